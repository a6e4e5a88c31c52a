"""Packing: token sequences filled in the proportions of a mixture of sources."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import Memo, send_if_small, staged
from revlens.llm.words import encoded, release

#: How a byte-level vocabulary writes a space, and bare words that are encoded as one text.
_SPACE, _JOINED = "\u0120", 1024
#: Sequences in a window of the mixture.
WINDOW_SEQUENCES = 64
#: Queues that share the sources without a target and with less than a token a window.
TAIL_QUEUES = 1024
#: Numbers that the windows a task remembers hold together.
_REMEMBERED = 1 << 22


class JsonCodec:
    """Ids by a tokenizer file of the tokenizers library, words in recent use remembered.

    For byte-level BPE that splits by the usual pattern, adds no prefix space and normalises nothing.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._after_space: Memo[str, bytes] = Memo(lambda w: self._plain(" " + w), 350_000, self._all)
        known = self._tokenizer.get_vocab()
        self._opens = np.zeros(max(known.values(), default=-1) + 1, bool)
        self._opens[[i for token, i in known.items() if token.startswith(_SPACE)]] = True

    def _all(self, words: list[str]) -> list[bytes]:
        """The ids of " " + w for every word; many bare words are one text, cut again before each space."""
        out: list[bytes] = [b""] * len(words)
        bare = [i for i, w in enumerate(words) if w and w == w.strip()]
        for at in range(0, len(bare), _JOINED):
            part = bare[at : at + _JOINED]
            for i, ids in zip(part, self._in_one([words[i] for i in part])):
                out[i] = ids
        for i in set(range(len(words))).difference(bare):
            out[i] = self._plain(" " + words[i])
        return out

    def _in_one(self, words: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)
        ids = np.array(found[0].ids, np.uint32)
        cuts = np.flatnonzero(self._opens[ids])
        if len(cuts) != len(words):  # a tokenizer that splits otherwise
            return [self._plain(" " + w) for w in words]
        data, ends = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _plain(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for ids, ends in encoded(texts, self._after_space, self._plain, "<u4"):
            yield from np.split(ids, ends[:-1])


@lru_cache(maxsize=4)
def codec(path: str) -> JsonCodec:
    """One codec for a Python worker, which serves many tasks."""
    return JsonCodec(path)


@dataclass(frozen=True)
class Phase:
    """A stretch of the stream in which the same queues take part.

    ``shares[i]`` tokens of queue ``queues[i]`` lie in it, ``taken[i]`` are those the queue gave to
    earlier phases.
    """

    start: int
    length: int
    queues: tuple[str, ...]
    shares: tuple[int, ...]
    taken: tuple[int, ...]

    def served(self, i: int, x: int) -> int:
        """Whole tokens queue i has been served when ``x`` tokens' worth of quanta are dealt."""
        return min(x, self.length) * self.shares[i] // self.length

    def window(self, nth: int, size: int) -> tuple[list[int], list[int]]:
        """Of every queue, tokens served before the window, and where in the stream its next ones lie."""
        low = [self.served(i, nth * size) for i in range(len(self.queues))]
        at, places = self.start + sum(low), []
        for i, n in enumerate(low):
            places.append(at)
            at += self.served(i, (nth + 1) * size) - n
        return low, places


def phases(totals: Mapping[str, int], targets: Mapping[str, float] | None = None) -> list[Phase]:
    """The round-robin's course, worked out from the queues' sizes alone.

    Each round fills one window: every queue in turn adds its quantum, its target share of the
    window, to its deficit counter and is served the counter's whole tokens; the rest, less than a
    token, is carried to the next window. As documents may be cut, no other deficit arises, and
    after x tokens' worth of quanta a queue has been served the whole tokens of x times its share.
    Where a queue ends, a phase ends, and the others share its part by their targets. Without
    targets every queue's is its own share of all tokens; then all end together. Queues without a
    target, or with none above 0, come last.
    """
    left = {q: n for q, n in sorted(totals.items()) if n > 0}
    wanted = {q: Fraction(n if targets is None else targets.get(q, 0)) for q, n in left.items()}
    taken = dict.fromkeys(left, 0)
    out: list[Phase] = []
    start = 0
    while left:
        active = {q: wanted[q] for q in left if wanted[q] > 0} or {q: Fraction(n) for q, n in left.items()}
        first = min(active, key=lambda q: (left[q] / active[q], q))
        shares = {q: min(left[q], int(left[first] * w / active[first])) for q, w in active.items()}
        shares = {q: n for q, n in shares.items() if n}
        length = sum(shares.values())
        out.append(Phase(start, length, tuple(shares), tuple(shares.values()), tuple(taken[q] for q in shares)))
        start += length
        for q, n in shares.items():
            taken[q] += n
            left[q] -= n
        left = {q: n for q, n in left.items() if n}
    return out


def places(
    course: dict[str, list[tuple[Phase, int]]],
    queue: str,
    start: int,
    length: int,
    window: int,
    known: dict[tuple[int, int], tuple[list[int], list[int]]],
) -> Iterator[tuple[int, int]]:
    """(Place in the stream, tokens) of a stretch of a queue, cut where it changes windows.

    ``course[queue]`` lists the phases the queue takes part in, with its index there; ``known``
    keeps windows for further calls.
    """
    for phase, i in course[queue]:
        if not length:
            return
        at = start - phase.taken[i]
        if at >= phase.shares[i]:
            continue
        some = min(length, phase.shares[i] - at)
        start, length = start + some, length - some
        nth = at * phase.length // (phase.shares[i] * window)
        while some:
            end = phase.served(i, (nth + 1) * window)
            if end > at:
                key = (phase.start, nth)
                if key not in known:
                    if len(known) * len(phase.queues) > _REMEMBERED:
                        known.clear()
                    known[key] = phase.window(nth, window)
                low, stream = known[key]
                now = min(some, end - at)
                yield stream[i] + at - low[i], now
                at, some = at + now, some - now
            nth += 1


def tokens(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", queue_col: str = "source"
) -> DataFrame:
    """Every row's ids (binary, ``end_id`` last) with its queue and its place in the queue's task share.

    ``part`` numbers the task, ``earlier`` counts the queue's tokens before the row in that task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer_path)
        part = TaskContext.get().partitionId()
        running: dict[str, int] = {}
        for batch in batches:
            ids, counts, earlier = [], [], []
            queues = batch.column("queue").to_pylist()
            narrow, wide = np.array([end_id], "<u4").astype("<u2").tobytes(), np.array([end_id], "<u4").tobytes()
            for queue, found in zip(queues, own.encode_all(batch.column("text"))):
                small = end_id < 1 << 16 and (not len(found) or found.max() < 1 << 16)
                ids.append(found.astype("<u2").tobytes() + narrow if small else found.tobytes() + wide)
                counts.append(len(found) + 1)
                earlier.append(running.get(queue, 0))
                running[queue] = earlier[-1] + counts[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("queue"),
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(earlier, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "queue", "part", "earlier", "n", "ids"],
            )
            release()

    named = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(queue_col).cast("string"), F.lit("")).alias("queue"),
        F.col(text_col).cast("string").alias("text"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return named.mapInArrow(run, f"doc_id {kind}, queue string, part int, earlier bigint, n bigint, ids binary")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    targets: Mapping[str, float] | None = None,
    length: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    queue_col: str = "source",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.

    Every id of every row lies in exactly one piece; all sequences but the last are full. Sources
    are queues; windows of ``WINDOW_SEQUENCES`` sequences are filled by a deficit round-robin to the
    ``targets`` (see ``phases``). Every source with a target, or with a token or more of its own share
    in a window, is a queue of its own, at most one per token of a window and target; the others, whose
    turn comes less often than once a window, take turns in ``TAIL_QUEUES`` queues. A NULL text is empty and still has its end id; NULL and empty
    source names are one queue; repeated rows are packed each. No rows, no pieces. Only the three
    named columns are read.

    Ids are made once and written with each row's place in its task. A row's place in its queue is
    that plus the queue's tokens in earlier tasks, from one small row per task and queue, and its
    place in the stream follows by arithmetic from the queues' totals. So no row is moved, no queue
    is gathered anywhere, and deficits carry over windows and tasks alike.
    """
    coded = staged(tokens(docs, tokenizer_path, end_id, id_col, text_col, queue_col), "tokens")
    window = length * WINDOW_SEQUENCES
    shares = _shared_queues(coded, targets, window)
    totals = {r["shared"]: r["n"] for r in shares.groupBy("shared").agg(F.sum("n").alias("n")).collect()}  # bounded, see above
    if targets is not None:
        targets = {_OWN + q: share for q, share in targets.items()}
    course: dict[str, list[tuple[Phase, int]]] = {q: [] for q in totals}
    for phase in phases(totals, targets):
        for i, queue in enumerate(phase.queues):
            course[queue].append((phase, i))
    bases = _bases(shares)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
        for batch in batches:
            row, first, size, crc, sequence, offset = [], [], [], [], [], []
            queues, begins = batch.column("queue").to_pylist(), batch.column("begin").to_pylist()
            counts, coded_ids = batch.column("n").to_pylist(), batch.column("ids")
            for at, (queue, begin, count) in enumerate(zip(queues, begins, counts)):
                data = coded_ids[at].as_buffer()
                wide = np.frombuffer(data, "<u2" if data.size == 2 * count else "<u4").astype("<u4")
                done = 0
                for place, many in places(course, queue, begin, count, window, known):
                    while many:
                        now = min(many, length - place % length)
                        row.append(at)
                        first.append(done)
                        size.append(now)
                        crc.append(zlib.crc32(wide[done : done + now]))
                        sequence.append(place // length)
                        offset.append(place % length)
                        place, many, done = place + now, many - now, done + now
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    *(pa.array(x, pa.int64()) for x in (first, size, crc)),
                    batch.column("n").take(taken),
                    *(pa.array(x, pa.int64()) for x in (sequence, offset)),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = coded.schema["doc_id"].dataType.simpleString()
    return (
        coded.join(bases, ["part", "queue"])
        .select("doc_id", F.col("shared").alias("queue"), "n", "ids", (F.col("base") + F.col("earlier")).alias("begin"))
        .mapInArrow(
            run,
            f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
            "sequence_id bigint, offset bigint",
        )
    )


_OWN, _TAIL = "=", "~"


def _shared_queues(coded: DataFrame, targets: Mapping[str, float] | None, window: int) -> DataFrame:
    """Tokens of each task and source, and ``shared``, the queue that the source is or is part of."""
    shares = staged(coded.groupBy("part", "queue").agg(F.sum("n").alias("n")), "source-shares")
    sources = shares.groupBy("queue").agg(F.sum("n").alias("total"))
    all_tokens = shares.agg(F.sum("n")).first()[0] or 0
    own = F.col("total") * window >= F.lit(all_tokens)
    if targets:
        own = own | F.col("queue").isin(*targets)
    tail = F.concat(F.lit(_TAIL), F.pmod(F.xxhash64("queue"), F.lit(TAIL_QUEUES)).cast("string"))
    names = sources.select("queue", F.when(own, F.concat(F.lit(_OWN), "queue")).otherwise(tail).alias("shared"))
    return staged(shares.join(names, "queue"), "queue-shares")


def _bases(shares: DataFrame) -> DataFrame:
    """Tokens of each queue before each task's part of a source, from a row per task and source.

    A queue's sources stand by task, then by name. Running sums in two steps, so that a queue's rows
    are added up in blocks of 1024 tasks.
    """
    from pyspark.sql import Window

    blocked = shares.withColumn("block", F.floor(F.col("part") / 1024))
    blocks = blocked.groupBy("shared", "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shared").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("shared", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("block_base"))
    within = Window.partitionBy("shared", "block").orderBy("part", "queue").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocked.withColumn("inner_base", F.coalesce(F.sum("n").over(within), F.lit(0))).join(blocks, ["shared", "block"])
    bases = staged(bases.select("part", "queue", "shared", (F.col("inner_base") + F.col("block_base")).alias("base")), "queue-bases")
    return send_if_small(bases, bases.count(), 96)
