"""Byte-level BPE by prefix dynamic programming: encoding, decoding, appends and edits."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import Memo
from revlens.llm.words import encoded

#: Strings up to this many bytes leave what their prefixes end with in the shared store.
SHORT = 64
#: Prefixes in the store; a full store starts anew.
STORED = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines "base64 rank"."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class _Endings:
    """For a growing string, which tokens it ends with: an Aho-Corasick automaton over bytes."""

    def __init__(self, tokens: dict[bytes, int]):
        self._child: dict[int, int] = {}  # node << 8 | byte
        self._fail = [0]
        self.ending: list[tuple[tuple[int, int], ...]] = [()]  # (token, length), longest first
        own: dict[int, tuple[int, int]] = {}
        level = {0}
        for token, rank in tokens.items():
            node = 0
            for byte in token:
                at = node << 8 | byte
                node = self._child.get(at, 0)
                if not node:
                    node = self._child[at] = len(self._fail)
                    self._fail.append(0)
                    self.ending.append(())
            own[node] = (rank, len(token))
        below: dict[int, list[tuple[int, int]]] = {}
        for at, node in self._child.items():
            below.setdefault(at >> 8, []).append((at & 255, node))
        while level:
            following = set()
            for parent in level:
                for byte, node in below.get(parent, ()):
                    fail = self._fail[parent]
                    while parent and fail and fail << 8 | byte not in self._child:
                        fail = self._fail[fail]
                    self._fail[node] = self._child.get(fail << 8 | byte, 0) if parent else 0
                    self.ending[node] = ((own[node],) if node in own else ()) + self.ending[self._fail[node]]
                    following.add(node)
            level = following
        self._next: Memo[int, int] = Memo(self._step, 300_000)

    def _step(self, at: int) -> int:
        node, byte = at >> 8, at & 255
        while node and node << 8 | byte not in self._child:
            node = self._fail[node]
        return self._child.get(node << 8 | byte, 0)

    def after(self, state: int, byte: int) -> int:
        return self._next[state << 8 | byte]


class PrefixEncoder:
    """Encodes byte strings as merging by rank would, from left to right without merging.

    For every prefix of a string there is exactly one token that can end its encoding: the one whose
    predecessor is the last token of the remaining shorter prefix and that merging would leave
    standing beside it. That token is stored for each prefix. The stored part stays valid when the
    string grows or changes further right, which makes appends and edits exact, and it is shared by
    all strings that begin alike.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # tokens that merging their own bytes brings about; no other can appear by merging
        sound = {t: r for t, r in ranks.items() if len(t) == 1 or self._merged(t) == [r]}
        self._endings = _Endings(sound)
        self._sizes = {rank: len(token) for token, rank in ranks.items()}
        self._beside: Memo[int, bool] = Memo(self._stands, 300_000)
        self._forget()

    def _forget(self) -> None:
        self._child: dict[int, int] = {}  # stored prefix << 8 | next byte
        self._token = [-1]
        self._state = [0]

    def _merged(self, data: bytes) -> list[int]:
        """The defining procedure: join the neighbours of lowest rank, leftmost first, while there are any."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min(
                ((self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks),
                default=(-1, -1),
            )
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _stands(self, pair: int) -> bool:
        left, right = pair >> 32, pair & 0xFFFFFFFF
        return self._merged(self.tokens[left] + self.tokens[right]) == [left, right]

    def last_tokens(self, data: bytes, known: list[tuple[int, int]] | None = None) -> list[tuple[int, int]]:
        """(Last token, automaton state) of every prefix, the empty one first.

        ``known`` are those of a common beginning; they are left as they are.
        """
        last = list(known or [(-1, 0)])
        beside, endings = self._beside, self._endings
        for end in range(len(last), len(data) + 1):
            state = endings.after(last[-1][1], data[end - 1])
            for token, size in endings.ending[state]:
                if size == end or beside[last[end - size][0] << 32 | token]:
                    last.append((token, state))
                    break
            else:
                raise ValueError("a single byte is not in the vocabulary")
        return last

    def unwind(self, last: list[tuple[int, int]]) -> list[int]:
        """Ids of the whole string, read back from its end."""
        out, at = [], len(last) - 1
        while at:
            token = last[at][0]
            out.append(token)
            at -= self._sizes[token]
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        """Ids of one match: a match that is a token is that token, any other goes by its prefixes."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > SHORT:
            return self.unwind(self.last_tokens(data))
        if len(self._token) > STORED:
            self._forget()
        child, tokens, states = self._child, self._token, self._state
        node, path = 0, [0]
        for end, byte in enumerate(data, 1):
            at = node << 8 | byte
            node = child.get(at)
            if node is None:
                state = self._endings.after(states[path[-1]], byte)
                for token, size in self._endings.ending[state]:
                    if size == end or self._beside[tokens[path[end - size]] << 32 | token]:
                        break
                else:
                    raise ValueError("a single byte is not in the vocabulary")
                node = child[at] = len(tokens)
                tokens.append(token)
                states.append(state)
            path.append(node)
        out, end, sizes = [], len(data), self._sizes
        while end:
            token = tokens[path[end]]
            out.append(token)
            end -= sizes[token]
        return out[::-1]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class TextCodec:
    """Encodes texts: the pattern's matches one by one, words in recent use remembered."""

    def __init__(self, ranks_path: str, pattern: str):
        self.encoder = PrefixEncoder(load_ranks(ranks_path))
        self.pattern = regex.compile(pattern)
        self._after_space: Memo[str, bytes] = Memo(self._word, 250_000)
        size = max(self.encoder.tokens) + 1
        tokens = [self.encoder.tokens.get(i, b"") for i in range(size)]
        self._sizes = np.fromiter(map(len, tokens), np.int64, size)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def _word(self, word: str) -> bytes:
        """Ids of a space and the word. Letters, and letters with one mark behind, need no pattern."""
        encode = self.encoder.encode
        if word.isalpha():
            return array("I", encode(b" " + word.encode())).tobytes()
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return array("I", encode(b" " + word[:-1].encode()) + encode(word[-1:].encode())).tobytes()
        return self._plain(" " + word)

    def _plain(self, text: str) -> bytes:
        encode = self.encoder.encode
        return array("I", [i for m in self.pattern.findall(text) for i in encode(m.encode())]).tobytes()

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """For every text its ids, unsigned 32-bit, little-endian."""
        for ids, ends in encoded(texts, self._after_space, self._plain, "<u4"):
            yield from np.split(ids, ends[:-1])

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all(pa.array([text], pa.string())))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered from one table of all tokens."""
        out = []
        for at in range(0, len(ids), 1 << 16):
            part = ids[at : at + (1 << 16)]
            sizes = self._sizes[part]
            ends = np.cumsum(sizes)
            index = np.arange(ends[-1]) + np.repeat(self._starts[part] - (ends - sizes), sizes)
            out.append(self._bytes[index].tobytes())
        return b"".join(out)


class EncodedText:
    """A text with its encoding that follows changes of the text without encoding it anew."""

    def __init__(self, codec: TextCodec, text: str = ""):
        self._codec = codec
        self.text = ""
        self._starts: list[int] = []
        self._pieces: list[str] = []
        self._last: list[list[tuple[int, int]]] = []
        self.replace(0, 0, text)

    @property
    def ids(self) -> list[int]:
        encoder = self._codec.encoder
        out: list[int] = []
        for piece, last in zip(self._pieces, self._last):
            whole = encoder.ranks.get(piece.encode())
            out += [whole] if whole is not None else encoder.unwind(last)
        return out

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Put ``new`` for ``text[start:end]``; returns how many matches were encoded again.

        Matches that end two characters before ``start`` stand (none looks further). From there the pattern runs
        until a match begins where an old one did, after the change: from a given place on, matches
        depend on nothing before it.
        """
        text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        keep = 0
        while keep < len(self._pieces) and self._starts[keep] + len(self._pieces[keep]) + 1 < start:
            keep += 1
        at = self._starts[keep] if keep < len(self._starts) else (
            self._starts[-1] + len(self._pieces[-1]) if self._pieces else 0
        )
        old_at = {s + shift: i for i, s in enumerate(self._starts) if i >= keep and s >= end}
        changed_to = start + len(new)
        starts, pieces = [], []
        resume = len(self._pieces)
        while at < len(text):
            if at >= changed_to and at in old_at:
                resume = old_at[at]
                break
            piece = self._codec.pattern.match(text, at).group()
            starts.append(at)
            pieces.append(piece)
            at += len(piece)
        encoder = self._codec.encoder
        last = []
        for n, piece in enumerate(pieces):
            data = piece.encode()
            known: list[tuple[int, int]] | None = None
            if keep + n < resume:  # what stood here may share its beginning
                before = self._pieces[keep + n].encode()
                same = next((i for i, (x, y) in enumerate(zip(before, data)) if x != y), min(len(before), len(data)))
                known = self._last[keep + n][: same + 1]
            last.append(encoder.last_tokens(data, known))
        moved = [s + shift for s in self._starts[resume:]]
        self._starts = self._starts[:keep] + starts + moved
        self._pieces = self._pieces[:keep] + pieces + self._pieces[resume:]
        self._last = self._last[:keep] + last + self._last[resume:]
        self.text = text
        return len(pieces)


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> TextCodec:
    """One codec for a Python worker, which serves many tasks."""
    return TextCodec(ranks_path, pattern)


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> TextCodec:
    """One codec for a Python worker, which serves many tasks."""
    return TextCodec(ranks_path, pattern)


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``ids`` (binary: little-endian unsigned 32-bit) for every row of ``docs``.

    A NULL text is an empty one, which has no ids. Repeated rows and ids each come back, a NULL id
    too. Only the two named columns are read, so no other column's name can clash. No rows, no rows.
    The vocabulary file has to exist at the same path on every executor.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            ids = [i.tobytes() for i in own.encode_all(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return _texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {_kind(docs, id_col)}, ids binary")


def decode_ids(coded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``data`` (binary) for every row of ``encode_texts``; NULL ids give no bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            data = [own.decode(np.frombuffer(i.as_py() or b"", "<u4")) for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {_kind(coded, 'doc_id')}, data binary")


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: encoded, then decoded from the ids.

    Ids and bytes stay in the task that made them; a row of digests leaves it. Rows as in
    ``encode_texts``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            counts, coded, back = [], [], []
            for ids in own.encode_all(batch.column("text")):
                counts.append(len(ids))
                coded.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _texts(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {_kind(docs, id_col)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
