"""Near duplicates by SimHash: fingerprints and the binary-trie self-join that links them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import send_if_small, spare_name, staged
from revlens.llm.components import connected_components
from revlens.llm.words import release

BITS = 64
#: Widths of the blocks a fingerprint is cut into.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: A subtrie with more fingerprints than this is cut into node pairs that many tasks share.
HOT_NODE = 20_000
#: Bits by which a hot subtrie is opened.
HOT_BITS = 6
#: Node pairs one step of the traversal holds.
FRONTIER = 1 << 16

# One byte to eight counters of one byte each, most significant bit first.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64)[:, 0]


def _hashes(text: str, words_per_shingle: int, seed: int) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, \x20 \x09-\x0D only
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= words_per_shingle:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[words_per_shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(line[a:b], seed) for a, b in zip(starts[: len(last)].tolist(), last)), np.uint64, len(last)
    )


def fingerprint(text: str | None, words_per_shingle: int = 4, seed: int = 42) -> int:
    """Bit i is set if more than half of the shingles' hashes have it; a text without words has 0."""
    hashes = _hashes(text or "", words_per_shingle, seed)
    if not len(hashes):
        return 0
    pad = -len(hashes) % 255  # counters of one byte hold 255 rows
    rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    if pad:
        rows = np.concatenate((rows, np.zeros((pad, 8), np.uint8)))
    counts = np.add.reduce(_SPREAD[rows].reshape(-1, 255, 8), axis=1).view(np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint as a signed long) for every row of ``docs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words_per_shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
            release()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, fp bigint"
    )


class Forest:
    """Disjoint sets over positions 0..n-1; unites whole arrays of links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        root = self.parent[x]
        while True:
            up = self.parent[root]
            if np.array_equal(up, root):
                return root
            root = up

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            open_ = a != b
            a, b = a[open_], b[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def roots(self) -> np.ndarray:
        self.parent = self.find(np.arange(len(self.parent)))
        return self.parent


def _traverse(fps: np.ndarray, pairs: np.ndarray, max_bits: int, forest: Forest) -> None:
    """Traverse node pairs of the trie over ``fps`` together and unite all fingerprints that link.

    ``fps`` is sorted within every node, so a node is a range of positions. A row of ``pairs`` is
    (first low, first high, second low, second high, differing bits so far, next bit). A pair whose
    bits exceed the budget is dropped with everything below it, a pair of few members is compared
    member by member, any other is opened by the next bit. The open pairs form a stack taken in
    bounded pieces.
    """
    stack = [pairs]
    while stack:
        pairs = stack.pop()
        if len(pairs) > FRONTIER:
            stack.append(pairs[FRONTIER:])
            pairs = pairs[:FRONTIER]
        same = (pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] == pairs[:, 3])
        size_a, size_b = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        full = (size_a > 0) & (size_b > 0) & (pairs[:, 4] <= max_bits) & ~(same & (size_a < 2))
        pairs, same, size_a, size_b = pairs[full], same[full], size_a[full], size_b[full]
        if not len(pairs):
            continue
        small = (size_a * size_b <= 16) | (pairs[:, 5] < 0)
        if small.any():
            at = pairs[small]
            wide = size_b[small]
            many = size_a[small] * wide
            which = np.repeat(np.arange(len(at)), many)
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            i = at[which, 0] + nth // wide[which]
            j = at[which, 2] + nth % wide[which]
            linked = (i != j) & (np.bitwise_count(fps[i] ^ fps[j]) <= max_bits)
            forest.unite(i[linked], j[linked])
        rest = pairs[~small]
        if not len(rest):
            continue
        opened = []
        for bit in np.unique(rest[:, 5]):
            at = rest[rest[:, 5] == bit]
            zeros = np.concatenate(([0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1) == 0)))
            a0, a1, b0, b1, diff, _ = at.T
            am, bm = a0 + zeros[a1] - zeros[a0], b0 + zeros[b1] - zeros[b0]
            below = np.full(len(at), bit - 1)
            self_pair = (a0 == b0) & (a1 == b1)
            opened += [
                np.stack((a0, am, b0, bm, diff, below), axis=1),
                np.stack((am, a1, bm, b1, diff, below), axis=1),
                np.stack((a0, am, bm, b1, diff + 1, below), axis=1),
                np.stack((am, a1, b0, bm, diff + 1, below), axis=1)[~self_pair],
            ]
        opened = np.concatenate(opened)
        stack.append(opened[(opened[:, 0] < opened[:, 1]) & (opened[:, 2] < opened[:, 3]) & (opened[:, 4] <= max_bits)])


def _orders(max_bits: int) -> list[tuple[int, ...]]:
    """Orders of the blocks: each choice of leading blocks that a pair within the budget may agree on."""
    clean = len(BLOCKS) - max_bits
    if clean < 1:
        raise ValueError(f"at most {len(BLOCKS) - 1} differing bits")
    return [c + tuple(b for b in range(len(BLOCKS)) if b not in c) for c in combinations(range(len(BLOCKS)), clean)]


def _permuted(order: tuple[int, ...], fp):
    """The fingerprint with its blocks in this order, as a Column expression over signed longs."""
    from_top = [sum(BLOCKS[:b]) for b in range(len(BLOCKS))]
    out, used = None, 0
    for b in order:
        block = F.shiftrightunsigned(fp, BITS - from_top[b] - BLOCKS[b]).bitwiseAND(F.lit((1 << BLOCKS[b]) - 1))
        block = F.shiftleft(block, BITS - used - BLOCKS[b])
        out = block if out is None else out.bitwiseOR(block)
        used += BLOCKS[b]
    return out


def linked_classes(classes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links ``a``, ``b`` between the classes (``rep`` long, ``fp`` long, each ``fp`` once) that span
    exactly the components of "at most ``max_bits`` differing bits".

    Two such fingerprints agree on at least 6 - max_bits of their 6 blocks. For every choice of that
    many blocks the trie is built with these on top: its node pairs down to there are the diagonal,
    every subtrie below is a group of its own, and groups are joined with themselves independently
    by descending node pairs together. A subtrie of more than ``HOT_NODE`` (and more than a
    thousandth of all) fingerprints is opened by 6 bits first, and its node pairs within the budget
    become groups of their own. Each group returns a spanning forest of its links, never all pairs.
    """
    orders = _orders(max_bits)
    total = classes.count()
    hot_rows = max(HOT_NODE, total // 1000)  # at most 1000 hot groups an order, whatever the input
    keyed = classes.select(
        "rep",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("ord"),
                        F.lit(sum(BLOCKS[b] for b in order[: len(BLOCKS) - max_bits])).alias("top"),
                        _permuted(order, F.col("fp")).alias("pfp"),
                    )
                    for n, order in enumerate(orders)
                ]
            )
        ).alias("k"),
    ).select("rep", "k.ord", "k.top", "k.pfp", F.expr("shiftrightunsigned(k.pfp, 64 - k.top)").alias("key"))
    hot = keyed.groupBy("ord", "key").count().where(F.col("count") > hot_rows).select("ord", "key", F.lit(True).alias("hot"))
    hot = staged(hot, "hot-nodes")
    near = [[u, v] for u in range(1 << HOT_BITS) for v in range(u, 1 << HOT_BITS) if (u ^ v).bit_count() <= max_bits]
    tables = {n: [u * (1 << HOT_BITS) + v for u, v in near if n in (u, v)] for n in range(1 << HOT_BITS)}
    if hot.isEmpty():
        keyed = keyed.withColumn("pair", F.lit(-1))
    else:
        opened = F.array(*[F.array(*[F.lit(p) for p in tables[n]]) for n in range(1 << HOT_BITS)])
        node = F.expr(f"cast(shiftrightunsigned(shiftleft(pfp, top), {BITS - HOT_BITS}) as int)")
        keyed = (
            keyed.join(F.broadcast(hot), ["ord", "key"], "left")
            .withColumn("pair", F.explode(F.when(F.col("hot"), F.get(opened, node)).otherwise(F.array(F.lit(-1)))))
            .drop("hot")
        )

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None
        for batch in batches:
            if kept is not None and len(kept):
                batch = pd.concat((kept, batch), ignore_index=True)
            head = batch[["ord", "key", "pair"]].to_numpy()
            changes = np.flatnonzero((head[1:] != head[:-1]).any(axis=1)) + 1
            cut = int(changes[-1]) if len(changes) else 0
            if cut:
                yield _joined(batch.iloc[:cut], max_bits)
            kept = batch.iloc[cut:]
        if kept is not None and len(kept):
            yield _joined(kept, max_bits)

    return (
        keyed.repartition("ord", "key", "pair")
        .sortWithinPartitions("ord", "key", "pair", "pfp")  # of one sign within a group
        .select("rep", "ord", "top", "pfp", "key", "pair")
        .mapInPandas(run, "a bigint, b bigint")
    )


def _joined(rows: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Spanning links of whole groups, which lie one after the other."""
    fps = rows["pfp"].to_numpy().view(np.uint64)
    reps = rows["rep"].to_numpy()
    head = rows[["ord", "key", "pair"]].to_numpy()
    starts = np.concatenate(([0], np.flatnonzero((head[1:] != head[:-1]).any(axis=1)) + 1))
    ends = np.concatenate((starts[1:], [len(rows)]))
    some = ends - starts > 1
    starts, ends = starts[some], ends[some]
    if not len(starts):
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    top = rows["top"].to_numpy()[starts].astype(np.int64)
    pair = rows["pair"].to_numpy()[starts].astype(np.int64)
    split, u, v = pair >= 0, pair // (1 << HOT_BITS), pair % (1 << HOT_BITS)
    shift = np.where(split, BITS - top - HOT_BITS, 0).astype(np.uint64)
    # a hot group of two nodes: the first one's members come first
    middle = ends.copy()
    for g in np.flatnonzero(split & (u != v)):
        node = (fps[starts[g] : ends[g]] >> shift[g]) & np.uint64((1 << HOT_BITS) - 1)
        middle[g] = starts[g] + int((node == np.uint64(u[g])).sum())
    crossing = split & (u != v)
    pairs = np.stack(
        (
            starts,
            np.where(crossing, middle, ends),
            np.where(crossing, middle, starts),
            ends,
            np.where(crossing, np.bitwise_count((u ^ v).astype(np.uint64)), 0),
            np.where(split, BITS - top - HOT_BITS, BITS - top) - 1,
        ),
        axis=1,
    ).astype(np.int64)
    forest = Forest(len(rows))
    _traverse(fps, pairs, max_bits, forest)
    roots = forest.roots()
    hangs = np.flatnonzero(roots != np.arange(len(rows)))
    return pd.DataFrame({"a": reps[hangs], "b": reps[roots[hangs]]})


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 4,
    max_bits: int = 4,
) -> DataFrame:
    """``doc_id``, ``fp`` (signed long), ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing bits.
    NULL and empty texts, and texts of white space, have fingerprint 0 and link like any other. Rows
    of a repeated id each come back; all of them are of one node if their texts link, and the id is
    a link between its texts' classes otherwise. Rows with a NULL id come back with a NULL component
    and link nothing. An empty table gives no rows. Only the two named columns are read.
    """
    rows = staged(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    named = rows.where("doc_id is not null")
    classes = staged(named.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")
    # an id on rows of several classes links each of them to the smallest
    held = named.join(classes, "fp").select("doc_id", "rep").distinct()
    least = named.join(classes, "fp").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    repeated = held.join(least.select("doc_id", "a"), "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    links = linked_classes(classes, max_bits).unionAll(repeated)
    components = connected_components(links)
    labelled = staged(
        classes.join(components, classes["rep"] == components["node"], "left").select(
            "fp", F.least("rep", F.coalesce("component", "rep")).alias("component_id")
        ),
        "fingerprint-components",
    )
    return rows.join(labelled, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 4,
    max_bits: int = 4,
) -> DataFrame:
    """The rows of ``docs`` without near copies: of every component the row of its smallest id stays.

    All columns come back as they are. Rows with a NULL id stay. Of several rows with the id that
    stays, the one with the smallest text does. What goes is a table of ids, joined by its counted
    size: broadcast while small, else by a shuffle that hashes the ids and does not sort the texts.
    """
    found = staged(
        near_duplicates(docs, id_col, text_col, words_per_shingle, max_bits)
        .where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("component_id")),
        "near-duplicates",
    )
    key = spare_name(docs, "gone")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(key))
    many = found.where("doc_id = component_id and n > 1").select(F.col("doc_id").alias(key))
    n_gone, n_many = gone.count(), many.count()

    def against(ids: DataFrame, count: int, how: str) -> DataFrame:
        small = send_if_small(ids, count, 16)
        ids = small if small is not ids else ids.hint("shuffle_hash")
        return docs.join(ids, docs[id_col] == ids[key], how)

    if not n_many:
        return against(gone, n_gone, "left_anti")
    order = Window.partitionBy(id_col).orderBy(text_col)
    place = spare_name(docs, "place")
    first = against(many, n_many, "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return against(gone.unionAll(many), n_gone + n_many, "left_anti").unionAll(first)
