"""Hard-negative mining: exact search within score ranges, pruned by length buckets and sorted coordinates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import send_if_small, staged
from revlens.llm.vectors import matrix, usable

#: Rows of a length bucket, rows that one task reads, anchors that one task holds.
BUCKET, PART, BLOCK = 2048, 16_384, 2048
#: Coordinates of an anchor, the largest ones, whose feasible ranges are intersected.
FOCUS = 4
#: Components are floor(SCALE * x).
SCALE = 256.0
_SLACK = 1e-9
_LONG = 2**63 - 1


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while these are exact, else in whole numbers of any size."""
    if rows.size and float(np.abs(rows).max()) * float(np.abs(query).max()) * len(query) >= 2.0**53:
        whole = [sum(int(a) * int(b) for a, b in zip(r, query)) for r in rows]
        return np.array([max(-_LONG - 1, min(_LONG, x)) for x in whole], object)
    return (rows @ query).astype(np.int64)


class _Bucket:
    """Rows of similar length; per coordinate their unit vectors' values, sorted when first needed."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, uids: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.uids, self.rows = ids, labels, uids, rows
        with np.errstate(all="ignore"):
            self.lengths = np.sqrt((rows * rows).sum(axis=1))
            self.longest = float(self.lengths.max(initial=0.0))
            self.unit = rows / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.sorted:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.sorted[f] = order, self.unit[order, f]
        return self.sorted[f]

    def feasible(self, query: np.ndarray, length: float, focus: np.ndarray, floor: float) -> np.ndarray:
        """Places of all rows whose product with the query can reach ``floor``, and of some others.

        For a unit row p and a unit query q, q.p >= t leaves p only the values between
        q_f t - sqrt((1 - t^2)(1 - q_f^2)) and q_f t + the same at every coordinate f, without an
        upper end where q_f >= t and without a lower one where -q_f >= t.
        """
        if floor <= 0 or length <= 0 or not np.isfinite(length * self.longest):
            return np.arange(len(self.ids))
        t = floor / (length * self.longest) * (1 - _SLACK) if self.longest > 0 else np.inf
        if t > 1:
            return np.empty(0, np.int64)
        q = query[focus] / length
        width = np.sqrt(max(0.0, 1 - t * t)) * np.sqrt(np.maximum(0.0, 1 - q * q)) + _SLACK
        low, high = np.where(-q >= t, -2.0, q * t - width), np.where(q >= t, 2.0, q * t + width)
        ranges = []
        for n, f in enumerate(focus):
            order, values = self._list(int(f))
            start, stop = np.searchsorted(values, low[n], "left"), np.searchsorted(values, high[n], "right")
            ranges.append((int(stop - start), n, order[start:stop]))
        ranges.sort(key=lambda r: r[0])
        left = ranges[0][2]
        for _, n, _ in ranges[1:]:
            if not len(left):
                break
            values = self.unit[left, focus[n]]
            left = left[(values >= low[n]) & (values <= high[n])]
        return left[self.lengths[left] * length >= floor * (1 - _SLACK)]


class _Best:
    """The highest scores up to ``high``, none below ``floor``, at most ``k``; ties to smaller ids."""

    def __init__(self, k: int, floor: int | None, high: int | None):
        self.k, self.floor, self.high = k, floor, high
        self.ids = np.empty(0, np.int64)
        self.uids = np.empty(0, np.int64)
        self.scores: np.ndarray = np.empty(0, np.int64)

    def see(self, ids: np.ndarray, uids: np.ndarray, scores: np.ndarray) -> None:
        keep = np.ones(len(ids), bool)
        if self.floor is not None:
            keep &= (scores >= self.floor).astype(bool)
        if self.high is not None:
            keep &= (scores <= self.high).astype(bool)
        if not keep.any():
            return
        ids, uids, scores = ids[keep], uids[keep], scores[keep]
        if len(ids) > 4 * self.k and scores.dtype != object:
            keep = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, uids, scores = ids[keep], uids[keep], scores[keep]
        ids, uids = np.concatenate((self.ids, ids)), np.concatenate((self.uids, uids))
        scores = np.concatenate((self.scores, scores))
        order = np.lexsort((uids, ids, [-s for s in scores] if scores.dtype == object else -scores))[: self.k]
        self.ids, self.uids, self.scores = ids[order], uids[order], scores[order]
        if len(order) == self.k:
            self.floor = int(self.scores[-1])


def _cut(rows: DataFrame, size: int, name: str, number: str) -> DataFrame:
    """Rows in order of falling length, cut into parts of ``size``, a part's number as ``number``.

    The order ends with the row's own number, so rows alike are many parts too. Written aside; the
    rows of each range are counted (one number a task), so that parts do not end where ranges do.
    """
    order = ["dim", F.desc("len"), "uid"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("_range", F.shiftright("_at", 33)), name)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    at = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return rows.join(F.broadcast(ranges), "_range").withColumn(number, F.floor(at / size)).drop("_at", "_range", "_before")


_ROW = ["uid", "id", "label", "dim", "len", "vec"]
_MEET = ["dim", "part", "block"]
_FOUND = "block long, anchor long, place int, uid long, id long, score long"


def _visited(data: DataFrame, anchors: DataFrame, visits: DataFrame, same_label: bool, k: int) -> DataFrame:
    """What the anchors find in the parts they visit: at most ``k`` rows per anchor, wish and part.

    ``visits`` has ``uid`` of an anchor and ``part``. An anchor's ``wishes`` are ranges of scores: a
    floor (NULL: none) and a highest score (NULL: none).
    """
    asked = anchors.join(visits, "uid").select("part", "block", *_ROW, "wishes")
    pairs = staged(asked.groupBy(*_MEET).agg(F.count(F.lit(1)).alias("n")), "hardneg-pairs")
    given = data.join(send_if_small(pairs.select(*_MEET), pairs.count(), 20), ["dim", "part"]).select("part", "block", *_ROW)

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and queries.num_rows:
            block = queries.column("block")[0].as_py()
            rows = rows.sort_by([("len", "descending"), ("uid", "ascending")])
            buckets = [
                _Bucket(*[some.column(c).to_numpy() for c in ("id", "label", "uid")], matrix(some.column("vec")))
                for some in (rows.slice(at, BUCKET) for at in range(0, rows.num_rows, BUCKET))
            ]
            vectors = matrix(queries.column("vec"))
            names = ("uid", "label", "wishes")
            for uid, label, wishes, q in zip(*[queries.column(c).to_pylist() for c in names], vectors):
                found = [_Best(k, w["floor"], w["high"]) for w in wishes]
                with np.errstate(all="ignore"):
                    length = float(np.sqrt((q * q).sum()))
                focus = np.argsort(-np.abs(q), kind="stable")[:FOCUS]
                for bucket in buckets:
                    floors = [b.floor for b in found]
                    floor = -np.inf if None in floors else float(min(floors))
                    at = bucket.feasible(q, length, focus, floor)
                    at = at[((bucket.labels[at] == label) == same_label) & (bucket.uids[at] != uid)]
                    if len(at):
                        scores = _scores(bucket.rows[at], q)
                        for best in found:
                            best.see(bucket.ids[at], bucket.uids[at], scores)
                for place, best in enumerate(found):
                    out += [(block, uid, place, u, i, int(s)) for u, i, s in zip(best.uids.tolist(), best.ids.tolist(), best.scores)]
        types = [("block", pa.int64()), ("anchor", pa.int64()), ("place", pa.int32()), ("uid", pa.int64()), ("id", pa.int64()), ("score", pa.int64())]
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(types)})

    return given.groupBy(*_MEET).cogroup(asked.groupBy(*_MEET)).applyInArrow(search, _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(data: DataFrame, anchors: DataFrame, parts: dict[int, list[tuple[int, float]]], same_label: bool, k: int) -> DataFrame:
    """The ``k`` best of every anchor's wish over all parts: ``anchor``, ``place``, ``rank``, ``id``, ``score``.

    The part of the longest rows comes first. What it yields raises the floors, and only the parts
    whose longest row could still reach an anchor's lowest floor are visited after it.
    """
    first = F.create_map(*[F.lit(x) for dim, ps in parts.items() for x in (dim, ps[0][0])])
    found = staged(_visited(data, anchors, anchors.select("uid", F.element_at(first, F.col("dim")).alias("part")), same_label, k), "hardneg-first")
    if all(len(ps) == 1 for ps in parts.values()):
        return _top(found, k)
    reached = found.groupBy("anchor", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    reached = reached.where(F.col("n") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("least"))
    raised = anchors.join(reached, F.col("uid") == F.col("anchor"), "left").drop("anchor")
    floors = F.transform(
        "wishes",
        lambda w, i: F.struct(F.coalesce(F.col("least")[i], w["floor"]).alias("floor"), w["high"].alias("high")),
    )
    raised = raised.withColumn("wishes", floors)
    lowest = F.when(F.exists("wishes", lambda w: w["floor"].isNull()), F.lit(float("-inf"))).otherwise(
        F.array_min(F.transform("wishes", lambda w: w["floor"])).cast("double")
    )
    raised = staged(raised.drop("least").withColumn("lowest", lowest), "hardneg-raised")
    # one number per part of PART rows
    others = F.create_map(
        *[
            x
            for dim, ps in parts.items()
            for x in (F.lit(dim), F.array(*[F.struct(F.lit(p).alias("part"), F.lit(reach).alias("reach")) for p, reach in ps[1:]]).cast("array<struct<part:bigint,reach:double>>"))
        ]
    )
    near = F.filter(F.element_at(others, F.col("dim")), lambda p: (F.col("lowest") <= 0) | (p["reach"] * F.col("len") >= F.col("lowest") * (1 - _SLACK)))
    visits = raised.select("uid", F.explode(F.transform(near, lambda p: p["part"])).alias("part"))
    return _top(found.unionByName(_visited(data, raised.drop("lowest"), visits, same_label, k)), k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: tuple[int, int] = (30, 100),
    high: tuple[int, int] = (90, 100),
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A row's score with an anchor is the integer product of their components ``floor(256 x)``. An
    anchor's positives are its ``positives`` highest other rows of the same label; for each, the
    ``negatives`` highest rows of other labels between the shares ``low`` and ``high`` (fractions) of
    the positive's score. Ties go to the smaller id; fewer rows, fewer ranks; a positive score below
    zero has no range. Rows with a NULL id, label or vector, or a NULL or non-finite component, take no
    part; rows of one id are rows of their own; only vectors of one length are compared. A score beyond
    a long is its limit. Other columns do not matter. No rows, no result.

    Method: rows in order of falling length, cut into buckets with sorted lists of their unit vectors'
    coordinates. A floor, the lower end of a range or the last of the best so far, and a bucket's
    longest row give every focus coordinate of an anchor a range of feasible values; the rows in all
    ranges are verified exactly. Parts of whole buckets meet blocks of anchors in tasks of bounded size.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
        is_anchor.alias("asks"),
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")))
    rows = rows.withColumn("vec", F.transform("vec", _floored))
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.select(
        "id", "label", "vec", F.coalesce("asks", F.lit(False)).alias("asks"),
        F.size("vec").alias("dim"), F.sqrt(squares).alias("len"), F.monotonically_increasing_id().alias("uid"),
    )
    rows = staged(rows, "hardneg-rows")
    data = _cut(rows, PART, "hardneg-data", "part")
    parts: dict[int, list[tuple[int, float]]] = {}
    for r in data.groupBy("dim", "part").agg(F.max("len").alias("reach")).orderBy("dim", "part").collect():
        parts.setdefault(r.dim, []).append((r.part, r.reach))
    anchors = _cut(data.where("asks").drop("part"), BLOCK, "hardneg-anchors", "block")
    if not parts:
        parts = {0: [(0, 0.0)]}
    any_score = F.array(F.struct(F.lit(None).cast("long").alias("floor"), F.lit(None).cast("long").alias("high")))
    near = staged(_searched(data, anchors.withColumn("wishes", any_score), parts, True, positives), "hardneg-positives")

    def share(of: tuple[int, int], up: bool) -> Column:
        exact = F.col("score").cast("decimal(38,0)") * of[0] / of[1]
        return (F.ceil(exact) if up else F.floor(exact)).cast("long")

    wanted = near.where("score >= 0").select("anchor", F.col("rank").alias("of"), F.struct(share(low, True).alias("floor"), share(high, False).alias("high")).alias("wish"))
    wanted = wanted.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("of", "wish"))).alias("w"))
    wanted = wanted.select("anchor", F.transform("w", lambda x: x["wish"]).alias("wishes"))
    asking = staged(anchors.join(wanted, F.col("uid") == F.col("anchor")).drop("anchor"), "hardneg-asking")
    mined = _searched(data, asking, parts, False, negatives)
    names = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    # wishes stand in the order of the positives, none of which with a score below 0 precedes another
    pairs = near.select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        mined.select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(pairs, ["anchor", "place"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _floored(x: Column) -> Column:
    """``floor(256 x)`` as a double, of any size: doubles of 2^53 and more are whole already."""
    scaled = x * SCALE
    return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)
