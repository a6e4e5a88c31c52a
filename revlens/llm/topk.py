"""Exact top-k search by inner product: a Voronoi kNN join."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import staged
from revlens.llm.vectors import distances, matrix, pivots, usable

#: Queries a cell should hold; queries a task holds; data rows that meet them in one task.
CELL_QUERIES = 512
TASK_QUERIES = 8192
TASK_ROWS = 1 << 17
MAX_CELLS = 512
#: Components are floor(SCALE * x).
SCALE = 256.0
_LONG = 2**63 - 1


def _ints(rows: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * rows)


def _lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """One more component makes all data equally long: then the nearest has the highest product."""
    rest = np.sqrt(np.maximum(longest * longest - (rows * rows).sum(axis=1), 0.0))
    return np.concatenate((rows, rest[:, None]), axis=1)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while these are exact, else in whole numbers of any size."""
    if queries.size and rows.size:
        bound = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
        if bound >= 2.0**53:
            whole = np.array([[int(x) for x in q] for q in queries], object) @ np.array(
                [[int(x) for x in r] for r in rows], object
            ).T
            return np.clip(whole, -_LONG - 1, _LONG)
    return queries @ rows.T


class _Best:
    """The ``k`` best of the rows seen so far, for each of some queries; ties to smaller ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        self.ids, self.rows, self.k = ids, rows, k
        self.q = self.x = np.empty(0, np.int64)
        self.score: np.ndarray = np.empty(0)
        self.floor: np.ndarray = np.full(len(ids), -np.inf)

    def see(self, ids: np.ndarray, rows: np.ndarray) -> None:
        step = max(1, (1 << 22) // max(1, len(self.ids)))
        for at in range(0, len(ids), step):
            self._see(ids[at : at + step], rows[at : at + step])

    def _see(self, ids: np.ndarray, rows: np.ndarray) -> None:
        scores = _products(self.rows, rows)
        q, x = np.nonzero((scores >= self._reached(scores)[:, None]) & (self.ids[:, None] != ids[None, :]))
        q, score, x = np.concatenate((self.q, q)), np.concatenate((self.score, scores[q, x])), np.concatenate((self.x, ids[x]))
        order = np.lexsort((x, -score, q))
        q, score, x = q[order], score[order], x[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.q, self.score, self.x = q[keep], score[keep], x[keep]
        full = place == self.k - 1
        self.floor = self.floor.astype(scores.dtype) if scores.dtype == object else self.floor
        self.floor[q[full]] = score[full]

    def _reached(self, scores: np.ndarray) -> np.ndarray:
        """A score each query's best are known to reach: of rows seen before, or of this block."""
        width = scores.shape[1]
        if width <= self.k + 1 or scores.dtype == object:
            return self.floor
        # one of the k + 1 highest may be the query itself
        own = np.partition(scores, width - self.k - 1, axis=1)[:, width - self.k - 1]
        return np.maximum(self.floor, own)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for every query its ``k`` highest products.

    Queries are the rows for which ``is_query`` holds, candidates all rows but those of the query's
    own id; ties go to the smaller id. Fewer candidates, fewer ranks. Vectors that are NULL or hold
    NULL or non-finite components and rows with a NULL id take no part. An id names one vector: of
    several rows with one id the smallest vector stands. Only vectors of one length are compared. A
    score beyond a long is its limit. Only the two named columns and those of ``is_query`` are read.

    Method: the data are lifted to equal length, which turns the highest product into the smallest
    distance. Pivots cut queries into Voronoi cells. One summary per cell pair gives a bound for how
    far the k-th neighbour of a cell's queries can be; a data row goes to exactly those cells whose
    queries it could serve, by the triangle inequality. Cells of many queries and rows are cut again
    by hashes of the ids, so a task holds at most ``TASK_QUERIES`` queries and reads its rows as a
    stream; each task returns ``k`` rows a query.
    """
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"), is_query.alias("asks"))
        .where(F.col("id").isNotNull() & usable(F.col("vec")))
        .groupBy("id")
        .agg(F.min("vec").alias("vec"), F.max("asks").alias("asks"))
    )
    rows = staged(rows.select("id", "vec", F.coalesce("asks", F.lit(False)).alias("asks")), "vectors")
    total, asking = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    cells = int(min(MAX_CELLS, max(4, -(-asking // CELL_QUERIES))))
    chosen = {dim: _ints(p) for dim, p in pivots(rows.where("asks"), cells).items()}
    longest = _longest(rows)
    centres = {dim: np.concatenate((p, np.zeros((len(p), 1))), axis=1) for dim, p in chosen.items()}
    reach = _reach(rows, centres, longest, k)
    shares = max(1, -(-total // TASK_ROWS))
    parts = {key: max(1, -(-n // TASK_QUERIES)) for key, (_, _, n) in reach.items()}

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, some in _by_length(batch):
                if dim not in centres:
                    continue
                ints = _ints(matrix(some.column("vec")))
                ids = some.column("id").to_numpy()
                asks = some.column("asks").to_numpy(zero_copy_only=False).astype(bool)
                # queries: to their cell, to one of its parts, to every share of the rows
                home = np.argmin(distances(_flat(ints), centres[dim]), axis=1)
                share = _spread(ids, shares)
                far = distances(_lifted(ints, longest), centres[dim])
                for cell in range(len(centres[dim])):
                    if (dim, cell) not in reach:
                        continue
                    radius, bound, _ = reach[dim, cell]
                    many = parts[dim, cell]
                    mine = np.flatnonzero(asks & (home == cell))
                    near = np.flatnonzero(far[:, cell] <= radius + bound)
                    part = _spread(ids[mine] + 1, many)
                    yield _dealt(some, np.repeat(mine, shares), dim, cell, np.repeat(part, shares), np.tile(np.arange(shares), len(mine)), 0)
                    yield _dealt(some, np.repeat(near, many), dim, cell, np.tile(np.arange(many), len(near)), np.repeat(share[near], many), 1)

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asked, best = None, [], None
        for batch in batches:
            heads = np.stack([batch.column(c).to_numpy() for c in ("dim", "cell", "part", "share", "kind")], axis=1)
            cuts = np.concatenate(([0], np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1, [len(heads)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if tuple(heads[a, :4]) != key:
                    yield from _answers(best)
                    key, asked, best = tuple(heads[a, :4]), [], None
                some = batch.slice(a, b - a)
                ids, ints = some.column("id").to_numpy(), _ints(matrix(some.column("vec")))
                if heads[a, 4] == 0:
                    asked.append((ids, ints))
                    continue
                if best is None and asked:
                    best = _Best(np.concatenate([i for i, _ in asked]), np.concatenate([r for _, r in asked]), k)
                if best is not None:
                    best.see(ids, ints)
        yield from _answers(best)

    found = (
        rows.mapInArrow(deal, "id bigint, vec array<double>, dim int, cell int, part int, share int, kind int")
        .repartition("dim", "cell", "part", "share")
        .sortWithinPartitions("dim", "cell", "part", "share", "kind")
        .mapInArrow(solve, "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _flat(ints: np.ndarray) -> np.ndarray:
    return np.concatenate((ints, np.zeros((len(ints), 1))), axis=1)


def _spread(ids: np.ndarray, many: int) -> np.ndarray:
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(many)).astype(np.int32)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.diff(batch.column("vec").offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        yield dim, batch.take(pa.array(np.flatnonzero(sizes == dim)))


def _dealt(some: pa.RecordBatch, at: np.ndarray, dim: int, cell: int, part: np.ndarray, share: np.ndarray, kind: int) -> pa.RecordBatch:
    taken = some.select(["id", "vec"]).take(pa.array(at))
    n = len(at)
    const = lambda v: pa.array(np.full(n, v, np.int32))
    return pa.RecordBatch.from_arrays(
        [*taken.columns, const(dim), const(cell), pa.array(part.astype(np.int32)), pa.array(share.astype(np.int32)), const(kind)],
        ["id", "vec", "dim", "cell", "part", "share", "kind"],
    )


def _answers(best: _Best | None) -> Iterator[pa.RecordBatch]:
    if best is not None and len(best.q):
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.ids[best.q]), pa.array(best.x), pa.array([int(s) for s in best.score], pa.int64())],
            ["query_id", "vec_id", "score"],
        )


def _longest(rows: DataFrame) -> float:
    """Length of the longest vector of the data, rounded up."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [np.sqrt((_ints(matrix(s.column("vec"))) ** 2).sum(axis=1)).max() for _, s in _by_length(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(tops, pa.float64())], ["top"])

    return float(rows.select("vec").mapInArrow(run, "top double").agg(F.max("top")).first()[0] or 0.0) * (1 + 1e-12)


def _reach(rows: DataFrame, centres: dict[int, np.ndarray], longest: float, k: int) -> dict[tuple[int, int], tuple[float, float, int]]:
    """For every cell that has queries: their radius, a bound for the k-th distance, their number.

    From summaries only: each task gives, per pivot, the farthest query of its cell and the k + 1
    smallest distances of data rows to the pivot (one may be the query itself). A query of the cell
    is at most its radius from the pivot, so k rows lie within radius + (k + 1)-th smallest.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, float, int]] = []
            for dim, some in _by_length(batch):
                if dim not in centres:
                    continue
                ints = _ints(matrix(some.column("vec")))
                asks = some.column("asks").to_numpy(zero_copy_only=False).astype(bool)
                to_pivots = distances(_flat(ints), centres[dim])
                home = np.argmin(to_pivots, axis=1)
                far = np.sort(distances(_lifted(ints, longest), centres[dim]), axis=0)[: k + 1]
                for cell in range(len(centres[dim])):
                    mine = to_pivots[asks & (home == cell), cell]
                    if len(mine):
                        out.append((dim, cell, 0, float(mine.max()), len(mine)))
                    out += [(dim, cell, 1, float(d), 1) for d in far[:, cell]]
            columns = list(zip(*out)) if out else [[], [], [], [], []]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["dim", "cell", "kind", "value", "n"]
            )

    seen = rows.select("vec", "asks").mapInArrow(run, "dim int, cell int, kind int, value double, n bigint")
    radii = seen.where("kind = 0").groupBy("dim", "cell").agg(F.max("value").alias("radius"), F.sum("n").alias("n"))
    nth = Window.partitionBy("dim", "cell").orderBy("value")
    bounds = (
        seen.where("kind = 1")
        .withColumn("nth", F.row_number().over(nth))
        .where(F.col("nth") <= k + 1)
        .groupBy("dim", "cell")
        .agg(F.max("value").alias("kth"), F.count(F.lit(1)).alias("have"))
    )
    slack = 1e-9
    return {
        (r["dim"], r["cell"]): (
            r["radius"] * (1 + slack) + slack,
            ((r["radius"] + r["kth"]) * (1 + slack) + longest * 1e-6 + slack) if r["have"] > k else float("inf"),
            r["n"],
        )
        for r in radii.join(bounds, ["dim", "cell"]).collect()  # at most MAX_CELLS rows a length
    }
