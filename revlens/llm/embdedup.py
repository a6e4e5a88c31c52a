"""Embedding near-dedup: an exact metric range join over vectors."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import staged
from revlens.llm.components import connected_components
from revlens.llm.simhash import Forest
from revlens.llm.vectors import distances, matrix, pivots, usable

#: Vectors a cell should hold, and those that visit it in one task.
CELL_ROWS = 1 << 14
VISIT_ROWS = 1 << 17
MAX_CELLS = 4096
#: Rows compared at once.
TILE = 1024


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square leaves the range of doubles."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _spread(ids: np.ndarray, many: int) -> np.ndarray:
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(many)).astype(np.int64)


class _Cell:
    """One part of a cell: its own vectors, the links among them and with visitors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, weights: np.ndarray, threshold: float):
        self.ids, self.rows, self.weights, self.threshold = ids, rows, weights, threshold
        self.links = np.zeros(len(ids), np.int64)
        self.forest = Forest(len(ids))

    def among(self) -> None:
        for a in range(0, len(self.ids), TILE):
            for b in range(a, len(self.ids), TILE):
                hit = self.rows[a : a + TILE] @ self.rows[b : b + TILE].T >= self.threshold
                if a == b:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                self.links[a : a + TILE] += hit @ self.weights[b : b + TILE]
                if a != b:
                    self.links[b : b + TILE] += hit.T @ self.weights[a : a + TILE]
                i, j = np.nonzero(hit)
                self.forest.unite(i + a, j + b)

    def visit(self, ids: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Link visitors; of those with links: their position, links, and one of their neighbours."""
        links = np.zeros(len(ids), np.int64)
        neighbour = np.full(len(ids), -1)
        for v in range(0, len(ids), TILE):
            for a in range(0, len(self.ids), TILE):
                hit = rows[v : v + TILE] @ self.rows[a : a + TILE].T >= self.threshold
                if not hit.any():
                    continue
                links[v : v + TILE] += hit @ self.weights[a : a + TILE]
                self.links[a : a + TILE] += hit.T @ weights[v : v + TILE]
                i, j = np.nonzero(hit)
                seen = neighbour[v + i]
                neighbour[v + i[seen < 0]] = a + j[seen < 0]
                self.forest.unite(neighbour[v + i], a + j)
        some = np.flatnonzero(neighbour >= 0)
        return some, links[some], self.ids[neighbour[some]]


def _out(ids: np.ndarray, links: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(others)], ["rep", "links", "other"])


def _range_join(classes: DataFrame, cosine: float) -> DataFrame:
    """``rep``, ``links``, ``other`` for classes (``id`` long, ``vec``, ``n`` equal vectors).

    ``links`` adds up, over all rows of a rep, to the number of vectors of other classes linked with
    it; rep and ``other`` are linked, and these links span the components. Every class has a home
    cell, that of its nearest pivot, and visits the cells in which a vector within the radius could
    live. Of two cells one is visited by the other, in a circle, so each pair meets once and cells
    are visited alike.
    """
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * cosine)) + 1e-7
    total = classes.count()
    cells = int(min(MAX_CELLS, max(4, -(-total // CELL_ROWS))))
    centres = {dim: _units(p) for dim, p in pivots(classes, cells).items()}
    apart = {dim: np.maximum(distances(c, c), 1e-12) for dim, c in centres.items()}
    summary = _summary(classes, centres)
    parts = {key: max(1, -(-n // CELL_ROWS)) for key, (_, _, n) in summary.items()}
    shares = max(1, -(-total // VISIT_ROWS))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vec").offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                some = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                ids = some.column("id").to_numpy()
                to = distances(_units(matrix(some.column("vec"))), centres[dim])
                k = to.shape[1]
                home = np.argmin(to, axis=1)
                near = to[np.arange(len(to)), home]
                own_parts = np.array([parts.get((dim, c), 1) for c in range(k)])
                part, share = _spread(ids + 1, 1 << 30) % own_parts[home], _spread(ids, shares)
                at, cell, sub, turn, kind = [], [], [], [], []

                def send(rows: np.ndarray, c: np.ndarray, p: np.ndarray, s: np.ndarray, what: int) -> None:
                    at.append(rows), cell.append(c), sub.append(p), turn.append(s), kind.append(np.full(len(rows), what))

                every = np.arange(len(ids))
                send(np.repeat(every, shares), np.repeat(home, shares), np.repeat(part, shares), np.tile(np.arange(shares), len(ids)), 0)
                for c in range(k):
                    if (dim, c) not in summary:
                        continue
                    inner, outer, _ = summary[dim, c]
                    ahead = (home - c) % k
                    hosts = (2 * ahead < k) | ((2 * ahead == k) & (c < home))
                    # triangle inequality with the cell's nearest and farthest member, and the
                    # distance to the plane between both pivots, which a neighbour lies across
                    plane = (to[:, c] ** 2 - near**2) / (2 * apart[dim][home, c])
                    could = (to[:, c] <= outer + radius) & (to[:, c] >= inner - radius) & (plane <= radius)
                    rows = np.flatnonzero(could & hosts & (home != c))
                    many = own_parts[c]
                    send(np.repeat(rows, many), np.full(len(rows) * many, c), np.tile(np.arange(many), len(rows)), np.repeat(share[rows], many), 1)
                    inside = np.flatnonzero((home == c) & (part > 0))  # earlier parts of the own cell
                    times = part[inside]
                    rows = np.repeat(inside, times)
                    before = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
                    send(rows, np.full(len(rows), c), before, share[rows], 1)
                taken = some.take(pa.array(np.concatenate(at)))
                columns = [np.full(len(taken), dim), *map(np.concatenate, (cell, sub, turn, kind))]
                yield pa.RecordBatch.from_arrays(
                    [taken.column("id"), taken.column("vec"), taken.column("n"), *(pa.array(x.astype(np.int32)) for x in columns)],
                    ["id", "vec", "n", "dim", "cell", "part", "share", "kind"],
                )

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        own: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cell: _Cell | None = None

        def opened() -> _Cell:
            made = _Cell(*(np.concatenate(x) for x in zip(*own)), cosine)
            if key[3] == 0:  # the cell's own links count once, not once a share
                made.among()
            return made

        def closed() -> Iterator[pa.RecordBatch]:
            if not own:
                return
            done = cell if cell is not None else opened()
            roots = done.forest.roots()
            some = np.flatnonzero((done.links > 0) | (roots != np.arange(len(roots))))
            if len(some):
                yield _out(done.ids[some], done.links[some], done.ids[roots[some]])

        for batch in batches:
            heads = np.stack([batch.column(c).to_numpy() for c in ("dim", "cell", "part", "share", "kind")], axis=1)
            cuts = np.concatenate(([0], np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1, [len(heads)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if tuple(heads[a, :4].tolist()) != key:
                    yield from closed()
                    key, own, cell = tuple(heads[a, :4].tolist()), [], None
                some = batch.slice(a, b - a)
                rows = (some.column("id").to_numpy(), _units(matrix(some.column("vec"))), some.column("n").to_numpy())
                if heads[a, 4] == 0:
                    own.append(rows)
                elif own:
                    cell = cell or opened()
                    at, links, other = cell.visit(*rows)
                    if len(at):
                        yield _out(rows[0][at], links, other)
        yield from closed()

    return (
        classes.mapInArrow(deal, "id bigint, vec array<double>, n bigint, dim int, cell int, part int, share int, kind int")
        .repartition("dim", "cell", "part", "share")
        .sortWithinPartitions("dim", "cell", "part", "share", "kind")
        .mapInArrow(solve, "rep bigint, links bigint, other bigint")
    )


def _summary(classes: DataFrame, centres: dict[int, np.ndarray]) -> dict[tuple[int, int], tuple[float, float, int]]:
    """Nearest and farthest member and size of every cell; at most ``MAX_CELLS`` rows a length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vec").offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                some = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                to = distances(_units(matrix(some.column("vec"))), centres[dim])
                home, near = np.argmin(to, axis=1), to.min(axis=1)
                found = np.unique(home)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found), dim, np.int32)),
                        pa.array(found.astype(np.int32)),
                        pa.array([near[home == c].min() for c in found], pa.float64()),
                        pa.array([near[home == c].max() for c in found], pa.float64()),
                        pa.array([int((home == c).sum()) for c in found], pa.int64()),
                    ],
                    ["dim", "cell", "inner", "outer", "n"],
                )

    rows = (
        classes.select("vec")
        .mapInArrow(run, "dim int, cell int, inner double, outer double, n bigint")
        .groupBy("dim", "cell")
        .agg(F.min("inner").alias("inner"), F.max("outer").alias("outer"), F.sum("n").alias("n"))
    )
    return {(r["dim"], r["cell"]): (r["inner"], r["outer"], r["n"]) for r in rows.collect()}


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row.

    Rows link whose vectors have a cosine of at least ``cosine`` (in doubles, over vectors of one
    length). ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    reachable over links, itself included, ``kept`` marks the row of that id. Vectors that are NULL,
    zero, or hold NULL or non-finite components link with nothing. Rows with a NULL id take no part:
    no links, a NULL component, not kept. Repeated rows are linked rows like any other. No rows, no
    rows. Only the two named columns are read.

    Equal vectors are one class with a count, so copies meet no one else twice. Classes are cut into
    cells by pivots; the triangle inequality says which cells a vector must visit; cells join
    independently, and big ones in parts. See ``_range_join``.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec")
    )
    rows = staged(
        rows.select(
            "vec_id",
            F.when(
                F.col("vec_id").isNotNull() & usable(F.col("vec")) & F.exists("vec", lambda x: x != 0), F.col("vec")
            ).alias("vec"),
        ),
        "vectors",
    )
    classes = staged(
        rows.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")),
        "vector-classes",
    )
    joined = staged(_range_join(classes, cosine), "vector-links")
    counts = joined.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(joined.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    classes = staged(
        classes.join(counts, F.col("id") == F.col("rep"), "left")
        .join(components, F.col("id") == F.col("node"), "left")
        .select(
            "vec",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "vector-components",
    )
    linked = rows.where("vec is not null").join(classes, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
