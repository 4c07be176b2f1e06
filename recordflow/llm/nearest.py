"""Nearest neighbours by cosine: stable projections in k-d trees, searched until a chi-square test says stop.

Vectors of length one are projected on M normal directions.  The projected square
distance of two vectors over their true one follows the chi-square distribution
with M degrees.  A query meets its projected neighbours by increasing
distance and verifies each; it stops when the next one lies so far that a
vector closer than the k-th found would, with probability CONFIDENCE, have come
before it: ``chi2(M).cdf(next / kth) >= CONFIDENCE``.

Over the cluster this takes two rounds.  The projections of all vectors are cut
into cells by the upper levels of a k-d tree (cuts from a bounded sample; all
vectors are indexed).  First each query searches its own cell, which bounds its
k-th distance; by the stopping test that gives a radius, and the query goes to
every other cell whose box it meets.  A cell holds its vectors in a k-d tree of its
own and lets queries stream by.  Cells are about ROOT square roots of the table long
(never under CELL), so that cells and the queries sent to them grow evenly;
a cell that equal vectors make larger is dealt into several by the id, and a
query visits all of them.

Scores are cosines of the original vectors in double precision, summed in one fixed
order, so equal vectors tie exactly; ties go to the smaller id.

Edge cases: vectors that are null, empty or zero, or hold a null or a number that
isn't finite, take no part, nor do rows without an id; vectors are compared with
those of as many components; repeated rows (equal ids) are candidates of
others once each, never of their own id; a query asked twice is
answered once; fewer candidates than asked for are all returned; columns other
than ``vec_id`` and ``embedding`` are not read; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.llm.base import output, pick, saved

M, CONFIDENCE, SEED = 8, 0.98, 13
CELL, ROOT, LEAF = 2048, 16, 64
#: Sampled vectors for each upper cell, and upper cells at most.
PER_CELL, MOST_CELLS = 24, 4096
#: Scores this close are decided by the fixed order of summation.
CLOSE = 1e-9


def chi_square_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees: a finite sum of Poisson terms."""
    half = x / 2
    return 1.0 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(degrees // 2))


def stopping_ratio(degrees: int = M, confidence: float = CONFIDENCE) -> float:
    """The least ratio of projected to true square distance at which the test holds."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if chi_square_cdf(middle, degrees) >= confidence else (middle, high)
    return high


def directions(size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, M))


def vectors_of(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array of doubles): the rows that take part."""
    rows = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))


# ------------------------------------------------------------------ k-d trees
@dataclass
class Tree:
    """Leaves of a k-d tree in order: their boxes, and the points of each."""

    low: np.ndarray
    high: np.ndarray
    members: list[np.ndarray]


def grow(points: np.ndarray, most: int) -> Tree:
    """Halve the widest side at its median until at most ``most`` points, or equal ones, are left."""
    low, high, members = [], [], []
    full = np.full(points.shape[1], np.inf)
    todo = [(np.arange(len(points)), -full, full)]
    while todo:
        own, below, above = todo.pop()
        if len(own) > most:
            inside = points[own]
            place = int(np.ptp(inside, axis=0).argmax())
            column = inside[:, place]
            cut = np.partition(column, len(own) // 2)[len(own) // 2]
            left = column < cut
            if not left.any():
                left = column <= cut
            if not left.all():
                middle = column[~left].min()
                right_low, left_high = below.copy(), above.copy()
                right_low[place] = left_high[place] = middle
                todo += [(own[~left], right_low, above), (own[left], below, left_high)]
                continue
        low.append(below)
        high.append(above)
        members.append(own)
    return Tree(np.array(low), np.array(high), members)


def box_distances(tree: Tree, at: np.ndarray) -> np.ndarray:
    """Square distances (points by leaves) from points to the boxes of the leaves."""
    gap = np.maximum(np.maximum(tree.low - at[:, None, :], at[:, None, :] - tree.high), 0.0)
    return np.einsum("qlm,qlm->ql", gap, gap)


def homes(tree: Tree, at: np.ndarray) -> np.ndarray:
    """The leaf whose box holds each point: low <= point < high in every place."""
    out = np.zeros(len(at), np.int64)
    for start in range(0, len(at), 512):
        part = at[start : start + 512, None, :]
        out[start : start + 512] = ((part >= tree.low) & (part < tree.high)).all(axis=2).argmax(axis=1)
    return out


# ------------------------------------------------------------------ cells
def exact_scores(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines of original vectors; each row's sum runs in the same order wherever it stands."""
    dots = (others * query).sum(axis=1)
    return dots / (np.sqrt((others * others).sum(axis=1)) * np.sqrt((query * query).sum()))


class Cell:
    """The vectors of a cell, their projections in a k-d tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.units = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        self.points = self.units @ directions(vectors.shape[1])
        self.tree = grow(self.points, LEAF)
        order = np.concatenate(self.tree.members)
        # leaves lie one behind the other, so that a leaf is a slice
        self.ids, self.vectors, self.units, self.points = (a[order] for a in (ids, vectors, self.units, self.points))
        self.stops = np.cumsum([len(m) for m in self.tree.members])

    def search(self, own: int, query: np.ndarray, k: int, bound: float, ratio: float) -> list[tuple[float, int]]:
        """The (score, id) pairs that the test leaves, at most ``k``; ``bound`` is a square distance known for the k-th."""
        unit = query / np.sqrt((query * query).sum())
        at = unit @ directions(len(query))
        far = box_distances(self.tree, at[None])[0]
        order = np.argsort(far, kind="stable")
        best: list[tuple[float, int]] = []
        kth, begin, width = bound, 0, 1
        while begin < len(order) and far[order[begin]] <= kth * ratio:
            leaves = order[begin : begin + width]
            leaves = leaves[far[leaves] <= kth * ratio]
            rows = np.concatenate([np.arange(self.stops[i] - len(self.tree.members[i]), self.stops[i]) for i in leaves])
            apart = self.points[rows] - at
            rows = rows[(np.einsum("ij,ij->i", apart, apart) <= kth * ratio) & (self.ids[rows] != own)]
            near = self.units[rows] @ unit
            least = 1.0 - kth / 2
            if len(best) == k:
                least = max(least, best[-1][0])
            keep = near >= least - CLOSE
            rows, near = rows[keep], near[keep]
            if len(rows) > k:
                rows = rows[near >= np.partition(near, len(near) - k)[len(near) - k] - CLOSE]
            if len(rows):
                scores = exact_scores(query, self.vectors[rows])
                best = sorted([*best, *zip(scores.tolist(), self.ids[rows].tolist())], key=lambda r: (-r[0], r[1]))[:k]
                if len(best) == k:
                    kth = min(kth, max(0.0, 2.0 - 2.0 * best[-1][0]) + CLOSE)
            begin += width
            width *= 2
        return best


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
SENT = "dim int, cell long, asks boolean, vec_id long, bound double, embedding array<double>"


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _search_cells(k: int, ratio: float) -> Callable:
    """Rows come sorted by (dim, cell, asks): first the vectors of a cell, then the queries that visit it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts, cell = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            where = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dim", "cell", "asks")], 1)
            edges = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
                dim, name, asks = where[start].tolist()
                if (dim, name) != key:
                    key, ids, parts, cell = (dim, name), [], [], None
                own = batch.slice(start, stop - start)
                vec_ids, rows = own.column("vec_id").to_numpy(), matrix(own.column("embedding"), dim)
                if not asks:
                    ids.append(vec_ids)
                    parts.append(rows)
                    continue
                if not parts:
                    continue
                if cell is None:
                    cell = Cell(np.concatenate(ids), np.concatenate(parts))
                found = [
                    (i, v, s) for i, q, b in zip(vec_ids.tolist(), rows, own.column("bound").to_pylist())
                    for s, v in cell.search(i, q, k, b, ratio)
                ]
                if found:
                    yield output(dict(zip(FOUND.names, zip(*found))), FOUND)

    return run


def _visit(rows: DataFrame, k: int, ratio: float) -> DataFrame:
    dealt = rows.repartition("dim", "cell").sortWithinPartitions("dim", "cell", "asks")
    return dealt.mapInArrow(_search_cells(k, ratio), "query_id long, vec_id long, score double")


@dataclass
class Upper:
    """The upper levels over the vectors of one size: boxes of the cells, and into how many each is dealt."""

    tree: Tree
    deals: np.ndarray

    def names(self) -> np.ndarray:
        """The first name of each cell; those of its deals follow."""
        return np.concatenate([[0], np.cumsum(self.deals)])


def _upper(rows: DataFrame) -> dict[int, Upper]:
    """Cells for each size of vectors, from a sample of bounded expected size."""
    sizes = {r["dim"]: r["count"] for r in rows.groupBy(F.size("embedding").alias("dim")).count().collect()}
    cells = {d: min(MOST_CELLS, -(-n // max(CELL, int(ROOT * math.sqrt(n))))) for d, n in sizes.items()}
    out = {}
    for dim, n in sizes.items():
        if cells[dim] == 1:
            continue
        share = min(1.0, PER_CELL * cells[dim] / n)
        drawn = rows.filter(F.size("embedding") == dim).sample(share, SEED).select("embedding").collect()
        some = np.array([r.embedding for r in drawn], float).reshape(-1, dim)
        if len(some):
            units = some / np.sqrt((some * some).sum(axis=1))[:, None]
            tree = grow(units @ directions(dim), PER_CELL)
            deals = [max(1, round(len(m) / (2 * PER_CELL))) for m in tree.members]
            out[dim] = Upper(tree, np.array(deals))
    return out


PLACED = pa.schema([
    ("dim", pa.int32()), ("cell", pa.int64()), ("asks", pa.bool_()), ("vec_id", pa.int64()), ("bound", pa.float64()),
    ("embedding", pa.list_(pa.float64())),
])


def _placed(rows: DataFrame, upper: dict[int, Upper], asks: bool, others: bool = False, ratio: float = 0.0) -> DataFrame:
    """Rows under the names of cells: vectors in their own; queries in their own, or with ``others`` in all others in reach."""
    shared = rows.sparkSession.sparkContext.broadcast(upper)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, ids = batch.column("embedding"), batch.column("vec_id").to_numpy()
            dims = column.value_lengths().to_numpy()
            bounds = batch.column("bound").to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                if dim not in shared.value:
                    row, cell = (rows[:0], rows[:0]) if others else (rows, np.zeros(len(rows), np.int64))
                else:
                    own = shared.value[dim]
                    names = own.names()
                    vectors = matrix(column.take(pa.array(rows)), dim)
                    at = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None] @ directions(dim)
                    home = homes(own.tree, at)
                    if not asks:
                        row, cell = rows, names[home] + ids[rows] % own.deals[home]
                    else:
                        if others:
                            near = box_distances(own.tree, at) <= (bounds[rows] * ratio)[:, None]
                            near[np.arange(len(rows)), home] = False
                        else:
                            near = home[:, None] == np.arange(len(own.deals))
                        r, c = np.nonzero(near)
                        n = own.deals[c]
                        row = np.repeat(rows[r], n)
                        cell = np.repeat(names[c], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                for start in range(0, len(row), 4096):
                    part = row[start : start + 4096]
                    at = pa.array(part)
                    yield output({
                        "dim": np.full(len(part), dim, np.int32), "cell": cell[start : start + 4096], "asks": np.full(len(part), asks),
                        "vec_id": ids[part], "bound": bounds[part], "embedding": column.take(at).cast(PLACED.field("embedding").type),
                    }, PLACED)

    return rows.select("vec_id", "embedding", "bound").mapInArrow(run, SENT)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best neighbours of each query, ranked."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``is_query`` (over vec_id) its ``k`` nearest other rows."""
    ratio = stopping_ratio()
    rows = saved(vectors_of(vectors).withColumn("bound", F.lit(4.0 + CLOSE)))
    upper = _upper(rows)
    points = saved(_placed(rows, upper, asks=False))
    queries = rows.filter(is_query).dropDuplicates(["vec_id"])
    first = saved(_visit(points.union(_placed(queries, upper, asks=True)), k, ratio))
    # the k-th of the own cell bounds the k-th of all; with fewer found, everything is within reach
    bounds = _best(first, k).filter(F.col("rank") == k).select("query_id", (2 - 2 * F.col("score") + CLOSE).alias("kth"))
    asking = queries.join(bounds, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "embedding", F.greatest(F.lit(0.0), F.coalesce("kth", "bound")).alias("bound")
    )
    second = _visit(points.union(_placed(asking, upper, asks=True, others=True, ratio=ratio)), k, ratio)
    return _best(first.union(second), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
