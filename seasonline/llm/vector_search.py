"""Nearest neighbours by collision counting over single projections.

Rows are dealt into blocks, and a block's rows into bands of like norm. A band projects its vectors onto random lines and
sorts their places on each line; a row keeps in one byte a line how far up in that order it stands. A query opens a window
around its own projection on every line at once; where too few vectors lie in enough of the windows, all windows widen
by the same factor (virtual rehashing), until the wanted share of the band has reached the collision threshold. The
vectors that reach it, and no others, are compared exactly.

For the inner product, a band's vectors are scaled by its largest norm and given one more coordinate that
makes them unit vectors: then the nearest in the plane's sense have the largest product. In a band that coordinate is
small, as norms differ little. Bands come by falling norm; what is left is passed over once no vector of such a norm
could be among the query's best. Norms are kept as logarithms, so that no finite vector is too large or too small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonline.session import staged


@dataclass(frozen=True)
class SearchPlan:
    """How a search is done.

    Lines for each dimension; collisions wanted as a share of the lines; growth of the windows; share of a band to verify, and
    how many times ``k`` rows at least; factor between the norms of a band; rows of a block, and places on lines that it may
    hold (more dimensions, fewer rows).

    The more dimensions, the less the distances of even vectors differ, and the more lines it takes to tell them apart. The
    number of rows plays no part: a table of any size is searched in the same way.
    """

    lines_per_dimension: float = 3.75
    collisions: float = 0.75
    growth: float = 1.03
    verify: float = 0.145
    least_verified: int = 8
    norm_band: float = 1.25
    block_rows: int = 8192
    block_places: int = 4_000_000
    seed: int = 7

    def lines(self, dimensions: int, rows: int | None = None) -> int:
        """The same for any number of ``rows``."""
        return max(96, round(self.lines_per_dimension * dimensions))

    def passing(self, dimensions: int, rows: int | None = None) -> float:
        """The share of a band that passes the lines and is verified, the same for any number of ``rows``."""
        return self.verify

    def rows(self, lines: int) -> int:
        return max(256, min(self.block_rows, self.block_places // lines))


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and the logarithms of the lengths, for any finite vectors but zero."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    shrunk = vectors / most
    norms = np.linalg.norm(shrunk, axis=1, keepdims=True)
    return shrunk / norms, (np.log(most) + np.log(norms)).ravel()


# A line's sorted places are told apart by so many steps of like many rows, which fit a byte.
_STEPS = 256
# Lines counted at once: few enough for a byte.
_COUNTED = 120
# Width of the narrowest windows.
_NARROWEST = 1e-6


class Band:
    """Vectors of like norm with their steps on every line."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, units: np.ndarray, logs: np.ndarray, plan: SearchPlan, lines: int, passing: float, k: int):
        self.ids, self.vectors, self.plan, self.top = ids, vectors, plan, float(logs.max())
        n = len(ids)
        self.most = float(np.abs(vectors).max())
        self.wanted = min(n, max(plan.least_verified * k + 1, int(passing * n)))
        if self.wanted == n:
            return
        scaled = units * np.exp(logs - self.top)[:, None]
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        self.lines = np.random.default_rng(plan.seed).standard_normal((vectors.shape[1] + 1, lines))
        places = scaled @ self.lines[:-1] + rest[:, None] * self.lines[-1]
        self.threshold = int(np.ceil(plan.collisions * lines))
        self.at = 0
        places = np.ascontiguousarray(places.T)
        bounds = np.sort(places, axis=1)[:, np.arange(1, _STEPS) * n // _STEPS]
        self.steps = np.stack([np.searchsorted(b, p, "right") for b, p in zip(bounds, places, strict=True)]).astype(np.uint8)
        # The bounds of all lines as one sorted array: each line has a stretch of its own.
        self.far = float(np.abs(places).max()) + 1.0
        self.offsets = np.arange(lines) * (2 * self.far + 1)
        self.bounds = (bounds + self.offsets[:, None]).ravel()
        self.before = np.arange(lines) * (_STEPS - 1)

    def candidates(self, units: np.ndarray) -> Iterator[np.ndarray]:
        """For each query, given as a unit vector, the rows that collide with it on enough lines."""
        if self.wanted == len(self.ids):
            yield from (np.arange(len(self.ids)) for _ in units)
            return
        for centre in units @ self.lines[:-1]:
            yield np.flatnonzero(self._colliding(centre))

    def _within(self, centre: np.ndarray, at: int) -> tuple[np.ndarray, bool]:
        """Which rows collide on enough lines after so many widenings, and whether they are as many as wanted."""
        width = _NARROWEST * self.plan.growth**at
        ends = np.clip(np.stack([centre - width, centre + width]), -self.far, self.far) + self.offsets
        low = np.searchsorted(self.bounds, ends[0], "left") - self.before
        high = np.searchsorted(self.bounds, ends[1], "right") - self.before
        low, span = low.astype(np.uint8)[:, None], (high - low).astype(np.uint8)[:, None]
        counts = np.zeros(len(self.ids), dtype=np.uint16)
        for a in range(0, len(low), _COUNTED):
            # Steps below the window wrap round to above it.
            inside = self.steps[a : a + _COUNTED] - low[a : a + _COUNTED] <= span[a : a + _COUNTED]
            counts += np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)
        found = counts >= self.threshold
        return found, np.count_nonzero(found) >= self.wanted

    def _colliding(self, centre: np.ndarray) -> np.ndarray:
        """Which rows collide on enough lines, at the first width that gives enough of them.

        The wider, the more: so the width is looked for from where the last query found its own, up or down, by longer and
        longer steps and then between the last two.
        """
        low, high, step = -1, None, 1
        at = self.at
        while high is None or high - low > 1:
            found, enough = self._within(centre, at)
            if enough:
                high, rows = at, found
            else:
                low = at
            if high is None:
                at, step = at + step, 2 * step
            elif low < 0 < high:
                at, step = max(0, high - step), 2 * step
            else:
                at = (low + high) // 2
        self.at = high
        return rows


def _largest(vectors: np.ndarray, most: float, query: np.ndarray, k: int) -> np.ndarray:
    """Which of the vectors, with no component beyond ``most``, can be among the ``k`` of largest product, however the products
    are rounded."""
    if len(vectors) <= k:
        return np.arange(len(vectors))
    with np.errstate(over="ignore", invalid="ignore"):
        products = np.einsum("ij,j->i", vectors, query)
        # Twice what two ways of summing can differ by.
        slack = 4 * len(query) * (np.finfo(float).eps * most * np.abs(query).sum() + np.finfo(float).smallest_subnormal)
        if not np.isfinite(products).all() or not np.isfinite(slack):
            return np.arange(len(vectors))
        return np.flatnonzero(products >= np.partition(products, -k)[-k] - slack)


class Block:
    """A bounded number of vectors of a table, in bands by falling norm; the table's number of ``rows`` plays no part. ``verified`` counts the products
    worked out."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, plan: SearchPlan, rows: int, k: int):
        lines, passing = plan.lines(vectors.shape[1]), plan.passing(vectors.shape[1])
        by_id = np.argsort(ids, kind="stable")
        ids, vectors = ids[by_id], vectors[by_id]
        units, logs = _units(vectors)
        number = np.minimum(40, np.floor((logs.max() - logs) / np.log(plan.norm_band))).astype(np.int64)
        self.bands = [Band(ids[i], vectors[i], units[i], logs[i], plan, lines, passing, k) for i in (np.flatnonzero(number == b) for b in np.unique(number))]
        self.k, self.verified = k, 0

    def nearest(self, names: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each query the ids and products of the ``k`` best verified rows, the best first, ties to the smaller id."""
        units, logs = _units(queries)
        best = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in names]
        for band in self.bands:
            # No vector of this band or a later one is better than what its norm allows.
            open_rows = [
                i
                for i, (found, products) in enumerate(best)
                if len(found) < self.k or not products[-1] > 0 or np.log(products[-1]) < logs[i] + band.top + 1e-9
            ]
            if not open_rows:
                break
            for i, rows in zip(open_rows, band.candidates(units[open_rows]), strict=True):
                rows = rows[band.ids[rows] != names[i]]
                self.verified += len(rows)
                vectors = band.vectors[rows]
                large = _largest(vectors, band.most, queries[i], self.k)
                with np.errstate(over="ignore", invalid="ignore"):
                    products = (vectors[large] * queries[i]).sum(axis=1)
                ids, products = np.concatenate([best[i][0], band.ids[rows[large]]]), np.concatenate([best[i][1], products])
                order = np.lexsort((ids, -products))[: self.k]
                best[i] = ids[order], products[order]
        for name, (ids, products) in zip(names.tolist(), best, strict=True):
            yield name, ids, products


def _search(plan: SearchPlan, rows: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block, the block's vectors before its queries."""
        at, block = None, None
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, kinds, names = (batch.column(i).to_numpy() for i in range(3))
            flat = batch.column(3).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, -1)
            edges = np.flatnonzero(np.r_[True, (np.diff(numbers) != 0) | (np.diff(kinds) != 0), True])
            out: list[tuple] = []
            for a, z in zip(edges, edges[1:], strict=False):
                if numbers[a] != at:
                    at, block, ids, vectors = numbers[a], None, [], []
                if kinds[a] == 0:
                    ids.append(names[a:z])
                    vectors.append(flat[a:z])
                    continue
                if block is None and ids:
                    block = Block(np.concatenate(ids), np.concatenate(vectors), plan, rows, k)
                    ids, vectors = [], []
                if block is not None:
                    for name, found, products in block.nearest(names[a:z], flat[a:z]):
                        out.append((np.full(len(found), name), found, products))
            if out:
                columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return run


def nearest_vectors(
    rows: DataFrame,
    queries: Column,
    *,
    k: int = 20,
    plan: SearchPlan = SearchPlan(),
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score (inner product in double precision) of each query's ``k`` nearest.

    ``queries`` says which rows are queries; every row but the query's own is a candidate. Vectors that
    are null, zero, or hold null or non-finite components take no part, nor do rows without id, nor
    vectors that are not of the commonest length (ties: the longest). Of rows that share an id, the
    smallest vector counts. Ties in score go to the smaller id. Other columns are not read; an empty table
    gives no rows.

    Every row is indexed; memory of a task is bounded by ``plan.rows``. The queries are sent to each
    block, so what is moved is the number of queries times that of blocks. A product beyond the largest double is infinite,
    one of infinite parts of both signs counts as the least.
    """
    good = rows.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
    )
    good = staged(good.groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked")), "vectors")
    sizes = good.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    size = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return rows.sparkSession.createDataFrame([], empty)
    good = good.where(F.size("vector") == size["n"])
    lines = plan.lines(size["n"], size["rows"])
    blocks = -(-size["rows"] // plan.rows(lines))
    data = good.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "vector")
    asked = good.where("asked").select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "vector"
    )
    dealt = data.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind")
    found = dealt.mapInArrow(_search(plan, size["rows"], k), "query_id long, vec_id long, score double")
    # At most k rows a block and query meet here.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
