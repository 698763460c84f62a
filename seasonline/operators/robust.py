"""Exact midpoint quantiles and outlier fences, per group or over the whole frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonline.functions.attach import attach
from seasonline.functions.numbers import present
from seasonline.session import staged

FENCE_FACTOR = 1.5
_SKETCHES_PER_GROUP = 16
_CUTS = 64


def quantile_name(q: float) -> str:
    """Column name of quantile ``q``: 0.25 -> ``q25``, 0.025 -> ``q2_5``."""
    return "q" + f"{q * 100:g}".replace(".", "_")


def midpoint_quantiles(
    df: DataFrame,
    value: str,
    qs: Sequence[float] = (0.25, 0.75),
    by: Sequence[str] = (),
    *,
    accuracy: int = 1000,
    slices: int = 1024,
    slice_rows: int = 1_000_000,
) -> DataFrame:
    """Exact quantiles with midpoint interpolation: one row per group with ``n`` and ``q..``.

    The quantile is the mean of the sorted elements at ``floor(h)`` and ``ceil(h)`` with
    ``h = (n - 1) * q``. No group is sorted as a whole:

    1. a mergeable sketch per group gives approximate pivots just below and above each ``q``;
    2. the pivots and equal-width slices between them number the value range; counting rows
       per slice combines before the shuffle and says which slices hold the wanted ranks; while one
       of these holds over ``slice_rows`` rows of different values, the rows of these slices are cut again at
       pivots of a fresh sketch of the slice, however close their values are;
    3. only rows of those slices, combined to (value, count), are put in order.

    Pivots and slices are small tables, staged between the passes over ``df``; stage ``df``
    itself where it is expensive to compute. Every rank comes from exact counts, so a poor sketch costs time but never precision.
    """
    by = list(by)
    rows = df.where(present(F.col(value))).select(*by, F.col(value).cast("double").alias("_v"))
    pivots = _pivots(rows, qs, by, accuracy)
    sliced = attach(rows, pivots, by).select(*by, "_v", _slice_number(2 * len(qs) + 2, slices).alias("_slice"))

    # Slices are at most `slices` times the number of pivots per group, so this window is bounded.
    in_group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    counts = sliced.groupBy(*by, "_slice").agg(F.count("*").alias("_in_slice"))
    counts = counts.withColumn(
        "_upto", F.sum("_in_slice").over(in_group.orderBy("_slice"))
    ).withColumn("n", F.sum("_in_slice").over(in_group))
    before = F.col("_upto") - F.col("_in_slice")
    hits = staged(_hit(counts.select(*by, "_slice", "n", "_in_slice", before.alias("_before"), _wanted_ranks(qs).alias("_wanted"))), "slices")
    # A slice of one value needs no order. All others shrink by about the number of pivots each time.
    largest = hits.agg(F.max("_in_slice")).first()[0] or 0
    while largest > slice_rows:
        sliced, hits, before = *_sliced_again(sliced, hits, by, accuracy), largest
        largest = hits.where("NOT _single").agg(F.max("_in_slice")).first()[0] or 0
        if largest >= before:
            break

    ordered = (
        sliced.join(hits.select(*by, "_slice"), [*by, "_slice"], "left_semi")
        .groupBy(*by, "_slice", "_v")
        .agg(F.count("*").alias("_copies"))
        .join(hits.select(*by, "_slice", "n", "_before", "_wanted"), [*by, "_slice"])
    )
    in_slice = Window.partitionBy(*by, "_slice").orderBy("_v")
    ordered = ordered.withColumn("_end", F.col("_before") + F.sum("_copies").over(in_slice))
    start, end = F.col("_end") - F.col("_copies"), F.col("_end")
    found = ordered.select(
        *by,
        "n",
        "_v",
        F.explode(F.filter("_wanted", lambda w: (w["rank"] >= start) & (w["rank"] < end))).alias("_w"),
    )
    # Two ranks per quantile, equal where h is whole: their mean is the midpoint.
    midpoints = [
        F.avg(F.when(F.col("_w")["q"] == i, F.col("_v"))).alias(quantile_name(q)) for i, q in enumerate(qs)
    ]
    return found.groupBy(*by).agg(F.first("n").alias("n"), *midpoints)


def _hit(counts: DataFrame) -> DataFrame:
    """Slices that hold wanted ranks, with these ranks."""
    before, upto = F.col("_before"), F.col("_before") + F.col("_in_slice")
    hit = F.filter("_wanted", lambda w: (w["rank"] >= before) & (w["rank"] < upto))
    return counts.withColumn("_wanted", hit).where(F.size("_wanted") > 0)


def _sliced_again(sliced: DataFrame, hits: DataFrame, by: list[str], accuracy: int) -> tuple[DataFrame, DataFrame]:
    """The rows of the hit slices, each slice cut at values of a sketch of its own, and which of the cuts are hit.

    A cut is what lies between two neighbouring pivots, or one pivot's value alone, so that a value met very often is
    a cut of its own.
    """
    keys = [*by, "_slice"]
    inside = staged(sliced.join(hits.select(*keys), keys, "left_semi"), "inside")
    probes = [(i + 0.5) / _CUTS for i in range(_CUTS)]
    sketch = (
        inside.withColumn("_part", F.spark_partition_id() % _SKETCHES_PER_GROUP)
        .groupBy(*keys, "_part")
        .agg(F.percentile_approx("_v", probes, max(accuracy, 10 * _CUTS)).alias("_q"))
        .groupBy(*keys)
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("_q")))).alias("_all"))
    )
    # Of all sketches' answers every so many-th, so that there are about as many as one sketch gives.
    pivots = staged(sketch.select(*keys, F.expr(f"filter(_all, (x, i) -> i % cast(ceil(size(_all) / {_CUTS}) as int) = 0)").alias("_p")), "pivots")
    met = inside.join(pivots, keys)
    below = sum((F.when(F.get("_p", F.lit(i)) < F.col("_v"), 2).otherwise(0) for i in range(_CUTS)), F.lit(0))
    equal = sum((F.when(F.get("_p", F.lit(i)) == F.col("_v"), 1).otherwise(0) for i in range(_CUTS)), F.lit(0))
    finer = met.select(*by, "_v", F.col("_slice").alias("_outer"), (below + equal).cast("long").alias("_inner"))
    counts = finer.groupBy(*by, "_outer", "_inner").agg(F.count("*").alias("_in_slice"), (F.min("_v") == F.max("_v")).alias("_single"))
    whole = hits.select(*by, F.col("_slice").alias("_outer"), "n", F.col("_before").alias("_start"), "_wanted")
    # At most twice as many rows as pivots for each hit slice.
    earlier = Window.partitionBy(*by, "_outer").orderBy("_inner").rowsBetween(Window.unboundedPreceding, -1)
    counted = counts.withColumn("_before", F.coalesce(F.sum("_in_slice").over(earlier), F.lit(0)))
    counted = counted.join(whole, [*by, "_outer"]).withColumn("_before", F.col("_before") + F.col("_start"))
    hit = _hit(counted.select(*by, "_outer", "_inner", "n", "_in_slice", "_single", "_before", "_wanted"))
    # No more hit cuts in a group than wanted ranks; they get numbers of their own, and only their rows go on.
    in_group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    hit = staged(hit.withColumn("_slice", F.row_number().over(in_group.orderBy("_outer", "_inner")).cast("long")), "slices")
    rows = finer.join(hit.select(*by, "_outer", "_inner", "_slice"), [*by, "_outer", "_inner"]).select(*by, "_v", "_slice")
    return rows, hit.drop("_outer", "_inner")


def _pivots(rows: DataFrame, qs: Sequence[float], by: list[str], accuracy: int) -> DataFrame:
    """Per group the extremes and, for each ``q``, a value likely below and one likely above.

    The sketches of a group are merged in several places, by the number of the input
    partition; the lowest and highest of their answers are taken.
    """
    margin = 2.0 / accuracy
    around = [p for q in qs for p in ((max(q - margin, 0.0), F.min), (min(q + margin, 1.0), F.max))]
    probes = [(0.0, F.min), *around, (1.0, F.max)]
    sketches = (
        rows.withColumn("_part", F.spark_partition_id() % _SKETCHES_PER_GROUP)
        .groupBy(*by, "_part")
        .agg(F.percentile_approx("_v", [p for p, _ in probes], accuracy).alias("_q"))
    )
    answers = F.array_sort(F.array(*[pick(F.col("_q")[i]) for i, (_, pick) in enumerate(probes)]))
    pivots = sketches.groupBy(*by).agg(answers.alias("_sorted"))
    return pivots.select(*by, *[F.col("_sorted")[i].alias(f"_p{i}") for i in range(len(probes))])


def _slice_number(n_pivots: int, slices: int) -> Column:
    """A number that never decreases with ``_v``: between two pivots, ``slices`` equal widths."""
    v = F.col("_v")
    number = F.lit(0).cast("long")
    for i in range(n_pivots - 1):
        low, high = F.col(f"_p{i}"), F.col(f"_p{i + 1}")
        width = high - low
        inner = F.when(
            (width > 0) & (width < float("inf")),
            F.least(F.floor((v - low) / width * slices), F.lit(slices - 1)),
        ).otherwise(F.lit(0))
        number = F.when(v > low, F.lit(i * slices + 1) + inner).otherwise(number)
    last = n_pivots - 1
    return F.when(v > F.col(f"_p{last}"), F.lit(last * slices + 1)).otherwise(number)


def _wanted_ranks(qs: Sequence[float]) -> Column:
    """Zero-based (quantile index, rank) pairs on both sides of each quantile position."""
    pairs = []
    for i, q in enumerate(qs):
        h = (F.col("n") - 1) * F.lit(float(q))
        for side in (F.floor(h), F.ceil(h)):
            pairs.append(F.struct(F.lit(i).alias("q"), side.alias("rank")))
    return F.array(*pairs)


def iqr_fence(
    df: DataFrame, error: str, by: Sequence[str] = (), *, factor: float = FENCE_FACTOR, kind: str = "width", **sketch
) -> DataFrame:
    """Quartiles of ``error`` per group, with ``iqr`` and the upper limit ``fence``.

    ``kind="width"`` sets the limit to ``factor * iqr``; ``kind="tukey"`` to ``q75 + factor * iqr``.
    """
    if kind not in ("width", "tukey"):
        raise ValueError(f"unknown fence kind: {kind!r}")
    quartiles = midpoint_quantiles(df, error, (0.25, 0.75), by, **sketch)
    quartiles = quartiles.withColumn("iqr", F.col("q75") - F.col("q25"))
    width = F.col("iqr") * factor
    return quartiles.withColumn("fence", width if kind == "width" else F.col("q75") + width)


def std_fence(df: DataFrame, error: str, by: Sequence[str] = (), *, factor: float = 2.0) -> DataFrame:
    """Per group the limit ``factor`` population standard deviations of ``error``."""
    return df.groupBy(*by).agg((F.stddev_pop(error) * factor).alias("fence"))


def keep_within(df: DataFrame, error: str, fences: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``error`` is at or below the fence of their group."""
    limits = fences.select(*by, F.col("fence").alias("_fence"))
    return attach(df, limits, by).where(F.col(error) <= F.col("_fence")).drop("_fence")
