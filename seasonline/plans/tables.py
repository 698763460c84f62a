"""Stat lines made from order data: a part is a player, its brand a position, a year a season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonline.operators.reconcile import absolute_error, enough_exposure, forecast_with_outcome, rescaled

FULL_YEAR = 12
MIN_MONTHS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shipped(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Line items shipped in a range of years, which is given to the scan as dates."""
    items = table(spark, sf_dir, "lineitem")
    kind = items.schema["l_shipdate"].dataType
    if first is not None:
        items = items.where(F.col("l_shipdate") >= F.lit(f"{first}-01-01").cast(kind))
    if last is not None:
        items = items.where(F.col("l_shipdate") < F.lit(f"{last + 1}-01-01").cast(kind))
    return items.select(
        F.col("l_partkey").alias("name"),
        F.year("l_shipdate").alias("yr"),
        F.month("l_shipdate").alias("month"),
        "l_quantity",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )


def _months() -> Column:
    """Distinct months as a bit each: combines before the shuffle, unlike a distinct count."""
    return F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("month"))))


def _with_part(sums: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rows are summed per part and season first: the join sees each hot part a few times only.
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("name"), F.col("p_brand").alias("pos"), "p_retailprice"
    )
    return sums.join(parts, "name").withColumn("proj", F.col("qty") * F.col("p_retailprice")).drop("p_retailprice")


def stat_lines(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``name, pos, yr, gp, qty, lines, proj, act``: one row per part and year, of the given years."""
    sums = _shipped(spark, sf_dir, first, last).groupBy("name", "yr").agg(
        _months().alias("gp"),
        F.sum("l_quantity").alias("qty"),
        F.count("*").alias("lines"),
        F.sum("revenue").alias("act"),
    )
    return _with_part(sums, spark, sf_dir).select("name", "pos", "yr", "gp", "qty", "lines", "proj", "act")


def forecast_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast side: ``name, pos, yr, qty, lines, proj`` at list price."""
    sums = _shipped(spark, sf_dir).groupBy("name", "yr").agg(
        F.sum("l_quantity").alias("qty"), F.count("*").alias("lines")
    )
    return _with_part(sums, spark, sf_dir).select("name", "pos", "yr", "qty", "lines", "proj")


def outcome_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome side: ``name, yr, gp, act`` as sold."""
    return _shipped(spark, sf_dir).groupBy("name", "yr").agg(_months().alias("gp"), F.sum("revenue").alias("act"))


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts joined to outcomes on name and season; list prices come in last, by name."""
    sold = _shipped(spark, sf_dir).groupBy("name", "yr").agg(F.sum("l_quantity").alias("qty"), F.count("*").alias("lines"))
    joined = forecast_with_outcome(
        sold,
        outcome_lines(spark, sf_dir),
        ["name", "yr"],
        exposure="gp",
        stats=["qty", "lines"],
        target="act",
        target_name="act",
    )
    return _with_part(joined, spark, sf_dir).select("name", "pos", "yr", "gp", "qty", "lines", "proj", "act")


def uneven_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Forecasts and outcomes that do not quite fit: each side lacks some names, and holds others twice."""
    forecast, outcome = forecast_lines(spark, sf_dir), outcome_lines(spark, sf_dir)

    def uneven(lines: DataFrame, lacks: int, doubles: int) -> DataFrame:
        copies = F.when(F.col("name") % doubles == 0, 2).otherwise(1)
        return lines.where(F.col("name") % lacks != 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))

    return uneven(forecast, 11, 7), uneven(outcome, 13, 5)


def with_errors(lines: DataFrame) -> DataFrame:
    """Lines with enough months, ``a`` carried to a full year, and the error ``e``."""
    kept = enough_exposure(lines, "gp", more_than=MIN_MONTHS)
    kept = kept.withColumn("a", rescaled(F.col("act"), F.col("gp"), FULL_YEAR))
    return kept.withColumn("e", absolute_error(F.col("a"), F.col("proj")))


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`with_errors` of the lines that need no join between the two sides."""
    return with_errors(stat_lines(spark, sf_dir))
