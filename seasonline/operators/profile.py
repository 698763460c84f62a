"""Error, shape and distribution reports."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.functions.attach import attach
from seasonline.functions.numbers import positive_log, present


# The function below travels with the tasks; workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def error_report(df: DataFrame, actual: str, predictions: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation and root mean square of ``actual - prediction``.

    ``predictions`` maps a short label to a column; the outputs are ``<label>_mean_error``,
    ``<label>_std_error`` and ``<label>_rmse``.
    """
    measures: list[Column] = [F.count("*").alias("n")]
    for label, column in predictions.items():
        error = F.col(f"`{actual}`") - F.col(f"`{column}`")
        measures += [
            F.avg(error).alias(f"{label}_mean_error"),
            F.stddev_pop(error).alias(f"{label}_std_error"),
            F.sqrt(F.avg(error * error)).alias(f"{label}_rmse"),
        ]
    return df.groupBy(*by).agg(*measures)


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per (group, stat), from the wide one-row-per-group frame with struct columns."""
    pairs = [F.struct(F.lit(c).alias("stat"), F.col(f"`{c}`").alias("m")) for c in columns]
    return df.select(*by, F.inline(F.array(*pairs))).select(*by, "stat", "m.*")


@F.pandas_udf(T.DoubleType())
def _two_sided_p(z: pd.Series) -> pd.Series:
    return z.map(lambda x: math.erfc(abs(x) / math.sqrt(2.0)) if x == x else math.nan)


def skew_report(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Skewness and D'Agostino's (1970) test of it: ``n, skewness, z, p_value`` per group and stat.

    All stats come from one aggregation. The transform needs at least eight rows; z and p
    are NULL below that, or when a stat does not vary.
    """
    wide = df.groupBy(*by).agg(
        *[
            F.struct(
                F.count(F.col(f"`{c}`")).alias("n"), F.skewness(F.col(f"`{c}`").cast("double")).alias("skewness")
            ).alias(c)
            for c in columns
        ]
    )
    report = _long(wide, columns, by).withColumn(
        "skewness", F.when(present(F.col("skewness")), F.col("skewness"))
    )
    report = report.withColumn("z", F.when(F.col("n") >= 8, _skew_z(F.col("skewness"), F.col("n").cast("double"))))
    return report.withColumn("p_value", _two_sided_p("z"))


def _skew_z(g1: Column, n: Column) -> Column:
    """Approximately standard normal under normality, from the sample skewness and size."""
    scaled = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    kurtosis = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (kurtosis - 1)) - 1
    ratio = scaled / F.sqrt(2 / (w2 - 1))
    return F.asinh(ratio) / F.sqrt(F.log(w2) / 2)


def histogram(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *, bins: int = 30, log: bool = False
) -> DataFrame:
    """Equal-width bins per group and stat: ``stat, bin, low, high, n, density``.

    The last bin includes the maximum; empty bins are left out; a stat without spread falls
    into bin 0. ``log=True`` bins natural logarithms, leaving out values that have none.
    """
    values = [positive_log(F.col(f"`{c}`")) if log else F.col(f"`{c}`").cast("double") for c in columns]
    ready = df.select(*by, *[v.alias(c) for v, c in zip(values, columns)])
    edges = ready.groupBy(*by).agg(
        *[
            F.struct(
                F.min(F.col(f"`{c}`")).alias("lo"), F.max(F.col(f"`{c}`")).alias("hi"), F.count(F.col(f"`{c}`")).alias("total")
            ).alias(f"{c}__edges")
            for c in columns
        ]
    )
    items = [
        F.struct(F.lit(c).alias("stat"), F.col(f"`{c}`").alias("x"), F.col(f"`{c}__edges`").alias("e")) for c in columns
    ]
    cells = attach(ready, edges, by).select(*by, F.inline(F.array(*items))).where(present(F.col("x")))
    lo, hi, total = F.col("e.lo"), F.col("e.hi"), F.col("e.total")
    place = F.when(hi > lo, F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    counted = cells.groupBy(*by, "stat", place.cast("int").alias("bin"), "e").agg(F.count("*").alias("n"))
    width = (hi - lo) / bins
    return counted.select(
        *by,
        "stat",
        "bin",
        (lo + width * F.col("bin")).alias("low"),
        (lo + width * (F.col("bin") + 1)).alias("high"),
        "n",
        F.try_divide(F.col("n"), total * width).alias("density"),
    )
