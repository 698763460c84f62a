"""Standardising stat columns by group, and scalers fitted on one frame and used on another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonline.functions.attach import attach
from seasonline.session import staged


def group_moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *, sample: bool = True) -> DataFrame:
    """Mean and standard deviation of every column, one row per group, in one aggregation.

    ``sample=True`` divides by n - 1, else by n. Columns are named ``<column>__mean`` and
    ``<column>__std``.
    """
    spread = F.stddev_samp if sample else F.stddev_pop
    measures = []
    for c in columns:
        measures += [F.avg(F.col(f"`{c}`")).alias(f"{c}__mean"), spread(F.col(f"`{c}`")).alias(f"{c}__std")]
    return df.groupBy(*by).agg(*measures)


def _standardised(column: str, scale: Column) -> Column:
    return (F.col(f"`{column}`") - F.col(f"`{column}__mean`")) / scale


def zscore(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *, names: Mapping[str, str] | None = None
) -> DataFrame:
    """``df`` with each column standardised within its group by mean and sample deviation.

    Undefined scores (a single row, no spread, a missing value or group) become 0. ``names``
    gives the output names; by default the column is replaced.
    """
    names = names or {}
    held = attach(df, group_moments(df, columns, by), by)
    scores = {}
    for c in columns:
        deviation = F.nullif(F.col(f"`{c}__std`"), F.lit(0.0))
        scores[names.get(c, c)] = F.coalesce(_standardised(c, deviation), F.lit(0.0))
    return held.withColumns(scores).drop(*_moment_columns(columns))


def zscore_features(
    df: DataFrame, columns: Sequence[str], season: str, identifiers: Sequence[str] = ()
) -> DataFrame:
    """Z-scores within each season, without the identifier columns and the season."""
    return zscore(df, columns, [season]).drop(*identifiers, season)


def fit_scaler(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation per group, to be used by :func:`apply_scaler`."""
    return staged(group_moments(df, columns, by, sample=False), "scaler")


def apply_scaler(
    df: DataFrame,
    scaler: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    *,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Centre and scale ``columns`` with a fitted scaler; a column without spread is only centred."""
    names = names or {}
    held = attach(df, scaler, by, settle=False)
    scaled = {}
    for c in columns:
        deviation = F.col(f"`{c}__std`")
        scaled[names.get(c, c)] = _standardised(c, F.when(deviation == 0, F.lit(1.0)).otherwise(deviation))
    return held.withColumns(scaled).drop(*_moment_columns(columns))


def _moment_columns(columns: Sequence[str]) -> list[str]:
    return [f"{c}__{part}" for c in columns for part in ("mean", "std")]
