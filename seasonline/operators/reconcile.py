"""Join forecasts to outcomes and put outcomes on a full-season footing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonline.functions.numbers import ratio

FULL_SEASON = 16
MIN_EXPOSURE = 13


def plain_name(name: Column) -> Column:
    """A name without full stops and surrounding spaces, so ``Jr.`` and ``Jr`` meet."""
    return F.trim(F.regexp_replace(name, r"\.", ""))


def forecast_with_outcome(
    forecast: DataFrame,
    outcome: DataFrame,
    keys: Sequence[str],
    *,
    stats: Sequence[str],
    identifiers: Sequence[str] = (),
    exposure: str = "GP",
    target: str,
    target_name: str,
    loose_name: str | None = None,
) -> DataFrame:
    """Inner join on ``keys``: identifiers, exposure, forecast stats, then the outcome's target.

    Duplicate keys pair with each other, as an inner join does. Only the exposure and the
    target are taken from the outcome. ``loose_name`` names a key compared by
    :func:`plain_name`; the forecast's spelling is kept.
    """
    keys = list(keys)
    right = outcome.select(*keys, F.col(f"`{exposure}`").alias("_exposure"), F.col(f"`{target}`").alias("_target"))
    left = forecast.select(*dict.fromkeys([*identifiers, *keys, *stats]))
    if loose_name is not None:
        left = left.withColumn("_loose", plain_name(F.col(f"`{loose_name}`")))
        right = right.withColumn("_loose", plain_name(F.col(f"`{loose_name}`"))).drop(loose_name)
        keys = ["_loose", *[k for k in keys if k != loose_name]]
    joined = left.join(right, keys, "inner")
    shown = dict.fromkeys([*identifiers, *([loose_name] if loose_name else []), *[k for k in keys if k != "_loose"]])
    return joined.select(
        *[F.col(f"`{c}`") for c in shown],
        F.col("_exposure").alias(exposure),
        *[F.col(f"`{c}`") for c in stats if c not in shown],
        F.col("_target").alias(target_name),
    )


def enough_exposure(df: DataFrame, exposure: str = "GP", *, more_than: float = MIN_EXPOSURE) -> DataFrame:
    """Rows with strictly more than ``more_than`` games."""
    return df.where(F.col(f"`{exposure}`") > more_than)


def rescaled(target: Column, exposure: Column, full_season: Column | float = FULL_SEASON) -> Column:
    """The target carried forward to a full season; NULL where there was no exposure.

    ``full_season`` may be a column where the season's length changes over the years.
    """
    season = full_season if isinstance(full_season, Column) else F.lit(full_season)
    return ratio(season.cast("double"), exposure) * target


def absolute_error(actual: Column, forecast: Column) -> Column:
    return F.abs(actual - forecast)


def with_full_exposure(df: DataFrame, exposure: str = "GP", *, full_season: int = FULL_SEASON) -> DataFrame:
    """The scoring frame: every row is taken to play the full season."""
    return df.withColumn(exposure, F.lit(full_season))


def in_seasons(df: DataFrame, season: str, first: int, last: int) -> DataFrame:
    """Rows from ``first`` to ``last``, both included."""
    return df.where(F.col(f"`{season}`").between(first, last))


def duplicate_keys(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Keys held by more than one row, with their number ``n_rows``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
