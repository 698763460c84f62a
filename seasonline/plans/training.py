"""Train on past seasons, score the coming one, for every position and run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonline.layouts import ACTUAL, IDENTIFIERS, LAYOUTS, POSITIONS, PROJECTED, stat_list
from seasonline.operators.conform import position_frame
from seasonline.operators.reconcile import (
    FULL_SEASON,
    MIN_EXPOSURE,
    absolute_error,
    enough_exposure,
    forecast_with_outcome,
    rescaled,
)
from seasonline.operators.regression import (
    HIDDEN_UNITS,
    PENALTY,
    RUNS,
    Layer,
    fit_relu_runs,
    full_results,
    hidden_layer,
    score_relu_runs,
)
from seasonline.operators.robust import iqr_fence, keep_within
from seasonline.operators.scaling import apply_scaler, fit_scaler
from seasonline.session import staged

FORECAST_POINTS = "Proj FPts"
OUTCOME_POINTS = "Act FPts"
RESULT_NAMES = {
    "Yr": "Yr",
    "pos": "pos",
    "run": "run",
    "Name": "Player",
    FORECAST_POINTS: "Projection",
    "prediction": "My Computed Score",
}


def matched_lines(lines: DataFrame, position: str, *, loose_names: bool = False) -> DataFrame:
    """Forecasts of one position with games and points of the outcome: identifiers, GP, stats."""
    forecast = position_frame(lines, LAYOUTS[position, PROJECTED]).withColumnRenamed("FPts", FORECAST_POINTS)
    outcome = position_frame(lines, LAYOUTS[position, ACTUAL])
    return forecast_with_outcome(
        forecast,
        outcome,
        ["Name", "Yr"],
        identifiers=IDENTIFIERS,
        stats=[*stat_list(position, with_points=False), FORECAST_POINTS],
        target="FPts",
        target_name=OUTCOME_POINTS,
        loose_name="Name" if loose_names else None,
    )


def full_season_errors(
    matched: DataFrame, *, more_than: float = MIN_EXPOSURE, full_season: float = FULL_SEASON
) -> DataFrame:
    """Players with enough games, their points carried to a full season, and ``abs_error``."""
    kept = enough_exposure(matched, more_than=more_than)
    kept = kept.withColumn(OUTCOME_POINTS, rescaled(F.col(f"`{OUTCOME_POINTS}`"), F.col("GP"), full_season))
    return kept.withColumn(
        "abs_error", absolute_error(F.col(f"`{OUTCOME_POINTS}`"), F.col(f"`{FORECAST_POINTS}`"))
    )


def training_frame(
    lines: DataFrame, position: str, *, loose_names: bool = False, fence: str = "width", **season
) -> DataFrame:
    """The rows a position's model is fitted on: matched, rescaled, without outliers."""
    errors = staged(full_season_errors(matched_lines(lines, position, loose_names=loose_names), **season), "errors")
    return keep_within(errors, "abs_error", iqr_fence(errors, "abs_error", kind=fence)).drop("abs_error")


def score_position(
    lines: DataFrame,
    scoring: DataFrame,
    position: str,
    *,
    runs: int = RUNS,
    units: int = HIDDEN_UNITS,
    penalty: float = PENALTY,
    layer: Callable[[int, int, int], Layer] = hidden_layer,
    **cleaning,
) -> DataFrame:
    """Scores of one position for every run. Forecast points are a feature, outcomes never."""
    features = ["GP", *stat_list(position, with_points=False), FORECAST_POINTS]
    train = staged(training_frame(lines, position, **cleaning), "train")
    layout = LAYOUTS[position, PROJECTED]
    coming = scoring.where((F.col("pos") == position) & (F.col("kind") == PROJECTED))
    coming = coming.select("GP", *[F.col(f"`{f}`") for f in layout.kept]).withColumnRenamed("FPts", FORECAST_POINTS)
    coming = coming.withColumn("pos", F.lit(position)).withColumn("_projection", F.col(f"`{FORECAST_POINTS}`"))
    scaler = fit_scaler(train, features)
    models = fit_relu_runs(
        apply_scaler(train, scaler, features), features, OUTCOME_POINTS, runs=runs, units=units, penalty=penalty, layer=layer
    )
    scores = score_relu_runs(
        apply_scaler(coming, scaler, features),
        models,
        features,
        keep=["Yr", "pos", "Name", "_projection"],
        units=units,
        layer=layer,
    )
    return full_results(scores.withColumnRenamed("_projection", FORECAST_POINTS), RESULT_NAMES)


def train_and_score(
    lines: DataFrame, scoring: DataFrame, positions: Sequence[str] = POSITIONS, **options
) -> DataFrame:
    """Scores of all positions and runs. ``scoring`` comes with GP set to a full season.

    The typed history is staged once. Positions differ in their features, so each has its own
    fit; all runs of a position share one.
    """
    lines, scoring = staged(lines, "lines"), staged(scoring, "scoring")
    return reduce(DataFrame.unionByName, [score_position(lines, scoring, p, **options) for p in positions])
