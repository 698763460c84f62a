"""Results on the published season files, whose folder STATLINE_FILES names."""

import os

import pytest
from pyspark.sql import functions as F

from seasonline.layouts import ACTUAL, LAYOUTS, PROJECTED
from seasonline.operators.profile import error_report
from seasonline.operators.regression import RUNS
from seasonline.operators.robust import iqr_fence
from seasonline.operators.scaling import zscore
from seasonline.plans.training import full_season_errors, matched_lines, train_and_score, training_frame
from seasonline.session import staged
from seasonline.sources.lines import read_master, read_scoring_season, read_seasons, union_lines

ROOT = os.environ.get("STATLINE_FILES")
pytestmark = pytest.mark.skipif(not ROOT, reason="STATLINE_FILES is not set")

# Position: forecasts, outcomes, joined, enough games, quartiles, fence, kept, joined by loose names.
SEASONS_2010_2018 = {
    "QB": (573, 662, 534, 201, 15.1429, 54.0000, 58.2857, 157, 534),
    "RB": (932, 1350, 879, 395, 17.9038, 66.1233, 72.3293, 311, 879),
    "WR": (1248, 1350, 1070, 632, 14.8500, 57.5933, 64.1150, 496, 1083),
    "TE": (620, 1022, 600, 273, 12.1000, 44.5000, 48.6000, 216, 600),
}
MASTERS = {
    ("TE", 2015, 2018): (297, 468, 286, 96, 14.8533, 45.4476, 45.8914, 72),
    ("TE", 2015, 2019): (374, 468, 286, 96, 14.8533, 45.4476, 45.8914, 72),
    ("QB", 2015, 2018): (65, 75, 62, 21, 28.2000, 90.3000, 93.1500, 16),
    ("QB", 2015, 2019): (314, 292, 235, 92, 15.7214, 57.2467, 62.2879, 73),
}


@pytest.fixture(scope="module")
def history(spark):
    return staged(read_seasons(spark, ROOT, 2010, 2018))


def figures(lines, position):
    here = lines.where(f"pos = '{position}'")
    matched = matched_lines(lines, position)
    errors = staged(full_season_errors(matched))
    fence = iqr_fence(errors, "abs_error").first()
    return (
        here.where(f"kind = '{PROJECTED}'").count(),
        here.where(f"kind = '{ACTUAL}'").count(),
        matched.count(),
        errors.count(),
        *(round(fence[c], 4) for c in ("q25", "q75", "fence")),
        training_frame(lines, position).count(),
    )


@pytest.mark.parametrize("position", SEASONS_2010_2018)
def test_seasons(history, position):
    *wanted, loose = SEASONS_2010_2018[position]
    assert figures(history, position) == tuple(wanted)
    assert matched_lines(history, position, loose_names=True).count() == loose


@pytest.mark.parametrize("position, first, last", MASTERS)
def test_masters(spark, position, first, last):
    kinds = [read_master(spark, ROOT, first, last, LAYOUTS[position, kind]) for kind in (PROJECTED, ACTUAL)]
    assert figures(staged(union_lines(kinds)), position) == MASTERS[position, first, last]


def test_drifted_files_conform(history):
    assert history.where("not width_ok or Yr IS NULL OR FPts IS NULL").count() == 0
    assert history.where(f"kind = '{PROJECTED}' AND Bye IS NULL").count() == 10


def test_season_scores(spark):
    lines = read_scoring_season(spark, ROOT, 2019)
    best = zscore(lines.where("pos = 'TE'"), ["FPts"], ["Yr"]).orderBy("FPts", ascending=False).first()
    assert best["FPts"] == pytest.approx(3.181459103100992, abs=1e-14)


def test_model_beats_the_published_forecast(spark):
    history, coming = read_seasons(spark, ROOT, 2010, 2017), read_scoring_season(spark, ROOT, 2018)
    scores = train_and_score(history, coming)
    outcome = read_seasons(spark, ROOT, 2018, 2018, kinds=[ACTUAL]).where("GP > 13")
    outcome = outcome.select("pos", F.col("Name").alias("Player"), (F.lit(16) / F.col("GP") * F.col("FPts")).alias("points"))
    names = {"model": "My Computed Score", "forecast": "Projection"}
    report = error_report(scores.join(outcome, ["pos", "Player"]), "points", names, ["pos"])
    for r in report.collect():
        assert r["n"] % RUNS == 0 and r["model_rmse"] < r["forecast_rmse"], r


def test_all_positions_are_scored(spark, history):
    scores = train_and_score(history, read_scoring_season(spark, ROOT, 2019), runs=2)
    counts = {(r["pos"], r["run"]): r["count"] for r in scores.groupBy("pos", "run").count().collect()}
    assert set(counts) == {(p, run) for p in SEASONS_2010_2018 for run in range(2)}
    assert all(counts[p, 0] == counts[p, 1] > 50 for p in SEASONS_2010_2018)
    assert scores.where("`My Computed Score` IS NULL OR isnan(`My Computed Score`)").count() == 0
