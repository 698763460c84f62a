"""The whole way from season files to scores on generated files, against figures worked out by plain Python."""

import csv
import math
import random

import pytest
from pyspark.sql import functions as F

from seasonline.layouts import ACTUAL, LAYOUTS, POSITIONS, PROJECTED
from seasonline.operators.robust import iqr_fence
from seasonline.plans.training import full_season_errors, matched_lines, train_and_score, training_frame
from seasonline.session import staged
from seasonline.sources.lines import read_master, read_scoring_season, read_seasons, union_lines

YEARS = range(2010, 2015)
COMING = 2015


def season(draw, position, year):
    """Forecast and outcome rows of one season as dictionaries; some players are on one side only."""
    forecast, outcome = [], []
    for i in range(60):
        name = f"P. {position} N{i}" + (" Jr." if i % 9 == 0 else "")
        skill = 20 + 4 * i + draw.gauss(0, 5)
        stats = {f: round(max(0.0, skill * draw.uniform(0.2, 1.0)), 1) for f in LAYOUTS[position, PROJECTED].fields}
        shared = {"Name": name, "Team": "SD", "Yr": float(year)}
        # Forecasts are far too high, so that a fitted model has something to find.
        forecast.append({**stats, **shared, "Bye": "-" if i % 7 == 0 else 5.0, "FPts": round(1.6 * skill + 30, 1)})
        games = draw.choice([16, 16, 15, 14, 13, 12, 5])
        points = round(skill * games / 16 + draw.gauss(0, 6), 1)
        spelled = name.replace("Jr.", "Jr") if i % 2 else name
        outcome.append({**{f: 1.0 for f in LAYOUTS[position, ACTUAL].fields}, **shared, "Name": spelled, "GP": float(games), "FPts": points})
    return [r for i, r in enumerate(forecast) if i % 13] + [forecast[3]], [r for i, r in enumerate(outcome) if i % 11]


@pytest.fixture(scope="module")
def generated(tmp_path_factory):
    root, draw, tables = tmp_path_factory.mktemp("files"), random.Random(11), {}

    def write(path, rows, fields):
        path.parent.mkdir(parents=True, exist_ok=True)
        with path.open("w", newline="") as out:
            csv.writer(out).writerows([r[f] for f in fields] for r in rows)

    for position in POSITIONS:
        sides = {k: [] for k in (PROJECTED, ACTUAL)}
        for year in [*YEARS, COMING]:
            for kind, rows in zip((PROJECTED, ACTUAL), season(draw, position, year), strict=True):
                layout = LAYOUTS[position, kind]
                # The first season's files lack the season, as older ones do.
                fields = [f for f in layout.fields if f != "Yr" or year != YEARS[0]]
                if year in YEARS:
                    write(root / f"Data/{year}/{position}/{position}_{kind}_{year}.csv", rows, fields)
                    sides[kind] += rows
                elif kind == PROJECTED:
                    write(root / f"Total_Data/Test_Data/{year}/{position}_projected.csv", rows, layout.fields)
                tables[position, kind, year] = rows
        for kind, rows in sides.items():
            write(root / f"Total_Data/{YEARS[0]}-{YEARS[-1]}/{position}_{kind}.csv", rows, LAYOUTS[position, kind].fields)
    return str(root), tables


def midpoint(values, q):
    h = (len(values) - 1) * q
    return (values[math.floor(h)] + values[math.ceil(h)]) / 2


def expected(tables, position, loose=False):
    plain = (lambda n: n.replace(".", "").strip()) if loose else (lambda n: n)
    joined = [
        (f["FPts"], o["GP"], o["FPts"])
        for year in YEARS
        for f in tables[position, PROJECTED, year]
        for o in tables[position, ACTUAL, year]
        if plain(f["Name"]) == plain(o["Name"])
    ]
    errors = sorted(abs(16.0 / games * points - forecast) for forecast, games, points in joined if games > 13)
    q25, q75 = midpoint(errors, 0.25), midpoint(errors, 0.75)
    fence = 1.5 * (q75 - q25)
    return len(joined), len(errors), q25, q75, fence, sum(e <= fence for e in errors)


@pytest.mark.parametrize("source", ["seasons", "master"])
def test_figures(spark, generated, source):
    root, tables = generated
    if source == "seasons":
        lines = staged(read_seasons(spark, root, YEARS[0], YEARS[-1]))
    else:
        frames = [read_master(spark, root, YEARS[0], YEARS[-1], layout) for layout in LAYOUTS.values()]
        lines = staged(union_lines(frames))
    assert lines.where("NOT width_ok").count() == 0
    assert lines.count() == sum(len(r) for (_, _, y), r in tables.items() if y in YEARS)
    for position in POSITIONS:
        matched = matched_lines(lines, position)
        errors = staged(full_season_errors(matched))
        fence = iqr_fence(errors, "abs_error").first()
        got = (matched.count(), errors.count(), fence["q25"], fence["q75"], fence["fence"], training_frame(lines, position).count())
        assert got == pytest.approx(expected(tables, position))
        loose = expected(tables, position, loose=True)[0]
        assert matched_lines(lines, position, loose_names=True).count() == loose > got[0]


def test_model_beats_a_poor_forecast(spark, generated):
    root, tables = generated
    scores = train_and_score(read_seasons(spark, root, YEARS[0], YEARS[-1]), read_scoring_season(spark, root, COMING), runs=2, fence="tukey")
    best = scores.groupBy("pos", "Player").agg(F.avg("My Computed Score").alias("model"), F.first("Projection").alias("forecast"))
    got = {(r["pos"], r["Player"]): (r["model"], r["forecast"]) for r in best.collect()}
    for position in POSITIONS:
        full = {o["Name"]: 16 / o["GP"] * o["FPts"] for o in tables[position, ACTUAL, COMING] if o["GP"] > 13}
        pairs = [(got[position, n], points) for n, points in full.items() if (position, n) in got]
        model, forecast = (math.sqrt(sum((p[i] - a) ** 2 for p, a in pairs) / len(pairs)) for i in (0, 1))
        assert len(pairs) > 15 and model < forecast
