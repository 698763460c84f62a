"""The operators over the benchmark tables, one query each.

Input of an operator that reads its rows more than once is staged first, so the expensive
aggregation under it runs a single time; so are rendered texts and pages, which stand for stored
files. Measures are rounded for comparison across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonline.functions import html as H
from seasonline.layouts import ACTUAL, PROJECTED, stat_list
from seasonline.operators.conform import conform, position_frame
from seasonline.operators.extract import (
    missing_table,
    numeric_columns,
    page_quality,
    records_from_pages,
    select_table,
    table_grid,
    table_rows,
    wide_table,
)
from seasonline.operators.profile import error_report, histogram, skew_report
from seasonline.operators.reconcile import (
    duplicate_keys,
    enough_exposure,
    forecast_with_outcome,
    in_seasons,
    rescaled,
    with_full_exposure,
)
from seasonline.operators.regression import (
    fit_relu_runs,
    fit_ridge,
    ols_by_group,
    score_relu_runs,
    score_ridge,
    score_summary,
    sine_layer,
)
from seasonline.operators.robust import iqr_fence, keep_within, midpoint_quantiles, std_fence
from seasonline.operators.scaling import apply_scaler, fit_scaler, zscore, zscore_features
from seasonline.plans import tables as t
from seasonline.plans.history import build_history, read_history, read_quarantine
from seasonline.plans.rendering import (
    GRID_COLUMNS,
    PART,
    PART_ID,
    PART_LAYOUTS,
    both_kinds,
    comma_text,
    fetched_pages,
    grid_pages,
    season_text,
    spelled,
    stat_pages,
)
from seasonline.plans.training import FORECAST_POINTS, OUTCOME_POINTS, train_and_score, training_frame
from seasonline.session import scratch_path, staged
from seasonline.sources.lines import (
    SCORING_FILE,
    SEASON_FILE,
    checked_stat_lines,
    from_comma_text,
    read_scoring_season,
    read_seasons,
    union_lines,
)
from seasonline.sources.pages import kind_of, query_value, read_pages
from seasonline.sources.sinks import read_or_empty, write_grid, write_master, write_scores, write_season_text, write_seasons
from seasonline.streaming.pages import LOAD, latest_loads, load_history, load_new_pages, stream_pages

Query = Callable[[SparkSession, str], DataFrame]

SCORE_YEAR = 2001
FEATURES = ("gp", "qty", "lines", "proj")


def _r(name: str, digits: int = 4) -> Column:
    return F.round(name, digits).alias(name)


# --- forecast against outcome --------------------------------------------------------------------


def forecast_actual_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast stats with exposure and outcome, joined on name and season.

    Each side lacks names that the other has, and names that stand twice on both sides pair four times.
    """
    forecast, outcome = t.uneven_sides(spark, sf_dir)
    joined = forecast_with_outcome(
        forecast,
        outcome.withColumn("act", F.col("act") * F.col("copy")),
        ["name", "yr"],
        identifiers=["name", "pos", "yr", "copy"],
        exposure="gp",
        stats=["qty", "lines", "proj"],
        target="act",
        target_name="act",
    )
    return joined.select("name", "pos", "yr", "copy", "gp", "qty", "lines", _r("proj"), _r("act"))


def loose_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join where the two sides write names differently: ``Jr.`` and ``Jr``, with and without stops."""
    forecast, outcome = t.uneven_sides(spark, sf_dir)
    letters, even = spelled(F.col("name")), F.col("name") % 2 == 0
    joined = forecast_with_outcome(
        forecast.withColumn("name", F.concat(letters, F.when(even, " Jr.").otherwise(""))),
        outcome.withColumn("name", F.concat(letters, F.when(even, " Jr").otherwise(". "))),
        ["name", "yr"],
        identifiers=["pos"],
        exposure="gp",
        stats=["proj"],
        target="act",
        target_name="act",
        loose_name="name",
    )
    return joined.select("pos", "name", "yr", "gp", _r("proj"), _r("act"))


def exposure_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a range of seasons carried to a full year, for parts sold in enough months."""
    lines = in_seasons(t.stat_lines(spark, sf_dir, 1996, 1999), "yr", 1996, 1999)
    kept = enough_exposure(lines, "gp", more_than=t.MIN_MONTHS)
    return kept.select(
        "name", "pos", "yr", "gp", _r("act"), F.round(rescaled(F.col("act"), F.col("gp"), t.FULL_YEAR), 6).alias("a")
    )


def trimmed_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts joined to rescaled outcomes, without each position's outliers."""
    errors = staged(t.with_errors(t.matched(spark, sf_dir)), "errors")
    kept = keep_within(errors, "e", iqr_fence(errors, "e", ["pos"]), ["pos"])
    return kept.select("name", "pos", "yr", "gp", _r("proj"), _r("a", 6), _r("e", 6))


def tukey_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept by the fence that starts at the upper quartile."""
    errors = staged(t.errors(spark, sf_dir).select("name", "pos", "yr", "e"), "errors")
    kept = keep_within(errors, "e", iqr_fence(errors, "e", ["pos"], kind="tukey"), ["pos"])
    return kept.select("name", "pos", "yr", _r("e", 6))


def std_fence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept by the older fence of two deviations."""
    errors = staged(t.errors(spark, sf_dir).select("name", "pos", "yr", "e"), "errors")
    kept = keep_within(errors, "e", std_fence(errors, "e", ["pos"]), ["pos"])
    return kept.select("name", "pos", "yr", _r("e", 6))


def midpoint_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles, their distance and the fence of the error, per position."""
    errors = staged(t.errors(spark, sf_dir).select("pos", "e"), "errors")
    return iqr_fence(errors, "e", ["pos"]).select("pos", "n", _r("q25", 7), _r("q75", 7), _r("iqr", 7), _r("fence", 7))


def overall_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the extended price over every line item, without groups."""
    prices = t.table(spark, sf_dir, "lineitem").select("l_extendedprice")
    found = midpoint_quantiles(prices, "l_extendedprice", (0.25, 0.5, 0.75))
    return found.select("n", _r("q25", 7), _r("q50", 7), _r("q75", 7))


def duplicate_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with more than one order in a year."""
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("name"), F.year("o_orderdate").alias("yr"))
    return duplicate_keys(orders, ["name", "yr"])


# --- scaling and reports ---------------------------------------------------------------------------


def season_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stat standardised within its season."""
    lines = staged(t.stat_lines(spark, sf_dir), "lines")
    names = {c: f"z_{c}" for c in ("gp", "qty", "lines", "proj", "act")}
    scored = zscore(lines, list(names), ["yr"], names=names)
    return scored.select("name", "pos", "yr", *[_r(z, 6) for z in names.values()])


def feature_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standardised stats alone, as a model takes them: no identifiers and no season."""
    lines = staged(t.stat_lines(spark, sf_dir), "lines")
    scored = zscore_features(lines, ["gp", "qty", "lines", "proj", "act"], "yr", identifiers=["name", "pos"])
    return scored.select(*[_r(c, 6) for c in scored.columns])


def pop_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scaler fitted on all seasons but the last, applied to every row."""
    lines = staged(t.stat_lines(spark, sf_dir), "lines")
    scaler = fit_scaler(lines.where(F.col("yr") < SCORE_YEAR), ["proj", "act"])
    scaled = apply_scaler(lines, scaler, ["proj", "act"], names={"proj": "s_proj", "act": "s_act"})
    return scaled.select("name", "pos", "yr", _r("s_proj", 6), _r("s_act", 6))


def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed errors per position: of the forecast and of the outcome that was not rescaled."""
    report = error_report(t.errors(spark, sf_dir), "a", {"proj": "proj", "raw": "act"}, ["pos"])
    measures = [f"{label}_{m}" for label in ("proj", "raw") for m in ("mean_error", "std_error", "rmse")]
    return report.select("pos", "n", *[_r(m, 3) for m in measures])


def skew_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skewness of each stat per position, with its test."""
    report = skew_report(t.stat_lines(spark, sf_dir), ["qty", "proj", "act"], ["pos"])
    return report.select("pos", "stat", "n", _r("skewness", 6), _r("z", 6), _r("p_value", 6))


def stat_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty bins of each points column per position."""
    lines = staged(t.stat_lines(spark, sf_dir).select("pos", "proj", "act"), "lines")
    bins = histogram(lines, ["proj", "act"], ["pos"], bins=30)
    return bins.select("pos", "stat", "bin", "n", _r("low", 7), _r("high", 7), _r("density", 9))


def log_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty bins of the logarithm of the outcome, over all positions."""
    lines = staged(t.stat_lines(spark, sf_dir).select("act"), "lines")
    return histogram(lines, ["act"], bins=20, log=True).select("stat", "bin", "n", _r("low", 6), _r("high", 6))


# --- layouts, unions, sinks ------------------------------------------------------------------------


def _line_columns(lines: DataFrame) -> DataFrame:
    return lines.select(
        "kind",
        F.col("Name").alias("name"),
        F.col("Team").alias("team"),
        F.col("Yr").alias("yr"),
        F.col("Bye").alias("bye"),
        F.col("GP").alias("gp"),
        F.col("Qty").alias("qty"),
        F.col("Lines").alias("lines"),
        F.col("FPts").alias("points"),
    )


def conform_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text records of two kinds, with and without a season, as typed columns."""
    text = staged(comma_text(both_kinds(spark, sf_dir)), "text")
    return _line_columns(from_comma_text(text, PART_LAYOUTS).where("width_ok"))


def season_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stat lines written as comma files per season and kind, and read back by their paths.

    Some lines are broken off in the files; they come back with their text.
    """
    sides = both_kinds(spark, sf_dir)
    missing = F.lit(None).cast("int")
    broken = F.when(F.col("name") % 41 == 7, F.concat(spelled(F.col("name")), F.lit(","), F.col("pos")))
    lines = sides.select(
        F.lit(PART).alias("pos"),
        "kind",
        spelled(F.col("name")).alias("Name"),
        F.col("pos").alias("Team"),
        F.col("yr").alias("Yr"),
        F.when(F.col("kind") == PROJECTED, F.col("gp")).otherwise(missing).alias("Bye"),
        F.when(F.col("kind") == ACTUAL, F.col("gp")).otherwise(missing).alias("GP"),
        F.col("qty").alias("Qty"),
        F.col("lines").alias("Lines"),
        F.col("points").alias("FPts"),
        broken.alias("raw"),
    )
    path = scratch_path(spark, "files")
    write_season_text(lines, path, PART_LAYOUTS)
    found = checked_stat_lines(spark, path, PART_LAYOUTS)
    return union_lines([_line_columns(found.lines), found.malformed.select("kind", "reason", "raw")])


def scoring_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast records of the last season, every part taken to sell the whole year."""
    lines = from_comma_text(staged(comma_text(both_kinds(spark, sf_dir)), "text"), PART_LAYOUTS)
    frame = position_frame(in_seasons(lines, "Yr", SCORE_YEAR, SCORE_YEAR), PART_LAYOUTS[PART, PROJECTED])
    return with_full_exposure(frame, full_season=t.FULL_YEAR).select(
        F.col("Name").alias("name"), F.col("GP").alias("gp"), F.col("Qty").alias("qty"), F.col("FPts").alias("points")
    )


def union_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts and outcomes as one table; what a side lacks is NULL."""
    forecast = t.forecast_lines(spark, sf_dir).select(F.lit(PROJECTED).alias("kind"), "name", "pos", "yr", _r("proj"))
    outcome = t.outcome_lines(spark, sf_dir).select(F.lit(ACTUAL).alias("kind"), "name", "yr", "gp", _r("act"))
    return union_lines([forecast, outcome])


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stat lines written per season, as a master and as scored text, and read back."""
    sides = both_kinds(spark, sf_dir).withColumnRenamed("yr", "Yr")
    root = scratch_path(spark, "sinks")
    write_seasons(sides, f"{root}/seasons")
    stored = spark.read.schema(sides.schema).parquet(f"{root}/seasons")
    write_master(stored, f"{root}/masters", 1996, 1998)
    scores = stored.where(F.col("Yr") == SCORE_YEAR).withColumn("run", F.lit(0))
    write_scores(scores, f"{root}/scores", by=("Yr", "kind", "run"))
    columns = ["kind", "name", "pos", "yr", "gp", "qty", "lines", "points"]

    def back(df: DataFrame, sink: str) -> DataFrame:
        return df.withColumnRenamed("Yr", "yr").select(F.lit(sink).alias("sink"), *columns)

    # The partition columns come after the file's own, as the folders give them.
    by = ["Yr", "kind", "run"]
    text = scores.select(*[c for c in scores.columns if c not in by], *by).schema
    return union_lines(
        [
            back(stored, "seasons"),
            back(spark.read.schema(sides.schema).parquet(f"{root}/masters"), "master"),
            back(spark.read.schema(text).csv(f"{root}/scores", header=True), "scores"),
        ]
    )


# --- pages -----------------------------------------------------------------------------------------


def _facets(pages: DataFrame) -> DataFrame:
    url = F.col("url")
    path = F.try_parse_url(url, F.lit("PATH"))
    kinds = {f"/{lang}/": lang for lang in ("en", "fr", "de", "es")}
    return pages.select(
        "page_id",
        F.try_parse_url(url, F.lit("HOST")).alias("host"),
        kind_of(url, kinds).alias("kind"),
        F.nullif(F.regexp_extract(path, r"([0-9]+)", 1), F.lit("")).alias("item"),
        query_value(url, "page").try_cast("int").alias("page"),
        query_value(url, "ref").alias("ref"),
        query_value(url, "utm_source").alias("utm_source"),
    )


def url_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a page's address says about it."""
    return _facets(read_pages(spark, f"{sf_dir}/pages.parquet"))


def incremental_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same facets, loaded by a stream that reads each page file once."""
    root = scratch_path(spark, "loads")
    # A stream reads a folder or a pattern, but no single file; the pattern fits a table of either kind.
    pages = stream_pages(spark, f"{sf_dir}/pages.parque[t]", "page_id bigint, url string")
    load_new_pages(pages, _facets, f"{root}/lines", f"{root}/progress", page_keys=["page_id"], loads=f"{root}/loads")
    # Where no page has come in, nothing is written.
    lines = _facets(spark.createDataFrame([], "page_id bigint, url string")).withColumn(LOAD, F.lit(0))
    loads = read_or_empty(spark, f"{root}/loads", lines.select("page_id", LOAD).schema)
    return latest_loads(read_or_empty(spark, f"{root}/lines", lines.schema), ["page_id"], loads).drop(LOAD)


def page_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every link on every page."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    bodies = H.cell_bodies(H.visible(F.col("html")), "a")
    return pages.select("page_id", F.posexplode(H.cell_texts(bodies)).alias("cell_no", "text"))


def page_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first block of a class on every page, and its text."""
    pages = select_table(read_pages(spark, f"{sf_dir}/pages.parquet"), tag="div", attributes={"class": "ad"}, into="block")
    return pages.select("page_id", "block", H.cell_texts(F.array("block"))[0].alias("text"))


def _english(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their element that is marked as English; the others have none."""
    return select_table(read_pages(spark, f"{sf_dir}/pages.parquet"), tag="html", attributes={"lang": "en"})


def page_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of page: how many lack the wanted element, and how many links the others hold."""
    pages = _english(spark, sf_dir).select(
        kind_of(F.col("url"), {f"/{lang}/": lang for lang in ("en", "fr", "de", "es")}).alias("kind"),
        "table_html",
        H.cell_bodies(F.col("table_html"), "a").alias("cells"),
    )
    return page_quality(pages, ["kind"])


def page_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the wanted element."""
    return missing_table(_english(spark, sf_dir)).select("page_id", "url")


def records_from_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stat lines rendered as ranking pages and parsed back into typed records."""
    pages = staged(stat_pages(both_kinds(spark, sf_dir)), "pages")
    records = records_from_pages(pages, PART_LAYOUTS).withColumnRenamed("yr", "season_hint")
    return _line_columns(conform(records, PART_LAYOUTS, season_included=True))


def _page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = staged(grid_pages(t.stat_lines(spark, sf_dir)), "pages")
    return table_rows(select_table(pages), ["yr", "page"])


def page_table_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of every rendered table, header included."""
    return table_grid(_page_rows(spark, sf_dir), ["yr", "page"])


def grid_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole parsed tables written per season and read back as columns."""
    path = scratch_path(spark, "grids")
    rows = _page_rows(spark, sf_dir)
    write_grid(rows, path, by=["yr"])
    wide = wide_table(spark.read.schema(rows.schema).parquet(path), ["yr", "page"])
    return wide.select(
        "yr", "page", "row_no", *[F.col(c).alias(c.lower()) for c in GRID_COLUMNS], F.array_join("extra", "|").alias("extra")
    )


def grid_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the rendered tables with those columns as numbers that hold nothing else; the foot is left out."""
    rows = staged(_page_rows(spark, sf_dir), "rows")
    wide = wide_table(rows, ["yr", "page"]).where(~F.col("Name").isin("Sum", "All & more"))
    typed = numeric_columns(staged(wide, "wide"), GRID_COLUMNS)
    return typed.select("yr", "page", "row_no", *[F.col(c).alias(c.lower()) for c in GRID_COLUMNS])


# --- regressions -----------------------------------------------------------------------------------


def ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line through outcome over forecast, per position."""
    fits = ols_by_group(t.errors(spark, sf_dir), "proj", "a", ["pos"])
    return fits.select("pos", "n", _r("slope", 6), _r("intercept", 3))


def _train_and_coming(spark: SparkSession, sf_dir: str, year: int = SCORE_YEAR) -> tuple[DataFrame, DataFrame]:
    """Trimmed lines of the years before ``year``, and its forecasts with a full year of months."""
    errors = staged(t.with_errors(t.stat_lines(spark, sf_dir, last=year - 1)), "errors")
    train = keep_within(errors, "e", iqr_fence(errors, "e", ["pos"]), ["pos"])
    coming = t.stat_lines(spark, sf_dir, year, year).drop("act", "gp")
    return staged(train, "train"), with_full_exposure(coming, "gp", full_season=t.FULL_YEAR)


def ridge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last year scored by one ridge regression per position."""
    train, coming = _train_and_coming(spark, sf_dir)
    inputs = ["gp", "proj"]
    scaler = fit_scaler(train, inputs, ["pos"])
    models = fit_ridge(apply_scaler(train, scaler, inputs, ["pos"]), inputs, "a", ["pos"])
    scaled = apply_scaler(coming.withColumn("projection", F.col("proj")), scaler, inputs, ["pos"])
    scores = score_ridge(scaled, models, inputs, ["pos"], name="score")
    return scores.select("pos", F.col("name").alias("player"), _r("projection"), _r("score", 3))


def _relu_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, coming = _train_and_coming(spark, sf_dir)
    scaler = fit_scaler(train, FEATURES, ["pos"])
    models = fit_relu_runs(apply_scaler(train, scaler, FEATURES, ["pos"]), FEATURES, "a", ["pos"])
    scaled = apply_scaler(coming.withColumn("projection", F.col("proj")), scaler, FEATURES, ["pos"])
    return score_relu_runs(scaled, models, FEATURES, ["pos"], keep=["name", "projection"], name="score")


def relu_run_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last year scored by every seeded run of a hidden-layer regression per position."""
    return _relu_scores(spark, sf_dir).select(
        "pos", F.col("name").alias("player"), "run", _r("projection"), _r("score", 2)
    )


def relu_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and spread of each player's scores over the runs."""
    summary = score_summary(_relu_scores(spark, sf_dir), ["pos", "name"], "score")
    return summary.select("pos", F.col("name").alias("player"), _r("score_mean", 2), _r("score_std", 2), "n_runs")


def _pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs with two hidden units each, whose layers come from a formula."""
    train, coming = _train_and_coming(spark, sf_dir)
    inputs = ["gp", "proj"]
    scaler = fit_scaler(train, inputs, ["pos"])
    models = fit_relu_runs(
        apply_scaler(train, scaler, inputs, ["pos"]), inputs, "a", ["pos"], runs=3, units=2, layer=sine_layer
    )
    scaled = apply_scaler(coming.withColumn("projection", F.col("proj")), scaler, inputs, ["pos"])
    return score_relu_runs(
        scaled, models, inputs, ["pos"], keep=["name", "projection"], units=2, name="score", layer=sine_layer
    )


def relu_pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last year scored by hidden-layer regressions small enough to be solved by hand."""
    return _pair_scores(spark, sf_dir).select("pos", F.col("name").alias("player"), "run", _r("projection"), _r("score", 2))


def relu_pair_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and spread of each player's scores over these runs."""
    summary = score_summary(_pair_scores(spark, sf_dir), ["pos", "name"], "score")
    return summary.select("pos", F.col("name").alias("player"), _r("score_mean", 2), _r("score_std", 2), "n_runs")


# --- from season files to scores ---------------------------------------------------------------------

FILE_POSITION = "TE"


def _season_files(spark: SparkSession, sf_dir: str) -> str:
    """A data folder with the files of five seasons and the forecasts of the one to be scored."""
    root = scratch_path(spark, "data")
    text = staged(season_text(both_kinds(spark, sf_dir)), "text")
    first = SCORE_YEAR - 5
    for yr in range(first, SCORE_YEAR):
        for kind in (PROJECTED, ACTUAL):
            path = SEASON_FILE.format(yr=yr, pos=FILE_POSITION, kind=kind)
            text.where((F.col("yr") == yr) & (F.col("kind") == kind)).select("value").write.text(f"{root}/{path}")
    coming = text.where((F.col("yr") == SCORE_YEAR) & (F.col("kind") == PROJECTED)).select("value")
    coming.write.text(f"{root}/" + SCORING_FILE.format(yr=SCORE_YEAR, pos=FILE_POSITION))
    return root


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a position's model is fitted on, from season files: matched, rescaled, without outliers."""
    lines = read_seasons(spark, _season_files(spark, sf_dir), SCORE_YEAR - 5, SCORE_YEAR - 1, positions=[FILE_POSITION])
    kept = training_frame(lines, FILE_POSITION, more_than=t.MIN_MONTHS, full_season=t.FULL_YEAR)
    stats = [F.col(f"`{s}`").alias(s.lower().replace(" ", "_")) for s in stat_list(FILE_POSITION, with_points=False)]
    return kept.select(
        F.col("Name").alias("name"), F.col("Team").alias("team"), F.col("Yr").alias("yr"), F.col("GP").alias("gp"), *stats,
        F.col(f"`{FORECAST_POINTS}`").alias("forecast"), F.round(F.col(f"`{OUTCOME_POINTS}`"), 6).alias("outcome"),
    )


def file_run_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From season files to the scores of the coming season: three runs with three hidden units and five features."""
    root = _season_files(spark, sf_dir)
    lines = read_seasons(spark, root, SCORE_YEAR - 5, SCORE_YEAR - 1, positions=[FILE_POSITION])
    scoring = read_scoring_season(spark, root, SCORE_YEAR, [FILE_POSITION], full_season=t.FULL_YEAR)
    scores = train_and_score(
        lines, scoring, [FILE_POSITION], runs=3, units=3, layer=sine_layer, more_than=t.MIN_MONTHS, full_season=t.FULL_YEAR
    )
    return scores.select(
        F.col("Yr").alias("yr"), "pos", "run", F.col("Player").alias("player"), _r("Projection").alias("projection"),
        _r("My Computed Score", 2).alias("score"),
    )


# --- from fetched pages to stored lines ------------------------------------------------------------


def _stored_and_quarantined(spark: SparkSession, root: str) -> DataFrame:
    lines = read_history(spark, root, 0, 9999, layouts=PART_LAYOUTS).select(
        F.lit("stored").alias("status"), "kind", F.col("Yr").alias("yr"), "page", F.col("Name").alias("name"), F.col("FPts").alias("points"), F.col("Qty").alias("qty")
    )
    nothing = F.lit(None).cast("double")
    records = read_quarantine(spark, root, "records", "raw string, kind string, yr int, page int").select(
        F.lit("record").alias("status"), "kind", "yr", "page", F.substring_index("raw", ",", 1).alias("name"), nothing.alias("points"), nothing.alias("qty")
    )
    missing = read_quarantine(spark, root, "pages", "reason string, kind string, yr int, page int").select(
        F.col("reason").alias("status"), "kind", "yr", "page", F.lit(None).cast("string").alias("name"), nothing.alias("points"), nothing.alias("qty")
    )
    return union_lines([lines, records, missing])


def page_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages stored as lines, in two loads, with all that does not fit in quarantine.

    The second load holds a few pages again: some with other quantities, one without any line, and some whose
    faults are gone, which leave the quarantine.
    """
    root = scratch_path(spark, "history")
    sides = both_kinds(spark, sf_dir)
    for load in (1, 2):
        pages = staged(fetched_pages(sides, load), "pages")
        build_history(pages, root, 1996, 1998, layouts=PART_LAYOUTS, position_ids={PART_ID: PART})
    return _stored_and_quarantined(spark, root)


def incremental_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two loads as files that come in one after the other, each stored by a stream when it is there."""
    root, folder = scratch_path(spark, "history"), scratch_path(spark, "fetched")
    sides = both_kinds(spark, sf_dir)
    for load in (1, 2):
        fetched_pages(sides, load).write.mode("append").parquet(folder)
        pages = stream_pages(spark, folder, "page_id bigint, url string, html string")
        load_history(pages, root, f"{root}-progress", 1996, 1998, layouts=PART_LAYOUTS, position_ids={PART_ID: PART})
    return _stored_and_quarantined(spark, root)


QUERIES: dict[str, Query] = {
    "trimmed_reconciliation": trimmed_reconciliation,
    "forecast_actual_join": forecast_actual_join,
    "loose_name_join": loose_name_join,
    "exposure_rescale": exposure_rescale,
    "tukey_fence": tukey_fence,
    "std_fence": std_fence_rows,
    "midpoint_quartiles": midpoint_quartiles,
    "overall_quartiles": overall_quartiles,
    "duplicate_keys": duplicate_key_report,
    "season_zscore": season_zscore,
    "feature_scores": feature_scores,
    "pop_scaler": pop_scaler,
    "error_report": error_summary,
    "skew_report": skew_summary,
    "stat_histogram": stat_histogram,
    "log_histogram": log_histogram,
    "conform_layouts": conform_layouts,
    "season_files": season_files,
    "scoring_frame": scoring_frame,
    "union_seasons": union_seasons,
    "sink_roundtrip": sink_roundtrip,
    "url_facets": url_facets,
    "incremental_pages": incremental_pages,
    "page_cells": page_cells,
    "page_element": page_element,
    "page_quality": page_quality_report,
    "page_quarantine": page_quarantine,
    "records_from_cells": records_from_cells,
    "table_grid": page_table_grid,
    "grid_sink_roundtrip": grid_sink_roundtrip,
    "grid_numbers": grid_numbers,
    "ols_by_group": ols_fit,
    "ridge_scores": ridge_scores,
    "relu_run_scores": relu_run_scores,
    "relu_run_summary": relu_run_summary,
    "relu_pair_scores": relu_pair_scores,
    "relu_pair_summary": relu_pair_summary,
    "training_rows": training_rows,
    "file_run_scores": file_run_scores,
    "page_history": page_history,
    "incremental_history": incremental_history,
}
