"""From fetched pages to stored stat lines."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.layouts import CELL_CLASS, LAYOUTS, POSITION_IDS, PROJECTED, TABLE_ATTRIBUTES
from seasonline.operators.conform import LayoutMap, conform, known_layout
from seasonline.operators.extract import (
    joined_cells,
    page_quality,
    records_from_pages,
    records_from_tables,
    select_table,
    split_cells,
    with_cells,
)
from seasonline.operators.reconcile import FULL_SEASON, with_full_exposure
from seasonline.session import staged
from seasonline.sources.pages import with_url_facets
from seasonline.sources.sinks import read_or_empty, write_master_seasons, write_partitioned, write_seasons

FACETS = ("yr", "pos", "kind", "page")
PAGE = ("Yr", "pos", "kind", "page")
LOAD = "load_id"

# Why a page holds no lines.
NO_TABLE = "no table"
UNKNOWN_PAGE = "unknown page"


def lines_from_pages(
    pages: DataFrame,
    layouts: LayoutMap = LAYOUTS,
    *,
    table_attributes: Mapping[str, str] = TABLE_ATTRIBUTES,
    cell_class: Mapping[str, str] = CELL_CLASS,
) -> DataFrame:
    """Typed stat lines of all pages that carry ``pos, yr, page, kind`` facets.

    Records of the wrong width are kept and marked, with their text in ``raw``.
    """
    records = records_from_pages(pages, layouts, table_attributes=table_attributes, cell_class=cell_class)
    return conform(records.withColumnRenamed("yr", "season_hint"), layouts, season_included=True)


def history_quality(pages: DataFrame) -> DataFrame:
    """Page counts by season, position, kind and page: all, empty ones, those without a table."""
    tables = with_cells(select_table(with_url_facets(pages)))
    cells = tables.withColumn("cells", split_cells(joined_cells(F.col("cells"))))
    return page_quality(cells, FACETS)


def build_history(
    pages: DataFrame,
    path: str,
    first: int,
    last: int,
    *,
    layouts: LayoutMap = LAYOUTS,
    position_ids: Mapping[str, str] = POSITION_IDS,
    name: str | None = None,
) -> None:
    """Store the lines of ``pages``, and the seasons from ``first`` to ``last`` as one master table.

    Nothing is lost on the way: a page without the table, or whose address names no known position, kind
    and season, goes to ``quarantine/pages`` with the reason; a record of the wrong width goes to
    ``quarantine/records`` with its text; all else is a stored line. Loading a page again replaces that
    page's lines and quarantine, also by none, and leaves other pages alone. An address without a page number is page 0.

    The page is cut once: facets and table are staged, and every output is made from them. A load adds
    folders of its own, and counts when the list of its pages is written; what a load that
    failed has left is not read. A load's number follows those in the list; with a ``name`` that the list holds already
    the load takes the place of that one, so a load that is done again replaces itself. Last, the master gets the
    seasons that changed since it was last written, and no others.
    """
    spark = pages.sparkSession
    load = _load_id(spark, path, name)
    cut = _cut_pages(pages, layouts, position_ids).withColumn(LOAD, F.lit(load))
    cut = staged(cut.drop("html"), "tables")
    good, bad = _page_lines(cut.where(F.col("reason").isNull()), layouts, load)
    write_seasons(good, f"{path}/seasons", by=("Yr", "pos", "kind", LOAD))
    write_partitioned(bad, f"{path}/quarantine/records", [LOAD])
    write_partitioned(cut.where(F.col("reason").isNotNull()), f"{path}/quarantine/pages", [LOAD])
    # Every page that was seen, with lines or without; one of no known place is told by its address.
    unknown = F.col("reason") == UNKNOWN_PAGE
    placed = [F.when(unknown.isNull() | ~unknown, F.col(c)).alias(n) for c, n in zip(FACETS, PAGE, strict=True)]
    seen = cut.select(*placed, F.when(unknown, F.col("url")).alias("url"), LOAD).distinct()
    write_partitioned(seen, f"{path}/loads", [LOAD])
    _update_master(spark, path, first, last, layouts, load)


def _cut_pages(pages: DataFrame, layouts: LayoutMap, position_ids: Mapping[str, str]) -> DataFrame:
    """Pages with facets, their table, and the reason if they hold no lines."""
    cut = select_table(with_url_facets(pages, position_ids=position_ids).withColumn("page", F.coalesce("page", F.lit(0))))
    reason = F.when(~known_layout(layouts) | F.col("yr").isNull(), UNKNOWN_PAGE).when(F.col("table_html").isNull(), NO_TABLE)
    return cut.withColumn("reason", reason)


def _page_lines(known: DataFrame, layouts: LayoutMap, load: str) -> tuple[DataFrame, DataFrame]:
    """Stat lines of cut pages, and the records of the wrong width with their place and text."""
    records = records_from_tables(known, layouts).withColumnRenamed("yr", "season_hint")
    # A record whose text gives no season falls under its page's.
    lines = conform(records.withColumn("page_yr", F.col("season_hint")), layouts, season_included=True)
    lines = staged(lines.withColumn(LOAD, F.lit(load)), "lines")
    good = lines.where("width_ok").withColumn("Yr", F.col("page_yr")).drop("page_yr", "width_ok", "raw")
    return good, lines.where("NOT width_ok").select(F.col("page_yr").alias("yr"), "pos", "kind", "page", "row_no", "raw", LOAD)


_LOADS = f"Yr int, pos string, kind string, page int, url string, {LOAD} string"


def _loads(spark: SparkSession, path: str) -> DataFrame:
    """The list of loads: a row for every page of each."""
    return read_or_empty(spark, f"{path}/loads", _LOADS)


def _load_id(spark: SparkSession, path: str, name: str | None) -> str:
    """The next number, and a name: ids grow with the list, whatever the clocks of those who write say."""
    ids = [r[0] for r in _loads(spark, path).select(LOAD).distinct().orderBy(F.desc(LOAD)).limit(1).collect()]
    if name is not None:
        same = _loads(spark, path).where(F.col(LOAD).endswith(f"-{name}")).select(F.max(LOAD)).first()[0]
        if same is not None:
            return same
    number = int(ids[0].split("-", 1)[0]) + 1 if ids else 0
    return f"{number:020d}-{name or uuid.uuid4().hex[:8]}"


def _update_master(spark: SparkSession, path: str, first: int, last: int, layouts: LayoutMap, load: str) -> None:
    """Write those seasons of the master again whose pages came in a load after the one it was last written for.

    A season's folder is written beside the old one and then takes its place; what fails before leaves the master as it was,
    and the next load does it again.
    """
    master = f"{path}/masters/{first}-{last}"
    upto = read_or_empty(spark, f"{master}/_upto", f"{LOAD} string").select(F.max(LOAD)).first()[0]
    seasons = None
    if upto is not None:
        newer = _loads(spark, path).where((F.col(LOAD) > upto) | (F.col(LOAD) == load)).where(F.col("Yr").between(first, last))
        seasons = [r["Yr"] for r in newer.select("Yr").distinct().collect()]
    stored = read_history(spark, path, first, last, layouts=layouts)
    write_master_seasons(stored, master, seasons)
    newest = spark.createDataFrame([(max(load, upto or ""),)], f"{LOAD} string")
    newest.coalesce(1).write.mode("overwrite").parquet(f"{master}/_upto")


def build_scoring_season(
    pages: DataFrame,
    path: str,
    season: int,
    *,
    full_season: int = FULL_SEASON,
    layouts: LayoutMap = LAYOUTS,
    position_ids: Mapping[str, str] = POSITION_IDS,
) -> None:
    """Store the forecasts of the season to be scored, with a full season of games.

    Forecast pages of the season without the table, pages of no known place and records of the wrong width go to
    ``_quarantine/pages`` and ``_quarantine/records``; pages of other seasons and kinds are left alone.
    """
    cut = _cut_pages(pages, layouts, position_ids)
    wanted = (F.col("kind") == PROJECTED) & (F.col("yr") == season)
    cut = staged(cut.where(F.coalesce(wanted, F.lit(False)) | (F.col("reason") == UNKNOWN_PAGE)).drop("html"), "tables")
    good, bad = _page_lines(cut.where(F.col("reason").isNull()), layouts, "")
    write_seasons(with_full_exposure(good.drop(LOAD), full_season=full_season), path)
    bad.drop(LOAD).write.mode("overwrite").parquet(f"{path}/_quarantine/records")
    cut.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{path}/_quarantine/pages")


def read_history(spark: SparkSession, path: str, first: int, last: int, *, layouts: LayoutMap = LAYOUTS) -> DataFrame:
    """Stored lines of a range of seasons, of each page's newest load; only those seasons' folders are read."""
    empty = conform(
        spark.createDataFrame([], "pos string, kind string, page int, row_no int, season_hint int, record array<string>"), layouts
    ).drop("width_ok", "raw")
    in_range = F.col("Yr").between(first, last)
    stored = spark.read.schema(empty.withColumn(LOAD, F.lit("")).schema).parquet(f"{path}/seasons").where(in_range)
    newest = _loads(spark, path).where(in_range).groupBy(*PAGE).agg(F.max(LOAD).alias(LOAD))
    return stored.join(newest, [*PAGE, LOAD], "left_semi").select(*empty.columns)


def read_quarantine(spark: SparkSession, path: str, what: str, schema: str, *, superseded: bool = False) -> DataFrame:
    """Quarantined ``pages`` or ``records`` of each page's newest load, or with ``superseded`` of every load.

    What a later load of the same page has set right is quarantined no more. A page of no known place is told by its address;
    one without an address stays.
    """
    wanted = T.StructType.fromDDL(schema)
    keys = [F.col(c).alias(n) for c, n in zip(FACETS, PAGE, strict=True)]
    own = "yr int, pos string, kind string, page int" + (", url string, reason string" if what == "pages" else "")
    needed = T.StructType([*wanted.fields, *[f for f in T.StructType.fromDDL(f"{own}, {LOAD} string").fields if f.name not in wanted.names]])
    entries = read_or_empty(spark, f"{path}/quarantine/{what}", needed)
    if superseded:
        return entries.select(*wanted.names)
    loads = _loads(spark, path)
    newest = loads.where(F.col("Yr").isNotNull()).groupBy(*PAGE).agg(F.max(LOAD).alias("newest"))
    unknown = F.col("reason") == UNKNOWN_PAGE if what == "pages" else F.lit(False)
    known = entries.where(~unknown).select("*", *[k.alias(f"_{n}") for k, n in zip(keys, PAGE, strict=True)])
    same = [F.col(f"_{n}") == newest[n] for n in PAGE] + [F.col(LOAD) == newest["newest"]]
    current = known.join(newest, same, "left_semi").select(*wanted.names)
    if what != "pages":
        return current
    urls = loads.where(F.col("url").isNotNull()).groupBy("url").agg(F.max(LOAD).alias(LOAD))
    lost = entries.where(unknown)
    addressed = lost.join(urls, ["url", LOAD], "left_semi").select(*wanted.names)
    return current.unionByName(addressed).unionByName(lost.where(F.col("url").isNull()).select(*wanted.names))
