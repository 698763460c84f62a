"""Stat lines written out as text records and as web pages: the input of the parsing queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonline.layouts import ACTUAL, PROJECTED, Layout
from seasonline.plans.tables import stat_lines

PART = "PART"
PART_ID = "50"
PART_LAYOUTS = {
    (PART, PROJECTED): Layout(PART, PROJECTED, ("Name", "Team", "Yr", "Bye", "Qty", "Lines", "FPts")),
    (PART, ACTUAL): Layout(
        PART, ACTUAL, ("Name", "Team", "Yr", "GP", "Tgts", "Qty", "Lines", "FPts", "FPPG"), dropped=("Tgts", "FPPG")
    ),
}
# Part keys are unique per season, so a page holds at most this many records.
NAMES_PER_PAGE = 50

GRID_COLUMNS = ("Name", "Team", "Months", "Qty", "Value")


def spelled(key: Column) -> Column:
    """A key in letters, since digits are cleaned out of names: 207 -> CAH."""
    return F.translate(key.cast("string"), "0123456789", "ABCDEFGHIJ")


def both_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stat line as a forecast and as an outcome: ``kind``, the fields, ``points``."""
    lines = stat_lines(spark, sf_dir)
    sides = F.array(
        F.struct(F.lit(PROJECTED).alias("kind"), F.round("proj", 2).alias("points")),
        F.struct(F.lit(ACTUAL).alias("kind"), F.round("act", 4).alias("points")),
    )
    return lines.select("name", "pos", "yr", "gp", "qty", "lines", F.round("proj", 2).alias("listed"), F.inline(sides))


def comma_text(sides: DataFrame) -> DataFrame:
    """Text records ``pos, kind, season_hint, value``.

    Odd seasons leave the season out and give it beside the text, as older files do; a
    forecast with an even number of lines has no bye.
    """
    bye = F.when(F.col("lines") % 2 == 0, F.lit("-")).otherwise(F.col("gp").cast("double").cast("string"))
    season = F.when(F.col("yr") % 2 == 0, F.col("yr").cast("double").cast("string"))
    common = [F.col("qty").cast("string"), F.col("lines").cast("double").cast("string")]
    forecast = F.concat_ws(",", spelled(F.col("name")), "pos", season, bye, *common, F.col("points").cast("string"))
    games = F.col("gp").cast("double").cast("string")
    outcome = F.concat_ws(
        ",", spelled(F.col("name")), "pos", season, games, F.lit("0.0"), *common, F.col("points").cast("string"), F.lit("1.5\r")
    )
    return sides.select(
        F.lit(PART).alias("pos"),
        "kind",
        F.col("yr").alias("season_hint"),
        F.when(F.col("kind") == PROJECTED, forecast).otherwise(outcome).alias("value"),
    )


def season_text(sides: DataFrame) -> DataFrame:
    """Stat lines as comma text of the position with the fewest stats: ``yr, kind, value``.

    Quantity, list price and number of lines stand in the places of its three stats, months in that of games and bye.
    """
    price = F.round(F.col("listed") / F.col("qty"), 2)
    stats = [c.cast("double").cast("string") for c in (F.col("qty"), price, F.col("lines"), F.col("points"))]
    months = F.col("gp").cast("double").cast("string")
    who = [spelled(F.col("name")), F.col("pos"), F.col("yr").cast("double").cast("string"), months]
    outcome = F.concat_ws(",", *who, F.lit("0.0"), *stats, F.lit("1.5"))
    return sides.select("yr", "kind", F.when(F.col("kind") == PROJECTED, F.concat_ws(",", *who, *stats)).otherwise(outcome).alias("value"))


def _pages(rows: DataFrame, facets: list[str], head: Column, foot: str, short: Column | None = None) -> DataFrame:
    """Rows ``(facets, name, row_html)`` as one page per facet group, in name order.

    Of pages that are ``short`` the rows of the last name end with their second cell.
    """
    ordered = F.array_sort(F.collect_list(F.struct("name", "row_html")))

    def shown(r: Column) -> Column:
        last = F.element_at("_rows", -1)["name"]
        # The text up to the second cell's end; the rest of the page then holds no further cell.
        cut = F.regexp_replace(r["row_html"], r"(?s)(<a .*?</a></td>).*", "$1</tr>")
        return r["row_html"] if short is None else F.when(short & r["name"].eqNullSafe(last), cut).otherwise(r["row_html"])

    return rows.groupBy(*facets).agg(ordered.alias("_rows")).select(
        *facets, F.concat(head, F.array_join(F.transform("_rows", shown), "\n"), F.lit(foot)).alias("html")
    )


def _on_pages(sides: DataFrame) -> DataFrame:
    return sides.withColumn("page", F.floor(F.col("name") / NAMES_PER_PAGE).cast("int"))


def stat_pages(sides: DataFrame, *, last_is_short: Column | None = None) -> DataFrame:
    """Ranking pages ``yr, pos, kind, page, html`` with the quirks of real ones.

    The data table stands inside another table, with no-break-space cells, links, entities with and
    without semicolon, on every fifth page a team's name in a table of its own with a ">" in an
    attribute, thousands commas and, for outcomes, the rank before the name. Where ``last_is_short`` holds of a page's
    facets, its last record lacks its last cells.
    """
    def td(kind: str, text: Column | str) -> Column:
        mark = {PROJECTED: 'class="smallbody"', ACTUAL: "align=right class='sort1'"}[kind]
        return F.concat(F.lit(f"<td {mark}>"), F.lit(text) if isinstance(text, str) else text, F.lit("</td>"))

    name, brand = spelled(F.col("name")), F.col("pos")
    nested = F.concat(F.lit("<table><tr><td title='>'>"), brand, F.lit("</td></tr></table>"))
    team = F.when(F.floor(F.col("name") / NAMES_PER_PAGE) % 5 == 0, nested).otherwise(brand)
    quantity, count = F.format_number("qty", 1), F.col("lines").cast("string")
    link = F.concat(F.lit('<a href="/players?x=1,2">'), name, F.lit("</a>"))
    rank = (F.col("name") % NAMES_PER_PAGE + 1).cast("string")
    forecast = F.concat(
        td(PROJECTED, "&nbsp"), td(PROJECTED, F.concat(F.lit(" "), link)), td(PROJECTED, team),
        td(PROJECTED, F.col("gp").cast("string")), td(PROJECTED, " "), td(PROJECTED, quantity),
        td(PROJECTED, count), td(PROJECTED, F.format_number("points", 2)),
    )
    outcome = F.concat(
        td(ACTUAL, F.concat(rank, F.lit(". "), link)), td(ACTUAL, brand), td(ACTUAL, F.col("gp").cast("string")),
        td(ACTUAL, "0"), td(ACTUAL, quantity), td(ACTUAL, count), td(ACTUAL, F.format_number("points", 4)),
        td(ACTUAL, "1.5"), td(ACTUAL, "&#160;"), td(ACTUAL, "&#xA0;"),
    )
    row = F.concat(F.lit("<tr>"), F.when(F.col("kind") == PROJECTED, forecast).otherwise(outcome), F.lit("</tr>"))
    rows = _on_pages(sides).select("yr", F.lit(PART).alias("brand"), "kind", "page", "name", row.alias("row_html"))
    head = F.lit(
        "<html><!-- <table width=100% cellpadding=2> --><table border=0><tr><td class=sort1>top</td><td>"
        "<table cellpadding='2' cellspacing=1 WIDTH=\"100%\">"
        "<tr><td class=\"head\"><table><tr><td>Name &amp; more</td></tr></table></td></tr>\n"
    )
    foot = "</table></td></tr></table><td class=smallbody>x</td></html>"
    pages = _pages(rows, ["yr", "brand", "kind", "page"], head, foot, last_is_short)
    return pages.withColumnRenamed("brand", "pos")


def fetched_pages(sides: DataFrame, load: int) -> DataFrame:
    """``page_id, url, html`` of ranking pages as fetched, some of them in a second load again.

    The last record of a page is short, every seventh page (from 3) is of an unknown position and every
    seventh (from 5) has no table. The second load holds even pages of two seasons, with the quantities doubled: of
    1996 with the same faults, and page 0 without any record; of 1997 with whole records, and with all tables.
    """
    faulty = F.lit(True) if load == 1 else F.col("yr") != 1997
    if load == 2:
        again = (F.col("yr").isin(1996, 1997)) & (F.floor(F.col("name") / NAMES_PER_PAGE) % 2 == 0)
        sides = sides.where(again).withColumn("qty", F.col("qty") * 2)
    pages = stat_pages(sides, last_is_short=faulty)
    page = F.col("page")
    head = F.when(F.col("kind") == PROJECTED, "rankings/list.php?").otherwise("stats/list.php?GameWeek=&")
    url = F.concat(
        F.lit("http://www.example.com/"),
        head,
        F.lit("PosID="),
        F.when(page % 7 == 3, "99").otherwise(PART_ID),
        F.lit("&Season="),
        F.col("yr").cast("string"),
        F.lit("&cur_page="),
        page.cast("string"),
    )
    html = F.when((page % 7 == 5) & faulty, "<p>not here</p>")
    if load == 2:
        html = html.when((page == 0) & (F.col("yr") == 1996), "<table width=100% cellpadding=2></table>")
    return pages.select(F.xxhash64(url).alias("page_id"), url.alias("url"), html.otherwise(F.col("html")).alias("html"))


def grid_pages(lines: DataFrame) -> DataFrame:
    """Pages ``yr, page, html`` with a table: a header row, a row per line, and at its end another header
    row and two rows that share a cell, one of them wider than the header."""
    cells = [
        spelled(F.col("name")),
        F.col("pos"),
        F.col("gp").cast("string"),
        F.format_number("qty", 0),
        F.format_number(F.round("proj", 2), 2),
    ]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    rows = _on_pages(lines).select("yr", "page", "name", row.alias("row_html"))
    titles = "".join(f"<th>{c}</th>" for c in GRID_COLUMNS)
    foot = (
        "<tr><th colspan=5>Sum</th></tr><tr><td rowspan=2 colspan='2'>All &amp; more</td><td>n</td><td colspan=2>x</td></tr>"
        "<tr><td>m</td><td title='a>b'>y</td><td>z</td><td>extra</td></tr></table>"
    )
    return _pages(rows, ["yr", "page"], F.lit(f'<table width="100%" cellpadding="2"><tr>{titles}</tr>\n'), foot)
