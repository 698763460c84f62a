"""Records from pages of HTML tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonline.functions import html as H
from seasonline.functions.numbers import float_text, number
from seasonline.layouts import ACTUAL, CELL_CLASS, LAYOUTS, TABLE_ATTRIBUTES
from seasonline.operators.conform import LayoutMap


def select_table(
    pages: DataFrame,
    *,
    html: str = "html",
    tag: str = "table",
    attributes: Mapping[str, str] = TABLE_ATTRIBUTES,
    into: str = "table_html",
) -> DataFrame:
    """``pages`` with the first element of the given tag and attributes; NULL where missing."""
    seen = pages.withColumn("_visible", H.visible(F.col(html)))
    return seen.withColumn(into, H.first_element(F.col("_visible"), tag, attributes)).drop("_visible")


def with_cells(
    pages: DataFrame,
    *,
    html: str = "table_html",
    kind: str = "kind",
    cell_class: Mapping[str, str] = CELL_CLASS,
    into: str = "cells",
) -> DataFrame:
    """Cell texts by the class that marks data cells for each page's kind."""
    bodies: Column | None = None
    for k, name in cell_class.items():
        found = H.cell_bodies(F.col(html), "td", {"class": name})
        bodies = F.when(F.col(kind) == k, found) if bodies is None else bodies.when(F.col(kind) == k, found)
    return pages.withColumn(into, H.cell_texts(bodies))


def joined_cells(cells: Column) -> Column:
    """Cells as comma text without the separators that hold only no-break spaces.

    A separator between a cell that ends in a no-break space and one that starts with one is
    removed too, which joins the two cells; any other no-break space is deleted.
    """
    text = F.array_join(cells, ",")
    text = F.replace(text, F.lit(f"{H.NBSP},{H.NBSP}"), F.lit(""))
    return F.replace(text, F.lit(H.NBSP), F.lit(""))


def split_cells(text: Column) -> Column:
    """Comma text back to cells, without empty ones."""
    return F.filter(F.split(text, ","), lambda c: c != "")


def chunked(cells: Column, width: Column) -> Column:
    """Cells in records of ``width``; the last one may be short. No cells, no records."""
    starts = F.sequence(F.lit(0), F.floor((F.size(cells) - 1) / width).cast("int"))
    records = F.transform(starts, lambda k: F.slice(cells, k * width + 1, width))
    return F.when(F.size(cells) > 0, records).otherwise(F.array().cast("array<array<string>>"))


# Digits of any script, raised, lowered and circled ones.
_DIGIT = r"[\p{Nd}\u00b2\u00b3\u00b9\u2070\u2074-\u2079\u2080-\u2089\u2460-\u2468]"


def clean_name(name: Column) -> Column:
    """A name without the rank printed before it: no digits, outer full stops, outer spaces."""
    return F.trim(F.btrim(F.regexp_replace(name, _DIGIT, ""), F.lit(".")))


def number_or_text(cell: Column) -> Column:
    """A cell as it is written out: numbers in float notation, everything else as it is."""
    return F.coalesce(float_text(number(cell)), cell)


def records_from_pages(
    pages: DataFrame,
    layouts: LayoutMap = LAYOUTS,
    *,
    html: str = "html",
    position: str = "pos",
    kind: str = "kind",
    season: str | None = "yr",
    order: Sequence[str] = ("page",),
    table_attributes: Mapping[str, str] = TABLE_ATTRIBUTES,
    cell_class: Mapping[str, str] = CELL_CLASS,
    season_at: int = 3,
) -> DataFrame:
    """One row per record: page facets, ``row_no`` on the page, and ``record``.

    With ``season`` the page's season goes in as the third field; with ``season=None`` the
    records keep the older layout without it. Names are cleaned on pages of outcomes only. Pages
    without the table or of an unknown layout have no records.
    """
    facets = list(dict.fromkeys([*([season] if season else []), position, kind, *order]))
    tables = select_table(pages.select(*facets, html), html=html, attributes=table_attributes)
    return records_from_tables(tables, layouts, position=position, kind=kind, season=season, order=order, cell_class=cell_class, season_at=season_at)


def records_from_tables(
    tables: DataFrame,
    layouts: LayoutMap = LAYOUTS,
    *,
    table: str = "table_html",
    position: str = "pos",
    kind: str = "kind",
    season: str | None = "yr",
    order: Sequence[str] = ("page",),
    cell_class: Mapping[str, str] = CELL_CLASS,
    season_at: int = 3,
) -> DataFrame:
    """The records of tables that were cut out of their pages; see :func:`records_from_pages`."""
    facets = list(dict.fromkeys([*([season] if season else []), position, kind, *order]))
    cells = with_cells(tables.select(*facets, table), html=table, kind=kind, cell_class=cell_class)
    flat = cells.select(*facets, split_cells(joined_cells(F.col("cells"))).alias("cells"))
    width: Column | None = None
    for (pos, knd), layout in layouts.items():
        here = (F.col(position) == pos) & (F.col(kind) == knd)
        width = F.when(here, layout.page_width) if width is None else width.when(here, layout.page_width)
    flat = flat.withColumn("_width", width).where(F.col("_width").isNotNull())
    rows = flat.select(*facets, F.posexplode(chunked(F.col("cells"), F.col("_width"))).alias("row_no", "record"))
    record = F.col("record")
    first = F.get(record, F.lit(0))
    named = F.concat(
        F.array(F.when(F.col(kind) == ACTUAL, clean_name(first)).otherwise(first)), F.slice(record, F.lit(2), F.size(record))
    )
    if season is not None:
        # A record too short to reach the third field gets the season at its end.
        at = F.least(F.lit(season_at), F.size(named) + 1)
        named = F.array_insert(named, at, F.col(season).cast("string"))
    return rows.withColumn("record", F.transform(named, number_or_text))


_ROW = rf"(?is)<tr\b[^>]*>({H.up_to('(?:tr|table|tbody|thead|tfoot)')})"
_CELL = rf"(?is)(<t[dh]\b{H.up_to('t[dh]')})"
_SPAN = r"(?is)^<t[dh]\b[^>]*\s{}\s*=\s*[\"']?([0-9]+)"


def table_rows(pages: DataFrame, keys: Sequence[str], *, html: str = "table_html") -> DataFrame:
    """Every row of a table, header rows included: ``row_no``, ``in_head`` and ``cells`` of (is_header, text).

    A cell that spans several columns or rows is repeated in each of them, as far as the table goes.
    ``in_head`` marks the header rows a table begins with; a header row further down is not among them.
    """

    def span(tag: Column, name: str) -> Column:
        width = F.regexp_extract(tag, _SPAN.format(name), 1).try_cast("int")
        return F.greatest(F.coalesce(width, F.lit(1)), F.lit(1))

    def single(tag: Column, text: Column) -> Column:
        return F.struct((F.lower(F.substring(tag, 2, 2)) == "th").alias("is_header"), text.alias("text"))

    def spanning(tag: Column, text: Column) -> Column:
        below = (span(tag, "rowspan") - 1).alias("below")
        cell = F.struct((F.lower(F.substring(tag, 2, 2)) == "th").alias("is_header"), text.alias("text"), below)
        return F.array_repeat(cell, span(tag, "colspan"))

    def texts(tags: Column) -> Column:
        return F.transform(H.plain_texts(tags), lambda t: F.btrim(t, F.lit(" \t\r\n")))

    def tags_of(row: Column) -> Column:
        return F.regexp_extract_all(row, F.lit(_CELL), F.lit(1))

    def plain(rows: Column) -> Column:
        return F.transform(F.transform(rows, tags_of), lambda tags: F.zip_with(tags, texts(tags), single))

    def spread(rows: Column) -> Column:
        """Rows laid out one after the other; from row to row go the rows done and the cells that reach further down."""
        own = F.transform(F.transform(rows, tags_of), lambda tags: F.zip_with(tags, texts(tags), spanning))

        def step(done: Column, row: Column) -> Column:
            return H.bind(
                _placed(done["above"], row),
                lambda line: F.struct(F.concat(done["rows"], F.array(F.transform(line, shown))).alias("rows"), line.alias("above")),
            )

        start = F.struct(F.array().cast(_SHOWN).alias("rows"), F.array().cast(_PLACED).alias("above"))
        return F.aggregate(own, start, step, lambda done: done["rows"])

    def shown(cell: Column) -> Column:
        return F.struct(cell["is_header"].alias("is_header"), cell["text"].alias("text"))

    # Only rows that a span may touch are laid out cell by cell: from the first row with one to as far as the last with one
    # or any that reaches over several rows goes. Most tables have none, or a few at the foot.
    found = pages.select(*keys, F.regexp_extract_all(F.col(html), F.lit(_ROW), F.lit(1)).alias("_rows"))
    marks = F.transform("_rows", lambda row: row.rlike(r"(?i)\s(?:col|row)span"))
    reach = F.transform(
        F.filter(F.transform("_rows", lambda row, i: F.struct(row.alias("row"), i.alias("i"))), lambda r: r["row"].rlike(r"(?i)\s(?:col|row)span")),
        lambda r: r["i"] + F.array_max(F.transform(tags_of(r["row"]), lambda tag: span(tag, "rowspan"))),
    )
    found = found.select(*keys, "_rows", F.array_position(marks, F.lit(True)).cast("int").alias("_first"), F.array_max(reach).cast("int").alias("_last"))
    n = F.size("_rows")
    last = F.least("_last", n)
    laid_out = F.concat(
        plain(F.slice("_rows", F.lit(1), F.col("_first") - 1)),
        spread(F.slice("_rows", F.col("_first"), last - F.col("_first") + 1)),
        plain(F.slice("_rows", last + 1, n - last)),
    )
    cells = F.when(F.col("_first") > 0, laid_out).otherwise(plain(F.col("_rows")))
    head = F.aggregate(
        "_cells",
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("open")),
        lambda s, row: F.struct(
            (s["n"] + F.when(s["open"] & F.forall(row, lambda c: c["is_header"]), 1).otherwise(0)).alias("n"),
            (s["open"] & F.forall(row, lambda c: c["is_header"])).alias("open"),
        ),
        lambda s: s["n"],
    )
    # The head is counted before the rows part: beside an explode it would be once for every row. The outer form, as
    # for the plain one Spark adds a filter on the cells below the projection that parses them, and so parses them again.
    laid = found.select(*keys, cells.alias("_cells")).select(*keys, "_cells", head.alias("_head"))
    laid = laid.select(*keys, "_head", F.posexplode_outer("_cells").alias("row_no", "cells")).where(F.col("row_no").isNotNull())
    return laid.select(*keys, "row_no", (F.col("row_no") < F.col("_head")).alias("in_head"), "cells")


_SHOWN = "array<array<struct<is_header:boolean,text:string>>>"
_PLACED = "array<struct<is_header:boolean,text:string,below:int>>"


def _placed(above: Column, row: Column) -> Column:
    """A row's cells in their columns, between those that reach down from the row ``above``.

    ``below`` of a cell says how many further rows it reaches into.
    """
    hanging = F.transform(
        above,
        lambda c: F.struct(
            (c["below"] > 0).alias("hangs"),
            F.struct(c["is_header"].alias("is_header"), c["text"].alias("text"), (c["below"] - 1).alias("below")).alias("cell"),
        ),
    )

    def joined(hanging: Column) -> Column:
        def step(line: Column, cells: Column) -> Column:
            """``line`` with the hanging cells that come next to it, then the row's next cell."""
            rest = F.slice(hanging, F.size(line) + 1, F.size(hanging))
            run = F.aggregate(
                rest,
                F.struct(line.alias("line"), F.lit(True).alias("on")),
                lambda s, h: F.struct(
                    F.when(s["on"] & h["hangs"], F.concat(s["line"], F.array(h["cell"]))).otherwise(s["line"]).alias("line"),
                    (s["on"] & h["hangs"]).alias("on"),
                ),
                lambda s: s["line"],
            )
            return F.concat(run, cells)

        def ended(line: Column) -> Column:
            rest = F.slice(hanging, F.size(line) + 1, F.size(hanging))
            return F.concat(line, F.transform(F.filter(rest, lambda h: h["hangs"]), lambda h: h["cell"]))

        return F.aggregate(row, F.array().cast(_PLACED), step, ended)

    return H.bind(hanging, joined)


def table_grid(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of :func:`table_rows` as one line per cell: ``row_no, col_no, is_header, text``."""
    # The outer form: for the plain one Spark adds a filter on the array's size below the
    # projection that parses it, and so parses every row twice more.
    cells = rows.select(*keys, "row_no", F.posexplode_outer("cells").alias("col_no", "_cell"))
    cells = cells.where(F.col("col_no").isNotNull())
    return cells.select(*keys, "row_no", "col_no", "_cell.is_header", "_cell.text")


def header_names(rows: DataFrame) -> list[str]:
    """Column names of the tables' longest first header row, in order of place; a name met twice gets a number.

    Spark chooses the row, of several as long the greatest by its names; one comes back.
    """
    headers = rows.where(F.col("in_head") & (F.col("row_no") == 0)).select(F.transform("cells", lambda c: c["text"]).alias("names"))
    header = headers.agg(F.max(F.struct(F.size("names").alias("n"), "names"))["names"].alias("names")).first()["names"] or []
    return [name if header.index(name) == i else f"{name}.{header[:i].count(name)}" for i, name in enumerate(header)]


def wide_table(rows: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, *, extra: str = "extra") -> DataFrame:
    """Rows of :func:`table_rows` as a table of text columns, without the header rows at the top.

    ``columns`` names the columns by place (None: as the tables' own headers do). What stands to the right
    of the last of them is kept as an array in ``extra``, which is empty where there is nothing.
    """
    columns = header_names(rows) if columns is None else list(columns)
    named = [F.get("cells", F.lit(i))["text"].alias(c) for i, c in enumerate(columns)]
    right = F.transform(F.slice("cells", len(columns) + 1, F.greatest(F.size("cells"), F.lit(1))), lambda c: c["text"])
    return rows.where(~F.col("in_head")).select(*keys, "row_no", *named, right.alias(extra))


def numeric_columns(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``table`` with those of the text columns as doubles whose values all are numbers.

    Thousands commas are allowed and empty texts are missing values. A column without any value stays text.
    """

    def value(c: str) -> Column:
        return number(F.replace(F.col(f"`{c}`"), F.lit(","), F.lit("")))

    def given(c: str) -> Column:
        return F.trim(F.col(f"`{c}`")) != ""

    checks = [
        (F.count_if(given(c)) > 0) & (F.count_if(given(c) & value(c).isNull()) == 0) for c in columns
    ]
    found = table.agg(*[check.alias(f"_{i}") for i, check in enumerate(checks)]).first() if columns else ()
    return table.withColumns({c: value(c) for c, is_number in zip(columns, found) if is_number})


def page_quality(
    pages: DataFrame, facets: Sequence[str], *, cells: str = "cells", table: str = "table_html"
) -> DataFrame:
    """Per facet group: pages, pages with at most one cell, pages without the table, cells."""
    n_cells = F.coalesce(F.size(cells), F.lit(0))
    n_cells = F.when(F.col(table).isNull(), F.lit(0)).otherwise(F.greatest(n_cells, F.lit(0)))
    return (
        pages.select(*facets, F.col(table).isNull().alias("_missing"), n_cells.alias("_n"))
        .groupBy(*facets)
        .agg(
            F.count("*").alias("n_pages"),
            F.count_if(F.col("_n") <= 1).alias("n_empty"),
            F.count_if(F.col("_missing")).alias("n_missing"),
            F.sum("_n").alias("n_cells"),
        )
    )


def missing_table(pages: DataFrame, *, table: str = "table_html") -> DataFrame:
    """Pages on which the table was not found, for the quarantine output."""
    return pages.where(F.col(table).isNull())
