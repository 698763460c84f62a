"""From positional text records to typed columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonline.functions.html import bind
from seasonline.functions.numbers import float_text, number, whole_number
from seasonline.layouts import LAYOUTS, Layout, all_fields

LayoutMap = Mapping[tuple[str, str], Layout]

# Four digits from 1900 to 2099, as a whole number or in float notation.
SEASON_PATTERN = r"^\s*(?:19|20)\d\d(?:\.0*)?\s*$"


def _typed(text: Column, field_type: str) -> Column:
    if field_type == "string":
        return F.regexp_replace(text, r"\s+$", "")
    return whole_number(text) if field_type == "int" else number(text)


def _by_layout(layouts: LayoutMap, position: str, kind: str, value: Callable[[Layout], Column]) -> Column:
    """A value looked up by the row's position and kind; NULL for an unknown pair."""
    pairs = [x for (p, k), layout in layouts.items() for x in (F.lit(f"{p}/{k}"), value(layout))]
    return F.try_element_at(F.create_map(*pairs), F.concat_ws("/", position, kind))


def known_layout(layouts: LayoutMap, *, position: str = "pos", kind: str = "kind") -> Column:
    """Whether the row's position and kind have a layout; never NULL."""
    names = [f"{p}/{k}" for p, k in layouts]
    return F.coalesce(F.concat_ws("/", position, kind).isin(names), F.lit(False)) & F.col(position).isNotNull()


def conform(
    records: DataFrame,
    layouts: LayoutMap = LAYOUTS,
    *,
    record: str = "record",
    position: str = "pos",
    kind: str = "kind",
    season_hint: str = "season_hint",
    season_included: bool | None = None,
) -> DataFrame:
    """Typed columns from ``record``, an array of strings, by the layout of (position, kind).

    ``season_included`` says whether the records hold the season. If not, they are one field short
    and take ``season_hint``. None: each record may or may not; one that is a field short is taken to
    lack the season only if no season stands in its place. Records of any other width, and those of an
    unknown layout, are malformed: ``width_ok`` is false, their fields are NULL and ``raw`` holds
    their comma text, which is NULL otherwise. The result is one table for all layouts: every kept
    field, NULL where a layout lacks it.
    """
    fields = all_fields(dict(layouts))
    passed = [F.col(f"`{c}`") for c in records.columns if c not in (record, season_hint)]

    def places(layout: Layout) -> Column:
        return F.array(*[F.lit(layout.fields.index(f) if f in layout.kept else None).cast("int") for f in fields])

    def season_place(layout: Layout) -> Column:
        return F.lit(layout.fields.index(layout.season) + 1 if layout.season in layout.fields else None).cast("int")

    width = _by_layout(layouts, position, kind, lambda layout: F.lit(layout.width))
    at = _by_layout(layouts, position, kind, season_place)
    hint, given = F.col(season_hint).cast("string"), F.col(record)
    whole = F.when(F.lit(season_included is not False) & (F.size(given) == F.col("_width")), given).when(
        F.lit(season_included is not True)
        & (F.size(given) == F.col("_width") - 1)
        & F.col("_season").isNotNull()
        & ~F.coalesce(F.get(given, F.col("_season") - 1).rlike(SEASON_PATTERN), F.lit(False)),
        F.array_insert(given, F.coalesce(F.col("_season"), F.lit(1)), hint),
    )
    aligned = (
        records.select(*passed, record, season_hint, width.alias("_width"), at.alias("_season"))
        .select(*passed, record, whole.alias("_cells"), _by_layout(layouts, position, kind, places).alias("_places"))
        .select(*passed, "_cells", "_places", F.when(F.col("_cells").isNull(), comma_line(given)).alias("raw"))
    )
    cells = [F.get(F.col("_cells"), F.get(F.col("_places"), F.lit(i))) for i in range(len(fields))]
    return (
        aligned.select(
            *passed, F.col("_cells").isNotNull().alias("width_ok"), "raw", *[c.alias(f) for c, f in zip(cells, fields)]
        ).select(*passed, *[_typed(F.col(f"`{f}`"), t).alias(f) for f, t in fields.items()], "width_ok", "raw")
    )


def comma_line(cells: Column) -> Column:
    """Texts as one comma line; those that hold a comma, a quote or a line end are quoted."""

    def quoted(cell: Column) -> Column:
        doubled = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(cell.rlike('[",\n\r]'), doubled).otherwise(F.coalesce(cell, F.lit("")))

    return F.array_join(F.transform(cells, quoted), ",")


def comma_cells(line: Column) -> Column:
    """The reverse of :func:`comma_line`; a quote inside an unquoted cell is an ordinary character."""

    def bare(cell: Column) -> Column:
        inner = F.substring(cell, F.lit(2), F.length(cell) - 2)
        whole = (F.length(cell) >= 2) & F.startswith(cell, F.lit('"')) & F.endswith(cell, F.lit('"'))
        return F.when(whole, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)

    # With a comma before it, every cell of the line is one match that is never empty.
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*+"(?=\s*(?:,|$))|[^,]*)'), F.lit(1))
    return F.when(F.contains(line, F.lit('"')), F.transform(found, bare)).otherwise(F.split(line, ",", -1))


def position_frame(lines: DataFrame, layout: Layout, *, position: str = "pos", kind: str = "kind") -> DataFrame:
    """The rows of one (position, kind) with that layout's columns, in its order."""
    rows = lines.where((F.col(position) == layout.position) & (F.col(kind) == layout.kind))
    return rows.select(*[F.col(f"`{f}`") for f in layout.kept])


def comma_text(
    lines: DataFrame, layouts: LayoutMap = LAYOUTS, *, position: str = "pos", kind: str = "kind", text: str = "value"
) -> DataFrame:
    """The reverse of :func:`conform`: each line's fields in its layout's order, as comma text.

    Numbers are written in float notation, texts quoted where they have to be; fields that are not
    kept, and missing values, are left empty. Lines of an unknown layout give NULL. A malformed line's
    ``raw`` text, where there is that column, is written as it came.
    """
    types = all_fields(dict(layouts))
    texts, numbers = ([f for f, t in types.items() if (t == "string") == wanted] for wanted in (True, False))
    order = [*texts, *numbers]

    def places(layout: Layout) -> Column:
        return F.array(*[F.lit(order.index(f) if f in layout.kept else None).cast("int") for f in layout.fields])

    # All fields once, and by layout the places to take them from: one short expression for any number of layouts.
    written = F.concat(
        F.array(*[F.col(f"`{f}`").cast("string") for f in texts]).cast("array<string>"),
        F.transform(F.array(*[F.col(f"`{f}`").cast("double") for f in numbers]).cast("array<double>"), float_text),
    )
    wanted = _by_layout(layouts, position, kind, places)
    # Bound, or the optimiser would work all fields out again for each place.
    value = bind(written, lambda ws: comma_line(F.transform(wanted, lambda at: F.coalesce(F.get(ws, at), F.lit("")))))
    if "raw" in lines.columns:
        value = F.coalesce(F.col("raw"), value)
    return lines.withColumn(text, value)
