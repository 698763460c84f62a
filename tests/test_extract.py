import random
import re
import time

import pytest
from conftest import rows
from pages import PAGES, TE_ACTUAL, TE_ROWS, expected_records, table
from pyspark.sql import functions as F

from seasonline.functions import html as H
from seasonline.layouts import CELL_CLASS, LAYOUTS, OLD_CELL_CLASS
from seasonline.operators.extract import (
    chunked,
    clean_name,
    joined_cells,
    missing_table,
    number_or_text,
    numeric_columns,
    page_quality,
    records_from_pages,
    select_table,
    split_cells,
    table_grid,
    table_rows,
    wide_table,
    with_cells,
)

SCHEMA = "name string, yr int, pos string, kind string, page int, html string"


@pytest.fixture(scope="module")
def pages(spark):
    data = [(name, 2015, pos, kind, i, html) for i, (name, (pos, kind, html)) in enumerate(PAGES.items())]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def parsed(pages):
    found = {}
    for r in records_from_pages(pages).orderBy("page", "row_no").collect():
        found.setdefault(r["page"], []).append(r["record"])
    return found


@pytest.mark.parametrize("name", PAGES)
def test_records_equal_a_plain_reading(parsed, name):
    pos, kind, html = PAGES[name]
    wanted = expected_records(html, CELL_CLASS[kind], LAYOUTS[pos, kind].page_width, 2015, kind == "actual")
    assert parsed.get(list(PAGES).index(name), []) == wanted


def test_known_records(parsed):
    at = list(PAGES).index
    assert parsed[at("plain")][0] == ["Al Bo", "KC", "2015.0", "7.0", "80.0", "1024.5", "9.0", "200.5"]
    assert parsed[at("plain")][1][:4] == ["Cy D'Oh", "FA", "2015.0", "-"]
    assert parsed[at("outcome with ranks")][0][:4] == ["Al Bo Jr", "KC", "2015.0", "16.0"]
    assert parsed[at("fused cells")][0][:4] == ["2. BoNO", "7.0", "2015.0", "80.0"]
    assert parsed[at("short last record")][1] == ["Zed", "2015.0"]


def test_older_records_have_no_season(spark):
    page = spark.createDataFrame([("x", 2010, "TE", "projected", 0, table(TE_ROWS, "sort1"))], SCHEMA)
    got = records_from_pages(page, season=None, cell_class=OLD_CELL_CLASS).orderBy("row_no").collect()
    assert got[0]["record"] == ["Al Bo", "KC", "7.0", "80.0", "1024.5", "9.0", "200.5"]


def test_chunks_put_together_are_the_cells(spark):
    data = [([str(i) for i in range(n)], w) for n in range(0, 8) for w in (1, 3, 7)]
    df = spark.createDataFrame(data, "cells array<string>, w int")
    for cells, w, chunks in df.select("cells", "w", chunked(F.col("cells"), F.col("w"))).collect():
        assert [c for chunk in chunks for c in chunk] == cells
        assert all(len(c) == w for c in chunks[:-1])


def test_small_steps(spark):
    df = spark.createDataFrame([(["a\u00a0", "\u00a0b", "\u00a0", "c", ""],)], "c array<string>")
    assert df.select(split_cells(joined_cells(F.col("c")))).first()[0] == ["ab", "c"]
    names = spark.createDataFrame([("1. Al Rider",), ("23. .A.J. Brook Jr. ",), ("  4 ",)], "n string")
    assert [r[0] for r in names.select(clean_name(F.col("n"))).collect()] == ["Al Rider", ".A.J. Brook Jr.", ""]
    cells = spark.createDataFrame([("7",), ("-",), ("1e2",), ("x1",)], "c string")
    assert [r[0] for r in cells.select(number_or_text(F.col("c"))).collect()] == ["7.0", "-", "100.0", "x1"]


def test_quality_and_quarantine(pages):
    tables = with_cells(select_table(pages))
    report = rows(page_quality(tables.where("name in ('plain', 'no table', 'empty table', 'other classes')"), ["kind"]))
    assert report == [("projected", 4, 3, 1, 14)]
    assert rows(missing_table(select_table(pages)).select("name")) == [("no table",)]


def test_grid_and_wide_table(spark):
    html = (
        "<table width=100% cellpadding=2><tr><th colspan=2>Na&amp;me</th><th>Yds</th></tr>"
        "<tr><td>Al</td><td class=x>KC</td><td>1,024</td></tr><tr><td>Bo<td><td> 7 </table>"
    )
    tables = select_table(spark.createDataFrame([(1, html)], "page int, html string"))
    parsed = table_rows(tables, ["page"])
    assert rows(table_grid(parsed, ["page"])) == [
        (1, 0, 0, True, "Na&me"), (1, 0, 1, True, "Na&me"), (1, 0, 2, True, "Yds"),
        (1, 1, 0, False, "Al"), (1, 1, 1, False, "KC"), (1, 1, 2, False, "1,024"),
        (1, 2, 0, False, "Bo"), (1, 2, 1, False, ""), (1, 2, 2, False, "7"),
    ]
    wide = wide_table(parsed, ["page"], ["name", "team", "yds"])
    assert rows(wide.drop("extra")) == [(1, 1, "Al", "KC", "1,024"), (1, 2, "Bo", "", "7")]


GRIDS = {
    "spans": (
        "<tr><th>A</th><th colspan=2>B</th></tr><tr><td rowspan=3>x</td><td rowspan='2'>y</td><td>1</td></tr>"
        "<tr><td>2</td></tr><tr><td>3</td><td>4</td><td>wide</td></tr><tr><td>end<td>",
        [["A", "B", "B"], ["x", "y", "1"], ["x", "y", "2"], ["x", "3", "4", "wide"], ["end", ""]],
    ),
    "hanging at the end": ("<tr><td>a<td rowspan=2>b<td rowspan=2>c</tr><tr><td>d</tr>", [["a", "b", "c"], ["d", "b", "c"]]),
    "wide and high": ("<tr><td colspan=2 rowspan=2>q</td><td>r</td></tr><tr><td>s</td></tr>", [["q", "q", "r"], ["q", "q", "s"]]),
    "beyond the table": ("<tr><td rowspan=9>a</td></tr>", [["a"]]),
    "very wide": ("<tr><td colspan=1500>a</td></tr>", [["a"] * 1500]),
    "in the middle": (
        "<tr><td>a</td><td>b</td></tr><tr><td rowspan=2>c</td><td>d</td></tr><tr><td>e</td></tr><tr><td>f</td><td>g</td></tr>",
        [["a", "b"], ["c", "d"], ["c", "e"], ["f", "g"]],
    ),
    "twice, plain between": (
        "<tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr><tr><td>d</td><td>e</td></tr><tr><td colspan=2>f</td></tr><tr><td>g</td></tr>",
        [["a", "b"], ["a", "c"], ["d", "e"], ["f", "f"], ["g"]],
    ),
    "long reach from above a later span": (
        "<tr><td rowspan=4>a</td><td>b</td></tr><tr><td colspan=2>c</td></tr><tr><td>d</td></tr><tr><td>e</td></tr><tr><td>f</td></tr>",
        [["a", "b"], ["a", "c", "c"], ["a", "d"], ["a", "e"], ["f"]],
    ),
    "no spans": ("<tr><td title='a>b'>a</td></tr><tr></tr><tr><td>b &lt</td></tr>", [["a"], [], ["b <"]]),
}


@pytest.mark.parametrize("name", GRIDS)
def test_spans_fill_their_places(spark, name):
    inner, wanted = GRIDS[name]
    html = f"<table width=100% cellpadding=2>{inner}</table>"
    tables = select_table(spark.createDataFrame([(1, html)], "page int, html string"))
    got = table_rows(tables, ["page"]).orderBy("row_no").collect()
    assert [[c["text"] for c in r["cells"]] for r in got] == wanted


def test_names_come_from_the_header_and_nothing_is_dropped(spark):
    html = (
        "<table width=100% cellpadding=2><tr><th>Name</th><th>Yds</th><th>Yds</th></tr><tr><td>Al</td><td>1,024</td><td>3</td></tr>"
        "<tr><th>Sub</th><th>total</th><th>x</th></tr><tr><td>Bo</td><td>7</td><td></td><td>more</td><td>still</td></tr></table>"
    )
    rows_ = table_rows(select_table(spark.createDataFrame([(1, html)], "page int, html string")), ["page"])
    wide = wide_table(rows_, ["page"])
    assert wide.columns == ["page", "row_no", "Name", "Yds", "Yds.1", "extra"]
    assert rows(wide.select("row_no", "Name", "Yds", F.array_join("extra", "|"))) == [(1, "Al", "1,024", ""), (2, "Sub", "total", ""), (3, "Bo", "7", "more|still")]
    typed = numeric_columns(wide.where("row_no <> 2"), ["Name", "Yds", "Yds.1"])
    assert dict(typed.dtypes)["Name"] == "string" and dict(typed.dtypes)["Yds"] == dict(typed.dtypes)["Yds.1"] == "double"
    assert rows(typed.select("Yds", "`Yds.1`")) == [(7.0, None), (1024.0, 3.0)]


def test_decode_entities(spark):
    df = spark.createDataFrame([("a&amp;b &#233;&#xE9;&eacute; &bogus; & &#0; &#xD800; &apos;",)], "t string")
    assert df.select(H.decode_entities(F.col("t"))).first()[0] == "a&b ééé &bogus; & &#0; &#xD800; '"


def test_outcome_fixture_has_two_records():
    assert len(expected_records(table(TE_ACTUAL, "sort1"), "sort1", 9, 2015, True)) == 2


def test_broken_tags_do_not_stop_the_job(spark):
    broken = ["<table width=100% cellpadding=2 </table >", "<table width=100% cellpadding=2", "<table <table width=100% cellpadding=2><td>", "", None]
    df = select_table(spark.createDataFrame([(h,) for h in broken], "html string"))
    assert [r["table_html"] for r in df.collect()] == [None, None, "<table width=100% cellpadding=2><td>", None, None]


def test_element_among_many_of_its_kind(spark):
    html = "<div>" * 2000 + "<div class='a b'>x<div>y</div>z</div>" + "</div>" * 2000 + "<div class=b>later</div>"
    df = select_table(spark.createDataFrame([(html,)], "html string"), tag="div", attributes={"class": "b"})
    assert df.first()["table_html"] == "<div class='a b'>x<div>y</div>z</div>"


def test_headers_that_differ_by_page_stay_in_spark(spark, monkeypatch):
    """One header a page: the longest names the columns, and one row comes to the driver."""
    pages = [(i, f"<table><tr><th>day {i}</th><th>x</th></tr><tr><td>{i}</td><td>1</td></tr></table>") for i in range(40)]
    pages.append((99, "<table><tr><th>day</th><th>x</th><th>x</th></tr><tr><td>99</td><td>1</td><td>2</td></tr></table>"))
    parsed = table_rows(spark.createDataFrame(pages, "page int, table_html string"), ["page"])
    kind, gathered = type(parsed), []
    collect = kind.collect

    def counted(frame):
        got = collect(frame)
        gathered.append(len(got))
        return got

    monkeypatch.setattr(kind, "collect", counted)
    wide = wide_table(parsed, ["page"])
    monkeypatch.undo()
    assert wide.columns == ["page", "row_no", "day", "x", "x.1", "extra"] and wide.count() == 41
    assert sum(gathered) <= 1
    assert wide_table(parsed.where("page < 0"), ["page"]).columns == ["page", "row_no", "extra"]


def plain_bodies(html):
    """Cells of class x by walking over all pieces with the number of open tables."""
    pieces = re.split(r"(?i)(?=</?(?:t[dhr]|table|tbody|thead|tfoot)\b)", html)
    levels = [0]
    for p in pieces:
        levels.append(max(0, levels[-1] + bool(re.match(r"(?i)<table\b", p)) - bool(re.match(r"(?i)</table\b", p))))
    out = []
    for i, p in enumerate(pieces):
        if re.match(r"(?i)<td class=x>", p):
            ends = (j for j in range(i + 1, len(pieces)) if levels[j] == levels[i] and not re.match(r"(?i)<table\b", pieces[j]))
            out.append("".join(pieces[i : next(ends, len(pieces))])[len("<td class=x>") :])
    return out


def test_cells_with_tables_in_them_by_definition(spark):
    draw = random.Random(5)
    bits = ["<td class=x>", "<TD class=x>", "</td>", "<td>", "<table>", "<table border=0>", "</table>", "</Table>", "<tr>", "</tr>", "<tbody>", "a", "b", "<i>", "<tables>", "<", " "]
    pages = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 40))) for _ in range(600)]
    got = spark.createDataFrame(enumerate(pages), "i int, html string").select("i", H.cell_bodies(F.col("html"), "td", {"class": "x"}).alias("b")).collect()
    assert {r["i"]: r["b"] for r in got} == {i: plain_bodies(p) for i, p in enumerate(pages)}


def test_a_long_page_of_cells_with_tables_takes_little_time(spark):
    """The walk over 2,500 rows of nested tables, 60,000 pieces; with their number squared it took many minutes."""
    cell = "<td class=x>{}</td><td class=x><table><tr><td title='>'>b</td></tr></table></td>" + "<td class=x>1</td>" * 6
    html = "<table>" + "".join(f"<tr>{cell.format(i)}</tr>" for i in range(2500)) + "</table>"
    df = spark.createDataFrame([(html,)], "html string")
    began = time.monotonic()
    found = df.select(H.cell_bodies(F.col("html"), "td", {"class": "x"}).alias("b")).first()["b"]
    assert time.monotonic() - began < 60
    assert len(found) == 20_000 and found[8:11] == ["1", "<table><tr><td title='>'>b</td></tr></table>", "1"]


def test_rows_of_a_table_are_parsed_once(spark):
    """No filter on what was parsed stands below the projection that parses it, and the head is counted once a page."""
    df = spark.createDataFrame([(1, "<table><tr><td>a</td></tr></table>")], "page int, table_html string")
    plan = table_rows(df, ["page"])._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert filters and not any("regexp_extract_all" in line for line in filters)
    assert "aggregate(_cells" not in plan.split("Generate")[0]
