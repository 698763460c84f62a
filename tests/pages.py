"""A plain reading of ranking pages with the standard library's parser, and pages to read."""

from html.parser import HTMLParser

NBSP = "\u00a0"


class _Cells(HTMLParser):
    """Texts of the wanted cells inside the first wanted table."""

    def __init__(self, cell_class):
        super().__init__(convert_charrefs=True)
        self.cell_class, self.depth, self.done, self.found = cell_class, 0, False, False
        # Open cells as (number, depth of their table).
        self.cells, self.open = [], []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "table":
            wanted = attrs.get("width") == "100%" and attrs.get("cellpadding") == "2"
            if self.depth or (wanted and not self.done):
                self.depth += 1
                self.found = True
        if tag in ("td", "th", "tr"):
            self.open = [c for c in self.open if c[1] < self.depth]
        if tag == "td" and self.depth and self.cell_class in (attrs.get("class") or "").split():
            self.open.append((len(self.cells), self.depth))
            self.cells.append("")

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.open = [c for c in self.open if c[1] < self.depth]
        if tag == "table" and self.depth:
            self.depth -= 1
            self.done = self.done or not self.depth

    def handle_data(self, data):
        for number, _ in self.open:
            self.cells[number] += data


def expected_records(html, cell_class, width, season, outcome):
    parser = _Cells(cell_class)
    parser.feed(html)
    parser.close()
    text = ",".join(c.strip(" ").replace(",", "") for c in parser.cells)
    cells = [c for c in text.replace(f"{NBSP},{NBSP}", "").replace(NBSP, "").split(",") if c]
    records = []
    for i in range(0, len(cells), width):
        record = cells[i : i + width]
        if season is not None:
            record.insert(2, str(season))
        if outcome:
            record[0] = "".join(c for c in record[0] if not c.isdigit()).strip(".").strip(" ")
        for j, cell in enumerate(record):
            try:
                record[j] = str(float(cell))
            except ValueError:
                pass
        records.append(record)
    return records


def table(rows, cell_class, attrs='width="100%" cellpadding="2"'):
    body = "".join("<tr>" + "".join(f'<td class="{cell_class}">{c}</td>' for c in row) + "</tr>" for row in rows)
    return f"<table {attrs}>{body}</table>"


TE_ROWS = [["<a href='/p?a=1,2'>Al Bo</a>", "KC", "7", "80", "1,024.5", "9", "200.5"], ["Cy D&#39;Oh", "FA", "-", "1", "2", "0", "-1.5"]]
TE_ACTUAL = [["1. Al Bo Jr.", "KC", "16", "100", "80", "1,024", "9", "200.5", "12.5"], ["12. Cy&sup2;&nbsp;\u0663", "SD", "1", "2", "1", "2", "0", "1.2", "1.2"]]

PAGES = {
    "plain": ("TE", "projected", table(TE_ROWS, "smallbody")),
    "attributes in any order": ("TE", "projected", table(TE_ROWS, "smallbody", "border=0 CELLPADDING=2 Width='100%'")),
    "outcome with ranks": ("TE", "actual", table(TE_ACTUAL, "sort1")),
    "no-break cells": ("TE", "projected", table([["&nbsp;", *TE_ROWS[0], "&#160;", "&#xa0;"], TE_ROWS[1]], "smallbody")),
    "fused cells": ("TE", "projected", table([["2. Bo&nbsp;", "&nbsp;NO", *TE_ROWS[0][2:], "x"]], "smallbody")),
    "short last record": ("TE", "projected", table([TE_ROWS[0], ["Zed"]], "smallbody")),
    "spaces and lines": ("TE", "projected", table([["  Al \n", "KC", " 7 ", "80 ", "1", "2", "3"]], "smallbody")),
    "several classes": ("TE", "projected", table(TE_ROWS, "odd smallbody wide")),
    "other classes": ("TE", "projected", table(TE_ROWS, "smallbody2")),
    "no table": ("TE", "projected", "<p>nothing</p>" + table(TE_ROWS, "smallbody", "width=50% cellpadding=2")),
    "empty table": ("TE", "projected", table([], "smallbody")),
    "outer table": ("TE", "projected", "<table><tr><td class=smallbody>no</td><td>" + table(TE_ROWS, "smallbody") + "</td></tr></table>"),
    "inner tables": (
        "TE",
        "projected",
        "<table width=100% cellpadding=2><tr><td><table><tr><td class=smallbody>In</td></tr></table></td></tr>"
        + table(TE_ROWS, "smallbody")[len('<table width="100%" cellpadding="2">') :]
        + table([["after"]], "smallbody"),
    ),
    "never closed": ("TE", "projected", table(TE_ROWS, "smallbody")[: -len("</table>")]),
    "implied ends": ("TE", "projected", "<table width=100% cellpadding=2><tr>" + "".join(f"<td class=smallbody>{c}" for c in TE_ROWS[1]) + "</table>"),
    "in a comment": ("TE", "projected", "<!-- " + table([["no"]], "smallbody") + " -->" + table(TE_ROWS, "smallbody")),
    "in a script": ("TE", "projected", "<script>var t='" + table([["no"]], "smallbody") + "';</script>" + table(TE_ROWS, "smallbody")),
    "entities": ("TE", "projected", table([["A&amp;B &eacute;&lt;&unknown; &#x1F600;", "K&nbsp;C", *TE_ROWS[0][2:]]], "smallbody")),
    "sign in an attribute": ("TE", "projected", table([["<i title='a>b'>Al</i>", *TE_ROWS[0][1:]]], 'smallbody" title="x>y').replace("<td class", "<td data-x='1>0' class")),
    "references without semicolon": ("TE", "projected", table([["A&nbspB &amp C &ngeq; &notit; &copy2", *TE_ROWS[0][1:]], ["&nbsp", "&#160", "&#65&#x42", *TE_ROWS[1][1:]]], "smallbody")),
    "text after an inner table": (
        "TE",
        "projected",
        table([["Al <table><tr><td>B.</td><td class=smallbody>in</td></tr></table> tail", "KC", *TE_ROWS[0][2:-1]]], "smallbody"),
    ),
    "tables in tables in cells": (
        "TE",
        "projected",
        table([["<table><tr><td><table><tr><td>deep<tr><td class='smallbody x'>er</table>est</table>", "KC"] * 4], "smallbody"),
    ),
    "quarterback": ("QB", "projected", table([["Q", "KC", *map(str, range(10))]] * 3, "smallbody")),
}
