"""Record layouts: which field stands where, per position and kind."""

from __future__ import annotations

from dataclasses import dataclass

PROJECTED = "projected"
ACTUAL = "actual"
KINDS = (PROJECTED, ACTUAL)

# The field order of the published files, as in the source data. ------------
IDENTIFIERS = ("Name", "Team", "Yr")
PROJECTED_FIELDS = {
    "QB": ("Name", "Team", "Yr", "Bye", "Comp", "Pass Att", "Pass Yds", "Pass TDs", "Int", "Rush Att", "Rush Yds", "Rush TDs", "FPts"),
    "RB": ("Name", "Team", "Yr", "Bye", "Rush Att", "Rush Yds", "Rush TDs", "Rec", "Rec Yds", "Rec TDs", "FPts"),
    "WR": ("Name", "Team", "Yr", "Bye", "Rec", "Rec Yds", "Rec TDs", "Rush Att", "Rush Yds", "Rush TDs", "FPts"),
    "TE": ("Name", "Team", "Yr", "Bye", "Rec", "Rec Yds", "Rec TDs", "FPts"),
}
ACTUAL_FIELDS = {
    "QB": ("Name", "Team", "Yr", "GP", "Comp", "Pass Att", "Pass Yds", "Pass TDs", "Int", "Rush Att", "Rush Yds", "Rush TDs", "FPts", "FPPG"),
    "RB": ("Name", "Team", "Yr", "GP", "Rush Att", "Rush Yds", "Rush TDs", "Rec Tgts", "Rec", "Rec Yds", "Rec TDs", "FPts", "FPPG"),
    "WR": ("Name", "Team", "Yr", "GP", "Rec Tgts", "Rec", "Rec Yds", "Rec TDs", "Rush Att", "Rush Yds", "Rush TDs", "FPts", "FPPG"),
    "TE": ("Name", "Team", "Yr", "GP", "Rec Tgts", "Rec", "Rec Yds", "Rec TDs", "FPts", "FPPG"),
}
POSITION_IDS = {"10": "QB", "20": "RB", "30": "WR", "40": "TE"}
TABLE_ATTRIBUTES = {"width": "100%", "cellpadding": "2"}
CELL_CLASS = {PROJECTED: "smallbody", ACTUAL: "sort1"}
OLD_CELL_CLASS = {PROJECTED: "sort1", ACTUAL: "sort1"}
UNUSED_ACTUAL = ("FPPG", "Rec Tgts")
# ------------------------------------------------------------------------------------------

INTEGERS = frozenset({"Yr", "Bye", "GP"})
TEXTS = frozenset({"Name", "Team"})


@dataclass(frozen=True)
class Layout:
    """Positional fields of one (position, kind).

    ``season`` names the field that older files leave out, and ``dropped`` the fields that
    are read but not kept.
    """

    position: str
    kind: str
    fields: tuple[str, ...]
    season: str = "Yr"
    dropped: tuple[str, ...] = ()
    integers: frozenset[str] = INTEGERS
    texts: frozenset[str] = TEXTS

    @property
    def width(self) -> int:
        return len(self.fields)

    @property
    def page_width(self) -> int:
        """Cells per record on a page, where the season is not shown."""
        return self.width - 1

    @property
    def kept(self) -> tuple[str, ...]:
        return tuple(f for f in self.fields if f not in self.dropped)

    def type_of(self, field: str) -> str:
        if field in self.texts:
            return "string"
        return "int" if field in self.integers else "double"


LAYOUTS: dict[tuple[str, str], Layout] = {
    **{(p, PROJECTED): Layout(p, PROJECTED, f) for p, f in PROJECTED_FIELDS.items()},
    **{(p, ACTUAL): Layout(p, ACTUAL, f, dropped=UNUSED_ACTUAL) for p, f in ACTUAL_FIELDS.items()},
}
POSITIONS = tuple(PROJECTED_FIELDS)


def stat_list(position: str, *, with_points: bool = True) -> tuple[str, ...]:
    """The stats of a position, without identifiers and bye; ``FPts`` is the forecast's points."""
    stats = PROJECTED_FIELDS[position][len(IDENTIFIERS) + 1 :]
    return stats if with_points else stats[:-1]


def all_fields(layouts: dict[tuple[str, str], Layout] = LAYOUTS) -> dict[str, str]:
    """Every kept field with its type, in first-seen order: the columns of the common table."""
    fields: dict[str, str] = {}
    for layout in layouts.values():
        for f in layout.kept:
            fields.setdefault(f, layout.type_of(f))
    return fields
