"""Pieces of HTML as column expressions: elements, cells, text.

Everything works on one page's string at a time inside the JVM; nothing is shuffled.
A cell ends where HTML ends it: at its closing tag, or at the next cell or row tag of its own
table. The text of a table inside a cell is part of the cell's text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import cache
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = "\u00a0"

_COMMENT_OR_CODE = r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)"
# What stands in a tag after its name: a ">" in a quoted value does not end it.
_REST = r"""[^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+"""
_BEFORE = r"""[^>"']*?(?:"[^"]*"[^>"']*?|'[^']*'[^>"']*?)*?"""
_TAG = rf"(?s)</?[a-zA-Z]{_REST}>"
_REFERENCE = "&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[a-zA-Z][a-zA-Z0-9]*;?"
_TOKEN = rf"(?s){_REFERENCE}|[^&]+|&"


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles, whose text may look like tags."""
    return F.regexp_replace(html, _COMMENT_OR_CODE, "")


def _attribute(name: str, value: str) -> str:
    """Pattern that looks ahead in a start tag for an attribute, in any order and quoting."""
    v = re.escape(value)
    return rf"(?={_BEFORE}\s{name}\s*=\s*(?:\"{v}\"|'{v}'|{v}(?=[\s>])))"


def _with_class(value: str) -> str:
    """As :func:`_attribute` for one name in a list of classes."""
    v = re.escape(value)
    return (
        rf"(?={_BEFORE}\sclass\s*=\s*(?:\"(?:[^\">]*\s)??{v}(?:\s[^\">]*)?\"|'(?:[^'>]*\s)??{v}(?:\s[^'>]*)?'|{v}(?=[\s>])))"
    )


def start_tag_pattern(tag: str, attributes: Mapping[str, str] | None = None) -> str:
    """Pattern of a start tag that carries all the given attributes."""
    looks = [
        _with_class(value) if name == "class" else _attribute(name, value)
        for name, value in (attributes or {}).items()
    ]
    return rf"(?is)<{tag}\b{''.join(looks)}{_REST}>"


def first_element(html: Column, tag: str, attributes: Mapping[str, str] | None = None) -> Column:
    """The first element with the given tag and attributes, with all it contains; NULL if none.

    The page is cut before each start or end tag of that name. Walking the pieces from the
    first match, the depth goes up and down and the element ends where it returns to zero
    (or with the page, when it is never closed).
    """
    wanted, opens, closes = start_tag_pattern(tag, attributes), rf"(?i)^<{tag}\b", rf"(?i)^</{tag}\b"

    def marked(head: Column) -> Column:
        return F.struct(
            head.rlike("^" + wanted).alias("wanted"), head.rlike(opens).alias("opens"), head.rlike(closes).alias("closes")
        )

    def span(heads: Column) -> Column:
        """One-based numbers of the first piece and of the one that closes it; 0 where there is none."""
        start = F.struct(*[F.lit(0).alias(c) for c in ("at", "depth", "first", "last")])

        def step(s: Column, piece: Column) -> Column:
            at, inside = s["at"] + 1, (s["first"] > 0) & (s["last"] == 0)
            enters, ends = (s["first"] == 0) & piece["wanted"], inside & piece["closes"]
            deeper = F.when(enters | (inside & piece["opens"]), 1).when(ends, -1).otherwise(0)
            return F.struct(
                at.alias("at"),
                (s["depth"] + deeper).alias("depth"),
                F.when(enters, at).otherwise(s["first"]).alias("first"),
                F.when(ends & (s["depth"] == 1), at).otherwise(s["last"]).alias("last"),
            )

        return F.aggregate(F.transform(heads, marked), start, step)

    def element(pieces: Column) -> Column:
        heads = F.transform(pieces, lambda p: F.regexp_extract(p, rf"^</?[a-zA-Z]{_REST}>", 0))
        return bind(
            heads,
            lambda heads: bind(
                span(heads),
                lambda s: F.when(
                    s["first"] > 0,
                    F.concat(
                        F.array_join(F.slice(pieces, s["first"], after(s) - s["first"]), ""),
                        F.coalesce(F.get(heads, s["last"] - 1), F.lit("")),
                    ),
                ),
            ),
        )

    def after(s: Column) -> Column:
        """The piece after the element's last whole one: the closing one, or one past the page."""
        return F.when(s["last"] > 0, s["last"]).otherwise(s["at"] + 1)

    # A page without the start tag needs no walk.
    return F.when(html.rlike(wanted), bind(F.split(html, rf"(?i)(?=</?{tag}\b)"), element))


def up_to(tags: str) -> str:
    """Pattern of the text up to the next start or end tag of the given names, or to the end of the page."""
    return rf"[^<]*+(?:<(?!/?{tags}\b)[^<]*+)*+"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), lambda v: use(v)), 1)


def cell_bodies(html: Column, tag: str = "td", attributes: Mapping[str, str] | None = None) -> Column:
    """Inner HTML of every ``tag`` element, in page order; an empty array where there is none.

    A table cell holds the tables in it as a whole, and their marked cells count as well.
    """
    name = tag if "|" not in tag else f"(?:{tag})"
    start = start_tag_pattern(name, attributes)
    if tag in ("td", "th", "td|th"):
        body = up_to("(?:t[dhr]|table|tbody|thead|tfoot)")
        found = F.regexp_extract_all(html, F.lit(rf"{start}({body}(?:<table\b)?)"), F.lit(1))
        # The match of a cell that holds a table ends in that table's tag, and no other does. Only then is the walk
        # through the levels needed.
        found = bind(
            found,
            lambda cells: F.when(
                F.exists(cells, lambda c: F.lower(F.substring(c, -6, 6)) == "<table"), _nested_bodies(html, start)
            ).otherwise(cells),
        )
    else:
        found = F.regexp_extract_all(html, F.lit(f"{start}({up_to(f'(?:{tag})')})"), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def _nested_bodies(html: Column, start: str) -> Column:
    """Cell bodies where tables hold tables: a cell ends at the next tag of its own table's level that opens no table.

    The page is cut before every tag of a table. Only start and end tags of tables change the level, so only over these
    the levels are added up; the pieces are then sorted by level, where the one after a cell is the one that ends it.
    """
    opens, closes = r"(?i)^<table\b", r"(?i)^</table\b"

    def level_before(levels: Column, stretch: Column) -> Column:
        """Appends how many tables are open after the tag that a stretch begins with."""
        step = F.when(stretch.rlike(opens), 1).when(stretch.rlike(closes), -1).otherwise(0)
        return F.concat(levels, F.array(F.greatest(F.element_at(levels, -1) + step, F.lit(0))))

    def pieces(stretches: Column, levels: Column) -> Column:
        """Every piece with its level; the first of a stretch is the one that may open or close a table."""

        def cut(stretch: Column, k: Column) -> Column:
            return F.transform(
                F.split(stretch, r"(?i)(?=</?(?:t[dhr]|tbody|thead|tfoot)\b)"),
                lambda piece, j: F.struct(
                    F.get(levels, k + F.when(j > 0, 1).otherwise(0)).alias("level"),
                    ((j == 0) & piece.rlike(opens)).alias("opens"),
                    piece.rlike("^" + start).alias("wanted"),
                    piece.alias("text"),
                ),
            )

        return F.flatten(F.transform(stretches, cut))

    def bodies(pieces: Column) -> Column:
        texts = F.transform(pieces, lambda p: p["text"])
        placed = F.transform(
            pieces, lambda p, i: F.struct(p["level"].alias("level"), (i + 1).alias("at"), p["opens"].alias("opens"), p["wanted"].alias("wanted"))
        )
        ending = F.sort_array(F.filter(placed, lambda p: ~p["opens"]))
        past = F.size(pieces) + 1
        spans = F.zip_with(
            ending,
            F.slice(ending, F.lit(2), F.size(ending)),
            lambda p, after: F.when(
                p["wanted"],
                F.struct(p["at"].alias("at"), F.when(after["level"] == p["level"], after["at"]).otherwise(past).alias("end")),
            ),
        )
        cells = F.sort_array(F.filter(spans, lambda c: c.isNotNull()))
        return bind(
            texts,
            lambda texts: F.transform(
                cells, lambda c: F.regexp_replace(F.array_join(F.slice(texts, c["at"], c["end"] - c["at"]), ""), "^" + start, "")
            ),
        )

    return bind(
        F.split(html, r"(?i)(?=</?table\b)"),
        lambda stretches: bind(
            F.aggregate(stretches, F.array(F.lit(0)), level_before),
            lambda levels: bind(pieces(stretches, levels), bodies),
        ),
    )


def cell_texts(bodies: Column) -> Column:
    """The texts of cells: no tags, entities decoded, spaces trimmed, thousands commas removed.

    Only spaces are trimmed: a no-break space or a line end stays.
    """
    return F.transform(plain_texts(bodies), lambda t: F.replace(F.trim(t), F.lit(","), F.lit("")))


def plain_texts(bodies: Column) -> Column:
    """The texts of cells as they stand: no tags, entities decoded, each different reference once for all cells."""
    bare = F.transform(bodies, lambda b: F.when(F.contains(b, F.lit("<")), F.regexp_replace(b, _TAG, "")).otherwise(b))
    return bind(bare, _decoded)


def decode_entities(text: Column) -> Column:
    """Named and numeric character references replaced as browsers do; unknown ones are left alone.

    A reference may lack its semicolon where HTML allows that: a number, and the older names, of which
    the longest that fits counts.
    """
    return F.get(_decoded(F.array(text)), F.lit(0))


def _decoded(texts: Column) -> Column:
    """:func:`decode_entities` of every text."""
    marked = F.filter(texts, lambda t: F.contains(t, F.lit("&")))
    references = F.array_distinct(F.flatten(F.transform(marked, lambda t: F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(0)))))
    known = F.map_from_entries(F.transform(references, lambda r: F.struct(r, _decode_token(r))))

    def replaced(known: Column) -> Column:
        def parts(text: Column) -> Column:
            return F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), lambda p: F.coalesce(F.try_element_at(known, p), p))

        return F.transform(texts, lambda t: F.when(F.contains(t, F.lit("&")), F.array_join(parts(t), "")).otherwise(t))

    return F.when(F.size(marked) > 0, bind(known, replaced)).otherwise(texts)


def _decode_token(token: Column) -> Column:
    code = F.when(
        F.lower(F.substring(token, 1, 3)) == "&#x",
        F.conv(F.regexp_extract(token, r"^&#[xX]([0-9a-fA-F]+);?$", 1), 16, 10),
    ).when(F.substring(token, 1, 2) == "&#", F.regexp_extract(token, r"^&#([0-9]+);?$", 1))
    code = code.try_cast("int")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    numeric = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    # A literal for the optimiser, which works it out once.
    names = F.str_to_map(F.lit(_entity_names()), F.lit("\x01"), F.lit("\x02"))
    named = F.try_element_at(names, token)
    older = F.regexp_extract(token, _older_names(), 1)
    prefixed = F.when(
        older != "", F.concat(F.try_element_at(names, older), F.substring(token, F.length(older) + 1, F.length(token)))
    )
    return F.when(valid, numeric).when(token.rlike("^&[a-zA-Z]"), F.coalesce(named, prefixed, token)).otherwise(token)


@cache
def _entity_names() -> str:
    """All names of the standard library's table as one text; those of HTML 4 first, as they are met most."""
    order = sorted(html5, key=lambda name: name.rstrip(";") not in name2codepoint)
    return "\x01".join(f"&{name}\x02{html5[name]}" for name in order)


@cache
def _older_names() -> str:
    """Pattern of the names that need no semicolon, the longest first."""
    names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return f"^(&(?:{'|'.join(names)}))"
