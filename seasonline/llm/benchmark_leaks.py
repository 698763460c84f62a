"""Benchmark decontamination in DataFrame operations alone.

Item-sized windows of a document get a SimHash over their words. Fingerprints of windows and items of
one size meet in a multi-index: cut into ``radius + 1`` blocks, two fingerprints within the radius agree
on one block at least, so all such pairs are found. Pairs beyond the radius, such as of a copy that is cut
at its ends, meet by shingles: of two sequences as similar as asked, the beginnings of the sorted shingles
share one. Then the exact weighted Jaccard similarity of the five-word shingles, weighted by how often
each occurs, decides; so no pair is lost to the fingerprints.

A window that can pass the last test shares a shingle with the item. So windows are laid only where a
shingle of the document is one of an item's, at the place that puts the two shingles over each other.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonline.session import staged

SHINGLE = 5
RADIUS = 13

# Up to so many rows of three numbers (24 MB) are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

# Windows that start within so many words of a document are gathered in one row.
STRETCH = 4096


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column, length: int = SHINGLE) -> Column:
    """Hashes of the word shingles in order; a shorter sequence is one shingle, an empty one has none."""
    return _let(
        words,
        lambda ws: F.when(
            F.size(ws) > 0,
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - (length - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(ws, i, length))),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def simhash_of(words: Column) -> Column:
    """The 64-bit SimHash of a word array: the bits set in more than half of the words' hashes."""

    def majority(hashes: Column) -> Column:
        def with_bit(bits: Column, at: Column) -> Column:
            n_set = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, at).cast("int"))
            return bits.bitwiseOR(F.call_function("shiftleft", (2 * n_set > F.size(hashes)).cast("long"), at))

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), with_bit)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), majority)


def _masks(radius: int) -> list[int]:
    """Signed masks of ``radius + 1`` blocks of the 64 bits."""
    edges = [64 * b // (radius + 1) for b in range(radius + 2)]
    masks = [((1 << (z - a)) - 1) << a for a, z in zip(edges, edges[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _blocks(fingerprint: Column, masks: list[int]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(b).alias("block"), fingerprint.bitwiseAND(F.lit(m).cast("long")).alias("bits"))
            for b, m in enumerate(masks)
        ]
    )


def beginning_of(shingles: Column, similarity: float) -> Column:
    """As many of the sorted shingles as have one in common with those of any sequence so similar.

    Such a sequence holds ``similarity`` of the shingles at least, so it cannot miss more than the rest.
    """
    needed = F.ceil(F.lit(similarity) * F.size(shingles) - F.lit(1e-9)).cast("int")
    return F.array_distinct(F.slice(F.sort_array(shingles), F.lit(1), F.greatest(F.size(shingles) - needed + 1, F.lit(1))))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Shared over joint weight of two shingle arrays, a shingle weighing as often as it occurs."""

    def times(shingles: Column, s: Column) -> Column:
        return F.size(F.filter(shingles, lambda x: x == s))

    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    shared = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(
        F.aggregate(F.array_distinct(b), F.lit(0), lambda n, s: n + F.least(times(a, s), times(b, s)))
    )
    return _let(shared, lambda n: n / (F.size(a) + F.size(b) - n))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    similarity: float = 0.8,
    radius: int = RADIUS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc, mark, item_id, start_word, similarity): the documents that hold an item, and its best window.

    ``doc`` is the document's id and ``mark`` the hash of its text: rows equal in both are one document.
    Words are runs of letters and digits without case. Equal similarities: the earliest window. An item
    without words leaks nowhere; an item of fewer than five words is one shingle. A null text has no
    words, a null document or item id stands for itself; items repeated word for word give a row each.
    Empty tables give no rows.
    """
    items = staged(
        items.select(F.col(item_id).alias("item_id"), words_of(F.col(item_text)).alias("words"))
        .where(F.size("words") > 0)
        .select("item_id", F.size("words").alias("n"), simhash_of(F.col("words")).alias("fp"), shingles_of(F.col("words")).alias("shingles")),
        "items",
    )
    wanted = staged(
        items.select("n", F.posexplode("shingles").alias("offset", "shingle")).distinct(),
        "item-shingles",
    )
    slim = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    # Items of fewer words than a shingle are looked for by as many; there are five lengths at most.
    lengths = [r["n"] for r in items.select(F.least("n", F.lit(SHINGLE)).alias("n")).distinct().collect()]
    places = [
        slim.select("doc", "mark", F.posexplode(shingles_of(words_of(F.col("text")), length)).alias("place", "shingle"))
        for length in sorted(lengths) or [SHINGLE]
    ]
    held = reduce(DataFrame.unionByName, places)
    windows = staged(
        held.join(few, "shingle").select("doc", "mark", (F.col("place") - F.col("offset")).alias("start"), "n").distinct(),
        "windows",
    )
    # A stretch's windows: as many as its words times the sizes of items at most.
    laid = staged(
        windows.groupBy("doc", "mark", F.floor(F.col("start") / STRETCH).alias("stretch")).agg(F.collect_list(F.struct("start", "n")).alias("windows")),
        "laid",
    )
    low = F.greatest("w.start", F.lit(0))
    met = slim.alias("d").join(
        laid.alias("l"), F.col("d.doc").eqNullSafe(F.col("l.doc")) & (F.col("d.mark") == F.col("l.mark"))
    )
    # One row a window before its words are cut out, so that no row holds the words of several.
    each = met.select(F.col("d.doc").alias("doc"), F.col("d.mark").alias("mark"), words_of(F.col("text")).alias("all"), "windows")
    each = each.select("doc", "mark", "all", F.explode("windows").alias("w"))
    sliced = each.select("doc", "mark", "w.start", "w.n", F.slice("all", low + 1, F.col("w.start") + F.col("w.n") - low).alias("words"))
    prints = staged(
        sliced.select("doc", "mark", "start", "n", simhash_of(F.col("words")).alias("fp"), shingles_of(F.col("words")).alias("held")),
        "window-prints",
    )
    masks = _masks(radius)
    indexed = prints.select("*", F.explode(_blocks(F.col("fp"), masks)).alias("b")).select(
        "doc", "mark", "start", "n", "held", "fp", "b.block", "b.bits"
    )
    index = items.select(
        "item_id", "n", "shingles", F.col("fp").alias("item_fp"), F.explode(_blocks(F.col("fp"), masks)).alias("b")
    ).select("item_id", "n", "shingles", "item_fp", "b.block", "b.bits")
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    # A pair may agree on several blocks; the first of these gives the row.
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(b)) for b, m in enumerate(masks)])
    near = indexed.join(index, ["n", "block", "bits"]).where((F.bit_count(differ) <= radius) & (first == F.col("block")))
    begun = prints.withColumn("begun", beginning_of(F.col("held"), similarity)).select("*", F.explode("begun").alias("shingle"))
    asked = items.withColumn("asked", beginning_of(F.col("shingles"), similarity)).select(
        "item_id", "n", "shingles", "asked", F.col("fp").alias("item_fp"), F.explode("asked").alias("shingle")
    )
    # A pair may share several shingles; the smallest of these gives the row.
    smallest = F.array_min(F.array_intersect("begun", "asked"))
    beyond = begun.join(asked, ["n", "shingle"]).where((F.bit_count(differ) > radius) & (smallest == F.col("shingle")))
    pairs = [f.select("doc", "mark", "item_id", "start", "held", "shingles") for f in (near, beyond)]
    scored = reduce(DataFrame.unionByName, pairs).select(
        "doc", "mark", "item_id", "start", weighted_jaccard(F.col("held"), F.col("shingles")).alias("similarity")
    ).where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.greatest("start", F.lit(0))).alias("before")))
    return scored.groupBy("doc", "mark", "item_id").agg(best.alias("best")).select(
        "doc", "mark", "item_id", (-F.col("best.before")).cast("long").alias("start_word"), F.col("best.similarity").alias("similarity")
    )


def without_leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item; rules as in ``find_leaks``, all columns are kept."""
    leaks = staged(find_leaks(docs, items, doc_id=doc_id, text=text, **options).select("doc", "mark").distinct(), "leaks")
    same = docs[doc_id].eqNullSafe(leaks["doc"]) & (F.xxhash64(docs[text]) == leaks["mark"])
    return docs.join(leaks, same, "left_anti")
