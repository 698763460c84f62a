"""Near-duplicates by SimHash: every two fingerprints within a few bits, compared exactly.

Distinct fingerprints are dealt out by what two of them within the radius must share: cut into
``blocks`` blocks, they agree on ``blocks - radius`` of these at least. What meets under one such key is
compared as a tile: exclusive-or and bit counts by numpy. A key that holds more than a tile is cut into
tiles by population count, and only pairs of tiles whose counts lie within the radius are compared: the
distance of two words is at least the difference of their counts. Tiles emit spanning stars, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.llm.components import component_roots
from seasonline.session import staged

TILE = 4096
_SMALL = 32


def fingerprint_of(text: str | None, words: int, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, A to Z lower-cased; 0 without words."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxh64_intdigest(b" ".join(parts), seed)
    n = len(parts) - words + 1
    line = b" ".join(parts)
    starts = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    firsts, ends = starts[:n].tolist(), (starts[words:] - 1).tolist()
    hashes = [xxh64_intdigest(line[a:b], seed) for a, b in zip(firsts, ends, strict=True)]
    return majority(np.array(hashes, dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, len(hashes), 8192):
        block = hashes[low : low + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, words: int) -> Column:
    """The fingerprint of a text column as a signed 64-bit integer."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint_of(t, words) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return of(text)


def _keys(blocks: int, radius: int) -> list[Column]:
    """One number per choice of the blocks that must agree, with the choice's own number on top."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = 0
        for b in chosen:
            mask |= ((1 << (edges[b + 1] - edges[b])) - 1) << edges[b]
        signed = mask - (1 << 64) if mask >> 63 else mask
        # The masked word itself names the key; hashing in the choice's number keeps choices apart.
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed))))
    return keys


def _stars(words: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """(first, member) for every member of a linked group in the tile, by breadth-first search."""
    counts = np.bitwise_count(words)
    order = np.argsort(counts, kind="stable")
    left, left_counts = words[order], counts[order].astype(np.int16)
    while len(left):
        root, queue = left[0], [(left[0], int(left_counts[0]))]
        left, left_counts = left[1:], left_counts[1:]
        while queue and len(left):
            word, count = queue.pop()
            # Rows are in order of population count: only this slice can be within the radius.
            low, high = np.searchsorted(left_counts, [count - radius, count + radius + 1])
            near = np.flatnonzero(np.bitwise_count(left[low:high] ^ word) <= radius) + low
            if len(near):
                for at in near.tolist():
                    queue.append((left[at], int(left_counts[at])))
                    yield int(root), int(left[at])
                keep = np.ones(len(left), dtype=bool)
                keep[near] = False
                left, left_counts = left[keep], left_counts[keep]


def _links(radius: int):
    """Links within each run of equal units of a sorted partition."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            a, b = a.view(np.int64), b.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def tiles(units: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
            sizes = np.diff(np.r_[starts, len(units)])
            small = np.repeat((sizes <= _SMALL) & (sizes > 1), sizes)
            small_units, small_words = units[small], words[small]
            for step in range(1, int(sizes[sizes <= _SMALL].max(initial=1))):
                same = small_units[step:] == small_units[:-step]
                near = same & (np.bitwise_count(small_words[step:] ^ small_words[:-step]) <= radius)
                if near.any():
                    yield emit(small_words[:-step][near], small_words[step:][near])
            for start, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
                found = list(_stars(words[start : start + size], radius))
                if found:
                    pairs = np.array(found, dtype=np.uint64)
                    yield emit(pairs[:, 0].copy(), pairs[:, 1].copy())

        held_units, held_words = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            units = np.r_[held_units, batch.column(0).to_numpy()]
            words = np.r_[held_words, batch.column(1).to_numpy().view(np.uint64)]
            if not len(units):
                continue
            whole = int(np.searchsorted(units, units[-1]))  # the last unit may go on in the next batch
            if whole:
                yield from tiles(units[:whole], words[:whole])
            held_units, held_words = units[whole:], words[whole:]
        if len(held_units):
            yield from tiles(held_units, held_words)

    return links


def near_links(distinct: DataFrame, radius: int = 3, blocks: int = 5, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join all within ``radius`` bits.

    Not every near pair is a row, but every near pair is joined by a path of rows, and every row lies
    within a group so joined.
    """
    rows = distinct.select("fp", F.explode(F.array(*_keys(blocks, radius))).alias("key"))
    # Keys with more than one tile, counted after partial sums; few, as each takes over ``tile`` rows.
    crowded = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile)
    by_count = (
        rows.join(crowded.select("key"), "key", "left_semi")
        .groupBy("key", F.bit_count("fp").alias("pop"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("key", "pop", F.ceil(F.col("n") / F.lit(tile // 2)).cast("int").alias("slices"))
    )
    by_count = staged(by_count, "tiles")
    # A tile is a slice of one count's rows; it meets itself and the tiles of counts within the radius.
    other = by_count.select("key", F.col("pop").alias("pop_b"), F.col("slices").alias("slices_b"))
    meets = (
        by_count.join(other, "key")
        .where(F.abs(F.col("pop") - F.col("pop_b")) <= radius)
        .groupBy("key", "pop", "slices")
        .agg(F.collect_list(F.struct("pop_b", "slices_b")).alias("others"))  # at most 2 * radius + 1
    )
    spread = (
        rows.withColumn("pop", F.bit_count("fp"))
        .join(meets, ["key", "pop"], "left")
        .withColumn("slice", F.when(F.col("slices").isNotNull(), F.pmod(F.xxhash64(F.lit("slice"), "fp"), F.col("slices"))))
    )
    plain = spread.where(F.col("slices").isNull()).select(F.col("key").alias("unit"), "fp")
    tiles = (
        spread.where(F.col("slices").isNotNull())
        .select("*", F.explode("others").alias("o"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("o.slices_b") - 1)).alias("slice_b"))
    )
    mine = F.struct(F.col("pop"), F.col("slice").cast("int").alias("slice"))
    its = F.struct(F.col("o.pop_b").alias("pop"), F.col("slice_b").cast("int").alias("slice"))
    paired = tiles.select(F.xxhash64("key", F.least(mine, its), F.greatest(mine, its)).alias("unit"), "fp")
    dealt = plain.unionByName(paired).repartition(F.col("unit")).sortWithinPartitions("unit")
    return dealt.mapInArrow(_links(radius), "a long, b long")


def near_groups(
    docs: DataFrame, *, words: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text", blocks: int | None = None
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    The fingerprint is the SimHash of ``words``-word shingles; a null text or one without words has
    fingerprint zero and is linked like any other. Rows are linked if their fingerprints differ in at most
    ``radius`` bits; component_id is the smallest document id that can be reached (null if all reached
    have none). Repeated rows each give a row; an empty table gives none; other columns of ``docs`` are
    not read.
    """
    prints = staged(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), words).alias("fp")), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = staged(distinct, "distinct")
    links = staged(near_links(distinct.select("fp"), radius, blocks or radius + 2), "links")
    roots = component_roots(links)  # node, root: only of fingerprints with a link
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    placed = staged(placed, "placed")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
