"""Substring deduplication by sliding spans of sentences and windows of words.

Every run of consecutive sentences that is as short as a length in words allows, from each sentence
forward and from each sentence back, is hashed; equal hashes meet in one global join; and sentences that
lie in any span but the first of its kind are removed.

Windows of words find what starts or ends inside a sentence. Of the shorter word runs in a window the one
with the smallest hash is its anchor; equal windows have equal anchors. An anchor is hashed with all words
that a window around it can have: where these recur, so does every window in them. Only around anchors met
with different words beside them windows are hashed as a whole, so none that recurs is lost.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.llm.common import free_name
from seasonline.session import staged

# Signs and what may close a quotation before white space, or a line feed. It begins with one set of signs, for which a
# text is searched much faster than for either of two patterns.
_END = re.compile(r"[.!?\n](?:(?<=\n)\s*|(?<!\n)[.!?]*[\"')\]]*\s+)")
_WORD = re.compile(r"\S+")

# What a place is: ``last`` of a span of sentences is its last sentence, and one of these for the others. An
# anchor is near if it stands, with the same words around it, less than a window before.
_WINDOW, _ANCHOR, _NEAR = -1, -2, -3
# Words hashed at once, which bounds the arrays.
_STRETCH = 1 << 15
# And bytes.
_BYTES = 1 << 18
# Characters of documents that are worked on together; a longer one stands alone. They are no more words than a stretch.
_GROUP = 1 << 15
_FACTOR = 0x9E3779B97F4A7C15


def _edges(text: str) -> list[int]:
    """Where the sentences of a text begin, and its end."""
    edges = [0, *[m.end() for m in _END.finditer(text)]]
    if edges[-1] < len(text):
        edges.append(len(text))
    return edges


def sentences(text: str) -> list[str]:
    """The sentences of a text with the white space after them; joined they are the text again."""
    return [text[a:b] for a, b in pairwise(_edges(text))]


class Words(NamedTuple):
    """The words in small letters of a document, or of several one after the other, as one line of bytes, one blank between
    two: their starts and ends in it, the number of words before each sentence and in all, and the first sentence of each
    document and their number."""

    line: bytes
    starts: np.ndarray
    ends: np.ndarray
    before: np.ndarray
    heads: np.ndarray


# White space up to the last sign that is; what lies beyond is none.
_SPACES = np.array([chr(i).isspace() for i in range(0x3002)])


_SPACE_BYTES = bytes(_SPACES[:256])


def _white(joined: str | bytes) -> np.ndarray:
    """Which characters are white space; a text as bytes is Latin-1."""
    if isinstance(joined, bytes):
        return np.frombuffer(joined.translate(_SPACE_BYTES), dtype=bool)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _SPACES[np.minimum(codes, len(_SPACES) - 1)]


def _words(*texts: str) -> Words:
    joined = "\n".join(texts)
    edges, heads, base = [], [0], 0
    for text in texts:
        own = _edges(text)
        # The last edge is the next document's first: between them there are no words.
        edges += own[:-1] if not base else [e + base for e in own[:-1]]
        heads.append(len(edges))
        base += len(text) + 1
    edges.append(len(joined))
    try:
        opens = ~_white(joined.encode("latin-1"))
    except UnicodeEncodeError:
        opens = ~_white(joined)
    opens[1:] &= ~opens[:-1]
    line = " ".join(joined.lower().split()).encode()
    before = opens.nonzero()[0].searchsorted(edges)
    if not line:
        none = np.zeros(0, dtype=np.int64)
        return Words(line, none, none, before, np.array(heads))
    blanks = (np.frombuffer(line, np.uint8) == 32).nonzero()[0]
    return Words(line, np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(line)]]), before, np.array(heads))


def _groups(texts: list[str | None]) -> Iterator[tuple[np.ndarray, Words]]:
    """Texts that are not empty, several short ones at once: their places in the list, and their words. Texts beyond Latin-1
    go together, as it takes longer to find their white space."""
    held: dict[bool, list[int]] = {False: [], True: []}
    sizes = {False: 0, True: 0}
    for i, text in enumerate(texts):
        if not text:
            continue
        try:
            beyond = not text.isascii() and not text.encode("latin-1")
        except UnicodeEncodeError:
            beyond = True
        if held[beyond] and sizes[beyond] + len(text) > _GROUP:
            yield np.array(held[beyond]), _words(*[texts[j] for j in held[beyond]])
            held[beyond], sizes[beyond] = [], 0
        held[beyond].append(i)
        sizes[beyond] += len(text)
    for own in held.values():
        if own:
            yield np.array(own), _words(*[texts[j] for j in own])


def spans(parts: list[str], least: int, alone: int, shortest: int = 2) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """First sentence, last sentence and normalised text of each span of a document.

    From each sentence on, and back from each, the shortest run of at least ``shortest`` sentences and
    ``least`` words; and each sentence of ``alone`` words or more by itself.
    """
    words = _words("".join(parts))
    found = _spans(words, least, alone, shortest)
    return found.first, found.last, _texts(words, found)


class Spans(NamedTuple):
    """Spans of documents: first and last sentence, first and last word, and how many sentences of no words stand at
    either end (none: no span has any). A span with such sentences is another one than that without them."""

    first: np.ndarray
    last: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    leads: np.ndarray | None
    trails: np.ndarray | None


def _spans(words: Words, least: int, alone: int, shortest: int = 2) -> Spans:
    total = words.before
    n = len(total) - 1
    at = np.arange(n)
    last = np.maximum(total.searchsorted(total[:-1] + least) - 1, at + shortest - 1)
    first = np.minimum(total.searchsorted(total[1:] - least, side="right") - 1, at - shortest + 1)
    heads = words.heads
    sizes = heads[1:] - heads[:-1]
    onward, back, single = last < np.repeat(heads[1:], sizes), first >= np.repeat(heads[:-1], sizes), total[1:] - total[:-1] >= alone
    keys = np.concatenate([(at * n + last)[onward], (first * n + at)[back], (at * (n + 1))[single]])
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    first, last = np.divmod(keys, max(n, 1))
    begin, end = total[first], total[last + 1] - 1
    empty = total[1:] == total[:-1]
    if not empty.any():
        return Spans(first, last, begin, end, None, None)
    following = np.minimum.accumulate(np.where(empty, n, at)[::-1])[::-1]
    preceding = np.maximum.accumulate(np.where(empty, -1, at))
    return Spans(first, last, begin, end, following[first] - first, last - preceding[last])


def _texts(words: Words, found: Spans) -> list[bytes]:
    """The normalised text of each span."""
    line = words.line
    texts = [line[a:z] for a, z in zip(words.starts[found.begin].tolist(), words.ends[found.end].tolist(), strict=True)]
    if found.leads is None:
        return texts
    return [b" " * i + t + b" " * j for i, t, j in zip(found.leads.tolist(), texts, found.trails.tolist(), strict=True)]


def _hashes(found: list[bytes], seed: int = 0) -> np.ndarray:
    """128-bit hashes as two columns of signed 64-bit integers."""
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join([xxh3_128_digest(f, seed) for f in found]), dtype="<i8").reshape(-1, 2)


def _short_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hashes as signed integers."""
    from xxhash import xxh3_64_digest

    return np.frombuffer(b"".join([xxh3_64_digest(f) for f in found]), dtype=">i8").astype(np.int64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2**64."""

    def powers(of: int) -> np.ndarray:
        line = np.full(n, of, dtype=np.uint64)
        line[0] = 1
        return np.multiply.accumulate(line)

    return powers(_FACTOR), powers(pow(_FACTOR, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OF_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))
_OF_SPAN = _mixed(np.arange(257, 260, dtype=np.uint64) * np.uint64(_FACTOR))


class Sums(NamedTuple):
    """For each word the sum of the line's bytes, weighed by powers of the factor, before it and to its end, and the power
    that makes a difference of such sums the same wherever in a line it is taken."""

    begun: np.ndarray
    ended: np.ndarray
    back: np.ndarray


def _sums(words: Words) -> Sums:
    line, starts, ends = words[:3]
    up, down = _powers(_BYTES)
    parts = []
    before = np.zeros(1, dtype=np.uint64)
    for at in range(0, len(line), _BYTES):
        part = np.frombuffer(line, np.uint8, min(_BYTES, len(line) - at), at)
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_OF_BYTE[part] * up[: len(part)], out=sums[1:])
        a, z = starts, ends
        if len(line) > _BYTES:
            a = starts[starts.searchsorted(at) : starts.searchsorted(at + _BYTES)] - at
            z = ends[ends.searchsorted(at, "right") : ends.searchsorted(at + _BYTES, "right")] - at
            sums = sums * np.uint64(pow(_FACTOR, at, 1 << 64)) + before
            before = sums[-1:]
        back = down[a]
        if at:
            back = back * np.uint64(pow(_FACTOR, -at, 1 << 64))
        parts.append((sums[a], sums[z], back))
    if len(parts) == 1:
        return Sums(*parts[0])
    return Sums(*[np.concatenate(p) for p in zip((before[:0],) * 3, *parts, strict=True)])


def _span_lows(sums: Sums, found: Spans) -> np.ndarray:
    """A hash of each span, worked out from the sums and not from its text."""
    value = (sums.ended[found.end] - sums.begun[found.begin]) * sums.back[found.begin] + _OF_SPAN[0]
    if found.leads is not None:
        value += found.leads.astype(np.uint64) * _OF_SPAN[1] + found.trails.astype(np.uint64) * _OF_SPAN[2]
    return _mixed(value).view(np.int64)


def _smallest(sums: Sums, size: int, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of half of ``size`` words that are the smallest of some window, or equal to one; with the
    document of each word, of windows within a document."""
    length = (size + 1) // 2
    width = size - length + 1
    n = len(sums.begun) - length + 1
    hashes = _mixed((sums.ended[length - 1 :] - sums.begun[:n]) * sums.back[:n])
    # Smallest of every ``width`` neighbours: the rest of one block with the beginning of the next.
    blocks = np.full((-(-len(hashes) // width), width), np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks.reshape(-1)[: len(hashes)] = hashes
    rest = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    begun = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    n = len(hashes) - width + 1
    least = np.minimum(rest[:n], begun[width - 1 : width - 1 + n])
    first = np.ones(n, dtype=bool)
    np.not_equal(least[1:], least[:-1], out=first[1:])
    named = hashes
    if doc is not None:
        # Documents have values of their own.
        own = doc.astype(np.uint64) * np.uint64(_FACTOR)
        named = hashes + own[: len(hashes)]
        least = least + own[:n]
        np.not_equal(least[1:], least[:-1], out=first[1:])
        first &= doc[:n] == doc[size - 1 :]
    values = least[first]
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values.sort()
    is_one = values[np.minimum(values.searchsorted(named), len(values) - 1)] == named
    if doc is not None:
        is_one &= doc[: len(hashes)] == doc[length - 1 :]
    where = is_one.nonzero()[0]
    return where, hashes[where].view(np.int64)


def _anchors(sums: Sums, size: int, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the anchors of a document, or of short ones: at least every place that is one of some
    window."""
    if doc is not None and doc[0] == doc[-1]:
        doc = None
    if doc is not None:
        return _smallest(sums, size, doc) if len(doc) >= size else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    places, hashes = [], []
    for at in range(0, len(sums.begun) - size + 1, _STRETCH):
        where, found = _smallest(Sums(*[part[at : at + _STRETCH + size - 1] for part in sums]), size)
        places.append(where + at)
        hashes.append(found)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(places) == 1:
        return places[0], hashes[0]
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[first]


def _doc_of_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The number of the first word of each document and of all words, and the document of each word."""
    edges = words.before[words.heads]
    return edges, np.repeat(np.arange(len(edges) - 1), edges[1:] - edges[:-1])


def _low_halves(least: int, alone: int, passage: int):
    """The lower halves of the hashes of the spans and anchors of documents; one that recurs in those worked on together
    comes twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, words in _groups(batch.column(0).to_pylist()):
                if not words.line:
                    continue
                sums = _sums(words)
                found = np.concatenate([_span_lows(sums, _spans(words, least, alone)), _anchors(sums, passage, _doc_of_words(words)[1])[1]])
                found.sort()
                first = np.ones(len(found), dtype=bool)
                first[1:] = found[1:] != found[:-1]
                out += [found[first], found[1:][first[:-1] & ~first[1:]]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["low"])

    return run


_PLACES = pa.schema([(c, pa.int64()) for c in ("low", "high", "doc", "mark")] + [("first", pa.int32()), ("last", pa.int32())])
_PLACE_COLUMNS = "low long, high long, doc long, mark long, first int, last int"


class _Places:
    """Places of documents, given by their row in a batch of ids and marks, as batches of about so many rows."""

    def __init__(self, batch: pa.RecordBatch, rows: int = 1 << 17):
        self._batch, self._held = batch, []
        self._n, self._rows = 0, rows

    def add(self, own: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        self._held.append((own, low, high, first, last))
        self._n += len(low)

    def full(self) -> Iterator[pa.RecordBatch]:
        if self._n >= self._rows:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._n:
            own, low, high, first, last = (np.concatenate(v) for v in zip(*self._held, strict=True))
            doc, mark = (self._batch.column(i).take(pa.array(own)) for i in range(2))
            low, high, first, last = (pa.array(v.astype(of, copy=False)) for v, of in ((low, np.int64), (high, np.int64), (first, np.int32), (last, np.int32)))
            yield pa.RecordBatch.from_arrays([low, high, doc, mark, first, last], schema=_PLACES)
        self._held, self._n = [], 0


def _around(words: Words, edges: np.ndarray, doc: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all words of their document that windows around anchors can have, and of the anchors' places among them."""
    from xxhash import xxh3_64_digest

    line, room = words.line, size - (size + 1) // 2
    first = np.maximum(places - room, edges[doc])
    a, z = words.starts[first].tolist(), words.ends[np.minimum(places + size, edges[doc + 1]) - 1].tolist()
    hashes = [xxh3_64_digest(line[i:j], n) for i, j, n in zip(a, z, (places - first).tolist(), strict=True)]
    return np.frombuffer(b"".join(hashes), dtype=">i8").astype(np.int64)


def _located(least: int, alone: int, passage: int):
    """Places of the spans and the anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _Places(batch)
            for rows, words in _groups(batch.column(2).to_pylist()):
                if not words.line:
                    continue
                heads, sums, found = words.heads, _sums(words), _spans(words, least, alone)
                own = heads.searchsorted(found.first, "right") - 1
                first = found.first - heads[own]
                places.add(rows[own], _span_lows(sums, found), _short_hashes(_texts(words, found)), first, found.last - heads[own])
                edges, doc = _doc_of_words(words)
                at, anchors = _anchors(sums, passage, doc)
                if len(at):
                    own = doc[at]
                    around = _around(words, edges, own, at, passage)
                    order = np.lexsort((at, around, anchors))
                    in_order = anchors[order], around[order], own[order]
                    near = at[order][1:] - at[order][:-1] < passage
                    for same in in_order:
                        near &= same[1:] == same[:-1]
                    kind = np.full(len(at), _ANCHOR)
                    kind[order[1:][near]] = _NEAR
                    places.add(rows[own], anchors, around, at - edges[own], kind)
                yield from places.full()
            yield from places.rest()

    return run


def _windows(passage: int):
    """Places of all windows around the anchors given with each document."""
    room = passage - (passage + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _Places(batch)
            for at, text in enumerate(batch.column(2).to_pylist()):
                line, starts, ends = _words(text)[:3]
                given = np.unique(batch.column(3)[at].values.to_numpy()).astype(np.int64)
                first = np.unique(given[:, None] - np.arange(room + 1))
                first = first[(first >= 0) & (first + passage <= len(starts))]
                edges = zip(starts[first].tolist(), ends[first + passage - 1].tolist(), strict=True)
                hashes = _hashes([line[a:z] for a, z in edges], 1)
                places.add(np.full(len(first), at), hashes[:, 0], hashes[:, 1], first, np.full(len(first), _WINDOW))
                yield from places.full()
            yield from places.rest()

    return run


_CUT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("n_sentences", T.LongType()),
        T.StructField("n_removed", T.LongType()),
    ]
)


def _gone(body: str, edges: list[int], covered: np.ndarray, passage: int) -> list[tuple[int, int]]:
    """The stretches of a text, in order and apart, that its covered places take; each word with the white space
    after it. ``covered`` holds first and last as :func:`without_repeated_spans` packs them."""
    ends = np.array(edges)
    first, last = covered >> 32, (covered & 0xFFFFFFFF) + _NEAR
    whole = last >= 0
    a, z = ends[first[whole]], ends[np.minimum(last[whole] + 1, len(ends) - 1)]
    if not whole.all():
        words = np.array([m.start() for m in _WORD.finditer(body)] + [len(body)])
        words[0] = 0
        before = np.where(last[~whole] != _WINDOW, passage - (passage + 1) // 2, 0)
        own = first[~whole]
        a = np.concatenate([a, words[np.maximum(own - before, 0)]])
        z = np.concatenate([z, words[np.minimum(own + passage, len(words) - 1)]])
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(z[order])
    heads = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
    return list(zip(a[heads].tolist(), reach[np.concatenate([heads[1:] - 1, [len(a) - 1]])].tolist(), strict=True))


def _touched(edges: list[int], gone: list[tuple[int, int]]) -> int:
    ends = np.array(edges)
    hit = np.zeros(len(edges) - 1, dtype=bool)
    for a, z in gone:
        hit[np.searchsorted(ends, a, side="right") - 1 : np.searchsorted(ends, z)] = True
    return int(hit.sum())


def without_repeated_spans(
    docs: DataFrame,
    *,
    least_words: int = 30,
    alone_words: int = 50,
    passage_words: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` without the sentences and words that a non-first repeated span or window covers.

    A span is a shortest run of two sentences or more with ``least_words`` words, or one sentence of
    ``alone_words``; a window is any ``passage_words`` words in a row; case and white space do not matter. So
    every passage of at least ``passage_words`` words that recurs word for word is covered as a whole, wherever
    it starts or ends, and of shorter repeats those spans. The first occurrence is the one in the smallest
    document id (null before all), then the smallest hash of the text, then the earliest place, and stays; so
    does a window that overlaps the first one of its kind, as in a word said over and over. Rows equal in id
    and text are one document: they get one result. A null or empty text stays as it is. With ``counts`` two
    columns are added: the number of sentences, and of those removed in whole or in part. Other columns are
    kept; an empty table gives an empty one.

    Three passes over the texts: one sends 8 bytes per span and anchor and finds hashes met twice, the next
    sends only to these their places, and the last hashes windows around anchors whose surroundings differ.
    Hashes are summed before each shuffle and joins are left to adaptive execution, which splits a passage
    that very many documents share.
    """
    mark = free_name(docs, "mark")
    named = docs.withColumn(mark, F.xxhash64(F.col(text)))
    slim = named.select(F.col(doc_id).cast("long").alias("doc"), F.col(mark).alias("mark"), F.col(text).alias("text"))
    lows = slim.select("text").mapInArrow(_low_halves(least_words, alone_words, passage_words), "low long")
    twice = staged(lows.groupBy("low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("low"), "twice")
    located = slim.mapInArrow(_located(least_words, alone_words, passage_words), _PLACE_COLUMNS)
    located = staged(located.join(twice, "low", "left_semi"), "places")
    place = F.struct("doc", "mark", "first")
    firsts = located.groupBy("low", "high").agg(F.min(place).alias("kept"), F.max(place).alias("other"), F.min("last").alias("kind"))
    # Staged, so that the joins below have plain shuffles on both sides: only then is a hot span split.
    firsts = staged(
        firsts.select("low", "high", "kept", "kind", (F.col("kept") != F.col("other")).alias("recurs")).where((F.col("kind") <= _ANCHOR) | F.col("recurs")),
        "firsts",
    )
    anchors = firsts.where(F.col("kind") <= _ANCHOR)
    several = anchors.groupBy("low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("low")
    opened = anchors.join(staged(several, "several"), "low", "left_semi").select("kept.*")
    opened = opened.unionByName(located.where(F.col("last") == _NEAR).select("doc", "mark", "first"))
    opened = staged(opened.groupBy("doc", "mark").agg(F.collect_set("first").alias("anchors")), "anchors")
    looked = slim.alias("d").join(opened.alias("a"), F.col("d.doc").eqNullSafe(F.col("a.doc")) & (F.col("d.mark") == F.col("a.mark")))
    windows = looked.select("d.doc", "d.mark", "d.text", "a.anchors").mapInArrow(_windows(passage_words), _PLACE_COLUMNS)
    windows = staged(windows, "windows")
    first_windows = windows.groupBy("low", "high").agg(F.min(place).alias("kept"), F.max(place).alias("other"))
    first_windows = staged(first_windows.where("kept != other").drop("other"), "first-windows")
    itself = F.col("doc").eqNullSafe(F.col("kept.doc")) & (F.col("mark") == F.col("kept.mark"))
    overlaps = (F.col("last") < 0) & itself & (F.col("first") - F.col("kept.first") < passage_words)
    later = located.join(firsts.where("recurs").select("low", "high", "kept"), ["low", "high"]).unionByName(
        windows.join(first_windows, ["low", "high"])
    )
    later = later.where(~place.eqNullSafe(F.col("kept")) & ~overlaps)
    cover, its_doc, its_mark = (free_name(named, c) for c in ("cover", "its_doc", "its_mark"))
    # As many ranges as the document has spans and words at most; equal ranges are put together before the shuffle.
    covers = later.groupBy(F.col("doc").alias(its_doc), F.col("mark").alias(its_mark)).agg(
        F.collect_set(F.shiftleft(F.col("first").cast("long"), 32) + (F.col("last") - _NEAR)).alias(cover)
    )

    @F.pandas_udf(_CUT)
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        rows = []
        for body, covered in zip(texts, ranges, strict=True):
            if covered is None and counts is None or not body:
                rows.append((body, 0, 0))
                continue
            starts = _edges(body)
            if covered is None:
                rows.append((body, len(starts) - 1, 0))
                continue
            gone = _gone(body, starts, np.asarray(covered), passage_words)
            edges = [0, *(edge for a_z in gone for edge in a_z), len(body)]
            kept = "".join([body[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)])
            rows.append((kept, len(starts) - 1, _touched(starts, gone)))
        return pd.DataFrame(rows, columns=_CUT.names)

    joined = named.join(covers, F.col(doc_id).cast("long").eqNullSafe(F.col(its_doc)) & (F.col(mark) == F.col(its_mark)), "left")
    hold = free_name(joined, "cut")
    done = joined.withColumn(hold, cut(F.col(text), F.col(cover)))
    added = dict(zip(("n_sentences", "n_removed"), counts or (), strict=False))
    return done.select(
        *[F.col(hold)["text"].alias(c) if c == text else F.col(c) for c in docs.columns if c not in added.values()],
        *[F.col(hold)[c].alias(name) for c, name in added.items()],
    )
