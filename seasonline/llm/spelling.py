"""Spelling variants: words of a corpus one edit apart, found by composing finite-state machines.

The vocabulary's minimised acceptor is composed with a transducer of exactly one edit and with the acceptor
again; every accepting path is a pair of words one edit apart. The composition is cut by where a path starts:

- pairs that agree in the first half of the shorter word start behind that half, on the acceptor as it is;
- all others agree in the second half, and start behind it on the acceptor of the words read backwards.

Each such start (length, half, direction) is a group of words that some task holds, as the acceptor of what is left of
them. Groups with too much text are cut into tiles, and every two tiles meet in one place. So each pair is
accepted in exactly one place, and no place holds more than a bounded number of characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonline.session import staged

LETTERS = "A-Za-zÀ-ÿ"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z as small letters and everything else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def word_counts(
    docs: DataFrame,
    *,
    letters: str = LETTERS,
    shortest: int = 6,
    least: int = 5,
    change: Callable[[Column, Column], Column] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n): runs of ``letters`` in whole texts, A-Z as small letters, of ``shortest`` code points or more that
    occur ``least`` times or more.

    ``change`` may shorten a run, or leave it, given the document's id and the run. Null and empty texts have no
    words; repeated rows count as often as they are there; other columns are not read.
    """
    runs = docs.select(
        F.col(doc_id).alias("doc"), F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{letters}]{{{shortest},}}"), F.lit(0))).alias("run")
    ).select("doc", lower_ascii(F.col("run")).alias("run"))
    if change is not None:
        runs = runs.select(change(F.col("doc"), F.col("run")).alias("run")).where(F.char_length("run") >= shortest)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


@dataclass
class Acceptor:
    """A minimised acyclic acceptor over several groups of words, each with a start state of its own.

    States are numbered so that arcs lead to smaller numbers. An arc's ``skip`` is the number of accepted words
    that come before those through it, so the sum along a path is the word's place in sorted order.
    """

    starts: np.ndarray  # per group
    first: np.ndarray  # arcs of state s are first[s]:first[s + 1], by symbol
    symbol: np.ndarray
    to: np.ndarray
    skip: np.ndarray
    low: np.ndarray  # shortest and longest word from a state; words of a group differ by one symbol at most
    high: np.ndarray

    @property
    def key(self) -> np.ndarray:
        """(state, symbol) of every arc as one ascending number."""
        states = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        return states * self.width + self.symbol

    @property
    def width(self) -> int:
        return int(self.symbol.max(initial=0)) + 1


def acceptor(groups: np.ndarray, words: np.ndarray) -> Acceptor:
    """Of words (fixed-width Unicode) sorted by group number and word, without repeats in a group."""
    n, depth = len(words), max(1, words.dtype.itemsize // 4)
    codes = np.ascontiguousarray(words).view(np.uint32).reshape(n, depth)
    alphabet, codes = np.unique(codes, return_inverse=True)
    codes = codes.reshape(n, depth)
    sizes = np.char.str_len(words)
    # A row opens a node at a depth where it differs, there or before, from the row above.
    fresh = np.zeros((n, depth + 1), dtype=bool)
    fresh[0] = True
    fresh[1:, 0] = groups[1:] != groups[:-1]
    fresh[1:, 1:] = codes[1:] != codes[:-1]
    np.logical_or.accumulate(fresh, axis=1, out=fresh)
    parents, symbols, finals, highs, lows = [], [], [], [], []
    above, total = np.zeros(n, dtype=np.int64), 0
    for d in range(depth + 1):
        rows = np.flatnonzero(sizes >= d)
        if not len(rows):
            break
        opens = fresh[rows, d] if d else fresh[rows, 0]
        number = np.cumsum(opens) - 1 + total
        heads = np.flatnonzero(opens)
        parents.append(above[rows[heads]] if d else np.full(len(heads), -1))
        symbols.append(codes[rows[heads], d - 1] if d else np.zeros(len(heads), dtype=np.int64))
        left = sizes[rows] - d
        highs.append(np.maximum.reduceat(left, heads))
        lows.append(np.minimum.reduceat(left, heads))
        finals.append(lows[-1] == 0)
        above[rows] = number
        total += len(heads)
    parent, symbol, final = np.concatenate(parents), np.concatenate(symbols), np.concatenate(finals)
    high, low = np.concatenate(highs), np.concatenate(lows)
    children = np.argsort(parent, kind="stable")[np.count_nonzero(parent < 0) :]
    fan = np.bincount(parent[children], minlength=total)
    begin = np.cumsum(fan) - fan
    # Nodes with equal rest are one state; what is left of a word is shorter below, so states go by height.
    state = np.full(total, -1, dtype=np.int64)
    counts = np.zeros(total, dtype=np.int64)  # words from a state
    state_low, state_high, arc_symbol, arc_to, arc_skip, arc_fan = [], [], [], [], [], []
    made, width = 0, np.int64(len(alphabet) + 1)
    by_height = np.lexsort((fan, high))
    edges = np.flatnonzero(np.r_[True, (np.diff(high[by_height]) != 0) | (np.diff(fan[by_height]) != 0)])
    for a, z in zip(edges, [*edges[1:], total], strict=True):
        nodes = by_height[a:z]
        f = int(fan[nodes[0]])
        below = children[begin[nodes][:, None] + np.arange(f)]
        rest = np.concatenate([final[nodes][:, None].astype(np.int64), state[below] * width + symbol[below]], axis=1)
        if f < 2:
            flat = rest[:, 0] if f == 0 else rest[:, 1] * 2 + rest[:, 0]
            _, one, same = np.unique(flat, return_index=True, return_inverse=True)
        else:
            _, one, same = np.unique(rest, axis=0, return_index=True, return_inverse=True)
        state[nodes] = made + same.reshape(-1)
        sums = np.cumsum(np.concatenate([final[nodes[one]][:, None].astype(np.int64), counts[state[below[one]]]], axis=1), axis=1)
        counts[made : made + len(one)] = sums[:, -1]
        state_low.append(low[nodes[one]])
        state_high.append(high[nodes[one]])
        arc_fan.append(np.full(len(one), f))
        arc_symbol.append(symbol[below[one]].ravel())
        arc_to.append(state[below[one]].ravel())
        arc_skip.append(sums[:, :-1].ravel())
        made += len(one)
    return Acceptor(
        state[: len(parents[0])],
        np.concatenate([[0], np.cumsum(np.concatenate(arc_fan))]),
        np.concatenate(arc_symbol),
        np.concatenate(arc_to),
        np.concatenate(arc_skip),
        np.concatenate(state_low),
        np.concatenate(state_high),
    )


def _spread(first: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each state of a list its arcs: the place in the list, and the arc."""
    fans = first[states + 1] - first[states]
    places = np.repeat(np.arange(len(states)), fans)
    within = np.arange(len(places)) - np.repeat(np.cumsum(fans) - fans, fans)
    return places, first[states][places] + within


def one_edit_pairs(machine: Acceptor, bases: np.ndarray, lengths: np.ndarray, backwards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word places (u, v) of every accepting path of acceptor, one-edit transducer and acceptor.

    ``bases`` is the place of a group's first word, ``lengths`` that of its shorter words: u has it, v has it or one
    more. In a group read ``backwards`` a pair that an edit at the very front explains is left out, as it
    agrees in the other half and is accepted there.
    """
    key, width = machine.key, machine.width
    low, high, first, symbol, to, skip = machine.low, machine.high, machine.first, machine.symbol, machine.to, machine.skip
    found: list[tuple[np.ndarray, ...]] = []

    def alive(paths: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """Of paths behind their edit, as (state of u, state of v, place of u, place of v, symbols left, edit at the
        front), those that can end together; what has ended is taken out."""
        q, r, *_, left, _ = paths
        going = ((low[q] == left) | (high[q] == left)) & ((low[r] == left) | (high[r] == left))
        done = going & (left == 0)
        if done.any():
            found.append(tuple(paths[i][done] for i in (2, 3, 5)))
        return tuple(x[going & ~done] for x in paths)

    def step(paths: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """Both sides read the same symbol."""
        q, r, u, v, left, front = paths
        places, arcs = _spread(first, q)
        wanted = r[places] * width + symbol[arcs]
        other = np.searchsorted(key, wanted)
        other[other == len(key)] = 0
        both = key[other] == wanted if len(arcs) else np.zeros(0, dtype=bool)
        places, arcs, other = places[both], arcs[both], other[both]
        return to[arcs], to[other], u[places] + skip[arcs], v[places] + skip[other], left[places] - 1, front[places]

    def joined(*some: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*some, strict=True))

    def merged(paths: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """One path for those that differ only in where a symbol was put into a run of equal ones."""
        order = np.lexsort((~paths[5], *paths[:4]))
        paths = tuple(x[order] for x in paths)
        new = np.r_[True, np.logical_or.reduce([np.diff(x) != 0 for x in paths[:4]])] if len(order) else np.zeros(0, dtype=bool)
        return tuple(x[new] for x in paths)

    nothing = np.zeros(0, dtype=np.int64)
    replaced = longer = (nothing, nothing, nothing, nothing, nothing, nothing.astype(bool))
    q, base, left, front = machine.starts, bases, lengths, backwards
    while len(q) or len(replaced[0]) or len(longer[0]):
        places, arcs = _spread(first, q)
        # One more symbol on the longer side.
        more = q[places], to[arcs], base[places], base[places] + skip[arcs], left[places], front[places]
        longer = merged(alive(joined(longer, more)))
        # Another symbol in the same place: every arc with each later one of its state.
        n = np.bincount(places, minlength=len(q))
        later = np.repeat(np.cumsum(n), n) - np.arange(len(arcs)) - 1
        a = np.repeat(np.arange(len(arcs)), later)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)
        at, a, b = places[a], arcs[a], arcs[b]
        other = to[a], to[b], base[at] + skip[a], base[at] + skip[b], left[at] - 1, np.zeros(len(at), dtype=bool)
        replaced = alive(joined(step(replaced), other))
        longer = step(longer)
        # No edit yet.
        q, base, left = to[arcs], base[places] + skip[arcs], left[places] - 1
        going = left >= 0
        q, base, left = q[going], base[going], left[going]
        front = np.zeros(len(q), dtype=bool)
    if not found:
        return nothing, nothing
    u, v, front = joined(*found)
    total = np.int64(max(u.max(initial=0), v.max(initial=0)) + 1)
    pairs = u * total + v
    pairs = np.setdiff1d(pairs, pairs[front])
    return pairs // total, pairs % total


def _pairs_of(rows: list[tuple]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words, their counts, and the places of both words of each pair; rows are whole groups."""
    tails = []
    for length, half, backwards, low, high, _, word, _ in rows:
        tails.append(word[: len(word) - len(half)][::-1] if backwards else word[len(half) :])
    groups_of: dict[tuple, int] = {}
    groups = np.fromiter((groups_of.setdefault(r[:5], len(groups_of)) for r in rows), dtype=np.int64, count=len(rows))
    tails = np.array(tails, dtype=np.str_)
    order = np.lexsort((tails, groups))
    groups, tails = groups[order], tails[order]
    rows = [rows[i] for i in order.tolist()]
    heads = np.flatnonzero(np.r_[True, np.diff(groups) != 0])
    machine = acceptor(groups, tails)
    lengths = np.array([rows[i][0] - len(rows[i][1]) for i in heads.tolist()], dtype=np.int64)
    backwards = np.array([rows[i][2] for i in heads.tolist()], dtype=bool)
    u, v = one_edit_pairs(machine, heads.astype(np.int64), lengths, backwards)
    tiles = np.array([r[5] for r in rows])
    crossing = np.array([r[3] != r[4] for r in rows])
    meet = ~crossing[u] | (tiles[u] != tiles[v])  # two words of one tile meet where the tile meets itself
    return [r[6] for r in rows], np.array([r[7] for r in rows], dtype=np.int64), u[meet], v[meet]


def _by_group(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """Rows in whole groups, as many at a time as have about ``most`` characters when written one below the other."""
    held: list[tuple] = []
    done = longest = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:5] != held[-1][:5]:
                done = len(held)
            longest = max(longest, len(row[6]))
            held.append(row)
            if done and len(held) * longest > most:
                yield held[:done]
                held, done = held[done:], 0
                longest = max(len(r[6]) for r in held)
    if held:
        yield held


def _grouped(words: DataFrame, tile: int) -> DataFrame:
    """Each word once for every place where a pair with it may be accepted."""
    shortest = words.agg(F.min(F.char_length("word"))).first()[0] or 1
    size = F.char_length("word")
    half = F.expr("length div 2")
    ways = (
        words.select("word", "n", F.explode(F.array(size, size - 1)).alias("length"))
        .where(F.col("length") >= shortest)
        .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("backwards"))
        .where((half > 0) | ~F.col("backwards"))
        .select(
            "length",
            F.when(F.col("backwards"), F.expr("right(word, length - length div 2)")).otherwise(F.expr("left(word, length div 2)")).alias("half"),
            "backwards",
            "word",
            "n",
        )
    )
    group = ["length", "half", "backwards"]
    large = staged(
        ways.groupBy(*group).agg((F.sum(F.char_length("word")) / tile).cast("int").alias("tiles")).where("tiles > 0"), "hot-groups"
    )
    tiles = F.coalesce(F.col("tiles") + 1, F.lit(1))
    own = F.pmod(F.xxhash64("word"), tiles).cast("int")
    met = ways.join(large, group, "left").select(*group, own.alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"), "word", "n")
    return met.select(*group, F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "word", "n")


def _near(words: DataFrame, tile: int, schema: str, result) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_group(batches, 2 * tile):
            yield from result(*_pairs_of(rows))

    group = ["length", "half", "backwards", "low", "high"]
    dealt = _grouped(words, tile).repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(run, schema)


def near_pairs(words: DataFrame, *, tile: int = 1_000_000) -> DataFrame:
    """(a, b) of every two words one inserted, deleted or replaced code point apart, once each way.

    ``words`` has different non-empty words in ``word`` and their counts in ``n``. ``tile`` bounds the characters of
    a group that meet in one place; see the module.
    """

    def both(names: list[str], _: np.ndarray, u: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
        pool = pa.array(names, pa.string())
        for low in range(0, len(u), 100_000):
            x, y = pool.take(pa.array(u[low : low + 100_000])), pool.take(pa.array(v[low : low + 100_000]))
            yield pa.RecordBatch.from_arrays([x, y], names=["a", "b"])
            yield pa.RecordBatch.from_arrays([y, x], names=["a", "b"])

    return _near(words, tile, "a string, b string", both)


def near_counts(words: DataFrame, *, tile: int = 1_000_000) -> DataFrame:
    """(word, n_near, near, near_n) of every word with a near one: how many, and that of largest count, ties to the
    smallest in code-point order. Pairs are added up where they are accepted and never written out."""

    def summed(names: list[str], counts: np.ndarray, u: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(u):
            return
        rank = np.empty(len(names), dtype=np.int64)
        rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        one, other = np.concatenate([u, v]), np.concatenate([v, u])
        order = np.lexsort((rank[other], -counts[other], one))
        heads = np.flatnonzero(np.r_[True, np.diff(one[order]) != 0])
        pool, best = pa.array(names, pa.string()), other[order][heads]
        columns = [pool.take(pa.array(one[order][heads])), pa.array(np.diff(np.r_[heads, len(one)])), pool.take(pa.array(best)), pa.array(counts[best])]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "near", "near_n"])

    parts = _near(words, tile, "word string, n_near long, near string, near_n long", summed)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )


def spelling_variants(words: DataFrame, *, ratio: int = 5, tile: int = 1_000_000) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n).

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that n is ``ratio`` times
    the word's own or more, else null; ``form_n`` is its n. Following forms to the last gives the root, the word
    itself where there is no form; with a ratio over 1 counts grow along the way, so there is no circle and about
    as many steps as the logarithm of the largest count. Of rows that share a word the largest n counts, and rows
    with a null or empty word or a null n are left out; an empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("a ratio under 2 lets words be each other's form")
    words = words.where((F.col("word") != "") & F.col("n").isNotNull()).groupBy("word").agg(F.max("n").cast("long").alias("n"))
    words = staged(words, "words")
    known = words.join(near_counts(words, tile=tile), "word", "left")
    much = F.col("near_n") >= F.col("n") * ratio
    known = staged(
        known.select(
            "word", F.when(much, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(much, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    # Pointers over twice the way in each round, as long as any leads on.
    leads = staged(known.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "leads")
    while True:
        on = leads.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = staged(leads.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "leads")
        leads = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return known.join(leads, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
