"""Token counts that follow edits: a segment tree over each document's pieces.

A document is kept as a segment tree whose leaves are its pre-token pieces (see ``pieces``), each with
its length and token count. An edit finds the leaves it touches by descending the tree, re-encodes only
these and as much beside them as the new text may join with, and updates the sums above them.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.llm.common import free_name, held_by_worker
from seasonline.llm.pieces import PieceMemo, cut

EDITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("replacement", T.StringType()),
        ]
    )
)
_COUNTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_edits", T.LongType()),
        T.StructField("n_tokens_after", T.LongType()),
        T.StructField("reencoded_chars", T.LongType()),
        T.StructField("edited", T.StringType()),
    ]
)


class CountTree:
    """The token count of one text under edits."""

    def __init__(self, text: str, counts_of: Callable[[list[str]], list[int]]):
        self._counts_of = counts_of
        leaves = cut(text)
        self._plant(leaves, counts_of(leaves))
        self.reencoded_chars = 0

    def _plant(self, leaves: list[str], counts: list[int]) -> None:
        """A new tree over these leaves and their counts; nothing is encoded."""
        self._leaves = leaves
        self._width = 1 << max(0, len(leaves) - 1).bit_length()
        self._chars = self._sums([len(p) for p in leaves])
        self._tokens = self._sums(counts)

    def _sums(self, values: list[int]) -> np.ndarray:
        tree = np.zeros(2 * self._width, dtype=np.int64)
        tree[self._width : self._width + len(values)] = values
        at = self._width
        while at > 1:
            tree[at // 2 : at] = tree[at : 2 * at : 2] + tree[at + 1 : 2 * at : 2]
            at //= 2
        return tree

    @property
    def n_tokens(self) -> int:
        return int(self._tokens[1])

    @property
    def n_chars(self) -> int:
        return int(self._chars[1])

    @property
    def text(self) -> str:
        return "".join(self._leaves)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place``, and the place of its first character."""
        node, first = 1, 0
        while node < self._width:
            node *= 2
            if place - first >= self._chars[node]:
                first += int(self._chars[node])
                node += 1
        return node - self._width, first

    def _with_text(self, low: int, high: int) -> tuple[list[str], list[int]]:
        """The leaves of a range that are not empty, and their counts."""
        held = [i for i in range(low, high) if self._leaves[i]]
        return [self._leaves[i] for i in held], self._tokens[[self._width + i for i in held]].tolist()

    def replace(self, start: int, length: int, new: str) -> None:
        """Put ``new`` in place of ``length`` characters from ``start``; places beyond the text are its end."""
        start = min(max(start, 0), self.n_chars)
        length = min(max(length, 0), self.n_chars - start)
        if not self._leaves:
            leaves = cut(new)
            self._plant(leaves, self._counts_of(leaves))
            self.reencoded_chars += len(new)
            return
        if not length and not new:
            return
        left, first = self._leaf_at(min(start, self.n_chars - 1)) if self.n_chars else (0, 0)
        right, right_first = (
            self._leaf_at(start + length - 1) if length and self.n_chars else (left, first)
        )
        tail = self._leaves[right][start + length - right_first :]
        region = self._leaves[left][: start - first] + new + tail
        # Boundary context: a cut stands only between a visible character and white space that opens a piece. The next
        # leaf with text is found by the sums, however many empty ones lie between.
        end = right_first + len(self._leaves[right])
        while first > 0:
            before, before_first = self._leaf_at(first - 1)
            if _is_cut(self._leaves[before], region):
                break
            left, first, region = before, before_first, self._leaves[before] + region
        while end < self.n_chars:
            after, _ = self._leaf_at(end)
            if _is_cut(region, self._leaves[after]):
                break
            right, end, region = after, end + len(self._leaves[after]), region + self._leaves[after]
        self._put(left, right, region)

    def _put(self, left: int, right: int, region: str) -> None:
        """Give leaves ``left`` to ``right`` the pieces of ``region``.

        Where these are too many, the leaves around are dealt anew among their places, if some are empty; otherwise the tree
        is planted again with every ninth leaf empty. Nothing beside the region is encoded for that.
        """
        pieces = cut(region)
        counts = list(self._counts_of(pieces))
        self.reencoded_chars += len(region)
        if len(pieces) > right - left + 1:
            low, high = max(0, left - _AROUND), min(len(self._leaves), right + 1 + _AROUND)
            fits = self._with_text(low, left), self._with_text(right + 1, high)
            if len(fits[0][0]) + len(pieces) + len(fits[1][0]) > high - low:
                low, high = 0, len(self._leaves)
                fits = self._with_text(low, left), self._with_text(right + 1, high)
            pieces, counts = ([*before, *own, *after] for before, own, after in zip(fits[0], (pieces, counts), fits[1], strict=True))
            if len(pieces) > high - low or high - low == len(self._leaves):
                self._plant(*_spread(pieces, counts, len(pieces) + len(pieces) // 8 + 8))
                return
            pieces, counts = _spread(pieces, counts, high - low)
            left, right = low, high - 1
        slots = right - left + 1
        pieces += [""] * (slots - len(pieces))
        counts += [0] * (slots - len(counts))
        self._leaves[left : right + 1] = pieces
        low, high = left + self._width, right + self._width
        self._chars[low : high + 1] = [len(p) for p in pieces]
        self._tokens[low : high + 1] = counts
        while low > 1:
            low, high = low // 2, high // 2
            for tree in (self._chars, self._tokens):
                tree[low : high + 1] = tree[2 * low : 2 * high + 2 : 2] + tree[2 * low + 1 : 2 * high + 2 : 2]


# Leaves on either side among which new ones may find a place.
_AROUND = 64


def _spread(leaves: list[str], counts: list[int], slots: int) -> tuple[list[str], list[int]]:
    """Leaves dealt evenly over so many places, empty ones between."""
    spread, sums = [""] * slots, [0] * slots
    for i, (leaf, count) in enumerate(zip(leaves, counts, strict=True)):
        spread[i * slots // len(leaves)], sums[i * slots // len(leaves)] = leaf, count
    return spread, sums


def _is_cut(left: str, right: str) -> bool:
    return bool(left) and bool(right) and not left[-1].isspace() and right[0] in " \n"


def _piece_counts(path: str, pattern: str) -> PieceMemo:
    """Token counts of pieces by the vocabulary in ``path``."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return PieceMemo(lambda pieces: [len(encoding.encode_ordinary(p)) for p in pieces])


def with_token_counts(
    docs: DataFrame, edits: Column | None, *, vocabulary: str, pattern: str, text: str = "text", keep_text: bool = False
) -> DataFrame:
    """``docs`` with the token counts of their texts before and after edits.

    ``edits`` is an array of (start, length, replacement) per row; each speaks of the text that the edits
    before it left, in code points. Adds n_tokens, n_edits, n_tokens_after and reencoded_chars, and with
    ``keep_text`` the edited text as ``edited``. A null text counts as empty, a null array as no edits; an
    edit that is null or has no start is passed over, a null length is 0 and a null replacement empty;
    places beyond the text are its end. Rows are independent, so repeated rows, ties and an empty table
    need no rule. Columns of these names in ``docs`` give way to the new ones. No shuffle.
    """

    @F.pandas_udf(_COUNTS)
    def counted(texts: pd.Series, edit_lists: pd.Series) -> pd.DataFrame:
        memo = held_by_worker(("counts", vocabulary, pattern), lambda: _piece_counts(vocabulary, pattern))
        rows = []
        for body, changes in zip(texts, edit_lists, strict=True):
            body = body or ""
            changes = [c for c in (changes if changes is not None else []) if c is not None and c["start"] is not None]
            if not changes:
                n = sum(memo.of_text(body))
                rows.append((n, 0, n, 0, body if keep_text else None))
                continue
            tree = CountTree(body, memo.values)
            n = tree.n_tokens
            for c in changes:
                tree.replace(int(c["start"]), int(c["length"] or 0), c["replacement"] or "")
            rows.append((n, len(changes), tree.n_tokens, tree.reencoded_chars, tree.text if keep_text else None))
        return pd.DataFrame(rows, columns=_COUNTS.names)

    added = [c for c in _COUNTS.names if keep_text or c != "edited"]
    hold = free_name(docs, "counts")
    given = edits if edits is not None else F.lit(None).cast(EDITS)
    return docs.withColumn(hold, counted(F.col(text), given)).select(
        *[c for c in docs.columns if c not in added], *[F.col(hold)[c].alias(c) for c in added]
    )


# What a scrub takes out of a text, and what it puts there.
SCRUBS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<email>"),
    (r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "<ip>"),
    (r"\b[0-9a-f]{32,64}\b", "<secret>"),
    (r"\b\d{13,19}\b", "<card>"),
    (r"(?m)^(?:Licensed under|This work is licensed under)[^\n]*\n?", ""),
)


def scrub_edits(text: Column) -> Column:
    """The edits that replace addresses, secrets and licence lines, the last of a text first.

    Matches that overlap an earlier rule's are left out. Null for a text without any.
    """
    rules = [(re.compile(p), r) for p, r in SCRUBS]

    @F.pandas_udf(EDITS)
    def found(texts: pd.Series) -> pd.Series:
        def edits(body: str | None) -> list | None:
            starts: list[int] = []  # of the spans so far, which lie apart, in order
            spans: dict[int, tuple[int, str]] = {}
            for rule, new in rules:
                for m in rule.finditer(body or ""):
                    start, end = m.span()
                    at = bisect_left(starts, end)
                    if at and starts[at - 1] + spans[starts[at - 1]][0] > start:
                        continue
                    starts.insert(at, start)
                    spans[start] = end - start, new
            return [{"start": s, "length": spans[s][0], "replacement": spans[s][1]} for s in reversed(starts)] or None

        return pd.Series([edits(body) for body in texts], dtype=object)

    return found(text)
