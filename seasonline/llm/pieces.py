"""Texts cut where byte-level BPE never joins across, and values remembered per piece.

No match of the split pattern holds a visible character followed by white space. So a text may be cut
before every blank or line feed that follows a visible character, the pieces encoded one by one, and the
results joined: that gives what the whole text gives, while most pieces are words seen before.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Only the two common kinds of white space open a piece, and only after what every Unicode table calls visible.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def cut(text: str) -> list[str]:
    """The pieces of ``text``; joined they are ``text`` again."""
    return _CUT.split(text) if text else []


class PieceMemo:
    """Values of pieces by ``encode_many``, of which the lately used ones are kept.

    Two generations of about ``size`` pieces each: what is used moves to the young one, and between two
    texts a full young generation takes the place of the old. Pieces longer than ``longest`` characters,
    and those that end in white space, are not kept.
    """

    def __init__(self, encode_many: Callable[[list[str]], Sequence], size: int = 250_000, longest: int = 48):
        self._encode_many, self._size, self._longest = encode_many, size, longest
        self._young: dict = {}
        self._old: dict = {}

    def missing(self, pieces: list[str]) -> set[str]:
        """The pieces whose values are not at hand."""
        return set(pieces).difference(self._young)

    def values(self, pieces: list[str], missing: set[str] | None = None) -> list:
        """The values of ``pieces``; ``missing`` may be given if it is known already."""
        missing = self.missing(pieces) if missing is None else missing
        if missing:
            return self._after_learning(pieces, missing)
        return list(map(self._young.__getitem__, pieces))

    def _after_learning(self, pieces: list[str], missing: set[str]) -> list:
        young, old = self._young, self._old
        unknown = [p for p in missing if p not in old]
        young.update(zip(unknown, self._encode_many(unknown), strict=True))
        if len(unknown) < len(missing):
            young.update((p, old[p]) for p in missing.difference(unknown))
        found = list(map(young.__getitem__, pieces))
        for piece in unknown:
            if len(piece) > self._longest or piece[-1:].isspace():
                del young[piece]
        if len(young) > self._size:
            self._old, self._young = young, {}
        return found

    def of_text(self, text: str) -> list:
        """The values of a text's pieces, in order.

        Replacing is several times faster than the regular expression, but also cuts inside runs of
        white space; a piece that ends in white space shows this, and the text is then cut by the rule.
        """
        if not text:
            return []
        if "\0" not in text:
            pieces = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
            missing = set(pieces).difference(self._young)
            if not missing:
                return list(map(self._young.__getitem__, pieces))  # only sound pieces are ever kept
            if not any(p[-1:].isspace() for p in missing):
                return self._after_learning(pieces, missing)
        return self.values(cut(text))


def gathered(values: list[bytes], index: np.ndarray, item: int) -> tuple[np.ndarray, np.ndarray]:
    """``values[i]`` for every i of ``index`` one after the other as bytes, and the number of items of each.

    An item is ``item`` bytes wide, 2 or 4.
    """
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // item
    starts = np.cumsum(sizes) - sizes
    blob = np.frombuffer(b"".join(values), dtype=f"<u{item}")
    counts = sizes[index]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(starts[index] - (ends - counts), counts) + np.arange(total)
    return blob[places], counts


def slices(texts: pa.Array, most_bytes: int = 4 << 20) -> Iterator[pa.Array]:
    """``texts`` in stretches of bounded size, one text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield texts.slice(low, high - low)
        low = high


def batch_ids(texts: pa.Array, memo: PieceMemo, dtype: str, most_bytes: int = 4 << 20) -> Iterator[np.ndarray]:
    """The ids of each text, by a memo whose values are ids as bytes of ``dtype``; a null text has none.

    Works on columns: Arrow cuts all texts and numbers the different pieces, so that each of these is
    looked up once, and ids are gathered by index. Texts with runs of white space go by the cutting rule.
    """
    for some in slices(texts, most_bytes):
        yield from _batch_ids(pc.fill_null(some.cast(pa.large_string()), ""), memo, np.dtype(dtype))


def _batch_ids(texts: pa.Array, memo: PieceMemo, dtype: np.dtype) -> list[np.ndarray]:
    """Pieces open at blanks, line feeds, full stops and commas here.

    Before white space a cut is sound after a visible character, before a stop or comma after a letter or
    digit, which never join with signs. A text with any other cut is encoded by the rule instead.
    """
    marked = texts
    for opener in ("\n", " ", ".", ","):
        marked = pc.replace_substring(marked, opener, "\0" + opener)
    lists = pc.split_pattern(marked, "\0")
    edges = lists.offsets.to_numpy().astype(np.int64)
    edges = edges - edges[0]
    coded = lists.flatten().dictionary_encode()
    names, index = coded.dictionary, coded.indices.to_numpy()
    pieces = names.to_pylist()
    missing = memo.missing(pieces)
    loose = {p for p in missing if p[-1:].isspace()}  # no such piece is ever kept
    by_rule = pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False).copy()
    wrong = np.zeros(len(index), dtype=bool)
    if loose:
        wrong |= np.fromiter((p in loose for p in pieces), dtype=bool, count=len(pieces))[index]
        missing -= loose
        missing.add("")
        pieces = ["" if p in loose else p for p in pieces]
    stops = pc.or_(pc.starts_with(names, "."), pc.starts_with(names, ",")).to_numpy(zero_copy_only=False)
    after_stop = np.flatnonzero(stops[index])
    before = index[np.maximum(after_stop - 1, 0)]
    firm = np.zeros(len(pieces), dtype=bool)
    for i in np.unique(before).tolist():
        firm[i] = pieces[i][-1:].isalnum()
    wrong[after_stop] |= ~firm[before]
    by_rule |= np.logical_or.reduceat(wrong, edges[:-1])
    ids, counts = gathered(memo.values(pieces, missing), index, dtype.itemsize)
    ids, ends = ids.view(dtype), np.concatenate([[0], np.cumsum(counts)])[edges]
    found = [ids[a:z] for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    for i in np.flatnonzero(by_rule).tolist():
        found[i] = np.frombuffer(b"".join(memo.values(cut(texts[i].as_py()))), dtype=dtype)
    return found
