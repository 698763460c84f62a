"""Two tokenizers' tokens of the same texts set against each other, by interval coalescing.

Both tokenizers tile a text's bytes. All tokens of both are sorted by their start, the running maximum of their
ends is taken, and a group of tokens ends where the next start reaches that maximum: there both tokenizers end a token.
Within a group every two tokens whose bytes overlap are linked.

A text is cut where neither tokenizer joins across (before a blank or line feed that follows something visible, and before
a stop or comma that follows a letter), and the different units of a batch are encoded and coalesced together, once
each: every cut ends a group, so a text's groups and links are those of its units. Where a vocabulary does
not allow this, a whole text is one unit.

How often a link's two ids are linked in the whole corpus is known only after all texts. So texts are read once, by slices
of a few megabytes; a slice is written as its rows, the links of its different units, and the units of each row. The
links are then added up over all slices, and looked up for each slice.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.llm.common import free_name, held_by_worker
from seasonline.llm.pieces import PieceMemo, cut, slices
from seasonline.session import scratch_path, staged

# Links are stored as one number, A's id in the high half.
_HALF = 32


class Unit(NamedTuple):
    """What is known of one unit; ``n_a`` is -1 where the bytes of a tokenizer's tokens are not those of the unit."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: bytes  # "a1,a2|b1;" and so on
    links: bytes  # little-endian 64-bit numbers


_OPENERS = frozenset(" \n")
_STOPS = frozenset(".,")
_WRONG = Unit(-1, 0, 0, 0, b"", b"")


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies name a byte by its Latin-1 letter if that is visible, else by the next free letter from 256."""
    visible = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


def _byte_level(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes], bool]:
    """Encoder, bytes of every id, and whether texts may be cut, of a byte-level ``tokenizers`` file. Special tokens
    in a text are plain text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    added = {t["content"] for t in spec.get("added_tokens", [])}
    letters, names = _bytes_of_letters(), tokenizer.get_vocab()
    known = [b""] * (max(names.values()) + 1)
    for name, number in names.items():
        known[number] = name.encode() if name in added else bytes(letters[c] for c in name)
    split = spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    whole = [k for k in ("normalizer", "truncation", "padding") if spec.get(k)]
    ordinary = [t["content"] for t in spec.get("added_tokens", []) if not t.get("special")]

    def encode(units: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    return encode, known, plain and not whole and not ordinary


def _sentence_pieces(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes], bool]:
    """Encoder of texts with a blank before them, bytes of every id, and whether texts may be cut, of a
    ``sentencepiece`` model that adds that blank itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    named = re.compile(r"<0x([0-9A-F]{2})>")
    known = [
        bytes([int(named.fullmatch(p)[1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
    ]
    # A line feed stands alone, so it can open a unit in place of the blank that the model would add.
    head = model.encode("\n")
    probe = model.encode("\n a  b\n c ")
    parted = (
        not any("\n" in p or re.search(r"\S ", p.replace("▁", " ")) for p in pieces)
        and not any(x.isalpha() and y in ".," for p in pieces for x, y in pairwise(p))
        and [known[i] for i in head] == [b" ", b"\n"]
        and b"".join(known[i] for i in probe) == b" \n a  b\n c "
    )

    def encode(units: list[str]) -> list[list[int]]:
        if parted:
            return [ids[2:] for ids in model.encode(["\n" + u for u in units], num_threads=1)]
        return model.encode([u[1:] for u in units], num_threads=1)

    return encode, known, parted


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval coalescing: the order of all intervals by start, and the group of each in that order."""
    order = np.argsort(starts, kind="stable")
    reach = np.maximum.accumulate(ends[order])
    breaks = np.r_[True, starts[order][1:] >= reach[:-1]] if len(order) else np.zeros(0, dtype=bool)
    return order, np.cumsum(breaks) - 1


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every (a, b) whose ranges overlap; both sides are tilings, in order."""
    low = np.searchsorted(b_ends, a_starts, side="right")
    counts = np.searchsorted(b_starts, a_ends, side="left") - low
    a = np.repeat(np.arange(len(a_starts)), counts)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts - low, counts)


class Aligner:
    """Units to what is known of them, for one pair of vocabulary files."""

    def __init__(self, a_path: str, b_path: str):
        self._a, self._a_bytes, a_parted = _byte_level(a_path)
        self._b, self._b_bytes, b_parted = _sentence_pieces(b_path)
        self.by_unit = a_parted and b_parted
        self._a_sizes = np.array([len(x) for x in self._a_bytes])
        self._b_sizes = np.array([len(x) for x in self._b_bytes])
        # An id as it is written before a comma, and before the sign that ends its side of a group.
        a_names, b_names = (np.arange(len(x)).astype(np.bytes_).tolist() for x in (self._a_bytes, self._b_bytes))
        self._written = [*(n + b"," for n in a_names), *(n + b"|" for n in a_names), *(n + b"," for n in b_names), *(n + b";" for n in b_names)]
        self.memo = PieceMemo(self.aligned, size=100_000)

    def aligned(self, units: list[str]) -> list[Unit]:
        found: list[Unit] = []
        some, size = [], 0
        for unit in units:
            some.append(unit)
            size += len(unit)
            if size > 400_000:
                found += self._aligned(some)
                some, size = [], 0
        return found + self._aligned(some)

    def _aligned(self, units: list[str]) -> list[Unit]:
        # Units that open with white space and end without stay apart when joined: one call for all of them.
        closed = [self.by_unit and u[:1] in _OPENERS and not u[-1:].isspace() for u in units]
        together = [u for u, ok in zip(units, closed, strict=True) if ok]
        found = self._joined(together) if together else None
        if found is None:
            return self._one_by_one(units)
        rest = iter(self._one_by_one([u for u, ok in zip(units, closed, strict=True) if not ok]))
        return [next(found) if ok else next(rest) for ok in closed]

    def _joined(self, units: list[str]) -> Iterator[Unit] | None:
        """None if a tokenizer's tokens are not the units' bytes, or cross from one into the next."""
        whole = "".join(units)
        raw, ends = whole.encode(), np.cumsum([len(u.encode()) for u in units])
        sides = []
        for encode, known, sizes in ((self._a, self._a_bytes, self._a_sizes), (self._b, self._b_bytes, self._b_sizes)):
            ids = encode([whole])[0]
            token_ends = np.cumsum(sizes[ids])
            last = np.searchsorted(token_ends, ends)
            if b"".join([known[i] for i in ids]) != raw or not np.array_equal(token_ends[last], ends):
                return None
            sides.append((np.array(ids, dtype=np.int64), np.diff(last, prepend=-1)))
        return self._coalesced(*sides[0], *sides[1])

    def _one_by_one(self, units: list[str]) -> list[Unit]:
        if not units:
            return []
        a_ids, b_ids = self._a(units), self._b(units)
        a_bytes, b_bytes = self._a_bytes, self._b_bytes
        same = [
            u != "" and (raw := u.encode()) == b"".join([a_bytes[i] for i in a]) and raw == b"".join([b_bytes[i] for i in b])
            for u, a, b in zip(units, a_ids, b_ids, strict=True)
        ]
        sides = []
        for ids in (a_ids, b_ids):
            good = [x for x, ok in zip(ids, same, strict=True) if ok]
            sides += [np.array([i for x in good for i in x], dtype=np.int64), np.array([len(x) for x in good])]
        good = self._coalesced(*sides) if any(same) else iter(())
        return [next(good) if ok else _WRONG for ok in same]

    def _coalesced(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> Iterator[Unit]:
        """Units one after the other in one row of bytes, by their ids and the number of these in each."""
        a_ends, b_ends = np.cumsum(self._a_sizes[a]), np.cumsum(self._b_sizes[b])
        a_starts, b_starts = a_ends - self._a_sizes[a], b_ends - self._b_sizes[b]
        order, groups = coalesce(np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends]))
        group = np.empty(len(order), dtype=np.int64)
        group[order] = groups
        # Written by group, A's tokens before B's.
        side = np.repeat([0, 1], [len(a), len(b)])
        by_group = np.lexsort((side, group))
        last = np.r_[np.diff(group[by_group] * 2 + side[by_group]) != 0, True]
        sizes = len(self._a_bytes), len(self._b_bytes)
        codes = np.concatenate([a, b + 2 * sizes[0]])[by_group] + np.where(last, np.where(side[by_group] == 0, *sizes), 0)
        written = [self._written[i] for i in codes.tolist()]
        token_ends = np.cumsum(n_a + n_b)
        group_ends = group[len(a) + np.cumsum(n_b) - 1] + 1
        x, y = overlaps(a_starts, a_ends, b_starts, b_ends)
        links = (a[x] << _HALF | b[y]).astype("<i8").tobytes()
        link_ends = np.cumsum(np.bincount(x, minlength=len(a)))[np.cumsum(n_a) - 1]
        rows = (x.tolist() for x in (n_a, n_b, group_ends, link_ends, token_ends))
        group_at = link_at = token_at = 0
        for n, m, groups_to, links_to, tokens_to in zip(*rows, strict=True):
            yield Unit(
                n, m, groups_to - group_at, links_to - link_at, b"".join(written[token_at:tokens_to]), links[8 * link_at : 8 * links_to]
            )
            group_at, link_at, token_at = groups_to, links_to, tokens_to


def _aligner(a_path: str, b_path: str) -> Aligner:
    return held_by_worker(("aligner", a_path, b_path), lambda: Aligner(a_path, b_path))


def _let_go() -> None:
    """The worker's vocabularies and memo are not needed any more."""
    held_by_worker("nothing", lambda: None)


class Batch:
    """The units of some texts: each different one once, and per text the numbers of its units, in order."""

    def __init__(self, texts: pa.Array, aligner: Aligner):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        self.empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        texts = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
        if aligner.by_unit:
            names, index, edges = self._cut(texts)
        else:
            names, index, edges = texts.to_pylist(), np.arange(len(texts)), np.arange(len(texts) + 1)
        self.units: list[Unit] = aligner.memo.values(names)
        self.index, self.edges = index, edges
        wrong = np.array([u.n_a < 0 for u in self.units], dtype=bool)
        self.full = ~self.empty & ~np.logical_or.reduceat(wrong[index], edges[:-1])  # texts with tokens

    @staticmethod
    def _cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Arrow cuts before every blank, line feed, stop and comma; a text where one of the first two follows white space,
        or one of the others no letter, or that holds the mark itself, is cut by the rule for white space alone."""
        marked = texts
        for opener in ("\n", " ", ".", ","):
            marked = pc.replace_substring(marked, opener, "\0" + opener)
        lists = pc.split_pattern(marked, "\0")
        edges = lists.offsets.to_numpy().astype(np.int64)
        edges = edges - edges[0]
        coded = lists.flatten().dictionary_encode()
        names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        loose = np.fromiter((n[-1:].isspace() for n in names), dtype=bool, count=len(names))
        firm = np.fromiter((n[-1:].isalpha() for n in names), dtype=bool, count=len(names))
        stop = np.fromiter((n[:1] in _STOPS for n in names), dtype=bool, count=len(names))
        wrong = loose[index]
        wrong[1:] |= stop[index[1:]] & ~firm[index[:-1]]  # no text's first piece opens with a stop, as a blank comes first
        by_rule = pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False) | np.logical_or.reduceat(wrong, edges[:-1])
        # The text opens with a blank, so its first piece is always empty and is left out.
        number = {n: i for i, n in enumerate(names)}
        parts = []
        for i, (low, high) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if by_rule[i]:
                pieces = cut(texts[i].as_py())
                parts.append(np.array([number.setdefault(p, len(number)) for p in pieces], dtype=np.int64))
            else:
                parts.append(index[low + 1 : high])
        # Only the units that texts are made of are looked up.
        sizes, index, names = [len(p) for p in parts], np.concatenate(parts), list(number)
        used = np.bincount(index, minlength=len(names)) > 0
        return [names[i] for i in np.flatnonzero(used).tolist()], (np.cumsum(used) - 1)[index], np.concatenate([[0], np.cumsum(sizes)])

    def measures(self, with_groups: bool) -> dict[str, pa.Array]:
        """Per text its numbers of tokens, groups and links, its digest and groups."""
        columns = {}
        for place, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
            values = np.array([u[place] for u in self.units], dtype=np.int64)
            columns[name] = pa.array(np.where(self.full, np.add.reduceat(values[self.index], self.edges[:-1]), 0))
        written, numbers = [u.groups for u in self.units], self.index.tolist()
        digests, texts = [], []
        for low, high, ok in zip(self.edges[:-1].tolist(), self.edges[1:].tolist(), self.full.tolist(), strict=True):
            groups = b"".join([written[i] for i in numbers[low:high]])[:-1] if ok else b""
            digests.append(hashlib.sha256(groups).hexdigest() if ok else "")
            if with_groups:
                texts.append(groups.decode())
        columns["groups_sha256"] = pa.array(digests, pa.string())
        if with_groups:
            columns["groups"] = pa.array(texts, pa.string())
        return columns

    def units_of_texts(self) -> np.ndarray:
        """The units of all texts with tokens, one after the other."""
        return self.index[np.repeat(self.full, np.diff(self.edges))]


# A slice as it is written: its rows with their measures, the units of these rows, and the links of every unit.
_SLICE = "slice long, units binary, n_links binary, a_ids binary, b_ids binary"
_SLICE_BYTES = 1 << 20
_ROW_GROUP = 8 << 20


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each; a head of eight bytes says how many."""
    width = next(w for w in (1, 2, 4, 8) if int(values.max(initial=0)) >> 8 * w == 0)
    return bytes([width, *[0] * 7]) + values.astype(f"<u{width}").tobytes()


def _unpacked(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    blob = batch.column(name)[i].as_buffer()
    return np.frombuffer(blob, dtype=f"<u{blob[0]}", offset=8)


def _slices_of(a_path: str, b_path: str, body: str, n_units: str, with_groups: bool):
    """Rows to slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            others = [n for n in batch.schema.names if n != body]
            low = 0
            for texts in slices(batch.column(batch.schema.names.index(body)), _SLICE_BYTES):
                some = Batch(texts, aligner)
                measures = some.measures(with_groups)
                measures[n_units] = pa.array(np.where(some.full, np.diff(some.edges), 0))
                columns = [batch.column(n).slice(low, len(texts)) for n in others] + list(measures.values())
                rows = pa.StructArray.from_arrays(columns, names=others + list(measures))
                low += len(texts)
                used = np.bincount(some.units_of_texts(), minlength=len(some.units)) > 0
                units = [u for u, ok in zip(some.units, used.tolist(), strict=True) if ok]
                links = np.frombuffer(b"".join([u.links for u in units]), dtype="<i8")
                numbers = (
                    (np.cumsum(used) - 1)[some.units_of_texts()],
                    np.array([u.n_links for u in units], dtype=np.int64),
                    links >> _HALF,
                    links & ((1 << _HALF) - 1),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays([0, len(rows)], rows), pa.array([number]), *(pa.array([_packed(x)], pa.binary()) for x in numbers)],
                    names=["rows", *(c.split()[0] for c in _SLICE.split(", "))],
                )
                number += 1

    return run


def _read_links(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return _unpacked(batch, "a_ids", i).astype(np.int64) << _HALF | _unpacked(batch, "b_ids", i)


def _read_units(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Units of the rows, the unit of each link, and the number of units."""
    n_links = _unpacked(batch, "n_links", i)
    return _unpacked(batch, "units", i), np.repeat(np.arange(len(n_links)), n_links), len(n_links)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, places = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(found), dtype=np.int64)
    np.add.at(sums, places, np.concatenate(counts))
    return found, sums


def _sums(most: int = 500_000):
    """Slices to (key, n): their links, added up as far as ``most`` different ones are held."""

    def sent(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[low : low + 100_000]) for x in (keys, counts)], names=["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go()
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for batch in batches:
            for i in range(batch.num_rows):
                units, owners, n_units = _read_units(batch, i)
                some = _merged([_read_links(batch, i)], [np.bincount(units, minlength=n_units)[owners]])
                keys.append(some[0])
                counts.append(some[1])
                if sum(map(len, keys)) > 3 * most:
                    keys, counts = ([x] for x in _merged(keys, counts))
                    if len(keys[0]) > most:
                        yield from sent(keys[0], counts[0])
                        keys, counts = [], []
        if keys:
            yield from sent(*_merged(keys, counts))

    return run


_MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _sliced(docs: DataFrame, a: str, b: str, text: str, groups: bool, keep: bool) -> tuple[DataFrame, list[T.StructField]]:
    """All texts read once, as slices, and the fields of the columns kept beside them."""
    gone = {text.lower(), *(c.split()[0] for c in _MEASURES.split(", ")), *(["groups"] if groups else [])}
    body = free_name(docs, "body")
    kept = docs.select(*[c for c in docs.columns if keep and c.lower() not in gone], F.col(text).cast("string").alias(body))
    fields = [f for f in kept.schema.fields if f.name != body]
    made = T.StructType.fromDDL("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string").fields
    made += [T.StructField("groups", T.StringType())] if groups else []
    n_units = free_name(kept, "n_units")
    row = T.StructType([*fields, *made, T.StructField(n_units, T.LongType())])
    schema = T.StructType([T.StructField("rows", T.ArrayType(row)), *T.StructType.fromDDL(_SLICE).fields])
    path = scratch_path(docs.sparkSession, "slices")
    # A reader holds the wide values of a row group at once, so these are small.
    kept.mapInArrow(_slices_of(a, b, body, n_units, groups), schema).write.option("parquet.block.size", _ROW_GROUP).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path), fields


def _pairs(sliced: DataFrame) -> DataFrame:
    """key, n and a mark on the largest n of each B id, staged; there are no more maxima than ids."""
    sums = sliced.drop("rows").mapInArrow(_sums(), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    sums = staged(sums, "pair-sums")
    b_id = F.col("key").bitwiseAND(F.lit((1 << _HALF) - 1))
    most = staged(sums.groupBy(b_id.alias("b")).agg(F.max("n").alias("most")), "pair-maxima")
    return staged(sums.join(most, b_id == most["b"]).select("key", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def pair_counts(texts: DataFrame, *, a: str, b: str, text: str = "text") -> DataFrame:
    """(a_id, b_id, n, best) of every pair of ids linked in ``texts``: how many links hold it, and whether no pair
    with the same b_id has more. See :func:`align_tokenizers`."""
    sliced, _ = _sliced(texts, a, b, text, False, False)
    b_id = F.col("key").bitwiseAND(F.lit((1 << _HALF) - 1))
    return _pairs(sliced).select(F.shiftright("key", _HALF).cast("int").alias("a_id"), b_id.cast("int").alias("b_id"), "n", "best")


def align_tokenizers(
    docs: DataFrame, *, a: str, b: str, text: str = "text", groups: bool = False, most_sent: int = 3_000_000
) -> DataFrame:
    """The alignment of two tokenizers' tokens of each text: the byte-level ``tokenizers`` file ``a`` on the text with a blank
    before it, and the ``sentencepiece`` model ``b``, which adds that blank itself. All columns but the text are kept.

    New columns: n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair of ids no other pair with their B id
    surpasses in the corpus), count_sum (the corpus-wide counts of the links' pairs, added up), groups_sha256 and with
    ``groups`` the groups themselves, written as "a1,a2|b1;a3|b2,b3". Texts that are null or empty, or whose tokens do
    not have the bytes of the text with its blank in both vocabularies, have no tokens: zeros and '', and their links
    count nowhere. Repeated rows count as often as they are there; columns of these names give way; an empty table gives no rows.

    Texts are not shuffled. Pairs of ids are added up in the tasks before they are. Up to ``most_sent`` different pairs, which
    are counted first, are sent to all tasks; beyond, every slice meets only the pairs that its own texts hold.
    """
    sliced, fields = _sliced(docs, a, b, text, groups, True)
    out = T.StructType([*fields, *T.StructType.fromDDL(_MEASURES + (", groups string" if groups else "")).fields])
    pairs = _pairs(sliced)
    if pairs.count() <= most_sent:
        return sliced.mapInArrow(_by_sent_pairs(pairs, out.names), out)
    keys = sliced.select("slice", "a_ids", "b_ids").mapInArrow(_keys_of_slice, "slice long, key long")
    met = keys.join(pairs, "key")

    def measured(slices: pa.Table, known: pa.Table) -> pa.Table:
        look = _known(*_sorted_pairs(known))
        return pa.Table.from_batches([r for batch in slices.to_batches() for r in _rows(batch, look, out.names)])

    return sliced.groupBy("slice").cogroup(met.groupBy("slice")).applyInArrow(measured, out)


def _keys_of_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, number in enumerate(batch.column("slice").to_pylist()):
            keys = np.unique(_read_links(batch, i))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), number)), pa.array(keys)], names=["slice", "key"])


def _sorted_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = table.column("key").to_numpy()
    order = np.argsort(keys)
    return keys[order], table.column("n").to_numpy()[order], table.column("best").to_numpy()[order].astype(np.int64)


def _known(keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    def look(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.searchsorted(keys, links)
        return counts[places], best[places]

    return look


def _by_sent_pairs(pairs: DataFrame, names: list[str]):
    """Slices to rows, by the pairs as sorted arrays that every task gets; their number has been checked."""
    sent = pairs.sparkSession.sparkContext.broadcast(_sorted_pairs(pairs.toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go()
        look = _known(*sent.value)
        for batch in batches:
            yield from _rows(batch, look, names)

    return run


def _rows(batch: pa.RecordBatch, look, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of slices with the counts of their links."""
    for i in range(batch.num_rows):
        rows = batch.column("rows").slice(i, 1).flatten()
        units, owners, size = _read_units(batch, i)
        ends = np.concatenate([[0], np.cumsum(rows.field(rows.type.num_fields - 1).to_numpy())])
        made = {}
        for name, values in zip(("count_sum", "n_best"), look(_read_links(batch, i)), strict=True):
            per_unit = np.zeros(size, dtype=np.int64)
            np.add.at(per_unit, owners, values)
            sums = np.concatenate([[0], np.cumsum(per_unit[units])])
            made[name] = pa.array(sums[ends[1:]] - sums[ends[:-1]])
        yield pa.RecordBatch.from_arrays([made[n] if n in made else rows.field(n) for n in names], names=names)
