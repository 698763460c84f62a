"""Byte-level BPE from a rank file: exact merges in linear time, and back to bytes.

A sequence of tokens is the encoding of its bytes just if every two neighbours are compatible, that is
if no merge would have crossed their border before both were whole. So the encoder walks forward with
the longest vocabulary match at each byte, and backtracks to shorter ones where neighbours do not fit.
Matches come from an Aho-Corasick automaton over the bytes, written as Latin-1 characters.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice, pairwise

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.llm.common import free_name, held_by_worker
from seasonline.llm.pieces import PieceMemo, batch_ids, slices

_NEVER = 1 << 60


def merged(ranks: dict[bytes, int], piece: bytes, below: int = _NEVER) -> list[bytes]:
    """``piece`` merged pair by pair, lowest rank first, by ranks under ``below``: the definition."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = below, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1], _NEVER)
            if rank < best:
                best, at = rank, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class _Compatible(dict):
    """Whether two tokens can stand side by side, remembered for the pairs met lately."""

    def __init__(self, crossed, size: int = 100_000):
        super().__init__()
        self._crossed, self._size = crossed, size

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= self._size:
            self.clear()
        self[pair] = fits = not self._crossed(*pair)
        return fits


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks a single byte")
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.decimal_of = {i: str(i) for i in ranks.values()}
        self._pattern = regex.compile(pattern)
        self._halves: dict[int, tuple[int, int]] = {}
        self._fits = _Compatible(self._crossed)
        automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = merged(ranks, token, rank)
                if len(parts) != 2:
                    continue  # no merges lead to it: it only stands for a piece that equals it
                self._halves[rank] = (ranks[parts[0]], ranks[parts[1]])
            automaton.add_word(token.decode("latin-1"), rank)
        automaton.make_automaton()
        self._automaton = automaton
        self._sizes = {rank: len(token) for token, rank in ranks.items()}
        self._shorter = {rank: self._next_shorter(token) for token, rank in ranks.items()}
        # Every worker of an executor holds these, beside what stages before have left in it.
        self._memo = PieceMemo(self._encode_pieces, size=80_000)
        self._words = PieceMemo(lambda words: [self._encode_word(w) for w in words], size=30_000)

    def encode(self, text: str) -> list[int]:
        """The token ids of a text."""
        return np.frombuffer(b"".join(self._memo.of_text(text)), dtype="<u4").tolist()

    def encode_batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The token ids of each text of an Arrow array; a null text has none."""
        return batch_ids(texts, self._memo, "<u4")

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        split = [self._pattern.findall(p) for p in pieces]
        ids = iter(self._words.values(list(chain.from_iterable(split))))
        return [b"".join(islice(ids, len(words))) for words in split]

    def _encode_word(self, word: str) -> bytes:
        piece = word.encode()
        whole = self.ranks.get(piece)
        return array("I", [whole] if whole is not None else self.encode_bytes(piece)).tobytes()

    def encode_bytes(self, piece: bytes) -> list[int]:
        """The merges of one piece, in time linear in its length."""
        text = piece.decode("latin-1")
        tokens = [token for _, token in self._automaton.iter_long(text)]
        if all(map(self._fits.__getitem__, pairwise(tokens))):
            return tokens  # the longest matches, one after the other, already fit
        return self._backtracked(text)

    def _backtracked(self, text: str) -> list[int]:
        n, size_of, shorter_than, fits = len(text), self._sizes, self._shorter, self._fits
        longest = [0] * n
        for end, token in self._automaton.iter(text):
            longest[end + 1 - size_of[token]] = token  # later ends are longer matches
        dead = bytearray(n + 1)  # places from which no compatible rest leads to the end
        tokens: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + size_of[token]
            if not dead[end] and (not tokens or fits[tokens[-1], token]):
                tokens.append(token)
                at = end
                if at < n:
                    token = longest[at]
                continue
            token = shorter_than[token]
            while token < 0:
                dead[at] = 1
                at -= size_of[tokens[-1]]
                token = shorter_than[tokens.pop()]
        return tokens

    def _next_shorter(self, token: bytes) -> int:
        """The longest token in the automaton that ``token`` starts with, or -1."""
        for size in range(len(token) - 1, 0, -1):
            rank = self.ranks.get(token[:size])
            if rank is not None and (size == 1 or rank in self._halves):
                return rank
        return -1

    def _crossed(self, left: int, right: int) -> bool:
        """Whether a merge over the border comes before the two tokens are whole.

        Goes back in time: the token that was formed last is taken apart, and its half at the border is
        what stood there before. A pair that stood together until one of them was merged away is crossed
        if its own merge has a lower rank; on equal ranks the merge further left comes first.
        """
        left_until = right_until = _NEVER
        while True:
            merge = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], _NEVER)
            if merge < left_until and merge <= right_until and merge in self._halves:
                return True
            left_parts, right_parts = self._halves.get(left), self._halves.get(right)
            if left_parts and (not right_parts or left > right):
                left_until, left = left, left_parts[1]
            elif right_parts:
                right_until, right = right, right_parts[0]
            else:
                return False


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The encoder of a rank file (base64 token and rank per line), kept by the worker."""

    def build() -> ByteBpe:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return ByteBpe(ranks, pattern)

    return held_by_worker(("bpe", path, pattern), build)


def with_token_ids(
    docs: DataFrame,
    *,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    ids: str = "token_ids",
    round_trip: str | None = None,
) -> DataFrame:
    """``docs`` with the token ids of their texts as an array; a null text counts as empty.

    With ``round_trip`` a column of that name says whether the ids decode to the text again. Rows are
    independent: repeated rows, ties and an empty table need no rule. Columns of these names in ``docs``
    give way. No shuffle. Texts go through a worker a few megabytes at a time.
    """
    added = [ids, *([round_trip] if round_trip else [])]
    kept = [c for c in docs.columns if c not in added]
    hold = free_name(docs, "body")
    given = docs.select(*kept, F.col(text).alias(hold))
    fields = [*given.schema.fields[:-1], T.StructField(ids, T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(round_trip, T.BooleanType())] if round_trip else []

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary, pattern)
        for batch in batches:
            at = 0
            for some in slices(batch.column(len(kept))):
                found = list(bpe.encode_batch(some))
                offsets = np.zeros(len(found) + 1, dtype=np.int32)
                np.cumsum([len(a) for a in found], out=offsets[1:])
                values = pa.array(np.concatenate(found).view(np.int32) if found else np.empty(0, np.int32))
                columns = [c.slice(at, len(some)) for c in batch.columns[: len(kept)]]
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), values))
                if round_trip:
                    bodies = ((t or "").encode() for t in some.to_pylist())
                    columns.append(pa.array([bpe.decode(a.tolist()) == b for a, b in zip(found, bodies, strict=True)], pa.bool_()))
                at += len(some)
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return given.mapInArrow(encoded, T.StructType(fields))


def with_decoded(tokens: DataFrame, *, vocabulary: str, pattern: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes that their ids stand for; a null array counts as empty.

    Ids that the vocabulary lacks raise an error. A column named ``into`` gives way. No shuffle.
    """

    @F.pandas_udf(T.BinaryType())
    def decoded(arrays: pd.Series) -> pd.Series:
        bpe = byte_bpe(vocabulary, pattern)
        return pd.Series([bpe.decode([] if a is None else a.tolist()) for a in arrays], dtype=object)

    return tokens.withColumn(into, decoded(F.col(ids)))


_DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def round_trip_digests(docs: DataFrame, *, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with the digests of encoding and decoding their texts, without carrying ids between stages.

    n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 (of the bytes that the
    ids decode to) replace columns of these names. Other rules are those of ``with_token_ids``.
    """

    @F.pandas_udf(_DIGESTS)
    def digests(texts: pd.Series) -> pd.DataFrame:
        bpe = byte_bpe(vocabulary, pattern)
        rows = []
        for found in bpe.encode_batch(pa.Array.from_pandas(texts, type=pa.large_string())):
            ids = found.tolist()
            decimal = ",".join(map(bpe.decimal_of.__getitem__, ids)).encode()
            rows.append(
                (len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest())
            )
        return pd.DataFrame(rows, columns=_DIGESTS.names)

    hold = free_name(docs, "digests")
    return docs.withColumn(hold, digests(F.col(text))).select(
        *[c for c in docs.columns if c not in _DIGESTS.names],
        *[F.col(hold)[c].alias(c) for c in _DIGESTS.names],
    )
