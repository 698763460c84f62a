"""Alignment of two tokenizers against both libraries on whole texts, byte by byte."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seasonline.llm.alignment import Aligner, align_tokenizers, coalesce, overlaps, pair_counts
from seasonline.llm.queries import PIECES, QUERIES, TOKENIZER
from fixtures import documents

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _libraries():
    a = Tokenizer.from_file(TOKENIZER)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def _letters():
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute_tokens(text, a, b, letters=_letters()):
    """(id, start, end) of both sides, or None."""
    if not text:
        return None
    whole = (" " + text).encode()
    found = a.encode(" " + text, add_special_tokens=False)
    sides = [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens, strict=True)], []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        sides[1].append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    out = []
    for side in sides:
        if b"".join(x for _, x in side) != whole:
            return None
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def brute(texts):
    a, b = _libraries()
    tokens = [brute_tokens(t, a, b) for t in texts]
    links, groups = [], []
    for both in tokens:
        if both is None:
            links.append([])
            groups.append(None)
            continue
        links.append([(x[0], y[0]) for x in both[0] for y in both[1] if x[1] < y[2] and y[1] < x[2]])
        cuts = sorted({x[2] for x in both[0]} & {y[2] for y in both[1]})
        parts, low = [], 0
        for high in cuts:
            parts.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in both))
            low = high
        groups.append(parts)
    counts = Counter(x for some in links for x in some)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    rows = []
    for both, some, parts in zip(tokens, links, groups, strict=True):
        if both is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(counts[x] == most[x[1]] for x in some)
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest()
        rows.append((len(both[0]), len(both[1]), len(parts), len(some), best, sum(counts[x] for x in some), digest))
    return rows, counts, most


HOSTILE = [
    None, "", " ", "  ", "\n", "\n\n", "a", " a", "a ", "a  b", "a\nb", "a\n\n b", "\na", "a▁b", "▁", "▁ x", "<s> </s> <unk>", "<0x0A>",
    "<|endoftext|> and <|endoftext|>", "a\0b", "\0", "x \0 y\n", "\t tab\r\n line", "Straße, naïve — “quoted”", "漢字 かな \U0001f600\U0001f600 ́e", "\x85 \x1c\xa0z　w",
    "it's we'll I'd", "1234 5678.90, 3,4", "...!!! ???", "x" * 3000, "ab" * 500 + " " + "é" * 300, "﻿bom ​zero", "ﬁ ﬂ ½", "don't\n  indent\n\ttab",
]


def drawn(n, seed=3):
    draw = random.Random(seed)
    parts = [" ", " ", "\n", "a", "the", "tion", "é", "漢", "\U0001f600", ".", ",", "'s", "12", "\t", "\r", "\0", "<s>", "▁", "\xa0", "Z", "_", "--"]
    weights = [8] * 3 + [4] * 13 + [1] * 6
    return ["".join(draw.choices(parts, weights, k=draw.randint(1, 30))) for _ in range(n)]


def _rows(frame, names=MEASURES):
    return [tuple(r[n] for n in names) for r in frame.orderBy("place").collect()]


@pytest.mark.parametrize("most_sent", [3_000_000, 0])
def test_measures_of_hostile_texts(spark, most_sent):
    """Both ways to look counts up: pairs sent to the tasks, and slices with their own pairs."""
    texts = HOSTILE + drawn(1500) + ["the same text again"] * 200
    want, *_ = brute(texts)
    assert sum(r[0] == 0 for r in want) > 20
    frame = spark.createDataFrame(list(enumerate(texts)), "place int, text string").repartition(4)
    assert _rows(align_tokenizers(frame, a=TOKENIZER, b=PIECES, most_sent=most_sent)) == want


def test_counts_of_pairs(spark):
    texts = HOSTILE + drawn(300, 5)
    _, counts, most = brute(texts)
    pairs = pair_counts(spark.createDataFrame([(t,) for t in texts], "text string"), a=TOKENIZER, b=PIECES).collect()
    assert {(r["a_id"], r["b_id"]): r["n"] for r in pairs} == counts
    assert all(r["best"] == (r["n"] == most[r["b_id"]]) for r in pairs)


def test_groups_read_back(spark):
    """The written groups are the two token sequences."""
    a, b = _libraries()
    docs = documents(spark, [(1, "Unbelievable tokenisations, naturellement.", "en", "a", 1)])
    row = align_tokenizers(docs, a=TOKENIZER, b=PIECES, groups=True).first()
    sides = [[int(i) for part in row["groups"].split(";") for i in part.split("|")[s].split(",")] for s in (0, 1)]
    assert sides == [a.encode(" Unbelievable tokenisations, naturellement.").ids, b.encode("Unbelievable tokenisations, naturellement.")]
    assert row["groups_sha256"] == hashlib.sha256(row["groups"].encode()).hexdigest()
    assert "text" not in row and row["source"] == "a"


@pytest.mark.parametrize("most_sent", [3_000_000, 0])
def test_awkward_tables(spark, most_sent):
    """Nulls, repeated rows, very long texts, clashing names, no rows."""
    clashes = {"body": F.lit("b"), "slice": F.lit(1), "rows": F.lit(2), "units": F.lit(3), "n_units": F.lit("u"), "key": F.lit("k"), "N_A": F.lit("n"), "best": F.lit(0)}
    docs = documents(spark, clashes=True).withColumns(clashes)
    got = align_tokenizers(docs, a=TOKENIZER, b=PIECES, most_sent=most_sent)
    assert set(clashes) - {"N_A"} <= set(got.columns) and got.count() == docs.count()
    texts = [r["text"] for r in docs.select("text").collect()]
    want, *_ = brute([t if t is None or len(t) < 50_000 else None for t in texts])
    short = [tuple(r[n] for n in MEASURES) for r in got.where("n_chars < 50000 or n_chars is null").collect()]
    # Counts also hold the very long texts' links, which the plain version leaves out.
    nothing = [(0,) * 6 + ("",)] * sum(t is not None and len(t) >= 50_000 for t in texts)
    assert sorted((*r[:4], r[6]) for r in short + nothing) == sorted((*r[:4], r[6]) for r in want)
    whole = got.where("n_chars >= 50000").collect()
    assert len(whole) == len(nothing) and all(r["n_a"] > 1000 and r["n_best"] <= r["n_links"] for r in whole)
    assert align_tokenizers(docs.limit(0), a=TOKENIZER, b=PIECES, most_sent=most_sent).collect() == []


def test_vocabularies_that_do_not_part(spark):
    """Without a cut a whole text is one unit, with the same result."""
    texts = [t for t in HOSTILE if t] + drawn(100, 9)
    parted, whole = Aligner(TOKENIZER, PIECES), Aligner(TOKENIZER, PIECES)
    assert parted.by_unit
    want, *_ = brute(texts)
    found = whole.aligned([" " + t for t in texts])
    assert [(max(u.n_a, 0), u.n_b, u.n_groups, u.n_links) for u in found] == [r[:4] for r in want]


def test_coalescing_by_hand():
    starts, ends = np.array([0, 3, 5, 0, 2, 5]), np.array([3, 5, 8, 2, 5, 8])
    order, groups = coalesce(starts, ends)
    assert groups[np.argsort(order)].tolist() == [0, 0, 1, 0, 0, 1]
    a, b = overlaps(starts[:3], ends[:3], starts[3:], ends[3:])
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 2)]


def test_query_on_the_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    docs = [r for r in docs if r["text"] is None or len(r["text"]) < 4000]
    got = {r["doc_id"]: r for r in QUERIES["op13_tokenizer_alignment"](spark, sf_dir).collect()}
    want, *_ = brute([r["text"] for r in docs])
    for row, w in zip(docs, want, strict=True):
        assert tuple(got[row["doc_id"]][n] for n in (*MEASURES[:4], "groups_sha256")) == (*w[:4], w[6])
