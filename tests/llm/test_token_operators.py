"""Token counts under edits, byte-level BPE, and token files, against the tokenizer libraries."""

import base64
import random
import time
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from fixtures import CLASHES, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seasonline.llm.byte_bpe import ByteBpe, byte_bpe, merged, round_trip_digests, with_decoded, with_token_ids
from seasonline.llm.edit_counts import EDITS, CountTree, scrub_edits, with_token_counts
from seasonline.llm.pieces import PieceMemo, cut
from seasonline.llm.token_files import NO_ID, open_shard, read_documents, read_manifest, write_token_files

RANKS, MULTI, JSON = (P.path(f"byte_bpe_{n}") for n in ("50k.tiktoken", "multi_50k.tiktoken", "50k.json"))
HOW = {"vocabulary": RANKS, "pattern": P.PATTERN}
BITS = [" ", "  ", "\n", "\t", "a", "aa", "th", "é", "漢", "\U0001f600", "'s", "1", "22", "!", "...", "\x1c", "\x85", "_", "A",
        "the", "ing", "ер", "\0", "\r\n", "%%%", " ", "́", "ß", " ", "<|endoftext|>"]


def library(path):
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_text(draw, n=25):
    return "".join(draw.choice(BITS) for _ in range(draw.randint(0, n)))


def test_pieces_join_to_the_text_and_encode_alone():
    draw, enc = random.Random(3), library(RANKS)
    memo = PieceMemo(lambda ps: [tuple(enc.encode_ordinary(p)) for p in ps], size=50)
    for _ in range(2000):
        text = odd_text(draw)
        assert "".join(cut(text)) == text
        assert [i for ids in memo.of_text(text) for i in ids] == enc.encode_ordinary(text)


@pytest.mark.parametrize("path", [RANKS, MULTI])
def test_merges_are_exact(path):
    draw, enc, bpe = random.Random(4), library(path), byte_bpe(path, P.PATTERN)
    for _ in range(3000):
        text = odd_text(draw)
        ids = bpe.encode(text)
        assert ids == enc.encode_ordinary(text)
        assert bpe.decode(ids).decode() == text
    for _ in range(300):
        piece = bytes(draw.choice(b"abndthe\xc3\xa9\xff ") for _ in range(draw.randint(1, 40)))
        assert [bpe.bytes_of[i] for i in bpe.encode_bytes(piece)] == merged(bpe.ranks, piece)


def test_a_very_long_piece_takes_linear_time():
    bpe = byte_bpe(MULTI, P.PATTERN)
    for text in ("a" * 300_000, "nd" * 100_000, " " * 100_000):
        assert bpe.decode(bpe.encode(text)).decode() == text


def test_a_vocabulary_without_a_byte_is_refused():
    from seasonline.llm.byte_bpe import ByteBpe

    with pytest.raises(ValueError):
        ByteBpe({b"a": 0}, P.PATTERN)


def test_round_trip_of_awkward_documents(spark):
    enc = library(MULTI)
    docs = documents(spark, clashes=True)
    got = round_trip_digests(docs, vocabulary=MULTI, pattern=P.PATTERN)
    assert set(c.split()[0] for c in CLASHES.split(", ")) <= set(got.columns)
    for r in got.collect():
        ids, body = enc.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == sha256(body).hexdigest()
        assert r["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
    both = with_decoded(with_token_ids(docs, vocabulary=MULTI, pattern=P.PATTERN), vocabulary=MULTI, pattern=P.PATTERN)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in both.collect())
    assert round_trip_digests(docs.limit(0), vocabulary=MULTI, pattern=P.PATTERN).count() == 0


def test_tree_follows_edits():
    draw, enc = random.Random(5), library(RANKS)
    count = lambda ps: [len(enc.encode_ordinary(p)) for p in ps]
    for _ in range(400):
        text = odd_text(draw, 40)
        tree = CountTree(text, count)
        for _ in range(draw.randint(1, 6)):
            start, length, new = draw.randint(-2, len(text) + 3), draw.randint(0, 8), odd_text(draw, 4)
            tree.replace(start, length, new)
            at = min(max(start, 0), len(text))
            text = text[:at] + new + text[at + max(length, 0) :]
            assert tree.text == text and tree.n_chars == len(text)
            assert tree.n_tokens == len(enc.encode_ordinary(text))


def test_an_edit_reencodes_little():
    enc = library(RANKS)
    text = "some words of a text that goes on " * 2000
    tree = CountTree(text, lambda ps: [len(enc.encode_ordinary(p)) for p in ps])
    tree.replace(30_001, 3, "new")
    assert tree.reencoded_chars < 40


def test_counts_of_awkward_documents(spark):
    enc = library(RANKS)
    docs = documents(spark, clashes=True)
    edits = F.array(
        F.struct(F.lit(0).cast("long").alias("start"), F.lit(3).cast("long").alias("length"), F.lit("New ").alias("replacement")),
        F.lit(None).cast(EDITS.elementType),
        F.struct(F.lit(10**9).alias("start"), F.lit(None).cast("long").alias("length"), F.lit(" end").alias("replacement")),
        F.struct(F.lit(None).cast("long").alias("start"), F.lit(1).cast("long").alias("length"), F.lit("never").alias("replacement")),
        F.struct(F.lit(2).cast("long").alias("start"), F.lit(1).cast("long").alias("length"), F.lit(None).cast("string").alias("replacement")),
    ).cast(EDITS)
    for r in with_token_counts(docs, edits, keep_text=True, **HOW).collect():
        body = r["text"] or ""
        after = "New " + body[3:] + " end"
        after = after[:2] + after[3:]
        assert (r["n_tokens"], r["n_edits"]) == (len(enc.encode_ordinary(body)), 3)
        assert r["edited"] == after and r["n_tokens_after"] == len(enc.encode_ordinary(after))
    none = with_token_counts(docs, None, **HOW).collect()
    assert all(r["n_edits"] == 0 and r["n_tokens"] == r["n_tokens_after"] for r in none)
    assert with_token_counts(docs.limit(0), None, **HOW).count() == 0


def test_scrub(spark):
    texts = ["mail a.b@c.org or 10.0.0.1\nLicensed under X.\nend 4111111111111111", "clean", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = with_token_counts(df.withColumn("e", scrub_edits(F.col("text"))), F.col("e"), keep_text=True, **HOW).collect()
    assert got[0]["edited"] == "mail <email> or <ip>\nend <card>"
    assert [r["n_edits"] for r in got] == [4, 0, 0, 0]


def test_token_files(spark, tmp_path):
    docs = documents(spark, clashes=True)
    folder = f"file://{tmp_path}/ids"
    write_token_files(docs, folder, vocabulary=JSON, end_id=2, shards=3)
    tokenizer = Tokenizer.from_file(JSON)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r))
    want, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    got = read_documents(spark, folder, with_ids=True).collect()
    assert sorted(tuple(r) for r in got if r[0] is not None) == [w for w in want if w[0] is not None]
    assert sorted(tuple(r)[1:] for r in got if r[0] is None) == [w[1:] for w in want if w[0] is None]
    assert read_manifest(spark, folder).agg(F.sum("n_tokens")).first()[0] == start
    shard = read_manifest(spark, folder).orderBy("shard").first()
    names, offsets, ids = open_shard(folder, shard["shard"], shard["id_bytes"])
    assert isinstance(ids, np.memmap) and ids.dtype == np.dtype("<u2") and len(offsets) == len(names) + 1
    assert names[0] == NO_ID and offsets[-1] == len(ids)


def test_token_files_of_nothing_and_of_wide_ids(spark, tmp_path):
    docs = documents(spark)
    write_token_files(docs.limit(0), str(tmp_path / "none"), vocabulary=JSON, end_id=2)
    assert read_documents(spark, str(tmp_path / "none")).count() == 0
    write_token_files(docs, str(tmp_path / "wide"), vocabulary=JSON, id_bytes=4, shards=2)
    with_end = read_documents(spark, str(tmp_path / "wide")).agg(F.sum("n_tokens")).first()[0]
    tokenizer = Tokenizer.from_file(JSON)
    assert with_end == sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect())


def _words_counted(pieces):
    return [len(p) for p in pieces]


def test_many_insertions_reencode_little():
    """Three thousand appends of two characters, and as many insertions in the middle, against the plain text."""
    for place in (lambda n: n, lambda n: n // 2, lambda n: 0):
        tree, text = CountTree("a short text.", _words_counted), "a short text."
        for i in range(3000):
            new, at = (" a" if i % 3 else "b "), place(len(text))
            tree.replace(at, 0, new)
            text = text[:at] + new + text[at:]
        assert tree.text == text and tree.n_tokens == tree.n_chars == len(text)
        assert tree.reencoded_chars < 100_000


def test_edits_at_random_against_the_plain_text():
    draw = random.Random(12)
    for _ in range(40):
        text = "".join(draw.choice(["a", "b ", " c", "\n", ". ", "dd"]) for _ in range(draw.randint(0, 60)))
        tree = CountTree(text, _words_counted)
        for _ in range(120):
            start, length = draw.randint(0, len(text) + 2), draw.choice([0, 0, 1, 3, 30, 10_000])
            new = "".join(draw.choice(["x", " ", "\n", "yy", "zz zz"]) for _ in range(draw.choice([0, 1, 4, 40])))
            tree.replace(start, length, new)
            start = min(start, len(text))
            text = text[:start] + new + text[start + length :]
            assert tree.text == text and tree.n_tokens == tree.n_chars == len(text)


def test_empty_leaves_are_skipped_by_the_sums():
    """One deletion leaves a hundred thousand empty leaves; edits beside them stay quick."""
    tree = CountTree("word " * 100_000 + "end", _words_counted)
    tree.replace(10, 499_980, "")
    started = time.perf_counter()
    for _ in range(2000):
        tree.replace(tree.n_chars // 2, 0, "x")
        tree.replace(tree.n_chars // 2, 1, "")
    assert time.perf_counter() - started < 5


def test_very_many_matches_take_linear_time(spark):
    text = " ".join(f"user{i}@mail.example.org" for i in range(100_000))
    started = time.perf_counter()
    row = spark.createDataFrame([(text,)], "text string").select(F.size(scrub_edits(F.col("text"))).alias("n")).first()
    assert row["n"] == 100_000 and time.perf_counter() - started < 20


def test_what_an_encoder_remembers_is_bounded():
    """A quarter of a million different words leave few of them, and few pairs of tokens, behind."""
    draw, bpe = random.Random(8), ByteBpe(byte_bpe(MULTI, P.PATTERN).ranks, P.PATTERN)
    for _ in range(25):
        bpe.encode(" ".join("".join(draw.choices("abcdefghij", k=8)) for _ in range(10_000)))
    assert sum(len(d) for m in (bpe._memo, bpe._words) for d in (m._young, m._old)) <= 260_000
    assert len(bpe._fits) <= 100_000
