"""The pipeline's stages on a small corpus, and the registered queries."""

import random
from collections import Counter

import pytest
from fixtures import documents, prose
from pyspark.sql import functions as F
from test_duplicate_operators import plain_dedup, plain_fingerprint, plain_groups, plain_leaks

import __spark_entry__
import corpus_pipeline
from seasonline.llm.byte_bpe import byte_bpe
from seasonline.llm.queries import MULTI_RANKS, PATTERN, QUERIES


def test_every_operator_has_one_query():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    numbers = Counter(int(n[2:].split("_")[0]) for n in names if n[2].isdigit())
    assert numbers == Counter(range(1, 14)) and "pipeline" in __spark_entry__.queries()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("op5", "op6", "op10", "op11"))])
def test_a_row_for_every_document(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A corpus with junk, toxic texts, near copies, shared passages and leaks."""
    draw = random.Random(8)
    shared, items = prose(500, 80), [(i, prose(600 + i, 40)) for i in range(4)]
    texts = {i: prose(i, draw.randint(60, 200)) for i in range(1, 161)}
    labels = []
    for i in range(1, 161):
        labels.append((i, 1, 0))
    for i in range(161, 221):
        texts[i] = " ".join(w + draw.choice(["***", "&&&", "%%%"]) for w in prose(i, 90).split())
        labels.append((i, 0, 0))
    for i in range(221, 281):
        words = prose(i, 90).split()
        for w in ["idiot", "moron", "trash", "loser"]:
            words.insert(draw.randint(0, len(words)), w)
        texts[i] = " ".join(words)
        labels.append((i, 1, 1))
    for i in range(281, 291):
        texts[i] = texts[i - 280]  # exact copies
    texts[291] = texts[11] + " x"
    for i in (20, 30, 40):
        texts[i] += "\n" + shared + "\n" + prose(700 + i, 30)
    texts[50] += " " + items[1][1]
    texts[60] = items[2][1] + " " + texts[60]
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    rows += [(None, None, None, None, None), (300, "", "en", None, 0), (300, "", "en", None, 0)]
    folder = str(tmp_path_factory.mktemp("tables"))
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, items


def test_stages_step_by_step(spark, tables):
    folder, texts, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.good_quality(spark, docs, folder)
    assert good.columns == docs.columns
    ids = {r["doc_id"] for r in good.collect()}
    assert not ids & set(range(161, 281))
    assert len(ids & set(range(1, 161))) == 160

    one = corpus_pipeline.one_of_each_group(spark, good, folder)
    assert one.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in good.collect()]
    group = plain_groups([plain_fingerprint(t, 3) for _, t in left], 3)
    best = {}
    for (i, _), g in zip(left, group, strict=True):
        best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    kept = sorted(((r["doc_id"] is None, r["doc_id"] or 0) for r in one.collect()))
    assert kept == sorted(best.values())
    assert not {r["doc_id"] for r in one.collect()} & set(range(281, 291))

    cut = corpus_pipeline.no_repeated_passages(spark, one, folder)
    rows = [(r["doc_id"], r["text"]) for r in one.collect()]
    want = plain_dedup(rows)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {i: want[i, t] if t else t for i, t in rows}
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in cut.collect())

    clean = corpus_pipeline.no_benchmark_items(spark, cut, folder)
    leaks = plain_leaks([(r["doc_id"], r["text"]) for r in cut.collect()], items)
    assert {50, 60} <= {d for d, _ in leaks}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in cut.collect()} - {d for d, _ in leaks}

    bpe = byte_bpe(MULTI_RANKS, PATTERN)
    ids = corpus_pipeline.token_ids(spark, clean, folder)
    texts = {r["doc_id"]: r["text"] or "" for r in clean.collect()}
    for r in ids.collect():
        assert r["token_ids"] == bpe.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["token_ids"]) and r["round_trip"]
    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == ids.columns and whole.count() == clean.count()


def test_stages_on_awkward_and_empty_tables(spark, tables):
    folder = tables[0]
    for docs in (documents(spark, clashes=True), documents(spark).limit(0)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            assert out.count() <= docs.count()
            if number < 4:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_repeated_rows_leave_one(spark, tables):
    rows = [(None, "a b c d e", None, None, None)] * 2 + [(4, "a b c d e", None, None, None)] * 3 + [(4, "other text here", None, None, None)] * 2
    got = corpus_pipeline.one_of_each_group(spark, documents(spark, rows), tables[0])
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(4, "a b c d e"), (4, "other text here")]
    assert got.where(F.col("doc_id").isNull()).count() == 0
