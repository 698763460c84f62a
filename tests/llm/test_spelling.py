"""Spelling variants against every word by every other."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seasonline.llm.queries import slipped
from seasonline.llm.spelling import lower_ascii, near_counts, near_pairs, spelling_variants, word_counts
from fixtures import documents


def one_edit_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=5):
    near = {w: [x for x in counts if one_edit_apart(w, x)] for w in counts}
    forms = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda x: (-counts[x], x))
            if counts[best] >= ratio * counts[word]:
                forms[word] = best

    def root(word):
        while word in forms:
            word = forms[word]
        return word

    return {(w, forms.get(w), root(w), n, len(near[w]), counts.get(forms.get(w))) for w, n in counts.items()}


def drawn(seed, size=260, letters="abcé", longest=8):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(1, longest))) for _ in range(size)}
    return {w: draw.choice((1, 2, 5, 9, 30, 30, 200, 1000, 5000)) for w in sorted(words)}


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("tile", [1_000_000, 60])
def test_every_pair_is_accepted_once(spark, tile):
    """Also where groups are cut into many tiles."""
    counts = drawn(1)
    got = [tuple(r) for r in near_pairs(frame(spark, counts), tile=tile).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in counts for b in counts if one_edit_apart(a, b)}


@pytest.mark.parametrize(("seed", "tile"), [(2, 1_000_000), (3, 200)])
def test_forms_and_roots(spark, seed, tile):
    counts = drawn(seed)
    want = brute(counts)
    assert any(form and root != form for _, form, root, *_ in want)  # chains of several forms
    got = [tuple(r) for r in spelling_variants(frame(spark, counts), tile=tile).collect()]
    assert len(got) == len(want)
    assert set(got) == want


def test_a_hot_group_is_cut_and_nothing_is_lost(spark):
    """A thousand words that share their first half, with a tile of about forty of them."""
    draw = random.Random(5)
    counts = {"zzzzzz" + "".join(draw.choice("abcde") for _ in range(5)): draw.randint(1, 100) for _ in range(1000)}
    got = {tuple(r) for r in near_pairs(frame(spark, counts), tile=440).collect()}
    by_hole = {}
    for word in counts:
        for i in range(len(word)):
            by_hole.setdefault((i, word[:i] + word[i + 1 :]), []).append(word)
    assert got == {(a, b) for group in by_hole.values() for a in group for b in group if a != b}


def test_awkward_vocabularies(spark):
    """Null and empty words, null counts, repeated words, very long ones, signs beyond the basic plane, an empty table."""
    long = "x" * 5_000
    rows = [(None, 5), ("", 5), ("a", None), ("ab", 1), ("ab", 7), ("abc", 100), ("a\U0001f600c", 3), (long, 2), (long + "y", 40), ("z", 9)]
    words = spark.createDataFrame(rows, "word string, n long")
    assert {tuple(r) for r in spelling_variants(words).collect()} == {
        ("ab", "abc", "abc", 7, 1, 100),
        ("abc", None, "abc", 100, 2, None),
        ("a\U0001f600c", "abc", "abc", 3, 1, 100),
        (long, long + "y", long + "y", 2, 1, 40),
        (long + "y", None, long + "y", 40, 1, None),
        ("z", None, "z", 9, 0, None),
    }
    assert spelling_variants(words.limit(0)).collect() == []
    assert near_counts(words.where("word = 'z'")).collect() == []
    with pytest.raises(ValueError, match="ratio"):
        spelling_variants(words, ratio=1)


def test_words_of_awkward_documents(spark):
    """Whole texts, A-Z alone in small letters, clashing columns, and the slips by the checksum."""
    rows = [(i, "Éclair ÉCLAIR, éclair! mésange_Mésange×Mésange " * 40, "fr", "a", 1) for i in range(60)]
    docs = documents(spark, rows, clashes=True).unionByName(documents(spark, clashes=True))
    docs = docs.withColumns({"run": F.lit(1), "doc": F.lit("d"), "word": F.lit("w"), "n": F.lit(2)})
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain, changed = Counter(), Counter()
    for row in docs.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            run = run.translate(lower)
            plain[run] += 1
            h = zlib.crc32(f"{'' if row['doc_id'] is None else row['doc_id']}:{run}".encode())
            changed[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    for change, counts in ((None, plain), (slipped, changed)):
        want = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
        assert {r["word"]: r["n"] for r in word_counts(docs, change=change).collect()} == want
    assert set(plain) != set(changed)


def test_only_plain_capitals_become_small(spark):
    row = spark.createDataFrame([("ÀÉZ aZ", "AZ")], "a string, b string").select(lower_ascii(F.col("a")), lower_ascii(F.col("b"))).first()
    assert tuple(row) == ("ÀÉz az", "az")
