"""Near-duplicates, repeated passages and benchmark leaks, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from fixtures import CLASHES, documents, prose
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from seasonline.llm import span_dedup
from seasonline.llm.benchmark_leaks import RADIUS, find_leaks, simhash_of, weighted_jaccard, without_leaks, words_of
from seasonline.llm.components import component_roots
from seasonline.llm.simhash_near import fingerprint_of, near_groups, near_links
from seasonline.llm.span_dedup import _located, _low_halves, _windows, _words, sentences, spans, without_repeated_spans


def plain_fingerprint(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(words, radius):
    """Component numbers of fingerprints by comparing all with all."""
    root = list(range(len(words)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(words)):
        for j in range(i):
            if (words[i] ^ words[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(words))]


def test_fingerprints_by_definition():
    draw = random.Random(1)
    for text in [None, "", " \t\n\x0b", "One", "one two", "A b C d", "é x y z", prose(9, 300)]:
        for k in (1, 3):
            assert fingerprint_of(text, k) == plain_fingerprint(text, k)
    for _ in range(50):
        text = "".join(draw.choice("aBc \n\x0c\x1c é") for _ in range(draw.randint(0, 60)))
        assert fingerprint_of(text, 3) == plain_fingerprint(text, 3)


def test_groups_of_awkward_documents(spark):
    docs = documents(spark, clashes=True)
    got = near_groups(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == docs.count()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = [plain_fingerprint(t, 3) for _, t in rows]
    group = plain_groups(prints, 3)
    want = []
    for (doc_id, _), p, g in zip(rows, prints, group, strict=True):
        ids = [r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None]
        want.append((doc_id, f"{p:016x}", min(ids, default=None)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert near_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [8, 64, 4096])
def test_links_join_all_near_words(spark, tile):
    """Crowded keys, chains, tiles of one and of many slices: the groups stay those of brute force."""
    draw = random.Random(tile)
    words = {draw.getrandbits(64) for _ in range(150)}
    centre = draw.getrandbits(64)
    words |= {centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 6))) for _ in range(250)}
    chain = draw.getrandbits(64)
    for _ in range(40):
        chain ^= sum(1 << b for b in draw.sample(range(64), 3))
        words.add(chain)
    words = sorted(words)
    signed = np.array(words, dtype=np.uint64).view(np.int64).tolist()
    links = near_links(spark.createDataFrame([(w,) for w in signed], "fp long"), 3, tile=tile)
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)) for r in links.collect())
    roots = {r["node"]: r["root"] for r in component_roots(links).collect()}
    group = plain_groups(words, 3)
    by_group, by_root = {}, {}
    for w, g in zip(signed, group, strict=True):
        by_group.setdefault(g, set()).add(w)
        by_root.setdefault(roots.get(w, w), set()).add(w)
    assert sorted(map(sorted, by_group.values())) == sorted(map(sorted, by_root.values()))


def test_components_of_paths_stars_and_odd_links(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1300)] + [(7, 7), (None, 3), (2000, 2001), (2001, 2000)]
    roots = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1300)}, 2000: 2000, 2001: 2000}
    assert component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated passages -----------------------------------------------------------------------------


def plain_dedup(rows, least=30, alone=50):
    """Kept text of each (id, text): every span by every other, in order of id and place."""
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t})
    seen, kept = {}, {}
    located = []
    for place, (_, _, text) in enumerate(order):
        parts = sentences(text)
        first, last, found = spans(parts, least, alone)
        located += [(h, place, int(a), int(z)) for a, z, h in zip(first, last, found, strict=True)]
    for h, place, a, _ in sorted(located, key=lambda x: (x[1], x[2])):
        seen.setdefault(h, (place, a))
    for place, (has, i, text) in enumerate(order):
        parts = sentences(text)
        gone = {k for h, p, a, z in located if p == place and seen[h] != (p, a) for k in range(a, z + 1)}
        kept[i if has else None, text] = "".join(s for k, s in enumerate(parts) if k not in gone)
    return kept


def test_sentences_join_to_the_text():
    for text in ["", "a", "A b. C d!  E?\n\nf", "x.y z.\n", "one\ntwo", "...\n...", prose(3, 200)]:
        assert "".join(sentences(text)) == text


def test_spans_cover_every_long_passage():
    """Whatever the lengths of a passage's sentences, its spans cover it if it has over 50 words."""
    draw = random.Random(2)
    for _ in range(500):
        sizes = [draw.randint(1, 49) for _ in range(draw.randint(2, 12))]
        if sum(sizes) <= 50:
            continue
        first, last, _ = spans([" ".join(["w"] * n) + ". " for n in sizes], 30, 50)
        covered = {k for a, z in zip(first, last, strict=True) for k in range(a, z + 1)}
        assert covered == set(range(len(sizes)))


def test_repeats_are_removed_but_the_first(spark):
    shared, other = prose(21, 60), prose(22, 55)
    rows = [
        (5, prose(23, 40) + "\n" + shared + "\n" + prose(24, 30)),
        (2, shared),
        (9, prose(25, 35) + " " + shared.upper() + " " + other),
        (8, other + "\n" + prose(26, 20) + "\n" + other),
        (7, "Short line. Again.\n" + prose(27, 20)),
        (6, "Short line. Again.\n" + prose(28, 20)),
        (3, "w " * 60 + "alone."),
        (4, prose(29, 15) + " " + "w " * 60 + "alone. Tail."),
    ]
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    got = {r["doc_id"]: r["text"] for r in without_repeated_spans(docs).collect()}
    want = plain_dedup(rows)
    assert got == {i: want[i, t] for i, t in rows}
    assert got[2] == shared and shared not in got[5] and got[7] == rows[4][1] and got[6] == rows[5][1]
    assert got[8].count(other) == 1 and other not in got[9] and shared.upper() not in got[9]


def test_passages_in_awkward_documents(spark):
    docs = documents(spark, clashes=True)
    got = without_repeated_spans(docs, counts=("sentences", "removed"))
    assert got.columns == [*docs.columns, "sentences", "removed"]
    want = plain_dedup([(r["doc_id"], r["text"]) for r in docs.collect()])
    source = docs.collect()
    out = got.collect()
    assert len(out) == len(source)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    left = sorted(((r["doc_id"], r["text"]) for r in out), key=key)
    right = sorted(((r["doc_id"], want[r["doc_id"], r["text"]] if r["text"] else r["text"]) for r in source), key=key)
    assert left == right
    assert [c for c in docs.columns if c != "text"] and all(r["mark"] == 1 and r["cut"] == "c" for r in out)
    assert without_repeated_spans(docs.limit(0)).count() == 0


def plain_windows(rows, size=50):
    """Places of the words that lie in a window met before, each window by every other."""
    seen, gone = {}, {}
    for i, text in sorted(rows):
        words = text.lower().split()
        for at in range(len(words) - size + 1):
            doc, first = seen.setdefault(tuple(words[at : at + size]), (i, at))
            if (doc, first) != (i, at) and not (doc == i and at - first < size):
                gone.setdefault(i, set()).update(range(at, at + size))
    return gone


def test_passages_that_end_inside_sentences(spark):
    """Three sentences of 18 words in running text, one sentence of 49 words with parts of others, periods."""
    words = lambda seed, n: prose(seed, n).lower().replace(".", "").split()
    three = [" ".join(words(200 + i, 18)) for i in range(3)]
    lone, rest = words(210, 49), words(211, 40)
    again = " ".join(words(212, 7))
    rows = [
        (1, f"{three[0]}. {three[1]}. {three[2]} and so on."),
        (2, f"Here it runs on with {three[0]}. {three[1]}. {three[2]} which ends in another way. " + prose(213, 30)),
        (3, " ".join(rest[:5]) + ". " + " ".join(lone) + ". " + " ".join(rest[5:]) + "."),
        (4, "Other words " + " ".join(rest[2:5]) + ". " + " ".join(lone) + ". " + " ".join(rest[5:9]) + " other words."),
        (5, " ".join([again] * 40)),
        (6, "at first " + " ".join([again] * 9) + " at last"),
        (7, " ".join(words(214, 49)) + " one"),
        (8, " ".join(words(214, 49)) + " two"),
        (9, " \n" + " ".join(words(215, 50))),
        (10, "So: " + " ".join(words(215, 50)).upper() + "\n"),
    ]
    # A passage at every place of a text of several stretches, taken from anywhere in another.
    draw = random.Random(3)
    source = words(216, 34_000)
    for i in range(11, 31):
        at, n = draw.choice([0, 32_700, draw.randrange(33_000)]), draw.randint(50, 90)
        rows.append((i, " ".join(words(300 + i, draw.randint(0, 60)) + source[at : at + n] + words(400 + i, draw.randint(0, 60)))))
    rows.append((0, " ".join(source)))
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    got = {r["doc_id"]: (r["text"].lower().split(), r["m"]) for r in without_repeated_spans(docs, counts=("n", "m")).collect()}
    gone = plain_windows(rows)
    assert {2, 4, 5, 6, 10, *range(11, 31)} == set(gone)
    for i, text in rows:
        assert got[i][0] == [w for at, w in enumerate(text.lower().split()) if at not in gone.get(i, ())]
        assert (got[i][1] > 0) == (i in gone)


# --- benchmark leaks -------------------------------------------------------------------------------


def plain_leaks(docs, items, least=0.8):
    """(document, item) pairs by sliding every item over every document, word by word."""
    tokens = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    shingles = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    found = set()
    for item_id, item in items:
        wanted = tokens(item)
        if not wanted:
            continue
        b = shingles(wanted)
        for doc_id, text in docs:
            words = tokens(text)
            for start in range(-len(wanted) + 1, len(words)):
                part = words[max(0, start) : max(0, start + len(wanted))]
                if part:
                    a = shingles(part)
                    if (a & b).total() / (a | b).total() >= least:
                        found.add((doc_id, item_id))
                        break
    return found


def test_leaks_by_brute_force(spark):
    items = [(i, prose(100 + i, 20 + 3 * i)) for i in range(8)] + [(50, "four words and few"), (51, ""), (52, None), (None, prose(160, 30)), (60, prose(170, 90))]
    words = lambda i: items[i][1].split()
    docs = [
        (1, prose(1, 50) + " " + items[3][1] + " " + prose(2, 50)),
        (2, items[7][1].upper().replace(" ", " -- ")),
        (3, " ".join(words(7)[:20] + ["changed"] + words(7)[20:])),
        (12, prose(8, 20) + " " + " ".join(words(12)[:40] + ["changed"] + words(12)[40:]) + " " + prose(9, 20)),
        (4, " ".join(words(7)[: len(words(7)) // 2]) + " " + prose(3, 40)),
        (5, prose(4, 30) + "\n" + items[0][1] + "\n" + items[1][1]),
        (6, "before Four, words AND few after"),
        (7, prose(5, 500)),
        (8, None),
        (9, ""),
        (None, prose(6, 10) + " " + items[2][1]),
        (10, "\n".join(words(5)[2:])),
        (11, items[11][1]),
        (11, items[11][1]),
    ]
    frame = documents(spark, [(i, t, None, None, None) for i, t in docs], clashes=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_leaks(frame, bench)
    assert {(r["doc"], r["item_id"]) for r in got.collect()} == plain_leaks(docs, items)
    assert (12, 60) in {(r["doc"], r["item_id"]) for r in got.collect()}
    assert all(0.8 <= r["similarity"] <= 1 and r["start_word"] >= 0 for r in got.collect())
    clean = without_leaks(frame, bench)
    leaked = {d for d, _ in plain_leaks(docs, items)}
    assert clean.columns == frame.columns
    assert sorted((r["doc_id"] for r in clean.collect())) == sorted(d for d, _ in docs if d not in leaked)
    assert without_leaks(frame, bench.limit(0)).count() == frame.count()
    assert find_leaks(frame.limit(0), bench).count() == 0


def test_leaks_cut_at_the_ends(spark):
    """Copies that lack five of their words at an end are similar by 0.8, however far their fingerprints lie."""

    def fingerprint(words):
        hashes = [xxh64_intdigest(w, 42) for w in words]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    items, docs, far = [], [], 0
    for seed in range(400):
        draw = random.Random(seed)
        item, around = (["".join(draw.choices("abcdefghij", k=7)) for _ in range(n)] for n in (50, 20))
        window = around[5:10] + item[5:]
        beyond = (fingerprint(window) ^ fingerprint(item)).bit_count() > RADIUS
        far += beyond
        if beyond or seed < 3:
            items.append((seed, " ".join(item)))
            docs.append((seed, " ".join(around[:10] + item[5:] + around[10:])))
            docs.append((1000 + seed, " ".join(around[:10] + item[:-5] + around[10:])))
            docs.append((2000 + seed, " ".join(around[:10] + item[6:] + around[10:])))
    assert far
    got = find_leaks(documents(spark, [(*d, None, None, None) for d in docs]), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc"], r["item_id"]): (r["start_word"], r["similarity"]) for r in got.collect()}
    assert set(got) == plain_leaks(docs, items) == {(i + at, i) for i, _ in items for at in (0, 1000)}
    assert all(got[i, i] == (5, pytest.approx(41 / 51)) for i, _ in items)


def test_windows_of_a_long_document_come_in_stretches(spark, monkeypatch):
    """A phrase of several items all over a document: no row holds its windows as a whole."""
    from seasonline.llm import benchmark_leaks

    held = {}

    def kept(frame, label):
        held[label] = staged(frame, label)
        return held[label]

    staged = benchmark_leaks.staged
    monkeypatch.setattr(benchmark_leaks, "staged", kept)
    phrase = "one two three four five six "
    items = [(i, phrase + prose(500 + i, 10 + i)) for i in range(4)] + [(9, phrase * 3)]
    docs = [(1, phrase * 1500 + items[2][1]), (2, "no leak " + phrase)]
    got = find_leaks(documents(spark, [(*d, None, None, None) for d in docs]), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc"], r["item_id"], r["start_word"]) for r in got.collect()} == {(1, 2, 9000), (1, 9, 0)}
    sizes = held["laid"].select("doc", F.size("windows").alias("n")).collect()
    assert max(r["n"] for r in sizes) <= 4096 * 5 and sum(r["doc"] == 1 for r in sizes) > 2


def test_leaks_in_awkward_documents(spark):
    docs = documents(spark, clashes=True)
    items = spark.createDataFrame([(1, prose(3, 60)), (2, "one")], "item_id long, text string")
    got = {(r["doc"], r["item_id"]) for r in find_leaks(docs, items).collect()}
    assert {(8, 1), (9, 1), (7, 2)} <= got
    assert set(c.split()[0] for c in CLASHES.split(", ")) <= set(without_leaks(docs, items).columns)


def test_word_simhash_and_weights(spark):
    row = spark.createDataFrame([("A b, C.", "a b c a b")], "x string, y string")
    got = row.select(
        words_of(F.col("x")).alias("w"),
        simhash_of(words_of(F.col("x"))).alias("h"),
        F.transform(words_of(F.col("x")), lambda w: F.xxhash64(w)).alias("each"),
        weighted_jaccard(F.lit([1, 1, 2]), F.lit([1, 2, 2, 3])).alias("j"),
        weighted_jaccard(F.lit([1, 2]), F.lit([2, 3])).alias("k"),
    ).first()
    assert got["w"] == ["a", "b", "c"]
    bits = sum(1 << b for b in range(64) if 2 * sum((e >> b) & 1 for e in got["each"]) > 3)
    assert got["h"] & (2**64 - 1) == bits
    assert got["j"] == pytest.approx(2 / 5) and got["k"] == pytest.approx(1 / 3)


def test_main_path_is_native(spark):
    docs, items = documents(spark), spark.createDataFrame([(1, prose(3, 60))], "item_id long, text string")
    plan = find_leaks(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and RADIUS == 13


def test_sentences_and_words_by_definition():
    draw = random.Random(12)
    ends = re.compile(r"[.!?]+[\"')\]]*\s+|\n\s*")
    for i in range(20_000):
        text = "".join(draw.choice("ab.!?\"')] \n\t\x1cé" + "Łл" * (i % 2)) for _ in range(draw.randint(1, 25)))
        edges = [0, *[m.end() for m in ends.finditer(text)]]
        edges += [len(text)] * (edges[-1] < len(text))
        assert sentences(text) == [text[a:b] for a, b in zip(edges, edges[1:])]
        assert _words(text).before.tolist() == [sum(m.start() < e for m in re.finditer(r"\S+", text)) for e in edges]


def test_places_of_many_documents_share_a_batch():
    """A batch a document made most of the work of windows in small documents."""
    texts = [prose(i, 200) for i in range(30)] + [None]
    ids, marks = pa.array([*range(29), None, 30], pa.int64()), pa.array(range(31), pa.int64())
    located = list(_located(30, 50, 50)(iter([pa.RecordBatch.from_arrays([ids, marks, pa.array(texts)], names=["d", "m", "t"])])))
    given = pa.array([[0, 3]] * 31, pa.list_(pa.int32()))
    few = pa.RecordBatch.from_arrays([ids, marks, pa.array(texts), given], names=["d", "m", "t", "a"]).slice(0, 30)
    windows = list(_windows(50)(iter([few])))
    assert len(located) == len(windows) == 1
    assert set(located[0]["doc"].to_pylist()) == set(windows[0]["doc"].to_pylist()) == {*range(29), None}
    one = pa.Table.from_batches(list(_located(30, 50, 50)(iter([few.slice(7, 1).select([0, 1, 2])]))))
    assert one.equals(pa.Table.from_batches(located).filter(pc.field("doc") == 7).combine_chunks())


def test_documents_worked_on_together_are_as_alone(monkeypatch):
    """Short texts share the work on words; their places and hashes are those of each text by itself."""
    draw = random.Random(14)
    signs = ["É", "\u3000", "ΑΣ", "\n", "\n\n", ". ", '! "', "  ", "\x85", "中。", "?\n"]
    texts = ["".join(draw.choice([*signs, *(f"w{draw.randrange(40)} " for _ in range(30))]) for _ in range(draw.choice([1, 20, 200]))) for _ in range(120)]
    texts += [None, "", " ", ".", "w1 " * 70, "".join(f"w{i} " for i in range(60))] + texts[:20] + ["long " * 40 + "".join(f"w{i % 700} " for i in range(9000))]
    n, calls = len(texts), []

    def located(rows):
        batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([i * 7]), pa.array([texts[i]], pa.string())], names=["d", "m", "t"]) for i in rows]
        table = pa.Table.from_batches(_located(30, 50, 50)(iter(batches)))
        return sorted(zip(*(c.to_pylist() for c in table.columns), strict=True))

    alone = located(range(n))
    whole = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([i * 7 for i in range(n)]), pa.array(texts, pa.string())], names=["d", "m", "t"])
    monkeypatch.setattr(span_dedup, "_words", lambda *t: calls.append(t) or _words(*t))
    together = pa.Table.from_batches(_located(30, 50, 50)(iter([whole])))
    assert len(calls) < 12
    assert sorted(zip(*(c.to_pylist() for c in together.columns), strict=True)) == alone
    # Equal hashes mean equal texts, also where sentences without words stand at the ends.
    of_hash, of_text = {}, {}
    for low, high, doc, _, first, last in alone:
        if last >= 0:
            ends = spans(sentences(texts[doc]), 30, 50)
            text = next(t for f, z, t in zip(*ends, strict=True) if (f, z) == (first, last))
            assert of_hash.setdefault((low, high), text) == text and of_text.setdefault(text, low) == low
    # The first pass finds what the second meets twice.
    lows = [v for b in _low_halves(30, 50, 50)(iter([whole.select(["t"])])) for v in b.column(0).to_pylist()]
    counted = Counter(low for low, *_ in alone)
    assert {v for v, c in Counter(lows).items() if c > 1} == {v for v, c in counted.items() if c > 1}
    # And lines longer than what is summed at once change nothing.
    monkeypatch.setattr(span_dedup, "_BYTES", 64)
    assert located(range(n)) == alone
