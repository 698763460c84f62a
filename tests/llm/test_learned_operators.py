"""Quality, language, main text and vector search: held-out accuracy, brute force, awkward rows."""

import html
import random
import re
import zlib

import numpy as np
import pytest
from fixtures import documents, prose
from pyspark.sql import functions as F

from seasonline.llm.language import fit_languages, has_letters, presence, train_languages, with_language
from seasonline.llm.main_text import (
    TextModel,
    _PRIOR,
    _PRIOR_PAIRS,
    fit_text_model,
    forest,
    known_labels,
    parse,
    sum_product,
    train_text_model,
    with_main_text,
)
from seasonline.llm.quality import BIAS, REPEATS, features, fit_grades, grade_of_labels, train_grades, with_grades
from seasonline.llm.vector_search import Band, Block, SearchPlan, nearest_vectors, usable

# --- quality ---------------------------------------------------------------------------------------


def rated_text(draw, grade):
    body = prose(draw.randint(0, 10**9), draw.randint(20, 200))
    if grade == 0:
        return " ".join(w + draw.choice(["***", "%%%", "&&&"]) for w in body.split())
    if grade == 1:
        words = body.split()
        for _ in range(max(2, len(words) // 30)):
            words.insert(draw.randint(0, len(words)), draw.choice(["idiot", "moron", "trash"]))
        return " ".join(words)
    return body


def test_grades_of_held_out_texts(spark):
    draw = random.Random(1)
    rows = [(i, rated_text(draw, g), g) for i, g in enumerate(draw.choices([0, 1, 2], [2, 3, 10], k=900))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = train_grades(frame.drop("grade"), frame.where("doc_id % 3 != 0").select("doc_id", "grade"))
    assert model.grades == [0, 1, 2] and (np.diff(model.thresholds) > 0).all()
    got = with_grades(frame, model).where("doc_id % 3 = 0").collect()
    right = [(r["p_top"] >= 0.5) == (r["grade"] == 2) for r in got]
    assert np.mean(right) > 0.95
    assert np.mean([r["expected_grade"] for r in got if r["grade"] == 0]) < 0.5
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["p_top"] <= 1 for r in got)


def test_tails_fall_and_gradient_finds_the_optimum():
    """With one feature that tells the grades apart, the fitted tails are ordered and near the shares."""
    draw = np.random.default_rng(0)
    grades = draw.choice(3, 600, p=[0.3, 0.3, 0.4])
    # Each row has words of its own, or all would count as copies of one.
    rows = [(np.array([4 * i, 4 * i + 1, 4 * i + 2, BIAS], np.int32), np.ones(4, np.float32)) for i in range(len(grades))]
    model = fit_grades(rows, grades.tolist(), rounds=800)
    tails = model.tails(np.zeros(1))[0]
    weight = 1 / np.bincount(grades)[grades] ** 0.5
    want = [weight[grades >= k].sum() / weight.sum() for k in (1, 2)]
    assert tails[0] > tails[1] and tails == pytest.approx(want, abs=0.02)


def test_grades_of_awkward_documents(spark):
    docs = documents(spark, clashes=True)
    ratings = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (999, 2)], "doc_id long, grade int")
    one = train_grades(docs, ratings)
    assert one.grades == [0]
    assert {(r["expected_grade"], r["p_top"]) for r in with_grades(docs, one).collect()} == {(0.0, 1.0)}
    none = train_grades(docs, ratings.limit(0))
    assert {(r["expected_grade"], r["p_top"]) for r in with_grades(docs, none).collect()} == {(None, 1.0)}
    two = train_grades(docs, spark.createDataFrame([(1, 0), (2, 1), (7, 1)], "doc_id long, grade int"))
    got = with_grades(docs, two)
    assert got.count() == docs.count() and got.where("p_top is null").count() == 0
    assert set(docs.columns) <= set(got.columns)
    assert with_grades(docs.limit(0), two).count() == 0
    assert features(None)[0].tolist() == [BIAS] == features(" \n ")[0].tolist()


def test_grade_of_labels(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 0), (1, None), (None, 1), (None, None)]
    df = spark.createDataFrame(rows, "quality int, toxic int")
    assert [r[0] for r in df.select(grade_of_labels(F.col("quality"), F.col("toxic"))).collect()] == [0, 0, 1, 2, 2, None, None]


def test_repeated_neighbours_count_in_every_text():
    """However many of the tokens differ."""
    for others in (0, 3, 20, 200, 2000):
        tokens = ["twice", "twice", *(f"t{i}" for i in range(others))]
        index, value = features(" ".join(tokens))
        assert value[index == REPEATS] == pytest.approx(1 / len(tokens))
    index, value = features("every token differs")
    assert value[index == REPEATS] == 0


# --- language --------------------------------------------------------------------------------------

LETTERS = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "xyzéèç"}


def tongue(draw, lang):
    word = lambda: "".join(draw.choice(LETTERS[lang]) for _ in range(draw.randint(2, 7)))
    return " ".join(word() for _ in range(draw.randint(3, 60)))


def test_language_of_held_out_texts(spark):
    draw = random.Random(2)
    langs = draw.choices(list(LETTERS), [20, 5, 1], k=600)
    rows = [(i, tongue(draw, x), x if i % 7 else None) for i, x in enumerate(langs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_languages(frame.where("doc_id % 4 != 2"), per_language=80, key=F.col("doc_id"))
    assert model.languages == sorted(LETTERS)
    got = with_language(frame, model).where("doc_id % 4 = 2").collect()
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in got]) > 0.97
    assert all(0 < r["score"] <= 1 for r in got)


def test_scores_equal_the_kernel_form():
    """Weights per n-gram give what kernel values with the landmarks give."""
    draw = random.Random(3)
    langs = draw.choices(list(LETTERS), k=60)
    bits = [presence(tongue(draw, x)) for x in langs]
    model = fit_languages([np.packbits(b).tobytes() for b in bits], langs, landmarks=60, ridge=1e-6)
    x = np.stack(bits).astype(float)
    unit = x / np.sqrt(x.sum(axis=1, keepdims=True))
    scores = unit @ model.weights + model.offset
    y = (np.array(langs)[:, None] == np.array(model.languages)[None]).astype(float)
    assert np.abs(scores - y).max() < 0.05  # as many landmarks as texts and hardly a penalty: interpolation


def test_presence_is_of_the_whole_text():
    body = "ab cd " * 5000
    assert presence(body + "zqx")[presence("zqx")].all() and not presence(body)[presence("zqx")].all()
    assert (presence("A  b\n") == presence("a b")).all() and presence("").sum() == 0
    assert not has_letters(None) and not has_letters("12 !?\n") and has_letters("1é")


def test_language_of_awkward_documents(spark):
    docs = documents(spark, clashes=True)
    model = train_languages(docs, key=F.col("doc_id"))
    got = with_language(docs, model).collect()
    assert len(got) == docs.count()
    for r in got:
        if not has_letters(r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.languages
    none = train_languages(docs.limit(0), key=F.col("doc_id"))
    assert {r["lang_pred"] for r in with_language(docs, none).collect()} == {"und"}
    single = train_languages(docs.where("doc_id = 8"), key=F.col("doc_id"))
    assert {(r["lang_pred"], r["score"]) for r in with_language(docs, single).collect()} == {("und", 0.0), ("de", 1.0)}
    assert with_language(docs.limit(0), model).count() == 0
    assert zlib.crc32(b"10") % 4 == 1


# --- main text -------------------------------------------------------------------------------------

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- x --><div class="ad">Buy this thing now.</div>'
    "{body}<footer>&copy; site &middot; All words reserved here.</footer></body></html>"
)


def page(body):
    return PAGE.format(body=body)


def article(seed):
    parts = [prose(seed * 10 + i, 30 + 10 * i) for i in range(3)]
    return f"<article><h1>{parts[0][:40]}</h1>" + "".join(f"<p>{html.escape(p)}</p>" for p in parts) + "</article>", [parts[0][:40].strip(), *parts]


def test_messages_equal_enumeration():
    """Marginals of a small forest by summing over all states."""
    draw = np.random.default_rng(4)
    trees = [[-1, 0, 0, 1, 1, 2, 0], [-1], [-1, 0, 1, 2]]
    joined = forest(trees)
    n = len(joined.parents)
    own, pairs = draw.normal(size=(n, 2)), draw.normal(size=(2, 2))
    total, each, both = 0.0, np.zeros((n, 2)), np.zeros((n, 2, 2))
    for state in range(1 << n):
        s = [(state >> i) & 1 for i in range(n)]
        w = np.exp(sum(own[i, s[i]] + (pairs[s[p], s[i]] if (p := joined.parents[i]) >= 0 else 0) for i in range(n)))
        total += w
        for i in range(n):
            each[i, s[i]] += w
            if joined.parents[i] >= 0:
                both[i, s[joined.parents[i]], s[i]] += w
    marginals, together = sum_product(joined, own, pairs)
    assert marginals == pytest.approx(each / total) and together == pytest.approx(both / total)


def texts(pages, model):
    return ["\n".join(t for node, t, _ in p.runs if c[node] >= 0.5) for p, c in zip(pages, model.content(pages), strict=True)]


@pytest.fixture(scope="module")
def model():
    return fit_text_model([parse(page(article(s)[0])) for s in range(40)])


def test_articles_are_found_with_and_without_their_tag(model):
    for seed in range(50, 80):
        body, parts = article(seed)
        for form in (body, body.replace("article", "main"), body.replace("article", "div"), body.replace("<article>", '<div class="post-content">').replace("</article>", "</div>")):
            assert texts([parse(page(form))], model) == ["\n".join(parts)]


def test_boilerplate_goes(model):
    body, parts = article(90)
    asides = (
        f"<aside><p>{prose(1, 30)}</p></aside>",
        f'<div class="sidebar"><p>{prose(2, 30)}</p></div>',
        f'<section id="comments"><div class="comment"><p>{prose(3, 30)}</p></div></section>',
        f'<div class="cookie-notice">{prose(4, 20)}</div>',
        f"<form><p>{prose(5, 12)}</p><input><button>Send</button></form>",
        f"<header><p>{prose(6, 12)}</p></header>",
        f'<div role="complementary"><p>{prose(7, 25)}</p></div>',
    )
    for extra in asides:
        assert texts([parse(page(extra + body))], model) == ["\n".join(parts)]
        assert texts([parse(page(body + extra))], model) == ["\n".join(parts)]
        if "<header>" not in extra:  # an article's own header belongs to it
            assert texts([parse(page(body.replace("</article>", extra + "</article>")))], model) == ["\n".join(parts)]


def test_wrappers_of_the_page_are_no_boilerplate(model):
    """A form or a div with a telling name round everything, with and without an article in it."""
    prior = TextModel(_PRIOR, _PRIOR_PAIRS)
    wrappers = ["form id=form1", "div class='content has-sidebar'", "div class=with-comments", "section class='no-sidebar'", "form><div class='page no-sidebar'"]
    related = f"<section class=related><article class=card><p>{prose(8, 12)}</p></article></section>"
    comments = f"<section id=comments><article class=comment><p>{prose(9, 40)}</p></article></section>"
    for seed, wrapper in enumerate(wrappers):
        body, parts = article(300 + seed)
        for form in (body, body.replace("article", "main"), body.replace("article", "div")):
            source = page(f"<{wrapper}>{form}{comments}<div class=sidebar><p>{prose(10, 30)}</p></div></{wrapper.split()[0].split('>')[0]}>")
            for fitted in (model, prior):
                assert texts([parse(source)], fitted) == ["\n".join(parts)]
        marks = known_labels(parse(page(f"<{wrapper}>{body}{related}{comments}")))
        plain = known_labels(parse(page(f"{body}{related}{comments}")))
        assert marks.sum() == plain.sum() == 5
        inner = body.replace("<article>", "<article><div class='text has-sidebar'>").replace("</article>", "</div></article>")
        assert texts([parse(page(inner + related))], model) == ["\n".join(parts)]
    assert known_labels(parse(page("<main class=no-sidebar><p>" + prose(11, 50) + "</p></main>"))).sum() == 2


def test_a_long_thread_is_no_main_part(model):
    """Comments three times as long as the article, with and without its tag, under names in several languages."""
    for seed, name in enumerate(["comments", "kommentare", "commentaires", "comentarios", "c-thread"]):
        body, parts = article(400 + seed)
        thread = "".join(f"<div class=item><p>{prose(500 + 20 * seed + i, 60)}</p></div>" for i in range(12))
        for form in (body, body.replace("article", "main"), body.replace("article", "div")):
            got = texts([parse(page(f"{form}<section class='{name}'><h2>Words of readers</h2>{thread}</section>"))], model)
            assert got == ["\n".join(parts)], name


def test_all_of_an_article_is_kept(model):
    """Lists of links, table heads and cells, and short blocks."""
    body, parts = article(430)
    added = (
        "<ul><li><a href=/x>First link</a></li><li>See <a href=/y>the second</a></li></ul>"
        "<table><tr><th>Year</th><th>n</th></tr><tr><td>2019</td><td>7</td></tr></table><p>Short.</p><div>x</div></article>"
    )
    got = texts([parse(page(body.replace("</article>", added)))], model)
    assert got == ["\n".join([*parts, "First link", "See the second", "Year", "n", "2019", "7", "Short.", "x"])]


def test_unknown_elements_stand_within_a_line(model):
    body, parts = article(440)
    added = "<p>A <ruby>kan<rp>(</rp><rt>ji</rt><rp>)</rp></ruby> word, <nobr>no break</nobr> and <my-tag>own</my-tag> <blink>tags</blink> here.</p></article>"
    got = texts([parse(page(body.replace("</article>", added)))], model)
    assert got == ["\n".join([*parts, "A kan(ji) word, no break and own tags here."])]


def test_tags_and_references(model):
    body = (
        "<article><h1>A &amp; B &copy &#x41;&#66; &bogus; x</h1><p class='a>b'>one\n two\t<b>bold</b> <a href='x'>link</a>, more words here.<br>next"
        "<p>unclosed paragraph of words.<ul><li>first item<li>second item</ul><script>if (a<b) x='</p>';</script><p>last &nbsp; words.</p></article>"
    )
    got = texts([parse(page(body))], model)[0].split("\n")
    assert got == ["A & B © AB &bogus; x", "one two bold link, more words here. next", "unclosed paragraph of words.", "first item", "second item", "last words."]


def test_elements_that_close_themselves_or_not_at_all(model):
    body, parts = article(95)
    for extra in (
        "<svg class=icon />", "<svg/>", "<math/>", "<object data='x.swf' />", "<script src='x.js'/>", "<iframe src='x'/>", "<select name=a/>",
        "<title/>", "<template/>", "<svg><path d='M0'/>", "<object data=x>", "<nav><select><option>one<option>two</nav>", "<select><option>one",
        "<template><p>not shown</p><template>nor this</template> or this</template>", "<svg><desc>not shown</desc><path d=''/></svg>",
        "<script src=/a/>var x = '<p>not shown</p>';</script>",
    ):
        for source in (extra + body, body.replace("<article>", "<article>" + extra), body.replace("</h1>", "</h1>" + extra)):
            assert texts([parse(page(source))], model) == ["\n".join(parts)], extra
    sentence = prose(96, 20)
    formula = "<math><mrow><mi>a</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding='application/x-tex'>a=1</annotation></math>"
    added = f"<p>{sentence} {formula} and <svg><text>drawn</text></svg> or <object data=x><b>instead</b></object> here.</p></article>"
    got = texts([parse(page(body.replace("</article>", added)))], model)
    assert got == ["\n".join([*parts, f"{sentence} a=1 and drawn or instead here."])]


def test_pages_without_labels_or_text(spark, model):
    prior = fit_text_model([parse("<p>no main part</p>")])
    assert (prior.weights == _PRIOR).all() and (prior.pairs == _PRIOR_PAIRS).all()
    assert known_labels(parse("<p>x</p>")) is None
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    odd = [None, "", "   ", "plain text only", "<", "<p", "<!-- open", "<script>never closed", "</p></div>", "<p a='", deep, page(article(3)[0]) * 2, "<br>" * 10000]
    rows = [(i % 5 if i else None, f"u{i}" if i % 2 else None, h, "t", 1) for i, h in enumerate(odd)] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, extracted int")
    got = with_main_text(frame, model)
    assert sorted(got.columns) == sorted(frame.columns) and got.count() == len(rows)
    assert all(r["text"] == "" for r in got.collect() if not (r["html"] or "").strip())
    assert with_main_text(frame.limit(0), TextModel(_PRIOR, _PRIOR_PAIRS)).count() == 0
    assert (train_text_model(frame.limit(0), key=F.col("page_id")).weights == _PRIOR).all()
    trained = train_text_model(frame, key=F.col("page_id"))
    assert with_main_text(frame, trained).count() == len(rows)


def test_main_text_of_the_tables(spark, sf_dir):
    from seasonline.llm.queries import page_main_text

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = page_main_text(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inner))]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


# --- vector search ---------------------------------------------------------------------------------


def plain_nearest(rows, k):
    found = {}
    for q, x in rows:
        if q % 20 == 0:
            scored = sorted((-float(np.dot(np.float64(v), np.float64(x))), i) for i, v in rows if i != q)
            found[q] = scored[:k]
    return found


@pytest.mark.parametrize("shape", ["even", "clustered", "norms"])
def test_recall(spark, shape):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(2000, 32))
    if shape == "clustered":
        x += 3 * draw.normal(size=(10, 32))[draw.integers(0, 10, 2000)]
    if shape == "norms":
        x *= draw.lognormal(0, 0.7, 2000)[:, None]
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nearest_vectors(frame, F.col("vec_id") % 20 == 0, plan=SearchPlan(block_rows=512)).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = plain_nearest(rows, 20)
    hits = sum(len({i for _, i in want[q]} & {i for i, _ in got[q].values()}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    vectors = dict(rows)
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21)) and q not in {i for i, _ in found.values()}
        assert all(s == pytest.approx(np.dot(vectors[q], vectors[i]), abs=1e-12) for i, s in found.values())
        assert [(-s, i) for i, s in (found[r] for r in range(1, 21))] == sorted((-s, i) for i, s in found.values())


def _share_found(ids, vectors, queries, k=20, plan=SearchPlan()):
    """Share of the true nearest found (by score, so that ties do not matter), and share of products worked out."""
    n = len(vectors)
    rows = plan.rows(plan.lines(vectors.shape[1], n))
    best, verified = {q: [] for q in queries.tolist()}, 0
    for part in np.array_split(np.arange(n), -(-n // rows)):
        block = Block(ids[part], vectors[part], plan, n, k)
        for name, found, products in block.nearest(ids[queries], vectors[queries]):
            best[int(np.flatnonzero(ids == name)[0])] += zip((-products).tolist(), found.tolist(), strict=True)
        verified += block.verified
    hits = 0
    for q, found in best.items():
        products = (vectors * vectors[q]).sum(axis=1)
        least = np.sort(np.delete(products, q))[-k]
        hits += sum(-s >= least for s, _ in sorted(found)[:k])
    return hits / (k * len(queries)), verified / (n * len(queries))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, scale):
    rows = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet").where(usable(F.col("embedding"))).orderBy("vec_id").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    found, verified = _share_found(ids, vectors, np.flatnonzero(ids % 20 == 0))
    assert found >= 0.95
    assert verified < (0.2 if len(ids) >= 2000 else 0.5)  # of small tables at least 160 rows are verified


@pytest.mark.parametrize(("dimensions", "norms"), [(64, 0), (64, 0.35), (64, 2), (256, 0), (256, 0.35), (768, 0)])
def test_recall_by_dimension_and_norms(dimensions, norms):
    """Vectors without any structure, the hardest ones; norms log-normal."""
    draw = np.random.default_rng(8)
    vectors = draw.normal(size=(8000, dimensions))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors *= np.exp(draw.normal(0, norms, size=8000))[:, None]
    found, verified = _share_found(np.arange(8000), vectors, np.arange(0, 8000, 200))
    assert found >= 0.9
    assert verified < (0.2 if dimensions == 64 and not norms else 0.55)


@pytest.mark.parametrize("size", [1e-200, 1e25, 1e150])
def test_every_finite_vector_has_its_neighbours(spark, size):
    """Sizes whose squares are beyond single or double precision lose nothing."""
    draw = np.random.default_rng(9)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(draw.normal(size=(200, 8)) * size)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest_vectors(frame, F.lit(True)).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(got) == list(range(200)) and all(sorted(f) == list(range(1, 21)) for f in got.values())
    if size > 1e-100:
        vectors = np.array([v for _, v in rows]) / size
        for q, found in got.items():
            products = vectors @ vectors[q]
            products[q] = -np.inf
            assert [i for i, _ in found.values()] == np.argsort(-products, kind="stable")[:20].tolist()


def test_vectors_that_take_no_part_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, float(i % 3), 0.5]) for i in range(0, 60)]
    odd = [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 1.0]), (180, [nan, 1.0, 1.0]), (200, [1.0, inf, 1.0]), (220, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    rows = [(i, v, 1, 2.0) for i, v in good + odd + [(20, [1.0, 2.0, 0.5])]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score double")
    assert frame.where(usable(F.col("embedding"))).count() == 63
    got = {}
    for r in nearest_vectors(frame, F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 20, 40}
    for q, found in plain_nearest(good, 20).items():
        assert [(i, s) for _, i, s in sorted(got[q])] == [(i, -s) for s, i in found]
    few = nearest_vectors(frame.where("vec_id < 5"), F.col("vec_id") % 20 == 0, k=20)
    assert [r["vec_id"] for r in few.orderBy("rank").collect()] == [2, 1, 4, 3] or few.count() == 4
    assert nearest_vectors(frame.limit(0), F.col("vec_id") % 20 == 0).columns == ["query_id", "rank", "vec_id", "score"]
    assert nearest_vectors(frame.where("vec_id = 140"), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest_vectors(frame.where("vec_id = 40"), F.col("vec_id") % 20 == 0).count() == 0


def test_the_number_of_rows_does_not_change_the_search():
    """A block gives the same neighbours whether its table is small or large."""
    plan, draw = SearchPlan(), np.random.default_rng(10)
    assert plan.lines(64, 100) == plan.lines(64, 10**7) and plan.passing(64, 100) == plan.passing(64, 10**7)
    vectors, ids = draw.normal(size=(1500, 64)), np.arange(1500)
    found = [[(n, i.tolist()) for n, i, _ in Block(ids, vectors, plan, rows, 20).nearest(ids[::50], vectors[::50])] for rows in (1500, 10**6)]
    assert found[0] == found[1]


def test_windows_do_not_depend_on_the_query_before():
    draw = np.random.default_rng(11)
    vectors, ids = draw.normal(size=(1500, 64)), np.arange(1500)

    def found(order):
        return {n: i.tolist() for n, i, _ in Block(ids, vectors, SearchPlan(), 1500, 20).nearest(ids[order], vectors[order])}

    order = np.arange(0, 1500, 30)
    assert found(order) == found(order[::-1]) == {q: i for o in order for q, i in found(order[order == o]).items()}


@pytest.mark.parametrize("shape", ["even", "copies"])
def test_windows_are_counted_on_bytes_and_few_times(shape, monkeypatch):
    """A place takes one byte and a query few counts; what the windows hold on enough lines is found, and little else."""
    draw = np.random.default_rng(12)
    vectors = draw.normal(size=(3000, 64))
    if shape == "copies":
        vectors[1000:] = vectors[np.arange(2000) % 7]
    block = Block(np.arange(3000), vectors, SearchPlan(norm_band=1e9), 3000, 20)
    band, counted, within = block.bands[0], [], Band._within
    assert band.steps.shape == (240, 3000) and band.steps.nbytes == 240 * 3000
    monkeypatch.setattr(Band, "_within", lambda self, centre, at: counted.append(at) or within(self, centre, at))
    list(block.nearest(np.arange(0, 3000, 30), vectors[::30]))
    assert len(counted) < (4 if shape == "even" else 12) * 100
    scaled = vectors / np.linalg.norm(vectors, axis=1).max()
    last = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
    places = np.c_[scaled, last] @ band.lines
    for query in vectors[::300]:
        centre = query / np.linalg.norm(query) @ band.lines[:-1]
        at = 470
        found, enough = within(band, centre, at)
        width = 1e-6 * 1.03**at
        hits = (np.abs(places - centre) <= width).sum(axis=1)
        assert found[hits >= 180].all() and not found[hits < 170].any()
        assert enough == (found.sum() >= int(0.145 * 3000))


def test_products_are_preselected_without_loss():
    draw = np.random.default_rng(13)
    ids = np.arange(400)
    for size in (1, 1e-200, 1e150, 1e300):
        vectors = draw.integers(-2, 3, size=(400, 8)) * float(size)
        vectors[:, 0] = size
        for name, found, products in Block(ids, vectors, SearchPlan(verify=1.0, norm_band=1e9), 400, 20).nearest(ids[::20], vectors[::20]):
            with np.errstate(over="ignore", invalid="ignore"):
                want = (vectors * vectors[name]).sum(axis=1)
            others = np.delete(ids, name)
            order = others[np.lexsort((others, -want[others]))][:20]
            assert found.tolist() == order.tolist() and np.array_equal(products, want[order], equal_nan=True)
