"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonline.llm.alignment import align_tokenizers
from seasonline.llm.benchmark_leaks import find_leaks
from seasonline.llm.byte_bpe import round_trip_digests
from seasonline.llm.common import table
from seasonline.llm.edit_counts import scrub_edits, with_token_counts
from seasonline.llm.language import train_languages, with_language
from seasonline.llm.main_text import train_text_model, with_main_text
from seasonline.llm.quality import grade_of_labels, train_grades, with_grades
from seasonline.llm.sharding import shard_documents
from seasonline.llm.simhash_near import near_groups
from seasonline.llm.span_dedup import without_repeated_spans
from seasonline.llm.spelling import spelling_variants, word_counts
from seasonline.llm.token_files import read_documents, write_token_files
from seasonline.llm.vector_search import nearest_vectors
from seasonline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
END_ID = 2


def edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after a scrub of addresses, secrets and licence lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = with_token_counts(docs, scrub_edits(F.col("text")), vocabulary=RANKS, pattern=PATTERN)
    return counted.select("doc_id", "n_tokens", "n_edits", "n_tokens_after", "reencoded_chars")


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return near_groups(table(spark, sf_dir, "documents"), words=3, radius=3)


def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip_digests(docs, vocabulary=MULTI_RANKS, pattern=PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as token ids to binary files, and read back from them."""
    folder = scratch_path(spark, "token-ids")
    write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary=TOKENIZER, end_id=END_ID)
    return read_documents(spark, folder)


def vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    return nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def page_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    model = train_text_model(pages, key=F.col("page_id"))
    return with_main_text(pages, model).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_spans(docs, counts=("n_sentences", "n_removed"))


def quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of the best grade, and choice of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").withColumn("grade", grade_of_labels(F.col("quality"), F.col("toxic")))
    graded = with_grades(docs, train_grades(docs, labels))
    return graded.select("doc_id", "expected_grade", "p_top", (F.col("p_top") >= 0.5).alias("kept"))


def kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = train_languages(docs.where(~held_out), key=F.col("doc_id"))
    return with_language(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the window."""
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select(F.col("doc").alias("doc_id"), "item_id", "start_word", "similarity")


def slipped(doc_id: Column, run: Column) -> Column:
    """``run``, of which every 199th by a checksum with the document's id (none: empty) loses one code point."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(h % 199 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every common word of the corpus with the commoner word it is a variant of."""
    words = word_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), shortest=6, least=5, change=slipped)
    return spelling_variants(words, ratio=5)


def document_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard of sixteen and its place in it."""
    return shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, set against each other."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokenizers(docs, a=TOKENIZER, b=PIECES)


QUERIES: dict[str, Query] = {
    "op1_edit_aware_counts": edit_aware_counts,
    "op2_simhash_groups": simhash_groups,
    "op3_byte_bpe_round_trip": byte_bpe_round_trip,
    "op4_token_id_files": token_id_files,
    "op5_vector_neighbours": vector_neighbours,
    "op6_page_main_text": page_main_text,
    "op7_sentence_span_dedup": sentence_span_dedup,
    "op8_quality_grades": quality_grades,
    "op9_kernel_language": kernel_language,
    "op10_benchmark_leaks": benchmark_leaks,
    "op11_spelling_groups": spelling_groups,
    "op12_document_shards": document_shards,
    "op13_tokenizer_alignment": tokenizer_alignment,
}

_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"

# Leaks without fingerprints: every window that shares a shingle with an item, against every item of its size.
# The other operators hash, learn or write files, and no SQL of DuckDB gives the same rows; they are tested
# against brute force, exact round trips and held-out rows in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op10_benchmark_leaks": f"""WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws, len(ws) AS n FROM benchmark WHERE len({_WORDS}) > 0),
ishingles AS (
  SELECT item_id, n, pos, array_to_string(ws[pos + 1:pos + least(n, 5)], ' ') AS s
  FROM (SELECT *, unnest(range(0, greatest(n - 4, 1))) AS pos FROM i)),
dshingles AS (
  SELECT doc_id, pos, array_to_string(ws[pos + 1:pos + k], ' ') AS s
  FROM (SELECT doc_id, ws, k, unnest(range(0, greatest(len(ws) - k + 1, 1))) AS pos
        FROM d, (SELECT DISTINCT least(n, 5) AS k FROM i) WHERE len(ws) > 0)),
windows AS (SELECT DISTINCT doc_id, CAST(d.pos AS BIGINT) - i.pos AS start, n FROM dshingles d JOIN ishingles i USING (s)),
words AS (SELECT doc_id, start, n, ws[greatest(start, 0) + 1:start + n] AS ws FROM windows JOIN d USING (doc_id)),
wshingles AS (
  SELECT doc_id, start, n, size, array_to_string(ws[pos + 1:pos + 5], ' ') AS s, count(*) AS c
  FROM (SELECT *, greatest(len(ws) - 4, 1) AS size, unnest(range(0, greatest(len(ws) - 4, 1))) AS pos FROM words)
  GROUP BY ALL),
icounts AS (SELECT item_id, n, greatest(n - 4, 1) AS isize, s, count(*) AS c FROM ishingles GROUP BY ALL),
shared AS (
  SELECT doc_id, start, item_id, size, isize, CAST(sum(least(w.c, i.c)) AS DOUBLE) AS m
  FROM wshingles w JOIN icounts i USING (n, s) GROUP BY doc_id, start, item_id, size, isize),
scored AS (SELECT doc_id, item_id, greatest(start, 0) AS start_word, m / (size + isize - m) AS similarity FROM shared)
SELECT doc_id, item_id, start_word, similarity FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start_word) = 1""",
    # The checksum byte by byte, every word against all with one code point less, and the forms step by step.
    "op11_spelling_groups": r"""WITH RECURSIVE
table8 AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _: xor(c >> 1, (c & 1) * 3988292384)) AS c FROM (SELECT unnest(range(256)) AS i))),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
places AS (SELECT doc_id, run, count(*) AS times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs GROUP BY doc_id, run),
sums AS (SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, len(x), 2), lambda i: CAST(16 * (instr('0123456789ABCDEF', x[i]) - 1) + instr('0123456789ABCDEF', x[i + 1]) - 1 AS BIGINT))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h FROM places, table8),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, times FROM sums),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
holes AS (SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT h.word, v.word, v.n FROM holes h JOIN v ON v.word = h.rest
  UNION SELECT v.word, h.word, h.n FROM holes h JOIN v ON v.word = h.rest),
best AS (SELECT word, count(*) AS n_near, min({'less': -other_n, 'word': other}) AS b FROM near GROUP BY word),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 5 * n THEN b.word END AS form, CASE WHEN -b.less >= 5 * n THEN -b.less END AS form_n
  FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, 0 AS steps FROM forms UNION ALL SELECT w.word, f.form, steps + 1 FROM walk w JOIN forms f ON f.word = w.root WHERE f.form IS NOT NULL)
SELECT word, form, arg_max(root, steps) AS root, n, n_near, form_n FROM forms JOIN walk USING (word) GROUP BY word, form, n, n_near, form_n""",
}
