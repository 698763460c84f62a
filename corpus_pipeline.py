"""From raw documents to token ids: five stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonline.llm.benchmark_leaks import without_leaks
from seasonline.llm.byte_bpe import with_token_ids
from seasonline.llm.common import free_name, table
from seasonline.llm.quality import grade_of_labels, train_grades, with_grades
from seasonline.llm.simhash_near import near_groups
from seasonline.llm.span_dedup import without_repeated_spans
from seasonline.session import staged

# Documents whose probability of the best grade is lower are rejected.
LEAST_PROBABILITY = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model takes for good and not toxic."""
    labels = table(spark, sf_dir, "labels").withColumn("grade", grade_of_labels(F.col("quality"), F.col("toxic")))
    expected, top = free_name(docs, "expected_grade"), free_name(docs, "p_top")
    graded = with_grades(docs, train_grades(docs, labels), expected=expected, tail=top)
    return graded.where(F.col(top) >= LEAST_PROBABILITY).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Of rows that share that id, the one with the smallest hash of its text stays, and of rows equal in both
    any one. Rows without id stay only where no row of their group has one.
    """
    mark = free_name(docs, "mark")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    # Ordered: rows with an id before those without, then by id and text.
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.col(mark).alias("mark"))
    groups = near_groups(marked.select(place.alias("doc_id"), "text"), words=3, radius=3)
    kept = staged(groups.select("component_id.doc_id", "component_id.mark").distinct(), "kept")
    same = marked["doc_id"].eqNullSafe(kept["doc_id"]) & marked[mark].eqNullSafe(kept["mark"])
    stay = marked.join(kept, same, "left_semi")
    return stay.dropDuplicates(["doc_id", mark]).select(*docs.columns)


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier place holds; n_chars follows the text."""
    cut = without_repeated_spans(docs)
    if "n_chars" in cut.columns:
        return cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType))
    return cut


def no_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number, and whether they decode to the text."""
    encoded = with_token_ids(
        docs.select("doc_id", "text"),
        vocabulary=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        round_trip="round_trip",
    )
    return encoded.select("doc_id", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), "round_trip")


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_of_each_group),
    ("substring dedup", no_repeated_passages),
    ("benchmark decontamination", no_benchmark_items),
    ("byte-level BPE", token_ids),
]

# No SQL of DuckDB trains the classifier or hashes as the stages do; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
