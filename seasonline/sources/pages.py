"""Raw pages and the facets their URLs carry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonline.layouts import ACTUAL, POSITION_IDS, PROJECTED

# How the ranking and stat pages name their parts. -------------------------------
KIND_BY_PATH = {"/rankings/": PROJECTED, "/stats/": ACTUAL}
POSITION_KEY = "PosID"
SEASON_KEY = "Season"
PAGE_KEY = "cur_page"
# ----------------------------------------------------------------------------------------------


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A table of fetched pages: ``page_id, url, html``."""
    return spark.read.parquet(path)


def query_value(url: Column, key: str) -> Column:
    """A value from the query part of a URL; NULL where the key or the value is missing."""
    return F.nullif(F.try_parse_url(url, F.lit("QUERY"), F.lit(key)), F.lit(""))


def kind_of(url: Column, kinds: Mapping[str, str] = KIND_BY_PATH) -> Column:
    """The kind whose path piece occurs in the URL's path."""
    path = F.try_parse_url(url, F.lit("PATH"))
    kind: Column = F.lit(None).cast("string")
    for piece, name in kinds.items():
        kind = F.when(F.contains(path, F.lit(piece)), F.lit(name)).otherwise(kind)
    return kind


def with_url_facets(
    pages: DataFrame, *, url: str = "url", position_ids: Mapping[str, str] = POSITION_IDS
) -> DataFrame:
    """``pages`` with ``pos``, ``yr``, ``page`` and ``kind`` read from the URL; NULL where it does not say."""
    u = F.col(url)
    position = F.create_map(*[F.lit(x) for pair in position_ids.items() for x in pair])
    return pages.withColumns(
        {
            "pos": F.try_element_at(position, query_value(u, POSITION_KEY)),
            "yr": query_value(u, SEASON_KEY).try_cast("int"),
            "page": query_value(u, PAGE_KEY).try_cast("int"),
            "kind": kind_of(u),
        }
    )
