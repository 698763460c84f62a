"""Bring per-group statistics back to the rows they describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonline.session import staged


def attach(rows: DataFrame, stats: DataFrame, by: Sequence[str] = (), *, settle: bool = True) -> DataFrame:
    """``rows`` with the columns of ``stats``, which holds one row per group.

    The statistics are staged first (``settle``), so they are computed once and Spark plans
    with their measured size. With ``by`` this is a left equi-join whose right side is unique
    per key: below the broadcast threshold the rows are not shuffled at all, above it they
    are joined by a sort-merge join in which hot groups are split at run time. Rows whose
    group is NULL keep NULL statistics. Without ``by``, ``stats`` is a single row, read as a
    scalar subquery.
    """
    stats = staged(stats, "stats") if settle else stats
    if by:
        return rows.join(stats, list(by), "left")
    whole = F.struct(*[F.col(f"`{c}`") for c in stats.columns])
    held = rows.withColumn("_whole", stats.select(whole).scalar())
    return held.select(*[F.col(f"`{c}`") for c in rows.columns], "_whole.*")
