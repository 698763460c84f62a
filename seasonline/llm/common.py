"""What several operators share: tables, column names that cannot clash, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or ``wanted`` with underscores before it until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def unit_interval(*columns: Column) -> Column:
    """A fixed number from 0 to 1 for a row's values: the same on every run and in every order."""
    bits = F.xxhash64(*columns).bitwiseAND(F.lit((1 << 53) - 1))
    return bits.cast("double") / F.lit(float(1 << 53))


def hashed_sample(rows: DataFrame, key: Column, n: int) -> DataFrame:
    """About ``n`` rows, and never more than ``1.2 * n + 100``, chosen by a hash of ``key``.

    The share is taken from the exact count, so no sort is needed. Used only to fit models.
    """
    total = rows.count()
    if total <= n:
        return rows
    return rows.where(unit_interval(F.lit("sample"), key) < F.lit(n / total)).limit(int(1.2 * n) + 100)


_held: dict[Hashable, Any] = {}


def held_by_worker(key: Hashable, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps between batches and tasks: a vocabulary with its memo, say.

    Workers live on from one operator to the next, so only the last thing asked for is kept.
    """
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]
