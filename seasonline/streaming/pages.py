"""Incremental load: each batch of new pages becomes one load of stat lines."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonline.layouts import LAYOUTS, POSITION_IDS
from seasonline.operators.conform import LayoutMap
from seasonline.plans.history import build_history
from seasonline.sources.sinks import write_partitioned

LOAD = "load_id"


def stream_pages(
    spark: SparkSession, folder: str, schema: str, *, files: str = "*.parquet", files_per_batch: int = 10_000
) -> DataFrame:
    """Page files of a folder as a stream; a file is read once, when it first appears.

    A large backlog is worked off in batches of ``files_per_batch``.
    """
    stream = spark.readStream.schema(schema).option("pathGlobFilter", files)
    return stream.option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def load_new_pages(
    pages: DataFrame,
    to_lines: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    *,
    by: Sequence[str] = (),
    page_keys: Sequence[str] = (),
    loads: str | None = None,
) -> None:
    """Process all pages not seen before, then stop.

    Each micro-batch writes its own ``load_id`` partition, so a batch that is replayed after
    a failure replaces itself and touches nothing else. With ``loads`` the keys of every page of
    the batch are written there too, whether the page has lines or not.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = to_lines(batch).withColumn(LOAD, F.lit(batch_id))
        write_partitioned(lines, path, [LOAD, *by])
        if loads is not None:
            seen = batch.select(*page_keys).distinct().withColumn(LOAD, F.lit(batch_id))
            write_partitioned(seen, loads, [LOAD])

    query = (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_history(
    pages: DataFrame,
    path: str,
    checkpoint: str,
    first: int,
    last: int,
    *,
    name: str = "pages",
    layouts: LayoutMap = LAYOUTS,
    position_ids: Mapping[str, str] = POSITION_IDS,
) -> None:
    """Store the lines and the quarantine of all pages not seen before, then stop; see :func:`build_history`.

    Each micro-batch is one load, named by the stream and the batch: one that is done again after a failure replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        build_history(batch, path, first, last, layouts=layouts, position_ids=position_ids, name=f"{name}.{batch_id}")

    query = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_loads(lines: DataFrame, page_keys: Sequence[str], loads: DataFrame | None = None) -> DataFrame:
    """Lines of the newest load of each page: a page fetched again replaces its older lines.

    ``loads`` lists the loads of each page; without it they are taken from the lines, and a page whose
    newest load has no lines keeps its older ones.
    """
    newest = (lines if loads is None else loads).groupBy(*page_keys).agg(F.max(LOAD).alias(LOAD))
    return lines.join(newest, [*page_keys, LOAD], "left_semi")
