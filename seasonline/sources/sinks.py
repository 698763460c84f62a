"""Partitioned writers. Rerunning a job replaces exactly the partitions it writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seasonline.layouts import LAYOUTS
from seasonline.operators.conform import LayoutMap, comma_text, known_layout
from seasonline.operators.reconcile import in_seasons
from seasonline.session import staged

ROWS_PER_FILE = 5_000_000


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    *,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    whole: bool = False,
) -> None:
    """Write ``df`` below ``path``, one folder per value of ``by``.

    Folders that ``df`` has no rows for stay as they are, or go if ``df`` is the ``whole`` table.

    ``rebalance`` gathers a folder's rows into few files, and at run time splits a folder
    that holds far more rows than the others over several tasks.
    """
    writer = (
        df.hint("rebalance", *[F.col(f"`{c}`") for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*by)
    )
    writer.options(**(options or {})).format(file_format).save(path)


def write_seasons(lines: DataFrame, path: str, *, by: Sequence[str] = ("Yr", "pos", "kind"), **options) -> None:
    """Stat lines per season, position and kind."""
    write_partitioned(lines, path, by, **options)


def write_season_text(
    lines: DataFrame, path: str, layouts: LayoutMap = LAYOUTS, *, season: str = "Yr", **options
) -> None:
    """Stat lines as headerless comma files, one folder of parts per position, kind and season.

    ``read_stat_lines`` reads them back.
    """
    # By layout, not by the text itself: a filter on the text would have it worked out twice.
    written = known_layout(layouts)
    if "raw" in lines.columns:
        written |= F.col("raw").isNotNull()
    text = comma_text(lines.where(written), layouts)
    named = text.select(F.concat_ws("_", "pos", "kind", F.col(season).cast("string")).alias("file"), "value")
    write_partitioned(named, path, ["file"], file_format="text", **options)


def write_master(
    lines: DataFrame, path: str, first: int, last: int, *, season: str = "Yr", by: Sequence[str] = ("pos", "kind"), **options
) -> None:
    """The seasons from ``first`` to ``last`` as one table per position and kind."""
    write_partitioned(in_seasons(lines, season, first, last), path, by, **options)


def write_master_seasons(
    lines: DataFrame, path: str, seasons: Sequence[int] | None = None, *, season: str = "Yr", by: Sequence[str] = ("pos", "kind")
) -> None:
    """Write the given ``seasons`` of a master table again, or with None the whole of it; other seasons stay untouched.

    The new folders are written beside the old ones and take their places when all are there. A season that has no
    rows of a position and kind any more then loses that folder.
    """
    if seasons is not None and not seasons:
        return
    folders = [*by, season]
    if seasons is None:
        write_partitioned(lines, path, folders, whole=True)
        return
    changed = staged(lines.where(F.col(season).isin(list(seasons))), "master")
    write_partitioned(changed, path, folders)
    # As many rows as there are positions, kinds and changed seasons.
    held = {"/".join(f"{c}={r[c]}" for c in folders) for r in changed.select(*folders).distinct().collect()}
    store, root = _files(lines.sparkSession, path)
    for number in seasons:
        pattern = "/".join([*(f"{c}=*" for c in by), f"{season}={number}"])
        for found in store.globStatus(root.suffix(f"/{pattern}")) or []:
            folder = found.getPath()
            if "/".join(folder.toString().split("/")[-len(folders) :]) not in held:
                store.delete(folder, True)


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A Parquet table, without rows where nothing has been written yet."""
    store, at = _files(spark, path)
    return spark.read.schema(schema).parquet(path) if store.exists(at) else spark.createDataFrame([], schema)


def write_scores(
    scores: DataFrame, path: str, *, by: Sequence[str] = ("Yr", "pos", "run"), file_format: str = "csv", **options
) -> None:
    """Scored players per season, position and run; comma files carry a header."""
    extra = {"header": "true"} if file_format == "csv" else {}
    write_partitioned(scores, path, by, file_format=file_format, options=extra, **options)


def write_grid(rows: DataFrame, path: str, *, by: Sequence[str], **options) -> None:
    """Whole parsed tables, header rows included, with the page kept as a column."""
    write_partitioned(rows, path, by, **options)
