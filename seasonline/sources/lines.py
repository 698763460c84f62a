"""Headerless comma files of stat lines, and tables written by this library."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonline.layouts import KINDS, LAYOUTS, POSITIONS, PROJECTED, Layout
from seasonline.operators.conform import LayoutMap, comma_cells, conform, known_layout
from seasonline.operators.reconcile import FULL_SEASON, in_seasons, with_full_exposure
from seasonline.session import staged

# Where the files of a season, of a range of seasons and of the season to be
# scored lie below the data folder. -------------------------------------------------------------
SEASON_FILE = "Data/{yr}/{pos}/{pos}_{kind}_{yr}.csv"
MASTER_FILE = "Total_Data/{first}-{last}/{pos}_{kind}.csv"
SCORING_FILE = "Total_Data/Test_Data/{yr}/{pos}_projected.csv"
# ------------------------------------------------------------------------------------------------

# A large file is a folder of parts; its name counts, not theirs.
_PART = r"/part-[^/]*$"
_POS_AND_KIND = r"([A-Za-z]+)_(projected|actual)[^/]*$"
_SEASON_IN_PATH = r"_([0-9]{4})(?:\.[^/]*)?$|/([0-9]{4})/[^/]*$"


# Why a line of a file is no stat line.
UNKNOWN_LAYOUT = "unknown layout"
WRONG_WIDTH = "wrong width"
NO_SEASON = "no season"


class Checked(NamedTuple):
    """What a read found: the stat lines, and every line that is none, with its place and the reason."""

    lines: DataFrame
    malformed: DataFrame


def _path_facets() -> list[Column]:
    """Position, kind and season as the file's path says them."""
    path = F.regexp_replace(F.col("_metadata.file_path"), _PART, "")
    season = F.coalesce(
        F.nullif(F.regexp_extract(path, _SEASON_IN_PATH, 1), F.lit("")),
        F.nullif(F.regexp_extract(path, _SEASON_IN_PATH, 2), F.lit("")),
    )
    return [
        F.regexp_extract(path, _POS_AND_KIND, 1).alias("pos"),
        F.regexp_extract(path, _POS_AND_KIND, 2).alias("kind"),
        season.alias("season_hint"),
    ]


def read_stat_lines(spark: SparkSession, paths: str | Sequence[str], layouts: LayoutMap = LAYOUTS) -> DataFrame:
    """Typed stat lines of all the files: ``pos, kind``, every field, ``width_ok``.

    Position, kind and (for records that lack it) the season come from the file's path. Malformed lines are
    marked; :func:`checked_stat_lines` sorts them out.
    """
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths)).select(*_path_facets(), F.col("value"))
    return from_comma_text(lines, layouts)


def checked_stat_lines(
    spark: SparkSession, paths: str | Sequence[str], layouts: LayoutMap = LAYOUTS, *, season: str = "Yr"
) -> Checked:
    """The stat lines of all the files, and beside them what is malformed: ``pos, kind, file, line_no, reason, raw``.

    A line is malformed if the path names no known layout, if its number of cells is not the layout's, or if it says no
    season. Every line of the files that is not blank is in exactly one of the two. ``line_no`` counts from 1 and counts
    blank lines too.

    The files are read once, into a staged table. A line's number is its place among the rows of its split, and the lines
    of the file's earlier splits before it; only malformed lines are numbered, so no good line is shuffled.
    """
    read = spark.read.text([paths] if isinstance(paths, str) else list(paths)).select(
        *_path_facets(),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value"),
    )
    typed = conform(read.withColumn("record", comma_cells(F.col("value"))), layouts)
    reason = (
        F.when(F.trim("value") == "", "")
        .when(~known_layout(layouts), UNKNOWN_LAYOUT)
        .when(~F.col("width_ok"), WRONG_WIDTH)
        .when(F.col(f"`{season}`").isNull(), NO_SEASON)
    )
    typed = typed.withColumn("reason", reason)
    whole = staged(typed.withColumn("value", F.when(F.col("reason") != "", F.col("value"))), "lines")
    lines = whole.where(F.col("reason").isNull()).drop("file", "_split", "_at", "value", "reason")

    splits = whole.groupBy("file", "_split").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.expr("coalesce(sum(_n) over (partition by file order by _split rows between unbounded preceding and 1 preceding), 0L)")
    starts = staged(splits.select("file", "_split", "_first", before.alias("_before")), "splits")
    bad = whole.where(F.col("reason") != "").join(starts, ["file", "_split"])
    number = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return Checked(lines, bad.select("pos", "kind", "file", number.alias("line_no"), "reason", F.col("value").alias("raw")))


def _good_lines(found: Checked, quarantine: str | None) -> DataFrame:
    """The stat lines; the others are written to ``quarantine``, or a warning says how many there are."""
    if quarantine is not None:
        found.malformed.write.mode("overwrite").parquet(quarantine)
    elif n := found.malformed.count():
        warnings.warn(f"{n} malformed lines are left out; name a quarantine folder to keep them", stacklevel=3)
    return found.lines


def from_comma_text(lines: DataFrame, layouts: LayoutMap = LAYOUTS, *, text: str = "value") -> DataFrame:
    """Typed stat lines from comma text with ``pos``, ``kind`` and ``season_hint`` columns.

    Cells may be quoted. Blank lines are no records.
    """
    kept = [c for c in lines.columns if c != text]
    records = lines.where(F.trim(text) != "").select(*kept, comma_cells(F.col(text)).alias("record"))
    return conform(records, layouts)


def season_paths(
    root: str, seasons: Iterable[int], positions: Sequence[str] = POSITIONS, kinds: Sequence[str] = KINDS
) -> list[str]:
    """Files of the given seasons, one per season, position and kind."""
    return [
        f"{root}/" + SEASON_FILE.format(yr=yr, pos=p, kind=k) for yr in seasons for p in positions for k in kinds
    ]


def read_seasons(
    spark: SparkSession,
    root: str,
    first: int,
    last: int,
    kinds: Sequence[str] = KINDS,
    positions: Sequence[str] = POSITIONS,
    *,
    quarantine: str | None = None,
) -> DataFrame:
    """All stat lines of a range of seasons, from one file per season, position and kind.

    Malformed lines go to the folder ``quarantine``; without one a warning tells their number.
    """
    paths = season_paths(root, range(first, last + 1), positions, kinds)
    return in_seasons(_good_lines(checked_stat_lines(spark, paths), quarantine), "Yr", first, last)


def read_master(
    spark: SparkSession, root: str, first: int, last: int, layout: Layout, *, quarantine: str | None = None
) -> DataFrame:
    """One position and kind of a range of seasons, from its master file; see :func:`read_seasons`."""
    path = f"{root}/" + MASTER_FILE.format(first=first, last=last, pos=layout.position, kind=layout.kind)
    return in_seasons(_good_lines(checked_stat_lines(spark, path), quarantine), "Yr", first, last)


def read_scoring_season(
    spark: SparkSession,
    root: str,
    season: int,
    positions: Sequence[str] = POSITIONS,
    *,
    full_season: int = FULL_SEASON,
    quarantine: str | None = None,
) -> DataFrame:
    """Forecasts of the season to be scored; every player is given a full season of games. See :func:`read_seasons`."""
    paths = [f"{root}/" + SCORING_FILE.format(yr=season, pos=p) for p in positions]
    lines = _good_lines(checked_stat_lines(spark, paths), quarantine).where(F.col("kind") == PROJECTED)
    return with_full_exposure(in_seasons(lines, "Yr", season, season), full_season=full_season)


def union_lines(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames of several seasons, kinds or pages as one; missing columns become NULL."""
    whole, *rest = frames
    for frame in rest:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole
