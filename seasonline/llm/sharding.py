"""Shards of even size that keep linked documents together, by balanced label propagation.

Documents are linked through the groups they belong to. Every linked document starts in a shard by hash. In each round
a document looks at how much of its groups each shard holds (its neighbours' labels) and wants to move to where most is,
among the shards that still have room; a shard takes as many of those who want in as its quota allows, those who
gain most first. Where no shard has room for anybody, rows of two shards change places. So cut links go down and no shard grows beyond an even share. What has no links is ballast and fills the
shards up at the end: slices of it, largest first, each into the emptiest shard.

What comes to the driver is sums per shard and slice, as many as the parameters say, never rows or groups.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonline.llm.common import unit_interval
from seasonline.session import staged

# Wishes are let in by classes: whole powers of two of the gain, each cut by hash.
_GAINS = 16


def _hashed(n: int, *columns: Column) -> Column:
    return F.floor(unit_interval(*columns) * n).cast("int")


def _wishes(links: DataFrame, labels: DataFrame, open_shards: list[int], cuts: int, turn: int) -> DataFrame:
    """Of every linked row that would gain by moving to one of ``open_shards``: node, size, shard, target, class.

    Weights are counted per group and shard before anything meets; the row of a group then travels to its members.
    Where a shard has more even with the row itself counted here, all members see it alike and may move at once; where only
    the others count, neighbours could trade places for ever, so a row moves in half of the turns, by hash.
    """
    placed = links.join(labels, "node")
    held = placed.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
    # Under half a row on top, by hash of group and shard: of shards that hold the same all members prefer the same one.
    weight = F.col("n") + unit_interval(F.col("hub"), F.col("shard")) / 2
    # One row a group, with at most one number a shard; staged, so that a join with a hot group can be split.
    hubs = staged(held.groupBy("hub").agg(F.map_from_entries(F.collect_list(F.struct("shard", weight.alias("n")))).alias("held")), "hubs")
    seen = placed.join(hubs, "hub").select("node", "size", "shard", F.explode("held").alias("near", "n"))
    total = seen.groupBy("node", "size", "shard", "near").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hubs"))
    own = F.col("near") == F.col("shard")
    here = F.max(F.when(own, F.col("n")))
    others = F.max(F.when(own, F.col("n") - F.col("hubs")))
    free = F.col("near").isin(open_shards) & (F.col("near") != F.col("shard"))
    best = F.max(F.when(free, F.struct("n", "near")))
    wanted = total.groupBy("node", "size", "shard").agg(here.alias("here"), others.alias("others"), best.alias("best"))
    gain = F.col("best.n") - F.col("others")
    moves = (F.col("best.n") > F.col("here")) | ((gain > 0) & (unit_interval(F.lit(turn), F.col("node")) < 0.5))
    rank = F.least(F.lit(_GAINS - 1), F.floor(F.log2(gain + 1)).cast("int"))
    return wanted.where(moves).select(
        "node", "size", "shard", F.col("best.near").alias("target"), (rank * cuts + _hashed(cuts, F.lit("wish"), F.col("node"))).alias("class")
    )


def _trades(classes: list) -> dict[tuple[int, int], int]:
    """Per pair of shards the size that may change places: as much as wants to go both ways."""
    sums: dict[tuple[int, int], int] = {}
    for row in classes:
        pair = row["shard"], row["target"]
        sums[pair] = sums.get(pair, 0) + row["size"]
    return {(a, b): min(size, sums.get((b, a), 0)) for (a, b), size in sums.items()}


def _propagated(links: DataFrame, sizes: DataFrame, shards: int, quota: float, rounds: int, cuts: int) -> DataFrame:
    """(node, size, shard) of every linked row after at most ``rounds`` rounds of moves."""
    nodes = links.select("node").distinct()
    labels = sizes.join(nodes, "node", "left_semi").select("node", "size", _hashed(shards, F.lit("start"), F.col("node")).alias("shard"))
    labels = staged(labels, "labels")
    spark = sizes.sparkSession
    closed: dict[int, int] = {}  # shards that could take none of those who wanted in, and their load then
    trade = False
    for turn in range(rounds):
        load = {r["shard"]: r["size"] for r in labels.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
        room = {s: quota - load.get(s, 0) for s in range(shards)}
        open_shards = [s for s in range(shards) if trade or room[s] > 0.01 * quota and closed.get(s) != load.get(s, 0)]
        wishes = staged(_wishes(links, labels, open_shards, cuts, turn), "wishes")
        classes = wishes.groupBy("shard", "target", "class").agg(F.sum("size").alias("size")).collect()
        budget = _trades(classes) if trade else {}
        least: list[tuple[int, int, int]] = []
        for target in open_shards:
            wanted = sorted((r for r in classes if r["target"] == target), key=lambda r: (-r["class"], r["shard"]))
            left, got = room[target], {}
            for row in wanted:
                pair = row["shard"], target
                if trade:
                    budget[pair] -= row["size"]
                    if budget[pair] >= 0:
                        got[pair] = row["class"]
                    continue
                left -= row["size"]
                if left < 0:
                    break
                got[pair] = row["class"]
            if wanted and not got:
                closed[target] = load.get(target, 0)
            least += [(*pair, number) for pair, number in got.items()]
        if least:
            let_in = spark.createDataFrame(least, "shard int, target int, least int")
            moved = wishes.join(let_in, ["shard", "target"]).where(F.col("class") >= F.col("least")).select("node", "target")
            labels = staged(labels.join(moved, "node", "left").select("node", "size", F.coalesce("target", "shard").alias("shard")), "labels")
            trade = False
        elif trade:
            break
        elif not classes:
            trade = True  # nobody fits in anywhere any more: rows change places
    return labels


def _filled(loose: DataFrame, load: dict[int, int], shards: int, slices: int) -> DataFrame:
    """(node, size, shard) of rows that may go anywhere: slices of rows of like size, the largest first, each to the
    emptiest shard, so that what differs at the end is about one of the smallest."""
    # A power of four of the size, then a hash: at most 32 times ``slices`` sums come to the driver.
    cut = loose.select("node", "size", F.floor(F.log2("size") / 2).cast("int").alias("kind"), _hashed(slices, F.lit("slice"), F.col("node")).alias("slice"))
    sums = [(r["size"], r["kind"], r["slice"]) for r in cut.groupBy("kind", "slice").agg(F.sum("size").alias("size")).collect()]
    heap = [(load.get(s, 0), s) for s in range(shards)]
    heapq.heapify(heap)
    dealt = []
    for size, kind, number in sorted(sums, reverse=True):
        held, shard = heap[0]
        heapq.heapreplace(heap, (held + size, shard))
        dealt.append((kind, number, shard))
    spark = loose.sparkSession
    places = staged(spark.createDataFrame(dealt, "kind int, slice int, shard int"), "slices")
    return cut.join(places, ["kind", "slice"]).select("node", "size", "shard")


def balanced_shards(
    sizes: DataFrame, links: DataFrame, *, shards: int = 16, rounds: int = 12, cuts: int = 64, slices: int = 4096
) -> DataFrame:
    """(node, size, shard) of every row of ``sizes`` (node, size): shards from 0 of near equal total size, that cut few links.

    ``links`` (node, hub) links rows that share a hub; a plain edge is a hub of two. ``node`` is different in every row of
    ``sizes`` and of a type that hashes; sizes are whole and at least 1. Links of nodes that are not in ``sizes`` and
    rows with a null do nothing, repeated links count once. A linked row moves at most ``rounds`` times. A shard that
    holds more linked rows than an even share gives some of them, by hash, back to be dealt with the rest. Equal
    input gives equal shards; an empty table gives no rows.
    """
    total = sizes.agg(F.sum("size")).first()[0]
    if total is None:
        return sizes.select("node", "size", F.lit(0).alias("shard"))
    quota = total / shards
    # Groups of one link nothing.
    real = links.where(F.col("hub").isNotNull()).distinct().join(sizes.select("node"), "node", "left_semi")
    many = staged(real.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hub"), "hubs")
    links = staged(real.join(many, "hub", "left_semi"), "links")
    if links.isEmpty():
        return _filled(sizes, {}, shards, slices)
    labels = _propagated(links, sizes, shards, quota, rounds, cuts)
    # Of a shard above the quota only the first cuts by hash stay, as far as they fit.
    cut = labels.withColumn("cut", _hashed(cuts, F.lit("stay"), F.col("node")))
    sums = cut.groupBy("shard", "cut").agg(F.sum("size").alias("size")).collect()
    stays = F.lit(True)
    for shard in range(shards):
        left = quota
        for row in sorted((r for r in sums if r["shard"] == shard), key=lambda r: r["cut"]):
            left -= row["size"]
            if left < 0:
                stays &= (F.col("shard") != shard) | (F.col("cut") < row["cut"])
                break
    kept = staged(cut.where(stays).drop("cut"), "labels")
    load = {r["shard"]: r["size"] for r in kept.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
    return kept.unionByName(_filled(sizes.join(kept, "node", "left_anti"), load, shards, slices))


def with_slots(rows: DataFrame, shard: str = "shard", *, order: str, slot: str = "slot", rows_of_part: int = 100_000) -> DataFrame:
    """``rows`` with gapless numbers from 0 in every shard; ``order`` is a column that differs in every row.

    Rows of a shard are cut by hash into parts of about ``rows_of_part``; a part starts where those before it end, by a
    prefix sum over the parts' counts.
    """
    parts = max(1, -(-rows.count() // rows_of_part))
    cut = rows.withColumn("part", _hashed(parts, F.lit("part"), F.col(order)))
    counts = cut.groupBy(shard, "part").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed(shard, "of")
    before = F.expr("coalesce(sum(n) over (partition by of order by part rows between unbounded preceding and 1 preceding), 0L)")
    starts = staged(counts.select("of", F.col("part").alias("at"), before.alias("start")), "starts")
    within = F.expr(f"row_number() over (partition by {shard}, part order by {order})") - 1
    numbered = cut.withColumn("within", within)
    met = numbered.join(starts, (F.col(shard) == F.col("of")) & (F.col("part") == F.col("at")))
    return met.withColumn(slot, (F.col("start") + F.col("within")).cast("long")).drop("of", "at", "start", "within", "part")


def shard_documents(docs: DataFrame, *, shards: int = 16, doc_id: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``.

    Size is the text's bytes in UTF-8 plus 1; a null text has none, and counts as equal to the empty one. Law ``bytes``: the
    shards' sizes are near equal; ``grown_shard`` is null, as it belongs to another law. Rows with equal texts are linked and
    stay together as far as the sizes allow. Every row gets a place, also repeated ones and those without id; other columns are
    not read; an empty table gives no rows. ``settings`` go to :func:`balanced_shards`.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    raw = F.encode(body, "UTF-8")
    read = docs.select(
        F.monotonically_increasing_id().alias("node"),
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.sha2(raw, 256).alias("hub"),
    )
    read = staged(read, "documents")
    placed = balanced_shards(read.select("node", "size"), read.select("node", "hub"), shards=shards, **settings)
    placed = staged(placed.select("node", "shard"), "placed")
    numbered = with_slots(read.drop("hub").join(placed, "node"), order="node")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
