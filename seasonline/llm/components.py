"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonline.session import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def component_roots(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of an undirected graph, root being its component's smallest node.

    Alternates two star operations until nothing changes: each node's larger neighbours are hung onto its
    smallest one, then its smaller ones and itself. The number of rounds grows with the logarithm of the
    graph's width. Minima are partial sums before the shuffle and come back by a join that adaptive
    execution splits, so a node with very many neighbours is no single task; each round is written to the
    shared folder, so a lost executor repeats one round at most. Loops and repeated links are harmless; a
    link with a null end is passed over.
    """
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    edges = staged(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.join(least, "u").where(F.col("v") > F.col("u"))
        large = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = (
            met.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        edges = staged(small, "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
