"""Connected components of a stored table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardex.llm.common import discard, store


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable by ``links(a, b)``.

    Large-star and small-star steps: every node's neighbours are tied to the smallest
    of them, first the larger ones, then the smaller ones, until nothing changes.  A
    step shuffles the links twice, partially aggregated where a node has many, and is
    stored in the shared folder, so lost executors cost one step.  Only the number of
    links and a checksum reach the driver.  Only nodes that have links are returned.
    """
    spark = links.sparkSession
    state = {
        "rows": "count(1)",
        "mixed": "bit_xor(xxhash64(a, b))",
        "summed": f"sum(pmod(xxhash64(a, b), {1 << 20}))",
    }
    edges = store(
        spark,
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
        **state,
    )
    while edges.measures["rows"]:
        before, edges = edges, store(spark, _small_star(_large_star(edges)), "edges", **state)
        discard(before)
        if before.measures == edges.measures:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(smallest, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # every link points from the larger to the smaller node
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(smallest, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .unionByName(smallest.select("a", F.col("m").alias("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
