"""Connected components of a graph that no single task ever holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake.sources.tables import stored


def components(links: DataFrame, a: str, b: str, links_per_task: int | None = None) -> DataFrame:
    """(node, component) of every node of ``links``; a component is named by its smallest node.

    Links are contracted to stars in rounds. In a round each node hands its
    larger neighbours, then its smaller ones, to the smallest node it knows;
    the number of rounds grows with the logarithm of the longest path. Every
    round is one written table in the shared folder, so a lost executor costs
    at most a round. A node with very many links is only ever a minimum (summed
    before the shuffle) and one side of a join that adaptive execution splits;
    for that the minima are written first.
    With ``links_per_task`` the links are counted first, so they should be
    written, and the rounds have as many tasks and files as that number asks
    for, however many shuffle partitions are set.
    Links with a NULL end and loops say nothing and are left out.
    """
    tasks = None if links_per_task is None else max(1, -(-links.count() // links_per_task))

    def dealt(df: DataFrame) -> DataFrame:
        return df if tasks is None else df.coalesce(tasks)

    edges = stored(
        dealt(links).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") < F.col("v")))
        .distinct(),
        "links",
    )
    while True:
        both = dealt(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        lowest = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "lowest")
        larger = both.join(dealt(lowest), "u").where(F.col("v") > F.col("u")).select("v", F.col("low").alias("u")).distinct()
        # By now a node has few smaller neighbours: minima only.
        lowest = larger.groupBy("v").agg(F.min("u").alias("low"))
        met = larger.join(lowest, "v")
        smaller = met.select(F.col("u").alias("v"), F.col("low").alias("u")).where("u < v")
        edges = stored(dealt(smaller.unionByName(lowest.select("v", F.col("low").alias("u")))).distinct(), "stars")
        # Done when every node hangs on one other and none of those hangs on a third.
        edges = dealt(edges)
        inner = edges.select(F.col("u").alias("v")).distinct()
        if edges.join(inner, "v", "left_semi").isEmpty():
            break
    roots = edges.select(F.col("u").alias("node")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
