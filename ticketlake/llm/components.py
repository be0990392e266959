"""Connected components of a table of links, by alternating star steps in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ticketlake.llm.common import discard, written


def connected(links: DataFrame, tasks: int | None = None) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of all nodes in ``a``, ``b``.

    Large-star: every node hands its larger neighbours to its smallest one. Small-star:
    its smaller neighbours and itself. Both keep components and shorten paths, until all
    links are stars around the smallest node. A node with very many neighbours is one
    aggregate and one join key, never a collected list. At most ``tasks`` tasks write the
    links, where they are known to be few.
    """
    edges = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links", tasks=tasks)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of the join are plain shuffles and Spark splits a hub's rows
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least", tasks=tasks)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "large-star", tasks=tasks)
        discard(least)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least", tasks=tasks)
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = written(small.select("e.u", "e.v").where("u <> v").distinct(), "small-star", tasks=tasks)
        discard(least)
        # done when no node is both a child and a parent and every child has one parent
        parents = small.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        open_ = parents.where("n > 1").select("u").unionByName(small.join(parents.select(F.col("u").alias("v")), "v", "left_semi").select("u"))
        if open_.isEmpty():
            break
        discard(edges, large)
        edges = small
    discard(edges, large)
    roots = small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return small.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
