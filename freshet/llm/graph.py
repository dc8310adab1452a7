"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.session import shared_path


def written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` for all nodes of the edges ``a``, ``b`` (long).

    The component is its smallest node. Each round ties every node's larger
    neighbours to the least of its neighbourhood, then does the same with the
    smaller ones; rounds end when nothing changes, after about the logarithm of
    the longest path. Edges and minima are tables of their own, so the join of a
    node with very many neighbours can be split. Nulls and loops are no edges.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = written(ordered, "edges"), None
    while True:
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = (state["n"], state["s"])
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "minima")
        least = least.select("u", F.least("u", "m").alias("m"))
        large = written(links.join(least, links["b"] == least["u"]).select("a", F.col("m").alias("b")).distinct(), "edges")
        smaller = written(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "minima")
        tied = large.join(smaller, large["a"] == smaller["u"])
        moved = tied.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(moved.union(smaller.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
