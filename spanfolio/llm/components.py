"""Connected components of links between numbered rows, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.sources.workspace import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``root``, the least id reachable, of every id that has a link (``a``, ``b``), written.

    Rounds of large and small stars: every node links its greater neighbours, then its
    smaller ones, to the least it knows. Each step is an aggregate and a join whose rows
    don't exceed the links; a round is written, so lost executors redo one round at most.
    The number of rounds grows with the logarithm of the longest chain.
    """
    links = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        print_of = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if print_of["n"] == 0 or print_of == before:
            roots = materialise(links.select(F.col("a").alias("id"), F.col("b").alias("root")).unionAll(links.select("b", "b").distinct()), "roots")
            discard(links)
            return roots
        before = print_of
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, links = links, materialise(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "small-stars")
        discard(last, large)
