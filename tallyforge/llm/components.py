"""Connected components of a written table of links, by large-star and small-star rounds.

Each round is joins and aggregations of links; hubs are never gathered in one place. A round's
links are written to the shared folder, so that lineage stays short and executors may be lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathering, remove, written


def _mark(links: DataFrame) -> tuple:
    """Number of links and a checksum of their set."""
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b) but the roots: the least node that links lead to.

    A round at least halves what is between a node and its root; it ends when a round changes nothing."""
    spark = links.sparkSession
    links = written(links.where("a != b").select("a", "b").distinct(), "links")
    before = _mark(links)
    while before[0]:
        paths: list[str] = []
        with gathering(paths):
            now = written(_small_star(written(_large_star(links), "links")), "links")
        for path in paths[:-1]:  # of the round's tables the last one goes on
            remove(spark, path)
        links, mark = now, _mark(now)
        if mark == before:
            break
        before = mark
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
