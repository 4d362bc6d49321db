"""Helpers on tables: joins that survive hot keys, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tunetables.operators.staging import materialise


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the columns of ``right``, which has one row for a key. Both
    must be written tables: then nothing but their exchanges lies under the join,
    and Spark splits the partitions of hot keys among tasks when it runs
    (``spark.sql.adaptive.skewJoin``), repeating only the one row that they meet."""
    return left.join(right, keys, how)


def _written(df: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    """A table, written, and a digest of its rows taken in the same pass."""
    seen = Observation()
    digest = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
    out = materialise(df.observe(seen, *digest), label)
    return out, tuple(seen.get.values())


def components(links: DataFrame, label: str = "component") -> DataFrame:
    """(node, root) for every node of the undirected links (a, b); root is the
    smallest node that can be reached. Alternating large and small stars; each
    half round is a written table, and the rounds grow with the logarithm of the
    longest path."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, before = _written(pairs, label)
    while True:
        # large star: larger neighbours go to the smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), label)
        moved = join_unique(both, least, ["u"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(moved.filter("u <> v").distinct(), label)
        # small star: smaller neighbours and the node go to the smallest
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), label)
        small = join_unique(large, least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges, now = _written(small.filter("u <> v").distinct(), label)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
