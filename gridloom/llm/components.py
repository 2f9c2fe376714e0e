"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.sources.staging import session_conf, staged

MAX_ROUNDS = 60


def written(df: DataFrame, name: str, folder: str | None = None, compression: str | None = None) -> DataFrame:
    """:func:`staged`, after which Spark deletes the shuffle files behind the table.

    A run of large shuffles would otherwise keep all of them on the executors' disks.
    """
    with session_conf(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return staged(df, name, folder, compression=compression)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id``, ``component`` (smallest id reachable) of every id in a link to another one.

    Each round hangs every id's larger neighbours, then its smaller ones, under the
    smallest neighbour. The edge table never grows and is written each round, so a
    lost executor costs one round at most. Null ends and loops are left out.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("root"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("root"))
        hung = large.join(small, "a").select(F.explode(F.array("a", "b")).alias("a"), "root")
        after = written(hung.where("a <> root").select("a", F.col("root").alias("b")).distinct(), "links")
        # Done when every link leads from a leaf to a root: no leaf has two roots, no root is itself a leaf.
        ends = after.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("leaf")), F.struct(F.col("b").alias("id"), F.lit(0).alias("leaf")))).alias("e"))
        open_ends = ends.groupBy("e.id").agg(F.sum("e.leaf").alias("roots"), F.min("e.leaf").alias("leaf")).where("roots > leaf")
        links = after
        if not open_ends.count():
            roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
    raise RuntimeError(f"components have not settled after {MAX_ROUNDS} rounds")
