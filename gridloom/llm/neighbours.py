"""Approximate nearest neighbours by a hierarchical k-means tree, best bin first.

The tree is fitted on at most ``FIT_ROWS`` vectors, those with the smallest hash of id
and vector, which is the documented bound; every vector is then put into a leaf. A query
walks the tree through a priority queue, nearest branch first, and so gets an order of
leaves. How many leaves it visits is calibrated: on a held-out part of the sample, the
number is widened until the recall asked for is reached. A query goes on until its leaves
hold more than ``k`` vectors, so an outlier gets as many neighbours as any other.

Vectors and queries meet by leaf; a leaf with many vectors or queries is dealt to several
groups, and each gives its best few. Equal queries are asked once, and of equal vectors
only as many take part as can be in a result, so copies make no hot leaf. Distances are
exact on the original vectors, so a result can only lack a neighbour, never misplace one.

Defined cases: vectors that are null, zero, or hold null or non-finite components take
no part, nor do rows without an id. Vectors of unequal length are an error. Rows that
share an id are apart: each is a candidate of the others, and each that asks gets a list of
its own. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.batches import least_hashed
from gridloom.llm.components import written
from gridloom.sources.staging import discard, new_folder

FIT_ROWS = 20_000
BRANCHES, LEAF_ROWS = 8, 64
RECALL = 0.97
# Candidates, and queries, of one leaf that are compared in one task group.
GROUP_ROWS = 4_000


@dataclass
class Node:
    """A centre per child; a leaf has a number instead."""

    centres: np.ndarray | None
    children: list[Node]
    leaf: int = -1


class KMeansTree:
    def __init__(self, vectors: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS, seed: int = 3):
        self.leaves = 0
        self._rng = np.random.default_rng(seed)
        self.root = self._grow(vectors, branches, leaf_rows)

    def _grow(self, vectors: np.ndarray, branches: int, leaf_rows: int) -> Node:
        distinct = np.unique(vectors, axis=0) if len(vectors) > leaf_rows else vectors
        if len(vectors) <= leaf_rows or len(distinct) <= branches:
            self.leaves += 1
            return Node(None, [], self.leaves - 1)
        centres = distinct[self._rng.choice(len(distinct), branches, replace=False)]
        for _ in range(8):
            own = distances(vectors, centres).argmin(axis=1)
            centres = np.stack([vectors[own == k].mean(axis=0) if (own == k).any() else centres[k] for k in range(branches)])
        own = distances(vectors, centres).argmin(axis=1)
        used = [k for k in range(branches) if (own == k).any()]
        if len(used) < 2:
            self.leaves += 1
            return Node(None, [], self.leaves - 1)
        return Node(centres[used], [self._grow(vectors[own == k], branches, leaf_rows) for k in used])

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(len(vectors), np.int32)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if node.centres is None:
                out[rows] = node.leaf
                continue
            own = distances(vectors[rows], node.centres).argmin(axis=1)
            todo += [(child, rows[own == k]) for k, child in enumerate(node.children) if (own == k).any()]
        return out

    def visits(self, query: np.ndarray, most: int, sizes: np.ndarray | None = None, rows: int = 0) -> list[int]:
        """Leaves, best bin first: the first ``most``, and more until they hold ``rows`` vectors by ``sizes``."""
        queue, found, held, tick = [(0.0, 0, self.root)], [], 0, 0
        while queue and (len(found) < most or held < rows):
            _, _, node = heapq.heappop(queue)
            while node.centres is not None:
                d = ((node.centres - query) ** 2).sum(axis=1)
                near = int(d.argmin())
                for k, child in enumerate(node.children):
                    if k != near:
                        tick += 1
                        heapq.heappush(queue, (float(d[k]), tick, child))
                node = node.children[near]
            found.append(node.leaf)
            held += 0 if sizes is None else int(sizes[node.leaf])
        return found


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by the product form, for choosing centres."""
    return (a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1)[None]


def calibrated_visits(tree: KMeansTree, vectors: np.ndarray, queries: np.ndarray, k: int, recall: float = RECALL) -> int:
    """The least number of leaves with which the queries find that share of their ``k`` nearest."""
    if not len(queries) or len(vectors) <= k:
        return tree.leaves
    leaf = tree.leaf_of(vectors)
    needed = []
    for q in queries:
        nearest = np.argpartition(((vectors - q) ** 2).sum(axis=1), k)[:k]
        place = np.empty(tree.leaves, np.int64)
        place[tree.visits(q, tree.leaves)] = np.arange(1, tree.leaves + 1)
        needed += place[leaf[nearest]].tolist()
    return int(np.quantile(needed, recall, method="higher"))


def usable(vector: Column) -> Column:
    """Vectors that take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding", fit_rows: int = FIT_ROWS, recall: float = RECALL) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (Euclidean distance) of each query's ``k`` nearest others."""
    spark = vectors.sparkSession
    folder = new_folder(spark, "nearest")
    usable_rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("q"))
    usable_rows = usable_rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    # Numbers tell rows apart that share id and vector; they hold once they are written.
    rows = written(usable_rows.withColumn("row", F.monotonically_increasing_id()), "rows", folder)
    # The hash of a row's id and vector decides, so that ids that come again do not.
    fitted = np.array(least_hashed(rows.select("vec_id", "v"), fit_rows).select("v").toArrow().column("v").to_pylist(), np.float64)
    if not len(fitted):
        discard(spark, folder)
        return spark.createDataFrame([], RESULT)
    held = fitted[: min(200, len(fitted) // 5)]
    tree = KMeansTree(fitted[len(held) :] if len(fitted) > 400 else fitted)
    most = calibrated_visits(tree, fitted[len(held) :], held, k, recall) if len(fitted) > 400 else tree.leaves
    shared = spark.sparkContext.broadcast((tree, most))

    @F.pandas_udf("int")
    def leaf_of(v: pd.Series) -> pd.Series:
        return pd.Series(shared.value[0].leaf_of(np.stack(v.to_list())) if len(v) else [], dtype="int32")

    # Of equal vectors only the k + 1 smallest ids can be among a query's k nearest others.
    same = Window.partitionBy("v").orderBy("vec_id", "row")
    few = rows.select("v", "vec_id", "row").withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy")
    placed = written(few.withColumn("leaf", leaf_of("v")), "placed", folder)
    counts = placed.groupBy("leaf").count().collect()  # a row for each leaf of the fitted tree at most
    sizes = np.zeros(tree.leaves, np.int64)
    for row in counts:
        sizes[row["leaf"]] = row["count"]
    sent = spark.sparkContext.broadcast(sizes)

    @F.pandas_udf("array<int>")
    def visits(v: pd.Series) -> pd.Series:
        known, count = shared.value
        return pd.Series([known.visits(q, count, sent.value, k + 1) for q in v])

    # Equal queries are asked once.
    queries = written(rows.where("q").select("v").distinct().withColumn("query", F.monotonically_increasing_id()), "queries", folder)
    asked = queries.select("query", F.col("v").alias("qv"), F.explode(visits("v")).alias("leaf"))

    def dealt(df: DataFrame, number: str, name: str, group_rows: int) -> DataFrame:
        """A leaf's rows in groups of about ``group_rows``; ``name`` is the group, ``name``s how many there are."""
        of_leaf = df.groupBy("leaf").agg(F.ceil(F.count("*") / group_rows).cast("int").alias(f"{name}s"))
        return df.join(F.broadcast(of_leaf), "leaf").withColumn(name, F.pmod(F.xxhash64(number), f"{name}s").cast("int"))

    def all_groups(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(f"{name}s") - 1)).alias(name)

    asked, placed = dealt(asked, "query", "part", GROUP_ROWS), dealt(placed, "row", "group", GROUP_ROWS)
    parts, groups = (df.groupBy("leaf").agg(F.first(f"{n}s").alias(f"{n}s")) for df, n in ((asked, "part"), (placed, "group")))
    asked = asked.join(F.broadcast(groups), "leaf").select("query", "qv", "leaf", "part", all_groups("group"))
    placed = placed.join(F.broadcast(parts), "leaf").select("vec_id", "row", "v", "leaf", "group", all_groups("part"))

    def best(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query": [], "vec_id": [], "row": [], "score": []})
        ids, numbers, there = held["vec_id"].to_numpy(), held["row"].to_numpy(), np.stack(held["v"].to_list())
        found = []
        for q, v in zip(asked["query"].to_numpy(), asked["qv"], strict=True):
            d = np.sqrt(((there - np.asarray(v)) ** 2).sum(axis=1))
            order = np.lexsort([numbers, ids, d])[: k + 1]
            found.append(pd.DataFrame({"query": q, "vec_id": ids[order], "row": numbers[order], "score": d[order]}))
        return pd.concat(found)

    keys = ["leaf", "part", "group"]
    met = asked.groupBy(keys).cogroup(placed.groupBy(keys)).applyInPandas(best, "query long, vec_id long, row long, score double")
    order = Window.partitionBy("query").orderBy("score", "vec_id", "row")
    near = met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    near = near.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "row", "score"))).alias("near"))
    # Every row that asks gets the list of its vector, without itself.
    own = rows.where("q").join(queries, "v").select("query", F.col("vec_id").alias("query_id"), F.col("row").alias("own"))
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("own")), 1, k)
    listed = own.join(near, "query").select("query_id", F.posexplode(others).alias("at", "x"))
    result = written(listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")), "nearest")
    discard(spark, folder)
    return result
