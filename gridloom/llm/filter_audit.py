"""How filters of documents interact, whatever order they are applied in.

Each document has the set of filters that it fails. A state is a set of filters applied
so far, an edge adds one filter to it, and an order is a path from the empty state to the
full one. The documents an edge removes fail its filter and none of its state; this holds
for all orders through that edge. Paths are counted forward (orders that reach a state)
and backward (orders that leave it), and an edge's removals, weighted by the paths through
it, sum to the Shapley figure of its filter. The steps of an order are read from its edges.

Spark counts documents per part and set of failed filters, so at most 2 ** filters figures
a part reach the lattice, which is the same for every part.

Defined cases: a null text is empty, a null part the empty string. A document is marked if
any row of the marks with its id says so; a null id is never marked. Copies are judged by
whole texts: a row fails if a row of the same text has a smaller id, so rows that share the
smallest id all pass, and a row without id neither fails nor makes others fail. Repeated
rows count as often as they come; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.batches import arrow_map

# The lattice of one part has 2 ** filters states, and filters! orders are reported.
MOST_FILTERS = 8

LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
BLANKS, CAPITALS, MARKUP = r"[\x20\x09-\x0D]+", r"[^A-Z]+", r"[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D: few words, few distinct words, many capitals, markup characters."""
    words = F.array_remove(F.split(text, BLANKS), "")
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT,
        "C": F.length(F.regexp_replace(text, CAPITALS, "")).cast("long") * 100 > F.length(text).cast("long") * MOST_CAPITALS,
        "D": text.rlike(MARKUP),
    }


def copies(rows: DataFrame) -> DataFrame:
    """``rows`` of ``id``, ``digest`` and ``times`` with ``copy``: whether a smaller id has the digest.

    The smallest id of each digest is found with partial minima, and only the pair of both is
    joined, so no digest makes a hot key.
    """
    least = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"), F.lit(True).alias("first"))
    joined = rows.join(least, ["digest", "id"], "left")
    return joined.withColumn("copy", F.col("id").isNotNull() & F.col("first").isNull()).drop("first")


def failed_sets(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per ``part`` and ``fails`` (bits of the filters A to E) the documents ``n``, and those marked ``good`` and ``toxic``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("whole"))
    bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(F.col("whole")).values())]
    rows = rows.select("id", "part", F.unhex(F.sha2("whole", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("fails"))
    # Repeated rows meet here, so that none of the joins has a hot key.
    rows = rows.groupBy("id", "digest", "part", "fails").agg(F.count("*").alias("times"))
    marks = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    judged = copies(rows).join(marks, "id", "left")
    fails = F.col("fails") + F.when(F.col("copy"), 16).otherwise(0)
    marked = [F.sum(F.when(F.col(m) == 1, F.col("times")).otherwise(0)).alias(m) for m in ("good", "toxic")]
    return judged.groupBy("part", fails.alias("fails")).agg(F.sum("times").alias("n"), *marked)


class Lattice:
    """States, edges and paths of ``k`` filters."""

    def __init__(self, k: int):
        if not 1 <= k <= MOST_FILTERS:
            raise ValueError(f"from 1 to {MOST_FILTERS} filters")
        states = np.arange(1 << k)
        self.k, self.states = k, states
        # Edges in order of their size, so that a state is complete before its edges are read.
        by_size = sorted(states.tolist(), key=lambda s: (s.bit_count(), s))
        self.edges = [(s, f) for s in by_size for f in range(k) if not s >> f & 1]
        self.reach, self.leave = np.zeros(1 << k, np.int64), np.zeros(1 << k, np.int64)
        self.reach[0] = self.leave[-1] = 1
        for state, f in self.edges:
            self.reach[state | 1 << f] += self.reach[state]
        for state, f in reversed(self.edges):
            self.leave[state] += self.leave[state | 1 << f]

    def kept(self, counts: np.ndarray) -> np.ndarray:
        """Per state the documents that fail none of its filters; ``counts`` is per failed set."""
        kept = np.zeros((len(self.states), counts.shape[1]), np.int64)
        for state in self.states:
            kept[state] = counts[self.states & state == 0].sum(axis=0)
        return kept

    def report(self, counts: np.ndarray, names: str) -> list[tuple]:
        """Rows of all orders and steps from the columns n, good and toxic of ``counts``."""
        kept = self.kept(counts)
        removed = {(s, f): kept[s] - kept[s | 1 << f] for s, f in self.edges}
        shapley = [0] * self.k
        for (state, f), gone in removed.items():
            shapley[f] += int(gone[0]) * int(self.reach[state]) * int(self.leave[state | 1 << f])
        failing = [int(counts[self.states >> f & 1 == 1, 0].sum()) for f in range(self.k)]
        rows = []
        for order in permutations(range(self.k)):
            state = 0
            for step, f in enumerate(order, 1):
                gone = removed[state, f].tolist()
                state |= 1 << f
                name = "".join(names[g] for g in order)
                rows.append((name, step, int(kept[state, 0]), gone[0], failing[f] - gone[0], int(counts[1 << f, 0]), gone[1], gone[2], shapley[f]))
        return rows


REPORT = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def interactions(sets: DataFrame, names: str = "ABCDE") -> DataFrame:
    """One row per ``part``, order of the filters and step, from the counts of :func:`failed_sets`.

    ``sets`` has one row per part and failed set; a part's rows meet in one, of 2 ** filters entries at most.
    """
    lattice = Lattice(len(names))
    parts = sets.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part, found in zip(batch.column("part").to_pylist(), batch.column("sets").to_pylist(), strict=True):
            counts = np.zeros((1 << lattice.k, 3), np.int64)
            for one in found:
                counts[one["fails"]] += [one["n"], one["good"], one["toxic"]]
            columns = list(zip(*lattice.report(counts, names), strict=True))
            kinds = [pa.string(), pa.int32()] + [pa.int64()] * 7
            yield {"part": [part] * len(columns[0]), **{c: pa.array(v, k) for c, v, k in zip(REPORT, columns, kinds, strict=True)}}

    return arrow_map(parts, work, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in REPORT[2:]))


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part``, ``filter_order``, ``step``, and the counts of that step, for all orders of the filters A to E."""
    return interactions(failed_sets(docs, labels, id, text, part))
