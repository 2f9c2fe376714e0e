"""Documents linked by the Jaccard similarity of their word shingles (prefix-tree join).

Sets are ordered alike everywhere: shingles by hash, the most common ones last. Two
sets that are similar enough share one of the first ``n - ceil(t n) + 1`` shingles of
each, so documents meet under those. Before they are compared there,

* equal sets become one class,
* each class is compared with one partner for each of two min-hashes, which already
  joins nearly all copies of a text, at a cost in proportion to the classes,
* shingles under which only one component is left are dropped, and of those with the
  same documents all but one.

The prefixes of what is left are compared in prefix trees (:class:`SetTree`), and the
pairs that share enough there on their texts. No step writes all pairs
of a group, and none leaves out a pair that could link two components.

Defined cases: null, empty and blank texts have an empty set and no link. With fewer
words than ``width`` the whole sequence is the one shingle. A null id keeps its row
with a null component. Rows that share an id count as one document for linking, each
row with its own set size. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.batches import HASHED_BYTES, arrow_map, mixed, shingle_sets, signed, sliced
from gridloom.llm.components import components, written

# The shingles ordered last: those met most, at most so many. This only sets the order.
COMMON_SHINGLES = 1 << 18
# A task reports shingles that it met in so many documents.
COMMON_IN_TASK = 8
# Text bytes among which a task looks for shingles that come again; hashed in smaller slices.
COUNTED_BYTES = 8 << 20
# Documents of one shingle that are put into one tree; more are dealt to pairs of blocks.
BLOCK = 1_000

_SALT = np.uint64(0x9E3779B97F4A7C15)


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 80, width: int = 5) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``, the smallest linked id."""
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = written(_summaries(docs, width), "summaries")
    sizes = base.where("kind = 0").select("doc_id", "n")
    filled = base.where("kind = 0 and n > 0 and doc_id is not null")
    classes = filled.groupBy("d1", "d2", "n", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    classes = written(classes, "classes")
    same = filled.join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    texts = docs.where("doc_id is not null")
    stars = written(_stars(classes, percent), "stars")
    near = written(_verified(stars, texts, percent, width), "near")
    found = components(same.where("a <> b").unionByName(near))

    order = _common_order(base)
    first = prefixes(texts, order, percent, width)
    shared = first.groupBy("shingle").count().where("count > 1").select("shingle")
    members = classes.select(F.col("rep").alias("doc_id"), "n").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    members = members.withColumn("component", F.coalesce("component", "doc_id"))
    met = written(first.join(shared, "shingle").join(members, "doc_id"), "met")
    # Shingles with the very same documents need one comparison; most shingles of copies are such.
    same_members = [F.sum(F.xxhash64("doc_id", F.lit(k)).cast("decimal(20,0)")).alias(f"m{k}") for k in (1, 2)]
    spans = met.groupBy("shingle").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("size"), *same_members
    )
    spans = written(spans.where("c0 <> c1").select("shingle", F.struct("m1", "m2", "size").alias("meeting")), "spans")
    rest = met.join(spans, "shingle").groupBy("meeting", "doc_id", "n", "component").agg(F.min("place").alias("place"))
    rest = written(_meetings(rest, percent), "rest")
    pairs = written(tree_pairs(rest, texts, order, percent, width), "pairs")
    more = written(_verified(pairs, texts, percent, width), "more")
    if not more.isEmpty():
        # Every id already hangs under its component, so few rounds are left.
        found = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    found = found.withColumnRenamed("id", "doc_id")
    return sizes.join(found, "doc_id", "left").select(
        F.col("doc_id").alias(id),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def _summaries(docs: DataFrame, width: int) -> DataFrame:
    """Per row its set's size, digest and two min-hashes (kind 0); per task its common shingles (kind 1)."""

    def rows(kind: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
        count = len(next(iter(columns.values())))
        names = ("doc_id", "n", "d1", "d2", "f1", "f2")
        nothing = pa.nulls(count, pa.int64())
        arrays = [pa.array(np.full(count, kind, np.int8)), *(columns.get(c, nothing) for c in names)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["kind", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in sliced(batch, "text", COUNTED_BYTES):
                # Hashing takes some fifty bytes for one of text, the sets take one or two.
                sets = [s for some in sliced(part, "text", HASHED_BYTES) for s in shingle_sets(some.column("text"), width)]
                digests = np.array([divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 2**64) for s in sets], np.uint64).reshape(-1, 2)
                yield rows(
                    0,
                    {
                        "doc_id": part.column("doc_id"),
                        "n": np.array([len(s) for s in sets], np.int64),
                        "d1": signed(digests[:, 0]),
                        "d2": signed(digests[:, 1]),
                        "f1": signed(np.array([s[0] if len(s) else 0 for s in sets], np.uint64)),
                        "f2": signed(np.array([mixed(s ^ _SALT).min() if len(s) else 0 for s in sets], np.uint64)),
                    },
                )
                values, times = np.unique(np.concatenate(sets), return_counts=True)
                seen, at = np.unique(np.concatenate([seen, values[times > 1]]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, times[times > 1]]), len(seen)).astype(np.int64)
        often = counts >= COMMON_IN_TASK
        if often.any():
            yield rows(1, {"doc_id": signed(seen[often]), "n": counts[often]})

    return docs.mapInArrow(run, "kind byte, doc_id long, n long, d1 long, d2 long, f1 long, f2 long")


def _common_order(base: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The common shingles, sorted, and the place of each among them; bounded by ``COMMON_SHINGLES``."""
    common = base.where("kind = 1").groupBy(F.col("doc_id").alias("shingle")).agg(F.sum("n").alias("times"))
    top = common.orderBy(F.desc("times"), "shingle").limit(COMMON_SHINGLES).toArrow()
    shingles = top.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    place = np.lexsort([shingles, top.column("times").to_numpy()])
    rank = np.empty(len(place), np.int64)
    rank[place] = np.arange(1, len(place) + 1)
    order = np.argsort(shingles)
    return shingles[order], rank[order]


def _ranks(shingles: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Zero for ordinary shingles, else the place among the common ones."""
    common, rank = order
    if not len(common):
        return np.zeros(len(shingles), np.int64)
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    return np.where(common[at] == shingles, rank[at], 0)


def prefix_length(n: int, percent: int) -> int:
    """So many first shingles hold one that any similar enough set shares."""
    return n - -(-percent * n // 100) + 1 if n else 0


def prefixes(docs: DataFrame, order: tuple[np.ndarray, np.ndarray], percent: int, width: int) -> DataFrame:
    """``shingle``, ``doc_id``, ``place`` for the first shingles of every set, in the common order."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, "text", HASHED_BYTES):
            first = []
            for s in shingle_sets(part.column("text"), width):
                ranks = _ranks(s, shared.value)
                ordered = s if not ranks.any() else s[np.argsort(ranks, kind="stable")]
                first.append(ordered[: prefix_length(len(s), percent)])
            ids = part.column("doc_id").to_numpy()
            place = [np.arange(len(f)) for f in first]
            yield {"shingle": signed(np.concatenate(first)), "doc_id": np.repeat(ids, [len(f) for f in first]), "place": np.concatenate(place).astype(np.int32)}

    return arrow_map(docs, work, "shingle long, doc_id long, place int")


def _stars(classes: DataFrame, percent: int) -> DataFrame:
    """Each class with the first class of the same min-hash, for two min-hashes."""
    hashed = classes.select("rep", "n", F.explode(F.array(F.struct(F.lit(1).alias("k"), F.col("f1").alias("f")), F.struct(F.lit(2).alias("k"), F.col("f2").alias("f")))).alias("h"))
    hashed = hashed.select("rep", "n", F.struct("h.k", "h.f").alias("h"))
    heads = hashed.groupBy("h").agg(F.min("rep").alias("a"), F.count("*").alias("size")).where("size > 1").drop("size")
    # Written first, so that a hot min-hash can be split in the join.
    heads = written(heads, "heads")
    pairs = heads.join(hashed, "h").where("a <> rep").select("a", F.col("rep").alias("b"))
    return pairs.distinct()


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs ``a``, ``b`` of ids whose texts are similar enough."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = right.join(left.join(pairs.hint("shuffle_hash"), "a").hint("shuffle_hash"), "b")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        # One of the two texts may be much the longer.
        for part in (p for some in sliced(batch, "text_a", HASHED_BYTES) for p in sliced(some, "text_b", HASHED_BYTES)):
            sets = [shingle_sets(part.column(c), width) for c in ("text_a", "text_b")]
            keep = [similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent) for x, y in zip(*sets, strict=True)]
            part = part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield {"a": part.column("a"), "b": part.column("b")}

    return arrow_map(both.select("a", "b", "text_a", "text_b"), work, "a long, b long")


def similar(common: int, x: int, y: int, percent: int) -> bool:
    return common > 0 and 100 * common >= percent * (x + y - common)


def needed_overlap(x: int, y: int, percent: int) -> int:
    """What two sets of these sizes must at least share."""
    return -(-percent * (x + y) // (100 + percent))


def needed_in_prefixes(x: int, y: int, percent: int) -> int:
    """What their prefixes must share: at most what is behind the larger one's can come on top."""
    behind = -(-percent * max(x, y) // 100) - 1
    return max(1, needed_overlap(x, y, percent) - behind)


def signature(s: np.ndarray) -> bytes:
    """A bit for each element, in a power of two of at least two bits an element."""
    marks = np.zeros(1 << max(6, (2 * len(s) - 1).bit_length()), bool)
    marks[s & np.uint64(len(marks) - 1)] = True
    return np.packbits(marks).tobytes()


def least_difference(a: np.ndarray, b: np.ndarray) -> int:
    """So many elements at least are in one of two sets only, by their signatures as bytes."""
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    return int(np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)).sum())


class SetTree:
    """Prefix tree of the first elements of sets, as increasing integers.

    A node holds a run of elements, its children by their first one, and the range of
    the sizes of the whole sets below. A search carries the overlap so far down the
    tree, shared by all sets below a node, and leaves a branch when its sizes, or what
    is left of both prefixes, cannot reach what they need to share.
    """

    __slots__ = ("run", "children", "least", "most", "sets")

    def __init__(self, run: np.ndarray):
        self.run = run
        self.children: dict[int, SetTree] = {}
        self.least, self.most = 1 << 60, 0
        self.sets: list[tuple[int, int]] = []

    @classmethod
    def of(cls, prefixes: list[np.ndarray], sizes: list[int]) -> SetTree:
        root = cls(np.zeros(0, np.int64))
        for key, (elements, size) in enumerate(zip(prefixes, sizes, strict=True)):
            root._add(key, elements, size)
        return root

    def _add(self, key: int, elements: np.ndarray, size: int) -> None:
        node, at = self, 0
        while True:
            node.least, node.most = min(node.least, size), max(node.most, size)
            if at == len(elements):
                node.sets.append((key, size))
                return
            child = node.children.get(int(elements[at]))
            if child is None:
                child = SetTree(elements[at:])
                node.children[int(elements[at])] = child
                at = len(elements)
            else:
                width = min(len(child.run), len(elements) - at)
                differs = np.flatnonzero(child.run[:width] != elements[at : at + width])
                same = int(differs[0]) if len(differs) else width
                if same < len(child.run):
                    upper = SetTree(child.run[:same])
                    upper.least, upper.most = child.least, child.most
                    child.run = child.run[same:]
                    upper.children[int(child.run[0])] = child
                    node.children[int(elements[at])] = upper
                    child = upper
                at += same
            node = child

    def matches(self, probe: np.ndarray, size: int, percent: int, skip) -> Iterator[int]:
        """Keys of the sets whose prefixes share enough with ``probe``, that of a set of ``size``; ``skip(key)`` spares a set."""
        stack = [(self, 0, 0)]
        while stack:
            node, depth, common = stack.pop()
            if 100 * node.most < percent * size or 100 * size < percent * node.least:
                continue
            if len(node.run):
                at = np.searchsorted(probe, node.run)
                inside = at < len(probe)
                common += int((probe[at[inside]] == node.run[inside]).sum())
                depth += len(node.run)
                left = min(prefix_length(node.most, percent) - depth, len(probe) - int(np.searchsorted(probe, node.run[-1], side="right")))
                # The need is least at an end of the range of sizes, up to rounding.
                if common + left < min(needed_in_prefixes(size, n, percent) for n in (node.least, node.most)) - 1:
                    continue
            for key, n in node.sets:
                fits = 100 * n >= percent * size and 100 * size >= percent * n
                if fits and common >= needed_in_prefixes(size, n, percent) and not skip(key):
                    yield key
            stack.extend((child, depth, common) for child in node.children.values())


def _meetings(rest: DataFrame, percent: int) -> DataFrame:
    """The documents of each meeting that can match another component's there.

    What two sets share from their first common shingle on is no more than either has
    left there. So a set this far into its order has a largest size of a partner.
    """
    largest = F.floor(((100 + percent) * (F.col("n") - F.col("place")) - percent * F.col("n")) / percent)
    rest = rest.withColumn("largest", largest)
    for _ in range(2):
        about = rest.groupBy("meeting").agg(
            F.min("n").alias("least"),
            F.max("largest").alias("reach"),
            F.min("component").alias("c0"),
            F.max("component").alias("c1"),
            F.count("*").alias("size"),
        )
        rest = rest.drop("size").join(about.where("c0 <> c1"), "meeting")
        rest = rest.where("largest >= least and n <= reach").drop("least", "reach", "c0", "c1")
    about = rest.groupBy("meeting").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    return rest.join(about.where("c0 <> c1").select("meeting"), "meeting").drop("largest")


def tree_pairs(rest: DataFrame, texts: DataFrame, order: tuple[np.ndarray, np.ndarray], percent: int, width: int) -> DataFrame:
    """Pairs of different components among documents of the same meeting whose prefixes share enough.

    Only prefixes and signatures travel; a pair whose signatures differ too much is left
    out. A meeting of many documents is dealt to blocks, with one task group for each
    pair of blocks, so that no group outgrows a task; a pair is compared in that of its
    two blocks only. Prefixes start at the meeting's first shingle: what lies before it
    is shared only by pairs that also have an earlier meeting, where they are found.
    """
    shared = texts.sparkSession.sparkContext.broadcast(order)

    def first(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, "text", HASHED_BYTES):
            found, marks = [], []
            for s in shingle_sets(part.column("text"), width):
                ordered = s[np.argsort(_ranks(s, shared.value), kind="stable")]
                found.append(ordered[: prefix_length(len(s), percent)].tobytes())
                marks.append(signature(s))
            yield {"doc_id": part.column("doc_id"), "prefix": pa.array(found, pa.binary()), "marks": pa.array(marks, pa.binary())}

    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("long")
    rest = rest.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks"))
    # The pairs of blocks that a block takes part in; one pair alone where there is one block.
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    key = ["meeting", "u", "v"]
    keyed = rest.select("doc_id", "n", "component", "place", "block", "meeting", F.least("block", "other").alias("u"), F.greatest("block", "other").alias("v"))
    full = arrow_map(texts, first, "doc_id long, prefix binary, marks binary").join(keyed.hint("shuffle_hash"), "doc_id")
    full = full.withColumn("prefix", F.expr("substring(prefix, place * 8 + 1)")).drop("place")
    full = full.repartition(*key).sortWithinPartitions(*key)

    member = ["doc_id", "n", "component", "block", "prefix", "marks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = None, []
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in key), strict=True)
            for k, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in member), strict=True), strict=True):
                if k != held:
                    yield _group_pairs(group, shared.value, percent, held is not None and held[1] != held[2])
                    held, group = k, []
                group.append(Member(*row[:4], np.frombuffer(row[4], np.uint64), np.frombuffer(row[5], np.uint8)))
        yield _group_pairs(group, shared.value, percent, held is not None and held[1] != held[2])

    return full.select(*key, *member).mapInArrow(run, "a long, b long").distinct()


class Member(NamedTuple):
    """A document in a group, its prefix from the meeting's first shingle on."""

    doc: int
    n: int
    component: int
    block: int
    prefix: np.ndarray
    marks: np.ndarray


def _group_pairs(group: list[Member], order: tuple[np.ndarray, np.ndarray], percent: int, two_blocks: bool) -> pa.RecordBatch:
    """Pairs inside one block, or between the members of two blocks."""
    pairs: set[tuple[int, int]] = set()
    if len({m.component for m in group}) > 1:
        every = np.unique(np.concatenate([m.prefix for m in group]))
        local = np.empty(len(every), np.int64)
        local[np.lexsort([every, _ranks(every, order)])] = np.arange(len(every))
        prefixes = [local[np.searchsorted(every, m.prefix)] for m in group]
        tree = SetTree.of(prefixes, [m.n for m in group])
        # A pair of two components is found from one side; the largest component need not search.
        idle = Counter(m.component for m in group).most_common(1)[0][0]
        for x, probe in zip(group, prefixes, strict=True):
            if x.component == idle:
                continue

            def skip(key: int, x: Member = x) -> bool:
                y = group[key]
                return y.component == x.component or two_blocks and y.block == x.block

            for j in tree.matches(probe, x.n, percent, skip):
                y = group[j]
                if least_difference(x.marks, y.marks) <= x.n + y.n - 2 * needed_overlap(x.n, y.n, percent):
                    pairs.add((min(x.doc, y.doc), max(x.doc, y.doc)))
    columns = list(zip(*sorted(pairs), strict=True)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])
