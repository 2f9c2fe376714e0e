"""Ranked lexical search through a pipeline of term owners.

An inverted index is written in blocks of documents: per block and term the places of the
documents that hold it. The terms of the items have owners, by bands of weight, rarest
first. Items travel in bundles: in every stage a bundle's sparse accumulators (documents
and partial scores of one block) meet, by ``cogroup``, the postings of that stage's owner
in that block, take their integer contributions, and go on. After the last owner each block
gives its best documents, and the best of these are the result.

Between two stages the ``top``-th best partial score of each item is taken over all blocks.
What an item can still gain has an exact bound, the greatest contribution of each later
term. A document that cannot reach that score any more goes, and an item whose gain alone
cannot reach it takes no new documents. Contributions are never negative, so the result is
that of all documents.

A frequent term, or many copies of a text, only make more blocks: a group of a cogroup is one
bundle in one block, both bounded. Every stage is written to the shared folder.

Weight of a term ``floor(1000 * ln((2N + 2) / (2 df + 1)))``, ``N`` documents with a term,
``df`` those with this one. Length norm ``m = 75 + (25 n N) div L`` for ``n`` terms of
``L`` in all. Contribution ``weight * ((10**9 tf) div (1000 tf + 12 m))``, for each time
the term stands in the item. Terms are 64-bit hashes of the lower-cased (A-Z) runs of
ASCII letters, digits and characters beyond ASCII.

Defined cases: null and blank texts hold no term; items without a term in any document have
no row. Each row of the documents is ranked by itself, also where an id or a text comes
again; a null id ranks after others of its score. Items that share id and text are one
item, those that share an id only are ranked separately. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.batches import ALPHANUMERIC, fresh, prefix_sums, signed, sliced, span_hashes, text_bytes, word_spans
from gridloom.llm.components import written
from gridloom.sources.staging import discard, new_folder

TOP = 20
# Documents and postings of a block, and items of a bundle (on average).
BLOCK_DOCS, BLOCK_POSTINGS, BUNDLE = 4096, 2_000_000, 64
# Least weight of the terms of each owner; these weights mean 0.7, 5 and 22 % of the documents.
OWNERS = (5000, 3000, 1500, 0)
SCALE = 1_000_000_000

INDEX = "block long, term long, docs array<int>, counts array<int>, lengths array<int>, ids array<long>"


def term_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every distinct term of every row, sorted, and the terms of each row with repeats."""
    data, offsets = text_bytes(column)
    starts, ends, firsts = word_spans(data, offsets, ALPHANUMERIC)
    terms = span_hashes(prefix_sums(data, lower=True), starts, ends)
    lengths = np.diff(firsts)
    rows = np.repeat(np.arange(len(column)), lengths)
    order = np.lexsort((terms, rows))
    rows, terms = rows[order], terms[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(new)
    return rows[at], signed(terms[at]), np.diff(np.append(at, len(rows))), lengths


def block_index(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Per block one row with the ``ids`` and ``lengths`` of its documents, and one per term with its postings.

    ``docs`` has ``id`` and ``text``. Block numbers are told from the partition, so they hold once the index is written.
    """

    def flushed(block: int, ids: list, lengths: list, parts: list) -> Iterator[pa.RecordBatch]:
        sizes = np.concatenate(lengths).astype(np.int32)
        rows, terms, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(terms, kind="stable")
        rows, terms, counts = rows[order].astype(np.int32), terms[order], counts[order].astype(np.int32)
        at = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
        cuts = pa.array(np.append(at, len(terms)).astype(np.int32))
        none = pa.nulls(len(at), pa.list_(pa.int64()))
        names = [f.split()[0] for f in INDEX.split(", ")]
        head = [pa.array([block]), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.list_(pa.int32()))] * 2, pa.array([sizes], pa.list_(pa.int32())), pa.array([ids], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(head, names)
        lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (rows, counts, sizes[rows])]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block)), pa.array(terms[at]), *lists, none], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, lengths, parts, held = [], [], [], 0
        for batch in batches:
            for some in sliced(batch, "text"):
                for at in range(0, some.num_rows, block_docs):
                    part = some.slice(at, block_docs)
                    if ids and (len(ids) + part.num_rows > block_docs or held > BLOCK_POSTINGS):
                        yield from flushed(block, ids, lengths, parts)
                        block, ids, lengths, parts, held = block + 1, [], [], [], 0
                    rows, terms, counts, sizes = term_counts(part.column("text"))
                    parts.append((rows + len(ids), terms, counts))
                    lengths.append(sizes)
                    held += len(rows)
                    ids += part.column("id").to_pylist()
        if ids:
            yield from flushed(block, ids, lengths, parts)

    return docs.mapInArrow(run, INDEX)


def item_terms(items: DataFrame) -> DataFrame:
    """``query`` (a number), ``id``, ``term`` and ``times`` of every term of the distinct rows of ``id`` and ``text``."""
    asked = items.distinct().withColumn("query", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                rows, terms, counts, _ = term_counts(part.column("text"))
                ids, queries = (part.column(c).take(pa.array(rows)) for c in ("id", "query"))
                yield pa.RecordBatch.from_arrays([queries, ids, pa.array(terms), pa.array(counts)], ["query", "id", "term", "times"])

    fields = ["query long", f"id {items.schema['id'].dataType.simpleString()}", "term long", "times long"]
    return asked.mapInArrow(run, ", ".join(fields))


def impact(counts: np.ndarray, lengths: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """Contribution of postings to a weight of 1."""
    counts, lengths = counts.astype(np.int64), lengths.astype(np.int64)
    return SCALE * counts // (1000 * counts + 12 * (75 + 25 * lengths * docs // terms))


def weighted(index: DataFrame, asked: DataFrame, docs: int, terms: int, owners: tuple[int, ...]) -> DataFrame:
    """Per item and term that counts: ``gain`` for each unit of impact, ``most`` it can add to a score, and ``owner``."""
    best = f"array_max(zip_with(counts, lengths, (c, n) -> ({SCALE} * cast(c as long)) div (1000 * cast(c as long) + 12 * (75 + (25 * cast(n as long) * {docs}L) div {terms}L))))"
    found = index.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max(F.expr(best)).alias("best"))
    weight = F.floor(F.log(F.lit(float(2 * docs + 2)) / (2 * F.col("df") + 1)) * 1000).cast("long")
    uses = asked.join(found.select("term", weight.alias("weight"), "best").where("weight > 0"), "term")
    gain = F.col("weight") * F.col("times")
    owner = sum((F.when(F.col("weight") < least, 1).otherwise(0) for least in owners[:-1]), F.lit(0))
    return uses.select("query", "term", gain.alias("gain"), (gain * F.col("best")).alias("most"), owner.alias("owner"))


def search(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    top: int = TOP, owners: tuple[int, ...] = OWNERS, block_docs: int = BLOCK_DOCS, bundle: int = BUNDLE,
) -> DataFrame:
    """The ``top`` documents of every item: item id, ``rank`` from 1, document id, ``score``."""
    spark = docs.sparkSession
    folder = new_folder(spark, "search")
    asked = written(item_terms(items.select(F.col(item_id).alias("id"), F.col(text).alias("text"))), "items", folder)
    # Postings of no item's term are dropped; the rows of the blocks, without a term, stay.
    wanted = asked.select("term").distinct().unionAll(spark.sql("select cast(null as long)")).withColumnRenamed("term", "wanted")
    whole = block_index(docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")), block_docs)
    index = written(whole.join(wanted, F.col("term").eqNullSafe(F.col("wanted")), "left_semi"), "index", folder)

    blocks = index.where("term is null")
    counted = "aggregate(lengths, 0L, (a, n) -> a + n)"
    total = blocks.agg(F.sum(F.expr("size(filter(lengths, n -> n > 0))")).alias("docs"), F.sum(F.expr(counted)).alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, max(1, total["terms"] or 0)
    uses = written(weighted(index, asked, n_docs, n_terms, owners), "uses", folder)
    bundles = max(1, -(-uses.select("query").distinct().count() // bundle))
    of_bundle = F.pmod(F.xxhash64("query"), F.lit(bundles)).cast("int").alias("bundle")

    state, floor = None, None
    for owner in range(len(owners)):
        last = owner == len(owners) - 1
        # What each item gains from this owner on and after it, against its score to reach.
        gains = uses.groupBy("query").agg(
            F.sum(F.when(F.col("owner") >= owner, F.col("most")).otherwise(0)).alias("now"),
            F.sum(F.when(F.col("owner") > owner, F.col("most")).otherwise(0)).alias("later"),
        )
        known = gains.withColumn("floor", F.lit(0).cast("long")) if floor is None else gains.join(floor, "query", "left").fillna(0, "floor")
        known = known.select("query", (F.col("now") >= F.col("floor")).alias("open"), (F.col("floor") - F.col("later")).alias("need"))
        users = uses.where(F.col("owner") == owner).join(known, "query")
        users = users.groupBy(of_bundle, "term").agg(F.collect_list(F.struct("query", "gain", "open", "need")).alias("users"))
        postings = index.where("term is not null").join(users, "term").select("bundle", "block", "docs", "counts", "lengths", "users")
        carried = carry(spark, state, known, blocks if last else None, bundles)
        stage = add_contributions(carried, postings, n_docs, n_terms, top, last)
        state = written(stage, f"owner{owner}", folder)
        if not last:
            scores = state.select("query", F.explode("best").alias("score"))
            by_score = Window.partitionBy("query").orderBy(F.desc("score"))
            best = scores.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= top)
            floor = best.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == top).drop("n")

    found = state.select("query", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query", F.col("x.ids").alias("doc"), F.col("x.scores").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = ranked.join(asked.select("query", "id").distinct(), "query")
    doc = fresh(id, [item_id, "rank", "score"])
    result = written(named.select(F.col("id").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(doc), "score"), "ranked")
    discard(spark, folder)
    return result


CARRIED = "bundle int, block long, query long, docs array<int>, scores array<long>, open boolean, need long, ids array<long>"
STATE = "bundle int, block long, query long, docs array<int>, scores array<long>, best array<long>, ids array<long>"


def carry(spark: SparkSession, state: DataFrame | None, known: DataFrame, blocks: DataFrame | None, bundles: int) -> DataFrame:
    """Accumulators with what their items need, and for the last owner the document ids of each block, for each bundle."""
    carried = spark.createDataFrame([], CARRIED)
    if state is not None:
        carried = carried.unionByName(state.select("bundle", "block", "query", "docs", "scores", "ids").join(known, "query"))
    if blocks is not None:
        each = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
        carried = carried.unionByName(blocks.select(each, "block", "ids"), allowMissingColumns=True)
    return carried


def add_contributions(carried: DataFrame, postings: DataFrame, n_docs: int, n_terms: int, top: int, last: bool) -> DataFrame:
    """Accumulators after one owner: ``docs``, ``scores`` and their ``best`` ones, or with ``last`` the best ``ids``."""
    kinds = {"query": pa.int64(), "docs": pa.list_(pa.int32()), "scores": pa.list_(pa.int64()), "best": pa.list_(pa.int64()), "ids": pa.list_(pa.int64())}

    def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        sums, need = accumulated(left, right, n_docs, n_terms)
        ids = missing = None
        if last:
            # The one row without a query holds the ids of the block.
            listed = left.filter(pc.is_null(left.column("query"))).column("ids")[0].values
            missing = pc.is_null(listed).to_numpy(zero_copy_only=False)
            ids = pc.fill_null(listed, 0).to_numpy()
        out = {c: [] for c in kinds}
        for query, (docs, scores) in sums.items():
            keep = (scores > 0) & (scores >= need[query])
            docs, scores = docs[keep].astype(np.int32), scores[keep]
            if not len(docs):
                continue
            best = named = None
            if last:
                places = np.lexsort((ids[docs], missing[docs], -scores))[:top]
                docs, scores = docs[places], scores[places]
                named = pa.array(ids[docs], mask=missing[docs])
            else:
                best = np.sort(scores)[::-1][:top]
            for name, value in zip(kinds, (query, docs, scores, best, named), strict=True):
                out[name].append(value)
        n = len(out["query"])
        where = {"bundle": pa.array([key[0].as_py()] * n, pa.int32()), "block": pa.array([key[1].as_py()] * n, pa.int64())}
        return pa.table({**where, **{c: pa.array(out[c], kind) for c, kind in kinds.items()}})

    keys = ["bundle", "block"]
    return carried.groupBy(keys).cogroup(postings.groupBy(keys)).applyInArrow(work, STATE)


def accumulated(left: pa.Table, right: pa.Table, n_docs: int, n_terms: int) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], dict[int, int]]:
    """Per query its documents of the block and their scores so far, and the score they need to stay."""
    need: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    alive: dict[int, np.ndarray] = {}
    size = 1 + max(pc.max(pc.list_flatten(t.column("docs"))).as_py() or 0 for t in (left, right))
    columns = (left.column(c) for c in ("query", "docs", "scores", "open", "need"))
    for query, docs, scores, takes_new, least in zip(*columns, strict=True):
        query = query.as_py()
        if query is None:
            continue
        need[query] = least.as_py()
        places = docs.values.to_numpy()
        sums[query] = np.zeros(size, np.int64)
        sums[query][places] = scores.values.to_numpy()
        if not takes_new.as_py():
            alive[query] = places
    for docs, counts, lengths, users in zip(*(right.column(c) for c in ("docs", "counts", "lengths", "users")), strict=True):
        places = docs.values.to_numpy()
        of_one = impact(counts.values.to_numpy(), lengths.values.to_numpy(), n_docs, n_terms)
        for user in users.as_py():
            query = user["query"]
            if query not in sums:
                # Only its accumulators count for an item that takes no new documents, and it has none here.
                if not user["open"]:
                    continue
                need[query] = user["need"]
                sums[query] = np.zeros(size, np.int64)
            sums[query][places] += user["gain"] * of_one
    found = {}
    for query, scores in sums.items():
        docs = alive[query] if query in alive else np.flatnonzero(scores)
        found[query] = (docs, scores[docs])
    return found, need
