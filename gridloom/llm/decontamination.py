"""Benchmark decontamination: BM25 with block-max WAND, then a check of question and answer.

Items are indexed by pairs of neighbouring words. Every passage of every document is a
query against the index. An impact is the BM25 weight of a term in an item, divided by
what the item scores against itself, so one threshold serves items of any length.

Passages are windows of two strides, a stride being as long as the longest item (at
least ``LEAST_STRIDE`` words), so that every copy of an item lies whole in a window. A
window whose words' largest impacts do not add up to the threshold cannot hold an item;
the rest goes through the index, where blocks of postings are left out by their maxima.

Words are lower-cased runs of ASCII letters, digits and characters beyond ASCII. The
last sentence or line of an item is its answer where both parts have three words.

Defined cases: null and blank texts match nothing; items with fewer than two words match
nothing; repeated items each match; repeated documents each get their leaks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.batches import ALPHANUMERIC, HASHED_BYTES, arrow_map, fresh, joined_hashes, prefix_sums, sliced, span_hashes, text_bytes, word_spans

K1, B = 1.2, 0.75
THRESHOLD = 0.5
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.6, 0.6
LEAST_STRIDE = 32
BLOCK = 64
# Bytes of item text in one index, which takes some ten times as much; more items make further indexes and passes.
SHARD_BYTES = 16 << 20

LEAK = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("question_overlap", T.DoubleType()),
        T.StructField("answer_overlap", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
    ]
)


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and the first word of each row (n + 1 entries)."""
    data, offsets = text_bytes(column)
    starts, ends, firsts = word_spans(data, offsets, ALPHANUMERIC)
    return span_hashes(prefix_sums(data, lower=True), starts, ends), firsts


class Postings:
    """Items and impacts of every term, one after another in two arrays, and the largest impact of each block of a term."""

    def __init__(self, terms: np.ndarray, items: np.ndarray, impacts: np.ndarray):
        """``terms`` are sorted, the items of one term too."""
        self.items, self.impacts = items.astype(np.int32), impacts
        self.terms, first = np.unique(terms, return_index=True)
        self.bounds = np.append(first, len(terms))
        counts = np.diff(self.bounds)
        self.first_block = np.append(0, np.cumsum(-(-counts // BLOCK)))
        inside = np.arange(self.first_block[-1]) - np.repeat(self.first_block[:-1], np.diff(self.first_block))
        at = np.repeat(first, np.diff(self.first_block)) + BLOCK * inside
        self.block_most = np.maximum.reduceat(impacts, at) if len(at) else impacts
        self.most = np.maximum.reduceat(impacts, first) if len(first) else impacts

    def __getitem__(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.bounds[term], self.bounds[term + 1]
        return self.items[a:b], self.impacts[a:b]

    def block(self, term: int, at: int) -> float:
        """The largest impact of the block that holds place ``at`` of a term."""
        return self.block_most[self.first_block[term] + at // BLOCK]


class ItemIndex:
    """Inverted index of one shard of items; ``frequency`` has sorted terms and in how many items of all shards they are."""

    def __init__(self, ids: list[int | None], texts: list[str], frequency: tuple[np.ndarray, np.ndarray] | tuple[()], total: int, mean_length: float):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        parts = [words_of(part.column("text")) for part in sliced(batch, "text", HASHED_BYTES)]
        hashes = np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in parts)])
        firsts = np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *(np.diff(f) for _, f in parts)])))
        pairs = joined_hashes(hashes, 2)
        self.ids = ids
        self.words, self.pairs, self.answer_words = [], [], []
        for k, text in enumerate(texts):
            own = hashes[firsts[k] : firsts[k + 1]]
            cut = answer_start(text, len(own))
            self.words.append(own)
            self.pairs.append(np.unique(pairs[firsts[k] : max(firsts[k], firsts[k + 1] - 1)][: max(0, cut - 1)]))
            self.answer_words.append(np.unique(own[cut:]))
        sizes = np.diff(firsts)
        self.stride = int(max(LEAST_STRIDE, sizes.max(initial=0)))
        # Pairs inside one item, each with how often it comes there.
        item_of = np.repeat(np.arange(len(texts)), sizes)
        inside = np.flatnonzero(item_of[1:] == item_of[:-1])
        order = inside[np.lexsort((pairs[inside], item_of[inside]))]
        terms, items = pairs[order], item_of[order]
        new = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (items[1:] != items[:-1]))) if len(terms) else np.zeros(0, np.int64)
        counts = np.diff(np.append(new, len(terms)))
        terms, items = terms[new], items[new]
        idf = np.log(1 + (total - self._known(terms, frequency) + 0.5) / (self._known(terms, frequency) + 0.5))
        length = np.maximum(sizes - 1, 0)[items]
        weights = idf * counts * (K1 + 1) / (counts + K1 * (1 - B + B * length / max(mean_length, 1)))
        impacts = weights / np.bincount(items, weights, len(texts))[items]
        by_term = np.lexsort((items, terms))
        self.postings = Postings(terms[by_term], items[by_term], impacts[by_term])
        self.terms, self.most = self.postings.terms, self.postings.most

    @staticmethod
    def _known(terms: np.ndarray, frequency: tuple[np.ndarray, np.ndarray] | tuple[()]) -> np.ndarray:
        """How many items hold each term; one, where that is not told."""
        if not frequency or not len(frequency[0]):
            return np.ones(len(terms))
        known, counts = frequency
        at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
        return np.where(known[at] == terms, counts[at], 1)

    def search(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Items with a score of at least ``threshold`` against a passage of these term numbers."""
        postings = {t: self.postings[t] for t in terms}
        cursors = [[int(postings[t][0][0]), t, 0] for t in terms]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(cursors):
                bound += self.most[t]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # What the blocks that would hold the pivot allow, and where the first of them ends.
            allowed, ends = 0.0, []
            for _, t, at in cursors[: pivot + 1]:
                items = postings[t][0]
                at = _reach(items, at, item)
                if at < len(items):
                    allowed += self.postings.block(t, at)
                    ends.append(int(items[min(len(items), (at // BLOCK + 1) * BLOCK) - 1]))
            if allowed >= threshold:
                if cursors[0][0] == item:
                    score = float(sum(postings[t][1][at] for i, t, at in cursors[: pivot + 1] if i == item))
                    if score >= threshold:
                        found.append((item, score))
                    target = item + 1
                else:
                    target = item
            else:
                target = min(ends, default=item) + 1
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, item + (cursors[0][0] == item))
            moved = []
            for k, (i, t, at) in enumerate(cursors):
                if k <= pivot and i < target:
                    items = postings[t][0]
                    at = _reach(items, at, target)
                    if at == len(items):
                        continue
                    i = int(items[at])
                moved.append([i, t, at])
            cursors = moved
        return found

    def leaks(self, words: np.ndarray, pairs: np.ndarray, numbers: np.ndarray, threshold: float = THRESHOLD) -> list[dict]:
        """Verified items of one document; ``numbers`` are term numbers of its word pairs, -1 for none."""
        if not len(numbers):
            return []
        known = np.concatenate([[0.0], np.cumsum(np.where(numbers >= 0, self.most[numbers], 0.0))])
        starts = np.arange(0, max(1, len(words) - self.stride), self.stride)
        ends = np.minimum(starts + 2 * self.stride, len(words))
        # Rounding of the sums may not hide a window.
        hopeful = known[np.minimum(ends - 1, len(pairs))] - known[starts] >= threshold - 1e-6
        best: dict[int, dict] = {}
        for a, b in zip(starts[hopeful].tolist(), ends[hopeful].tolist(), strict=True):
            terms = np.unique(numbers[a : b - 1])
            for item, score in self.search(terms[terms >= 0].tolist(), threshold):
                question = _share(self.pairs[item], pairs[a : b - 1])
                answer = _share(self.answer_words[item], words[a:b])
                if question >= QUESTION_OVERLAP and answer >= ANSWER_OVERLAP and score > best.get(item, {"score": -1.0})["score"]:
                    best[item] = {
                        "item_id": self.ids[item],
                        "score": score,
                        "question_overlap": question,
                        "answer_overlap": answer,
                        "first_word": a,
                        "last_word": b - 1,
                    }
        return [best[k] for k in sorted(best)]

    def document_leaks(self, column: pa.Array) -> list[list[dict]]:
        words, firsts = words_of(column)
        pairs = joined_hashes(words, 2)
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, pairs), len(self.terms) - 1)
            numbers = np.where(self.terms[at] == pairs, at, -1)
        else:
            numbers = np.full(len(pairs), -1)
        if not (numbers >= 0).any():
            return [[] for _ in range(len(column))]
        found = []
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            last = max(a, b - 1)
            found.append(self.leaks(words[a:b], pairs[a:last], numbers[a:last]))
        return found


def _reach(items: np.ndarray, at: int, target: int) -> int:
    """First place from ``at`` on with an item of at least ``target``."""
    return at + int(np.searchsorted(items[at:], target))


def _share(wanted: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(wanted, there).mean()) if len(wanted) else 1.0


def answer_start(text: str, words: int) -> int:
    """The first word of the answer: that of the last sentence or line, where both parts have three words."""
    cuts = [m.end() for m in re.finditer(r"[.!?]\s+|\n+", text.rstrip())]
    for cut in reversed(cuts):
        before = text[:cut]
        column = pa.array([before], pa.string())
        data, offsets = text_bytes(column)
        count = len(word_spans(data, offsets, ALPHANUMERIC)[0])
        if words - count >= 3:
            return count if count >= 3 else words
    return words


def with_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", into: str = "leaks", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with an array of verified leaks per row; a column of that name is replaced."""
    spark = docs.sparkSession
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count("*").alias("items")).first()
    shards = max(1, -(-size["bytes"] // shard_bytes))

    def pairs(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, "text", HASHED_BYTES):
            words, firsts = words_of(part.column("text"))
            joined = joined_hashes(words, 2)
            for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
                own = np.unique(joined[a : max(a, b - 1)])
                yield {"term": own.view(np.int64), "length": np.full(len(own), max(0, b - a - 1)), "one": np.eye(1, len(own), dtype=np.int64)[0]}

    terms = arrow_map(items.select("text"), pairs, "term long, length long, one long")
    mean = terms.agg(F.sum(F.col("length") * F.col("one")) / F.greatest(F.sum("one"), F.lit(1))).first()[0] or 0.0
    frequency = terms.groupBy("term").count()
    numbered = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    for shard in range(shards):
        own = numbered.where(F.col("shard") == shard).select("item_id", "text").orderBy("item_id", "text")
        # One shard of items and its terms come to the driver: bounded by SHARD_BYTES.
        rows = own.toArrow()
        used = frequency.join(arrow_map(own.select("text"), pairs, "term long, length long, one long").select("term").distinct(), "term").toArrow()
        known, counts = used.column("term").to_numpy().astype(np.int64).view(np.uint64), used.column("count").to_numpy()
        order = np.argsort(known)
        index = ItemIndex(rows.column("item_id").to_pylist(), rows.column("text").to_pylist(), (known[order], counts[order]), size["items"], float(mean))
        docs = _marked(docs, spark.sparkContext.broadcast(index), text, into, keep=shard > 0)
    return docs


def _marked(docs: DataFrame, index, text: str, into: str, keep: bool) -> DataFrame:
    others = [c for c in docs.columns if c != into]
    before = fresh("_before", others)
    source = docs.select(*[F.col(f"`{c}`") for c in others], *([F.col(into).alias(before)] if keep else []))
    leak = pa.list_(pa.struct([(f.name, pa.int64() if f.dataType == T.LongType() else pa.float64()) for f in LEAK]))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, text, HASHED_BYTES):
            found = index.value.document_leaks(part.column(text))
            if keep:
                found = [[*old, *new] for old, new in zip(part.column(before).to_pylist(), found, strict=True)]
            yield {**{c: part.column(c) for c in others}, into: pa.array(found, leak)}

    return arrow_map(source, work, source.select(*[F.col(f"`{c}`") for c in others]).schema.add(into, T.ArrayType(LEAK)))


def leaks(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document row and item found in it."""
    marked = with_leaks(docs.select(F.col(id).alias(id), F.col(text).alias("text")), items, **options)
    return marked.select(id, F.explode("leaks").alias("leak")).select(id, "leak.*")
