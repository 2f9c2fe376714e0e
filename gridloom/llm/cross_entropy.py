"""Cross-entropy difference: how much more a target model expects a text than a background one.

Both are bigram models over all words (64-bit hashes of the lower-cased ones); nothing is
left out of the vocabulary, which both share. A probability mixes the pair's share, the
word's share and an even one over the distinct words, of which ``VOCABULARY`` are assumed
at least. A document's losses are means over its tokens in bits; ``score`` is target minus
background, lower for documents more like the target.

Counts of words and pairs are taken over all documents and grow with them. Documents lie in
blocks; a block sends the distinct pairs and words it holds, with their counts, to the
buckets of their hashes, and is sent back the counts of the whole corpus
(:mod:`gridloom.llm.block_keys`). So a pair travels once a block and not once a document.

Defined cases: null and blank texts have no token and zero losses; an empty
target or background is the even model; null ids are scored too; repeated rows count
and are scored as often as they come.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm import block_keys
from gridloom.llm.batches import joined_hashes, prefix_sums, sliced, span_hashes, text_bytes, word_spans
from gridloom.llm.components import written
from gridloom.sources.staging import discard, new_folder

VOCABULARY = 2048
PAIR_SHARE, WORD_SHARE = 0.7, 0.29
# The token that begins a text.
BEGIN = np.uint64(0)
PAIRS, WORDS = 0, 1
ADDED = ("n_tokens", "target_loss", "background_loss", "score")


def tokens(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of all rows its hash and that of it and the one before it, and the first word of each row."""
    owns, both, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    # Sums of all bytes are held while words are hashed, so a part of the rows is taken at a time.
    for part in sliced(rows, "text"):
        data, offsets = text_bytes(part.column("text"))
        starts, ends, firsts = word_spans(data, offsets)
        own = span_hashes(prefix_sums(data, lower=True), starts, ends)
        before = np.concatenate([[BEGIN], own[:-1]]) if len(own) else own
        before[firsts[:-1][firsts[:-1] < len(own)]] = BEGIN
        owns.append(own)
        both.append(joined_hashes(np.column_stack([before, own]).ravel(), 2)[::2])
        counts.append(np.diff(firsts))
    return np.concatenate(owns), np.concatenate(both), np.append(0, np.cumsum(np.concatenate(counts)))


def sources(docs: DataFrame, target: DataFrame | Column, background: DataFrame | None, text: str) -> DataFrame:
    """All texts, with whether each counts for target ``t``, background ``b`` and is scored ``d``; scored rows keep their columns in ``row``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text, *ADDED)]
    row = F.struct(*others, F.lit(0).alias("_"))
    own = F.coalesce(target, F.lit(False)) if isinstance(target, Column) else F.lit(False)
    parts = [docs.select(F.col(text).alias("text"), own.alias("t"), F.lit(background is None).alias("b"), F.lit(True).alias("d"), row.alias("row"))]
    for df, t in [(target, True), (background, False)]:
        if isinstance(df, DataFrame):
            parts.append(df.select(F.col(text).alias("text"), F.lit(t).alias("t"), F.lit(not t).alias("b"), F.lit(False).alias("d")))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def marks(rows: pa.RecordBatch) -> np.ndarray:
    """The columns t and b of the rows as numbers."""
    return np.stack([rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in "tb"])


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, the order that sorts all, and where each distinct one begins in it."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(values) else np.zeros(0, np.int64)
    return ranked[starts], order, starts


def asked(rows: pa.RecordBatch) -> list[block_keys.Keys]:
    """Distinct pairs with their counts, and words with how often they come and come before another, for target and background."""
    own, pairs, firsts = tokens(rows)
    if not len(own):
        return []
    of_row = marks(rows)
    lengths = np.diff(firsts)
    of_token = np.repeat(of_row, lengths, axis=1)
    found, order, starts = grouped(pairs)
    words, by_word, at = grouped(own)
    counts = np.add.reduceat(of_token[:, by_word], at, axis=1)
    # A word comes before another one except where it ends a text.
    before = counts.copy()
    full = lengths > 0
    lasts = np.searchsorted(words, own[firsts[1:][full] - 1])
    np.subtract.at(before, (slice(None), lasts), of_row[:, full])
    begin = np.concatenate([np.zeros(2, np.int64), of_row[:, full].sum(axis=1)])[:, None]
    figures = np.concatenate([begin, np.concatenate([counts, before])], axis=1)
    return [
        (found[None], np.add.reduceat(of_token[:, order], starts, axis=1)),
        (np.append(BEGIN, words)[None], figures),
    ]


def merged(kind: int, figures: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The sums themselves; of words their number and all tokens of target and background."""
    return figures, [figures.shape[1], int(figures[0].sum()), int(figures[1].sum())] if kind == WORDS else []


def model_loss(of_pair: np.ndarray, of_own: np.ndarray, of_before: np.ndarray, tokens: int, words: int) -> np.ndarray:
    """Bits of a word after another one."""
    even = (1 - PAIR_SHARE - WORD_SHARE) / words
    # A model without tokens is the even one.
    rest = (WORD_SHARE * of_own / tokens + even) / (1 - PAIR_SHARE) if tokens else 1 / words
    # A word that was never followed leaves its share to the words.
    share = np.where(of_before > 0, PAIR_SHARE, 0.0)
    return -np.log2(share * of_pair / np.maximum(of_before, 1) + (1 - share) * rest)


def scored(rows: pa.RecordBatch, found: list[np.ndarray], totals: tuple[int, int], distinct: int) -> dict:
    """Losses of the rows of a block from the counts of its pairs and words."""
    own, pairs, firsts = tokens(rows)
    n = np.diff(firsts)
    sums = np.zeros((2, len(n)))
    if len(own):
        words, by_word, at = grouped(own)
        word = np.empty(len(own), np.int64)
        word[by_word] = np.repeat(np.arange(len(words)), np.diff(np.append(at, len(own)))) + 1
        before = np.append(0, word[:-1])
        before[firsts[:-1][n > 0]] = 0
        _, by_pair, at = grouped(pairs)
        sizes = np.diff(np.append(at, len(own)))
        pair = np.empty(len(own), np.int64)
        pair[by_pair] = np.repeat(np.arange(len(at)), sizes)
        of_pair, of_word = found
        for k in range(2):
            losses = model_loss(of_pair[k][pair], of_word[k][word], of_word[2 + k][before], totals[k], distinct)
            ends = np.append(0.0, np.cumsum(losses))
            sums[k] = ends[firsts[1:]] - ends[firsts[:-1]]
    means = sums / np.maximum(n, 1)
    keep = pa.array(rows.column("d"))
    made = {"row": rows.column("row"), "n_tokens": pa.array(n.astype(np.int64)), "target_loss": pa.array(means[0]), "background_loss": pa.array(means[1]), "score": pa.array(means[0] - means[1])}
    return {name: column.filter(keep) for name, column in made.items()}


def score_difference(docs: DataFrame, target: DataFrame | Column, background: DataFrame | None = None, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens``, ``target_loss``, ``background_loss`` and ``score``.

    ``target`` is a table of texts, or a condition on the rows of ``docs``; ``background`` is ``docs`` if not given.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "losses")
    blocks = block_keys.in_blocks(sources(docs, target, background, text), "texts", folder)
    sent = block_keys.requests(blocks, asked, block_keys.bucket_count(blocks))
    counts = written(block_keys.replies(sent, 1, [[np.add] * 2, [np.add] * 4], merged), "counts", folder)
    each = counts.where(F.col("kind") == WORDS).groupBy("bucket").agg(F.first("stats").alias("s"))
    row = each.agg(*(F.sum(F.col("s")[k]).alias(c) for k, c in enumerate(("distinct", "t", "b")))).first()
    totals, distinct = (row["t"] or 0, row["b"] or 0), max(VOCABULARY, row["distinct"] or 0)

    schema = T.StructType([blocks.schema["row"], T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ADDED[1:])])
    made = block_keys.answered(blocks, counts, lambda rows, found: scored(rows, found, totals, distinct), 2, schema)
    others = [F.col(f"row.`{c}`") for c in docs.columns if c not in (text, *ADDED)]
    result = written(made.select(*others, *ADDED), "losses")
    discard(spark, folder)
    return result
