"""Cleaning of ``documents`` for training: five stages, each written before the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given. The first
four return the columns of ``documents``, the last one digests of the encoded texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontamination, secrets, sentencepieces, toxicity
from gridloom.llm.batches import fresh
from gridloom.llm.ngram_join import jaccard_components
from gridloom.llm.queries import PIECES, TOXIC, piece_digests
from gridloom.sources.staging import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents whose score reaches the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out(F.col("doc_id")))
    score = fresh("_score", docs.columns)
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels), into=score)
    return scored.where(F.col(score) < TOXIC).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, that with the smallest id (null last).

    Where an id comes again, perhaps with another text, or is missing, rows are told apart by
    a number, which holds once it is written.
    """
    again = docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1 or doc_id is null")
    if again.isEmpty():
        first = jaccard_components(docs).where("doc_id = component_id").select("doc_id")
        return docs.join(first, "doc_id", "left_semi").select(docs.columns)
    row = fresh("_row", docs.columns)
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = jaccard_components(numbered.select(row, "text"), id=row).select(F.col(row), F.col("component_id").alias("_group"))
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", F.col(row).alias("row"))
    first = numbered.select("doc_id", row).join(groups, row).groupBy("_group").agg(F.min(order).alias("first"))
    return numbered.join(first.select(F.col("first.row").alias(row)), row, "left_semi").select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = fresh("_leaks", docs.columns)
    marked = decontamination.with_leaks(docs, items, into=found)
    return marked.where(F.size(found) == 0).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts; ``n_chars`` follows."""
    clean = secrets.redacted(docs, secrets.fit_secrets(docs))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text that is left."""
    texts = docs.select("doc_id", "text")
    return piece_digests(sentencepieces.encode(texts, public_tokenizers.path(PIECES), end_id=True, decoded=True))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("sentencepiece", encode_pieces),
]

# The stages learn models, so SQL cannot express them; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
