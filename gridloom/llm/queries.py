"""One query per operator over its whole table, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import byte_pairs, chunk_dedup, cross_entropy, decontamination, filter_audit, html_extraction, lexical_rank, neighbours, repeated_substrings, secrets, sentencepieces, toxicity
from gridloom.llm.ngram_join import jaccard_components

PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"
TOXIC = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_substrings.without_repeats(table(spark, sf_dir, "documents")).drop("text")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = html_extraction.main_text(pages, html_extraction.fit_labeller(pages))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels").where(~out))
    scored = toxicity.score_toxicity(docs, model).select("doc_id", out.alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a target of the documents that are labelled as good."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit(True).alias("good")).distinct()
    # Labels grow with the documents: merged at every size rather than sent to all tasks while they are few.
    marked = docs.join(good.hint("merge"), "doc_id", "left")
    return cross_entropy.score_difference(marked, F.col("good")).drop("good")


def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.deduplicated(table(spark, sf_dir, "documents")).drop("text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.findings(docs, secrets.fit_secrets(docs))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_digests(sentencepieces.encode(docs, public_tokenizers.path(PIECES), end_id=True, decoded=True))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_pairs.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def piece_digests(encoded: DataFrame) -> DataFrame:
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        # Where the last piece ends in the original text.
        F.try_element_at("ends", F.lit(-1)).cast("long").alias("n_bytes"),
        F.xxhash64("begins", "ends").alias("spans_hash"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_substrings": op1_repeated_substrings,
    "op2_html_extraction": op2_html_extraction,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_cross_entropy": op5_cross_entropy,
    "op6_chunk_dedup": op6_chunk_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_secrets": op8_secrets,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_neighbours": op10_neighbours,
    "op11_filter_audit": op11_filter_audit,
    "op12_lexical_rank": op12_lexical_rank,
    "op13_byte_pairs": op13_byte_pairs,
}

_AUDIT = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), least AS (
  SELECT text, min(doc_id) AS doc_id FROM d GROUP BY text
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), judged AS (
  SELECT d.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 10 * length(d.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN d.doc_id > l.doc_id THEN 'E' ELSE '' END AS fails
  FROM d JOIN least l ON l.text = d.text LEFT JOIN marks m ON m.doc_id = d.doc_id
), sets AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before,
         substr(filter_order, 1, step) AS through
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
), counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT regexp_matches(fails, '[' || through || ']') THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN contains(fails, f) AND (step = 1 OR NOT regexp_matches(fails, '[' || before || 'z]')) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, f) AND step > 1 AND regexp_matches(fails, '[' || before || 'z]') THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN contains(fails, f) AND (step = 1 OR NOT regexp_matches(fails, '[' || before || 'z]')) THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN contains(fails, f) AND (step = 1 OR NOT regexp_matches(fails, '[' || before || 'z]')) THEN toxic ELSE 0 END) AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""

_RANK = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), total AS (
  SELECT count(*)::BIGINT AS N, sum(len(terms))::BIGINT AS L FROM d WHERE len(terms) > 0
), tf AS (
  SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d
), post AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM tf GROUP BY r, doc_id, n, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM post GROUP BY term), total
), asked AS (
  SELECT item_id, text,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), scored AS (
  SELECT a.item_id, a.text, p.r, p.doc_id,
         sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * t.N) // t.L))))::BIGINT AS score
  FROM asked a JOIN post p ON p.term = a.term JOIN weight w ON w.term = a.term, total t
  GROUP BY a.item_id, a.text, p.r, p.doc_id
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0
) WHERE rank <= 20
"""

SQL: dict[str, str] = {"op11_filter_audit": _AUDIT, "op12_lexical_rank": _RANK}
