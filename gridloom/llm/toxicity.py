"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned from labelled texts: words and word beginnings that are far more
common in toxic ones. Features are densities of lexicon words, their nearness to second
person words, and rates of capitals, punctuation and obfuscation. Trees are fitted to
other labelled rows than the lexicon, the calibration to others again.

Fitting takes at most ``FIT_ROWS`` labelled rows, those with the smallest hash of their
id; this is the documented bound of the sample. Scoring takes every row.

Defined cases: null text counts as empty; an empty text gets the score of its (zero)
features like any other. Labels that are null, or of ids without a text, are left out.
Without labels of both kinds every score is the share of toxic ones, 0 without labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.batches import arrow_map, sliced

# Bounds of the fit: labelled rows, and lexicon entries of each kind.
FIT_ROWS, LEXICON_SIZE = 16_000, 20_000
# A lexicon entry is in so many toxic texts, and so many times as common in them.
LEAST_TEXTS, LEAST_RATIO = 4, 6.0
BEGINNINGS = (4, 5, 6)
NEAR = 5

# Second person words of the languages covered.
SECOND_PERSON = frozenset(
    "you your yours yourself u ya thou thee du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tuyo".split()
)
# Characters that stand in for letters.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, ".": None, "-": None, "_": None})

_WORD = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"[^\W\d_]+(?:[0-9@$!*._-]{1,2}[^\W\d_]+)+")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")

FEATURES = (
    "hits hit_density distinct_hits weight_sum weight_max beginning_hits beginning_density beginning_weight near_second_person "
    "second_person capitals shouted punctuation exclamations questions digits symbols disguised disguised_hits stretched non_ascii"
).split()


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)


@dataclass
class ToxicityModel:
    """What scoring needs, of bounded size: lexicon, trees, calibration steps."""

    lexicon: Lexicon
    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    knots: tuple[np.ndarray, np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), self.base)
        return np.interp(margins(self.trees, x), *self.knots)


def features(text: str, lexicon: Lexicon) -> list[float]:
    words = _WORD.findall(text.lower())
    n = len(words) or 1
    known, begun = lexicon.words, lexicon.beginnings
    at = [k for k, w in enumerate(words) if w in known]
    weights = [known[words[k]] for k in at]
    begins = []
    if begun:
        short = BEGINNINGS[0]
        for w in words:
            if w[:short] in begun and len(w) > short:
                begins.append(max(begun.get(w[:size], 0.0) for size in BEGINNINGS))
    you = [k for k, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if at and you:
        gaps = np.searchsorted(you, at)
        spots = np.array([-(10**9), *you, 10**9])
        near = int((np.minimum(np.array(at) - spots[gaps], spots[gaps + 1] - np.array(at)) <= NEAR).sum())
    codes = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256) if text else np.zeros(256, np.int64)
    size = max(1, int(codes.sum()))
    letters = max(1, int(codes[65:91].sum() + codes[97:123].sum()))
    punctuation = int(codes[33:48].sum() + codes[58:65].sum() + codes[91:97].sum() + codes[123:127].sum())
    disguised = _DISGUISED.findall(text) if codes[48:58].any() or codes[[33, 36, 42, 64]].any() else []
    unmasked = sum(m.lower().translate(STAND_INS) in known for m in disguised)
    shouted = sum(w.isupper() for w in text.split()) if codes[65:91].sum() > letters * 0.08 else 0
    return [
        min(len(at), 50),
        len(at) / n,
        len({words[k] for k in at}),
        min(sum(weights), 200.0),
        max(weights, default=0.0),
        min(len(begins), 50),
        len(begins) / n,
        max(begins, default=0.0),
        near / max(1, len(at)),
        len(you) / n,
        int(codes[65:91].sum()) / letters,
        shouted / n,
        punctuation / size,
        int(codes[33]) / size,
        int(codes[63]) / size,
        int(codes[48:58].sum()) / size,
        int(codes[[35, 36, 37, 38, 42, 64]].sum()) / size,
        len(disguised) / n,
        unmasked,
        (len(_STRETCHED.findall(text)) if text else 0) / n,
        int(codes[128:].sum()) / size,
    ]


def _feature_rows(docs: DataFrame, lexicon: Lexicon, kept: list[str]) -> DataFrame:
    """``kept`` columns and the array ``x``; the text is read whole."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, "text"):
            x = [features(t or "", shared.value) for t in part.column("text").to_pylist()]
            yield {**{c: part.column(c) for c in kept}, "x": pa.array(x, pa.list_(pa.float64()))}

    schema = docs.select(*kept).schema.add("x", T.ArrayType(T.DoubleType()))
    return arrow_map(docs, work, schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = FIT_ROWS) -> ToxicityModel:
    """Fits on labelled rows; the caller leaves out of ``labels`` those that are held out."""
    labels = labels.select(F.col(id).alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    sample = labels.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most FIT_ROWS rows of two numbers.
    sample = F.broadcast(docs.sparkSession.createDataFrame(sample.toArrow(), "doc_id long, y int"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(8))
    texts = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).join(sample, "doc_id").withColumn("part", part)
    lexicon = _learned_lexicon(texts.where("part < 4"))
    fitted = _feature_rows(texts.where("part >= 4"), lexicon, ["doc_id", "y", "part"]).orderBy("doc_id", "x").toArrow()
    x = np.array(fitted.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    y, fold = fitted.column("y").to_numpy().astype(np.float64), fitted.column("part").to_numpy()
    if len(set(y.tolist())) < 2 or len(set(y[fold < 7].tolist())) < 2:
        return ToxicityModel(lexicon, float(y.mean()) if len(y) else 0.0, [], (np.zeros(1), np.zeros(1)))
    trees = boosted(x[fold < 7], y[fold < 7])
    # Small samples have too few rows to calibrate on them alone.
    held = fold == 7 if min((y[fold == 7] == k).sum() for k in (0, 1)) >= 20 else fold >= 4
    return ToxicityModel(lexicon, float(y.mean()), trees, isotonic(margins(trees, x[held]), y[held]))


def _learned_lexicon(texts: DataFrame) -> Lexicon:
    """Words and beginnings that tell toxic texts; counted on the executors, the best few come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, str], list[int]] = {}
        for batch in batches:
            for t, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                words = set(_WORD.findall((t or "").lower()))
                entries = {(0, w) for w in words} | {(1, w[:size]) for w in words for size in BEGINNINGS if len(w) > size}
                for entry in [*entries, (2, "")]:
                    counts.setdefault(entry, [0, 0])[y] += 1
        yield pa.RecordBatch.from_pydict(
            {
                "kind": pa.array([k for k, _ in counts], pa.int32()),
                "entry": pa.array([e for _, e in counts], pa.string()),
                "clean": pa.array([c for c, _ in counts.values()], pa.int64()),
                "toxic": pa.array([t for _, t in counts.values()], pa.int64()),
            }
        )

    counted = texts.select("text", "y").mapInArrow(run, "kind int, entry string, clean long, toxic long")
    counted = counted.groupBy("kind", "entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = counted.where("kind = 2").first()
    if total is None or not total["clean"] or not total["toxic"]:
        return Lexicon()
    ratio = ((F.col("toxic") + 0.5) / total["toxic"]) / ((F.col("clean") + 0.5) / total["clean"])
    told = counted.where(F.col("toxic") >= LEAST_TEXTS).withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
    lexicon = Lexicon()
    for kind, entries in ((0, lexicon.words), (1, lexicon.beginnings)):
        best = told.where(F.col("kind") == kind).orderBy(F.desc("ratio"), "entry").limit(LEXICON_SIZE)
        entries.update((r["entry"], float(np.log(r["ratio"]))) for r in best.collect())
    # A longer beginning is looked for only where its shortest one is known.
    for entry in list(lexicon.beginnings):
        lexicon.beginnings.setdefault(entry[: BEGINNINGS[0]], 0.0)
    return lexicon


def boosted(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, smooth: float = 2.0) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gradient boosting for log loss: complete trees as (feature, cut, leaf value) arrays."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    trees = [(np.zeros(0, np.int64), np.zeros(0), np.array([margin[0]]))]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(width)
            chosen = np.full(width, -1)
            for f, edges in enumerate(cuts):
                if not len(edges):
                    continue
                slot = local * (len(edges) + 1) + binned[:, f]
                size = width * (len(edges) + 1)
                g = np.bincount(slot, grad, size).reshape(width, -1).cumsum(axis=1)
                h = np.bincount(slot, hess, size).reshape(width, -1).cumsum(axis=1)
                left_g, left_h, all_g, all_h = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = left_g**2 / (left_h + smooth) + (all_g - left_g) ** 2 / (all_h - left_h + smooth) - all_g**2 / (all_h + smooth)
                at = gain.argmax(axis=1)
                value = gain[np.arange(width), at]
                better = value > best + 1e-9
                best[better], chosen[better] = value[better], f
                feature[first : first + width][better] = f
                cut[first : first + width][better] = edges[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - (2**depth - 1)
        g, h = np.bincount(leaf, grad, 2**depth), np.bincount(leaf, hess, 2**depth)
        values = -rate * g / (h + smooth)
        trees.append((feature, cut, values))
        margin = margin + values[leaf]
    return trees


def margins(trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), trees[0][2][0])
    rows = np.arange(len(x))
    for feature, cut, values in trees[1:]:
        node = np.zeros(len(x), np.int64)
        while len(x) and node[0] < len(feature):
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        total += values[node - len(feature)]
    return total


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best increasing fit of ``y``, by pooling neighbours that are out of order."""
    order = np.lexsort([y, score])
    blocks: list[list[float]] = []
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        if blocks and blocks[-1][3] == s:
            blocks[-1][0] += v
            blocks[-1][1] += 1
        else:
            blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            v, w, _, high = blocks.pop()
            blocks[-1][0] += v
            blocks[-1][1] += w
            blocks[-1][3] = high
    at = [s for _, _, low, high in blocks for s in (low, high)]
    # One more row of either kind keeps 0 and 1 for nobody.
    return np.array(at), np.array([(v + 0.5 * y.mean()) / (w + 0.5) for v, w, _, _ in blocks for _ in (0, 1)])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a score per row; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != into])
    others = source.columns

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, text):
            known = shared.value
            x = np.array([features(t or "", known.lexicon) for t in part.column(text).to_pylist()])
            yield {**{c: part.column(c) for c in others}, into: known.predict(x)}

    return arrow_map(source, work, T.StructType([*source.schema.fields, T.StructField(into, T.DoubleType())]))


def held_out(id: Column) -> Column:
    """Rows whose labels are never learned."""
    return F.pmod(F.crc32(id.cast("string")), F.lit(4)) == 2
