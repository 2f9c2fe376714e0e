"""Secret scans: candidates by pattern, false positives removed by a random forest.

The forest sees a candidate's length, character classes and transitions between them,
how usual its letter pairs are, how much of it dictionary words cover, whether it looks
like a path or address, and the words around it. It is trained on labelled findings, a
table that ``labelled_findings`` builds and that others can be added to.

The dictionary and letter pairs are counted over all documents. The labelled findings come
from a bounded sample of them (``FIT_ROWS`` rows, those with the smallest hash of their
text); scanning itself takes every text whole.

Defined cases: null and empty texts have no finding; a candidate found twice in a text
gives two findings; repeated rows each give theirs. Without findings of both kinds every
candidate that a strict rule names is kept, with score 1.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.batches import arrow_map, fresh, least_hashed, sliced
from gridloom.llm.components import written
from gridloom.sources.staging import discard, new_folder

FIT_ROWS = 1_000
DICTIONARY_SIZE = 5_000
# Distinct words a task counts before it hands them on.
WORDS_HELD = 200_000
ACCEPT = 0.5
MARK = "[SECRET]"

# Published forms of access keys.
STRICT = {
    "access_key_id": r"(?<![A-Za-z0-9])A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "hub_token": r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}",
    "payment_key": r"(?<![A-Za-z0-9])sk_live_[A-Za-z0-9]{16,}",
    "chat_token": r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}",
    "api_key": r"(?<![A-Za-z0-9])AIza[A-Za-z0-9_-]{35}",
    "web_token": r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "private_key": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]{40,}-----END [A-Z ]{0,20}PRIVATE KEY-----)?",
}
# Words that announce a secret, and words that announce a harmless number.
SECRET_WORDS = "password passwd pwd token secret apikey api_key access_key auth credential private_key passwort contraseña".split()
HARMLESS_WORDS = "commit sha sha1 sha256 md5 checksum hash digest uuid guid revision version isbn id build etag example".split()
_PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|placeholder|change.?me|your[_-]|xxxx|test|<|\*\*\*|0000|1234567")
_STRICT = re.compile("|".join(f"(?P<{name}>{form})" for name, form in STRICT.items()))
# A whole name that holds a secret word, a sign, a value. Runs are taken whole and never given back, so a text is passed over once.
_ASSIGNED = re.compile(
    r"(?i)(?<![\w-])(?=[\w-]*?(?:" + "|".join(re.escape(w) for w in SECRET_WORDS) + r"))[\w-]++[\"']?\s{0,3}(?:[:=]|=>)\s{0,3}[\"']?(?P<assigned>[^\s\"'<>,;]{6,}+)"
)
_LONG = re.compile(r"(?<![A-Za-z0-9+/=_.@-])(?P<long>[A-Za-z0-9+/=_-]{20,}+)(?!@)")
_DIGIT = re.compile("[0-9]")

FEATURES = (
    "length digits uppers lowers symbols transitions entropy surprise dictionary slashes path_before dotted assigned secret_word harmless_word "
    "placeholder quoted hex strict"
).split()


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Begin, end and kind of what may be a secret, without overlaps; strict forms come first."""
    found = [(*m.span(), m.lastgroup) for m in _STRICT.finditer(text)] if _may_be_strict(text) else []
    lower = text.lower()
    if any(w in lower for w in SECRET_WORDS):
        found += [(*m.span("assigned"), "assigned") for m in _ASSIGNED.finditer(text)]
    if any(d in text for d in "0123456789"):
        found += [(*m.span("long"), "long") for m in _LONG.finditer(text) if _DIGIT.search(m["long"])]
    # Kept spans do not overlap, so of those in order of their begin only two neighbours can meet a new one.
    kept: list[tuple[int, int, str]] = []
    for span in found:
        at = bisect_left(kept, span)
        if (not at or kept[at - 1][1] <= span[0]) and (at == len(kept) or span[1] <= kept[at][0]):
            kept.insert(at, span)
    return kept


def _may_be_strict(text: str) -> bool:
    return any(mark in text for mark in ("KIA", "SIA", "gh", "sk_live_", "xox", "AIza", "eyJ", "PRIVATE KEY"))


@dataclass
class Language:
    """What ordinary text looks like; both parts are of bounded size."""

    words: frozenset[str]
    pairs: np.ndarray


def language_of(docs: DataFrame, text: str = "text") -> Language:
    """Most frequent words and letter pairs of all documents; ties go to the smaller word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(words: list, pairs: list, times: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(pairs, pa.int32()), pa.array(times, pa.int64())], ["word", "pair", "times"])

        words, pairs = Counter(), np.zeros(128 * 128, np.int64)
        for batch in batches:
            for part in sliced(batch, "text"):
                for t in part.column("text").to_pylist():
                    words.update(re.findall(r"[a-z]{4,12}", t.lower()))
                    if len(words) > WORDS_HELD:
                        yield counted(list(words), [None] * len(words), list(words.values()))
                        words.clear()
                letters = [np.frombuffer(" ".join(re.findall(r"[A-Za-z]+", t)).lower().encode(), np.uint8) for t in part.column("text").to_pylist()]
                both = [codes[:-1].astype(np.int32) * 128 + codes[1:] for codes in letters]
                pairs += np.bincount(np.concatenate(both), minlength=128 * 128)
        met = np.flatnonzero(pairs)
        yield counted([*words, *[None] * len(met)], [*[None] * len(words), *met.tolist()], [*words.values(), *pairs[met].tolist()])

    texts = docs.select(F.col(text).alias("text")).where("length(text) > 0")
    counts = texts.mapInArrow(run, "word string, pair int, times long").groupBy("word", "pair").agg(F.sum("times").alias("times"))
    folder = new_folder(docs.sparkSession, "language")
    counts = written(counts, "language", folder)
    top = counts.where("word is not null").orderBy(F.desc("times"), "word").limit(DICTIONARY_SIZE).collect()
    met = counts.where("pair is not null").collect()  # at most 128 * 128 rows
    discard(docs.sparkSession, folder)
    pairs = np.ones(128 * 128)
    for row in met:
        pairs[row["pair"]] += row["times"]
    pairs = pairs.reshape(128, 128)
    return Language(frozenset(row["word"] for row in top), -np.log2(pairs / pairs.sum(axis=1, keepdims=True)))


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.isalpha() else 3


def features(text: str, a: int, b: int, kind: str, language: Language) -> list[float]:
    value = text[a:b]
    size = len(value)
    classes = [_class(c) for c in value]
    share = [classes.count(k) / size for k in range(4)]
    counts = Counter(value)
    codes = np.frombuffer(value.lower().encode("ascii", "replace"), np.uint8) & 127
    lower = value.lower()
    covered = 0
    at = 0
    while at < size:
        width = next((w for w in range(min(12, size - at), 3, -1) if lower[at : at + w] in language.words), 0)
        covered += width
        at += width or 1
    before, after = text[max(0, a - 40) : a].lower(), text[b : b + 2]
    around = set(re.findall(r"\w+", before)[-4:] + re.findall(r"\w+", text[b : b + 30].lower())[:2])
    return [
        min(size, 200),
        share[0],
        share[1],
        share[2],
        share[3],
        sum(x != y for x, y in zip(classes, classes[1:], strict=False)) / size,
        -sum(n / size * log2(n / size) for n in counts.values()),
        float(language.pairs[codes[:-1], codes[1:]].mean()) if size > 1 else 0.0,
        covered / size,
        (value.count("/") + value.count("\\")) / size,
        float(before.endswith(("/", ".", "@", ":\\", "www"))),
        float("." in value or "@" in value),
        float(bool(re.search(r"[:=]\s{0,3}[\"']?$", before))),
        float(any(w in before for w in SECRET_WORDS)),
        float(any(w in around for w in HARMLESS_WORDS)),
        float(bool(_PLACEHOLDER.search(value))),
        float(after[:1] in "\"'" and after != "" and before[-1:] in "\"'"),
        float(bool(re.fullmatch(r"[0-9a-fA-F-]+", value))),
        float(kind in STRICT),
    ]


# ---- labelled findings


def labelled_findings(texts: list[str], seed: int = 7) -> list[tuple[str, int, int, str, int]]:
    """Findings with labels: text, begin, end, kind, 1 for a secret.

    Findings of the given texts are labelled where the case is clear: strict forms that
    are no placeholder are secrets, candidates next to a harmless word or made of
    dictionary-like runs of letters are not. To these come findings put into the same
    texts: random keys under secret words, and commits, digests, ids, paths, placeholders
    and long words under harmless ones or none.
    """
    r = random.Random(seed)
    found = []
    for text in texts:
        for a, b, kind in candidates(text):
            value = text[a:b]
            if kind in STRICT or kind == "assigned" and len(set(value)) > 6 and any(c.isdigit() for c in value):
                found.append((text, a, b, kind, int(not _PLACEHOLDER.search(value))))
            elif kind == "long" and sum(c.isdigit() for c in value) <= 1:
                found.append((text, a, b, kind, 0))
        words = [w for w in text.split(" ") if w]
        for put, label in _made(r, words):
            at = r.randrange(len(text) + 1) if not words else len(" ".join(words[: r.randrange(len(words) + 1)]))
            near = text[max(0, at - 60) : at] + " " + put + " " + text[at : at + 40]
            start = len(text[max(0, at - 60) : at]) + 1
            for a, b, kind in candidates(near):
                if a < start + len(put) and b > start:
                    found.append((near, a, b, kind, label))
    return found


def _made(r: random.Random, words: list[str]) -> list[tuple[str, int]]:
    def of(alphabet: str, size: int) -> str:
        return "".join(r.choice(alphabet) for _ in range(size))

    hexes, upper, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    name = r.choice([*SECRET_WORDS, "db_password", "client_secret", "auth_token", "API_KEY"])
    sign, quote = r.choice(["=", ": ", " = ", ":"]), r.choice(['"', "'", "", ""])
    value = r.choice([of(mixed, r.randrange(16, 48)), of(hexes, r.choice([18, 32, 40, 64])), of(upper, 24), of(mixed + "+/", 40)])
    if r.random() < 0.3:
        name = name.upper()
        value = value.upper()
    long_word = "".join(re.findall(r"[A-Za-z]+", "".join(r.choices(words, k=5)))) if words else "plain"
    uuid = "-".join(of(hexes, k) for k in (8, 4, 4, 4, 12))
    harmless = r.choice(
        [
            f"{r.choice(['commit', 'sha1', 'revision', 'checksum', 'md5', 'digest'])}{r.choice([' ', ': ', '='])}{of(hexes, r.choice([20, 32, 40, 64]))}",
            f"{r.choice(['id', 'uuid', 'guid', 'build'])}{r.choice(['=', ': ', ' '])}{uuid}",
            f"{name}{sign}{quote}{r.choice(['your_' + name + '_here_1', 'EXAMPLE' + of(upper, 8), 'x' * 20 + '1', 'changeme123', '<' + name + '>', '0' * 24])}{quote}",
            f"{long_word}{r.randrange(10)}{long_word[:12]}",
            f"/usr/share/{long_word[:8]}/{of(hexes, 6)}/{long_word[:6]}{r.randrange(100)}",
            f"{name}{sign}{quote}{''.join(w for w in words[:3] if w.isalpha())[:20] or 'nothing'}{quote}",
            "AKIA" + "EXAMPLE" + of(upper, 9),
        ]
    )
    keyed = r.choice([f"{name}{sign}{quote}{value}{quote}", f"{name}{sign}{quote}{value}{quote}", "AKIA" + of(upper, 16), "ghp_" + of(mixed, 36)])
    return [(keyed, 1), (harmless, 0)]


# ---- the forest


def forest(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 8, least: int = 3, seed: int = 11) -> list[list[tuple[int, float, int, int, float]]]:
    """Trees of (feature, cut, left, right, share of secrets); a leaf has feature -1."""
    rng = np.random.default_rng(seed)
    tries = max(1, int(np.sqrt(x.shape[1]) + 1))
    grown = []
    for _ in range(trees):
        nodes: list[tuple[int, float, int, int, float]] = []
        todo = [(rng.integers(0, len(y), len(y)), 0, -1, 0)]
        while todo:
            rows, level, parent, side = todo.pop()
            own = y[rows]
            place = len(nodes)
            nodes.append((-1, 0.0, -1, -1, float(own.mean())))
            if parent >= 0:
                f, c, left, right, p = nodes[parent]
                nodes[parent] = (f, c, place, right, p) if side == 0 else (f, c, left, place, p)
            if level == depth or len(rows) < 2 * least or own.min() == own.max():
                continue
            best = (own.mean() * (1 - own.mean()) * len(rows) - 1e-9, -1, 0.0)
            for f in rng.choice(x.shape[1], tries, replace=False):
                order = np.argsort(x[rows, f], kind="stable")
                v, cum = x[rows, f][order], own[order].cumsum()
                n = np.arange(1, len(rows))
                ok = (v[:-1] < v[1:]) & (n >= least) & (len(rows) - n >= least)
                if not ok.any():
                    continue
                left, right = cum[:-1], cum[-1] - cum[:-1]
                impurity = left * (1 - left / n) + right * (1 - right / (len(rows) - n))
                at = int(np.where(ok, impurity, np.inf).argmin())
                if impurity[at] < best[0]:
                    best = (float(impurity[at]), int(f), float((v[at] + v[at + 1]) / 2))
            if best[1] >= 0:
                nodes[place] = (best[1], best[2], -1, -1, nodes[place][4])
                goes = x[rows, best[1]] <= best[2]
                todo += [(rows[goes], level + 1, place, 0), (rows[~goes], level + 1, place, 1)]
        grown.append(nodes)
    return grown


def votes(trees: list[list[tuple[int, float, int, int, float]]], row: list[float]) -> float:
    total = 0.0
    for nodes in trees:
        f, cut, left, right, share = nodes[0]
        while f >= 0:
            f, cut, left, right, share = nodes[left if row[f] <= cut else right]
        total += share
    return total / len(trees)


@dataclass
class SecretModel:
    language: Language
    trees: list[list[tuple[int, float, int, int, float]]]

    def score(self, text: str, a: int, b: int, kind: str) -> float:
        if not self.trees:
            return float(kind in STRICT)
        return votes(self.trees, features(text, a, b, kind, self.language))


def fit_secrets(docs: DataFrame, text: str = "text", rows: int = FIT_ROWS, more: list[tuple[str, int, int, str, int]] = ()) -> SecretModel:
    """Fits on findings in a bounded sample of ``docs`` and on ``more`` labelled ones, with the language of all ``docs``."""
    texts = docs.select(F.col(text).alias("text")).where("length(text) > 0")
    sample = [r["text"] for r in least_hashed(texts, rows).collect()]
    language = language_of(docs, text)
    findings = [*labelled_findings(sample), *more]
    x = np.array([features(t, a, b, k, language) for t, a, b, k, _ in findings]).reshape(-1, len(FEATURES))
    y = np.array([f[-1] for f in findings], np.float64)
    if len(set(y.tolist())) < 2:
        return SecretModel(language, [])
    return SecretModel(language, forest(x, y))


FINDING = T.StructType(
    [T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("score", T.DoubleType())]
)


def with_findings(docs: DataFrame, model: SecretModel, text: str = "text", into: str = "findings", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with an array of accepted findings (character offsets) per row; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != into]
    source = docs.select(*[F.col(f"`{c}`") for c in others])
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]))

    def found(t: str | None) -> list[dict]:
        rows = [(a, b, k, shared.value.score(t, a, b, k)) for a, b, k in candidates(t)] if t else []
        return [{"begin": a, "end": b, "kind": k, "score": s} for a, b, k, s in rows if s >= accept]

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, text):
            yield {**{c: part.column(c) for c in others}, into: pa.array([found(t) for t in part.column(text).to_pylist()], kind)}

    return arrow_map(source, work, T.StructType([*source.schema.fields, T.StructField(into, T.ArrayType(FINDING))]))


def redacted(docs: DataFrame, model: SecretModel, text: str = "text", **options) -> DataFrame:
    """``docs`` with every accepted finding in the text replaced by a mark."""
    columns = docs.columns
    found = fresh("_findings", columns)
    marked = with_findings(docs, model, text, into=found, **options)
    cuts = F.concat(F.array(F.lit(0)), F.col(f"{found}.end"))
    stops = F.concat(F.col(f"{found}.begin"), F.array(F.length(F.col(text))))
    parts = F.zip_with(cuts, stops, lambda a, b: F.substring(F.col(text), a + 1, b - a))
    clean = F.when(F.size(found) > 0, F.array_join(parts, MARK)).otherwise(F.col(text))
    return marked.withColumn(text, clean).select(*[F.col(f"`{c}`") for c in columns])


def findings(docs: DataFrame, model: SecretModel, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per accepted finding; the value itself is given as a digest."""
    marked = with_findings(docs.select(F.col(id).alias(id), F.col(text).alias("_text")), model, "_text", into="_findings", **options)
    marked = marked.select(id, "_text", F.explode("_findings").alias("f"))
    value = F.substring("_text", F.col("f.begin") + 1, F.col("f.end") - F.col("f.begin"))
    return marked.select(id, F.col("f.begin").alias("begin"), F.col("f.end").alias("end"), F.col("f.kind").alias("kind"), F.col("f.score").alias("score"), F.sha2(value, 256).alias("value_sha256"))
