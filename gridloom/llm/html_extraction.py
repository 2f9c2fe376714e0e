"""Main text of web pages: every block labelled by a bidirectional LSTM.

A page becomes a sequence of blocks, the runs of text between block-level tags. Each is
described by its tag path (names, classes and ids of its ancestors, hashed), its words
(hashed) and a few figures. The network reads the whole sequence both ways, so a block's
label can rest on all others; blocks labelled as content are joined.

It is trained here, on at most ``FIT_PAGES`` pages, those with the smallest hash of
their url, which is the documented bound: as they are, labelled by sectioning elements
that say what they hold, and with their blocks put into made-up page layouts whose
labels are known. Extraction takes every page whole.

Defined cases: null and empty html gives an empty text; broken markup is read as far as
it goes, open elements end with the page; repeated rows each give a row.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.batches import arrow_map, fresh, least_hashed, sliced

FIT_PAGES = 250
PATH_SIZE, WORD_SIZE, FIGURES = 48, 24, 6
HIDDEN = 16

# Elements of HTML by their part in the layout.
SKIPPED = "script style noscript template title svg math iframe object textarea select option datalist audio video canvas".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CONTENT, REST = frozenset(("article", "main")), frozenset(("nav", "header", "footer", "aside", "form", "button", "dialog", "menu"))
# Words in classes and ids that name parts of a page which are not the article.
REST_WORDS = (
    "ad ads advert banner sponsor promo sidebar side menu nav navbar breadcrumb header footer cookie consent notice alert popup modal comment "
    "comments reply respond share social related newsletter subscribe form login search widget tags pagination"
).split()
CONTENT_WORDS = "article content post entry story main body text page".split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<skip>" + "|".join(SKIPPED) + r")\b[^>]*>.*?(?:</(?P=skip)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: float):
        self.path, self.text, self.linked = path, text, linked


def blocks(page: str) -> list[Block]:
    """The runs of text between block-level tags, decoded, with one space for white space."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                path = tuple(n for _, names in stack for n in names)
                found.append(Block(path, text, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            parts.append(raw)
            if any(name == "a" for name, _ in stack):
                linked += len(raw)

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            flush()
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                # An inline end tag does not reach beyond its block.
                if name in INLINE and stack[k][0] not in INLINE:
                    break
        elif name not in VOID:
            if name in CLOSES_P:
                # A new block ends an open paragraph and what is in it.
                opened = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] not in INLINE), -1)
                if opened >= 0 and stack[opened][0] == "p":
                    del stack[opened:]
            elif name == "li" and any(n == "li" for n, _ in stack):
                k = max(k for k, (n, _) in enumerate(stack) if n == "li")
                if not any(n in ("ul", "ol", "menu") for n, _ in stack[k:]):
                    del stack[k:]
            rest = m["rest"]
            names = [name]
            if rest and "=" in rest:
                names += [f".{w}" for found_names in _NAMES.findall(rest) for w in re.split(r"[^a-z0-9]+", "".join(found_names).lower()) if w]
            if not rest.endswith("/") or name not in VOID:
                stack.append((name, tuple(names)))
    add(page[at:])
    flush()
    return found


def _slot(word: str, size: int) -> tuple[int, float]:
    h = crc32(word.encode())
    return h % size, 1.0 if h & 0x10000 else -1.0


# Slot of a word, counted from one and negative where it counts down.
_places: dict[str, int] = {}


def _place(word: str) -> int:
    slot, sign = _slot(word.lower(), WORD_SIZE)
    _places[word] = place = int(sign) * (slot + 1)
    return place


def vectors(page: list[Block]) -> np.ndarray:
    """A row per block."""
    x = np.zeros((len(page), PATH_SIZE + WORD_SIZE + FIGURES), np.float32)
    if len(_places) > 200_000:
        _places.clear()
    total = sum(len(b.text) for b in page) or 1
    words = [b.text.split(" ") for b in page]
    counts = np.array([len(w) for w in words], np.int64)
    places = np.array([_places.get(w) or _place(w) for own in words for w in own], np.int64)
    at = np.repeat(np.arange(len(page)), counts) * WORD_SIZE + np.abs(places) - 1
    sums = np.bincount(at, np.sign(places), len(page) * WORD_SIZE).reshape(len(page), WORD_SIZE)
    x[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = sums / counts[:, None]
    paths: dict[tuple[str, ...], np.ndarray] = {}
    for k, b in enumerate(page):
        row = paths.get(b.path)
        if row is None:
            row = np.zeros(PATH_SIZE, np.float32)
            for name in b.path:
                slot, sign = _slot(name, PATH_SIZE)
                row[slot] += sign
            paths[b.path] = row = np.clip(row, -2, 2)
        x[k, :PATH_SIZE] = row
        x[k, PATH_SIZE + WORD_SIZE :] = (
            np.log1p(len(b.text)) / 5,
            b.linked,
            k / len(page),
            len(b.text) / total,
            b.text[-1] in ".!?",
            len(b.path) / 10,
        )
    return x


# ---- the network


class Labeller:
    """A bidirectional LSTM over block vectors with one logistic output."""

    def __init__(self, size: int = PATH_SIZE + WORD_SIZE + FIGURES, hidden: int = HIDDEN, seed: int = 5):
        r = np.random.default_rng(seed)
        self.hidden = hidden
        scale = 1 / np.sqrt(size + hidden)
        self.weights = {}
        for side in "fb":
            self.weights[f"w{side}"] = (r.standard_normal((size + hidden, 4 * hidden)) * scale).astype(np.float32)
            self.weights[f"c{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden).astype(np.float32)
        self.weights["out"] = (r.standard_normal((2 * hidden,)) * 0.3).astype(np.float32)
        self.weights["bias"] = np.zeros(1, np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        """States for every step of (pages, steps, size); a masked step carries the state on."""
        n, steps, size = x.shape
        w, bias, hid = self.weights[f"w{side}"], self.weights[f"c{side}"], self.hidden
        h, c = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
        out, saved = np.zeros((n, steps, hid), np.float32), []
        inputs = x @ w[:size] + bias
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = inputs[:, t] + h @ w[size:]
            gates = 1 / (1 + np.exp(-z[:, : 3 * hid]))
            i, f, o, g = gates[:, :hid], gates[:, hid : 2 * hid], gates[:, 2 * hid :], np.tanh(z[:, 3 * hid :])
            m = mask[:, t, None]
            c_new = f * c + i * g
            tanh = np.tanh(c_new)
            if keep:
                saved.append((t, i, f, o, g, c, h, tanh, m))
            c = m * c_new + (1 - m) * c
            h = m * (o * tanh) + (1 - m) * h
            out[:, t] = h
        return out, saved

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        forward, backward = self._pass(x, mask, "f", False)[0], self._pass(x, mask, "b", False)[0]
        return 1 / (1 + np.exp(-(np.concatenate([forward, backward], axis=2) @ self.weights["out"] + self.weights["bias"])))

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over the unmasked blocks."""
        passes = {side: self._pass(x, mask, side, True) for side in "fb"}
        both = np.concatenate([passes["f"][0], passes["b"][0]], axis=2)
        p = 1 / (1 + np.exp(-(both @ self.weights["out"] + self.weights["bias"])))
        d = (p - y) * mask / max(1.0, mask.sum())
        grads = {"out": np.einsum("nt,nth->h", d, both), "bias": np.array([d.sum()], np.float32)}
        size, hid = x.shape[2], self.hidden
        for side, part in (("f", slice(0, hid)), ("b", slice(hid, 2 * hid))):
            w = self.weights[f"w{side}"]
            gw, gb = np.zeros_like(w), np.zeros(4 * hid, np.float32)
            dh, dc = np.zeros((len(x), hid), np.float32), np.zeros((len(x), hid), np.float32)
            for t, i, f, o, g, c, h, tanh, m in reversed(passes[side][1]):
                dh = dh + d[:, t, None] * self.weights["out"][part]
                own, own_c = m * dh, m * dc
                own_c = own_c + own * o * (1 - tanh**2)
                z = np.concatenate([own_c * g * i * (1 - i), own_c * c * f * (1 - f), own * tanh * o * (1 - o), own_c * i * (1 - g**2)], axis=1)
                gw[:size] += x[:, t].T @ z
                gw[size:] += h.T @ z
                gb += z.sum(axis=0)
                dh = z @ w[size:].T + (1 - m) * dh
                dc = own_c * f + (1 - m) * dc
            grads[f"w{side}"], grads[f"c{side}"] = gw, gb
        return grads

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            by_size = sorted(range(len(pages)), key=lambda k: (len(pages[k]) + r.random() * 4, k))
            groups = [by_size[a : a + batch] for a in range(0, len(by_size), batch)]
            for k in r.permutation(len(groups)):
                x, mask = padded([pages[j] for j in groups[k]])
                y = padded([labels[j][:, None] for j in groups[k]])[0][:, :, 0]
                step += 1
                for name, grad in self.gradients(x, mask, y).items():
                    grad = np.clip(grad, -1, 1)
                    first[name] += 0.1 * (grad - first[name])
                    second[name] += 0.01 * (grad**2 - second[name])
                    change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
                    self.weights[name] = (self.weights[name] - rate * (1 - epoch / epochs * 0.8) * change).astype(np.float32)

    def label(self, pages: list[np.ndarray], cells: int = 20_000) -> list[np.ndarray]:
        """Scores of the blocks of each page; pages of like length go together, at most so many steps at a time."""
        found: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            longest = len(pages[order[-1]])
            take = order[-max(1, cells // longest) :]
            del order[-len(take) :]
            x, mask = padded([pages[k] for k in take])
            for k, row in zip(take, self.scores(x, mask), strict=True):
                found[k] = row[: len(pages[k])]
        return found


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32)
    mask = np.zeros((len(pages), steps), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
        mask[k, : len(p)] = 1
    return x, mask


# ---- training pages


def told(block: Block) -> int | None:
    """1 or 0 where the path says what a block is, the innermost word first; else nothing."""
    for name in reversed(block.path):
        if name in REST or name[0] == "." and name[1:] in REST_WORDS:
            return 0
        if name in CONTENT:
            return 1
    return None


def made_up(r: random.Random, pool: list[str], bits: list[str]) -> tuple[list[Block], list[int]]:
    """A page of known labels, from texts of real pages in a layout drawn at random."""
    page: list[Block] = []
    labels: list[int] = []

    def put(label: int, path: tuple[str, ...], text: str, linked: float = 0.0) -> None:
        page.append(Block(("html", "body", *path), text, linked))
        labels.append(label)

    def some(low: int, high: int) -> range:
        return range(r.randrange(low, high + 1))

    def words(low: int, high: int) -> str:
        text = r.choice(pool).split(" ")
        at = r.randrange(len(text))
        return " ".join(text[at : at + r.randrange(low, high + 1)])

    outer = r.choice([(), ("div", ".wrapper"), ("div", ".container"), ("div", ".page")])

    def rest(where: str) -> None:
        kind = r.choice(["nav", "list", "ad", "notice", "side", "form", "foot", "comments"] if where == "after" else ["nav", "list", "ad", "notice", "side", "form"])
        word = r.choice(REST_WORDS)
        if kind == "nav":
            path = r.choice([("nav", "ul", "li", "a"), ("header", "nav", "a"), ("div", ".menu", "ul", "li", "a"), ("header", "div", ".logo")])
            for _ in some(1, 8):
                put(0, (*outer, *path), words(1, 3), 1.0 if "a" in path else 0.0)
        elif kind == "list":
            for _ in some(2, 6):
                put(0, (*outer, "div", f".{word}", "ul", "li", "a"), words(1, 8), 1.0)
        elif kind in ("ad", "notice"):
            path = ("div", "." + r.choice(["ad", "ads", "advert", "banner", "sponsor", "promo"] if kind == "ad" else ["cookie", "consent", "notice", "alert", "popup"]))
            for _ in some(1, 2):
                put(0, (*outer, *path, *r.choice([(), ("p",)])), r.choice(bits) if bits else words(5, 30))
        elif kind == "side":
            path = r.choice([("aside",), ("aside", ".sidebar"), ("div", ".sidebar"), ("div", f".{word}")])
            for _ in some(1, 5):
                put(0, (*outer, *path, *r.choice([("p",), ("h3",), ("ul", "li", "a")])), words(2, 40), r.choice([0.0, 1.0]))
        elif kind == "form":
            for _ in some(1, 3):
                put(0, (*outer, "form", *r.choice([("label",), ("button",), ("p",)])), words(1, 8))
        elif kind == "foot":
            for _ in some(1, 3):
                put(0, (*outer, "footer", *r.choice([(), ("p",), ("div",)])), r.choice(["© ", "", "Copyright "]) + words(2, 20))
        else:
            path = r.choice([("section", ".comments"), ("div", ".comments"), ("ol", ".commentlist"), ("div", ".comment", ".reply")])
            for _ in some(1, 6):
                put(0, (*outer, *path, *r.choice([("p",), ("div", ".comment", "p"), ("li", ".comment", "p"), ("article", ".comment", "p")])), words(3, 60))

    for _ in some(1, 3):
        rest("before")
    inner = r.choice([("article",), ("main",), ("main", "article"), ("div", f".{r.choice(CONTENT_WORDS)}"), ("div", ".post", ".content"), ("section", ".article"), ("article", ".post", "div", ".entry", ".content")])
    if r.random() < 0.7:
        put(1, (*outer, *inner, r.choice(["h1", "h2"])), words(3, 12))
    for _ in some(1, 14):
        put(1, (*outer, *inner, *r.choice([("p",), ("p",), ("p", "b"), ("h2",), ("ul", "li"), ("blockquote", "p"), ("pre",), ("table", "tr", "td"), ()])), words(1, 120), r.choice([0.0, 0.0, 0.0, 0.3]))
        if r.random() < 0.06:
            put(0, (*outer, *inner, "div", "." + r.choice(["ad", "share", "related", "newsletter", "promo"])), words(2, 20))
    for _ in some(1, 4):
        rest("after")
    return page, labels


def fit_labeller(pages: DataFrame, html: str = "html", url: str = "url", rows: int = FIT_PAGES) -> Labeller:
    """Trains on a bounded sample of the pages."""
    some = pages.select(F.col(html).alias("h"), F.col(url).alias("u")).where("length(h) > 0")
    read = [blocks(r["h"]) for r in least_hashed(some, rows).collect()]
    x, y = [], []
    for page in read:
        labels = [told(b) for b in page]
        if page and None not in labels:
            x.append(vectors(page))
            y.append(np.array(labels, np.float32))
    r = random.Random(9)
    pool = [b.text for page in read for b in page if len(b.text) > 20] or ["text of a page"]
    bits = [b.text for page in read for b in page if told(b) == 0 and len(b.text) > 20]
    for _ in range(3 * max(80, len(read))):
        page, labels = made_up(r, pool, bits)
        x.append(vectors(page))
        y.append(np.array(labels, np.float32))
    model = Labeller()
    model.fit(x, y)
    return model


def main_text(pages: DataFrame, model: Labeller, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` without ``html``, with the main text of each; a column of that name is replaced."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    others = [c for c in pages.columns if c not in (html, into)]
    body = fresh("_html", others)
    source = pages.select(*[F.col(f"`{c}`") for c in others], F.col(html).alias(body))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, body):
            read = [blocks(h) if h else [] for h in part.column(body).to_pylist()]
            scores = shared.value.label([vectors(page) for page in read])
            texts = [" ".join(b.text for b, s in zip(page, own, strict=True) if s >= 0.5) for page, own in zip(read, scores, strict=True)]
            yield {**{c: part.column(c) for c in others}, into: pa.array(texts, pa.string())}

    fields = [f for f in source.schema.fields if f.name != body]
    return arrow_map(source, work, T.StructType([*fields, T.StructField(into, T.StringType())]))
