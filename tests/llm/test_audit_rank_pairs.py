"""Filter audit, ranked search and byte pairs against brute force and the library, and on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gridloom.llm import byte_pairs, filter_audit, lexical_rank

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# ---- filter audit


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = set()
    if len(words) < 100:
        found.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        found.add("B")
    if 100 * sum(c in UPPER for c in text) > 10 * len(text):
        found.add("C")
    if set(text) & set("#$%&*|"):
        found.add("D")
    return found


def audited(rows, labels):
    """Every order applied to the rows, one filter after the other."""
    judged = []
    for i, text, lang in rows:
        text = text or ""
        own = fails(text)
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            own.add("E")
        good = any(k == i and q == 1 for k, q, _ in labels) if i is not None else False
        toxic = any(k == i and t == 1 for k, _, t in labels) if i is not None else False
        judged.append((lang or "", own, good, toxic))
    out = []
    for part in {p for p, *_ in judged}:
        mine = [x for x in judged if x[0] == part]
        shapley, steps = Counter(), []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                failing = [x for x in mine if f in x[1]]
                alone = sum(x[1] == {f} for x in mine)
                steps.append((part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), alone, sum(x[2] for x in gone), sum(x[3] for x in gone), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def audit_rows(seed):
    r = random.Random(seed)
    texts = [None, "", " \t\n", "a", "É" * 40, "# one", "x y"]
    for _ in range(60):
        words = [f"w{r.randrange(r.choice([30, 5000]))}" for _ in range(r.choice([20, 99, 100, 101, 300]))]
        if r.random() < 0.3:
            words = [w.upper() * 2 for w in words]
        texts.append(r.choice([" ", "  ", "\n", "\x0b"]).join(words) + r.choice(["", "", "|", "\x1c"]))
    rows = [(k, r.choice(texts), r.choice(["en", "fr", None, ""])) for k in range(150)]
    rows += [(None, texts[9], "en"), (None, texts[9], "en"), rows[3], rows[3], (3, "another text", "fr")]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1, None])) for k in r.sample(range(150), 80)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1)]
    return rows, labels


COUNTS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_agrees_with_applying_every_order(spark, seed):
    rows, labels = audit_rows(seed)
    docs = spark.createDataFrame([(*x, 1, "p", "d") for x in rows], "doc_id long, text string, lang string, fails int, part string, digest string")
    marks = spark.createDataFrame([(*x, 7) for x in labels], "doc_id long, quality int, toxic int, n int")
    found = filter_audit.audit(docs, marks).select(COUNTS).collect()
    assert sorted(map(tuple, found)) == audited(rows, labels)


def test_audit_of_empty_tables(spark):
    rows, labels = audit_rows(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert sorted(map(tuple, filter_audit.audit(docs, marks.limit(0)).select(COUNTS).collect())) == audited(rows, [])


def test_paths_of_the_lattice():
    lattice = filter_audit.Lattice(4)
    sizes = [s.bit_count() for s in range(16)]
    assert lattice.reach.tolist() == [math.factorial(n) for n in sizes]
    assert lattice.leave.tolist() == [math.factorial(4 - n) for n in sizes]
    counts = np.random.default_rng(3).integers(0, 50, (16, 3))
    rows = lattice.report(counts, "ABCD")
    by_filter = Counter()
    for order, step, _, removed, *_ in rows:
        by_filter[order[step - 1]] += removed
    assert all(by_filter[order[step - 1]] == rest[-1] for order, step, *rest in rows)
    assert all(rest[0] == counts[0, 0] for _, step, *rest in rows if step == 4)
    with pytest.raises(ValueError):
        filter_audit.Lattice(0)


# ---- ranked search


def terms_of(text):
    lowered = (text or "").translate({ord(c): c.lower() for c in UPPER})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def ranked(docs, items, top):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for i, text in set(items):
        scores = []
        for (doc, counts), n in zip(held, sizes):
            score = 0
            for term in terms_of(text):
                if counts[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 75 + 25 * n * n_docs // n_terms
                    score += weight * (1_000_000_000 * counts[term] // (1000 * counts[term] + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(i, k, doc, -score) for k, (score, _, _, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def rank_rows(seed):
    r = random.Random(seed)
    vocabulary = [f"Wort{k}" if k % 3 else f"é{k}" for k in range(150)]

    def prose(n):
        return r.choice([" ", ", ", "-", "_"]).join(vocabulary[min(r.randrange(150), r.randrange(150), r.randrange(150))] for _ in range(n))

    docs = [(k, prose(r.randrange(1, 80))) for k in range(120)]
    docs += [(200 + k, docs[4][1]) for k in range(30)] + [(4, docs[4][1]), (4, "wort1 other"), (None, docs[4][1]), (None, None), (300, ""), (301, " -- "), (302, prose(4000))]
    items = [(k, prose(r.randrange(1, 40))) for k in range(25)] + [(25, None), (26, "."), (27, "nowhere"), (28, docs[4][1]), (28, docs[4][1]), (29, "Wort1 wort1 WORT1 é1 É1")]
    return docs, items


@pytest.mark.parametrize(("top", "owners", "block_docs", "bundle"), [(20, lexical_rank.OWNERS, 4096, 64), (3, (3000, 1500, 700, 0), 7, 4), (5, (0,), 16, 100)])
def test_ranking_agrees_with_scoring_every_document(spark, top, owners, block_docs, bundle):
    docs, items = rank_rows(top)
    texts = spark.createDataFrame([(*x, "r", 0.5, 1) for x in docs], "doc_id long, text string, rank string, score double, block int").repartition(5)
    asked = spark.createDataFrame([(*x, "q") for x in items], "item_id long, text string, query string")
    found = lexical_rank.search(texts, asked, top=top, owners=owners, block_docs=block_docs, bundle=bundle)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect()), key=str) == ranked(docs, items, top)


def test_ranking_of_empty_tables(spark):
    docs, items = rank_rows(1)
    texts, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert lexical_rank.search(texts.limit(0), asked).count() == lexical_rank.search(texts, asked.limit(0)).count() == 0
    assert lexical_rank.search(texts.where("text is null"), asked).count() == 0


def test_items_that_cannot_gain_take_no_new_documents(spark):
    """The bound between stages drops documents, and none of the best."""
    docs = [(k, "rare " * 3 + "common") for k in range(25)] + [(100 + k, "common words here") for k in range(400)]
    found = lexical_rank.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "rare common")], "item_id long, text string"), owners=(1000, 0))
    assert sorted(map(tuple, found.collect())) == sorted(ranked(docs, [(1, "rare common")], 20))
    assert {x["doc_id"] for x in found.collect()} == set(range(20))


# ---- byte pairs


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pairs.read_ranks(RANKS), special_tokens={})


def odd_texts(count):
    r = random.Random(4)
    points = [*range(0, 0x250), *range(0x2000, 0x2070), *(r.choice([r.randrange(0x250, 0xD800), r.randrange(0xE000, 0x110000)]) for _ in range(2000))]
    points += [0x558, 0x2B73A, 0x1C89, 0x16D70, 0x3FC3F, 0x85, 0x1C, 0x3000]
    texts = ["".join(chr(r.choice(points)) for _ in range(r.randrange(40))) for _ in range(count)]
    return texts + [" ".join(r.choice(["don't", "we're  ", "\n\n", "12345", "naïve", "x" * 200, "' 's"]) for _ in range(30)) for _ in range(50)]


def test_ids_are_those_of_the_rank_library(spark, library):
    texts = [None, "", " ", "<|endoftext|>", "a" * 50_000, "\t 　 x", *odd_texts(600)]
    rows = [(k, t, [9], "d", "t") for k, t in enumerate(texts)] + [(None, "no id", [], "", ""), (1, "", [], "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, decoded string, _text string").repartition(3)
    found = byte_pairs.encode(df, RANKS, public_tokenizers.PATTERN, decoded=True)
    assert found.columns == ["doc_id", "_text", "ids", "decoded"]
    result = sorted(((x["doc_id"], x["ids"], bytes(x["decoded"])) for x in found.collect()), key=str)
    assert result == sorted(((k, library.encode_ordinary(t or ""), (t or "").encode()) for k, t, *_ in rows), key=str)
    assert byte_pairs.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_ids_decode_to_bytes(spark, library):
    lists = [library.encode_ordinary(t) for t in odd_texts(20)] + [[], None, [200, 13]]
    df = spark.createDataFrame(list(enumerate(lists)), "k int, ids array<int>")
    found = {x["k"]: x["decoded"] for x in byte_pairs.decode(df, RANKS, public_tokenizers.PATTERN).collect()}
    assert all((found[k] is None) if ids is None else bytes(found[k]) == library.decode_bytes(ids) for k, ids in enumerate(lists))


def test_pieces_stand_for_bytes_by_falling_rank():
    ranks = byte_pairs.read_ranks(RANKS)
    assert len(set(byte_pairs.byte_characters())) == 256
    with pytest.raises(ValueError):
        byte_pairs.serialised({b"a": 0})
    few = {bytes([b]): 1000 - b for b in range(256)} | {b"th": 2000, b"the": 2001, b"he": 2002}
    coder = byte_pairs.BytePairs(byte_pairs.serialised(few), np.array(sorted(few.values())), public_tokenizers.PATTERN, "")
    own = tiktoken.Encoding("few", pat_str=public_tokenizers.PATTERN, mergeable_ranks=few, special_tokens={})
    for text in ("the heathen", "hehe then", "thththe"):
        assert coder.encode(text).tolist() == own.encode_ordinary(text)
    digest = hashlib.sha256(byte_pairs.serialised(ranks)).hexdigest()
    assert digest == hashlib.sha256(byte_pairs.serialised(dict(reversed(ranks.items())))).hexdigest()
