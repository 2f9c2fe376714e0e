import random
import re
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest

from gridloom.llm import ngram_join
from gridloom.llm.batches import shingle_sets
from gridloom.llm.components import components
from gridloom.llm.ngram_join import SetTree, jaccard_components, similar


def shingles(text, width=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows):
    """Size per row and smallest linked id, by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in sets:
        for j, y in sets:
            if None not in (i, j) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted(((i, len(x), None if i is None else find(i)) for i, x in sets), key=str)


def texts(count, seed):
    r = random.Random(seed)
    passage = " ".join(f"common{k}" for k in range(60))
    found = []
    for _ in range(count):
        kind = r.random()
        if found and kind < 0.5:
            words = r.choice(found).split(" ")
            for _ in range(r.choice([0, 0, 1, 2, 3, 6, 12])):
                at = r.randrange(len(words) + 1)
                words[at : at + r.choice([0, 1])] = [f"new{r.randrange(50)}"]
            found.append(" ".join(words))
        else:
            words = " ".join(f"w{r.randrange(400)}" for _ in range(r.choice([1, 3, 4, 5, 6, 40, 90, 200])))
            found.append(words + (" " + passage if kind > 0.8 else ""))
    return found


@pytest.mark.parametrize(("seed", "block"), [(1, 1000), (2, 1000), (3, 4)])
def test_agrees_with_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = list(enumerate(texts(160, seed), start=5))
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"x{k}" for k in range(5000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (9, "one TWO"), (5, "two one"), (None, "one two"), (7, long), (8, long + " y")]
    rows += [(7, long), (10, "a b c d e"), (11, "a b c d e f g h i j k"), (12, "ÄB c d e f"), (13, "äB c d e f")]
    df = spark.createDataFrame([(i, t, "p", 0, 0) for i, t in rows], "doc_id long, text string, component_id string, n int, shingle int")
    assert sorted(map(tuple, jaccard_components(df).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    found = jaccard_components(spark.createDataFrame([], "doc_id long, text string"))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert found.count() == 0


def test_common_shingles_only_set_the_order(spark, monkeypatch):
    rows = list(enumerate(texts(120, 9)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "COMMON_IN_TASK", 2)
    monkeypatch.setattr(ngram_join, "COMMON_SHINGLES", 30)
    assert sorted(map(tuple, jaccard_components(df).collect()), key=str) == brute(rows)


def test_tree_finds_what_comparing_finds():
    import numpy as np

    r = random.Random(4)
    sets = [np.array(sorted(r.sample(range(60), r.randrange(1, 50)))) for _ in range(150)]
    sets += [np.delete(s, 0) for s in sets if len(s) > 6] + sets[:5]
    first = [s[: ngram_join.prefix_length(len(s), 80)] for s in sets]
    tree = SetTree.of(first, [len(s) for s in sets])
    for s, prefix in zip(sets, first):
        enough = {
            k
            for k, (x, p) in enumerate(zip(sets, first))
            if min(len(x), len(s)) * 100 >= 80 * max(len(x), len(s))
            and len(np.intersect1d(prefix, p)) >= ngram_join.needed_in_prefixes(len(s), len(x), 80)
        }
        assert set(tree.matches(prefix, len(s), 80, lambda key: False)) == enough
        assert enough >= {k for k, x in enumerate(sets) if similar(len(np.intersect1d(s, x)), len(s), len(x), 80)}


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 90), (90, 95), (100, 95), (7, 7), (200, 201)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 1 for k in range(1, 61)}, 90: 90, 95: 90, 100: 90, 200: 200, 201: 200}


def peak_of(work):
    """What ``work`` returns, and the most bytes it held at a time."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_summaries_hash_few_bytes_at_a_time():
    passage = " ".join(f"common{k}" for k in range(5))
    r = random.Random(4)
    rows = [" ".join(f"w{r.randrange(10**6)}" for _ in range(700)) for _ in range(1500)]
    # Far apart, so that no slice of the hashing holds two of them.
    rows[::200] = [passage + " " + t for t in rows[::200]]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(rows))), "text": rows})
    size = sum(map(len, rows))
    assert 6 << 20 < size < 8 << 20
    run = ngram_join._summaries(SimpleNamespace(mapInArrow=lambda work, schema: work), 5)
    found, most = peak_of(lambda: pa.Table.from_batches(run(iter([batch]))).to_pylist())
    assert most < 20 * size
    assert [(x["doc_id"], x["n"]) for x in found if x["kind"] == 0] == [(i, len(shingles(t))) for i, t in enumerate(rows)]
    common = next(shingle_sets(pa.array([passage])))
    assert [(x["doc_id"], x["n"]) for x in found if x["kind"] == 1] == [(int(common.astype("int64")[0]), 8)]


def test_long_partners_of_short_texts_are_hashed_in_slices(monkeypatch):
    frames = []
    monkeypatch.setattr(ngram_join, "arrow_map", lambda df, work, schema: frames.append(work))
    frame = SimpleNamespace(hint=lambda _: frame, join=lambda *_: frame, select=lambda *_: frame)
    monkeypatch.setattr(ngram_join, "F", SimpleNamespace(col=lambda _: SimpleNamespace(alias=lambda _: None)))
    ngram_join._verified(frame, frame, 80, 5)
    r = random.Random(5)
    long = [" ".join(f"w{r.randrange(10**6)}" for _ in range(40_000)) for _ in range(48)]
    short = ["a b c d e"] * 47 + [long[-1]]
    batch = pa.RecordBatch.from_pydict({"a": list(range(48)), "b": list(range(48, 96)), "text_a": short, "text_b": long})
    found, most = peak_of(lambda: [list(zip(x["a"].to_pylist(), x["b"].to_pylist(), strict=True)) for x in frames[0](batch)])
    assert most < 12 * sum(map(len, long))
    assert [pair for part in found for pair in part] == [(47, 95)]
