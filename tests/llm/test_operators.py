"""Each operator against brute force, an exact round trip or known cases, and on odd rows."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from gridloom.llm import batches, block_keys, chunk_dedup, cross_entropy, decontamination, html_extraction, neighbours, repeated_substrings, secrets, sentencepieces, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(1, None), (2, ""), (3, "  \n"), (4, "a"), (None, "no id here"), (5, "repeated row"), (5, "repeated row"), (6, "long " * 30_000)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", 0.5, "y") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, score double, _text string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def prose(r, words):
    return " ".join("".join(r.choice(["er", "an", "th", "on", "st"]) for _ in range(r.randrange(1, 4))) for _ in range(words))


# ---- repeated substrings


def without_repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    windows = [d[k : k + length] for d in data for k in range(len(d) - length + 1)]
    counts = {w: 0 for w in windows}
    for w in windows:
        counts[w] += 1
    found = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if counts[d[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        found.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return found


@pytest.mark.parametrize("block", [1500, 3])
def test_repeated_substrings_agree_with_all_windows(spark, monkeypatch, block):
    monkeypatch.setattr(repeated_substrings, "BLOCK", block)
    r = random.Random(2)
    texts = [prose(r, 150) for _ in range(25)]
    passage = prose(r, 60)
    for k in range(12):
        texts[k] = texts[k][: 40 * k] + passage[k : len(passage) - k] + texts[k][40 * k :]
    texts += [texts[3], texts[4][100:700], "ab" * 300, "x" * 450, texts[0] + "é" + texts[0], None, "", "short"]
    rows = [(k, t) for k, t in enumerate(texts)]
    found = repeated_substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).drop("text").orderBy("doc_id").collect()
    assert [tuple(x)[1:] for x in found] == without_repeats(texts)


def test_repeated_substrings_of_odd_rows(odd, none):
    found = repeated_substrings.without_repeats(odd).drop("text").collect()
    expected = without_repeats([t for _, t in ODD])
    assert sorted(map(str, found)) == sorted(str((i, *e)).replace("(", "Row(doc_id=", 1) for (i, _), e in zip(ODD, expected)) or sorted(
        tuple(x)[1:] for x in found
    ) == sorted(expected)
    assert repeated_substrings.without_repeats(none).count() == 0


def test_maximal_repeats_agree_with_all_prefixes():
    r = random.Random(1)
    for _ in range(400):
        suffixes = [(bytes(r.choice(b"ab") for _ in range(r.randrange(3, 9))), r.choice([-1, 97, 97, 98])) for _ in range(r.randrange(1, 9))]
        by_prefix = {}
        for k, (s, _) in enumerate(suffixes):
            for size in range(3, len(s) + 1):
                by_prefix.setdefault(s[:size], []).append(k)
        expected = set()
        for prefix, own in by_prefix.items():
            after = {suffixes[k][0][len(prefix) : len(prefix) + 1] for k in own}
            before = [suffixes[k][1] for k in own]
            if len(own) > 1 and (len(after) > 1 or b"" in after) and (-1 in before or len(set(before)) > 1):
                expected.add((len(prefix), tuple(own)))
        assert {(n, tuple(sorted(own))) for n, own in repeated_substrings.maximal_repeats(suffixes, 3)} == expected


# ---- HTML


def test_blocks_of_broken_markup():
    page = "<title>t</title><p>One <b>two</b>&amp;<p>three<br>four<!-- no --><script>var a='</p>'</script><ul><li>five<li>six</ul>seven"
    assert [b.text for b in html_extraction.blocks(page)] == ["One two&", "three", "four", "five", "six", "seven"]


def test_article_text_is_found(spark):
    r = random.Random(6)
    rows, expected = [], []
    for k in range(60):
        body = [prose(r, 30).capitalize() + "." for _ in range(r.randrange(2, 7))]
        noise = f'<nav><ul><li><a href="/x">{prose(r, 1)}</a></li></ul></nav><div class="cookie">{prose(r, 8)}</div>'
        tail = f'<section class="comments"><p>{prose(r, 12)}</p></section><aside class="sidebar"><p>{prose(r, 9)}</p></aside><footer>&copy; {prose(r, 4)}</footer>'
        rows.append((k, f"u{k}", f"<html><body>{noise}<article>" + "".join(f"<p>{b}</p>" for b in body) + f"</article>{tail}</body></html>"))
        expected.append(" ".join(body))
    rows += [(100, "n", None), (101, "e", ""), (102, "t", "just text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_extraction.main_text(pages, html_extraction.fit_labeller(pages)).orderBy("page_id").collect()
    assert sum(x["text"] == e for x, e in zip(found, expected)) >= 57
    assert found[60]["text"] == found[61]["text"] == ""
    assert html_extraction.main_text(pages.limit(0), html_extraction.Labeller()).count() == 0


# ---- toxicity


def test_toxic_texts_are_told_on_held_out_rows(spark, odd, none):
    r = random.Random(8)
    rows = []
    for k in range(900):
        toxic = k % 5 == 0
        words = prose(r, 60).split()
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words)), r.choice(["vilewort", "grimling", "you nastik"]))
        rows.append((k, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(df.drop("toxic"), df.drop("text").where(~toxicity.held_out(F.col("doc_id"))))
    held = toxicity.score_toxicity(df, model).where(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(held) > 100
    assert np.mean([(x["score"] >= 0.3) == bool(x["toxic"]) for x in held]) > 0.95
    scored = toxicity.score_toxicity(odd, model).collect()
    assert len(scored) == len(ODD) and all(0 <= x["score"] <= 1 for x in scored)
    assert toxicity.score_toxicity(none, toxicity.fit_toxicity(none, df.drop("text").limit(0))).count() == 0


def test_isotonic_fit_increases():
    score, y = np.array([0.1, 0.2, 0.3, 0.3, 0.5]), np.array([0.0, 1, 0, 0, 1])
    at, value = toxicity.isotonic(score, y)
    assert (np.diff(at) >= 0).all() and (np.diff(value) >= 0).all()


# ---- cross-entropy


def test_losses_agree_with_counting_by_hand(spark, odd):
    good, bad = ["a b a b", "a b"], ["c c c", "a c"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(good + bad)], "doc_id long, text string")
    target = docs.where("doc_id < 2")
    scored = {x["doc_id"]: x for x in cross_entropy.score_difference(docs, target).collect()}
    pairs, words = {}, {}
    for t in good:
        before = "^"
        for w in t.split():
            pairs[before, w] = pairs.get((before, w), 0) + 1
            words[w] = words.get(w, 0) + 1
            before = w
    rest = lambda w: (0.29 * words.get(w, 0) / 6 + 0.01 / cross_entropy.VOCABULARY) / 0.3
    total = 0.0
    for before, w in (("^", "a"), ("a", "c")):
        seen = sum(n for (b, _), n in pairs.items() if b == before)
        total -= np.log2(0.7 * pairs.get((before, w), 0) / seen + 0.3 * rest(w))
    assert scored[3]["target_loss"] == pytest.approx(total / 2, rel=1e-5)
    assert scored[0]["score"] < 0 < scored[2]["score"]
    assert cross_entropy.score_difference(docs, F.col("doc_id") < 2).sort("doc_id").collect() == [scored[k] for k in range(4)]
    found = cross_entropy.score_difference(odd, target).collect()
    assert len(found) == len(ODD) and [x["n_tokens"] for x in found if x["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert cross_entropy.score_difference(docs.limit(0), target.limit(0)).count() == 0


@pytest.mark.parametrize(("sizes", "own"), [((4 << 20, 4 << 20), True), ((900, 700), True), ((5, 300), False)])
def test_every_word_has_its_own_counts(spark, monkeypatch, sizes, own):
    """More words than any fixed vocabulary of old; one block and many, one bucket and many give the same."""
    monkeypatch.setattr(block_keys.in_blocks, "__defaults__", (sizes[0],))
    monkeypatch.setattr(block_keys.bucket_count, "__defaults__", (sizes[1],))
    r = random.Random(8)
    texts = [" ".join(f"w{min(r.randrange(4000), r.randrange(4000))}" for _ in range(r.randrange(1, 300))) for _ in range(80)] + ["w1 w2 w1 w2"] * 5
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[3]), (900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = docs.where("doc_id < 20")
    other = docs.where("doc_id >= 30")
    models = []
    for part in ([t for k, t in rows if k is not None and k < 20], [t for k, t in rows if t and (own or k is not None and k >= 30)]):
        pairs, words, seen = {}, {}, {}
        for t in part:
            for a, w in zip(["^", *t.split()], t.split()):
                pairs[a, w], words[w], seen[a] = pairs.get((a, w), 0) + 1, words.get(w, 0) + 1, seen.get(a, 0) + 1
        models.append((pairs, words, seen, sum(words.values())))
    distinct = len({w for t in texts for w in t.split()}) + 1
    assert distinct > cross_entropy.VOCABULARY

    def loss(model, a, w):
        pairs, words, seen, n = model
        share = 0.7 if a in seen else 0.0
        rest = (0.29 * words.get(w, 0) / n + 0.01 / distinct) / 0.3
        return -np.log2(share * pairs.get((a, w), 0) / seen.get(a, 1) + (1 - share) * rest)

    found = cross_entropy.score_difference(docs, target, None if own else other).collect()
    expected = []
    for k, t in rows:
        met = list(zip(["^", *t.split()], t.split())) if t else []
        expected.append((k, len(met), *(sum(loss(m, *p) for p in met) / max(1, len(met)) for m in models)))

    def order(x):
        return (x[0] is None, x[0] or 0)

    for x, y in zip(sorted(found, key=order), sorted(expected, key=order), strict=True):
        assert (x["doc_id"], x["n_tokens"]) == y[:2]
        assert (x["target_loss"], x["background_loss"], x["score"]) == pytest.approx((y[2], y[3], y[2] - y[3]), rel=1e-9)


# ---- chunks


def test_gear_hash_is_the_rolling_one():
    data = np.random.default_rng(0).integers(0, 256, 500, dtype=np.uint8)
    h, expected = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(chunk_dedup._GEAR[b])) % 2**32
        expected.append(h)
    assert chunk_dedup.gear(data).tolist() == expected


def test_shared_passages_are_found_in_spite_of_insertions(spark, odd, none):
    r = random.Random(3)
    passage = prose(r, 90)
    texts = [prose(r, 80) for _ in range(30)]
    for k in range(10):
        texts[k] = texts[k][: 37 * k] + passage + texts[k][37 * k :]
    rows = [(k, t) for k, t in enumerate(texts)]
    found = {x["doc_id"]: x for x in chunk_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[k]["n_shared"] > len(passage) // 2 for k in range(10))
    assert found[0]["n_removed"] == 0 and all(found[k]["n_removed"] > len(passage) // 2 for k in range(1, 10))
    assert all(found[k]["n_shared"] == 0 and bytes(found[k]["text"]).decode() == texts[k] for k in range(10, 30))
    assert chunk_dedup.deduplicated(odd).count() == len(ODD)
    assert chunk_dedup.deduplicated(none).count() == 0


def test_passages_of_51_words_in_two_documents_are_found(spark):
    r = random.Random(17)
    short = "a be in of to the and was it not for day sun red big cat".split()
    texts = []
    for k in range(300):
        passage = prose(r, 51) if k % 3 else " ".join(r.choices(short, k=51))
        texts += [f"{prose(r, 40)} {passage} {prose(r, 40)}" for _ in range(2)]
    found = chunk_dedup.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(x["n_shared"] >= chunk_dedup.LEAST_RUN for x in found)
    assert all((x["n_removed"] > 0) == (x["doc_id"] % 2 == 1) for x in found)


def brute_chunk_dedup(rows, least_run):
    """The rule of the module, one dictionary of all chunks."""
    cut = []
    for i, t in rows:
        data = (t or "").encode()
        ends = chunk_dedup.cuts(np.frombuffer(data, np.uint8)).tolist()
        cut.append((i, data, [(a, b, data[a:b]) for a, b in zip([0, *ends], ends)]))
    times, first = {}, {}
    for i, _, parts in cut:
        for _, _, c in parts if i is not None else []:
            times[c] = times.get(c, 0) + 1
            first[c] = min(first.get(c, i), i)
    out = []
    for i, data, parts in cut:
        gone, shared, seen, k = np.zeros(len(data), bool), 0, set(), 0
        flags = []
        for a, b, c in parts:
            flags.append((a, b, i is not None and times[c] > 1, c in seen or first.get(c) != i))
            seen.add(c)
        while k < len(flags):
            j = k
            while j < len(flags) and flags[j][2]:
                j += 1
            if j > k and flags[j - 1][1] - flags[k][0] >= least_run:
                shared += flags[j - 1][1] - flags[k][0]
                x = k
                while x < j:
                    y = x
                    while y < j and flags[y][3]:
                        y += 1
                    if y > x and flags[y - 1][1] - flags[x][0] >= least_run:
                        gone[flags[x][0] : flags[y - 1][1]] = True
                    x = max(y, x + 1)
            k = max(j, k + 1)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((i, len(data), len(parts), shared, int(gone.sum()), kept))
    return out


@pytest.mark.parametrize("sizes", [(16 << 20, 12 << 20), (700, 900)])
def test_chunk_dedup_agrees_with_one_dictionary(spark, monkeypatch, sizes):
    monkeypatch.setattr(block_keys.in_blocks, "__defaults__", (sizes[0],))
    monkeypatch.setattr(block_keys.bucket_count, "__defaults__", (sizes[1],))
    r = random.Random(21)
    texts = [prose(r, r.randrange(1, 120)) for _ in range(60)]
    for k in range(25):
        a, b = r.sample(range(60), 2)
        at = r.randrange(len(texts[a]))
        texts[b] += texts[a][at : at + r.randrange(20, 300)] + prose(r, 3)
    rows = [(k - 20, t) for k, t in enumerate(texts)] + [(7, texts[27]), (7, "other " + texts[30]), (None, texts[3]), (90, None), (91, ""), (92, texts[1] * 3)]
    found = chunk_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), least_run=40)
    assert sorted((str(x["doc_id"]), x["n_bytes"], x["n_chunks"], x["n_shared"], x["n_removed"], bytes(x["text"])) for x in found.collect()) == sorted(
        (str(i), *rest) for i, *rest in brute_chunk_dedup(rows, 40)
    )
    assert {x["kept_sha256"] for x in found.collect()} == {hashlib.sha256(k).hexdigest() for *_, k in brute_chunk_dedup(rows, 40)}


def test_chunks_cover_the_text():
    for data in (b"", b"a", b"ab" * 3000, bytes(range(256)) * 20):
        ends = chunk_dedup.cuts(np.frombuffer(data, np.uint8))
        assert (np.diff(ends) > 0).all() and (not data or ends[-1] == len(data))
        assert all(np.diff(ends, prepend=0) <= chunk_dedup.MOST)


# ---- decontamination


def items_and_texts(seed, count=40):
    r = random.Random(seed)
    items = [prose(r, r.randrange(12, 50)).capitalize() + ". " + prose(r, r.randrange(3, 8)) for _ in range(count)]
    texts = [prose(r, r.randrange(1, 400)) for _ in range(60)]
    planted = {}
    for k in range(20):
        item = r.randrange(count)
        at = r.randrange(len(texts[k]))
        texts[k] = texts[k][:at] + " " + items[item].upper() + " " + texts[k][at:]
        planted[k] = item
    return items, texts, planted


@pytest.mark.parametrize("shard_bytes", [1 << 20, 900])
def test_planted_items_are_found(spark, odd, none, shard_bytes):
    items, texts, planted = items_and_texts(5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (900, None), (901, ""), (902, "one")], "item_id long, text string")
    found = {(x["doc_id"], x["item_id"]) for x in decontamination.leaks(docs, bench, shard_bytes=shard_bytes).collect()}
    assert set(planted.items()) <= found
    assert {d for d, _ in found} == set(planted)
    assert decontamination.leaks(odd, bench).count() == 0
    assert decontamination.leaks(none, bench).count() == decontamination.leaks(docs, bench.limit(0)).count() == 0


def test_search_agrees_with_scoring_every_item(monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 3)
    r = random.Random(1)
    items = [" ".join(r.choice("abcdefg") for _ in range(r.randrange(2, 14))) for _ in range(120)]
    index = decontamination.ItemIndex(list(range(120)), items, {}, 120, 6.0)
    for _ in range(200):
        terms = sorted(r.sample(range(len(index.terms)), r.randrange(1, 30)))
        scores = {}
        for t in terms:
            for item, w in zip(*index.postings[t], strict=True):
                scores[item] = scores.get(item, 0) + w
        found = dict(index.search(terms, 0.4))
        assert set(found) == {k for k, v in scores.items() if v >= 0.4}
        assert all(found[k] == pytest.approx(scores[k]) for k in found)


# ---- secrets


def test_secrets_are_told_from_harmless_strings(spark, odd, none):
    r = random.Random(12)
    rows, truth = [], []
    for k in range(200):
        words = prose(r, 40).split(" ")
        put, label = secrets._made(random.Random(1000 + k), words)[k % 2]
        words.insert(20, put)
        rows.append((k, " ".join(words)))
        truth.append(label)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.fit_secrets(docs)
    found = {x["doc_id"] for x in secrets.findings(docs, model).collect()}
    assert np.mean([(k in found) == bool(label) for k, label in enumerate(truth)]) > 0.9
    clean = secrets.redacted(docs, model).collect()
    assert all((secrets.MARK in x["text"]) == (x["doc_id"] in found) for x in clean)
    assert [x["text"] for x in secrets.redacted(odd, model).collect()] == [t for _, t in ODD]
    assert secrets.findings(none, secrets.fit_secrets(none)).count() == 0


def test_long_secrets_go_whole(spark):
    r = random.Random(5)
    texts = []
    for k in range(60):
        words = prose(r, 40).split(" ")
        words.insert(20, secrets._made(random.Random(k), words)[k % 2][0])
        texts.append(" ".join(words))
    key = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(344))
    text = f"so client_secret={key} ends"
    assert secrets.candidates(text) == [(17, 17 + 344, "assigned")]
    docs = spark.createDataFrame(list(enumerate([*texts, text])), "doc_id long, text string")
    model = secrets.fit_secrets(docs)
    found = [(x["begin"], x["end"], x["value_sha256"]) for x in secrets.findings(docs, model).where("doc_id = 60").collect()]
    assert found == [(17, 17 + 344, hashlib.sha256(key.encode()).hexdigest())]
    assert secrets.redacted(docs, model).where("doc_id = 60").first()["text"] == f"so client_secret={secrets.MARK} ends"


@pytest.mark.parametrize("held", [200_000, 5])
def test_language_is_that_of_all_documents(spark, none, monkeypatch, held):
    monkeypatch.setattr(secrets, "WORDS_HELD", held)
    r = random.Random(6)
    texts = [f"{prose(r, 20)} {'rareword' * (k == 77)} Überlänge x{k}" for k in range(80)]
    docs = spark.createDataFrame([*enumerate(texts), (90, None), (91, "")], "doc_id long, text string")
    words, pairs = {}, np.ones((128, 128))
    for t in texts:
        for w in re.findall(r"[a-z]{4,12}", t.lower()):
            words[w] = words.get(w, 0) + 1
        letters = " ".join(re.findall(r"[A-Za-z]+", t)).lower()
        for a, b in zip(letters, letters[1:]):
            pairs[ord(a), ord(b)] += 1
    language = secrets.fit_secrets(docs, rows=3).language
    assert language.words == set(sorted(words, key=lambda w: (-words[w], w))[: secrets.DICTIONARY_SIZE]) and "rareword" in language.words
    assert np.allclose(language.pairs, -np.log2(pairs / pairs.sum(axis=1, keepdims=True)))
    assert secrets.language_of(none).words == frozenset()


# ---- sentence pieces


def test_ids_and_texts_are_those_of_the_library(spark, odd, none):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [t for _, t in ODD] + [" a", "a  b ", "▁x▁▁y", "日本語 テキスト", "\u0000a\t\n", "é" * 40 + "\U0001f600", "<s> </s>", "x" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in sentencepieces.encode(df, MODEL, end_id=True, decoded=True).collect():
        text = texts[row["doc_id"]] or ""
        ids = library.encode(text, add_eos=True)
        assert (row["ids"], row["decoded"]) == (ids, library.decode(ids))
        assert not text or (row["begins"][0], row["ends"][-1]) == (0, len(text.encode()))
        assert all(a <= b for a, b in zip(row["begins"], row["ends"]))
    assert sentencepieces.encode(odd, MODEL).columns == ["doc_id", "score", "_text", "ids", "begins", "ends"]
    assert sentencepieces.encode(none, MODEL).count() == 0
    back = sentencepieces.decode(spark.createDataFrame([([1, 306, 2],), (None,), ([],), ([200, 0, 259],)], "ids array<int>"), MODEL)
    assert [x["decoded"] for x in back.collect()] == [library.decode([1, 306, 2]), None, "", library.decode([200, 0, 259])]


def compiled_map(rules):
    """A double-array trie and its values, as a model file holds them; small and not packed."""
    values, offsets = b"", {}
    for key, value in rules.items():
        offsets[key] = len(values)
        values += value + b"\0"
    units = {0: 0}
    taken = {0}
    base = 256

    def place(node, prefix):
        nonlocal base
        labels = sorted({k[len(prefix)] for k in offsets if k.startswith(prefix) and len(k) > len(prefix)})
        leaf = prefix in offsets
        own = base
        base += 256
        units[node] = units.get(node, 0) | ((node ^ own) << 10) | (leaf << 8)
        if leaf:
            units[own] = offsets[prefix] | 1 << 31
        taken.update([own])
        for label in labels:
            units[own ^ label] = label
            place(own ^ label, prefix + bytes([label]))

    place(0, b"")
    array = np.zeros(base + 256, "<u4")
    for k, u in units.items():
        array[k] = u
    return len(array.tobytes()).to_bytes(4, "little") + array.tobytes() + values


@pytest.mark.parametrize(("prefix", "squeeze"), [(True, True), (True, False), (False, True)])
def test_compiled_map_keeps_alignment(prefix, squeeze):
    rules = {"ﬁ".encode(): b"fi", b"A": b"a", b"AB": b"xyz", "é".encode(): "e".encode(), b"\t": b" ", "…".encode(): b"...", b"Q": b""}
    parsed = proto.ModelProto()
    with open(MODEL, "rb") as file:
        parsed.ParseFromString(file.read())
    spec = parsed.normalizer_spec
    spec.precompiled_charsmap = compiled_map(rules)
    spec.add_dummy_prefix, spec.remove_extra_whitespaces = prefix, squeeze
    raw = parsed.SerializeToString()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=raw), sentencepieces.PieceModel(raw)
    for text in ["ﬁne ABle…", "  two  \t words ", "AABBA é", "Q", "aQb", "plain", "x\t\ty  "]:
        ids, begins, ends = next(own.encode([text]))
        assert ids.tolist() == library.encode(text)
        assert own.decode(ids) == library.decode(ids.tolist())
        data = text.encode()
        for a, b in zip(begins.tolist(), ends.tolist()):
            data[a:b].decode()


# ---- neighbours


def test_recall_and_exact_order(spark):
    r = np.random.default_rng(4)
    v = r.standard_normal((3000, 16)) + 3 * r.standard_normal((20, 16))[r.integers(0, 20, 3000)]
    v[500:900] = v[500]
    rows = [(k, x.tolist(), "w") for k, x in enumerate(v)]
    rows += [(5000, None, "w"), (5100, [0.0] * 16, "w"), (5200, [float("nan")] * 16, "w"), (5300, [None] + [1.0] * 15, "w"), (None, [1.0] * 16, "w"), (5400, [float("inf")] * 16, "w")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    found = {}
    for x in neighbours.nearest(df, F.col("vec_id") % 100 == 0, fit_rows=1500).orderBy("query_id", "rank").collect():
        found.setdefault(x["query_id"], []).append((x["score"], x["vec_id"]))
    assert sorted(found) == list(range(0, 3000, 100))
    hits = 0
    for q, own in found.items():
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort([np.arange(3000), d]) if k != q][:10]
        assert len(own) == 10 and own == sorted(own)
        assert all(s == pytest.approx(d[k]) for s, k in own)
        hits += len(set(order) & {k for _, k in own})
    assert hits / (10 * len(found)) >= 0.9
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    few = neighbours.nearest(spark.createDataFrame(rows[:3], df.schema), F.lit(True)).collect()
    assert len(few) == 6


# ---- pipeline


def test_pipeline_acts_and_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(21)
    texts = [prose(r, 60) for _ in range(400)]
    for k in range(0, 400, 6):
        texts[k] += " vilewort you grimling vilewort"
    texts[1] = texts[7] + " more"
    item = prose(r, 30)
    texts[13] += " " + item
    texts[25] += " password=Zk83hQ0aPq92LmXx1"
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)] + [(200, None, None, None, None), (7, texts[7], "en", "s", 1), (None, "no id", "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 6 == 0)) for k in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), schema)
    left = {x["doc_id"]: x for x in docs.collect()}
    gone = {k for k in range(0, 400, 6)} | {7, 13}
    assert set(left) == {k for k in range(400)} - gone | {200, None}
    assert left[25]["text"].endswith(f"password={secrets.MARK}") and left[25]["n_chars"] == len(left[25]["text"])
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    assert re.fullmatch(r"[0-9a-f]{64}", corpus_pipeline.encode_pieces(spark, docs, "").first()["ids_sha256"])


def near_copies(rows):
    """Groups of rows, by place, whose shingle sets are linked; all pairs are compared."""
    from tests.llm.test_ngram_join import shingles

    sets = [shingles(t) for t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(rows))]


def test_pipeline_agrees_with_brute_force(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(33)
    texts = [prose(r, r.randrange(20, 90)) for _ in range(260)]
    toxic = set(range(0, 260, 7))
    for k in toxic:
        texts[k] += " vilewort you grimling vilewort nastik you"
    item = prose(r, 30)
    rows = list(enumerate(texts))
    for k in range(1, 250, 9):
        if k not in toxic:
            rows.append((300 + k, texts[k] + r.choice(["", " more words"])))
    rows += [(1, "b " + prose(r, 40)), (7000, None), (7000, ""), (7001, "two words"), (7001, "two words"), (None, texts[2]), (None, "one two three four five six"), (None, "one two three four five six")]
    rows += [(8000, f"{prose(r, 20)} {item} {prose(r, 9)}"), (8001, f"{prose(r, 30)} password=Zk83hQ0aPq92LmXx1"), (8001, f"{prose(r, 30)} nothing here")]
    spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(260)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [(i, t) for i, t in rows if "vilewort" not in (t or "")]
    groups = near_copies([t for _, t in left])
    first = {}
    for (i, t), g in zip(left, groups):
        own = (i is None, i or 0, t or "")
        first[g] = min(first.get(g, own), own)
    kept, used = [], set()
    for (i, t), g in zip(left, groups):
        if first[g] == (i is None, i or 0, t or "") and g not in used:
            used.add(g)
            kept.append((i, t))
    kept = [(i, (t or "").replace("password=Zk83hQ0aPq92LmXx1", f"password={secrets.MARK}")) for i, t in kept if item not in (t or "")]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = []
    for i, t in kept:
        ids = library.encode(t, add_eos=True)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        expected.append((i, len(ids), *digests))
    found = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_outliers_copies_and_repeated_ids_get_all_their_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP_ROWS", 50)
    r = np.random.default_rng(9)
    v = r.standard_normal((900, 8))
    v[::25] = 40 * r.standard_normal((36, 8))
    v[300:600] = v[300]
    rows = [(k, x.tolist()) for k, x in enumerate(v)] + [(0, (v[0] + 1).tolist()), (100, v[100].tolist()), (100, v[100].tolist())]
    found = {}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for x in neighbours.nearest(df, F.col("vec_id") % 100 == 0, fit_rows=700).collect():
        found.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    assert {q: len(own) for q, own in found.items()} == {q: {0: 20, 100: 30}.get(q, 10) for q in range(0, 900, 100)}
    # A vector of 300 copies: the ten smallest ids other than its own.
    assert sorted(found[400]) == [(k + 1, 300 + k, 0.0) for k in range(10)]
    assert sorted(found[300]) == [(k + 1, 301 + k, 0.0) for k in range(10)]
    assert [x for x in sorted(found[100]) if x[0] <= 2] == [(1, 100, 0.0)] * 3 + [(2, 100, 0.0)] * 3
    with pytest.raises(Exception, match="inhomogeneous|same shape"):
        neighbours.nearest(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], df.schema), F.lit(True)).collect()


def test_secret_candidates_have_no_length_limit_and_take_linear_time():
    import time

    token = "x" * 70 + "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    assert secrets.candidates(f"see {token} there") == [(4, 104, "long")]
    assert secrets.candidates(f"{'my_' * 30}token{'_of_mine' * 9}: abcdef123") == [(90 + 5 + 72 + 2, 90 + 5 + 72 + 11, "assigned")]
    r = random.Random(2)
    many = " ".join("".join(r.choices("abcdefghijkl0123456789", k=26)) for _ in range(40_000))
    begin = time.perf_counter()
    assert len(secrets.candidates(many)) > 39_000
    assert len(secrets.candidates("token" * 40_000 + " a=" * 40_000)) == 0
    assert time.perf_counter() - begin < 20


def test_candidates_are_those_of_comparing_all(spark):
    r = random.Random(4)
    for _ in range(200):
        parts = ["password=", "AKIA" + "Q" * 16, "ghp_" + "a1" * 20, "token: ", "x" * 25 + "7", " ", "-", "\"", "abc", "=", "eyJabcdefgh1.abcdefgh1.abcdefgh1", "@"]
        text = "".join(r.choices(parts, k=r.randrange(1, 30)))
        spans = secrets.candidates(text)
        assert spans == sorted(spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        for a, b, kind in spans:
            assert 0 <= a < b <= len(text) and (kind != "long" or re.fullmatch(r"[A-Za-z0-9+/=_-]{20,}", text[a:b]))
        strict = [m.span() for m in secrets._STRICT.finditer(text)]
        assert {s[:2] for s in spans if s[2] in secrets.STRICT} == set(strict)


def test_least_hashed_rows_are_the_same_however_dealt(spark):
    df = spark.range(5000).selectExpr("concat('t', id % 3000) AS t").unionAll(spark.sql("select 'hot' as t from range(3000)"))
    few = [batches.least_hashed(df.repartition(n), 200).collect() for n in (1, 7)]
    assert few[0] == few[1] and len({x["t"] for x in few[0]}) == 200
    assert batches.least_hashed(df, 10_000).count() == 3001
    assert batches.least_hashed(df.limit(0), 5).count() == 0


def test_packed_numbers_come_back():
    r = np.random.default_rng(1)
    for n in (0, 1, 7, 300):
        rows = np.stack([r.integers(0, 2**bits, n, dtype=np.uint64) for bits in (1, 9, 40, 63)])
        assert np.array_equal(block_keys.unpacked(block_keys.packed(rows), n, np.uint64), rows)
    signed = np.array([[-1, 5, -(2**63)], [0, 0, 0]])
    assert np.array_equal(block_keys.unpacked(block_keys.packed(signed), 3, np.int64), signed)
