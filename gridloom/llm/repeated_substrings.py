"""Repeated byte strings of all texts, found by suffix arrays over the places that can repeat.

Every window of ``LENGTH`` bytes has an anchor: of its strings of ``ANCHOR`` bytes the
one with the least hash, leftmost first. Equal windows have equal anchors at the same
place, so only texts' segments around a common anchor need to be compared. Neighbouring
windows of one anchor make a segment.

Segments that are equal byte for byte repeat as a whole. Different segments of one anchor
go to one task group. There, suffixes with an equal start of ``LENGTH`` bytes form the
outer intervals of an enhanced suffix array; each is sorted, and a stack scan over the
longest common prefixes of neighbours yields its interval tree. An interval whose
occurrences are preceded by different bytes is a maximal repeat and is given out with
all of them (:func:`maximal_repeats`); all others lie inside such a one.

An anchor with many different segments is dealt to pairs of blocks, so that no group
outgrows a task.

Defined cases: null text counts as empty; texts shorter than ``LENGTH`` keep all bytes.
Repeated rows, with or without an id, repeat each other. Overlapping occurrences inside a
text count. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.batches import arrow_map, mixed, prefix_sums, signed, sliced, span_hashes, text_bytes
from gridloom.sources.staging import staged

LENGTH, ANCHOR = 200, 50
# Different segments of one anchor that are compared at once.
BLOCK = 6_000
# Bytes of segments in one suffix array.
ARRAY_BYTES = 4 << 20

_PLACE_BITS = np.uint64(31)


def anchored(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of all rows: first window, number of windows, hash of the anchor."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, np.zeros(0, np.uint64)
    at = np.arange(n - anchor + 1)
    hashes = span_hashes(prefix_sums(data), at, at + anchor)
    # Order by hash, then place: both depend on the window's bytes alone.
    keys = (hashes & ~((np.uint64(1) << _PLACE_BITS) - np.uint64(1))) | at.astype(np.uint64)
    width = length - anchor + 1
    blocks = -(-len(keys) // width)
    grid = np.full(blocks * width, np.iinfo(np.uint64).max)
    grid[: len(keys)] = keys
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - length + 1)
    least = np.minimum(behind[starts], ahead[starts + width - 1])
    place = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    # Windows may not reach into the next row.
    row_end = offsets[1:][np.searchsorted(offsets[1:], starts, side="right")]
    starts, place = starts[starts + length <= row_end], place[starts + length <= row_end]
    if not len(starts):
        return none, none, np.zeros(0, np.uint64)
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (np.diff(place) != 0)
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), hashes[place[first]]


def segments(docs: DataFrame) -> DataFrame:
    """``h``, digest ``s1``, ``s2``, row key, ``a`` (first byte), ``n`` (windows) of every segment."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            first, count, h = anchored(data, offsets)
            whole = data.tobytes()
            digests = b"".join(xxhash.xxh3_128_digest(whole[a : a + c + LENGTH - 1]) for a, c in zip(first.tolist(), count.tolist(), strict=True))
            halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
            row = np.searchsorted(offsets[1:], first, side="right")
            yield {
                "h": signed(mixed(h)),
                "s1": np.ascontiguousarray(halves[:, 0]),
                "s2": np.ascontiguousarray(halves[:, 1]),
                "k1": part.column("k1").to_numpy()[row],
                "k2": part.column("k2").to_numpy()[row],
                "a": (first - offsets[row]).astype(np.int32),
                "n": count.astype(np.int32),
            }

    return arrow_map(docs.select("k1", "k2", "text"), work, "h long, s1 long, s2 long, k1 long, k2 long, a int, n int")


def maximal_repeats(suffixes: list[tuple[bytes, int]], least: int = LENGTH) -> Iterator[tuple[int, list[int]]]:
    """Length and members of every maximal repeat among suffixes given with the byte before each (-1: none).

    Members are places in the list, in the order of the suffix array.
    """
    order = sorted(range(len(suffixes)), key=lambda k: suffixes[k][0])
    lcp = [common_prefix(suffixes[x][0], suffixes[y][0]) for x, y in zip(order, order[1:], strict=False)]
    # An open interval: its common length, first place, a byte before its members, whether those differ.
    stack: list[list] = []
    for k, common in enumerate([*lcp, 0], 1):
        byte = suffixes[order[k - 1]][1]
        # What joins the interval below: this suffix, or the intervals that end with it.
        start, differs = k - 1, byte < 0
        if stack and stack[-1][0] >= max(common, 1) and stack[-1][0] >= (lcp[k - 2] if k > 1 else 0):
            stack[-1][3] |= differs or byte != stack[-1][2]
        while stack and stack[-1][0] > common:
            length, start, byte, differs = stack.pop()
            if differs:
                yield length, order[start:k]
            if stack and stack[-1][0] >= common:
                stack[-1][3] |= differs or byte != stack[-1][2]
        if common >= least and (not stack or stack[-1][0] < common):
            stack.append([common, start, byte, differs])


def common_prefix(x: bytes, y: bytes) -> int:
    size = min(len(x), len(y))
    if x[:size] == y[:size]:
        return size
    return int((np.frombuffer(x, np.uint8, size) != np.frombuffer(y, np.uint8, size)).argmax())


def repeats_in(groups: list[int], texts: list[bytes], least: int = LENGTH) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeats among texts of the same group: length, and (text, place) of all occurrences.

    Occurrences at the start of a text count as preceded by different bytes.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - least + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begins[owner] + place
    keys = span_hashes(prefix_sums(data), at, at + least) ^ mixed(np.array(groups, np.uint64) + np.uint64(1))[owner]
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(order)))
    byte = np.where(place > 0, data[np.maximum(at - 1, 0)].astype(np.int64), -1)[order]
    if not len(order):
        return
    # Left extension: where all occurrences follow one and the same byte, a longer repeat covers them.
    alike = (np.maximum.reduceat(byte, first) == np.minimum.reduceat(byte, first)) & (byte[first] >= 0)
    for k in np.flatnonzero((count > 1) & ~alike).tolist():
        members = order[first[k] : first[k] + count[k]]
        found = [(int(owner[m]), int(place[m])) for m in members]
        suffixes = [(texts[t][p:], int(texts[t][p - 1]) if p else -1) for t, p in found]
        for length, own in maximal_repeats(suffixes, least):
            yield length, [found[j] for j in own]


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``begin``, ``end`` of byte ranges covered by repeats, of rows keyed ``k1``, ``k2``."""
    every = segments(docs)
    often = staged(every.groupBy("h").count().where("count > 1").select("h"), "anchors")
    met = staged(every.join(often, "h"), "met")
    # Any occurrence serves as the example of a segment; the table is written, so it stays the same.
    kinds = met.groupBy("h", "s1", "s2").agg(
        F.count("*").alias("times"), F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("a").alias("a"), F.first("n").alias("n")
    )
    kinds = staged(kinds, "kinds")
    same = met.join(kinds.where("times > 1").select("h", "s1", "s2"), ["h", "s1", "s2"])
    same = same.select("k1", "k2", F.col("a").alias("begin"), (F.col("a") + F.col("n") + LENGTH - 1).alias("end"))

    several = staged(kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1"), "several")
    blocks = F.ceil(F.col("kinds") / BLOCK).cast("int")
    rest = kinds.join(several, "h").withColumn("blocks", blocks).withColumn("block", F.pmod("s1", "blocks").cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("h", "times", "k1", "k2", "a", "n", "s1", "s2", F.least("block", "other").alias("u"), F.greatest("block", "other").alias("v"))
    cut = F.substring(F.col("text").cast("binary"), F.col("a") + 1, F.col("n") + LENGTH - 1)
    full = docs.join(rest.hint("shuffle_hash"), ["k1", "k2"]).select("h", "u", "v", "s1", "s2", "times", "k1", "k2", "a", cut.alias("bytes"))
    full = full.repartition("h", "u", "v").sortWithinPartitions("h", "u", "v", "s1", "s2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, number, key = 0, 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h", "u", "v", "s1", "s2", "times", "k1", "k2", "a", "bytes")]
            for h, u, v, s1, s2, times, k1, k2, a, raw in zip(*columns, strict=True):
                if (h, u, v) != key:
                    if size > ARRAY_BYTES:
                        yield _covered(held)
                        held, size = [], 0
                    key, number = (h, u, v), number + 1
                # Rows that are wholly alike bring their segment once.
                if not held or held[-1][:3] != (number, s1, s2):
                    held.append((number, s1, s2, times, k1, k2, a, raw))
                    size += len(raw)
        yield _covered(held)

    other = full.mapInArrow(run, "k1 long, k2 long, begin int, end int")
    return same.unionByName(other)


def _covered(held: list[tuple]) -> pa.RecordBatch:
    """Spans of the segments that occur once, overlapping ones of a row in one."""
    spans: dict[tuple[int, int], set[tuple[int, int]]] = {}
    if held:
        for length, found in repeats_in([g for g, *_ in held], [row[-1] for row in held]):
            for text, place in found:
                _, _, _, times, k1, k2, a, _ = held[text]
                if times == 1:
                    spans.setdefault((k1, k2), set()).add((a + place, a + place + length))
    rows = []
    for key, own in spans.items():
        end = -1
        for begin, stop in sorted(own):
            if begin <= end:
                end = max(end, stop)
                rows[-1] = (*key, rows[-1][2], end)
            else:
                end = stop
                rows.append((*key, begin, stop))
    names, kinds = ("k1", "k2", "begin", "end"), (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = list(zip(*sorted(rows), strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, kept ``text`` (bytes), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``; one row per row."""
    # A row's key holds its text's hash, so rows that share an id are told apart.
    keyed = docs.select(
        F.col(id).alias("doc_id"),
        F.coalesce(F.col(id).cast("long"), F.lit(-(2**63))).alias("k1"),
        F.xxhash64(F.col(text)).alias("k2"),
        F.col(text).alias("text"),
    )
    spans = repeated_spans(keyed).groupBy("k1", "k2").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    joined = keyed.join(spans, ["k1", "k2"], "left").select("doc_id", "text", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in sliced(batch, "text"):
            kept, counts = [], []
            for t, begins, ends in zip(*(part.column(c).to_pylist() for c in ("text", "begins", "ends")), strict=True):
                data = np.frombuffer((t or "").encode(), np.uint8)
                change = np.zeros(len(data) + 1, np.int64)
                if begins:
                    np.add.at(change, begins, 1)
                    np.add.at(change, ends, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept.append(data[~gone].tobytes())
                runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                counts.append((len(data), int(gone.sum()), runs))
            yield {
                "doc_id": part.column("doc_id"),
                "text": pa.array(kept, pa.binary()),
                **{c: pa.array([x[k] for x in counts], pa.int64()) for k, c in enumerate(("n_bytes", "n_removed", "n_spans"))},
                "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
            }

    schema = f"doc_id {docs.schema[id].dataType.simpleString()}, text binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return arrow_map(joined, work, schema).withColumnRenamed("doc_id", id)
