"""Figures of keys over a whole corpus, asked for and answered by blocks of rows.

Rows are written once in blocks of bounded size. For each block a task works out its
distinct keys (hashes of word pairs, digests of chunks) with their figures in it, cuts them
into buckets by value and sends one packed row a bucket. All rows of a bucket meet, equal
keys are merged (sums, minima), and every row gets the merged figures back in its own order
without the keys: the block works them out again from its texts and reads the answer in line.

A key comes once a block however often the block holds it, so a hot key makes one entry a
block, and buckets are ranges of hashes, so they fill evenly; their number grows with the
corpus. A block that two tasks read in parts is asked for in parts, each by its row numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.batches import SLICE_BYTES, sliced
from gridloom.llm.components import written

# Text bytes and rows of a block, and text bytes whose keys come to one bucket.
BLOCK_BYTES, BLOCK_ROWS, BUCKET_BYTES = 4 << 20, 1 << 16, 4 << 20

# Sorted distinct keys, one row per 64-bit word of them, and their figures, one row per figure.
Keys = tuple[np.ndarray, np.ndarray]

REQUEST = "block long, first int, rows int, kind int, bucket int, n int, keys binary, figures binary"
REPLY = "block long, first int, rows int, kind int, bucket int, n int, figures binary, stats array<long>"


def packed(rows: np.ndarray) -> bytes:
    """Rows of 64-bit numbers, each with as many bytes a number as its largest one needs, after their count; low bytes first."""
    parts = []
    for row in rows:
        row = np.ascontiguousarray(row).view(np.uint64)
        width = max(1, -(-int(row.max(initial=0)).bit_length() // 8))
        parts += [bytes([width]), row.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    return b"".join(parts)


def unpacked(data: bytes, n: int, dtype: type) -> np.ndarray:
    """The rows of :func:`packed`, of ``n`` numbers each."""
    rows, at = [], 0
    while at < len(data):
        width = data[at]
        row = np.zeros((n, 8), np.uint8)
        row[:, :width] = np.frombuffer(data, np.uint8, width * n, at + 1).reshape(width, n).T
        rows.append(row.view(dtype)[:, 0])
        at += 1 + width * n
    return np.stack(rows)


def in_blocks(source: DataFrame, name: str, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``source`` (with a column ``text``) written with ``block`` and ``at``, the row's number in its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at, held = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            for part in sliced(batch, "text", min(block_bytes, SLICE_BYTES)):
                size = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if at and (held + size > block_bytes or at + part.num_rows > BLOCK_ROWS):
                    block, at, held = block + 1, 0, 0
                n = part.num_rows
                where = [pa.array(np.full(n, block)), pa.array(np.arange(at, at + n, dtype=np.int32))]
                yield pa.RecordBatch.from_arrays([*where, *part.columns], names=["block", "at", *part.schema.names])
                at, held = at + n, held + size

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("at", T.IntegerType()), *source.schema.fields])
    # Texts are the larger part of what is on disk later.
    return written(source.mapInArrow(run, schema), name, folder, compression="zstd")


def bucket_count(blocks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    size = blocks.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, -(-size // bucket_bytes))


def requests(blocks: DataFrame, ask: Callable[[pa.RecordBatch], list[Keys]], buckets: int) -> DataFrame:
    """One row per part of a block, kind of keys (place in the list of ``ask``) and bucket."""

    def asked(rows: pa.RecordBatch) -> Iterator[dict]:
        at = rows.column("at")
        where = {"block": rows.column("block")[0].as_py(), "first": at[0].as_py(), "rows": rows.num_rows}
        for kind, (keys, figures) in enumerate(ask(rows)):
            edges = np.flatnonzero(np.diff(bucket_of(keys[0], buckets), prepend=-1, append=buckets))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                gaps = np.diff(keys[0, a:b], prepend=np.uint64(0))
                bucket = int(bucket_of(keys[0, a : a + 1], buckets)[0])
                yield where | {"kind": kind, "bucket": bucket, "n": b - a, "keys": packed(gaps[None]) + packed(keys[1:, a:b]), "figures": packed(figures[:, a:b])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_blocks(batches):
            found = list(asked(rows))
            if found:
                columns = {c: [f[c] for f in found] for c in found[0]}
                kinds = {"block": pa.int64(), "keys": pa.binary(), "figures": pa.binary()}
                yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int32())) for c, v in columns.items()})

    return blocks.mapInArrow(run, REQUEST)


def bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of one block put together, as far as the task holds them."""
    held: list[pa.RecordBatch] = []

    def together() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, at = batch.column("block").to_numpy(), batch.column("at").to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(at) != 1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
            if held:
                last = held[-1].slice(held[-1].num_rows - 1)
                if last.column("block")[0].as_py() != blocks[a] or last.column("at")[0].as_py() + 1 != at[a]:
                    yield together()
                    held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield together()


def replies(asked: DataFrame, words: int, merges: list[list[np.ufunc]], reply: Callable[[int, np.ndarray], tuple[np.ndarray, list[int]]]) -> DataFrame:
    """Answers to :func:`requests`, with keys of ``words`` words.

    ``merges`` has one function per figure of each kind; ``reply`` makes the figures to send
    back from the merged ones of a bucket, and numbers about the bucket (``stats``).
    """

    def work(key: tuple, table: pa.Table) -> pa.Table:
        kind = key[0].as_py()
        sizes = table.column("n").to_numpy()
        parts = [unpacked(k.as_py(), n, np.uint64) for k, n in zip(table.column("keys"), sizes.tolist(), strict=True)]
        keys = np.concatenate([np.concatenate([np.cumsum(p[:1], axis=1, dtype=np.uint64), p[1:]]) for p in parts], axis=1)
        figures = np.concatenate([unpacked(f.as_py(), n, np.int64) for f, n in zip(table.column("figures"), sizes.tolist(), strict=True)], axis=1)
        order = np.argsort(keys[0], kind="stable") if words == 1 else np.lexsort(keys[::-1])
        new = np.append(True, (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0))
        starts = np.flatnonzero(new)
        merged = np.stack([f.reduceat(row[order], starts) for f, row in zip(merges[kind], figures, strict=True)])
        sent, stats = reply(kind, merged)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        ends = np.cumsum(sizes)
        out = [packed(sent[:, group[b - n : b]]) for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        kept = table.select(["block", "first", "rows", "kind", "bucket", "n"])
        return kept.append_column("figures", pa.array(out, pa.binary())).append_column("stats", pa.array([stats] * len(out), pa.list_(pa.int64())))

    return asked.groupBy("kind", "bucket").applyInArrow(work, REPLY)


def answered(blocks: DataFrame, answers: DataFrame, work: Callable[[pa.RecordBatch, list[np.ndarray]], dict], kinds: int, schema: T.StructType | str) -> DataFrame:
    """What ``work`` makes of the rows of each part of a block and the answers to each kind of its keys, in their order."""

    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        rows = rows.sort_by("at").combine_chunks()
        replies = replies.sort_by([("first", "ascending"), ("kind", "ascending"), ("bucket", "ascending")])
        by_part: dict[int, list[list[np.ndarray]]] = {}
        for first, kind, n, figures in zip(*(replies.column(c).to_pylist() for c in ("first", "kind", "n", "figures")), strict=True):
            by_part.setdefault(first, [[] for _ in range(kinds)])[kind].append(unpacked(figures, n, np.int64))
        lengths = dict(zip(replies.column("first").to_pylist(), replies.column("rows").to_pylist(), strict=True))
        made, at = [], 0
        none = np.zeros((0, 0), np.int64)
        for first in [*sorted(lengths), rows.num_rows]:
            # Rows that no reply covers hold no key.
            spans = [(at, first, [none] * kinds)]
            if first in lengths:
                spans.append((first, first + lengths[first], [np.concatenate(f, axis=1) if f else none for f in by_part[first]]))
            for a, b, found in spans:
                if b > a:
                    made.append(pa.table(work(rows.slice(a, b - a).to_batches()[0], found)))
                at = max(at, b)
        return pa.concat_tables(made)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
