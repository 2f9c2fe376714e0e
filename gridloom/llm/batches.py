"""Arrow batches cut to bounded slices, and vectorised hashes of bytes and words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text bytes handled at a time in a task; a longer text makes a slice of its own.
SLICE_BYTES = 2 << 20
# Those whose words are hashed at a time: spans, sums and powers take some fifty times as much.
HASHED_BYTES = 512 << 10

_RANDOM = np.random.default_rng(0x5EED)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]
_STEP = int(_RANDOM.integers(1, 2**62)) * 2 + 1
_BACK = pow(_STEP, -1, 2**64)
# Bytes of the words ``[^\\x20\\x09-\\x0D]+``, and of runs of ASCII letters, digits and all other scripts.
NOT_BLANK = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
ALPHANUMERIC = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` with one call per input batch; ``work`` yields column dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


def least_hashed(rows: DataFrame, n: int) -> DataFrame:
    """About the ``n`` distinct rows with the least hash, at most ``n``: a sample for the driver.

    Hashes spread evenly, so their number tells under which hash ``n`` of them lie. Only rows
    under it are sorted and sent, however many tasks there are; copies of a row count once.
    """
    by = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    count = rows.agg(F.approx_count_distinct(by, 0.02)).first()[0]
    share = (1.1 * n + 6 * n**0.5 + 20) / max(count, 1)
    if share < 1:
        rows = rows.where(by < F.lit(int(-(2**63) + share * 2**64)))
    return rows.distinct().orderBy(by, *rows.columns).limit(n)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def sliced(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with at most ``limit`` bytes of text each, or one row."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column, and the n + 1 offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """``base ** 0 .. base ** (count - 1)`` modulo 2 ** 64, kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        known = np.ones(1, np.uint64)
        while len(known) < count:
            known = np.concatenate([known, known * np.uint64(pow(base, len(known), 2**64))])
        _powers[base] = known
    return known[:count]


def prefix_sums(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Sums from which :func:`span_hashes` takes the hash of any byte range."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[data] * powers(_STEP, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the ranges, equal for equal bytes wherever they lie."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    back = powers(_BACK, len(sums))
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``member`` bytes, and the first run of each row (n + 1 entries)."""
    inside = member[data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """Per row the sorted distinct 64-bit hashes of its lower-cased word shingles.

    A row with fewer words gives the hash of all its words, a row without words none.
    """
    data, offsets = text_bytes(column)
    starts, ends, firsts = word_spans(data, offsets)
    words = span_hashes(prefix_sums(data, lower=True), starts, ends)
    rolled = joined_hashes(words, width)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            whole = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mixed(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def joined_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` neighbouring words; rows are not told apart."""
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled += words[k : k + len(rolled)] * _PLACE[k]
    return mixed(rolled)


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)
