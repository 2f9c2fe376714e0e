"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of each text. A place is a cut where the hash falls
under a limit and no such place lies within ``LEAST`` bytes before it; both depend on
the nearby bytes only, so an insertion moves no cut beyond its neighbourhood. Chunks
are compared by a 128-bit digest over all documents. A run of neighbouring repeated
chunks counts from ``LEAST_RUN`` bytes on, as short phrases repeat by chance. Of each
repeated chunk the one in the document with the smallest id stays; elsewhere it goes with
neighbours that go too, again from ``LEAST_RUN`` bytes on. Documents lie in blocks, which
ask for their distinct chunks (:mod:`gridloom.llm.block_keys`); a chunk that a third of the
corpus holds travels once a block.

Defined cases: null text counts as empty, with no chunk. Rows with a null id are cut but
not compared, and keep their text. Rows that share an id are treated alike: a chunk first
seen under that id stays in each of them. A chunk repeated inside a document stays once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import block_keys
from gridloom.llm.batches import sliced, text_bytes
from gridloom.llm.components import written
from gridloom.sources.staging import new_folder

# The chunks at both edges of a repeated passage are lost, so they are small: of a passage of
# 51 words, short ones too, a run of LEAST_RUN is left.
MEAN, LEAST, MOST = 12, 8, 1024
LEAST_RUN = 48

_GEAR = np.random.default_rng(0x6EA2).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The 32-bit gear hash after every byte: ``h = (h << 1) + GEAR[byte]``, all at once by doubling."""
    h = _GEAR[data]
    width = 1
    while width < 32:
        before = h.copy()
        h[width:] += before[:-width] << np.uint32(width)
        width *= 2
    return h


def cuts(data: np.ndarray, mean: int = MEAN) -> np.ndarray:
    """Ends of the chunks of one text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    places = np.flatnonzero(gear(data) < np.uint32(2**32 // mean)) + 1
    if len(places):
        places = places[np.diff(places, prepend=-LEAST) >= LEAST]
    ends = np.unique(np.append(places[places < n], n))
    gaps = np.diff(ends, prepend=0)
    if (gaps > MOST).any():
        starts = ends - gaps
        ends = np.unique(np.concatenate([ends, *(np.arange(a + MOST, b, MOST) for a, b in zip(starts[gaps > MOST], ends[gaps > MOST], strict=True))]))
    return ends


def chunk_digests(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row the ends of its chunks and their digests, two 64-bit words each."""
    for part in sliced(rows, "text"):
        data, offsets = text_bytes(part.column("text"))
        whole = data.tobytes()
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            ends = cuts(data[a:b])
            at = [a, *(ends + a).tolist()]
            digests = b"".join([xxhash.xxh3_128_digest(whole[x:y]) for x, y in pairwise(at)])
            yield ends, np.frombuffer(digests, np.uint64).reshape(-1, 2)


def asked(rows: pa.RecordBatch) -> list[block_keys.Keys]:
    """The distinct chunks of the rows that have an id, with how often they come and the least id."""
    ids, known = row_ids(rows)
    found = [(d, k) for k, (_, d) in enumerate(chunk_digests(rows)) if known[k] and len(d)]
    if not found:
        return []
    digests = np.concatenate([d for d, _ in found]).T
    owners = np.repeat(ids[[k for _, k in found]], [len(d) for d, _ in found])
    order, starts, _ = distinct(digests)
    times = np.diff(np.append(starts, len(order)))
    return [(digests[:, order[starts]], np.stack([times, np.minimum.reduceat(owners[order], starts)]))]


def row_ids(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.column("id")
    return pc.fill_null(ids, 0).to_numpy(), pc.is_valid(ids).to_numpy(zero_copy_only=False)


def distinct(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts digests, where each distinct one begins in it, and the number of each digest's group."""
    order = np.lexsort(digests[::-1])
    new = np.append(True, (digests[:, order[1:]] != digests[:, order[:-1]]).any(axis=0))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


def merged(kind: int, figures: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Whether a chunk is repeated, and if so the least id that has it."""
    repeated = figures[0] > 1
    return np.stack([repeated.astype(np.int64), np.where(repeated, figures[1], 0)]), []


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", least_run: int = LEAST_RUN, folder: str | None = None) -> DataFrame:
    """Id, kept ``text`` (bytes), ``n_bytes``, ``n_chunks``, ``n_shared`` and ``n_removed`` bytes, ``kept_sha256``; one row per row.

    ``n_shared`` counts the bytes of runs that are repeated, ``n_removed`` those that go. The
    result reads the blocks staged in ``folder``, which goes with the session if not given.
    """
    folder = folder or new_folder(docs.sparkSession, "chunks")
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    blocks = block_keys.in_blocks(source, "texts", folder)
    sent = block_keys.requests(blocks, asked, block_keys.bucket_count(blocks))
    seen = written(block_keys.replies(sent, 2, [[np.add, np.minimum]], merged), "seen", folder)
    schema = "doc_id long, text binary, n_bytes long, n_chunks long, n_shared long, n_removed long, kept_sha256 string"
    made = block_keys.answered(blocks, seen, lambda rows, found: cut_down(rows, found[0], least_run), 1, schema)
    return made.withColumnRenamed("doc_id", id)


def cut_down(rows: pa.RecordBatch, seen: np.ndarray, least_run: int) -> dict:
    """The rows of a block without their repeated runs, from the answers for its distinct chunks."""
    ids, known = row_ids(rows)
    found = list(chunk_digests(rows))
    with_id = [d for k, (_, d) in enumerate(found) if known[k]]
    digests = np.concatenate([*with_id, np.zeros((0, 2), np.uint64)]).T
    group = distinct(digests)[2] if digests.shape[1] else np.zeros(0, np.int64)
    figures: dict[str, list[int]] = {k: [] for k in ("n_bytes", "n_chunks", "n_shared", "n_removed")}
    kept, at = [], 0
    for k, (text, (ends, own)) in enumerate(zip(rows.column("text").to_pylist(), found, strict=True)):
        data = (text or "").encode()
        held, removed = 0, []
        if known[k] and len(own):
            mine = group[at : at + len(own)]
            at += len(own)
            shared = np.flatnonzero(seen[0][mine])
            if len(shared):
                again = np.ones(len(mine), bool)
                again[np.unique(mine, return_index=True)[1]] = False
                begins = np.append(0, ends[:-1])
                goes = (seen[1][mine] != ids[k]) | again
                held, removed = counted_runs(begins[shared].tolist(), (ends - begins)[shared].tolist(), goes[shared].tolist(), least_run)
        kept.append(without(data, removed))
        for name, value in zip(figures, (len(data), len(ends), held, len(data) - len(kept[-1])), strict=True):
            figures[name].append(value)
    return {
        "doc_id": rows.column("id"),
        "text": pa.array(kept, pa.binary()),
        **{c: pa.array(v, pa.int64()) for c, v in figures.items()},
        "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
    }


def without(data: bytes, removed: list[tuple[int, int]]) -> bytes:
    edges = [0, *chain.from_iterable(removed), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def counted_runs(begins: list[int], sizes: list[int], leaves: list[bool], least_run: int = LEAST_RUN) -> tuple[int, list[tuple[int, int]]]:
    """Bytes in runs of at least ``least_run``, and the spans of those that go."""
    held, removed, run = 0, [], []
    for chunk in [*zip(begins, sizes, leaves, strict=True), None]:
        if run and (chunk is None or chunk[0] != run[-1][0] + run[-1][1]):
            size = sum(s for _, s, _ in run)
            if size >= least_run:
                held += size
                # A short phrase first seen elsewhere stays where the passage itself stays.
                for goes, part in groupby(run, key=lambda c: c[2]):
                    span = list(part)
                    begin, end = span[0][0], span[-1][0] + span[-1][1]
                    if goes and end - begin >= least_run:
                        removed.append((begin, end))
            run = []
        run.append(chunk)
    return held, removed
