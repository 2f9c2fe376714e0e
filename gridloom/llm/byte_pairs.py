"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

Every byte of a vocabulary entry becomes one printable character, so an entry becomes a
piece; its score is its rank with the sign changed, and normalisation is the identity. The
pair of symbols with the highest score, the leftmost of equals, is then the pair with the
lowest rank. Each match of the split pattern is encoded by itself: its bytes are mapped,
encoded, and piece numbers are ranks. Decoding maps the ids back to the bytes of their pieces.

An entry that its own merges do not lead to is found whole first, as a match that equals an
entry is that entry.

The pattern's classes are those of Unicode 16, as in the tiktoken library. Characters that
became letters or numbers later (unknown to Python's tables and not in ``ADDED_16``) count
as neither; only spans are found with a stand-in for them, the bytes are the text's own.

Defined cases: null text counts as empty; an empty text has no id and decodes to no bytes.
A null list of ids decodes to null, an id outside the vocabulary is an error. Repeated rows
stay; new columns replace old ones of the same name.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as proto

from gridloom.llm.batches import arrow_map, fresh, sliced

# Letters and numbers of Unicode 16, which Python's tables before version 16 do not have.
ADDED_16 = """
1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B
1138E-1138E 11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 116D0-116E3 11BC0-11BE0 11BF0-11BF9
13460-143FA 16100-1611D 16130-16139 16D40-16D6C 16D70-16D79 18CFF-18CFF 1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA
"""
# Stands for a character that is neither letter, number nor blank.
OTHER = "\ue000"
# Characters of matches that a worker keeps the ids of.
MEMORY = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The entries of a rank file: a base64 entry and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, file)}


def byte_characters() -> list[str]:
    """One printable character per byte: printable Latin ones stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def serialised(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose pieces are the entries by ascending rank, and one unknown piece after them."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"bytes without a rank: {missing}")
    characters = byte_characters()
    model = proto.ModelProto()
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.unk_id = len(ranks)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    for entry, rank in sorted(ranks.items(), key=lambda e: e[1]):
        model.pieces.add(piece="".join(map(characters.__getitem__, entry)), score=-rank, type=proto.ModelProto.SentencePiece.NORMAL)
    # A space is no byte's character, so no entry has this name.
    unknown = " unknown "
    model.trainer_spec.unk_piece = unknown
    model.pieces.add(piece=unknown, score=0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    return model.SerializeToString()


def later_characters() -> str:
    """Letters and numbers that came after Unicode 16, as the ranges of a pattern's class."""
    known = {c for a, b in (r.split("-") for r in ADDED_16.split()) for c in range(int(a, 16), int(b, 16) + 1)}
    word = regex.compile(r"[\p{L}\p{N}]")
    later = [c for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn" and c not in known and word.match(chr(c))]
    edges = [k for k in range(len(later)) if not k or later[k] != later[k - 1] + 1]
    return "".join(f"\\U{later[a]:08X}-\\U{later[b - 1]:08X}" for a, b in zip(edges, [*edges[1:], len(later)], strict=True))


class BytePairs:
    """Encoder and decoder over one serialised model."""

    def __init__(self, model: bytes, ranks: np.ndarray, pattern: str, later: str):
        parsed = proto.ModelProto()
        parsed.ParseFromString(model)
        characters = byte_characters()
        self.to_characters = dict(enumerate(characters))
        back = {ord(c): b for b, c in enumerate(characters)}
        pieces = [p.piece for p in parsed.pieces][:-1]
        ids = ranks.tolist()
        self.surface = {i: p.translate(back).encode("latin-1") for i, p in zip(ids, pieces, strict=True)}
        self.whole = {entry: (i,) for i, entry in self.surface.items()}
        self.ids = ids
        self.merges = SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern)
        self.later = regex.compile(f"[{later}]") if later else None
        # The first byte of the least later character.
        self.least = chr(int(later[2:10], 16)).encode()[0] if later else 256
        self.known: dict[str, tuple[int, ...]] = {}
        self.kept = 0

    def _may_be_later(self, text: str) -> bool:
        return not text.isascii() and np.frombuffer(text.encode(), np.uint8).max() >= self.least

    def matches(self, text: str) -> list[str]:
        if self._may_be_later(text) and self.later.search(text):
            spans = [m.span() for m in self.split.finditer(self.later.sub(OTHER, text))]
            return [text[a:b] for a, b in spans]
        return [m.group() for m in self.split.finditer(text)] if self.split.groups else self.split.findall(text)

    def learn(self, words: set[str]) -> None:
        """Encodes matches that are not known yet."""
        new = [w for w in words if w not in self.known]
        if self.kept > MEMORY:
            self.known, self.kept = {}, 0
            new = list(words)
        data = [w.encode() for w in new]
        found = [self.whole.get(d) for d in data]
        rest = [k for k, f in enumerate(found) if f is None]
        mapped = [data[k].decode("latin-1").translate(self.to_characters) for k in rest]
        for k, pieces in zip(rest, self.merges.encode(mapped, num_threads=1) if rest else [], strict=True):
            found[k] = tuple(map(self.ids.__getitem__, pieces))
        self.known.update(zip(new, found, strict=True))
        self.kept += sum(map(len, new))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; what is new in all of them is encoded by one call, as a call has a price."""
        split = [self.matches(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        return [np.array(list(chain.from_iterable(map(self.known.__getitem__, words))), np.int32) for words in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.surface.__getitem__, ids))


_coders: dict[int, BytePairs] = {}


class _Shared:
    """What a worker builds its coder from, sent to each executor once; its size is that of the rank file."""

    def __init__(self, df: DataFrame, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        parts = (serialised(ranks), np.array(sorted(ranks.values()), np.int64), pattern, later_characters())
        self.sent = df.sparkSession.sparkContext.broadcast(parts)
        self.key = uuid.uuid4().int

    def coder(self) -> BytePairs:
        if self.key not in _coders:
            _coders.clear()
            _coders[self.key] = BytePairs(*self.sent.value)
        return _coders[self.key]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` without ``text``, plus ``ids`` (array of int) and, if asked for, ``decoded`` (binary, from the ids)."""
    added = ["ids"] + ["decoded"] * decoded
    others = [c for c in df.columns if c not in (text, *added)]
    body = fresh("_text", others)
    source = df.select(*[F.col(f"`{c}`") for c in others], F.col(text).alias(body))
    shared = _Shared(df, ranks_path, pattern)
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add("decoded", T.BinaryType())

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        coder = shared.coder()
        for part in sliced(batch, body):
            found = coder.encode_all([t or "" for t in part.column(body).to_pylist()])
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            columns = {c: part.column(c) for c in others}
            columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            if decoded:
                columns["decoded"] = pa.array([coder.decode(ids.tolist()) for ids in found], pa.binary())
            yield columns

    return arrow_map(source, work, schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the ``ids`` arrays."""
    shared = _Shared(df, ranks_path, pattern)

    @F.pandas_udf("binary")
    def text(column: pd.Series) -> pd.Series:
        coder = shared.coder()
        return column.map(lambda x: None if x is None else coder.decode([int(i) for i in x]))

    return df.withColumn(into, text(F.col(ids)))
