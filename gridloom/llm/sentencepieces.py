"""SentencePiece BPE encoding with offsets, and decoding.

Normalisation walks the compiled character map of the model, the same way for every model:
at each place the longest key that is a prefix of the rest is replaced by its value, any
other character stays; an empty map leaves all. Every normalised byte keeps the range of
original bytes it came from, so each piece is projected to a span of the original text.

The merges themselves are done on the normalised text by the sentencepiece package, with
the model's own normalisation switched off.

Defined cases: null text counts as empty; an empty text has no piece, only the end id if
asked for. A lone surrogate or broken byte cannot occur in a Spark string.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as proto

from gridloom.llm.batches import arrow_map, fresh, sliced

SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "
REPLACEMENT = "�"
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

codecs.register_error("each_byte", lambda e: (REPLACEMENT * (e.end - e.start), e.end))


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 keys, and the values it points to."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.values = compiled[4 + size :]
        # Length of the key that :meth:`walk` gave the value of.
        self.taken = 0
        root = _offset(self.units[0]) if self.units else 0
        self.begins = np.array([bool(self.units) and self.units[root ^ b] & 0x800000FF == b for b in range(256)])

    def walk(self, data: bytes) -> Iterator[tuple[int, bytes, bool]]:
        """The parts of ``data`` in order: where a part begins, its value, and whether it stays as it is.

        The longest key that is a prefix of the rest is replaced; characters without one stay,
        and go on together up to the next. Only places whose byte can begin a key are looked up.
        """
        at = 0
        for place in np.flatnonzero(self.begins[np.frombuffer(data, np.uint8)]).tolist():
            if place < at:
                continue
            taken, value = self.longest(data, place)
            if taken:
                if place > at:
                    yield at, data[at:place], True
                self.taken, at = taken, place + taken
                yield place, value, False
        if at < len(data):
            yield at, data[at:], True

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest key at ``at`` and its value; length 0 where there is none."""
        units = self.units
        if not units:
            return 0, b""
        found, value = 0, 0
        unit = units[0]
        node = _offset(unit)
        for end in range(at, len(data)):
            byte = data[end]
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found, value = end + 1 - at, units[node] & 0x7FFFFFFF
        if not found:
            return 0, b""
        return found, self.values[value : self.values.index(b"\0", value)]


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 512) >> 6)


class PieceModel:
    """Encoder and decoder of one BPE model file."""

    def __init__(self, model: bytes):
        parsed = proto.ModelProto()
        parsed.ParseFromString(model)
        if parsed.trainer_spec.model_type != proto.TrainerSpec.BPE:
            raise ValueError("only BPE models are read")
        kinds = [p.type for p in parsed.pieces]
        if USER in kinds or UNUSED in kinds or parsed.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("user-defined or unused pieces and whitespace suffixes are not read")
        spec = parsed.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.pieces = [p.piece for p in parsed.pieces]
        self.unknown = kinds.index(UNKNOWN)
        self.end = self.pieces.index(parsed.trainer_spec.eos_piece)
        self.bytes = {k for k, kind in enumerate(kinds) if kind == BYTE}
        self.sizes = np.array([1 if k in self.bytes else len(p.encode()) for k, p in enumerate(self.pieces)])
        self.control = np.array([k == CONTROL for k in kinds])
        self.strips = self.prefix or self.squeeze
        self.surface = [self._surface(p.piece, p.type) for p in parsed.pieces]
        # The same pieces and merges for text that is normalised already.
        spec.precompiled_charsmap = b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.merges = SentencePieceProcessor(model_proto=parsed.SerializeToString())

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return UNKNOWN_SURFACE.encode()
        return bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(SPACE, " ").encode()

    def forget(self) -> None:
        """Empties the word memory."""
        self.words: dict[str, int] = {}
        self.kept = 0
        self.word_ids: list[list[int]] = []
        self.word_bytes: list[list[int]] = []

    def normalised(self, text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The text that is encoded, and for each of its bytes begin and end of the original bytes it stands for."""
        data = text.encode()
        space = (SPACE if self.escape else " ").encode()
        parts, begins, ends = [], [], []
        blank = self.squeeze
        for begin, value, stays in self.map.walk(data):
            for at, run in self._runs(value) if stays and self.squeeze else [(0, value)]:
                dropped = len(run) - len(run.lstrip(b" ")) if blank else 0
                run = run[dropped:]
                if not run:
                    continue
                blank = self.squeeze and run.endswith(b" ")
                codes = np.frombuffer(run, np.uint8)
                if stays:
                    # A byte stands for the whole character it belongs to.
                    first = begin + at + dropped
                    lead = np.flatnonzero(codes & 0xC0 != 0x80)
                    size = np.diff(np.append(lead, len(run)))
                    own, stop = (np.repeat(v, size) for v in (first + lead, first + lead + size))
                else:
                    own, stop = np.full(len(run), begin), np.full(len(run), begin + self.map.taken)
                if len(space) > 1:
                    widths = np.where(codes == 32, len(space), 1)
                    own, stop, run = np.repeat(own, widths), np.repeat(stop, widths), run.replace(b" ", space)
                if not parts and self.prefix:
                    parts.append(space)
                    begins.append(np.full(len(space), own[0]))
                    ends.append(np.full(len(space), own[0]))
                parts.append(run)
                begins.append(own)
                ends.append(stop)
        if data and not parts and self.prefix and not self.squeeze:
            parts, begins, ends = [space], [np.zeros(len(space), np.int64)], [np.full(len(space), len(data))]
        out = b"".join(parts)
        none = np.zeros(0, np.int64)
        begins, ends = (np.concatenate([none, *x]) for x in (begins, ends))
        while self.squeeze and out.endswith(space):
            out = out[: -len(space)]
        return out, begins[: len(out)], ends[: len(out)]

    @staticmethod
    def _runs(value: bytes) -> Iterator[tuple[int, bytes]]:
        """Spaces one by one, and what lies between them."""
        return ((m.start(), m.group()) for m in re.finditer(rb" |[^ ]+", value))

    def encode(self, texts: list[str], end_id: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: ids, and the first and last original byte offset of each piece."""
        normal = [self.normalised(t) for t in texts]
        for (out, begins, ends), ids in zip(normal, self.merges.encode([n.decode() for n, _, _ in normal], num_threads=1), strict=True):
            ids = np.array(ids, np.int32)
            if (ids == self.unknown).any():
                # An unknown piece is as long as the characters it stands for.
                pieces = self.merges.encode(out.decode(), out_type=str)
                sizes = [1 if i in self.bytes else len(p.encode()) for i, p in zip(ids.tolist(), pieces, strict=True)]
            else:
                sizes = self.sizes[ids]
            stops = np.cumsum(sizes, dtype=np.int64)
            first, last = begins[stops - sizes], ends[stops - 1]
            if end_id:
                end = last[-1:] if len(last) else np.zeros(1, np.int64)
                ids, first, last = np.append(ids, np.int32(self.end)), np.append(first, end), np.append(last, end)
            yield ids, first.astype(np.int32), last.astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids, as far as ids keep it."""
        surface = self.surface
        controls = np.flatnonzero(self.control[ids]).tolist()
        ids = ids.tolist()
        parts, at = [], 0
        for stop in [*controls, len(ids)]:
            parts.append(b"".join(map(surface.__getitem__, ids[at:stop])).decode(errors="each_byte"))
            at = stop + 1
        text = "".join(parts)
        if self.strips and text.startswith(" "):
            first = next(i for i in ids if not self.control[i])
            piece = self.pieces[first]
            if piece.startswith(SPACE):
                drop = len(piece) - len(piece.lstrip(SPACE)) if self.squeeze else 1
                return text[drop:]
        return text


_models: dict[int, PieceModel] = {}


def _model(shared) -> PieceModel:
    if shared.id not in _models:
        _models.clear()
        _models[shared.id] = PieceModel(shared.value)
    return _models[shared.id]


class _Shared:
    """The model's bytes, sent to each executor once; their size is that of the file."""

    def __init__(self, df: DataFrame, model_path: str):
        with open(model_path, "rb") as file:
            self._sent = df.sparkSession.sparkContext.broadcast(file.read())
        self.id = self._sent.id if hasattr(self._sent, "id") else id(self._sent)

    @property
    def value(self) -> bytes:
        return self._sent.value


def encode(df: DataFrame, model_path: str, text: str = "text", end_id: bool = True, decoded: bool = False) -> DataFrame:
    """``df`` without ``text``, plus ``ids``, ``begins``, ``ends`` (arrays of int), and ``decoded`` if asked for.

    ``begins`` and ``ends`` are byte offsets of the pieces in the original UTF-8 text, always
    at characters: the pieces of one that falls back to bytes share its span. New columns
    replace old ones of the same name.
    """
    added = ["ids", "begins", "ends"] + ["decoded"] * decoded
    others = [c for c in df.columns if c not in (text, *added)]
    body = fresh("_text", others)
    source = df.select(*[F.col(f"`{c}`") for c in others], F.col(text).alias(body))
    shared = _Shared(df, model_path)
    fields = source.select(*[F.col(f"`{c}`") for c in others])
    lists = "ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * decoded
    schema = fields.schema
    for field in fields.limit(0).selectExpr(*[f"cast(null as {d}) as {n}" for n, d in (x.split(" ", 1) for x in lists.split(", "))]).schema:
        schema = schema.add(field.name, field.dataType)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        model = _model(shared)
        for part in sliced(batch, body):
            columns = {c: part.column(c) for c in others}
            found = list(model.encode([t or "" for t in part.column(body).to_pylist()], end_id))
            offsets = np.cumsum([0, *(len(ids) for ids, _, _ in found)]).astype(np.int32)
            for k, name in enumerate(("ids", "begins", "ends")):
                flat = np.concatenate([f[k] for f in found])
                columns[name] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            if decoded:
                columns["decoded"] = pa.array([model.decode(ids) for ids, _, _ in found], pa.string())
            yield columns

    return arrow_map(source, work, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text of the ``ids`` arrays; a null array gives a null text."""
    shared = _Shared(df, model_path)

    @F.pandas_udf("string")
    def text(column):
        model = _model(shared)
        return column.map(lambda x: None if x is None else model.decode(np.asarray(x, np.int64)))

    return df.withColumn(into, text(F.col(ids)))
