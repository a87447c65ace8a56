"""SentencePiece encoding and decoding that keeps source offsets (operator 12).

A text is normalised first: at every position the longest prefix that the
model's compiled character map knows is replaced (the map is a double-array
trie over byte strings; without a match one character stays), white space is
folded and escaped as the model says, and for every normalised byte the source
byte of its character is recorded. The normalised text is encoded without any
further normalisation, and the pieces, which cover it byte by byte, are projected
through that record to spans of the original UTF-8 bytes. The pieces of one
character (byte fallback) end where it starts, the last where it ends, as in the
library; begin and end ids have empty spans at the ends of the text.

No piece of such a vocabulary holds a word's start behind something else (this
is checked), so no merge crosses the start of a word: texts are encoded in slices
that begin with a word, and neither time nor memory of a long text grows faster
than its length. Vocabularies of another kind are encoded text by text. Decoding
takes the ids in stretches that begin with a word.

Defined cases: null text is the empty text (begin and end id alone, decoded empty);
very long texts are read whole; null and repeated ids are rows like any other; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, worker_cache
from tidemark.session import ship_by_value

SPACE = "▁"              # the escaped space
SPACE_BYTES = SPACE.encode()
WORD_START = re.compile(f"(?<!{SPACE}){SPACE}")
SLICE = 1 << 16               # characters encoded at once, about
DECODE_IDS = 1 << 16          # ids decoded at once, about
BATCH_BYTES = 1 << 24         # of the columns handed back at once, about

# Fields of the public model format (message, field number) and kinds of pieces.
PIECE, NORMALIZER = 1, 3
TEXT, KIND = 1, 3
CHARACTER_MAP, DUMMY_PREFIX, FOLD_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
UNKNOWN, USER_DEFINED, BYTE = 2, 4, 6


# ---- the model file ----

def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 128:
            return value, at


def as_varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out + bytes([value]))


def fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, the field's own bytes) of a serialised message."""
    at = 0
    while at < len(data):
        start = at
        tag, at = varint(data, at)
        if tag & 7 == 0:
            value, at = varint(data, at)
        else:
            size, at = varint(data, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value, data[start:at]


# ---- normalisation with source alignment ----

class CharacterMap:
    """The compiled map: size of the trie, its 32-bit units, then the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size:]
        self.first = frozenset(b for b in range(256) if self.child(0, b) is not None) if size else frozenset()

    @staticmethod
    def offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def child(self, node: int, byte: int) -> int | None:
        at = node ^ self.offset(self.units[node]) ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``data[at:]``."""
        node, found = 0, None
        for i in range(at, len(data)):
            node = self.child(node, data[i])
            if node is None:
                break
            unit = self.units[node]
            if unit & 256:  # a key ends here; its value lies at the node's offset
                found = i + 1 - at, self.units[node ^ self.offset(unit)] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1]:self.texts.index(0, found[1])]


class Normalizer:
    """Normalised bytes of a text and, for each of them and the end, the source byte."""

    def __init__(self, spec: bytes, symbols: list[bytes]):
        own = {n: v for n, v, _ in fields(spec)}
        self.map = CharacterMap(bytes(own.get(CHARACTER_MAP, b"")))
        self.prefix, self.fold, self.escape = (bool(own.get(n, 1)) for n in (DUMMY_PREFIX, FOLD_SPACES, ESCAPE_SPACES))
        self.symbols = re.compile(b"|".join(map(re.escape, sorted(symbols, key=len, reverse=True)))) if symbols else None
        self.changing = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in sorted(self.map.first)) + b"]") if self.map.first else None

    def mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The text after the character map, and the source byte of each of its bytes."""
        raw = np.frombuffer(data, np.uint8)
        origin = np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, np.arange(len(raw), dtype=np.int32), np.int32(0)))
        if self.symbols is None and (self.changing is None or not self.changing.search(data)):
            return data, origin
        texts, origins, at, kept = [], [], 0, 0
        while at < len(data):
            symbol = self.symbols.match(data, at) if self.symbols else None
            found = None if symbol or data[at] not in self.map.first else self.map.longest(data, at)
            if found is None:
                at += len(symbol.group()) if symbol else 1 if data[at] < 0xC0 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                continue
            texts += [data[kept:at], found[1]]
            origins += [origin[kept:at], np.full(len(found[1]), at, np.int32)]
            at += found[0]
            kept = at
        return b"".join([*texts, data[kept:]]), np.concatenate([*origins, origin[kept:]])

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not data:
            return b"", np.zeros(1, np.int64)
        text, origin = self.mapped(data)
        end = len(data)
        if self.fold:  # no space at the start, after a space, or at the end
            blank = np.frombuffer(text, np.uint8) == 32
            stay = ~(blank & np.concatenate([[True], blank[:-1]]))
            if len(stay) and blank[-1]:
                last = np.flatnonzero(~blank)[-1:]
                cut = int(last[0]) + 1 if len(last) else 0
                stay[cut:], end = False, int(origin[cut])
            text, origin = np.frombuffer(text, np.uint8)[stay].tobytes(), origin[stay]
            if not text:
                return b"", np.array([end])
        start = np.zeros(0, np.int32)
        if self.prefix:
            start = np.repeat(origin[:1] if self.fold else np.zeros(1, np.int32), 3 if self.escape else 1)
        if self.escape:
            origin = np.repeat(origin, np.where(np.frombuffer(text, np.uint8) == 32, 3, 1))
            text = text.replace(b" ", SPACE_BYTES)
        prefix = (SPACE_BYTES if self.escape else b" ") if self.prefix else b""
        return prefix + text, np.concatenate([start, origin, np.array([end], np.int32)])


# ---- encoding and decoding ----

@dataclass
class Encoded:
    """ids, and the source byte at which each piece ends (it starts at the end of the one before)."""
    ids: bytes
    ends: bytes


def as_words(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model: bytes):
        import sentencepiece
        parts = list(fields(model))
        pieces = [{n: v for n, v, _ in fields(v)} for n, v, _ in parts if n == PIECE]
        texts, kinds = [p[TEXT] for p in pieces], [p.get(KIND, 1) for p in pieces]
        spec = b"".join(v for n, v, _ in parts if n == NORMALIZER)
        self.normalize = Normalizer(spec, [t for t, k in zip(texts, kinds) if k == USER_DEFINED])
        # the same model with a normaliser that changes nothing
        plain = b"".join(bytes([n << 3]) + b"\0" for n in (DUMMY_PREFIX, FOLD_SPACES, ESCAPE_SPACES))
        bare = b"".join(b for n, _, b in parts if n != NORMALIZER) + bytes([NORMALIZER << 3 | 2]) + as_varint(len(plain)) + plain
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=bare)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.begin, self.end = self.whole.bos_id(), self.whole.eos_id()
        self.lengths = np.array([1 if k == BYTE else len(t) for t, k in zip(texts, kinds)], np.int64)
        self.unknown = kinds.index(UNKNOWN) if UNKNOWN in kinds and BYTE not in kinds else -1
        starts = {t.decode() for t, k in zip(texts, kinds) if k in (1, USER_DEFINED)}
        self.by_word = SPACE in starts and not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in starts)
        self.starts_word = np.array([t.startswith(SPACE_BYTES) for t in texts])

    def slices(self, normal: str) -> Iterator[str]:
        """A normalised text, cut at starts of words."""
        at = 0
        while at < len(normal):
            cut = WORD_START.search(normal, at + SLICE) if self.by_word else None
            end = cut.start() if cut else len(normal)
            yield normal[at:end]
            at = end

    def encode(self, text: str) -> Encoded:
        normal, origin = self.normalize(text.encode())
        parts = list(self.slices(normal.decode()))
        ids = b"".join([as_words(self.bare.encode(part)) for part in parts])
        numbers = np.frombuffer(ids, "<u4")
        lengths = self.lengths[numbers]
        if self.unknown >= 0 and (numbers == self.unknown).any():  # an unknown piece is as long as its text
            lengths = np.array([len(p.encode()) for part in parts for p in self.bare.encode(part, out_type=str)], np.int64)
        ends = np.concatenate([[0], origin[np.cumsum(lengths)], origin[-1:]]).astype("<u4")
        return Encoded(as_words([self.begin]) + ids + as_words([self.end]), ends.tobytes())

    def decode(self, ids: bytes) -> str:
        """The library's text of ``ids``, decoded in stretches. A stretch that
        starts with a word lacks the space before it, which the library drops at a start."""
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) <= DECODE_IDS or not (self.by_word and self.normalize.prefix and not self.normalize.fold):
            return self.whole.decode(numbers.tolist())
        starts = np.flatnonzero(self.starts_word[numbers])
        at, out = 0, []
        while at < len(numbers):
            k = np.searchsorted(starts, at + DECODE_IDS)
            end = int(starts[k]) if k < len(starts) else len(numbers)
            out.append((" " if at else "") + self.whole.decode(numbers[at:end].tolist()))
            at = end
        return "".join(out)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def worker_codec(path: str) -> PieceCodec:
    """The codec of this worker process."""
    cache = worker_cache()
    if ("pieces", path) not in cache:
        for kept in [k for k in cache if k in ("received", "received_token") or isinstance(k, tuple)]:
            cache.pop(kept)  # a worker keeps one operator's tables at a time
        with open(path, "rb") as f:
            cache["pieces", path] = PieceCodec(f.read())
    return cache["pieces", path]


def encode_decode(docs: DataFrame, model: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids and ends (little-endian unsigned 32-bit integers), decoded of every document."""
    ship_by_value(sys.modules[__name__])
    path = model or default_model()
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids", "ends", "decoded"]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for batch in batches:
            start, held, out = 0, 0, []
            for i, value in enumerate(batch.column(1)):
                one = codec.encode(value.as_py() or "")
                out.append((len(one.ids) // 4, one.ids, one.ends, codec.decode(one.ids)))
                held += 2 * len(one.ids) + len(out[-1][3])
                if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(out)),
                                                      *[pa.array(x, k) for x, k in zip(zip(*out), kinds)]], names)
                    start, held, out = i + 1, 0, []

    return rows.mapInArrow(coded, f"doc_id {id_type}, n_tokens long, ids binary, ends binary, decoded string")


def piece_spans(encoded: DataFrame) -> DataFrame:
    """doc_id, pos, id, start, end: one row per piece of ``encode_decode``, with its span of source bytes."""
    ship_by_value(sys.modules[__name__])
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (ids, ends) in enumerate(zip(batch.column(1), batch.column(2))):
                numbers, end = np.frombuffer(ids.as_py(), "<u4").astype(np.int64), np.frombuffer(ends.as_py(), "<u4").astype(np.int64)
                start = np.concatenate([[0], end[:-1]])
                for a in range(0, len(numbers), DECODE_IDS):
                    part = slice(a, a + DECODE_IDS)
                    n = len(numbers[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([batch.column(0).slice(i, 1)] * n), pa.array(np.arange(a, a + n)),
                         *[pa.array(x[part]) for x in (numbers, start, end)]], ["doc_id", "pos", "id", "start", "end"])

    return encoded.select("doc_id", "ids", "ends").mapInArrow(listed, f"doc_id {id_type}, pos long, id long, start long, end long")
