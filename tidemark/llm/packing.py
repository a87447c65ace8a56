"""Sum-of-squares online packing of tokenised documents (operator 1).

Every document becomes its token ids and a closing separator. Whole windows
are cut off its front and fill a sequence each; the rest is one item. Items
are placed online by the sum-of-squares rule: with N(h) open windows filled to
level h, an item of length s goes to the level h (0: a new window) for which
the sum of all N(h)^2 after placing is smallest, ties to the fuller window.
The level array has one counter per level, so a step costs the same at any
input size.

A partition packs for itself, in the order it reads its rows, and needs
nothing from others. When it ends (or ``OPEN_WINDOWS`` are open, the memory
bound) the open windows are closed by cutting: the emptiest windows' pieces
are poured into the gaps of the fullest, so one window at most stays
partly filled. No token is dropped; a partition that is run again packs again
in full and keeps its sequence numbers (partition number, counter).

Defined cases: null text is a document of the separator alone; very long texts
take as many windows as they need; a row that repeats is packed again; null
doc_id stays null; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import quoted, worker_cache
from tidemark.session import ship_by_value

WINDOW = 1024
SEPARATOR = 0
OPEN_WINDOWS = 4096   # windows that may be open at once in a task
CACHED_CHUNKS = 100_000  # chunks of a generation; a worker remembers two (about 45 MB)
ROW_TOKENS = 1 << 18  # tokens of the pieces handed back at once, about

# A chunk is an optional space and a word of plain letters before white space or a
# common mark, the marks between such a word and white space, any other run
# without white space, or white space up to its last character: the tokenizer's
# own pattern never joins text over the ends of these, so chunks can be
# encoded one by one and remembered.
CHUNK = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[\s,.;:!?]|\Z)|[,.;:!?]+(?=\s|\Z)| ?\S+|\s+(?!\S)|\s")
ODD_SPACE = re.compile(r"[\x1c-\x1f]")  # white space to Python, not to the tokenizer
SPECIAL = "<|endoftext|>"


class ChunkIds(dict):
    """chunk → its ids as unsigned little-endian 32-bit bytes. When a
    generation is full the one before it is forgotten."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = array("I", self.encode(chunk)).tobytes() if sys.byteorder == "little" else np.array(self.encode(chunk), "<u4").tobytes()
        if len(chunk) <= 64:
            if len(self) >= CACHED_CHUNKS:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


class DocumentEncoder:
    """Ids of whole texts by the byte-level vocabulary in ``ranks_path`` (the
    same vocabulary and ids as the tokenizer file ``json_path``, which encodes
    the rare texts that hold its special token's string)."""

    def __init__(self, ranks_path: str, pattern: str, json_path: str):
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks, self.json_path, self.exact = ranks, json_path, None
        self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.chunks = ChunkIds(self.plain)

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            if self.exact is None:
                from tokenizers import Tokenizer
                self.exact = Tokenizer.from_file(self.json_path)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if ODD_SPACE.search(text):
            return np.array(self.plain(text), "<u4").tobytes()
        chunks = self.chunks
        return b"".join([chunks[c] for c in CHUNK.findall(text)])


def worker_encoder(paths: tuple[str, str, str]) -> DocumentEncoder:
    """The encoder of this worker process."""
    cache = worker_cache()
    if ("encoder", paths) not in cache:
        cache.pop("received_token", None)  # a worker keeps one operator's tables at a time
        cache.pop("received", None)
        cache["encoder", paths] = DocumentEncoder(*paths)
    return cache["encoder", paths]


def default_paths() -> tuple[str, str, str]:
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
            public_tokenizers.path("byte_bpe_50k.json"))


class LevelPacker:
    """Sum-of-squares placement into windows of ``window`` tokens. Pieces are
    tuples whose first field is a length; ``done`` gets (sequence, offset, piece)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.count = np.zeros(window, np.int64)          # N(h), h = 1 … window-1
        self.open: list[list[list]] = [[] for _ in range(window)]  # windows by level: lists of pieces
        self.n_open = 0
        self.done: list[tuple[int, int, tuple]] = []

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((self.sequence, offset, piece))
            offset += piece[0]
        self.sequence += 1

    def best_level(self, size: int) -> int:
        """Level whose window takes the item."""
        top = self.window - size
        count = self.count
        gain = np.empty(top + 1, np.int64)   # change of the sum of squares
        gain[:top] = 2 * count[size:self.window] + 1
        gain[top] = 0                        # a full window is counted no more
        gain[1:] += 1 - 2 * count[1:top + 1]
        usable = count[:top + 1] > 0
        usable[0] = True
        gain[~usable] = np.iinfo(np.int64).max
        return top - int(np.argmin(gain[::-1]))

    def place(self, piece: tuple) -> None:
        size = piece[0]
        if size == self.window:
            self.close([piece])
            return
        level = self.best_level(size)
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self.close(pieces)
            return
        self.open[level + size].append(pieces)
        self.count[level + size] += 1
        self.n_open += 1
        if self.n_open >= OPEN_WINDOWS:
            self.finish(cut_piece)

    def finish(self, cut) -> None:
        """Close all open windows: fullest first, gaps filled with what the
        emptiest hold, pieces cut where a gap ends."""
        windows = [p for level in range(self.window - 1, 0, -1) for p in self.open[level]]
        room = [self.window - sum(x[0] for x in p) for p in windows]
        front, back = 0, len(windows) - 1
        while front <= back:
            while room[front] and front < back:
                piece = windows[back].pop()
                if piece[0] > room[front]:
                    piece, rest = cut(piece, room[front])
                    windows[back].append(rest)
                windows[front].append(piece)
                room[front] -= piece[0]
                if not windows[back]:
                    back -= 1
            self.close(windows[front])
            front += 1
        self.open = [[] for _ in range(self.window)]
        self.count[:] = 0
        self.n_open = 0


def cut_piece(piece: tuple, size: int) -> tuple[tuple, tuple]:
    """(length, doc_id, start, doc_tokens, ids) cut after ``size`` ids."""
    length, doc, start, tokens, ids = piece
    return ((size, doc, start, tokens, ids[:4 * size]),
            (length - size, doc, start + size, tokens, ids[4 * size:]))


def pack(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
         paths: tuple[str, str, str] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned little-endian
    32-bit), doc_tokens, sequence_id, offset."""
    ship_by_value(sys.modules[__name__])
    ship_by_value(sys.modules[worker_cache.__module__])
    paths = paths or default_paths()
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode = worker_encoder(paths)
        packer = LevelPacker(window, TaskContext.get().partitionId() << 40)
        separator = np.array([SEPARATOR], "<u4").tobytes()
        id_arrow = pa.int64()

        def handed() -> pa.RecordBatch:
            done, packer.done = packer.done, []
            pieces = [p for _, _, p in done]
            return pa.RecordBatch.from_arrays([
                pa.array([p[1] for p in pieces], id_arrow), pa.array([p[2] for p in pieces], pa.int64()),
                pa.array([p[0] for p in pieces], pa.int64()), pa.array([p[4] for p in pieces], pa.binary()),
                pa.array([p[3] for p in pieces], pa.int64()), pa.array([s for s, _, _ in done], pa.int64()),
                pa.array([o for _, o, _ in done], pa.int64())], names)

        waiting = 0
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(body.as_py() or "") + separator
                tokens = len(ids) // 4
                for start in range(0, tokens, window):
                    size = min(window, tokens - start)
                    packer.place((size, doc, start, tokens, ids[4 * start:4 * (start + size)]))
                waiting += tokens
                if waiting >= ROW_TOKENS:
                    if packer.done:
                        yield handed()
                    waiting = 0
        packer.finish(cut_piece)
        if packer.done:
            yield handed()

    return rows.mapInArrow(packed, f"doc_id {id_type}, start long, length long, ids binary, "
                                   "doc_tokens long, sequence_id long, offset long")
