"""Token counts by offset-mapped attribution (operator 8).

A document is encoded once as a whole, so the counts of its sections add up
to the count of the document. The vocabulary is byte-level: the tokens of a
text tile its UTF-8 bytes, and running sums of the tokens' byte lengths give
every token's span. Sections are lines (a line owns the line feed that ends
it); both lists of spans are sorted, so their interval join is two binary
searches per section. Byte spans are turned into code point spans for the result.

A token that crosses a section boundary is allocated by an explicit rule:
``start`` gives it to the section of its first byte, ``most`` to the section
that holds most of its bytes (of equals the first).

Defined cases: null and empty texts have one empty section 0 with no token;
very long texts are one array pass; repeated rows are counted again; null
doc_id stays null; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import packing
from tidemark.llm.common import quoted, worker_cache
from tidemark.session import ship_by_value

LINE_FEED = 0x0A
COLUMNS = ["section", "char_start", "char_end", "n_tokens", "n_crossing", "doc_tokens"]
BATCH_ROWS = 50_000  # section rows handed back at once, about


def line_spans(raw: np.ndarray) -> np.ndarray:
    """Byte offsets where the lines of a text begin, and its end."""
    starts = np.flatnonzero(raw == LINE_FEED) + 1
    inner = starts[starts < len(raw)]
    return np.concatenate([[0], inner, [len(raw)]]).astype(np.int64)


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many of them cross a boundary of it.

    ``starts``/``ends``: sorted byte spans of the tokens; ``bounds``: section
    starts and the end of the text."""
    first = np.searchsorted(bounds[1:-1], starts, side="right")
    last = np.searchsorted(bounds[1:-1], ends - 1, side="right")
    owner, crossing = first.copy(), first != last
    if rule == "most":
        for t in np.flatnonzero(crossing):
            own = np.arange(first[t], last[t] + 1)
            shared = np.minimum(bounds[own + 1], ends[t]) - np.maximum(bounds[own], starts[t])
            owner[t] = own[int(np.argmax(shared))]
    sections = len(bounds) - 1
    return (np.bincount(owner, minlength=sections),
            np.bincount(owner[crossing], minlength=sections))


def section_tokens(docs: DataFrame, rule: str = "start", doc_id: str = "doc_id", text: str = "text",
                   paths: tuple[str, str, str] | None = None) -> DataFrame:
    """One row per document and line: doc_id, section, char_start, char_end
    (code points, end exclusive), n_tokens, n_crossing (of them, tokens that
    reach into another section), doc_tokens."""
    if rule not in ("start", "most"):
        raise ValueError(f"unknown rule {rule!r}")
    for module in (__name__, packing.__name__, worker_cache.__module__):
        ship_by_value(sys.modules[module])
    paths = paths or packing.default_paths()
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = packing.worker_encoder(paths)
        cache = worker_cache()
        if ("lengths", paths) not in cache:
            lengths = np.zeros(max(encoder.ranks.values()) + 2, np.int64)
            lengths[list(encoder.ranks.values())] = [len(b) for b in encoder.ranks]
            lengths[-1] = len(packing.SPECIAL)
            cache["lengths", paths] = lengths
        lengths = cache["lengths", paths]
        for batch in batches:
            id_arrow, docs_of, parts, waiting = batch.schema.field(0).type, [], [], 0

            def handed() -> pa.RecordBatch:
                columns = [np.concatenate(c) for c in zip(*parts)]
                return pa.RecordBatch.from_arrays(
                    [pa.array([d for d, n in docs_of for _ in range(n)], id_arrow)]
                    + [pa.array(c, pa.int64()) for c in columns], ["doc_id", *COLUMNS])

            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py() or ""
                raw = np.frombuffer(body.encode(), np.uint8)
                ends = np.cumsum(lengths[np.frombuffer(encoder(body), "<u4")])
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                bounds = line_spans(raw)
                tokens, crossing = attribute(starts, ends, bounds, rule)
                points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[bounds]  # bytes that begin a code point
                n = len(tokens)
                docs_of.append((doc, n))
                parts.append((np.arange(n), points[:-1], points[1:], tokens, crossing, np.full(n, len(ends))))
                waiting += n
                if waiting >= BATCH_ROWS:
                    yield handed()
                    docs_of, parts, waiting = [], [], 0
            if parts:
                yield handed()

    return rows.mapInArrow(counted, f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in COLUMNS))
