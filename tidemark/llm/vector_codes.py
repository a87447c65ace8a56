"""Vector code compression by exact integer GEMM (operator 13).

Components become integers, vectors are cut into equal parts, and every part
position has a codebook of integer vectors (product quantisation). The squared
distance of a part to all entries is |v|² - 2·v·c + |c|², whose inner products are
matrix products. To stay exact they are limb-split: integers are broken into
limbs so small that a float64 product of limb matrices cannot leave 2^53, so
BLAS makes no rounding error, and the limb products are put together in
64-bit integers; the first smallest distance wins. Means are exact as well: the
sum of the parts of an entry is the product of a 0/1 matrix and the parts.

A round reads the vectors where they lie and shuffles no vector: a task hands
back one sum per entry component (``parts × entries × components of a part``
numbers, cut into 40-bit limbs so that no sum over any number of tasks
overflows), and the codebooks, of the same fixed size, go out with the next round.

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part and no row; shorter vectors are filled up with zeros to the longest
length, rounded up to whole parts; with fewer rows than entries a codebook is
that much smaller; null ids seed last, equal ids in order of their
components; repeated rows each get a row; where a distance could leave 64 bits,
all is done in Python integers, and an error or sum of errors beyond a long is
null; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, staged
from tidemark.session import ship_by_value

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
STEP_ROWS = 2048          # vectors of one matrix product
SUM_LIMB = 40             # bits of the limbs of a sum
BROADCAST_LABELS = 500_000  # sums per label that may be broadcast (about 16 MB)


# ---- exact products of integer matrices ----

def limbs(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 matrices x_0, x_1, … with a = Σ x_i·2^(i·bits), |x_i| ≤ 2^bits."""
    out = []
    while True:
        most = max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0))))
        if most <= 1 << bits:
            return [*out, a.astype(np.float64)]
        out.append((a & ((1 << bits) - 1)).astype(np.float64))
        a = a >> bits


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integer matrices (stacked ones too): float64 products of limbs
    below 2^53, put together in the integers of ``a``'s type."""
    inner = a.shape[-1]
    bits = (53 - max(1, inner).bit_length()) // 2
    total: np.ndarray | int = 0
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            shift, product = bits * (i + j), np.matmul(x, y)
            # in 64 bits a limb may wrap; the whole does not, where it fits
            total = total + (product.astype(np.int64).astype(object) * (1 << shift) if a.dtype == object
                             else product.astype(np.int64) << min(shift, 63) if shift < 64 else 0)
    return total


def nearest(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``parts`` (position, row, component), ``books`` (position, entry,
    component) → per position and row the nearest entry (the first of equals) and its squared distance."""
    products = exact_product(parts, books.transpose(0, 2, 1))
    own, theirs = (parts * parts).sum(axis=2), (books * books).sum(axis=2)
    distance = own[:, :, None] - 2 * products + theirs[:, None, :]
    entry = distance.argmin(axis=2)
    return entry, np.take_along_axis(distance, entry[:, :, None], axis=2)[:, :, 0]


def sums_by_entry(parts: np.ndarray, entry: np.ndarray, entries: int) -> np.ndarray:
    """Exact sum of the parts of each entry: (position, entry, component)."""
    chosen = (entry[:, None, :] == np.arange(entries)[None, :, None]).astype(parts.dtype)
    return exact_product(chosen, parts)


# ---- rows and codebooks ----

@dataclass
class Shape:
    """What all tasks agree on: parts, components of a part, and whether 64 bits are enough."""
    parts: int
    width: int
    scale: int
    wide: bool

    def integers(self, rows: list[np.ndarray]) -> np.ndarray:
        """(position, row, component) of ``rows``, as floor(scale·x), filled up with zeros."""
        out = np.zeros((len(rows), self.parts * self.width))
        for i, x in enumerate(rows):
            out[i, :len(x)] = x
        whole = np.floor(self.scale * out)
        ints = np.vectorize(int, otypes=[object])(whole) if self.wide and whole.size else whole.astype(object if self.wide else np.int64)
        return ints.reshape(len(rows), self.parts, self.width).transpose(1, 0, 2)


@dataclass
class Codebooks:
    """``books`` (position, entry, component) of integers."""
    shape: Shape
    books: np.ndarray

    def sha256(self) -> str:
        """Hex digest of all integers by position, entry and component, comma-joined."""
        return hashlib.sha256(",".join(str(int(x)) for x in self.books.ravel()).encode()).hexdigest()


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str | None) -> DataFrame:
    """vec_id, label, x (doubles) of the rows that take part."""
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.select(quoted(vec_id).alias("vec_id"), (quoted(label) if label else F.lit(None).cast("int")).alias("label"),
                           quoted(embedding).cast("array<double>").alias("x"))
            .where(F.col("x").isNotNull() & ~bad))


def vectors_of(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    lists = batch.column(column)
    flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    return [flat[e - n:e] for e, n in zip(ends, lengths)]


def steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for a in range(0, batch.num_rows, STEP_ROWS):
        yield batch.slice(a, STEP_ROWS)


def entry_sums(rows: DataFrame, found: Codebooks) -> dict[tuple[int, int, int], int]:
    """(position, entry, component) → sum of the parts nearest to the entry;
    component -1 holds their count. A fixed number of sums, whatever the rows."""
    shape, books = found.shape, found.books

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(books.shape, object), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for step in steps(batch):
                parts = shape.integers(vectors_of(step, 0))
                entry, _ = nearest(parts, books)
                total += sums_by_entry(parts, entry, books.shape[1]).astype(object)
                for p in range(shape.parts):
                    count[p] += np.bincount(entry[p], minlength=books.shape[1])
        out = []
        for p, e in zip(*np.nonzero(count)):
            out.append((p, e, -1, 0, int(count[p, e])))
            for c in range(shape.width):
                rest, limb = int(total[p, e, c]), 0
                while rest:
                    low = rest if abs(rest) < 1 << SUM_LIMB else rest & ((1 << SUM_LIMB) - 1)
                    out.append((p, e, c, limb, low))
                    rest, limb = (rest - low) >> SUM_LIMB, limb + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([int(x) for x in xs], pa.int64()) for xs in zip(*out)],
                                             ["part", "entry", "component", "limb", "value"])

    sums = (rows.select("x").mapInArrow(summed, "part long, entry long, component long, limb long, value long")
            .groupBy("part", "entry", "component", "limb").agg(F.sum("value").alias("value")))
    whole: dict[tuple[int, int, int], int] = {}
    for r in sums.collect():  # parts × entries × (components + 1) numbers
        key = (r["part"], r["entry"], r["component"])
        whole[key] = whole.get(key, 0) + (r["value"] << (SUM_LIMB * r["limb"]))
    return whole


def fit(rows: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> Codebooks | None:
    """Codebooks of ``rows(vec_id, x)``: seeds, then ``rounds`` of assignment and exact means. None without rows."""
    longest, most = rows.agg(F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs)))).first()
    if longest is None:
        return None
    width = max(1, -(-longest // parts))
    reach = 2 * (int(scale * (most or 0)) + 1)  # of a difference of two components
    shape = Shape(parts, width, scale, wide=reach * reach * width * parts >= 1 << 62)
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    found = Codebooks(shape, shape.integers([np.array(r["x"], np.float64) for r in seeds]))
    for _ in range(rounds):
        sums, books = entry_sums(rows, found), found.books.copy()
        for (p, e, c), value in sums.items():
            if c < 0:
                books[p, e] = [sums.get((p, e, i), 0) // value for i in range(width)]
        found = Codebooks(shape, books)
    return found


def assign(rows: DataFrame, found: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits per part), error of each of ``rows``."""
    shape, books = found.shape, found.books
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                entry, distance = nearest(shape.integers(vectors_of(step, 2)), books)
                digits = entry.T.astype(np.uint8).tobytes().hex()
                n = 2 * shape.parts
                error = [int(x) for x in distance.sum(axis=0)]
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), step.column(1), pa.array([digits[i * n:i * n + n] for i in range(step.num_rows)], pa.string()),
                     pa.array([x if x < 1 << 63 else None for x in error], pa.int64())], ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(coded, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that takes part (entries ≤ 256)."""
    ship_by_value(sys.modules[__name__])
    rows = usable(vectors, vec_id, embedding, label)
    found = fit(rows, parts, entries, rounds, scale)
    if found is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).where("false")
    codes = staged(assign(rows, found), "codes")
    labels = staged(codes.groupBy("label").agg(F.try_sum("error").alias("label_error"))
                    .withColumnRenamed("label", "of"), "labels")
    few = labels.count() <= BROADCAST_LABELS
    return (codes.join(F.broadcast(labels) if few else labels, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(found.sha256()).alias("codebooks_sha256")))


def _assigned(book: str) -> str:
    """SQL: the nearest entry of every part by the codebooks in ``book``."""
    return f"""
  SELECT vec_id, label, p, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT v.vec_id, v.label, v.p, v.x, b.e,
           list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM part v JOIN {book} b ON v.p = b.p) GROUP BY vec_id, label, p"""


def _updated(assigned: str, book: str) -> str:
    """SQL: every entry of ``book`` replaced by the floored mean of its parts."""
    return f"""
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
      SELECT p, best.e AS e, i, sum(x[i + 1])::BIGINT AS s, count(*) AS n
      FROM {assigned}, (SELECT unnest(range(4)) AS i) GROUP BY ALL) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e"""


#: For vectors of 64 components (4 a part) with ids that do not repeat.
ORACLE_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT vec_id, label, p, v[p * 4 + 1 : p * 4 + 4] AS x FROM kept, (SELECT unnest(range(16)) AS p)),
seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS MATERIALIZED (SELECT p, e, x FROM part JOIN seed USING (vec_id)),
near0 AS MATERIALIZED ({_assigned("book0")}),
book1 AS MATERIALIZED ({_updated("near0", "book0")}),
near1 AS MATERIALIZED ({_assigned("book1")}),
book2 AS MATERIALIZED ({_updated("near1", "book1")}),
near2 AS MATERIALIZED ({_assigned("book2")}),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
          FROM near2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded"""
