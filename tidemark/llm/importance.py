"""Target-distribution importance resampling (operator 11).

The runs of 1 … n words of all documents and of all target texts are counted into
hashed buckets. A bucket's gain is its floored, scaled and smoothed log ratio of
target to corpus; a document's weight is the floored mean gain of its features
(one look into the array of gains each). A Gumbel variate from the hash of its id
turns the weight into a score, and the highest scores are a draw without
replacement.

Ranks come from a distributed radix sort, least significant digit first, over a
composite key (descending score, then id) of as many bits as its values need.
Rows lie in blocks by their position. A pass counts the digits of every block,
turns the counts into global prefix offsets (all smaller digits, then the same digit in
earlier blocks: windows over counts, never over rows), and every block
places its rows by a stable counting sort: a row's destination is its
digit's offset plus its place among the block's rows of that digit. Blocks
have the same size up to one, whatever the keys, so equal or hot scores make no task
larger. After the last pass a row's position is its rank.

Defined cases: null and empty texts have no features and weight 0; texts are
read whole, in slices; null doc_id hashes like an empty id and ranks after all ids of
its score; repeated rows each take a rank; ids are cast to long; without target
texts (or documents) the counts are 0; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import sys
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, quoted, shuffle_partitions, staged
from tidemark.session import ship_by_value

BUCKETS, NGRAM, SEED = 10_000, 1, 2024
LEAST_WORDS, PERCENT = 20, 10
DIGIT_BITS = 11             # of a pass of the radix sort
LEAST_BLOCK, MOST_BLOCK = 10, 18  # bits of the rows of a block
KEY_BITS = 62               # of a packed key
SLICE = 1 << 20             # bytes of a text that are cut into words at once
REMEMBERED = 200_000        # features whose bucket a task remembers

# A-Z in lower case, everything but 0-9, a-z and non-ASCII bytes as a space
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# ---- inside the tasks ----

class Buckets(dict):
    """feature → its bucket, remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


def word_slices(text: str) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice (a slice ends between words)."""
    data = text.encode().translate(LETTERS)
    at = 0
    while at < len(data):
        end = len(data) if at + SLICE >= len(data) else data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def features_of(text: str, n: int, bucket: Buckets) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the features that end in them), slice by slice."""
    before: deque[bytes] = deque(maxlen=max(1, n - 1))
    for words in word_slices(text):
        found = [bucket[w] for w in words]
        if n > 1:
            run = [*before, *words]
            start = len(run) - len(words)
            for size in range(2, n + 1):
                found += [bucket[b" ".join(run[i - size + 1:i + 1])] for i in range(max(start, size - 1), len(run))]
            before.extend(islice(words, max(0, len(words) - n + 1), None))
        yield len(words), np.array(found, np.int64)


def bucket_counts(texts: DataFrame, buckets: int, n: int) -> np.ndarray:
    """Features per bucket over all rows of ``texts(text)``."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bucket = np.zeros(buckets, np.int64), Buckets(buckets)
        for batch in batches:
            for text in batch.column(0):
                for _, found in features_of(text.as_py() or "", n, bucket):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in (texts.mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))).collect():
        out[r["bucket"]] = r["n"]  # at most ``buckets`` rows
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000·ln((t+1)(S+B) / ((s+1)(T+B)))) per bucket, in doubles."""
    size, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(all_s + size) / (float(s + 1) * float(all_t + size))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """floor(-1000·ln(-ln u)) of the hash-seeded uniform u of an id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, n: int, seed: int, least_words: int) -> DataFrame:
    """``docs(doc_id, text)`` → doc_id, n_features, weight, score, eligible."""
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets(len(gain))
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, batch.column(1)):
                words = features = total = 0
                for count, found in features_of(text.as_py() or "", n, bucket):
                    words, features, total = words + count, features + len(found), total + int(gain[found].sum())
                weight = total // features if features else 0
                out.append((features, weight, weight + gumbel(doc_id, seed), words >= least_words))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in zip(*out)]],
                                                 ["doc_id", "n_features", "weight", "score", "eligible"])

    return docs.mapInArrow(weighed, "doc_id long, n_features long, weight long, score long, eligible boolean")


# ---- the radix sort ----

def packed_keys(fields: list[tuple[Column, int]]) -> list[tuple[Column, int]]:
    """Fields (column, bits), least significant first, packed into as few longs."""
    keys: list[tuple[Column, int]] = []
    for column, bits in fields:
        if keys and keys[-1][1] + bits <= KEY_BITS:
            low, width = keys[-1]
            keys[-1] = (low.bitwiseOR(F.shiftleft(column, width)), width + bits)
        elif bits:
            keys.append((column, bits))
    return keys or [(F.lit(0).cast("long"), 1)]


def rank_fields(rows: DataFrame) -> list[tuple[Column, int]]:
    """The composite key of descending score, then ascending id (null last)."""
    least, most, low, high, nulls = rows.agg(F.min("score"), F.max("score"), F.min("doc_id"), F.max("doc_id"),
                                             F.max(F.col("doc_id").isNull().cast("int"))).first()
    if least is None:
        return []
    some = F.coalesce(F.col("doc_id"), F.lit(low or 0))
    if low is None:
        of_id = []
    elif high - low < 1 << KEY_BITS:
        of_id = [(some - F.lit(low), (high - low).bit_length())]
    else:  # the difference could leave a long
        of_id = [(some.bitwiseAND(F.lit(0xFFFFFFFF)), 32), (F.shiftright(some, 32) - F.lit(low >> 32), ((high >> 32) - (low >> 32)).bit_length())]
    of_null = [(F.col("doc_id").isNull().cast("long"), 1)] if nulls else []
    return [*of_id, *of_null, (F.lit(most) - F.col("score"), (most - least).bit_length())]


def counting_pass(rows: DataFrame, digit: Column, block_bits: int) -> DataFrame:
    """``rows`` with ``at`` moved to its place in the stable order by ``digit``."""
    dealt = rows.withColumn("block", F.shiftright("at", block_bits)).withColumn("digit", digit)
    counts = dealt.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n"))
    smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # over one row per digit
    base = (counts.groupBy("digit").agg(F.sum("n").alias("n"))
            .select("digit", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("base")))
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
              .join(F.broadcast(base), "digit")  # at most 2^DIGIT_BITS rows
              .select("block", "digit", (F.col("base") + F.col("before")).alias("start")).toDF("of_block", "digit", "start"))
    names = rows.columns

    def placed(block: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        digits = block["digit"].to_numpy()
        order = np.argsort(digits, kind="stable")  # the counting sort of the block
        first = np.zeros(int(digits.max(initial=0)) + 1, np.int64)
        first[start["digit"].to_numpy()] = start["start"].to_numpy()
        ordered = digits[order]
        before = np.searchsorted(ordered, ordered, "left")
        at = np.empty(len(block), np.int64)
        at[order] = first[ordered] + np.arange(len(block)) - before
        return block.assign(at=at)[names]

    return dealt.groupBy("block").cogroup(starts.groupBy("of_block")).applyInPandas(placed, rows.schema)


def radix_ranked(rows: DataFrame, fields: list[tuple[Column, int]], count: int) -> DataFrame:
    """``rows`` with ``at``, their position (from 0) in the order of the key ``fields``."""
    keys = packed_keys(fields)
    names = [f"key_{i}" for i in range(len(keys))]
    columns = rows.columns
    parts = 4 * shuffle_partitions(rows.sparkSession)
    block_bits = min(MOST_BLOCK, max(LEAST_BLOCK, (count // parts).bit_length()))
    # any first order will do; the written table fixes it
    placed = staged(rows.select(F.monotonically_increasing_id().alias("at"), *columns,
                                *[k.cast("long").alias(n) for (k, _), n in zip(keys, names)]), "radix")
    for name, (_, bits) in zip(names, keys):
        passes = -(-bits // DIGIT_BITS)
        width = -(-bits // passes)
        for shift in range(0, bits, width):
            digit = F.shiftright(name, shift).bitwiseAND(F.lit((1 << width) - 1))
            later = staged(counting_pass(placed, digit, block_bits), "radix")
            discard(placed)
            placed = later
    return placed.select("at", *columns)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
             ngram: int = NGRAM, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank (from 1) of those drawn."""
    ship_by_value(sys.modules[__name__])
    rows = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    aims = target.select(quoted(target_text).cast("string").alias("text"))
    gain = gains(bucket_counts(rows.select("text"), buckets, ngram), bucket_counts(aims, buckets, ngram))
    found = staged(scored(rows, gain, ngram, seed, least_words), "scored")
    able = found.where("eligible").drop("eligible")
    count = able.count()
    ranked = radix_ranked(able, rank_fields(able), count)
    drawn = percent * count // 100
    rank = F.when(F.col("at") < drawn, F.col("at") + 1)
    rest = found.where(~F.col("eligible"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).union(rest.select(*columns, F.lit(None).cast("long").alias("rank")))


#: Words of one (NGRAM 1) are counted per distinct word; the CRC's table is derived in place.
ORACLE_SQL = r"""
WITH word AS MATERIALIZED (
  SELECT src, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT 0 AS src, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark)),
step AS (SELECT list(list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
         FROM (SELECT unnest(range(256)) AS i)),
bucket AS MATERIALIZED (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(hex(w)) // 2),
                     lambda k: ('0x' || substr(hex(w), (2 * k + 1)::INT, 2))::BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS b
  FROM (SELECT DISTINCT w FROM word), step),
counted AS (
  SELECT b, count(*) FILTER (src = 0) AS s, count(*) FILTER (src = 1) AS t
  FROM word JOIN bucket USING (w) GROUP BY b),
gain AS MATERIALIZED (
  SELECT b, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
                            / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE)))::BIGINT AS g
  FROM counted),
weighed AS (
  SELECT id AS doc_id, count(*) AS n, sum(g)::BIGINT AS total
  FROM word JOIN bucket USING (w) JOIN gain USING (b) WHERE src = 0 GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
         floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
  FROM documents LEFT JOIN weighed USING (doc_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS able
  FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, (weight + noise)::BIGINT AS score,
       CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END::BIGINT AS rank
FROM ranked"""
