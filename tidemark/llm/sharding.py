"""Sharding by jump consistent hashing (operator 7).

A row's shard depends on its key and the number of shards alone: no ring, no
table, no shuffle to decide it. Appending a shard moves about 1/(n+1) of the
rows, all of them into the new shard. The jump loop runs in NumPy over Arrow
batches of 64-bit key hashes (its multiplication wraps, which ANSI SQL
forbids); the text never leaves the JVM.

Rows are numbered inside a shard in two levels: the shard is cut into blocks
by a row hash, blocks are numbered by a window each, and running sums of the
block sizes give the offsets. No task holds a whole shard.

Defined cases: null text has 0 bytes (size 1, CRC 0); null keys share one
hash and so one shard; repeated rows get slots of their own in no defined
order between them; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, quoted, shuffle_partitions, text_or_empty
from tidemark.session import ship_by_value

BLOCK_ROWS = 65_536  # rows of a numbering block, about
MIN_BLOCKS = 8       # blocks per shard at least


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of 64-bit keys to 0 … shards-1."""
    key = keys.astype(np.int64).view(np.uint64).copy()
    place = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    jump = np.zeros(len(key), np.int64)
    while len(live):
        place[live] = jump[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = (1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        far = np.minimum((place[live] + 1) * step, shards)  # beyond the last shard all is one
        jump[live] = far.astype(np.int64)
        live = live[jump[live] < shards]
    return place


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a key column of any type, by its 64-bit hash."""
    ship_by_value(sys.modules[__name__])

    @F.pandas_udf("int")
    def jumped(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(), shards).astype(np.int32))

    return jumped(F.xxhash64(key))


def assign_shards(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row."""
    def blocked(src: DataFrame) -> DataFrame:
        return src.withColumn("block", F.pmod(F.xxhash64(F.col("doc_id"), F.col("row_hash")), F.lit(blocks)))

    key = quoted(doc_id)
    blocks = max(MIN_BLOCKS, docs.count() // (BLOCK_ROWS * shards))
    whole = text_or_empty(quoted(text))
    rows = blocked(docs.select(
        key.alias("doc_id"), (F.octet_length(whole).cast("long") + 1).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"), shard_of(key, shards).alias("shard"),
        shard_of(key, shards + 1).alias("grown_shard"), F.crc32(whole.cast("binary")).alias("row_hash")))
    in_block = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32")
    numbered = rows.withColumn("in_block", F.row_number().over(in_block) - 1)
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("shard", "block").count()
               .withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
               .drop("count"))
    return (numbered.join(offsets, ["shard", "block"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("in_block")).alias("slot"), "grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, doc_id: str = "doc_id") -> str:
    """The rows themselves, one folder per shard. A shard is written by many
    tasks (salted), so no task holds a whole shard. Returns the name of the
    folders' column: ``shard``, or a free name where the documents have one."""
    parts = max(1, shuffle_partitions(docs.sparkSession) // shards)
    name = free_name(docs, "shard")
    (docs.withColumn(name, shard_of(quoted(doc_id), shards))
     .repartition(name, F.pmod(F.xxhash64(quoted(doc_id)), F.lit(parts)))
     .write.partitionBy(name).parquet(path))
    return name
