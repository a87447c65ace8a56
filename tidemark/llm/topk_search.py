"""Exact top-k search by inner product with multi-resolution segment
statistics (operator 10).

A vector is cut into 1, 4 and 16 segments; of each segment its mean and its
deviation (length of what is left after the mean) are kept. By Cauchy-Schwarz
the inner product is at most the sum over segments of n·mean·mean' + dev·dev',
which is the same as a lower bound on the distance. A candidate goes from
the coarse to the fine bound as long as it can still reach the query's k-th best
exact score, and only survivors get their exact integer inner product. Bounds
are widened by the rounding error of their arithmetic, so nothing is lost.

Queries are written once, in blocks of at most ``BLOCK_VALUES`` components, the
proven size of what the driver and the tasks hold at once: a block is fetched,
sent to the tasks, searched, its rows written, and released before the next
one. Every block meets all rows where they lie, without a shuffle of the
candidates. A task keeps k rows per query over all its batches, and the tasks'
rows meet in one window per query, whose partial limit runs before the shuffle.

Defined cases: vectors that are null or hold null, NaN or infinite components
(and rows without an id) take no part; only vectors of the same length meet;
rows that repeat a query's id are its own and no candidates; other repeated rows
each count; of several query rows with one id the smallest vector asks; ties
go to the smaller id; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, staged, staged_path
from tidemark.session import ship_by_value

SCALE = 1024.0
LEVELS = (1, 4, 16)        # segments, coarse to fine
BLOCK_VALUES = 1 << 22     # components of a block of queries (32 MB as 64-bit integers)
SEED_ROWS = 64             # candidates scored at once to get first thresholds


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, x (doubles) of the rows that take part."""
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.select(quoted(vec_id).cast("long").alias("vec_id"), quoted(embedding).cast("array<double>").alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~bad))


def as_integers(rows: list[np.ndarray]) -> np.ndarray:
    """floor(1024·x) of equally long vectors; Python integers where a product could leave 64 bits."""
    scaled = np.floor(SCALE * np.stack(rows))
    most = float(np.abs(scaled).max(initial=0.0))
    if most * most * scaled.shape[1] < 2.0 ** 62:
        return scaled.astype(np.int64)
    return np.vectorize(int, otypes=[object])(scaled)


def segment_features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector sqrt(n)·mean and deviation of each segment: their inner
    product bounds the vectors' own from above."""
    parts = np.array_split(vectors.astype(np.float64), min(segments, vectors.shape[1]), axis=1)
    means = np.stack([p.mean(axis=1) for p in parts], axis=1)
    devs = np.stack([np.sqrt(((p - p.mean(axis=1, keepdims=True)) ** 2).sum(axis=1)) for p in parts], axis=1)
    return np.concatenate([means * np.sqrt([p.shape[1] for p in parts]), devs], axis=1)


class BlockSearch:
    """The k best candidates so far of each query of a block (one vector length)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [segment_features(vectors, s) for s in LEVELS]
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.best: list[tuple[np.ndarray, np.ndarray]] = [
            (np.empty(0, vectors.dtype), np.empty(0, np.int64)) for _ in ids]

    def keep(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.best[q][0], scores]), np.concatenate([self.best[q][1], ids])
        order = np.lexsort((ids, -scores))[:self.k] if scores.dtype != object else np.array(
            sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:self.k], np.int64)
        self.best[q] = scores[order], ids[order]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        if vectors.dtype == object and self.vectors.dtype != object:
            self.vectors = self.vectors.astype(object)
        for a in range(0, len(ids), 8192):
            self._add(ids[a:a + 8192], vectors[a:a + 8192])

    def _add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        levels = [segment_features(vectors, s) for s in LEVELS]
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        coarse = self.levels[0] @ levels[0].T
        for q, own in enumerate(self.ids):
            slack = 1e-9 * self.norms[q] * norms + 1e-6
            left = np.flatnonzero(ids != own)
            if len(self.best[q][0]) < self.k:  # first thresholds: the best by the coarse bound
                first = left[np.argsort(-coarse[q, left], kind="stable")[:max(SEED_ROWS, self.k)]]
                self.keep(q, vectors[first] @ self.vectors[q], ids[first])
                left = np.setdiff1d(left, first, assume_unique=True)
            full = len(self.best[q][0]) == self.k
            least = float(self.best[q][0][-1]) if full else -np.inf
            left = left[coarse[q, left] + slack[left] >= least]
            for mine, theirs in zip(self.levels[1:], levels[1:]):
                left = left[theirs[left] @ mine[q] + slack[left] >= least]
            if len(left):
                self.keep(q, vectors[left] @ self.vectors[q], ids[left])


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is
    divisible by ``every`` the k rows of highest inner product."""
    ship_by_value(sys.modules[__name__])
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    asking = staged(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x")), "queries")
    n, values = asking.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("x")), F.lit(0))).first()
    blocks = max(1, -(-values // BLOCK_VALUES))
    schema = "query_id long, vec_id long, score long"

    def search(part: DataFrame) -> tuple[DataFrame, Broadcast]:
        groups: dict[int, list[tuple[int, np.ndarray]]] = {}
        for r in part.collect() if n else []:  # at most about BLOCK_VALUES components
            groups.setdefault(len(r["x"]), []).append((r["vec_id"], np.array(r["x"])))
        sent = spark.sparkContext.broadcast(
            {d: (np.array([i for i, _ in g], np.int64), [x for _, x in g]) for d, g in groups.items()})

        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = {d: BlockSearch(ids, as_integers(xs), k) for d, (ids, xs) in sent.value.items()}
            for batch in batches:
                ids, lists = batch.column(0).to_numpy(), batch.column(1)
                flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
                lengths = np.diff(ends, prepend=0)
                for d, block_search in found.items():
                    at = np.flatnonzero(lengths == d)
                    if len(at):
                        block_search.add(ids[at], as_integers([flat[ends[i] - d:ends[i]] for i in at]))
            for block_search in found.values():
                kept = [(int(q), int(i), int(s)) for q, (ss, ii) in zip(block_search.ids, block_search.best)
                        for s, i in zip(ss, ii)]
                if kept:
                    q, i, s = zip(*kept)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q, i, s)],
                                                     ["query_id", "vec_id", "score"])

        best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        found = (rows.mapInArrow(searched, schema)
                 .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                 .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
        return found, sent

    if blocks == 1:
        return search(asking)[0]
    # a query lies in one block, so each block's rows are final; a block whose job fails adds none
    asking = staged(asking.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "query-blocks", "block")
    path = staged_path(spark, "found")
    for block in range(blocks):
        found, sent = search(asking.where(F.col("block") == block).drop("block"))
        found.write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(found.schema).parquet(path)
