"""Exact dedup by content sort (operator 2, DataFrame functions only).

Rows are range-partitioned on their normalised content: Spark samples the
splitters from a short key (first characters, SHA-256), so the sampled keys
are bounded however long the texts are. Inside a partition the external
sort puts equal texts next to each other and every row is compared in full
with its left neighbour; a run of equal neighbours is one group.

A group of copies with more than a partition's fair share of the rows gets a
salt (by doc_id) after the digest in the range key, so it spreads over
neighbouring partitions. Such groups are recognised on a row sample and
there are fewer of them than partitions; their run heads (at most two per
partition on average) are compared in full in a second, small sort.

Defined cases: null text counts as empty; all texts of white space alone are
equal (normalised text ''); a null doc_id sorts last among ties; of rows that
repeat doc_id and text exactly one has ``kept``; an empty table gives no rows;
further columns are ignored by ``exact_groups`` and kept by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, shuffle_partitions, staged, text_or_empty

WHITE = " \t\n\x0b\x0c\r"  # what normalisation deletes: [\x20\x09-\x0D]
HEAD_CHARS = 16            # leading characters of the range key
HOT_SAMPLE = 200_000       # rows on which hot groups are recognised, about


def normalise(text: Column) -> Column:
    """The text without white space, null as empty."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", "")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalise(text), 256))


def hot_groups(rows: DataFrame) -> DataFrame:
    """(sha, salts) of the groups above a partition's share of a sample of
    ``rows(doc_id, text)``: fewer rows than shuffle partitions."""
    spark = rows.sparkSession
    n = rows.count()
    step = max(1, n // HOT_SAMPLE)
    limit = max(8, n // step // shuffle_partitions(spark))
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0) if step > 1 else rows
    return (sample.groupBy(digest(F.col("text")).alias("sha")).count()
            .where(F.col("count") > limit)
            .select("sha", F.ceil(F.col("count") / limit).alias("salts")))


def _order(norm: str = "norm"):
    return [F.col(norm), F.col("n_cp").desc(), F.col("doc_id").asc_nulls_last()]


def sorted_runs(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, text, …)`` with sha, salt (0: group not split), norm,
    n_cp, run (number within sha and salt), first_of_run and, for every row,
    ``head_row`` (the best row of its run)."""
    hot = F.broadcast(hot_groups(rows.select("doc_id", "text")))  # below one row per partition
    salted = (rows.withColumn("sha", digest(F.col("text")))
              .withColumn("head", F.substring(normalise(F.col("text")), 1, HEAD_CHARS))
              .join(hot, "sha", "left")
              .withColumn("salt", F.when(F.col("salts").isNull(), F.lit(0).cast("long"))
                          .otherwise(1 + F.pmod(F.xxhash64("doc_id"), F.col("salts"))))
              .drop("salts"))
    key = ["head", "sha", "salt"]
    near = Window.partitionBy(*key).orderBy(*_order())
    so_far = near.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (salted.repartitionByRange(*key)
            .withColumn("norm", normalise(F.col("text")))
            .withColumn("n_cp", F.char_length(text_or_empty(F.col("text"))).cast("long"))
            .withColumn("left_norm", F.lag("norm").over(near))
            .withColumn("first_of_run", F.col("left_norm").isNull() | (F.col("left_norm") != F.col("norm")))
            .drop("left_norm")
            .withColumn("run", F.sum(F.col("first_of_run").cast("int")).over(so_far))
            .withColumn("head_row", F.last(F.when(F.col("first_of_run"), F.struct("n_cp", "doc_id")),
                                           ignorenulls=True).over(so_far)))


def _joined_runs(heads: DataFrame) -> DataFrame:
    """Run heads of split groups, compared in full across salts: ``best``
    (is this head the row that stays) and ``whole`` (number of the text)."""
    near = Window.partitionBy("sha").orderBy(*_order(), F.col("salt"), F.col("run"))
    so_far = near.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (heads.withColumn("left_norm", F.lag("norm").over(near))
            .withColumn("best", F.col("left_norm").isNull() | (F.col("left_norm") != F.col("norm")))
            .withColumn("whole", F.sum(F.col("best").cast("int")).over(so_far))
            .drop("left_norm"))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    same = Window.partitionBy("head", "sha", "salt", "run")
    runs = staged(
        sorted_runs(rows)
        .withColumn("norm", F.when(F.col("first_of_run") & (F.col("salt") > 0), F.col("norm")))
        .select("doc_id", "head", "sha", "salt", "run", "first_of_run", "head_row", "norm")
        .withColumn("size", F.count(F.lit(1)).over(same)), "exact")
    heads = (runs.where(F.col("first_of_run") & (F.col("salt") > 0))
             .select("sha", "salt", "run", "norm", "size", "head_row.n_cp", "head_row.doc_id"))
    text_of = Window.partitionBy("sha", "whole")
    merged = (_joined_runs(heads)
              .withColumn("all_rows", F.sum("size").over(text_of))
              .withColumn("stays", F.max(F.when(F.col("best"), F.struct("doc_id"))).over(text_of))
              .select("sha", "salt", "run", "all_rows", "stays", "best"))
    split = F.col("salt") > 0
    # one row per run of a split group: about two per shuffle partition
    return (runs.join(F.broadcast(merged), ["sha", "salt", "run"], "left")
            .select("doc_id",
                    F.when(split, F.col("stays.doc_id")).otherwise(F.col("head_row.doc_id")).alias("keep_id"),
                    F.when(split, F.col("all_rows")).otherwise(F.col("size")).alias("group_size"),
                    (F.col("first_of_run") & (~split | F.coalesce(F.col("best"), F.lit(False)))).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (all its columns) with only the row of each group that stays."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"),
                       F.struct(*[quoted(c) for c in docs.columns]).alias("whole_row"))
    heads = staged(sorted_runs(rows).where("first_of_run")
                   .select("whole_row", "doc_id", "sha", "salt", "run", "n_cp",
                           F.when(F.col("salt") > 0, F.col("norm")).alias("norm")), "copies")
    single = heads.where("salt = 0").select("whole_row.*")
    split = _joined_runs(heads.where("salt > 0")).where("best").select("whole_row.*")
    return single.unionByName(split)
