"""Column-label operators: header match (JOIN-2), label difference and
intersection (SET-1, SET-5), label guard (PRJ-2), name cleaning (PRJ-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import clean_label


def labels_of(spark: SparkSession, columns: list[str], dataset: str = "") -> DataFrame:
    """Schema labels as a (dataset, pos, label) DataFrame (metadata only)."""
    return spark.createDataFrame([(dataset, i, c) for i, c in enumerate(columns)],
                                 "dataset string, pos int, label string")


def header_match(left: DataFrame, right: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Full outer join of two label lists on the label (first position
    wins for a repeated label). ``status`` is ``common``, ``absent`` (left
    only) or ``extra`` (right only); ``same_pos`` tells whether a common
    label sits at the same position."""
    key = key or []

    def first(df, tag):
        return (df.groupBy(*key, "label").agg(F.min("pos").alias(f"{tag}_pos"),
                                             F.count("*").alias(f"{tag}_n")))

    j = first(left, "left").join(first(right, "right"), on=[*key, "label"], how="full_outer")
    status = (F.when(F.col("left_pos").isNotNull() & F.col("right_pos").isNotNull(), "common")
               .when(F.col("left_pos").isNotNull(), "absent").otherwise("extra"))
    return j.select(*key, "label", "left_pos", "right_pos", status.alias("status"),
                    (F.col("left_pos") == F.col("right_pos")).alias("same_pos"),
                    (F.greatest(F.coalesce("left_n", F.lit(0)), F.coalesce("right_n", F.lit(0))) > 1)
                    .alias("duplicated"))


def check_labels(labels: DataFrame, key: list[str] | None = None) -> DataFrame:
    """PRJ-2: a label containing a space is CRITICAL (one row per label)."""
    key = key or []
    return (labels.where(F.col("label").contains(" "))
                  .select(*key, F.lit("CRITICAL").alias("severity"),
                          F.lit("label_space").alias("code"), "pos", "label",
                          F.concat(F.lit("variable names must be single string: "), F.col("label"))
                          .alias("message")))


def clean_names(df: DataFrame) -> DataFrame:
    """PRJ-1 on a DataFrame's own column names."""
    import re
    names = [re.sub(r"[^A-Za-z0-9]+", "_", c.strip()) for c in df.columns]
    return df.toDF(*names)


def clean_labels(labels: DataFrame) -> DataFrame:
    return labels.withColumn("label", clean_label("label"))
