"""Sinks: columnar dataset with attributes (SNK-1), paged output (SNK-2),
CSV export with quoting styles (SNK-3), reports (SNK-4), quarantine
routing (SNK-6) and the file-size comparison (AGG-13)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.profile import page_number

QUOTE_ALL, QUOTE_NONNUMERIC, QUOTE_MINIMAL = "all", "nonnumeric", "minimal"


def with_attributes(df: DataFrame, var_meta: dict[str, dict]) -> DataFrame:
    """Variable attributes travel in the column metadata (kept by Parquet)."""
    return df.select(*[F.col(f"`{c}`").alias(c, metadata=var_meta.get(c, {})) for c in df.columns])


def write_dataset(df: DataFrame, path: str, var_meta: dict[str, dict] | None = None,
                  global_meta: dict | None = None, compression: str = "zstd") -> None:
    """SNK-1: Parquet with per-variable attributes in the schema and the
    global attributes as a one-row side table ``<path>/_attributes``."""
    out = with_attributes(df, var_meta or {})
    out.write.mode("overwrite").option("compression", compression).parquet(f"{path}/data")
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(global_meta or {}),)], "attributes string") \
        .coalesce(1).write.mode("overwrite").json(f"{path}/_attributes")


def write_paged(df: DataFrame, path: str, rows_per_file: int, row_idx: str = "row_idx") -> None:
    """SNK-2: exact pages of ``rows_per_file`` rows (``part`` = floor(row/n)+1),
    one file each: rows are dealt by page, and a page is bounded."""
    df.withColumn("part", page_number(row_idx, rows_per_file)).repartition("part") \
        .write.mode("overwrite").partitionBy("part").parquet(path)


def write_named_pages(df: DataFrame, path: str, base_name: str, rows_per_file: int | None, row_idx: str = "row_idx") -> None:
    """SNK-2 with names: the folder ``dataset=<base_name>_part<k>`` for page k,
    ``dataset=<base_name>`` if there is no more than one page (or no page size)."""
    several = bool(rows_per_file) and (df.agg(F.max(row_idx)).first()[0] or 0) >= rows_per_file
    if not several:
        df.withColumn("dataset", F.lit(base_name)).write.mode("overwrite").partitionBy("dataset").parquet(path)
        return
    name = F.concat(F.lit(f"{base_name}_part"), page_number(row_idx, rows_per_file).cast("string"))
    df.withColumn("dataset", name).repartition("dataset").write.mode("overwrite").partitionBy("dataset").parquet(path)


def _is_number(c: Column) -> Column:
    from tidemark.functions.numeric import NUMBER_RX
    return c.rlike(NUMBER_RX)


def csv_lines(df: DataFrame, quoting: str = QUOTE_MINIMAL, quote: str = '"', delim: str = ",",
              numeric_cols: list[str] | None = None) -> DataFrame:
    """SNK-3 as a DataFrame of text lines (header first): ``all`` quotes
    every cell, ``nonnumeric`` every non-numeric cell, ``minimal`` only
    cells containing the delimiter, the quote or a line break; an inner
    quote is doubled. Column names are cleaned like PRJ-1."""
    import re
    names = [re.sub(r"[^A-Za-z0-9]+", "_", c.strip()) for c in df.columns]
    numeric = set(numeric_cols if numeric_cols is not None else
                  [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint")]
                  or [])

    def cell(c: str) -> Column:
        v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        q = F.concat(F.lit(quote), F.replace(v, F.lit(quote), F.lit(quote + quote)), F.lit(quote))
        if quoting == QUOTE_ALL:
            return q
        if quoting == QUOTE_NONNUMERIC:
            return v if c in numeric else q
        needs = (F.instr(v, delim) > 0) | (F.instr(v, quote) > 0) | v.rlike("[\r\n]")
        return F.when(needs, q).otherwise(v)

    header = df.sparkSession.range(1).select(F.lit(delim.join(names)).alias("line"),
                                             F.lit(0).cast("long").alias("_o"))
    body = df.select(F.concat_ws(delim, *[cell(c) for c in df.columns]).alias("line"),
                     F.lit(1).cast("long").alias("_o"))
    return header.unionByName(body)


def write_csv(df: DataFrame, path: str, quoting: str = QUOTE_MINIMAL, quote: str = '"',
              delim: str = ",", order_by: str | None = "row_idx") -> None:
    """SNK-3: one text file set with the header line first. With
    ``order_by`` the rows are range-partitioned by it (no single task)."""
    cols = [c for c in df.columns if c != order_by] if order_by else df.columns
    data = df
    if order_by and order_by in df.columns:
        data = df.repartitionByRange(order_by).sortWithinPartitions(order_by)
    lines = csv_lines(data.select(*cols), quoting, quote, delim)
    # header in its own first part, data parts after it, in order
    lines.where("_o = 0").select("line").coalesce(1).write.mode("overwrite").text(f"{path}/0_header")
    lines.where("_o = 1").select("line").write.mode("overwrite").text(f"{path}/1_rows")


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """SNK-4: report tables are DataFrames; written as JSON lines or text."""
    (df.write.mode("overwrite").json(path) if fmt == "json"
     else df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns]).alias("v"))
     .write.mode("overwrite").text(path))


def route_by_verdict(df: DataFrame, qc: DataFrame, key: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """SNK-6: rows of datasets with a CRITICAL qc message go to quarantine
    (``bad``), the others pass (``good``). The failing-key list is one
    row per failing dataset."""
    failing = qc.where(F.col("severity") == "CRITICAL").select(key).distinct()
    return df.join(failing, on=key, how="left_anti"), df.join(failing, on=key, how="left_semi")


def size_compare(spark: SparkSession, left: str, right: str) -> DataFrame:
    """AGG-13: total bytes of two file sets (content is never read) and
    the percent difference of the second from the first."""
    def total(p):
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p).select("length").agg(F.sum("length").alias("b"))
    a, b = total(left).select(F.col("b").alias("left_bytes")), total(right).select(F.col("b").alias("right_bytes"))
    return a.select("left_bytes", b.select("right_bytes").scalar().alias("right_bytes")) \
        .withColumn("equal", F.col("left_bytes") == F.col("right_bytes")) \
        .withColumn("percent_difference", F.try_divide((F.col("right_bytes") - F.col("left_bytes")).cast("double"),
                                                       F.col("left_bytes") * F.lit(0.01)))
