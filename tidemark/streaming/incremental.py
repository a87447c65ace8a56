"""Incremental runs (STR-1, STR-2).

STR-1: a file-source stream with ``trigger(availableNow=True)`` and a
checkpoint processes only files it has not seen (``incremental_run``). Where
sources can change or vanish, ``sync_sources`` keeps a versioned table of them
(path, time, length), joins it with the listing, and rewrites the outputs of
changed sources alone, by dynamic partition overwrite; outputs of vanished
sources go. The new version is written last, so a run that failed is
done again in full by the next one, with the same result.

STR-2: the column profile is folded over micro-batches as counters (one row per
column). Each batch merges its counters into the state of the batch before and
writes the result under its own batch id (re-running a batch after a failure
rewrites the same folder: exactly-once). Only the last two states are kept, and a
run reads nothing else, however many batches went before. Families are
derived from the merged counters, so the result equals the profile of the whole
input for any split into batches, batches without a value in a column included.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.profile import counters, families, merge_counters

PATHS_AT_ONCE = 10_000  # changed sources that one read takes


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a location."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def _remove(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def incremental_run(spark: SparkSession, source_dir: str, checkpoint: str, process,
                    fmt: str = "text", schema=None, max_files_per_trigger: int | None = None,
                    options: dict | None = None):
    """STR-1: call ``process(batch_df, batch_id)`` for the files that are
    new since the last run, then stop. Returns the finished query."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    src = r.load(source_dir).withColumn("source_file", F.col("_metadata.file_path"))
    q = (src.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


# ---- sources that change ----

def list_sources(spark: SparkSession, source_dir: str) -> DataFrame:
    """(source, path, modified, length) of the files below ``source_dir``; their
    content is not read. ``source`` is the path relative to the folder."""
    fs, where = _hadoop(spark, source_dir)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source_dir)
    return files.select(_relative(F.col("path"), fs.makeQualified(where).toString()).alias("source"), "path",
                        F.col("modificationTime").alias("modified"), "length")


def _relative(path, root: str):
    """A path below ``root`` without the root, whatever slashes its scheme is written with."""
    bare = root.split(":", 1)[-1].lstrip("/") if ":" in root else root.lstrip("/")
    return F.regexp_replace(F.substring_index(path, bare.rstrip("/") + "/", -1), "^/+", "")


def source_changes(listing: DataFrame, known: DataFrame) -> DataFrame:
    """(source, path, modified, length, action): ``new``, ``changed``, ``vanished`` or ``same``."""
    old = known.select("source", F.col("modified").alias("old_modified"), F.col("length").alias("old_length"))
    action = (F.when(F.col("old_length").isNull(), "new").when(F.col("path").isNull(), "vanished")
              .when((F.col("modified") != F.col("old_modified")) | (F.col("length") != F.col("old_length")), "changed").otherwise("same"))
    return listing.join(old, "source", "full_outer").select("source", "path", "modified", "length", action.alias("action"))


def _versions(spark: SparkSession, state_dir: str) -> int:
    """Number of the last version (0 without one); versions count from 1."""
    if not _exists(spark, state_dir):
        return 0
    fs, where = _hadoop(spark, state_dir)
    done = [f.getPath().getName() for f in fs.listStatus(where) if _exists(spark, posixpath.join(f.getPath().toString(), "_SUCCESS"))]
    return max((int(n.split("=")[1]) for n in done if n.startswith("version=")), default=0)


def sync_sources(spark: SparkSession, source_dir: str, out_dir: str, state_dir: str,
                 process: Callable[[DataFrame], DataFrame], fmt: str = "parquet", schema=None,
                 options: dict | None = None) -> DataFrame:
    """STR-1 with changed sources: bring ``out_dir`` (Parquet, one partition
    per source, named by the hash of its path) in line with the files of
    ``source_dir``. ``process`` maps the rows of sources (with the column
    ``source``, which it keeps) to output rows. Returns the sources with the action taken."""
    version = _versions(spark, state_dir)
    at = posixpath.join(state_dir, f"version={version}")
    listing = list_sources(spark, source_dir)
    known = spark.read.parquet(at).where("action <> 'vanished'") if version else listing.where("false")
    after = posixpath.join(state_dir, f"version={version + 1}")
    pending = posixpath.join(state_dir, f"pending-{version + 1}")
    source_changes(listing, known).write.mode("overwrite").parquet(pending)
    changes = spark.read.parquet(pending)

    for keys in _some(changes.where("action IN ('changed', 'vanished')").select(F.md5("source"))):
        for key in keys:  # also a changed source that gives no row any more
            _remove(spark, posixpath.join(out_dir, f"source_key={key}"))
    reader = spark.read.format(fmt).options(**(options or {}))
    reader = reader.schema(schema) if schema is not None else reader
    fs, where = _hadoop(spark, source_dir)
    qualified = fs.makeQualified(where).toString()
    for paths in _some(changes.where("action IN ('new', 'changed')").select("path")):
        rows = reader.load(paths)
        named = rows.withColumn("source", _relative(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), qualified))
        (process(named).withColumn("source_key", F.md5("source")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("source_key").parquet(out_dir))
    changes.write.parquet(after)  # the commit
    _remove(spark, pending)
    return spark.read.parquet(after)


def _some(names: DataFrame) -> Iterator[list[str]]:
    """The single column of ``names``, in lists of at most ``PATHS_AT_ONCE``."""
    held: list[str] = []
    for row in names.toLocalIterator():
        held.append(row[0])
        if len(held) == PATHS_AT_ONCE:
            yield held
            held = []
    if held:
        yield held


# ---- the folded profile ----

def fold_counters(spark: SparkSession, state_dir: str, batch: DataFrame, batch_id: int, columns: list[str] | None = None) -> None:
    """Merge a batch's counters into the state of the batch before."""
    cols = columns or [c for c in batch.columns if c not in ("row_idx", "source_file")]
    own = counters(batch, cols).drop("chunk")
    before = posixpath.join(state_dir, f"batch={batch_id - 1}")
    if batch_id > 0 and _exists(spark, before):
        own = own.unionByName(spark.read.schema(own.schema).parquet(before))
    merge_counters(own.coalesce(1)).write.mode("overwrite").parquet(posixpath.join(state_dir, f"batch={batch_id}"))  # one row per column
    _remove(spark, posixpath.join(state_dir, f"batch={batch_id - 2}"))


def incremental_profile(spark: SparkSession, source_dir: str, state_dir: str, checkpoint: str,
                        schema, columns: list[str] | None = None, fmt: str = "parquet",
                        max_files_per_trigger: int = 1) -> DataFrame:
    """STR-2: fold PRF-1 over the micro-batches of a file stream; returns
    the merged profile (column, pos, family, max_len, max_int, non_null)."""
    incremental_run(spark, source_dir, checkpoint, lambda batch, k: fold_counters(batch.sparkSession, state_dir, batch, k, columns),
                    fmt=fmt, schema=schema, max_files_per_trigger=max_files_per_trigger)
    kept = spark.read.parquet(state_dir)  # two states at most
    last = kept.agg(F.max("batch")).first()[0]
    return families(kept.where(F.col("batch") == last).drop("batch"))
