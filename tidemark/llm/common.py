"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
import sys
import types
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir


def staged_path(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` that goes when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def staged(df: DataFrame, label: str, *parts: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder of ``spark.checkpoint.dir``
    (a folder per value of the columns ``parts``) and read it back: lineage
    ends there, and the files outlive executors. They go when the driver's JVM
    ends."""
    spark = df.sparkSession
    path = staged_path(spark, label)
    (df.repartition(*parts).write.partitionBy(*parts) if parts else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a table of ``staged`` that no plan reads any more."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process (functions are
    shipped by value, so module globals are new in every task)."""
    name = "_tidemark_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object of a class that is shipped by value."""
    return spark.sparkContext.broadcast((uuid.uuid4().hex, cloudpickle.dumps(value)))


def received(sent: Broadcast):
    """The object of ``send``, unpacked once per worker process."""
    token, data = sent.value
    cache = worker_cache()
    if cache.get("received_token") != token:
        for kept in [k for k in cache if k == "received" or isinstance(k, tuple)]:
            cache.pop(kept)  # a worker keeps one operator's tables at a time
        cache["received_token"], cache["received"] = token, pickle.loads(data)
    return cache["received"]
