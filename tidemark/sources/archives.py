"""Delimited members of zip archives (SRC-6, UDF-4).

The archives are read with Spark's ``binaryFile`` source (one row per
archive) and opened inside the tasks by ``mapInPandas``; every member
whose name has a wanted extension is decoded line by line (bad bytes
replaced). Unreadable archives are reported, not raised, so they can be
routed to quarantine.
"""

from __future__ import annotations

import io
import itertools
import sys
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES_SCHEMA = "archive string, file string, line_no long, line string, error string"


def _archive_lines(path: str, content: bytes, exts: tuple[str, ...], encoding: str):
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for info in z.infolist():
                if info.is_dir() or not info.filename.lower().endswith(exts):
                    continue
                with z.open(info) as fh:
                    text = io.TextIOWrapper(fh, encoding=encoding, errors="replace", newline="")
                    for i, line in enumerate(text):
                        yield path, info.filename, i, line.rstrip("\r\n"), None
    except (zipfile.BadZipFile, OSError, EOFError) as e:  # unreadable archive
        yield path, None, None, None, f"{type(e).__name__}: {e}"


BATCH_LINES = 10_000  # lines handed back at once
MAX_ARCHIVE = 1 << 30  # bytes of an archive that one cell may hold


def archive_lines(files: DataFrame, exts=(".csv",), encoding: str = "utf-8") -> DataFrame:
    """``files(path, content)`` -> (archive, file, line_no, line, error), in
    batches of bounded size; an archive that turns out to be unreadable gives a
    row with ``error`` after the lines read so far."""
    wanted = tuple(e.lower() for e in exts)
    columns = ["archive", "file", "line_no", "line", "error"]

    def run(batches):
        for pdf in batches:
            for p, c in zip(pdf["path"], pdf["content"]):
                found = _archive_lines(p, bytes(c), wanted, encoding)
                while rows := list(itertools.islice(found, BATCH_LINES)):
                    yield pd.DataFrame(rows, columns=columns).astype({"line_no": "Int64"})

    from tidemark.session import ship_by_value
    ship_by_value(sys.modules[__name__])
    return files.select("path", "content").mapInPandas(run, LINES_SCHEMA)


def pack_zip(texts: DataFrame, member: str) -> DataFrame:
    """``texts(path, text)`` -> (path, content): an archive of each text as
    ``member``, next to a member of another kind."""
    def run(batches):
        for pdf in batches:
            packed = []
            for text in pdf["text"]:
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("readme.txt", "not wanted")
                    z.writestr(member, text)
                packed.append(held.getvalue())
            yield pd.DataFrame({"path": pdf["path"], "content": packed})

    from tidemark.session import ship_by_value
    ship_by_value(sys.modules[__name__])
    return texts.select("path", "text").mapInPandas(run, "path string, content binary")


def read_zip_lines(spark: SparkSession, path: str, exts=(".csv",), encoding: str = "utf-8",
                   glob: str = "*.zip", max_bytes: int = MAX_ARCHIVE) -> DataFrame:
    """(archive, file, line_no, line, error) for every wanted member line;
    a row with ``error`` set (and no line) marks a bad archive, or one of more
    than ``max_bytes``, whose content is never read (it would not fit one cell)."""
    # the file source packs archives into partitions of at most
    # maxPartitionBytes (a larger archive gets a partition of its own); the
    # condition on the length reaches the source, which skips the content
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    large = files.where(F.col("length") > max_bytes).select(
        F.col("path").alias("archive"), F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("line_no"),
        F.lit(None).cast("string").alias("line"), F.concat(F.lit("TooLarge: "), F.col("length").cast("string"), F.lit(" bytes")).alias("error"))
    return archive_lines(files.where(F.col("length") <= max_bytes), exts, encoding).unionByName(large)


def zip_lines(zl: DataFrame) -> DataFrame:
    """Good members as ``lines(file, line_no, line)`` (file = archive!member)."""
    return (zl.where(F.col("error").isNull())
              .select(F.concat_ws("!", "archive", "file").alias("file"), "line_no", "line"))


def bad_archives(zl: DataFrame) -> DataFrame:
    return zl.where(F.col("error").isNotNull()).select("archive", "error")
