"""Delimited text with line breaks inside quoted cells, read by many tasks
(SRC-4).

Whether a line starts a record depends on every quote before it in its file. A
split is therefore read for both cases: one pass gives, per split, the
state at its end if it starts outside a quoted cell and if it starts inside one
(one row per split); composing these over the splits of a file, in order, gives
the true state at each start; a second pass cuts the records. A record that
crosses splits is handed on as pieces (two per split at most), which are put
together by their order. No line is shuffled but those pieces, and the parser is
Spark's own, record by record.

Quotes are doubled inside quoted cells; a quote elsewhere in an unquoted cell is
text, and text behind a closing quote belongs to the cell up to the delimiter.
Lines end with ``\\n`` or ``\\r\\n`` (in a record that ends so, line breaks in cells become ``\\n``); records without any character are skipped, as the CSV reader does. A cell that is
never closed takes the rest of the file, but for its last line break.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import ship_by_value

BATCH_CHARS = 1 << 22  # of the records handed back at once, about


def inside_after(line: str, inside: bool, delim: str, quote: str) -> bool:
    """Whether a quoted cell is open at the end of ``line``."""
    at = 0
    while True:
        if inside:
            end = line.find(quote, at)
            if end < 0:
                return True
            if line.startswith(quote, end + 1):  # doubled
                at = end + 2
                continue
            at = line.find(delim, end + 1)
            inside = False
        elif line.startswith(quote, at):
            at, inside = at + 1, True
            continue
        else:
            at = line.find(delim, at)
        if at < 0:
            return False
        at += len(delim)


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line"))


def split_starts(lines: DataFrame, delim: str, quote: str) -> DataFrame:
    """(file, split, inside): the state at the start of every split."""
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for file, split, line in zip(*(c.to_pylist() for c in batch.columns)):
                now = state.setdefault((file, split), [False, True])
                if quote in line:
                    now[:] = [inside_after(line, s, delim, quote) for s in now]
        if state:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*((f, s, o, i) for (f, s), (o, i) in state.items()))],
                                             ["file", "split", "outside", "inside"])

    # from outside or inside, a split either ends in one state (fixed), changes the state or keeps it
    found = lines.mapInArrow(ends, "file string, split long, outside boolean, inside boolean")
    in_order = Window.partitionBy("file").orderBy("split")  # one row per split
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    changes = (F.col("outside") & ~F.col("inside")).cast("int")
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("state"), F.col("changes").alias("at")))
    counted = found.withColumn("changes", F.sum(changes).over(in_order)).withColumn("fixed", fixed)
    last, total = F.last("fixed", ignorenulls=True).over(before), F.coalesce(F.max("changes").over(before), F.lit(0))
    state = F.when(last.isNull(), total).otherwise(last["state"] + total - last["at"])
    return counted.select("file", "split", (state % 2 == 1).alias("inside"))


def cut_records(batches: Iterator[pa.RecordBatch], delim: str, quote: str) -> Iterator[pa.RecordBatch]:
    """(file, split, pos, kind, record) of the lines (file, split, line, inside) of a task, in batches of
    about ``BATCH_CHARS`` characters, line breaks in cells included."""
    names = ["file", "split", "pos", "kind", "record"]
    out: list[tuple] = []
    held: list[str] = []
    at, inside, kind, pos, size = None, False, "whole", 0, 0
    for batch in batches:
        for file, split, line, start in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, split) != at:
                if held:
                    out.append((*at, pos, "tail" if kind == "tail" else "head", "\n".join(held)))
                at, inside, held, pos = (file, split), start, [], 0
                kind = "tail" if start else "whole"  # lines of a record that starts before
            held.append(line)
            size += len(line) + 1
            inside = inside_after(line, inside, delim, quote) if quote in line else inside
            if not inside:
                out.append((file, split, pos, "end" if kind == "tail" else "whole", "\n".join(held)))
                held, kind, pos = [], "whole", pos + 1
                if size >= BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)
                    out, size = [], 0
    if held:
        out.append((*at, pos, "tail" if kind == "tail" else "head", "\n".join(held)))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)


def quoted_records(spark: SparkSession, path, delim: str = ",", quote: str = '"') -> DataFrame:
    """(file, split, pos, record): the records of the files of ``path``, in the
    order of (file, split, pos); a record lies where it starts."""
    ship_by_value(sys.modules[__name__])
    lines = _lines(spark, path)
    starts = F.broadcast(split_starts(lines, delim, quote))  # one row per split of the file listing
    pieces = (lines.join(starts, ["file", "split"]).select("file", "split", "line", "inside")
              .mapInArrow(lambda batches: cut_records(batches, delim, quote), "file string, split long, pos long, kind string, record string"))
    # pieces of records that cross splits: those from a head up to the next one belong together
    torn = pieces.where("kind <> 'whole'")
    upto = Window.partitionBy("file").orderBy("split", "pos")
    heads = F.sum((F.col("kind") == "head").cast("int")).over(upto)
    joined = (torn.withColumn("of", heads).groupBy("file", "of")
              .agg(F.array_sort(F.collect_list(F.struct("split", "pos", "record"))).alias("parts"))
              .select("file", F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["pos"].alias("pos"),
                      F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))
    whole = pieces.where("kind = 'whole'").select("file", "split", "pos", "record").unionByName(joined)
    crlf = F.replace(F.expr("substring(record, 1, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))
    return whole.withColumn("record", F.when(F.endswith("record", F.lit("\r")), crlf).otherwise(F.col("record")))


def read_quoted(spark: SparkSession, path, schema: StructType | str, delim: str = ",", quote: str = '"',
                header: bool = True, bad_record: str | None = None) -> DataFrame:
    """The rows of quoted delimited files, equal to those of the CSV reader with
    ``multiLine``; a large file is read by many tasks."""
    records = quoted_records(spark, path, delim, quote)
    if header:
        records = records.where(~((F.col("split") == 0) & (F.col("pos") == 0)))
    options = {"sep": delim, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "multiLine": "true"}
    if bad_record:
        options["columnNameOfCorruptRecord"] = bad_record
    text = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1]
    return records.where(F.length("record") > 0).select(F.from_csv("record", text, options).alias("r")).select("r.*")
