"""Line scans of delimited text (SRC-1) and header sniffing (SRC-2).

Data model: ``lines(file STRING, line_no LONG, line STRING)``; line 0 of
every file is its header, data row ``row_idx = line_no - 1``. Lines of
``read_lines`` also say which rows are headers and what is known of their
quote style; tables made otherwise need not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import strip_quotes, ustrip
from tidemark.session import written

# Candidate delimiters in priority order (first wins ties).
DELIMITERS = [",", "|", ";", "\t"]


SPLIT_BROADCAST_LIMIT = 1_000_000  # split rows that may be broadcast (about 200 MB)


def read_lines(spark: SparkSession, path, encoding: str | None = None,
               across_files: bool = False, broadcast_limit: int = SPLIT_BROADCAST_LIMIT) -> DataFrame:
    """Physical lines of text files with a 0-based line number.

    Numbering is two-phase (S1): each file split is read by one task in
    order, so a line's position inside its split is its id minus the
    smallest id of the split. ONE counting pass, run here, writes the split
    table (:func:`split_table`); after that a line is read with its number
    in one scan, and headers come from the split table alone: they are a
    branch of their own (``is_header``), so Catalyst drops the text's scan
    from a plan that asks for headers only, and the headers from the rest.
    ``quote_style`` is the running quote style (WIN-1) of all rows of a
    split whose totals decide it; only if some split is undecided there is a
    ``balance_before`` to go on from. With ``across_files`` the numbering
    continues over the files of ``path`` in name order (a multi-part export
    is one table), ``file`` = ``path``. Undecodable bytes become U+FFFD
    (``errors='replace'``).

    A line whose split is not in the table or whose position is beyond its
    count (files or split sizes changed in between) is an error, never a
    wrong number.
    """
    reader = spark.read.format("text").option("recursiveFileLookup", across_files)
    if encoding:
        reader = reader.option("encoding", encoding)
    paths = [path] if isinstance(path, str) else list(path)
    raw = (reader.load(paths)
           .select(F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("split"),
                   F.monotonically_increasing_id().alias("_id"),
                   F.make_valid_utf8("value").alias("line")))
    table = written(split_table(raw, across_files), "splits")
    n_splits, undecided = table.agg(F.count("*"), F.count_if(F.col("quote_style").isNull())).first()
    side = table.drop("head")
    # one row per split, counted above: within the limit it is broadcast, so
    # the lines themselves are never shuffled to get their numbers
    if n_splits <= broadcast_limit:
        side = F.broadcast(side)
    extra = ["quote_style", "balance_before"] if undecided else ["quote_style"]
    at = F.col("_id") - F.col("_first")
    stale = F.col("_off").isNull() | (at < 0) | (at >= F.col("_n"))
    number = (F.when(stale, F.raise_error(F.lit("the files or their splits changed while they were read")).cast("long"))
              .otherwise(F.col("_off") + at))
    headers = table.where(F.col("_off") == 0).select(
        "file", F.lit(0).cast("long").alias("line_no"), F.col("head").alias("line"),
        F.col("_off").alias("split"), F.lit(True).alias("is_header"), *extra)
    # ``split`` becomes the first line number of the split: a bounded
    # block key that orders like the lines themselves
    data = (raw.join(side, on=["file", "split"], how="left")
            .where(F.coalesce((F.col("_off") > 0) | (F.col("_id") != F.col("_first")), F.lit(True)))
            .select("file", number.alias("line_no"), "line", F.col("_off").alias("split"),
                    F.lit(False).alias("is_header"), *extra))
    out = headers.unionByName(data)
    if across_files:
        name = paths[0] if len(paths) == 1 else ",".join(paths)
        out = out.withColumn("file", F.lit(name))
    return out


def split_table(raw: DataFrame, across_files: bool = False) -> DataFrame:
    """One row per file split of ``raw(file, split, _id, line)``: its rows
    ``_n``, smallest id ``_first``, first line number ``_off``, the header
    line (``head``, where the split starts with one), the quote balance of
    the data rows before it, and the quote style that all its data rows
    have, if the rows that lower (or raise) the balance cannot turn it."""
    def turn(text):  # double quotes less single quotes
        return F.length(F.replace(text, F.lit("'"), F.lit(""))) - F.length(F.replace(text, F.lit('"'), F.lit("")))

    def down(text):
        return F.least(turn(text), F.lit(0)).cast("long")

    def up(text):
        return F.greatest(turn(text), F.lit(0)).cast("long")

    # the set (of at most one value) makes this one hash aggregate of objects:
    # with the header line alone Spark would sort all lines by split
    per = raw.groupBy("file", "split").agg(
        F.count("*").alias("_n"), F.min("_id").alias("_first"),
        F.min_by(F.when(F.col("split") == 0, F.col("line")), "_id").alias("_line"),
        F.sum(down("line")).alias("_down"), F.sum(up("line")).alias("_up"),
        F.collect_set(F.when(turn("line") != 0, True)).alias("_turns"))
    w = (Window.orderBy("file", "split") if across_files else Window.partitionBy("file").orderBy("split")
         ).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    per = (per.withColumn("head", F.when(F.col("_off") == 0, F.col("_line")))
           .withColumn("_down", F.col("_down") - F.coalesce(down("head"), F.lit(0)))
           .withColumn("_up", F.col("_up") - F.coalesce(up("head"), F.lit(0)))
           .withColumn("balance_before", F.coalesce(F.sum(F.col("_down") + F.col("_up")).over(w), F.lit(0))))
    before = F.col("balance_before")
    style = (F.when(F.size("_turns") == 0, F.when(before >= 0, F.lit('"')).otherwise(F.lit("'")))
             .when(before + F.col("_down") >= 0, F.lit('"'))
             .when(before + F.col("_up") < 0, F.lit("'")))
    return per.select("file", "split", "_n", "_first", "_off", "head", "balance_before", style.alias("quote_style"))


def data_rows(lines: DataFrame) -> DataFrame:
    """Data lines with their 0-based ``row_idx``."""
    if "is_header" in lines.columns:
        lines = lines.where(~F.col("is_header")).drop("is_header")
    else:
        lines = lines.where(F.col("line_no") > 0)
    return lines.withColumn("row_idx", F.col("line_no") - 1)


def header_rows(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("is_header") if "is_header" in lines.columns else F.col("line_no") == 0)


def sniff_header(lines: DataFrame) -> DataFrame:
    """SRC-2: delimiter = the most frequent candidate in the header (first
    wins ties); labels = header without quote characters, split on it,
    each stripped. Returns (file, delim, labels array)."""
    h = header_rows(lines)
    counts = F.array(*[F.length("line") - F.length(F.replace("line", F.lit(d), F.lit("")))
                       for d in DELIMITERS])
    idx = F.array_position(counts, F.array_max(counts))
    delim = F.try_element_at(F.array(*[F.lit(d) for d in DELIMITERS]), idx.cast("int"))
    h = h.select("file", "line", delim.alias("delim"))
    labels = F.transform(F.split(strip_quotes("line"), F.concat(F.lit("\\Q"), "delim", F.lit("\\E")), -1),
                         lambda x: ustrip(x))
    return h.select("file", "delim", labels.alias("labels"))


def header_labels(lines: DataFrame) -> DataFrame:
    """(file, pos, label) rows of every header (for JOIN-2 / PRJ-2)."""
    return (sniff_header(lines)
            .select("file", F.posexplode("labels").alias("pos", "label"))
            .withColumn("pos", F.col("pos").cast("int")))
