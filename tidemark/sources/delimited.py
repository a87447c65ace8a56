"""Typed delimited scans (SRC-4), sampled scans (SRC-5), multi-part
concatenation (SRC-10), and the parse of line DataFrames into cell tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import clean_label
from tidemark.operators.compare import replace_tokens
from tidemark.operators.structure import parsed_rows
from tidemark.sources.lines import read_lines, sniff_header


def read_table(spark: SparkSession, path, schema=None, delim: str = ",", quote: str = '"',
               encoding: str = "UTF-8", header: bool = True, mode: str = "PERMISSIVE",
               quoting: str = "doubled", multi_line: bool = False, bad_record: str | None = None) -> DataFrame:
    """SRC-4: Spark's CSV reader with an explicit schema (no inference
    pass), quote character, encoding and permissive parsing. ``quoting``:
    ``doubled`` (an inner quote is doubled), ``escaped`` (by a back-slash)
    or ``none`` (quotes are text); ``multi_line`` lets quoted cells hold
    line breaks; ``bad_record`` names a string column of the schema that
    receives records which do not fit it."""
    r = (spark.read.option("header", header).option("sep", delim)
         .option("quote", "" if quoting == "none" else quote)
         .option("escape", quote if quoting == "doubled" else "\\")
         .option("multiLine", multi_line).option("encoding", encoding).option("mode", mode))
    if bad_record:
        r = r.option("columnNameOfCorruptRecord", bad_record)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def cells_table(lines: DataFrame, labels: list[str] | None = None, clean: bool = True,
                block_col: str | None = None, unwrap: bool = False, tokens: dict | None = None,
                header: tuple[str, list[str]] | None = None) -> DataFrame:
    """Lines -> (file, row_idx, <one string column per header label>).

    The header labels are a per-file fact needed for the static schema:
    they are taken from the (single) header row once; every data row is
    split quote-aware with its running quote style. Cells keep the
    source's text, quotes included; with ``unwrap`` a cell wrapped in its
    row's quote character loses the wrapping; ``tokens`` are replaced in
    inner cells first (PRJ-3). Files of different headers cannot share one schema and are refused."""
    if labels is None:
        header = header or header_layout(lines)
        labels = header[1]
    names = [_clean(x) for x in labels] if clean else labels
    r = parsed_rows(lines, block_col, header=header)
    cells = [F.try_element_at(F.col("cells"), F.lit(i + 1)) for i in range(len(names))]
    if tokens:
        cells = [replace_tokens(c, 0 < i < len(names) - 1, tokens) for i, c in enumerate(cells)]
    cols = [(unquote(c, F.col("quote")) if unwrap else c).alias(n) for c, n in zip(cells, names)]
    return r.select("file", "row_idx", *cols)


def header_layout(lines: DataFrame) -> tuple[str, list[str]]:
    """(delimiter, labels) of the one header that all files share."""
    layouts = sniff_header(lines).select("delim", "labels").distinct().limit(2).collect()
    if len(layouts) > 1:
        raise ValueError(f"more than one header layout: {layouts[0]['labels']} and {layouts[1]['labels']}")
    return (layouts[0]["delim"], list(layouts[0]["labels"])) if layouts else (",", [])


def _clean(label: str) -> str:
    import re
    return re.sub(r"[^A-Za-z0-9]+", "_", label.strip())


def unquote(col, quote='"'):
    """A cell wrapped in the quote character (text or column) loses the
    wrapping, and its doubled inner quote characters become single."""
    c = F.col(col) if isinstance(col, str) else col
    q = F.lit(quote) if isinstance(quote, str) else quote
    wrapped = (F.length(c) >= 2) & F.startswith(c, q) & F.endswith(c, q)
    return F.when(wrapped, F.replace(c.substr(F.lit(2), F.length(c) - 2), F.concat(q, q), q)).otherwise(c)


def read_exported(spark: SparkSession, path: str, delim: str = ",", quote: str = '"') -> DataFrame:
    """The rows of a folder that ``write_csv`` made: (row_idx, one string
    column per label). Quoted cells may hold line breaks and quotes, so the
    parts are read by the CSV reader, each part by one task; the parts are
    of bounded size, and rows are numbered by part order and position."""
    header = spark.read.text(f"{path}/0_header").first()
    names = header[0].split(delim)
    rows = (spark.read.schema(", ".join(f"`{n}` string" for n in names)).option("sep", delim).option("quote", quote)
            .option("escape", quote).option("multiLine", True).option("emptyValue", "").option("nullValue", None)
            .csv(f"{path}/1_rows")
            .select("*", F.col("_metadata.file_name").alias("_part"), F.monotonically_increasing_id().alias("_id")))
    # a file without line splits is read by one task in order; the table of parts has one row per file
    parts = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return rows.join(parts, "_part").select((F.col("_off") + F.col("_id") - F.col("_first")).alias("row_idx"),
                                            *[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])


def read_sampled(spark: SparkSession, path, window: int = 500) -> tuple[DataFrame, DataFrame]:
    """SRC-5: lines -> cells below the guessed header line; types guessed
    on the first ``window`` rows. Returns (cells table, guessed types)."""
    from tidemark.operators.profile import guess_types
    lines = read_lines(spark, path)
    cells = cells_table(skip_preamble(lines, guess_header_offset(lines, window)), block_col="split", unwrap=True)
    return cells, guess_types(cells.drop("file"), window)


def read_parts(spark: SparkSession, paths: list[str], fmt: str = "parquet", transform=None) -> DataFrame:
    """SRC-10 / UDF-1: concatenate parts along rows (columns matched by
    name, missing ones NULL), each optionally transformed first."""
    parts = [spark.read.format(fmt).load(p) for p in paths]
    if transform is not None:
        parts = [p.transform(transform) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def clean_header_labels(lines: DataFrame) -> DataFrame:
    """Header labels with PRJ-1 applied (file, pos, label, clean)."""
    h = sniff_header(lines)
    return (h.select("file", F.posexplode("labels").alias("pos", "label"))
             .withColumn("clean", clean_label("label")))


HEADER_TOLERANCE = 1  # fixed value: cells a header may have fewer than the usual row


def guess_header_offset(lines: DataFrame, window: int = 500) -> DataFrame:
    """SRC-5: per file, the header is the first line that reaches the
    usual number of non-empty cells of the first ``window`` lines (the most
    frequent number, the larger on ties) less a tolerance of one; lines
    before it are a preamble. Cells are split quote-aware on the delimiter
    sniffed from that window's lines; returns (file, header_line, n_cells)."""
    from tidemark.sources.lines import DELIMITERS
    w = lines.where(F.col("line_no") < window)
    counts = F.array(*[F.length("line") - F.length(F.replace("line", F.lit(d), F.lit(""))) for d in DELIMITERS])
    per_file = w.groupBy("file").agg(*[F.sum(counts[i]).alias(f"d{i}") for i in range(len(DELIMITERS))])
    tot = F.array(*[F.col(f"d{i}") for i in range(len(DELIMITERS))])
    delim = F.try_element_at(F.array(*[F.lit(d) for d in DELIMITERS]),
                             F.array_position(tot, F.array_max(tot)).cast("int"))
    d = w.join(per_file.select("file", delim.alias("delim")), on="file")
    # rows are read like a CSV reader reads them: quote-aware (double quote)
    from tidemark.operators.structure import split_cells
    cells = split_cells("line", F.col("delim"), '"')
    n = F.size(F.filter(cells, lambda c: F.length(F.trim(c)) > 0))
    counted = d.select("file", "line_no", n.alias("n"))   # at most ``window`` rows per file
    usual = (counted.groupBy("file", "n").count()
             .groupBy("file").agg(F.max_by("n", F.struct("count", "n")).alias("usual")))
    return (counted.join(usual, "file").where(F.col("n") >= F.col("usual") - HEADER_TOLERANCE)
            .groupBy("file").agg(F.min("line_no").alias("header_line"), F.min_by("n", "line_no").alias("n_cells")))


def skip_preamble(lines: DataFrame, offsets: DataFrame) -> DataFrame:
    """Lines renumbered so that each file's guessed header is its line 0;
    the lines before it go. ``offsets`` has one row per file."""
    return (lines.drop("is_header", "quote_style", "balance_before")  # of the first lines, no longer the headers
            .join(offsets.select("file", "header_line"), "file")
            .withColumn("line_no", F.col("line_no") - F.col("header_line")).where(F.col("line_no") >= 0)
            .drop("header_line"))
