"""Structural QC of delimited lines: quote-aware split and width (SRC-3,
S2), quote majority (AGG-2), running quote style (WIN-1), row-width QC
(AGG-1), token replacement (PRJ-3, S3) and delimiter normalisation (PRJ-4).

All per-line work is a Column expression over ``split`` segments, linear
in the line length (the lookahead form is quadratic).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import ustrip
from tidemark.operators.prefix import running_sum
from tidemark.sources.lines import data_rows, sniff_header

_SENTINEL = "\n"  # a physical line never holds a line feed


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _count_char(s: Column, ch) -> Column:
    return F.length(s) - F.length(F.replace(s, _lit(ch), F.lit("")))


def _segments(line: Column, quote) -> Column:
    q = _lit(quote)
    return F.split(line, F.concat(F.lit("\\Q"), q, F.lit("\\E")), -1)


def cell_width(line, delim=",", quote='"') -> Column:
    """S2: number of cells when a delimiter counts only if an even number
    of quote characters follows it in the line."""
    segs = _segments(_c(line), quote)
    n = F.size(segs)
    live = F.transform(segs, lambda s, i: F.when(((n - 1 - i) % 2) == 0, _count_char(s, delim))
                       .otherwise(F.lit(0)))
    return (F.lit(1) + F.aggregate(live, F.lit(0), lambda a, x: a + x)).cast("int")


def split_cells(line, delim=",", quote='"') -> Column:
    """SRC-3: quote-aware split; cells keep their quote characters."""
    segs = _segments(_c(line), quote)
    n = F.size(segs)
    marked = F.transform(segs, lambda s, i: F.when(((n - 1 - i) % 2) == 0,
                                                   F.replace(s, _lit(delim), F.lit(_SENTINEL)))
                         .otherwise(s))
    return F.split(F.call_function("array_join", marked, _lit(quote)), _SENTINEL, -1)


def quote_diff(line) -> Column:
    """#double quotes - #single quotes of one line (AGG-2 summand)."""
    c = _c(line)
    return (_count_char(c, '"') - _count_char(c, "'")).cast("long")


def quote_majority(lines: DataFrame) -> DataFrame:
    """AGG-2 per file over data rows: balance >= 0 -> double-quote style."""
    d = data_rows(lines)
    return (d.groupBy("file").agg(F.sum(quote_diff("line")).alias("balance"))
             .withColumn("quote", F.when(F.col("balance") >= 0, F.lit('"')).otherwise(F.lit("'"))))


def running_quote_style(lines: DataFrame, block_col: str | None = None) -> DataFrame:
    """WIN-1: each data row gets the quote style implied by the rows up to
    and including it (two-phase prefix sum, bounded blocks)."""
    d = data_rows(lines)
    d = running_sum(d, ["file"], "line_no", {"balance": quote_diff("line")}, block_col=block_col)
    return d.withColumn("quote", F.when(F.col("balance") >= 0, F.lit('"')).otherwise(F.lit("'")))


def with_header(rows: DataFrame, lines: DataFrame, header: tuple[str, list[str]] | None = None) -> DataFrame:
    """Attach (delim, labels, n_labels) of each file's header. The header
    table has one row per file; AQE broadcasts it when it is small. With a
    known ``header`` (delimiter, labels) that all files share they are
    literals, and the lines are not read for it again."""
    if header is not None:
        return (rows.withColumn("delim", F.lit(header[0]))
                .withColumn("labels", F.array(*[F.lit(x) for x in header[1]]).cast("array<string>"))
                .withColumn("n_labels", F.lit(len(header[1]))))
    h = sniff_header(lines).withColumn("n_labels", F.size("labels"))
    return rows.join(h, on="file", how="inner")


def styled_rows(lines: DataFrame, block_col: str | None = None) -> DataFrame:
    """Data rows with the quote style needed to split them. A row without
    any quote character splits the same way under either style and adds
    nothing to the balance, so only rows that contain a quote go through
    the running sum (and its shuffle); the others pass straight through
    with ``balance`` NULL. Typical data has few quoted rows, so almost no
    line text is shuffled."""
    d = data_rows(lines)
    hasq = (F.instr("line", '"') > 0) | (F.instr("line", "'") > 0)
    if "quote_style" in d.columns:
        return _styled_by_split(d, hasq)
    q = running_sum(d.where(hasq), ["file"], "line_no", {"balance": quote_diff("line")},
                    block_col=block_col)
    q = q.withColumn("quote", F.when(F.col("balance") >= 0, F.lit('"')).otherwise(F.lit("'")))
    nq = d.where(~hasq).withColumn("balance", F.lit(None).cast("long")).withColumn("quote", F.lit('"'))
    return q.unionByName(nq)


def _styled_by_split(d: DataFrame, turning: Column) -> DataFrame:
    """Data rows of ``read_lines`` with their quote style: splits whose
    totals decide it need nothing more (and no second scan, unless some
    split is undecided); the ``turning`` rows of the others take a running
    sum inside their split, on from the balance before it."""
    known = d.withColumn("balance", F.lit(None).cast("long"))
    if "balance_before" not in d.columns:
        return known.withColumnRenamed("quote_style", "quote")
    open_ = F.col("quote_style").isNull() & turning
    w = Window.partitionBy("file", "split").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    summed = (d.where(open_).withColumn("balance", F.col("balance_before") + F.sum(quote_diff("line")).over(w))
              .withColumn("quote", F.when(F.col("balance") >= 0, F.lit('"')).otherwise(F.lit("'"))))
    known = known.where(~open_).withColumn("quote", F.coalesce("quote_style", F.lit('"')))
    return summed.unionByName(known).drop("quote_style", "balance_before")


def parsed_rows(lines: DataFrame, block_col: str | None = None, full_style: bool = False,
                header: tuple[str, list[str]] | None = None) -> DataFrame:
    """Data rows with quote style, cells and width. ``full_style`` gives
    every row its running style (needed when the style is written out,
    as in delimiter normalisation); otherwise only quoted rows need it."""
    if full_style and "quote_style" in lines.columns:
        styled = _styled_by_split(data_rows(lines), F.lit(True))
    else:
        styled = running_quote_style(lines, block_col) if full_style else styled_rows(lines, block_col)
    r = with_header(styled, lines, header)
    return (r.withColumn("cells", split_cells("line", F.col("delim"), F.col("quote")))
             .withColumn("width", F.size("cells")))


def check_widths(lines: DataFrame, block_col: str | None = None,
                 header: tuple[str, list[str]] | None = None) -> DataFrame:
    """AGG-1: every data row whose width differs from its header (all of
    them, not only the first) as CRITICAL qc rows."""
    r = parsed_rows(lines, block_col, header=header)
    return (r.where(F.col("width") != F.col("n_labels"))
             .select("file", "row_idx", "width", F.col("n_labels").alias("expected"),
                     F.lit("CRITICAL").alias("severity")))


def replace_tokens_line(line, mapping: dict[str, str], ignore_case: bool = False,
                        delim: str = ",") -> Column:
    """PRJ-3 / S3 on whole lines. Keys of the form ``,x,`` become one
    lookaround pattern (adjacent tokens are all reached in one pass);
    other keys are plain replacements."""
    out = _c(line)
    flag = "(?i)" if ignore_case else ""
    framed, plain = {}, {}
    for k, v in mapping.items():
        if len(k) > 2 and k.startswith(delim) and k.endswith(delim):
            framed.setdefault(v.strip(delim), []).append(k[1:-1])
        elif k:
            plain[k] = v
    for k, v in plain.items():
        out = F.regexp_replace(out, flag + re.escape(k), v.replace("\\", "\\\\").replace("$", "\\$"))
    d = re.escape(delim)
    for repl, toks in framed.items():
        alt = "|".join(re.escape(t) for t in sorted(toks, key=len, reverse=True))
        out = F.regexp_replace(out, f"{flag}(?<={d})(?:{alt})(?={d})",
                               repl.replace("\\", "\\\\").replace("$", "\\$"))
    return out


def normalize_delimiter(lines: DataFrame, to: str = ",", block_col: str | None = None) -> DataFrame:
    """PRJ-4: rewrite data rows with ``to`` as delimiter. Cells are split
    quote-aware, stripped, and a cell that contains ``to`` and is not
    already quoted is wrapped in the file's running quote character, its
    inner quote characters doubled."""
    r = parsed_rows(lines, block_col, full_style=True)

    def fix(c, q):
        quoted = (F.length(c) >= 2) & F.startswith(c, q) & F.endswith(c, q)
        return F.when(~quoted & (F.instr(c, to) > 0),
                      F.concat(q, F.replace(c, q, F.concat(q, q)), q)).otherwise(c)

    cells = F.transform("cells", lambda c: fix(ustrip(c), F.col("quote")))
    return r.select("file", "row_idx", F.array_join(cells, to).alias("line"))


def infer_quoting(lines: DataFrame, text_columns: DataFrame, threshold: float = 0.99) -> DataFrame:
    """AGG-3 per file: observed quoted cells = quote balance / 2; over all
    cells > threshold -> ``all``; else over text cells > threshold ->
    ``nonnumeric``; else ``minimal``. ``text_columns`` gives (file,
    n_text) from the profile; the header width comes from the lines."""
    d = data_rows(lines)
    per = d.groupBy("file").agg(F.sum(quote_diff("line")).alias("balance"), F.count("*").alias("rows"))
    h = sniff_header(lines).select("file", F.size("labels").alias("columns"))
    j = per.join(h, on="file").join(text_columns, on="file", how="left")
    observed = F.col("balance") / F.lit(2.0)
    all_frac = F.try_divide(observed, (F.col("columns") * F.col("rows")).cast("double"))
    text_frac = F.try_divide(observed, (F.coalesce(F.col("n_text"), F.lit(0)) * F.col("rows")).cast("double"))
    style = (F.when(all_frac > threshold, F.lit("all"))
              .when(text_frac > threshold, F.lit("nonnumeric"))
              .otherwise(F.lit("minimal")))
    return j.select("file", "rows", "columns", F.coalesce("n_text", F.lit(0)).alias("n_text"),
                    "balance", style.alias("quoting"))
