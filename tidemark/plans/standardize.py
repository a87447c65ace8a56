"""Composite user-level operators: ``standardize`` (PIPE-1),
``standardize_sampled`` (PIPE-2) and ``round_trip`` (PIPE-4).

``standardize`` reads its header first, then the cells twice: ONE
aggregate pass computes the column profile, the numeric acceptance counts
and the first value of each position axis for all columns together (a
one-row result, fetched to fix the static schema); the second pass is the
typed projection, evaluated lazily by the caller's write. Lines of
``read_lines`` were counted once before; from then on a pass over them is
one scan of the files, and their headers are none.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import NUMBER_RX, SPECIAL_RX, parse_number
from tidemark.functions.text import to_ascii
from tidemark.operators import coerce as co
from tidemark.functions.time import to_utc
from tidemark.operators.compare import DEFAULT_TOKENS, reconcile
from tidemark.operators.labels import check_labels
from tidemark.operators.profile import INT32_MAX, INT64_MAX, chunk_id, chunk_rows, text_flags
from tidemark.operators.structure import check_widths, infer_quoting
from tidemark.session import checkpoint_dir
from tidemark.sinks.writers import write_csv
from tidemark.sources.delimited import cells_table, header_layout, read_exported, unquote
from tidemark.sources.lines import header_labels, header_rows, read_lines


CHUNK_ELEMENTS = 1e7  # cells per chunk whose column families are compared


@dataclass
class Standardized:
    table: DataFrame          # typed rows (lazy)
    qc: DataFrame             # qc_messages (lazy)
    types: dict               # column -> family / decision (from the one aggregate)
    quoting: DataFrame        # AGG-3: quoting style per file (lazy)


def _stats(flags: DataFrame, cols: list[str], absent: str, positions: list[str], times: list[str], rows: int) -> dict:
    """Profile, numeric acceptance, first value of each position axis and
    parsable times of all columns, as one row: aggregated per chunk of
    ``rows`` rows, then over the chunks (whose families may disagree)."""
    from tidemark.operators.profile import _family
    from tidemark.operators.profile import _stats as profile_stats
    per, over = [], []
    for c in cols:
        v, num = F.col(f"`v__{c}`"), F.col(f"`fn__{c}`")
        ok = v.isNotNull() & (v != "") & (v != " ")
        per += profile_stats(c)
        per += [F.sum(F.when(ok, 1).otherwise(0)).alias(f"e__{c}"),
                F.sum(F.when(v == F.lit(absent), 1).otherwise(0)).alias(f"a__{c}"),
                F.sum(F.when(ok & num, 1).otherwise(0)).alias(f"p__{c}")]
        over += [F.sum(F.col(f"`{x}__{c}`")).alias(f"{x}__{c}") for x in "nbifeap"]
        fam = _family(*[F.col(f"`{x}__{c}`") for x in "nbif"])
        over += [F.max(F.col(f"`m__{c}`")).alias(f"m__{c}"),
                 F.count_distinct(F.when(F.col(f"`n__{c}`") > 0, fam)).alias(f"families__{c}")]
        if c in positions:
            at = F.when(v.isNotNull(), F.col("row_idx"))
            per += [F.min_by(v, at).alias(f"first__{c}"), F.min(at).alias(f"at__{c}")]
            over.append(F.min_by(F.col(f"`first__{c}`"), F.col(f"`at__{c}`")).alias(f"first__{c}"))
        if c in times:
            per.append(F.count(to_utc(v)).alias(f"t__{c}"))
            over.append(F.sum(F.col(f"`t__{c}`")).alias(f"t__{c}"))
    chunks = flags.groupBy(chunk_id("row_idx", rows).alias("chunk")).agg(*per)
    return chunks.agg(*over).first().asDict()


def standardize(lines: DataFrame, absent: str = "NA", time_cols: list[str] | None = None,
                time_mode: str | None = None, int_overflow: str = "string",
                axis_specs: dict | None = None, numeric_terms: list[str] | None = None,
                string_terms: list[str] | None = None, block_col: str | None = None,
                tokens: dict | None = None, source_tz: str | None = None,
                chunk_elements: float = CHUNK_ELEMENTS) -> Standardized:
    """PIPE-1 over a ``lines`` DataFrame of ONE header layout: ``tokens``
    replaced in inner cells (PRJ-3; the default map for a delimiter other
    than the comma, ``{}`` for none), cells unwrapped by their row's quote
    style, one type decision per column, and QC messages."""
    axis = {k.lower() for k in (axis_specs or co.AXIS_SPECS)}
    nums = [t.lower() for t in (numeric_terms if numeric_terms is not None else co.NUMERIC_TERMS)]
    strs = [t.lower() for t in (string_terms if string_terms is not None else co.STRING_TERMS)]
    header = header_layout(lines)
    if tokens is None and header[0] != ",":
        tokens = DEFAULT_TOKENS
    cells = cells_table(lines, block_col=block_col, unwrap=True, tokens=tokens, header=header)
    cols = [c for c in cells.columns if c not in ("file", "row_idx")]
    positions = [c for c in cols if c.lower() in axis]
    times = [c for c in cols if time_mode and c in (time_cols or [])]
    flags = text_flags(cells, cols, keep=[F.col("row_idx")])
    row = _stats(flags, cols, absent, positions, times, chunk_rows(chunk_elements, len(cols)) or 1)

    types, out, notes = {}, [], []
    for c in cols:
        n, b, i, f = (row[f"{p}__{c}"] or 0 for p in "nbif")
        mx = row[f"m__{c}"]
        fam = ("object" if n == 0 else "bool" if b == n else "int" if i == n else
               "float" if f == n else "object")
        if fam == "int" and mx > (INT32_MAX if int_overflow == "string" else INT64_MAX):
            fam = "object"
        if row[f"families__{c}"] > 1:
            notes.append(("WARNING", "chunk_types", c, f"parts of the column look like different types; kept as {fam}"))
        low = c.lower()
        v = F.col(f"`{c}`")
        decision = fam
        if fam == "object":
            if c in positions:
                first = row.get(f"first__{c}") or ""
                parts = first.split(".")
                prec = len(parts[-1]) if len(parts) == 2 else 0
                expr, decision = F.bround(parse_number(v), prec), f"position({prec})"
                if (row[f"e__{c}"] or 0) > (row[f"a__{c}"] or 0) + (row[f"p__{c}"] or 0):
                    lost = row[f"e__{c}"] - row[f"a__{c}"] - row[f"p__{c}"]
                    notes.append(("WARNING", "position_lost", c, f"{lost} cells are no number and became empty"))
            elif c in times and row[f"t__{c}"]:
                expr, decision = co.normalize_time(v, time_mode, source_tz=source_tz), f"time({time_mode})"
                if row[f"t__{c}"] < n:
                    notes.append(("WARNING", "time_lost", c, f"{n - row[f't__{c}']} cells are no time and became empty"))
            elif (row[f"e__{c}"] or 0) - (row[f"a__{c}"] or 0) == (row[f"p__{c}"] or 0):
                expr, decision = parse_number(v), "numeric"
            else:
                expr, decision = to_ascii(v, "replace"), "text"
            if c in times and not row[f"t__{c}"]:
                notes.append(("WARNING", "time_unparsed", c, "no cell is a time; the column is left as it was"))
        elif any(t in low for t in strs):
            expr, decision = co.force_string(v), "string"
        elif fam == "int":
            expr = F.trim(v).cast("bigint")
        elif fam == "float":
            expr = parse_number(v)
        elif fam == "bool":
            expr = F.lower(v) == F.lit("true")
        else:
            expr = v
        if fam != "object" and any(t in low for t in nums) and decision == fam:
            decision = f"{fam}(numeric term)"
        types[c] = decision
        out.append(expr.alias(c))
    table = cells.select("row_idx", *out)
    none = F.lit(None)
    qc = (check_widths(lines, block_col, header)
          .select("file", "severity", F.lit("row_width").alias("code"), "row_idx",
                  none.cast("string").alias("column"),
                  F.concat(F.lit("row "), F.col("row_idx").cast("string"),
                           F.lit(" has "), F.col("width").cast("string"), F.lit(" cells under "),
                           F.col("expected").cast("string"), F.lit(" labels")).alias("message"))
          .unionByName(check_labels(header_labels(lines), key=["file"])
                       .select("file", "severity", "code", none.cast("long").alias("row_idx"),
                               F.col("label").alias("column"), "message")))
    if notes:
        spark = lines.sparkSession
        said = F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip(("severity", "code", "column", "message"), note)])
                         for note in notes])
        qc = qc.unionByName(spark.range(1).select(F.inline(said)).select(
            none.cast("string").alias("file"), "severity", "code", none.cast("long").alias("row_idx"), "column", "message"))
    n_text = sum(t in ("text", "object") for t in types.values())
    quoting = infer_quoting(lines, header_rows(lines).select("file", F.lit(n_text).alias("n_text")))
    return Standardized(table, qc, types, quoting)


def standardize_sampled(cells: DataFrame, window: int | None = 500, absent: str = "NA",
                        sample_size: int = 0, ascii_only: bool = False) -> tuple[DataFrame, dict]:
    """PIPE-2: types guessed on the first ``window`` rows (SRC-5; None: on
    all rows), every cell normalised by its column's type (COE-6), altitude
    / depth forced to Decimal (COE-7), columns without any value dropped
    (PRJ-8, booleans kept), optional first-``sample_size`` rows (LIM-1),
    optionally without characters beyond ASCII (COE-5). Cells beyond the
    window that do not fit their type become NULL; :func:`sampled_losses`
    counts them."""
    from tidemark.operators.profile import value_counts
    cols = [c for c in cells.columns if c not in ("file", "row_idx")]
    if sample_size:
        cells = cells.where(F.col("row_idx") < sample_size)
    types = _sampled_types(cells, window, cols)
    typed = cells.select("row_idx", *[_sampled_cell(c, types[c], absent, ascii_only).alias(c) for c in cols])
    kept = {r["column"] for r in value_counts(typed, cols, absent="").where("kept").collect()}
    keep = [c for c in cols if c in kept]
    return typed.select("row_idx", *[F.col(f"`{c}`") for c in keep]), {c: types[c] for c in keep}


def _sampled_types(cells: DataFrame, window: int | None, cols: list[str]) -> dict[str, str]:
    from tidemark.operators.profile import guess_types
    return {r["column"]: r["type"] for r in guess_types(cells, window, cols).collect()}


def _sampled_cell(c: str, type_name: str, absent: str, ascii_only: bool):
    cell = co.normalize_cell(c, type_name, absent)
    return to_ascii(cell, "ignore") if ascii_only and type_name in ("String", "Bool") else cell


def sampled_losses(cells: DataFrame, window: int | None = 500, absent: str = "NA") -> DataFrame:
    """QC of PIPE-2: per column (column, type, n_lost) the cells with text
    (other than the absent token) that its guessed type could not take.
    One aggregate over the whole table."""
    cols = [c for c in cells.columns if c not in ("file", "row_idx")]
    types = _sampled_types(cells, window, cols)

    def lost(c):
        text = F.col(f"`{c}`").cast("string")
        given = text.isNotNull() & (F.trim(text) != "") & (text != F.lit(absent))
        return F.sum(F.when(given & co.normalize_cell(c, types[c], absent).isNull(), 1).otherwise(0))

    wide = cells.agg(*[lost(c).cast("long").alias(f"x{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.coalesce(F.col(f"x{i}"), F.lit(0)).alias("n_lost"))
        for i, c in enumerate(cols)])))


def round_trip(df: DataFrame, row_idx: str = "row_idx", quoting: str = "minimal", folder: str | None = None,
               **opts):
    """PIPE-4: export ``df`` as CSV (SNK-3), read it back (rows numbered
    across the parts; cells may hold quotes and line breaks) and reconcile
    the reread cells with the source text. A CSV cell cannot tell NULL from
    the empty text, so NULL is compared as the empty text here."""
    spark = df.sparkSession
    folder = folder or os.path.join(checkpoint_dir(spark), f"round-trip-{uuid.uuid4().hex}")
    write_csv(df, folder, quoting=quoting, order_by=row_idx)
    back = read_exported(spark, folder)
    src = df.select(row_idx, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
                               for c in df.columns if c != row_idx])
    return reconcile(src, back, on=row_idx, **opts)


def apply_chain(df: DataFrame, steps) -> DataFrame:
    """UDF-3 / UDF-1: an ordered chain of ``DataFrame -> DataFrame`` steps."""
    for step in steps:
        df = df.transform(step)
    return df


def first_files(files: DataFrame, n: int, name: str = "name") -> DataFrame:
    """LIM-2: the first ``n`` distinct files by name (a distributed top-k;
    ``n`` <= 0 keeps all)."""
    names = files.select(name).distinct()
    return names if n <= 0 else names.orderBy(name).limit(n)


def text_column_counts(lines: DataFrame, block_col: str | None = None) -> DataFrame:
    """(file, n_text): per file, the number of columns whose profile
    family is ``object``. Works for any number of files and header
    layouts at once: cells are profiled in long form (file, pos, cell)
    with a partial aggregate per partition, so the shuffle carries one
    row per (file, column) and partition, never the cells themselves."""
    from tidemark.operators.profile import BOOL_RX as B, INT_RX as I
    from tidemark.operators.structure import parsed_rows
    r = parsed_rows(lines, block_col)
    cells = (r.select("file", "n_labels", "quote", F.posexplode("cells").alias("pos", "cell"))
              .where(F.col("pos") < F.col("n_labels"))
              .select("file", "pos", unquote(F.col("cell")).alias("v")))
    v = F.col("v")
    g = cells.groupBy("file", "pos").agg(
        F.count("*").alias("n"),
        F.sum(F.when(v.rlike(B), 1).otherwise(0)).alias("b"),
        F.sum(F.when(v.rlike(I), 1).otherwise(0)).alias("i"),
        F.sum(F.when(v.rlike(NUMBER_RX) | v.rlike(SPECIAL_RX), 1).otherwise(0)).alias("f"))
    obj = ~((F.col("b") == F.col("n")) | (F.col("i") == F.col("n")) | (F.col("f") == F.col("n")))
    labels = header_labels(lines).select("file", "pos")
    per_col = labels.join(g, on=["file", "pos"], how="left") \
        .withColumn("is_text", F.col("n").isNull() | obj)
    return per_col.groupBy("file").agg(F.sum(F.when(F.col("is_text"), 1).otherwise(0)).cast("int")
                                       .alias("n_text"))


def compare_files(spark, source_path: str, other_path: str, across_files: bool = False, **opts):
    """PIPE-3 on two delimited files (or folders of parts): both are read
    as lines (SRC-1), split quote-aware under their own headers (labels
    cleaned on both sides), paired by row number and reconciled; the byte
    sizes are compared too (AGG-13). Returns (Reconciliation, sizes)."""
    from tidemark.sinks.writers import size_compare

    def cells(path):
        c = cells_table(read_lines(spark, path, across_files=across_files), block_col="split")
        return c.drop("file")

    r = reconcile(cells(source_path), cells(other_path), on="row_idx", **opts)
    return r, size_compare(spark, source_path, other_path)


def standardize_to(lines: DataFrame, path: str, dataset: str, global_meta: dict | None = None,
                   quarantine: str | None = None, **opts) -> Standardized:
    """PIPE-1 end to end: standardise, write the QC messages as a report
    (SNK-4), and write the typed table with its variable attributes
    (SNK-1) to ``path`` when the run has no CRITICAL message, otherwise to
    ``quarantine`` (SNK-6). Variable attributes (long name, units,
    positive, encoding) come from META-2 over the decided storage types."""
    from tidemark.operators.metadata import variable_metadata
    from tidemark.sinks.writers import write_dataset, write_report
    std = standardize(lines, **opts)
    spark = lines.sparkSession
    write_report(std.qc, f"{path}/_qc")
    failed = std.qc.where(F.col("severity") == "CRITICAL").limit(1).count() > 0
    codes = {c: ("i4" if t.startswith("int") else "f8" if t.startswith(("float", "numeric", "position"))
                 else "S1") for c, t in std.types.items()}
    vars_ = spark.createDataFrame([(dataset, i, c, codes[c]) for i, c in enumerate(std.types)],
                                  "dataset string, pos long, name string, dtype string")
    meta = {r["name"]: {k: r[k] for k in ("long_name", "units", "positive", "encoding") if r[k] is not None}
            for r in variable_metadata(vars_).collect()}
    target = quarantine if (failed and quarantine) else path
    write_dataset(std.table, f"{target}/{dataset}", meta, global_meta)
    return std
