"""Mergeable column profiling (PRF-1..4), type guessing on a sample
window (SRC-5), empty-column detection (PRJ-8) and chunk numbering (WIN-3).

One pass: every statistic of every column is a conditional aggregate in
ONE ``agg`` (partial aggregation on each partition, a final merge of one
row per partition or per chunk), unpivoted afterwards. The profile is
associative, so profiles of parts merge into the profile of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import NUMBER_RX, SPECIAL_RX, number_like, special_like

INT_RX = r"^\s*[+-]?\d+\s*$"
BOOL_RX = r"^(True|False|TRUE|FALSE|true|false)$"
DATE_RX = r"^\d{4}-\d{2}-\d{2}$"
INT32_MAX = 2147483647
INT64_MAX = 9223372036854775807

# family ranks of the reconciliation lattice: int < float < object
_RANK = {"int": 1, "float": 2, "object": 3}


def chunk_rows(elements: float | None, n_columns: int) -> int | None:
    """WIN-3: rows per chunk = max(1, int(elements / columns))."""
    if not elements:
        return None
    return max(1, int(elements / max(1, n_columns)))


def chunk_id(row_idx, rows: int) -> Column:
    c = F.col(row_idx) if isinstance(row_idx, str) else row_idx
    return F.floor(c / F.lit(rows)).cast("long")


def page_number(row_idx, rows_per_file: int) -> Column:
    """SNK-2: 1-based page of a row."""
    return (chunk_id(row_idx, rows_per_file) + 1).cast("int")


BOOL_WORDS = ["True", "False", "TRUE", "FALSE", "true", "false"]


def text_flags(df: DataFrame, cols: list[str], keep: list[Column] | None = None) -> DataFrame:
    """Per-value classification of text columns, each regex evaluated
    ONCE per value: a first projection holds the text and its strict
    number test, a second derives the flags from those columns (an
    integer is a number without '.', 'e' or 'E'; the special-number regex
    only runs on values that are not numbers)."""
    keep = keep or []
    first = df.select(*keep, *[x for c in cols for x in (
        F.col(f"`{c}`").cast("string").alias(f"v__{c}"),
        F.coalesce(number_like(F.col(f"`{c}`").cast("string")), F.lit(False)).alias(f"fn__{c}"))])
    out = []
    for c in cols:
        v, num = F.col(f"`v__{c}`"), F.col(f"`fn__{c}`")
        out += [v, num,
                (num & (F.instr(v, ".") == 0) & (F.instr(v, "e") == 0) & (F.instr(v, "E") == 0))
                .alias(f"fi__{c}"),
                F.when(num, F.lit(False)).otherwise(F.coalesce(special_like(v), F.lit(False)))
                .alias(f"fs__{c}"),
                F.coalesce(v.isin(*BOOL_WORDS), F.lit(False)).alias(f"fb__{c}")]
    return first.select(*[F.col(f"`{k}`") if isinstance(k, str) else k for k in
                          [c for c in first.columns if not (c.startswith("v__") or c.startswith("fn__"))]],
                        *out)


def _stats(c: str) -> list[Column]:
    v = F.col(f"`v__{c}`")
    num, is_int, special, is_bool = (F.col(f"`{p}__{c}`") for p in ("fn", "fi", "fs", "fb"))
    return [
        F.count(v).alias(f"n__{c}"),
        F.sum(is_bool.cast("long")).alias(f"b__{c}"),
        F.sum(is_int.cast("long")).alias(f"i__{c}"),
        F.sum((num | special).cast("long")).alias(f"f__{c}"),
        F.max(F.length(v)).alias(f"l__{c}"),
        # up to 18 characters fit a long; any 38 digits are exact, and a
        # longer number counts as the largest of them
        F.greatest(F.max(F.when(is_int & (F.length(v) <= 18), F.trim(v).cast("bigint"))).cast("decimal(38,0)"),
                   F.max(F.when(is_int & (F.length(v) > 18), F.coalesce(
                       F.trim(v).try_cast("decimal(38,0)"), F.lit("9" * 38).cast("decimal(38,0)"))))).alias(f"m__{c}"),
    ]


def _family(n, b, i, f) -> Column:
    return (F.when(n == 0, F.lit("object"))
             .when(b == n, F.lit("bool"))
             .when(i == n, F.lit("int"))
             .when(f == n, F.lit("float"))
             .otherwise(F.lit("object")))


def counters(df: DataFrame, columns: list[str] | None = None, chunk: Column | None = None) -> DataFrame:
    """What a profile is made of, per chunk and column: (chunk, column, pos,
    non_null, bools, ints, numbers, max_len, largest). Counts add up and
    maxima are merged, so counters of parts merge into those of the whole."""
    cols = columns or [c for c in df.columns if c != "row_idx"]
    ck = chunk.alias("chunk") if chunk is not None else F.lit(0).cast("long").alias("chunk")
    flagged = text_flags(df, cols, keep=[ck])
    stats = [a for c in cols for a in _stats(c)]
    if chunk is None:  # one group, gathered without a shuffle by key; no row without input
        wide = flagged.agg(F.min("chunk").alias("chunk"), *stats).where(F.col("chunk").isNotNull())
    else:
        wide = flagged.groupBy("chunk").agg(*stats)
    rows = []
    for pos, c in enumerate(cols):
        n, b, i, f, l, m = (F.col(f"`{p}__{c}`") for p in "nbiflm")
        zero = F.lit(0).cast("long")
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(pos).alias("pos"), n.alias("non_null"), F.coalesce(b, zero).alias("bools"),
                             F.coalesce(i, zero).alias("ints"), F.coalesce(f, zero).alias("numbers"),
                             F.coalesce(l, F.lit(0)).alias("max_len"), m.alias("largest")))
    return wide.select("chunk", F.inline(F.array(*rows)))


def merge_counters(parts: DataFrame) -> DataFrame:
    """Counters of the whole from counters of its parts."""
    total = [F.sum(c).alias(c) for c in ("non_null", "bools", "ints", "numbers")]
    return parts.groupBy("column").agg(F.min("pos").alias("pos"), *total, F.max("max_len").alias("max_len"), F.max("largest").alias("largest"))


def families(counted: DataFrame, int_overflow: str = "string", empty: str = "object") -> DataFrame:
    """Profile rows from counters (further columns, such as ``chunk``, are kept)."""
    fam = F.when(F.col("non_null") == 0, F.lit(empty)).otherwise(_family(*[F.col(c) for c in ("non_null", "bools", "ints", "numbers")]))
    limit = INT32_MAX if int_overflow == "string" else INT64_MAX  # beyond 64 bits only text keeps the digits
    fam = F.when((fam == "int") & (F.col("largest") > F.lit(limit)), F.lit("object")).otherwise(fam)
    known = ("column", "pos", "non_null", "bools", "ints", "numbers", "max_len", "largest")
    return counted.select(*[c for c in counted.columns if c not in known], "column", "pos", fam.alias("family"), "max_len",
                          F.when(fam == "int", F.col("largest").cast("long")).alias("max_int"), "non_null")


def profile(df: DataFrame, columns: list[str] | None = None, chunk: Column | None = None,
            int_overflow: str = "string") -> DataFrame:
    """PRF-1: (chunk, column, pos, family, max_len, max_int, non_null).

    Family of the text of a column: ``bool`` when every value is a
    boolean word, ``int`` when every value is an integer, ``float`` when
    every value is a number, else ``object``. An ``int`` column whose
    maximum exceeds the 32-bit range becomes ``object`` when
    ``int_overflow='string'`` (otherwise it stays ``int``, stored as long, up to
    the 64-bit range). Without any value a chunk's family is ``empty``
    (it says nothing), a whole table's is ``object``.
    """
    return families(counters(df, columns, chunk), int_overflow, empty="object" if chunk is None else "empty")


def reconcile_types(profiles: DataFrame) -> DataFrame:
    """PRF-2 over chunk profiles: int+float -> float, anything+object ->
    object, bool only when bool in every chunk (bool with anything else ->
    object), width = max length over all chunks; chunks that disagree are
    flagged (WARNING). Chunks without a value take no part; a column
    without any value is ``object``."""
    some = F.col("non_null") > 0
    rank = F.when(some, F.when(F.col("family") == "int", 1).when(F.col("family") == "float", 2)
                  .when(F.col("family") == "object", 3).otherwise(0))
    g = profiles.groupBy("column").agg(
        F.min("pos").alias("pos"),
        F.max(rank).alias("_r"),
        F.sum(F.when(some & (F.col("family") == "bool"), 1).otherwise(0)).alias("_b"),
        F.sum(F.when(some, 1).otherwise(0)).alias("_n"),
        F.count("*").alias("chunks"),
        F.count_distinct(F.when(some, F.col("family"))).alias("families"),
        F.max("max_len").alias("max_len"),
        F.max("max_int").alias("max_int"),
        F.sum("non_null").alias("non_null"))
    fam = (F.when(F.col("_n") == 0, F.lit("object"))
            .when(F.col("_b") == F.col("_n"), F.lit("bool"))
            .when(F.col("_b") > 0, F.lit("object"))
            .when(F.col("_r") == 1, F.lit("int"))
            .when(F.col("_r") == 2, F.lit("float"))
            .otherwise(F.lit("object")))
    return g.select("column", "pos", fam.alias("family"), "max_len",
                    F.when(fam == "int", F.col("max_int")).alias("max_int"), "non_null",
                    "chunks", (F.col("families") > 1).alias("chunks_disagree"))


def spark_type(family_col) -> Column:
    """Family -> Spark SQL type name."""
    f = F.col(family_col) if isinstance(family_col, str) else family_col
    return (F.when(f == "int", F.lit("bigint")).when(f == "float", F.lit("double"))
             .when(f == "bool", F.lit("boolean")).otherwise(F.lit("string")))


def storage_type(family_col) -> Column:
    """PRF-3: storage code of a family (int -> i4, float -> f8, else text)."""
    f = F.col(family_col) if isinstance(family_col, str) else family_col
    return F.when(f == "int", F.lit("i4")).when(f == "float", F.lit("f8")).otherwise(F.lit("S1"))


def string_width(max_len_col, pad: int = 2) -> Column:
    """PRF-4: storage width of a text column (max length + pad, at least 1)."""
    c = F.col(max_len_col) if isinstance(max_len_col, str) else max_len_col
    return F.greatest(c + F.lit(pad), F.lit(1))


def guess_types(df: DataFrame, window: int | None = 500, columns: list[str] | None = None) -> DataFrame:
    """SRC-5: guess (Integer, Decimal, Date, Bool, String) per column from
    the first ``window`` rows (None: all); empty cells fit every type."""
    cols = columns or [c for c in df.columns if c != "row_idx"]
    s = df if window is None else df.where(F.col("row_idx") < window)
    aggs = []
    for c in cols:
        v = F.col(f"`{c}`").cast("string")
        ne = F.trim(v) != ""
        aggs += [F.sum(F.when(ne, 1).otherwise(0)).alias(f"n__{c}"),
                 F.sum(F.when(ne & v.rlike(INT_RX), 1).otherwise(0)).alias(f"i__{c}"),
                 F.sum(F.when(ne & v.rlike(NUMBER_RX), 1).otherwise(0)).alias(f"f__{c}"),
                 F.sum(F.when(ne & v.rlike(DATE_RX) & F.try_to_date(v).isNotNull(), 1)
                        .otherwise(0)).alias(f"d__{c}"),
                 F.sum(F.when(ne & v.rlike(BOOL_RX), 1).otherwise(0)).alias(f"b__{c}")]
    wide = s.agg(*aggs)
    rows = []
    for pos, c in enumerate(cols):
        n = F.col(f"`n__{c}`")
        t = (F.when(n == 0, F.lit("String"))
              .when(F.col(f"`i__{c}`") == n, F.lit("Integer"))
              .when(F.col(f"`f__{c}`") == n, F.lit("Decimal"))
              .when(F.col(f"`d__{c}`") == n, F.lit("Date"))
              .when(F.col(f"`b__{c}`") == n, F.lit("Bool"))
              .otherwise(F.lit("String")))
        if c.lower() in ("altitude", "depth"):  # COE-7
            t = F.lit("Decimal")
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(pos).alias("pos"), t.alias("type")))
    return wide.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, columns: list[str] | None = None, absent: str = "NA") -> DataFrame:
    """Per column: number of real values (not NULL, not blank, not the
    absent token). Used by PRJ-8."""
    cols = columns or [c for c in df.columns if c != "row_idx"]
    aggs = []
    for c in cols:
        v = F.col(f"`{c}`").cast("string")
        real = v.isNotNull() & (F.trim(v) != "") & (v != F.lit(absent))
        aggs.append(F.sum(F.when(real, 1).otherwise(0)).alias(f"v__{c}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(p).alias("pos"),
                     F.col(f"`v__{c}`").cast("long").alias("n_values"))
            for p, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows))).withColumn("kept", F.col("n_values") > 0)


def drop_empty_columns(df: DataFrame, absent: str = "NA") -> DataFrame:
    """PRJ-8: drop columns without any real value (one small action, then
    a column selection; boolean columns are kept like any other)."""
    kept = [r["column"] for r in value_counts(df, absent=absent).where("kept").collect()]
    keep = [c for c in df.columns if c == "row_idx" or c in kept]
    return df.select(*[F.col(f"`{c}`") for c in keep])
