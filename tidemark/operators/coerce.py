"""Cell standardisation (COE-1..7, PRJ-5, PRJ-7).

Decisions that fix a column's type (numeric acceptance, position
precision) are one small aggregate over all columns; the conversion
itself is a projection, so the whole coercion is two scans at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import NUMBER_RX, number_like, parse_number
from tidemark.functions.text import ustrip
from tidemark.functions.time import OUT_FORMAT, days_since_epoch, format_iso, to_utc
from tidemark.operators.rules import first_rules

# Name rules. Axis specs are keyed by lower-case label.
AXIS_SPECS = {
    "decimallongitude": {"destinationName": "longitude", "units": "degrees_east"},
    "decimallatitude": {"destinationName": "latitude", "units": "degrees_north"},
    "altitude": {"destinationName": "altitude", "units": "m", "positive": "up"},
    "depth": {"destinationName": "depth", "units": "m", "positive": "down"},
}
NUMERIC_TERMS = ["_meters", "minimum_", "maximum_", "_minimum_", "_maximum", "decimal",
                 "in_meters", "inmeters"]
STRING_TERMS = ["_id", "_code"]
VARIABLE_UNITS = {"inKg": "kg", "in_meters": "m", "inmeters": "m", "WeightsN": "N"}


def _col(c: str) -> Column:
    return F.col(f"`{c}`")


def acceptance(df: DataFrame, columns: list[str], absent: str = "NA") -> DataFrame:
    """COE-1 decision per column, one aggregate for all columns:
    accepted iff (#entries - #absent) = #parsable entries, where entries
    are cells not NULL, not '' and not ' '."""
    aggs = []
    for c in columns:
        v = _col(c).cast("string")
        ok = v.isNotNull() & (v != "") & (v != " ")
        aggs += [F.sum(F.when(ok, 1).otherwise(0)).alias(f"e__{c}"),
                 F.sum(F.when(v == F.lit(absent), 1).otherwise(0)).alias(f"a__{c}"),
                 F.sum(F.when(ok & number_like(v), 1).otherwise(0)).alias(f"p__{c}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("pos"),
                     F.col(f"`e__{c}`").cast("long").alias("entries"),
                     F.col(f"`a__{c}`").cast("long").alias("absent"),
                     F.col(f"`p__{c}`").cast("long").alias("parsable"),
                     ((F.col(f"`e__{c}`") - F.col(f"`a__{c}`")) == F.col(f"`p__{c}`")).alias("accepted"))
            for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def coerce_numeric(df: DataFrame, columns: list[str] | None = None, absent: str = "NA",
                   decisions: DataFrame | None = None) -> DataFrame:
    """COE-1: accepted columns become double (unparsable cells NULL); the
    others stay text. ONE global decision per column (not per chunk)."""
    cols = columns or [c for c, t in df.dtypes if t == "string" and c != "row_idx"]
    dec = decisions if decisions is not None else acceptance(df, cols, absent)
    accepted = {r["column"] for r in dec.where("accepted").select("column").collect()}
    return df.select(*[(parse_number(_col(c)).alias(c) if c in accepted else _col(c))
                       for c in df.columns])


def _decimals(value: Column) -> Column:
    """Digits behind the one point of a text, else 0."""
    parts = F.split(F.coalesce(value, F.lit("")), r"\.", -1)
    return F.when(F.size(parts) == 2, F.length(F.try_element_at(parts, F.lit(2)))).otherwise(F.lit(0))


def position_precision(df: DataFrame, columns: list[str], precision: str = "first") -> DataFrame:
    """COE-2 / WIN-5: (column, pos, first_value, precision), in one aggregate.
    ``first``: the decimals of the first non-null value in row order
    (``min_by`` over ``row_idx``); ``max``: the most decimals of any number of the column,
    so that rounding loses no digit."""
    aggs = []
    for c in columns:
        text = _col(c).cast("string")
        aggs += [F.min_by(text, F.when(_col(c).isNotNull(), F.col("row_idx"))).alias(f"v_{c}"),
                 F.max(F.when(number_like(text), _decimals(F.trim(text)))).alias(f"p_{c}") if precision == "max" else F.lit(None).cast("int").alias(f"p_{c}")]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(columns):
        first = F.col(f"`v_{c}`")
        decimals = F.coalesce(F.col(f"`p_{c}`"), F.lit(0)) if precision == "max" else _decimals(first)
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(i).alias("pos"), first.alias("first_value"), decimals.cast("int").alias("precision")))
    return one.select(F.inline(F.array(*rows)))


def coerce_position(df: DataFrame, columns: list[str], precision: dict[str, int] | str = "first") -> DataFrame:
    """COE-2: force numeric (errors -> NULL) and round half-even to the
    column's precision (one global value per column: given, ``first`` or ``max``)."""
    if isinstance(precision, str):
        precision = {r["column"]: r["precision"]
                     for r in position_precision(df, columns, precision).collect()}
    return df.select(*[(F.bround(parse_number(_col(c)), int(precision[c])).alias(c)
                        if c in precision else _col(c)) for c in df.columns])


def normalize_time(col, mode: str = "datetime", fmt: str = OUT_FORMAT, source_tz: str | None = None) -> Column:
    """COE-3: ``datetime`` -> UTC timestamp, ``string`` -> formatted UTC
    text, ``integer`` -> whole days since 1970-01-01. Unparsable -> NULL.
    The session zone plays no part; ``source_tz`` is the zone of wall-clock text."""
    c = F.col(col) if isinstance(col, str) else col
    ts = to_utc(c, source_tz)
    if mode == "datetime":
        return ts
    if mode == "string":
        return format_iso(ts, fmt)
    if mode == "integer":
        return days_since_epoch(c)
    raise ValueError(f"unknown time mode {mode}")


def force_string(col, dtype: str | None = None) -> Column:
    """COE-4: identifier-like numbers as text; integral doubles keep no
    ``.0`` suffix."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype in ("double", "float"):
        return F.when(c == F.floor(c), c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def fill_absent(df: DataFrame, token: str = "NA", columns: list[str] | None = None) -> DataFrame:
    """PRJ-5: NULL text cells become the absent token (at sinks only)."""
    cols = columns or [c for c, t in df.dtypes if t == "string"]
    return df.na.fill(token, subset=cols) if cols else df


def normalize_cell(col, type_name: str, absent: str = "NA") -> Column:
    """COE-6 by declared type: Date -> ISO date, String -> stripped (the
    absent token -> ''), Integer -> int(float(x)), Decimal -> double,
    Bool -> text. A failed conversion gives NULL (the fill)."""
    c = (F.col(f"`{col}`") if isinstance(col, str) else col).cast("string")
    if type_name == "Date":
        return F.date_format(F.try_to_date(c), "yyyy-MM-dd")
    if type_name == "String":
        return F.when(c == F.lit(absent), F.lit("")).otherwise(ustrip(c))
    if type_name == "Integer":  # whole numbers keep all their digits; 64 bits, beyond that NULL
        whole = F.trim(c).try_cast("bigint")
        return F.when(c.rlike(NUMBER_RX), F.coalesce(F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), whole),
                                                     F.when(~c.rlike(r"^\s*[+-]?\d+\s*$"),
                                                            F.trim(c).cast("double").try_cast("bigint"))))
    if type_name == "Decimal":
        return F.when(c.rlike(NUMBER_RX), F.trim(c).cast("double"))
    return c


def column_directives(labels: DataFrame, axis_specs: dict | None = None,
                      numeric_terms: list[str] | None = None,
                      string_terms: list[str] | None = None) -> DataFrame:
    """PRJ-7 (+ COE-7, S9): per label the directive ``position`` (axis
    spec, lower-cased label), ``numeric`` (a numeric term is contained,
    case-insensitive), ``string`` (a string term) or ``none``."""
    axis = list((axis_specs or AXIS_SPECS).keys())
    nums = numeric_terms if numeric_terms is not None else NUMERIC_TERMS
    strs = string_terms if string_terms is not None else STRING_TERMS
    low = F.lower("label")
    arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    d = (F.when(F.array_contains(arr(axis), low), F.lit("position"))
          .when(F.exists(arr(nums), lambda t: F.instr(low, t) > 0), F.lit("numeric"))
          .when(F.exists(arr(strs), lambda t: F.instr(low, t) > 0), F.lit("string"))
          .otherwise(F.lit("none")))
    return labels.withColumn("directive", d)


def directives_by_rules(labels: DataFrame, rules: DataFrame, axis_specs: dict | None = None) -> DataFrame:
    """PRJ-7 with the rules as a table ``(kind, ord, term)`` of any size;
    kinds are ``numeric`` and ``string``."""
    found = first_rules(labels, {"_numeric": ("label", "numeric"), "_string": ("label", "string")}, rules)
    axis = F.lower("label").isin(list((axis_specs or AXIS_SPECS).keys()))
    d = (F.when(axis, F.lit("position")).when(F.col("_numeric").isNotNull(), F.lit("numeric"))
          .when(F.col("_string").isNotNull(), F.lit("string")).otherwise(F.lit("none")))
    return found.withColumn("directive", d).drop("_numeric", "_string")
