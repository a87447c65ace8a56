"""DuckDB oracles for profiling and coercion queries."""

from __future__ import annotations

NUM_RX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_RX = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
INT_RX = r"^\s*[+-]?\d+\s*$"
BOOL_RX = r"^(True|False|TRUE|FALSE|true|false)$"
DATE_RX = r"^\d{4}-\d{2}-\d{2}$"


def m(expr: str, scale: int = 2) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,{scale})) AS VARCHAR)"


CUSTOMER_TEXT = f"""
ct AS (
  SELECT c_custkey AS row_idx, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
         CAST(c_nationkey AS VARCHAR) AS c_nationkey,
         CASE WHEN c_custkey % 13 = 0 THEN 'NA' WHEN c_custkey % 37 = 0 THEN ''
              WHEN c_custkey % 59 = 0 THEN ' ' ELSE {m('c_acctbal')} END AS c_acctbal,
         c_mktsegment,
         CASE WHEN c_custkey % 211 = 0 THEN 'see note' ELSE CAST(c_custkey * 7 AS VARCHAR) END AS c_comment,
         '' AS c_notes,
         CASE WHEN c_custkey % 71 = 70 THEN '?'
              WHEN c_custkey % 9 = 0 THEN {m('(c_custkey * 37 % 18000) / 100.0 - 90.0')}
              ELSE {m('(c_custkey * 37 % 18000) / 100.0 - 90.0 + 0.0011 * (c_custkey % 9)', 4)}
         END AS decimalLatitude,
         {m('(c_custkey * 53 % 36000) / 100.0 - 180.0 + 0.001 * (c_custkey % 7)', 3)} AS decimalLongitude
  FROM customer)"""

CT_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_comment",
           "c_notes", "decimalLatitude", "decimalLongitude"]

LINEITEM_TEXT = f"""
lt AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
         CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
         CASE WHEN l_orderkey % 10007 = 10006 THEN {m('l_quantity', 1)}
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS l_quantity,
         {m('l_extendedprice')} AS l_extendedprice, {m('l_discount')} AS l_discount,
         CASE WHEN l_orderkey % 41 = 0 THEN 'NA' ELSE {m('l_tax')} END AS l_tax,
         l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
         CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS l_isreturn,
         CAST(l_orderkey * 1000003 AS VARCHAR) AS l_bigkey,
         l_orderkey AS _key
  FROM lineitem)"""

LT_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_isreturn", "l_bigkey"]


def _rx(expr: str, rx: str) -> str:
    return f"regexp_matches({expr}, '{rx}')"


def _profile_rows(source: str, cols: list[str], chunk: str) -> str:
    parts = []
    for pos, c in enumerate(cols):
        v = c
        parts.append(f"""
  SELECT {chunk} AS chunk, '{c}' AS column, {pos} AS pos,
         count({v}) AS n,
         sum(CASE WHEN {_rx(v, BOOL_RX)} THEN 1 ELSE 0 END) AS b,
         sum(CASE WHEN {_rx(v, INT_RX)} THEN 1 ELSE 0 END) AS i,
         sum(CASE WHEN {_rx(v, NUM_RX)} OR {_rx(v, SPECIAL_RX)} THEN 1 ELSE 0 END) AS f,
         max(length({v})) AS l,
         max(CASE WHEN {_rx(v, INT_RX)} THEN CAST(trim({v}) AS DECIMAL(38,0)) END) AS mx
  FROM {source} GROUP BY 1""")
    return " UNION ALL ".join(parts)


_FAMILY = """CASE WHEN n = 0 THEN 'object' WHEN b = n THEN 'bool' WHEN i = n THEN
    (CASE WHEN mx > 2147483647 THEN 'object' ELSE 'int' END)
    WHEN f = n THEN 'float' ELSE 'object' END"""


def column_profile() -> str:
    return f"""WITH {LINEITEM_TEXT},
s AS ({_profile_rows('lt', LT_COLS, '0')}),
fam AS (SELECT *, {_FAMILY} AS family FROM s)
SELECT "column", CAST(pos AS INTEGER) AS pos, family, CAST(coalesce(l, 0) AS INTEGER) AS max_len,
       CASE WHEN family = 'int' THEN CAST(mx AS BIGINT) END AS max_int, CAST(n AS BIGINT) AS non_null
FROM fam"""


def type_reconcile() -> str:
    rows = int(1e6 / len(LT_COLS))
    return f"""WITH {LINEITEM_TEXT},
s AS ({_profile_rows('lt', LT_COLS, f'CAST(floor(_key / {rows}) AS BIGINT)')}),
fam AS (SELECT *, {_FAMILY} AS family FROM s),
g AS (
  SELECT "column", min(pos) AS pos,
         max(CASE family WHEN 'int' THEN 1 WHEN 'float' THEN 2 WHEN 'object' THEN 3 ELSE 0 END) AS r,
         sum(CASE WHEN family = 'bool' THEN 1 ELSE 0 END) AS nb, count(*) AS chunks,
         count(DISTINCT family) AS families, max(coalesce(l, 0)) AS max_len,
         max(CASE WHEN family = 'int' THEN CAST(mx AS BIGINT) END) AS max_int, sum(n) AS non_null
  FROM fam GROUP BY "column"),
t AS (
  SELECT *, CASE WHEN nb = chunks THEN 'bool' WHEN nb > 0 THEN 'object' WHEN r = 1 THEN 'int'
                 WHEN r = 2 THEN 'float' ELSE 'object' END AS family FROM g)
SELECT "column", CAST(pos AS INTEGER) AS pos, family, CAST(max_len AS INTEGER) AS max_len,
       CASE WHEN family = 'int' THEN max_int END AS max_int, CAST(non_null AS BIGINT) AS non_null,
       families > 1 AS chunks_disagree,
       CASE family WHEN 'int' THEN 'bigint' WHEN 'float' THEN 'double' WHEN 'bool' THEN 'boolean'
                   ELSE 'string' END AS spark_type,
       CASE family WHEN 'int' THEN 'i4' WHEN 'float' THEN 'f8' ELSE 'S1' END AS storage,
       CASE WHEN family = 'object' THEN CAST(greatest(max_len + 2, 1) AS INTEGER) END AS width
FROM t"""


_GAP = "CAST(floor(_key / 1000) AS BIGINT)"
GAPPY = LINEITEM_TEXT + f""",
gt AS (SELECT * REPLACE (CASE WHEN {_GAP} % 2 = 0 THEN l_linenumber END AS l_linenumber,
                         CASE WHEN {_GAP} % 2 = 0 THEN l_discount END AS l_discount,
                         CASE WHEN {_GAP} % 2 = 0 THEN l_isreturn END AS l_isreturn) FROM lt)"""


def gaps_whole() -> str:
    return column_profile().replace(LINEITEM_TEXT, GAPPY).replace("FROM lt GROUP", "FROM gt GROUP")


def gaps_chunked() -> str:
    return f"""WITH {GAPPY},
s AS ({_profile_rows('gt', LT_COLS, _GAP)}),
fam AS (SELECT *, {_FAMILY} AS family FROM s),
g AS (
  SELECT "column", min(pos) AS pos, count(DISTINCT family) FILTER (n > 0) AS families,
         list_sort(list(DISTINCT family) FILTER (n > 0)) AS seen, max(coalesce(l, 0)) AS max_len,
         max(CASE WHEN family = 'int' THEN CAST(mx AS BIGINT) END) AS max_int, sum(n) AS non_null
  FROM fam GROUP BY "column"),
t AS (SELECT *, CASE WHEN seen = ['bool'] THEN 'bool' WHEN seen = ['int'] THEN 'int' WHEN seen IN (['float'], ['float', 'int']) THEN 'float'
                     ELSE 'object' END AS family FROM g)
SELECT "column", CAST(pos AS INTEGER) AS pos, family, CAST(max_len AS INTEGER) AS max_len, CASE WHEN family = 'int' THEN max_int END AS max_int,
       CAST(non_null AS BIGINT) AS non_null, families > 1 AS chunks_disagree FROM t"""


def _acc_rows() -> str:
    parts = []
    for pos, c in enumerate(CT_COLS):
        ok = f"({c} IS NOT NULL AND {c} <> '' AND {c} <> ' ')"
        parts.append(f"""
  SELECT '{c}' AS column, {pos} AS pos,
         CAST(sum(CASE WHEN {ok} THEN 1 ELSE 0 END) AS BIGINT) AS entries,
         CAST(sum(CASE WHEN {c} = 'NA' THEN 1 ELSE 0 END) AS BIGINT) AS absent,
         CAST(sum(CASE WHEN {ok} AND {_rx(c, NUM_RX)} THEN 1 ELSE 0 END) AS BIGINT) AS parsable
  FROM ct""")
    return " UNION ALL ".join(parts)


def numeric_accept() -> str:
    return f"""WITH {CUSTOMER_TEXT}, a AS ({_acc_rows()})
SELECT "column", CAST(pos AS INTEGER) AS pos, entries, absent, parsable,
       entries - absent = parsable AS accepted FROM a"""


def _num(c: str) -> str:
    return f"CASE WHEN {_rx(c, NUM_RX)} THEN CAST(trim({c}) AS DOUBLE) END"


def numeric_coerce() -> str:
    # The acceptance decisions are those numeric_accept checks: at every
    # scale key 0 writes 'see note' as comment and key 70 a '?' latitude,
    # so comment and latitude stay text; the numeric ones and the empty
    # notes column (no entries, nothing to contradict) become doubles.
    num = ["c_custkey", "c_nationkey", "c_acctbal", "c_notes", "decimalLongitude"]
    cols = ", ".join(f"{_num(c)} AS {c}" if c in num else c for c in CT_COLS)
    return f"WITH {CUSTOMER_TEXT}\nSELECT row_idx, {cols} FROM ct"


def standardize_sampled() -> str:
    # Types are those sampled_types checks (the first 500 rows hold 'NA'
    # balances, key 0's comment and key 70's '?' latitude at every scale);
    # the all-empty notes column has no value left and is dropped.
    def txt(c):
        return f"CASE WHEN {c} = 'NA' THEN '' ELSE trim({c}) END AS {c}"

    def integer(c):
        return (f"CASE WHEN {_rx(c, INT_RX)} THEN TRY_CAST(trim({c}) AS BIGINT) "
                f"WHEN {_rx(c, NUM_RX)} THEN TRY_CAST(trunc(CAST(trim({c}) AS DOUBLE)) AS BIGINT) END AS {c}")
    cols = [integer("c_custkey"), txt("c_name"), integer("c_nationkey"), txt("c_acctbal"), txt("c_mktsegment"),
            txt("c_comment"), txt("decimalLatitude"), f"{_num('decimalLongitude')} AS decimalLongitude"]
    return f"WITH {CUSTOMER_TEXT}\nSELECT row_idx, {', '.join(cols)} FROM ct"


def round_precision() -> str:
    def prec(c):
        return f"""(SELECT CAST(CASE WHEN len(string_split(v, '.')) = 2 THEN length(string_split(v, '.')[2]) ELSE 0 END AS INTEGER)
           FROM (SELECT {c} AS v FROM ct WHERE {c} IS NOT NULL ORDER BY row_idx LIMIT 1))"""
    return f"""WITH {CUSTOMER_TEXT}
SELECT row_idx,
       round_even({_num('decimalLatitude')}, {prec('decimalLatitude')}) AS decimalLatitude,
       round_even({_num('decimalLongitude')}, {prec('decimalLongitude')}) AS decimalLongitude
FROM ct"""


EVENTS_TEXT = """
et AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'unknown'
                        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS eventDate
  FROM events)"""


def time_to_utc() -> str:
    return f"""WITH {EVENTS_TEXT}
SELECT event_id, strftime(TRY_CAST(eventDate AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS eventDate FROM et"""


def days_since_epoch() -> str:
    return f"""WITH {EVENTS_TEXT}
SELECT event_id, CAST(floor(epoch_us(TRY_CAST(eventDate AS TIMESTAMP)) / 86400000000) AS INTEGER) AS eventDate
FROM et"""


def ascii_replace() -> str:
    return r"""SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '?', 'g') AS text,
       regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS text_ignore FROM documents"""


def page_number() -> str:
    return """SELECT CAST(floor(o_orderkey / 1000) + 1 AS INTEGER) AS page, count(*) AS n_rows,
       min(o_orderkey) AS first_row, max(o_orderkey) AS last_row,
       CASE WHEN (SELECT count(*) FROM orders) > 1000
            THEN 'orders_part' || CAST(CAST(floor(o_orderkey / 1000) + 1 AS INTEGER) AS VARCHAR)
            ELSE 'orders' END AS part_name
FROM orders GROUP BY 1"""


def empty_columns() -> str:
    parts = [f"""SELECT '{c}' AS column, {pos} AS pos,
       CAST(sum(CASE WHEN {c} IS NOT NULL AND trim({c}) <> '' AND {c} <> 'NA' THEN 1 ELSE 0 END) AS BIGINT)
         AS n_values FROM ct""" for pos, c in enumerate(CT_COLS)]
    return f"""WITH {CUSTOMER_TEXT}, v AS ({' UNION ALL '.join(parts)})
SELECT "column", CAST(pos AS INTEGER) AS pos, n_values, n_values > 0 AS kept FROM v"""


def sampled_types() -> str:
    parts = []
    for pos, c in enumerate(CT_COLS):
        ne = f"trim({c}) <> ''"
        parts.append(f"""SELECT '{c}' AS column, {pos} AS pos,
  sum(CASE WHEN {ne} THEN 1 ELSE 0 END) AS n,
  sum(CASE WHEN {ne} AND {_rx(c, INT_RX)} THEN 1 ELSE 0 END) AS i,
  sum(CASE WHEN {ne} AND {_rx(c, NUM_RX)} THEN 1 ELSE 0 END) AS f,
  sum(CASE WHEN {ne} AND {_rx(c, DATE_RX)} AND TRY_CAST({c} AS DATE) IS NOT NULL THEN 1 ELSE 0 END) AS d,
  sum(CASE WHEN {ne} AND {_rx(c, BOOL_RX)} THEN 1 ELSE 0 END) AS b
FROM ct WHERE row_idx < 500""")
    return f"""WITH {CUSTOMER_TEXT}, s AS ({' UNION ALL '.join(parts)})
SELECT "column", CAST(pos AS INTEGER) AS pos,
  CASE WHEN n = 0 THEN 'String' WHEN i = n THEN 'Integer' WHEN f = n THEN 'Decimal'
       WHEN d = n THEN 'Date' WHEN b = n THEN 'Bool' ELSE 'String' END AS type
FROM s"""


def incremental_profile() -> str:
    # the stream folds batch profiles; the merged result equals the whole-table profile
    return column_profile()


ORACLES = {
    "standardize_sampled": standardize_sampled,
    "numeric_coerce": numeric_coerce,
    "incremental_profile": incremental_profile,
    "column_profile": column_profile,
    "type_reconcile": type_reconcile,
    "numeric_accept": numeric_accept,
    "round_precision": round_precision,
    "time_to_utc": time_to_utc,
    "days_since_epoch": days_since_epoch,
    "ascii_replace": ascii_replace,
    "page_number": page_number,
    "empty_columns": empty_columns,
    "sampled_types": sampled_types,
}
