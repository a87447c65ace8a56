"""DuckDB oracles for the delimited-line queries (fixtures rebuilt in SQL
with the same rules; the quote-aware split uses the linear S2 form, since
DuckDB's regex engine has no lookahead)."""

from __future__ import annotations

SQ = "''''"  # a single quote character as a SQL literal


def part_lines(revised: bool = False) -> str:
    file = "part_redo.csv" if revised else "part.csv"
    header = ("p_partkey,p_name,p_brand,p_kind,p_size,p_retailprice,p_comment" if revised
              else "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice")
    extra = ", 'c' || CAST(p_partkey AS VARCHAR)" if revised else ""
    return f"""
  SELECT '{file}' AS file, CAST(0 AS BIGINT) AS line_no, '{header}' AS line
  UNION ALL
  SELECT '{file}', p_partkey + 1, concat_ws(',', CAST(p_partkey AS VARCHAR),
    CASE WHEN p_partkey % 131 = 0 THEN '"' || p_name
         WHEN p_partkey % 11 = 0 THEN '"' || p_name || ', ' || p_brand || '"'
         WHEN p_partkey % 7 = 0 THEN {SQ} || p_name || {SQ}
         ELSE p_name END,
    CASE WHEN p_partkey % 19 = 0 THEN 'none' ELSE p_brand END,
    CASE WHEN p_partkey % 13 = 0 THEN 'n/a' WHEN p_partkey % 23 = 0 THEN 'NA'
         WHEN p_partkey % 29 = 0 THEN 'Na' ELSE p_type END,
    CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR){extra})
  FROM part"""


CUST_LINES = f"""
  SELECT 'customer.txt' AS file, CAST(0 AS BIGINT) AS line_no,
         'c_custkey|c_name|c_nationkey|c acctbal|c_mktsegment' AS line
  UNION ALL
  SELECT 'customer.txt', c_custkey + 1, concat_ws('|', CAST(c_custkey AS VARCHAR),
    CASE WHEN c_custkey % 131 = 0 THEN {SQ} || c_name
         WHEN c_custkey % 11 = 0 THEN '"' || c_name || '|' || c_mktsegment || '"'
         WHEN c_custkey % 7 = 0 THEN {SQ} || c_name || {SQ}
         ELSE c_name END,
    CAST(c_nationkey AS VARCHAR),
    CASE WHEN c_custkey % 17 = 0 THEN replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END,
    CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE c_mktsegment END)
  FROM customer"""


def all_lines() -> str:
    return f"lines AS ({part_lines()} UNION ALL {CUST_LINES})"


def nchar(expr: str, ch_sql: str) -> str:
    return f"(length({expr}) - length(replace({expr}, {ch_sql}, '')))"


QDIFF = f"({nchar('line', chr(39) + chr(34) + chr(39))} - {nchar('line', SQ)})"

SNIFF = """
hdr AS (
  SELECT file, line,
    CASE WHEN c1 >= c2 AND c1 >= c3 AND c1 >= c4 THEN ','
         WHEN c2 >= c3 AND c2 >= c4 THEN '|'
         WHEN c3 >= c4 THEN ';' ELSE chr(9) END AS delim
  FROM (SELECT file, line,
          length(line) - length(replace(line, ',', '')) AS c1,
          length(line) - length(replace(line, '|', '')) AS c2,
          length(line) - length(replace(line, ';', '')) AS c3,
          length(line) - length(replace(line, chr(9), '')) AS c4
        FROM lines WHERE line_no = 0)),
lab AS (
  SELECT file, delim,
         list_transform(string_split(replace(replace(line, '"', ''), chr(39), ''), delim),
                        lambda x: trim(x)) AS labels
  FROM hdr),
labs AS (
  SELECT file, delim, CAST(unnest(range(len(labels))) AS INTEGER) AS pos, unnest(labels) AS label
  FROM lab)"""

RUNNING = f"""
run AS (
  SELECT file, line_no, line_no - 1 AS row_idx, line,
         sum({QDIFF}) OVER (PARTITION BY file ORDER BY line_no
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
  FROM lines WHERE line_no > 0),
runq AS (SELECT *, CASE WHEN balance >= 0 THEN '"' ELSE chr(39) END AS quote FROM run)"""


def _marked(q: str) -> str:
    return f"""array_to_string(list_transform(string_split(r.line, {q}),
             lambda s, i: CASE WHEN (len(string_split(r.line, {q})) - i) % 2 = 0
                               THEN replace(s, l.delim, chr(1)) ELSE s END), {q})"""


PARSED = f"""
parsed AS (
  SELECT r.file, r.row_idx, r.quote, r.balance, l.delim, len(l.labels) AS n_labels,
         string_split(CASE WHEN r.quote = '"' THEN {_marked(chr(39) + chr(34) + chr(39))}
                           ELSE {_marked('chr(39)')} END, chr(1)) AS cells
  FROM runq r JOIN lab l ON r.file = l.file)"""


def delimiter_sniff() -> str:
    return f"""WITH {all_lines()}, {SNIFF}
SELECT file, delim, pos, label, regexp_replace(trim(label), '[^A-Za-z0-9]+', '_', 'g') AS clean
FROM labs"""


def label_guard() -> str:
    return f"""WITH {all_lines()}, {SNIFF}
SELECT file, 'CRITICAL' AS severity, 'label_space' AS code, pos, label,
       'variable names must be single string: ' || label AS message
FROM labs WHERE contains(label, ' ')"""


def header_match() -> str:
    return f"""WITH lines AS ({part_lines()} UNION ALL {part_lines(True)}), {SNIFF},
a AS (SELECT label, min(pos) AS left_pos, count(*) AS left_n FROM labs
      WHERE file = 'part.csv' GROUP BY label),
b AS (SELECT label, min(pos) AS right_pos, count(*) AS right_n FROM labs
      WHERE file = 'part_redo.csv' GROUP BY label)
SELECT coalesce(a.label, b.label) AS label, left_pos, right_pos,
       CASE WHEN left_pos IS NOT NULL AND right_pos IS NOT NULL THEN 'common'
            WHEN left_pos IS NOT NULL THEN 'absent' ELSE 'extra' END AS status,
       left_pos = right_pos AS same_pos,
       greatest(coalesce(left_n, 0), coalesce(right_n, 0)) > 1 AS duplicated
FROM a FULL OUTER JOIN b ON a.label = b.label"""


def quote_majority() -> str:
    return f"""WITH {all_lines()}
SELECT file, CAST(sum({QDIFF}) AS BIGINT) AS balance,
       CASE WHEN sum({QDIFF}) >= 0 THEN '"' ELSE chr(39) END AS quote
FROM lines WHERE line_no > 0 GROUP BY file"""


def running_quote_style() -> str:
    return f"""WITH {all_lines()}, {RUNNING}
SELECT file, row_idx, CAST(balance AS BIGINT) AS balance, quote FROM runq"""


def row_width_qc() -> str:
    return f"""WITH {all_lines()}, {SNIFF}, {RUNNING}, {PARSED}
SELECT file, row_idx, CAST(len(cells) AS INTEGER) AS width, CAST(n_labels AS INTEGER) AS expected,
       'CRITICAL' AS severity
FROM parsed WHERE len(cells) <> n_labels"""


def cell_split() -> str:
    return f"""WITH {all_lines()}, {SNIFF}, {RUNNING}, {PARSED}
SELECT file, row_idx, CAST(unnest(range(len(cells))) AS INTEGER) AS pos, unnest(cells) AS cell
FROM parsed"""


def token_replace() -> str:
    return f"""WITH lines AS ({part_lines()})
SELECT file, line_no - 1 AS row_idx,
       array_to_string(list_transform(string_split(line, ','), lambda x, i:
         CASE WHEN i > 1 AND i < len(string_split(line, ',')) AND lower(x) IN ('n/a', 'none', 'na')
              THEN 'NA' ELSE x END), ',') AS line
FROM lines WHERE line_no > 0"""


def normalize_delimiter() -> str:
    return f"""WITH lines AS ({CUST_LINES}), {SNIFF}, {RUNNING}, {PARSED}
SELECT file, row_idx, array_to_string(list_transform(cells, lambda c:
    CASE WHEN NOT (length(trim(c)) >= 2 AND starts_with(trim(c), quote) AND ends_with(trim(c), quote))
              AND contains(trim(c), ',') THEN quote || replace(trim(c), quote, quote || quote) || quote ELSE trim(c) END), ',') AS line
FROM parsed"""


def standardize_qc() -> str:
    return f"""WITH lines AS ({part_lines()}), {SNIFF}, {RUNNING}, {PARSED}
SELECT file, 'CRITICAL' AS severity, 'row_width' AS code, row_idx, CAST(NULL AS VARCHAR) AS "column",
       'row ' || CAST(row_idx AS VARCHAR) || ' has ' || CAST(len(cells) AS VARCHAR)
       || ' cells under ' || CAST(n_labels AS VARCHAR) || ' labels' AS message
FROM parsed WHERE len(cells) <> n_labels
UNION ALL
SELECT file, 'CRITICAL', 'label_space', NULL, label, 'variable names must be single string: ' || label
FROM labs WHERE contains(label, ' ')"""


NUM_RX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_RX = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
INT_RX = r"^\s*[+-]?\d+\s*$"
BOOL_RX = r"^(True|False|TRUE|FALSE|true|false)$"


def quote_style() -> str:
    uq = ("CASE WHEN length(c) >= 2 AND starts_with(c, '\"') AND ends_with(c, '\"') "
          "THEN substr(c, 2, length(c) - 2) ELSE c END")
    return f"""WITH {all_lines()}, {SNIFF}, {RUNNING}, {PARSED},
cp AS (SELECT file, n_labels, CAST(unnest(range(len(cells))) AS INTEGER) AS pos, unnest(cells) AS c FROM parsed),
cv AS (SELECT file, pos, {uq} AS v FROM cp WHERE pos < n_labels),
g AS (SELECT file, pos, count(*) AS n,
             sum(CASE WHEN regexp_matches(v, '{BOOL_RX}') THEN 1 ELSE 0 END) AS b,
             sum(CASE WHEN regexp_matches(v, '{INT_RX}') THEN 1 ELSE 0 END) AS i,
             sum(CASE WHEN regexp_matches(v, '{NUM_RX}') OR regexp_matches(v, '{SPECIAL_RX}') THEN 1 ELSE 0 END) AS f
      FROM cv GROUP BY file, pos),
nt AS (SELECT l.file, CAST(sum(CASE WHEN g.n IS NULL OR NOT (g.b = g.n OR g.i = g.n OR g.f = g.n)
                                    THEN 1 ELSE 0 END) AS INTEGER) AS n_text
       FROM labs l LEFT JOIN g ON g.file = l.file AND g.pos = l.pos GROUP BY l.file),
per AS (SELECT file, sum({QDIFF}) AS balance, count(*) AS rows FROM lines WHERE line_no > 0 GROUP BY file),
j AS (SELECT per.file, per.rows, CAST(len(lab.labels) AS INTEGER) AS columns, coalesce(nt.n_text, 0) AS n_text,
             CAST(per.balance AS BIGINT) AS balance
      FROM per JOIN lab ON lab.file = per.file LEFT JOIN nt ON nt.file = per.file)
SELECT file, rows, columns, n_text, balance,
       CASE WHEN columns * rows > 0 AND balance / 2.0 / (columns * rows) > 0.99 THEN 'all'
            WHEN n_text * rows > 0 AND balance / 2.0 / (n_text * rows) > 0.99 THEN 'nonnumeric'
            ELSE 'minimal' END AS quoting
FROM j"""


def header_offset() -> str:
    return _header_rule(all_lines())


def _header_rule(lines: str) -> str:
    dq = chr(39) + chr(34) + chr(39)
    return f"""WITH {lines},
w AS (SELECT * FROM lines WHERE line_no < 500),
dc AS (SELECT file,
         sum(length(line) - length(replace(line, ',', ''))) AS c1,
         sum(length(line) - length(replace(line, '|', ''))) AS c2,
         sum(length(line) - length(replace(line, ';', ''))) AS c3,
         sum(length(line) - length(replace(line, chr(9), ''))) AS c4
       FROM w GROUP BY file),
dl AS (SELECT file, CASE WHEN c1 >= c2 AND c1 >= c3 AND c1 >= c4 THEN ','
                         WHEN c2 >= c3 AND c2 >= c4 THEN '|' WHEN c3 >= c4 THEN ';' ELSE chr(9) END AS delim
       FROM dc),
sp AS (SELECT w.file, w.line_no,
         string_split(array_to_string(list_transform(string_split(w.line, {dq}),
           lambda s, i: CASE WHEN (len(string_split(w.line, {dq})) - i) % 2 = 0
                             THEN replace(s, dl.delim, chr(1)) ELSE s END), {dq}), chr(1)) AS cells
       FROM w JOIN dl ON dl.file = w.file),
nc AS (SELECT file, line_no, len(list_filter(cells, lambda c: length(trim(c)) > 0)) AS n FROM sp),
usual AS (SELECT file, n AS usual FROM (
  SELECT file, n, row_number() OVER (PARTITION BY file ORDER BY count(*) DESC, n DESC) AS r FROM nc GROUP BY file, n) WHERE r = 1)
SELECT nc.file, min(line_no) AS header_line, CAST(arg_min(n, line_no) AS INTEGER) AS n_cells
FROM nc JOIN usual USING (file) WHERE n >= usual - 1 GROUP BY nc.file"""


ORACLES = {
    "header_offset": header_offset,
    "quote_style": quote_style,
    "standardize_qc": standardize_qc,
    "delimiter_sniff": delimiter_sniff,
    "label_guard": label_guard,
    "header_match": header_match,
    "quote_majority": quote_majority,
    "running_quote_style": running_quote_style,
    "row_width_qc": row_width_qc,
    "cell_split": cell_split,
    "token_replace": token_replace,
    "normalize_delimiter": normalize_delimiter,
}
