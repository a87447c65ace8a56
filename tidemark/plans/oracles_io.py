"""DuckDB oracles for the queries over written files."""

from __future__ import annotations

from tidemark.plans.oracles_manifest import FILES
from tidemark.plans.oracles_lines import PARSED, RUNNING, SNIFF, _header_rule, part_lines
from tidemark.plans.oracles_meta import DVARS, variable_units
from tidemark.plans.oracles_profile import CUSTOMER_TEXT, gaps_chunked, gaps_whole
from tidemark.plans.oracles_vocab import HTML_ROWS, LOCAL_VOCAB, MATCHES, TRIPLES, VARIABLES, match_counts

NUM_RX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

SPECIAL_NAMES = """SELECT CASE p_partkey % 4 WHEN 0 THEN repeat('*', CAST(p_partkey % 5 + 1 AS INTEGER))
                  WHEN 1 THEN '_' || substr(p_name, 1, 1) || '_' || substr(p_name, 2, 1)
                  WHEN 2 THEN string_split(p_name, ' ')[1] || '-' ELSE 'q7' || CAST(p_partkey AS VARCHAR) END AS name,
                0 AS dataset, 0 AS pos FROM part"""


def _report(name: str) -> str:
    from tidemark.plans import oracles  # which itself collects this module's oracles
    return getattr(oracles, name)()


PREAMBLE = f"""
  SELECT 'part.csv' AS file, CAST(0 AS BIGINT) AS line_no, 'exported by the parts office' AS line
  UNION ALL SELECT 'part.csv', 1, 'draft'
  UNION ALL SELECT 'part.csv', 2, 'p_partkey,p_name,p_brand,p_size'
  UNION ALL SELECT 'part.csv', p_partkey + 3,
    CASE WHEN p_partkey % 17 = 0 THEN concat_ws(',', CAST(p_partkey AS VARCHAR), p_name, p_brand, CAST(p_size AS VARCHAR), 'more', 'cells')
         ELSE concat_ws(',', CAST(p_partkey AS VARCHAR), p_name, p_brand, CAST(p_size AS VARCHAR)) END FROM part"""

SIDES = """
s AS (SELECT l_orderkey, l_linenumber, count(*) AS n, any_value(l_orderkey % 29 = 0 AND CAST(l_quantity AS BIGINT) <> 0) AS q_bad,
             any_value(l_orderkey % 31 = 0) AS f_bad FROM lineitem GROUP BY l_orderkey, l_linenumber),
u AS (SELECT * FROM s WHERE n = 1)"""


def _uq(c: str) -> str:
    return (f"CASE WHEN length({c}) >= 2 AND starts_with({c}, quote) AND ends_with({c}, quote) "
            f"THEN replace(substr({c}, 2, length({c}) - 2), quote || quote, quote) ELSE {c} END")


def standardize() -> str:
    # text where the cells are not all numbers; the numeric columns come out NULL if they were
    cells = ", ".join(f"{_uq(f'cells[{i + 1}]')} AS c{i}" for i in range(6))

    def text(i, name):
        rx = r"[^\x00-\x7F]"
        return f"CASE WHEN NOT (SELECT a{i} FROM t) THEN regexp_replace(c{i}, '{rx}', '?', 'g') END AS {name}"

    def number(i, name):
        return f"CASE WHEN (SELECT a{i} FROM t) THEN CAST(c{i} AS DOUBLE) END AS {name}"
    return f"""WITH lines AS ({part_lines()}), {SNIFF}, {RUNNING}, {PARSED},
c AS (SELECT row_idx, {cells} FROM parsed),
t AS (SELECT {', '.join(f"bool_and(regexp_matches(c{i}, '{NUM_RX}')) AS a{i}" for i in range(6))} FROM c)
SELECT row_idx, {text(0, 'p_partkey')}, {text(1, 'p_name')}, {text(2, 'p_brand')}, {text(3, 'p_type')},
       {text(4, 'p_size')}, {number(5, 'p_retailprice')} FROM c"""


ORACLES = {
    "standardize": standardize,
    "typed_scan": lambda: """SELECT c_custkey,
  CASE WHEN c_custkey % 10 = 0 THEN c_name || ' "the first"' || chr(10) || ', ' || c_mktsegment ELSE c_name END AS c_name,
  CASE WHEN c_custkey % 50 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS c_acctbal,
  c_custkey % 50 = 0 AS is_bad FROM customer""",
    "zip_scan": lambda: """SELECT 'parts_' || CAST(p_partkey // 100 AS VARCHAR) || '.zip' AS archive, 'part.csv' AS file,
  p_partkey % 100 AS line_no, CAST(p_partkey AS VARCHAR) || ',' || p_name AS line, false AS is_bad
FROM part WHERE (p_partkey // 100) % 7 <> 3
UNION ALL SELECT DISTINCT 'parts_' || CAST(p_partkey // 100 AS VARCHAR) || '.zip', NULL, NULL, NULL, true
FROM part WHERE (p_partkey // 100) % 7 = 3""",
    "manifest_scan": lambda: """WITH f AS (SELECT o_orderkey, unnest(range(o_orderkey % 3 + 1)) AS i FROM orders WHERE o_orderkey % 4 <> 3)
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, 'title ' || CAST(o.o_orderkey AS VARCHAR) AS title, 'u' AS link_url,
       CAST(f.i AS INTEGER) AS file_pos, 'f' || CAST(f.i AS VARCHAR) || '.csv' AS name, o.o_orderkey * 10 + f.i AS size
FROM orders o LEFT JOIN f ON f.o_orderkey = o.o_orderkey""",
    "vocab_scan": lambda: """SELECT 'term' || CAST(p_partkey AS VARCHAR) AS term, p_partkey % 100 AS ord,
  p_name AS definition, p_type AS type FROM part""",
    "part_concat": lambda: """SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus,
  CASE WHEN o_orderkey % 3 <> 2 THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "dataset_attributes": lambda: "SELECT o_orderkey, o_totalprice, 'Orders' AS title, 'currency' AS units FROM orders",
    "paged_files": lambda: """SELECT CAST(o_orderkey // 1000 + 1 AS INTEGER) AS part, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files,
  min(o_orderkey) AS first_row, max(o_orderkey) AS last_row FROM orders GROUP BY 1""",
    "match_report": match_counts,
    "quarantine": lambda: """SELECT c_nationkey AS dataset, c_custkey,
  CASE WHEN c_nationkey % 5 = 0 THEN 'bad' ELSE 'good' END AS route FROM customer""",
    "absent_filled": lambda: """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE 'NA' END AS flag,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber // 2 AS VARCHAR) ELSE CAST(l_linenumber // 2 AS VARCHAR) || '.5' END AS half_id,
  CAST(l_suppkey AS VARCHAR) AS supp_id FROM lineitem""",
    "sampled_limit": lambda: """SELECT p_partkey AS row_idx, CAST(p_size AS DOUBLE) AS altitude,
  CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_partkey % 50 AS DOUBLE) END AS depth, p_name || ' ' AS note
FROM part WHERE p_partkey < 1000""",
    "sampled_late_cells": lambda: """SELECT o_orderkey AS row_idx,
  CASE WHEN o_orderkey >= 500 AND o_orderkey % 100 IN (0, 2) THEN NULL
       WHEN o_orderkey >= 500 AND o_orderkey % 100 = 1 THEN 3000000000
       WHEN o_orderkey % 100 = 3 THEN NULL ELSE o_orderkey % 1000 END AS number, o_orderstatus AS status FROM orders""",
    "sampled_losses": lambda: """SELECT 'number' AS column, 'Integer' AS type,
  count(*) FILTER (WHERE o_orderkey >= 500 AND o_orderkey % 100 IN (0, 2)) AS n_lost FROM orders
UNION ALL SELECT 'status', 'String', 0""",
    "file_names": lambda: """WITH n AS (SELECT o_orderkey, 'set' || CAST(o_orderkey % 97 AS VARCHAR) AS base,
  CASE WHEN o_orderkey % 2 = 0 THEN '_part' || CAST(o_orderkey % 13 AS VARCHAR) ELSE '' END AS part FROM orders)
SELECT o_orderkey, base || part AS stem, '.csv' AS ext, base, base AS dataset, base || part AS own_dataset FROM n""",
    "catalog_parts": lambda: f"""WITH {DVARS.replace("'dataset_' || lpad(CAST(p_partkey // 40 AS VARCHAR), 9, '0')",
                                                  "'set_' || CAST(p_partkey // 120 AS VARCHAR)")
                                         .replace("dv AS (SELECT dataset, name, dtype, min(p_partkey) AS pos FROM dv0 GROUP BY dataset, name, dtype)",
                                                  "dv AS (SELECT dataset, name, arg_min(dtype, p_partkey) AS dtype, min(p_partkey) AS pos FROM dv0 GROUP BY dataset, name)")}
SELECT dataset, pos, name, dtype, destination FROM cat""",
    "time_axis_units": lambda: f"""SELECT dataset, pos, name,
  CASE WHEN name = 'eventDate' THEN 'days since 1970-01-01' ELSE units END AS units FROM ({variable_units()})""",
    "catalog_attributes": lambda: f"""SELECT dataset, name,
  CASE WHEN lower(name) IN ('altitude', 'depth', 'latitude', 'longitude') THEN lower(name) END AS standard_name,
  CASE WHEN lower(name) NOT IN ('altitude', 'depth', 'latitude', 'longitude') THEN coalesce(units, 'none') END AS units
FROM ({variable_units()})""",
    "incremental_skip": lambda: """SELECT CAST(o_orderkey % 2 AS INTEGER) AS run, o_orderstatus, count(*) AS n,
  min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1, 2""",
    "chained": lambda: """SELECT o_custkey, lower(o_orderstatus) AS o_orderstatus, count(*) AS n FROM orders
WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2""",
    "reconcile_repeated_keys": lambda: f"""WITH {SIDES},
k AS (SELECT count(*) AS shared, count(*) FILTER (WHERE q_bad) AS q, count(*) FILTER (WHERE f_bad) AS f FROM u)
SELECT 'l_orderkey' AS column, 0 AS pos, shared, 0 AS raw_mismatch, 0 AS filtered_mismatch, 0 AS equivalent_mismatch FROM k
UNION ALL SELECT 'l_linenumber', 1, shared, 0, 0, 0 FROM k
UNION ALL SELECT 'l_quantity', 2, shared, q, q, q FROM k
UNION ALL SELECT 'l_returnflag', 3, shared, f, f, f FROM k""",
    "repeated_key_messages": lambda: f"""WITH {SIDES},
k AS (SELECT CAST(2 * sum(n) FILTER (WHERE n > 1) AS BIGINT) AS rep, count(*) FILTER (WHERE n = 1 AND (q_bad OR f_bad)) AS bad FROM s)
SELECT 'INFO' AS severity, 'labels_agree' AS code, 'both sides have the same labels in the same order' AS message
UNION ALL SELECT CASE WHEN bad = 0 THEN 'INFO' ELSE 'WARNING' END, 'entry_agreement',
  CASE WHEN bad = 0 THEN 'all shared cells agree' ELSE 'some shared cells differ even with all allowances' END FROM k
UNION ALL SELECT 'CRITICAL', 'repeated_keys', CAST(rep AS VARCHAR) || ' rows share their key with another row and were not paired'
FROM k WHERE rep > 0""",
    "reconcile_hot_key": lambda: """WITH k AS (SELECT count(*) FILTER (WHERE n = 1) AS shared, count(*) FILTER (WHERE n = 1 AND event_id % 11 = 0) AS bad,
           count(*) FILTER (WHERE n > 1) AS rep FROM (
  SELECT event_id, count(*) OVER (PARTITION BY CASE WHEN event_id % 3 = 0 THEN -1 WHEN event_id % 3 = 1 AND event_id % 7 = 0 THEN NULL ELSE event_id END) AS n
  FROM events))
SELECT 'k' AS column, shared, 0 AS raw_mismatch FROM k UNION ALL SELECT 'event_type', shared, 0 FROM k
UNION ALL SELECT 'u', shared, bad FROM k UNION ALL SELECT '(repeated)', 2 * rep, 0 FROM k""",
    "reconcile_reports": lambda: f"""SELECT 'dims' AS report, side AS name, CAST("rows" AS BIGINT) AS n FROM ({_report('reconcile_dims')})
UNION ALL SELECT 'entries', measure, CAST("count" AS BIGINT) FROM ({_report('reconcile_entries')})
UNION ALL SELECT 'discrepancies', stage, CAST("count" AS BIGINT) FROM ({_report('discrepancy_reduction')})
UNION ALL SELECT 'columns', "column", CAST(equivalent_mismatch AS BIGINT) FROM ({_report('reconcile_by_column')})
UNION ALL SELECT 'messages', code, NULL FROM ({_report('reconcile_messages')})""",
    "type_reconcile_gaps": lambda: gaps_chunked(),
    "incremental_profile_gaps": lambda: gaps_whole(),
    "quoted_scan": lambda: """SELECT doc_id, sha256(CASE WHEN doc_id % 3 = 0 THEN '"' ELSE chr(39) END || text || CASE WHEN doc_id % 5 = 0 THEN '","' || chr(10)
  ELSE chr(10) || chr(10) || '.' END) AS text_sha256, lang FROM documents""",
    "named_pages": lambda: """SELECT 'many' AS run, 'orders' || CASE WHEN (SELECT max(o_orderkey) FROM orders) >= 1000 THEN '_part' || CAST(o_orderkey // 1000 + 1 AS VARCHAR) ELSE '' END AS dataset,
  count(*) AS n_rows, min(o_orderkey) AS first_row, max(o_orderkey) AS last_row FROM orders GROUP BY 1, 2
UNION ALL SELECT 'one', 'orders', count(*), min(o_orderkey), max(o_orderkey) FROM orders WHERE o_orderkey < 1000
UNION ALL SELECT 'whole', 'orders', count(*), min(o_orderkey), max(o_orderkey) FROM orders""",
    "round_precision_max": lambda: f"""WITH {CUSTOMER_TEXT}
SELECT row_idx, TRY_CAST(decimalLatitude AS DOUBLE) AS decimalLatitude, TRY_CAST(decimalLongitude AS DOUBLE) AS decimalLongitude FROM ct""",
    "changed_sources": lambda: """WITH o AS (SELECT o_orderkey, o_orderkey % 9 AS part, CASE WHEN o_orderkey % 9 = 2 THEN 'Z' ELSE o_orderstatus END AS st
  FROM orders WHERE o_orderkey % 9 <> 5 AND NOT (o_orderkey % 9 = 2 AND o_orderkey % 2 = 1)),
r AS (SELECT part, count(*) AS n, CASE WHEN part IN (2, 8) THEN 2 ELSE 1 END AS written_in, max(st) AS last_status, max(o_orderkey) AS last_key FROM o GROUP BY part),
a AS (SELECT p, run, CASE WHEN run = 1 THEN 'new' WHEN run = 3 THEN 'same' WHEN p = 2 THEN 'changed' WHEN p = 5 THEN 'vanished' WHEN p = 8 THEN 'new' ELSE 'same' END AS action
  FROM range(9) t(p), range(1, 4) s(run) WHERE NOT (p = 8 AND run = 1) AND NOT (p = 5 AND run = 3))
SELECT 'part ' || p || '.csv' AS source, CAST(run AS INTEGER) AS run, action, n, written_in, last_status, last_key
FROM a LEFT JOIN r ON r.part = a.p""",
    "match_special_names": lambda: f"""WITH {HTML_ROWS}, {TRIPLES},
vars AS ({SPECIAL_NAMES}), {MATCHES}
SELECT name, kind, term, hits, CAST(stage AS INTEGER) AS stage FROM m""",
    "match_limited": lambda: f"""WITH {HTML_ROWS}, {TRIPLES},
vars AS ({SPECIAL_NAMES} UNION ALL SELECT lower(substr(p_name, 1, 2)), 0, 0 FROM part UNION ALL SELECT substr(p_name, 1, 1), 0, 0 FROM part), {MATCHES}
SELECT name, kind, term, hits, CAST(stage AS INTEGER) AS stage,
  CASE WHEN regexp_matches(name, '^[^A-Za-z0-9]+$') AND stage = 2 THEN '*' ELSE array_to_string(candidates[:3], '|') END AS candidates FROM m""",
    "revised_vocabulary": lambda: f"""WITH {LOCAL_VOCAB}, {TRIPLES}, {VARIABLES}, {MATCHES},
hit AS (SELECT DISTINCT term AS label FROM m WHERE kind = 'fuzzy'),
new AS (SELECT cand.* FROM hit JOIN cand USING (label))
SELECT term, 'local' AS source, CAST(apos AS INTEGER) AS apos, attr, value FROM lv WHERE term NOT IN (SELECT label FROM hit)
UNION ALL SELECT label, 'fuzzy', 0, 'definition', definition FROM new UNION ALL SELECT label, 'fuzzy', 1, 'details', details FROM new
UNION ALL SELECT label, 'fuzzy', 2, 'label', label FROM new UNION ALL SELECT label, 'fuzzy', 3, 'identifier', identifier FROM new
UNION ALL SELECT label, 'fuzzy', 4, 'section', section FROM new
UNION ALL SELECT label, 'fuzzy', 5, 'comment', 'taken from the one vocabulary entry that fits the name' FROM new""",
    "preamble_offset": lambda: _header_rule(f"lines AS ({PREAMBLE})"),
    "preamble_cells": lambda: """SELECT p_partkey AS row_idx, CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand,
  CAST(p_size AS VARCHAR) AS p_size FROM part""",
    "file_headers": lambda: """SELECT layout, delim, 'p_partkey,the name,p_size,remark' AS labels, count(*) AS n_rows,
  CAST(sum(strlen(CAST(p_partkey AS VARCHAR)) + strlen(p_name) + strlen(CAST(p_size AS VARCHAR)) + 7) AS BIGINT) AS n_bytes
FROM part, (VALUES ('pipe', '|'), ('semicolon', ';'), ('tab', chr(9))) AS d(layout, delim) GROUP BY layout, delim""",
    "file_standardize": lambda: """SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_idx, c_custkey AS key,
  CASE WHEN c_custkey % 3 = 0 THEN c_name || ' "the first"' WHEN c_custkey % 4 = 1 THEN c_name || ', d''Or et d''Argent' ELSE c_name END AS name,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance, chr(39) AS mark FROM customer""",
    "rule_units": lambda: """WITH r AS (SELECT p_partkey * 7919 % 1000003 AS ord, lower(substr(p_name, 2 + p_partkey % 3, 5 + p_partkey % 4)) AS term,
  'u' || p_partkey AS unit FROM part),
f AS (SELECT n.p_name, (SELECT min(struct_pack(ord := ord, term := term, unit := unit)) FROM r WHERE contains(lower(n.p_name), r.term)) AS rule
  FROM (SELECT DISTINCT p_name FROM part) n)
SELECT p_partkey, upper(p_name) AS name, rule.unit AS unit FROM part JOIN f USING (p_name)""",
    "rule_files": lambda: f"""WITH {FILES},
r AS (SELECT o_orderkey * 7919 % 1000003 AS ord, 'occurrence_' || (o_orderkey // 50) AS term FROM orders WHERE o_orderkey % 50 = 0),
k AS (SELECT count(*) FILTER (WHERE o_orderkey % 100 = 0) > 0 AS has_title, count(*) FILTER (WHERE o_orderkey % 100 = 50) > 0 AS has_ext FROM orders),
nt AS (SELECT n.name, arg_min(r.term, struct_pack(ord := ord, term := r.term)) AS t FROM (SELECT DISTINCT name FROM mf) n
  JOIN r ON contains(lower(n.name), r.term) GROUP BY n.name),
g AS (SELECT mf.item_id, mf.file_pos, mf.name, mf.stem,
  CASE WHEN has_title AND contains(lower(title), 'core:occurrence') THEN 'core:occurrence data'
       WHEN has_ext AND contains(lower(mf.name), '.zip') THEN nt.t || ' data' END AS dftype FROM k, mf LEFT JOIN nt ON nt.name = mf.name)
SELECT *, dftype IS NOT NULL AS passes FROM g""",
    "rule_directives": lambda: """WITH l AS (SELECT p_partkey, CASE WHEN p_partkey % 90 = 0 THEN 'Altitude' ELSE p_name || '_' || p_brand END AS label FROM part),
r AS (SELECT p_partkey % 20 AS kind, lower(substr(p_name, 3, 6)) AS term FROM part WHERE p_partkey % 20 < 2)
SELECT p_partkey, label, CASE WHEN lower(label) = 'altitude' THEN 'position'
  WHEN EXISTS (SELECT 1 FROM r WHERE kind = 0 AND contains(lower(label), term)) THEN 'numeric'
  WHEN EXISTS (SELECT 1 FROM r WHERE kind = 1 AND contains(lower(label), term)) THEN 'string' ELSE 'none' END AS directive FROM l""",
    "bad_bytes": lambda: """SELECT CAST(p_partkey AS VARCHAR) || ',c' || CASE WHEN p_partkey % 3 = 0 THEN chr(65533) ELSE 'é' END AS line FROM part""",
    "round_trip_documents": lambda: """WITH n AS (SELECT count(*) AS shared FROM documents)
SELECT 'doc_id' AS column, 0 AS pos, shared, 0 AS raw_mismatch, 0 AS filtered_mismatch, 0 AS equivalent_mismatch FROM n
UNION ALL SELECT 'text', 1, shared, 0, 0, 0 FROM n UNION ALL SELECT 'lang', 2, shared, 0, 0, 0 FROM n
UNION ALL SELECT 'source', 3, shared, 0, 0, 0 FROM n""",
}
