"""DuckDB oracles for the vocabulary queries."""

from __future__ import annotations

BASE = "http://example.org/ont/ioos"

HTML_ROWS = """
hr AS (
  SELECT CAST(floor(p_partkey / 100) AS BIGINT) AS page_id,
         p_partkey % 100 AS seq, p_partkey AS gseq,
         replace(p_name, ' ', '') AS term, p_partkey AS k, p_type, p_brand, p_size
  FROM part),
attrs AS (
  SELECT page_id, seq, gseq, 0 AS ord, term, 'definition' AS attr, p_type || ' ' || p_brand || ' part ' AS value FROM hr
  UNION ALL SELECT page_id, seq, gseq, 1, term, 'comments', 'size ' || CAST(p_size AS VARCHAR) || ' ' FROM hr
  UNION ALL SELECT page_id, seq, gseq, 2, term, 'details', 'index.htm#' || term FROM hr)"""

LOCAL_VOCAB = HTML_ROWS + """,
tl AS (SELECT term, max(gseq) AS last_seq, min(gseq) AS first_seq FROM attrs GROUP BY term),
lv AS (SELECT a.term, tl.first_seq AS ord, a.ord AS apos, a.attr, a.value
       FROM attrs a JOIN tl ON a.term = tl.term AND a.gseq = tl.last_seq)"""

TRIPLES = f"""
fp AS (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name),
fpt AS (SELECT fp.p_name, fp.k, part.p_type FROM fp JOIN part ON part.p_partkey = fp.k),
tr AS (
  SELECT '{BASE}/term/p' || CAST(k AS VARCHAR) AS s, '{BASE}/Term' AS p, replace(p_name, ' ', '') AS o FROM fpt
  UNION ALL SELECT '{BASE}/term/p' || CAST(k AS VARCHAR), '{BASE}/Defintion', 'Definition of ' || p_name FROM fpt
  UNION ALL SELECT '{BASE}/term/p' || CAST(k AS VARCHAR), '{BASE}/Defintion', 'Other definition of ' || p_name
            FROM fpt WHERE k % 7 = 2
  UNION ALL SELECT '{BASE}/term/p' || CAST(k AS VARCHAR), '{BASE}/Reference',
                   'http://example.org/terms/' || replace(p_name, ' ', '') FROM fpt
  UNION ALL SELECT '{BASE}/term/p' || CAST(k AS VARCHAR), '{BASE}/Section', p_type FROM fpt WHERE k % 5 <> 1
  UNION ALL SELECT '{BASE}/term/s' || CAST(s_suppkey AS VARCHAR), '{BASE}/Term',
                   lower(replace(s_name, '#', '')) FROM supplier
  UNION ALL SELECT '{BASE}/term/s' || CAST(s_suppkey AS VARCHAR), '{BASE}/Defintion',
                   'Supplier in nation ' || CAST(s_nationkey AS VARCHAR) FROM supplier
  UNION ALL SELECT '{BASE}/term/s' || CAST(s_suppkey AS VARCHAR), '{BASE}/Reference',
                   'http://example.org/suppliers/' || CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION ALL SELECT '{BASE}/term/s' || CAST(s_suppkey AS VARCHAR), '{BASE}/Section', 'Supplier'
            FROM supplier WHERE s_suppkey % 4 <> 3
  UNION ALL SELECT '{BASE}/Defintion', 'rdfs:label', 'Definition' FROM supplier WHERE s_suppkey = 0),
pat AS (
  SELECT l.o AS label, d.s AS identifier, sec.o AS section, d.o AS definition, r.o AS details, d.p AS p_definition
  FROM tr d
  JOIN tr l ON l.s = d.s AND regexp_matches(l.p, '/Term')
  JOIN tr r ON r.s = d.s AND regexp_matches(r.p, '/Reference')
  JOIN tr sec ON sec.s = d.s AND regexp_matches(sec.p, '/Section')
  WHERE regexp_matches(d.p, '/Defintion') AND regexp_matches(d.s, '(?i)ioos')),
cand AS (
  SELECT pat.* FROM pat JOIN (SELECT s FROM tr WHERE p = 'rdfs:label') pl ON pl.s = pat.p_definition)"""

VARIABLES = """
vr AS (
  SELECT 'dataset_' || lpad(CAST(p_partkey % 25 AS VARCHAR), 2, '0') AS dataset,
         CASE p_partkey % 6
           WHEN 0 THEN replace(p_name, ' ', '')
           WHEN 1 THEN upper(replace(p_name, ' ', ''))
           WHEN 2 THEN upper(substr(string_split(p_name, ' ')[1], 1, 1)) || substr(string_split(p_name, ' ')[1], 2)
                       || '_' || upper(substr(string_split(p_name, ' ')[2], 1, 1)) || substr(string_split(p_name, ' ')[2], 2)
           WHEN 3 THEN string_split(p_name, ' ')[2] || '_' || string_split(p_name, ' ')[1]
           WHEN 4 THEN string_split(p_name, ' ')[2]
           ELSE 'x' || CAST(p_partkey AS VARCHAR) END AS name,
         p_partkey
  FROM part),
vars AS (SELECT dataset, name, min(p_partkey) AS pos FROM vr GROUP BY dataset, name)"""


def html_terms() -> str:
    return f"WITH {HTML_ROWS}\nSELECT page_id, seq, CAST(ord AS INTEGER) AS ord, term, attr, value FROM attrs"


def vocab_terms() -> str:
    return f"WITH {LOCAL_VOCAB}\nSELECT term, CAST(floor(ord / 100) AS BIGINT) AS page_id, ord % 100 AS seq, CAST(apos AS INTEGER) AS apos, attr, value FROM lv"


def triple_pattern() -> str:
    return f"WITH {TRIPLES}\nSELECT label, identifier, section, definition, details FROM pat"


def vocab_merge() -> str:
    return f"""WITH {LOCAL_VOCAB}, {TRIPLES},
nb AS (
  SELECT lower(label) AS term,
         arg_min(struct_pack(identifier := identifier, section := section, definition := definition,
                             details := details),
                 struct_pack(a := identifier, b := definition, c := details, d := section)) AS r
  FROM pat WHERE lower(label) NOT IN (SELECT term FROM lv) GROUP BY lower(label))
SELECT term, 'local' AS source, CAST(apos AS INTEGER) AS apos, attr, value FROM lv
UNION ALL SELECT term, 'graph', 0, 'definition', lower(r.definition) FROM nb
UNION ALL SELECT term, 'graph', 1, 'comments', '' FROM nb
UNION ALL SELECT term, 'graph', 2, 'details', lower(r.details) FROM nb
UNION ALL SELECT term, 'graph', 3, 'identifier', lower(r.identifier) FROM nb
UNION ALL SELECT term, 'graph', 4, 'section', lower(r.section) FROM nb"""


MATCHES = f"""
lt AS (SELECT DISTINCT term FROM attrs),
names AS (SELECT DISTINCT name FROM vars),
verb AS (SELECT name, 'verbatim' AS kind, name AS term FROM names WHERE name IN (SELECT term FROM lt)),
r1 AS (SELECT name FROM names WHERE name NOT IN (SELECT name FROM verb)),
ic AS (SELECT r1.name, 'ignore_case' AS kind, lt.term FROM r1 JOIN lt ON lower(r1.name) = lower(lt.term)),
r2 AS (SELECT name FROM r1 WHERE name NOT IN (SELECT name FROM ic)),
s1 AS (SELECT r2.name, 1 AS stage, c.label FROM r2 JOIN cand c
       ON lower(regexp_replace(r2.name, '[^A-Za-z0-9]+', '', 'g')) = lower(c.label)),
s2 AS (SELECT r2.name, 2 AS stage, c.label FROM r2 JOIN cand c
       ON list_bool_and(list_transform(string_split(regexp_replace(r2.name, '[^A-Za-z0-9]+', '_', 'g'), '_'),
                                       lambda t: contains(lower(c.label), lower(t))))),
ps AS (SELECT name, stage, count(*) AS hits, list_sort(list(label)) AS labels
       FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2) GROUP BY name, stage),
best AS (SELECT name, arg_max(struct_pack(stage := stage, hits := hits, labels := labels),
                             struct_pack(u := hits = 1, h := hits, s := -stage)) AS b
         FROM ps GROUP BY name),
fz AS (SELECT name, CASE WHEN b.hits = 1 THEN 'fuzzy' ELSE 'nonunique' END AS kind,
              CASE WHEN b.hits = 1 THEN b.labels[1] END AS term, b.labels AS candidates, b.stage AS stage, b.hits AS hits
       FROM best),
m AS (
  SELECT name, kind, term, CAST([] AS VARCHAR[]) AS candidates, 0 AS stage, 0 AS hits FROM verb
  UNION ALL SELECT name, kind, term, CAST([] AS VARCHAR[]), 0, 0 FROM ic
  UNION ALL SELECT name, kind, term, candidates, stage, hits FROM fz
  UNION ALL SELECT name, 'no_match', NULL, CAST([] AS VARCHAR[]), 0, 0 FROM r2
            WHERE name NOT IN (SELECT name FROM fz)),
mv AS (SELECT vars.dataset, vars.name, vars.pos, m.kind, m.term, m.stage, m.hits, m.candidates
       FROM vars LEFT JOIN m ON vars.name = m.name)"""


def _with_matches() -> str:
    return f"WITH {HTML_ROWS}, {TRIPLES}, {VARIABLES}, {MATCHES}"


def match_cascade() -> str:
    return f"""{_with_matches()}
SELECT dataset, name, pos, kind, term, CAST(stage AS INTEGER) AS stage, hits,
       CAST(len(candidates) AS INTEGER) AS n_candidates, array_to_string(candidates, '|') AS candidates
FROM mv"""


def match_counts() -> str:
    return f"""{_with_matches()}
SELECT dataset,
       count(*) FILTER (WHERE kind = 'verbatim') AS verbatim,
       count(*) FILTER (WHERE kind = 'ignore_case') AS ignore_case,
       count(*) FILTER (WHERE kind = 'fuzzy') AS fuzzy,
       count(*) FILTER (WHERE kind = 'nonunique') AS nonunique,
       count(*) FILTER (WHERE kind = 'no_match') AS no_match
FROM mv GROUP BY dataset"""


def missing_labels() -> str:
    return f"""{_with_matches()}
SELECT name, count(DISTINCT dataset) AS n_datasets, min(dataset) AS first_dataset
FROM mv WHERE kind = 'no_match' GROUP BY name"""


ORACLES = {
    "html_terms": html_terms,
    "vocab_terms": vocab_terms,
    "triple_pattern": triple_pattern,
    "vocab_merge": vocab_merge,
    "match_cascade": match_cascade,
    "match_counts": match_counts,
    "missing_labels": missing_labels,
}
