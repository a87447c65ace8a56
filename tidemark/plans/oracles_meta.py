"""DuckDB oracles for the metadata and catalogue queries."""

from __future__ import annotations

from tidemark.plans.oracles_manifest import FILES
from tidemark.plans.oracles_vocab import LOCAL_VOCAB

LABELS = [
    ("decimalLatitude", "f8"), ("decimalLongitude", "f8"), ("depth", "f8"), ("altitude", "f8"),
    ("eventDate", "S1"), ("scientificName", "S1"), ("individualCount", "i4"),
    ("minimumDepthInMeters", "f8"), ("sampleSizeValue", "f8"), ("bodyWeightInKg", "f8"),
    ("occurrenceID", "S1"), ("latitude", "f8"), ("Depth", "f8"), ("collection_code", "S1"),
    ("event_date", "S1"), ("time", "i8"),
]

# Python white space as an RE2 class
WS = r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NWS = "[^" + WS[1:]


def wrap(expr: str) -> str:
    rx = f"(?:{NWS}{{81,}}|[^\\n]{{1,80}})(?:{WS}+|$)"
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, '{rx}'), "
            f"lambda p: regexp_replace(p, '^{WS}+|{WS}+$', '', 'g')), chr(10))")


DVARS = f"""
dv0 AS (
  SELECT 'dataset_' || lpad(CAST(p_partkey // 40 AS VARCHAR), 9, '0') AS dataset,
         CASE WHEN p_partkey % 40 = 39 THEN replace(p_name, ' ', '') ELSE {'[' + ', '.join(f"'{n}'" for n, _ in LABELS) + ']'}[CAST(p_partkey % 16 AS INTEGER) + 1] END AS name,
         CASE WHEN p_partkey % 40 = 39 THEN 'S1' ELSE {'[' + ', '.join(f"'{t}'" for _, t in LABELS) + ']'}[CAST(p_partkey % 16 AS INTEGER) + 1] END AS dtype,
         p_partkey
  FROM part),
dv AS (SELECT dataset, name, dtype, min(p_partkey) AS pos FROM dv0 GROUP BY dataset, name, dtype),
spec AS (
  SELECT * FROM (VALUES ('decimallongitude', 'longitude', 'degrees_east', NULL),
                        ('decimallatitude', 'latitude', 'degrees_north', NULL),
                        ('altitude', 'altitude', 'm', 'up'),
                        ('depth', 'depth', 'm', 'down')) t(k, dest, units, positive)),
cv AS (
  SELECT dv.*, spec.dest, spec.units AS spec_units, spec.positive,
         CASE WHEN spec.dest IN ('depth', 'altitude') THEN
           row_number() OVER (PARTITION BY dataset, spec.dest IN ('depth', 'altitude')
                              ORDER BY CASE WHEN spec.dest = 'depth' THEN 0 ELSE 1 END, pos) > 1
         ELSE false END AS conflict
  FROM dv LEFT JOIN spec ON lower(dv.name) = spec.k),
cat AS (
  SELECT dataset, pos, name, dtype, conflict,
         CASE WHEN conflict THEN 'source_' || name
              WHEN dest IS NULL AND lower(name) IN ('latitude', 'longitude', 'depth', 'altitude', 'time')
                THEN 'source_' || name
              WHEN dest IS NOT NULL THEN dest ELSE name END AS destination,
         CASE WHEN lower(name) IN ('altitude', 'depth', 'latitude', 'longitude') THEN 'Location'
              ELSE 'Unknown' END AS category,
         CASE dtype WHEN 'S1' THEN 'String' WHEN 'i4' THEN 'int' WHEN 'i8' THEN 'long'
                    WHEN 'f8' THEN 'double' END AS data_type,
         dest, spec_units, positive
  FROM cv)"""


def destination_names() -> str:
    return f"""WITH {DVARS}
SELECT dataset, pos, name, dtype, conflict, destination, category, data_type FROM cat"""


def axis_conflicts() -> str:
    return f"WITH {DVARS}\nSELECT dataset, pos, name, destination FROM cat WHERE conflict"


def keywords() -> str:
    return f"""WITH {DVARS}
SELECT dataset, string_agg(destination, ',' ORDER BY pos) AS keywords, CAST(count(*) AS INTEGER) AS n_variables
FROM cat GROUP BY dataset"""


def variable_units() -> str:
    # axis labels here are letters only, so Python's title() is upper(first) || lower(rest)
    date_like = "(contains(lower(name), '_date') OR contains(name, 'Date'))"
    return f"""WITH {DVARS}, {LOCAL_VOCAB},
vdef AS (SELECT term, max(value) FILTER (WHERE attr = 'definition') AS value,
                string_agg(attr || '=' || value, ';' ORDER BY apos) AS vocab FROM lv GROUP BY term)
SELECT c.dataset, c.pos, c.name, c.dtype,
       CASE WHEN c.dest IS NOT NULL THEN upper(substr(c.name, 1, 1)) || lower(substr(c.name, 2)) ELSE c.name END
         AS long_name,
       CASE WHEN c.dest IS NOT NULL THEN c.spec_units
            WHEN c.dtype IN ('i4', 'f8', 'i8') THEN
              CASE WHEN contains(lower(c.name), 'inkg') THEN 'kg'
                   WHEN contains(lower(c.name), 'in_meters') THEN 'm'
                   WHEN contains(lower(c.name), 'inmeters') THEN 'm'
                   WHEN contains(lower(c.name), 'weightsn') THEN 'N'
                   WHEN {date_like} THEN 'datetime (unspecified)'
                   ELSE 'unspecified' END
            WHEN {date_like} OR contains(lower(c.name), '_time') THEN 'datetime (unspecified)' END AS units,
       c.positive,
       CASE WHEN c.dtype NOT IN ('i4', 'f8', 'i8') AND c.dest IS NULL THEN 'UTF-8' END AS encoding,
       replace(replace({wrap('vdef.value')}, '"', ''), chr(39), '') AS definition, vdef.vocab,
       CASE WHEN vdef.vocab IS NULL THEN 'no term of vocabulary has this name' END AS comment
FROM cat c LEFT JOIN vdef ON vdef.term = c.name"""


def wrap_text() -> str:
    return f"SELECT doc_id, {wrap('text')} AS text FROM documents"


def strip_html() -> str:
    return """SELECT page_id, regexp_replace(html, '<[^>]*>|"', '', 'g') AS text FROM pages"""


def dataset_metadata() -> str:
    p = ["source files deposited", "labels and cells standardised and checked", "written as typed columns with its reports"]
    return f"""WITH {FILES},
it AS (
  SELECT 'item_' || CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderkey % 4 = 0 THEN 'Survey ' || CAST(o_orderkey AS VARCHAR) || ' occurrence data'
              ELSE 'Survey ' || CAST(o_orderkey AS VARCHAR) END AS title,
         '<p>Orders of customer ' || CAST(o_custkey AS VARCHAR) || ' with status "' || o_orderstatus
           || '" and priority ' || o_orderpriority || '. ' || repeat('Collected at sea station. ',
           CAST(o_orderkey % 9 AS INTEGER)) || '</p>' AS body,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Report ' || CAST(o_orderkey AS VARCHAR) END AS citation,
         'http://example.org/items/' || CAST(o_orderkey AS VARCHAR) AS link_url
  FROM orders),
idate AS (SELECT item_id, coalesce(strftime(min(uploaded), '%Y-%m-%dT%H:%M:%SZ'), 'time not known')
          AS item_start FROM mf GROUP BY item_id),
fdate AS (SELECT item_id, src_file,
                 coalesce(strftime(arg_max_null(uploaded, file_pos),
                                   '%Y-%m-%dT%H:%M:%SZ'), 'time not known') AS file_start
          FROM mf GROUP BY item_id, src_file),
ds AS (
  SELECT t.stem AS dataset, t.dftype, it.title, it.body, it.citation, it.link_url, idate.item_start, fdate.file_start
  FROM tagged t JOIN it ON it.id = t.item_id JOIN idate ON idate.item_id = t.item_id
  LEFT JOIN fdate ON fdate.item_id = t.item_id AND fdate.src_file = t.src_file
  WHERE t.candidate)
SELECT dataset,
       CASE WHEN title IS NULL THEN 'Untitled dataset'
            WHEN dftype IS NULL OR contains(title, dftype) THEN title ELSE title || ' ' || dftype END AS title,
       regexp_replace({wrap('body')}, '<[^>]*>|"', '', 'g') AS summary,
       coalesce(citation, 'No publication was cited') AS citation,
       coalesce(item_start, 'time not known') || ': {p[0]}' || chr(10)
         || coalesce(file_start, 'time not known') || ': {p[1]}' || chr(10)
         || '2000-01-01T00:00:00Z: {p[2]}' AS history,
       'item page: ' || link_url AS reference
FROM ds"""


def column_directives() -> str:
    nums = ["_meters", "minimum_", "maximum_", "_minimum_", "_maximum", "decimal", "in_meters", "inmeters"]
    strs = ["_id", "_code"]
    num = " OR ".join(f"contains(lower(name), '{t}')" for t in nums)
    st = " OR ".join(f"contains(lower(name), '{t}')" for t in strs)
    return f"""WITH {DVARS}
SELECT dataset, pos, name AS label,
       CASE WHEN lower(name) IN ('decimallongitude', 'decimallatitude', 'altitude', 'depth') THEN 'position'
            WHEN {num} THEN 'numeric' WHEN {st} THEN 'string' ELSE 'none' END AS directive
FROM dv"""


def catalog() -> str:
    return f"""WITH {DVARS}
SELECT dataset, 'Occurrence table ' || dataset AS title, 'Local source' AS info_url,
       'No summary info available' AS summary,
       string_agg(destination, ',' ORDER BY pos) AS keywords, CAST(count(*) AS INTEGER) AS n_variables,
       string_agg(CAST(pos AS VARCHAR) || ':' || name || ':' || destination || ':' || data_type || ':' || category,
                  ';' ORDER BY pos) AS variables
FROM cat GROUP BY dataset"""


ORACLES = {
    "catalog": catalog,
    "column_directives": column_directives,
    "variable_units": variable_units,
    "destination_names": destination_names,
    "axis_conflicts": axis_conflicts,
    "keywords": keywords,
    "wrap_text": wrap_text,
    "strip_html": strip_html,
    "dataset_metadata": dataset_metadata,
}
