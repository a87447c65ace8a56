"""DuckDB oracles for the manifest queries."""

from __future__ import annotations

FILES = """
mfiles AS (
  SELECT 'item_' || CAST(l_orderkey AS VARCHAR) AS item_id, l_linenumber AS ln,
         CAST(l_linenumber AS BIGINT) * 1000000000000
           + (l_partkey * 1000003 + l_suppkey * 10007 + CAST(round(l_extendedprice * 100) AS BIGINT) * 101
              + datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) % 1000000000000 AS file_pos,
         CASE WHEN l_linenumber = 7 THEN 'notes_' || CAST(l_orderkey AS VARCHAR) || '.txt'
              WHEN l_linenumber % 2 = 0 THEN 'occurrence_' || CAST(l_orderkey AS VARCHAR) || '_'
                                             || CAST(l_linenumber % 3 AS VARCHAR) || '.csv'
              ELSE 'occurrence_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber % 3 AS VARCHAR)
                   || '.zip' END AS name,
         CASE WHEN l_partkey % 10 = 0 THEN 'DarwinCore:Occurrence extension' END AS title,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS size,
         CASE WHEN l_linenumber = 6 AND l_orderkey % 11 = 0 THEN 'n/a'
              WHEN l_linenumber = 5 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '.123456Z'
              ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') END AS dateUploaded
  FROM lineitem),
mf AS (
  SELECT *, string_split(name, '.')[1] AS stem,
         try_strptime(dateUploaded, ['%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%dT%H:%M:%S.%fZ']) AS uploaded,
         CASE WHEN contains(name, '.zip') THEN string_split(name, '.')[1] || '.csv' ELSE name END AS src_file,
         CASE WHEN contains(lower(title), 'darwincore:event') THEN 'darwincore:event data'
              WHEN contains(lower(title), 'darwincore:occurrence') THEN 'darwincore:occurrence data'
              WHEN contains(lower(title), 'darwincore:measurementorfact') THEN 'darwincore:measurementorfact data'
              WHEN contains(lower(title), 'final processed source') THEN 'final processed source data'
              WHEN contains(lower(title), 'final processed file') THEN 'final processed file data'
              WHEN (contains(lower(name), '.csv') OR contains(lower(name), '.zip')) THEN
                CASE WHEN contains(lower(name), 'occurrence') THEN 'occurrence data'
                     WHEN contains(lower(name), 'event') THEN 'event data'
                     WHEN contains(lower(name), 'measurementorfact') THEN 'measurementorfact data' END
         END AS dftype
  FROM mfiles),
tagged AS (
  SELECT *, dftype IS NOT NULL AS passes,
         dftype IS NOT NULL AND row_number() OVER (PARTITION BY item_id, stem, dftype IS NOT NULL
                                                   ORDER BY file_pos) = 1 AS candidate
  FROM mf)"""

ITEMS = """
items AS (
  SELECT 'item_' || CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderkey % 4 = 0 THEN 'Survey ' || CAST(o_orderkey AS VARCHAR) || ' occurrence data'
              ELSE 'Survey ' || CAST(o_orderkey AS VARCHAR) END AS title
  FROM orders)"""

LOCAL = """
copies AS (
  SELECT 'occurrence_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber % 3 AS VARCHAR) || '.csv' AS file,
         max(CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_partkey % 37 - 24 AS INTEGER))) AS modified
  FROM lineitem WHERE l_orderkey % 3 <> 0 AND l_linenumber <> 7 GROUP BY 1),
loc AS (
  SELECT * FROM copies
  UNION ALL SELECT 'legacy_' || CAST(o_orderkey AS VARCHAR) || '.csv', CAST(o_orderdate AS TIMESTAMP)
  FROM orders WHERE o_orderkey % 50 = 0)"""

FRESH = """
fresh AS (
  SELECT t.*, loc.modified,
         CASE WHEN loc.modified IS NULL THEN 'absent'
              WHEN t.uploaded IS NULL THEN 'bad_upload_time'
              WHEN loc.modified < t.uploaded - INTERVAL 12 HOUR THEN 'stale'
              ELSE 'current' END AS reason
  FROM tagged t LEFT JOIN loc ON loc.file = t.src_file WHERE t.candidate)"""


def candidate_files() -> str:
    return f"WITH {FILES}\nSELECT item_id, name, stem, dftype, size FROM tagged WHERE candidate"


def manifest_summary() -> str:
    return f"""WITH {FILES}, {ITEMS}, {LOCAL}, {FRESH}
SELECT (SELECT count(*) FROM items) AS items, count(*) AS total_files,
       CAST(sum(CASE WHEN candidate THEN 1 ELSE 0 END) AS BIGINT) AS candidate_files,
       sum(CASE WHEN candidate THEN size ELSE 0 END) / 1e6 AS candidate_mb,
       (SELECT CAST(sum(CASE WHEN reason IN ('absent', 'stale') THEN 1 ELSE 0 END) AS BIGINT) FROM fresh)
         AS downloads,
       (SELECT sum(CASE WHEN reason IN ('absent', 'stale') THEN size ELSE 0 END) / 1e6 FROM fresh) AS download_mb
FROM tagged"""


def freshness() -> str:
    return f"""WITH {FILES}, {LOCAL}, {FRESH}
SELECT item_id, name, src_file, reason, reason IN ('absent', 'stale') AS fetch FROM fresh"""


def items_without_files() -> str:
    return f"""WITH {FILES}, {ITEMS}
SELECT id, title FROM items WHERE id NOT IN (SELECT item_id FROM tagged WHERE candidate)"""


def request_status() -> str:
    return f"""WITH {FILES}, {LOCAL},
req AS (SELECT DISTINCT src_file AS file FROM tagged WHERE candidate),
l AS (SELECT DISTINCT file FROM loc WHERE ends_with(file, '.csv'))
SELECT file, 'ok' AS status FROM l WHERE file IN (SELECT file FROM req)
UNION ALL SELECT file, 'ignored' FROM l WHERE file NOT IN (SELECT file FROM req)
UNION ALL SELECT file, 'missing' FROM req WHERE file NOT IN (SELECT file FROM l)"""


def item_dates() -> str:
    return f"""WITH {FILES}
SELECT item_id, count(*) AS files, count(uploaded) AS dated,
       coalesce(strftime(min(uploaded), '%Y-%m-%dT%H:%M:%SZ'), 'time not known') AS start_date
FROM mf GROUP BY item_id"""


def file_dates() -> str:
    return f"""WITH {FILES}
SELECT item_id, src_file,
       coalesce(strftime(arg_max_null(uploaded, file_pos),
                         '%Y-%m-%dT%H:%M:%SZ'), 'time not known') AS file_start_date
FROM mf GROUP BY item_id, src_file"""


def first_files() -> str:
    return f"""WITH {FILES}
SELECT DISTINCT src_file AS name FROM tagged WHERE candidate ORDER BY name LIMIT 10"""


ORACLES = {
    "first_files": first_files,
    "candidate_files": candidate_files,
    "manifest_summary": manifest_summary,
    "freshness": freshness,
    "items_without_files": items_without_files,
    "request_status": request_status,
    "item_dates": item_dates,
    "file_dates": file_dates,
}
