"""DuckDB oracle SQL, written independently of the Spark code paths.

DuckDB notes: ``%`` and integer arithmetic match Spark for the non
negative keys used here; ``sum`` returns HUGEINT so counters are cast to
BIGINT; lambdas use the ``lambda x: ...`` form.
"""

from __future__ import annotations

NUM_RX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# --------------------------------------------------------------------------
# Reconcile: orders source vs revision
# --------------------------------------------------------------------------
_ORDERS_L = """
l AS (
  SELECT o_orderkey AS row_idx,
         CAST(o_orderkey AS VARCHAR) AS c0,
         CAST(o_custkey AS VARCHAR) AS c1,
         CASE WHEN o_orderkey % 83 = 0 THEN 'NA' ELSE o_orderstatus END AS c2,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS c3,
         o_orderpriority AS c4
  FROM orders)"""

_ORDERS_R = """
r AS (
  SELECT o_orderkey AS row_idx,
         CAST(o_orderkey AS VARCHAR) AS c0,
         CAST(o_custkey AS VARCHAR) AS c1,
         CASE WHEN o_orderkey % 83 = 0 THEN 'n/a' ELSE o_orderstatus END AS c2,
         CASE WHEN o_orderkey % 97 = 0 THEN CAST(CAST(o_totalprice + 1.0 AS DECIMAL(18,2)) AS VARCHAR)
              WHEN o_orderkey % 89 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,3)) AS VARCHAR)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS c3,
         o_orderpriority AS c4
  FROM orders
  WHERE o_orderkey <= (SELECT max(o_orderkey) FROM orders) - 10)"""

# common columns in left order, with "interior cell" flags of each side
_ORDERS_COLS = [("o_orderkey", False, False), ("o_custkey", True, True),
                ("o_orderstatus", True, True), ("o_totalprice", True, True),
                ("o_orderpriority", False, True)]


def _flt(expr: str, interior: bool) -> str:
    if not interior:
        return expr
    return f"CASE WHEN lower({expr}) IN ('n/a','none','na') THEN 'NA' ELSE {expr} END"


def _num(expr: str) -> str:
    return f"regexp_matches({expr}, '{NUM_RX}')"


def _orders_paired() -> str:
    cols = []
    for i, (_, li, ri) in enumerate(_ORDERS_COLS):
        lr, rr = f"trim(l.c{i})", f"trim(r.c{i})"
        lf, rf = f"trim({_flt(f'l.c{i}', li)})", f"trim({_flt(f'r.c{i}', ri)})"
        both = "(l.row_idx IS NOT NULL AND r.row_idx IS NOT NULL)"
        eq = (f"CASE WHEN {_num(lf)} AND {_num(rf)} THEN TRY_CAST({lf} AS DOUBLE) = TRY_CAST({rf} AS DOUBLE) "
              f"WHEN NOT {_num(lf)} AND NOT {_num(rf)} THEN {lf} = {rf} ELSE false END")
        cols.append(f"{lr} AS lv{i}, {rr} AS rv{i}, "
                    f"{both} AND {lr} <> {rr} AS raw{i}, "
                    f"{both} AND {lf} <> {rf} AS flt{i}, "
                    f"{both} AND {lf} <> {rf} AND NOT ({eq}) AS typ{i}")
    return f"""WITH {_ORDERS_L}, {_ORDERS_R},
p AS (
  SELECT coalesce(l.row_idx, r.row_idx) AS row_idx,
         l.row_idx IS NOT NULL AS in_l, r.row_idx IS NOT NULL AS in_r,
         {', '.join(cols)}
  FROM l FULL OUTER JOIN r ON l.row_idx = r.row_idx)"""


def _orders_counts() -> str:
    n = len(_ORDERS_COLS)
    sums = ", ".join(
        f"CAST(sum(CASE WHEN {f}{i} THEN 1 ELSE 0 END) AS BIGINT) AS {f}{i}"
        for i in range(n) for f in ("raw", "flt", "typ"))
    tot = lambda f: " + ".join(f"{f}{i}" for i in range(n))
    return f"""{_orders_paired()},
c AS (
  SELECT CAST(sum(CASE WHEN in_l THEN 1 ELSE 0 END) AS BIGINT) AS o_row,
         CAST(sum(CASE WHEN in_r THEN 1 ELSE 0 END) AS BIGINT) AS r_row,
         CAST(sum(CASE WHEN in_l AND in_r THEN 1 ELSE 0 END) AS BIGINT) AS paired,
         {sums}
  FROM p),
t AS (
  SELECT o_row, r_row, paired, 6 AS o_col, 7 AS r_col, paired * {n} AS share_all,
         {tot('raw')} AS no_share, {tot('flt')} AS no_fltr, {tot('typ')} AS no_fltr_typ
  FROM c)"""


def reconcile_entries() -> str:
    return f"""{_orders_counts()}
SELECT 'total source entries' AS measure, o_row * o_col AS count, CAST(NULL AS DOUBLE) AS percent FROM t
UNION ALL SELECT 'shared (common) entries', share_all, CAST(share_all AS DOUBLE) / (o_row * o_col) * 100 FROM t
UNION ALL SELECT 'matching of shared entries', share_all - no_share,
                 CAST(share_all - no_share AS DOUBLE) / share_all * 100 FROM t
UNION ALL SELECT 'non-matching of shared entries', no_share, CAST(no_share AS DOUBLE) / share_all * 100 FROM t
UNION ALL SELECT 'missing entries', o_row * 1, CAST(o_row * 1 AS DOUBLE) / (o_row * o_col) * 100 FROM t
UNION ALL SELECT 'extra entries', r_row * 2, CAST(r_row * 2 AS DOUBLE) / (r_row * r_col) * 100 FROM t"""


def reconcile_dims() -> str:
    return f"""{_orders_counts()}
SELECT 'source file' AS side, o_row AS rows, o_col AS columns FROM t
UNION ALL SELECT 'reconstructed file', r_row, r_col FROM t
UNION ALL SELECT '(row, col) difference', o_row - r_row, o_col - r_col FROM t"""


def discrepancy_reduction() -> str:
    return f"""{_orders_counts()}
SELECT 'non-matching' AS stage, no_share AS count,
       CASE WHEN no_share > 0 THEN CAST(no_share AS DOUBLE) / share_all * 100 END AS remaining_pct FROM t
UNION ALL SELECT 'filtering', no_fltr,
       CASE WHEN no_share > 0 THEN CAST(no_fltr AS DOUBLE) / share_all * 100 END FROM t
UNION ALL SELECT 'filtering + equivalence', no_fltr_typ,
       CASE WHEN no_share > 0 THEN CAST(no_fltr_typ AS DOUBLE) / share_all * 100 END FROM t"""


def reconcile_by_column() -> str:
    parts = [f"SELECT '{name}' AS column, {i} AS pos, paired AS shared, raw{i} AS raw_mismatch, "
             f"flt{i} AS filtered_mismatch, typ{i} AS equivalent_mismatch FROM c"
             for i, (name, _, _) in enumerate(_ORDERS_COLS)]
    return f"{_orders_counts()}\n" + "\nUNION ALL ".join(parts)


def top_errors() -> str:
    parts = [f"SELECT row_idx, '{name}' AS column, lv{i} AS original, rv{i} AS reproduced FROM p WHERE typ{i}"
             for i, (name, _, _) in enumerate(_ORDERS_COLS)]
    return f"""{_orders_paired()},
e AS ({' UNION ALL '.join(parts)})
SELECT row_idx, "column", original, reproduced, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY row_idx) AS INTEGER) AS rank FROM e)
WHERE rank <= 50"""


def round_trip() -> str:
    # a lossless export and reread: every shared entry matches
    return """WITH t AS (SELECT count(*) AS n FROM orders)
SELECT 'total source entries' AS measure, n * 6 AS count, CAST(NULL AS DOUBLE) AS percent FROM t
UNION ALL SELECT 'shared (common) entries', n * 6, 100.0 FROM t
UNION ALL SELECT 'matching of shared entries', n * 6, 100.0 FROM t
UNION ALL SELECT 'non-matching of shared entries', 0, 0.0 FROM t
UNION ALL SELECT 'missing entries', 0, 0.0 FROM t
UNION ALL SELECT 'extra entries', 0, 0.0 FROM t"""


def reconcile_messages() -> str:
    # the label facts of the two fixture schemas, then the verdict from the counters
    return f"""{_orders_counts()}
SELECT 'WARNING' AS severity, 'labels_differ' AS code,
       'label lists differ; columns are compared where names agree' AS message
UNION ALL SELECT 'CRITICAL', 'extra_columns', 'only in the second table: o_orderdate_utc, o_clerk'
UNION ALL SELECT 'CRITICAL', 'missing_columns', 'only in the first table: o_orderdate'
UNION ALL SELECT CASE WHEN no_fltr_typ = 0 THEN 'INFO' ELSE 'WARNING' END, 'entry_agreement',
       CASE WHEN no_share = 0 THEN 'all shared cells agree'
            WHEN no_fltr_typ = 0 THEN 'shared cells agree once tokens and number formats are allowed for'
            ELSE 'some shared cells differ even with all allowances' END FROM t"""


def key_duplicates() -> str:
    return """WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
           GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT 'source' AS side, l_orderkey, l_linenumber, n FROM d
UNION ALL SELECT 'reconstructed', l_orderkey, l_linenumber, n FROM d"""


def export_sizes() -> str:
    line = ("length(concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), "
            "CASE WHEN o_orderkey % 83 = 0 THEN 'NA' ELSE o_orderstatus END, "
            "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), "
            "o_orderpriority)) + 1")
    header = len("o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority") + 1
    return f"""WITH s AS (SELECT sum({line}) + {header} AS l, count(*) AS n FROM orders),
b AS (SELECT CAST(l AS BIGINT) AS left_bytes, CAST(l + 12 * n AS BIGINT) AS right_bytes FROM s)
SELECT left_bytes, right_bytes, left_bytes = right_bytes AS equal,
       CAST(right_bytes - left_bytes AS DOUBLE) / (CAST(left_bytes AS DOUBLE) * 0.01) AS percent_difference
FROM b"""


ORACLES = {
    "reconcile_messages": reconcile_messages,
    "key_duplicates": key_duplicates,
    "export_sizes": export_sizes,
    "round_trip": round_trip,
    "reconcile_entries": reconcile_entries,
    "reconcile_dims": reconcile_dims,
    "discrepancy_reduction": discrepancy_reduction,
    "reconcile_by_column": reconcile_by_column,
    "top_errors": top_errors,
}


def oracle_sql() -> dict[str, str]:
    from tidemark.plans import (oracles_io, oracles_lines, oracles_manifest, oracles_meta, oracles_profile,
                                oracles_vocab)
    allq = dict(ORACLES)
    for mod in (oracles_io, oracles_lines, oracles_profile, oracles_vocab, oracles_manifest, oracles_meta):
        allq.update(mod.ORACLES)
    return {k: f() for k, f in allq.items()}
