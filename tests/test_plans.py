"""Plan shape and distribution properties."""

from pyspark.sql import functions as F

from tidemark.operators.prefix import running_sum
from tidemark.operators.profile import profile
from tidemark.plans import fixtures as fx
from tidemark.plans import queries as q
from tests.conftest import SF_MID


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_errors_uses_window_group_limit(spark):
    p = _plan(q.top_errors(spark, SF_MID))
    assert "WindowGroupLimit" in p


def test_no_single_partition_exchange_on_lines(spark):
    for df in (q.running_quote_style(spark, SF_MID), q.row_width_qc(spark, SF_MID)):
        p = _plan(df)
        assert "SinglePartition" not in p


def test_fuzzy_join_is_an_equi_join(spark):
    p = _plan(q.match_cascade(spark, SF_MID))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_single_layout_is_parsed_without_a_header_join(spark):
    from tidemark.sources.delimited import cells_table
    p = _plan(cells_table(fx.part_lines(spark, SF_MID)))
    assert "Join" not in p.replace("JoinType", "") or p.count("Scan parquet") <= 4


def test_running_sum_independent_of_partitioning(spark):
    base = spark.range(0, 5000).select(F.col("id").alias("line_no"), (F.col("id") % 7 - 3).alias("v"),
                                       (F.col("id") % 3).cast("string").alias("file"))
    want = {(r["file"], r["line_no"]): r["s"] for r in
            running_sum(base, ["file"], "line_no", {"s": F.col("v")}, block=10 ** 9).collect()}
    for parts, block in ((1, 64), (7, 100), (13, 1)):
        got = running_sum(base.repartition(parts), ["file"], "line_no", {"s": F.col("v")}, block=block)
        assert {(r["file"], r["line_no"]): r["s"] for r in got.collect()} == want


def test_profile_is_mergeable(spark):
    li = fx.lineitem_text(spark, SF_MID)
    whole = {r["column"]: (r["family"], r["max_len"], r["non_null"]) for r in profile(li).collect()}
    a = li.where(F.col("l_orderkey").cast("long") % 2 == 0)
    b = li.where(F.col("l_orderkey").cast("long") % 2 == 1)
    from tidemark.operators.profile import reconcile_types
    pa = profile(a).withColumn("chunk", F.lit(0))
    pb = profile(b).withColumn("chunk", F.lit(1))
    merged = {r["column"]: (r["family"], r["max_len"], r["non_null"])
              for r in reconcile_types(pa.unionByName(pb)).collect()}
    assert merged == whole


def test_stage2_pairs_equal_brute_force(spark):
    import re

    from tidemark.operators.vocab import _all_labels, _stage2_pairs
    names = ["widget_red", "gizmo", "Old_Ring", "_", "**", "x5", "ring_old", "a_b_c", "hot", "o", "_d__r"]
    labels = [(lab, 1 + i % 2) for i, lab in enumerate(["redwidget", "bluegizmo", "coldring", "OldRing", "hotplate", "shotgun", "abc"])]
    n = spark.createDataFrame([(x,) for x in names], "name string")
    lab = spark.createDataFrame(labels, "label string, mult long")
    tokens = {x: [t.lower() for t in re.split("[^A-Za-z0-9]+", x) if t] for x in names}
    want = {(x, y, m) for x in names for y, m in labels if tokens[x] and all(t in y.lower() for t in tokens[x])}
    assert {(r["name"], r["label"], r["mult"]) for r in _stage2_pairs(n, lab).collect()} == want
    every = {(r["name"], r["mult"], r["only"]) for r in _all_labels(n, lab).collect()}
    assert {(x, m) for x, m, _ in every} == {("_", sum(m for _, m in labels)), ("**", sum(m for _, m in labels))}


def test_wide_table_profile_and_reconcile(spark):
    # 150 columns: beyond the whole-stage codegen field limit, still one aggregate
    from tidemark.operators.compare import reconcile
    n = 150
    base = spark.range(0, 300).select(F.col("id").alias("row_idx"),
                                      *[(F.col("id") * (i + 1)).cast("string").alias(f"c{i}") for i in range(n)])
    prof = {r["column"]: r["family"] for r in profile(base, [f"c{i}" for i in range(n)]).collect()}
    assert len(prof) == n and set(prof.values()) == {"int"}
    other = base.withColumn("c7", F.when(F.col("row_idx") == 5, F.lit("x")).otherwise(F.col("c7")))
    e = {r["measure"]: r["count"] for r in reconcile(base, other).entries().collect()}
    assert e["non-matching of shared entries"] == 1 and e["shared (common) entries"] == 300 * n


def test_reports_of_one_reconciliation_share_one_join(spark):
    r = q.orders_reconciliation(spark, SF_MID)
    assert _plan(r.paired()).count("SortMergeJoin") + _plan(r.paired()).count("BroadcastHashJoin") == 1
    for report in (r.dims(), r.entries(), r.discrepancies(), r.by_column(), r.messages()):
        p = _plan(report)
        assert "Join" not in p and p.count("FileScan") == 1


def test_hot_key_is_no_window_and_spreads(spark, monkeypatch):
    from tidemark.operators import compare
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"),
                               F.col("id").cast("string").alias("x"))
    want = None
    for most in (compare.BROADCAST_KEYS, 0):  # keys sent to all tasks, or the hot ones sent and the others joined
        monkeypatch.setattr(compare, "BROADCAST_KEYS", most)
        r = compare.reconcile(df, df.repartition(5), on="k")
        assert "Window" not in _plan(r.paired())
        got = ([tuple(x) for x in r.by_column().collect()], r.counts().first()["repeated"])
        assert want in (None, got)
        want = got
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = r.paired().groupBy(F.spark_partition_id()).count().collect()
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert max(x["count"] for x in rows) < 10_000  # of 50,000 rows in 8 parts, 40,000 of them of two hot keys
    assert want[0][0][2] == n // 3 and want[1] == 4 * n // 3


def test_two_keys_one_null(spark):
    from tidemark.operators.compare import reconcile
    left = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (1, 2, "c"), (2, None, "d"), (3, 3, "e"), (3, 3, "f")], "i int, j int, x string")
    right = spark.createDataFrame([(1, 2, "c"), (2, None, "d"), (3, 3, "e"), (4, 4, "z"), (4, 4, "z")], "i int, j int, x string")
    r = reconcile(left, right, on=["i", "j"])
    c = r.counts().first()
    assert (c["o_row"], c["r_row"], c["paired"], c["repeated"]) == (6, 5, 1, 6)


def test_graph_pattern_scans_the_triples_once(spark):
    p = _plan(q.triple_pattern(spark, SF_MID))
    from tidemark.operators import vocab as vc
    t = fx.graph_triples(spark, SF_MID)
    assert p.count("FileScan") == _plan(t).count("FileScan") and "collect_list" in _plan(vc.triple_pattern(t))


def test_names_of_one_gram_are_never_paired(spark):
    from tidemark.operators import vocab as vc
    labels = spark.createDataFrame([(f"{a}red{i}", 1 + i % 2) for i in range(50) for a in "ab"], "label string, mult long")
    names = spark.createDataFrame([("red",), ("a",), ("_R_",), ("zz",), ("reda",), ("a_red",)], "name string")
    assert {r["name"] for r in vc._stage2_pairs(names, labels, singles=False).collect()} == {"a_red"}
    got = {r["name"]: (r["hits"], r["labels"]) for r in vc._single_grams(names, labels, 3).collect()}
    assert got == {"red": (150, ["ared0", "ared1", "ared1"]), "a": (75, ["ared0", "ared1", "ared1"]), "_R_": (150, ["ared0", "ared1", "ared1"])}
    assert vc.candidate_rows(names, labels.drop("mult")).groupBy("name").count().where("name = 'red'").first()["count"] == 100


def test_dataset_metadata_shuffles_only_what_it_uses(spark):
    plan = q.dataset_metadata(spark, SF_MID)._jdf.queryExecution().optimizedPlan().toString()
    assert "example.org/files" not in plan  # the files' URLs
    assert "example.org/items" in plan


def test_counters_of_a_whole_table_need_no_shuffle_by_key(spark):
    from tidemark.operators.profile import counters, profile
    df = spark.createDataFrame([("1", None), ("2.5", "x")], "a string, b string")
    assert "hashpartitioning" not in counters(df)._jdf.queryExecution().executedPlan().toString()
    assert {(r["column"], r["family"], r["non_null"]) for r in profile(df).collect()} == {("a", "float", 2), ("b", "object", 1)}
    assert profile(df.where("false")).count() == 0
