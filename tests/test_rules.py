"""Golden cases for the exact semantics (S-rules) on hand-written rows."""

import random
import re

from pyspark.sql import functions as F

from tidemark.functions.numeric import equivalent
from tidemark.functions.text import clean_label, title_label, ustrip, wrap_text
from tidemark.operators import structure as st
from tidemark.operators.compare import reconcile
from tidemark.operators.rules import first_rule
from tidemark.sources.lines import sniff_header


def _one(spark, col, *vals, schema="v string"):
    df = spark.createDataFrame([(v,) for v in vals], schema)
    return [r[0] for r in df.select(col).collect()]


def test_sniff_tie_first_wins(spark):
    lines = spark.createDataFrame([("f", 0, "a,b|c;d"), ("g", 0, "a|b|c")], "file string, line_no long, line string")
    got = {r["file"]: (r["delim"], list(r["labels"])) for r in sniff_header(lines).collect()}
    assert got["f"] == (",", ["a", "b|c;d"])
    assert got["g"] == ("|", ["a", "b", "c"])


def test_width_matches_lookahead_on_random_lines(spark):
    rnd = random.Random(7)
    alphabet = ['a', ',', '"', ' ', 'b']
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    rx = re.compile(r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    expected = [len(rx.split(x)) for x in lines]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, v string")
    got = [r[1] for r in df.select("i", st.cell_width("v")).orderBy("i").collect()]
    assert got == expected
    cells = [list(r[1]) for r in df.select("i", st.split_cells("v")).orderBy("i").collect()]
    assert cells == [rx.split(x) for x in lines]


def test_token_replace_adjacent_and_edges(spark):
    col = st.replace_tokens_line("v", {",n/a,": ",NA,", ",none,": ",NA,", ",na,": ",NA,"}, ignore_case=True)
    got = _one(spark, col, "x,na,na,x", "na,x,n/a", "x,NONE,n/a,none,y", "x,nan,x")
    assert got == ["x,NA,NA,x", "na,x,n/a", "x,NA,NA,NA,y", "x,nan,x"]
    exact = st.replace_tokens_line("v", {",na,": ",NA,"}, ignore_case=False)
    assert _one(spark, exact, "x,na,Na,x") == ["x,NA,Na,x"]


def test_equivalence_numbers_text_nan(spark):
    df = spark.createDataFrame([("1.00", "1"), ("1d", "1"), ("nan", "nan"), ("abc", "abc"), ("1e3", "1000"),
                                (" 2 ", "2.0"), ("x", "1")], "a string, b string")
    got = [r[0] for r in df.select(equivalent("a", "b")).collect()]
    assert got == [True, False, False, True, True, True, False]


def test_labels_and_wrap(spark):
    assert _one(spark, clean_label("v"), " decimal Latitude (deg) ") == ["decimal_Latitude_deg_"]
    assert _one(spark, title_label("v"), "max_depth_2m", "decimalLatitude") == ["Max_Depth_2M", "Decimallatitude"]
    assert _one(spark, ustrip("v"), "  x \t") == ["x"]
    text = ("word " * 40) + "x" * 90 + " end"
    want = "\n".join(p.strip() for p in re.findall(r"(?:\S{81,}|.{1,80})(?:\s+|$)", text))
    assert _one(spark, wrap_text("v"), text) == [want]


def test_reconcile_self_has_no_mismatch(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumn("row_idx", F.col("o_orderkey"))
    r = reconcile(o, o, postfilter=True, equivalence=True)
    rows = {x["measure"]: x["count"] for x in r.entries().collect()}
    assert rows["non-matching of shared entries"] == 0
    assert rows["missing entries"] == 0 and rows["extra entries"] == 0
    assert r.errors().count() == 0


def test_reconcile_duplicate_labels_flagged(spark):
    left = spark.createDataFrame([(0, "a", "b")], "row_idx long, x string, y string").toDF("row_idx", "x", "x")
    right = spark.createDataFrame([(0, "a", "b")], "row_idx long, x string, y string")
    r = reconcile(left, right)
    codes = [m["code"] for m in r.messages().collect()]
    assert "duplicate_labels" in codes


def test_token_replace_equals_list_form_on_random_lines(spark):
    rnd = random.Random(3)
    toks = ["na", "NA", "n/a", "N/A", "none", "None", "x", "", "nan", "1"]
    lines = [",".join(rnd.choice(toks) for _ in range(rnd.randint(1, 8))) for _ in range(3000)]

    def list_form(line):
        cells = line.split(",")
        return ",".join("NA" if 0 < i < len(cells) - 1 and c.lower() in ("n/a", "none", "na") else c
                        for i, c in enumerate(cells))

    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, v string")
    col = st.replace_tokens_line("v", {",n/a,": ",NA,", ",none,": ",NA,", ",na,": ",NA,"}, ignore_case=True)
    got = [r[1] for r in df.select("i", col).orderBy("i").collect()]
    assert got == [list_form(x) for x in lines]


def test_times_do_not_depend_on_the_session_zone(spark):
    from tidemark.functions.time import format_iso, parse_iso
    from tidemark.operators.coerce import normalize_time
    text = ["2020-01-01T00:00:00Z", "2020-07-01 12:30:00", "2020-07-01T12:30:00+02:00", "2020-03-08 02:30:00", "1969-12-31 23:59:59.5",
            "2020-01-01T00:00:00.123456Z", "2020-01-01", "no time", None]
    want = ["2020-01-01T00:00:00Z", "2020-07-01T12:30:00Z", "2020-07-01T10:30:00Z", "2020-03-08T02:30:00Z", "1969-12-31T23:59:59Z",
            "2020-01-01T00:00:00Z", "2020-01-01T00:00:00Z", None, None]
    days = [18262, 18444, 18444, 18329, -1, 18262, 18262, None, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, v string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = df.select("i", normalize_time("v", "string").alias("s"), normalize_time("v", "integer").alias("d"),
                            format_iso(parse_iso("v")).alias("iso")).orderBy("i").collect()
            assert [r["s"] for r in got] == want, z
            assert [r["d"] for r in got] == days, z
            assert got[0]["iso"] == want[0] and got[5]["iso"] == want[5] and got[7]["iso"] is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    kolkata = df.where("i = 1").select(normalize_time("v", "string", source_tz="Asia/Kolkata")).first()[0]
    assert kolkata == "2020-07-01T07:00:00Z"


def test_null_is_not_the_empty_text(spark):
    left = spark.createDataFrame([(0, None), (1, ""), (2, None)], "row_idx long, x string")
    right = spark.createDataFrame([(0, ""), (1, ""), (2, None)], "row_idx long, x string")
    r = reconcile(left, right, equivalence=True)
    assert [(x["shared"], x["raw_mismatch"], x["equivalent_mismatch"]) for x in r.by_column().collect()] == [(3, 1, 1)]


def test_repeated_keys_are_not_paired(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, x string")
    r = reconcile(t, t, on="k")
    assert [m["severity"] for m in r.messages().where("code = 'repeated_keys'").collect()] == ["CRITICAL"]
    assert {x["column"]: x["shared"] for x in r.by_column().collect()} == {"k": 1, "x": 1}
    assert [d["rows"] for d in r.dims().collect()] == [4, 4, 0]


def test_dotted_names_and_long_integers(spark):
    from tidemark.operators.profile import profile
    df = spark.createDataFrame([("00000000000000000000005", "99999999999999999999", "1")], "`a.b` string, big string, `c d` string")
    got = {r["column"]: (r["family"], r["max_int"]) for r in profile(df, int_overflow="long").collect()}
    assert got == {"a.b": ("int", 5), "big": ("object", None), "c d": ("int", 1)}


def test_cells_keep_control_characters_and_inner_quotes(spark):
    from tidemark.sources.delimited import cells_table
    lines = spark.createDataFrame([("f", 0, "a,b"), ("f", 1, "x\u0001y,'it''s'"), ("f", 2, "'5','6'")], "file string, line_no long, line string")
    got = [tuple(r) for r in cells_table(lines, unwrap=True).select("a", "b").orderBy("row_idx").collect()]
    assert got == [("x\u0001y", "it's"), ("5", "6")]
    import pytest
    with pytest.raises(ValueError):
        cells_table(lines.unionByName(spark.createDataFrame([("g", 0, "a,b,c")], lines.schema)))


def test_standardize_single_quotes_strings_tokens_and_times(spark):
    from tidemark.plans.standardize import standardize
    rows = ["obs_id|n|when|note|bad_time"] + [f"{i}|'{i}'|2020-01-0{1 + i % 9} 01:00:00|n/a|never" for i in range(20)]
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(rows)], "file string, line_no long, line string")
    std = standardize(lines, time_cols=["when", "bad_time"], time_mode="string", chunk_elements=10)
    assert std.types == {"obs_id": "string", "n": "int", "when": "time(string)", "note": "numeric", "bad_time": "text"}
    row = std.table.where("row_idx = 3").first()
    assert (row["obs_id"], row["n"], row["when"], row["bad_time"]) == ("3", 3, "2020-01-04T01:00:00Z", "never")
    assert {r["code"] for r in std.qc.collect()} == {"time_unparsed"}
    assert std.quoting.first()["quoting"] in ("all", "nonnumeric", "minimal")


def test_maximal_position_precision(spark):
    from tidemark.operators.coerce import coerce_position, position_precision
    df = spark.createDataFrame([(0, "1.5", "7"), (1, " 2.125 ", "x.99999"), (2, "?", None), (3, "3", "8.25")], "row_idx long, a string, b string")
    assert [r["precision"] for r in position_precision(df, ["a", "b"], "max").collect()] == [3, 2]
    assert [r["precision"] for r in position_precision(df, ["a", "b"]).collect()] == [1, 0]
    assert [tuple(r) for r in coerce_position(df, ["a", "b"], "max").orderBy("row_idx").collect()] == [
        (0, 1.5, 7.0), (1, 2.125, None), (2, None, None), (3, 3.0, 8.25)]


def test_first_of_a_hundred_thousand_rules(spark):
    rules = spark.range(100_000).select((F.lit(100_000) - F.col("id")).alias("ord"), F.concat(F.lit("T"), F.col("id"), F.lit("e")).alias("term"))
    texts = [("x t7e and t99999e",), ("T12E",), ("none",), ("",), (None,), ("x t7e and t99999e",)]
    df = spark.createDataFrame(texts, "label string")
    got = sorted(first_rule(df, "label", rules, "hit").collect(), key=str)
    want = {"x t7e and t99999e": "t99999e", "T12E": "t12e", "none": None, "": None, None: None}
    assert len(got) == 6 and all(r["hit"] == want[r["label"]] for r in got)


def test_rules_equal_brute_force(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("aBc") for _ in range(n))
    rules = [(rng.randrange(20), word(rng.randrange(5)) if i % 9 else None) for i in range(40)]
    texts = [word(rng.randrange(9)) for _ in range(80)] + [None]
    for given in (rules, [r for r in rules if r[1]], []):
        df = spark.createDataFrame(given, "ord int, term string")
        got = first_rule(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", df, "hit").collect()
        for r in got:
            hits = [(o, t.lower()) for o, t in given if t is not None and r["t"] is not None and t.lower() in r["t"].lower()]
            assert r["hit"] == (min(hits)[1] if hits else None)
        assert len(got) == len(texts)


def test_rules_of_all_kinds_in_one_join(spark, monkeypatch):
    """Substrings meet the terms in the task that cuts them; beyond the broadcast size the result is the same."""
    from tidemark.operators import rules as ru
    from tidemark.operators.manifest import tag_files_by_rules
    rules = spark.createDataFrame([("name", 2, "Occ"), ("name", 1, "cc_2"), ("title", 5, "core"), ("title", 9, None), ("ftype_req", 1, ".zip"), ("other", 0, "o")],
                                  "kind string, ord int, term string")
    files = spark.createDataFrame([("i", 1, "occ_1.zip", None), ("i", 1, "occ_1.zip", None), ("i", 2, "occ_2.zip", "a"), ("j", 3, "occ_2.csv", None),
                                   ("j", 4, "x.csv", "Dwc:Core"), ("j", 5, None, None), (None, None, "Q.ZIP", None)],
                                  "item_id string, file_pos int, name string, title string")
    want = [("x.csv", "core data"), ("Q.ZIP", None), ("occ_1.zip", "occ data"), ("occ_1.zip", "occ data"), ("occ_2.csv", None), ("occ_2.zip", "cc_2 data"), (None, None)]
    for most in (ru.BROADCAST_TERMS, 2):
        monkeypatch.setattr(ru, "BROADCAST_TERMS", most)
        tagged = tag_files_by_rules(files, rules)
        assert sorted(((r["name"], r["dftype"]) for r in tagged.collect()), key=str) == sorted(want, key=str)
        assert tagged.columns == [*files.columns, "stem", "dftype", "passes"]
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        if most > 2:  # files and their distinct texts are shuffled, no substrings
            assert not any("_term" in x and "_text_" in x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
            assert sum("Exchange hashpartitioning(_text_" in x for x in plan.splitlines()) <= 2
