"""Sources and sinks on files written to a scratch folder."""

import io
import json
import os
import random
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import structure
from tidemark.plans import fixtures as fx
from tidemark.plans.standardize import round_trip, standardize, standardize_sampled
from tidemark.sinks.writers import csv_lines, route_by_verdict, size_compare, write_csv, write_paged
from tidemark.sources.archives import bad_archives, read_zip_lines, zip_lines
from tidemark.sources.delimited import cells_table, read_parts, read_table
from tidemark.sources.lines import header_rows, read_lines
from tidemark.sources.manifest import read_manifest, read_vocab
from tidemark.streaming.incremental import incremental_run
from tests.conftest import SF_SMALL


def _scratch():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def test_read_lines_numbering_over_many_splits(spark):
    d = _scratch()
    text = "\n".join(f"row {i}," + "x" * (i % 17) for i in range(20000)) + "\n"
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = read_lines(spark, os.path.join(d, "a.csv"))
        assert lines.select("split").distinct().count() > 5
        got = {r["line_no"]: r["line"] for r in lines.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: f"row {i}," + "x" * (i % 17) for i in range(20000)}


def _text_scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan text")


def test_lines_are_counted_once_then_read_by_one_scan(spark):
    d = _scratch()
    rng = random.Random(3)
    quoted = [("\"a\"", "x,y", "'b'", "it's", "", "\"c")[rng.randrange(6)] + f",{i}" for i in range(6000)]
    plain = [f'"n{i}",{i},it\'s' for i in range(6000)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        for name, rows, scans in (("plain", plain, 1), ("quoted", quoted, 2)):
            path = os.path.join(d, name + ".csv")
            with open(path, "w") as f:
                f.write("'k',v\n" + "\n".join(rows) + "\n")
            for limit in (0, 1000):
                lines = read_lines(spark, path, broadcast_limit=limit)
                header = header_rows(lines)
                assert [r["line"] for r in header.collect()] == ["'k',v"] and _text_scans(header) == 0
                styled = structure.styled_rows(lines)
                assert _text_scans(styled) == scans
                got = {r["row_idx"]: r["quote"] for r in styled.where("line like '%\"%' or line like \"%'%\"").collect()}
                balance, want = 0, {}
                for i, row in enumerate(rows):
                    balance += row.count('"') - row.count("'")
                    if '"' in row or "'" in row:
                        want[i] = '"' if balance >= 0 else "'"
                assert got == want
                full = structure.parsed_rows(lines, full_style=True).select("row_idx", "quote").collect()
                assert len(full) == len(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_changed_splits_are_an_error(spark):
    d = _scratch()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("\n".join(f"row {i}" for i in range(5000)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = read_lines(spark, os.path.join(d, "a.csv"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        with pytest.raises(Exception, match="changed while they were read"):
            lines.select("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_read_lines_across_files_in_name_order(spark):
    d = _scratch()
    for name, rows in (("p0.txt", ["h"]), ("p1.txt", ["a", "b"]), ("p2.txt", ["c"])):
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(rows) + "\n")
    got = sorted((r["line_no"], r["line"]) for r in read_lines(spark, d, across_files=True).collect())
    assert got == [(0, "h"), (1, "a"), (2, "b"), (3, "c")]


def test_zip_scan_reads_members_and_reports_bad_archives(spark):
    d = _scratch()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("events.csv", "a,b\n1,2\n3,4\n")
        z.writestr("readme.txt", "ignore me\n")
    with open(os.path.join(d, "good.zip"), "wb") as f:
        f.write(buf.getvalue())
    with open(os.path.join(d, "bad.zip"), "wb") as f:
        f.write(b"not a zip")
    zl = read_zip_lines(spark, d)
    lines = sorted((r["line_no"], r["line"]) for r in zip_lines(zl).collect())
    assert lines == [(0, "a,b"), (1, "1,2"), (2, "3,4")]
    assert [os.path.basename(r["archive"]) for r in bad_archives(zl).collect()] == ["bad.zip"]


def test_manifest_and_vocab_scans(spark):
    d = _scratch()
    items = [{"id": "i1", "title": "T", "body": "B", "link": {"url": "u"},
              "files": [{"name": "occurrence.csv", "size": 10, "dateUploaded": "2020-01-01T00:00:00Z"},
                        {"name": "occurrence.zip", "size": 5}]},
             {"id": "i2", "title": "T2", "files": []}]
    with open(os.path.join(d, "items.json"), "w") as f:
        f.write("\n".join(json.dumps(i) for i in items))
    it, files = read_manifest(spark, os.path.join(d, "items.json"))
    assert it.count() == 2
    assert [(r["item_id"], r["file_pos"], r["name"]) for r in files.orderBy("file_pos").collect()] == \
        [("i1", 0, "occurrence.csv"), ("i1", 1, "occurrence.zip")]
    with open(os.path.join(d, "vocab.json"), "w") as f:
        json.dump({"depth": {"definition": "d", "details": "x"}, "eventDate": {"definition": "t"}}, f)
    v = read_vocab(spark, os.path.join(d, "vocab.json")).orderBy("ord").collect()
    assert [(r["term"], r["ord"], r["attrs"]["definition"]) for r in v] == [("depth", 0, "d"), ("eventDate", 1, "t")]


def test_round_trip_is_lossless(spark):
    r = round_trip(fx.orders_source(spark, SF_SMALL))
    e = {x["measure"]: x["count"] for x in r.entries().collect()}
    assert e["non-matching of shared entries"] == 0
    assert e["shared (common) entries"] == e["total source entries"]


def test_csv_quoting_styles(spark):
    df = spark.createDataFrame([(1, "a,b", 'say "hi"', 2.5)], "k int, s string, q string, x double")
    rows = lambda style: [r["line"] for r in csv_lines(df, style).collect()]
    assert rows("minimal") == ["k,s,q,x", '1,"a,b","say ""hi""",2.5']
    assert rows("all") == ["k,s,q,x", '"1","a,b","say ""hi""","2.5"']
    assert rows("nonnumeric") == ["k,s,q,x", '1,"a,b","say ""hi""",2.5']


def test_standardize_types_and_qc(spark):
    s = standardize(fx.part_lines(spark, SF_SMALL))
    # row 0 opens an unbalanced quote, so its first delimiter is not live
    # and the key cell holds text: the key column stays text (S2, kept)
    assert s.types["p_partkey"] == "text"
    assert s.types["p_retailprice"] == "float"
    dt = dict(s.table.dtypes)
    assert dt["p_retailprice"] == "double" and dt["p_partkey"] == "string"
    codes = {r["code"] for r in s.qc.collect()}
    assert codes == {"row_width"}  # every 101st row lacks a cell


def test_sampled_path_drops_empty_columns(spark):
    typed, types = standardize_sampled(fx.customer_text(spark, SF_SMALL).drop("file"))
    assert "c_notes" not in typed.columns
    assert types["c_custkey"] == "Integer"


def test_paged_write_and_size_compare(spark):
    d = _scratch()
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("row_idx", F.col("o_orderkey"))
    write_paged(o, os.path.join(d, "paged"), 400)
    parts = sorted(r["part"] for r in spark.read.parquet(os.path.join(d, "paged")).select("part").distinct().collect())
    assert parts == [1, 2, 3, 4]
    write_csv(o, os.path.join(d, "a"))
    write_csv(o, os.path.join(d, "b"))
    r = size_compare(spark, os.path.join(d, "a"), os.path.join(d, "b")).first()
    assert r["equal"] and r["percent_difference"] == 0.0


def test_route_by_verdict(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, v int")
    qc = spark.createDataFrame([("b", "CRITICAL")], "dataset string, severity string")
    good, bad = route_by_verdict(df, qc)
    assert [r["dataset"] for r in good.collect()] == ["a"]
    assert [r["dataset"] for r in bad.collect()] == ["b"]


def test_read_table_and_parts(spark):
    d = _scratch()
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("a;b\n1;x\n2;y\n")
    t = read_table(spark, os.path.join(d, "t.csv"), "a int, b string", delim=";")
    assert [tuple(r) for r in t.orderBy("a").collect()] == [(1, "x"), (2, "y")]
    p1, p2 = os.path.join(d, "p1"), os.path.join(d, "p2")
    spark.createDataFrame([(1,)], "a int").write.parquet(p1)
    spark.createDataFrame([(2, "z")], "a int, c string").write.parquet(p2)
    u = read_parts(spark, [p1, p2])
    assert sorted(tuple(r) for r in u.collect()) == [(1, None), (2, "z")]


def test_incremental_run_skips_seen_files(spark):
    d, ck = _scratch(), _scratch()
    seen = []

    def process(batch, batch_id):
        seen.extend(r["value"] for r in batch.select("value").collect())

    with open(os.path.join(d, "1.txt"), "w") as f:
        f.write("a\n")
    incremental_run(spark, d, ck, process)
    with open(os.path.join(d, "2.txt"), "w") as f:
        f.write("b\n")
    incremental_run(spark, d, ck, process)
    assert seen == ["a", "b"]


def test_dataset_attributes_report_and_catalog_sinks(spark):
    from tidemark.operators.catalog import build_catalog, catalog_variables, write_catalog
    from tidemark.sinks.writers import write_dataset, write_report
    d = _scratch()
    df = spark.createDataFrame([(1.0, "a")], "depth double, name string")
    write_dataset(df, os.path.join(d, "ds"), {"depth": {"units": "m", "positive": "down"}}, {"title": "T"})
    back = spark.read.parquet(os.path.join(d, "ds", "data"))
    assert back.schema["depth"].metadata == {"units": "m", "positive": "down"}
    attrs = json.loads(spark.read.json(os.path.join(d, "ds", "_attributes")).first()["attributes"])
    assert attrs == {"title": "T"}
    write_report(df, os.path.join(d, "report"))
    assert spark.read.json(os.path.join(d, "report")).count() == 1
    vars_ = spark.createDataFrame([("x", 0, "depth", "f8"), ("x", 1, "altitude", "f8")],
                                  "dataset string, pos long, name string, dtype string")
    cat = build_catalog(spark.createDataFrame([("x", "T")], "dataset string, title string"),
                        catalog_variables(vars_))
    write_catalog(cat, os.path.join(d, "catalog.xml"), fmt="xml")
    text = "".join(r["value"] for r in spark.read.text(os.path.join(d, "catalog.xml")).collect())
    assert "<dataset>" in text and "source_altitude" in text


def test_header_offset_guess(spark):
    rows = [("f", 0, "exported by tool"), ("f", 1, ""), ("f", 2, "a,b,c"), ("f", 3, "1,2,3"), ("f", 4, "4,,6"),
            ("g", 0, "x|y"), ("g", 1, "1|2")]
    from tidemark.sources.delimited import guess_header_offset
    lines = spark.createDataFrame(rows, "file string, line_no long, line string")
    got = {r["file"]: (r["header_line"], r["n_cells"]) for r in guess_header_offset(lines).collect()}
    assert got == {"f": (2, 3), "g": (0, 2)}


def test_compare_files_end_to_end(spark):
    from tidemark.plans.standardize import compare_files
    d = _scratch()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write('id,name,value\n1,"x, y",1.0\n2,b,2\n3,c,NA\n')
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write('id,name,value,extra\n1,"x, y",1,e\n2,b,2.5,e\n')
    r, sizes = compare_files(spark, os.path.join(d, "a.csv"), os.path.join(d, "b.csv"),
                             postfilter=True, equivalence=True)
    e = {x["measure"]: x["count"] for x in r.entries().collect()}
    assert e["total source entries"] == 9 and e["shared (common) entries"] == 6
    assert e["non-matching of shared entries"] == 2 and e["extra entries"] == 2
    disc = {x["stage"]: x["count"] for x in r.discrepancies().collect()}
    assert disc == {"non-matching": 2, "filtering": 2, "filtering + equivalence": 1}
    errs = [(x["row_idx"], x["column"], x["original"], x["reproduced"]) for x in r.errors().collect()]
    assert errs == [(1, "value", "2", "2.5")]
    assert sizes.first()["equal"] is False


def test_standardize_to_routes_failed_runs(spark):
    from tidemark.plans.standardize import standardize_to
    d = _scratch()
    std = standardize_to(fx.part_lines(spark, SF_SMALL), os.path.join(d, "out"), "part",
                         {"title": "parts"}, quarantine=os.path.join(d, "bad"))
    assert os.path.isdir(os.path.join(d, "bad", "part", "data"))   # width errors are CRITICAL
    assert not os.path.isdir(os.path.join(d, "out", "part"))
    back = spark.read.parquet(os.path.join(d, "bad", "part", "data"))
    assert back.count() == 200 and back.schema["p_retailprice"].metadata["units"] == "unspecified"
    assert spark.read.json(os.path.join(d, "out", "_qc")).count() == std.qc.count()


def test_profile_state_equals_the_whole_for_any_split(spark):
    from tidemark.operators.profile import families, profile
    from tidemark.streaming.incremental import fold_counters
    rows = [(str(i), None if i < 40 else str(i), "1.5" if i == 7 else "9999999999", "True" if i % 2 else None, None, str(i * 10 ** 9)) for i in range(60)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    want = {tuple(r) for r in profile(df).drop("chunk").collect()}
    for cuts in ([60], [10, 50], [1, 7, 8, 40, 60], list(range(5, 65, 5))):
        d, start = _scratch(), 0
        for k, end in enumerate([*cuts, 60] if cuts[-1] != 60 else cuts):
            for _ in range(2 if k == 1 else 1):  # a batch that is run again
                fold_counters(spark, d, spark.createDataFrame(rows[start:end], df.schema), k)
            start = end
        kept = sorted(x for x in os.listdir(d) if x.startswith("batch="))
        assert len(kept) <= 2
        assert {tuple(r) for r in families(spark.read.parquet(os.path.join(d, kept[-1] if len(kept) == 1 else f"batch={k}"))).collect()} == want


def test_empty_chunks_say_nothing(spark):
    from tidemark.operators.profile import profile, reconcile_types
    df = spark.createDataFrame([(i, str(i) if i < 10 else None, None, None if i < 10 else "True") for i in range(20)],
                               "i long, n string, none string, b string")
    prof = profile(df, ["n", "none", "b"], chunk=F.floor(F.col("i") / 10).cast("long"))
    assert {(r["chunk"], r["column"]): r["family"] for r in prof.collect()} == {
        (0, "n"): "int", (1, "n"): "empty", (0, "none"): "empty", (1, "none"): "empty", (0, "b"): "empty", (1, "b"): "bool"}
    got = {r["column"]: (r["family"], r["chunks_disagree"]) for r in reconcile_types(prof).collect()}
    assert got == {"n": ("int", False), "none": ("object", False), "b": ("bool", False)}


def test_sync_of_changed_sources(spark):
    from tidemark.streaming.incremental import sync_sources
    src, out, state = _scratch(), os.path.join(_scratch(), "out"), os.path.join(_scratch(), "state")

    def put(name, *lines):
        os.makedirs(os.path.dirname(os.path.join(src, name)), exist_ok=True)
        with open(os.path.join(src, name), "w") as f:
            f.write("".join(x + "\n" for x in lines))

    def run():
        done = sync_sources(spark, src, out, state, lambda d: d.where("value <> 'skip'"), fmt="text")
        return ({r["source"]: r["action"] for r in done.collect()},
                {(r["source"], r["value"]) for r in spark.read.parquet(out).collect()})

    put("a b+c.txt", "1", "2")
    put("sub/x.txt", "3")
    put("y%20.txt", "4")
    assert run() == ({"a b+c.txt": "new", "sub/x.txt": "new", "y%20.txt": "new"}, {("a b+c.txt", "1"), ("a b+c.txt", "2"), ("sub/x.txt", "3"), ("y%20.txt", "4")})
    assert set(run()[0].values()) == {"same"}
    put("a b+c.txt", "skip")       # changed, and without rows now
    put("sub/x.txt", "3", "33")
    os.remove(os.path.join(src, "y%20.txt"))
    assert run() == ({"a b+c.txt": "changed", "sub/x.txt": "changed", "y%20.txt": "vanished"}, {("sub/x.txt", "3"), ("sub/x.txt", "33")})
    assert run()[0] == {"a b+c.txt": "same", "sub/x.txt": "same"}

    def broken(d):
        raise RuntimeError("stopped")

    put("z.txt", "5")
    import pytest
    with pytest.raises(RuntimeError):
        sync_sources(spark, src, out, state, broken, fmt="text")
    assert run()[0]["z.txt"] == "new"  # done again by the next run


def test_quoted_line_breaks_are_read_by_many_tasks(spark):
    import random

    from tidemark.sources.quoted import quoted_records, read_quoted
    rng = random.Random(2)
    d, words = _scratch(), ["plain", '5" pipe', "", "a,b", 'say ""', "two\nlines", "\n", "\r\nx", 'q"\n"', "é\n\n\n日", "long " * 40, '"', '","']

    def cell(text):
        if rng.random() < 0.1 and "\n" not in text and "," not in text and not text.startswith('"'):
            return text  # unquoted, a quote inside is text
        return '"' + text.replace('"', '""') + '"'

    for name, rows, end in (("a.csv", 3000, "\n"), ("b.csv", 500, "\r\n"), ("c.csv", 1, "\n")):
        with open(os.path.join(d, name), "w", newline="") as f:
            f.write("k,t,n,bad" + end)
            for i in range(rows):
                f.write(f"{i},{cell(rng.choice(words))},{rng.choice(['1.5', 'none', ''])}{end}")
                if i % 97 == 0:
                    f.write(end)
    with open(os.path.join(d, "d.csv"), "w") as f:  # one cell over many splits, never closed
        f.write("k,t,n,bad\n1,\"" + "line of a long cell\n" * 3000 + "end")
    schema = "k int, t string, n double, bad string"
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert quoted_records(spark, d).select("file", "split").distinct().count() > 20
        got = sorted(map(repr, read_quoted(spark, d, schema, bad_record="bad").drop("bad").collect()))
        text = spark.read.schema(schema).csv(d, header=True, multiLine=True, escape='"', columnNameOfCorruptRecord="bad")
        assert got == sorted(map(repr, text.drop("bad").collect())) and len(got) == 3502
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_state_behind_a_line():
    from tidemark.sources.quoted import inside_after
    for line, open_ in {'a,"b': True, '5" x,y': False, '"a""': True, '"a"": (b': True, "": False, 'a"b"c"': False, '"a"b,"': True}.items():
        assert inside_after(line, False, ",", '"') == open_, line
    assert inside_after("x", True, ",", '"') and not inside_after('x"', True, ",", '"') and inside_after('x"",', True, ",", '"')
    assert inside_after('x","', True, ",", '"') and not inside_after('""', False, ",", '"') and inside_after('"""', False, ",", '"')


def test_large_archives_are_error_rows(spark):
    d = _scratch()
    for name, n in (("small.zip", 10), ("large.zip", 50_000)):
        with zipfile.ZipFile(os.path.join(d, name), "w") as z:
            z.writestr("a.csv", "\n".join(str(i * 7919) for i in range(n)))
    got = read_zip_lines(spark, d, max_bytes=10_000)
    assert got.where("error is null").count() == 10
    bad = bad_archives(got).collect()
    assert len(bad) == 1 and bad[0]["archive"].endswith("large.zip") and bad[0]["error"].startswith("TooLarge")
    plan = got.where("error is not null")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(length" in plan and "LessThanOrEqual(length" in plan  # both reach the source
    assert read_zip_lines(spark, d).count() == 50_010


def test_records_with_line_breaks_are_handed_back_in_bounded_batches(monkeypatch):
    import pyarrow as pa

    from tidemark.sources import quoted
    lines = [x for i in range(200) for x in (f'{i},"' + "x" * 300, "y" * 300, 'z"')]
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * len(lines)), pa.array([0] * len(lines)), pa.array(lines), pa.array([False] * len(lines))],
                                       ["file", "split", "line", "inside"])
    monkeypatch.setattr(quoted, "BATCH_CHARS", 2_000)
    got = list(quoted.cut_records(iter([batch]), ",", '"'))
    assert max(sum(len(r) for r in b.column(4).to_pylist()) for b in got) < 4_000
    assert [r for b in got for r in b.column(4).to_pylist()] == ["\n".join(lines[i:i + 3]) for i in range(0, len(lines), 3)]
    assert [p for b in got for p in b.column(2).to_pylist()] == list(range(200))


def test_term_rows_are_handed_back_in_bounded_batches(monkeypatch):
    import pyarrow as pa

    from tidemark.sources import html_terms
    page = "<table>" + "".join(f'<tr><td><a name="t{i}">Term Name: dwc:t{i}</a></td></tr><tr><td>Definition:</td><td>d{i}</td></tr>' for i in range(50)) + "</table>"
    batch = pa.RecordBatch.from_arrays([pa.array([*range(99), None]), pa.array([page] * 98 + [None, page])], ["page_id", "html"])
    monkeypatch.setattr(html_terms, "ROWS_AT_ONCE", 120)
    got = list(html_terms.term_rows(iter([batch])))
    assert max(b.num_rows for b in got) <= 170
    rows = [tuple(r.values()) for b in got for r in b.to_pylist()]
    assert rows == [(p, i, 0, f"t{i}", "definition", f"d{i} ") for p in [*range(98), None] for i in range(50)]
