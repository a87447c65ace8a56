"""Registered queries of sources, sinks and rules that need files: each
writes files made from the given tables into the shared checkpoint folder
and reads them back through the operator under test."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import file_ext, file_stem, part_base
from tidemark.operators import catalog as ct
from tidemark.operators import coerce as co
from tidemark.operators import manifest as mf
from tidemark.operators import metadata as md
from tidemark.operators import profile as pr
from tidemark.operators import vocab as vc
from tidemark.operators.compare import reconcile
from tidemark.plans import fixtures as fx
from tidemark.plans import standardize as sd
from tidemark.session import checkpoint_dir, table
from tidemark.sinks import writers as wr
from tidemark.sources import archives, delimited, manifest
from tidemark.sources.html_terms import extract_terms
from tidemark.sources.lines import data_rows, read_lines, sniff_header
from tidemark.sources.quoted import read_quoted
from tidemark.streaming.incremental import incremental_profile, incremental_run, sync_sources

GAP_ORDERS = 1000  # orders of a block without values


def _folder(spark: SparkSession, name: str) -> str:
    return posixpath.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def typed_scan(spark, sf_dir):
    """SRC-4: customers as CSV with quotes and line breaks in the names,
    every 50th balance no number; records that do not fit are kept apart."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 10 == 0, F.concat("c_name", F.lit(' "the first"\n, '), "c_mktsegment")).otherwise(F.col("c_name"))
    balance = F.when(k % 50 == 0, F.lit("none")).otherwise(fx.money(F.col("c_acctbal")))
    path = _folder(spark, "typed")
    c.select(k, name.alias("c_name"), balance.alias("c_acctbal")).write.option("header", True).option("escape", '"').csv(path)
    got = delimited.read_table(spark, path, "c_custkey bigint, c_name string, c_acctbal double, bad string",
                               multi_line=True, bad_record="bad")
    return got.select("c_custkey", "c_name", "c_acctbal", F.col("bad").isNotNull().alias("is_bad"))


def zip_scan(spark, sf_dir):
    """SRC-6: archives of 100 parts each (one wanted and one other member),
    every 7th archive cut short."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    pages = p.groupBy(F.floor(k / 100).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(k.alias("k"), F.concat_ws(",", k.cast("string"), "p_name").alias("line")))).alias("rows"))
    text = F.concat(F.array_join(F.transform("rows", lambda r: r["line"]), "\r\n"), F.lit("\r\n"))
    packed = archives.pack_zip(pages.select(
        F.concat(F.lit("parts_"), F.col("page").cast("string"), F.lit(".zip")).alias("path"), text.alias("text")), "part.csv")
    cut = F.regexp_extract("path", r"(\d+)", 1).cast("int") % 7 == 3
    content = F.when(cut, F.substring("content", 1, 40)).otherwise(F.col("content"))
    lines = archives.archive_lines(packed.select("path", content.alias("content")), (".csv",))
    return lines.select("archive", "file", "line_no", "line", F.col("error").isNotNull().alias("is_bad"))


def manifest_scan(spark, sf_dir):
    """SRC-7: items with nested files as JSON lines, and as single documents."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    files = F.transform(F.sequence(F.lit(0), (k % 3).cast("int")), lambda i: F.struct(
        F.concat(F.lit("f"), i.cast("string"), F.lit(".csv")).alias("name"), F.lit("t").alias("title"),
        F.lit("u").alias("url"), (k * 10 + i).alias("size"), F.lit("2020-01-01T00:00:00Z").alias("dateUploaded")))
    item = F.struct(k.cast("string").alias("id"), F.concat(F.lit("title "), k.cast("string")).alias("title"),
                    F.lit("body").alias("body"), F.lit("c").alias("citation"), F.struct(F.lit("u").alias("url")).alias("link"),
                    F.when(k % 4 != 3, files).alias("files"))
    path = _folder(spark, "manifest")
    o.select(F.to_json(item).alias("value")).write.text(path)
    items, listed = manifest.read_manifest(spark, path)
    return items.select("id", "title", "link_url").join(
        listed.select(F.col("item_id").alias("id"), "file_pos", "name", "size"), "id", "left")


def vocab_scan(spark, sf_dir):
    """SRC-8: one vocabulary document per 100 parts."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    entry = F.struct(k.alias("k"), F.concat(F.lit("term"), k.cast("string")).alias("t"),
                     F.create_map(F.lit("definition"), F.col("p_name"), F.lit("type"), F.col("p_type")).alias("m"))
    docs = p.groupBy(F.floor(k / 100).alias("page")).agg(F.array_sort(F.collect_list(
        F.struct(entry["k"], entry["t"], F.map_entries(entry["m"]).alias("m")))).alias("e"))
    as_map = F.map_from_entries(F.transform("e", lambda x: F.struct(x["t"], F.map_from_entries(x["m"]))))
    path = _folder(spark, "vocabulary")
    docs.select("page", F.to_json(as_map).alias("value")).repartition("page").write.partitionBy("page").text(path)
    v = manifest.read_vocab(spark, path)
    return v.select("term", "ord", F.try_element_at("attrs", F.lit("definition")).alias("definition"),
                    F.try_element_at("attrs", F.lit("type")).alias("type"))


def part_concat(spark, sf_dir):
    """SRC-10, SET-2, UDF-1: three parts of one table, one without a column,
    each transformed while it is read."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    base = _folder(spark, "parts")
    for i in range(3):
        part = o.where(F.col("o_orderkey") % 3 == i)
        (part.drop("o_orderpriority") if i == 2 else part).write.parquet(f"{base}/{i}")
    return delimited.read_parts(spark, [f"{base}/{i}" for i in range(3)],
                                transform=lambda d: d.withColumn("o_orderstatus", F.lower("o_orderstatus")))


def dataset_attributes(spark, sf_dir):
    """SNK-1: rows, column attributes and global attributes of a written dataset."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = _folder(spark, "dataset")
    wr.write_dataset(o, path, {"o_totalprice": {"units": "currency"}}, {"title": "Orders"})
    got = spark.read.parquet(f"{path}/data")
    units = got.schema["o_totalprice"].metadata.get("units")
    title = spark.read.json(f"{path}/_attributes").select(F.get_json_object("attributes", "$.title")).first()[0]
    return got.withColumn("title", F.lit(title)).withColumn("units", F.lit(units))


def paged_files(spark, sf_dir):
    """SNK-2: every page is one file, with its rows."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_idx"), "o_totalprice")
    path = _folder(spark, "pages")
    wr.write_paged(o, path, 1000)
    got = spark.read.parquet(path).select("part", "row_idx", F.col("_metadata.file_path").alias("f"))
    return got.groupBy("part").agg(F.count("*").alias("n_rows"), F.count_distinct("f").alias("n_files"),
                                   F.min("row_idx").alias("first_row"), F.max("row_idx").alias("last_row"))


def named_pages(spark, sf_dir):
    """SNK-2: written page names, with one page and with several."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_idx"), "o_totalprice")
    path = _folder(spark, "named")
    wr.write_named_pages(o, f"{path}/many", "orders", 1000)
    wr.write_named_pages(o.where("row_idx < 1000"), f"{path}/one", "orders", 1000)
    wr.write_named_pages(o, f"{path}/whole", "orders", None)
    sets = [spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("run"), "dataset", "row_idx") for name in ("many", "one", "whole")]
    return sets[0].union(sets[1]).union(sets[2]).groupBy("run", "dataset").agg(
        F.count("*").alias("n_rows"), F.min("row_idx").alias("first_row"), F.max("row_idx").alias("last_row"))


def round_precision_max(spark, sf_dir):
    """COE-2: positions rounded to the most decimals of their column."""
    df = fx.customer_text(spark, sf_dir)
    cols = ["decimalLatitude", "decimalLongitude"]
    return co.coerce_position(df, cols, "max").select("row_idx", *cols)


def match_report(spark, sf_dir):
    """SNK-4: the match counts per dataset, written as a report and reread."""
    from tidemark.plans.queries import match_counts
    path = _folder(spark, "report")
    wr.write_report(match_counts(spark, sf_dir), path)
    return spark.read.schema("dataset string, " + ", ".join(f"{k} bigint" for k in vc.KINDS)).json(path)


def quarantine(spark, sf_dir):
    """SNK-6: customers of a nation are a dataset; every 5th nation has a CRITICAL message."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("dataset"), "c_custkey")
    qc = c.select("dataset", F.when(F.col("dataset") % 5 == 0, F.lit("CRITICAL")).otherwise("INFO").alias("severity")).distinct()
    good, bad = wr.route_by_verdict(c, qc)
    return good.withColumn("route", F.lit("good")).unionByName(bad.withColumn("route", F.lit("bad")))


def absent_filled(spark, sf_dir):
    """PRJ-5, COE-4: empty text cells filled, identifier-like numbers as text."""
    li = table(spark, sf_dir, "lineitem")
    half = F.col("l_linenumber") / 2.0
    t = li.select("l_orderkey", "l_partkey", "l_linenumber",
                  F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
                  co.force_string(half, "double").alias("half_id"), co.force_string("l_suppkey").alias("supp_id"))
    return co.fill_absent(t)


def sampled_limit(spark, sf_dir):
    """PIPE-2, LIM-1, COE-7: the first 1000 parts, altitude and depth are decimals whatever they look like."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cells = p.select(k.alias("row_idx"), F.col("p_size").cast("string").alias("altitude"),
                     F.when(k % 9 == 0, F.lit("deep")).otherwise((k % 50).cast("string")).alias("depth"),
                     F.concat("p_name", F.lit(" é")).alias("note"), F.lit("").alias("empty"))
    return sd.standardize_sampled(cells, sample_size=1000, ascii_only=True)[0]


def _late_cells(spark, sf_dir):
    """Cells that change after the first 500 rows: text, long and longer integers."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    late = k >= 500
    number = (F.when(late & (k % 100 == 0), F.lit("abc")).when(late & (k % 100 == 1), F.lit("3000000000"))
              .when(late & (k % 100 == 2), F.lit("99999999999999999999")).when(k % 100 == 3, F.lit(""))
              .otherwise((k % 1000).cast("string")))
    return o.select(k.alias("row_idx"), number.alias("number"), F.col("o_orderstatus").alias("status"))


def sampled_late_cells(spark, sf_dir):
    return sd.standardize_sampled(_late_cells(spark, sf_dir))[0]


def sampled_losses(spark, sf_dir):
    return sd.sampled_losses(_late_cells(spark, sf_dir))


def file_names(spark, sf_dir):
    """FN-8, SET-4: stem, extension and dataset of paged file names."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("/data/set"), (k % 97).cast("string"), F.when(k % 2 == 0, F.concat(F.lit("_part"), (k % 13).cast("string")))
                    .otherwise(F.lit("")), F.lit(".CSV"))
    n = o.select(k, name.alias("name")).withColumn("stem", file_stem("name")).withColumn("ext", file_ext("name"))
    return n.select("o_orderkey", "stem", "ext", part_base("stem").alias("base"),
                    ct.dataset_of_file("stem").alias("dataset"), ct.dataset_of_file("stem", virtual=False).alias("own_dataset"))


def catalog_parts(spark, sf_dir):
    """CAT-1: three paged files of a dataset are one catalogue entry."""
    v = fx.dataset_vars(spark, sf_dir)
    n = F.regexp_extract("dataset", r"(\d+)", 1).cast("long")
    paged = v.withColumn("dataset", F.concat(F.lit("set_"), F.floor(n / 3).cast("string"), F.lit("_part"), (n % 3 + 1).cast("string")))
    return ct.catalog_variables(ct.group_parts(paged)).select("dataset", "pos", "name", "dtype", "destination")


def time_axis_units(spark, sf_dir):
    """FN-12: the units of a time axis follow its conversion mode."""
    specs = {**co.AXIS_SPECS, "eventDate": {"destinationName": "time", "units": "UTC"}}
    m = md.variable_metadata(fx.dataset_vars(spark, sf_dir), specs=specs, time_mode="integer")
    return m.select("dataset", "pos", "name", "units")


def catalog_attributes(spark, sf_dir):
    """CAT-1: standard names of location variables, attributes of the others."""
    v = fx.dataset_vars(spark, sf_dir)
    attrs = md.variable_metadata(v).select("dataset", "name", F.create_map(F.lit("units"), F.coalesce("units", F.lit("none"))).alias("attrs"))
    cat = ct.build_catalog(v.select("dataset").distinct(), ct.catalog_variables(v).join(attrs, ["dataset", "name"]))
    return cat.select("dataset", F.explode("variables").alias("v")).select(
        "dataset", "v.name", "v.standard_name", F.try_element_at("v.attrs", F.lit(1))["value"].alias("units"))


def incremental_skip(spark, sf_dir):
    """STR-1: two runs over a growing folder; the second sees only the new files."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    base = _folder(spark, "incremental")
    for run in range(2):
        o.where(F.col("o_orderkey") % 2 == run).write.mode("append").parquet(f"{base}/in")

        def store(batch: DataFrame, batch_id: int, run=run):
            batch.drop("source_file").withColumn("run", F.lit(run)).write.mode("overwrite").parquet(f"{base}/out/b{run}_{batch_id}")

        incremental_run(spark, f"{base}/in", f"{base}/state", store, fmt="parquet", schema=o.schema)
    return spark.read.parquet(f"{base}/out/*").groupBy("run", "o_orderstatus").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


def chained(spark, sf_dir):
    """UDF-3: an ordered chain of table functions."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return sd.apply_chain(o, [lambda d: d.where(F.col("o_orderkey") % 3 != 0),
                              lambda d: d.withColumn("o_orderstatus", F.lower("o_orderstatus")),
                              lambda d: d.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))])


def _lineitem_sides(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    flag = F.when(F.col("l_orderkey") % 31 == 0, F.lit(None)).otherwise(F.col("l_returnflag"))
    left = li.select("l_orderkey", "l_linenumber", qty.alias("l_quantity"), flag.alias("l_returnflag"))
    other = F.when(F.col("l_orderkey") % 29 == 0, F.lit("0")).otherwise(qty)
    blank = F.when(F.col("l_orderkey") % 31 == 0, F.lit("")).otherwise(F.col("l_returnflag"))
    return left, li.select("l_orderkey", "l_linenumber", other.alias("l_quantity"), blank.alias("l_returnflag"))


def reconcile_repeated_keys(spark, sf_dir):
    """PIPE-3 on a table whose key repeats: repeated keys are not paired."""
    return reconcile(*_lineitem_sides(spark, sf_dir), on=["l_orderkey", "l_linenumber"]).by_column()


def repeated_key_messages(spark, sf_dir):
    return reconcile(*_lineitem_sides(spark, sf_dir), on=["l_orderkey", "l_linenumber"]).messages()


def _event_sides(spark, sf_dir):
    """Events keyed so that a third of all rows of both sides share one key and a seventh of another third has none."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    key = F.when(n % 3 == 0, F.lit(-1)).when((n % 3 == 1) & (n % 7 == 0), F.lit(None)).otherwise(n)
    left = e.select(key.alias("k"), "event_type", F.col("user_id").cast("string").alias("u"))
    return left, e.select(key.alias("k"), "event_type", F.when(n % 11 == 0, F.lit("0x")).otherwise(F.col("user_id").cast("string")).alias("u"))


def reconcile_hot_key(spark, sf_dir):
    """JOIN-1 with one key that holds a third of all rows, and rows without a key."""
    r = reconcile(*_event_sides(spark, sf_dir), on="k")
    rows = r.counts().select(F.lit("(repeated)").alias("column"), F.col("repeated").alias("shared"), F.lit(0).cast("long").alias("raw_mismatch"))
    return r.by_column().select("column", "shared", "raw_mismatch").unionByName(rows)


def reconcile_reports(spark, sf_dir):
    """AGG-5 to AGG-8: every summary of one reconciliation, from one join."""
    r = reconcile(fx.orders_source(spark, sf_dir), fx.orders_revised(spark, sf_dir), on="row_idx", postfilter=True, equivalence=True)

    def rows(report: str, df: DataFrame, name: str, n: str) -> DataFrame:
        return df.select(F.lit(report).alias("report"), F.col(name).alias("name"), F.col(n).cast("long").alias("n"))

    return (rows("dims", r.dims(), "side", "rows").unionByName(rows("entries", r.entries(), "measure", "count"))
            .unionByName(rows("discrepancies", r.discrepancies(), "stage", "count"))
            .unionByName(rows("columns", r.by_column(), "column", "equivalent_mismatch"))
            .unionByName(r.messages().select(F.lit("messages").alias("report"), F.col("code").alias("name"), F.lit(None).cast("long").alias("n"))))


def _gappy_lineitem(spark, sf_dir):
    """lineitem as text, with three columns empty in every second block of orders; ``half`` tells which."""
    li = fx.lineitem_text(spark, sf_dir)
    half = F.floor(F.col("l_orderkey").cast("long") / GAP_ORDERS) % 2
    gone = ("l_linenumber", "l_discount", "l_isreturn")
    return li.select(*[F.when(half == 0, F.col(c)).alias(c) if c in gone else F.col(c) for c in li.columns], half.alias("half"))


def type_reconcile_gaps(spark, sf_dir):
    """PRF-1/PRF-2: chunks in which a column has no value say nothing about its type."""
    li = _gappy_lineitem(spark, sf_dir).drop("half")
    prof = pr.profile(li, chunk=F.floor(F.col("l_orderkey").cast("long") / GAP_ORDERS).cast("long"))
    return pr.reconcile_types(prof).select("column", "pos", "family", "max_len", "max_int", "non_null", "chunks_disagree")


def incremental_profile_gaps(spark, sf_dir):
    """STR-2: a micro-batch in which three columns have no value at all."""
    base = _folder(spark, "gaps")
    li = _gappy_lineitem(spark, sf_dir)
    for half in (0, 1):  # the files of a half are one micro-batch
        li.where(F.col("half") == half).drop("half").repartition(8).write.mode("append").parquet(f"{base}/source")
    prof = incremental_profile(spark, f"{base}/source", f"{base}/state", f"{base}/checkpoint", li.drop("half").schema,
                               max_files_per_trigger=8)
    return prof.select("column", "pos", "family", "max_len", "max_int", "non_null")


def quoted_scan(spark, sf_dir):
    """SRC-4: documents with quotes, delimiters and line breaks in their cells, read split by split."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    text = F.concat(F.when(k % 3 == 0, F.lit('"')).otherwise(F.lit("'")), F.col("text"), F.when(k % 5 == 0, F.lit('","\n')).otherwise(F.lit("\n\n.")))
    path = _folder(spark, "quoted")
    (d.select(k, text.alias("text"), "lang").write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    got = read_quoted(spark, path, "doc_id bigint, text string, lang string")
    return got.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "lang")


def changed_sources(spark, sf_dir):
    """STR-1: of eight sources one changes, one vanishes and one is new before
    the second run; a third run finds nothing to do."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 9).alias("part"))
    base, spark_path = _folder(spark, "sources"), spark._jvm.org.apache.hadoop.fs.Path
    fs = spark_path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def put(rows: DataFrame, run: int, name: str) -> None:  # one file with a name that stays
        made = f"{base}/made/{run}-{name}"
        rows.coalesce(1).write.csv(made)
        file = next(f.getPath() for f in fs.listStatus(spark_path(made)) if f.getPath().getName().startswith("part-"))
        fs.mkdirs(spark_path(f"{base}/in"))
        fs.delete(spark_path(f"{base}/in/{name}.csv"), False)
        fs.rename(file, spark_path(f"{base}/in/{name}.csv"))

    def sync(run: int) -> DataFrame:
        done = sync_sources(spark, f"{base}/in", f"{base}/out", f"{base}/state", lambda d: d.withColumn("run", F.lit(run)), fmt="csv", schema="o_orderkey long, o_orderstatus string, part long")
        return done.select("source", F.lit(run).alias("run"), "action")

    for k in range(8):
        put(o.where(F.col("part") == k), 1, f"part {k}")
    first = sync(1)
    put(o.where((F.col("part") == 2) & (F.col("o_orderkey") % 2 == 0)).withColumn("o_orderstatus", F.lit("Z")), 2, "part 2")
    put(o.where(F.col("part") == 8), 2, "part 8")
    fs.delete(spark_path(f"{base}/in/part 5.csv"), False)
    actions = first.unionByName(sync(2)).unionByName(sync(3))
    rows = spark.read.parquet(f"{base}/out").groupBy("source").agg(
        F.count("*").alias("n"), F.max("run").alias("written_in"), F.max("o_orderstatus").alias("last_status"), F.max("o_orderkey").alias("last_key"))
    return actions.join(rows, "source", "left").select("source", "run", "action", "n", "written_in", "last_status", "last_key")


def _special_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    word = F.try_element_at(F.split("p_name", " "), F.lit(1))
    name = (F.when(k % 4 == 0, F.repeat(F.lit("*"), (k % 5 + 1).cast("int")))
            .when(k % 4 == 1, F.concat(F.lit("_"), F.substring("p_name", 1, 1), F.lit("_"), F.substring("p_name", 2, 1)))
            .when(k % 4 == 2, F.concat(word, F.lit("-"))).otherwise(F.concat(F.lit("q7"), k.cast("string"))))
    vocab = vc.vocab_from_attrs(extract_terms(fx.term_pages(spark, sf_dir)))
    return p.select(name.alias("name")), vocab, vc.triple_pattern(fx.graph_triples(spark, sf_dir), require_predicate_label=True)


def match_special_names(spark, sf_dir):
    """JOIN-6: names of special characters, short tokens and plain words."""
    return vc.match_names(*_special_names(spark, sf_dir)).select("name", "kind", "term", "hits", "stage")


def match_limited(spark, sf_dir):
    """JOIN-6/WIN-6: lists of three candidates at most, hits as numbers."""
    names, vocab, candidates = _special_names(spark, sf_dir)
    short = table(spark, sf_dir, "part").select(F.lower(F.substring("p_name", 1, 2)).alias("name")).union(
        table(spark, sf_dir, "part").select(F.substring("p_name", 1, 1).alias("name")))
    return vc.match_names(names.union(short), vocab, candidates, max_candidates=3).select(
        "name", "kind", "term", "hits", "stage", F.array_join("candidates", "|").alias("candidates"))


def revised_vocabulary(spark, sf_dir):
    """SNK-4: the vocabulary after matching, written as a report and reread."""
    from tidemark.plans.queries import _candidates, _local_vocab, _matches
    revised = vc.revised_vocabulary(_matches(spark, sf_dir), _local_vocab(spark, sf_dir), _candidates(spark, sf_dir))
    path = _folder(spark, "vocabulary")
    wr.write_report(revised.select("term", "source", F.posexplode("attrs").alias("apos", "attr", "value")), path)
    return spark.read.schema("term string, source string, apos int, attr string, value string").json(path)


def preamble_offset(spark, sf_dir):
    """SRC-5: the header below two lines of preamble, above ragged rows."""
    lines = fx.preamble_lines(spark, sf_dir)
    return delimited.guess_header_offset(lines)


def preamble_cells(spark, sf_dir):
    """SRC-5 wired: cells of the table below the guessed header."""
    lines = fx.preamble_lines(spark, sf_dir)
    got = delimited.cells_table(delimited.skip_preamble(lines, delimited.guess_header_offset(lines)), unwrap=True)
    return got.drop("file")


def bad_bytes(spark, sf_dir):
    """SRC-1: bytes that are no UTF-8 are read as U+FFFD."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    line = F.concat(k.cast("string").cast("binary"), F.lit(b","), F.when(k % 3 == 0, F.unhex(F.lit("63E9"))).otherwise(F.unhex(F.lit("63C3A9"))))
    path = _folder(spark, "bytes")
    p.select(line.cast("string").alias("value")).write.text(path)
    return read_lines(spark, path).select("line")


def file_headers(spark, sf_dir):
    """SRC-1/2: delimiter, labels and rows of files written with three
    delimiters, many files each; headers are read from the files themselves."""
    p = table(spark, sf_dir, "part")
    base = _folder(spark, "headers")
    layouts = {"pipe": "|", "semicolon": ";", "tab": "\t"}
    for name, sep in layouts.items():
        (p.select("p_partkey", F.col("p_name").alias("the name"), "p_size", F.lit("it's").alias("remark")).repartition(3, "p_partkey")
         .write.option("header", True).option("sep", sep).csv(f"{base}/{name}"))
    lines = read_lines(spark, [f"{base}/{name}" for name in layouts])
    layout = F.regexp_extract("file", r"/([a-z]+)/[^/]*$", 1).alias("layout")
    heads = sniff_header(lines).select(layout, "delim", F.array_join("labels", ",").alias("labels")).distinct()
    rows = data_rows(lines).groupBy(layout).agg(F.count("*").alias("n_rows"), F.sum(F.octet_length("line")).alias("n_bytes"))
    return heads.join(rows, "layout")


def file_standardize(spark, sf_dir):
    """PIPE-1 from real files: customers exported in parts, all cells quoted,
    with quotes, apostrophes and commas inside."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = (F.when(k % 3 == 0, F.concat("c_name", F.lit(' "the first"'))).when(k % 4 == 1, F.concat("c_name", F.lit(", d'Or et d'Argent")))
            .otherwise(F.col("c_name")))
    path = _folder(spark, "files")
    wr.write_csv(c.select(k.alias("row_idx"), k.cast("string").alias("key"), name.alias("name"),
                          fx.money(F.col("c_acctbal")).alias("balance"), F.lit("'").alias("mark")), path, quoting="all")
    std = sd.standardize(read_lines(spark, path, across_files=True))
    return std.table


def rule_units(spark, sf_dir):
    """JOIN-13 with one rule per part: stretches of the names, in a mixed order."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rules = p.select((k * 7919 % 1000003).alias("ord"), F.col("p_name").substr((2 + k % 3).cast("int"), (5 + k % 4).cast("int")).alias("term"),
                     F.concat(F.lit("u"), k.cast("string")).alias("unit"))
    return md.units_by_rules(p.select("p_partkey", F.upper("p_name").alias("name")), rules)


def rule_files(spark, sf_dir):
    """PRJ-6 with one name term per 50th order."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 50 == 0)
    k = F.col("o_orderkey")
    rules = (o.select(F.lit("name").alias("kind"), (k * 7919 % 1000003).alias("ord"), F.concat(F.lit("Occurrence_"), (k / 50).cast("long").cast("string")).alias("term"))
             .unionByName(o.select(F.when(k % 100 == 0, F.lit("title")).otherwise(F.lit("ftype_req")).alias("kind"), k.alias("ord"),
                                   F.when(k % 100 == 0, F.lit("Core:occurrence")).otherwise(F.lit(".zip")).alias("term"))))
    tagged = mf.tag_files_by_rules(fx.manifest_files(spark, sf_dir), rules)
    return tagged.select("item_id", "file_pos", "name", "stem", "dftype", "passes")


def rule_directives(spark, sf_dir):
    """PRJ-7 with terms taken from the parts' own names."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rules = p.where(k % 20 < 2).select(F.when(k % 20 == 0, F.lit("numeric")).otherwise(F.lit("string")).alias("kind"), k.alias("ord"),
                                       F.col("p_name").substr(3, 6).alias("term"))
    labels = p.select("p_partkey", F.when(k % 90 == 0, F.lit("Altitude")).otherwise(F.concat_ws("_", "p_name", "p_brand")).alias("label"))
    return co.directives_by_rules(labels, rules)


def round_trip_documents(spark, sf_dir):
    """PIPE-4 on whole texts with quotes, apostrophes and line breaks."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    text = F.concat(F.when(k % 3 == 0, F.lit('"')).otherwise(F.lit("'")), F.col("text"), F.when(k % 5 == 0, F.lit('","')).otherwise(F.lit("\n\n")))
    src = d.select(k.alias("row_idx"), k.cast("string").alias("doc_id"), text.alias("text"), "lang",
                   F.when(k % 7 == 0, F.lit("")).otherwise(F.col("source")).alias("source"))
    return sd.round_trip(src).by_column()


IO_QUERIES = {f.__name__: f for f in (
    typed_scan, zip_scan, manifest_scan, vocab_scan, part_concat, dataset_attributes, paged_files, match_report, quarantine,
    absent_filled, sampled_limit, sampled_late_cells, sampled_losses, file_names, catalog_parts, time_axis_units, catalog_attributes, incremental_skip, chained,
    reconcile_repeated_keys, repeated_key_messages, match_special_names, preamble_offset, preamble_cells, bad_bytes,
    round_trip_documents, reconcile_hot_key, reconcile_reports, type_reconcile_gaps, incremental_profile_gaps, changed_sources, match_limited, revised_vocabulary, quoted_scan, named_pages, round_precision_max, file_headers, file_standardize,
    rule_units, rule_files, rule_directives)}
