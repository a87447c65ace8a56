"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator family of the blueprint. Each reads the given tables (or data
Spark derives from them), over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidemark.functions.text import clean_label
from tidemark.operators import structure as st
from tidemark.functions.text import to_ascii
from tidemark.functions.time import OUT_FORMAT, format_iso
from tidemark.operators import coerce as co
from tidemark.operators import profile as pr
from tidemark.functions.text import strip_tags, wrap_text
from tidemark.operators import catalog as ct
from tidemark.operators import manifest as mf
from tidemark.operators import metadata as md
from tidemark.operators import vocab as vc
from tidemark.operators.compare import reconcile
from tidemark.operators.labels import check_labels, header_match
from tidemark.plans import fixtures as fx
from tidemark.plans.queries_io import IO_QUERIES
from tidemark.sources.html_terms import extract_terms
from tidemark.sources.lines import data_rows, header_labels, sniff_header

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------
# Wave 1: reconciliation of a source table against its revision
# --------------------------------------------------------------------------
def orders_reconciliation(spark: SparkSession, sf_dir: str):
    return reconcile(fx.orders_source(spark, sf_dir), fx.orders_revised(spark, sf_dir),
                     on="row_idx", postfilter=True, equivalence=True, max_report=50)


def reconcile_entries(spark, sf_dir):
    return orders_reconciliation(spark, sf_dir).entries()


def reconcile_dims(spark, sf_dir):
    return orders_reconciliation(spark, sf_dir).dims()


def discrepancy_reduction(spark, sf_dir):
    return orders_reconciliation(spark, sf_dir).discrepancies()


def reconcile_by_column(spark, sf_dir):
    return orders_reconciliation(spark, sf_dir).by_column()


def top_errors(spark, sf_dir):
    return orders_reconciliation(spark, sf_dir).errors(50)


# --------------------------------------------------------------------------
# Wave 2: structure of delimited lines
# --------------------------------------------------------------------------
# The post-filter map on whole lines.
LINE_TOKENS = {",n/a,": ",NA,", ",none,": ",NA,", ",na,": ",NA,"}


def delimiter_sniff(spark, sf_dir):
    h = sniff_header(fx.all_lines(spark, sf_dir))
    return (h.select("file", "delim", F.posexplode("labels").alias("pos", "label"))
             .select("file", "delim", F.col("pos").cast("int").alias("pos"), "label",
                     clean_label("label").alias("clean")))


def label_guard(spark, sf_dir):
    return check_labels(header_labels(fx.all_lines(spark, sf_dir)), key=["file"])


def header_match_lines(spark, sf_dir):
    left = header_labels(fx.part_lines(spark, sf_dir)).drop("file")
    right = header_labels(fx.part_lines(spark, sf_dir, revised=True)).drop("file")
    return header_match(left, right)


def quote_majority(spark, sf_dir):
    return st.quote_majority(fx.all_lines(spark, sf_dir))


def running_quote_style(spark, sf_dir):
    return (st.running_quote_style(fx.all_lines(spark, sf_dir))
              .select("file", "row_idx", "balance", "quote"))


def row_width_qc(spark, sf_dir):
    return st.check_widths(fx.all_lines(spark, sf_dir))


def cell_split(spark, sf_dir):
    r = st.parsed_rows(fx.all_lines(spark, sf_dir))
    return r.select("file", "row_idx", F.posexplode("cells").alias("pos", "cell")) \
        .withColumn("pos", F.col("pos").cast("int"))


def token_replace(spark, sf_dir):
    d = data_rows(fx.part_lines(spark, sf_dir))
    return d.select("file", "row_idx",
                    st.replace_tokens_line("line", LINE_TOKENS, ignore_case=True).alias("line"))


def normalize_delimiter(spark, sf_dir):
    return st.normalize_delimiter(fx.customer_lines(spark, sf_dir))


# --------------------------------------------------------------------------
# Wave 3: profiling and cell coercion
# --------------------------------------------------------------------------
CHUNK_ELEMENTS = 1e6  # elements per chunk for the chunked profile


def column_profile(spark, sf_dir):
    return pr.profile(fx.lineitem_text(spark, sf_dir)).drop("chunk")


def type_reconcile(spark, sf_dir):
    li = fx.lineitem_text(spark, sf_dir)
    rows = pr.chunk_rows(CHUNK_ELEMENTS, len(li.columns))
    prof = pr.profile(li, chunk=pr.chunk_id(F.col("l_orderkey").cast("long"), rows))
    t = pr.reconcile_types(prof)
    return t.select("column", "pos", "family", "max_len", "max_int", "non_null", "chunks_disagree",
                    pr.spark_type("family").alias("spark_type"),
                    pr.storage_type("family").alias("storage"),
                    F.when(F.col("family") == "object", pr.string_width("max_len")).alias("width"))


def numeric_accept(spark, sf_dir):
    df = fx.customer_text(spark, sf_dir)
    return co.acceptance(df, [c for c in df.columns if c != "row_idx"])


def numeric_coerce(spark, sf_dir):
    return co.coerce_numeric(fx.customer_text(spark, sf_dir))


def round_precision(spark, sf_dir):
    df = fx.customer_text(spark, sf_dir)
    return co.coerce_position(df, ["decimalLatitude", "decimalLongitude"]) \
        .select("row_idx", "decimalLatitude", "decimalLongitude")


def time_to_utc(spark, sf_dir):
    e = fx.events_text(spark, sf_dir)
    return e.select("event_id", co.normalize_time("eventDate", "string", OUT_FORMAT).alias("eventDate"))


def days_since_epoch(spark, sf_dir):
    e = fx.events_text(spark, sf_dir)
    return e.select("event_id", co.normalize_time("eventDate", "integer").alias("eventDate"))


def ascii_replace(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select("doc_id", to_ascii("text", "replace").alias("text"),
                    to_ascii("text", "ignore").alias("text_ignore"))


def page_number(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("row_idx"))
    rows_per_file = 1000
    total = o.select(F.count("*")).scalar()
    pages = o.groupBy(pr.page_number("row_idx", rows_per_file).alias("page")).agg(
        F.count("*").alias("n_rows"), F.min("row_idx").alias("first_row"),
        F.max("row_idx").alias("last_row"))
    name = F.when(total > rows_per_file, F.concat(F.lit("orders_part"), F.col("page").cast("string"))) \
        .otherwise(F.lit("orders"))
    return pages.withColumn("part_name", name)


def empty_columns(spark, sf_dir):
    return pr.value_counts(fx.customer_text(spark, sf_dir))


def sampled_types(spark, sf_dir):
    return pr.guess_types(fx.customer_text(spark, sf_dir), window=500)


# --------------------------------------------------------------------------
# Wave 4: vocabularies and name matching
# --------------------------------------------------------------------------
def _local_vocab(spark, sf_dir):
    return vc.vocab_from_attrs(extract_terms(fx.term_pages(spark, sf_dir)))


def _candidates(spark, sf_dir):
    return vc.triple_pattern(fx.graph_triples(spark, sf_dir), require_predicate_label=True)


def _matches(spark, sf_dir):
    return vc.match_variables(fx.variables(spark, sf_dir), _local_vocab(spark, sf_dir),
                              _candidates(spark, sf_dir))


def html_terms(spark, sf_dir):
    return extract_terms(fx.term_pages(spark, sf_dir))


def vocab_terms(spark, sf_dir):
    v = _local_vocab(spark, sf_dir)
    page = F.floor(F.col("ord") / vc.PAGE_STEP).cast("long")
    return (v.select("term", page.alias("page_id"), (F.col("ord") % vc.PAGE_STEP).cast("long").alias("seq"),
                     F.posexplode("attrs").alias("apos", "attr", "value"))
            .withColumn("apos", F.col("apos").cast("int")))


def triple_pattern(spark, sf_dir):
    return vc.triple_pattern(fx.graph_triples(spark, sf_dir))


def vocab_merge(spark, sf_dir):
    m = vc.merge_vocab(_local_vocab(spark, sf_dir), vc.triple_pattern(fx.graph_triples(spark, sf_dir)))
    return m.select("term", "source", F.posexplode("attrs").alias("apos", "attr", "value")) \
        .withColumn("apos", F.col("apos").cast("int"))


def match_cascade(spark, sf_dir):
    m = _matches(spark, sf_dir)
    return m.select("dataset", "name", "pos", "kind", "term", "stage", "hits",
                    F.size("candidates").alias("n_candidates"),
                    F.array_join("candidates", "|").alias("candidates"))


def match_counts(spark, sf_dir):
    return vc.match_counts(_matches(spark, sf_dir))


def missing_labels(spark, sf_dir):
    return vc.missing_labels(_matches(spark, sf_dir))


# --------------------------------------------------------------------------
# Wave 6: file manifests
# --------------------------------------------------------------------------
def _tagged(spark, sf_dir):
    return mf.tag_files(fx.manifest_files(spark, sf_dir))


def _fresh(spark, sf_dir):
    return mf.freshness(mf.candidates(_tagged(spark, sf_dir)), fx.local_listing(spark, sf_dir))


def candidate_files(spark, sf_dir):
    return mf.candidates(_tagged(spark, sf_dir)).select("item_id", "name", "stem", "dftype", "size")


def manifest_summary(spark, sf_dir):
    return mf.manifest_summary(fx.manifest_items(spark, sf_dir), _tagged(spark, sf_dir), _fresh(spark, sf_dir))


def freshness(spark, sf_dir):
    return _fresh(spark, sf_dir).select("item_id", "name", "src_file", "reason", "fetch")


def items_without_files(spark, sf_dir):
    return mf.items_without_candidates(fx.manifest_items(spark, sf_dir), _tagged(spark, sf_dir)) \
        .select("id", "title")


def request_status(spark, sf_dir):
    return mf.request_status(mf.candidates(_tagged(spark, sf_dir)), fx.local_listing(spark, sf_dir))


def item_dates(spark, sf_dir):
    return mf.item_dates(fx.manifest_files(spark, sf_dir))


def file_dates(spark, sf_dir):
    return mf.file_start_dates(fx.manifest_files(spark, sf_dir))


# --------------------------------------------------------------------------
# Wave 5: metadata and catalogue
# --------------------------------------------------------------------------
RUN_TIME = "2000-01-01T00:00:00Z"  # fixed processing time for reproducible history text


def variable_units(spark, sf_dir):
    m = md.variable_metadata(fx.dataset_vars(spark, sf_dir), _local_vocab(spark, sf_dir))
    attrs = F.array_join(F.transform(F.map_entries("vocab"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return m.withColumn("vocab", attrs)


def destination_names(spark, sf_dir):
    return ct.catalog_variables(fx.dataset_vars(spark, sf_dir))


def axis_conflicts(spark, sf_dir):
    return ct.catalog_variables(fx.dataset_vars(spark, sf_dir)).where("conflict") \
        .select("dataset", "pos", "name", "destination")


def keywords(spark, sf_dir):
    return ct.keywords(ct.catalog_variables(fx.dataset_vars(spark, sf_dir)))


def wrap_documents(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select("doc_id", wrap_text("text").alias("text"))


def strip_html(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return p.select("page_id", strip_tags("html").alias("text"))


def dataset_metadata(spark, sf_dir):
    tagged = _tagged(spark, sf_dir)
    files = fx.manifest_files(spark, sf_dir)
    # only what is used below goes through the shuffles, and the item texts are joined last
    passing = tagged.select("item_id", "stem", "file_pos", "name", "dftype", "passes")
    cands = mf.candidates(passing).select("item_id", F.col("stem").alias("dataset"), "dftype",
                                          mf.source_name(F.col("name")).alias("src_file"))
    items = fx.manifest_items(spark, sf_dir)
    by_file = mf.dates_by_file(files)   # one pass over the files for both dates
    file_start = by_file.select("item_id", "src_file", F.coalesce(
        format_iso("file_uploaded"), F.lit(md.NO_TIME))
        .alias("file_start"))
    dated = (cands.join(file_start, ["item_id", "src_file"], "left").drop("src_file")
                  .join(mf.item_start_dates(by_file), "item_id"))
    ds = mf.attach_items(dated, items)
    return md.dataset_metadata(ds, now=F.lit(RUN_TIME))


# --------------------------------------------------------------------------
# Wave 7: composite operators, sinks and incremental runs
# --------------------------------------------------------------------------
def round_trip(spark, sf_dir):
    from tidemark.plans.standardize import round_trip as rt
    return rt(fx.orders_source(spark, sf_dir), postfilter=True, equivalence=True).entries()


def standardize_table(spark, sf_dir):
    from tidemark.plans.standardize import standardize
    return standardize(fx.part_lines(spark, sf_dir)).table


def standardize_qc(spark, sf_dir):
    from tidemark.plans.standardize import standardize
    return standardize(fx.part_lines(spark, sf_dir)).qc


def standardize_sampled(spark, sf_dir):
    from tidemark.plans.standardize import standardize_sampled as ss
    return ss(fx.customer_text(spark, sf_dir).drop("file"), window=500)[0]


SOURCE_FILE_ROWS, SOURCE_FILES_PER_BATCH = 50_000, 8


def incremental_profile(spark, sf_dir):
    import os
    import uuid

    from tidemark.session import checkpoint_dir
    from tidemark.streaming.incremental import incremental_profile as ip
    base = os.path.join(checkpoint_dir(spark), f"incremental-{uuid.uuid4().hex}")
    li = fx.lineitem_text(spark, sf_dir)
    # the source arrives in files of bounded size, several per micro-batch
    li.write.option("maxRecordsPerFile", SOURCE_FILE_ROWS).parquet(f"{base}/source")
    prof = ip(spark, f"{base}/source", f"{base}/state", f"{base}/checkpoint", schema=li.schema,
              max_files_per_trigger=SOURCE_FILES_PER_BATCH)
    return prof.select("column", "pos", "family", "max_len", "max_int", "non_null")


def quote_style(spark, sf_dir):
    from tidemark.plans.standardize import text_column_counts
    lines = fx.all_lines(spark, sf_dir)
    return st.infer_quoting(lines, text_column_counts(lines))


def first_files(spark, sf_dir):
    from tidemark.plans.standardize import first_files as ff
    c = mf.candidates(_tagged(spark, sf_dir)).select(mf.source_name(F.col("name")).alias("name"))
    return ff(c, 10)


def column_directives(spark, sf_dir):
    labels = fx.dataset_vars(spark, sf_dir).select("dataset", "pos", F.col("name").alias("label"))
    return co.column_directives(labels)


def catalog(spark, sf_dir):
    cv = ct.catalog_variables(fx.dataset_vars(spark, sf_dir))
    datasets = cv.select("dataset").distinct().withColumn(
        "title", F.concat(F.lit("Occurrence table "), F.col("dataset")))
    cat = ct.build_catalog(datasets, cv)
    # the nested variable list, flattened to text for comparison
    var_text = F.array_join(F.transform("variables", lambda v: F.concat_ws(
        ":", v["pos"].cast("string"), v["name"], v["destination"], v["data_type"], v["category"])), ";")
    return cat.select("dataset", "title", "info_url", "summary", "keywords", "n_variables",
                      var_text.alias("variables"))


def reconcile_messages(spark, sf_dir):
    return orders_reconciliation(spark, sf_dir).messages()


def key_duplicates(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("l_quantity"))
    return reconcile(li, li, on=["l_orderkey", "l_linenumber"]).duplicate_keys()


def header_offset(spark, sf_dir):
    from tidemark.sources.delimited import guess_header_offset
    return guess_header_offset(fx.all_lines(spark, sf_dir), window=500)


def export_sizes(spark, sf_dir):
    import os
    import uuid

    from tidemark.session import checkpoint_dir
    from tidemark.sinks.writers import size_compare, write_csv
    base = os.path.join(checkpoint_dir(spark), f"export-{uuid.uuid4().hex}")
    src = fx.orders_source(spark, sf_dir)
    write_csv(src, f"{base}/minimal", quoting="minimal")
    write_csv(src, f"{base}/all", quoting="all")
    return size_compare(spark, f"{base}/minimal", f"{base}/all")


QUERIES: dict[str, Query] = {
    **IO_QUERIES,
    "reconcile_entries": reconcile_entries,
    "reconcile_dims": reconcile_dims,
    "discrepancy_reduction": discrepancy_reduction,
    "reconcile_by_column": reconcile_by_column,
    "top_errors": top_errors,
    "delimiter_sniff": delimiter_sniff,
    "label_guard": label_guard,
    "header_match": header_match_lines,
    "quote_majority": quote_majority,
    "running_quote_style": running_quote_style,
    "row_width_qc": row_width_qc,
    "cell_split": cell_split,
    "token_replace": token_replace,
    "normalize_delimiter": normalize_delimiter,
    "column_profile": column_profile,
    "type_reconcile": type_reconcile,
    "numeric_accept": numeric_accept,
    "numeric_coerce": numeric_coerce,
    "round_precision": round_precision,
    "time_to_utc": time_to_utc,
    "days_since_epoch": days_since_epoch,
    "ascii_replace": ascii_replace,
    "page_number": page_number,
    "empty_columns": empty_columns,
    "sampled_types": sampled_types,
    "html_terms": html_terms,
    "vocab_terms": vocab_terms,
    "triple_pattern": triple_pattern,
    "vocab_merge": vocab_merge,
    "match_cascade": match_cascade,
    "match_counts": match_counts,
    "missing_labels": missing_labels,
    "candidate_files": candidate_files,
    "manifest_summary": manifest_summary,
    "freshness": freshness,
    "items_without_files": items_without_files,
    "request_status": request_status,
    "item_dates": item_dates,
    "file_dates": file_dates,
    "variable_units": variable_units,
    "destination_names": destination_names,
    "axis_conflicts": axis_conflicts,
    "keywords": keywords,
    "wrap_text": wrap_documents,
    "strip_html": strip_html,
    "dataset_metadata": dataset_metadata,
    "round_trip": round_trip,
    "standardize": standardize_table,
    "standardize_qc": standardize_qc,
    "standardize_sampled": standardize_sampled,
    "incremental_profile": incremental_profile,
    "quote_style": quote_style,
    "first_files": first_files,
    "column_directives": column_directives,
    "catalog": catalog,
    "reconcile_messages": reconcile_messages,
    "key_duplicates": key_duplicates,
    "header_offset": header_offset,
    "export_sizes": export_sizes,
}
