"""Derived inputs: deterministic tables Spark builds from the given test
tables (all arithmetic on keys, so the DuckDB oracles can rebuild them
with the same rules). Every fixture grows with the table it reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import table


def money(c: Column, scale: int = 2) -> Column:
    """Render a double as fixed-point text (Spark would print 1.0E7)."""
    return c.cast(f"decimal(18,{scale})").cast("string")


# --------------------------------------------------------------------------
# Source vs revised orders (reconcile fixtures)
# --------------------------------------------------------------------------
def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the text a delimited source holds; the source marks a
    missing status with ``NA`` on every 83rd key."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("row_idx"),
        k.cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(k % 83 == 0, F.lit("NA")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        money(F.col("o_totalprice")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.col("o_orderpriority"))


def orders_revised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revision of :func:`orders_source`: every 97th price changed, every
    89th price written with three decimals, every 83rd status ``n/a``,
    the last 10 keys dropped, the date column renamed, a clerk column added."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    last = o.select(F.max("o_orderkey")).scalar()
    price = F.col("o_totalprice")
    return (o.where(k <= last - 10).select(
        k.alias("row_idx"),
        k.cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(k % 83 == 0, F.lit("n/a")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 97 == 0, money(price + F.lit(1.0)))
         .when(k % 89 == 0, money(price, 3))
         .otherwise(money(price)).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate_utc"),
        F.col("o_orderpriority"),
        F.concat(F.lit("Clerk#"), F.lpad((k % 1000).cast("string"), 9, "0")).alias("o_clerk")))


# --------------------------------------------------------------------------
# Delimited lines built from part / customer rows
# --------------------------------------------------------------------------
def _lines(spark: SparkSession, file: str, header: str, rows: DataFrame) -> DataFrame:
    """(file, line_no, line): header literal at line 0, data rows after."""
    head = spark.range(1).select(F.lit(file).alias("file"), F.lit(0).cast("long").alias("line_no"),
                                 F.lit(header).alias("line"))
    return head.unionByName(rows.select(F.lit(file).alias("file"), "line_no", "line"))


def part_lines(spark: SparkSession, sf_dir: str, revised: bool = False) -> DataFrame:
    """``part.csv``: comma delimited. Every 11th name quoted around an
    embedded delimiter, every 7th single-quoted, every 131st with an
    unbalanced double quote; every 19th brand ``none``, every 13th type
    ``n/a``, every 23rd ``NA``, every 29th ``Na``; every 101st row lacks
    its size cell. ``revised`` renames ``p_type`` and adds a comment."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = (F.when(k % 131 == 0, F.concat(F.lit('"'), "p_name"))
             .when(k % 11 == 0, F.concat(F.lit('"'), "p_name", F.lit(", "), "p_brand", F.lit('"')))
             .when(k % 7 == 0, F.concat(F.lit("'"), "p_name", F.lit("'")))
             .otherwise(F.col("p_name")))
    brand = F.when(k % 19 == 0, F.lit("none")).otherwise(F.col("p_brand"))
    ptype = (F.when(k % 13 == 0, F.lit("n/a")).when(k % 23 == 0, F.lit("NA"))
              .when(k % 29 == 0, F.lit("Na")).otherwise(F.col("p_type")))
    size = F.when(k % 101 == 0, F.lit(None)).otherwise(F.col("p_size").cast("string"))
    cells = [k.cast("string"), name, brand, ptype, size, money(F.col("p_retailprice"))]
    header = "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice"
    file = "part.csv"
    if revised:
        cells.append(F.concat(F.lit("c"), k.cast("string")))
        header = "p_partkey,p_name,p_brand,p_kind,p_size,p_retailprice,p_comment"
        file = "part_redo.csv"
    rows = p.select((k + 1).alias("line_no"), F.concat_ws(",", *cells).alias("line"))
    return _lines(spark, file, header, rows)


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer.txt``: pipe delimited, one header label with a space.
    Every 11th name double-quoted around an embedded pipe, every 7th
    single-quoted, every 131st with an unbalanced single quote, every
    101st row lacks its segment, every 17th balance has a comma."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = (F.when(k % 131 == 0, F.concat(F.lit("'"), "c_name"))
             .when(k % 11 == 0, F.concat(F.lit('"'), "c_name", F.lit("|"), "c_mktsegment", F.lit('"')))
             .when(k % 7 == 0, F.concat(F.lit("'"), "c_name", F.lit("'")))
             .otherwise(F.col("c_name")))
    bal = F.when(k % 17 == 0, F.replace(money(F.col("c_acctbal")), F.lit("."), F.lit(","))) \
        .otherwise(money(F.col("c_acctbal")))
    seg = F.when(k % 101 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    cells = [k.cast("string"), name, F.col("c_nationkey").cast("string"), bal, seg]
    rows = c.select((k + 1).alias("line_no"), F.concat_ws("|", *cells).alias("line"))
    return _lines(spark, "customer.txt", "c_custkey|c_name|c_nationkey|c acctbal|c_mktsegment", rows)


def preamble_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part.csv`` with two lines above its header and two cells too many
    in every 17th row."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cells = [k.cast("string"), F.col("p_name"), F.col("p_brand"), F.col("p_size").cast("string")]
    line = F.when(k % 17 == 0, F.concat_ws(",", *cells, F.lit("more"), F.lit("cells"))).otherwise(F.concat_ws(",", *cells))
    rows = p.select((k + 3).alias("line_no"), line.alias("line"))
    top = spark.createDataFrame([(1, "draft"), (2, "p_partkey,p_name,p_brand,p_size")], "line_no long, line string")
    return _lines(spark, "part.csv", "exported by the parts office", rows.unionByName(top))


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_lines(spark, sf_dir).unionByName(customer_lines(spark, sf_dir))


# --------------------------------------------------------------------------
# Text tables for profiling and coercion
# --------------------------------------------------------------------------
def customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows as delimited-source text: balance ``NA`` every 13th
    key, '' every 37th, ' ' every 59th; comment numeric except every
    211th; an always-empty notes column; two position axes (latitude
    written with 2 or 4 decimals, garbage every 71st; longitude with 3)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    bal = (F.when(k % 13 == 0, F.lit("NA")).when(k % 37 == 0, F.lit(""))
            .when(k % 59 == 0, F.lit(" ")).otherwise(money(F.col("c_acctbal"))))
    lat0 = (k * 37 % 18000) / F.lit(100.0) - F.lit(90.0)
    lat = (F.when(k % 71 == 70, F.lit("?"))
            .when(k % 9 == 0, money(lat0))
            .otherwise(money(lat0 + F.lit(0.0011) * (k % 9), 4)))
    lon = money((k * 53 % 36000) / F.lit(100.0) - F.lit(180.0) + F.lit(0.001) * (k % 7), 3)
    return c.select(
        k.alias("row_idx"), k.cast("string").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"), bal.alias("c_acctbal"),
        "c_mktsegment",
        F.when(k % 211 == 0, F.lit("see note")).otherwise((k * 7).cast("string")).alias("c_comment"),
        F.lit("").alias("c_notes"), lat.alias("decimalLatitude"), lon.alias("decimalLongitude"))


def lineitem_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem rows as text: quantity integral except for orders with
    key % 10007 = 10006 (written with one decimal), tax ``NA`` every 41st
    order, a boolean return flag and a key too large for 32 bits."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    qty = F.when(k % 10007 == 10006, money(F.col("l_quantity"), 1)) \
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    return li.select(
        k.cast("string").alias("l_orderkey"), F.col("l_partkey").cast("string").alias("l_partkey"),
        F.col("l_suppkey").cast("string").alias("l_suppkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"), qty.alias("l_quantity"),
        money(F.col("l_extendedprice")).alias("l_extendedprice"),
        money(F.col("l_discount")).alias("l_discount"),
        F.when(k % 41 == 0, F.lit("NA")).otherwise(money(F.col("l_tax"))).alias("l_tax"),
        "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
        F.when(F.col("l_returnflag") == "R", F.lit("True")).otherwise(F.lit("False")).alias("l_isreturn"),
        (k * 1000003).cast("string").alias("l_bigkey"))


def events_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text with microseconds; every 97th unparsable."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    ts = F.when(k % 97 == 0, F.lit("unknown")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return e.select(k.alias("row_idx"), k.alias("event_id"), ts.alias("eventDate"))


# --------------------------------------------------------------------------
# Vocabulary fixtures: term pages, graph triples, dataset variables
# --------------------------------------------------------------------------
GRAPH_BASE = "http://example.org/ont/ioos"


def term_name(c: Column) -> Column:
    """``red widget`` -> ``redwidget``."""
    return F.regexp_replace(c, " ", "")


def term_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML term tables built from all parts, 100 terms per page. (Labels
    that are no local term come from the suppliers.)"""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    t = term_name(F.col("p_name"))
    row = F.concat(
        F.lit('<tr><td colspan="2"><a name="'), t, F.lit('">Term Name: dwc:'), t, F.lit("</a></td></tr>"),
        F.lit("<tr><td>Definition:</td><td>"), F.col("p_type"), F.lit(" "), F.col("p_brand"),
        F.lit(" part</td></tr>"),
        F.lit("<tr><td>Comments:</td><td>size "), F.col("p_size").cast("string"), F.lit("</td></tr>"),
        F.lit('<tr><td>Details:</td><td><a href="./index.htm#'), t, F.lit('">'), t, F.lit("</a></td></tr>"))
    pages = (p.groupBy(F.floor(k / 100).alias("page_id"))
               .agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), row.alias("r")))).alias("rows")))
    return pages.select(
        "page_id",
        F.concat(F.lit("<html><body><table><tbody>"),
                 F.array_join(F.transform("rows", lambda x: x["r"]), ""),
                 F.lit("</tbody></table></body></html>")).alias("html"))


def graph_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples (s, p, o): one subject per distinct part name (its smallest
    key k), four predicates each; no section when k % 5 = 1, a second
    definition when k % 7 = 2. Supplier subjects add labels that are not
    local terms (section missing when key % 4 = 3). One rdfs:label triple
    names the definition predicate."""
    p = table(spark, sf_dir, "part")
    first = p.groupBy("p_name").agg(F.min_by(F.struct("p_partkey", "p_type"), "p_partkey").alias("f"))
    k = F.col("f.p_partkey")
    s = F.concat(F.lit(GRAPH_BASE + "/term/p"), k.cast("string"))
    label = term_name(F.col("p_name"))

    def tri(df, subj, pred, obj):
        return df.select(subj.alias("s"), F.lit(GRAPH_BASE + pred).alias("p"), obj.alias("o"))

    parts = [
        tri(first, s, "/Term", label),
        tri(first, s, "/Defintion", F.concat(F.lit("Definition of "), F.col("p_name"))),
        tri(first.where(k % 7 == 2), s, "/Defintion", F.concat(F.lit("Other definition of "), F.col("p_name"))),
        tri(first, s, "/Reference", F.concat(F.lit("http://example.org/terms/"), label)),
        tri(first.where(k % 5 != 1), s, "/Section", F.col("f.p_type")),
    ]
    sup = table(spark, sf_dir, "supplier")
    sk = F.col("s_suppkey")
    ss = F.concat(F.lit(GRAPH_BASE + "/term/s"), sk.cast("string"))
    slabel = F.lower(F.regexp_replace("s_name", "#", ""))
    parts += [
        tri(sup, ss, "/Term", slabel),
        tri(sup, ss, "/Defintion", F.concat(F.lit("Supplier in nation "), F.col("s_nationkey").cast("string"))),
        tri(sup, ss, "/Reference", F.concat(F.lit("http://example.org/suppliers/"), sk.cast("string"))),
        tri(sup.where(sk % 4 != 3), ss, "/Section", F.lit("Supplier")),
        sup.where(sk == 0).select(F.lit(GRAPH_BASE + "/Defintion").alias("s"), F.lit("rdfs:label").alias("p"),
                                  F.lit("Definition").alias("o")),
    ]
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d)
    return out


def variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset variables (dataset, pos, name) derived from part rows:
    by key % 6 the exact term, its upper case, ``Red_Widget``,
    ``widget_red``, the noun alone, or a foreign word."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    words = F.split("p_name", " ")
    t = term_name(F.col("p_name"))
    name = (F.when(k % 6 == 0, t)
             .when(k % 6 == 1, F.upper(t))
             .when(k % 6 == 2, F.regexp_replace(F.initcap("p_name"), " ", "_"))
             .when(k % 6 == 3, F.concat(F.try_element_at(words, F.lit(2)), F.lit("_"), F.try_element_at(words, F.lit(1))))
             .when(k % 6 == 4, F.try_element_at(words, F.lit(2)))
             .otherwise(F.concat(F.lit("x"), k.cast("string"))))
    ds = F.concat(F.lit("dataset_"), F.lpad((k % 25).cast("string"), 2, "0"))
    return (p.select(ds.alias("dataset"), name.alias("name"), k)
             .groupBy("dataset", "name").agg(F.min("p_partkey").alias("pos")))


# --------------------------------------------------------------------------
# Manifest fixtures: items = orders, files = lineitem rows
# --------------------------------------------------------------------------
def manifest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    title = (F.when(k % 4 == 0, F.concat(F.lit("Survey "), k.cast("string"), F.lit(" occurrence data")))
              .otherwise(F.concat(F.lit("Survey "), k.cast("string"))))
    body = F.concat(F.lit("<p>Orders of customer "), F.col("o_custkey").cast("string"),
                    F.lit(" with status \""), F.col("o_orderstatus"), F.lit("\" and priority "),
                    F.col("o_orderpriority"), F.lit(". "), F.repeat(F.lit("Collected at sea station. "), k % 9),
                    F.lit("</p>"))
    return o.select(F.concat(F.lit("item_"), k.cast("string")).alias("id"), title.alias("title"),
                    body.alias("body"),
                    F.when(k % 3 == 0, F.concat(F.lit("Report "), k.cast("string"))).alias("citation"),
                    F.concat(F.lit("http://example.org/items/"), k.cast("string")).alias("link_url"))


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files listed in the items (``file_pos`` orders them within an
    item): stems ``occurrence_<order>_<line % 3>``
    with ``.csv`` on even and ``.zip`` on odd line numbers (so stems
    repeat), line 7 a ``notes`` text file; a file title naming an
    occurrence extension when part key % 10 = 0; upload time = ship date,
    with a fraction on line 5 and unparsable on line 6 of every 11th order."""
    li = table(spark, sf_dir, "lineitem")
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    stem = F.concat(F.lit("occurrence_"), k.cast("string"), F.lit("_"), (ln % 3).cast("string"))
    name = (F.when(ln == 7, F.concat(F.lit("notes_"), k.cast("string"), F.lit(".txt")))
             .when(ln % 2 == 0, F.concat(stem, F.lit(".csv")))
             .otherwise(F.concat(stem, F.lit(".zip"))))
    up = (F.when((ln == 6) & (k % 11 == 0), F.lit("n/a"))
           .when(ln == 5, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'.123456Z'"))
           .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return li.select(
        F.concat(F.lit("item_"), k.cast("string")).alias("item_id"),
        # list position: line number first, then a fixed mix of the row's
        # other fields (rows repeating an (order, line) pair stay ordered)
        (ln.cast("long") * F.lit(10 ** 12)
         + (F.col("l_partkey") * 1000003 + F.col("l_suppkey") * 10007
            + F.round(F.col("l_extendedprice") * 100).cast("long") * 101
            + F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")))
         % F.lit(10 ** 12)).alias("file_pos"),
        name.alias("name"),
        F.when(F.col("l_partkey") % 10 == 0, F.lit("DarwinCore:Occurrence extension")).alias("title"),
        F.concat(F.lit("http://example.org/files/"), name).alias("url"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("size"),
        up.alias("dateUploaded"))


def local_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local copies: the csv of every file of orders with key % 3 != 0,
    modified (part key % 37 - 24) hours around its upload time, plus a
    legacy file for every 50th order (from another request)."""
    li = table(spark, sf_dir, "lineitem")
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    stem = F.concat(F.lit("occurrence_"), k.cast("string"), F.lit("_"), (ln % 3).cast("string"))
    copies = (li.where((k % 3 != 0) & (ln != 7))
                .select(F.concat(stem, F.lit(".csv")).alias("file"),
                        (F.col("l_shipdate").cast("timestamp")
                         + F.make_interval(hours=(F.col("l_partkey") % 37 - 24).cast("int"))).alias("modified")))
    # one modification time per local file: the newest copy
    copies = copies.groupBy("file").agg(F.max("modified").alias("modified"))
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 50 == 0)
    legacy = o.select(F.concat(F.lit("legacy_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file"),
                      F.col("o_orderdate").cast("timestamp").alias("modified"))
    return copies.unionByName(legacy)


# --------------------------------------------------------------------------
# Catalogue fixture: dataset columns named like occurrence tables
# --------------------------------------------------------------------------
# Fixture constants: column labels and their storage codes.
DATASET_LABELS = [
    ("decimalLatitude", "f8"), ("decimalLongitude", "f8"), ("depth", "f8"), ("altitude", "f8"),
    ("eventDate", "S1"), ("scientificName", "S1"), ("individualCount", "i4"),
    ("minimumDepthInMeters", "f8"), ("sampleSizeValue", "f8"), ("bodyWeightInKg", "f8"),
    ("occurrenceID", "S1"), ("latitude", "f8"), ("Depth", "f8"), ("collection_code", "S1"),
    ("event_date", "S1"), ("time", "i8"),
]


def dataset_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, pos, name, dtype): each 40 part keys are a dataset; key k
    gives it a column labelled by k % 16 (first key = position), every
    40th a column named like the part's vocabulary term."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    names = F.array(*[F.lit(n) for n, _ in DATASET_LABELS])
    types = F.array(*[F.lit(t) for _, t in DATASET_LABELS])
    idx = (k % len(DATASET_LABELS) + 1).cast("int")
    own = k % 40 == 39
    return (p.select(F.concat(F.lit("dataset_"), F.lpad(F.floor(k / 40).cast("string"), 9, "0")).alias("dataset"),
                     F.when(own, term_name(F.col("p_name"))).otherwise(F.try_element_at(names, idx)).alias("name"),
                     F.when(own, F.lit("S1")).otherwise(F.try_element_at(types, idx)).alias("dtype"), k)
             .groupBy("dataset", "name", "dtype").agg(F.min("p_partkey").alias("pos")))
