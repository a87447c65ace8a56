"""File-manifest selection (MAN-1): candidate tagging (PRJ-6, S4), search
summary (AGG-4), freshness (JOIN-11), request reconciliation (JOIN-10),
items without candidates (JOIN-12), item / file dates (AGG-10) and item
metadata attachment (JOIN-9).

Manifest model: ``items(id, title, body, citation, link_url)`` and
``files(item_id, file_pos, name, title, url, size, dateUploaded)``; a
local listing is ``local(file, modified)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import contains_any, first_contained
from tidemark.functions.time import format_iso, parse_iso
from tidemark.operators.rules import first_rules, tag

# Default search terms (lower-cased when used).
FILE_SEARCH = {
    "title": ["DarwinCore:event", "DarwinCore:occurrence", "DarwinCore:measurementOrFact",
              "final processed source", "Final Processed File"],
    "name": ["occurrence", "event", "measurementorfact"],
    "ftype_req": [".csv", ".zip"],
}
FRESHNESS_MARGIN_HOURS = 12


def _first_term(text: Column, terms: list[str]) -> Column:
    return first_contained(text, [t.lower() for t in terms])


def tag_files(files: DataFrame, search: dict | None = None) -> DataFrame:
    """PRJ-6 / S4: a file passes when its lower-cased title contains a
    title term, or its name contains a name term and a required
    extension; its tag is ``<first matching term> data``. Adds ``stem``,
    ``dftype`` and ``passes``; :func:`candidates` keeps the first passing
    file per (item, stem) (``a.csv`` hides ``a.zip``)."""
    s = search or FILE_SEARCH
    t_title = _first_term(F.col("title"), s["title"])
    t_name = _first_term(F.col("name"), s["name"])
    ext_ok = contains_any(F.col("name"), [e.lower() for e in s["ftype_req"]])
    tag = (F.when(t_title.isNotNull(), F.concat(t_title, F.lit(" data")))
            .when(t_name.isNotNull() & ext_ok, F.concat(t_name, F.lit(" data"))))
    stem = F.substring_index("name", ".", 1)
    return files.withColumn("stem", stem).withColumn("dftype", tag) \
        .withColumn("passes", F.col("dftype").isNotNull())


def tag_files_by_rules(files: DataFrame, rules: DataFrame) -> DataFrame:
    """PRJ-6 / S4 with the search terms as a table ``(kind, ord, term)`` of
    any size; kinds are ``title``, ``name`` and ``ftype_req``."""
    found = first_rules(files, {"_title": ("title", "title"), "_name": ("name", "name"), "_ext": ("name", "ftype_req")}, rules)
    dftype = F.when(F.col("_title").isNotNull(), tag(F.col("_title"))).when(F.col("_ext").isNotNull(), tag(F.col("_name")))
    return (found.withColumn("stem", F.substring_index("name", ".", 1)).withColumn("dftype", dftype)
            .withColumn("passes", F.col("dftype").isNotNull()).drop("_title", "_name", "_ext"))


def candidates(tagged: DataFrame) -> DataFrame:
    """S4: first passing file per (item, stem) by list position: a
    grouped ``min_by`` (map-side partial aggregation; an item holding a
    third of all files still spreads over its stems). The pass test is an
    aggregate input, not a filter, so the optimizer cannot copy the tag
    expressions into a pushed-down predicate."""
    cols = [c for c in tagged.columns if c not in ("item_id", "stem", "file_pos")]
    pos = F.when(F.col("passes"), F.col("file_pos"))
    return (tagged.groupBy("item_id", "stem")
                  .agg(F.min_by(F.struct(*cols), pos).alias("_f"), F.min(pos).alias("file_pos"))
                  .where(F.col("file_pos").isNotNull())
                  .select("item_id", "stem", "file_pos", "_f.*"))


def source_name(name: Column) -> Column:
    """Local source file of a candidate: a zip stands for ``<stem>.csv``."""
    return F.when(F.instr(name, ".zip") > 0, F.concat(F.substring_index(name, ".", 1), F.lit(".csv"))) \
        .otherwise(name)


def freshness(candidates: DataFrame, local: DataFrame, overwrite: bool = False,
              margin_hours: int = FRESHNESS_MARGIN_HOURS) -> DataFrame:
    """JOIN-11: fetch when the local copy is absent, older than the upload
    time minus the margin, or ``overwrite``; an unparsable upload time is
    treated as not newer (reason ``bad_upload_time``)."""
    c = candidates.withColumn("src_file", source_name(F.col("name"))) \
        .withColumn("uploaded", parse_iso(F.col("dateUploaded")))
    j = c.join(local.select(F.col("file").alias("src_file"), F.col("modified")), on="src_file", how="left")
    stale = F.col("modified") < F.col("uploaded") - F.expr(f"INTERVAL {int(margin_hours)} HOURS")
    reason = (F.when(F.lit(overwrite), F.lit("overwrite"))
               .when(F.col("modified").isNull(), F.lit("absent"))
               .when(F.col("uploaded").isNull(), F.lit("bad_upload_time"))
               .when(stale, F.lit("stale"))
               .otherwise(F.lit("current")))
    fetch = reason.isin("overwrite", "absent", "stale")
    return j.withColumn("reason", reason).withColumn("fetch", fetch)


def manifest_summary(items: DataFrame, tagged: DataFrame, fresh: DataFrame | None = None) -> DataFrame:
    """AGG-4: items, files, candidates, downloads and sizes in MB (/1e6)."""
    # ``fresh`` has one row per candidate, so one aggregate of it gives the
    # candidate and the download figures
    chosen = fresh if fresh is not None else candidates(tagged).withColumn("fetch", F.lit(False))
    figures = chosen.agg(
        F.count("*").alias("candidate_files"), (F.sum("size") / F.lit(1e6)).alias("candidate_mb"),
        F.sum(F.col("fetch").cast("long")).alias("downloads"),
        (F.sum(F.when(F.col("fetch"), F.col("size")).otherwise(0)) / F.lit(1e6)).alias("download_mb"))
    names = figures.columns if fresh is not None else figures.columns[:2]
    return (tagged.agg(F.count("*").alias("total_files"))
            .select(items.select(F.count("*")).scalar().alias("items"), "total_files",
                    figures.select(F.struct("*")).scalar().alias("f"))
            .select("items", "total_files", *[F.col(f"f.{n}").alias(n) for n in names]))


def request_status(candidates: DataFrame, local: DataFrame, ext: str = ".csv") -> DataFrame:
    """JOIN-10: local files of another request (``ignored``), requested
    files missing locally (``missing``) and the work list (``ok``)."""
    # one full outer join of the two distinct name sets decides all three
    req = candidates.select(source_name(F.col("name")).alias("file")).distinct() \
        .withColumn("requested", F.lit(True))
    loc = local.where(F.col("file").endswith(ext)).select("file").distinct().withColumn("present", F.lit(True))
    j = req.join(loc, on="file", how="full_outer")
    status = (F.when(F.col("requested") & F.col("present"), F.lit("ok"))
               .when(F.col("present"), F.lit("ignored")).otherwise(F.lit("missing")))
    return j.select("file", status.alias("status"))


def items_without_candidates(items: DataFrame, tagged: DataFrame) -> DataFrame:
    """JOIN-12."""
    return items.join(tagged.where("passes").select(F.col("item_id").alias("id")), on="id",
                      how="left_anti")


def item_dates(files: DataFrame) -> DataFrame:
    """AGG-10 per item: start date = earliest parsable upload time, as
    ``yyyy-MM-ddTHH:mm:ssZ`` text ('time not known' when none)."""
    t = files.withColumn("uploaded", parse_iso(F.col("dateUploaded")))
    g = t.groupBy("item_id").agg(F.min("uploaded").alias("first"), F.count("*").alias("files"),
                                 F.count("uploaded").alias("dated"))
    return g.select("item_id", "files", "dated",
                    F.coalesce(format_iso(F.col("first")), F.lit("time not known")).alias("start_date"))


def file_start_dates(files: DataFrame) -> DataFrame:
    """AGG-10 per source csv: upload time of the file with the same name,
    or of the zip with the same stem (the later listed file wins)."""
    t = files.withColumn("uploaded", parse_iso(F.col("dateUploaded"))) \
        .withColumn("src_file", source_name(F.col("name")))
    g = t.groupBy("item_id", "src_file").agg(F.max_by("uploaded", "file_pos").alias("u"))
    return g.select("item_id", "src_file",
                    F.coalesce(format_iso(F.col("u")), F.lit("time not known")).alias("file_start_date"))


def dates_by_file(files: DataFrame) -> DataFrame:
    """AGG-10 in one pass: per (item, source csv) the earliest upload time
    and the upload time of the last listed file; per-item start dates are
    the minimum over this (much smaller) table (:func:`item_start_dates`)."""
    t = files.withColumn("uploaded", parse_iso(F.col("dateUploaded"))) \
        .withColumn("src_file", source_name(F.col("name")))
    return t.groupBy("item_id", "src_file").agg(F.min("uploaded").alias("first_uploaded"),
                                                F.max_by("uploaded", "file_pos").alias("file_uploaded"))


def item_start_dates(by_file: DataFrame) -> DataFrame:
    return (by_file.groupBy("item_id").agg(F.min("first_uploaded").alias("u"))
                   .select("item_id", F.coalesce(format_iso(F.col("u")), F.lit("time not known"))
                           .alias("item_start")))


def attach_items(datasets: DataFrame, items: DataFrame, on_item: str = "item_id") -> DataFrame:
    """JOIN-9: item metadata on each dataset (left join)."""
    return datasets.join(items.withColumnRenamed("id", on_item), on=on_item, how="left")
