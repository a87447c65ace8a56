"""Item-manifest scan (SRC-7) and vocabulary scan (SRC-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM_SCHEMA = ("id string, title string, body string, citation string, link struct<url:string>, "
               "files array<struct<name:string, title:string, url:string, size:bigint, "
               "dateUploaded:string>>")


def read_manifest(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON items with nested file lists: one item per line, or with
    ``multi_line`` documents of one item or a list of items each. Returns
    (items, files) with ``file_pos`` = position in the item."""
    raw = spark.read.schema(ITEM_SCHEMA).option("multiLine", multi_line).json(path)
    items = raw.select("id", "title", "body", "citation", F.col("link.url").alias("link_url"))
    files = raw.select(F.col("id").alias("item_id"), F.posexplode_outer("files").alias("file_pos", "f")) \
        .where(F.col("f").isNotNull()).select("item_id", "file_pos", "f.*")
    return items, files


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: a JSON document ``{term: {attr: text}}`` -> (term, ord, attrs).

    A document is one value (``wholetext``) and is parsed to a map; term
    order is the document order. A document that is no such JSON fails."""
    doc = spark.read.option("wholetext", True).text(path)
    parsed = F.from_json("value", "map<string,map<string,string>>")
    m = F.coalesce(parsed, F.raise_error(F.lit("a vocabulary document is not JSON of the form {term: {attribute: text}}"))
                   .cast("map<string,map<string,string>>"))
    return doc.select(F.posexplode(F.map_entries(m)).alias("ord", "e")) \
        .select(F.col("e.key").alias("term"), F.col("ord").cast("long").alias("ord"),
                F.col("e.value").alias("attrs"))
