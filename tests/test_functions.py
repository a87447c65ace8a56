"""Small column functions and helpers on hand-written rows."""

import datetime

from pyspark.sql import functions as F

from tidemark.functions.text import file_ext, file_stem, part_base, strip_tags, to_ascii
from tidemark.functions.time import parse_iso
from tidemark.operators.catalog import catalog_type, dataset_of_file, destination_name
from tidemark.operators.coerce import fill_absent, force_string, normalize_cell, normalize_time
from tidemark.operators.compare import reconcile
from tidemark.operators.metadata import category, compose_title
from tidemark.plans.standardize import apply_chain, first_files


def _vals(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_file_names(spark):
    df = spark.createDataFrame([("dir/occ_part3.nc",), ("a.tar.gz",), ("plain",)], "v string")
    assert _vals(df, file_stem("v")) == ["occ_part3", "a.tar", "plain"]
    assert _vals(df, file_ext("v")) == [".nc", ".gz", ""]
    stems = spark.createDataFrame([("occ_part3",), ("occ",), ("x_part",)], "v string")
    assert _vals(stems, part_base("v")) == ["occ", "occ", "x_part"]
    assert _vals(stems, dataset_of_file("v", virtual=False)) == ["occ_part3", "occ", "x_part"]


def test_ascii_and_tags(spark):
    df = spark.createDataFrame([("Ça va 😀",), ('<b>"x"</b> y',)], "v string")
    assert _vals(df, to_ascii("v")) == ["?a va ?", '<b>"x"</b> y']
    assert _vals(df, to_ascii("v", "ignore")) == ["a va ", '<b>"x"</b> y']
    assert _vals(df, strip_tags("v"))[1] == "x y"


def test_time_modes(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("1969-12-31 23:00:00",), ("bad",)], "v string")
    assert _vals(df, normalize_time("v", "string")) == ["2020-01-02T03:04:05Z", "1969-12-31T23:00:00Z", None]
    assert _vals(df, normalize_time("v", "integer")) == [18263, -1, None]
    ts = _vals(df, normalize_time("v", "datetime"))
    assert ts[0] == datetime.datetime(2020, 1, 2, 3, 4, 5) and ts[2] is None
    iso = spark.createDataFrame([("2020-01-02T03:04:05Z",), ("2020-01-02T03:04:05.5Z",), ("x",)], "v string")
    assert [v.isoformat() if v else None for v in _vals(iso, parse_iso("v"))] == \
        ["2020-01-02T03:04:05", "2020-01-02T03:04:05.500000", None]


def test_cells_and_strings(spark):
    df = spark.createDataFrame([(" 7.9 ", "NA", "2020-01-02", 3.0)], "i string, s string, d string, x double")
    r = df.select(normalize_cell("i", "Integer").alias("i"), normalize_cell("s", "String").alias("s"),
                  normalize_cell("d", "Date").alias("d"), force_string("x", "double").alias("x")).first()
    assert (r["i"], r["s"], r["d"], r["x"]) == (7, "", "2020-01-02", "3")
    filled = fill_absent(spark.createDataFrame([(None, 1)], "a string, b int")).first()
    assert filled["a"] == "NA" and filled["b"] == 1


def test_titles_categories_destinations(spark):
    df = spark.createDataFrame([("Survey occurrence data", "occurrence data"), ("Survey", "event data"),
                                (None, "x")], "t string, g string")
    assert _vals(df, compose_title("t", "g")) == ["Survey occurrence data", "Survey event data",
                                                  "Untitled dataset"]
    names = spark.createDataFrame([("depth", False), ("Latitude", False), ("decimalLatitude", False),
                                   ("altitude", True), ("speed", False)], "n string, c boolean")
    assert _vals(names, destination_name("n", "c")) == ["depth", "source_Latitude", "latitude",
                                                        "source_altitude", "speed"]
    assert _vals(names, category("n")) == ["Location", "Location", "Unknown", "Location", "Unknown"]
    codes = spark.createDataFrame([("i4",), ("f8",), ("S1",), ("zz",)], "v string")
    assert _vals(codes, catalog_type("v")) == ["int", "double", "String", None]


def test_chain_first_files_and_duplicate_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "name string")
    out = apply_chain(df, [lambda d: d.withColumn("u", F.upper("name")), lambda d: d.where("u != 'C'")])
    assert sorted(_vals(out, "u")) == ["A", "A", "B"]
    assert _vals(first_files(df, 2), "name") == ["a", "b"]
    left = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z")], "row_idx long, v string")
    right = spark.createDataFrame([(0, "x"), (1, "z")], "row_idx long, v string")
    dup = reconcile(left, right).duplicate_keys().collect()
    assert [(r["side"], r["row_idx"], r["n"]) for r in dup] == [("source", 0, 2)]
