"""Catalogue assembly (CAT-1): vertical-axis conflicts (WIN-4),
destination names (FN-7), categories (FN-6), catalogue data types
(PRF-3), keywords (AGG-12), paged-file grouping (FN-8) and the
catalogue sink (SNK-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import part_base
from tidemark.operators.metadata import GENERIC_AXES, axis_field, category

# Storage code -> catalogue type name.
CATALOG_TYPES = {
    "S1": "String", "c": "char", "i1": "byte", "b": "byte", "B": "byte", "u1": "byte",
    "i2": "short", "h": "short", "u2": "short", "i4": "int", "i": "int", "l": "int", "u4": "int",
    "i8": "long", "u8": "long", "f4": "float", "f": "float", "f8": "double", "d": "double",
}


def catalog_type(dtype) -> Column:
    d = F.col(dtype) if isinstance(dtype, str) else dtype
    m = F.create_map(*[x for k, v in CATALOG_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, d)


def axis_conflicts(variables: DataFrame) -> DataFrame:
    """WIN-4: in a dataset with more than one vertical axis (depth first,
    then altitude, each in column order) every one after the first is a
    conflict."""
    dest = axis_field(F.col("name"), "destinationName")
    vertical = dest.isin("depth", "altitude")
    w = Window.partitionBy("dataset", "_vert").orderBy(F.when(dest == "depth", 0).otherwise(1), "pos")
    v = variables.withColumn("_vert", vertical)
    return (v.withColumn("_rank", F.when(F.col("_vert"), F.row_number().over(w)))
             .withColumn("conflict", F.coalesce(F.col("_rank") > 1, F.lit(False)))
             .drop("_vert", "_rank"))


def destination_name(name, conflict) -> Column:
    """FN-7."""
    n, c = (F.col(name) if isinstance(name, str) else name), (F.col(conflict) if isinstance(conflict, str)
                                                                else conflict)
    spec = axis_field(n, "destinationName")
    return (F.when(c, F.concat(F.lit("source_"), n))
             .when(spec.isNull() & F.lower(n).isin(*GENERIC_AXES), F.concat(F.lit("source_"), n))
             .when(spec.isNotNull(), spec)
             .otherwise(n))


def catalog_variables(variables: DataFrame) -> DataFrame:
    """(dataset, pos, name, dtype) -> destination, category, type, conflict."""
    v = axis_conflicts(variables)
    return v.select("dataset", "pos", "name", "dtype", "conflict",
                    destination_name("name", "conflict").alias("destination"),
                    category("name").alias("category"),
                    catalog_type("dtype").alias("data_type"))


def keywords(cat_vars: DataFrame) -> DataFrame:
    """AGG-12: comma-joined destination names in column order (one list
    per dataset, bounded by its column count)."""
    return (cat_vars.groupBy("dataset")
                    .agg(F.array_sort(F.collect_list(F.struct("pos", "destination"))).alias("_v"))
                    .select("dataset", F.array_join(F.transform("_v", lambda x: x["destination"]), ",")
                            .alias("keywords"), F.size("_v").alias("n_variables")))


def dataset_of_file(stem, virtual: bool = True) -> Column:
    """FN-8 / SET-4: paged files ``x_part3`` form one dataset ``x``."""
    s = F.col(stem) if isinstance(stem, str) else stem
    return part_base(s) if virtual else s


def group_parts(variables: DataFrame) -> DataFrame:
    """CAT-1: the files of a paged dataset (``x_part1``, ``x_part2``, ...)
    are one dataset ``x``; each of its columns stands once, at its first
    position and with the type it has there."""
    return (variables.withColumn("dataset", dataset_of_file("dataset")).groupBy("dataset", "name")
            .agg(F.min("pos").alias("pos"), F.min_by("dtype", "pos").alias("dtype")))


# Catalogue attribute fallbacks.
NO_INFO_URL = "Local source"
NO_CATALOG_SUMMARY = "No summary info available"


def build_catalog(datasets: DataFrame, cat_vars: DataFrame) -> DataFrame:
    """CAT-1: one record per dataset with its global attributes (an info
    URL and a summary fall back to fixed texts) and the nested, ordered
    variable list."""
    cols = set(datasets.columns)
    datasets = datasets.withColumn(
        "info_url", F.coalesce(F.col("link_url"), F.lit(NO_INFO_URL)) if "link_url" in cols else F.lit(NO_INFO_URL))
    datasets = datasets.withColumn(
        "summary", F.coalesce(F.col("summary"), F.lit(NO_CATALOG_SUMMARY)) if "summary" in cols
        else F.lit(NO_CATALOG_SUMMARY))
    # a location variable has a standard name, any other keeps its own attributes
    location = F.col("category") == "Location"
    fields = ["pos", "name", "destination", "data_type", "category",
              F.when(location, F.lower("name")).alias("standard_name")]
    if "attrs" in cat_vars.columns:  # entries, since maps have no order to sort by
        fields.append(F.when(~location, F.map_entries("attrs")).alias("attrs"))
    nested = (cat_vars.groupBy("dataset")
                      .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("variables")))
    kw = keywords(cat_vars)
    return datasets.join(nested, on="dataset", how="left").join(kw, on="dataset", how="left")


def write_catalog(catalog: DataFrame, path: str, fmt: str = "json") -> None:
    """SNK-5: JSON lines, or XML with one ``dataset`` element per row."""
    w = catalog.write.mode("overwrite")
    if fmt == "xml":
        w.format("xml").option("rootTag", "datasets").option("rowTag", "dataset").save(path)
    else:
        w.json(path)
