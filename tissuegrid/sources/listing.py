"""What lies in a folder: layouts, class folders, experiments and reports. File contents are never read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissuegrid.operators.orderstats import numbered


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of all files below a folder."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        .load(folder).select("path", "length", "modificationTime")
    )


def layout(files: DataFrame) -> DataFrame:
    """One row (layout, n_patches): merged table, patch files, or neither."""
    name = F.element_at(F.split("path", "/"), -1)
    merged = F.max(name.rlike(r"^cell_metadata\.(csv|parquet)$").cast("int"))
    patch = F.regexp_extract(name, r"^patch-(\d+)-cell_metadata\.(csv|parquet)$", 1)
    n = F.count_distinct(F.when(patch != "", patch))
    return files.agg(F.coalesce(merged, F.lit(0)).alias("_m"), n.alias("n_patches")).select(
        F.when(F.col("_m") == 1, "merged").when(F.col("n_patches") > 0, "patches").otherwise("unknown").alias("layout"), "n_patches"
    )


def class_folders(files: DataFrame, root: str, extensions: Sequence[str] = (".tif", ".tiff")) -> DataFrame:
    """(path, class_name, label): label is the rank of the first folder below root; a flat root gives 0."""
    ends = F.lower("path").rlike("(" + "|".join(e.replace(".", r"\.") for e in extensions) + ")$")
    rest = F.regexp_replace("path", f"^.*{root}/", "")
    folder = F.when(F.instr(rest, "/") > 0, F.split_part(rest, F.lit("/"), F.lit(1)))
    named = files.where(ends).select("*", folder.alias("class_name"))
    classes = numbered(named.where(F.col("class_name").isNotNull()).select("class_name").distinct(), ["class_name"], "place")
    label = F.coalesce(F.col("place").cast("int") - 1, F.lit(0))
    return named.join(classes, "class_name", "left").withColumn("label", label).drop("place")


def pick_experiments(experiments: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = (), column: str = "exp_id") -> DataFrame:
    out = experiments if not include else experiments.where(F.col(column).isin(*include))
    return out.where(~F.col(column).isin(*exclude)) if exclude else out


def reports(files: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """(exp_id, report_type, file_size, modified, dest_filename) of known report files, one folder per experiment."""
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    kind = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    known = files.where(name.isin(*types)).select(
        F.element_at(parts, -2).alias("exp_id"), F.try_element_at(kind, name).alias("report_type"),
        F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"),
    )
    return known.withColumn("dest_filename", F.concat("exp_id", F.lit("_"), "report_type", F.lit(".html")))


def with_cell_counts(found: DataFrame, overview: DataFrame, patches: DataFrame) -> DataFrame:
    """Cells per experiment: rows of the overview, else the patch table's n_cells, else NULL."""
    rows = overview.groupBy("exp_id").agg(F.count(F.lit(1)).alias("_rows"))
    sums = patches.groupBy("exp_id").agg(F.sum("n_cells").alias("_sum"))
    return found.join(rows, "exp_id", "left").join(sums, "exp_id", "left").withColumn(
        "cell_count", F.coalesce("_rows", "_sum")
    ).drop("_rows", "_sum")


def report_index(found: DataFrame) -> DataFrame:
    return found.orderBy("exp_id", "report_type")
