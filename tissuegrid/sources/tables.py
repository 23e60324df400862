"""Reading the engine's tables: cell tables, panels, patches, pixels and stored stages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

PANEL = T.StructType([T.StructField("version", T.StringType()), T.StructField("channel_id", T.StringType()), T.StructField("antibody_name", T.StringType())])
PATCHES = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("patch_id", "y_start", "x_start", "patch_height", "patch_width")]
)


def _schema_from_header(spark: SparkSession, path: str, sep: str, text: set[str]) -> T.StructType:
    """Column names from the header; everything is a double but known text columns. No pass over the data."""
    names = spark.read.csv(path, header=True, inferSchema=False, sep=sep).columns
    return T.StructType([T.StructField(n, T.StringType() if n in text else T.DoubleType()) for n in names])


TEXT_COLUMNS = {"global_cell_id", "cluster", "antibody_name"}


def scan_table(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema: T.StructType | None = None, patch: int | None = None) -> DataFrame:
    """Cell metadata or expression; with a patch number only that patch is read when files are partitioned by it."""
    if fmt == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(*([path] if isinstance(path, str) else path))
    else:
        first = path if isinstance(path, str) else path[0]
        schema = schema or _schema_from_header(spark, first, ",", TEXT_COLUMNS)
        df = spark.read.csv(path if isinstance(path, str) else list(path), header=True, schema=schema)
    return df if patch is None else df.where(F.col("patch_id") == patch)


def scan_all(spark: SparkSession, paths: Iterable[str], fmt: str = "csv") -> DataFrame:
    """Union of patch files whose columns may differ; files that cannot be found are left out."""
    frames = []
    for p in paths:
        try:
            frames.append(scan_table(spark, p, fmt))
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    if not frames:
        raise FileNotFoundError("no patch file found")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_glob(spark: SparkSession, folder: str, pattern: str, schema: T.StructType) -> DataFrame:
    """All files of a name pattern; malformed rows are dropped and the source file is kept."""
    df = spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", pattern).csv(folder)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def with_line_number(df: DataFrame, name: str) -> DataFrame:
    """A column that numbers the rows of a file scan from 0: file after file by path, line after line.

    Tasks read splits of files in line order; lines are numbered inside their split, and splits by the rows of those
    before them. Only the list of splits passes through one task.
    """
    splits = ["_file", "_start"]
    read = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"))
    before = W.orderBy(*splits).rowsBetween(W.unboundedPreceding, -1)
    offsets = read.groupBy(*splits).agg(F.count("*").alias("_rows")).select(*splits, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy(*splits).orderBy("_line"))
    return read.join(offsets, splits).withColumn(name, F.col("_before") + within - 1).drop(*splits, "_line", "_before")


def scan_panel(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated channel panel of one or more files; the line order becomes an explicit channel index."""
    df = with_line_number(spark.read.csv(path, sep="\t", header=True, inferSchema=False), "channel_idx")
    return df.withColumn("channel_idx", F.col("channel_idx").cast("int"))


def scan_patches(spark: SparkSession, path: str, schema: T.StructType = PATCHES) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def scan_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Experiment sheet: every column a text, rows numbered from 0 in file order."""
    return with_line_number(spark.read.csv(path, header=True, inferSchema=False), "row_index")


def scan_pixels(spark: SparkSession, path: str, box: tuple[int, int, int, int] | None = None, channels: Sequence[str] | None = None, every: int = 1) -> DataFrame:
    """Pixels of a half-open box (y0, y1, x0, x1), some channels, every n-th row and column.

    All three are plain filters and column picks, so they reach the file scan.
    """
    df = spark.read.parquet(path)
    if box is not None:
        y0, y1, x0, x1 = box
        df = df.where((F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1))
    if channels is not None:
        fixed = [c for c in ("image_id", "patch_id", "y", "x") if c in df.columns]
        df = df.select(*fixed, *[c for c in channels if c not in fixed])
    if every > 1:
        df = df.where((F.col("y") % every == 0) & (F.col("x") % every == 0))
    return df


def write_pixels(pixels: DataFrame, path: str, tile: int = 1024) -> None:
    """Pixels stored by tile row and sorted inside, so that box scans skip files and row groups."""
    strip = F.floor(F.col("y") / tile).cast("int")
    column = F.floor(F.col("x") / tile).cast("int")
    placed = pixels.withColumn("_row", strip).withColumn("_col", column)
    placed.repartition("_row", "_col").sortWithinPartitions("_row", "_col", "y", "x").drop("_row", "_col").write.parquet(path)


def resume(spark: SparkSession, folder: str, expected: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Stored stage tables by name; a table with an unexpected number of rows stops the run."""
    expected = expected or {}
    out = {}
    for name in ("panel", "patches", "labels_original", "labels_repaired", "manifest"):
        try:
            out[name] = spark.read.parquet(f"{folder}/{name}")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        if name in expected and out[name].count() != expected[name]:
            raise ValueError(f"{name}: row count differs from the manifest")
    return out
