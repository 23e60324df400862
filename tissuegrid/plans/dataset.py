"""The engine's tables as views over the supplied relational tables.

Each view exists twice: as a DataFrame and as a common table expression for the other engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKERS = ["quantity", "price", "discount", "tax"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- cells: one row per order, four markers ---------------------------------------------------

CELLS_SQL = """cells AS (
  SELECT l_orderkey AS cell_mask_id, max(l_quantity) AS quantity, max(l_extendedprice) AS price,
         max(abs(l_discount)) AS discount, max(abs(l_tax)) AS tax,
         CAST(l_orderkey % 7 AS INTEGER) AS patch_id,
         'fov_patch_' || CAST(l_orderkey % 7 AS VARCHAR) AS global_cell_id
  FROM lineitem GROUP BY l_orderkey)"""


def cells(spark, folder) -> DataFrame:
    line = table(spark, folder, "lineitem")
    patch = (F.col("cell_mask_id") % 7).cast("int")
    return (
        line.groupBy(F.col("l_orderkey").alias("cell_mask_id"))
        .agg(
            F.max("l_quantity").alias("quantity"),
            F.max("l_extendedprice").alias("price"),
            F.max(F.abs("l_discount")).alias("discount"),
            F.max(F.abs("l_tax")).alias("tax"),
        )
        .withColumn("patch_id", patch)
        .withColumn("global_cell_id", F.concat(F.lit("fov_patch_"), F.col("patch_id").cast("string")))
    )


CLUSTERS_SQL = """clusters AS (
  SELECT o_orderkey AS cell_mask_id, nullif(o_orderpriority, '3-MEDIUM') AS cluster FROM orders)"""


def clusters(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders")
    level = F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))
    return orders.select(F.col("o_orderkey").alias("cell_mask_id"), level.alias("cluster"))


# --- measurements: every line, four markers in long form --------------------------------------

LONG_SQL = """long AS (
  SELECT l_returnflag AS cluster, 'quantity' AS feature, l_quantity AS v FROM lineitem
  UNION ALL SELECT l_returnflag, 'price', l_extendedprice FROM lineitem
  UNION ALL SELECT l_returnflag, 'discount', abs(l_discount) FROM lineitem
  UNION ALL SELECT l_returnflag, 'tax', abs(l_tax) FROM lineitem)"""


def measurements(spark, folder) -> DataFrame:
    line = table(spark, folder, "lineitem")
    return line.select(
        F.col("l_returnflag").alias("cluster"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.abs("l_discount").alias("discount"),
        F.abs("l_tax").alias("tax"),
    )


def long_measurements(spark, folder) -> DataFrame:
    wide = measurements(spark, folder)
    return wide.unpivot(["cluster"], MARKERS, "feature", "v").withColumn("raw", F.col("v"))


# --- pixels: a raster 50 wide with cell and nucleus labels ------------------------------------

PIXELS_SQL = """raw_px AS (
  SELECT CAST(p_partkey // 50 AS INTEGER) AS y, CAST(p_partkey % 50 AS INTEGER) AS x,
         CAST(p_size AS DOUBLE) AS v0, p_retailprice AS v1 FROM part),
px AS (
  SELECT *, CAST((y // 20) * 2 + x // 25 AS INTEGER) AS patch_id,
    CASE WHEN y % 5 < 4 AND x % 5 < 4 AND NOT (y % 5 = 0 AND x % 5 = 0 AND v0 % 2 = 0)
         THEN CAST((y // 5) * 10 + x // 5 + 1 AS BIGINT) ELSE 0 END AS cell_label,
    CASE WHEN (y // 5) % 4 = 3 AND (x // 5) % 5 = 4 THEN 0
         WHEN (x // 5) % 3 = 0 AND y % 5 = 1 AND x % 5 = 1
         THEN CAST(3 * ((y // 5) * 10 + x // 5) + 2 AS BIGINT)
         WHEN (y + (x // 5) % 2) % 5 IN (1, 2) AND x % 5 IN (1, 2)
         THEN CAST(3 * (((y + (x // 5) % 2) // 5) * 10 + x // 5) + 1 AS BIGINT)
         ELSE 0 END AS nucleus_label
  FROM raw_px)"""


def pixels(spark, folder) -> DataFrame:
    part = table(spark, folder, "part")
    raw = part.select(
        F.expr("CAST(p_partkey DIV 50 AS INT)").alias("y"),
        F.expr("CAST(p_partkey % 50 AS INT)").alias("x"),
        F.col("p_size").cast("double").alias("v0"),
        F.col("p_retailprice").alias("v1"),
    )
    return raw.select(
        "*",
        F.expr("CAST((y DIV 20) * 2 + x DIV 25 AS INT)").alias("patch_id"),
        F.expr(
            """CASE WHEN y % 5 < 4 AND x % 5 < 4 AND NOT (y % 5 = 0 AND x % 5 = 0 AND v0 % 2 = 0)
                    THEN (y DIV 5) * 10 + x DIV 5 + 1 ELSE 0L END"""
        ).alias("cell_label"),
        F.expr(
            """CASE WHEN (y DIV 5) % 4 = 3 AND (x DIV 5) % 5 = 4 THEN 0L
                    WHEN (x DIV 5) % 3 = 0 AND y % 5 = 1 AND x % 5 = 1
                    THEN 3 * ((y DIV 5) * 10 + x DIV 5) + 2
                    WHEN (y + (x DIV 5) % 2) % 5 IN (1, 2) AND x % 5 IN (1, 2)
                    THEN 3 * (((y + (x DIV 5) % 2) DIV 5) * 10 + x DIV 5) + 1
                    ELSE 0L END"""
        ).alias("nucleus_label"),
    )


# --- regions: one four-cornered polygon per supplier ------------------------------------------

REGIONS_SQL = """regions AS (
  SELECT s_suppkey AS region_id, CASE WHEN s_nationkey % 5 = 0 THEN 'Tissue' ELSE 'N' || CAST(s_nationkey % 5 AS VARCHAR) END AS label,
         CAST(s_suppkey // 3 AS DOUBLE) AS y0, CAST((s_suppkey * 11) % 43 AS DOUBLE) AS x0 FROM supplier),
corners AS (
  SELECT region_id, label, 0 AS pos, y0 AS y, x0 AS x FROM regions
  UNION ALL SELECT region_id, label, 1, y0 + 6, x0 + 1 FROM regions
  UNION ALL SELECT region_id, label, 2, y0 + 7, x0 + 6 FROM regions
  UNION ALL SELECT region_id, label, 3, y0 + 1, x0 + 7 FROM regions)"""


def regions(spark, folder) -> DataFrame:
    """region_id, label, ring array<struct<y,x>>."""
    supplier = table(spark, folder, "supplier")
    placed = supplier.select(
        F.col("s_suppkey").alias("region_id"),
        F.when(F.col("s_nationkey") % 5 == 0, "Tissue")
        .otherwise(F.concat(F.lit("N"), (F.col("s_nationkey") % 5).cast("string")))
        .alias("label"),
        F.expr("CAST(s_suppkey DIV 3 AS DOUBLE)").alias("y0"),
        F.expr("CAST((s_suppkey * 11) % 43 AS DOUBLE)").alias("x0"),
    )
    ring = F.expr(
        """array(named_struct('y', y0, 'x', x0), named_struct('y', y0 + 6, 'x', x0 + 1),
                 named_struct('y', y0 + 7, 'x', x0 + 6), named_struct('y', y0 + 1, 'x', x0 + 7))"""
    )
    return placed.select("region_id", "label", ring.alias("ring"))
