"""Writing stage tables, exports and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.operators.markers import fold_change_matrix, leading_features, significant


def by_partition(df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet") -> None:
    """One folder per key; rows of a key are written by as many tasks as hold them."""
    writer = df.write.mode("overwrite").partitionBy(*columns)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def profile_tables(tables: dict[str, DataFrame], folder: str, key: str = "patch_id") -> None:
    """cell_by_marker, cell_metadata and the overviews; partitioned where the patch is known."""
    for name, df in tables.items():
        if key in df.columns:
            by_partition(df, f"{folder}/{name}", [key])
        else:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path)


def marker_export(results: DataFrame, folder: str, alpha: float = 0.05) -> None:
    """Significant rows by cluster and direction, and the ten leading names of each as JSON lines."""
    kept = significant(results, alpha)
    by_partition(kept, f"{folder}/significant", ["cluster", "direction"])
    tops = leading_features(kept.where("direction = 'positive'")).select("cluster", F.col("features").alias("positive")).join(
        leading_features(kept.where("direction = 'negative'"), ascending=True).select("cluster", F.col("features").alias("negative")),
        "cluster", "full",
    )
    tops.write.mode("overwrite").json(f"{folder}/top_markers")


def matrix_export(results: DataFrame, folder: str, features: Sequence[str], top_n: int = 10, log1p: DataFrame | None = None) -> list[str]:
    """All eight fold-change matrices: log or not, raw or normalised, all markers or the top ones."""
    names = []
    for use_log in (True, False):
        for use_raw in (True, False):
            for n in (None, top_n):
                name = f"{'log_' if use_log else ''}fold_change{'_raw' if use_raw else ''}{f'_top{n}' if n else ''}"
                overwrite_table(fold_change_matrix(results, use_log, use_raw, n, None if n else features), f"{folder}/{name}")
                names.append(name)
    if log1p is not None:
        overwrite_table(log1p, f"{folder}/log1p")
        names.append("log1p")
    return names


def annotated_matrix(expression: DataFrame, observations: DataFrame, edges: DataFrame, folder: str) -> None:
    for name, df in (("expression", expression), ("obs", observations), ("edges", edges)):
        overwrite_table(df, f"{folder}/{name}")


def label_layers(pixels: DataFrame, layers: Sequence[str], path: str, keys: Sequence[str] = ()) -> None:
    """Sparse label table, one folder per image (``keys``), patch and layer."""
    parts = F.array(*[F.struct(F.lit(n).alias("layer"), F.col(n).cast("bigint").alias("label")) for n in layers])
    at = [*keys, "patch_id", "y", "x"]
    long = pixels.select(*at, F.explode(parts).alias("e")).select(*at, "e.layer", "e.label")
    by_partition(long.where("label > 0"), path, [*keys, "patch_id", "layer"])


def manifest(files: DataFrame) -> DataFrame:
    """(artifact, n_files, bytes, modified) per stage table of a folder listing."""
    parts = F.split("path", "/")
    at = F.regexp_extract("path", r"([^/]+)/(?:[^/]+=[^/]+/)*part-[^/]+$", 1)
    return files.where(at != "").groupBy(at.alias("artifact")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified")
    )


def one_json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def polygon_json(regions: DataFrame, group: str = "source") -> DataFrame:
    """One JSON document per annotation source: its shapes and their number."""
    shape = F.struct("label", F.transform("ring", lambda p: F.array(p["y"], p["x"])).alias("data"))
    docs = regions.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("region_id", shape.alias("s")))).alias("_s"))
    body = F.struct(F.transform("_s", lambda e: e["s"]).alias("shapes"), F.size("_s").alias("count"), F.col(group).alias("source"))
    return docs.select(group, F.to_json(body).alias("document"))


def selection_json(selected: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The shown patches (a handful) as one JSON text."""
    listed = F.array_sort(F.collect_list(F.struct(*columns)))
    return selected.agg(listed.alias("_p")).select(
        F.to_json(F.struct(F.size("_p").alias("n_selected"), F.col("_p").alias("patches"))).alias("document")
    )


def prediction_table(scored: DataFrame, path: str, fmt: str = "csv") -> None:
    n = scored.select(F.size("logits")).head()
    wide = scored.select("path", "predicted", *[F.col("logits")[i].alias(f"logit_{i}") for i in range(n[0] if n else 0)])
    overwrite_table(wide, path, fmt)
