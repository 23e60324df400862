"""Cell tables across patches: unique channel names, global ids and coordinates, overviews, repair loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tissuegrid.operators.orderstats import positions

NUCLEUS_SUFFIX = "_nucleus_mean"
LEAD = ("cell_mask_id", "y", "x", "area")


def unique_channel_names(panel: DataFrame) -> DataFrame:
    """Second and later uses of a name get ``_n``; a suffixed name that is taken also gets its channel index."""
    turn = positions(panel, ["antibody_name"], "channel_idx", name="_n").withColumn("_n", F.col("_n") - 1)
    taken = panel.select(F.col("antibody_name").alias("_try")).distinct().withColumn("_taken", F.lit(True))
    proposed = turn.withColumn(
        "_try", F.when(F.col("_n") > 0, F.concat_ws("_", "antibody_name", F.col("_n").cast("string")))
    )
    checked = proposed.join(taken, "_try", "left")
    name = (
        F.when(F.col("_n") == 0, F.col("antibody_name"))
        .when(F.col("_taken"), F.concat("_try", F.lit("_"), F.col("channel_idx").cast("string")))
        .otherwise(F.col("_try"))
    )
    return checked.select("channel_idx", "antibody_name", name.alias("unique_name"))


def globalise(cells: DataFrame, patches: DataFrame, source: str, key: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """Global id text, global centroid and the local one kept beside it.

    ``keys`` name the image in both tables; ids then begin with it, so that they differ between images.
    """
    at = [*keys, "patch_id"]
    placed = cells.join(patches.select(*at, "y_start", "x_start"), at, "left")
    dy, dx = F.coalesce("y_start", F.lit(0)), F.coalesce("x_start", F.lit(0))
    return placed.select(
        *[c for c in cells.columns if c not in ("y", "x")],
        (F.col("y") + dy).alias("y"),
        (F.col("x") + dx).alias("x"),
        F.col("y").alias("patch_y"),
        F.col("x").alias("patch_x"),
        F.concat(*[p for k in keys for p in (F.col(k).cast("string"), F.lit("_"))], F.col(key).cast("string"), F.lit(f"_{source}_" if source else "_patch_"), F.col("patch_id").cast("string")).alias("global_cell_id"),
    )


def mask_ids(cells: DataFrame, offsets: DataFrame, key: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """Cell ids that keep rising from patch to patch of an image (``keys``)."""
    return cells.join(offsets.select(*keys, "patch_id", "label_offset"), [*keys, "patch_id"]).withColumn(
        "cell_mask_id", F.col(key) + F.col("label_offset")
    ).drop("label_offset")


def retained_fractions(after: DataFrame, before: DataFrame, matches: DataFrame, kind: str, keys: Sequence[str]) -> DataFrame:
    """Area kept by repair, looked up through the old label of each new one.

    ``after``: keys, new_label, area. ``before``: keys, label, area. ``matches``: keys, cell, nucleus, new_label.
    """
    keys = list(keys)
    old = matches.select(*keys, "new_label", F.col(kind).alias("label"))
    joined = after.join(old, [*keys, "new_label"], "left").join(
        before.select(*keys, "label", F.col("area").alias(f"{kind}_area_before")), [*keys, "label"], "left"
    )
    base = F.coalesce(F.col(f"{kind}_area_before"), F.lit(0)).cast("double")
    return joined.select(
        *keys,
        "new_label",
        F.col("area").alias(f"{kind}_area"),
        base.alias(f"{kind}_area_before"),
        F.coalesce(F.col("area") / F.greatest(base, F.lit(1e-6)), F.lit(0.0)).alias(f"{kind}_retained_fraction"),
    )


def with_trim_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("nucleus_was_trimmed", F.col("nucleus_retained_fraction") < 0.99)


def cell_overview(expression: DataFrame, metadata: DataFrame, markers: Sequence[str], key: str = "cell_mask_id") -> DataFrame:
    meta = metadata.select(key, "y", "x", F.col("cell_area").alias("area"))
    return expression.select(key, *markers).join(meta, key, "left").select(*LEAD, *markers)


def nucleus_overview(expression: DataFrame, metadata: DataFrame, markers: Sequence[str], key: str = "cell_mask_id") -> DataFrame:
    """Same layout with nucleus area and nucleus means; a marker without them keeps its whole-cell value."""
    has = {m for m in markers if f"{m}{NUCLEUS_SUFFIX}" in metadata.columns}
    meta = metadata.select(key, "y", "x", F.col("nucleus_area").alias("area"), *[f"{m}{NUCLEUS_SUFFIX}" for m in markers if m in has])
    joined = expression.select(key, *markers).join(meta, key, "left")
    return joined.select(*LEAD, *[F.col(f"{m}{NUCLEUS_SUFFIX}").alias(m) if m in has else F.col(m) for m in markers])


def move_marker(metadata: DataFrame, expression: DataFrame, marker: str, key: str = "cell_mask_id") -> tuple[DataFrame, DataFrame]:
    """(metadata with the marker, expression without it)."""
    if marker not in expression.columns:
        return metadata, expression
    return metadata.join(expression.select(key, marker), key, "left"), expression.drop(marker)


def keep_one(df: DataFrame, key: str, order: str, last: bool) -> DataFrame:
    """One row per key, the first or last by ``order``; ranking is cut off before the shuffle.

    Rows with one key and ``order`` are told apart by their other columns in order, so that reruns pick the same one.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    others = [F.col(c) for c in sorted(df.columns) if c not in (key, order) and kinds[c] not in ("map", "variant")]
    by = [F.col(order).desc() if last else F.col(order).asc(), *others]
    return df.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(*by))).where("_r = 1").drop("_r")


def refresh_area(overview: DataFrame, metadata: DataFrame, order: str, keys: Sequence[str] = ("cell_mask_id", "global_cell_id")) -> DataFrame:
    """Overview area replaced by metadata cell area through the first key both tables have."""
    key = next(k for k in keys if k in overview.columns and k in metadata.columns)
    lookup = keep_one(metadata.where(F.col("cell_area").isNotNull()), key, order, last=False)
    joined = overview.join(lookup.select(key, F.col("cell_area").cast("double").alias("_a")), key, "left")
    return joined.withColumn("area", F.coalesce("_a", F.col("area").cast("double"))).drop("_a").select(*overview.columns)


def rebuild_nucleus_overview(overview: DataFrame, metadata: DataFrame, order: str) -> DataFrame:
    """Nucleus overview from an existing overview and metadata that may repeat a cell (last row counts)."""
    lookup = keep_one(metadata, "cell_mask_id", order, last=True)
    markers = [c for c in overview.columns if c not in LEAD and c != "global_cell_id"]
    nuclear = {m: f"{m}{NUCLEUS_SUFFIX}" for m in markers if f"{m}{NUCLEUS_SUFFIX}" in metadata.columns}
    area = next((c for c in ("nucleus_area", "area") if c in metadata.columns), None)
    place = [c for c in ("y", "x") if c in metadata.columns]
    wanted = lookup.select(
        "cell_mask_id",
        *[F.col(c).alias(f"_{c}") for c in place],
        *([F.col(area).alias("_area")] if area else []),
        *[F.col(c).alias(f"_{m}") for m, c in nuclear.items()],
    )
    joined = overview.join(wanted, "cell_mask_id", "left")

    def pick(c: str, known: bool):
        return F.col(f"_{c}").alias(c) if known else F.col(c)

    return joined.select(
        "cell_mask_id", pick("y", "y" in place), pick("x", "x" in place), pick("area", area is not None),
        *[pick(m, m in nuclear) for m in markers],
    )


def missing_from(overview: DataFrame, metadata: DataFrame, key: str = "cell_mask_id") -> DataFrame:
    return overview.select(key).distinct().join(metadata.select(key), key, "left_anti")


def drop_legacy(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
