"""Objects per area: whole masks, sliding windows and their summary per patch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.operators.orderstats import quantiles
from tissuegrid.runtime import cut_lineage

# Order of the masks in a patch report, and the pixel column each one is read from.
REPORT_MASKS = {
    "cell": "cell_label",
    "nucleus": "nucleus_label",
    "repaired_cell": "cell_matched",
    "repaired_nucleus": "nucleus_matched",
    "unmatched_nucleus": "nucleus_unmatched",
}


def long_masks(pixels: DataFrame, masks: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """(keys, mask, y, x, label) with background left out."""
    parts = [F.struct(F.lit(m).alias("mask"), F.col(c).cast("bigint").alias("label")) for m, c in masks.items()]
    return (
        pixels.select(*keys, "y", "x", F.explode(F.array(*parts)).alias("_m"))
        .select(*keys, "y", "x", "_m.mask", "_m.label")
        .where("label > 0")
    )


def object_table(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per object: pixels and centroid. Everything later works on this small table."""
    return long.groupBy(*keys, "mask", "label").agg(
        F.count(F.lit(1)).alias("area"), F.avg("y").alias("cy"), F.avg("x").alias("cx")
    )


def mask_density(objects: DataFrame, keys: Sequence[str], mpp: float = 0.5) -> DataFrame:
    """Objects, mm² of labelled tissue and objects per mm², per mask."""
    mm2 = F.sum("area") * F.lit(mpp * mpp / 1e6)
    return objects.groupBy(*keys, "mask").agg(F.count(F.lit(1)).alias("nobj"), mm2.alias("areamm2")).withColumn(
        "density", F.coalesce(F.try_divide("nobj", "areamm2"), F.lit(0.0))
    )


def window_grid(extents: DataFrame, size: int, step: int) -> DataFrame:
    """Windows of each patch clipped at its edges; ``wi, wj`` number them."""
    rows = extents.withColumn("wi", F.explode(F.sequence(F.lit(0), F.floor((F.col("height") - 1) / step).cast("int"))))
    cells = rows.withColumn("wj", F.explode(F.sequence(F.lit(0), F.floor((F.col("width") - 1) / step).cast("int"))))
    h = F.least(F.lit(size), F.col("height") - F.col("wi") * step)
    w = F.least(F.lit(size), F.col("width") - F.col("wj") * step)
    return cells.withColumn("window_px", (h * w).cast("bigint"))


def in_windows(objects: DataFrame, size: int, step: int) -> DataFrame:
    """Each object with every window number that holds its centroid; no join needed."""
    def cover(c: str):
        last = F.floor(F.col(c) / step).cast("int")
        first = F.greatest(F.lit(0), (F.floor((F.col(c) - size) / step) + 1).cast("int"))
        return F.sequence(first, last) if step < size else F.array(last)

    spread = objects.withColumn("wi", F.explode(cover("cy"))).withColumn("wj", F.explode(cover("cx")))
    if step > size:
        spread = spread.where((F.col("cy") < F.col("wi") * step + size) & (F.col("cx") < F.col("wj") * step + size))
    return spread


def local_densities(objects: DataFrame, extents: DataFrame, masks: Sequence[str], keys: Sequence[str], mpp: float = 0.5, window_um: float = 200, step_um: float | None = None) -> DataFrame:
    """Centroids per mm² in each window, empty windows included.

    Centroids and extents are local to the patch.
    """
    keys = list(keys)
    size, step = int(window_um / mpp), int((step_um or window_um) / mpp)
    counts = in_windows(objects, size, step).groupBy(*keys, "mask", "wi", "wj").agg(F.count(F.lit(1)).alias("n"))
    grid = window_grid(extents.select(*keys, "height", "width"), size, step)
    grid = grid.withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks])))
    area = F.col("window_px") * F.lit(mpp * mpp / 1e6)
    return grid.join(counts, [*keys, "mask", "wi", "wj"], "left").select(
        *keys, "mask", "wi", "wj", (F.coalesce("n", F.lit(0)) / area).alias("local_density")
    )


def local_summary(local: DataFrame, keys: Sequence[str]) -> DataFrame:
    group = [*keys, "mask"]
    parts = local.groupBy(*group).agg(F.avg("local_density").alias("mean"), F.stddev_pop("local_density").alias("std"))
    cuts = quantiles(local, group, "local_density", {"median": 0.5, "quantile_25": 0.25, "quantile_75": 0.75})
    return parts.join(cuts, group)


def density_report(pixels: DataFrame, extents: DataFrame, keys: Sequence[str], masks: Mapping[str, str] = REPORT_MASKS, mpp: float = 0.5, window_um: float = 200, with_global: bool = True, with_local: bool = True) -> DataFrame:
    """Long (keys, mask, metric columns) report; either half can be switched off.

    Pixel coordinates are local to the patch.
    """
    keys = list(keys)
    objects = cut_lineage(object_table(long_masks(pixels, masks, keys), keys))
    names = F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")
    out = extents.select(*keys, names)
    group = [*keys, "mask"]
    if with_global:
        out = out.join(mask_density(objects, keys, mpp), group, "left")
        out = out.na.fill(0, ["nobj", "areamm2", "density"])
    if with_local:
        local = local_summary(local_densities(objects, extents, list(masks), keys, mpp, window_um), keys)
        renamed = local.select(*group, *[F.col(c).alias(f"local_density_{c}") for c in ("mean", "median", "std", "quantile_25", "quantile_75")])
        out = out.join(renamed, group, "left")
    return out


def attach_to_patches(patches: DataFrame, report: DataFrame, masks: Sequence[str] = tuple(REPORT_MASKS), key: str = "patch_id") -> DataFrame:
    """Wide metric columns ``{mask}_mask_{metric}`` joined to the patch table; unknown ones are 0."""
    metrics = [c for c in report.columns if c not in (key, "mask")]
    wide = report.groupBy(key).pivot("mask", list(masks)).agg(*[F.first(m).alias(m) for m in metrics])
    named = wide.select(key, *[F.coalesce(F.col(f"{k}_{m}"), F.lit(0)).alias(f"{k}_mask_{m}") for k in masks for m in metrics])
    return patches.join(named, key, "left")
