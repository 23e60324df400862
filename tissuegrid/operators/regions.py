"""Polygons against pixels and tiles."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tissuegrid.functions.geometry import clipped, covered_area, fills, flat_of, flat_rings, ring_area, ring_bounds, rings_of, row_spans
from tissuegrid.operators import components, raster
from tissuegrid.runtime import cut_lineage

STRIP = 256
#: Polygons of one label in one square before it is quartered, and how often that may happen.
CROWD, MOST_QUARTERS = 64, 26


def with_area(regions: DataFrame) -> DataFrame:
    return regions.withColumn("area", F.expr(ring_area("ring")))


def with_bounds(regions: DataFrame) -> DataFrame:
    return regions.withColumns({k: F.expr(v) for k, v in ring_bounds("ring").items()})


def clip_to_image(regions: DataFrame, height, width, keys: Sequence[str] = ()) -> DataFrame:
    """Regions that touch the image, their vertices moved inside it."""
    inside = (F.col("max_y") >= 0) & (F.col("max_x") >= 0) & (F.col("min_y") < height) & (F.col("min_x") < width)
    ring = F.transform("ring", lambda p: F.struct(
        F.least(F.greatest(p["y"], F.lit(0.0)), (height - 1).cast("double")).alias("y"),
        F.least(F.greatest(p["x"], F.lit(0.0)), (width - 1).cast("double")).alias("x"),
    ))
    return with_bounds(regions).where(inside).select(*keys, "region_id", "label", ring.alias("ring"))


def spans(regions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, region_id, label, y, spans): which x belong to the region on each row."""
    placed = with_bounds(regions)
    rows = placed.withColumn(
        "y", F.explode(F.sequence(F.ceil("min_y").cast("int"), F.floor("max_y").cast("int")))
    )
    return rows.select(*keys, "region_id", "label", "y", F.expr(row_spans("ring", "y")).alias("spans")).where(F.size("spans") > 0)


def pixels_in_regions(pixels: DataFrame, regions: DataFrame, least: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Pixels of each region, border included; regions with fewer than ``least`` pixels are left out.

    ``keys`` name the image in both tables; a region only meets pixels of its own image. Regions become row spans cut
    into strips, so pixels meet them by equality on (image, row, strip).
    """
    rows = spans(regions, keys)
    lo = F.array_min(F.transform("spans", lambda s: s["lo"]))
    hi = F.array_max(F.transform("spans", lambda s: s["hi"]))
    strips = rows.withColumn("_s", F.explode(F.sequence(F.floor(lo / STRIP).cast("int"), F.floor(hi / STRIP).cast("int"))))
    hit = pixels.withColumn("_s", F.floor(F.col("x") / STRIP).cast("int")).join(strips, [*keys, "y", "_s"])
    hit = hit.where(F.exists("spans", lambda s: (F.col("x") >= s["lo"]) & (F.col("x") <= s["hi"]))).drop("_s", "spans")
    big = hit.groupBy(*keys, "region_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    return hit.join(big, [*keys, "region_id"], "left_semi")


def crops(pixels: DataFrame, regions: DataFrame, channels: Sequence[str], least: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Bounding-box crop of each region in local coordinates, zero outside the polygon."""
    keys = list(keys)
    inside = pixels_in_regions(pixels.select(*keys, "y", "x"), regions, least, keys)
    boxes = inside.groupBy(*keys, "region_id").agg(
        F.min("y").alias("_y0"), F.min("x").alias("_x0"), F.max("y").alias("_y1"), F.max("x").alias("_x1")
    )
    # Every position of the box is made once, then filled where the polygon holds it.
    rows = boxes.withColumn("y", F.explode(F.sequence("_y0", "_y1")))
    frame = rows.withColumn("x", F.explode(F.sequence("_x0", "_x1"))).drop("_y1", "_x1")
    values = inside.join(pixels.select(*keys, "y", "x", *channels), [*keys, "y", "x"]).select(*keys, "region_id", "y", "x", *channels)
    joined = frame.join(values, [*keys, "region_id", "y", "x"], "left")
    return joined.select(
        *keys,
        "region_id",
        (F.col("y") - F.col("_y0")).alias("crop_y"),
        (F.col("x") - F.col("_x0")).alias("crop_x"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in channels],
    )


def _cut_to_squares(parts: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep, y, x, side, flat, full): rings cut to their square; polygons without area in it go, copies count once."""

    def cut(batches):
        for batch in batches:
            flat, full = [], []
            places = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("y", "x", "side")]
            for rings, y, x, side in zip(batch.column(batch.schema.get_field_index("flat")), *places):
                kept = clipped(rings_of(rings.values.to_numpy(zero_copy_only=False)), y, x, y + side, x + side)
                flat.append(flat_of(kept))
                full.append(fills(kept, y, x, y + side, x + side))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in [*keep, "y", "x", "side"]]
            yield pa.record_batch([*columns, pa.array(flat, pa.list_(pa.float64())), pa.array(full, pa.bool_())], [*keep, "y", "x", "side", "flat", "full"])

    kinds = dict(parts.dtypes)
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in [*keep, "y", "x", "side"])
    done = parts.select(*keep, "y", "x", "side", "flat").mapInArrow(cut, f"{shape}, flat array<double>, full boolean")
    return done.where("size(flat) > 0").dropDuplicates([*keep, "y", "x", "side", "flat"])


def tile_label_areas(regions: DataFrame, tile: int, keys: Sequence[str] = (), crowd: int = CROWD) -> DataFrame:
    """(keys, ty, tx, label, area): area of each tile under the union of a label's polygons.

    A polygon only goes to the tiles its box touches, cut to each; ``rings`` holds the exterior and any holes. A square
    that one polygon fills is done. A square where more than ``crowd`` different ones meet is quartered, and so are its
    quarters: covered area adds up over the parts, and only edges are left to share a part. After 26 quarterings a square
    is 2 ** -52 of the tile, the last digit of its area; one still crowded, where edges meet in a point, counts with its
    largest polygon.
    """
    at = [*keys, "ty", "tx"]
    keep = [*at, "label"]
    corners = F.flatten("rings")
    boxed = regions.withColumns(
        {
            f"_{name}_{axis}": pick(corners.getField(axis))
            for name, pick in (("min", F.array_min), ("max", F.array_max))
            for axis in ("y", "x")
        }
    )

    def tiles_along(axis: str):
        first = F.floor(F.col(f"_min_{axis}") / tile)
        return F.sequence(first.cast("int"), F.greatest(first, F.ceil(F.col(f"_max_{axis}") / tile) - 1).cast("int"))

    spread = boxed.withColumn("ty", F.explode(tiles_along("y"))).withColumn("tx", F.explode(tiles_along("x")))
    spread = spread.select(*keep, (F.col("ty") * F.lit(float(tile))).alias("y"), (F.col("tx") * F.lit(float(tile))).alias("x"), F.lit(float(tile)).alias("side"), F.expr(flat_rings("rings")).alias("flat"))
    parts = cut_lineage(_cut_to_squares(spread, keep))
    square = [*keep, "y", "x", "side"]
    done = []
    for level in range(MOST_QUARTERS + 1):
        sizes = parts.groupBy(*square).agg(F.count("*").alias("_n"), F.max("full").alias("_full"))
        done.append(sizes.where("_full").select(*keep, (F.col("side") * F.col("side")).alias("area")))
        few = F.col("_n") <= crowd
        open_squares = sizes.where("NOT _full").withColumn("_few", few).select(*square, "_few")
        joined = parts.join(open_squares, square)
        done.append(_measured(joined.where("_few"), square, keep))
        many = joined.where("NOT _few")
        if many.isEmpty():
            break
        if level == MOST_QUARTERS:
            done.append(_measured(many, square + ["flat"], keep + square[len(keep):]).groupBy(*square).agg(F.max("area").alias("area")).select(*keep, "area"))
            break
        half = F.col("side") / 2
        corner = F.explode(F.array(*[F.struct((F.col("y") + i * half).alias("y"), (F.col("x") + j * half).alias("x")) for i in (0, 1) for j in (0, 1)]))
        quarters = many.select(*keep, half.alias("side"), "flat", corner.alias("_c")).select(*keep, F.col("_c.y").alias("y"), F.col("_c.x").alias("x"), "side", "flat")
        parts = cut_lineage(_cut_to_squares(quarters, keep))
    areas = done[0]
    for more in done[1:]:
        areas = areas.unionByName(more)
    return areas.groupBy(*keep).agg(F.sum("area").alias("area"))


def _measured(parts: DataFrame, square: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep, area) of each square from the polygons cut to it."""

    def areas(polygons: pd.Series, y: pd.Series, x: pd.Series, side: pd.Series) -> pd.Series:
        return pd.Series([covered_area([rings_of(f) for f in p], b, a, b + s, a + s) for p, b, a, s in zip(polygons, y, x, side)], dtype=float)

    grouped = parts.groupBy(*square).agg(F.collect_list("flat").alias("polygons"))
    return grouped.select(*keep, F.pandas_udf(areas, "double")("polygons", "y", "x", "side").alias("area"))


def label_tiles(tiles: DataFrame, regions: DataFrame, tile: int, least_tissue: float = 0.30, keys: Sequence[str] = ()) -> DataFrame:
    """One label per tile: too little tissue, else the label covering most, else ``Unlabeled``.

    Tissue only counts on images (``keys``) that have a tissue region at all.
    """
    at = [*keys, "ty", "tx"]
    areas = tile_label_areas(regions, tile, keys)
    tissue = F.lower("label") == "tissue"
    best = areas.groupBy(*at).agg(
        F.coalesce(F.sum(F.when(tissue, F.col("area"))), F.lit(0.0)).alias("tissue_area"),
        F.max(F.when(~tissue & (F.col("area") > 0), F.struct("area", "label"))).alias("_b"),
    )
    joined = tiles.join(best, at, "left")
    if keys:
        marked = regions.groupBy(*keys).agg(F.max(tissue.cast("int")).alias("_t"))
        joined, has_tissue = joined.join(marked, list(keys), "left"), F.col("_t")
    else:
        has_tissue = regions.agg(F.max(tissue.cast("int"))).scalar()
    share = F.coalesce("tissue_area", F.lit(0.0)) / F.lit(float(tile * tile))
    return joined.select(
        *tiles.columns,
        F.when((F.coalesce(has_tissue, F.lit(0)) == 1) & (share < least_tissue), "minimal_tissue")
        .otherwise(F.coalesce(F.col("_b.label"), F.lit("Unlabeled")))
        .alias("label"),
    )


def automatic_regions(preview: DataFrame, channel: str, factor: int, n: int, least_area: int, keys: Sequence[str] = ()) -> DataFrame:
    """Boxes, in full-size pixels, of the n largest bright areas of each preview image (``keys``).

    Every image has its own threshold, areas and places.
    """
    at = list(keys) or ["_image"]
    images = preview if keys else preview.withColumn("_image", F.lit(0))
    bright = images.join(raster.otsu_thresholds(images, channel, at), at).where(F.col(channel) >= F.col("threshold"))
    parts = components.connected_pixels(bright.select(*at, "y", "x"), at)
    boxes = parts.groupBy(*at, "component").agg(
        F.count(F.lit(1)).alias("area"),
        (F.min("y") * factor).alias("min_row"),
        (F.min("x") * factor).alias("min_col"),
        ((F.max("y") + 1) * factor).alias("max_row"),
        ((F.max("x") + 1) * factor).alias("max_col"),
    )
    largest = W.partitionBy(*at).orderBy(F.col("area").desc(), "component")
    placed = boxes.where(F.col("area") >= least_area).withColumn("place", F.row_number().over(largest)).where(F.col("place") <= n)
    return placed.drop("place", "_image")
