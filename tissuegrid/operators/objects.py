"""From labelled pixels to one row per object: intensity, spread and shape."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissuegrid.operators import raster


def label_sums(pixels: DataFrame, label: str, channels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Pixel count and channel sums per label."""
    return (
        pixels.where(F.col(label) > 0)
        .groupBy(*keys, F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n_pixels"), *[F.sum(c).alias(f"{c}_sum") for c in channels])
    )


def label_means(pixels: DataFrame, label: str, channels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return (
        pixels.where(F.col(label) > 0)
        .groupBy(*keys, F.col(label).alias("label"))
        .agg(*[F.avg(c).alias(c) for c in channels])
    )


def compartment_means(
    pixels: DataFrame,
    channels: Sequence[str],
    keys: Sequence[str],
    cell: str = "cell_label",
    nucleus: str = "nucleus_label",
    with_cov: bool = False,
    laplacian_suffix: str | None = None,
) -> DataFrame:
    """Whole-cell, nucleus and cytoplasm mean of every channel for labels that exist as nuclei.

    A pixel contributes to its cell's label and to its nucleus' label; when both are the same it
    stays one row. Everything is additive, so one partial-then-final aggregate does it.
    """
    same = F.col(cell) == F.col(nucleus)
    roles = F.array(
        F.struct(F.col(cell).alias("label"), F.lit(1).alias("c"), same.cast("int").alias("n")),
        F.struct(F.when(~same, F.col(nucleus)).alias("label"), F.lit(0).alias("c"), F.lit(1).alias("n")),
    )
    used = list(channels) + [f"{c}{laplacian_suffix}" for c in channels if laplacian_suffix]
    rows = pixels.select(*keys, *used, F.explode(roles).alias("_r")).where(F.col("_r.label") > 0)
    c, n = F.col("_r.c") == 1, F.col("_r.n") == 1
    aggs = [F.count_if(c).alias("_nc"), F.count_if(n).alias("_nn")]
    for ch in channels:
        aggs += [F.sum(F.when(c, F.col(ch))).alias(f"_c_{ch}"), F.sum(F.when(n, F.col(ch))).alias(f"_n_{ch}")]
        if with_cov:
            aggs.append(F.sum(F.when(c, F.col(ch) * F.col(ch))).alias(f"_q_{ch}"))
        if laplacian_suffix:
            aggs.append(F.sum(F.when(c, F.col(f"{ch}{laplacian_suffix}"))).alias(f"_l_{ch}"))
    sums = rows.groupBy(*keys, F.col("_r.label").alias("label")).agg(*aggs).where("_nn > 0")

    nc, nn = F.col("_nc"), F.col("_nn")

    def mean(total: Column, count: Column) -> Column:
        return F.coalesce(F.try_divide(total, count), F.lit(0.0))

    out = [F.col(k) for k in keys] + [F.col("label"), nc.alias("cell_area"), nn.alias("nucleus_area")]
    for ch in channels:
        cs, ns = F.coalesce(F.col(f"_c_{ch}"), F.lit(0.0)), F.col(f"_n_{ch}")
        whole = mean(cs, nc)
        out += [
            whole.alias(ch),
            mean(ns, nn).alias(f"{ch}_nucleus_mean"),
            F.when(nc > nn, (cs - ns) / (nc - nn)).alias(f"{ch}_cytoplasm_mean"),
        ]
        if with_cov:
            var = F.greatest(mean(F.col(f"_q_{ch}"), nc) - whole * whole, F.lit(0.0))
            out.append((F.sqrt(var) / (whole + 1e-8)).alias(f"{ch}_cov"))
        if laplacian_suffix:
            out.append(mean(F.col(f"_l_{ch}"), nc).alias(f"{ch}_laplacian_var"))
    return sums.select(*out)


def cell_features(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str], laplacian: bool = False, cov: bool = False) -> DataFrame:
    """compartment_means with the optional spread measures worked out first."""
    if laplacian:
        pixels = raster.laplacian(pixels, channels, keys)
    return compartment_means(pixels, channels, keys, with_cov=cov, laplacian_suffix="_laplacian" if laplacian else None)


# --- shape -------------------------------------------------------------------------------------


def moments(pixels: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Area, centroid, axis lengths and eccentricity from first and second moments."""
    m = (
        pixels.where(F.col(label) > 0)
        .groupBy(*keys, F.col(label).alias("label"))
        .agg(
            F.count(F.lit(1)).alias("area"),
            F.avg("y").alias("y"),
            F.avg("x").alias("x"),
            F.var_pop("y").alias("_vy"),
            F.var_pop("x").alias("_vx"),
            F.covar_pop("y", "x").alias("_c"),
        )
    )
    half = (F.col("_vy") + F.col("_vx")) / 2
    root = F.sqrt(F.pow((F.col("_vy") - F.col("_vx")) / 2, 2) + F.pow("_c", 2))
    long, short = half + root, F.greatest(half - root, F.lit(0.0))
    squeeze = F.coalesce(F.try_divide(short, long), F.lit(1.0))
    return m.select(
        *keys,
        "label",
        "area",
        "y",
        "x",
        (4 * F.sqrt(long)).alias("axis_major_length"),
        (4 * F.sqrt(short)).alias("axis_minor_length"),
        F.sqrt(F.greatest(1 - squeeze, F.lit(0.0))).alias("eccentricity"),
    )


def own_border(pixels: DataFrame, label: str, keys: Sequence[str], tile: int = raster.TILE) -> DataFrame:
    """Pixels of an object with a side on anything else, the outside of the image included."""
    near = raster.with_neighbours(pixels.where(F.col(label) > 0).select(*keys, "y", "x", label), keys, [label], tile)
    inside = [F.coalesce(F.col(f"{s}.{label}") == F.col(label), F.lit(False)) for s in raster.SIDES]
    return near.where(~(inside[0] & inside[1] & inside[2] & inside[3])).select(*keys, "y", "x", label)


def perimeter(pixels: DataFrame, label: str, keys: Sequence[str], tile: int = raster.TILE) -> DataFrame:
    """Border length: each border pixel weighs by which of its neighbours are border pixels too.

    The pattern code counts sides twice, corners ten times and the pixel itself once.
    """
    border = own_border(pixels, label, keys, tile)
    near = raster.with_neighbours(border, keys, [label], tile)

    def own(path: str) -> Column:
        return F.coalesce((F.col(f"{path}.{label}") == F.col(label)).cast("int"), F.lit(0))

    sides = own("left") + own("right") + own("up") + own("down")
    corners = _corner_count(border, label, keys)
    code = 1 + 2 * F.col("_sides") + 10 * F.coalesce(F.col("_corners"), F.lit(0))
    # Pattern codes and the length each stands for.
    length = (
        F.when(code.isin(5, 7, 15, 17, 25, 27), 1.0)
        .when(code.isin(21, 33), F.lit(2.0**0.5))
        .when(code.isin(13, 23), F.lit((1 + 2.0**0.5) / 2))
        .otherwise(0.0)
    )
    scored = near.withColumn("_sides", sides).join(corners, [*keys, "y", "x"], "left")
    return scored.groupBy(*keys, F.col(label).alias("label")).agg(F.sum(length).alias("perimeter"))


def _corner_count(border: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """How many of the four corner neighbours of a position hold the same label as the pixel there."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 1) for dx in (-1, 1)])
    sent = border.select(*keys, "y", "x", label, F.explode(steps).alias("s")).select(
        *keys, (F.col("y") + F.col("s.dy")).alias("y"), (F.col("x") + F.col("s.dx")).alias("x"), F.col(label).alias("_l"), F.lit(1).alias("_k")
    )
    here = border.select(*keys, "y", "x", F.col(label).alias("_l"), F.lit(0).alias("_k"))
    counted = here.unionByName(sent).groupBy(*keys, "y", "x", "_l").agg(F.min("_k").alias("_own"), F.sum("_k").alias("_corners"))
    return counted.where("_own = 0").select(*keys, "y", "x", "_corners")


def _hull_pixels(ys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> int:
    """Pixels whose centre lies in the hull of an object given by its extent in each row."""
    y = np.concatenate([ys, ys, ys - 0.5, ys + 0.5, ys - 0.5, ys + 0.5])
    x = np.concatenate([lo - 0.5, hi + 0.5, lo, lo, hi, hi])

    def chain(sign: float) -> tuple[np.ndarray, np.ndarray]:
        """Outermost chain over y: the concave envelope of sign · x."""
        order = np.lexsort((-sign * x, y))
        py, px = y[order], sign * x[order]
        first = np.concatenate([[True], py[1:] != py[:-1]])
        py, px = py[first], px[first]
        hull: list[int] = []
        for i in range(len(py)):
            while len(hull) > 1:
                a, b = hull[-2], hull[-1]
                if (px[b] - px[a]) * (py[i] - py[a]) <= (px[i] - px[a]) * (py[b] - py[a]):
                    hull.pop()
                else:
                    break
            hull.append(i)
        return py[hull], sign * px[hull]

    rows = np.arange(ys.min(), ys.max() + 1)
    right = np.interp(rows, *chain(1.0))
    left = np.interp(rows, *chain(-1.0))
    return int(np.maximum(np.floor(right + 1e-10) - np.ceil(left - 1e-10) + 1, 0).sum())


def _hull_areas(spans: pd.Series) -> pd.Series:
    def one(rows) -> int:
        a = np.array([(r["y"], r["lo"], r["hi"]) for r in rows], dtype=float)
        return _hull_pixels(a[:, 0], a[:, 1], a[:, 2])

    return spans.map(one)


def convex_area(pixels: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Hull area; an object is first cut down to its two outermost pixels per row."""
    spans = (
        pixels.where(F.col(label) > 0)
        .groupBy(*keys, F.col(label).alias("label"), "y")
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"))
    )
    per_object = spans.groupBy(*keys, "label").agg(F.collect_list(F.struct("y", "lo", "hi")).alias("s"), F.sum("n").alias("n"))
    area = per_object.withColumn("convex_area", F.pandas_udf(_hull_areas, "long")("s"))
    return area.select(*keys, "label", "convex_area", (F.col("n") / F.col("convex_area")).alias("solidity"))


PROPERTIES = {
    "moments": moments,
    "perimeter": perimeter,
    "convex_area": convex_area,
}


def region_properties(pixels: DataFrame, label: str, keys: Sequence[str], parts: Sequence[str] = tuple(PROPERTIES)) -> DataFrame:
    """All asked-for property groups of each object in one row."""
    tables = [PROPERTIES[p](pixels, label, keys) for p in parts]
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, [*keys, "label"])
    return out


def nucleus_with_cell(nuclei: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Nucleus properties with those of the cell of the same label; a missing cell gives NULLs."""
    def named(df: DataFrame, prefix: str) -> DataFrame:
        fixed = [*keys, "label"]
        return df.select(*fixed, *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in fixed])

    return named(nuclei, "nucleus").join(named(cells, "cell"), [*keys, "label"], "left")


def nucleus_cell_ratio(joined: DataFrame) -> DataFrame:
    """Area ratio for rows where both areas are known and not zero."""
    usable = (F.col("nucleus_area") > 0) & (F.col("cell_area") > 0)
    return joined.where(usable).withColumn("nc_ratio", F.col("nucleus_area") / F.col("cell_area"))


def error_flags(pixels: DataFrame, keys: Sequence[str], oversized: float = 2000, undersized: float = 50, eccentric: float = 0.95) -> DataFrame:
    """Suspicious cells: too big, too small, too long, or not holding exactly one nucleus."""
    shape = moments(pixels, "cell_label", keys).select(*keys, "label", "area", "eccentricity")
    held = (
        pixels.where(F.col("cell_label") > 0)
        .groupBy(*keys, F.col("cell_label").alias("label"))
        .agg(
            F.coalesce(F.min(F.when(F.col("nucleus_label") > 0, F.col("nucleus_label"))), F.lit(-1)).alias("_lo"),
            F.coalesce(F.max(F.when(F.col("nucleus_label") > 0, F.col("nucleus_label"))), F.lit(-2)).alias("_hi"),
        )
    )
    return shape.join(held, [*keys, "label"]).select(
        *keys,
        "label",
        (F.col("area") > oversized).alias("oversized"),
        (F.col("area") < undersized).alias("undersized"),
        (F.col("eccentricity") > eccentric).alias("high_eccentricity"),
        (F.col("_lo") != F.col("_hi")).alias("unmatched"),
    )
