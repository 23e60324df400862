"""Per-pixel operators: neighbours, boundaries, stencils, thresholds and resampling.

Neighbour lookups cut the image into square tiles. A pixel near a tile edge is also sent
to the tile next door, so one shuffle by tile serves both the row and the column window, and no
task ever holds more than a tile however large the image is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

TILE = 256


def in_tiles(pixels: DataFrame, keys: Sequence[str], tile: int = TILE, halo: int = 1) -> DataFrame:
    def span(c: str) -> Column:
        return F.sequence(F.floor((F.col(c) - halo) / tile), F.floor((F.col(c) + halo) / tile))

    copied = pixels.withColumn("_ty", F.explode(span("y"))).withColumn("_tx", F.explode(span("x")))
    return copied.repartition(*keys, "_ty", "_tx")


def at_home(tiled: DataFrame, tile: int = TILE) -> DataFrame:
    home = (F.floor(F.col("y") / tile) == F.col("_ty")) & (F.floor(F.col("x") / tile) == F.col("_tx"))
    return tiled.where(home).drop("_ty", "_tx")


def with_neighbours(pixels: DataFrame, keys: Sequence[str], values: Sequence[str], tile: int = TILE) -> DataFrame:
    """Add ``left``, ``right``, ``up``, ``down`` structs of the values; NULL where there is no pixel."""
    keys = list(keys)
    tiled = in_tiles(pixels, keys, tile)
    row = W.partitionBy(*keys, "_ty", "_tx", "y").orderBy("x")
    col = W.partitionBy(*keys, "_ty", "_tx", "x").orderBy("y")
    body = F.struct(*values)

    def shifted(axis: str, content: Column, w, by: int) -> Column:
        place = F.lag(axis).over(w) if by < 0 else F.lead(axis).over(w)
        held = F.lag(content).over(w) if by < 0 else F.lead(content).over(w)
        return F.when(place == F.col(axis) + by, held)

    sided = tiled.withColumn("left", shifted("x", body, row, -1)).withColumn("right", shifted("x", body, row, 1))
    full = sided.withColumn("up", shifted("y", body, col, -1)).withColumn("down", shifted("y", body, col, 1))
    return at_home(full, tile)


SIDES = ("left", "right", "up", "down")


def inner_boundary(pixels: DataFrame, label: str, keys: Sequence[str], name: str = "boundary", tile: int = TILE) -> DataFrame:
    """``name`` keeps the label of labelled pixels beside another value; the image edge is no boundary."""
    near = with_neighbours(pixels, keys, [label], tile)
    differs = [F.coalesce(F.col(f"{s}.{label}") != F.col(label), F.lit(False)) for s in SIDES]
    flag = (F.col(label) > 0) & (differs[0] | differs[1] | differs[2] | differs[3])
    return near.withColumn(name, F.when(flag, F.col(label)).otherwise(F.lit(0))).drop(*SIDES)


def outer_boundary(pixels: DataFrame, label: str, keys: Sequence[str], tile: int = TILE) -> DataFrame:
    """``outer``: background beside a label. ``thick``: the cross neighbourhood holds several values."""
    near = with_neighbours(pixels, keys, [label], tile)
    around = [F.coalesce(F.col(f"{s}.{label}"), F.col(label)) for s in SIDES]
    top, low = F.greatest(F.col(label), *around), F.least(F.col(label), *around)
    return (
        near.withColumn("outer", (F.col(label) == 0) & (top > 0)).withColumn("thick", top != low).drop(*SIDES)
    )


def laplacian(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str], tile: int = TILE, suffix: str = "_laplacian") -> DataFrame:
    """Size of the five-point stencil; the edge pixel stands in for what lies beyond it."""
    near = with_neighbours(pixels, keys, channels, tile)
    for c in channels:
        around = [F.coalesce(F.col(f"{s}.{c}"), F.col(c)) for s in SIDES]
        near = near.withColumn(f"{c}{suffix}", F.abs(4 * F.col(c) - around[0] - around[1] - around[2] - around[3]))
    return near.drop(*SIDES)


def max_projection(pixels: DataFrame, channels: Sequence[str], name: str = "wholecell") -> DataFrame:
    cols = [F.col(c) for c in channels]
    return pixels.withColumn(name, F.greatest(*cols) if len(cols) > 1 else cols[0])


def above_mean(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """1 where a channel exceeds its mean over the patch, their number, and whether any does."""
    keys = list(keys)
    means = pixels.groupBy(*keys).agg(*[F.avg(c).alias(f"_mean_{c}") for c in channels])
    marked = pixels.join(means, keys)
    for c in channels:
        marked = marked.withColumn(f"{c}_above", (F.col(c) > F.col(f"_mean_{c}")).cast("int"))
    total = sum((F.col(f"{c}_above") for c in channels), F.lit(0))
    return (
        marked.withColumn("n_above", total)
        .withColumn("foreground", F.signum(F.col("n_above")).cast("int"))
        .drop(*[f"_mean_{c}" for c in channels])
    )


def pyramid(pixels: DataFrame, levels: int) -> DataFrame:
    """Every second row and column per level; level 0 is the image itself."""
    def on(c: str, level: Column) -> Column:
        return F.pmod(F.col(c), F.pow(F.lit(2), level).cast("int")) == 0

    kept = F.filter(F.sequence(F.lit(0), F.lit(levels)), lambda l: on("y", l) & on("x", l))
    side = F.pow(F.lit(2), F.col("level")).cast("int")
    return (
        pixels.withColumn("level", F.explode(kept))
        .withColumn("y", F.floor(F.col("y") / side).cast("int"))
        .withColumn("x", F.floor(F.col("x") / side).cast("int"))
    )


def stride(pixels: DataFrame, k: int) -> DataFrame:
    """Nearest sampling: every k-th row and column."""
    on = (F.pmod(F.col("y"), F.lit(k)) == 0) & (F.pmod(F.col("x"), F.lit(k)) == 0)
    return (
        pixels.where(on)
        .withColumn("y", F.floor(F.col("y") / k).cast("int"))
        .withColumn("x", F.floor(F.col("x") / k).cast("int"))
    )


def area_resize(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str], height: int, width: int, scale: float) -> DataFrame:
    """Area-weighted mean on a coarser lattice of int(side · scale) cells."""
    out_h, out_w = int(height * scale), int(width * scale)

    def overlaps(c: str, ratio: float) -> Column:
        lo, hi = F.col(c) * F.lit(ratio), (F.col(c) + 1) * F.lit(ratio)
        cells = F.sequence(F.floor(lo).cast("int"), (F.ceil(hi) - 1).cast("int"))
        return F.filter(
            F.transform(
                cells,
                lambda i: F.struct(i.alias("at"), (F.least(hi, i + 1.0) - F.greatest(lo, i.cast("double"))).alias("w")),
            ),
            lambda e: e["w"] > 1e-12,
        )

    spread = pixels.withColumn("_oy", F.explode(overlaps("y", out_h / height))).withColumn(
        "_ox", F.explode(overlaps("x", out_w / width))
    )
    weight = F.col("_oy.w") * F.col("_ox.w")
    return (
        spread.where((F.col("_oy.at") < out_h) & (F.col("_ox.at") < out_w))
        .groupBy(*keys, F.col("_oy.at").alias("y"), F.col("_ox.at").alias("x"))
        .agg(*[(F.sum(weight * F.col(c)) / F.sum(weight)).alias(c) for c in channels])
    )


def rescale(pixels: DataFrame, channel: str, keys: Sequence[str]) -> DataFrame:
    """``unit``: min-max to [0, 1], constant images 0. ``byte``: share of the maximum times 255."""
    keys = list(keys)
    bounds = pixels.groupBy(*keys).agg(F.min(channel).alias("_lo"), F.max(channel).alias("_hi"))
    joined = pixels.join(bounds, keys) if keys else pixels.withColumn(
        "_b", pixels.agg(F.struct(F.min(channel).alias("lo"), F.max(channel).alias("hi")).alias("b")).scalar()
    ).select("*", F.col("_b.lo").alias("_lo"), F.col("_b.hi").alias("_hi")).drop("_b")
    c = F.col(channel)
    return (
        joined.withColumn("unit", F.coalesce(F.try_divide(c - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0)))
        .withColumn("byte", F.coalesce(F.try_divide(c, F.col("_hi")) * 255, F.lit(0.0)))
        .drop("_lo", "_hi")
    )


def add_ramp(pixels: DataFrame, channels: Sequence[str], height: int, width: int, scale: float) -> DataFrame:
    """Tilt the image: adds scale · (relative y + relative x), both centred."""
    tilt = F.col("y") / F.lit(float(height - 1)) - 0.5 + F.col("x") / F.lit(float(width - 1)) - 0.5
    return pixels.withColumns({c: F.col(c) + tilt * F.lit(float(scale)) for c in channels})


# Noise deviation per bit depth and level.
NOISE_SIGMA = {8: {1: 1.94, 2: 3.88, 3: 5.82}, 16: {1: 500.0, 2: 1000.0, 3: 1500.0}}


def gaussian_noise(pixels: DataFrame, channels: Sequence[str], level: int, bits: int = 8, seed: int = 0, only: str = "is_informative", draws: Sequence[tuple[Column, Column]] | None = None) -> DataFrame:
    """Normal noise on informative patches, cut to whole numbers in 0..255.

    The draw hangs on pixel position, so a retried task repeats it; ``draws`` gives two uniform numbers, the first over
    0, per channel in its place.
    """
    sigma = NOISE_SIGMA[bits][level]
    out = pixels
    for i, c in enumerate(channels):
        u1 = (F.pmod(F.xxhash64("patch_id", "y", "x", F.lit(seed + 2 * i)), F.lit(1 << 52)) + 1) / F.lit(float((1 << 52) + 1))
        u2 = F.pmod(F.xxhash64("patch_id", "y", "x", F.lit(seed + 2 * i + 1)), F.lit(1 << 52)) / F.lit(float(1 << 52))
        u1, u2 = draws[i] if draws else (u1, u2)
        normal = F.sqrt(-2 * F.log(u1)) * F.cos(2 * F.pi() * u2)
        noisy = F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.col(c) + normal * sigma))).cast("double")
        out = out.withColumn(c, F.when(F.col(only), noisy).otherwise(F.col(c)))
    return out


DISRUPTIONS: dict[str, Callable[..., DataFrame]] = {
    "gaussian": lambda px, channels, level, **o: gaussian_noise(px, channels, level, **o),
    "downsampling": lambda px, channels, level, height, width, keys=("patch_id",): area_resize(
        px, channels, keys, height, width, 0.3 + 0.2 * level
    ),
}


def disrupt(pixels: DataFrame, kind: str, channels: Sequence[str], level: int, **options) -> DataFrame:
    if kind not in DISRUPTIONS:
        raise ValueError(f"unknown disruption {kind!r}; choose from {sorted(DISRUPTIONS)}")
    return DISRUPTIONS[kind](pixels, channels, level, **options)


def radial_profile(pixels: DataFrame, channel: str, cy: float, cx: float, keys: Sequence[str] = ()) -> DataFrame:
    """Mean by whole-number distance from a centre."""
    r = F.floor(F.sqrt(F.pow(F.col("y") - cy, 2) + F.pow(F.col("x") - cx, 2)))
    return pixels.groupBy(*keys, r.alias("radius")).agg(F.avg(channel).alias("mean"))


def flip_or_turn(pixels: DataFrame, height: int, width: int, flip_x: bool = False, flip_y: bool = False, turns: int = 0) -> DataFrame:
    """Mirror and counter-clockwise quarter turns as coordinate arithmetic."""
    y, x, h, w = F.col("y"), F.col("x"), height, width
    if flip_x:
        x = w - 1 - x
    if flip_y:
        y = h - 1 - y
    for _ in range(turns % 4):
        y, x = w - 1 - x, y
        h, w = w, h
    return pixels.select(*[c for c in pixels.columns if c not in ("y", "x")], y.alias("y"), x.alias("x"))


def otsu_thresholds(pixels: DataFrame, channel: str, keys: Sequence[str], bins: int = 256) -> DataFrame:
    """(keys, threshold): threshold of largest between-class variance over a fixed-width histogram of each image."""
    keys = list(keys)
    ends = pixels.groupBy(*keys).agg(F.min(channel).cast("double").alias("_lo"), ((F.max(channel) - F.min(channel)).cast("double") / bins).alias("_width"))
    slot = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col(channel) - F.col("_lo"), F.col("_width"))), F.lit(0)))
    hist = pixels.join(ends, keys).groupBy(*keys, "_lo", "_width", slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    hist = hist.withColumn("centre", F.col("_lo") + (F.col("bin") + 0.5) * F.col("_width"))
    image = W.partitionBy(*keys).orderBy("bin")  # a histogram has at most ``bins`` rows
    up, down = image.rowsBetween(W.unboundedPreceding, W.currentRow), image.rowsBetween(1, W.unboundedFollowing)
    mass = F.col("n") * F.col("centre")
    scored = hist.select(
        *keys,
        "centre",
        F.sum("n").over(up).alias("w1"),
        F.sum("n").over(down).alias("w2"),
        F.sum(mass).over(up).alias("m1"),
        F.sum(mass).over(down).alias("m2"),
    )
    between = F.coalesce(
        F.col("w1").cast("double") * F.col("w2") * F.pow(F.col("m1") / F.col("w1") - F.try_divide(F.col("m2"), F.col("w2")), 2),
        F.lit(0.0),
    )
    return scored.groupBy(*keys).agg(F.max(F.struct(between.alias("v"), (-F.col("centre")).alias("c"))).alias("best")).select(*keys, (-F.col("best.c")).alias("threshold"))


def otsu_threshold(pixels: DataFrame, channel: str, bins: int = 256) -> Column:
    """``otsu_thresholds`` of a single image, as a scalar."""
    return otsu_thresholds(pixels.withColumn("_image", F.lit(0)), channel, ["_image"], bins).select("threshold").scalar()
