"""Cutting an image into patches and putting patches back together.

Images are tables of pixels, so a patch is a key on a pixel row: nothing is copied but the
key. Generators work on a table of image extents (image_id, height, width).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissuegrid.operators.orderstats import running_before

BOX = ["y_start", "x_start", "patch_height", "patch_width"]


def _floor_int(c: Column) -> Column:
    return F.floor(c).cast("int")


def _box(y: Column, x: Column, h: Column, w: Column) -> Column:
    return F.struct(
        y.cast("int").alias("y_start"),
        x.cast("int").alias("x_start"),
        h.cast("int").alias("patch_height"),
        w.cast("int").alias("patch_width"),
    )


def _numbered(extents: DataFrame, boxes: Column) -> DataFrame:
    """One row per box of an image; ids follow the array order."""
    keep = [c for c in extents.columns]
    return extents.select(*keep, F.posexplode(boxes).alias("patch_id", "_b")).select(
        *keep, "patch_id", *[F.col(f"_b.{c}").alias(c) for c in BOX]
    )


def full_image(extents: DataFrame, **_) -> DataFrame:
    zero = F.lit(0)
    return _numbered(extents, F.array(_box(zero, zero, F.col("height"), F.col("width"))))


def halves(extents: DataFrame, axis: str = "vertical", **_) -> DataFrame:
    """Two parts; an odd remainder goes to the second one."""
    h, w, zero = F.col("height"), F.col("width"), F.lit(0)
    if axis == "vertical":
        m = F.floor(w / 2)
        boxes = F.array(_box(zero, zero, h, m), _box(zero, m, h, w - m))
    else:
        m = F.floor(h / 2)
        boxes = F.array(_box(zero, zero, m, w), _box(m, zero, h - m, w))
    return _numbered(extents, boxes)


def quarters(extents: DataFrame, **_) -> DataFrame:
    h, w, zero = F.col("height"), F.col("width"), F.lit(0)
    my, mx = F.floor(h / 2), F.floor(w / 2)
    return _numbered(
        extents,
        F.array(
            _box(zero, zero, my, mx),
            _box(zero, mx, my, w - mx),
            _box(my, zero, h - my, mx),
            _box(my, mx, h - my, w - mx),
        ),
    )


def grid_step(size: int, overlap: float) -> int:
    return max(1, size - int(size * overlap))


def overlapping_grid(extents: DataFrame, patch_height: int, patch_width: int, overlap: float = 0.0, **_) -> DataFrame:
    """Full windows only, row by row; patch origins are part of the table."""
    sy, sx = grid_step(patch_height, overlap), grid_step(patch_width, overlap)
    rows = F.floor((F.col("height") - patch_height) / sy) + 1
    cols = F.floor((F.col("width") - patch_width) / sx) + 1
    fits = extents.where((F.col("height") >= patch_height) & (F.col("width") >= patch_width))
    placed = fits.withColumn("_cols", cols).withColumn("_i", F.explode(F.sequence(F.lit(0), rows - 1)))
    placed = placed.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_cols") - 1)))
    return placed.select(
        *extents.columns,
        (F.col("_i") * F.col("_cols") + F.col("_j")).cast("int").alias("patch_id"),
        (F.col("_i") * sy).cast("int").alias("y_start"),
        (F.col("_j") * sx).cast("int").alias("x_start"),
        F.lit(patch_height).alias("patch_height"),
        F.lit(patch_width).alias("patch_width"),
    )


SPLIT_MODES: dict[str, Callable[..., DataFrame]] = {
    "full_image": full_image,
    "halves": halves,
    "quarters": quarters,
    "patches": overlapping_grid,
}


def split(extents: DataFrame, mode: str, **options) -> DataFrame:
    if mode not in SPLIT_MODES:
        raise ValueError(f"unknown split mode {mode!r}; choose from {sorted(SPLIT_MODES)}")
    return SPLIT_MODES[mode](extents, **options)


def pad_to_cover(extents: DataFrame, patch_height: int, patch_width: int, overlap: float = 0.0) -> DataFrame:
    """Zeros to add at the end of each axis so that the grid covers the image."""
    def pad(n: str, size: int) -> Column:
        step = grid_step(size, overlap)
        return F.pmod(F.lit(size) - F.pmod(F.col(n) - size, F.lit(step)), F.lit(size)).cast("int")

    return extents.withColumn("pad_height", pad("height", patch_height)).withColumn(
        "pad_width", pad("width", patch_width)
    )


def pad_pixels(pixels: DataFrame, padded: DataFrame, channels: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Add the zero pixels of the padding strips; known pixels are not touched or shuffled."""
    keys = list(keys)
    full_h, full_w = F.col("height") + F.col("pad_height"), F.col("width") + F.col("pad_width")
    bottom = padded.where("pad_height > 0").select(
        *keys,
        F.explode(F.sequence(F.col("height"), full_h - 1)).alias("y"),
        F.sequence(F.lit(0), full_w - 1).alias("_xs"),
    )
    right = padded.where("pad_width > 0").select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"),
        F.sequence(F.col("width"), full_w - 1).alias("_xs"),
    )
    zeros = [F.lit(0.0).alias(c) for c in channels]
    extra = [
        part.select(*keys, "y", F.explode("_xs").alias("x"), *zeros) for part in (bottom, right)
    ]
    known = pixels.select(*keys, "y", "x", *channels)
    return known.unionByName(extra[0]).unionByName(extra[1])


def resolve_parameters(params: DataFrame) -> DataFrame:
    """Typed patch parameters of each row, with an ``error`` text when they cannot be used.

    Input columns: split_mode, patch_height, patch_width, overlap (texts), height, width.
    """
    def size(c: str) -> Column:
        v = F.expr(f"try_cast(trim({c}) AS DOUBLE)")
        return F.when(v > 0, _floor_int(v))

    def unreadable(c: str) -> Column:
        return (F.trim(F.col(c)) != "") & F.expr(f"try_cast(trim({c}) AS DOUBLE) IS NULL")

    whole = F.col("split_mode").isin("full_image", "halves", "quarters")
    share = F.expr("try_cast(trim(overlap) AS DOUBLE)")
    typed = params.select(
        "*",
        F.when(whole, F.col("height")).otherwise(size("patch_height")).cast("int").alias("_h"),
        F.when(whole, F.col("width")).otherwise(size("patch_width")).cast("int").alias("_w"),
        F.when(whole, 0.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("_o"),
        F.when(unreadable("patch_height"), "patch_height is not a number")
        .when(unreadable("patch_width"), "patch_width is not a number")
        .when(unreadable("overlap"), "overlap is not a number")
        .when((share < 0) | (share >= 1), "overlap must lie in [0, 1)")
        .alias("_e"),
    )
    missing = F.col("_h").isNull() | F.col("_w").isNull()

    def step(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.greatest(F.lit(1), F.col(c) - _floor_int(F.col(c) * F.col("_o"))))

    return typed.select(
        *[c for c in params.columns if c not in ("patch_height", "patch_width", "overlap")],
        F.col("_h").alias("patch_height"),
        F.col("_w").alias("patch_width"),
        F.col("_o").alias("overlap"),
        step("_h").alias("step_height"),
        step("_w").alias("step_width"),
        F.coalesce("_e", F.when(missing, "patch size must be positive")).alias("error"),
    )


def require_valid(params: DataFrame) -> DataFrame:
    """Fail the job on the first unusable parameter row."""
    bad = F.col("error").isNotNull()
    return params.withColumn("patch_height", F.when(bad, F.raise_error(F.col("error"))).otherwise(F.col("patch_height")))


def cut_boxes(pixels: DataFrame, patches: DataFrame, keys: Sequence[str] = (), cell: int = 256, last: Sequence[str] = ()) -> DataFrame:
    """Pixels with every patch whose half-open box holds them, plus local coordinates.

    Boxes are spread over a coarse lattice, so the range condition runs as an equi-join on lattice cells.
    """
    keys = list(keys)
    boxes = patches.select(*keys, "patch_id", *BOX, *last)
    spread = boxes.withColumn(
        "_gy",
        F.explode(F.sequence(_floor_int(F.col("y_start") / cell), _floor_int((F.col("y_start") + F.col("patch_height") - 1) / cell))),
    ).withColumn(
        "_gx",
        F.explode(F.sequence(_floor_int(F.col("x_start") / cell), _floor_int((F.col("x_start") + F.col("patch_width") - 1) / cell))),
    )
    located = pixels.withColumn("_gy", _floor_int(F.col("y") / cell)).withColumn("_gx", _floor_int(F.col("x") / cell))
    dy, dx = F.col("y") - F.col("y_start"), F.col("x") - F.col("x_start")
    inside = (dy >= 0) & (dy < F.col("patch_height")) & (dx >= 0) & (dx < F.col("patch_width"))
    joined = located.join(spread, [*keys, "_gy", "_gx"]).where(inside)
    return joined.withColumn("patch_y", dy).withColumn("patch_x", dx).drop("_gy", "_gx", *BOX)


def exact_tiles(pixels: DataFrame, height: int, width: int, extent_h: Column, extent_w: Column) -> DataFrame:
    """Whole tiles only: what is left over at the far edges is dropped."""
    rows, cols = F.floor(extent_h / height), F.floor(extent_w / width)
    ty, tx = F.floor(F.col("y") / height), F.floor(F.col("x") / width)
    return pixels.where((ty < rows) & (tx < cols)).withColumn("tile_id", (ty * cols + tx).cast("bigint"))


def exact_tiles_by_image(pixels: DataFrame, height: int, width: int, keys: Sequence[str]) -> DataFrame:
    """``exact_tiles`` of several images, each with its own extent and tile numbers."""
    size = pixels.groupBy(*keys).agg((F.max("y") + 1).alias("_height"), (F.max("x") + 1).alias("_width"))
    return exact_tiles(pixels.join(size, list(keys)), height, width, F.col("_height"), F.col("_width")).drop("_height", "_width")


def extent(patches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return patches.groupBy(*keys).agg(
        F.max(F.col("y_start") + F.col("patch_height")).alias("height"),
        F.max(F.col("x_start") + F.col("patch_width")).alias("width"),
    )


def stitch(pieces: DataFrame, patches: DataFrame, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Local patch pixels placed by their patch origin; the later patch wins where two overlap."""
    keys = list(keys)
    placed = pieces.join(patches.select(*keys, "patch_id", "y_start", "x_start"), [*keys, "patch_id"])
    body = F.struct(*values)
    return (
        placed.select(
            *keys,
            (F.col("patch_y") + F.col("y_start")).alias("y"),
            (F.col("patch_x") + F.col("x_start")).alias("x"),
            "patch_id",
            body.alias("_v"),
        )
        .groupBy(*keys, "y", "x")
        .agg(F.max_by("_v", "patch_id").alias("_v"))
        .select(*keys, "y", "x", *[F.col(f"_v.{v}").alias(v) for v in values])
    )


def label_offsets(labelled: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """What to add to a patch's labels so that no two patches share one."""
    top = labelled.groupBy(*keys, "patch_id").agg(F.max(label).alias("max_label"))
    return running_before(top, keys, "patch_id", "max_label", "label_offset")


def merge_labels(pieces: DataFrame, patches: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """One label raster from patch rasters: offsets keep labels apart, the first patch keeps a shared pixel."""
    keys = list(keys)
    found = pieces.where(F.col(label) > 0)
    origins = patches.select(*keys, "patch_id", "y_start", "x_start")
    shifts = label_offsets(found, label, keys).join(origins, [*keys, "patch_id"])
    placed = found.join(shifts, [*keys, "patch_id"]).select(
        *keys,
        (F.col("patch_y") + F.col("y_start")).alias("y"),
        (F.col("patch_x") + F.col("x_start")).alias("x"),
        (F.col(label) + F.col("label_offset")).alias(label),
        "patch_id",
    )
    return placed.groupBy(*keys, "y", "x").agg(F.min_by(label, "patch_id").alias(label))


def half_overlap_windows(extents: DataFrame, size: int) -> DataFrame:
    """Windows at half their size apart; the last one lies flush with the far edge."""
    def starts(n: str) -> Column:
        last = F.greatest(F.col(n) - F.col("_s"), F.lit(0))
        return F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.col("_stride")), F.array(last)))

    sized = extents.withColumn("_s", F.least(F.lit(size), F.greatest("height", "width")))
    sized = sized.withColumn("_stride", F.greatest(F.floor(F.col("_s") / 2).cast("int"), F.lit(1)))
    sized = sized.withColumn("_ys", starts("height")).withColumn("_xs", starts("width"))
    rows = sized.select("*", F.posexplode("_ys").alias("_i", "y_start"))
    cells = rows.select("*", F.posexplode("_xs").alias("_j", "x_start"))
    return cells.select(
        *extents.columns,
        (F.col("_i") * F.size("_xs") + F.col("_j")).cast("int").alias("patch_id"),
        F.col("y_start").cast("int").alias("y_start"),
        F.col("x_start").cast("int").alias("x_start"),
        F.least(F.col("_s"), F.col("height") - F.col("y_start")).cast("int").alias("patch_height"),
        F.least(F.col("_s"), F.col("width") - F.col("x_start")).cast("int").alias("patch_width"),
    )


def window_summary(pixels: DataFrame, windows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct matched and original labels, what was lost, and density of each window.

    Pixels carry cell_label, nucleus_label, cell_matched, nucleus_matched.
    """
    keys = list(keys)
    masks = ["cell_matched", "nucleus_matched", "cell_label", "nucleus_label"]
    boxed = cut_boxes(pixels.select(*keys, "y", "x", *masks), windows, keys)
    long = boxed.select(
        *keys, "patch_id",
        F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), F.col(m).cast("bigint").alias("label")) for m in masks])).alias("e"),
    ).select(*keys, "patch_id", "e.mask", "e.label").where("label > 0").distinct()
    counts = long.groupBy(*keys, "patch_id").agg(
        *[F.count_if(F.col("mask") == m).alias(m) for m in masks]
    )
    area = F.col("patch_height") * F.col("patch_width")
    zero = F.lit(0)
    joined = windows.join(counts, [*keys, "patch_id"], "left").na.fill(0, masks)
    return joined.select(
        *keys, "patch_id", *BOX,
        F.col("cell_matched").alias("cell_count"),
        F.col("nucleus_matched").alias("nucleus_count"),
        F.greatest(zero, F.col("cell_label") - F.col("cell_matched")).alias("unmatched_cells"),
        F.greatest(zero, F.col("nucleus_label") - F.col("nucleus_matched")).alias("unmatched_nuclei"),
        F.try_divide(F.col("cell_matched"), F.col("cell_label")).alias("matched_fraction"),
        (F.col("cell_matched") / area).alias("cell_density"),
    )


def pyramid_levels(height: int, width: int, smallest: int = 256) -> int:
    """How many times both sides can be halved while they are at least ``smallest``."""
    levels = 0
    while height >= smallest and width >= smallest:
        height, width = (height + 1) // 2, (width + 1) // 2
        levels += 1
    return levels
