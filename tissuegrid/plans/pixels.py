"""Patch, raster, object and matching queries on the raster view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissuegrid.operators import components, match, objects, patches, raster
from tissuegrid.plans.catalog import query
from tissuegrid.plans.cells import rounded
from tissuegrid.plans.dataset import PIXELS_SQL, pixels, table

K = ["patch_id"]
CH = ["v0", "v1"]

# --- patch generators: every part is an image of its own size ----------------------------------

EXTENT_SQL = """ext AS (SELECT p_partkey AS image_id, CAST(100 + p_size * 7 AS INTEGER) AS height,
  CAST(81 + p_size * 3 AS INTEGER) AS width FROM part)"""


def extents(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("image_id"),
        (100 + F.col("p_size") * 7).cast("int").alias("height"),
        (81 + F.col("p_size") * 3).cast("int").alias("width"),
    )


def raster_extent(spark, d):
    return pixels(spark, d).agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


WHOLE_SQL = "whole AS (SELECT max(y) + 1 AS height, max(x) + 1 AS width FROM px)"


@query("R1_full_image", f"WITH {EXTENT_SQL} SELECT *, 0 AS patch_id, 0 AS y_start, 0 AS x_start, height AS patch_height, width AS patch_width FROM ext")
def _(spark, d):
    return patches.split(extents(spark, d), "full_image")


@query(
    "R2_halves",
    f"""WITH {EXTENT_SQL} SELECT *, 0 AS patch_id, 0 AS y_start, 0 AS x_start, height AS patch_height, width // 2 AS patch_width FROM ext
    UNION ALL SELECT *, 1, 0, width // 2, height, width - width // 2 FROM ext""",
)
def _(spark, d):
    return patches.split(extents(spark, d), "halves")


@query(
    "R2_halves_horizontal",
    f"""WITH {EXTENT_SQL} SELECT *, 0 AS patch_id, 0 AS y_start, 0 AS x_start, height // 2 AS patch_height, width AS patch_width FROM ext
    UNION ALL SELECT *, 1, height // 2, 0, height - height // 2, width FROM ext""",
)
def _(spark, d):
    return patches.split(extents(spark, d), "halves", axis="horizontal")


@query(
    "R3_quarters",
    f"""WITH {EXTENT_SQL}, m AS (SELECT *, height // 2 AS my, width // 2 AS mx FROM ext)
    SELECT image_id, height, width, 0 AS patch_id, 0 AS y_start, 0 AS x_start, my AS patch_height, mx AS patch_width FROM m
    UNION ALL SELECT image_id, height, width, 1, 0, mx, my, width - mx FROM m
    UNION ALL SELECT image_id, height, width, 2, my, 0, height - my, mx FROM m
    UNION ALL SELECT image_id, height, width, 3, my, mx, height - my, width - mx FROM m""",
)
def _(spark, d):
    return patches.split(extents(spark, d), "quarters")


GRID_SQL = f"""{EXTENT_SQL}, g AS (
  SELECT *, (height - 64) // 48 + 1 AS nr, (width - 64) // 48 + 1 AS nc FROM ext),
grid AS (SELECT image_id, height, width, CAST(i * nc + j AS INTEGER) AS patch_id, CAST(i * 48 AS INTEGER) AS y_start, CAST(j * 48 AS INTEGER) AS x_start,
  64 AS patch_height, 64 AS patch_width FROM g, unnest(range(nr)) a(i), unnest(range(nc)) b(j))"""


@query("R4_overlapping_grid", f"WITH {GRID_SQL} SELECT * FROM grid")
def _(spark, d):
    return patches.split(extents(spark, d), "patches", patch_height=64, patch_width=64, overlap=0.25)


@query(
    "R5_pad_to_cover",
    f"""WITH {EXTENT_SQL} SELECT *, CAST((64 - (((height - 64) % 48) + 48) % 48) % 64 AS INTEGER) AS pad_height,
    CAST((64 - (((width - 64) % 48) + 48) % 48) % 64 AS INTEGER) AS pad_width FROM ext""",
)
def _(spark, d):
    return patches.pad_to_cover(extents(spark, d), 64, 64, 0.25)


@query(
    "R5_padded_pixels",
    f"""WITH {PIXELS_SQL}, {WHOLE_SQL}, p AS (SELECT height, width, CAST((16 - (((height - 16) % 12) + 12) % 12) % 16 AS INTEGER) AS ph,
      CAST((16 - (((width - 16) % 12) + 12) % 12) % 16 AS INTEGER) AS pw FROM whole)
    SELECT CAST(a.y AS INTEGER) AS y, CAST(b.x AS INTEGER) AS x, coalesce(v0, 0.0) AS v0, coalesce(v1, 0.0) AS v1 FROM p, unnest(range(p.height + p.ph)) a(y), unnest(range(p.width + p.pw)) b(x)
    LEFT JOIN px ON px.y = a.y AND px.x = b.x""",
)
def _(spark, d):
    padded = patches.pad_to_cover(raster_extent(spark, d), 16, 16, 0.25)
    return patches.pad_pixels(pixels(spark, d), padded, CH)


CUT_SQL = f"""{PIXELS_SQL}, {WHOLE_SQL}, g AS (SELECT *, (height - 12) // 9 + 1 AS nr, (width - 16) // 12 + 1 AS nc FROM whole WHERE height >= 12),
boxes AS (SELECT CAST(i * nc + j AS INTEGER) AS box_id, CAST(i * 9 AS INTEGER) AS y_start, CAST(j * 12 AS INTEGER) AS x_start FROM g, unnest(range(nr)) a(i), unnest(range(nc)) b(j)),
cut AS (SELECT box_id, px.y - y_start AS patch_y, px.x - x_start AS patch_x, y_start, x_start, v0, v1, cell_label FROM px JOIN boxes
  ON px.y >= y_start AND px.y < y_start + 12 AND px.x >= x_start AND px.x < x_start + 16)"""


def _boxes(spark, d):
    return patches.split(raster_extent(spark, d), "patches", patch_height=12, patch_width=16, overlap=0.25)


def _cut(spark, d):
    bare = pixels(spark, d).select("y", "x", "v0", "v1", "cell_label")
    return patches.cut_boxes(bare, _boxes(spark, d), cell=32)


@query("R6_cut_boxes", f"WITH {CUT_SQL} SELECT box_id AS patch_id, patch_y, patch_x, v0, cell_label FROM cut")
def _(spark, d):
    return _cut(spark, d).select("patch_id", "patch_y", "patch_x", "v0", "cell_label")


@query("J15_pixels_in_box", f"WITH {CUT_SQL} SELECT box_id AS patch_id, count(*) AS n, sum(v0) AS total FROM cut GROUP BY box_id")
def _(spark, d):
    return _cut(spark, d).groupBy("patch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("v0").alias("total"))


@query(
    "R7_exact_tiles",
    f"""WITH {PIXELS_SQL}, {WHOLE_SQL} SELECT CAST((y // 16) * (width // 16) + x // 16 AS BIGINT) AS tile_id, count(*) AS n, sum(v0) AS total
    FROM px, whole WHERE y // 16 < height // 16 AND x // 16 < width // 16 GROUP BY 1""",
)
def _(spark, d):
    size = raster_extent(spark, d)
    h, w = size.select("height").scalar(), size.select("width").scalar()
    tiles = patches.exact_tiles(pixels(spark, d), 16, 16, h, w)
    return tiles.groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"), F.sum("v0").alias("total"))


@query("R8_extent", f"WITH {GRID_SQL} SELECT image_id, max(y_start + patch_height) AS height, max(x_start + patch_width) AS width FROM grid GROUP BY image_id")
def _(spark, d):
    grid = patches.overlapping_grid(extents(spark, d), 64, 64, 0.25)
    return patches.extent(grid, ["image_id"])


@query("R9_stitch", f"WITH {CUT_SQL} SELECT DISTINCT patch_y + y_start AS y, patch_x + x_start AS x, v0, v1 FROM cut")
def _(spark, d):
    return patches.stitch(_cut(spark, d), _boxes(spark, d), CH)


@query(
    "W4_label_offsets",
    f"""WITH {PIXELS_SQL}, m AS (SELECT patch_id, max(cell_label) AS max_label FROM px GROUP BY patch_id)
    SELECT patch_id, max_label, CAST(coalesce(sum(max_label) OVER (ORDER BY patch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS label_offset FROM m""",
)
def _(spark, d):
    return patches.label_offsets(pixels(spark, d), "cell_label")


@query(
    "R20_merge_labels",
    f"""WITH {CUT_SQL}, m AS (SELECT box_id, max(cell_label) AS top FROM cut GROUP BY box_id),
    o AS (SELECT box_id, coalesce(sum(top) OVER (ORDER BY box_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM m)
    SELECT patch_y + y_start AS y, patch_x + x_start AS x, CAST(min_by(cell_label + off, box_id) AS BIGINT) AS cell_label
    FROM cut JOIN o USING (box_id) WHERE cell_label > 0 GROUP BY 1, 2""",
)
def _(spark, d):
    return patches.merge_labels(_cut(spark, d), _boxes(spark, d), "cell_label")


@query(
    "R25_patch_parameters",
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'full_image' ELSE 'patches' END AS split_mode,
      CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN 'wide' ELSE CAST(o_custkey % 50 AS VARCHAR) END AS ph,
      CAST(o_custkey % 13 AS VARCHAR) AS ov, 900 AS height, 700 AS width FROM orders),
    t AS (SELECT *, split_mode = 'full_image' AS w, TRY_CAST(trim(ph) AS DOUBLE) AS h, CAST(ov AS DOUBLE) / 10 AS o FROM r)
    SELECT o_orderkey, split_mode, height, width,
      CASE WHEN w THEN height WHEN h > 0 THEN CAST(floor(h) AS INTEGER) END AS patch_height,
      CASE WHEN w THEN width ELSE 64 END AS patch_width, CASE WHEN w THEN 0.0 ELSE o END AS overlap,
      CASE WHEN w THEN height WHEN h > 0 THEN greatest(1, CAST(floor(h) - floor(floor(h) * o) AS INTEGER)) END AS step_height,
      CASE WHEN w THEN width ELSE greatest(1, CAST(64 - floor(64 * o) AS INTEGER)) END AS step_width,
      CASE WHEN trim(ph) <> '' AND h IS NULL THEN 'patch_height is not a number' WHEN o >= 1 THEN 'overlap must lie in [0, 1)'
           WHEN NOT w AND (h IS NULL OR h <= 0) THEN 'patch size must be positive' END AS error
    FROM t""",
)
def _(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 == 0, "full_image").otherwise("patches").alias("split_mode"),
        F.when(F.col("o_orderkey") % 7 == 0, "").when(F.col("o_orderkey") % 11 == 0, "wide")
        .otherwise((F.col("o_custkey") % 50).cast("string")).alias("patch_height"),
        F.lit("64").alias("patch_width"),
        ((F.col("o_custkey") % 13) / 10.0).cast("string").alias("overlap"),
        F.lit(900).alias("height"),
        F.lit(700).alias("width"),
    )
    return patches.resolve_parameters(rows)


# --- raster ------------------------------------------------------------------------------------


@query("R10_max_projection", f"WITH {PIXELS_SQL} SELECT y, x, greatest(v0, v1 - 900) AS wholecell FROM px")
def _(spark, d):
    px = pixels(spark, d).withColumn("shifted", F.col("v1") - 900)
    return raster.max_projection(px, ["v0", "shifted"]).select("y", "x", "wholecell")


@query(
    "R11_above_mean",
    f"""WITH {PIXELS_SQL} SELECT y, x, CAST(v0 > avg(v0) OVER (PARTITION BY patch_id) AS INTEGER) AS v0_above,
    CAST(v1 > avg(v1) OVER (PARTITION BY patch_id) AS INTEGER) AS v1_above FROM px""",
)
def _(spark, d):
    return raster.above_mean(pixels(spark, d), CH, K).select("y", "x", "v0_above", "v1_above")


@query(
    "R12_foreground",
    f"""WITH {PIXELS_SQL}, t AS (SELECT y, x, CAST(v0 > avg(v0) OVER (PARTITION BY patch_id) AS INTEGER)
      + CAST(v1 > avg(v1) OVER (PARTITION BY patch_id) AS INTEGER) AS n_above FROM px)
    SELECT y, x, n_above, CAST(n_above > 0 AS INTEGER) AS foreground FROM t""",
)
def _(spark, d):
    return raster.above_mean(pixels(spark, d), CH, K).select("y", "x", "n_above", "foreground")


def around_sql(col, keys="patch_id", source="px"):
    row = f"(PARTITION BY {keys}, y ORDER BY x)"
    column = f"(PARTITION BY {keys}, x ORDER BY y)"
    return (
        f"lag({col}) OVER {row} AS l, lead({col}) OVER {row} AS r, "
        f"lag({col}) OVER {column} AS u, lead({col}) OVER {column} AS d"
    )


NEAR_SQL = f"{PIXELS_SQL}, near AS (SELECT *, {around_sql('cell_label')} FROM px)"
EDGE = "(coalesce(l <> cell_label, false) OR coalesce(r <> cell_label, false) OR coalesce(u <> cell_label, false) OR coalesce(d <> cell_label, false))"
BOUND_SQL = f"""{NEAR_SQL},
bounded AS (SELECT y, x, v0, v1, patch_id, cell_label, nucleus_label,
  CASE WHEN cell_label > 0 AND {EDGE} THEN cell_label ELSE 0 END AS boundary FROM near)"""


@query("R13_inner_boundary", f"WITH {BOUND_SQL} SELECT y, x, cell_label, boundary FROM bounded")
def _(spark, d):
    return raster.inner_boundary(pixels(spark, d), "cell_label", K, tile=16).select("y", "x", "cell_label", "boundary")


@query(
    "R14_outer_boundary",
    f"""WITH {NEAR_SQL}, m AS (SELECT y, x, cell_label, greatest(cell_label, l, r, u, d) AS top, least(cell_label, l, r, u, d) AS low FROM near)
    SELECT y, x, cell_label = 0 AND top > 0 AS "outer", top <> low AS thick FROM m""",
)
def _(spark, d):
    return raster.outer_boundary(pixels(spark, d), "cell_label", K).select("y", "x", "outer", "thick")


LAPLACE_SQL = f"""{PIXELS_SQL}, lap0 AS (SELECT *, {around_sql('v1')} FROM px),
lap AS (SELECT *, abs(4 * v1 - coalesce(l, v1) - coalesce(r, v1) - coalesce(u, v1) - coalesce(d, v1)) AS v1_laplacian FROM lap0)"""


@query("R15_laplacian", f"WITH {LAPLACE_SQL} SELECT y, x, round(v1_laplacian, 6) AS v1_laplacian FROM lap")
def _(spark, d):
    out = raster.laplacian(pixels(spark, d), ["v1"], K)
    return out.select("y", "x", F.round("v1_laplacian", 6).alias("v1_laplacian"))


@query(
    "R16_pyramid",
    f"""WITH {PIXELS_SQL} SELECT CAST(lv AS INTEGER) AS level, CAST(y // (1 << lv) AS INTEGER) AS y, CAST(x // (1 << lv) AS INTEGER) AS x, v0
    FROM px, unnest([0, 1, 2]) t(lv) WHERE y % (1 << lv) = 0 AND x % (1 << lv) = 0""",
)
def _(spark, d):
    levels = patches.pyramid_levels(1024, 600)
    return raster.pyramid(pixels(spark, d), levels).select("level", "y", "x", "v0")


@query(
    "R17_area_resize",
    f"""WITH {PIXELS_SQL}, l AS (SELECT *, y % 20 AS py, x % 25 AS qx FROM px),
    e AS (SELECT patch_id, oy, ox, v0, least((py + 1) * 0.5, oy + 1) - greatest(py * 0.5, oy) AS wy, least((qx + 1) * (12 / 25), ox + 1) - greatest(qx * (12 / 25), ox) AS wx
      FROM l, unnest(range(10)) a(oy), unnest(range(12)) b(ox))
    SELECT patch_id, CAST(oy AS INTEGER) AS y, CAST(ox AS INTEGER) AS x, round(sum(wy * wx * v0) / sum(wy * wx), 6) AS v0
    FROM e WHERE wy > 1e-12 AND wx > 1e-12 GROUP BY 1, 2, 3""",
)
def _(spark, d):
    local = pixels(spark, d).withColumn("y", F.col("y") % 20).withColumn("x", F.col("x") % 25)
    out = raster.disrupt(local, "downsampling", ["v0"], 1, height=20, width=25)
    return rounded(out, ["v0"])


@query("R18_stride", f"WITH {PIXELS_SQL} SELECT CAST(y // 4 AS INTEGER) AS y, CAST(x // 4 AS INTEGER) AS x, v0 FROM px WHERE y % 4 = 0 AND x % 4 = 0")
def _(spark, d):
    return raster.stride(pixels(spark, d), 4).select("y", "x", "v0")


@query(
    "R19_rescale",
    f"""WITH {PIXELS_SQL} SELECT y, x, round((v0 - min(v0) OVER w) / (max(v0) OVER w - min(v0) OVER w), 6) AS unit,
    round(v0 / max(v0) OVER w * 255, 6) AS byte FROM px WINDOW w AS (PARTITION BY patch_id)""",
)
def _(spark, d):
    return rounded(raster.rescale(pixels(spark, d), "v0", K).select("y", "x", "unit", "byte"), ["unit", "byte"])


@query(
    "R23_radial_profile",
    f"WITH {PIXELS_SQL} SELECT CAST(floor(sqrt((y - 20.0)**2 + (x - 25.0)**2)) AS BIGINT) AS radius, round(avg(v0), 6) AS mean FROM px GROUP BY 1",
)
def _(spark, d):
    return rounded(raster.radial_profile(pixels(spark, d), "v0", 20.0, 25.0), ["mean"])


@query("P27_ramp", f"WITH {PIXELS_SQL} SELECT y, x, round(v1 + (y / 39.0 - 0.5 + x / 49.0 - 0.5) * 100, 6) AS v1 FROM px")
def _(spark, d):
    out = raster.add_ramp(pixels(spark, d), ["v1"], 40, 50, 100.0)
    return out.select("y", "x", F.round("v1", 6).alias("v1"))


@query("P28_gaussian_noise")
def _(spark, d):
    flagged = pixels(spark, d).withColumn("is_informative", F.col("patch_id") % 2 == 0)
    return raster.disrupt(flagged, "gaussian", ["v0"], 2).select("y", "x", "is_informative", "v0")


@query(
    "P28_noise_from_given_draws",
    f"""WITH {PIXELS_SQL}, u AS (SELECT *, (((y * 7919 + x * 104729) % 10007) + 1) / 10008.0 AS u1, ((CAST(y AS BIGINT) * 15485863 + CAST(x AS BIGINT) * 32452843 + 7) % 10009) / 10009.0 AS u2 FROM px)
    SELECT y, x, patch_id % 2 = 0 AS is_informative, CASE WHEN patch_id % 2 = 0 THEN CAST(floor(least(255, greatest(0, v0 + sqrt(-2 * ln(CAST(u1 AS DOUBLE))) * cos(2 * pi() * CAST(u2 AS DOUBLE)) * {raster.NOISE_SIGMA[8][2]}))) AS DOUBLE) ELSE v0 END AS v0 FROM u""",
)
def _(spark, d):
    flagged = pixels(spark, d).withColumn("is_informative", F.col("patch_id") % 2 == 0)
    y, x = F.col("y").cast("bigint"), F.col("x").cast("bigint")
    draws = [(((y * 7919 + x * 104729) % 10007 + 1) / F.lit(10008.0), ((y * 15485863 + x * 32452843 + 7) % 10009) / F.lit(10009.0))]
    return raster.disrupt(flagged, "gaussian", ["v0"], 2, draws=draws).select("y", "x", "is_informative", "v0")


@query("X20_flip_and_turn", f"WITH {PIXELS_SQL} SELECT patch_id, 24 - (x - (patch_id % 2) * 25) AS y, 19 - y % 20 AS x, v0 FROM px")
def _(spark, d):
    local = pixels(spark, d).select("patch_id", (F.col("y") % 20).alias("y"), (F.col("x") % 25).alias("x"), "v0")
    return raster.flip_or_turn(local, 20, 25, flip_y=True, turns=1)


@query(
    "X19_unknown_channel_dropout",
    f"""WITH {PIXELS_SQL} SELECT y, x, CASE WHEN (y * 7 + x * 13) % 10 < 3 THEN 0 ELSE 1 END AS channel_id,
    CASE WHEN (y * 7 + x * 13) % 10 < 3 THEN 0.0 ELSE v0 END AS v0 FROM px""",
)
def _(spark, d):
    from tissuegrid.operators.summary import channel_dropout

    px = pixels(spark, d).select("y", "x", F.lit(1).alias("channel_id"), "v0")
    draw = F.pmod(F.col("y") * 7 + F.col("x") * 13, F.lit(10)) / 10.0
    return channel_dropout(px, 0.3, ["v0"], draw)


# --- components --------------------------------------------------------------------------------


@query(
    "R22_connected_pixels",
    f"""WITH RECURSIVE {PIXELS_SQL}, m AS (SELECT y, x, CAST(y AS BIGINT) * 4294967296 + x AS code FROM px WHERE v0 > 30),
    e AS (SELECT a.code AS a, b.code AS b FROM m a JOIN m b ON abs(a.y - b.y) + abs(a.x - b.x) = 1 AND (b.y = a.y OR b.x = a.x)),
    walk(code, root) AS (SELECT code, code FROM m UNION SELECT e.b, walk.root FROM walk JOIN e ON e.a = walk.code WHERE walk.root <= e.b)
    SELECT y, x, min(root) AS component FROM m JOIN walk USING (code) GROUP BY y, x""",
)
def _(spark, d):
    mask = pixels(spark, d).where("v0 > 30").select("y", "x")
    return components.connected_pixels(mask, [], tile=16)


# --- objects -----------------------------------------------------------------------------------


@query(
    "A1_label_sums",
    f"WITH {PIXELS_SQL} SELECT patch_id, cell_label AS label, count(*) AS n_pixels, sum(v0) AS v0_sum FROM px WHERE cell_label > 0 GROUP BY 1, 2",
)
def _(spark, d):
    return objects.label_sums(pixels(spark, d), "cell_label", ["v0"], K)


MEANS_SQL = """c AS (SELECT patch_id, cell_label AS label, count(*) AS nc, sum(v0) AS c0, sum(v1) AS c1, sum(v1 * v1) AS q1 FROM rep WHERE cell_label > 0 GROUP BY 1, 2),
n AS (SELECT patch_id, nucleus_label AS label, count(*) AS nn, sum(v0) AS n0, sum(v1) AS n1 FROM rep WHERE nucleus_label > 0 GROUP BY 1, 2),
j AS (SELECT patch_id, label, coalesce(nc, 0) AS nc, nn, coalesce(c0, 0) AS c0, coalesce(c1, 0) AS c1, n0, n1, coalesce(q1, 0) AS q1 FROM n LEFT JOIN c USING (patch_id, label))"""
REP_SQL = f"""{PIXELS_SQL}, rep AS (SELECT patch_id, y, x, v0, v1, cell_label,
  CASE WHEN nucleus_label > 0 AND nucleus_label % 3 = 1 THEN (nucleus_label - 1) // 3 + 1 ELSE 0 END AS nucleus_label FROM px)"""


def paired_pixels(spark, d):
    """Cell and nucleus share a label, as after matching."""
    own = F.expr("CASE WHEN nucleus_label > 0 AND nucleus_label % 3 = 1 THEN (nucleus_label - 1) DIV 3 + 1 ELSE 0 END")
    return pixels(spark, d).withColumn("nucleus_label", own)


@query(
    "A2_compartment_means",
    f"""WITH {REP_SQL}, {MEANS_SQL} SELECT patch_id, label, nc AS cell_area, nn AS nucleus_area,
    round(CASE WHEN nc > 0 THEN c0 / nc ELSE 0 END, 6) AS v0, round(n0 / nn, 6) AS v0_nucleus_mean,
    round(CASE WHEN nc > 0 THEN c1 / nc ELSE 0 END, 6) AS v1, round(n1 / nn, 6) AS v1_nucleus_mean FROM j""",
)
def _(spark, d):
    out = objects.compartment_means(paired_pixels(spark, d), CH, K)
    names = ["v0", "v0_nucleus_mean", "v1", "v1_nucleus_mean"]
    return rounded(out.select("patch_id", "label", "cell_area", "nucleus_area", *names), names)


@query(
    "A3_cytoplasm_mean",
    f"""WITH {REP_SQL}, {MEANS_SQL} SELECT patch_id, label, round(CASE WHEN nc > nn THEN (c0 - n0) / (nc - nn) END, 6) AS v0_cytoplasm_mean,
    round(CASE WHEN nc > nn THEN (c1 - n1) / (nc - nn) END, 6) AS v1_cytoplasm_mean FROM j""",
)
def _(spark, d):
    names = ["v0_cytoplasm_mean", "v1_cytoplasm_mean"]
    return rounded(objects.compartment_means(paired_pixels(spark, d), CH, K).select("patch_id", "label", *names), names)


@query(
    "A4_coefficient_of_variation",
    f"""WITH {REP_SQL}, {MEANS_SQL}, s AS (SELECT patch_id, label, CASE WHEN nc > 0 THEN c1 / nc ELSE 0 END AS m, CASE WHEN nc > 0 THEN q1 / nc ELSE 0 END AS q FROM j)
    SELECT patch_id, label, round(sqrt(greatest(q - m * m, 0)) / (m + 1e-8), 6) AS v1_cov FROM s""",
)
def _(spark, d):
    out = objects.cell_features(paired_pixels(spark, d), ["v1"], K, cov=True)
    return rounded(out.select("patch_id", "label", "v1_cov"), ["v1_cov"])


@query(
    "A5_mean_laplacian",
    f"""WITH {LAPLACE_SQL}, nuc AS (SELECT DISTINCT patch_id, (nucleus_label - 1) // 3 + 1 AS label FROM px WHERE nucleus_label > 0 AND nucleus_label % 3 = 1),
    m AS (SELECT patch_id, cell_label AS label, avg(v1_laplacian) AS a FROM lap WHERE cell_label > 0 GROUP BY 1, 2)
    SELECT patch_id, label, round(coalesce(a, 0), 6) AS v1_laplacian_var FROM nuc LEFT JOIN m USING (patch_id, label)""",
)
def _(spark, d):
    out = objects.cell_features(paired_pixels(spark, d), ["v1"], K, laplacian=True)
    return rounded(out.select("patch_id", "label", "v1_laplacian_var"), ["v1_laplacian_var"])


@query(
    "A6_object_means",
    f"WITH {PIXELS_SQL} SELECT patch_id, nucleus_label AS label, round(avg(v0), 6) AS v0, round(avg(v1), 6) AS v1 FROM px WHERE nucleus_label > 0 GROUP BY 1, 2",
)
def _(spark, d):
    return rounded(objects.label_means(pixels(spark, d), "nucleus_label", CH, K), CH)


MOMENTS_SQL = """SELECT patch_id, {label} AS label, count(*) AS area, avg(y) AS y, avg(x) AS x,
  var_pop(y) AS vy, var_pop(x) AS vx, covar_pop(y, x) AS c FROM px WHERE {label} > 0 GROUP BY 1, 2"""


def shape_sql(label, name):
    return f"""{name}0 AS ({MOMENTS_SQL.format(label=label)}),
  {name}1 AS (SELECT *, (vy + vx) / 2 + sqrt(((vy - vx) / 2)**2 + c * c) AS l1, greatest((vy + vx) / 2 - sqrt(((vy - vx) / 2)**2 + c * c), 0) AS l2 FROM {name}0),
  {name} AS (SELECT patch_id, label, area, y, x, 4 * sqrt(l1) AS axis_major_length, 4 * sqrt(l2) AS axis_minor_length,
    sqrt(greatest(1 - CASE WHEN l1 = 0 THEN 1 ELSE l2 / l1 END, 0)) AS eccentricity FROM {name}1)"""


SHAPES = ["y", "x", "axis_major_length", "axis_minor_length", "eccentricity"]


@query(
    "A7_moments",
    f"""WITH {PIXELS_SQL}, {shape_sql('cell_label', 's')} SELECT patch_id, label, area, {', '.join(f'round({c}, 5) AS {c}' for c in SHAPES)} FROM s""",
)
def _(spark, d):
    return rounded(objects.moments(pixels(spark, d), "cell_label", K), SHAPES, 5)


PERIMETER_SQL = f"""{PIXELS_SQL}, n1 AS (SELECT patch_id, y, x, cell_label AS lab, {around_sql('cell_label')} FROM px),
b AS (SELECT patch_id, y, x, lab FROM n1 WHERE lab > 0 AND NOT (coalesce(l = lab, false) AND coalesce(r = lab, false) AND coalesce(u = lab, false) AND coalesce(d = lab, false))),
w AS (SELECT a.patch_id, a.lab, a.y, a.x, sum(CASE WHEN abs(a.y - o.y) + abs(a.x - o.x) = 0 THEN 1 WHEN abs(a.y - o.y) + abs(a.x - o.x) = 1 THEN 2 ELSE 10 END) AS code
  FROM b a JOIN b o ON a.patch_id = o.patch_id AND a.lab = o.lab AND abs(a.y - o.y) <= 1 AND abs(a.x - o.x) <= 1 GROUP BY 1, 2, 3, 4)
SELECT patch_id, lab AS label, round(sum(CASE WHEN code IN (5, 7, 15, 17, 25, 27) THEN 1 WHEN code IN (21, 33) THEN sqrt(2) WHEN code IN (13, 23) THEN (1 + sqrt(2)) / 2 ELSE 0 END), 5) AS perimeter
FROM w GROUP BY 1, 2"""


@query("A7_perimeter", f"WITH {PERIMETER_SQL}")
def _(spark, d):
    return rounded(objects.perimeter(pixels(spark, d), "cell_label", K, tile=16), ["perimeter"], 5)


@query("A7_convex_area")
def _(spark, d):
    return rounded(objects.convex_area(pixels(spark, d), "cell_label", K), ["solidity"])


@query("A7_region_properties")
def _(spark, d):
    return objects.region_properties(pixels(spark, d), "cell_label", K)


@query(
    "J2_nucleus_with_cell",
    f"""WITH {PIXELS_SQL}, {shape_sql('cell_label', 'c')}, {shape_sql('nucleus_label', 'n')}
    SELECT n.patch_id, n.label, n.area AS nucleus_area, round(n.y, 5) AS nucleus_y, c.area AS cell_area, round(c.x, 5) AS cell_x
    FROM n LEFT JOIN c ON n.patch_id = c.patch_id AND n.label = c.label""",
)
def _(spark, d):
    px = pixels(spark, d)
    both = objects.nucleus_with_cell(objects.moments(px, "nucleus_label", K), objects.moments(px, "cell_label", K), K)
    return rounded(both.select("patch_id", "label", "nucleus_area", "nucleus_y", "cell_area", "cell_x"), ["nucleus_y", "cell_x"], 5)


@query(
    "A26_nucleus_cell_ratio",
    f"""WITH {PIXELS_SQL}, {shape_sql('cell_label', 'c')}, {shape_sql('nucleus_label', 'n')}
    SELECT n.patch_id, n.label, round(n.area / c.area, 6) AS nc_ratio FROM n JOIN c ON n.patch_id = c.patch_id AND n.label = c.label""",
)
def _(spark, d):
    px = pixels(spark, d)
    both = objects.nucleus_with_cell(objects.moments(px, "nucleus_label", K), objects.moments(px, "cell_label", K), K)
    return rounded(objects.nucleus_cell_ratio(both).select("patch_id", "label", "nc_ratio"), ["nc_ratio"])


@query(
    "P19_error_flags",
    f"""WITH {PIXELS_SQL}, {shape_sql('cell_label', 's')}, h AS (SELECT patch_id, cell_label AS label, count(DISTINCT CASE WHEN nucleus_label > 0 THEN nucleus_label END) AS n FROM px WHERE cell_label > 0 GROUP BY 1, 2)
    SELECT patch_id, label, area > 15 AS oversized, area < 16 AS undersized, eccentricity > 0.2 AS high_eccentricity, n <> 1 AS unmatched
    FROM s JOIN h USING (patch_id, label)""",
)
def _(spark, d):
    return objects.error_flags(pixels(spark, d), K, oversized=15, undersized=16, eccentric=0.2)


# --- matching ----------------------------------------------------------------------------------


@query(
    "J5_overlaps",
    f"WITH {PIXELS_SQL} SELECT patch_id, cell_label AS cell, nucleus_label AS nucleus, count(*) AS n_overlap FROM px WHERE cell_label > 0 AND nucleus_label > 0 GROUP BY 1, 2, 3",
)
def _(spark, d):
    return match.overlaps(pixels(spark, d), K)


MISMATCH_SQL = f"""{BOUND_SQL}, pr AS (SELECT patch_id, cell_label AS cell, nucleus_label AS nucleus, count(*) AS n_overlap,
  count(*) FILTER (WHERE boundary = 0) AS n_inside FROM bounded WHERE cell_label > 0 AND nucleus_label > 0 GROUP BY 1, 2, 3),
tot AS (SELECT patch_id, nucleus_label AS nucleus, count(*) AS n_nucleus FROM bounded WHERE nucleus_label > 0 GROUP BY 1, 2),
mm AS (SELECT *, (n_nucleus - n_inside) / n_nucleus AS mismatch FROM pr JOIN tot USING (patch_id, nucleus))"""


@query("J6_mismatch", f"WITH {MISMATCH_SQL} SELECT patch_id, cell, nucleus, n_overlap, n_inside, n_nucleus, round(mismatch, 6) AS mismatch FROM mm")
def _(spark, d):
    bounded = raster.inner_boundary(pixels(spark, d), "cell_label", K)
    return rounded(match.mismatches(bounded, K), ["mismatch"])


# In this raster no nucleus is the best choice of two cells, so the walk over cells reduces to a minimum.
MATCH_SQL = f"""{MISMATCH_SQL}, rkd AS (SELECT *, row_number() OVER (PARTITION BY patch_id, cell ORDER BY mismatch, nucleus) AS r FROM mm WHERE mismatch < 1),
mt AS (SELECT patch_id, cell, nucleus, mismatch, mismatch > 0 AS repaired, row_number() OVER (PARTITION BY patch_id ORDER BY cell) AS new_label FROM rkd WHERE r = 1)"""


def _repair(spark, d):
    return match.repair(pixels(spark, d), K)


@query("J7_one_to_one_match", f"WITH {MATCH_SQL} SELECT patch_id, cell, nucleus, round(mismatch, 6) AS mismatch, repaired, new_label FROM mt")
def _(spark, d):
    return rounded(_repair(spark, d)[1], ["mismatch"])


# Nuclei of seven columns over cells of five: several cells want one nucleus, and cells are served in label order.
_WIDE = "CASE WHEN y % 5 BETWEEN 1 AND 3 THEN CAST(1000 + (y {div} 5) * 20 + (x + 3) {div} 7 AS BIGINT) ELSE 0 END"
_WIDE_SQL = PIXELS_SQL.replace("\npx AS (", "\npx0 AS (") + f",\npx AS (SELECT y, x, v0, v1, patch_id, cell_label, {_WIDE.format(div='//')} AS nucleus_label FROM px0)"
_WALK_SQL = f"""{MISMATCH_SQL.replace(PIXELS_SQL, _WIDE_SQL)},
cl AS (SELECT patch_id, cell, row_number() OVER (PARTITION BY patch_id ORDER BY cell) AS i FROM (SELECT DISTINCT patch_id, cell FROM mm WHERE mismatch < 1)),
walk(patch_id, i, used, cell, b) AS (
  SELECT DISTINCT patch_id, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS STRUCT(m DOUBLE, n BIGINT)) FROM cl
  UNION ALL SELECT patch_id, i + 1, CASE WHEN b IS NULL THEN used ELSE list_append(used, b.n) END, cell, b FROM (
    SELECT w.patch_id, w.i, w.used, c.cell, min({{'m': CAST(mm.mismatch AS DOUBLE), 'n': mm.nucleus}}) FILTER (WHERE NOT list_contains(w.used, mm.nucleus)) AS b
    FROM walk w JOIN cl c ON c.patch_id = w.patch_id AND c.i = w.i + 1 JOIN mm ON mm.patch_id = c.patch_id AND mm.cell = c.cell AND mm.mismatch < 1 GROUP BY 1, 2, 3, 4))"""


@query(
    "J7_contested_match",
    f"WITH RECURSIVE {_WALK_SQL} SELECT patch_id, cell, b.n AS nucleus, round(b.m, 6) AS mismatch, b.m > 0 AS repaired, row_number() OVER (PARTITION BY patch_id ORDER BY cell) AS new_label FROM walk WHERE b IS NOT NULL",
)
def _(spark, d):
    px = pixels(spark, d).withColumn("nucleus_label", F.expr(_WIDE.format(div="DIV")))
    return rounded(match.repair(px, K)[1], ["mismatch"])


REPAIRED_SQL = f"""{MATCH_SQL}, fx AS (SELECT b.*, coalesce(mt.new_label, 0) AS cell_matched,
  CASE WHEN mt.new_label IS NOT NULL AND b.nucleus_label = mt.nucleus AND b.boundary = 0 THEN mt.new_label ELSE 0 END AS nucleus_matched
  FROM bounded b LEFT JOIN mt ON b.patch_id = mt.patch_id AND b.cell_label = mt.cell)"""


@query("J8_matched_pixels", f"WITH {REPAIRED_SQL} SELECT y, x, cell_matched, nucleus_matched, cell_matched - nucleus_matched AS cell_outside FROM fx")
def _(spark, d):
    return _repair(spark, d)[0].select("y", "x", "cell_matched", "nucleus_matched", "cell_outside")


@query(
    "J9_unmatched_nuclei",
    f"WITH {MATCH_SQL} SELECT DISTINCT patch_id, nucleus_label AS nucleus FROM px WHERE nucleus_label > 0 AND (patch_id, nucleus_label) NOT IN (SELECT patch_id, nucleus FROM mt)",
)
def _(spark, d):
    return match.unmatched(pixels(spark, d), _repair(spark, d)[1], K)


@query(
    "U4_label_set_difference",
    f"WITH {MATCH_SQL} SELECT DISTINCT patch_id, cell_label AS cell FROM px WHERE cell_label > 0 AND (patch_id, cell_label) NOT IN (SELECT patch_id, cell FROM mt)",
)
def _(spark, d):
    return match.unmatched(pixels(spark, d), _repair(spark, d)[1], K, kind="cell")


@query(
    "U3_pixel_sets",
    f"""WITH {BOUND_SQL} SELECT patch_id, count(*) FILTER (WHERE nucleus_label > 0 AND cell_label > 0 AND boundary = 0) AS nucleus_and_interior,
    count(*) FILTER (WHERE nucleus_label > 0 AND NOT (cell_label > 0 AND boundary = 0)) AS nucleus_not_interior,
    count(*) FILTER (WHERE cell_label > 0 AND boundary = 0) AS cell_not_membrane FROM bounded GROUP BY patch_id""",
)
def _(spark, d):
    b = raster.inner_boundary(pixels(spark, d), "cell_label", K)
    nucleus, interior = F.col("nucleus_label") > 0, (F.col("cell_label") > 0) & (F.col("boundary") == 0)
    return b.groupBy(*K).agg(
        F.count_if(nucleus & interior).alias("nucleus_and_interior"),
        F.count_if(nucleus & ~interior).alias("nucleus_not_interior"),
        F.count_if(interior).alias("cell_not_membrane"),
    )


@query(
    "A10_label_counts",
    f"WITH {PIXELS_SQL} SELECT patch_id, count(DISTINCT nullif(cell_label, 0)) AS cell_label, count(DISTINCT nullif(nucleus_label, 0)) AS nucleus_label FROM px GROUP BY 1",
)
def _(spark, d):
    return match.label_counts(pixels(spark, d), ["cell_label", "nucleus_label"], K)


@query(
    "A11_matched_fraction",
    f"""WITH {REPAIRED_SQL}, n AS (SELECT patch_id, count(DISTINCT cell_matched) AS m, count(DISTINCT cell_label) AS c, count(DISTINCT nucleus_label) AS u,
      count(DISTINCT nullif(cell_matched, 0)) AS mm, count(DISTINCT nullif(cell_label, 0)) AS cc FROM fx GROUP BY 1)
    SELECT patch_id, round(m / ((c - m) + (u - m) + m), 6) AS matched_fraction, round(mm / cc, 6) AS matched_cell_share, 1.0 AS repaired_fraction FROM n""",
)
def _(spark, d):
    return rounded(match.matched_fractions(_repair(spark, d)[0], K), ["matched_fraction", "matched_cell_share"])


@query(
    "A12_matching_statistics",
    f"""WITH {REPAIRED_SQL}, n AS (SELECT patch_id, count(DISTINCT nullif(cell_label, 0)) AS c, count(DISTINCT nullif(cell_matched, 0)) AS cm,
      count(DISTINCT nullif(nucleus_label, 0)) AS u, count(DISTINCT nullif(nucleus_matched, 0)) AS um FROM fx GROUP BY 1)
    SELECT patch_id, c AS whole_cell_total, cm AS whole_cell_matched, c - cm AS whole_cell_unmatched, round(cm * 100 / c, 6) AS whole_cell_matched_percent,
      round((c - cm) * 100 / c, 6) AS whole_cell_unmatched_percent, u AS nucleus_total, um AS nucleus_matched, u - um AS nucleus_unmatched,
      round(um * 100 / u, 6) AS nucleus_matched_percent, round((u - um) * 100 / u, 6) AS nucleus_unmatched_percent FROM n""",
)
def _(spark, d):
    out = match.matching_statistics(_repair(spark, d)[0], K)
    return rounded(out, [c for c in out.columns if c.endswith("percent")])


@query(
    "R24_half_overlap_windows",
    f"""WITH {REPAIRED_SQL}, {WHOLE_SQL}, s AS (SELECT *, least(20, greatest(height, width)) AS sz FROM whole),
    ys AS (SELECT DISTINCT unnest(list_append(range(0, greatest(height - sz, 0) + 1, sz // 2), greatest(height - sz, 0))) AS y0 FROM s),
    xs AS (SELECT DISTINCT unnest(list_append(range(0, greatest(width - sz, 0) + 1, sz // 2), greatest(width - sz, 0))) AS x0 FROM s),
    yn AS (SELECT y0, row_number() OVER (ORDER BY y0) - 1 AS i FROM ys), xn AS (SELECT x0, row_number() OVER (ORDER BY x0) - 1 AS j, count(*) OVER () AS nx FROM xs),
    wn AS (SELECT CAST(i * nx + j AS INTEGER) AS patch_id, CAST(y0 AS INTEGER) AS y_start, CAST(x0 AS INTEGER) AS x_start,
      CAST(least(sz, height - y0) AS INTEGER) AS patch_height, CAST(least(sz, width - x0) AS INTEGER) AS patch_width FROM yn, xn, s),
    q AS (SELECT wn.*, count(DISTINCT nullif(cell_matched, 0)) AS cm, count(DISTINCT nullif(nucleus_matched, 0)) AS nm, count(DISTINCT nullif(cell_label, 0)) AS c, count(DISTINCT nullif(nucleus_label, 0)) AS n
      FROM wn LEFT JOIN fx ON fx.y >= y_start AND fx.y < y_start + patch_height AND fx.x >= x_start AND fx.x < x_start + patch_width GROUP BY ALL)
    SELECT patch_id, y_start, x_start, patch_height, patch_width, cm AS cell_count, nm AS nucleus_count, greatest(0, c - cm) AS unmatched_cells, greatest(0, n - nm) AS unmatched_nuclei,
      round(cm / nullif(c, 0), 6) AS matched_fraction, round(cm / (patch_height * patch_width), 6) AS cell_density FROM q""",
)
def _(spark, d):
    merged = _repair(spark, d)[0].drop("patch_id")
    windows = patches.half_overlap_windows(raster_extent(spark, d), 20)
    return rounded(patches.window_summary(merged, windows), ["matched_fraction", "cell_density"])
