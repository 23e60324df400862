"""Operators chosen by name or by a rule table, and the image-to-mask join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tissuegrid.operators import normalize as nz
from tissuegrid.operators import objects, patches, qc, raster
from tissuegrid.plans.catalog import query
from tissuegrid.plans.cells import rounded
from tissuegrid.plans.dataset import CELLS_SQL, PIXELS_SQL, cells, pixels
from tissuegrid.plans.pixels import EXTENT_SQL, K, PERIMETER_SQL, extents


@query(
    "J1_image_and_masks",
    f"WITH {PIXELS_SQL} SELECT a.y, a.x, a.v0, b.cell_label FROM px a JOIN px b ON a.patch_id = b.patch_id AND a.y = b.y AND a.x = b.x WHERE b.cell_label > 0",
)
def _(spark, d):
    px = pixels(spark, d)
    image, masks = px.select("patch_id", "y", "x", "v0"), px.where("cell_label > 0").select("patch_id", "y", "x", "cell_label")
    return image.join(masks, ["patch_id", "y", "x"]).select("y", "x", "v0", "cell_label")


@query(
    "E1_normalisers_by_name",
    f"WITH {CELLS_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS norm, count(*) AS n_cells FROM cells" for n in sorted(nz.NORMALISERS)),
)
def _(spark, d):
    table = cells(spark, d)
    parts = [nz.prepare(table, n).agg(F.lit(n).alias("norm"), F.count("price").alias("n_cells")) for n in sorted(nz.NORMALISERS)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "E2_split_modes_by_name",
    f"""WITH {EXTENT_SQL} SELECT 'full_image' AS mode, count(*) AS n, CAST(sum(height * width) AS BIGINT) AS area FROM ext
    UNION ALL SELECT 'halves', 2 * count(*), CAST(sum(height * width) AS BIGINT) FROM ext
    UNION ALL SELECT 'patches', CAST(sum((height // 50) * (width // 50)) AS BIGINT), CAST(sum((height // 50) * (width // 50)) * 2500 AS BIGINT) FROM ext
    UNION ALL SELECT 'quarters', 4 * count(*), CAST(sum(height * width) AS BIGINT) FROM ext""",
)
def _(spark, d):
    sizes = extents(spark, d)
    parts = []
    for mode in sorted(patches.SPLIT_MODES):
        options = {"patch_height": 50, "patch_width": 50} if mode == "patches" else {}
        boxes = patches.split(sizes, mode, **options)
        area = F.sum((F.col("patch_height") * F.col("patch_width")).cast("bigint"))
        parts.append(boxes.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"), area.alias("area")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "E3_disruption_by_name",
    f"""WITH {PIXELS_SQL}, l AS (SELECT *, y % 20 AS py, x % 25 AS qx FROM px),
    e AS (SELECT patch_id, oy, ox, v1, least((py + 1) * (14 / 20), oy + 1) - greatest(py * (14 / 20), oy) AS wy, least((qx + 1) * (17 / 25), ox + 1) - greatest(qx * (17 / 25), ox) AS wx
      FROM l, unnest(range(14)) a(oy), unnest(range(17)) b(ox))
    SELECT patch_id, CAST(oy AS INTEGER) AS y, CAST(ox AS INTEGER) AS x, round(sum(wy * wx * v1) / sum(wy * wx), 4) AS v1
    FROM e WHERE wy > 1e-12 AND wx > 1e-12 GROUP BY 1, 2, 3""",
)
def _(spark, d):
    local = pixels(spark, d).withColumn("y", F.col("y") % 20).withColumn("x", F.col("x") % 25)
    return rounded(raster.disrupt(local, "downsampling", ["v1"], 2, height=20, width=25), ["v1"], 4)


@query(
    "E4_chosen_properties",
    f"WITH p AS (WITH {PERIMETER_SQL}), {PIXELS_SQL} SELECT patch_id, label, any_value(perimeter) AS perimeter, count(*) AS area FROM px JOIN p USING (patch_id) WHERE cell_label = label GROUP BY 1, 2",
)
def _(spark, d):
    table = objects.region_properties(pixels(spark, d), "cell_label", K, ["moments", "perimeter"])
    return rounded(table.select("patch_id", "label", "perimeter", "area"), ["perimeter"], 5)


RULE_TABLE = [("price", "min", 20000.0), ("price", "max", 90000.0), ("tax", "max", 0.07), ("absent", "min", 1.0)]


@query("E5_rule_table", f"WITH {CELLS_SQL} SELECT cell_mask_id, price >= 20000 AND price <= 90000 AND tax <= 0.07 AS passed FROM cells")
def _(spark, d):
    rules: dict[str, dict[str, float]] = {}
    for column, side, bound in RULE_TABLE:
        rules.setdefault(column, {})[side] = bound
    table = cells(spark, d)
    return table.select("cell_mask_id", qc.rule_predicate(table.columns, rules).alias("passed"))
