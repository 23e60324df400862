"""Profile tables, quality control, density, bias, regions and sheet queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissuegrid.functions import text
from tissuegrid.operators import bias, density, match, patches, profile, qc, raster, regions, sheets
from tissuegrid.operators.patches import label_offsets
from tissuegrid.plans.catalog import query
from tissuegrid.plans.cells import rounded
from tissuegrid.plans.dataset import CELLS_SQL, PIXELS_SQL, REGIONS_SQL, cells, pixels, table
from tissuegrid.plans.dataset import regions as region_view
from tissuegrid.plans.pixels import CH, K, REPAIRED_SQL, _repair

# --- profile -----------------------------------------------------------------------------------

PATCH_SQL = "patches AS (SELECT DISTINCT patch_id, CAST((patch_id // 2) * 20 AS INTEGER) AS y_start, CAST((patch_id % 2) * 25 AS INTEGER) AS x_start FROM px)"


def patch_table(spark, d):
    return pixels(spark, d).select("patch_id").distinct().select(
        "patch_id",
        F.expr("CAST((patch_id DIV 2) * 20 AS INT)").alias("y_start"),
        F.expr("CAST((patch_id % 2) * 25 AS INT)").alias("x_start"),
    )


@query(
    "P13_unique_channel_names",
    """SELECT CAST(s_suppkey AS INTEGER) AS channel_idx, 'CD' || CAST(s_nationkey AS VARCHAR) AS antibody_name,
    'CD' || CAST(s_nationkey AS VARCHAR) || CASE WHEN row_number() OVER w > 1 THEN '_' || CAST(row_number() OVER w - 1 AS VARCHAR) ELSE '' END AS unique_name
    FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_suppkey)""",
)
def _(spark, d):
    panel = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("int").alias("channel_idx"),
        F.concat(F.lit("CD"), F.col("s_nationkey").cast("string")).alias("antibody_name"),
    )
    return profile.unique_channel_names(panel)


@query(
    "P14_global_ids",
    f"""WITH {PIXELS_SQL}, {PATCH_SQL}, c AS (SELECT patch_id, cell_label AS label, avg(y % 20) AS y, avg(x % 25) AS x FROM px WHERE cell_label > 0 GROUP BY 1, 2)
    SELECT patch_id, label, round(y + y_start, 6) AS y, round(x + x_start, 6) AS x, round(y, 6) AS patch_y, round(x, 6) AS patch_x,
    CAST(label AS VARCHAR) || '_patch_' || CAST(patch_id AS VARCHAR) AS global_cell_id FROM c JOIN patches USING (patch_id)""",
)
def _(spark, d):
    local = pixels(spark, d).where("cell_label > 0").groupBy("patch_id", F.col("cell_label").alias("label")).agg(
        F.avg(F.col("y") % 20).alias("y"), F.avg(F.col("x") % 25).alias("x")
    )
    return rounded(profile.globalise(local, patch_table(spark, d), "patch"), ["y", "x", "patch_y", "patch_x"])


@query(
    "W4_rising_mask_ids",
    f"""WITH {PIXELS_SQL}, m AS (SELECT patch_id, max(cell_label) AS t FROM px GROUP BY 1),
    o AS (SELECT patch_id, coalesce(sum(t) OVER (ORDER BY patch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM m)
    SELECT patch_id, label, CAST(label + off AS BIGINT) AS cell_mask_id FROM (SELECT DISTINCT patch_id, cell_label AS label FROM px WHERE cell_label > 0) JOIN o USING (patch_id)""",
)
def _(spark, d):
    px = pixels(spark, d)
    labels = px.where("cell_label > 0").select("patch_id", F.col("cell_label").alias("label")).distinct()
    return profile.mask_ids(labels, label_offsets(px, "cell_label"))


@query(
    "P15_retained_fraction",
    f"""WITH {REPAIRED_SQL}, a AS (SELECT patch_id, nucleus_matched AS new_label, count(*) AS area FROM fx WHERE nucleus_matched > 0 GROUP BY 1, 2),
    b AS (SELECT patch_id, nucleus_label AS nucleus, count(*) AS area_before FROM fx WHERE nucleus_label > 0 GROUP BY 1, 2)
    SELECT a.patch_id, a.new_label, area AS nucleus_area, CAST(coalesce(area_before, 0) AS DOUBLE) AS nucleus_area_before, round(area / greatest(coalesce(area_before, 0), 1e-6), 6) AS nucleus_retained_fraction,
    area / greatest(coalesce(area_before, 0), 1e-6) < 0.99 AS nucleus_was_trimmed
    FROM a LEFT JOIN mt ON a.patch_id = mt.patch_id AND a.new_label = mt.new_label LEFT JOIN b ON b.patch_id = mt.patch_id AND b.nucleus = mt.nucleus""",
)
def _(spark, d):
    fixed, matches = _repair(spark, d)
    after = fixed.where("nucleus_matched > 0").groupBy("patch_id", F.col("nucleus_matched").alias("new_label")).agg(F.count(F.lit(1)).alias("area"))
    before = fixed.where("nucleus_label > 0").groupBy("patch_id", F.col("nucleus_label").alias("label")).agg(F.count(F.lit(1)).alias("area"))
    kept = profile.with_trim_flag(profile.retained_fractions(after, before, matches, "nucleus", K))
    return rounded(kept, ["nucleus_retained_fraction"])


def _metadata(spark, d):
    """One metadata row per cell with a nucleus mean for two of the markers."""
    return cells(spark, d).select(
        "cell_mask_id",
        "global_cell_id",
        (F.col("cell_mask_id") % 97 + 0.5).alias("y"),
        (F.col("cell_mask_id") % 89 + 0.25).alias("x"),
        (F.col("quantity") * 10).alias("cell_area"),
        (F.col("quantity") * 4).alias("nucleus_area"),
        (F.col("quantity") / 2).alias("quantity_nucleus_mean"),
        (F.col("tax") * 3).alias("tax_nucleus_mean"),
    )


META_SQL = f"""{CELLS_SQL}, meta AS (SELECT cell_mask_id, global_cell_id, cell_mask_id % 97 + 0.5 AS y, cell_mask_id % 89 + 0.25 AS x, quantity * 10 AS cell_area,
  quantity * 4 AS nucleus_area, quantity / 2 AS quantity_nucleus_mean, tax * 3 AS tax_nucleus_mean FROM cells)"""


@query("P10_cell_overview", f"WITH {META_SQL} SELECT cell_mask_id, y, x, cell_area AS area, quantity, price FROM cells JOIN meta USING (cell_mask_id)")
def _(spark, d):
    return profile.cell_overview(cells(spark, d), _metadata(spark, d), ["quantity", "price"])


@query("P11_nucleus_overview", f"WITH {META_SQL} SELECT cell_mask_id, y, x, nucleus_area AS area, quantity_nucleus_mean AS quantity, price FROM cells JOIN meta USING (cell_mask_id)")
def _(spark, d):
    return profile.nucleus_overview(cells(spark, d), _metadata(spark, d), ["quantity", "price"])


@query("P4_move_marker", f"WITH {META_SQL} SELECT cell_mask_id, y, price FROM meta JOIN cells USING (cell_mask_id)")
def _(spark, d):
    meta, _rest = profile.move_marker(_metadata(spark, d), cells(spark, d), "price")
    return meta.select("cell_mask_id", "y", "price")


@query("P12_drop_legacy", f"WITH {CELLS_SQL} SELECT cell_mask_id, quantity, price, discount, tax FROM cells")
def _(spark, d):
    return profile.drop_legacy(cells(spark, d), ["area", "patch_id", "global_cell_id"])


LINES_SQL = """lines AS (SELECT l_orderkey AS cell_mask_id, max(l_extendedprice) AS cell_area, l_shipdate AS seen FROM lineitem GROUP BY 1, 3)"""


def _repeated_metadata(spark, d):
    """Several metadata rows per cell, told apart by date."""
    line = table(spark, d, "lineitem")
    return line.groupBy(F.col("l_orderkey").alias("cell_mask_id"), F.col("l_shipdate").alias("seen")).agg(
        F.max("l_extendedprice").alias("cell_area")
    )


def _overview(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("cell_mask_id"), F.col("o_totalprice").alias("area"), F.col("o_custkey").cast("double").alias("CD4")
    )


@query(
    "J3_refresh_area",
    f"""WITH {LINES_SQL}, f AS (SELECT cell_mask_id, min_by(cell_area, seen) AS a FROM lines GROUP BY 1)
    SELECT o_orderkey AS cell_mask_id, coalesce(a, o_totalprice) AS area, CAST(o_custkey AS DOUBLE) AS CD4 FROM orders LEFT JOIN f ON f.cell_mask_id = o_orderkey""",
)
def _(spark, d):
    return profile.refresh_area(_overview(spark, d), _repeated_metadata(spark, d), "seen")


@query(
    "J4_rebuild_nucleus_overview",
    f"""WITH {LINES_SQL}, f AS (SELECT cell_mask_id, max_by(cell_area, seen) AS a FROM lines GROUP BY 1)
    SELECT o_orderkey AS cell_mask_id, o_orderkey * 1.5 AS y, 2.0 AS x, a AS area, a / 2 AS CD4 FROM orders LEFT JOIN f ON f.cell_mask_id = o_orderkey""",
)
def _(spark, d):
    overview = _overview(spark, d).select("cell_mask_id", (F.col("cell_mask_id") * 1.5).alias("y"), F.lit(2.0).alias("x"), "area", "CD4")
    meta = _repeated_metadata(spark, d).select(
        "cell_mask_id", "seen", F.col("cell_area").alias("nucleus_area"), (F.col("cell_area") / 2).alias("CD4_nucleus_mean")
    )
    return profile.rebuild_nucleus_overview(overview, meta, "seen")


@query("J4_missing_ids", "SELECT DISTINCT o_orderkey AS cell_mask_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(spark, d):
    return profile.missing_from(_overview(spark, d), _repeated_metadata(spark, d))


@query("W8_keep_last", f"WITH {LINES_SQL} SELECT cell_mask_id, max_by(cell_area, seen) AS cell_area FROM lines GROUP BY 1")
def _(spark, d):
    return profile.keep_one(_repeated_metadata(spark, d), "cell_mask_id", "seen", last=True).select("cell_mask_id", "cell_area")


@query("U1_union_of_patch_tables", "SELECT s_suppkey AS cell_mask_id, s_acctbal AS area FROM supplier UNION ALL SELECT c_custkey, c_acctbal FROM customer")
def _(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell_mask_id"), F.col("s_acctbal").alias("area"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("cell_mask_id"), F.col("c_acctbal").alias("area"))
    return s.unionByName(c)


# --- quality control ---------------------------------------------------------------------------

RULES = {"quantity": {"min": 10, "max": 45}, "discount": {"max": 0.09}, "no_such_column": {"min": 1}}
RULE_SQL = "quantity >= 10 AND quantity <= 45 AND discount <= 0.09"


@query("P5_morphology_filter", f"WITH {CELLS_SQL} SELECT cell_mask_id, quantity, discount FROM cells WHERE {RULE_SQL}")
def _(spark, d):
    return qc.filter_cells(cells(spark, d), RULES).select("cell_mask_id", "quantity", "discount")


@query("P5_same_cells_elsewhere", f"WITH {CELLS_SQL} SELECT o_orderkey AS cell_mask_id, o_totalprice AS area, CAST(o_custkey AS DOUBLE) AS CD4 FROM orders JOIN cells ON o_orderkey = cell_mask_id WHERE {RULE_SQL}")
def _(spark, d):
    return qc.keep_cells(_overview(spark, d), qc.filter_cells(cells(spark, d), RULES))


@query("P5_pass_rate", f"WITH {CELLS_SQL} SELECT count(*) AS n_cells, count(*) FILTER (WHERE {RULE_SQL}) AS n_passed, round(count(*) FILTER (WHERE {RULE_SQL}) / count(*), 6) AS pass_rate FROM cells")
def _(spark, d):
    return rounded(qc.pass_rate(cells(spark, d), RULES), ["pass_rate"])


STATS_SQL = f"""{PIXELS_SQL}, st AS (SELECT patch_id, avg(v0) AS nucleus_mean, stddev_pop(v0) AS nucleus_std, avg(CASE WHEN v0 <> 0 THEN 1.0 ELSE 0 END) AS nucleus_non_zero_perc,
  avg(v1) AS wholecell_mean, stddev_pop(v1) AS wholecell_std, avg(CASE WHEN v1 <> 0 THEN 1.0 ELSE 0 END) AS wholecell_non_zero_perc FROM px GROUP BY 1)"""
STATS = ["nucleus_mean", "nucleus_std", "nucleus_non_zero_perc", "wholecell_mean", "wholecell_std", "wholecell_non_zero_perc"]


@query("A9_patch_statistics", f"WITH {STATS_SQL} SELECT patch_id, {', '.join(f'round({c}, 5) AS {c}' for c in STATS)} FROM st")
def _(spark, d):
    return rounded(qc.patch_statistics(pixels(spark, d), "v0", "v1"), STATS, 5)


@query(
    "A8_channel_statistics",
    f"""WITH {PIXELS_SQL}, l AS (SELECT 'v0' AS "Channel", v0 AS v FROM px UNION ALL SELECT 'v1', v1 FROM px)
    SELECT "Channel", min(v) AS "Min", round(median(v), 5) AS "Median", max(v) AS "Max", round(quantile_cont(v, 0.95), 5) AS "95%", round(avg(v), 5) AS "Mean", round(stddev_pop(v), 5) AS "Std Dev" FROM l GROUP BY 1""",
)
def _(spark, d):
    return rounded(qc.channel_statistics(pixels(spark, d), CH), ["Median", "95%", "Mean", "Std Dev"], 5)


@query(
    "P6_patch_flags",
    f"""WITH {STATS_SQL} SELECT patch_id, nucleus_non_zero_perc < 0.05 AS is_empty, nucleus_mean < 25.5 AS is_noisy,
    nucleus_non_zero_perc < 0.05 OR nucleus_mean < 25.5 AS is_bad_patch, NOT (nucleus_non_zero_perc < 0.05 OR nucleus_mean < 25.5) AS is_informative FROM st""",
)
def _(spark, d):
    flagged = qc.flag_patches(qc.patch_statistics(pixels(spark, d), "v0", "v1"), mean=25.5)
    return flagged.select("patch_id", "is_empty", "is_noisy", "is_bad_patch", "is_informative")


@query("P7_informative_pixels", f"WITH {STATS_SQL} SELECT patch_id, count(*) AS n FROM px JOIN st USING (patch_id) WHERE nucleus_mean >= 25.5 GROUP BY 1")
def _(spark, d):
    px = pixels(spark, d)
    flagged = qc.flag_patches(qc.patch_statistics(px, "v0", "v1"), mean=25.5)
    return qc.informative_pixels(px, flagged).groupBy("patch_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P8_flag_from_text",
    """SELECT o_orderkey, coalesce(lower(trim(CASE WHEN o_orderstatus = 'F' THEN ' True' WHEN o_orderstatus = 'O' THEN 'FALSE' END)) = 'true', false) AS is_informative FROM orders""",
)
def _(spark, d):
    raw = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", " True").when(F.col("o_orderstatus") == "O", "FALSE").alias("is_infomative")
    )
    return qc.normalise_flag(raw)


@query(
    "P9_minimum_cells",
    "SELECT l_suppkey, count(*) AS n, CASE WHEN count(*) >= 600 THEN round(avg(l_quantity), 5) END AS score FROM lineitem GROUP BY 1",
)
def _(spark, d):
    scores = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 5).alias("score"))
    return qc.too_few_cells(scores, "n", "score", least=600)


@query(
    "P20_patch_content",
    "SELECT s_suppkey, greatest(coalesce(CASE WHEN s_suppkey % 3 > 0 THEN s_acctbal END, 0), s_nationkey * 10) >= 200 AS has_content FROM supplier",
)
def _(spark, d):
    s = table(spark, d, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 3 > 0, F.col("s_acctbal")).alias("cell_count"),
        (F.col("s_nationkey") * 10).alias("nucleus_count"),
        F.lit(None).cast("double").alias("unmatched_nuclei"),
        F.lit(0).alias("unmatched_cells"),
    )
    return s.select("s_suppkey", qc.has_content().alias("has_content"))


@query("P22_missing_channels", "SELECT DISTINCT n_name AS antibody_name FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) % 2 = 0)")
def _(spark, d):
    nation = table(spark, d, "nation")
    rich = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).count().where("count % 2 = 0").select("n_nationkey")
    panel = nation.join(rich, "n_nationkey", "left_semi").select(F.col("n_name").alias("antibody_name"))
    return qc.require_channels(nation.select(F.col("n_name").alias("antibody_name")), panel)


@query("J10_channel_index", "SELECT n_name AS antibody_name, c_custkey, n_nationkey AS channel_idx FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(spark, d):
    panel = table(spark, d, "nation").select(F.col("n_name").alias("antibody_name"), F.col("n_nationkey").alias("channel_idx"))
    asked = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("antibody_name"))
    return qc.channel_index(asked, panel)


# --- density -----------------------------------------------------------------------------------

LOCAL_SQL = f"""{REPAIRED_SQL}, loc AS (SELECT patch_id, y % 20 AS y, x - (patch_id % 2) * 25 AS x, cell_label, nucleus_label, cell_matched, nucleus_matched FROM fx),
lm AS (SELECT patch_id, 'cell' AS mask, y, x, cell_label AS label FROM loc WHERE cell_label > 0
  UNION ALL SELECT patch_id, 'nucleus', y, x, nucleus_label FROM loc WHERE nucleus_label > 0
  UNION ALL SELECT patch_id, 'repaired_cell', y, x, cell_matched FROM loc WHERE cell_matched > 0
  UNION ALL SELECT patch_id, 'repaired_nucleus', y, x, nucleus_matched FROM loc WHERE nucleus_matched > 0),
ob AS (SELECT patch_id, mask, label, count(*) AS area, avg(y) AS cy, avg(x) AS cx FROM lm GROUP BY 1, 2, 3),
ext AS (SELECT patch_id, max(y) + 1 AS height, max(x) + 1 AS width FROM loc GROUP BY 1),
names(mask) AS (VALUES ('cell'), ('nucleus'), ('repaired_cell'), ('repaired_nucleus')),
grid AS (SELECT patch_id, mask, i AS wi, j AS wj, least(8, height - i * 4) * least(8, width - j * 4) AS px FROM ext, names, unnest(range((height - 1) // 4 + 1)) a(i), unnest(range((width - 1) // 4 + 1)) b(j)),
ld AS (SELECT g.patch_id, g.mask, wi, wj, count(ob.label) / (px * 0.25 / 1e6) AS local_density FROM grid g LEFT JOIN ob ON ob.patch_id = g.patch_id AND ob.mask = g.mask
  AND cy >= wi * 4 AND cy < least(wi * 4 + 8, (SELECT height FROM ext e WHERE e.patch_id = g.patch_id)) AND cx >= wj * 4 AND cx < least(wj * 4 + 8, (SELECT width FROM ext e WHERE e.patch_id = g.patch_id)) GROUP BY 1, 2, 3, 4, px),
gd AS (SELECT patch_id, mask, count(*) AS nobj, sum(area) * 0.25 / 1e6 AS areamm2, count(*) / (sum(area) * 0.25 / 1e6) AS density FROM ob GROUP BY 1, 2),
ls AS (SELECT patch_id, mask, avg(local_density) AS mean, median(local_density) AS median, stddev_pop(local_density) AS std,
  quantile_cont(local_density, 0.25) AS quantile_25, quantile_cont(local_density, 0.75) AS quantile_75 FROM ld GROUP BY 1, 2)"""
MASKS = {k: v for k, v in density.REPORT_MASKS.items() if k != "unmatched_nucleus"}


def _local_pixels(spark, d):
    fixed = _repair(spark, d)[0]
    return fixed.select(
        "patch_id", (F.col("y") % 20).alias("y"), (F.col("x") - (F.col("patch_id") % 2) * 25).alias("x"),
        "v0", "v1", "cell_label", "nucleus_label", "cell_matched", "nucleus_matched",
    )


def _extents(px):
    return px.groupBy("patch_id").agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


def _objects(spark, d):
    px = _local_pixels(spark, d)
    return density.object_table(density.long_masks(px, MASKS, K), K), _extents(px)


@query("A13_mask_density", f"WITH {LOCAL_SQL} SELECT patch_id, mask, nobj, round(areamm2, 9) AS areamm2, round(density, 3) AS density FROM gd")
def _(spark, d):
    out = density.mask_density(_objects(spark, d)[0], K)
    return rounded(rounded(out, ["areamm2"], 9), ["density"], 3)


@query("A14_local_densities", f"WITH {LOCAL_SQL} SELECT patch_id, mask, CAST(wi AS INTEGER) AS wi, CAST(wj AS INTEGER) AS wj, round(local_density, 3) AS local_density FROM ld")
def _(spark, d):
    objects, ext = _objects(spark, d)
    return rounded(density.local_densities(objects, ext, list(MASKS), K, 0.5, 4.0, 2.0), ["local_density"], 3)


@query("J16_objects_in_windows", f"WITH {LOCAL_SQL} SELECT ob.patch_id, ob.mask, label, CAST(wi AS INTEGER) AS wi, CAST(wj AS INTEGER) AS wj FROM ob, unnest(range(6)) a(wi), unnest(range(8)) b(wj) WHERE cy >= wi * 4 AND cy < wi * 4 + 8 AND cx >= wj * 4 AND cx < wj * 4 + 8")
def _(spark, d):
    return density.in_windows(_objects(spark, d)[0], 8, 4).select("patch_id", "mask", "label", "wi", "wj")


L5 = ["mean", "median", "std", "quantile_25", "quantile_75"]


@query("A15_local_summary", f"WITH {LOCAL_SQL} SELECT patch_id, mask, {', '.join(f'round({c}, 3) AS {c}' for c in L5)} FROM ls")
def _(spark, d):
    objects, ext = _objects(spark, d)
    local = density.local_densities(objects, ext, list(MASKS), K, 0.5, 4.0, 2.0)
    return rounded(density.local_summary(local, K), L5, 3)


REPORT_SQL = f"""{LOCAL_SQL}, rp AS (SELECT e.patch_id, n.mask, coalesce(nobj, 0) AS nobj, coalesce(areamm2, 0) AS areamm2, coalesce(density, 0) AS density, mean, median, std, quantile_25, quantile_75
  FROM ext e CROSS JOIN names n LEFT JOIN gd ON gd.patch_id = e.patch_id AND gd.mask = n.mask LEFT JOIN ls ON ls.patch_id = e.patch_id AND ls.mask = n.mask)"""


def _report(spark, d):
    # Windows of 4 px side by side would differ from the sliding ones above, so sizes match: 8 px, step 8.
    px = _local_pixels(spark, d)
    return density.density_report(px, _extents(px), K, MASKS, window_um=4.0)


STEP8_SQL = REPORT_SQL.replace("height - i * 4", "height - i * 8").replace("width - j * 4", "width - j * 8").replace(
    "(height - 1) // 4", "(height - 1) // 8").replace("(width - 1) // 4", "(width - 1) // 8").replace("wi * 4", "wi * 8").replace("wj * 4", "wj * 8")


@query("A16_density_report", f"WITH {STEP8_SQL} SELECT patch_id, mask, nobj, round(areamm2, 9) AS areamm2, round(density, 3) AS density, {', '.join(f'round({c}, 3) AS local_density_{c}' for c in L5)} FROM rp")
def _(spark, d):
    out = _report(spark, d)
    return rounded(rounded(out, ["areamm2"], 9), [c for c in out.columns if "density" in c], 3)


@query(
    "J11_patch_density_columns",
    f"""WITH {STEP8_SQL} SELECT patch_id, any_value(p.y_start) AS y_start, """
    + ", ".join(f"max(CASE WHEN mask = '{m}' THEN nobj END) AS {m}_mask_nobj, round(max(CASE WHEN mask = '{m}' THEN median END), 3) AS {m}_mask_local_density_median" for m in MASKS)
    + f" FROM rp JOIN (SELECT DISTINCT patch_id, (patch_id // 2) * 20 AS y_start FROM px) p USING (patch_id) GROUP BY patch_id",
)
def _(spark, d):
    wide = density.attach_to_patches(patch_table(spark, d).select("patch_id", "y_start"), _report(spark, d), list(MASKS))
    medians = [f"{m}_mask_local_density_median" for m in MASKS]
    return rounded(wide.select("patch_id", "y_start", *[f"{m}_mask_nobj" for m in MASKS], *medians), medians, 3)


@query("A52_density_and_bias_by_patch")
def _(spark, d):
    """Density of all five masks, unmatched nuclei as connected groups, and channel bias, per patch."""
    fixed, matches = _repair(spark, d)
    lost = match.unmatched_objects(fixed, matches, K)
    px = fixed.join(lost, ["patch_id", "y", "x"], "left").withColumn("nucleus_unmatched", F.coalesce("nucleus_unmatched", F.lit(0)))
    local = px.withColumn("y", F.col("y") % 20).withColumn("x", F.col("x") - (F.col("patch_id") % 2) * 25)
    wide = density.attach_to_patches(patch_table(spark, d), density.density_report(local, _extents(local), K, window_um=4.0))
    shift = bias.bias_by_channel(px, CH, K).groupBy("patch_id").pivot("channel", CH).agg(F.first("cell_percent_change"))
    return wide.join(shift, "patch_id", "left")


# --- bias --------------------------------------------------------------------------------------

BIAS_SQL = f"""{REPAIRED_SQL}, bm AS (SELECT patch_id, 'cell_original' AS mask, cell_label AS label, v0, v1 FROM fx WHERE cell_label > 0
  UNION ALL SELECT patch_id, 'cell_repaired', cell_matched, v0, v1 FROM fx WHERE cell_matched > 0
  UNION ALL SELECT patch_id, 'nucleus_original', nucleus_label, v0, v1 FROM fx WHERE nucleus_label > 0
  UNION ALL SELECT patch_id, 'nucleus_repaired', nucleus_matched, v0, v1 FROM fx WHERE nucleus_matched > 0),
om AS (SELECT patch_id, mask, label, avg(v0) AS v0, avg(v1) AS v1 FROM bm GROUP BY 1, 2, 3),
ol AS (SELECT patch_id, mask, label, 'v0' AS channel, v0 AS v FROM om UNION ALL SELECT patch_id, mask, label, 'v1', v1 FROM om),
os AS (SELECT patch_id, channel, mask, avg(v) AS mean, median(v) AS median, stddev_pop(v) AS std FROM ol GROUP BY 1, 2, 3),
ow AS (SELECT patch_id, channel, max(CASE WHEN mask = 'cell_original' THEN mean END) AS co, max(CASE WHEN mask = 'cell_repaired' THEN mean END) AS cr,
  max(CASE WHEN mask = 'nucleus_original' THEN mean END) AS no, max(CASE WHEN mask = 'nucleus_repaired' THEN mean END) AS nr FROM os GROUP BY 1, 2),
ob2 AS (SELECT patch_id, channel, (cr - co) / co * 100 AS cell_percent_change, cr - co AS cell_absolute_change, (nr - no) / no * 100 AS nucleus_percent_change, nr - no AS nucleus_absolute_change FROM ow)"""


def _means(spark, d):
    return bias.object_means_long(_repair(spark, d)[0], bias.pair_masks(), CH, K)


@query("A17_intensity_statistics", f"WITH {BIAS_SQL} SELECT patch_id, channel, mask, round(mean, 5) AS mean, round(std, 5) AS std, round(median, 5) AS median FROM os")
def _(spark, d):
    return rounded(bias.intensity_statistics(_means(spark, d), ["patch_id", "channel", "mask"]), ["mean", "std", "median"], 5)


B4 = ["cell_percent_change", "cell_absolute_change", "nucleus_percent_change", "nucleus_absolute_change"]


@query("A18_repair_bias", f"WITH {BIAS_SQL} SELECT patch_id, channel, {', '.join(f'round({c}, 5) AS {c}' for c in B4)} FROM ob2")
def _(spark, d):
    stats = bias.intensity_statistics(_means(spark, d), ["patch_id", "channel", "mask"])
    return rounded(bias.repair_bias(stats, ["patch_id", "channel"]), B4, 5)


@query(
    "A19_bias_by_channel",
    f"""WITH {BIAS_SQL} SELECT patch_id, channel, {', '.join(f'round({c}, 5) AS {c}' for c in B4)}, """
    + ", ".join(f"round(max(CASE WHEN mask = '{m}' THEN os.{s} END), 5) AS {m}_{s}" for m in bias.pair_masks() for s in ("mean", "median", "std"))
    + " FROM os JOIN ob2 USING (patch_id, channel) GROUP BY patch_id, channel, " + ", ".join(B4),
)
def _(spark, d):
    out = bias.bias_by_channel(_repair(spark, d)[0], CH, K)
    return rounded(out, [c for c in out.columns if c not in ("patch_id", "channel")], 5)


@query("P21_significant_bias", f"WITH {BIAS_SQL} SELECT patch_id, channel FROM ob2 WHERE abs(cell_percent_change) > 0.2 OR abs(nucleus_percent_change) > 0.2")
def _(spark, d):
    return bias.significant_bias(bias.bias_by_channel(_repair(spark, d)[0], CH, K), 0.2).select("patch_id", "channel")


@query(
    "A20_matched_and_unmatched",
    f"""WITH {REPAIRED_SQL}, n AS (SELECT patch_id, nucleus_label AS label, avg(v1) AS v FROM fx WHERE nucleus_label > 0 GROUP BY 1, 2),
    c AS (SELECT patch_id, cell_label AS label, avg(v1) AS v FROM fx WHERE cell_label > 0 GROUP BY 1, 2),
    g AS (SELECT patch_id, 'all_nuclei' AS grp, v FROM n
      UNION ALL SELECT n.patch_id, CASE WHEN mt.nucleus IS NULL THEN 'unmatched_nuclei' ELSE 'matched_nuclei' END, v FROM n LEFT JOIN mt ON mt.patch_id = n.patch_id AND mt.nucleus = n.label
      UNION ALL SELECT c.patch_id, CASE WHEN mt.cell IS NULL THEN 'unmatched_cells' ELSE 'matched_cells' END, v FROM c LEFT JOIN mt ON mt.patch_id = c.patch_id AND mt.cell = c.label)
    SELECT patch_id, grp AS "group", round(avg(v), 5) AS mean, round(median(v), 5) AS median, round(stddev_pop(v), 5) AS std, round(min(v), 5) AS min, round(max(v), 5) AS max, count(*) AS count FROM g GROUP BY 1, 2""",
)
def _(spark, d):
    fixed, matches = _repair(spark, d)
    rows = bias.matched_and_unmatched(fixed, matches, ["v1"], K)
    stats = bias.intensity_statistics(rows, ["patch_id", "group"], extremes=True)
    return rounded(stats, ["mean", "median", "std", "min", "max"], 5)


@query("A20_background_sample", f"WITH {PIXELS_SQL} SELECT y, x, patch_id, v0 FROM px WHERE nucleus_label = 0")
def _(spark, d):
    """Patches here hold fewer background pixels than the limit, so the sample is all of them."""
    return bias.background_sample(pixels(spark, d), ["v0"], K).select("y", "x", "patch_id", "v0")


# --- regions -----------------------------------------------------------------------------------


@query("A50_polygon_area", f"WITH {REGIONS_SQL} SELECT region_id, abs(sum(a.x * b.y - b.x * a.y)) / 2 AS area FROM corners a JOIN corners b USING (region_id) WHERE b.pos = (a.pos + 1) % 4 GROUP BY 1")
def _(spark, d):
    return regions.with_area(region_view(spark, d)).select("region_id", "area")


INSIDE_SQL = f"""{PIXELS_SQL}, {REGIONS_SQL}, hit AS (SELECT region_id, px.y AS y, px.x AS x, v0 FROM px JOIN regions ON px.y BETWEEN y0 AND y0 + 7 AND px.x BETWEEN x0 AND x0 + 7
  WHERE 6 * (px.x - x0) - 1 * (px.y - y0) >= 0 AND 1 * (px.x - x0 - 1) - 5 * (px.y - y0 - 6) >= 0
    AND -6 * (px.x - x0 - 6) - 1 * (px.y - y0 - 7) >= 0 AND -1 * (px.x - x0 - 7) + 7 * (px.y - y0 - 1) >= 0),
big AS (SELECT region_id FROM hit GROUP BY 1 HAVING count(*) >= 10)"""


@query("J14_pixels_in_polygons", f"WITH {INSIDE_SQL} SELECT region_id, y, x, v0 FROM hit JOIN big USING (region_id)")
def _(spark, d):
    return regions.pixels_in_regions(pixels(spark, d), region_view(spark, d)).select("region_id", "y", "x", "v0")


@query(
    "J14_crops",
    f"""WITH {INSIDE_SQL}, b AS (SELECT region_id, min(y) AS ya, max(y) AS yb, min(x) AS xa, max(x) AS xb FROM hit JOIN big USING (region_id) GROUP BY 1),
    f AS (SELECT region_id, ya, xa, i AS y, j AS x FROM b, unnest(range(ya, yb + 1)) r(i), unnest(range(xa, xb + 1)) c(j))
    SELECT f.region_id, CAST(f.y - ya AS INTEGER) AS crop_y, CAST(f.x - xa AS INTEGER) AS crop_x, coalesce(v0, 0.0) AS v0 FROM f LEFT JOIN hit ON hit.region_id = f.region_id AND hit.y = f.y AND hit.x = f.x""",
)
def _(spark, d):
    clipped = regions.clip_to_image(region_view(spark, d), F.lit(10**6), F.lit(10**6))
    return regions.crops(pixels(spark, d), clipped, ["v0"])


# Three slides with the same coordinates; a region belongs to one of them.
SLIDES_SQL = f"""slides AS (SELECT CAST(p_partkey % 3 AS INTEGER) AS image_id, CAST((p_partkey // 3) // 50 AS INTEGER) AS y,
  CAST((p_partkey // 3) % 50 AS INTEGER) AS x, CAST(p_size AS DOUBLE) AS v0 FROM part), {REGIONS_SQL},
hit AS (SELECT s.image_id, region_id, s.y AS y, s.x AS x, v0 FROM slides s JOIN regions r ON s.image_id = r.region_id % 3 AND s.y BETWEEN y0 AND y0 + 7 AND s.x BETWEEN x0 AND x0 + 7
  WHERE 6 * (s.x - x0) - 1 * (s.y - y0) >= 0 AND 1 * (s.x - x0 - 1) - 5 * (s.y - y0 - 6) >= 0
    AND -6 * (s.x - x0 - 6) - 1 * (s.y - y0 - 7) >= 0 AND -1 * (s.x - x0 - 7) + 7 * (s.y - y0 - 1) >= 0),
big AS (SELECT image_id, region_id FROM hit GROUP BY ALL HAVING count(*) >= 10)"""
IMAGE = ["image_id"]


def slides(spark, d):
    at = F.expr("CAST(p_partkey DIV 3 AS BIGINT)")
    return table(spark, d, "part").select(
        (F.col("p_partkey") % 3).cast("int").alias("image_id"), F.floor(at / 50).cast("int").alias("y"),
        (at % 50).cast("int").alias("x"), F.col("p_size").cast("double").alias("v0"),
    )


def _on_slides(rows):
    return rows.withColumn("image_id", (F.col("region_id") % 3).cast("int"))


@query("J14_pixels_in_polygons_by_image", f"WITH {SLIDES_SQL} SELECT image_id, region_id, y, x, v0 FROM hit JOIN big USING (image_id, region_id)")
def _(spark, d):
    found = regions.pixels_in_regions(slides(spark, d), _on_slides(region_view(spark, d)), keys=IMAGE)
    return found.select("image_id", "region_id", "y", "x", "v0")


RECT_SQL = """rects AS (SELECT s_suppkey AS region_id, CASE WHEN s_nationkey % 5 = 0 THEN 'Tissue' ELSE 'N' || CAST(s_nationkey % 5 AS VARCHAR) END AS label,
  s_suppkey // 3 AS y0, (s_suppkey * 11) % 43 AS x0 FROM supplier),
units AS (SELECT DISTINCT label, y0 + i AS uy, x0 + j AS ux FROM rects, unnest(range(7)) a(i), unnest(range(9)) b(j)),
ta AS (SELECT CAST(uy // 8 AS INTEGER) AS ty, CAST(ux // 8 AS INTEGER) AS tx, label, CAST(count(*) AS DOUBLE) AS area FROM units GROUP BY 1, 2, 3)"""


def _rects(spark, d):
    s = table(spark, d, "supplier")
    at = s.select(
        F.col("s_suppkey").alias("region_id"),
        F.when(F.col("s_nationkey") % 5 == 0, "Tissue").otherwise(F.concat(F.lit("N"), (F.col("s_nationkey") % 5).cast("string"))).alias("label"),
        F.expr("CAST(s_suppkey DIV 3 AS DOUBLE)").alias("y0"), F.expr("CAST((s_suppkey * 11) % 43 AS DOUBLE)").alias("x0"),
    )
    ring = F.expr("array(named_struct('y', y0, 'x', x0), named_struct('y', y0 + 7, 'x', x0), named_struct('y', y0 + 7, 'x', x0 + 9), named_struct('y', y0, 'x', x0 + 9))")
    return at.select("region_id", "label", F.array(ring).alias("rings"))


@query("J13_tile_label_areas", f"WITH {RECT_SQL} SELECT ty, tx, label, area FROM ta")
def _(spark, d):
    return rounded(regions.tile_label_areas(_rects(spark, d), 8), ["area"])


@query(
    "J13_tile_labels",
    f"""WITH {PIXELS_SQL}, {RECT_SQL}, t AS (SELECT DISTINCT CAST(y // 8 AS INTEGER) AS ty, CAST(x // 8 AS INTEGER) AS tx FROM px),
    g AS (SELECT t.ty, t.tx, coalesce(sum(CASE WHEN lower(label) = 'tissue' THEN area END), 0) AS tissue, arg_max(label, (area, label)) FILTER (WHERE lower(label) <> 'tissue') AS best FROM t LEFT JOIN ta USING (ty, tx) GROUP BY 1, 2)
    SELECT ty, tx, CASE WHEN (SELECT count(*) FROM rects WHERE label = 'Tissue') > 0 AND tissue / 64 < 0.3 THEN 'minimal_tissue' ELSE coalesce(best, 'Unlabeled') END AS label FROM g""",
)
def _(spark, d):
    tiles = pixels(spark, d).select(F.expr("CAST(y DIV 8 AS INT)").alias("ty"), F.expr("CAST(x DIV 8 AS INT)").alias("tx")).distinct()
    return regions.label_tiles(tiles, _rects(spark, d), 8)


@query(
    "J13_tile_labels_by_image",
    f"""WITH {SLIDES_SQL}, {RECT_SQL.replace("units AS (SELECT DISTINCT label", "iu AS (SELECT DISTINCT CAST(region_id % 3 AS INTEGER) AS image_id, label, y0 + i AS uy, x0 + j AS ux FROM rects, unnest(range(7)) a(i), unnest(range(9)) b(j)), units AS (SELECT DISTINCT label")},
    ia AS (SELECT image_id, CAST(uy // 8 AS INTEGER) AS ty, CAST(ux // 8 AS INTEGER) AS tx, label, CAST(count(*) AS DOUBLE) AS area FROM iu GROUP BY ALL),
    t AS (SELECT DISTINCT image_id, CAST(y // 8 AS INTEGER) AS ty, CAST(x // 8 AS INTEGER) AS tx FROM slides),
    g AS (SELECT t.image_id, t.ty, t.tx, coalesce(sum(CASE WHEN lower(label) = 'tissue' THEN area END), 0) AS tissue, arg_max(label, (area, label)) FILTER (WHERE lower(label) <> 'tissue') AS best FROM t LEFT JOIN ia USING (image_id, ty, tx) GROUP BY ALL)
    SELECT image_id, ty, tx, CASE WHEN image_id IN (SELECT region_id % 3 FROM rects WHERE label = 'Tissue') AND tissue / 64 < 0.3 THEN 'minimal_tissue' ELSE coalesce(best, 'Unlabeled') END AS label FROM g""",
)
def _(spark, d):
    tiles = slides(spark, d).select("image_id", F.expr("CAST(y DIV 8 AS INT)").alias("ty"), F.expr("CAST(x DIV 8 AS INT)").alias("tx")).distinct()
    return regions.label_tiles(tiles, _on_slides(_rects(spark, d)), 8, keys=IMAGE)


_BOX_SQL = """ends AS (SELECT image_id, min(v0) AS lo, (max(v0) - min(v0)) / 256 AS wd FROM pv GROUP BY 1),
  bins AS (SELECT image_id, any_value(lo) AS lo, any_value(wd) AS wd, CASE WHEN wd = 0 THEN 0 ELSE least(255, floor((v0 - lo) / wd)) END AS bin, count(*) AS n FROM pv JOIN ends USING (image_id) GROUP BY image_id, 4),
  cen AS (SELECT image_id, n, lo + (bin + 0.5) * wd AS c FROM bins),
  cut AS (SELECT image_id, c, sum(n) OVER u AS w1, sum(n) OVER dn AS w2, sum(n * c) OVER u AS m1, sum(n * c) OVER dn AS m2 FROM cen
    WINDOW u AS (PARTITION BY image_id ORDER BY c), dn AS (PARTITION BY image_id ORDER BY c ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
  lim AS (SELECT image_id, arg_max(c, (coalesce(CAST(w1 AS DOUBLE) * w2 * power(m1 / w1 - m2 / w2, 2), 0), -c)) AS t FROM cut GROUP BY 1),
  br AS (SELECT image_id, y, x, CAST(y AS BIGINT) * 4294967296 + x AS code FROM pv JOIN lim USING (image_id) WHERE v0 >= t),
  st AS (SELECT a.image_id, a.code AS a, b.code AS b FROM br a JOIN br b ON a.image_id = b.image_id AND abs(a.y - b.y) + abs(a.x - b.x) = 1),
  walk(image_id, node, root) AS (SELECT image_id, code, code FROM br UNION SELECT walk.image_id, st.b, walk.root FROM walk JOIN st ON st.image_id = walk.image_id AND st.a = walk.node WHERE walk.root < st.b),
  part AS (SELECT image_id, node, min(root) AS component FROM walk GROUP BY 1, 2),
  box AS (SELECT image_id, component, count(*) AS area, min(y) * 2 AS min_row, min(x) * 2 AS min_col, (max(y) + 1) * 2 AS max_row, (max(x) + 1) * 2 AS max_col FROM part JOIN br USING (image_id) WHERE br.code = part.node GROUP BY 1, 2)
  SELECT {out} component, area, min_row, min_col, max_row, max_col FROM box WHERE area >= 3 QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY area DESC, component) <= 5"""


@query("R21_automatic_regions", f"WITH RECURSIVE {PIXELS_SQL}, pv AS (SELECT 0 AS image_id, y // 2 AS y, x // 2 AS x, v0 FROM px WHERE y % 2 = 0 AND x % 2 = 0), {_BOX_SQL.format(out='')}")
def _(spark, d):
    preview = raster.stride(pixels(spark, d), 2)
    return regions.automatic_regions(preview, "v0", 2, 5, 3)


@query("R21_automatic_regions_by_image", f"WITH RECURSIVE {SLIDES_SQL}, pv AS (SELECT image_id, y, x, v0 FROM slides), {_BOX_SQL.format(out='image_id,')}")
def _(spark, d):
    return regions.automatic_regions(slides(spark, d), "v0", 2, 5, 3, IMAGE)


@query(
    "R7_exact_tiles_by_image",
    f"""WITH {SLIDES_SQL}, w AS (SELECT image_id, max(y) + 1 AS h, max(x) + 1 AS w FROM slides GROUP BY 1)
    SELECT image_id, CAST((y // 6) * (w // 7) + x // 7 AS BIGINT) AS tile_id, count(*) AS n, sum(v0) AS total FROM slides JOIN w USING (image_id) WHERE y // 6 < h // 6 AND x // 7 < w // 7 GROUP BY 1, 2""",
)
def _(spark, d):
    tiles = patches.exact_tiles_by_image(slides(spark, d), 6, 7, IMAGE)
    return tiles.groupBy("image_id", "tile_id").agg(F.count(F.lit(1)).alias("n"), F.sum("v0").alias("total"))


@query(
    "P14_global_ids_by_image",
    f"""WITH {SLIDES_SQL}, c AS (SELECT image_id, y // 5 AS patch_id, CAST(v0 AS BIGINT) AS label, avg(y % 5) AS y, avg(x) AS x FROM slides GROUP BY ALL)
    SELECT image_id, patch_id, label, round(y + patch_id * 5 + image_id * 100, 6) AS y, round(x, 6) AS x, round(y, 6) AS patch_y, round(x, 6) AS patch_x,
    CAST(image_id AS VARCHAR) || '_' || CAST(label AS VARCHAR) || '_patch_' || CAST(patch_id AS VARCHAR) AS global_cell_id FROM c""",
)
def _(spark, d):
    """Each slide has patches of its own origin; patch numbers repeat."""
    cut = slides(spark, d).withColumn("patch_id", F.expr("CAST(y DIV 5 AS INT)"))
    local = cut.groupBy("image_id", "patch_id", F.col("v0").cast("bigint").alias("label")).agg(F.avg(F.col("y") % 5).alias("y"), F.avg("x").alias("x"))
    origins = cut.select("image_id", "patch_id", (F.col("patch_id") * 5 + F.col("image_id") * 100).alias("y_start"), F.lit(0).alias("x_start")).distinct()
    return rounded(profile.globalise(local, origins, "patch", keys=IMAGE), ["y", "x", "patch_y", "patch_x"])


@query("T2_largest_regions", f"WITH {REGIONS_SQL} SELECT region_id, label, y0 FROM regions ORDER BY x0 DESC, region_id LIMIT 7")
def _(spark, d):
    r = regions.with_bounds(region_view(spark, d))
    return r.orderBy(F.col("min_x").desc(), "region_id").limit(7).select("region_id", "label", F.col("min_y").alias("y0"))


@query(
    "X11_region_labels",
    """SELECT s_suppkey, regexp_replace(CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey AS VARCHAR) WHEN s_suppkey % 4 = 1 THEN s_name WHEN s_suppkey % 4 = 2 THEN 'Area ' || CAST(s_nationkey AS VARCHAR) ELSE CAST(s_suppkey AS VARCHAR) END, '[^A-Za-z0-9_-]', '_', 'g') AS label FROM supplier""",
)
def _(spark, d):
    k = F.col("s_suppkey")
    idx = F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit(".0")))
    name = F.when(k % 4 == 1, F.col("s_name"))
    cls = F.when(k % 4 == 2, F.concat(F.lit("Area "), F.col("s_nationkey").cast("string")))
    return table(spark, d, "supplier").select("s_suppkey", text.safe_label(idx, name, cls, k).alias("label"))


# --- sheets ------------------------------------------------------------------------------------

FIELDS = [
    sheets.Field("exp_id", "str", required=True, regex=r"E\d+"),
    sheets.Field("priority", "int", required=True, min=1, max=4),
    sheets.Field("price", "float", min=2000.0),
    sheets.Field("urgent", "bool", default=False),
    sheets.Field("mode", "str", choices=["O", "F"]),
    sheets.Field("parts", "list[int]"),
    sheets.Field("file", "path", allow_relative=False, extensions=[".tif", ".ome.tiff"]),
]
SHEET_RULES = [
    {"type": "require_if", "if": {"key": "mode", "equals": "F"}, "required_keys": ["urgent"]},
    {"type": "forbid_if", "if": {"key": "mode", "equals": "O"}, "forbidden_when_set": ["price"]},
    {"type": "range_if", "if": {"key": "priority", "in": [2, 3]}, "key": "price", "max": 400000.0},
]


def _sheet(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        k.alias("row_index"),
        F.concat(F.when(k % 50 == 0, F.lit("X")).otherwise(F.lit(" E")), k.cast("string")).alias("exp_id"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.when(k % 9 == 0, F.lit("none")).when(k % 10 == 3, F.lit("much")).otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("price"),
        F.when(k % 3 == 0, F.lit("Yes")).when(k % 3 == 1, F.lit("maybe")).alias("urgent"),
        F.col("o_orderstatus").alias("mode"),
        F.concat_ws(", ", k.cast("string"), (k + 1).cast("string"), F.when(k % 31 == 0, "x")).alias("parts"),
        F.concat(F.when(k % 40 == 0, "").otherwise("/"), F.lit("a/"), k.cast("string"), F.when(k % 23 == 0, ".png").otherwise(".OME.TIFF")).alias("file"),
    )


SHEET_SQL = """sheet AS (SELECT o_orderkey AS row_index, o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE 'E' END || CAST(o_orderkey AS VARCHAR) AS exp_id,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority, CASE WHEN o_orderkey % 9 = 0 OR o_orderkey % 10 = 3 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS price,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS shown, o_orderstatus AS mode FROM orders),
fe AS (SELECT *, list_filter([
  CASE WHEN k % 50 = 0 THEN 'column ''exp_id'': value does not match required pattern' END,
  CASE WHEN priority > 4 THEN 'column ''priority'': value 5 above maximum 4' END,
  CASE WHEN k % 9 <> 0 AND k % 10 = 3 THEN 'column ''price'': expected float' WHEN price < 2000 THEN 'column ''price'': low' END,
  CASE WHEN k % 3 = 1 THEN 'column ''urgent'': expected boolean' END,
  CASE WHEN mode NOT IN ('O', 'F') THEN 'column ''mode'': value ''' || mode || ''' not in allowed choices [''O'', ''F'']' END,
  CASE WHEN k % 31 = 0 THEN 'column ''parts'': expected integer in list' END,
  CASE WHEN k % 40 = 0 THEN 'column ''file'': expected absolute path' WHEN k % 23 = 0 THEN 'column ''file'': file extension not allowed; expected one of: .tif, .ome.tiff' END], lambda e: e IS NOT NULL) AS f FROM sheet),
re AS (SELECT *, CASE WHEN len(f) > 0 THEN f ELSE list_filter([
  CASE WHEN mode = 'O' AND price IS NOT NULL THEN 'column ''price'': value is not allowed when condition holds' END,
  CASE WHEN priority IN (2, 3) AND price IS NULL THEN 'column ''price'': value is required' END,
  CASE WHEN priority IN (2, 3) AND price > 400000 THEN 'column ''price'': big' END], lambda e: e IS NOT NULL) END AS e FROM fe)"""


def _checked(spark, d):
    return sheets.validate(_sheet(spark, d), FIELDS, SHEET_RULES)


def _short(e):
    """Row prefix checked and cut, and shown numbers left out: engines print doubles differently."""
    body = F.regexp_replace(e, r"^Row \d+, ", "")
    body = F.when(body.contains("below minimum"), "column 'price': low").otherwise(body)
    return F.when(body.contains("above maximum 400000"), "column 'price': big").otherwise(body)


@query("P24_sheet_errors", f"WITH {SHEET_SQL} SELECT row_index, array_to_string(f, '; ') AS errors FROM fe WHERE len(f) > 0")
def _(spark, d):
    bad = sheets.split_valid(sheets.validate(_sheet(spark, d), FIELDS))[1]
    return bad.select("row_index", F.array_join(F.transform("errors", _short), "; ").alias("errors"))


@query("P25_sheet_rule_errors", f"WITH {SHEET_SQL} SELECT row_index, array_to_string(e, '; ') AS errors FROM re WHERE len(e) > 0")
def _(spark, d):
    bad = sheets.split_valid(_checked(spark, d))[1]
    return bad.select("row_index", F.array_join(F.transform("errors", _short), "; ").alias("errors"))


@query("P24_typed_rows", f"WITH {SHEET_SQL} SELECT row_index, exp_id, priority, price, k % 3 = 0 AS urgent, mode, CAST(k + k + 1 AS BIGINT) AS part_sum FROM re WHERE len(e) = 0")
def _(spark, d):
    good = sheets.split_valid(_checked(spark, d))[0]
    total = F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return good.select("row_index", "exp_id", "priority", "price", "urgent", "mode", total.alias("part_sum"))


@query("P23_header_errors", "SELECT region || ': missing required column ''exp_id''' AS error FROM (SELECT r_name AS region FROM region)")
def _(spark, d):
    names = table(spark, d, "region")
    found = sheets.check_header(names.columns, [sheets.Field("exp_id", required=True), sheets.Field("r_name"), sheets.Field("r_regionkey")])
    return names.select(F.explode(F.array(*[F.concat("r_name", F.lit(f": {e}")) for e in found])).alias("error"))


@query("P26_preprocess_defaults", "SELECT p_partkey, p_size % 2 = 0 AS visualize, CASE WHEN p_size % 2 = 0 AND (p_size < 20 OR p_size > 40) THEN 64 WHEN p_size > 40 THEN NULL ELSE p_size - 19 END AS downscale_factor FROM part")
def _(spark, d):
    raw = table(spark, d, "part").select(
        "p_partkey", (F.col("p_size") % 2 == 0).alias("visualize"), F.when(F.col("p_size") <= 40, F.col("p_size") - 19).alias("downscale_factor")
    )
    return sheets.preprocess_defaults(raw)
