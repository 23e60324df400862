"""Report, summary, scalar, source and sink queries."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from tissuegrid.functions import text
from tissuegrid.operators import objects, scoring, summary
from tissuegrid.plans.catalog import query
from tissuegrid.plans.cells import RANKED_SQL, _de, rounded
from tissuegrid.plans.dataset import (
    CELLS_SQL, LONG_SQL, MARKERS, PIXELS_SQL, REGIONS_SQL, cells, long_measurements, measurements, pixels, regions, table,
)
from tissuegrid.plans.pixels import CH, K, REPAIRED_SQL, _repair, shape_sql
from tissuegrid.plans.reports import _metadata, patch_table
from tissuegrid.runtime import stage_folder
from tissuegrid.sources import documents, listing, sinks, tables


def scratch(spark, name: str) -> str:
    """A folder of this run; it goes when the session's Python process ends."""
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- statistics --------------------------------------------------------------------------------


@query(
    "A21_marker_statistics",
    f"""WITH {LONG_SQL}, s AS (SELECT feature, avg(v) AS mean, median(v) AS median, stddev_samp(v) AS std, min(v) AS min, max(v) AS max, median(v) + stddev_samp(v) AS t FROM long GROUP BY 1)
    SELECT feature, round(mean, 5) AS mean, round(median, 5) AS median, round(std, 5) AS std, min, max, round(t, 5) AS positive_threshold,
    count(*) FILTER (WHERE v > t) AS positive_cells, round(count(*) FILTER (WHERE v > t) * 100 / count(*), 5) AS positive_percentage
    FROM long JOIN s USING (feature) GROUP BY feature, mean, median, std, min, max, t""",
)
def _(spark, d):
    out = summary.marker_statistics(long_measurements(spark, d))
    return rounded(out, ["mean", "median", "std", "positive_threshold", "positive_percentage"], 5)


@query(
    "A22_cell_report",
    "SELECT count(*) AS total_cells, round(avg(o_totalprice), 4) AS mean_cell_area, round(stddev_samp(o_totalprice), 4) AS cell_area_std, round(median(o_totalprice), 4) AS median_cell_area, round(avg(o_totalprice) * 0.25, 4) AS mean_cell_area_um2, round(median(o_totalprice) * 0.25, 4) AS median_cell_area_um2 FROM orders",
)
def _(spark, d):
    out = summary.cell_report(table(spark, d, "orders").withColumnRenamed("o_totalprice", "area"), mpp=0.5)
    return rounded(out, [c for c in out.columns if c != "total_cells"], 4)


PATCHES_SQL = """pt AS (SELECT s_suppkey AS patch_id, s_nationkey % 3 > 0 AS is_informative, s_acctbal AS nucleus_mean, s_acctbal / 2 AS wholecell_mean, s_nationkey * 10 AS n_cells,
  CASE WHEN s_nationkey % 4 > 0 THEN s_acctbal / 10000 END AS quality_score, (s_nationkey + 1) / 26.0 AS matched_fraction FROM supplier)"""


def _patches(spark, d):
    n = F.col("s_nationkey")
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("patch_id"), (n % 3 > 0).alias("is_informative"), F.col("s_acctbal").alias("nucleus_mean"),
        (F.col("s_acctbal") / 2).alias("wholecell_mean"), (n * 10).alias("n_cells"),
        F.when(n % 4 > 0, F.col("s_acctbal") / 10000).alias("quality_score"), ((n + 1) / 26.0).alias("matched_fraction"),
    )


@query(
    "A22_patch_report",
    f"""WITH {PATCHES_SQL} SELECT count(*) AS total_patches, count(*) FILTER (WHERE is_informative) AS informative_patches, round(avg(nucleus_mean), 4) AS mean_nucleus_intensity,
    round(avg(wholecell_mean), 4) AS mean_wholecell_intensity, CAST(sum(n_cells) AS BIGINT) AS total_cells, round(avg(quality_score), 6) AS mean_quality_score, round(avg(matched_fraction), 6) AS mean_matched_fraction,
    round(min(matched_fraction), 6) AS min_matched_fraction, round(max(matched_fraction), 6) AS max_matched_fraction FROM pt""",
)
def _(spark, d):
    out = summary.patch_report(_patches(spark, d))
    out = rounded(out, ["mean_nucleus_intensity", "mean_wholecell_intensity"], 4)
    return rounded(out, ["mean_quality_score", "mean_matched_fraction", "min_matched_fraction", "max_matched_fraction"])


@query(
    "A24_score_summary",
    f"""WITH {PATCHES_SQL} SELECT count(*) AS informative_patches, count(quality_score) AS evaluated_patches, round(avg(quality_score), 6) AS quality_score_mean, round(stddev_pop(quality_score), 6) AS quality_score_std,
    round(min(quality_score), 6) AS quality_score_min, round(max(quality_score), 6) AS quality_score_max, round(median(quality_score), 6) AS quality_score_median, (SELECT count(*) FROM pt) AS total_patches FROM pt WHERE is_informative""",
)
def _(spark, d):
    out = summary.score_summary(_patches(spark, d))
    return rounded(out, [c for c in out.columns if c.startswith("quality")])


@query("J12_patch_scores", f"WITH {PATCHES_SQL} SELECT o_orderkey AS patch_id, round(quality_score, 6) AS quality_score FROM orders LEFT JOIN pt ON patch_id = o_orderkey")
def _(spark, d):
    ids = table(spark, d, "orders").select(F.col("o_orderkey").alias("patch_id"))
    return rounded(summary.with_scores(ids, _patches(spark, d)), ["quality_score"])


@query(
    "T3_best_and_worst",
    f"""WITH {PATCHES_SQL}, g AS (SELECT patch_id, round(quality_score, 8) AS metric FROM pt WHERE is_informative AND quality_score IS NOT NULL)
    (SELECT *, 'top' AS side FROM g ORDER BY metric DESC, patch_id LIMIT 3) UNION ALL (SELECT *, 'bottom' FROM g ORDER BY metric, patch_id LIMIT 3)""",
)
def _(spark, d):
    return rounded(summary.best_and_worst(_patches(spark, d)), ["metric"], 8)


SHAPE_COLUMNS = ("area", "axis_major_length", "axis_minor_length", "eccentricity")
_SHOWN = summary.SHAPE_PERCENTILES
_CUTS = sorted({p for ps in _SHOWN.values() for p in ps})
SHAPES_SQL = f"""{PIXELS_SQL}, {shape_sql('cell_label', 's')}, ml AS (SELECT 'area' AS measure, CAST(area AS DOUBLE) AS v FROM s UNION ALL SELECT 'eccentricity', eccentricity FROM s
  UNION ALL SELECT 'aspect_ratio', axis_major_length / axis_minor_length FROM s WHERE axis_minor_length > 0)"""


@query(
    "A23_shape_percentiles",
    f"WITH {SHAPES_SQL} SELECT measure, round(avg(v), 5) AS mean, round(stddev_pop(v), 5) AS std, "
    + ", ".join(
        f"CASE WHEN measure IN ({', '.join(repr(m) for m, ps in _SHOWN.items() if p in ps)}) THEN round(quantile_cont(v, {p / 100}), 5) END AS p{p}" for p in _CUTS
    )
    + " FROM ml GROUP BY measure",
)
def _(spark, d):
    out = summary.shape_percentiles(objects.moments(pixels(spark, d), "cell_label", K))
    return rounded(out, [c for c in out.columns if c != "measure"], 5)


@query(
    "K10_suggested_thresholds",
    f"WITH {SHAPES_SQL} SELECT round(quantile_cont(v, 0.01) FILTER (WHERE measure = 'area'), 5) AS undersized, round(quantile_cont(v, 0.99) FILTER (WHERE measure = 'area'), 5) AS oversized, round(quantile_cont(v, 0.95) FILTER (WHERE measure = 'eccentricity'), 5) AS high_eccentricity FROM ml",
)
def _(spark, d):
    """Written as one JSON text and read back."""
    cuts = summary.suggested_thresholds(summary.shape_percentiles(objects.moments(pixels(spark, d), "cell_label", K)))
    path = scratch(spark, "thresholds")
    sinks.one_json(cuts, path)
    back = spark.read.schema("undersized double, oversized double, high_eccentricity double").json(path)
    return rounded(back, back.columns, 5)


@query(
    "A25_quality_map",
    f"""WITH {PIXELS_SQL}, s AS (SELECT patch_id, cell_label, count(*) AS n FROM px GROUP BY 1, 2)
    SELECT patch_id, round(count(*) FILTER (WHERE cell_label > 0) / (sum(n) * 0.25 / 1e6), 3) AS cell_density, round(avg(n) FILTER (WHERE cell_label > 0), 5) AS mean_cell_area FROM s GROUP BY 1""",
)
def _(spark, d):
    out = summary.quality_map(pixels(spark, d), K, "cell_label")
    return rounded(rounded(out, ["cell_density"], 3), ["mean_cell_area"], 5)


@query(
    "A28_collection_summary",
    """WITH r AS (SELECT c_mktsegment AS report_type, c_custkey * 10 AS file_size, CASE WHEN c_nationkey > 3 THEN c_nationkey END AS cell_count FROM customer)
    SELECT report_type, count(*) AS n_reports, CAST(sum(file_size) AS BIGINT) AS total_size, CAST(sum(coalesce(cell_count, 0)) AS BIGINT) AS total_cells, count(*) FILTER (WHERE cell_count IS NULL) AS missing_counts FROM r GROUP BY GROUPING SETS ((), (report_type))""",
)
def _(spark, d):
    r = table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("report_type"), (F.col("c_custkey") * 10).alias("file_size"), F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("cell_count")
    )
    return summary.collection_summary(r)


@query("A29_class_weights", "WITH c AS (SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1), w AS (SELECT *, 1 / (n + 1e-6) AS w FROM c) SELECT label, n, round(w / sum(w) OVER () * count(*) OVER (), 6) AS weight FROM w")
def _(spark, d):
    return rounded(summary.class_weights(table(spark, d, "events").withColumnRenamed("event_type", "label")), ["weight"])


@query(
    "A44_histogram",
    """WITH e AS (SELECT event_type, value, min(value) OVER (PARTITION BY event_type) AS lo, max(value) OVER (PARTITION BY event_type) AS hi FROM events)
    SELECT event_type, CAST(least(49, floor((value - lo) * 50 / (hi - lo))) AS INTEGER) AS bin, count(*) AS n FROM e GROUP BY 1, 2""",
)
def _(spark, d):
    return summary.histogram(table(spark, d, "events"), "value", ["event_type"])


@query("A44_box_statistics", "SELECT event_type, round(quantile_cont(value, 0.25), 5) AS q25, round(median(value), 5) AS median, round(quantile_cont(value, 0.75), 5) AS q75 FROM events GROUP BY 1")
def _(spark, d):
    return rounded(summary.box_statistics(table(spark, d, "events"), "value", ["event_type"]), ["q25", "median", "q75"], 5)


@query(
    "A45_density_curve",
    """WITH s AS (SELECT event_type, count(*) AS n, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1), p AS (SELECT *, sd * power(n, -0.2) AS h FROM s),
    b AS (SELECT event_type, least(4095, floor((value - lo) / ((hi - lo) / 4096))) AS slot, count(*) AS c FROM events JOIN p USING (event_type) GROUP BY 1, 2),
    g AS (SELECT event_type, CAST(i AS INTEGER) AS i, lo - 3 * h + i * (hi - lo + 6 * h) / 49 AS x, n, h, lo, hi FROM p, unnest(range(50)) r(i))
    SELECT event_type, g.i, round(x, 4) AS at, round(sum(CASE WHEN abs(x - (lo + (slot + 0.5) * (hi - lo) / 4096)) <= 8 * h THEN exp(-power((x - (lo + (slot + 0.5) * (hi - lo) / 4096)) / h, 2) / 2) / (h * sqrt(2 * pi())) * c ELSE 0 END) / any_value(n), 8) AS density
    FROM g JOIN b USING (event_type) GROUP BY 1, 2, 3 HAVING sum(CASE WHEN abs(x - (lo + (slot + 0.5) * (hi - lo) / 4096)) <= 8 * h THEN 1 ELSE 0 END) > 0""",
)
def _(spark, d):
    out = summary.density_curve(table(spark, d, "events"), "value", ["event_type"], points=50)
    return rounded(rounded(out, ["at"], 4), ["density"], 8)


@query(
    "A46_pearson",
    "WITH c AS (SELECT l_quantity AS quantity, l_extendedprice AS price, abs(l_discount) AS discount, abs(l_tax) AS tax FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM c" for a in MARKERS for b in MARKERS),
)
def _(spark, d):
    return rounded(summary.pearson(measurements(spark, d), MARKERS), ["r"])


def _rank_sql(c):
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"


@query(
    "A46_spearman",
    f"WITH {CELLS_SQL}, c AS (SELECT {', '.join(_rank_sql(c) for c in MARKERS)} FROM cells) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM c" for a in MARKERS for b in MARKERS),
)
def _(spark, d):
    return rounded(summary.spearman(cells(spark, d), MARKERS, "cell_mask_id"), ["r"])


@query(
    "A46_kendall",
    """WITH c AS (SELECT c_custkey AS id, c_acctbal AS a, c_nationkey AS b FROM customer), p AS (SELECT sign(x.a - y.a) AS s, sign(x.b - y.b) AS t FROM c x JOIN c y ON x.id < y.id)
    SELECT 'c_acctbal' AS a, 'c_nationkey' AS b, round(sum(s * t) / sqrt(CAST(count(*) FILTER (WHERE s <> 0) AS DOUBLE) * count(*) FILTER (WHERE t <> 0)), 8) AS tau FROM p""",
)
def _(spark, d):
    return rounded(summary.kendall(table(spark, d, "customer"), "c_acctbal", "c_nationkey"), ["tau"], 8)


@query(
    "A47_metric_pairs",
    """WITH e AS (SELECT min(l_quantity) AS ql, max(l_quantity) AS qh, min(l_extendedprice) AS pl, max(l_extendedprice) AS ph FROM lineitem)
    SELECT 'quantity' AS a, 'price' AS b, CAST(least(19, floor((l_quantity - ql) / ((qh - ql) / 20))) AS INTEGER) AS bin_a, CAST(least(19, floor((l_extendedprice - pl) / ((ph - pl) / 20))) AS INTEGER) AS bin_b, count(*) AS n FROM lineitem, e GROUP BY 1, 2, 3, 4""",
)
def _(spark, d):
    return summary.metric_pair_bins(measurements(spark, d), ["quantity", "price"], 20)


def _roots_sql() -> str:
    """Eigenvalues of the correlation matrix of four markers: roots of its characteristic polynomial, largest first.

    All roots are real, so Newton's steps from above fall on the largest one; dividing it out leads to the next.
    """
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    c = {p: f"c{p[0]}{p[1]}" for p in pairs}
    threes = [(i, j, k) for i in range(4) for j in range(i + 1, 4) for k in range(j + 1, 4)]
    squares = " + ".join(f"{x} * {x}" for x in c.values())
    triples = " + ".join(f"{c[i, j]} * {c[j, k]} * {c[i, k]}" for i, j, k in threes)
    opposite = " + ".join(f"{a} * {a} * {b} * {b}" for a, b in ((c[0, 1], c[2, 3]), (c[0, 2], c[1, 3]), (c[0, 3], c[1, 2])))
    rings = " + ".join(" * ".join(c[p] for p in r) for r in (((0, 1), (1, 2), (2, 3), (0, 3)), ((0, 1), (1, 3), (2, 3), (0, 2)), ((0, 2), (1, 2), (1, 3), (0, 3))))
    cors = ", ".join(f"corr({MARKERS[i]}, {MARKERS[j]}) AS {c[i, j]}" for i, j in pairs)
    third = " + ".join(f"(1 + 2 * {c[i, j]} * {c[j, k]} * {c[i, k]} - {c[i, j]} * {c[i, j]} - {c[j, k]} * {c[j, k]} - {c[i, k]} * {c[i, k]})" for i, j, k in threes)
    return f"""m AS (SELECT l_quantity AS quantity, l_extendedprice AS price, abs(l_discount) AS discount, abs(l_tax) AS tax FROM lineitem),
    k AS (SELECT count(*) AS n, {cors} FROM m),
    e AS (SELECT n, -4.0 AS p3, 6 - ({squares}) AS p2, -({third}) AS p1, 1 - ({squares}) + 2 * ({triples}) + {opposite} - 2 * ({rings}) AS p0 FROM k),
    r1 AS (SELECT 0 AS i, CAST(4 AS DOUBLE) AS x FROM e UNION ALL SELECT i + 1, x - coalesce(((((x + p3) * x + p2) * x + p1) * x + p0) / nullif(((4 * x + 3 * p3) * x + 2 * p2) * x + p1, 0), 0) FROM r1, e WHERE i < 200),
    v1 AS (SELECT x AS a FROM r1 WHERE i = 200),
    q AS (SELECT n, a, p3 + a AS b2, p2 + a * (p3 + a) AS b1, p1 + a * (p2 + a * (p3 + a)) AS b0 FROM e, v1),
    r2 AS (SELECT 0 AS i, a AS x FROM q UNION ALL SELECT i + 1, x - coalesce((((x + b2) * x + b1) * x + b0) / nullif((3 * x + 2 * b2) * x + b1, 0), 0) FROM r2, q WHERE i < 200),
    v AS (SELECT n, a, x AS b, b2 + x AS d1, b1 + x * (b2 + x) AS d0 FROM q, r2 WHERE i = 200)"""


@query(
    "A48_principal_components",
    f"WITH RECURSIVE {_roots_sql()} SELECT round(a, 5) AS var1, round(b, 5) AS var2, round((-d1 + sqrt(greatest(d1 * d1 - 4 * d0, 0))) / 2, 5) AS var3, round((a + b + (-d1 + sqrt(greatest(d1 * d1 - 4 * d0, 0))) / 2) / 4, 6) AS explained FROM v",
)
def _(spark, d):
    """Scores of all rows; their variances are those of the components."""
    m = measurements(spark, d)
    axes = summary.principal_axes(m, MARKERS, 3, standardise=True)
    scored = summary.project(m, MARKERS, axes)
    total = F.expr("round(aggregate(shares, CAST(0 AS DOUBLE), (s, e) -> s + e), 6)")
    return scored.agg(*[F.round(F.var_pop(F.col("pcs")[i]), 5).alias(f"var{i + 1}") for i in range(3)]).withColumn("explained", axes.select(total.alias("t")).scalar())


@query(
    "A48_two_components",
    """WITH c AS (SELECT var_pop(l_quantity) AS a, var_pop(l_tax * 100) AS b, covar_pop(l_quantity, l_tax * 100) AS c FROM lineitem)
    SELECT round(((a + b) / 2 + sqrt(((a - b) / 2)**2 + c * c)) / (a + b), 6) AS first_share FROM c""",
)
def _(spark, d):
    two = table(spark, d, "lineitem").select("l_quantity", (F.col("l_tax") * 100).alias("tax"))
    return summary.principal_axes(two, ["l_quantity", "tax"], 2).select(F.round(F.col("shares")[0], 6).alias("first_share"))


@query("G7_two_dimensional_view")
def _(spark, d):
    emb = table(spark, d, "embeddings")
    out, _axes = summary.vector_components(emb, "embedding", 2)
    return out.select("vec_id", "label", F.col("pcs")[0].alias("x"), F.col("pcs")[1].alias("y"))


_TILT_SQL = """s AS (SELECT *, (v0 - avg(v0) OVER w) / stddev_pop(v0) OVER w AS z0, (v1 - avg(v1) OVER w) / stddev_pop(v1) OVER w AS z1 FROM {src} WINDOW w AS (PARTITION BY {key})),
  g AS (SELECT *, sign(corr(z0, z1) OVER (PARTITION BY {key})) AS sg FROM s)
  SELECT {out} 1 AS PC, round(corr(z0 + sg * z1, CAST(y AS DOUBLE)), 6) AS rho_y, round(corr(z0 + sg * z1, CAST(x AS DOUBLE)), 6) AS rho_x FROM g GROUP BY {key}
  UNION ALL SELECT {out} 2, round(corr(z0 - sg * z1, CAST(y AS DOUBLE)), 6), round(corr(z0 - sg * z1, CAST(x AS DOUBLE)), 6) FROM g GROUP BY {key}"""


@query("A49_illumination_check", f"WITH {PIXELS_SQL}, one AS (SELECT *, 0 AS image FROM px), {_TILT_SQL.format(src='one', key='image', out='')}")
def _(spark, d):
    return rounded(summary.illumination_check(pixels(spark, d), CH, 2), ["rho_y", "rho_x"])


SLIDE_SQL = "sl AS (SELECT CAST(p_partkey % 3 AS INTEGER) AS image_id, CAST((p_partkey // 3) // 50 AS INTEGER) AS y, CAST((p_partkey // 3) % 50 AS INTEGER) AS x, CAST(p_size AS DOUBLE) AS v0, p_retailprice AS v1 FROM part)"


def slide_pixels(spark, d):
    at = F.expr("CAST(p_partkey DIV 3 AS BIGINT)")
    return table(spark, d, "part").select(
        (F.col("p_partkey") % 3).cast("int").alias("image_id"), F.floor(at / 50).cast("int").alias("y"), (at % 50).cast("int").alias("x"),
        F.col("p_size").cast("double").alias("v0"), F.col("p_retailprice").alias("v1"),
    )


@query("A49_illumination_check_by_image", f"WITH {SLIDE_SQL}, {_TILT_SQL.format(src='sl', key='image_id', out='image_id,')}")
def _(spark, d):
    return rounded(summary.illumination_check(slide_pixels(spark, d), CH, 2, ["image_id"]), ["rho_y", "rho_x"])


@query("A51_vocabulary", "SELECT p_name AS name, CAST(row_number() OVER (ORDER BY p_name) AS INTEGER) AS id FROM (SELECT DISTINCT p_name FROM part)")
def _(spark, d):
    return summary.vocabulary(table(spark, d, "part").select(F.col("p_name").alias("name")))


CHAN_SQL = """ch AS (SELECT s_suppkey AS image_id, CAST(s_suppkey % 4 + 1 AS INTEGER) AS n_channels, 'NATION_' || CAST(s_nationkey AS VARCHAR) AS c10, 'NATION_' || CAST((s_nationkey + 7) % 30 AS VARCHAR) AS c2, 'NATION_3' AS c1 FROM supplier),
vo AS (SELECT n_name AS name, row_number() OVER (ORDER BY n_name) AS id FROM nation)"""


def _channels(spark, d):
    n = F.col("s_nationkey")

    def name(c):
        return F.concat(F.lit("NATION_"), c.cast("string"))

    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("image_id"), (F.col("s_suppkey") % 4 + 1).cast("int").alias("n_channels"),
        F.create_map(F.lit("Channel:0:10"), name(n), F.lit("Channel:0:2"), name((n + 7) % 30), F.lit("Channel:0:1"), F.lit("NATION_3"), F.lit("Channel:0:x"), F.lit("NATION_1")).alias("CHANNELS"),
    )


@query(
    "J17_channel_ids",
    f"""WITH {CHAN_SQL}, l AS (SELECT image_id, n_channels, [coalesce(a.id, 0), coalesce(b.id, 0), coalesce(c.id, 0), 0] AS ids FROM ch LEFT JOIN vo a ON a.name = c1 LEFT JOIN vo b ON b.name = c2 LEFT JOIN vo c ON c.name = c10)
    SELECT image_id, array_to_string(ids[1:n_channels], ',') AS ids FROM l""",
)
def _(spark, d):
    vocab = summary.vocabulary(table(spark, d, "nation").select(F.col("n_name").alias("name")))
    out = summary.channel_ids(_channels(spark, d), vocab)
    return out.select("image_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


INFO_SQL = f"""{REPAIRED_SQL}, n AS (SELECT patch_id, count(DISTINCT nullif(cell_label, 0)) AS c, count(DISTINCT nullif(cell_matched, 0)) AS cm, count(DISTINCT nullif(nucleus_label, 0)) AS u, count(DISTINCT nullif(nucleus_matched, 0)) AS um FROM fx GROUP BY 1)"""


def _infos(spark, d):
    from tissuegrid.operators.match import matching_statistics

    stats = matching_statistics(_repair(spark, d)[0], K)
    return stats.select(
        "patch_id", F.col("whole_cell_matched").alias("cell_count"), F.col("nucleus_matched").alias("nucleus_count"),
        F.col("whole_cell_unmatched").alias("unmatched_cells"), F.col("nucleus_unmatched").alias("unmatched_nuclei"),
        F.try_divide("whole_cell_matched", "whole_cell_total").alias("matched_fraction"), F.lit(20).alias("patch_height"), F.lit(25).alias("patch_width"),
    )


@query(
    "A53_repair_scores",
    f"WITH {INFO_SQL} SELECT patch_id, round(cm / 500, 6) AS cell_density, round(c - cm + u - um + greatest(0, 1 - cm / c) * greatest(cm, 1), 6) AS repair_score FROM n",
)
def _(spark, d):
    return rounded(summary.repair_scores(_infos(spark, d)).select("patch_id", "cell_density", "repair_score"), ["cell_density", "repair_score"])


def _many_infos(spark, d):
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("patch_id"), F.round("s_acctbal", 0).cast("bigint").alias("cell_count"), F.lit(0).alias("nucleus_count"), F.lit(0).alias("unmatched_cells"),
        (F.col("s_nationkey") * 9).alias("unmatched_nuclei"), (F.col("s_nationkey") * 9).cast("bigint").alias("repair_score"),
    )


@query("T4_representative_patches")
def _(spark, d):
    return summary.representative_patches(_many_infos(spark, d), 8).select("patch_id", "cell_count", "selection_reason")


def _picked_sql(n: int) -> str:
    """Each reason takes its first patch that no earlier one took; what is left is filled by density."""
    ok = "(greatest(cell_count, unmatched_nuclei, 0) >= 200)"
    steps = [
        "i AS (SELECT s_suppkey AS patch_id, CAST(round(s_acctbal, 0) AS BIGINT) AS cell_count, s_nationkey * 9 AS unmatched_nuclei, CAST(s_nationkey * 9 AS BIGINT) AS repair_score FROM supplier)",
        f"f AS (SELECT *, {ok} AS ok, (patch_id * 7919 + 13) % 1000003 AS draw FROM i)",
        "t1 AS (SELECT patch_id, 'high_density' AS reason FROM f WHERE ok ORDER BY cell_count DESC, patch_id LIMIT 1)",
        "t2 AS (SELECT patch_id, 'repair_hotspot' AS reason FROM f WHERE ok AND patch_id NOT IN (SELECT patch_id FROM t1) ORDER BY repair_score DESC, patch_id LIMIT 1)",
        "u2 AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2)",
        "t3 AS (SELECT patch_id, 'low_density' AS reason FROM f WHERE ok AND patch_id NOT IN (SELECT patch_id FROM u2) ORDER BY cell_count, patch_id LIMIT 1)",
        "u3 AS (SELECT * FROM u2 UNION ALL SELECT * FROM t3)",
        "t4 AS (SELECT patch_id, 'representative' AS reason FROM f WHERE patch_id NOT IN (SELECT patch_id FROM u3) ORDER BY ok DESC, draw, patch_id LIMIT 1)",
        "u4 AS (SELECT * FROM u3 UNION ALL SELECT * FROM t4)",
        f"t5 AS (SELECT patch_id, 'coverage' AS reason FROM f WHERE patch_id NOT IN (SELECT patch_id FROM u4) ORDER BY ok DESC, cell_count DESC, patch_id LIMIT (SELECT {n} - count(*) FROM u4))",
    ]
    return f"WITH {', '.join(steps)} SELECT patch_id, cell_count, reason AS selection_reason FROM (SELECT * FROM u4 UNION ALL SELECT * FROM t5) JOIN f USING (patch_id)"


@query("T4_representatives_by_given_order", _picked_sql(8))
def _(spark, d):
    infos = _many_infos(spark, d)
    chosen = summary.representative_patches(infos, 8, draw=(F.col("patch_id") * 7919 + 13) % 1000003)
    return chosen.select("patch_id", "cell_count", "selection_reason")


@query("K15_selection_summary")
def _(spark, d):
    chosen = summary.representative_patches(_many_infos(spark, d), 5)
    return sinks.selection_json(chosen, ["patch_id", "cell_count", "selection_reason"])


@query(
    "A54_channel_usage",
    """WITH r AS (SELECT DISTINCT CASE WHEN c_mktsegment = 'BUILDING' THEN 'nucleus' ELSE 'wholecell' END AS role, c_nationkey FROM customer)
    SELECT role, count(*) AS n_channels, count(n_nationkey) AS n_in_panel, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM r JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""",
)
def _(spark, d):
    panel = table(spark, d, "nation").select(F.col("n_name").alias("antibody_name"), F.col("n_nationkey").alias("channel_idx"))
    roles = table(spark, d, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", "nucleus").otherwise("wholecell").alias("role"), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("antibody_name")
    ).distinct()
    out = summary.channel_usage(panel, roles)
    return out.withColumn("names", F.array_join("names", ","))


_DRAW = "(c_custkey * 7919 + 13) % 1000003"


@query(
    "W9_stratified_split",
    f"""WITH p AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {_DRAW}, c_custkey) AS r, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer),
    q AS (SELECT *, round_even(n * 0.2, 0) AS t FROM p) SELECT c_custkey, CASE WHEN r <= t THEN 'test' WHEN r <= t + round_even((n - t) * 0.1, 0) THEN 'val' ELSE 'train' END AS split FROM q""",
)
def _(spark, d):
    return summary.stratified_split(table(spark, d, "customer"), "c_mktsegment", "c_custkey", draw=F.expr(_DRAW)).select("c_custkey", "split")


@query(
    "W9_plain_split",
    f"""WITH p AS (SELECT c_custkey, row_number() OVER (ORDER BY {_DRAW}, c_custkey) AS r, count(*) OVER () AS n FROM customer),
    q AS (SELECT *, round_even(n * 0.2, 0) AS t FROM p) SELECT c_custkey, CASE WHEN r <= t THEN 'test' WHEN r <= t + round_even((n - t) * 0.1, 0) THEN 'val' ELSE 'train' END AS split FROM q""",
)
def _(spark, d):
    return summary.stratified_split(table(spark, d, "customer"), "c_mktsegment", "c_custkey", stratify=False, draw=F.expr(_DRAW)).select("c_custkey", "split")


@query("J18_label_lookup", f"WITH {PIXELS_SQL}, m AS (SELECT cell_label, max(v0) AS value FROM px WHERE cell_label > 0 AND cell_label % 3 > 0 GROUP BY 1) SELECT y, x, coalesce(value, 0) AS value FROM px LEFT JOIN m USING (cell_label)")
def _(spark, d):
    px = pixels(spark, d)
    values = px.where("cell_label > 0 AND cell_label % 3 > 0").groupBy(F.col("cell_label").alias("label")).agg(F.max("v0").alias("value"))
    return summary.label_lookup(px, values).select("y", "x", "value")


# --- scalar functions --------------------------------------------------------------------------


@query("X12_safe_filenames", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g') AS name FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", text.safe_filename(F.col("url")).alias("name"))


@query(
    "X13_formatting",
    """SELECT event_id, CASE WHEN event_id * 977 < 1024 THEN printf('%.1f B', CAST(event_id * 977 AS DOUBLE)) WHEN event_id * 977 < 1048576 THEN printf('%.1f KB', event_id * 977 / 1024) WHEN event_id * 977 < 1073741824 THEN printf('%.1f MB', event_id * 977 / 1048576)
      WHEN event_id * 977 < 1099511627776 THEN printf('%.1f GB', event_id * 977 / 1073741824) WHEN event_id * 977 < 1125899906842624 THEN printf('%.1f TB', event_id * 977 / 1099511627776) ELSE printf('%.1f PB', event_id * 977 / 1125899906842624) END AS size,
    format('{:,}', event_id * 977) AS number, strftime(ts, '%Y-%m-%d %H:%M') AS stamp FROM events""",
)
def _(spark, d):
    n = F.col("event_id") * 977
    return table(spark, d, "events").select("event_id", text.human_size(n).alias("size"), text.thousands(n).alias("number"), text.minute_stamp(F.col("ts")).alias("stamp"))


@query("X14_units", "SELECT p_partkey, p_size * 0.25 AS area_um2, round(p_size / (p_partkey + 1000) / (377.5 * 377.5 / 1e6) * 100, 6) AS density FROM part")
def _(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", text.area_um2(F.col("p_size")).alias("area_um2"), F.round(text.per_hundred_um2(F.col("p_size"), F.col("p_partkey") + 1000), 6).alias("density")
    )


@query("X15_tile_names", "SELECT p_partkey, 'img' || CAST(p_partkey AS VARCHAR) AS image_id, CASE WHEN p_size > 5 THEN p_size END AS channel FROM part")
def _(spark, d):
    path = F.concat(F.lit("/a/b/img"), F.col("p_partkey").cast("string"), F.lit("_tile_0_1.tif"))
    key = F.concat(F.lit("Channel:0:"), F.when(F.col("p_size") > 5, F.col("p_size").cast("string")).otherwise("x"))
    return table(spark, d, "part").select("p_partkey", text.image_of_tile(path).alias("image_id"), text.channel_number(key).alias("channel"))


@query(
    "X16_literals",
    "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS flag, o_orderkey % 5 IN (3) AS is_null FROM orders",
)
def _(spark, d):
    words = F.element_at(F.array(*[F.lit(w) for w in (" Yes", "OFF", "t", "None ", "perhaps")]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", text.parse_bool(words).alias("flag"), text.is_null_word(words).alias("is_null"))


@query("X17_flatten_metrics", "SELECT p_partkey, p_size AS cells, p_retailprice AS area, p_size * 2 AS nuclei FROM part")
def _(spark, d):
    nested = table(spark, d, "part").select("p_partkey", F.struct(F.col("p_size").alias("cells"), F.col("p_retailprice").alias("area")).alias("cell"), F.struct((F.col("p_size") * 2).alias("nuclei")).alias("nucleus"))
    return nested.select("p_partkey", "cell.*", "nucleus.*")


@query("X18_cluster_labels", "SELECT vec_id, CAST(label + 1 AS VARCHAR) AS cluster FROM embeddings")
def _(spark, d):
    return table(spark, d, "embeddings").select("vec_id", text.one_based(F.col("label")).alias("cluster"))


@query("E7_tile_scores", "SELECT vec_id, CASE WHEN embedding[1] + embedding[2] > embedding[3] THEN 0 ELSE 1 END AS predicted FROM embeddings")
def _(spark, d):
    weights = np.zeros((64, 2))
    weights[[0, 1], 0] = 1.0
    weights[2, 1] = 1.0
    scored = scoring.classify(table(spark, d, "embeddings"), scoring.linear_model(weights), "embedding", 64)
    return scored.select("vec_id", "predicted")


# --- sources -----------------------------------------------------------------------------------


def _cells_folder(spark, d):
    """Cell table stored by patch, the way the profile step leaves it."""
    path = scratch(spark, "cells")
    sinks.profile_tables({"cell_by_marker": cells(spark, d), "cell_metadata": _metadata(spark, d).withColumn("patch_id", (F.col("cell_mask_id") % 7).cast("int"))}, path)
    return path


@query("S1_metadata_of_one_patch", f"WITH {CELLS_SQL} SELECT cell_mask_id, cell_mask_id % 97 + 0.5 AS y FROM cells WHERE patch_id = 3")
def _(spark, d):
    return tables.scan_table(spark, _cells_folder(spark, d) + "/cell_metadata", patch=3).select("cell_mask_id", "y")


@query("S2_expression_scan", f"WITH {CELLS_SQL} SELECT cell_mask_id, quantity, price, patch_id FROM cells")
def _(spark, d):
    return tables.scan_table(spark, _cells_folder(spark, d) + "/cell_by_marker").select("cell_mask_id", "quantity", "price", "patch_id")


@query("S3_layout")
def _(spark, d):
    return listing.layout(listing.list_files(spark, d, "*.parquet"))


@query("S4_union_of_patch_files", f"WITH {CELLS_SQL} SELECT cell_mask_id, quantity, CASE WHEN patch_id % 2 = 1 THEN tax END AS tax FROM cells")
def _(spark, d):
    folder = scratch(spark, "patches")
    c = cells(spark, d)
    patches = [r[0] for r in c.select("patch_id").distinct().orderBy("patch_id").collect()]
    for i in patches:  # every other patch lacks a column
        columns = ["cell_mask_id", "quantity", *(["tax"] if i % 2 == 1 else [])]
        sinks.overwrite_table(c.where(F.col("patch_id") == i).select(*columns), f"{folder}/{i}")
    return tables.scan_all(spark, [f"{folder}/{i}" for i in [*patches, max(patches, default=0) + 1]], "parquet").select("cell_mask_id", "quantity", "tax")


@query("S5_glob_union", "SELECT s_suppkey AS cell_mask_id, s_acctbal AS area FROM supplier")
def _(spark, d):
    folder = scratch(spark, "glob")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell_mask_id"), F.col("s_acctbal").alias("area"))
    sinks.overwrite_table(s, folder, "csv")
    return tables.scan_glob(spark, folder, "part-*.csv", s.schema).select("cell_mask_id", "area")


@query("S6_panel", "SELECT p_name AS antibody_name, CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS channel_idx FROM part")
def _(spark, d):
    """The panel lies in several files, in the order of their names."""
    folder = scratch(spark, "panel")
    ordered = table(spark, d, "part").repartitionByRange(5, "p_partkey").sortWithinPartitions("p_partkey")
    ordered.select(F.col("p_name").alias("antibody_name")).write.option("sep", "\t").option("header", True).csv(folder)
    return tables.scan_panel(spark, folder).select("antibody_name", "channel_idx")


@query("S7_patch_table", f"WITH {PIXELS_SQL} SELECT DISTINCT patch_id, CAST((patch_id // 2) * 20 AS INTEGER) AS y_start, CAST((patch_id % 2) * 25 AS INTEGER) AS x_start, 20 AS patch_height, 25 AS patch_width FROM px")
def _(spark, d):
    folder = scratch(spark, "patch_table")
    sinks.overwrite_table(patch_table(spark, d).withColumn("patch_height", F.lit(20)).withColumn("patch_width", F.lit(25)), folder, "csv")
    return tables.scan_patches(spark, folder)


@query("S8_channel_names", "SELECT s_suppkey AS file, 2 AS version, 'Channel:0:' || CAST(i AS VARCHAR) AS channel_id, 'M' || CAST(s_nationkey * 10 + i AS VARCHAR) AS antibody_name FROM supplier, unnest(range(3)) t(i)")
def _(spark, d):
    n = F.col("s_nationkey") * 10

    def channel(image, i):
        return F.concat(F.lit(f'<Channel ID="Channel:{image}:{i}" Name="M'), (n + i).cast("string"), F.lit('"/>'))

    body = F.concat(
        F.lit('<OME><Image ID="Image:0"><Pixels>'), *[channel(0, i) for i in range(3)],
        F.lit('</Pixels></Image><Image ID="Image:1"><Pixels>'), channel(1, 0), channel(1, 1), F.lit("</Pixels></Image></OME>"),
    )
    docs = table(spark, d, "supplier").select(F.col("s_suppkey").alias("file"), body.alias("text"))
    return documents.channel_names(docs).drop("channel_idx")


def _geojson(spark, d):
    """One collection per supplier: two polygons in reverse idx order, every third with a MultiPolygon."""
    r = regions(spark, d)
    ring = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    geometry = F.when(
        F.col("region_id") % 3 == 0, F.struct(F.lit("MultiPolygon").alias("type"), F.to_json(F.array(F.array(ring))).alias("c"))
    ).otherwise(F.struct(F.lit("Polygon").alias("type"), F.to_json(F.array(ring)).alias("c")))
    moved = F.to_json(F.array(F.transform("ring", lambda p: F.array(p["x"] + 100, p["y"]))))
    props = F.concat(F.lit('"properties":{"classification":{"name":"'), "label", F.lit('"},"idx":'))
    doc = F.concat(
        F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Polygon","coordinates":'), moved, F.lit("},"), props, F.lit('2}},'),
        F.lit('{"type":"Feature","geometry":{"type":"'), geometry.getField("type"), F.lit('","coordinates":'), geometry.getField("c"), F.lit("},"), props, F.lit("1}}]}"),
    )
    return r.select(F.concat(F.lit("r"), F.col("region_id").cast("string"), F.lit(".geojson")).alias("file"), doc.alias("text"))


_BOTH = f"""{REGIONS_SQL}, bt AS (SELECT region_id, label, 0 AS pos, sum(y) AS ys, sum(x) AS xs, count(*) AS n FROM corners GROUP BY 1, 2 UNION ALL SELECT region_id, label, 1, sum(y), sum(x + 100), count(*) FROM corners GROUP BY 1, 2)"""


def _ring_sums():
    add = lambda s, e: s + e
    return [
        F.aggregate(F.col("ring.y"), F.lit(0.0), add).alias("ys"), F.aggregate(F.col("ring.x"), F.lit(0.0), add).alias("xs"), F.size("ring").cast("bigint").alias("n"),
    ]


@query("S9_annotations", f"WITH {_BOTH} SELECT 'r' || CAST(region_id AS VARCHAR) || '.geojson' AS file, pos, CAST(pos + 1 AS VARCHAR) AS idx, label AS class_name, ys, xs, n FROM bt")
def _(spark, d):
    return documents.annotations(_geojson(spark, d)).select("file", "pos", "idx", "class_name", *_ring_sums())


@query("S9_shape_lists", f"WITH {REGIONS_SQL} SELECT region_id, sum(y) AS ys, sum(x) AS xs, count(*) AS n FROM corners GROUP BY 1")
def _(spark, d):
    """The same polygons as bare lists, shape lists, named shapes and transposed coordinates."""
    r = regions(spark, d)
    ring = F.to_json(F.transform("ring", lambda p: F.array(p["y"], p["x"])))
    flat = F.to_json(F.array(F.col("ring.y"), F.col("ring.x")))
    k = F.col("region_id") % 4
    doc = (
        F.when(k == 0, F.concat(F.lit("["), ring, F.lit("]")))
        .when(k == 1, F.concat(F.lit('{"shapes":[{"data":'), ring, F.lit('},{"data":[[1,2],[3,4]]}]}')))
        .when(k == 2, F.concat(F.lit('{"a":{"points":'), ring, F.lit(',"properties":{"name":"z"}}}')))
        .otherwise(F.concat(F.lit('[{"coordinates":'), flat, F.lit("}]")))
    )
    parsed = documents.annotations(r.select(F.col("region_id").cast("string").alias("file"), doc.alias("text")))
    return parsed.select(F.col("file").cast("bigint").alias("region_id"), *_ring_sums())


@query("S10_annotation_directory", f"WITH {_BOTH} SELECT 'r' || CAST(region_id AS VARCHAR) || '_' || CAST(pos + 1 AS VARCHAR) AS label, n FROM bt")
def _(spark, d):
    return documents.annotation_directory(_geojson(spark, d)).select("label", F.size("ring").cast("bigint").alias("n"))


@query("S11_polygon_csv", f'WITH {REGIONS_SQL} SELECT region_id AS "index", sum(y) AS ys, sum(x) AS xs, count(*) AS n FROM corners GROUP BY 1')
def _(spark, d):
    corners = regions(spark, d).select(F.col("region_id").alias("index"), F.posexplode("ring").alias("pos", "p")).select("index", "pos", F.col("p.y").alias("axis-0"), F.col("p.x").alias("axis-1"))
    return documents.polygon_csv(corners).select("index", *_ring_sums())


@query("S12_labelled_regions", f"WITH {_BOTH} SELECT label, count(*) AS n, sum(ys) AS ys FROM bt GROUP BY 1")
def _(spark, d):
    parsed = documents.labelled_regions(_geojson(spark, d))
    ys = F.aggregate(F.flatten("rings").getField("y"), F.lit(0.0), lambda s, e: s + e)
    return parsed.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(ys).alias("ys"))


@query("S13_image_channels", f"WITH {CHAN_SQL} SELECT CAST(image_id AS VARCHAR) AS image_id, c10, c2 FROM ch")
def _(spark, d):
    records = _channels(spark, d).select(F.to_json(F.array(F.struct(F.col("image_id").cast("string").alias("image_id"), "CHANNELS"))).alias("text"))
    return documents.image_channels(records).select("image_id", F.col("CHANNELS")["Channel:0:10"].alias("c10"), F.col("CHANNELS")["Channel:0:2"].alias("c2"))


@query(
    "S14_class_folders",
    """WITH p AS (SELECT page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 2) AS class_name, url FROM pages)
    SELECT page_id, class_name, CAST(dense_rank() OVER (ORDER BY class_name) - 1 AS INTEGER) AS label FROM p""",
)
def _(spark, d):
    paths = table(spark, d, "pages").select("page_id", F.concat(F.lit("/root/"), F.split_part(F.regexp_replace("url", "^https?://", ""), F.lit("/"), F.lit(2)), F.lit("/t.TIF")).alias("path"))
    return listing.class_folders(paths, "root").select("page_id", "class_name", "label")


@query("S15_experiment_sheet", "SELECT CAST(s_suppkey AS VARCHAR) AS exp_id, s_name AS \"data::file_name\", row_number() OVER (ORDER BY s_suppkey) - 1 AS row_index FROM supplier")
def _(spark, d):
    folder = scratch(spark, "sheet")
    ordered = table(spark, d, "supplier").repartitionByRange(4, "s_suppkey").sortWithinPartitions("s_suppkey")
    sinks.overwrite_table(ordered.select(F.col("s_suppkey").alias("exp_id"), F.col("s_name").alias("data::file_name")), folder, "csv")
    return tables.scan_sheet(spark, folder)


def _pixel_file(spark, d):
    path = scratch(spark, "pixels")
    tables.write_pixels(pixels(spark, d), path, tile=16)
    return path


@query("S16_raster_scan", f"WITH {PIXELS_SQL} SELECT patch_id, y, x, v0, v1 FROM px")
def _(spark, d):
    return tables.scan_pixels(spark, _pixel_file(spark, d)).select("patch_id", "y", "x", "v0", "v1")


@query("S17_window_scan", f"WITH {PIXELS_SQL} SELECT patch_id, y, x, v1 FROM px WHERE y >= 1 AND y < 30 AND x >= 7 AND x < 33")
def _(spark, d):
    return tables.scan_pixels(spark, _pixel_file(spark, d), (1, 30, 7, 33), ["v1"])


@query("S18_preview", f"WITH {PIXELS_SQL} SELECT patch_id, y, x, v0 FROM px WHERE y % 3 = 0 AND x % 3 = 0")
def _(spark, d):
    return tables.scan_pixels(spark, _pixel_file(spark, d), channels=["v0"], every=3)


@query("S19_labels_of_one_patch", f"WITH {PIXELS_SQL} SELECT y, x, cell_label AS label FROM px WHERE patch_id = 1 AND cell_label > 0")
def _(spark, d):
    path = scratch(spark, "labels")
    sinks.label_layers(pixels(spark, d), ["cell_label", "nucleus_label"], path)
    return tables.scan_table(spark, path, patch=1).where("layer = 'cell_label'").select("y", "x", "label")


@query("S20_resume", "SELECT 'panel' AS name, count(*) AS n FROM nation UNION ALL SELECT 'patches', count(DISTINCT ((p_partkey // 50) // 20) * 2 + (p_partkey % 50) // 25) FROM part")
def _(spark, d):
    folder = scratch(spark, "stages")
    sinks.overwrite_table(table(spark, d, "nation"), f"{folder}/panel")
    sinks.overwrite_table(patch_table(spark, d), f"{folder}/patches")
    back = tables.resume(spark, folder, {"panel": table(spark, d, "nation").count()})
    parts = [df.agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n, df in back.items()]
    return parts[0].unionByName(parts[1])


_REPORT_SQL = """p AS (SELECT page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS host, length(html) AS size FROM pages)"""


def _page_files(spark, d):
    """A listing: every page is a report file in the folder of its host."""
    host = F.split_part(F.regexp_replace("url", "^https?://", ""), F.lit("/"), F.lit(1))
    kind = F.when(F.col("page_id") % 3 == 0, "patch-7-cell_metadata.csv").when(F.col("page_id") % 3 == 1, "qc.html").otherwise("other.txt")
    name = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("patch-"), F.col("page_id").cast("string"), F.lit("-cell_metadata.csv"))).otherwise(kind)
    return table(spark, d, "pages").select(
        "page_id", F.concat(F.lit("/data/"), host, F.lit("/"), name).alias("path"), F.length("html").cast("bigint").alias("length"), F.timestamp_seconds("page_id").alias("modificationTime"),
    )


@query("S3_layout_of_a_listing", "SELECT 'patches' AS layout, count(*) AS n_patches FROM pages WHERE page_id % 3 = 0")
def _(spark, d):
    return listing.layout(_page_files(spark, d))


@query(
    "S21_reports_of_a_listing",
    f"""WITH {_REPORT_SQL} SELECT host AS exp_id, 'quality' AS report_type, size AS file_size, page_id AS modified, host || '_quality.html' AS dest_filename FROM p WHERE page_id % 3 = 1""",
)
def _(spark, d):
    found = listing.reports(_page_files(spark, d), {"qc.html": "quality"})
    return listing.report_index(found).withColumn("modified", F.unix_seconds("modified")).select("exp_id", "report_type", "file_size", "modified", "dest_filename")


@query("S21_report_listing")
def _(spark, d):
    """Every table file of the folder counts as a report of one experiment."""
    files = listing.list_files(spark, d, "*.parquet")
    found = listing.reports(files, {"part.parquet": "parts", "orders.parquet": "orders", "lineitem.parquet": "lines"})
    return listing.report_index(found).select("exp_id", "report_type", "file_size", "dest_filename")


_FOUND = "fo AS (SELECT n_nationkey AS exp_id, n_name AS report_type FROM nation), ov AS (SELECT CASE WHEN c_nationkey % 3 = 0 THEN c_nationkey END AS exp_id, count(*) AS k FROM customer GROUP BY 1), pa AS (SELECT s_nationkey AS exp_id, sum(s_suppkey) AS k FROM supplier GROUP BY 1)"


@query("S22_cell_counts", f"WITH {_FOUND} SELECT exp_id, report_type, CAST(coalesce(ov.k, pa.k) AS BIGINT) AS cell_count FROM fo LEFT JOIN ov USING (exp_id) LEFT JOIN pa USING (exp_id)")
def _(spark, d):
    found = table(spark, d, "nation").select(F.col("n_nationkey").alias("exp_id"), F.col("n_name").alias("report_type"))
    overview = table(spark, d, "customer").select(F.expr("CASE WHEN c_nationkey % 3 = 0 THEN c_nationkey END AS exp_id"))
    pt = table(spark, d, "supplier").select(F.col("s_nationkey").alias("exp_id"), F.col("s_suppkey").alias("n_cells"))
    return listing.with_cell_counts(found, overview, pt)


@query("J21_reports_with_types", f"WITH {_FOUND} SELECT exp_id, report_type, CAST(coalesce(ov.k, pa.k) AS BIGINT) AS cell_count FROM fo LEFT JOIN ov USING (exp_id) LEFT JOIN pa USING (exp_id) WHERE exp_id <> 4")
def _(spark, d):
    found = table(spark, d, "nation").select(F.col("n_nationkey").alias("exp_id"), F.col("n_name").alias("report_type"))
    overview = table(spark, d, "customer").select(F.expr("CASE WHEN c_nationkey % 3 = 0 THEN c_nationkey END AS exp_id"))
    pt = table(spark, d, "supplier").select(F.col("s_nationkey").alias("exp_id"), F.col("s_suppkey").alias("n_cells"))
    return listing.with_cell_counts(listing.pick_experiments(found, exclude=[4]), overview, pt)


@query("T5_report_order", "SELECT c_nationkey AS exp_id, c_mktsegment AS report_type, count(*) AS n FROM customer GROUP BY 1, 2 ORDER BY 1, 2")
def _(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("exp_id"), F.col("c_mktsegment").alias("report_type")).agg(F.count(F.lit(1)).alias("n"))
    return listing.report_index(c)


@query("U5_include_exclude", "SELECT n_name AS exp_id FROM nation WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_3') AND n_name <> 'NATION_2'")
def _(spark, d):
    return listing.pick_experiments(table(spark, d, "nation").select(F.col("n_name").alias("exp_id")), ["NATION_1", "NATION_2", "NATION_3"], ["NATION_2"])


# --- sinks: written, then read back ------------------------------------------------------------


@query("K1_profile_tables", f"WITH {CELLS_SQL} SELECT patch_id, count(*) AS n, sum(CAST(quantity AS BIGINT)) AS q FROM cells GROUP BY 1")
def _(spark, d):
    back = spark.read.parquet(_cells_folder(spark, d) + "/cell_by_marker")
    return back.groupBy("patch_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("quantity").cast("bigint")).alias("q"))


@query("K2_channel_table", "SELECT 'v0' AS \"Channel\", CAST(min(p_size) AS DOUBLE) AS \"Min\" FROM part UNION ALL SELECT 'v1', min(p_retailprice) FROM part")
def _(spark, d):
    from tissuegrid.operators.qc import channel_statistics

    path = scratch(spark, "channels")
    sinks.overwrite_table(channel_statistics(pixels(spark, d), CH), path)
    return spark.read.parquet(path).select("Channel", "Min")


@query("K3_patch_table", f"WITH {PIXELS_SQL} SELECT DISTINCT patch_id FROM px")
def _(spark, d):
    path = scratch(spark, "patch_save")
    for _again in range(2):
        sinks.overwrite_table(patch_table(spark, d), path, "csv")
    return spark.read.csv(path, header=True, schema="patch_id int, y_start int, x_start int").select("patch_id")


@query("K4_marker_export", f"WITH {RANKED_SQL} SELECT cluster, feature, CASE WHEN fc > 1 THEN 'positive' WHEN fc < 1 THEN 'negative' ELSE 'none' END AS direction FROM de WHERE p_adj < 0.9")
def _(spark, d):
    path = scratch(spark, "markers")
    sinks.marker_export(_de(spark, d), path, alpha=0.9)
    return spark.read.parquet(f"{path}/significant").select("cluster", "feature", "direction")


@query("K5_matrix_export", f"WITH {RANKED_SQL} SELECT cluster, " + ", ".join(f"round(max(CASE WHEN feature = '{m}' THEN fc END), 6) AS {m}" for m in MARKERS) + " FROM de GROUP BY 1")
def _(spark, d):
    path = scratch(spark, "matrices")
    staged = scratch(spark, "tests")
    sinks.overwrite_table(_de(spark, d), staged)
    sinks.matrix_export(spark.read.parquet(staged), path, MARKERS, top_n=2)
    return rounded(spark.read.parquet(f"{path}/fold_change_raw"), MARKERS, 6)


@query("K7_annotated_matrix", "SELECT count(*) AS n_obs, (SELECT count(*) FROM orders) AS n_edges FROM customer")
def _(spark, d):
    path = scratch(spark, "annotated")
    sinks.annotated_matrix(table(spark, d, "customer").select("c_custkey", "c_acctbal"), table(spark, d, "customer").select("c_custkey", "c_mktsegment"), table(spark, d, "orders").select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst")), path)
    n_edges = spark.read.parquet(f"{path}/edges").agg(F.count(F.lit(1))).scalar()
    return spark.read.parquet(f"{path}/obs").agg(F.count(F.lit(1)).alias("n_obs")).withColumn("n_edges", n_edges)


@query("K8_manifest", "SELECT 'labels_repaired' AS artifact UNION ALL SELECT 'panel'")
def _(spark, d):
    folder = scratch(spark, "artifacts")
    sinks.overwrite_table(table(spark, d, "nation"), f"{folder}/panel")
    sinks.label_layers(pixels(spark, d), ["cell_label"], f"{folder}/labels_repaired")
    return sinks.manifest(listing.list_files(spark, folder, "part-*")).select("artifact")


@query("K9_label_layers", f"WITH {PIXELS_SQL} SELECT 'cell_label' AS layer, patch_id, y, x, cell_label AS label FROM px WHERE cell_label > 0 UNION ALL SELECT 'nucleus_label', patch_id, y, x, nucleus_label FROM px WHERE nucleus_label > 0")
def _(spark, d):
    path = scratch(spark, "layers")
    sinks.label_layers(pixels(spark, d), ["cell_label", "nucleus_label"], path)
    return spark.read.parquet(path).select("layer", "patch_id", "y", "x", "label")


@query("K9_label_layers_by_image", f"WITH {SLIDE_SQL} SELECT image_id, 'size_label' AS layer, y // 20 AS patch_id, y, x, CAST(v0 AS BIGINT) - 3 AS label FROM sl WHERE v0 > 3")
def _(spark, d):
    path = scratch(spark, "layers")
    px = slide_pixels(spark, d).withColumn("patch_id", F.expr("CAST(y DIV 20 AS INT)")).withColumn("size_label", F.col("v0").cast("bigint") - 3)
    sinks.label_layers(px, ["size_label"], path, ["image_id"])
    return spark.read.parquet(path).select("image_id", "layer", "patch_id", "y", "x", "label")


@query("K11_polygon_json", f"WITH {REGIONS_SQL} SELECT label AS source, count(*) AS count FROM regions GROUP BY 1")
def _(spark, d):
    docs = sinks.polygon_json(regions(spark, d).withColumn("source", F.col("label")))
    parsed = docs.select(F.from_json("document", "count bigint, source string").alias("j"))
    return parsed.select("j.source", "j.count")


@query("K13_tiles_by_label", "SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def _(spark, d):
    path = scratch(spark, "tiles")
    sinks.by_partition(table(spark, d, "embeddings"), path, ["label"])
    return spark.read.parquet(path).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("K14_prediction_table", "SELECT CAST(vec_id AS VARCHAR) AS path, CASE WHEN embedding[1] > embedding[2] THEN 0 ELSE 1 END AS predicted FROM embeddings")
def _(spark, d):
    weights = np.zeros((64, 2))
    weights[0, 0] = weights[1, 1] = 1.0
    tiles = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("path"), "embedding")
    out = scratch(spark, "predictions")
    sinks.prediction_table(scoring.classify(tiles, scoring.linear_model(weights), "embedding", 64), out)
    return spark.read.csv(out, header=True, schema="path string, predicted int, logit_0 double, logit_1 double").select("path", "predicted")
