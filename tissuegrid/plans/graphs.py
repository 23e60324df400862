"""Neighbour, community and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissuegrid.operators import communities, match, neighbours, qc, quality, raster
from tissuegrid.operators.components import connected_nodes
from tissuegrid.plans.catalog import query
from tissuegrid.plans.cells import rounded
from tissuegrid.plans.dataset import PIXELS_SQL, pixels, table
from tissuegrid.plans.pixels import CH, K, LAPLACE_SQL, REPAIRED_SQL, _repair

VEC_SQL = "vec AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
KNN_SQL = f"""{VEC_SQL}, pr AS (SELECT a.id AS src, b.id AS dst, list_distance(a.v, b.v) AS dist FROM vec a JOIN vec b ON a.id <> b.id),
knn AS (SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pr QUALIFY rank <= 10)"""


def vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))


@query("J20_nearest_neighbours", f"WITH {KNN_SQL} SELECT src, dst, round(dist, 5) AS dist, CAST(rank AS INTEGER) AS rank FROM knn")
def _(spark, d):
    return rounded(neighbours.nearest(vectors(spark, d), 10), ["dist"], 5)


@query(
    "J20_nearest_cosine",
    """WITH vec AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), u AS (SELECT id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS v FROM vec),
    pr AS (SELECT a.id AS src, b.id AS dst, list_distance(a.v, b.v) AS dist FROM u a JOIN u b ON a.id <> b.id)
    SELECT src, dst, round(dist, 5) AS dist FROM pr QUALIFY row_number() OVER (PARTITION BY src ORDER BY dist, dst) <= 5""",
)
def _(spark, d):
    """Small balls and blocks, so that pruning and block merging are at work."""
    near = neighbours.nearest(vectors(spark, d), 5, metric="cosine", block=64, pivots=8)
    return rounded(near.drop("rank"), ["dist"], 5)


@query("G1_knn_edges", f"WITH {KNN_SQL} SELECT src, dst FROM knn")
def _(spark, d):
    return neighbours.nearest(vectors(spark, d), 10, block=128).select("src", "dst")


@query("G2_plain_weights", f"WITH {KNN_SQL} SELECT src, dst, round(dist, 5) AS w FROM knn")
def _(spark, d):
    edges = neighbours.plain_weights(neighbours.nearest(vectors(spark, d), 10), use_distance=True)
    return rounded(edges.select("src", "dst", "w"), ["w"], 5)


# The width of each cell's decay by halving and doubling, one row per step until the weights add up to log2 k.
FUZZY_SQL = """sc AS (SELECT src, coalesce(min(dist) FILTER (WHERE dist > 0), 0) AS rho, avg(dist) AS m, count(*) AS k FROM knn GROUP BY 1),
gp AS (SELECT knn.src, greatest(dist - rho, 0) AS gap FROM knn JOIN sc USING (src) WHERE rank > 1), ov AS (SELECT avg(dist) AS o FROM knn),
bs(src, i, low, high, mid) AS (SELECT src, 0, CAST(0 AS DOUBLE), CAST('infinity' AS DOUBLE), CAST(1 AS DOUBLE) FROM sc UNION ALL
  SELECT src, i + 1, CASE WHEN total > target THEN low ELSE mid END, CASE WHEN total > target THEN mid ELSE high END,
    CASE WHEN total > target THEN (low + mid) / 2 WHEN isinf(high) THEN mid * 2 ELSE (mid + high) / 2 END
  FROM (SELECT b.src, b.i, b.low, b.high, b.mid, any_value(log2(sc.k)) AS target, sum(exp(-gp.gap / b.mid)) AS total FROM bs b JOIN gp ON gp.src = b.src JOIN sc ON sc.src = b.src WHERE b.i < 64 GROUP BY 1, 2, 3, 4, 5)
  WHERE abs(total - target) >= 1e-5),
sg AS (SELECT src, arg_max(mid, i) AS mid FROM bs GROUP BY 1),
fin AS (SELECT sc.src, rho, greatest(mid, 0.001 * CASE WHEN rho > 0 THEN m ELSE o END) AS sigma FROM sc JOIN sg USING (src), ov),
ow AS (SELECT knn.src, dst, CASE WHEN dist - rho <= 0 OR sigma = 0 THEN 1 ELSE exp(-(dist - rho) / sigma) END AS w FROM knn JOIN fin USING (src)),
pp AS (SELECT least(src, dst) AS lo, greatest(src, dst) AS hi, coalesce(max(w) FILTER (WHERE src < dst), 0) AS a, coalesce(max(w) FILTER (WHERE src > dst), 0) AS b FROM ow GROUP BY 1, 2),
fw AS (SELECT lo AS src, hi AS dst, a + b - a * b AS w FROM pp UNION ALL SELECT hi, lo, a + b - a * b FROM pp)"""


@query("G3_fuzzy_weights", f"WITH RECURSIVE {KNN_SQL}, {FUZZY_SQL} SELECT src, dst, round(w, 5) AS w FROM fw")
def _(spark, d):
    return rounded(neighbours.fuzzy_weights(neighbours.nearest(vectors(spark, d), 10)), ["w"], 5)


@query(
    "G4_neighbour_graph",
    f"""WITH RECURSIVE vec AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), u AS (SELECT id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS v FROM vec),
    pr AS (SELECT a.id AS src, b.id AS dst, list_distance(a.v, b.v) AS dist FROM u a JOIN u b ON a.id <> b.id),
    knn AS (SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pr QUALIFY rank <= 10), {FUZZY_SQL}
    SELECT fw.src, fw.dst, round(w, 5) AS w, round(dist, 5) AS dist FROM fw LEFT JOIN knn ON knn.src = fw.src AND knn.dst = fw.dst""",
)
def _(spark, d):
    graph, _params = neighbours.neighbour_graph(vectors(spark, d), key="id", vector="v", k=10, metric="cosine")
    return rounded(graph, ["w", "dist"], 5)


@query("G5_communities")
def _(spark, d):
    return communities.run_clustering(vectors(spark, d), key="id", vector="v", n_neighbors=10, resolution=1.0)


@query("G6_kmeans")
def _(spark, d):
    return quality.kmeans_labels(vectors(spark, d), "v", 8).select("id", "cluster")


@query("G5_planted_communities", "SELECT c_custkey AS node, min(c_custkey) OVER (PARTITION BY c_nationkey) AS first_customer FROM customer UNION ALL SELECT -1 - c_nationkey, min(c_custkey) FROM customer GROUP BY c_nationkey")
def _(spark, d):
    """Every customer is tied to its nation, nations in a weak ring: the communities are the nations."""
    customer = table(spark, d, "customer")
    hub = -1 - F.col("c_nationkey").cast("bigint")
    nations = customer.select("c_nationkey").distinct()
    spokes = customer.select(F.col("c_custkey").cast("bigint").alias("src"), hub.alias("dst"), F.lit(1.0).alias("w"))
    later = nations.select(((F.col("c_nationkey") + 24) % 25).alias("before"), F.col("c_nationkey").alias("after"))
    ring = nations.join(later, F.col("c_nationkey") == F.col("before")).select(hub.alias("src"), (-1 - F.col("after").cast("bigint")).alias("dst"), F.lit(0.01).alias("w"))
    one_way = spokes.unionByName(ring)
    edges = one_way.unionByName(one_way.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    found = communities.find_communities(edges, resolution=1.0)
    names = found.where("node >= 0").groupBy("community").agg(F.min("node").alias("first_customer"))
    return found.join(names, "community").select("node", "first_customer")


@query(
    "R22_connected_nodes",
    """WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey AS a, 1000000000000 + l_suppkey * 100000 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS b FROM lineitem),
    s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), n AS (SELECT a AS node FROM s UNION SELECT b FROM s),
    walk(node, root) AS (SELECT node, node FROM n UNION SELECT s.b, walk.root FROM walk JOIN s ON s.a = walk.node WHERE walk.root < s.b)
    SELECT node, min(root) AS component FROM walk GROUP BY node""",
)
def _(spark, d):
    """Orders hang together that share a supplier on a day."""
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    stop = F.lit(1000000000000) + F.col("l_suppkey").cast("bigint") * 100000 + day
    return connected_nodes(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("a"), stop.alias("b")))


# --- quality -----------------------------------------------------------------------------------

FG_SQL = f"""{PIXELS_SQL}, fg AS (SELECT *, v0 > avg(v0) OVER (PARTITION BY patch_id) OR v1 > avg(v1) OVER (PARTITION BY patch_id) AS foreground FROM px)"""


def _foreground(px):
    return raster.above_mean(px, CH, K).withColumn("foreground", F.col("foreground") == 1)


@query(
    "A30_coverage",
    f"""WITH {FG_SQL}, n AS (SELECT patch_id, count(*) FILTER (WHERE cell_label > 0 AND foreground) AS mf, count(*) FILTER (WHERE cell_label > 0 AND NOT foreground) AS mb,
      count(*) FILTER (WHERE foreground) AS f, count(*) FILTER (WHERE NOT foreground) AS b, count(*) FILTER (WHERE cell_label > 0) AS m FROM fg GROUP BY 1)
    SELECT patch_id, round(mf / f, 6) AS foreground_fraction, round(CASE WHEN b = 0 THEN 0 ELSE mb / b END, 6) AS background_fraction, round(mf / m, 6) AS mask_fraction FROM n""",
)
def _(spark, d):
    out = quality.coverage(_foreground(pixels(spark, d)), K, F.col("cell_label") > 0, F.col("foreground"))
    return rounded(out, ["foreground_fraction", "background_fraction", "mask_fraction"])


@query(
    "A31_size_uniformity",
    f"""WITH {PIXELS_SQL}, s AS (SELECT patch_id, cell_label, count(*) AS n FROM px WHERE cell_label > 0 GROUP BY 1, 2)
    SELECT patch_id, count(*) AS n_cells, round(stddev_pop(n), 6) AS size_std, round(stddev_pop(n) / avg(n), 6) AS size_cv FROM s GROUP BY 1""",
)
def _(spark, d):
    return rounded(quality.size_uniformity(pixels(spark, d), "cell_label", K), ["size_std", "size_cv"])


@query(
    "A32_set_cv",
    f"""WITH {FG_SQL} SELECT patch_id, round((stddev_pop(v0) FILTER (WHERE foreground AND cell_label = 0) / avg(v0) + stddev_pop(v1) FILTER (WHERE foreground AND cell_label = 0) / avg(v1)) / 2, 6) AS cv FROM fg GROUP BY 1""",
)
def _(spark, d):
    fg = _foreground(pixels(spark, d))
    return rounded(quality.set_cv(fg, CH, K, F.col("foreground") & (F.col("cell_label") == 0)), ["cv"])


Z_SQL = """zz AS (SELECT *, (v0 - avg(v0) OVER w) / CASE WHEN stddev_pop(v0) OVER w > 0 THEN stddev_pop(v0) OVER w ELSE 1 END AS z0,
  (v1 - avg(v1) OVER w) / CASE WHEN stddev_pop(v1) OVER w > 0 THEN stddev_pop(v1) OVER w ELSE 1 END AS z1 FROM {src} WINDOW w AS (PARTITION BY patch_id, x))"""


@query(
    "A33_first_pc_share",
    f"""WITH {FG_SQL}, {Z_SQL.format(src='fg')}, c AS (SELECT patch_id, var_pop(z0) AS a, var_pop(z1) AS b, covar_pop(z0, z1) AS c FROM zz WHERE foreground AND cell_label = 0 GROUP BY 1)
    SELECT patch_id, round(((a + b) / 2 + sqrt(((a - b) / 2)**2 + c * c)) / (a + b), 5) AS first_pc FROM c""",
)
def _(spark, d):
    z = quality.column_zscores(_foreground(pixels(spark, d)), CH, K)
    return rounded(quality.set_first_pc(z, CH, K, F.col("foreground") & (F.col("cell_label") == 0)), ["first_pc"], 5)


TYPED_SQL = f"""{PIXELS_SQL}, {Z_SQL.format(src='px')}, cv AS (SELECT patch_id, cell_label AS label, avg(v0) AS f0, avg(v1) AS f1, avg(z0) AS z0, avg(z1) AS z1 FROM zz WHERE cell_label > 0 GROUP BY 1, 2),
ty AS (SELECT *, CAST(label % 3 AS INTEGER) AS cluster FROM cv),
cu AS (SELECT patch_id, cluster, count(*) AS n, (stddev_pop(f0) / avg(f0) + stddev_pop(f1) / avg(f1)) / 2 AS cv, var_pop(z0) AS a, var_pop(z1) AS b, covar_pop(z0, z1) AS c FROM ty GROUP BY 1, 2),
cp AS (SELECT patch_id, cluster, n, cv, CASE WHEN n = 1 THEN 1 ELSE ((a + b) / 2 + sqrt(((a - b) / 2)**2 + c * c)) / (a + b) END AS first_pc FROM cu)"""


def _cells_and_types(spark, d):
    cells = quality.cell_vectors(quality.column_zscores(pixels(spark, d), CH, K), "cell_label", CH, K)
    typed = cells.select("patch_id", "label", F.lit(3).alias("k"), (F.col("label") % 3).cast("int").alias("cluster"))
    return cells, typed


@query("A34_cluster_uniformity", f"WITH {TYPED_SQL} SELECT patch_id, 3 AS k, cluster, n, round(cv, 5) AS cv, round(first_pc, 5) AS first_pc FROM cp")
def _(spark, d):
    return rounded(quality.cluster_uniformity(*_cells_and_types(spark, d), K), ["cv", "first_pc"], 5)


@query("A35_size_weighted_mean", f"WITH {TYPED_SQL} SELECT patch_id, 3 AS k, round(sum(cv * n) / sum(n), 5) AS cv, round(sum(first_pc * n) / sum(n), 5) AS first_pc FROM cp GROUP BY 1")
def _(spark, d):
    per = quality.cluster_uniformity(*_cells_and_types(spark, d), K)
    return rounded(quality.size_weighted(per, ["patch_id", "k"], ["cv", "first_pc"]), ["cv", "first_pc"], 5)


@query("A36_cell_types")
def _(spark, d):
    cells, _types = _cells_and_types(spark, d)
    return quality.grouped_kmeans(cells, K, range(1, 11))


def _lloyd_sql(rounds: int) -> str:
    """Rounds of nearest centres and means, from the first k cells of each patch; settled centres stay."""
    steps = [
        "ce AS (SELECT patch_id, label, round(100 * z0 + label % 7, 6) AS z0, round(100 * z1 - label % 11, 6) AS z1 FROM cv)",
        "n1 AS (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY label) AS r FROM ce)",
        "c0 AS MATERIALIZED (SELECT patch_id, k, r - 1 AS c, z0 AS m0, z1 AS m1 FROM n1, range(1, 6) AS t(k) WHERE r <= k)",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT patch_id, label, k, arg_min(c, ((z0 - m0) * (z0 - m0) + (z1 - m1) * (z1 - m1), c)) AS c FROM ce JOIN c{i} USING (patch_id) GROUP BY 1, 2, 3)"
        )
        if i < rounds:
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT o.patch_id, o.k, o.c, coalesce(avg(ce.z0), any_value(o.m0)) AS m0, coalesce(avg(ce.z1), any_value(o.m1)) AS m1 FROM c{i} o LEFT JOIN a{i} a ON a.patch_id = o.patch_id AND a.k = o.k AND a.c = o.c LEFT JOIN ce ON ce.patch_id = a.patch_id AND ce.label = a.label GROUP BY 1, 2, 3)"
            )
    return ",\n".join(steps)


@query("A36_cell_types_from_given_starts", f"WITH {TYPED_SQL}, {_lloyd_sql(24)} SELECT patch_id, label, CAST(k AS INTEGER) AS k, CAST(c AS INTEGER) AS cluster FROM a24")
def _(spark, d):
    """Starting centres are the first cells by label; vectors are set apart by label, so that none are equal."""
    cells, _types = _cells_and_types(spark, d)
    apart = F.array(F.round(100 * F.col("z")[0] + F.col("label") % 7, 6), F.round(100 * F.col("z")[1] - F.col("label") % 11, 6))
    cells = cells.withColumn("z", apart)
    return quality.grouped_kmeans(cells, K, range(1, 6), order=F.col("label"))


@query(
    "A37_silhouette",
    f"""WITH {TYPED_SQL}, pr AS (SELECT a.patch_id, a.label, a.cluster AS own, b.cluster AS other, sum(sqrt((a.z0 - b.z0)**2 + (a.z1 - b.z1)**2)) AS s, count(*) AS n FROM ty a JOIN ty b ON a.patch_id = b.patch_id GROUP BY 1, 2, 3, 4),
    ab AS (SELECT patch_id, label, max(CASE WHEN own = other THEN s / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b, max(CASE WHEN own = other THEN n END) AS n FROM pr GROUP BY 1, 2)
    SELECT patch_id, 3 AS k, round(avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 5) AS silhouette FROM ab GROUP BY 1""",
)
def _(spark, d):
    cells, typed = _cells_and_types(spark, d)
    return rounded(quality.silhouette(cells, typed, K, block=8), ["silhouette"], 5)


@query("A38_segmentation_metrics")
def _(spark, d):
    fixed, _matches = _repair(spark, d)
    return quality.evaluate(_foreground(fixed), CH, K, match.matched_fractions(fixed, K), ks=(1, 2, 3), least_cells=5)


_SCORE_SQL = " + ".join(
    f"(m{i % 3} - ({mean})) / {scale} * ({a} * {quality.SCORE_SHARES[0]} + ({b}) * {quality.SCORE_SHARES[1]})"
    for i, (mean, scale, a, b) in enumerate(zip(quality.SCORE_MEAN, quality.SCORE_SCALE, quality.SCORE_FIRST, quality.SCORE_SECOND))
)


@query("A39_quality_score", f"WITH m AS (SELECT p_partkey, p_size / 50 AS m0, (p_retailprice - 900) / 100 AS m1, (p_partkey % 10) / 10 AS m2 FROM part) SELECT p_partkey, round(exp({_SCORE_SQL}), 6) AS score FROM m")
def _(spark, d):
    part = table(spark, d, "part")
    m = [F.col("p_size") / 50, (F.col("p_retailprice") - 900) / 100, (F.col("p_partkey") % 10) / 10]
    score = quality.quality_score([m[i % 3] for i in range(14)])
    return part.select("p_partkey", F.round(score, 6).alias("score"))


@query("A40_informative_patch_scores")
def _(spark, d):
    """Every patch that the content filter (P7, P8) calls informative, with all numbers of types from 1 to 10."""
    fixed, _matches = _repair(spark, d)
    informative = qc.flag_patches(qc.patch_statistics(pixels(spark, d), "v0", "v1"), mean=25.5).where("is_informative").select("patch_id")
    kept = fixed.join(informative, "patch_id", "left_semi")
    out = quality.evaluate(_foreground(kept), CH, K, match.matched_fractions(kept, K), least_cells=20)
    return out.select("patch_id", "n_cells", "QualityScore")
