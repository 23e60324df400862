"""Normalisation, ranking and marker-test queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissuegrid.functions import rows
from tissuegrid.functions.special import normal_cdf_sql, normal_quantile_sql
from tissuegrid.operators import markers as mk
from tissuegrid.operators import normalize as nz
from tissuegrid.operators import orderstats
from tissuegrid.plans.catalog import query
from tissuegrid.plans.dataset import (
    CELLS_SQL,
    CLUSTERS_SQL,
    LONG_SQL,
    MARKERS,
    cells,
    clusters,
    long_measurements,
    measurements,
    table,
)

M = MARKERS


def rounded(df, columns, digits=6):
    wanted = set(columns)
    return df.select(*[F.round(c, digits).alias(c) if c in wanted else F.col(c) for c in df.columns])


def sql_rounded(columns, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


# --- projections -------------------------------------------------------------------------------


@query("P1_strip_identifiers", f"WITH {CELLS_SQL} SELECT cell_mask_id, quantity, price, discount, tax FROM cells")
def _(spark, d):
    return nz.strip_identifiers(cells(spark, d))


@query(
    "P2_complete_cases",
    """SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events
       WHERE value IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL""",
)
def _(spark, d):
    events = table(spark, d, "events").select(
        "event_id", "value", F.get_json_object("props", "$.k").alias("k")
    )
    return nz.complete_cases(events, ["value", "k"])


@query(
    "P2_text_to_number",
    """SELECT p_partkey, p_retailprice, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS code FROM part
       WHERE TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) IS NOT NULL""",
)
def _(spark, d):
    part = table(spark, d, "part").select(
        "p_partkey", "p_retailprice", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("code")
    )
    return nz.complete_cases(part, ["p_retailprice", "code"])


@query(
    "P3_drop_empty_columns",
    "SELECT p_partkey, CASE WHEN p_size > 10 THEN p_retailprice END AS price FROM part WHERE p_size > 10",
)
def _(spark, d):
    part = table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_size") > 1000, F.col("p_size")).alias("never"),
    )
    return nz.drop_empty_columns(part, ["price", "never"])


# --- normalisers -------------------------------------------------------------------------------

_Z = {m: f"(ln(1 + {m}) - avg(ln(1 + {m})) OVER ()) / stddev_samp(ln(1 + {m})) OVER ()" for m in M}
_LIST = "[quantity, price, discount, tax]"
_UNPACK = ", ".join(f"round(w[{i + 1}], 6) AS {m}" for i, m in enumerate(M))
_RANKS = (
    f"list_transform({_LIST}, lambda a: (len(list_filter({_LIST}, lambda b: b < a))"
    f" + (len(list_filter({_LIST}, lambda b: b = a)) + 1) / 2.0) / 5.0)"
)
_ORDINAL = (
    "[" + ", ".join(
        "(" + " + ".join(
            f"CAST({b} < {a} OR ({b} = {a} AND {j} <= {i}) AS INTEGER)" for j, b in enumerate(M)
        ) + ") / 5.0"
        for i, a in enumerate(M)
    ) + "]"
)


def _normaliser(name, norm, sql, digits=6):
    @query(name, sql)
    def run(spark, d):
        return rounded(nz.prepare(cells(spark, d), norm), M, digits)


_normaliser(
    "X1_log1p",
    "log1p",
    f"WITH {CELLS_SQL} SELECT cell_mask_id, "
    + ", ".join(f"round(ln(1 + {m}), 6) AS {m}" for m in M)
    + " FROM cells",
)
_normaliser(
    "X2_zscore_log",
    "zscore_log",
    f"WITH {CELLS_SQL} SELECT cell_mask_id, " + ", ".join(f"round({_Z[m]}, 4) AS {m}" for m in M) + " FROM cells",
    digits=4,
)
_normaliser(
    "X3_clr",
    "clr",
    f"""WITH {CELLS_SQL}, g AS (
      SELECT *, (CASE WHEN quantity <> 0 THEN 1 ELSE 0 END + CASE WHEN price <> 0 THEN 1 ELSE 0 END
        + CASE WHEN discount <> 0 THEN 1 ELSE 0 END + CASE WHEN tax <> 0 THEN 1 ELSE 0 END) AS k,
        (CASE WHEN quantity <> 0 THEN ln(quantity) ELSE 0 END + CASE WHEN price <> 0 THEN ln(price) ELSE 0 END
        + CASE WHEN discount <> 0 THEN ln(discount) ELSE 0 END + CASE WHEN tax <> 0 THEN ln(tax) ELSE 0 END) AS s
      FROM cells)
    SELECT cell_mask_id, """
    + ", ".join(f"round(ln(1 + {m} / exp(s / k)), 6) AS {m}" for m in M)
    + " FROM g",
)
_normaliser(
    "X4_double_zscore",
    "double_z",
    f"""WITH {CELLS_SQL}, z AS (SELECT cell_mask_id, """
    + ", ".join(f"({m} - avg({m}) OVER ()) / stddev_pop({m}) OVER () AS {m}" for m in M)
    + """ FROM cells), r AS (SELECT *, (quantity + price + discount + tax) / 4 AS mu FROM z),
    s AS (SELECT *, sqrt(((quantity - mu)**2 + (price - mu)**2 + (discount - mu)**2 + (tax - mu)**2) / 4) AS sd FROM r),
    w AS (SELECT cell_mask_id, """
    + ", ".join(f"({m} - mu) / sd AS {m}" for m in M)
    + " FROM s) SELECT cell_mask_id, "
    + ", ".join(f"round(-ln(1 - least({normal_cdf_sql(m)}, 1 - 1e-12)), 4) AS {m}" for m in M)
    + " FROM w",
    digits=4,
)
_normaliser(
    "W1_rank_fraction",
    "rank_fraction",
    f"WITH {CELLS_SQL}, r AS (SELECT cell_mask_id, {_RANKS} AS w FROM cells) SELECT cell_mask_id, {_UNPACK} FROM r",
)
_normaliser(
    "W2_rank_ordinal",
    "rank_fraction_ordinal",
    f"WITH {CELLS_SQL}, r AS (SELECT cell_mask_id, {_ORDINAL} AS w FROM cells) SELECT cell_mask_id, {_UNPACK} FROM r",
)
_normaliser(
    "X5_rank_gaussian",
    "rank_gaussian",
    f"""WITH {CELLS_SQL}, r AS (SELECT cell_mask_id, {_RANKS} AS w FROM cells),
    f AS (SELECT cell_mask_id, {", ".join(f"w[{i + 1}] AS {m}" for i, m in enumerate(M))} FROM r)
    SELECT cell_mask_id, {", ".join(f"round({normal_quantile_sql(m)}, 6) AS {m}" for m in M)} FROM f""",
)


@query(
    "X6_prepare_by_name",
    f"WITH {CELLS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS norm, round(sum(CAST(round(1000 * ({e}), 0) AS BIGINT)) / 1000.0, 0) AS total FROM cells"
        for n, e in (("none", "quantity"), ("log1p", "ln(1 + quantity)"))
    ),
)
def _(spark, d):
    parts = []
    for norm in ("none", "log1p"):
        df = nz.prepare(cells(spark, d), norm)
        scaled = F.sum(F.round(F.col("quantity") * 1000, 0).cast("bigint"))
        parts.append(df.agg(F.lit(norm).alias("norm"), F.round(scaled / 1000.0, 0).alias("total")))
    return parts[0].unionByName(parts[1])


@query(
    "W2_rank_edge_rows",
    f"""WITH {CELLS_SQL} SELECT cell_mask_id, false AS all_missing, false AS all_infinite,
        quantity = price AND price = discount AND discount = tax AS is_constant FROM cells""",
)
def _(spark, d):
    packed = cells(spark, d).select("cell_mask_id", F.array(*M).alias("v"))
    flags = rows.rank_edge_flags("v")
    return packed.select("cell_mask_id", *[c.alias(n) for n, c in flags.items()])


def _entropy_sql(zero):
    total = "(quantity + price + discount + tax)"
    terms = " + ".join(
        f"CASE WHEN {m} > 0 THEN -({m} / {total}) * ln({m} / {total}) / ln(2) ELSE 0 END" for m in M
    )
    return f"CASE WHEN {total} > 0 THEN {terms} ELSE {zero} END"


@query(
    "X7_cell_entropy",
    f"WITH {CELLS_SQL} SELECT cell_mask_id, round({_entropy_sql('0.0')}, 6) AS cell_entropy FROM cells",
)
def _(spark, d):
    scored = nz.marker_entropy(cells(spark, d), M)
    return scored.select("cell_mask_id", F.round("cell_entropy", 6).alias("cell_entropy"))


@query(
    "X8_channel_entropy",
    f"WITH {CELLS_SQL} SELECT cell_mask_id, patch_id, round({_entropy_sql('NULL')}, 6) AS cell_entropy FROM cells",
)
def _(spark, d):
    c = cells(spark, d)
    scored = nz.add_entropy(c.select("cell_mask_id", "patch_id"), c, M)
    return scored.withColumn("cell_entropy", F.round("cell_entropy", 6))


@query("X9_entropy_bounds", "SELECT 0.0 AS low, round(ln(count(DISTINCT n_name)) / ln(2), 6) AS high FROM nation")
def _(spark, d):
    n = table(spark, d, "nation").agg(F.count_distinct("n_name").alias("n"))
    return n.select(F.lit(0.0).alias("low"), F.round(F.log2("n"), 6).alias("high"))


@query(
    "W10_column_zscore",
    f"WITH {CELLS_SQL} SELECT cell_mask_id, patch_id, global_cell_id, "
    + ", ".join(f"round(({m} - avg({m}) OVER ()) / stddev_pop({m}) OVER (), 4) AS {m}" for m in M)
    + " FROM cells",
)
def _(spark, d):
    return rounded(nz.zscore_columns(cells(spark, d), M), M, 4)


# --- marker tests ------------------------------------------------------------------------------

RANKED_SQL = f"""{LONG_SQL},
ranked AS (SELECT cluster, feature, v,
  rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS rk FROM long),
part1 AS (SELECT feature, cluster, count(*) AS n1, sum(v) AS s1, sum(rk) AS rank_sum FROM ranked GROUP BY 1, 2),
whole AS (SELECT feature, sum(n1) AS n, sum(s1) AS s FROM part1 GROUP BY 1),
means AS (SELECT p.*, w.n - n1 AS n2, s1 / n1 AS a, (s - s1) / (n - n1) AS b FROM part1 p JOIN whole w USING (feature)),
zs AS (SELECT *, (rank_sum - CAST(n1 AS DOUBLE) * (n1 + n2 + 1) / 2)
        / sqrt(CAST(n1 AS DOUBLE) * n2 * (n1 + n2 + 1) / 12) AS z FROM means),
ps AS (SELECT *, 2 * {normal_cdf_sql('(-abs(z))')} AS p_value FROM zs),
rk2 AS (SELECT *, count(*) OVER (PARTITION BY cluster ORDER BY p_value) AS k, count(*) OVER (PARTITION BY cluster) AS m FROM ps),
de AS (SELECT *, least(1.0, min(p_value * m / k) OVER (PARTITION BY cluster ORDER BY p_value DESC)) AS p_adj,
   (a + 1e-9) / (b + 1e-9) AS fc FROM rk2)"""

DE_SQL = f"""WITH {RANKED_SQL} SELECT cluster, feature, round(p_value, 6) AS p_value, round(p_adj, 6) AS p_value_corrected,
  round(fc, 6) AS fold_change, round(fc, 6) AS fold_change_raw, round(log2(fc), 6) AS log2_fold_change,
  round(log2(fc), 6) AS log2_fold_change_raw, round(a, 6) AS mean_cluster_norm, round(b, 6) AS mean_rest_norm,
  round(a, 6) AS mean_cluster_log1p, round(b, 6) AS mean_rest_log1p,
  round(0.5 * (log2(a + 1e-9) + log2(b + 1e-9)), 6) AS A_value FROM de"""


def _round_de(df):
    digits = {c: 6 for c in df.columns if c.startswith(("p_", "fold", "log2", "A_"))}
    digits.update({c: 6 for c in df.columns if c.startswith("mean_")})
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _de(spark, d):
    return mk.one_vs_rest(long_measurements(spark, d))


@query("A42_rank_sum", DE_SQL)
def _(spark, d):
    return _round_de(_de(spark, d))


@query(
    "A41_cluster_rest_means",
    f"""WITH {RANKED_SQL} SELECT feature, cluster, n1, CAST(n2 AS BIGINT) AS n2, round(a, 6) AS mean_cluster_norm, round(b, 6) AS mean_rest_norm,
        round(a, 6) AS mean_cluster_log1p, round(b, 6) AS mean_rest_log1p FROM means""",
)
def _(spark, d):
    return _round_de(mk.cluster_and_rest(long_measurements(spark, d)))


@query(
    "W3_tie_ranks",
    f"""WITH {LONG_SQL} SELECT feature, v, count(*) AS n, any_value(rk) AS avg_rank FROM (
        SELECT feature, v, rank() OVER (PARTITION BY feature ORDER BY v)
          + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS rk FROM long) GROUP BY feature, v""",
)
def _(spark, d):
    ranked = orderstats.ranked_counts(long_measurements(spark, d), ["feature"], "v")
    place = F.col("below") + (F.col("ties") + 1) / F.lit(2.0)
    return ranked.select("feature", "v", "n", place.alias("avg_rank"))


@query(
    "W7_benjamini_hochberg",
    """WITH t AS (SELECT event_type AS cluster, event_id, round(value / (SELECT max(value) + 1 FROM events), 9) AS p_value FROM events),
    k AS (SELECT *, count(*) OVER (PARTITION BY cluster ORDER BY p_value) AS k, count(*) OVER (PARTITION BY cluster) AS m FROM t)
    SELECT cluster, event_id, p_value, round(least(1.0, min(p_value * m / k) OVER (PARTITION BY cluster ORDER BY p_value DESC)), 9) AS p_value_corrected FROM k""",
)
def _(spark, d):
    events = table(spark, d, "events")
    top = events.agg(F.max("value") + 1).scalar()
    tests = events.select(
        F.col("event_type").alias("cluster"), "event_id", F.round(F.col("value") / top, 9).alias("p_value")
    )
    out = orderstats.corrected_levels(tests, "cluster", "p_value")
    return out.withColumn("p_value_corrected", F.round("p_value_corrected", 9))


@query(
    "X10_fold_changes",
    f"""WITH {RANKED_SQL} SELECT cluster, feature, round(fc, 6) AS fold_change, round(log2(fc), 6) AS log2_fold_change,
        round(0.5 * (log2(a + 1e-9) + log2(b + 1e-9)), 6) AS A_value FROM de""",
)
def _(spark, d):
    out = mk.with_fold_changes(mk.cluster_and_rest(long_measurements(spark, d)))
    return _round_de(out.select("cluster", "feature", "fold_change", "log2_fold_change", "A_value"))


@query(
    "J19_aligned_test",
    f"""WITH {CELLS_SQL}, {CLUSTERS_SQL}, j AS (SELECT c.*, k.cluster FROM cells c JOIN clusters k USING (cell_mask_id) WHERE k.cluster IS NOT NULL),
    long AS ("""
    + " UNION ALL ".join(f"SELECT cluster, '{m}' AS feature, {m} AS v, ln(1 + {m}) AS raw FROM j" for m in M)
    + """) SELECT cluster, feature, count(*) AS n, round(avg(v), 6) AS mean_v, round(avg(raw), 6) AS mean_raw FROM long GROUP BY 1, 2""",
)
def _(spark, d):
    c = cells(spark, d)
    long = mk.align(c, nz.prepare(c, "log1p"), clusters(spark, d), M, "cell_mask_id")
    return long.groupBy("cluster", "feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("v"), 6).alias("mean_v"),
        F.round(F.avg("raw"), 6).alias("mean_raw"),
    )


@query(
    "A43_fold_change_matrix",
    f"""WITH {RANKED_SQL} SELECT cluster, """
    + ", ".join(f"round(coalesce(max(CASE WHEN feature = '{m}' THEN log2(fc) END), 0), 6) AS {m}" for m in M)
    + " FROM de GROUP BY cluster",
)
def _(spark, d):
    return rounded(mk.fold_change_matrix(_de(spark, d), features=M), M)


@query(
    "U2_top_marker_union",
    f"""WITH {RANKED_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY abs(log2(fc)) DESC, feature) AS place FROM de)
        SELECT DISTINCT feature FROM o WHERE place <= 2""",
)
def _(spark, d):
    return mk.top_marker_union(_de(spark, d), "log2_fold_change", 2)


@query(
    "W5_top_markers",
    f"""WITH {RANKED_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY abs(log2(fc)) DESC, feature) AS place FROM de)
        SELECT cluster, feature, place, round(log2(fc), 6) AS log2_fold_change FROM o WHERE place <= 3""",
)
def _(spark, d):
    out = mk.top_markers(_de(spark, d), "log2_fold_change", 3)
    return _round_de(out.select("cluster", "feature", F.col("place").cast("bigint").alias("place"), "log2_fold_change"))


@query(
    "W6_leading_features",
    f"""WITH {RANKED_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY fc DESC, feature) AS r FROM de)
        SELECT cluster, string_agg(feature, ',' ORDER BY r) AS features FROM o WHERE r <= 10 GROUP BY cluster""",
)
def _(spark, d):
    out = mk.leading_features(_de(spark, d))
    return out.select("cluster", F.array_join("features", ",").alias("features"))


@query(
    "T1_sorted_by_change",
    f"WITH {RANKED_SQL} SELECT cluster, feature, round(fc, 6) AS fold_change_raw FROM de ORDER BY 3 DESC",
)
def _(spark, d):
    return _round_de(mk.sorted_by_change(_de(spark, d)).select("cluster", "feature", "fold_change_raw"))


@query(
    "P16_volcano_flags",
    f"""WITH {RANKED_SQL} SELECT cluster, feature, round(-log10(p_adj + 1e-300), 6) AS neg_log10_p,
        p_adj < 0.5 AND abs(log2(fc)) >= 0.001 AS is_significant FROM de""",
)
def _(spark, d):
    out = mk.volcano_flags(_de(spark, d), alpha=0.5, threshold=0.001)
    return out.select("cluster", "feature", F.round("neg_log10_p", 6).alias("neg_log10_p"), "is_significant")


@query(
    "P17_ma_flags",
    f"""WITH {RANKED_SQL} SELECT cluster, feature, round(0.5 * (log2(a + 1e-9) + log2(b + 1e-9)), 6) AS A_value,
        p_adj < 0.5 AND abs(log2(fc)) >= 0.001 AS is_significant FROM de""",
)
def _(spark, d):
    out = mk.ma_flags(_de(spark, d), alpha=0.5, threshold=0.001)
    return out.select("cluster", "feature", F.round("A_value", 6).alias("A_value"), "is_significant")


@query(
    "P18_significant_direction",
    f"""WITH {RANKED_SQL} SELECT cluster, feature, CASE WHEN fc > 1 THEN 'positive' WHEN fc < 1 THEN 'negative' ELSE 'none' END AS direction
        FROM de WHERE p_adj < 0.9""",
)
def _(spark, d):
    return mk.significant(_de(spark, d), alpha=0.9).select("cluster", "feature", "direction")


@query(
    "A27_cluster_sizes",
    f"WITH {CLUSTERS_SQL} SELECT cluster, count(*) AS n_cells FROM clusters WHERE cluster IS NOT NULL GROUP BY cluster",
)
def _(spark, d):
    return mk.cluster_sizes(clusters(spark, d))


@query(
    "K6_cluster_payload",
    f"""WITH {RANKED_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY abs(log2(fc)) DESC, feature) AS place FROM de)
        SELECT cluster, any_value(n1) AS n_cells, count(*) AS n_markers, string_agg(feature, ',' ORDER BY place) AS markers
        FROM o WHERE place <= 5 GROUP BY cluster""",
)
def _(spark, d):
    sizes = mk.cluster_sizes(measurements(spark, d))
    payload = mk.cluster_payload(_de(spark, d), sizes)
    parsed = payload.select(
        F.from_json("payload", "cluster string, n_cells bigint, top_markers array<struct<marker:string>>").alias("p")
    )
    return parsed.select(
        "p.cluster",
        "p.n_cells",
        F.size("p.top_markers").cast("bigint").alias("n_markers"),
        F.array_join(F.col("p.top_markers.marker"), ",").alias("markers"),
    )
