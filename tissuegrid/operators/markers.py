"""Which markers tell a cluster from the rest: rank-sum tests, corrections, fold changes, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tissuegrid.functions.special import two_sided_p
from tissuegrid.operators.orderstats import counted_values, ranks_of
from tissuegrid.runtime import cut_lineage

EPSILON = 1e-9


def align(norm: DataFrame, raw: DataFrame, clusters: DataFrame, markers: Sequence[str], key: str) -> DataFrame:
    """Long (cluster, feature, v, raw) rows of cells that have a cluster, matched by key."""
    known = clusters.where(F.col("cluster").isNotNull()).select(key, "cluster")
    left = norm.select(key, F.array(*[F.col(f"`{m}`").cast("double") for m in markers]).alias("_n"))
    right = raw.select(key, F.array(*[F.col(f"`{m}`").cast("double") for m in markers]).alias("_r"))
    names = F.array(*[F.lit(m) for m in markers])
    joined = left.join(known, key).join(right, key)
    cells = joined.select("cluster", F.explode(F.arrays_zip(names.alias("feature"), "_n", "_r")).alias("e"))
    return cells.select(
        "cluster", F.col("e.feature").alias("feature"), F.col("e._n").alias("v"), F.col("e._r").alias("raw")
    )


def counted(long: DataFrame, pieces: int | None = None) -> DataFrame:
    """Stage table (feature, cluster, v, n, raw) of equal values counted together; what follows reads only this."""
    return counted_values(long, ["feature"], "v", ["cluster"], ["raw"], pieces)


def cluster_and_rest(long: DataFrame) -> DataFrame:
    """Counts and means of both value columns in the cluster and in everything else."""
    return _cluster_and_rest(long.groupBy("feature", "cluster").agg(F.count("v").alias("n1"), F.sum("v").alias("s1"), F.sum("raw").alias("r1")))


def _cluster_and_rest(part: DataFrame) -> DataFrame:
    whole = part.groupBy("feature").agg(
        F.sum("n1").alias("n"), F.sum("s1").alias("s"), F.sum("r1").alias("r")
    )
    n2 = F.col("n") - F.col("n1")
    return part.join(whole, "feature").select(
        "feature",
        "cluster",
        "n1",
        n2.alias("n2"),
        (F.col("s1") / F.col("n1")).alias("mean_cluster_norm"),
        F.try_divide(F.col("s") - F.col("s1"), n2).alias("mean_rest_norm"),
        (F.col("r1") / F.col("n1")).alias("mean_cluster_log1p"),
        F.try_divide(F.col("r") - F.col("r1"), n2).alias("mean_rest_log1p"),
    )


def rank_sums(counts: DataFrame) -> DataFrame:
    """Sum of tie-averaged ranks per (feature, cluster); each marker is ranked once for all clusters."""
    ranked = ranks_of(counts, ["feature"], "v")
    share = F.col("n") * (F.col("below") + (F.col("ties") + 1) / F.lit(2.0))
    return ranked.groupBy("feature", "cluster").agg(F.sum(share).alias("rank_sum"))


def with_rank_test(df: DataFrame) -> DataFrame:
    """z and two-sided p of the rank sum, normal approximation without tie or continuity correction."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    expected = n1 * (n1 + n2 + 1) / 2
    spread = F.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
    tested = df.withColumn("z", F.try_divide(F.col("rank_sum") - expected, spread))
    return tested.withColumn("p_value", two_sided_p("z"))


def benjamini_hochberg(df: DataFrame, group: str = "cluster", p: str = "p_value", name: str = "p_value_corrected") -> DataFrame:
    """Step-up correction within the group of one row per marker, which the panel keeps small.

    For groups of any size see ``orderstats.corrected_levels``.
    """
    ascending = W.partitionBy(group).orderBy(p)
    whole = W.partitionBy(group)
    stepped = df.withColumn("_rank", F.count(F.lit(1)).over(ascending.rangeBetween(W.unboundedPreceding, 0)))
    stepped = stepped.withColumn("_q", F.col(p) * F.count(F.col(p)).over(whole) / F.col("_rank"))
    running = W.partitionBy(group).orderBy(F.col(p).desc())
    return stepped.withColumn(name, F.least(F.lit(1.0), F.min("_q").over(running))).drop("_rank", "_q")


def fold_change(a: Column, b: Column) -> Column:
    return F.when(b > 0, (a + EPSILON) / (b + EPSILON))


def with_fold_changes(df: DataFrame) -> DataFrame:
    a, b = F.col("mean_cluster_norm"), F.col("mean_rest_norm")
    out = df.withColumn("fold_change", fold_change(a, b)).withColumn(
        "fold_change_raw", fold_change(F.col("mean_cluster_log1p"), F.col("mean_rest_log1p"))
    )
    for name in ("fold_change", "fold_change_raw"):
        out = out.withColumn(f"log2_{name}", F.when(F.col(name) > 0, F.log2(name)))
    return out.withColumn("A_value", 0.5 * (F.log2(a + EPSILON) + F.log2(b + EPSILON)))


def one_vs_rest(long: DataFrame, pieces: int | None = None) -> DataFrame:
    """Full test table, one row per (cluster, feature), from long (cluster, feature, v, raw) rows."""
    counts = counted(long, pieces)
    n = F.when(F.col("v").isNotNull(), F.col("n"))
    part = counts.groupBy("feature", "cluster").agg(F.coalesce(F.sum(n), F.lit(0)).alias("n1"), F.sum(F.col("v") * n).alias("s1"), F.sum("raw").alias("r1"))
    joined = _cluster_and_rest(part).join(rank_sums(counts), ["feature", "cluster"])
    tested = benjamini_hochberg(with_rank_test(joined))
    return with_fold_changes(tested).select(
        "cluster",
        "feature",
        "p_value",
        "p_value_corrected",
        "fold_change",
        "fold_change_raw",
        "log2_fold_change",
        "log2_fold_change_raw",
        "mean_cluster_norm",
        "mean_rest_norm",
        "mean_cluster_log1p",
        "mean_rest_log1p",
        "A_value",
    )


def fold_change_column(use_log: bool, use_raw: bool) -> str:
    return ("log2_" if use_log else "") + "fold_change" + ("_raw" if use_raw else "")


def top_markers(results: DataFrame, column: str, n: int) -> DataFrame:
    """The n markers of largest absolute change in each cluster, with their place."""
    size = F.coalesce(F.abs(F.col(column)), F.lit(-1.0))
    w = W.partitionBy("cluster").orderBy(size.desc(), F.col("feature"))
    return results.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def top_marker_union(results: DataFrame, column: str, n: int) -> DataFrame:
    return top_markers(results, column, n).select("feature").distinct()


def fold_change_matrix(
    results: DataFrame,
    use_log: bool = True,
    use_raw: bool = False,
    top_n: int | None = None,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """cluster × marker matrix; unknown entries are 0. The panel gives the column list.

    Where the list has to be found out, the results are written first, so that the test runs once.
    """
    column = fold_change_column(use_log, use_raw)
    if top_n is not None or features is None:
        results = cut_lineage(results)
    if top_n is not None:
        picked = top_marker_union(results, column, top_n)
        features = sorted(r.feature for r in picked.collect())
        results = results.join(picked, "feature", "left_semi")
    elif features is None:
        features = sorted(r.feature for r in results.select("feature").distinct().collect())
    wide = results.groupBy("cluster").pivot("feature", list(features)).agg(F.first(column))
    return wide.select(
        "cluster", *[F.coalesce(F.col(f"`{f}`"), F.lit(0.0)).alias(f) for f in features]
    )


def significant(results: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Rows passing the corrected level, with the side of one their raw fold change lies on."""
    return results.where(F.col("p_value_corrected") < alpha).withColumn(
        "direction",
        F.when(F.col("fold_change_raw") > 1, "positive")
        .when(F.col("fold_change_raw") < 1, "negative")
        .otherwise("none"),
    )


def volcano_flags(results: DataFrame, p: str = "p_value_corrected", lfc: str = "log2_fold_change", alpha: float = 0.05, threshold: float = 1.0) -> DataFrame:
    return (
        results.na.drop("any", subset=[p, lfc])
        .withColumn("neg_log10_p", -F.log10(F.col(p) + 1e-300))
        .withColumn("is_significant", (F.col(p) < alpha) & (F.abs(F.col(lfc)) >= threshold))
    )


def ma_flags(results: DataFrame, p: str = "p_value_corrected", lfc: str = "log2_fold_change", alpha: float = 0.05, threshold: float = 1.0) -> DataFrame:
    return results.na.drop("any", subset=["A_value", p, lfc]).withColumn(
        "is_significant", (F.col(p) < alpha) & (F.abs(F.col(lfc)) >= threshold)
    )


def sorted_by_change(results: DataFrame) -> DataFrame:
    return results.orderBy(F.col("fold_change_raw").desc(), "cluster", "feature")


def leading_features(results: DataFrame, n: int = 10, ascending: bool = False) -> DataFrame:
    """One list of at most n marker names per cluster, ordered by raw fold change."""
    change = F.col("fold_change_raw")
    order = change.asc_nulls_last() if ascending else change.desc_nulls_last()
    w = W.partitionBy("cluster").orderBy(order, "feature")
    few = results.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    listed = F.array_sort(F.collect_list(F.struct("_r", "feature")))
    return few.groupBy("cluster").agg(F.transform(listed, lambda e: e["feature"]).alias("features"))


def cluster_sizes(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("cluster").isNotNull()).groupBy("cluster").agg(F.count(F.lit(1)).alias("n_cells"))


def cluster_payload(results: DataFrame, sizes: DataFrame, n: int = 5, column: str = "log2_fold_change_raw") -> DataFrame:
    """One JSON text per cluster: its size and strongest markers."""
    w_list = F.array_sort(
        F.collect_list(F.struct("place", "feature", F.col(column).alias("change"), "p_value_corrected"))
    )
    tops = top_markers(results, column, n).groupBy("cluster").agg(w_list.alias("_m"))
    markers = F.transform(
        "_m",
        lambda e: F.struct(
            e["feature"].alias("marker"),
            e["change"].alias(column),
            e["p_value_corrected"].alias("p_value_corrected"),
        ),
    )
    body = F.struct("cluster", F.col("n_cells"), F.coalesce(markers, F.array()).alias("top_markers"))
    return sizes.join(tops, "cluster", "left").select(
        "cluster", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload")
    )
