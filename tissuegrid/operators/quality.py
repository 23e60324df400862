"""Segmentation quality per patch: coverage, uniformity, cell types and the combined score.

All patches are scored together: the patch id is a grouping key, never a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tissuegrid.runtime import cut_lineage


def coverage(pixels: DataFrame, keys: Sequence[str], mask: Column, foreground: Column) -> DataFrame:
    """Share of foreground under the mask, of background under it, and of the mask on foreground."""
    m, f = mask, foreground
    return pixels.groupBy(*keys).agg(
        F.count_if(m & f).alias("_mf"), F.count_if(m & ~f).alias("_mb"), F.count_if(f).alias("_f"),
        F.count_if(~f).alias("_b"), F.count_if(m).alias("_m"),
    ).select(
        *keys,
        F.try_divide("_mf", "_f").alias("foreground_fraction"),
        F.coalesce(F.try_divide("_mb", "_b"), F.lit(0.0)).alias("background_fraction"),
        F.try_divide("_mf", "_m").alias("mask_fraction"),
    )


def size_uniformity(pixels: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    sizes = pixels.where(F.col(label) > 0).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.stddev_pop("n").alias("size_std"),
        (F.stddev_pop("n") / F.avg("n")).alias("size_cv"),
    )


def set_cv(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str], inside: Column) -> DataFrame:
    """Mean over channels of the deviation of v / channel mean on a pixel set."""
    per = [F.try_divide(F.stddev_pop(F.when(inside, F.col(c))), F.avg(c)) for c in channels]
    return pixels.groupBy(*keys).agg((sum(per[1:], per[0]) / len(per)).alias("cv"))


def column_zscores(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``{c}_z``: z-score within each image column, constant columns only centred."""
    w = W.partitionBy(*keys, "x")
    out = {}
    for c in channels:
        sd = F.stddev_pop(c).over(w)
        out[f"{c}_z"] = (F.col(c) - F.avg(c).over(w)) / F.when(sd > 0, sd).otherwise(F.lit(1.0))
    return pixels.withColumns(out)


def _pair_sums(columns: Sequence[str], weight: Column | None = None) -> list[Column]:
    def on(c: Column) -> Column:
        return c if weight is None else F.when(weight, c)

    firsts = F.array(*[F.sum(on(F.col(c))) for c in columns])
    seconds = F.array(*[F.sum(on(F.col(a) * F.col(b))) for i, a in enumerate(columns) for b in columns[i:]])
    n = F.count(F.lit(1)) if weight is None else F.count_if(weight)
    return [n.alias("_n"), firsts.alias("_s1"), seconds.alias("_s2")]


def _first_share(n: pd.Series, s1: pd.Series, s2: pd.Series) -> pd.Series:
    """Largest eigenvalue over the trace of the covariance matrix given by its sums."""
    out = []
    for count, a, b in zip(n, s1, s2):
        a = np.asarray(a, dtype=float)
        if not count or np.isnan(a).any():
            out.append(np.nan)
            continue
        m = np.zeros((len(a), len(a)))
        m[np.triu_indices(len(a))] = np.asarray(b, dtype=float)
        m = m + np.triu(m, 1).T
        cov = m / count - np.outer(a, a) / count**2
        trace = np.trace(cov)
        out.append(float(np.linalg.eigvalsh(cov)[-1] / trace) if trace > 1e-12 else np.nan)
    return pd.Series(out)


def first_share(n: str = "_n", s1: str = "_s1", s2: str = "_s2") -> Column:
    share = F.pandas_udf(_first_share, "double")(F.col(n), F.col(s1), F.col(s2))
    return F.nanvl(share, F.lit(None).cast("double"))


def set_first_pc(zscored: DataFrame, channels: Sequence[str], keys: Sequence[str], inside: Column) -> DataFrame:
    """Variance share of the first principal component of the z-scored channels on a pixel set."""
    names = [f"{c}_z" for c in channels]
    sums = zscored.groupBy(*keys).agg(*_pair_sums(names, inside))
    return sums.select(*keys, first_share().alias("first_pc"))


# --- cell types --------------------------------------------------------------------------------


def cell_vectors(zscored: DataFrame, label: str, channels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, label, f raw means, z mean z-scores) per object."""
    zs = [f"{c}_z" for c in channels]
    means = zscored.where(F.col(label) > 0).groupBy(*keys, F.col(label).alias("label")).agg(
        *[F.avg(c).alias(c) for c in [*channels, *zs]]
    )
    return means.select(*keys, "label", F.array(*channels).alias("f"), F.array(*zs).alias("z"))


def _nearest_centre(centres: str, v: str) -> Column:
    d = f"transform({centres}, c -> aggregate(zip_with(c, {v}, (a, b) -> (a - b) * (a - b)), CAST(0 AS DOUBLE), (s, e) -> s + e))"
    return F.expr(f"CAST(array_position({d}, array_min({d})) - 1 AS INT)")


def grouped_kmeans(cells: DataFrame, keys: Sequence[str], ks: Sequence[int], vector: str = "z", seed: int = 777, max_rounds: int = 500, order: Column | None = None) -> DataFrame:
    """(keys, label, k, cluster): k-means in every group and for every k at once.

    Starting centres are the k first cells of the group in hash order, or in the order given. Centres are a small table, one
    row per (group, k); cells are only aggregated, so a big group is spread over all tasks.
    """
    keys = list(keys)
    order = F.xxhash64("label", F.lit(seed)) if order is None else order
    w = W.partitionBy(*keys).orderBy(order, "label")
    starts = cells.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max(ks))
    starts = starts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_r", vector))).alias("_c"))
    every_k = F.explode(F.array(*[F.lit(k) for k in ks]))
    centres = starts.withColumn("k", every_k).select(
        *keys, "k", F.transform(F.slice("_c", F.lit(1), F.col("k")), lambda e: e[vector]).alias("centres")
    )
    centres = cut_lineage(centres)
    points = cells.select(*keys, "label", vector)
    size = F.size(vector)
    width = cells.select(size.alias("n")).first()
    if width is None:
        return points.select(*keys, "label", F.lit(0).alias("k"), F.lit(0).alias("cluster"))
    dims = range(width.n)
    for _ in range(max_rounds):
        placed = points.join(centres, keys).withColumn("cluster", _nearest_centre("centres", vector))
        means = placed.groupBy(*keys, "k", "cluster").agg(F.array(*[F.avg(F.col(vector)[i]) for i in dims]).alias("m"))
        fresh = means.groupBy(*keys, "k").agg(F.map_from_entries(F.collect_list(F.struct("cluster", "m"))).alias("_m"))
        # A centre that lost all its cells stays where it was.
        merged = centres.join(fresh, [*keys, "k"]).withColumn(
            "new", F.transform("centres", lambda c, i: F.coalesce(F.try_element_at(F.col("_m"), i), c))
        )
        shift = F.expr(
            "aggregate(zip_with(flatten(centres), flatten(new), (a, b) -> (a - b) * (a - b)), CAST(0 AS DOUBLE), (s, e) -> s + e)"
        )
        merged = cut_lineage(merged.select(*keys, "k", F.col("new").alias("centres"), shift.alias("shift")))
        centres = merged.select(*keys, "k", "centres")
        if merged.where("shift > 1e-12").isEmpty():
            break
    else:
        raise RuntimeError(f"centres still move after {max_rounds} rounds")
    return points.join(centres, keys).select(*keys, "label", "k", _nearest_centre("centres", vector).alias("cluster"))


def kmeans_labels(cells: DataFrame, vector: str, k: int, seed: int = 777) -> DataFrame:
    """k-means over one whole table with the library's own trainer."""
    prepared = cells.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(prepared)
    return model.transform(prepared).drop("_features")


def cluster_uniformity(cells: DataFrame, typed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, k, cluster, n, cv, first_pc) of each cell type; ``cells`` has label, f, z."""
    keys = list(keys)
    joined = typed.join(cells, [*keys, "label"])
    width = cells.select(F.size("f").alias("n")).first().n
    for i in range(width):
        joined = joined.withColumn(f"_f{i}", F.col("f")[i]).withColumn(f"_z{i}", F.col("z")[i])
    zs = [f"_z{i}" for i in range(width)]
    grouped = joined.groupBy(*keys, "k", "cluster").agg(
        F.array(*[
            F.when(F.sum(f"_f{i}") != 0, F.stddev_pop(f"_f{i}") / F.avg(f"_f{i}")) for i in range(width)
        ]).alias("_cv"),
        *_pair_sums(zs),
    )
    known = F.filter("_cv", lambda c: c.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, b: a + b)
    flat = (F.col("_n") == 1) | (F.aggregate("_s1", F.lit(0.0), lambda a, b: a + b) == 0)
    return grouped.select(
        *keys, "k", "cluster", F.col("_n").alias("n"),
        F.when((F.size(known) == 0) | (total == 0), 0.0).otherwise(F.try_divide(total, F.size(known))).alias("cv"),
        F.when(flat, 1.0).otherwise(first_share()).alias("first_pc"),
    )


def size_weighted(clusters: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return clusters.groupBy(*keys).agg(*[(F.sum(F.col(v) * F.col("n")) / F.sum("n")).alias(v) for v in values])


def silhouette(cells: DataFrame, typed: DataFrame, keys: Sequence[str], vector: str = "z", block: int = 2048) -> DataFrame:
    """(keys, k, silhouette): mean Euclidean silhouette, exact.

    Cells of a group are cut into blocks. A task compares two blocks and passes on one distance sum per
    (cell, k, cluster); single distances never leave it.
    """
    keys = list(keys)
    marks = typed.where("k > 1").groupBy(*keys, "label").agg(
        F.map_from_entries(F.collect_list(F.struct("k", "cluster"))).alias("marks")
    )
    ks = F.transform(F.array_sort(F.map_keys("marks")), lambda k: k)
    points = cells.select(*keys, "label", F.col(vector).alias("v")).join(marks, [*keys, "label"])
    points = points.select(*keys, "label", "v", ks.alias("ks"), F.transform(ks, lambda k: F.element_at("marks", k)).alias("cs"))
    counts = points.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_nb"))
    points = cut_lineage(points.join(counts, keys).withColumn("_b", F.pmod(F.xxhash64("label"), F.col("_nb")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    left = points.withColumn("_q", F.col("_b")).withColumn("_d", every)
    spot = [*keys, "_q", "_d"]
    # The right side gets names of its own, so that no column of the two sides can be taken for another.
    right = points.withColumn("_d", F.col("_b")).withColumn("_q", every)
    right = right.select(*[F.col(c).alias(f"other_{c}") for c in [*spot, "label", "v", "cs"]])
    schema = ", ".join(f"{k} {points.schema[k].dataType.simpleString()}" for k in keys)

    def sums(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(q) and len(d):
            a, b = np.stack(q["v"].to_numpy()), np.stack(d["other_v"].to_numpy())
            sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
            dist = np.sqrt(np.maximum(sq, 0))
            dist[q["label"].to_numpy()[:, None] == d["other_label"].to_numpy()[None, :]] = 0
            cs = np.stack(d["other_cs"].to_numpy())
            for i, k in enumerate(q["ks"].iloc[0]):
                present, at = np.unique(cs[:, i], return_inverse=True)
                total = dist @ np.eye(len(present))[at]
                rows, cols = np.indices(total.shape)
                part = pd.DataFrame({"label": q["label"].to_numpy()[rows.ravel()], "k": int(k), "other": present[cols.ravel()], "s": total.ravel()})
                parts.append(part)
        out = pd.concat(parts) if parts else pd.DataFrame({"label": [], "k": [], "other": [], "s": []})
        for name in keys:
            out[name] = q[name].iloc[0] if len(q) else (d[f"other_{name}"].iloc[0] if len(d) else 0)
        return out[[*keys, "label", "k", "other", "s"]].astype({"label": "int64", "k": "int32", "other": "int32"})

    raw = left.groupBy(*spot).cogroup(right.groupBy(*[f"other_{c}" for c in spot])).applyInPandas(sums, f"{schema}, label long, k int, other int, s double")
    totals = raw.groupBy(*keys, "label", "k", "other").agg(F.sum("s").alias("s"))
    sizes = typed.groupBy(*keys, "k", F.col("cluster").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    own = typed.select(*keys, "label", "k", "cluster")
    joined = totals.join(own, [*keys, "label", "k"]).join(sizes, [*keys, "k", "other"])
    same = F.col("other") == F.col("cluster")
    per_cell = joined.groupBy(*keys, "k", "label").agg(
        F.max(F.when(same, F.try_divide("s", F.col("n") - 1))).alias("a"),
        F.min(F.when(~same, F.col("s") / F.col("n"))).alias("b"),
        F.max(F.when(same, F.col("n"))).alias("n"),
    )
    score = F.when(F.col("n") > 1, F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))).otherwise(0.0)
    return per_cell.groupBy(*keys, "k").agg(F.avg(score).alias("silhouette"))


# --- combined ----------------------------------------------------------------------------------

# Metric order, centring, scaling, the two component rows and their variance shares.
METRICS = (
    "NumberOfCellsPer100SquareMicrons",
    "FractionOfForegroundOccupiedByCells",
    "1-FractionOfBackgroundOccupiedByCells",
    "FractionOfCellMaskInForeground",
    "1/(ln(StandardDeviationOfCellSize)+1)",
    "FractionOfMatchedCellsAndNuclei",
    "1/(AvgCVForegroundOutsideCells+1)",
    "FractionOfFirstPCForegroundOutsideCells",
    "nucleus_cv",
    "nucleus_first_pc",
    "nucleus_silhouette",
    "outside_cv",
    "outside_first_pc",
    "outside_silhouette",
)
SCORE_MEAN = (
    0.24670323, 0.22761458, 0.77619797, 0.81844031, 0.13839755, 0.52565821, 0.40882963,
    0.47843721, 0.6369653, 0.48012444, -0.03933201, 0.65830348, 0.47392855, 0.02017161,
)
SCORE_SCALE = (
    0.50052366, 0.29282845, 0.37274236, 0.326852, 0.06640284, 0.46528876, 0.23297468,
    0.29162715, 0.26499123, 0.25330019, 0.45668672, 0.27270701, 0.2439245, 0.47084118,
)
SCORE_FIRST = (
    0.09924839, 0.0969933, 0.25437275, 0.31304311, 0.26480891, 0.14801793, 0.2932504,
    0.28673252, 0.31817261, 0.29997623, 0.28617296, 0.31957945, 0.30848302, 0.29561606,
)
SCORE_SECOND = (
    0.49432047, 0.5929928, -0.29784797, -0.06378808, -0.09963801, 0.44910386, 0.02220557,
    -0.00938788, -0.14312166, -0.09237176, 0.15979289, -0.13594118, -0.08102384, 0.13937814,
)
SCORE_SHARES = (0.57297763, 0.14307601)


def quality_score(metrics: Sequence[Column]) -> Column:
    """exp of the two projections weighted by their variance share; NULL if any metric is unknown."""
    total = F.lit(0.0)
    for m, mean, scale, a, b in zip(metrics, SCORE_MEAN, SCORE_SCALE, SCORE_FIRST, SCORE_SECOND):
        total = total + (m - F.lit(mean)) / F.lit(scale) * F.lit(a * SCORE_SHARES[0] + b * SCORE_SHARES[1])
    return F.exp(total)


def type_metrics(zscored: DataFrame, label: str, typed: DataFrame, channels: Sequence[str], keys: Sequence[str], prefix: str) -> DataFrame:
    """Uniformity and silhouette of one compartment, averaged over all k."""
    keys = list(keys)
    cells = cut_lineage(cell_vectors(zscored, label, channels, keys))
    both = cut_lineage(typed.join(cells.select(*keys, "label"), [*keys, "label"], "left_semi"))
    per_k = size_weighted(cluster_uniformity(cells, both, keys), [*keys, "k"], ["cv", "first_pc"])
    scored = per_k.join(silhouette(cells, both, keys), [*keys, "k"], "left")
    scored = scored.withColumn("silhouette", F.when(F.col("k") == 1, 1.0).otherwise(F.col("silhouette")))
    return scored.groupBy(*keys).agg(
        (1 / (F.avg("cv") + 1)).alias(f"{prefix}_cv"),
        F.avg("first_pc").alias(f"{prefix}_first_pc"),
        F.avg("silhouette").alias(f"{prefix}_silhouette"),
    )


def evaluate(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str], fractions: DataFrame, nm: float = 377.5, ks: Sequence[int] = tuple(range(1, 11)), least_cells: int = 20) -> DataFrame:
    """All named metrics and the score of each patch.

    ``pixels`` carries cell_matched, nucleus_matched, cell_outside and a boolean ``foreground``; ``fractions``
    has matched_fraction per patch. Patches below ``least_cells`` get no score; no pixels give an empty table.
    """
    keys = list(keys)
    px = cut_lineage(column_zscores(pixels, channels, keys))
    if px.isEmpty():
        return px.select(*keys, F.lit(None).cast("bigint").alias("n_cells"), *[F.lit(None).cast("double").alias(m) for m in (*METRICS, "QualityScore")])
    mask, fg = F.col("cell_matched") > 0, F.col("foreground")
    outside = fg & ~mask
    area = px.groupBy(*keys).agg(F.count(F.lit(1)).alias("_px"))
    sizes = size_uniformity(px, "cell_matched", keys)
    parts = [
        area, sizes, coverage(px, keys, mask, fg), set_cv(px, channels, keys, outside),
        set_first_pc(px, channels, keys, outside), fractions.select(*keys, "matched_fraction"),
    ]
    cells = cut_lineage(cell_vectors(px, "cell_matched", channels, keys))
    typed = cut_lineage(grouped_kmeans(cells, keys, ks))
    for label, prefix in (("nucleus_matched", "nucleus"), ("cell_outside", "outside")):
        parts.append(type_metrics(px, label, typed, channels, keys, prefix))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, keys, "left")
    hundred = F.col("n_cells") / (F.col("_px") * F.lit(nm * nm / 1e6)) * 100
    values = [
        hundred, F.col("foreground_fraction"), 1 - F.col("background_fraction"), F.col("mask_fraction"),
        F.try_divide(F.lit(1.0), F.ln("size_std") + 1), F.col("matched_fraction"), 1 / (F.col("cv") + 1), F.col("first_pc"),
        *[F.col(m) for m in METRICS[8:]],
    ]
    named = out.select(*keys, "n_cells", *[v.alias(n) for v, n in zip(values, METRICS)])
    score = quality_score([F.col(f"`{m}`") for m in METRICS])
    return named.withColumn("QualityScore", F.when(F.col("n_cells") >= least_cells, score))
