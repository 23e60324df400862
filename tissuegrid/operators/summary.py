"""Channel, patch and report level summaries."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tissuegrid.functions.text import channel_number
from tissuegrid.operators.orderstats import counted_values, numbered, positions, quantiles, quantiles_of, ranked_counts, ranks_of, smaller_pairs
from tissuegrid.operators.qc import has_content
from tissuegrid.runtime import cut_lineage, fanout


def channel_dropout(df: DataFrame, share: float, channels: Sequence[str], draw: Column | None = None, seed: int = 0, id_column: str = "channel_id") -> DataFrame:
    """Channels become unknown (id 0) at random and their pixels zero.

    The draw hangs on the row's own values unless one is given, so a retry repeats it.
    """
    if draw is None:
        draw = F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    lost = draw < share
    return df.withColumns(
        {id_column: F.when(lost, 0).otherwise(F.col(id_column))}
        | {c: F.when(lost, 0.0).otherwise(F.col(c)) for c in channels}
    )


# --- tables behind the reports -----------------------------------------------------------------


def marker_statistics(long: DataFrame) -> DataFrame:
    """Per marker: mean, median, sample deviation, range, threshold and positive share.

    The threshold is the median for nuclear stains, else median plus one deviation. All of it comes from one table of
    counted values.
    """
    counts = counted_values(long, ["feature"], "v").where(F.col("v").isNotNull())
    base = counts.groupBy("feature").agg(F.sum("n").alias("_n"), F.try_divide(F.sum(F.col("v") * F.col("n")), F.sum("n")).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"))
    apart = F.sum(F.col("n") * F.pow(F.col("v") - F.col("mean"), 2))
    spread = counts.join(base.select("feature", "mean"), "feature").groupBy("feature").agg(apart.alias("_squares"))
    median = quantiles_of(ranks_of(counts, ["feature"], "v"), ["feature"], "v", {"median": 0.5})
    stats = base.join(spread, "feature").join(median, "feature", "left").withColumn("std", F.when(F.col("_n") > 1, F.sqrt(F.col("_squares") / (F.col("_n") - 1))))
    nuclear = F.upper("feature").rlike("DAPI|HOECHST")
    stats = cut_lineage(stats.withColumn("positive_threshold", F.when(nuclear, F.col("median")).otherwise(F.col("median") + F.col("std"))))
    over = F.coalesce(F.sum(F.when(F.col("v") > F.col("positive_threshold"), F.col("n"))), F.lit(0)).alias("positive_cells")
    positive = counts.join(stats.select("feature", "positive_threshold"), "feature").groupBy("feature").agg(over)
    return stats.join(positive, "feature").select(
        "feature", "mean", "median", "std", "min", "max", "positive_threshold", "positive_cells",
        (F.col("positive_cells") * 100.0 / F.col("_n")).alias("positive_percentage"),
    )


def cell_report(metadata: DataFrame, area: str = "area", mpp: float | None = None) -> DataFrame:
    """Cells, mean, median and sample deviation of area, also in µm² when the pixel size is known."""
    mid = quantiles(metadata.withColumn("_a", F.col(area).cast("double")), [], "_a", {"m": 0.5}).select("m").scalar()
    out = metadata.agg(
        F.count(F.lit(1)).alias("total_cells"), F.avg(area).alias("mean_cell_area"), F.stddev_samp(area).alias("cell_area_std")
    ).withColumn("median_cell_area", mid)
    factor = F.lit(mpp * mpp if mpp and mpp > 0 else None).cast("double")
    return out.withColumns({f"{c}_um2": F.col(c) * factor for c in ("mean_cell_area", "median_cell_area")})


def patch_report(patches: DataFrame) -> DataFrame:
    """Totals over the patch table: informative, intensities, cells, match and repair shares, quality."""
    known = F.when(~F.isnan("quality_score"), F.col("quality_score"))
    return patches.agg(
        F.count(F.lit(1)).alias("total_patches"),
        F.count_if("is_informative").alias("informative_patches"),
        F.avg("nucleus_mean").alias("mean_nucleus_intensity"),
        F.avg("wholecell_mean").alias("mean_wholecell_intensity"),
        F.sum("n_cells").alias("total_cells"),
        F.avg(known).alias("mean_quality_score"),
        F.avg("matched_fraction").alias("mean_matched_fraction"),
        F.min("matched_fraction").alias("min_matched_fraction"),
        F.max("matched_fraction").alias("max_matched_fraction"),
    )


# Percentiles shown per shape measure.
SHAPE_PERCENTILES = {
    "area": (1, 5, 10, 25, 50, 75, 90, 95, 99),
    "eccentricity": (50, 75, 90, 95, 99),
    "solidity": (1, 5, 10, 25, 50),
    "aspect_ratio": (50, 75, 90, 95, 99),
}


def shape_percentiles(shapes: DataFrame) -> DataFrame:
    """(measure, mean, std, p1 .. p99) with percentiles that a measure does not show left NULL."""
    ratio = F.when(F.col("axis_minor_length") > 0, F.col("axis_major_length") / F.col("axis_minor_length"))
    ready = shapes.withColumn("aspect_ratio", ratio)
    measures = [m for m in SHAPE_PERCENTILES if m in ready.columns]
    long = ready.select(*[F.col(m).cast("double").alias(m) for m in measures]).unpivot([], measures, "measure", "v")
    cuts = sorted({p for ps in SHAPE_PERCENTILES.values() for p in ps})
    wide = quantiles(long, ["measure"], "v", {f"p{p}": p / 100 for p in cuts})
    spread = long.groupBy("measure").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    shown = {p: [m for m, ps in SHAPE_PERCENTILES.items() if p in ps] for p in cuts}
    return spread.join(wide, "measure").select(
        "measure", "mean", "std", *[F.when(F.col("measure").isin(shown[p]), F.col(f"p{p}")).alias(f"p{p}") for p in cuts]
    )


def suggested_thresholds(percentiles: DataFrame) -> DataFrame:
    """One row: area limits at p1 and p99, eccentricity at p95, solidity at p5."""
    def pick(measure: str, p: str):
        return F.max(F.when(F.col("measure") == measure, F.col(p)))

    return percentiles.agg(
        pick("area", "p1").alias("undersized"), pick("area", "p99").alias("oversized"),
        pick("eccentricity", "p95").alias("high_eccentricity"), pick("solidity", "p5").alias("low_solidity"),
    )


def score_summary(patches: DataFrame) -> DataFrame:
    """Informative and evaluated patches and their score, for the patch-mode report."""
    good = patches.where("is_informative")
    score = F.when(~F.isnan("quality_score"), F.col("quality_score"))
    mid = quantiles(good.select(score.alias("s")), [], "s", {"m": 0.5}).select("m").scalar()
    return good.agg(
        F.count(F.lit(1)).alias("informative_patches"),
        F.count(score).alias("evaluated_patches"),
        F.avg(score).alias("quality_score_mean"),
        F.stddev_pop(score).alias("quality_score_std"),
        F.min(score).alias("quality_score_min"),
        F.max(score).alias("quality_score_max"),
    ).withColumn("quality_score_median", mid).withColumn("total_patches", patches.agg(F.count(F.lit(1))).scalar())


def with_scores(patches: DataFrame, scores: DataFrame, key: str = "patch_id") -> DataFrame:
    """Scores joined by patch id; patches without one keep NULL."""
    return patches.join(scores.select(key, "quality_score"), key, "left")


def best_and_worst(patches: DataFrame, n: int = 3, key: str = "patch_id") -> DataFrame:
    """The n best and n worst informative patches by score, or by matched fraction when none has a score."""
    good = patches.where("is_informative")
    any_score = good.agg(F.count("quality_score") > 0).scalar()
    metric = F.when(any_score, F.col("quality_score")).otherwise(F.col("matched_fraction"))
    ranked = good.select(key, metric.alias("metric")).where(F.col("metric").isNotNull())
    top = ranked.orderBy(F.col("metric").desc(), key).limit(n).withColumn("side", F.lit("top"))
    bottom = ranked.orderBy("metric", key).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def quality_map(pixels: DataFrame, keys: Sequence[str], label: str = "cell_matched", mpp: float = 0.5) -> DataFrame:
    """Per patch: cells per mm² with the pixel size taken into account, and mean cell area."""
    sizes = pixels.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    cell = F.col(label) > 0
    return sizes.groupBy(*keys).agg(
        (F.count_if(cell) / (F.sum("n") * F.lit(mpp * mpp / 1e6))).alias("cell_density"),
        F.coalesce(F.avg(F.when(cell, F.col("n"))), F.lit(0.0)).alias("mean_cell_area"),
    )


def collection_summary(reports: DataFrame) -> DataFrame:
    """Totals and counts per report type in one aggregate; the total row has type NULL."""
    return reports.groupingSets([[], ["report_type"]], "report_type").agg(
        F.count(F.lit(1)).alias("n_reports"),
        F.sum("file_size").alias("total_size"),
        F.sum(F.coalesce("cell_count", F.lit(0))).alias("total_cells"),
        F.count_if(F.col("cell_count").isNull()).alias("missing_counts"),
    )


def class_weights(items: DataFrame, label: str = "label") -> DataFrame:
    """Inverse class sizes scaled so that they add up to the number of classes."""
    sizes = items.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    raw = sizes.withColumn("_w", 1.0 / (F.col("n") + 1e-6))
    total = raw.agg(F.struct(F.sum("_w").alias("w"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    return raw.select(label, "n", (F.col("_w") / total.getField("w") * total.getField("k")).alias("weight"))


def histogram(df: DataFrame, value: str, keys: Sequence[str] = (), bins: int = 50) -> DataFrame:
    """Counts in equal bins between the group's ends; the top end belongs to the last bin."""
    keys = list(keys)
    known = df.where(F.col(value).isNotNull())
    ends = known.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    if keys:
        joined = known.join(ends, keys)
    else:
        e = known.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("e")).scalar()
        joined = known.withColumn("_lo", e.getField("lo")).withColumn("_hi", e.getField("hi"))
    slot = F.coalesce(F.floor(F.try_divide((F.col(value) - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo"))), F.lit(0))
    return joined.groupBy(*keys, F.least(F.lit(bins - 1), slot).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box_statistics(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    return quantiles(df.withColumn("_v", F.col(value).cast("double")), keys, "_v", {"q25": 0.25, "median": 0.5, "q75": 0.75})


def density_curve(df: DataFrame, value: str, keys: Sequence[str], points: int = 200, log_axis: bool = False, cut: float = 3.0, fine: int = 4096) -> DataFrame:
    """Gaussian kernel density on a grid that runs ``cut`` bandwidths past the data.

    Values are first counted in ``fine`` narrow bins, so work after the scan depends on bins, not rows.
    Bandwidth: deviation · n^(−1/5).
    """
    keys = list(keys)
    v = F.ln(value) if log_axis else F.col(value).cast("double")
    ready = df.where(F.col(value) > 0) if log_axis else df.where(F.col(value).isNotNull())
    ready = ready.select(*keys, v.alias("_v"))
    shape = ready.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_samp("_v").alias("_sd"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    shape = shape.where(F.col("_sd") > 0).withColumn("_h", F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2)))
    width = (F.col("_hi") - F.col("_lo")) / fine
    slot = F.least(F.lit(fine - 1), F.floor((F.col("_v") - F.col("_lo")) / width))
    bins = ready.join(shape, keys).groupBy(*keys, slot.alias("_s"), "_n", "_h", "_lo", "_hi").agg(F.count(F.lit(1)).alias("_c"))
    # A bin is known only to the grid points within eight bandwidths, where the kernel is not yet zero.
    start, step = F.col("_lo") - cut * F.col("_h"), (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h")) / (points - 1)
    centre = F.col("_lo") + (F.col("_s") + 0.5) * width
    first = F.greatest(F.lit(0), F.ceil((centre - 8 * F.col("_h") - start) / step))
    last = F.least(F.lit(points - 1), F.floor((centre + 8 * F.col("_h") - start) / step))
    spread = bins.withColumn("i", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    at = start + F.col("i") * step
    kernel = F.exp(-F.pow((at - centre) / F.col("_h"), 2) / 2) / (F.col("_h") * F.sqrt(2 * F.pi()))
    return spread.groupBy(*keys, "i", at.alias("at")).agg((F.sum(kernel * F.col("_c")) / F.max("_n")).alias("density"))


def vocabulary(names: DataFrame, column: str = "name") -> DataFrame:
    """Distinct names with ids from 1 in name order; 0 stays free for unknown ones."""
    return numbered(names.where(F.col(column).isNotNull()).select(column).distinct(), [column], "id").withColumn("id", F.col("id").cast("int"))


def channel_ids(images: DataFrame, names: DataFrame, n_channels: str = "n_channels") -> DataFrame:
    """(image_id, ids): vocabulary ids of an image's channels in channel order, cut or padded with 0.

    ``images``: image_id, CHANNELS map<string,string>, n_channels.
    """
    parts = images.select("image_id", n_channels, F.explode("CHANNELS").alias("key", "name"))
    numbered = parts.withColumn("_i", channel_number(F.col("key"))).where(F.col("_i").isNotNull())
    coded = numbered.join(names.withColumnRenamed("id", "_id"), "name", "left")
    listed = coded.groupBy("image_id", n_channels).agg(
        F.array_sort(F.collect_list(F.struct("_i", F.coalesce("_id", F.lit(0)).alias("id")))).alias("_l")
    )
    ids = F.transform("_l", lambda e: e["id"])
    padded = F.slice(F.concat(ids, F.array_repeat(F.lit(0), F.col(n_channels))), F.lit(1), F.col(n_channels))
    return listed.select("image_id", padded.alias("ids"))


def repair_scores(patches: DataFrame) -> DataFrame:
    """Cell density and how much repair each patch needed."""
    lost = F.col("unmatched_cells") + F.col("unmatched_nuclei")
    gap = F.greatest(F.lit(0.0), 1.0 - F.col("matched_fraction")) * F.greatest("cell_count", F.lit(1))
    return patches.withColumn(
        "cell_density", F.col("cell_count") / F.greatest(F.col("patch_width") * F.col("patch_height"), F.lit(1))
    ).withColumn("repair_score", lost + F.coalesce(gap, F.lit(0.0)))


def pictures_wanted(total_pixels: int, n_patches: int, low: int = 4, high: int = 8) -> int:
    """How many patches to show of an image above a million pixels; 0 for smaller ones."""
    if total_pixels <= 1_000_000:
        return 0
    return min(max(low, min(high, math.ceil(total_pixels / (2 * 1024 * 1024)))), n_patches)


REASONS = ("high_density", "repair_hotspot", "low_density", "representative", "coverage", "all")


def representative_patches(infos: DataFrame, n: int, seed: int = 17, key: str = "patch_id", draw: Column | None = None) -> DataFrame:
    """At most n patches with the reason for each: densest, most repaired, sparsest, one by hash, then by density.

    ``infos``: key, cell_count, nucleus_count, unmatched_cells, unmatched_nuclei, repair_score. ``draw`` orders patches in
    place of the hash. Every order gives as many candidates as others could take before it, in one job; the choice is
    made among these few.
    """
    marked = infos.withColumn("_ok", has_content())
    size = marked.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("ok")).alias("s")).first()["s"]
    if n <= 0 or size["n"] <= n:
        kept = marked.where("_ok") if size["ok"] else marked
        return kept.drop("_ok").withColumn("selection_reason", F.lit("all"))
    draw = F.xxhash64(key, F.lit(seed)) if draw is None else draw
    picks = [
        ("high_density", F.col("_ok") & F.col("cell_count").isNotNull(), [F.col("cell_count").desc(), F.col(key)], 1),
        ("repair_hotspot", F.col("_ok") & F.col("repair_score").isNotNull(), [F.col("repair_score").desc(), F.col(key)], 1),
        ("low_density", F.col("_ok") & F.col("cell_count").isNotNull(), [F.col("cell_count").asc(), F.col(key)], 1),
        ("representative", F.lit(True), [F.col("_ok").desc(), draw, F.col(key)], 1),
        ("coverage", F.lit(True), [F.col("_ok").desc(), F.col("cell_count").desc(), F.col(key)], n),
    ]
    tops = None
    for reason, allowed, order, many in picks:
        best = marked.where(allowed).orderBy(*order).limit(len(picks) - 1 + many)
        best = best.withColumn("place", F.row_number().over(W.orderBy(*order))).select(F.col(key).alias("key"), F.lit(reason).alias("reason"), "place")
        tops = best if tops is None else tops.unionByName(best)
    rows, chosen = tops.collect(), {}
    for reason, _, _, many in picks:
        mine = [r["key"] for r in sorted(rows, key=lambda r: r["place"]) if r["reason"] == reason and r["key"] not in chosen]
        chosen |= {k: reason for k in mine[: min(many, n - len(chosen))]}
    why = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair])
    out = marked.where(F.col(key).isin(list(chosen))).drop("_ok").withColumn("selection_reason", F.try_element_at(why, F.col(key)))
    place = F.array_position(F.array(*[F.lit(r) for r in REASONS]), F.col("selection_reason"))
    return out.orderBy(place, key)


def channel_usage(panel: DataFrame, roles: DataFrame) -> DataFrame:
    """Which panel rows serve which role: (role, n_channels, names)."""
    used = roles.join(panel, "antibody_name", "left")
    return used.groupBy("role").agg(
        F.count(F.lit(1)).alias("n_channels"),
        F.count("channel_idx").alias("n_in_panel"),
        F.transform(F.array_sort(F.collect_list(F.struct("channel_idx", "antibody_name"))), lambda e: e["antibody_name"]).alias("names"),
    )


def stratified_split(items: DataFrame, label: str, key: str, test: float = 0.2, val: float = 0.1, seed: int = 0, stratify: bool = True, draw: Column | None = None) -> DataFrame:
    """``split`` per row with exact class shares: test = round(n · test), val = round((n − test) · val)."""
    groups = [label] if stratify else []
    drawn = items.withColumn("_h", draw if draw is not None else F.xxhash64(key, F.lit(seed)))
    placed = positions(drawn, groups, "_h", [key], "_p")
    sizes = items.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    joined = placed.join(sizes, groups) if groups else placed.withColumn("_n", sizes.scalar())
    n_test = F.rint(F.col("_n") * F.lit(test))
    n_val = F.rint((F.col("_n") - n_test) * F.lit(val))
    split = F.when(F.col("_p") <= n_test, "test").when(F.col("_p") <= n_test + n_val, "val").otherwise("train")
    return joined.withColumn("split", split).drop("_h", "_p", "_n")


# --- principal components and correlation ------------------------------------------------------


def _outer_sums(keys: Sequence[str]):
    """Task function: Σ x xᵀ of each group, one matrix per group and task, row by row."""

    def add(batches):
        sums: dict[tuple, np.ndarray] = {}

        def out():
            rows = [(*key, i, line) for key, m in sums.items() for i, line in enumerate(m)]
            sums.clear()
            return pa.Table.from_pydict({n: [r[c] for r in rows] for c, n in enumerate([*keys, "i", "sums"])}, schema=schema).to_batches()

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([*[batch.schema.field(k) for k in keys], pa.field("i", pa.int32()), pa.field("sums", pa.list_(pa.float64()))])
            if not len(batch):
                continue
            x = batch.column(len(keys)).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            named = batch.select(list(keys)).to_pandas()
            for at in named.groupby(list(keys), dropna=False, sort=False).indices.values():
                key = tuple(batch.column(i)[int(at[0])].as_py() for i in range(len(keys)))
                sums[key] = sums.get(key, 0.0) + x[at].T @ x[at]
            if len(sums) * x.shape[1] ** 2 > 1 << 22:
                yield from out()
        if sums:
            yield from out()

    return add


def principal_axes(df: DataFrame, columns: Sequence[str], n: int, keys: Sequence[str] = (), standardise: bool = False, vector: bool = False) -> DataFrame:
    """(keys, n_rows, mean, variances, shares, loadings, offsets) of each image: its first ``n`` principal components.

    ``columns`` are numbers, or one array of numbers with ``vector``; rows with a NULL or NaN, or of a NULL image, are left
    out. Tasks add up
    one matrix per image, Spark adds up their entries, and one task per image holds a matrix of the panel's size. A
    score is Σ loading · x − offset. The sign makes the first of each component's largest loadings positive.
    """
    at = list(keys) or ["_all"]
    x = F.col(columns[0]).cast("array<double>") if vector else F.array(*[F.col(c).cast("double") for c in columns])
    rows = df.select(*keys, *([] if keys else [F.lit(0).alias("_all")]), x.alias("x")).where("x IS NOT NULL AND forall(x, e -> e IS NOT NULL AND NOT isnan(e))")
    if vector:
        wide = rows.select(*at, F.posexplode("x").alias("i", "e"))
        centre = wide.groupBy(*at, "i").agg(F.avg("e").alias("e"), F.count("*").alias("n")).groupBy(*at).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "e"))), lambda p: p["e"]).alias("mean"), F.max("n").alias("n_rows"))
    else:
        centre = rows.groupBy(*at).agg(F.array(*[F.avg(F.col("x")[i]) for i in range(len(columns))]).alias("mean"), F.count("*").alias("n_rows"))
    centre = cut_lineage(centre)
    moved = rows.join(centre, at).select(*at, F.expr("zip_with(x, mean, (a, b) -> a - b)").alias("x"))
    kinds = dict(rows.dtypes)
    named = ", ".join(f"`{k}` {kinds[k]}" for k in at)
    sums = moved.mapInArrow(_outer_sums(at), f"{named}, i int, sums array<double>")
    entries = sums.select(*at, "i", F.posexplode("sums").alias("j", "s")).groupBy(*at, "i", "j").agg(F.sum("s").alias("s")).join(centre.select(*at, "n_rows"), at)

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        m, rows_in = int(group["i"].max()) + 1, int(group["n_rows"].iloc[0])
        cov = np.zeros((m, m))
        cov[group["i"], group["j"]] = group["s"] / max(rows_in - 1, 1)
        scale = np.ones(m)
        if standardise:
            pop = np.sqrt(np.diag(cov) * (rows_in - 1) / rows_in)
            scale = np.where(pop > 0, pop, 1.0)
            cov = cov / np.outer(scale, scale)
        values, axes = np.linalg.eigh(cov)
        order = np.argsort(values)[::-1][:n]
        axes = axes[:, order].T
        size = np.abs(axes)
        first = (size >= size.max(1, keepdims=True) - 1e-9).argmax(1)
        axes = axes * np.sign(axes[np.arange(len(axes)), first])[:, None]
        total = values.sum()
        out = group[at].iloc[:1].copy()
        out["variances"], out["shares"] = [values[order].tolist()], [(values[order] / total if total else values[order] * np.nan).tolist()]
        out["loadings"] = [[(a / scale).tolist() for a in axes]]
        return out

    solved = entries.groupBy(*at).applyInPandas(solve, f"{named}, variances array<double>, shares array<double>, loadings array<array<double>>")
    offsets = F.expr("transform(loadings, l -> aggregate(zip_with(l, mean, (a, b) -> a * b), CAST(0 AS DOUBLE), (s, e) -> s + e))")
    return solved.join(centre, at).withColumn("offsets", offsets).drop("_all")


def project(df: DataFrame, columns: Sequence[str], axes: DataFrame, keys: Sequence[str] = (), vector: bool = False) -> DataFrame:
    """``df`` with ``pcs``, the scores of each row on the axes of its image."""
    x = F.col(columns[0]).cast("array<double>") if vector else F.array(*[F.col(c).cast("double") for c in columns])
    fields = F.struct(F.col("loadings").alias("l"), F.col("offsets").alias("o"))
    if keys:
        placed = df.join(axes.select(*keys, fields.alias("_axes")), list(keys), "left")
    else:
        placed = df.withColumn("_axes", axes.select(fields.alias("f")).scalar())
    score = "transform(_axes.l, (l, i) -> aggregate(zip_with(l, _x, (a, b) -> a * b), CAST(0 AS DOUBLE), (s, e) -> s + e) - _axes.o[i])"
    return placed.withColumn("_x", x).withColumn("pcs", F.expr(score)).drop("_axes", "_x")


def principal_components(df: DataFrame, columns: Sequence[str], n: int, standardise: bool = False, fit_on: DataFrame | None = None):
    """(rows with pc1..pcn, explained shares)."""
    axes = cut_lineage(principal_axes(df if fit_on is None else fit_on, columns, n, standardise=standardise))
    row = axes.first()
    shares = list(row["shares"]) if row else []
    out = project(df, columns, axes)
    return out.withColumns({f"pc{k + 1}": F.col("pcs")[k] for k in range(min(n, len(columns)))}).drop("pcs"), shares


def vector_components(df: DataFrame, vector: str, n: int) -> tuple[DataFrame, DataFrame]:
    """(rows with ``pcs``, axes): centred principal components of a vector column."""
    axes = cut_lineage(principal_axes(df, [vector], n, vector=True))
    return project(df, [vector], axes, vector=True), axes


def illumination_check(pixels: DataFrame, channels: Sequence[str], n: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, PC, rho_y, rho_x): components fitted and scored on every pixel of an image, against position."""
    axes = cut_lineage(principal_axes(pixels, channels, n, keys, standardise=True))
    scored = project(pixels, channels, axes, keys)
    cols = [F.struct(F.lit(k + 1).alias("PC"), F.corr(F.col("pcs")[k], F.col("y").cast("double")).alias("rho_y"), F.corr(F.col("pcs")[k], F.col("x").cast("double")).alias("rho_x")) for k in range(min(n, len(channels)))]
    return scored.groupBy(*keys).agg(F.array(*cols).alias("_r")).select(*keys, F.explode("_r").alias("r")).select(*keys, "r.*")


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for every pair of markers."""
    # Both directions name the same aggregate, so each pair is worked out once.
    r = {(i, j): F.corr(a, b) for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j}
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r[min(i, j), max(i, j)].alias("r")) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.agg(F.array(*pairs).alias("_r")).select(F.explode("_r").alias("e")).select("e.*")


def spearman(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """Pearson of tie-averaged ranks. Only the different values of a marker are ranked; rows look their ranks up.

    Every row counts, whatever its ``key``; a value that fills the table is one row of the ranking.
    """
    wide = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    counts = counted_values(wide.unpivot([], list(columns), "feature", "v"), ["feature"], "v")
    place = F.col("below") + (F.col("ties") + 1) / F.lit(2.0)
    ranked = cut_lineage(ranks_of(counts, ["feature"], "v").select("feature", "v", place.alias("place")))
    for c in columns:
        own = ranked.where(F.col("feature") == c).select(F.col("v").alias(c), F.col("place").alias("_place"))
        wide = wide.join(own, c, "left").drop(c).withColumnRenamed("_place", c)
    return pearson(wide, columns)


def kendall(df: DataFrame, a: str, b: str, pieces: int | None = None) -> DataFrame:
    """One row (a, b, tau): Kendall τ-b over all rows where both are known, without forming pairs of rows.

    Tau is NULL if an axis has fewer than two different values.
    """
    rows = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).where("a IS NOT NULL AND NOT isnan(a)")
    counts = cut_lineage(ranked_counts(rows, [], "b", ["a"], pieces).select("a", "b", "n", "below", "total"))
    total = counts.agg(F.max("total")).first()[0] or 0

    def tied(*keys: str):
        per = counts.groupBy(*keys).agg(F.sum("n").cast("double").alias("t"))
        return F.coalesce(per.agg(F.sum(F.col("t") * (F.col("t") - 1) / 2).alias("ties")).scalar(), F.lit(0.0))

    pairs = F.lit(total * (total - 1) / 2)
    concordant = smaller_pairs(counts, "a", "below", "n", total, pieces).scalar()
    parts = counts.groupBy().agg(F.first(F.lit(1))).select(tied("a").alias("ta"), tied("b").alias("tb"), tied("a", "b").alias("tab"), concordant.alias("up"))
    down = pairs - F.col("ta") - F.col("tb") + F.col("tab") - F.col("up")
    base = F.sqrt((pairs - F.col("ta")) * (pairs - F.col("tb")))
    return parts.select(F.lit(a).alias("a"), F.lit(b).alias("b"), F.try_divide(F.col("up") - down, base).alias("tau"))


def metric_pair_bins(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """(a, b, bin_a, bin_b, n): two-dimensional bins of every metric pair."""
    ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]).first()

    def slot(c: str) -> Column:
        lo, hi = ends[c]["lo"], ends[c]["hi"]
        width = (hi - lo) / bins if hi is not None and hi > lo else None
        return F.coalesce(F.least(F.lit(bins - 1), F.floor((F.col(c) - F.lit(lo)) / F.lit(width).cast("double"))), F.lit(0)).cast("int")

    coded = df.select(*[slot(c).alias(c) for c in columns])
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("bin_a"), F.col(b).alias("bin_b"))
        for i, a in enumerate(columns) for b in columns[i + 1 :]
    ]
    return coded.select(F.explode(F.array(*pairs)).alias("e")).groupBy("e.a", "e.b", "e.bin_a", "e.bin_b").agg(F.count(F.lit(1)).alias("n"))


def label_lookup(pixels: DataFrame, values: DataFrame, label: str = "cell_label", value: str = "value", default=0.0) -> DataFrame:
    """Per-pixel value of its cell, by label; background and unknown cells get the default."""
    known = pixels.where(F.col(label) > 0).join(values.select(F.col("label").alias(label), value), label, "left")
    back = pixels.where(F.col(label) <= 0).withColumn(value, F.lit(None).cast(values.schema[value].dataType))
    return known.unionByName(back).withColumn(value, F.coalesce(F.col(value), F.lit(default)))
