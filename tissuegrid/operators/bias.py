"""How repair shifts marker intensity: object means before and after, matched against unmatched."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuegrid.operators.orderstats import quantiles
from tissuegrid.runtime import cut_lineage

# Mask pairs compared by the report: name → (original column, repaired column).
PAIRS = {"cell": ("cell_label", "cell_matched"), "nucleus": ("nucleus_label", "nucleus_matched")}


def object_means_long(pixels: DataFrame, masks: Mapping[str, str], channels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, mask, label, channel, v): mean per object and channel of each mask.

    Channels are averaged side by side in one aggregate and turned long only afterwards.
    """
    parts = [F.struct(F.lit(m).alias("mask"), F.col(c).cast("bigint").alias("label")) for m, c in masks.items()]
    rows = pixels.select(*keys, *channels, F.explode(F.array(*parts)).alias("_m")).where("_m.label > 0")
    means = rows.groupBy(*keys, F.col("_m.mask").alias("mask"), F.col("_m.label").alias("label")).agg(
        *[F.avg(c).cast("double").alias(c) for c in channels]
    )
    return means.unpivot([*keys, "mask", "label"], list(channels), "channel", "v")


def intensity_statistics(means: DataFrame, group: Sequence[str], extremes: bool = False) -> DataFrame:
    """Mean, median and population deviation of object means, with min, max and count if asked."""
    aggs = [F.avg("v").alias("mean"), F.stddev_pop("v").alias("std")]
    if extremes:
        aggs += [F.min("v").alias("min"), F.max("v").alias("max"), F.count("v").alias("count")]
    return means.groupBy(*group).agg(*aggs).join(quantiles(means, group, "v", {"median": 0.5}), list(group))


def percent_change(new, old, near_zero: bool = False):
    """Change in percent; 0 where the old value gives no base."""
    usable = (F.abs(old) > 1e-8) if near_zero else (old > 0)
    return F.coalesce(F.when(usable, (new - old) / old * 100), F.lit(0.0))


def repair_bias(stats: DataFrame, group: Sequence[str], near_zero: bool = False) -> DataFrame:
    """Percent and absolute change of the mean, per compartment of PAIRS.

    ``stats`` has masks named ``{kind}_original`` and ``{kind}_repaired``.
    """
    group = list(group)
    names = [f"{k}_{s}" for k in PAIRS for s in ("original", "repaired")]
    wide = stats.groupBy(*group).pivot("mask", names).agg(F.first("mean"))
    out = []
    for kind in PAIRS:
        old, new = (F.coalesce(F.col(f"{kind}_{s}"), F.lit(0.0)) for s in ("original", "repaired"))
        out += [percent_change(new, old, near_zero).alias(f"{kind}_percent_change"), (new - old).alias(f"{kind}_absolute_change")]
    return wide.select(*group, *out)


def pair_masks() -> dict[str, str]:
    return {f"{k}_{s}": c for k, cols in PAIRS.items() for s, c in zip(("original", "repaired"), cols)}


def bias_by_channel(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per (keys, channel): statistics of the four masks and the changes between them."""
    group = [*keys, "channel"]
    means = cut_lineage(object_means_long(pixels, pair_masks(), channels, keys))
    stats = intensity_statistics(means, [*group, "mask"])
    names = list(pair_masks())
    wide = stats.groupBy(*group).pivot("mask", names).agg(
        F.first("mean").alias("mean"), F.first("median").alias("median"), F.first("std").alias("std")
    )
    filled = wide.select(*group, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in wide.columns if c not in group])
    return filled.join(repair_bias(stats, group), group)


def significant_bias(bias: DataFrame, threshold: float = 5.0) -> DataFrame:
    return bias.where((F.abs("cell_percent_change") > threshold) | (F.abs("nucleus_percent_change") > threshold))


def matched_and_unmatched(pixels: DataFrame, matches: DataFrame, channels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Object means by group: matched_nuclei, unmatched_nuclei, all_nuclei, matched_cells, unmatched_cells."""
    keys = list(keys)
    means = object_means_long(pixels, {"cells": "cell_label", "nuclei": "nucleus_label"}, channels, keys)
    hit = matches.select(*keys, F.explode(F.array(
        F.struct(F.lit("cells").alias("mask"), F.col("cell").alias("label")),
        F.struct(F.lit("nuclei").alias("mask"), F.col("nucleus").alias("label")),
    )).alias("e")).select(*keys, "e.mask", "e.label", F.lit(True).alias("_hit"))
    tagged = means.join(hit, [*keys, "mask", "label"], "left")
    group = F.concat(F.when(F.col("_hit"), "matched_").otherwise("unmatched_"), F.col("mask"))
    groups = F.when(F.col("mask") == "nuclei", F.array(group, F.lit("all_nuclei"))).otherwise(F.array(group))
    return tagged.select(*keys, "channel", "label", "v", F.explode(groups).alias("group"))


def background_sample(pixels: DataFrame, channels: Sequence[str], keys: Sequence[str], share: float = 1.0, seed: int = 0) -> DataFrame:
    """Pixels where no nucleus lies: all of them, or a share drawn by position hash."""
    bare = pixels.where(F.col("nucleus_label") == 0).select(*keys, "y", "x", *channels)
    if share >= 1:
        return bare
    return bare.where(F.pmod(F.xxhash64(*keys, "y", "x", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
