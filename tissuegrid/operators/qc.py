"""Quality control of patches and cells as predicates built from rule tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissuegrid.operators.orderstats import quantiles


def channel_statistics(pixels: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Min, median, 95 %, max, mean and population deviation per channel.

    Equal values are counted before anything is ranked; a 16-bit channel leaves at most 65 536 rows.
    """
    long = pixels.select(*[F.col(c).cast("double").alias(c) for c in channels]).unpivot([], list(channels), "Channel", "v")
    stats = long.groupBy("Channel").agg(
        F.min("v").alias("Min"), F.max("v").alias("Max"), F.avg("v").alias("Mean"), F.stddev_pop("v").alias("Std Dev")
    )
    cuts = quantiles(long, ["Channel"], "v", {"Median": 0.5, "p95": 0.95}).withColumnRenamed("p95", "95%")
    return stats.join(cuts, "Channel").select("Channel", "Min", "Median", "Max", "95%", "Mean", "Std Dev")


def patch_statistics(pixels: DataFrame, nucleus: str, wholecell: str, keys: Sequence[str] = ("patch_id",)) -> DataFrame:
    aggs = []
    for name, c in (("nucleus", nucleus), ("wholecell", wholecell)):
        aggs += [
            F.avg(c).alias(f"{name}_mean"),
            F.stddev_pop(c).alias(f"{name}_std"),
            F.avg((F.col(c) != 0).cast("double")).alias(f"{name}_non_zero_perc"),
        ]
    return pixels.groupBy(*keys).agg(*aggs)


def flag_patches(stats: DataFrame, non_zero: float = 0.05, mean: float = 1.0) -> DataFrame:
    empty, noisy = F.col("nucleus_non_zero_perc") < non_zero, F.col("nucleus_mean") < mean
    return stats.withColumns(
        {"is_empty": empty, "is_noisy": noisy, "is_bad_patch": empty | noisy, "is_informative": ~(empty | noisy)}
    )


def informative(patches: DataFrame) -> DataFrame:
    return patches.where("is_informative")


def informative_pixels(pixels: DataFrame, patches: DataFrame, keys: Sequence[str] = ("patch_id",)) -> DataFrame:
    """Pixels of informative patches; the small patch table prunes before any heavy work."""
    return pixels.join(informative(patches).select(*keys), list(keys), "left_semi")


def normalise_flag(df: DataFrame, aliases: Sequence[str] = ("is_informative", "is_infomative")) -> DataFrame:
    """``is_informative`` as a boolean from booleans or text; without any such column everything counts."""
    found = next((a for a in aliases if a in df.columns), None)
    value = F.lit(True) if found is None else F.coalesce(F.lower(F.trim(F.col(found).cast("string"))) == "true", F.lit(False))
    return df.select(*[c for c in df.columns if c not in aliases], value.alias("is_informative"))


def rule_predicate(columns: Sequence[str], rules: Mapping[str, Mapping[str, float]]) -> Column:
    """AND of all bounds on known columns; missing values fail."""
    tests = [F.lit(True)]
    for name, bounds in rules.items():
        if name not in columns:
            continue
        if "min" in bounds:
            tests.append(F.col(name) >= bounds["min"])
        if "max" in bounds:
            tests.append(F.col(name) <= bounds["max"])
    return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))


def null_nan(df: DataFrame) -> DataFrame:
    """NaN as NULL, so comparisons fail on it the way they do in pandas."""
    kinds = dict(df.dtypes)
    return df.select(*[
        F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if kinds[c] in ("double", "float") else F.col(f"`{c}`")
        for c in df.columns
    ])


def filter_cells(metadata: DataFrame, rules: Mapping[str, Mapping[str, float]]) -> DataFrame:
    clean = null_nan(metadata)
    return clean.where(rule_predicate(clean.columns, rules))


def keep_cells(df: DataFrame, kept: DataFrame, key: str = "cell_mask_id") -> DataFrame:
    return df.join(kept.select(key), key, "left_semi")


def pass_rate(metadata: DataFrame, rules: Mapping[str, Mapping[str, float]]) -> DataFrame:
    clean = null_nan(metadata)
    return clean.agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_if(rule_predicate(clean.columns, rules)).alias("n_passed")
    ).withColumn("pass_rate", F.try_divide("n_passed", "n_cells"))


def too_few_cells(scores: DataFrame, n: str, score: str, least: int = 20) -> DataFrame:
    return scores.withColumn(score, F.when(F.col(n) >= least, F.col(score)))


def has_content(least: float = 200.0) -> Column:
    """A patch worth looking at: enough cells, nuclei or unmatched objects."""
    counts = ("cell_count", "nucleus_count", "unmatched_nuclei", "unmatched_cells")
    return F.greatest(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in counts]) >= least


def require_channels(requested: DataFrame, panel: DataFrame) -> DataFrame:
    """Requested names absent from the panel; the table is empty when all is well."""
    return requested.join(panel.select("antibody_name").distinct(), "antibody_name", "left_anti")


def channel_index(requested: DataFrame, panel: DataFrame) -> DataFrame:
    return requested.join(panel.select("antibody_name", "channel_idx"), "antibody_name")
