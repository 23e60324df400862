"""Pairing cells with nuclei, trimming nuclei to their cell and counting what was matched."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tissuegrid.operators import raster
from tissuegrid.operators.components import connected_nodes, connected_pixels
from tissuegrid.operators.orderstats import positions
from tissuegrid.runtime import cut_lineage

#: Rounds before the pairs left are split into components, pairs that one task walks, and rounds whose results are joined.
ROUNDS, WALK, FOLD = 3, 200_000, 16


def overlaps(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shared pixels of every touching cell and nucleus; only real pairs ever exist."""
    both = (F.col("cell_label") > 0) & (F.col("nucleus_label") > 0)
    return (
        pixels.where(both)
        .groupBy(*keys, F.col("cell_label").alias("cell"), F.col("nucleus_label").alias("nucleus"))
        .agg(F.count(F.lit(1)).alias("n_overlap"))
    )


def mismatches(bounded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of each nucleus outside the interior of each cell it touches.

    ``bounded`` has the ``boundary`` column of the cell raster, so boundary pixels go by their own label.
    """
    # One pass over the pixels: nucleus pixels on background form a pair with cell 0 here.
    shared = (
        bounded.where(F.col("nucleus_label") > 0)
        .groupBy(*keys, F.col("cell_label").alias("cell"), F.col("nucleus_label").alias("nucleus"))
        .agg(F.count(F.lit(1)).alias("n_overlap"), F.count_if(F.col("boundary") == 0).alias("n_inside"))
    )
    totals = shared.groupBy(*keys, "nucleus").agg(F.sum("n_overlap").alias("n_nucleus"))
    return shared.where("cell > 0").join(totals, [*keys, "nucleus"]).select(
        *keys, "cell", "nucleus", "n_overlap", "n_inside", "n_nucleus",
        ((F.col("n_nucleus") - F.col("n_inside")) / F.col("n_nucleus")).alias("mismatch"),
    )


def _settle(open_pairs: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(final pairs, pairs still open) after one round: a cell's best nucleus is its own if no earlier cell can ask for it."""
    ck, nk = [*keys, "cell"], [*keys, "nucleus"]
    best = open_pairs.groupBy(*ck).agg(F.min(F.struct("mismatch", "nucleus")).alias("b"))
    best = best.select(*ck, F.col("b.nucleus").alias("nucleus"), F.col("b.mismatch").alias("mismatch"))
    first = open_pairs.groupBy(*nk).agg(F.min("cell").alias("cell"))
    final = cut_lineage(best.join(first, [*keys, "cell", "nucleus"]))
    rest = open_pairs.join(final.select(*ck), ck, "left_anti").join(final.select(*nk), nk, "left_anti")
    return final, cut_lineage(rest)


def _walk_components(open_pairs: DataFrame, keys: list[str], walk: int) -> tuple[DataFrame, DataFrame]:
    """(final pairs, pairs still open): components of at most ``walk`` pairs are walked cell by cell inside tasks.

    Components share no nucleus, so a task may walk any number of them; it gets about ``walk`` pairs.
    """
    edges = open_pairs.select(*keys, (F.col("cell") * 2).alias("a"), (F.col("nucleus") * 2 + 1).alias("b"))
    parts = connected_nodes(edges, keys).withColumnRenamed("node", "_node")
    placed = cut_lineage(open_pairs.withColumn("_node", F.col("cell") * 2).join(parts, [*keys, "_node"]).drop("_node"))
    sizes = placed.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("_n"))
    sized = cut_lineage(placed.join(sizes, [*keys, "component"]))
    small = sized.where(F.col("_n") <= walk)
    bundles = max(1, -(-small.count() // walk))
    dealt = small.select(*keys, "cell", "nucleus", "mismatch", F.pmod(F.xxhash64("component"), F.lit(bundles)).alias("_b"))

    def one_by_one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["cell", "mismatch", "nucleus"], ignore_index=True)
        served, taken, picked = set(), set(), []
        for i, (cell, nucleus) in enumerate(zip(rows["cell"].tolist(), rows["nucleus"].tolist())):
            if cell not in served and nucleus not in taken:
                served.add(cell)
                taken.add(nucleus)
                picked.append(i)
        return rows.loc[picked].drop(columns="_b")

    shape = T.StructType([f for f in dealt.schema.fields if f.name != "_b"])
    final = cut_lineage(dealt.groupBy(*keys, "_b").applyInPandas(one_by_one, shape))
    return final, cut_lineage(sized.where(F.col("_n") > walk).select(*keys, "cell", "nucleus", "mismatch"))


def assign(pairs: DataFrame, keys: Sequence[str], walk: int = WALK) -> DataFrame:
    """One-to-one pairs: cells in label order take the free nucleus of least mismatch.

    Equal mismatch goes to the smaller nucleus label; a mismatch of one is no candidate. The first rounds settle
    pairs that no earlier cell can contest. What is left falls into components, each walked in a task, so that the
    number of jobs does not hang on the length of a chain of contested nuclei. Only components of more than
    ``walk`` pairs go on in rounds; every round settles at least one pair of each.
    """
    keys = list(keys)
    open_pairs = cut_lineage(pairs.where("mismatch < 1").select(*keys, "cell", "nucleus", "mismatch"))
    settled, rounds = [], 0
    while True:
        final, open_pairs = _settle(open_pairs, keys)
        settled.append(final)
        rounds += 1
        if open_pairs.isEmpty():
            break
        if rounds == ROUNDS:
            final, open_pairs = _walk_components(open_pairs, keys, walk)
            settled.append(final)
            if open_pairs.isEmpty():
                break
        if rounds % FOLD == 0:  # few tables to read in the end
            settled = [cut_lineage(reduce(DataFrame.unionByName, settled))]
    return reduce(DataFrame.unionByName, settled).withColumn("repaired", F.col("mismatch") > 0)


def numbered(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New labels 1..n in the order of the old cell labels; old labels stay for look-ups."""
    return positions(matches, keys, "cell", name="new_label")


def apply_matches(bounded: DataFrame, matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pixels with cell_matched, nucleus_matched and cell_outside under the new labels.

    Background never enters the join, so it cannot pile up on one key.
    """
    keys = list(keys)
    lookup = matches.select(*keys, F.col("cell").alias("cell_label"), F.col("nucleus").alias("_n"), "new_label")
    labelled = bounded.where(F.col("cell_label") > 0).join(lookup, [*keys, "cell_label"], "left")
    inside = (F.col("nucleus_label") == F.col("_n")) & (F.col("boundary") == 0)
    cell = F.coalesce("new_label", F.lit(0))
    nucleus = F.when(inside, F.col("new_label")).otherwise(F.lit(0))
    kept = [c for c in bounded.columns]
    on = labelled.select(
        *kept, cell.alias("cell_matched"), nucleus.alias("nucleus_matched"), (cell - nucleus).alias("cell_outside")
    )
    zero = F.lit(0).cast("long")
    off = bounded.where(F.col("cell_label") <= 0).select(
        *kept, zero.alias("cell_matched"), zero.alias("nucleus_matched"), zero.alias("cell_outside")
    )
    return on.unionByName(off)


def repair(pixels: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(pixels with matched labels, match table) from raw cell and nucleus labels.

    Both come back as stored stage tables, since every later step reads them several times.
    """
    bounded = raster.inner_boundary(pixels, "cell_label", keys)
    matches = cut_lineage(numbered(assign(mismatches(bounded, keys), keys), keys))
    return cut_lineage(apply_matches(bounded, matches, keys)), matches


def unmatched(pixels: DataFrame, matches: DataFrame, keys: Sequence[str], kind: str = "nucleus") -> DataFrame:
    """Labels of the original raster that found no partner."""
    keys = list(keys)
    label = f"{kind}_label"
    all_labels = pixels.where(F.col(label) > 0).select(*keys, F.col(label).alias(kind)).distinct()
    return all_labels.join(matches.select(*keys, kind), [*keys, kind], "left_anti")


def label_counts(pixels: DataFrame, labels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Number of different labels above zero in each raster, one column per raster."""
    keys = list(keys)
    parts = F.array(*[F.struct(F.lit(c).alias("mask"), F.col(c).cast("bigint").alias("label")) for c in labels])
    found = pixels.select(*keys, F.explode(parts).alias("e")).select(*keys, "e.mask", "e.label").where("label > 0").distinct()
    return found.groupBy(*keys).agg(*[F.count_if(F.col("mask") == c).alias(c) for c in labels])


def matching_statistics(repaired: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total, matched and unmatched cells and nuclei, as counts and percentages."""
    n = label_counts(repaired, ["cell_label", "nucleus_label", "cell_matched", "nucleus_matched"], keys)
    out = [F.col(k) for k in keys]
    for kind, name in (("cell", "whole_cell"), ("nucleus", "nucleus")):
        total, matched = F.col(f"{kind}_label"), F.col(f"{kind}_matched")
        percent = F.coalesce(F.try_divide(matched * 100.0, total), F.lit(0.0))
        lost = F.coalesce(F.try_divide((total - matched) * 100.0, total), F.lit(0.0))
        out += [
            total.alias(f"{name}_total"),
            matched.alias(f"{name}_matched"),
            (total - matched).alias(f"{name}_unmatched"),
            percent.alias(f"{name}_matched_percent"),
            lost.alias(f"{name}_unmatched_percent"),
        ]
    return n.select(*out)


def matched_fractions(repaired: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both definitions: over the union of values with background counted, and over original cells."""
    keys = list(keys)
    masks = ["cell_label", "nucleus_label", "cell_matched"]
    parts = F.array(*[F.struct(F.lit(c).alias("mask"), F.col(c).cast("bigint").alias("label")) for c in masks])
    seen = repaired.select(*keys, F.explode(parts).alias("e")).select(*keys, "e.mask", "e.label").distinct()
    n = seen.groupBy(*keys).agg(
        *[F.count_if(F.col("mask") == c).alias(c) for c in masks],
        F.count_if((F.col("mask") == "cell_matched") & (F.col("label") > 0)).alias("_m"),
        F.count_if((F.col("mask") == "cell_label") & (F.col("label") > 0)).alias("_c"),
    )
    m, c, u = F.col("cell_matched"), F.col("cell_label"), F.col("nucleus_label")
    return n.select(
        *keys,
        (m / ((c - m) + (u - m) + m)).alias("matched_fraction"),
        F.coalesce(F.try_divide("_m", "_c"), F.lit(0.0)).alias("matched_cell_share"),
        F.lit(1.0).alias("repaired_fraction"),
    )


def unmatched_objects(pixels: DataFrame, matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Connected groups of unmatched nucleus pixels: (keys, y, x, nucleus_unmatched)."""
    lost = unmatched(pixels, matches, keys).withColumnRenamed("nucleus", "nucleus_label")
    mask = pixels.join(lost, [*keys, "nucleus_label"], "left_semi").select(*keys, "y", "x")
    # Ids start at one so that 0 stays background.
    return connected_pixels(mask, keys).select(*keys, "y", "x", (F.col("component") + 1).alias("nucleus_unmatched"))
