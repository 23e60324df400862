"""Connected components of graphs and of masks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tissuegrid.operators.raster import TILE
from tissuegrid.runtime import cut_lineage


#: Edges that are joined inside one task.
SMALL = 1 << 18


def _joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node that each of the nodes 0..n-1 is joined to by the edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _few_nodes(edges: DataFrame, keys: list[str]) -> DataFrame:
    """``connected_nodes`` of a bounded number of edges, in one task."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        ends = [pdf[[*keys, c]].rename(columns={c: "node"}) for c in ("lo", "hi")]
        nodes = pd.concat(ends).drop_duplicates().sort_values([*keys, "node"], ignore_index=True)
        both = pd.concat([nodes, *ends], ignore_index=True)
        code = both.groupby([*keys, "node"], dropna=False, sort=False).ngroup().to_numpy()[len(nodes):]  # numbers follow the sorted nodes
        root = _joined(code[: len(pdf)], code[len(pdf):], len(nodes))
        return nodes.assign(component=nodes["node"].to_numpy()[root])

    kinds = dict(edges.dtypes)
    shape = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"node {kinds['lo']}", f"component {kinds['lo']}"])
    return edges.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(join, shape)


def _looked_up(step: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, node, component) of the nodes that ``step`` handed on; one that lost all its edges names itself."""
    ends = found.select(*keys, F.col("node").alias("p"), "component")
    return step.join(ends, [*keys, "p"], "left").select(*keys, F.col("u").alias("node"), F.coalesce("component", "p").alias("component"))


def connected_nodes(edges: DataFrame, keys: Sequence[str] = (), max_rounds: int = 60, small: int = SMALL) -> DataFrame:
    """(keys, node, component) for nodes of an (a, b) edge table; the smallest node names a component.

    In a round every node is replaced by the first among itself and its neighbours, and edges that became loops or
    repeat others are dropped, so that later rounds see a graph that shrinks by half or more. The first round goes by the
    names, so the smallest node of a component stays; later ones go by a hash, which leaves no long ways down. Up to
    ``small`` edges are joined inside one task. The rounds are then looked up backwards.
    """
    keys = list(keys)
    current = cut_lineage(edges.select(*keys, F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo <> hi").distinct())
    steps: list[DataFrame] = []
    while current.count() > small:
        if len(steps) == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        both = current.select(*keys, F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            current.select(*keys, F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        if steps:
            place = [F.struct(F.xxhash64(c, F.lit(len(steps))).alias("h"), F.col(c).alias("n")) for c in ("u", "v")]
            first = both.groupBy(*keys, "u").agg(F.min(place[1]).alias("m")).select(*keys, "u", F.least(place[0], "m")["n"].alias("p"))
        else:
            first = both.groupBy(*keys, "u").agg(F.min("v").alias("m")).select(*keys, "u", F.least("u", "m").alias("p"))
        steps.append(cut_lineage(first))
        low, high = [steps[-1].select(*keys, F.col("u").alias(end), F.col("p").alias(to)) for end, to in (("lo", "a"), ("hi", "b"))]
        moved = current.join(low, [*keys, "lo"]).join(high, [*keys, "hi"]).where("a <> b")
        current = cut_lineage(moved.select(*keys, F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    found = _few_nodes(current, keys)
    for step in reversed(steps[1:]):
        found = _looked_up(step, found, keys)
    if len(steps) > 1:
        smallest = found.groupBy(*keys, "component").agg(F.min("node").alias("m"))
        found = found.join(smallest, [*keys, "component"]).select(*keys, "node", F.col("m").alias("component"))
    return _looked_up(steps[0], found, keys) if steps else found


def _label_tile(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of the first pixel of the 4-connected group each pixel belongs to."""
    y0, x0 = y.min(), x.min()
    grid = np.full((y.max() - y0 + 1, x.max() - x0 + 1), -1, dtype=np.int64)
    grid[y - y0, x - x0] = np.arange(len(y))
    pairs = []
    for first, second in ((grid[:, :-1], grid[:, 1:]), (grid[:-1], grid[1:])):
        on = (first >= 0) & (second >= 0)
        pairs.append(np.stack([first[on], second[on]]))
    a, b = np.concatenate(pairs, axis=1)
    return _joined(a, b, len(y))


def connected_pixels(mask: DataFrame, keys: Sequence[str], tile: int = TILE) -> DataFrame:
    """4-connected groups of the mask's pixels (keys, y, x) → ``component`` id, unique within the keys.

    Tiles are labelled on their own; only pixels on tile seams enter the graph step.
    """
    keys = list(keys)
    code = F.shiftleft(F.col("y").cast("bigint"), 32) + F.col("x")
    tiled = mask.select(
        *keys, "y", "x", code.alias("_code"),
        F.floor(F.col("y") / tile).cast("int").alias("_ty"),
        F.floor(F.col("x") / tile).cast("int").alias("_tx"),
    )

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_code", ignore_index=True)
        root = _label_tile(pdf["y"].to_numpy(), pdf["x"].to_numpy())
        return pdf.assign(local=pdf["_code"].to_numpy()[root])

    schema = T.StructType([*tiled.schema.fields, T.StructField("local", T.LongType())])
    labelled = cut_lineage(tiled.groupBy(*keys, "_ty", "_tx").applyInPandas(local, schema))
    near = labelled.where((F.pmod("y", F.lit(tile)) == 0) | (F.pmod("x", F.lit(tile)) == 0))
    far = labelled.where((F.pmod("y", F.lit(tile)) == tile - 1) | (F.pmod("x", F.lit(tile)) == tile - 1))

    def seam(dy: int, dx: int) -> DataFrame:
        first = far.select(*keys, (F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x"), F.col("local").alias("a"))
        return first.join(near.select(*keys, "y", "x", F.col("local").alias("b")), [*keys, "y", "x"]).where("a <> b").select(*keys, "a", "b")

    edges = seam(1, 0).unionByName(seam(0, 1)).distinct()
    joined = connected_nodes(edges, keys).withColumnRenamed("node", "local")
    return labelled.join(joined, [*keys, "local"], "left").select(
        *keys, "y", "x", F.coalesce("component", "local").alias("component")
    )
