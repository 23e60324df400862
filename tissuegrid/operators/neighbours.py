"""Exact nearest neighbours and the weighted graph built on them.

Vectors are dealt down a tree of pivots until a leaf holds about a block of them, so that the number of leaves grows with
the rows. A leaf finds the neighbours among its own vectors first; another leaf can only matter if it lies nearer than the
farthest of those (triangle inequality). Leaves that lie together ask as one bundle, and the leaves that a bundle has to
ask are found by walking down the tree. Only then are vectors sent, once per bundle whatever the size of a leaf: a leaf
that is asked sends one byte per component with an error bound per vector, the asking leaves stay whole. Pairs that the
bounds leave open are settled on the full vectors, so results are exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tissuegrid.runtime import cut_lineage

#: Children of a tree node, levels after which leaves are cut by a hash.
FAN, MOST_LEVELS = 256, 12
#: Vectors of a group when a node is split, of a bundle of asking leaves, and of the leaves it asks in one task.
DEAL, ASKING, ASKED = 8192, 8192, 131_072
#: Rows of a distance matrix held at once, vectors that asked leaves are put together to.
STRIP, WIDE = 512, 1024


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """Rows scaled to length one; a zero row stays zero."""
    norm = "sqrt(aggregate(v, CAST(0 AS DOUBLE), (s, x) -> s + x * x))"
    return vectors.withColumn("v", F.expr(f"transform(v, x -> coalesce(try_divide(x, {norm}), CAST(0 AS DOUBLE)))"))


def sound_vectors(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a vector without NULL, NaN or infinite components."""
    sound = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    return vectors.where(f"id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND {sound}")


def _rows(column) -> np.ndarray:
    """A list column as a matrix."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(sq, 0))


def _slack(a: np.ndarray, b: np.ndarray) -> float:
    """More than the products of ``_distances`` can be off by."""
    return 1e-6 * (1 + np.abs(a).max(initial=0) + np.abs(b).max(initial=0))


def _directly(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(1))


def _nearest_inside(v: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest others of each row, missing ones as -1 and inf; near ties are settled directly."""
    n, keep = len(v), min(k, len(v) - 1)
    near, far = np.full((n, k), -1, dtype=np.int64), np.full((n, k), np.inf)
    for first in range(0, n if keep else 0, STRIP):
        part = v[first: first + STRIP]
        d = _distances(part, v)
        d[np.arange(len(part)), np.arange(first, first + len(part))] = np.inf
        limit = np.partition(d, keep - 1, axis=1)[:, keep - 1]
        rows, cols = np.nonzero((d <= (limit + _slack(part, v))[:, None]) & np.isfinite(d))
        exact = _directly(part[rows], v[cols])
        order = np.lexsort((ids[cols], exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        best = place < k
        near[first + rows[best], place[best]] = ids[cols[best]]
        far[first + rows[best], place[best]] = exact[best]
    return near, far


def _best(candidates: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("src").orderBy("dist", "dst")
    return candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# --- the tree --------------------------------------------------------------------------------------


def _leaves(points: DataFrame, block: int, fan: int) -> DataFrame:
    """(id, v, node): every vector with the leaf it fell into; a leaf holds at most twice ``block`` of them.

    Nodes that hold more are split by pivots picked by a hash: each vector goes to the nearest. The name of a node is the
    way to it. Pivots of a node are one row of at most ``fan`` vectors.
    """
    placed = points.select("id", "v", F.lit("").alias("node"))
    for level in range(MOST_LEVELS + 1):
        sizes = placed.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > 2 * block)
        if sizes.isEmpty():
            return placed
        if level == MOST_LEVELS:
            part = F.pmod(F.xxhash64("id", F.lit(17)), F.ceil(F.col("n") / block)).cast("string")
            cut = placed.join(sizes, "node", "left")
            return cut.select("id", "v", F.when(F.col("n").isNull(), F.col("node")).otherwise(F.concat_ws(".", "node", part)).alias("node"))
        crowd = placed.join(sizes, "node").withColumn("place", F.row_number().over(W.partitionBy("node").orderBy(F.xxhash64("id", F.lit(11 + level)), "id")))
        picked = crowd.where(F.col("place") <= fan).where(F.col("place") <= F.ceil(F.col("n") / block)).groupBy("node")
        pivots = picked.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda e: e["v"])).alias("pivots"))

        parts = F.ceil(F.col("n") / DEAL).cast("int")
        dealt = crowd.select("id", "v", "node", F.pmod(F.xxhash64("id", F.lit(31)), parts).cast("int").alias("part"))
        copies = pivots.join(sizes, "node").select(F.col("node").alias("of"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("to"), "pivots")

        def fall(rows: pa.Table, split: pa.Table) -> pa.Table:
            v, name = _rows(rows.column("v")), rows.column("node")[0].as_py()
            at = np.asarray(split.column("pivots")[0].values).reshape(-1, v.shape[1])
            nearest = np.concatenate([_distances(v[i: i + STRIP], at).argmin(1) for i in range(0, len(v), STRIP)])
            return pa.table({"id": rows.column("id"), "v": rows.column("v"), "node": pa.array([f"{name}.{j}" for j in nearest], pa.string())})

        fallen = dealt.groupBy("node", "part").cogroup(copies.groupBy("of", "to")).applyInArrow(fall, "id long, v array<double>, node string")
        placed = cut_lineage(placed.join(sizes, "node", "left_anti").select("id", "v", "node").unionByName(fallen))
    return placed


PACK = "node string, n long, centre array<double>, radius double, reach double, whole binary, brief binary, home binary"


def _pack(k: int):
    def pack(table: pa.Table) -> pa.Table:
        ids, v = table.column("id").to_numpy(), _rows(table.column("v"))
        centre = v.mean(0)
        near, far = _nearest_inside(v, ids, k)
        scale = np.abs(v).max(1) / 127
        scale[scale == 0] = 1.0
        code = np.rint(v / scale[:, None]).astype(np.int8)
        error = np.sqrt(((v - code * scale[:, None]) ** 2).sum(1)) * (1 + 1e-9)
        whole = ids.tobytes() + far[:, -1].tobytes() + v.tobytes()
        brief = ids.tobytes() + scale.tobytes() + error.tobytes() + code.tobytes()
        row = [table.column("node")[0].as_py(), len(ids), centre.tolist(), float(_distances(v, centre[None]).max() + _slack(v, v)), float(far[:, -1].max())]
        names = [part.split()[0] for part in PACK.split(", ")]
        types = [pa.string(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.float64(), *[pa.binary()] * 3]
        return pa.table([pa.array([x], t) for x, t in zip([*row, whole, brief, near.tobytes() + far.tobytes()], types)], names=names)

    return pack


def _home(k: int):
    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                ids = np.frombuffer(row["whole"], dtype=np.int64, count=n)
                near = np.frombuffer(row["home"], dtype=np.int64, count=n * k)
                far = np.frombuffer(row["home"], dtype=np.float64, offset=8 * n * k)
                there = np.isfinite(far)
                yield pa.record_batch([pa.array(np.repeat(ids, k)[there]), pa.array(near[there]), pa.array(far[there])], ["src", "dst", "dist"])

    return unpack


def _apart(a: str, b: str) -> str:
    return f"sqrt(aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), CAST(0 AS DOUBLE), (s, x) -> s + x))"


def _tree(leaves: DataFrame) -> tuple[DataFrame, int]:
    """(parent, node, depth, centre, radius, leaf) of every node under the root, and the depth of the tree.

    Built from the leaves upward: a node's ball holds the balls of its children, of which there are at most a fan.
    """
    deep = F.size(F.split("node", r"\.")) - 1
    plain = leaves.select("node", deep.alias("depth"), "centre", "radius", F.lit(True).alias("leaf"))
    levels, depth = [], plain.agg(F.max("depth")).first()[0] or 0
    up = F.expr("substring_index(node, '.', depth)")
    inner = None
    for d in range(depth, 0, -1):
        here = plain.where(F.col("depth") == d)
        if inner is not None:
            here = here.unionByName(inner)
        here = here.withColumn("parent", up)
        levels.append(here)
        middle = _middle(here, "parent")
        reach = F.expr(f"{_apart('centre', 'middle')} + radius")
        inner = cut_lineage(here.join(middle, "parent").groupBy("parent").agg(F.max(reach).alias("radius"), F.first("middle").alias("centre"))) if d > 1 else None
        if inner is not None:
            inner = inner.select(F.col("parent").alias("node"), F.lit(d - 1).alias("depth"), "centre", F.expr("radius * (1 + 1e-9)").alias("radius"), F.lit(False).alias("leaf"))
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionByName(more)
    return cut_lineage(nodes), depth


def _middle(rows: DataFrame, key: str) -> DataFrame:
    """(key, middle): mean of the centres."""
    each = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("centre") - 1))).groupBy(key, "i").agg(F.avg(F.expr("centre[i]")).alias("x"))
    return each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("middle"))


def _bundles(leaves: DataFrame) -> DataFrame:
    """(node, bundle): leaves that ask together, at most about twice ``ASKING`` vectors if no leaf is larger.

    The largest subtrees of up to that many vectors are put together with the ones beside them under the same node, in
    the order of their distance from the first. A node has at most a fan of them.
    """
    ways = F.expr("transform(sequence(1, size(split(node, '[.]'))), i -> array_join(slice(split(node, '[.]'), 1, i), '.'))")
    under = leaves.select("node", "n", F.posexplode(ways).alias("depth", "up"))
    fit = under.groupBy("up").agg(F.sum("n").alias("total")).where(F.col("total") <= ASKING)
    highest = under.join(fit, "up").groupBy("node").agg(F.min(F.struct("depth", "up")).alias("top"))
    placed = leaves.join(highest, "node", "left").withColumn("unit", F.coalesce("top.up", "node"))
    units = placed.groupBy("unit").agg(F.sum("n").alias("total"), F.min_by("centre", "node").alias("centre"))
    units = units.withColumn("parent", F.expr("substring_index(unit, '.', size(split(unit, '[.]')) - 1)"))
    beside = W.partitionBy("parent")
    ordered = units.withColumn("first", F.min_by("centre", "unit").over(beside)).withColumn("gap", F.expr(_apart("centre", "first")))
    before = F.coalesce(F.sum("total").over(beside.orderBy("gap", "unit").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    named = ordered.select("unit", F.concat_ws("#", "parent", F.floor(before / ASKING).cast("string")).alias("bundle"))
    return placed.select("node", "unit").join(named, "unit").select("node", "bundle")


def _meetings(leaves: DataFrame) -> DataFrame:
    """(bundle, other): leaves where a vector of the bundle may have a neighbour. ``leaves`` have their bundle."""
    nodes, depth = _tree(leaves)
    reach = F.expr(f"{_apart('centre', 'middle')} + radius + reach")
    asking = leaves.join(_middle(leaves, "bundle"), "bundle").groupBy("bundle").agg(F.first("middle").alias("mine"), F.max(reach).alias("upto"))
    found, front = None, asking.withColumn("parent", F.lit(""))
    for d in range(1, depth + 1):
        step = front.join(nodes.where(F.col("depth") == d), "parent")
        step = cut_lineage(step.where(f"{_apart('mine', 'centre')} <= (upto + radius) * (1 + 1e-9)").select("bundle", "mine", "upto", "node", "leaf"))
        pairs = step.where("leaf").select("bundle", F.col("node").alias("other"))
        found = pairs if found is None else found.unionByName(pairs)
        front = step.where("NOT leaf").select("bundle", "mine", "upto", F.col("node").alias("parent"))
    return found


def _whole(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
    """Ids, limits, vectors and leaf numbers of the asking leaves, and the numbers by name."""
    parts, number = [], {}
    for row in table.select(["node", "n", "whole"]).to_pylist():
        n, raw = row["n"], row["whole"]
        number[row["node"]] = len(number)
        ids, far = np.frombuffer(raw, dtype=np.int64, count=n), np.frombuffer(raw, dtype=np.float64, count=n, offset=8 * n)
        parts.append((ids, far, np.frombuffer(raw, dtype=np.float64, offset=16 * n).reshape(n, -1), np.full(n, number[row["node"]])))
    return *(np.concatenate(x) for x in zip(*parts)), number


def _brief(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors from one byte per component, and error bounds of asked leaves."""
    parts = []
    for row in rows:
        m, raw = row["m"], row["brief"]
        scale, error = np.frombuffer(raw, dtype=np.float64, count=2 * m, offset=8 * m).reshape(2, m)
        parts.append((np.frombuffer(raw, dtype=np.int64, count=m), np.frombuffer(raw, dtype=np.int8, offset=24 * m).reshape(m, -1) * scale[:, None], error))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _compare(k: int):
    def compare(asking: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if len(asking) and len(asked):
            src, limit, a, leaf, number = _whole(asking)
            rows = asked.select(["other", "m", "centre", "radius", "brief"]).to_pylist()
            centre, radius = np.array([row["centre"] for row in rows]), np.array([row["radius"] for row in rows])
            turns, wide = [], 0  # near leaves first; own leaves alone, small ones together
            for i in np.argsort(_distances(a.mean(0)[None], centre)[0], kind="stable").tolist():
                if rows[i]["other"] in number:
                    turns.insert(0, [i])
                    continue
                if not wide:
                    turns.append([])
                turns[-1].append(i)
                wide = (wide + rows[i]["m"]) if wide + rows[i]["m"] < WIDE else 0
            top = np.full((len(a), k), np.inf)  # smallest upper bounds so far
            for turn in turns:
                may = (_distances(a, centre[turn]) <= limit[:, None] + radius[turn][None] + _slack(a, centre[turn])).any(1)
                here = np.flatnonzero(may & (leaf != number.get(rows[turn[0]]["other"], -1)))
                if not len(here):
                    continue
                dst, b, error = _brief([rows[i] for i in turn])
                for at in np.split(here, range(STRIP, len(here), STRIP)):
                    d, off = _distances(a[at], b), error + _slack(a[at], b)
                    x, y = np.nonzero(d - off[None] <= limit[at][:, None])
                    low, high = d[x, y] - off[y], d[x, y] + off[y]
                    out.append((at[x], dst[y], low, high))
                    order = np.lexsort((high, x))
                    place = np.arange(len(x)) - np.searchsorted(x, x)
                    best, more = place < k, np.full((len(at), k), np.inf)
                    more[x[best], place[best]] = high[order][best]
                    top[at] = np.sort(np.concatenate([top[at], more], axis=1), axis=1)[:, :k]
                    limit[at] = np.minimum(limit[at], top[at, -1])
        at, to, low, high = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0))
        if len(at):
            still = low <= limit[at]
            at, to, low, high = src[at[still]], to[still], low[still], high[still]
        return pa.table({"src": pa.array(at, pa.int64()), "dst": pa.array(to, pa.int64()), "low": low, "high": high})

    return compare


def _nearest_distinct(points: DataFrame, k: int, block: int, fan: int) -> DataFrame:
    """k nearest among distinct vectors: first inside the own leaf, then in leaves that can still matter."""
    packs = cut_lineage(_leaves(points, block, fan).groupBy("node").applyInArrow(_pack(k), PACK))
    home = packs.select("n", "whole", "home").mapInArrow(_home(k), "src long, dst long, dist double")
    if packs.where("node <> ''").isEmpty():  # a single leaf
        return home
    leaves = packs.select("node", "n", "centre", "radius", "reach")
    bundled = cut_lineage(leaves.join(_bundles(leaves), "node"))
    meet = _meetings(bundled).join(leaves.select(F.col("node").alias("other"), F.col("n").alias("m")), "other")
    parts = F.ceil(F.sum("m").over(W.partitionBy("bundle")) / F.lit(ASKED))
    meet = cut_lineage(meet.select("bundle", "other", F.pmod(F.xxhash64("other"), parts).cast("int").alias("part")))
    asking = meet.select("bundle", "part").distinct().join(bundled.select("bundle", "node"), "bundle").join(packs.select("node", "n", "whole"), "node")
    asked = meet.withColumnsRenamed({"bundle": "to", "part": "of"}).join(packs.select(F.col("node").alias("other"), F.col("n").alias("m"), "centre", "radius", "brief"), "other")
    open_pairs = cut_lineage(asking.groupBy("bundle", "part").cogroup(asked.groupBy("to", "of")).applyInArrow(_compare(k), "src long, dst long, low double, high double"))

    # Only pairs whose lower bound is not over the k-th upper bound of all are looked at in full.
    both = open_pairs.unionByName(home.select("src", F.lit(None).cast("long").alias("dst"), F.col("dist").alias("low"), F.col("dist").alias("high")))
    mine = W.partitionBy("src")
    placed = both.withColumn("place", F.row_number().over(mine.orderBy("high")))
    kth = F.max(F.when(F.col("place") <= k, F.col("high"))).over(mine)
    left = placed.withColumn("kth", kth).where("dst IS NOT NULL AND low <= kth").select("src", "dst")
    there = points.select(F.col("id").alias("src"), F.col("v").alias("a"))
    other = points.select(F.col("id").alias("dst"), F.col("v").alias("b"))

    def settle(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(_directly(np.stack(a.to_numpy()), np.stack(b.to_numpy())) if len(a) else np.zeros(0))

    settled = left.join(there, "src").join(other, "dst").select("src", "dst", F.pandas_udf(settle, "double")("a", "b").alias("dist"))
    return _best(home.unionByName(settled), k).drop("rank")


def nearest(vectors: DataFrame, k: int = 10, metric: str = "l2", block: int = 2048, pivots: int = FAN) -> DataFrame:
    """(src, dst, dist, rank) of the k nearest others; ties go to the smaller id.

    ``vectors``: id bigint, v array<double>. Rows without an id, and those whose vector is NULL, empty or holds a NULL,
    NaN or infinite component, neither ask nor answer. Vectors of different lengths are an error. Copies of a vector
    are searched for once: a group of equal vectors enters with its smallest id, and as no row needs more than k of the
    copies, only the first k + 1 ids of a group can ever be anyone's neighbour.
    """
    points = vectors.select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("array<double>").alias("v"))
    points = sound_vectors(points)
    if metric == "cosine":
        points = unit_vectors(points)
    elif metric != "l2":
        raise ValueError(f"unknown metric {metric!r}")
    heads = points.withColumn("place", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("place") <= k + 1)
    groups = heads.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    distinct = cut_lineage(groups.select(F.col("ids")[0].alias("id"), "v", "ids"))
    found = _nearest_distinct(distinct.select("id", "v"), k, block, pivots)

    # Neighbour groups bring their first ids, the own group its first ids at distance 0.
    ids = distinct.select(F.col("id").alias("dst"), "ids")
    others = found.join(ids, "dst").select("src", "dist", F.explode("ids").alias("dst"))
    own = distinct.where(F.size("ids") > 1).select(F.col("id").alias("src"), F.lit(0.0).alias("dist"), F.explode("ids").alias("dst"))
    lists = (
        _best(others.unionByName(own), k + 1)
        .groupBy(F.col("src").alias("id"))
        .agg(F.array_sort(F.collect_list(F.struct("dist", "dst"))).alias("near"))
    )
    by_vector = distinct.join(lists, "id").select("v", "near")
    kept = points.join(by_vector, "v").select(
        F.col("id").alias("src"), F.slice(F.filter("near", lambda e: e["dst"] != F.col("id")), 1, k).alias("near")
    )
    return kept.select("src", F.posexplode("near").alias("rank", "e")).select(
        "src", F.col("e.dst").alias("dst"), F.col("e.dist").alias("dist"), (F.col("rank") + 1).alias("rank")
    )


# --- graph weights -----------------------------------------------------------------------------


def plain_weights(edges: DataFrame, use_distance: bool = False) -> DataFrame:
    return edges.withColumn("w", F.col("dist") if use_distance else F.lit(1.0))


# Rounds, tolerance and smallest width of the local scale search.
SCALE_ROUNDS, SCALE_TOLERANCE, SCALE_FLOOR = 64, 1e-5, 1e-3


def _local_scale(dists: pd.Series, overall: float, count_nearest: bool) -> pd.DataFrame:
    rho, sigma = np.zeros(len(dists)), np.zeros(len(dists))
    sizes = np.array([len(row) for row in dists], dtype=int)
    for size in np.unique(sizes):  # nearly all rows have the same number of neighbours
        at = np.flatnonzero(sizes == size)
        d = np.sort(np.stack([np.asarray(dists.iloc[i], dtype=float) for i in at]), axis=1)
        nearest = np.where(d > 0, d, np.inf).min(axis=1, initial=np.inf)
        nearest[np.isinf(nearest)] = 0.0
        gaps = np.maximum((d if count_nearest else d[:, 1:]) - nearest[:, None], 0)
        target = math.log2(max(size, 1))
        low, high, mid = np.zeros(len(at)), np.full(len(at), np.inf), np.ones(len(at))
        for _ in range(SCALE_ROUNDS):
            total = np.exp(-gaps / mid[:, None]).sum(axis=1)
            still = np.abs(total - target) >= SCALE_TOLERANCE
            if not still.any():
                break
            above = still & (total > target)
            high[above], low[still & ~above] = mid[above], mid[still & ~above]
            with np.errstate(invalid="ignore"):
                middle = np.where(np.isinf(high), mid * 2, (low + high) / 2)
            mid = np.where(still, middle, mid)
        mean = d.mean(axis=1) if size else np.zeros(len(at))
        rho[at], sigma[at] = nearest, np.maximum(mid, SCALE_FLOOR * np.where(nearest > 0, mean, overall))
    return pd.DataFrame({"rho": rho, "sigma": sigma})


def fuzzy_weights(edges: DataFrame, count_nearest: bool = False) -> DataFrame:
    """Symmetric (src, dst, w): smooth decay from the nearest neighbour on, both directions joined as a + b − ab.

    The width makes the decayed neighbours add up to log2 k. By convention the nearest one is left out
    of that sum; ``count_nearest`` puts it in.
    """
    edges = cut_lineage(edges)
    overall = edges.agg(F.avg("dist")).first()[0]

    def scale(dists: pd.Series) -> pd.DataFrame:
        return _local_scale(dists, overall, count_nearest)

    per_cell = edges.groupBy("src").agg(F.collect_list("dist").alias("_d"))
    scaled = per_cell.withColumn("_s", F.pandas_udf(scale, "rho double, sigma double")("_d")).select("src", "_s.rho", "_s.sigma")
    gap = F.col("dist") - F.col("rho")
    member = F.when((gap <= 0) | (F.col("sigma") == 0), 1.0).otherwise(F.exp(-gap / F.col("sigma")))
    one_way = edges.join(scaled, "src").select("src", "dst", member.alias("w"))
    pairs = one_way.groupBy(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi")).agg(
        F.coalesce(F.max(F.when(F.col("src") < F.col("dst"), F.col("w"))), F.lit(0.0)).alias("a"),
        F.coalesce(F.max(F.when(F.col("src") > F.col("dst"), F.col("w"))), F.lit(0.0)).alias("b"),
    )
    w = F.col("a") + F.col("b") - F.col("a") * F.col("b")
    ways = F.explode(F.array(F.struct(F.col("lo").alias("src"), F.col("hi").alias("dst")), F.struct(F.col("hi").alias("src"), F.col("lo").alias("dst"))))
    return pairs.select(w.alias("w"), ways.alias("e")).select("e.src", "e.dst", "w")


def neighbour_graph(cells: DataFrame, columns: list[str] | None = None, key: str = "cell_mask_id", vector: str | None = None, k: int = 10, metric: str = "l2", fuzzy: bool = True, block: int = 2048) -> tuple[DataFrame, dict]:
    """(edges with dist and w, parameters) from marker columns or a ready vector column."""
    v = F.col(vector).cast("array<double>") if vector else F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    edges = cut_lineage(nearest(cells.select(F.col(key).alias("id"), v.alias("v")), k, metric, block))
    weights = fuzzy_weights(edges) if fuzzy else plain_weights(edges).select("src", "dst", "w")
    joined = weights.join(edges.select("src", "dst", "dist"), ["src", "dst"], "left")
    return joined, {"n_neighbors": k, "metric": metric, "method": "fuzzy" if fuzzy else "plain", "source": vector or "markers"}
