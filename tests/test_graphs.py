"""Neighbours, weights, communities, cell types and scores against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tissuegrid.operators import communities, neighbours, quality

rng = np.random.default_rng(5)


def _vectors(spark, v):
    return spark.createDataFrame([(i, [float(a) for a in row]) for i, row in enumerate(v)], "id long, v array<double>")


def test_neighbours_with_many_copies(spark):
    """A third of the rows are the same vector; the rest lie in clusters."""
    v = np.concatenate([np.ones((60, 4)), rng.normal(size=(60, 4)), rng.normal(8, 1, size=(60, 4))]).round(6)
    v = v[rng.permutation(len(v))]
    got = neighbours.nearest(_vectors(spark, v), 5, block=16, pivots=6).orderBy("src", "rank").toPandas()
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    for i in range(len(v)):
        order = sorted((d[i, j], j) for j in range(len(v)) if j != i)[:5]
        mine = got[got["src"] == i]
        assert mine["dst"].tolist() == [j for _, j in order]
        assert mine["dist"].to_numpy() == pytest.approx([a for a, _ in order])


def test_fewer_rows_than_neighbours(spark):
    got = neighbours.nearest(_vectors(spark, [[0, 0], [1, 0], [1, 0]]), 10)
    assert {(r.src, r.dst) for r in got.collect()} == {(a, b) for a in range(3) for b in range(3) if a != b}


def test_fuzzy_weights(spark):
    edges = neighbours.nearest(_vectors(spark, rng.normal(size=(40, 3))), 6)
    w = {(r.src, r.dst): r.w for r in neighbours.fuzzy_weights(edges, count_nearest=True).collect()}
    assert all(w[a, b] == w[b, a] and 0 < x <= 1 for (a, b), x in w.items())
    one = edges.where("src = 0").orderBy("dist").toPandas()["dist"].to_numpy()
    s = neighbours._local_scale(pd.Series([one]), one.mean(), True)
    assert np.exp(-np.maximum(one - s["rho"][0], 0) / s["sigma"][0]).sum() == pytest.approx(np.log2(6), abs=1e-4)


def test_two_cliques_are_two_communities(spark):
    def clique(ids):
        return [(a, b, 1.0) for a in ids for b in ids if a != b]

    rows = clique(range(8)) + clique(range(8, 20)) + [(0, 8, 0.1), (8, 0, 0.1)]
    edges = spark.createDataFrame(rows, "src long, dst long, w double")
    members = communities.find_communities(edges, resolution=1.0)
    named = {r.node: r.cluster for r in communities.name_by_size(members).collect()}
    assert {named[i] for i in range(8)} == {"2"} and {named[i] for i in range(8, 20)} == {"1"}
    assert communities.modularity(edges, members).first()[0] > 0.4


def test_grouped_kmeans_separates_blobs(spark):
    v = np.concatenate([rng.normal(0, 0.1, (30, 2)), rng.normal(5, 0.1, (30, 2))])
    df = spark.createDataFrame([(p, i, [float(a) for a in row]) for p in (0, 1) for i, row in enumerate(v)], "patch_id int, label long, z array<double>")
    out = quality.grouped_kmeans(df, ["patch_id"], [1, 2]).toPandas()
    for p in (0, 1):
        two = out[(out["patch_id"] == p) & (out["k"] == 2)].sort_values("label")["cluster"].to_numpy()
        assert len(set(two[:30])) == len(set(two[30:])) == 1 and two[0] != two[59]
    assert (out[out["k"] == 1]["cluster"] == 0).all()


def test_score_of_average_metrics_is_one(spark):
    row = spark.range(1).select(quality.quality_score([F.lit(m) for m in quality.SCORE_MEAN]))
    assert row.first()[0] == pytest.approx(1.0)


def test_communities_run_to_the_end(spark):
    n = 24
    edges = spark.createDataFrame([(a, b, 1.0) for i in range(n) for a, b in ((i, (i + 1) % n), ((i + 1) % n, i))], "src long, dst long, w double")
    ring = {r.node: r.community for r in communities.find_communities(edges, resolution=1.0).collect()}
    parts = set(ring.values())

    def gain(x, y):  # of merging two communities of the ring, times the weight of all edges
        between = sum(ring[i] in (x, y) and ring[(i + 1) % n] in (x, y) and ring[i] != ring[(i + 1) % n] for i in range(n))
        size = [sum(c == z for c in ring.values()) for z in (x, y)]
        return between - 2 * size[0] * size[1] / n

    assert len(ring) == n and all(gain(x, y) <= 1e-9 for x in parts for y in parts if x < y)
    with pytest.raises(RuntimeError):
        communities.find_communities(edges, resolution=1.0, max_rounds=1, small=0)


def connected_parts(edges, named):
    """Communities that fall apart along the edges inside them."""
    near = {}
    for a, b, _ in edges:
        if named[a] == named[b]:
            near.setdefault(a, set()).add(b)
    broken = set()
    for c in set(named.values()):
        mine = {v for v in named if named[v] == c}
        seen, front = set(), [min(mine)]
        while front:
            v = front.pop()
            if v not in seen:
                seen.add(v)
                front += near.get(v, ())
        if seen != mine:
            broken.add(c)
    return broken


def modularity_of(edges, named, resolution=1.0):
    total = sum(w for *_, w in edges)
    inside, strength = 0.0, {}
    for a, b, w in edges:
        inside += w * (named[a] == named[b])
        strength[named[a]] = strength.get(named[a], 0) + w
    return inside / total - resolution * sum((k / total) ** 2 for k in strength.values())


def some_graph(seed, groups, size, inner, outer):
    r = np.random.default_rng(seed)
    pairs = [(a, b) for a in range(groups * size) for b in range(a) if r.random() < (inner if a // size == b // size else outer)]
    weights = r.integers(1, 4, len(pairs)).astype(float)
    return [(x, y, w) for (a, b), w in zip(pairs, weights.tolist()) for x, y in ((a, b), (b, a))]


@pytest.mark.parametrize("small", [0, communities.SMALL])
def test_planted_communities_are_found_and_connected(spark, small):
    rows = some_graph(3, 5, 14, 0.7, 0.03)
    edges = spark.createDataFrame(rows, "src long, dst long, w double")
    named = {r.node: r.community for r in communities.find_communities(edges, resolution=1.0, small=small).collect()}
    assert all(len({named[v] for v in range(g * 14, g * 14 + 14)}) == 1 for g in range(5)) and len(set(named.values())) == 5
    assert not connected_parts(rows, named)


def test_no_community_falls_apart():
    for seed in range(30):
        rows = some_graph(seed, 6, 8, 0.35, 0.06)
        frame = pd.DataFrame(rows, columns=["src", "dst", "w"])
        frame["cs"], frame["cd"] = frame["src"], frame["dst"]
        out = communities._finish(frame, 1.0, seed)
        named = dict(zip(out["node"], out["c"]))
        assert not connected_parts(rows, named) and all(named[c] == c for c in named.values())
        planted = {v: v // 8 for v in named}
        assert modularity_of(rows, named) >= modularity_of(rows, planted) - 1e-9


def test_large_rings_end_near_the_best_split(spark):
    n = 64
    rows = [(a, b, 1.0) for i in range(n) for a, b in ((i, (i + 1) % n), ((i + 1) % n, i))]
    members = communities.find_communities(spark.createDataFrame(rows, "src long, dst long, w double"), resolution=1.0)
    named = {r.node: r.community for r in members.collect()}
    assert not connected_parts(rows, named) and modularity_of(rows, named) > 0.73


def test_communities_of_bad_and_no_edges(spark):
    shape = "src long, dst long, w double"
    assert communities.find_communities(spark.createDataFrame([], shape)).count() == 0
    rows = [(1, 2, 1.0), (2, 1, 1.0), (None, 1, 1.0), (1, None, 1.0), (3, 4, None), (5, 6, 0.0), (6, 5, 0.0)]
    got = {r.node: r.community for r in communities.find_communities(spark.createDataFrame(rows, shape)).collect()}
    assert got == {1: 1, 2: 1}


def brute_neighbours(v, k):
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    return {i: [j for _, j in sorted((d[i, j], j) for j in range(len(v)) if j != i)[:k]] for i in range(len(v))}


@pytest.mark.parametrize("block, fan", [(12, 4), (30, 256)])
def test_neighbours_through_a_tree_of_pivots(spark, block, fan):
    """Clusters far apart and of very different width, so that whole branches are passed over and others are not."""
    r = np.random.default_rng(block)
    v = np.concatenate([r.normal(c, s, (40, 5)) for c, s in ((0, 1), (30, 0.01), (31, 4), (-1000, 100))] + [np.full((1, 5), 1e6)])
    v = v[r.permutation(len(v))]
    want = brute_neighbours(v, 4)
    got = {}
    for row in neighbours.nearest(_vectors(spark, v), 4, block=block, pivots=fan).orderBy("src", "rank").collect():
        got.setdefault(row.src, []).append(row.dst)
    assert got == want


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_unsound_vectors_neither_ask_nor_answer(spark, metric):
    v = rng.normal(size=(40, 3))
    rows = [(i, [float(a) for a in row]) for i, row in enumerate(v)]
    bad = [(90, None), (91, [float("nan"), 0.0, 1.0]), (92, [float("inf"), 0.0, 1.0]), (93, [None, 0.0, 1.0]), (None, [0.0, 0.0, 1.0]), (94, [])]
    table = spark.createDataFrame(rows + bad, "id long, v array<double>").withColumn("node", F.lit("x"))
    unit = v / np.sqrt((v * v).sum(1))[:, None] if metric == "cosine" else v
    got = {}
    for row in neighbours.nearest(table, 3, metric=metric, block=8).orderBy("src", "rank").collect():
        got.setdefault(row.src, []).append(row.dst)
    assert got == brute_neighbours(unit, 3)
    assert neighbours.nearest(spark.createDataFrame(bad, "id long, v array<double>"), 3).count() == 0


def test_small_leaves_ask_in_bundles(spark, monkeypatch):
    """Without structure all leaves meet: each is sent once per bundle, not once per leaf that asks."""
    met, cut = [], neighbours.cut_lineage

    def counted(df):
        out = cut(df)
        if "other" in out.columns:
            met.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "cut_lineage", counted)
    v = np.random.default_rng(4).normal(size=(600, 12))
    got = neighbours.nearest(_vectors(spark, v), 4, block=8, pivots=6).groupBy("src").agg(F.array_sort(F.collect_list(F.struct("rank", "dst"))).alias("e")).collect()
    assert 0 < sum(met) <= 600
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert {r.src: [e.dst for e in r.e] for r in got} == {i: np.argsort(d[i], kind="stable")[:4].tolist() for i in range(600)}


def test_last_moves_are_made_in_one_task(spark, monkeypatch):
    """Stars in a ring, too many edges for one task: a few rounds, then the nodes that are left are settled together."""
    cuts, cut = [], communities.cut_lineage

    def counted(df):
        cuts.append(df.columns)
        return cut(df)

    monkeypatch.setattr(communities, "cut_lineage", counted)
    rows = [(a, -1 - a % 5, 1.0) for a in range(400)] + [(-1 - h, -1 - (h + 1) % 5, 0.01) for h in range(5)]
    edges = spark.createDataFrame([e for a, b, w in rows for e in ((a, b, w), (b, a, w))], "src long, dst long, w double")
    named = {r.node: r.community for r in communities.find_communities(edges, resolution=1.0, small=300).collect()}
    assert named == {a: -1 - (a % 5 if a >= 0 else -1 - a) for a in [*range(400), *range(-5, 0)]}
    assert len(cuts) < 40


def test_large_levels_move_block_by_block(spark, monkeypatch):
    """More edges than a task takes, a node with more than that by itself, ids below zero."""
    cuts, cut = [], communities.cut_lineage

    def counted(df):
        cuts.append(df.columns)
        return cut(df)

    monkeypatch.setattr(communities, "cut_lineage", counted)
    rows = [(x - 30, y - 30, w) for x, y, w in some_graph(7, 4, 20, 0.5, 0.03)]
    rows += [e for v in range(-30, 50) for e in ((v, 500, 0.05), (500, v, 0.05))]
    edges = spark.createDataFrame(rows, "src long, dst long, w double")
    named = {r.node: r.community for r in communities.find_communities(edges, resolution=1.0, small=70).collect()}
    assert any("block" in columns for columns in cuts)
    assert not connected_parts(rows, named) and all(named[c] == c for c in named.values())
    assert all(len({named[v] for v in range(g * 20 - 30, g * 20 - 10)}) == 1 for g in range(4)) and len(set(named.values())) == 4
