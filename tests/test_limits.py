"""Cases beyond former limits: NaN and NULL values, empty tables, all pixels, runs to the end."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tissuegrid import runtime
from tissuegrid.functions import rows
from tissuegrid.operators import bias, components, neighbours, orderstats, regions, summary
from tissuegrid.operators.neighbours import SCALE_FLOOR, _local_scale
from tissuegrid.sources import tables


@pytest.mark.parametrize("n", [3, 4000])
def test_quantiles_pass_over_nan_and_null(spark, n):
    rng = random.Random(n)
    values = [rng.choice([1.0, 2.0, rng.random() * 9]) for _ in range(n)] + [float("nan"), None]
    table = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    got = orderstats.quantiles(table, ["g"], "v", {"mid": 0.5, "low": 0.1}).first()
    assert got["mid"] == pytest.approx(np.percentile(values[:n], 50)) and got["low"] == pytest.approx(np.percentile(values[:n], 10))
    ranked = orderstats.ranked_counts(table, ["g"], "v")
    assert ranked.agg(F.sum("n")).first()[0] == n


def test_positions_put_null_last(spark):
    table = spark.createDataFrame([(i, None if i % 7 == 0 else float(-i)) for i in range(500)], "i long, o double")
    got = {r["i"]: r["position"] for r in orderstats.positions(table, [], "o", ["i"]).collect()}
    order = sorted(range(500), key=lambda i: (i % 7 == 0, i if i % 7 == 0 else -i))
    assert got == {i: k + 1 for k, i in enumerate(order)}


def test_nearest_of_an_empty_table(spark):
    assert neighbours.nearest(spark.createDataFrame([], "id long, v array<double>"), 3).count() == 0


def test_local_scale_equals_a_search_row_by_row():
    rng = np.random.default_rng(1)
    table = [sorted(rng.random(size)) for size in (5, 5, 8, 1)] + [[0.0, 0.0, 0.0], [0.0, 0.4, 0.9]]
    got = _local_scale(pd.Series(table), 0.7, False)
    for d, rho, sigma in zip(table, got["rho"], got["sigma"]):
        d = np.array(d)
        assert rho == (d[d > 0][0] if (d > 0).any() else 0.0)
        gaps = np.maximum(d[1:] - rho, 0)
        floor = SCALE_FLOOR * (d.mean() if rho > 0 else 0.7)
        total = np.exp(-gaps / sigma).sum()
        assert abs(total - math.log2(len(d))) < 1e-4 or sigma == pytest.approx(floor) or sigma > 1e6 or len(d) == 1 or not (gaps > 0).any()


def test_background_takes_every_pixel(spark):
    pixels = spark.range(30_000).select(F.lit(0).alias("patch_id"), F.lit(0).alias("y"), F.col("id").cast("int").alias("x"), F.lit(0).alias("nucleus_label"), F.lit(1.0).alias("v0"))
    assert bias.background_sample(pixels, ["v0"], ["patch_id"]).count() == 30_000
    assert 13_000 < bias.background_sample(pixels, ["v0"], ["patch_id"], share=0.5).count() < 17_000


def test_components_of_a_long_chain_and_an_early_end(spark):
    chain = spark.range(900).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.connected_nodes(chain).select("component").distinct().count() == 1
    with pytest.raises(RuntimeError):
        components.connected_nodes(chain, max_rounds=1, small=0)


@pytest.mark.parametrize("small", [0, components.SMALL])
def test_components_with_keys_nulls_and_loops(spark, small):
    rows = [("x", 1, 2), ("x", 2, 3), ("y", 1, 5), ("y", 7, 7), ("x", 9, 8), ("x", 3, 1), ("y", 5, 6), ("x", None, 4)]
    got = components.connected_nodes(spark.createDataFrame(rows, "g string, a long, b long"), ["g"], small=small).collect()
    assert {(r["g"], r["node"], r["component"]) for r in got} == {("x", 1, 1), ("x", 2, 1), ("x", 3, 1), ("y", 1, 1), ("y", 5, 1), ("y", 6, 1), ("x", 8, 8), ("x", 9, 8)}
    rng = np.random.default_rng(2)
    pairs = rng.integers(0, 200, (150, 2))
    named = {r["node"]: r["component"] for r in components.connected_nodes(spark.createDataFrame(pairs.tolist(), "a long, b long"), small=small).collect()}
    root = components._joined(pairs[:, 0], pairs[:, 1], 200)
    assert named == {int(x): int(root[x]) for x in {int(e) for a, b in pairs if a != b for e in (a, b)}}
    assert components.connected_nodes(spark.createDataFrame([], "a long, b long"), small=small).count() == 0


def test_row_functions_grow_with_the_panel_only(spark):
    for width in (4, 64):
        v = [float(i % 5 + 1) for i in range(width)]
        table = spark.createDataFrame([(v,), ([0.0] * width,), (None,)], "v array<double>")
        got = table.select(*[F.expr(f("v")).alias(n) for n, f in (("z", rows.zscore_row), ("c", rows.centred_log_ratio), ("e", rows.entropy))]).collect()
        x = np.array(v)
        assert np.allclose(got[0]["z"], (x - x.mean()) / x.std())
        assert np.allclose(got[0]["c"], np.log1p(x / np.exp(np.log(x).mean())))
        assert got[0]["e"] == pytest.approx(-(x / x.sum() * np.log2(x / x.sum())).sum())
        assert got[1]["z"] == got[1]["c"] == [None] * width and got[1]["e"] == 0.0
        assert got[2]["z"] is None and got[2]["e"] == 0.0


def test_kendall_on_ties_and_missing_values(spark):
    rng = np.random.default_rng(4)
    for n, spread in ((300, 9), (260, 100_000), (3, 1)):
        a, b = rng.integers(0, spread, n).astype(float), rng.integers(0, max(1, spread // 2), n).astype(float)
        table = spark.createDataFrame([*zip(a.tolist(), b.tolist()), (None, 1.0), (1.0, float("nan"))], "a double, b double")
        got = summary.kendall(table, "a", "b", pieces=7).first()
        up = np.sign(np.subtract.outer(a, a)), np.sign(np.subtract.outer(b, b))
        base = math.sqrt((up[0] != 0).sum() * float((up[1] != 0).sum()))
        assert got["tau"] == (pytest.approx((up[0] * up[1]).sum() / base) if base else None)
    assert summary.kendall(spark.createDataFrame([], "a double, b double"), "a", "b").first()["tau"] is None


def test_smaller_pairs_when_one_value_holds_most_rows(spark):
    rng = np.random.default_rng(6)
    a = np.where(rng.random(400) < 0.6, 5, rng.integers(0, 50, 400))
    b = np.where(rng.random(400) < 0.6, 3, rng.integers(0, 300, 400))
    n = rng.integers(1, 4, 400)
    table = spark.createDataFrame([(float(x), int(y), int(k)) for x, y, k in zip(a, b, n)], "a double, r long, n long")
    want = sum(int(n[i]) * int(n[j]) for i in range(400) for j in range(400) if a[j] < a[i] and b[j] < b[i])
    assert orderstats.smaller_pairs(table, "a", "r", "n", 300, pieces=9).first()["pairs"] == want


def test_names_are_numbered_in_ranges(spark):
    rng = random.Random(2)
    names = sorted({"".join(rng.choices("abZé ", k=rng.randint(0, 4))) for _ in range(400)}, key=lambda s: s.encode())
    shuffled = names[:]
    rng.shuffle(shuffled)
    table = spark.createDataFrame([(x,) for x in shuffled * 2] + [(None,)], "name string")
    got = {r["name"]: r["id"] for r in summary.vocabulary(table).collect()}
    assert got == {x: i for i, x in enumerate(names, 1)}
    assert summary.vocabulary(spark.createDataFrame([], "name string")).count() == 0


def test_lines_of_several_files_keep_their_order(spark, tmp_path):
    want = []
    for f in range(3):
        rows = [f"name {f} {i}" for i in range(40 * f)]
        want += rows
        (tmp_path / f"panel-{f}.tsv").write_text("channel_id\tantibody_name\n" + "".join(f"c{i}\t{x}\n" for i, x in enumerate(rows)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = tables.scan_panel(spark, str(tmp_path)).orderBy("channel_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["antibody_name"] for r in got] == want and [r["channel_idx"] for r in got] == list(range(len(want)))


def test_components_of_each_image(spark):
    rng = np.random.default_rng(3)
    rows = []
    for image in ("p", "q", None):
        x = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) + 1000
        rows += [(image, *map(float, r)) for r in x]
    rows += [("p", None, 1.0, 1.0, 1.0, 1.0), ("p", float("nan"), 1.0, 1.0, 1.0, 1.0)]
    names = list("abcde")
    table = spark.createDataFrame(rows, "image string, " + ", ".join(f"{c} double" for c in names))
    for standardise in (False, True):
        p = np.array([r[1:] for r in rows if r[0] == "p"][:60])
        z = (p - p.mean(0)) / (p.std(0) if standardise else 1)
        values, axes = np.linalg.eigh(np.cov(z.T))
        got = summary.principal_axes(table.where("image = 'p'"), names, 3, ["image"], standardise).first()
        assert got["variances"] == pytest.approx(values[::-1][:3]) and got["shares"] == pytest.approx(values[::-1][:3] / values.sum())
        scored = summary.project(table.where("image = 'p' AND a IS NOT NULL AND NOT isnan(a)"), names, summary.principal_axes(table, names, 3, standardise=standardise).limit(1))
        assert scored.count() == 60
        mine = summary.project(table.where("image = 'p'"), names, summary.principal_axes(table.where("image = 'p'"), names, 3, ["image"], standardise), ["image"])
        pcs = np.array([r["pcs"] for r in mine.collect() if r["a"] is not None and not math.isnan(r["a"])])
        assert np.abs(pcs) == pytest.approx(np.abs(z @ axes[:, ::-1][:, :3]), abs=1e-8)
    assert summary.principal_axes(table, ["a", "b"], 2, ["image"]).count() == 2
    assert summary.principal_axes(table.where("false"), ["a", "b"], 2).count() == 0


def test_view_of_vectors_matches_the_closed_form(spark):
    x = np.random.default_rng(1).normal(size=(50, 20)) * np.linspace(3, 0.1, 20)
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    out, axes = summary.vector_components(table, "v", 2)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    got = np.array([r["pcs"] for r in out.orderBy("id").collect()])
    assert np.abs(got) == pytest.approx(np.abs((x - x.mean(0)) @ vectors[:, ::-1][:, :2]), abs=1e-8)
    assert axes.first()["variances"] == pytest.approx(values[::-1][:2])


def test_every_image_has_its_own_threshold_and_places(spark):
    rows = []
    for image, level in (("a", 10), ("b", 1000)):
        for y in range(12):
            for x in range(12):
                bright = (y < 4 and x < 4) or (8 <= y < 11 and 6 <= x < 12) or (y, x) == (0, 11)
                rows.append((image, y, x, float(level * (5 if bright else 1) + (y + x) % 2)))
    preview = spark.createDataFrame(rows, "image_id string, y int, x int, v double")
    got = {(r["image_id"], r["area"], r["min_row"], r["min_col"], r["max_row"], r["max_col"]) for r in regions.automatic_regions(preview, "v", 4, 2, 2, ["image_id"]).collect()}
    assert got == {(i, *box) for i in "ab" for box in ((18, 32, 24, 44, 48), (16, 0, 0, 16, 16))}
    alone = regions.automatic_regions(preview.where("image_id = 'b'").drop("image_id"), "v", 4, 1, 2)
    assert [r["area"] for r in alone.collect()] == [18]


def test_counted_values_serve_ranks_and_quantiles(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.choice([1.0, 2.0, 2.5, rng.random() * 9]), rng.choice("xyz"), rng.random()) for _ in range(900)] + [("a", None, "x", 1.0), ("b", float("nan"), "y", 2.0)]
    table = spark.createDataFrame(rows, "g string, v double, c string, w double")
    counts = orderstats.counted_values(table, ["g"], "v", ["c"], ["w"], pieces=5)
    assert counts.agg(F.sum("n")).first()[0] == len(rows) and counts.agg(F.sum("w")).first()[0] == pytest.approx(sum(r[3] for r in rows))
    ranked = orderstats.ranks_of(counts, ["g"], "v")
    plain = {(r["g"], r["v"], r["c"]): (r["n"], r["ties"], r["below"], r["total"]) for r in orderstats.ranked_counts(table, ["g"], "v", ["c"]).collect()}
    assert {(r["g"], r["v"], r["c"]): (r["n"], r["ties"], r["below"], r["total"]) for r in ranked.collect()} == plain
    for r in orderstats.quantiles_of(ranked, ["g"], "v", {"q": 0.3}).collect():
        assert r["q"] == pytest.approx(np.percentile([x[1] for x in rows[:900] if x[0] == r["g"]], 30))


def test_a_cluster_needs_a_shared_stage_folder():
    assert runtime.is_cluster("spark://host:7077") and runtime.is_cluster("yarn") and runtime.is_cluster("local-cluster[3,2,1024]")
    assert not runtime.is_cluster("local") and not runtime.is_cluster("local[*]")

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, *default):
            return default[0] if default else "file:/tmp/warehouse"

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.ensure_checkpoint_dir(Session())


def test_component_rounds_shrink(spark, monkeypatch):
    """All rounds together write a few times the edges, not the edges once per round."""
    n, rows, cut = 3000, [], components.cut_lineage

    def counted(df):
        out = cut(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(components, "cut_lineage", counted)
    edges = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.range(n).select((F.col("id") * 7 + 10_000).alias("a"), (F.col("id") % 40 + 40_000).alias("b")))
    got = components.connected_nodes(edges, small=0)
    assert sum(rows) < 8 * 2 * n
    assert {(r["component"], r["count"]) for r in got.groupBy("component").count().collect()} == {(0, n + 1)} | {(10_000 + 7 * i, n // 40 + 1) for i in range(40)}


def test_a_frequent_value_is_ranked_once(spark, monkeypatch):
    """Rows that share a value, and rows that share a key, don't meet in one range of the ranking."""
    sizes, count = [], summary.counted_values

    def counted(*args, **options):
        out = count(*args, **options)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(summary, "counted_values", counted)
    a, b = [0.0] * 900 + [float(i) for i in range(100)], [float(i % 5) for i in range(1000)]
    frame = pd.DataFrame({"id": [i // 2 for i in range(1000)], "a": a, "b": b})
    got = {(r.a, r.b): r.r for r in summary.spearman(spark.createDataFrame(frame), ["a", "b"], "id").collect()}
    assert sum(sizes) == 100 + 5
    assert got["a", "b"] == pytest.approx(frame["a"].rank().corr(frame["b"].rank()))
