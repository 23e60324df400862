"""Ranks, normalisers, special functions and marker tests against plain Python."""

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tissuegrid.functions.special import normal_cdf, normal_quantile, two_sided_p
from tissuegrid.operators import markers, normalize, orderstats, summary

rng = np.random.default_rng(7)


def test_normal_distribution(spark):
    xs = [-9.0, -7.2, -3.1, -1.0, -0.2, 0.0, 0.4, 1.96, 5.5, 8.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, p, two in df.select("x", normal_cdf("x"), two_sided_p("x")).collect():
        assert p == pytest.approx(NormalDist().cdf(x), rel=1e-9, abs=1e-15)
        assert two == pytest.approx(math.erfc(abs(x) / math.sqrt(2)), rel=1e-8)
    ps = [1e-12, 1e-4, 0.02, 0.075, 0.5, 0.7, 0.925, 0.975, 1 - 1e-9]
    for p, z in spark.createDataFrame([(p,) for p in ps], "p double").select("p", normal_quantile("p")).collect():
        assert z == pytest.approx(NormalDist().inv_cdf(p), rel=1e-8, abs=1e-12)
    assert spark.createDataFrame([(0.0,)], "p double").select(normal_quantile("p")).first()[0] is None


def test_ranks_and_quantiles_with_one_heavy_value(spark):
    v = np.concatenate([np.zeros(400), rng.normal(size=500).round(3), np.full(100, 2.5)])
    g = rng.integers(0, 3, len(v))
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v}))
    pdf = pd.DataFrame({"g": g, "v": v})
    pdf["r"] = pdf.groupby("g")["v"].rank(method="average")
    want = {(a, b): r for a, b, r in pdf.drop_duplicates(["g", "v"]).itertuples(index=False)}
    got = orderstats.ranked_counts(df, ["g"], "v", pieces=16).collect()
    assert {(r.g, r.v): r.below + (r.ties + 1) / 2 for r in got} == want
    cuts = orderstats.quantiles(df, ["g"], "v", {"a": 0.01, "b": 0.5, "c": 0.95}, pieces=16).collect()
    for r in cuts:
        part = v[g == r.g]
        assert [r.a, r.b, r.c] == pytest.approx(np.quantile(part, [0.01, 0.5, 0.95]).tolist())


def test_positions_and_running_totals(spark):
    ids = rng.permutation(5000)
    df = spark.createDataFrame(pd.DataFrame({"k": ids % 2, "id": ids, "n": ids % 7}))
    for r in orderstats.positions(df, ["k"], "id", name="p").collect():
        assert r.p == r.id // 2 + 1
    before = np.concatenate([[0], np.cumsum(np.arange(5000) % 7)[:-1]])
    for r in orderstats.running_before(df.drop("k"), [], "id", "n", "b", block=64).collect():
        assert r.b == before[r.id]


def _scores(spark, df, norm):
    return normalize.prepare(df, norm).orderBy("cell_mask_id").toPandas().drop(columns="cell_mask_id").to_numpy(dtype=float)


def test_normalisers(spark):
    raw = rng.gamma(2.0, 3.0, size=(40, 5))
    raw[0] = 0.0
    raw[1, 2] = raw[1, 3]
    pdf = pd.DataFrame(raw, columns=list("abcde"))
    pdf.insert(0, "cell_mask_id", range(40))
    pdf["patch_id"] = 1
    df = spark.createDataFrame(pdf)
    assert _scores(spark, df, "log1p") == pytest.approx(np.log1p(raw))
    log = np.log1p(raw)
    assert _scores(spark, df, "zscore_log") == pytest.approx((log - log.mean(0)) / log.std(0, ddof=1))
    clr = _scores(spark, df, "clr")
    gm = np.exp(np.log(raw[1:]).mean(1, keepdims=True))
    assert np.isnan(clr[0]).all() and clr[1:] == pytest.approx(np.log1p(raw[1:] / gm))
    ranks = pd.DataFrame(raw).rank(axis=1).to_numpy() / 6
    assert _scores(spark, df, "rank_fraction") == pytest.approx(ranks)
    assert _scores(spark, df, "rank_gaussian")[2] == pytest.approx([NormalDist().inv_cdf(p) for p in ranks[2]])
    ordinal = _scores(spark, df, "rank_fraction_ordinal")
    assert sorted(ordinal[0]) == pytest.approx([i / 6 for i in range(1, 6)])
    with pytest.raises(ValueError):
        normalize.prepare(df, "other")


def test_incomplete_and_textual_rows_are_dropped(spark):
    df = spark.createDataFrame([(1, "3.5", 1.0), (2, "n/a", 2.0), (3, "1", float("nan"))], "cell_mask_id int, a string, b double")
    assert [r.cell_mask_id for r in normalize.prepare(df, "none").collect()] == [1]


def test_rank_test_matches_the_definition(spark):
    v = np.concatenate([rng.normal(size=60), rng.normal(1.0, 1.0, size=40), np.zeros(30)])
    c = np.array(["a"] * 60 + ["b"] * 40 + ["c"] * 30)
    df = spark.createDataFrame(pd.DataFrame({"cluster": c, "feature": "m", "v": v, "raw": v + 3}))
    got = {r.cluster: r for r in markers.one_vs_rest(df).collect()}
    rank = pd.Series(v).rank().to_numpy()
    for name in "abc":
        n1, n2 = (c == name).sum(), (c != name).sum()
        z = (rank[c == name].sum() - n1 * (n1 + n2 + 1) / 2) / math.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
        r = got[name]
        assert r.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-8)
        assert r.p_value_corrected == pytest.approx(r.p_value)
        assert r.mean_rest_log1p == pytest.approx((v[c != name] + 3).mean())
        # Negative normalised means give no fold change, the raw ones do.
        assert r.fold_change_raw == pytest.approx(((v[c == name] + 3).mean() + 1e-9) / ((v[c != name] + 3).mean() + 1e-9))
        assert (r.fold_change is None) == (v[c != name].mean() <= 0)


def test_corrected_levels_are_monotone(spark):
    p = rng.uniform(size=50) ** 2
    df = spark.createDataFrame(pd.DataFrame({"cluster": "x", "feature": range(50), "p_value": p}))
    out = markers.benjamini_hochberg(df).orderBy("p_value").toPandas()
    q = np.minimum.accumulate((np.sort(p) * 50 / np.arange(1, 51))[::-1])[::-1].clip(max=1)
    assert out["p_value_corrected"].to_numpy() == pytest.approx(q)
    large = orderstats.corrected_levels(df, "cluster", "p_value", pieces=8).orderBy("p_value").toPandas()
    assert large["p_value_corrected"].to_numpy() == pytest.approx(q)


def test_fold_change_matrix_of_nothing(spark):
    df = spark.createDataFrame([("1", "m", 2.0, None)], "cluster string, feature string, fold_change_raw double, log2_fold_change double")
    row = markers.fold_change_matrix(df, features=["m", "other"]).first()
    assert (row.m, row.other) == (0.0, 0.0)


def test_kendall_and_spearman(spark):
    a, b = rng.integers(0, 12, 300).astype(float), rng.normal(size=300).round(1)
    a[:100] = 0.0
    df = spark.createDataFrame(pd.DataFrame({"id": range(300), "a": a, "b": b}))
    s, t = np.sign(a[:, None] - a), np.sign(b[:, None] - b)
    want = (s * t).sum() / math.sqrt((s != 0).sum() * (t != 0).sum())
    assert summary.kendall(df, "a", "b", pieces=6).first().tau == pytest.approx(want)
    got = {(r.a, r.b): r.r for r in summary.spearman(df, ["a", "b"], "id").collect()}
    ranks = pd.DataFrame({"a": a, "b": b}).rank()
    assert got["a", "b"] == pytest.approx(ranks["a"].corr(ranks["b"]))


def test_principal_components(spark):
    x = rng.normal(size=(200, 3)) @ np.array([[3, 1, 0], [0, 1, 0], [0, 0, 0.2]])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")))
    out, shares = summary.principal_components(df, list("abc"), 2)
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert shares == pytest.approx((values / values.sum())[:2].tolist())
    assert out.agg(F.var_samp("pc1")).first()[0] == pytest.approx(values[0])


def test_representative_patches(spark):
    rows = [(i, 100 * i, 0, 0, 0, float(-i)) for i in range(12)]
    df = spark.createDataFrame(rows, "patch_id int, cell_count int, nucleus_count int, unmatched_cells int, unmatched_nuclei int, repair_score double")
    got = [(r.patch_id, r.selection_reason) for r in summary.representative_patches(df, 6).collect()]
    reasons = [why for _, why in got]
    assert got[0] == (11, "high_density") and got[1] == (2, "repair_hotspot") and got[2] == (3, "low_density")
    assert reasons[3:] == ["representative", "coverage", "coverage"] and len({p for p, _ in got}) == 6
    few = summary.representative_patches(df.where("patch_id < 4"), 6).collect()
    assert {(r.patch_id, r.selection_reason) for r in few} == {(2, "all"), (3, "all")}
    assert summary.pictures_wanted(900_000, 50) == 0 and summary.pictures_wanted(10**9, 50) == 8


def test_split_shares(spark):
    df = spark.createDataFrame([(i, "a" if i < 70 else "b") for i in range(100)], "id int, label string")
    out = summary.stratified_split(df, "label", "id").groupBy("label", "split").count().collect()
    assert {(r.label, r.split): r["count"] for r in out} == {
        ("a", "test"): 14, ("a", "val"): 6, ("a", "train"): 50, ("b", "test"): 6, ("b", "val"): 2, ("b", "train"): 22,
    }
