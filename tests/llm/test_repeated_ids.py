"""Null and repeated ids, copies and values beyond 64 bits in the vector operators and MinHash."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissuegrid.llm import minhash, pivots, tiles

VEC = "vec_id long, embedding array<double>"


def on_circle(*degrees):
    return [[math.cos(math.radians(a)), math.sin(math.radians(a))] for a in degrees]


def test_a_null_id_joins_its_neighbours(spark):
    a, b, c = on_circle(0, 15, 30)
    for order in ([(1, a), (None, b), (2, c)], [(None, b), (2, c), (1, a)]):
        got = {(r["id"], r["n_links"], r["component_id"], r["kept"]) for r in tiles.near_vectors(spark.createDataFrame(order, VEC)).collect()}
        assert got == {(1, 1, 1, True), (None, 2, 1, False), (2, 1, 1, False)}


def test_equal_vectors_with_null_and_repeated_ids(spark):
    a, b = on_circle(0, 90)
    rows = [(None, a), (1, a), (2, a), (5, b), (5, b), (7, None), (7, a), (None, b), (None, [0.0, 0.0]), (None, on_circle(45)[0])]
    table = spark.createDataFrame(rows, VEC).withColumn("row", F.lit("x")).withColumn("component", F.lit(1))
    got = sorted(((r["id"], r["n_links"], r["component_id"], r["kept"]) for r in tiles.near_vectors(table).collect()), key=repr)
    want = [(None, 3, 1, False), (1, 3, 1, True), (2, 3, 1, False), (7, 3, 1, False), (5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (7, 0, 7, True), (None, 0, None, False), (None, 0, None, False)]
    assert got == sorted(want, key=repr)


def test_repeated_rows_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(tiles, "TILE", 16)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(20, 6))
    rows = [(int(rng.integers(0, 30)) if rng.random() < 0.8 else None, base[k] + rng.normal(size=6) * 0.12) for k in rng.integers(0, 20, 120)]
    unit = np.stack([v / np.sqrt(v @ v) for _, v in rows])
    linked = (unit @ unit.T >= 0.95) & ~np.eye(len(rows), dtype=bool)
    part = list(range(len(rows)))
    for _ in range(len(rows)):
        part = [min([part[i], *(part[j] for j in np.flatnonzero(linked[i]))]) for i in range(len(rows))]
    name = {p: min((rows[i][0] for i in range(len(rows)) if part[i] == p and rows[i][0] is not None), default=None) for p in part}
    want = sorted(((i, int(n), i if n == 0 else name[p]) for (i, _), n, p in zip(rows, linked.sum(1), part)), key=repr)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in rows], VEC)
    assert sorted(((r["id"], r["n_links"], r["component_id"]) for r in tiles.near_vectors(table).collect()), key=repr) == want


def test_repeated_queries_are_searched_once(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in range(90, 140)]
    rows += [rows[10], rows[10], rows[5], (100, rows[3][1])]  # query 100 twice more, a candidate again, and another vector for 100
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q in {(i, tuple(v)) for i, v in whole if i % 100 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in whole if i != q[0])
        want += [(q[0], rank, i, -s) for rank, (s, i) in enumerate(scores[:10], 1)]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in pivots.top_products(spark.createDataFrame(rows, VEC)).collect()]
    assert sorted(got) == sorted(want) and len(got) == 20


@pytest.mark.parametrize("x", [1e12, 1e300, -1e12])
def test_products_beyond_64_bits_are_an_error(spark, x):
    with pytest.raises(Exception, match="64 bits"):
        pivots.top_products(spark.createDataFrame([(0, [x, 1.0]), (1, [x, 2.0])], VEC)).collect()


def test_many_documents_without_an_id(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcdefghijklmnop", k=1) [0] + str(rng.randrange(400)) for _ in range(30)) for _ in range(300)]
    rows = [(None, t) for t in texts] + [(None, f"{t} more") for t in texts[:40]] + [(4, texts[0]), (4, texts[200])]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("print", F.lit(1)).withColumn("lead", F.lit(2))
    got = minhash.near_duplicates(table).collect()
    assert len(got) == len(rows) and sum(r["component_id"] == 4 for r in got) == 5
    assert all(r["component_id"] in (None, 4) for r in got)
    nodes = minhash.sketches(table, "doc_id", "text", 5, 9).groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "print")).alias("lead"))
    assert minhash._texts(table, nodes, "doc_id", "text", 5).count() == len({t for _, t in rows})
