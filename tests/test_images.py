"""Patches, boundaries, objects, matching and regions on small drawn rasters."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import raster
from pyspark.sql import functions as F

from tissuegrid.functions.geometry import covered_area
from tissuegrid.operators import components, density, match, objects, patches, profile, raster as rs, regions

K = ["patch_id"]
rng = np.random.default_rng(3)


def disks(shape, cells):
    """cells: (label, y, x, radius)."""
    out = np.zeros(shape, dtype=int)
    yy, xx = np.indices(shape)
    for label, y, x, r in cells:
        out[(yy - y) ** 2 + (xx - x) ** 2 <= r * r] = label
    return out


def boundary_of(mask):
    out = np.zeros_like(mask)
    for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0)):
        for y in range(mask.shape[0]):
            for x in range(mask.shape[1]):
                a, b = y + dy, x + dx
                if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[y, x] and mask[a, b] != mask[y, x]:
                    out[y, x] = mask[y, x]
    return out


def to_array(df, column, shape):
    out = np.zeros(shape, dtype=int)
    for r in df.select("y", "x", column).collect():
        out[r.y, r.x] = r[column]
    return out


def test_boundary_across_tiles(spark):
    mask = rng.integers(0, 3, (40, 37))
    got = rs.inner_boundary(raster(spark, mask), "cell_label", K, tile=8)
    assert got.count() == mask.size
    assert (to_array(got, "boundary", mask.shape) == boundary_of(mask)).all()


def test_laplacian_repeats_the_edge(spark):
    v = rng.normal(size=(9, 11))
    got = rs.laplacian(raster(spark, np.zeros((9, 11)), channels=[v]), ["chan0"], K, tile=4)
    pad = np.pad(v, 1, mode="edge")
    want = np.abs(4 * v - pad[:-2, 1:-1] - pad[2:, 1:-1] - pad[1:-1, :-2] - pad[1:-1, 2:])
    for r in got.collect():
        assert r.chan0_laplacian == pytest.approx(want[r.y, r.x])


@pytest.mark.parametrize("mode", ["full_image", "halves", "quarters"])
def test_whole_image_modes_lose_no_pixel(spark, mode):
    ext = spark.createDataFrame([("i", 7, 9)], "image_id string, height int, width int")
    boxes = patches.split(ext, mode)
    px = spark.createDataFrame([("i", y, x) for y in range(7) for x in range(9)], "image_id string, y int, x int")
    cut = patches.cut_boxes(px, boxes, ["image_id"], cell=4)
    assert cut.count() == 63 and cut.select("y", "x").distinct().count() == 63


def test_grid_has_origins_and_padding_covers(spark):
    ext = spark.createDataFrame([("i", 25, 31)], "image_id string, height int, width int")
    grid = patches.split(ext, "patches", patch_height=10, patch_width=10, overlap=0.3).collect()
    assert {(r.y_start, r.x_start) for r in grid} == {(y, x) for y in (0, 7, 14) for x in (0, 7, 14, 21)}
    pad = patches.pad_to_cover(ext, 10, 10, 0.3).first()
    for n, extra in ((25, pad.pad_height), (31, pad.pad_width)):
        assert (n + extra - 10) // 7 * 7 + 10 >= n
    with pytest.raises(ValueError):
        patches.split(ext, "thirds")


def test_merged_labels_stay_apart_and_in_place(spark):
    local = [(p, y, x, 1 + (y + x) % 2) for p in range(12) for y in range(2) for x in range(2)]
    pieces = spark.createDataFrame(local, "patch_id int, patch_y int, patch_x int, cell_label long")
    at = spark.createDataFrame([(p, 2 * p, 0) for p in range(12)], "patch_id int, y_start int, x_start int")
    merged = patches.merge_labels(pieces, at, "cell_label")
    assert merged.count() == 48 and merged.select("cell_label").distinct().count() == 24
    assert merged.agg(F.max("y")).first()[0] == 23


def test_first_patch_keeps_shared_pixels(spark):
    pieces = spark.createDataFrame([(0, 0, 1, 1), (1, 0, 0, 1)], "patch_id int, patch_y int, patch_x int, cell_label long")
    at = spark.createDataFrame([(0, 0, 0), (1, 0, 1)], "patch_id int, y_start int, x_start int")
    assert [tuple(r) for r in patches.merge_labels(pieces, at, "cell_label").collect()] == [(0, 1, 1)]


def test_connected_pixels(spark):
    mask = rng.uniform(size=(50, 45)) < 0.58
    want = -np.ones(mask.shape, dtype=int)
    for start in zip(*np.nonzero(mask)):
        if want[start] < 0:
            want[start] = start[0] * 1000 + start[1]
            todo = [start]
            while todo:
                y, x = todo.pop()
                for a, b in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                    if 0 <= a < 50 and 0 <= b < 45 and mask[a, b] and want[a, b] < 0:
                        want[a, b] = want[start]
                        todo.append((a, b))
    px = spark.createDataFrame([(int(y), int(x)) for y, x in zip(*np.nonzero(mask))], "y int, x int")
    got = components.connected_pixels(px, [], tile=8).collect()
    pairs = {(r.component, want[r.y, r.x]) for r in got}
    assert len(got) == mask.sum() and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_long_chain_of_nodes(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.component for r in components.connected_nodes(edges).collect()}
    assert got[200] == 0 and got[1001] == 1000 and len(got) == 203


def test_compartment_means_of_disks(spark):
    cell = disks((32, 32), [(1, 8, 8, 6), (2, 22, 22, 5), (5, 8, 24, 4)])
    nucleus = disks((32, 32), [(1, 8, 8, 3), (2, 22, 22, 5)])
    v = np.where(nucleus > 0, 10.0, np.where(cell > 0, 3.0, 0.0))
    got = {r.label: r for r in objects.cell_features(raster(spark, cell, nucleus, [v]), ["chan0"], K, cov=True).collect()}
    assert set(got) == {1, 2}
    assert got[1].chan0_nucleus_mean == 10 and got[1].chan0_cytoplasm_mean == 3
    assert got[1].chan0 == pytest.approx(v[cell == 1].mean())
    assert got[1].chan0_cov == pytest.approx(v[cell == 1].std() / v[cell == 1].mean(), rel=1e-6)
    assert got[2].chan0_cytoplasm_mean is None
    empty = objects.cell_features(raster(spark, np.zeros((4, 4)), np.zeros((4, 4)), [np.zeros((4, 4))]), ["chan0"], K)
    assert empty.count() == 0


def test_shape_of_a_rectangle(spark):
    mask = np.zeros((12, 20), dtype=int)
    mask[2:7, 3:15] = 4
    r = objects.region_properties(raster(spark, mask), "cell_label", K).first()
    assert (r.area, r.y, r.x) == (60, 4.0, 8.5)
    assert r.axis_major_length == pytest.approx(4 * math.sqrt((12**2 - 1) / 12))
    assert r.axis_minor_length == pytest.approx(4 * math.sqrt((5**2 - 1) / 12))
    assert r.eccentricity == pytest.approx(math.sqrt(1 - 24 / 143))
    assert r.perimeter == pytest.approx(2 * (11 + 4))
    assert (r.convex_area, r.solidity) == (60, 1.0)


def test_hull_fills_a_notch(spark):
    mask = np.zeros((9, 9), dtype=int)
    mask[1:8, 1:3] = 1
    mask[1:3, 1:8] = 1
    r = objects.convex_area(raster(spark, mask), "cell_label", K).first()
    # Corners (1,7), (2,7) and (7,1), (7,2) span the hull; pixel centres inside the slanted edge count.
    inside = sum(1 for y in range(1, 8) for x in range(1, 8) if y + x <= 9 or (y <= 2 or x <= 2))
    assert r.convex_area == inside and r.solidity == pytest.approx(24 / inside)


def sequential_match(cell, nucleus):
    interior = np.where(boundary_of(cell) > 0, 0, cell)
    taken, out = set(), {}
    for c in sorted(set(cell.ravel()) - {0}):
        best = None
        for n in sorted(set(nucleus[cell == c]) - {0}):
            area = (nucleus == n).sum()
            m = 1 - ((nucleus == n) & (interior == c)).sum() / area
            if n not in taken and m < 1 and (best is None or m < best[0]):
                best = (m, n)
        if best:
            taken.add(best[1])
            out[c] = best[1]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matching_equals_the_sequential_walk(spark, seed):
    r = np.random.default_rng(seed)
    cell = disks((60, 60), [(3 * i + 2, *r.integers(5, 55, 2), int(r.integers(4, 9))) for i in range(14)])
    nucleus = disks((60, 60), [(5 * i + 1, *r.integers(5, 55, 2), int(r.integers(2, 7))) for i in range(25)])
    fixed, matches = match.repair(raster(spark, cell, nucleus), K)
    assert {m.cell: m.nucleus for m in matches.collect()} == sequential_match(cell, nucleus)
    relabelled = to_array(fixed, "nucleus_matched", cell.shape)
    whole = to_array(fixed, "cell_matched", cell.shape)
    for m in matches.collect():
        want = (nucleus == m.nucleus) & (cell == m.cell) & (boundary_of(cell) == 0)
        assert ((relabelled == m.new_label) == want).all() and ((whole == m.new_label) == (cell == m.cell)).all()
    labels = sorted(m.new_label for m in matches.collect())
    assert labels == list(range(1, len(labels) + 1))


def test_contested_nucleus_goes_to_the_first_cell(spark):
    pairs = spark.createDataFrame(
        [(0, 1, 9, 0.5), (0, 2, 9, 0.1), (0, 2, 8, 0.6), (0, 3, 8, 0.0), (0, 3, 7, 0.9), (0, 4, 7, 1.0)],
        "patch_id int, cell long, nucleus long, mismatch double",
    )
    assert {(m.cell, m.nucleus) for m in match.assign(pairs, K).collect()} == {(1, 9), (2, 8), (3, 7)}


@pytest.mark.parametrize(("links", "walk"), [(200, match.WALK), (9, 4)])
def test_chains_of_contested_nuclei(spark, links, walk):
    """Each cell's best nucleus is also a candidate of the cell before; the second case keeps to rounds."""
    rows = [(p, i, n, m) for p in range(2) for i in range(links) for n, m in ((i, 0.1), (i + 1, 0.2))]
    rows += [(3, 1, 5, 0.4), (3, 2, 5, 0.1), (3, 2, 6, 0.4)]
    pairs = spark.createDataFrame(rows, "patch_id int, cell long, nucleus long, mismatch double")
    got = {(m.patch_id, m.cell, m.nucleus) for m in match.assign(pairs.where("cell <> 0 or nucleus <> 0"), K, walk).collect()}
    # Without its own nucleus the first cell takes the second's, and so on down the chain.
    assert got == {(p, i, i + 1) for p in range(2) for i in range(links)} | {(3, 1, 5), (3, 2, 6)}


def test_gaps_in_labels_and_repair_loss(spark):
    """Membranes and areas are looked up by label, not by position."""
    cell = disks((40, 40), [(4, 10, 10, 6), (9, 28, 28, 6)])
    nucleus = disks((40, 40), [(23, 10, 10, 3), (5, 28, 33, 3)])
    fixed, matches = match.repair(raster(spark, cell, nucleus), K)
    assert {(m.cell, m.nucleus, m.new_label) for m in matches.collect()} == {(4, 23, 1), (9, 5, 2)}
    after = fixed.where("nucleus_matched > 0").groupBy("patch_id", F.col("nucleus_matched").alias("new_label")).agg(F.count(F.lit(1)).alias("area"))
    before = fixed.where("nucleus_label > 0").groupBy("patch_id", F.col("nucleus_label").alias("label")).agg(F.count(F.lit(1)).alias("area"))
    kept = profile.with_trim_flag(profile.retained_fractions(after, before, matches, "nucleus", K))
    got = {r.new_label: (r.nucleus_area_before, r.nucleus_was_trimmed) for r in kept.collect()}
    assert got[1] == ((nucleus == 23).sum(), False) and got[2] == ((nucleus == 5).sum(), True)


def test_empty_masks(spark):
    fixed, matches = match.repair(raster(spark, np.zeros((5, 5)), np.zeros((5, 5))), K)
    assert matches.count() == 0 and fixed.where("cell_matched > 0").count() == 0


def test_channel_names_never_collide(spark):
    panel = spark.createDataFrame([(0, "A"), (1, "A"), (2, "A_1"), (3, "B")], "channel_idx int, antibody_name string")
    names = [r.unique_name for r in profile.unique_channel_names(panel).collect()]
    assert len(set(names)) == 4 and {"A", "A_1", "B"} <= set(names)


def test_densities(spark):
    mask = disks((30, 30), [(1, 5, 5, 2), (2, 20, 20, 2), (3, 5, 25, 2)])
    px = raster(spark, mask)
    found = density.object_table(density.long_masks(px, {"cell": "cell_label"}, K), K)
    d = density.mask_density(found, K, 0.5).first()
    assert d.nobj == 3 and d.density == pytest.approx(3 / ((mask > 0).sum() * 0.25 / 1e6))
    ext = spark.createDataFrame([(0, 30, 30)], "patch_id int, height int, width int")
    local = {(r.wi, r.wj): r.local_density for r in density.local_densities(found, ext, ["cell"], K, 0.5, 10.0).collect()}
    assert len(local) == 4 and local[0, 0] == pytest.approx(1 / (400 * 0.25 / 1e6)) and local[1, 0] == 0
    assert local[0, 1] == pytest.approx(1 / (200 * 0.25 / 1e6))


def test_pixels_of_a_triangle_include_its_border(spark):
    ring = [(0.0, 0.0), (0.0, 6.0), (6.0, 0.0)]
    area = spark.createDataFrame([(1, "t", [{"y": y, "x": x} for y, x in ring])], "region_id int, label string, ring array<struct<y:double,x:double>>")
    px = spark.createDataFrame([(y, x) for y in range(10) for x in range(10)], "y int, x int")
    got = {(r.y, r.x) for r in regions.pixels_in_regions(px, area).collect()}
    assert got == {(y, x) for y in range(7) for x in range(7) if y + x <= 6}
    assert regions.pixels_in_regions(px, area, least=100).count() == 0


def test_regions_stay_on_their_image(spark):
    box = [{"y": y, "x": x} for y, x in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0))]
    shape = "image_id int, region_id int, label string, ring array<struct<y:double,x:double>>"
    area = spark.createDataFrame([(1, 1, "Tissue", box), (2, 1, "N", box)], shape)
    px = spark.createDataFrame([(i, y, x, float(i)) for i in range(3) for y in range(8) for x in range(8)], "image_id int, y int, x int, v double")
    inside = regions.pixels_in_regions(px, area, keys=["image_id"]).groupBy("image_id", "label").count().collect()
    assert {tuple(r) for r in inside} == {(1, "Tissue", 25), (2, "N", 25)}
    cut = regions.crops(px, area, ["v"], keys=["image_id"]).collect()
    assert len(cut) == 50 and all(r.v == r.image_id for r in cut)
    tiles = px.selectExpr("image_id", "y DIV 4 AS ty", "x DIV 4 AS tx").distinct()
    labels = regions.label_tiles(tiles, area.withColumn("rings", F.array("ring")), 4, keys=["image_id"]).collect()
    want = {(i, y, x): "minimal_tissue" if i == 1 and (y or x) else "N" if (i, y, x) == (2, 0, 0) else "Unlabeled" for i in range(3) for y in range(2) for x in range(2)}
    assert {(r.image_id, r.ty, r.tx): r.label for r in labels} == want


def test_union_area_counts_overlap_once():
    def box(y0, x0, y1, x1):
        return [[{"y": y, "x": x} for y, x in ((y0, x0), (y1, x0), (y1, x1), (y0, x1))]]

    assert covered_area([box(0, 0, 4, 4), box(2, 2, 6, 6)], 0, 0, 10, 10) == pytest.approx(28)
    hole = box(0, 0, 4, 4) + box(1, 1, 3, 3)
    assert covered_area([hole], 0, 0, 10, 10) == pytest.approx(12)
    diamond = [[{"y": y, "x": x} for y, x in ((0, 5), (5, 10), (10, 5), (5, 0))]]
    assert covered_area([diamond], 0, 0, 5, 5) == pytest.approx(12.5)
    assert covered_area([diamond, box(0, 0, 5, 5)], 0, 0, 10, 10) == pytest.approx(50 + 12.5)


def test_noise_repeats_and_spares_other_patches(spark):
    px = raster(spark, np.zeros((20, 20)), channels=[np.full((20, 20), 100.0)]).withColumn("is_informative", F.col("y") < 10)
    a = rs.disrupt(px, "gaussian", ["chan0"], 3).orderBy("y", "x").toPandas()
    b = rs.disrupt(px, "gaussian", ["chan0"], 3).orderBy("y", "x").toPandas()
    assert (a["chan0"] == b["chan0"]).all() and (a[a["y"] >= 10]["chan0"] == 100).all()
    assert 4 < a[a["y"] < 10]["chan0"].std() < 8


def test_crowded_tiles_are_cut_up(spark):
    """Many polygons of one label in one tile, some of them copies."""
    boxes = [(float(y), float(x)) for y in range(0, 12) for x in range(0, 12)] * 2
    rows = [(i, "t", [[{"y": y, "x": x}, {"y": y + 3, "x": x}, {"y": y + 3, "x": x + 3}, {"y": y, "x": x + 3}]]) for i, (y, x) in enumerate(boxes)]
    df = spark.createDataFrame(rows, "region_id int, label string, rings array<array<struct<y:double,x:double>>>")
    got = {(r.ty, r.tx): r.area for r in regions.tile_label_areas(df, 10).collect()}
    assert got == pytest.approx({(0, 0): 100.0, (0, 1): 40.0, (1, 0): 40.0, (1, 1): 16.0})


def test_squares_are_quartered_as_long_as_they_are_crowded(spark):
    """Stars that share a corner, slivers, holes and polygons that fill whole tiles: the same area at every crowd."""
    r = np.random.default_rng(4)
    rows = []
    for i in range(60):
        at, n = r.uniform(0, 16, 2), int(r.integers(3, 9))
        turn = np.sort(r.uniform(0, 2 * np.pi, n))
        ring = [(at[0] + h * np.sin(t), at[1] + h * np.cos(t)) for h, t in zip(r.uniform(0.5, 7, n), turn)]
        rows.append((i, "ab"[i % 2], [ring, [(y * 0.3 + at[0] * 0.7, x * 0.3 + at[1] * 0.7) for y, x in ring]] if i % 5 == 0 else [ring]))
    rows += [(100 + i, "fan", [[(4.0, 4.0), (4.0 + np.sin(a), 4.0 + np.cos(a)), (4.0 + np.sin(a + 0.1), 4.0 + np.cos(a + 0.1))]]) for i, a in enumerate(np.linspace(0, 6, 10))]
    rows += [(200, "c", [[(-1.0, -1.0), (9.0, -1.0), (9.0, 20.0), (-1.0, 20.0)]]), (201, "c", [[(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]])]
    shape = "region_id int, label string, rings array<array<struct<y:double,x:double>>>"
    df = spark.createDataFrame([(i, label, [[{"y": float(y), "x": float(x)} for y, x in ring] for ring in rings]) for i, label, rings in rows], shape)
    found = [{(q.label, q.ty, q.tx): q.area for q in regions.tile_label_areas(df, 8, crowd=c).collect() if q.area > 1e-12} for c in (12, 1000)]
    assert found[0] == pytest.approx(found[1], abs=1e-9) and found[0]["c", 0, 0] == 64.0

    def inside(rings, y, x):
        odd = np.zeros(y.shape, dtype=bool)
        for ring in rings:
            for (a, b), (c, e) in zip(ring, ring[1:] + ring[:1]):
                if a != c:
                    odd ^= ((a <= y) != (c <= y)) & (x < b + (y - a) * (e - b) / (c - a))
        return odd

    y, x = np.meshgrid((np.arange(400) + 0.5) / 50, (np.arange(400) + 0.5) / 50, indexing="ij")
    for label in ("a", "b", "fan"):
        for ty in (0, 1):
            share = np.any([inside(rings, y + 8 * ty, x) for _, name, rings in rows if name == label], axis=0).mean()
            assert found[0].get((label, ty, 0), 0.0) / 64 == pytest.approx(share, abs=4e-3)


def test_many_edges_in_one_point(spark, monkeypatch):
    """Quartering never parts them; what is left is too small to count."""
    monkeypatch.setattr(regions, "MOST_QUARTERS", 7)
    turn = np.linspace(0, 2 * np.pi, 31)
    rings = [[{"y": 3.0, "x": 5.0}, {"y": float(3 + np.sin(a)), "x": float(5 + np.cos(a))}, {"y": float(3 + np.sin(b)), "x": float(5 + np.cos(b))}] for a, b in zip(turn, turn[1:])]
    df = spark.createDataFrame([(i, "t", [r]) for i, r in enumerate(rings)], "region_id int, label string, rings array<array<struct<y:double,x:double>>>")
    (got,) = regions.tile_label_areas(df, 8, crowd=10).collect()
    assert got.area == pytest.approx(30 * np.sin(2 * np.pi / 30) / 2, abs=8 * 64 * 4.0**-7)


def test_area_of_no_regions(spark):
    df = spark.createDataFrame([], "region_id int, label string, rings array<array<struct<y:double,x:double>>>")
    assert regions.tile_label_areas(df, 8).count() == 0
