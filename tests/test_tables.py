"""Sheets, documents, sources, sinks and streams."""

import tempfile

from pyspark.sql import functions as F

from tissuegrid.operators import qc, sheets, summary
from tissuegrid.sources import documents, listing, sinks, tables
from tissuegrid.streaming.files import pixel_stream, write_complete


def test_error_texts(spark):
    sheet = spark.createDataFrame([(0, "E1", " 7", "yes"), (1, "", "x", "2"), (2, None, "99", None)], "row_index long, exp_id string, n string, flag string")
    fields = [sheets.Field("exp_id", required=True), sheets.Field("n", "int", max=10), sheets.Field("flag", "bool")]
    got = {r.row_index: r.errors for r in sheets.validate(sheet, fields).collect()}
    assert got[0] == []
    assert got[1] == [
        "Row 3, column 'exp_id': value cannot be null",
        "Row 3, column 'n': expected integer",
        "Row 3, column 'flag': expected boolean",
    ]
    assert got[2] == ["Row 4, column 'exp_id': missing required value", "Row 4, column 'n': value 99 above maximum 10"]
    good, bad = sheets.split_valid(sheets.validate(sheet, fields))
    assert [(r.n, r.flag) for r in good.collect()] == [(7, True)] and bad.count() == 2


def test_all_or_nothing_fails(spark):
    import pytest

    sheet = spark.createDataFrame([(0, "a"), (1, None)], "row_index long, exp_id string")
    checked = sheets.validate(sheet, [sheets.Field("exp_id", required=True)])
    with pytest.raises(Exception, match="missing required value"):
        sheets.all_or_nothing(checked).collect()
    assert sheets.all_or_nothing(checked.where("row_index = 0")).count() == 1


def test_rules(spark):
    sheet = spark.createDataFrame([(0, "fast", None), (1, "slow", "5"), (2, "other", "-1")], "row_index long, mode string, level string")
    fields = [sheets.Field("mode"), sheets.Field("level", "int")]
    rules = [
        {"type": "require_if", "if": {"key": "mode", "equals": "fast"}, "required_keys": ["level"]},
        {"type": "forbid_if", "if": {"key": "mode", "not_in": ["fast"]}, "forbidden_when_set": ["level"]},
        {"type": "range_if", "if": {"key": "level", "is_null": False}, "key": "level", "min": 0},
    ]
    got = {r.row_index: r.errors for r in sheets.validate(sheet, fields, rules).collect()}
    assert got[0] == ["Row 2, column 'level': value is required"]
    assert got[1] == ["Row 3, column 'level': value is not allowed when condition holds"]
    assert got[2] == ["Row 4, column 'level': value -1 below minimum 0"]


def test_annotation_forms(spark):
    docs = spark.createDataFrame(
        [
            ("a.json", '{"data": [{"data": [[0,1],[0,2],[3,4]]}, {"data": [[1,1],[2,2]]}]}'),
            ("b.json", '{"type":"FeatureCollection","features":[{"geometry":{"type":"Point","coordinates":[1,2]}},'
             '{"geometry":{"type":"Polygon","coordinates":[[[1,2],[3,4],[5,6]]]},"properties":{"name":"x y"}}]}'),
            ("c.json", "not json"),
            ("d.json", "[[[1,2,3,4],[5,6,7,8]]]"),
        ],
        "file string, text string",
    )
    got = {r.file: r for r in documents.with_region_label(documents.annotations(docs)).collect()}
    assert set(got) == {"a.json", "b.json", "d.json"}
    assert [(p.y, p.x) for p in got["a.json"].ring] == [(0, 1), (0, 2), (3, 4)]
    assert [(p.y, p.x) for p in got["b.json"].ring] == [(2, 1), (4, 3), (6, 5)] and got["b.json"].label == "x_y"
    assert [(p.y, p.x) for p in got["d.json"].ring] == [(1, 5), (2, 6), (3, 7), (4, 8)] and got["d.json"].label == "0"


def test_layout_of_folders(spark):
    def kind(*names):
        return listing.layout(spark.createDataFrame([(f"file:/x/{n}",) for n in names], "path string")).first().layout

    assert kind("cell_metadata.csv", "patch-0-cell_metadata.csv") == "merged"
    assert kind("patch-0-cell_metadata.csv", "patch-1-cell_metadata.csv") == "patches" and kind("a.txt") == "unknown"


def test_box_scan_reaches_the_files(spark):
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/px"
    px = spark.range(400).select((F.col("id") / 20).cast("int").alias("y"), (F.col("id") % 20).cast("int").alias("x"), F.lit(1.0).alias("a"), F.lit(2.0).alias("b"))
    tables.write_pixels(px, path, tile=8)
    box = tables.scan_pixels(spark, path, (2, 5, 3, 9), ["b"])
    plan = box._jdf.queryExecution().toString()
    assert box.count() == 18 and "GreaterThanOrEqual(y,2)" in plan and "ReadSchema: struct<y:int,x:int,b:double>" in plan


def test_quality_scores_join_by_patch(spark):
    p = spark.createDataFrame([(3,), (7,)], "patch_id int")
    s = spark.createDataFrame([(7, 0.5)], "patch_id int, quality_score double")
    assert {tuple(r) for r in summary.with_scores(p, s).collect()} == {(3, None), (7, 0.5)}


def test_density_is_in_square_millimetres(spark):
    px = spark.createDataFrame([(0, 0, x, 1 if x < 4 else 0) for x in range(10)], "patch_id int, y int, x int, cell_matched long")
    r = summary.quality_map(px, ["patch_id"], mpp=0.5).first()
    assert round(r.cell_density) == 400_000 and r.mean_cell_area == 4


def test_rules_skip_unknown_columns_and_missing_values_fail(spark):
    df = spark.createDataFrame([(1, 5.0), (2, float("nan")), (3, None), (4, 50.0)], "cell_mask_id int, area double")
    kept = qc.filter_cells(df, {"area": {"min": 1, "max": 10}, "other": {"min": 1}})
    assert [r.cell_mask_id for r in kept.collect()] == [1]


def test_stream_gives_the_batch_answer(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    px = spark.range(1000).select((F.col("id") % 3).cast("int").alias("patch_id"), F.col("id").cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("b"))
    px.repartition(4).write.parquet(f"{root}/in")
    stats = qc.patch_statistics(pixel_stream(spark, f"{root}/in", px.schema, 1), "a", "b")
    write_complete(stats, f"{root}/out", f"{root}/ck").awaitTermination()
    got = {r.patch_id: (r.nucleus_mean, r.wholecell_non_zero_perc) for r in spark.read.parquet(f"{root}/out").collect()}
    want = {r.patch_id: (r.nucleus_mean, r.wholecell_non_zero_perc) for r in qc.patch_statistics(px, "a", "b").collect()}
    assert got == want


def test_export_round_trip(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    df = spark.createDataFrame([("1", "m", 0.01, 2.0), ("1", "n", 0.01, 0.5), ("2", "m", 0.9, 3.0)], "cluster string, feature string, p_value_corrected double, fold_change_raw double")
    sinks.marker_export(df, root)
    tops = {r.cluster: (r.positive, r.negative) for r in spark.read.json(f"{root}/top_markers").collect()}
    assert tops == {"1": (["m"], ["n"])}
