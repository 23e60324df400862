"""JSON and XML documents: annotations, labelled regions, channel names and image metadata.

Each parser takes (file, text) rows, so a folder of documents is one distributed scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tissuegrid.functions.text import safe_label

RING = "array<array<double>>"
# Property names that may hold a region's label, in order of preference.
LABEL_KEYS = ("name", "Name", "label", "Label", "region", "Region", "class", "Class")


def read_texts(spark: SparkSession, path: str, pattern: str = "*.{json,geojson}") -> DataFrame:
    return spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("text")
    )


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _points(ring: Column, swap: bool) -> Column:
    """Vertices as (y, x); GeoJSON stores x first."""
    a, b = (1, 0) if swap else (0, 1)
    return F.transform(ring, lambda p: F.struct(p[a].alias("y"), p[b].alias("x")))


def _entry(ring: Column, props: Column) -> Column:
    return F.struct(
        ring.alias("ring"),
        _get(props, "$.idx", "string").alias("idx"),
        _get(props, "$.name", "string").alias("name"),
        _get(props, "$.classification.name", "string").alias("class_name"),
    )


def _feature_entries(f: Column) -> Column:
    """Exterior rings of one feature."""
    kind = _get(f, "$.geometry.type", "string")
    single = F.slice(_get(f, "$.geometry.coordinates", f"array<{RING}>"), 1, 1)
    many = F.transform(F.filter(_get(f, "$.geometry.coordinates", f"array<array<{RING}>>"), lambda p: F.size(p) > 0), lambda p: p[0])
    rings = F.when(kind == "Polygon", single).when(kind == "MultiPolygon", many)
    usable = F.filter(F.coalesce(rings, F.array().cast(f"array<{RING}>")), lambda r: F.size(r) >= 3)
    props = _get(f, "$.properties", "variant")
    return F.transform(usable, lambda r: _entry(_points(r, True), props))


def _transposed(c: Column) -> Column:
    """Two rows of n numbers as n pairs."""
    return F.when(F.forall(c, lambda p: F.size(p) == 2), c).when(
        F.size(c) == 2, F.transform(F.arrays_zip(c[0].alias("a"), c[1].alias("b")), lambda z: F.array(z["a"], z["b"]))
    )


def _shape_entries(s: Column) -> Column:
    """Polygon of one shape: named coordinates, a bare list, or the first list among its values."""
    found = F.coalesce(
        *[_get(s, f"$.{k}", RING) for k in ("data", "coordinates", "points")],
        _get(s, "$", RING),
        F.filter(F.transform(F.map_values(_get(s, "$", "map<string,variant>")), lambda v: _get(v, "$", RING)), lambda r: r.isNotNull())[0],
    )
    ring = _transposed(found)
    ok = F.coalesce(F.size(ring) >= 3, F.lit(False))
    entry = _entry(_points(ring, False), _get(s, "$.properties", "variant"))
    return F.when(ok, F.array(entry)).otherwise(F.slice(F.array(entry), 1, 0))


def annotations(docs: DataFrame) -> DataFrame:
    """(file, pos, ring, idx, name, class_name) polygons of at least three vertices.

    Understands feature collections, shape lists, and objects with shapes, data or plain values. A
    document whose polygons all carry a numeric idx is put in that order.
    """
    parsed = docs.select("file", F.try_parse_json("text").alias("doc")).where(F.col("doc").isNotNull())
    d = F.col("doc")
    is_collection = F.coalesce(_get(d, "$.type", "string") == "FeatureCollection", F.lit(False))
    features = F.when(is_collection, _get(d, "$.features", "array<variant>"))
    shapes = F.coalesce(
        _get(d, "$.shapes", "array<variant>"), _get(d, "$.data", "array<variant>"), _get(d, "$", "array<variant>"),
        F.map_values(_get(d, "$", "map<string,variant>")),
    )
    entries = F.when(features.isNotNull(), F.flatten(F.transform(features, _feature_entries))).otherwise(
        F.flatten(F.transform(shapes, _shape_entries))
    )
    listed = parsed.select("file", entries.alias("es")).where(F.size("es") > 0)
    keyed = F.transform("es", lambda e, i: F.struct(e["idx"].try_cast("double").alias("k"), i.alias("i"), e.alias("e")))
    ordered = F.when(
        F.forall("es", lambda e: e["idx"].try_cast("double").isNotNull()), F.array_sort(keyed)
    ).otherwise(keyed)
    return listed.select("file", F.posexplode(ordered).alias("pos", "s")).select(
        "file", "pos", "s.e.ring", "s.e.idx", "s.e.name", "s.e.class_name"
    )


def annotation_directory(docs: DataFrame) -> DataFrame:
    """Polygons of all documents; the label is the file stem, numbered when a file holds several."""
    polygons = annotations(docs)
    counts = polygons.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
    stem = F.split_part("file", F.lit("."), F.lit(1))
    label = F.when(F.col("_n") == 1, stem).otherwise(F.concat_ws("_", stem, (F.col("pos") + 1).cast("string")))
    return polygons.join(counts, "file").select("file", "pos", label.alias("label"), "ring", F.col("file").alias("source_file"))


def with_region_label(polygons: DataFrame) -> DataFrame:
    return polygons.withColumn("label", safe_label(F.col("idx"), F.col("name"), F.col("class_name"), F.col("pos")))


def polygon_csv(vertices: DataFrame) -> DataFrame:
    """(index, ring) from vertex rows index, pos, axis-0, axis-1; polygons of fewer than three points are dropped."""
    point = F.struct(F.col("pos"), F.col("axis-0").alias("y"), F.col("axis-1").alias("x"))
    grouped = vertices.groupBy("index").agg(F.array_sort(F.collect_list(point)).alias("_p"))
    ring = F.transform("_p", lambda p: F.struct(p["y"].cast("double").alias("y"), p["x"].cast("double").alias("x")))
    return grouped.where(F.size("_p") >= 3).select("index", ring.alias("ring"))


def labelled_regions(docs: DataFrame) -> DataFrame:
    """(file, label, rings): labelled polygons with their holes, from a collection, one feature or a list."""
    d = F.col("doc")
    kind = _get(d, "$.type", "string")
    features = (
        F.when(kind == "FeatureCollection", _get(d, "$.features", "array<variant>"))
        .when(kind == "Feature", F.array(d))
        .otherwise(_get(d, "$", "array<variant>"))
    )
    parsed = docs.select("file", F.try_parse_json("text").alias("doc"))
    each = parsed.select("file", F.explode(features).alias("f"))
    f = F.col("f")
    label = F.coalesce(_get(f, "$.properties.classification.name", "string"), *[_get(f, f"$.properties.{k}", "string") for k in LABEL_KEYS])
    shape = _get(f, "$.geometry.type", "string")
    one = F.array(_get(f, "$.geometry.coordinates", f"array<{RING}>"))
    many = _get(f, "$.geometry.coordinates", f"array<array<{RING}>>")
    parts = F.when(shape == "Polygon", one).when(shape == "MultiPolygon", many)
    rows = each.select("file", label.alias("label"), F.explode(parts).alias("p")).where("label IS NOT NULL AND label <> '' AND p IS NOT NULL")
    return rows.select("file", "label", F.transform("p", lambda r: _points(r, True)).alias("rings"))


def channel_names(docs: DataFrame) -> DataFrame:
    """(file, version, channel_id, antibody_name, channel_idx) of the first image of an OME document."""
    schema = "Image array<struct<_ID string, Pixels struct<Channel array<struct<_ID string, _Name string>>>>>"
    images = docs.select("file", F.from_xml("text", schema).alias("d")).select("file", F.explode("d.Image").alias("i"))
    first = images.where(F.col("i._ID") == "Image:0")
    each = first.select("file", F.posexplode("i.Pixels.Channel").alias("channel_idx", "c"))
    return each.select("file", F.lit(2).alias("version"), F.col("c._ID").alias("channel_id"), F.col("c._Name").alias("antibody_name"), "channel_idx")


def image_channels(docs: DataFrame) -> DataFrame:
    """(image_id, CHANNELS map) from lists of image records."""
    schema = "array<struct<image_id string, CHANNELS map<string,string>>>"
    return docs.select(F.explode(F.from_json("text", schema)).alias("r")).select("r.image_id", "r.CHANNELS")
