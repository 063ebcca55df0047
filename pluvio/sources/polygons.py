"""Catchment polygons from GeoJSON.

Newline-delimited GeoJSON (one Feature per line) is the scalable form: the
file splits across tasks.  A FeatureCollection document is one JSON value
and is read with ``multiLine`` (fine for small files; at scale convert it
once to feature-per-line).  Polygon and MultiPolygon geometries are both
brought to the MultiPolygon nesting ``parts -> rings -> [x, y] points``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MULTI = "array<array<array<array<double>>>>"
POLY = "array<array<array<double>>>"

FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),   # raw JSON, typed below
    ])),
])


def _typed_geometry(geom_type, coords_text):
    return (F.when(geom_type == "MultiPolygon", F.from_json(coords_text, MULTI))
            .when(geom_type == "Polygon", F.array(F.from_json(coords_text, POLY))))


def read_geojson(spark: SparkSession, path: str, region: str | None = None,
                 collection: bool = False, id_prop: str = "cat_id") -> DataFrame:
    """Polygons -> ``region, cat_id, props map, coordinates (MultiPolygon)``."""
    if collection:
        schema = T.StructType([T.StructField("type", T.StringType()),
                               T.StructField("features", T.ArrayType(FEATURE_SCHEMA))])
        doc = spark.read.schema(schema).option("multiLine", True).json(path)
        feats = doc.select(F.explode("features").alias("f")).select("f.*")
    else:
        feats = spark.read.schema(FEATURE_SCHEMA).json(path)
    out = feats.select(
        F.col("properties").alias("props"),
        _typed_geometry(F.col("geometry.type"), F.col("geometry.coordinates")).alias("coordinates"))
    out = out.withColumn("cat_id", F.col("props")[id_prop].cast("double").cast("bigint"))
    if region is not None:
        out = out.withColumn("region", F.lit(region))
    elif "region" not in out.columns:
        out = out.withColumn("region", F.col("props")["region"])
    return out.select("region", "cat_id", "props", "coordinates")


def to_feature_lines(polygons: DataFrame, id_prop: str = "cat_id") -> DataFrame:
    """Polygons (``props``, ``geometry``) -> one GeoJSON Feature text per row."""
    props = F.map_concat(F.col("props"), F.create_map(F.lit(id_prop), F.col("cat_id").cast("string")))
    feat = F.struct(F.lit("Feature").alias("type"), props.alias("properties"),
                    F.col("geometry").alias("geometry"))
    return polygons.select(F.to_json(feat).alias("value"))


def polygon_edges(polys: DataFrame, coords: str = "coordinates") -> DataFrame:
    """Polygons -> ``region, cat_id, part, ring, seq, x1, y1, x2, y2``.

    Rings that are not closed get their closing edge.
    """
    p = polys.select("region", "cat_id", F.posexplode(coords).alias("part", "rings"))
    r = p.select("region", "cat_id", "part", F.posexplode("rings").alias("ring", "pts"))
    closed = F.when(F.col("pts")[0] == F.element_at("pts", -1), F.col("pts")) \
        .otherwise(F.concat(F.col("pts"), F.array(F.col("pts")[0])))
    r = r.withColumn("pts", closed).withColumn("n", F.size("pts"))
    pairs = F.arrays_zip(F.slice("pts", 1, F.col("n") - 1).alias("a"),
                         F.slice("pts", 2, F.col("n") - 1).alias("b"))
    e = r.select("region", "cat_id", "part", "ring", F.posexplode(pairs).alias("seq", "ab"))
    return e.select("region", "cat_id", "part", "ring", "seq",
                    F.col("ab.a")[0].alias("x1"), F.col("ab.a")[1].alias("y1"),
                    F.col("ab.b")[0].alias("x2"), F.col("ab.b")[1].alias("y2"))


def properties(polys: DataFrame, names: list[str]) -> DataFrame:
    """feature properties only (geometry dropped)."""
    return polys.select("region", "cat_id", *[F.col("props")[n].alias(n) for n in names])
