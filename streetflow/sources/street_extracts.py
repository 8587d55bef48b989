"""Street extracts: JSON documents of map elements, read JVM-side (SRC11).

One file holds one document, ``{"elements": [{"type": "way", "id": ...,
"tags": {...}, "geometry": [{"lat": ..., "lon": ...}, ...]}, ...]}``, indented or
not. Files are read in parallel; an extract that is cut in tiles may list a way
in several of them (``operators.streets.select_ways`` keeps one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

VERTEX = StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])
EXTRACT = StructType([StructField("elements", ArrayType(StructType([
    StructField("type", StringType()),
    StructField("id", LongType()),
    StructField("tags", MapType(StringType(), StringType())),
    StructField("geometry", ArrayType(VERTEX)),
])))])


def read_ways(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Ways with a geometry: (way_id, tags, geometry). Elements of other types
    and ways without vertices are left out."""
    docs = spark.read.schema(EXTRACT).option("multiLine", "true").option("pathGlobFilter", glob).option(
        "recursiveFileLookup", "true").json(path)
    e = docs.select(F.explode("elements").alias("e")).where(
        "coalesce(e.type, 'way') = 'way' and size(e.geometry) > 0")
    return e.select(F.col("e.id").alias("way_id"), F.coalesce("e.tags", F.create_map().cast("map<string,string>")).alias(
        "tags"), F.col("e.geometry").alias("geometry"))
