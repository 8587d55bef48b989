"""Schedule releases: one zip per day, ``date=YYYY-MM-DD`` directories (SRC8-SRC10, GN1).

The release scan keeps the partition date as ``static_date``; selecting only
``static_date, length`` never reads the file contents. Members are CSV files
(shapes.txt, trips.txt) read per release file in chunks and put out column by
column (``mapInArrow``): a zip cannot be split, so one release is one unit of
work, and releases are decoded in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow import schemas

SHAPES_MEMBER = "shapes.txt"
TRIPS_MEMBER = "trips.txt"


def scan_releases(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Release files as (static_date, length, content) (SRC8)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(F.col("date").cast("date").alias("static_date"), "length", "content")


def release_sizes(releases: DataFrame) -> DataFrame:
    """Metadata only: (static_date, length) summed over a release's files; the
    content column is pruned."""
    return releases.groupBy("static_date").agg(F.sum("length").alias("length"))


#: Bytes of CSV that a reader holds at a time.
CHUNK_BYTES = 4 << 20


def _columns(member: str, content: bytes, types: dict):
    """Record batches of a member's named columns, read in chunks; a column that
    the file lacks is NULL."""
    import io
    import zipfile

    from pyarrow import csv

    with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(member) as f:
        yield from csv.open_csv(
            f, read_options=csv.ReadOptions(block_size=CHUNK_BYTES),
            convert_options=csv.ConvertOptions(column_types=types, include_columns=list(types),
                                               include_missing_columns=True, strings_can_be_null=True))


def decode_releases(releases: DataFrame) -> DataFrame:
    """Both members of every release file, each file opened once: (member,
    static_date, shape_id, seq, lat, lon, trip_id), columns of the other member
    NULL."""

    def run(batches):
        import pyarrow as pa

        members = {
            SHAPES_MEMBER: {"shape_id": pa.string(), "shape_pt_sequence": pa.int32(), "shape_pt_lat": pa.float64(),
                            "shape_pt_lon": pa.float64()},
            TRIPS_MEMBER: {"trip_id": pa.string(), "shape_id": pa.string()}}
        for batch in batches:
            for day, content in zip(batch.column(0), batch.column(1)):
                data = content.as_py()
                for member, types in members.items():
                    for part in _columns(member, data, types):
                        n = part.num_rows
                        held = dict(zip(types, part.columns))
                        get = lambda c, t: held.get(c, pa.nulls(n, t))  # noqa: E731, B023
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([member] * n), pa.array([day.as_py()] * n, pa.date32()),
                             get("shape_id", pa.string()), get("shape_pt_sequence", pa.int32()),
                             get("shape_pt_lat", pa.float64()), get("shape_pt_lon", pa.float64()),
                             get("trip_id", pa.string())],
                            names=["member", "static_date", "shape_id", "seq", "lat", "lon", "trip_id"])

    return releases.select("static_date", "content").mapInArrow(
        run, "member string, static_date date, shape_id string, seq int, lat double, lon double, trip_id string")


def shape_rows(decoded: DataFrame) -> DataFrame:
    """Route-line points (SRC9): static_date, shape_id, seq, lat, lon."""
    return decoded.where(F.col("member") == SHAPES_MEMBER).select(*schemas.SHAPE_POINTS.names)


def trip_rows(decoded: DataFrame) -> DataFrame:
    """Trips with their route line (SRC10); a trip without one is dropped."""
    return decoded.where((F.col("member") == TRIPS_MEMBER) & (F.col("shape_id") != "")).select(*schemas.TRIPS.names)


def decode_shapes(releases: DataFrame) -> DataFrame:
    """Route-line points of every release (SRC9, UDF2)."""
    return shape_rows(decode_releases(releases))


def decode_trips(releases: DataFrame) -> DataFrame:
    """Trips with their route line of every release (SRC10, UDF3)."""
    return trip_rows(decode_releases(releases))


def pack_releases(points: DataFrame, trips: DataFrame) -> DataFrame:
    """Build release zips from decoded tables (the publisher's side, used to
    make fixtures): (static_date, part, length, content). A release is written
    as one zip per input partition, so no group exceeds one partition's rows;
    decoding reads every part. CSVs carry a BOM."""
    from pyspark.sql.types import BinaryType, DateType, LongType, StructField, StructType

    rows = points.select("static_date", F.lit("s").alias("kind"),
                         F.format_string("%s,%d,%s,%s", "shape_id", "seq", F.col("lat").cast("string"),
                                         F.col("lon").cast("string")).alias("line")).unionByName(
        trips.select("static_date", F.lit("t").alias("kind"),
                     F.concat_ws(",", "trip_id", F.coalesce("shape_id", F.lit(""))).alias("line")))
    out_schema = StructType([StructField("static_date", DateType()), StructField("part", LongType()),
                             StructField("length", LongType()), StructField("content", BinaryType())])
    rows = rows.withColumn("part", F.spark_partition_id().cast("long"))

    def pack(pdf):
        import io
        import zipfile

        import pandas as pd

        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            s = pdf[pdf["kind"] == "s"]["line"].tolist()
            t = pdf[pdf["kind"] == "t"]["line"].tolist()
            z.writestr(SHAPES_MEMBER, ("﻿shape_id,shape_pt_sequence,shape_pt_lat,shape_pt_lon\n"
                                       + "\n".join(s) + "\n").encode("utf-8"))
            z.writestr(TRIPS_MEMBER, ("﻿trip_id,shape_id\n" + "\n".join(t) + "\n").encode("utf-8"))
        data = buf.getvalue()
        return pd.DataFrame({"static_date": [pdf["static_date"].iloc[0]], "part": [pdf["part"].iloc[0]],
                             "length": [len(data)], "content": [data]})

    return rows.groupBy("static_date", "part").applyInPandas(pack, out_schema)
