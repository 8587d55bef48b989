import datetime as dt

from pyspark.sql import functions as F

from streetflow import schemas

T0 = 1711900000  # 2024-03-31 15:46:40 UTC


def positions(spark, rows):
    """rows: dicts with vehicle_id, vts (epoch), fts (epoch), lat, lon, trip, entity (optional)."""
    data = []
    for i, r in enumerate(rows):
        data.append((
            r.get("source", "f"), r.get("fts"), r.get("entity", f"e{i:04d}"), r.get("trip", "A"), "R1",
            r.get("vehicle_id", "V1"), r.get("lat", 41.9), r.get("lon", 12.5), r.get("vts"),
        ))
    df = spark.createDataFrame(
        data,
        "source_file string, fts long, entity_id string, trip_id string, route_id string, vehicle_id string, "
        "latitude double, longitude double, vts long",
    )
    cols = {
        "feed_timestamp": F.timestamp_seconds("fts"),
        "vehicle_timestamp": F.timestamp_seconds("vts"),
        "date": F.to_date(F.timestamp_seconds("fts")),
        "ingested_at": F.current_timestamp(),
    }
    out = []
    for f in schemas.VEHICLE_POSITIONS.fields:
        if f.name in cols:
            out.append(cols[f.name].alias(f.name))
        elif f.name in df.columns:
            out.append(F.col(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def d(s):
    return dt.date.fromisoformat(s)
