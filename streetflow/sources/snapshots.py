"""Vehicle-position snapshots: decoding file bytes into entity rows (SRC2-SRC4).

Default codec: JSON feed messages (one message per line or per file) shaped
like the realtime feed specification -- ``{"header": {"timestamp": ...},
"entity": [{"id": ..., "vehicle": {"trip": {...}, "vehicle": {...},
"position": {...}, ...}}]}`` -- decoded JVM-side with ``from_json``; no Python
worker is involved. A binary codec plugs in through ``decode_with``, which runs
a per-file Python function in Arrow batches with ``mapInPandas`` so decoding
stays distributed over the files.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from streetflow import schemas
from streetflow.operators.positions import snapshot_ts


def _s(*fields):
    return StructType([StructField(n, t) for n, t in fields])


FEED_MESSAGE = _s(
    ("header", _s(("timestamp", LongType()))),
    ("entity", ArrayType(_s(
        ("id", StringType()),
        ("is_deleted", BooleanType()),
        ("vehicle", _s(
            ("trip", _s(("trip_id", StringType()), ("route_id", StringType()), ("direction_id", IntegerType()),
                        ("start_date", StringType()), ("start_time", StringType()),
                        ("schedule_relationship", IntegerType()))),
            ("vehicle", _s(("id", StringType()), ("label", StringType()), ("license_plate", StringType()))),
            ("position", _s(("latitude", DoubleType()), ("longitude", DoubleType()), ("bearing", DoubleType()),
                            ("odometer", DoubleType()), ("speed", DoubleType()))),
            ("stop_id", StringType()),
            ("current_stop_sequence", IntegerType()),
            ("current_status", IntegerType()),
            ("occupancy_status", IntegerType()),
            ("timestamp", LongType()),
        )),
    ))),
)


def messages(files: DataFrame) -> DataFrame:
    """(source_file, delivered, line, msg) for every message of every file.

    A file holds one message a line, or, where no line is a message, one message
    as a whole (indented, say). ``delivered`` is the file's modification time.
    Bytes that are no UTF-8 give one row with NULL line and msg, and so do no
    harm to other files of a batch; empty files and lines give none."""
    text = F.col("content").cast("string")
    delivered = F.col("modificationTime") if "modificationTime" in files.columns else F.lit(None).cast("timestamp")
    parse = lambda x: F.from_json(x, FEED_MESSAGE, {"mode": "PERMISSIVE"})
    is_message = lambda m: m["header"].isNotNull() | m["entity"].isNotNull()
    item = lambda x: F.struct(x.alias("line"), parse(x).alias("msg"))
    read = files.select(F.col("path").alias("source_file"), delivered.alias("delivered"),
                        F.when(F.is_valid_utf8(text), text).alias("_text"))
    read = read.where(F.col("_text").isNull() | (F.length(F.trim(F.regexp_replace("_text", r"\s", ""))) > 0))
    lines = read.withColumn("_lines", F.transform(
        F.filter(F.split("_text", "\n"), lambda x: F.length(F.trim(x)) > 0), item))
    by_line = F.coalesce(F.exists("_lines", lambda x: is_message(x["msg"])), F.lit(False))
    return lines.select("source_file", "delivered", F.inline(
        F.when(by_line, F.col("_lines")).otherwise(F.array(item(F.col("_text"))))))


def _time_of(msg: str, on_missing_header: str) -> Column:
    """Epoch of a message (SRC4)."""
    return snapshot_ts(F.col(f"{msg}.header.timestamp"),
                       F.array_max(F.transform(f"{msg}.entity", lambda e: e["vehicle"]["timestamp"])), on_missing_header)


def decode_json(files: DataFrame, on_missing_header: str = "null") -> DataFrame:
    """Binary files (path, content) -> one row per vehicle entity in the
    ``SNAPSHOT_ENTITY`` columns plus ``source_file`` (SRC2). Entities without a
    vehicle are skipped; unset fields stay NULL."""
    return entities(messages(files), on_missing_header)


def entities(msgs: DataFrame, on_missing_header: str = "null") -> DataFrame:
    """Parsed messages -> entity rows (see ``decode_json``), those of messages
    without a usable time left out (they are rejects)."""
    msgs = msgs.where(F.col("msg.header").isNotNull() | F.col("msg.entity").isNotNull())
    ents = msgs.select("source_file", "delivered", _time_of("msg", on_missing_header).alias("_feed_ts"),
                       F.explode("msg.entity").alias("e")).where("e.vehicle is not null and _feed_ts is not null")
    v = "e.vehicle"
    return ents.select(
        "source_file",
        "delivered",
        F.col("_feed_ts").alias("feed_timestamp"),
        F.col("e.id").alias("entity_id"),
        F.col("e.is_deleted").alias("is_deleted"),
        *[F.col(f"{v}.trip.{c}").alias(c) for c in
          ("trip_id", "route_id", "direction_id", "start_date", "start_time", "schedule_relationship")],
        F.col(f"{v}.vehicle.id").alias("vehicle_id"),
        F.col(f"{v}.vehicle.label").alias("vehicle_label"),
        F.col(f"{v}.vehicle.license_plate").alias("license_plate"),
        *[F.col(f"{v}.position.{c}").alias(c) for c in ("latitude", "longitude", "bearing", "odometer", "speed")],
        *[F.col(f"{v}.{c}").alias(c) for c in ("stop_id", "current_stop_sequence", "current_status",
                                               "occupancy_status")],
        F.col(f"{v}.timestamp").alias("vehicle_timestamp"),
    )


def rejects_json(files: DataFrame, on_missing_header: str = "null") -> DataFrame:
    """Snapshots that cannot be landed (SRC4): malformed text, no vehicle entity
    at all, or no usable time. One row per bad message: (source_file, reason)."""
    return rejects(messages(files), on_missing_header)


def rejects(msgs: DataFrame, on_missing_header: str = "null") -> DataFrame:
    """Parsed messages -> rejected ones (see ``rejects_json``)."""
    bad = F.col("msg.header").isNull() & F.col("msg.entity").isNull()
    empty = ~F.exists(F.coalesce(F.col("msg.entity"), F.array().cast(FEED_MESSAGE["entity"].dataType)),
                      lambda e: e["vehicle"].isNotNull())
    return msgs.where(bad | empty | _time_of("msg", on_missing_header).isNull()).select(
        "source_file", F.when(bad, F.lit("malformed")).when(empty, F.lit("no vehicles"))
        .otherwise(F.lit("no time")).alias("reason")
    )


#: Entities that a decoder's task holds at a time.
_CHUNK = 10_000
#: Bytes of a file's decoded entities that stay in memory until the file is through.
_SPOOL = 8 << 20


def _decoded(content: bytes, decode: Callable[[bytes], Iterable[dict]], names: list[str],
             on_missing_header: str) -> Iterator[list[list]]:
    """Rows of one snapshot file in chunks, each of ``names`` and the reason of a
    reject. Nothing comes out before the whole file is through, so that a bad file lands
    nothing; until then its rows wait on the task's disk, not in its memory."""
    import pickle
    import tempfile

    feed, vehicle = names.index("feed_timestamp"), names.index("vehicle_timestamp")
    chunks, newest, missing = 0, None, False
    reject = lambda why: [[*[None] * len(names), why]]
    with tempfile.SpooledTemporaryFile(max_size=_SPOOL) as spool:
        entities = None
        while True:
            try:
                entities = iter(decode(content)) if entities is None else entities
                some = list(itertools.islice(entities, _CHUNK))
            except Exception as e:  # noqa: BLE001 - any codec error rejects its file
                yield reject(f"malformed: {type(e).__name__}")
                return
            if not some:
                break
            rows = [[e.get(n) for n in names] + [None] for e in some]
            del some
            newest = max((t for t in (newest, *(r[vehicle] for r in rows)) if t is not None), default=None)
            missing = missing or any(r[feed] is None for r in rows)
            pickle.dump(rows, spool, protocol=pickle.HIGHEST_PROTOCOL)
            chunks += 1
            del rows
        stand_in = newest if on_missing_header == "max" else None
        if not chunks or (missing and stand_in is None):
            yield reject("no time" if chunks else "no vehicles")
            return
        spool.seek(0)
        for _ in range(chunks):
            rows = pickle.load(spool)
            for r in rows if missing else ():
                if r[feed] is None:
                    r[feed] = stand_in
            yield rows


def decode_with(files: DataFrame, decode: Callable[[bytes], Iterable[dict]], on_missing_header: str = "null") -> DataFrame:
    """(UDF1) Run a per-file Python decoder (e.g. a protocol-buffer codec) over the
    files in Arrow batches. ``decode(content)`` yields dicts keyed by the
    ``SNAPSHOT_ENTITY`` field names; missing keys become NULL. With
    ``on_missing_header="max"`` a snapshot without header time takes its newest
    vehicle time (SRC4). Of a file that the decoder
    fails on, or that gives no entity or no time, one row comes out, with
    ``reject`` telling why and all else NULL; elsewhere ``reject`` is NULL.
    A task holds the contents of a batch of files and ``_CHUNK`` decoded entities,
    if the decoder yields them one by one.
    """
    names = [f.name for f in schemas.SNAPSHOT_ENTITY.fields]
    fields = ([StructField("source_file", StringType())] + list(schemas.SNAPSHOT_ENTITY.fields)
              + [StructField("reject", StringType())])

    def run(batches):
        import pandas as pd

        columns = [f.name for f in fields]

        def frame(rows):
            return pd.DataFrame(rows, columns=columns).astype(object).where(lambda x: x.notna(), None)

        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                for rows in _decoded(bytes(content), decode, names, on_missing_header):
                    yield frame([[path, *r] for r in rows])

    out = files.select("path", "content").mapInPandas(run, StructType(fields))
    if "modificationTime" not in files.columns:
        return out.withColumn("delivered", F.lit(None).cast("timestamp"))
    times = files.select(F.col("path").alias("source_file"), F.col("modificationTime").alias("delivered"))
    return out.join(times, "source_file")


def to_bronze(decoded: DataFrame) -> DataFrame:
    """Decoded entities -> ``vehicle_positions`` rows: epochs become
    timestamps, ``date`` is the UTC date of the feed time (SRC3)."""
    out = (
        decoded.withColumn("feed_timestamp", F.timestamp_seconds("feed_timestamp"))
        .withColumn("vehicle_timestamp", F.timestamp_seconds("vehicle_timestamp"))
        .withColumn("date", F.to_date("feed_timestamp"))
        .withColumn("ingested_at", F.current_timestamp())
    )
    extra = [c for c in ("delivered",) if c in decoded.columns]
    return out.select(*[f.name for f in schemas.VEHICLE_POSITIONS.fields], *extra)


def snapshot_messages(positions: DataFrame) -> DataFrame:
    """Bronze-shaped rows -> JSON feed messages (the collector's output), with
    ``date``/``hour`` of the feed time for the landing layout (SRC6)."""
    ent = F.struct(
        F.col("entity_id").alias("id"),
        F.col("is_deleted").alias("is_deleted"),
        F.struct(
            F.struct(*[F.col(c) for c in ("trip_id", "route_id", "direction_id", "start_date", "start_time",
                                          "schedule_relationship")]).alias("trip"),
            F.struct(F.col("vehicle_id").alias("id"), F.col("vehicle_label").alias("label"),
                     F.col("license_plate")).alias("vehicle"),
            F.struct(*[F.col(c) for c in ("latitude", "longitude", "bearing", "odometer", "speed")]).alias("position"),
            *[F.col(c) for c in ("stop_id", "current_stop_sequence", "current_status", "occupancy_status")],
            F.unix_seconds("vehicle_timestamp").alias("timestamp"),
        ).alias("vehicle"),
    )
    # one message per snapshot and input partition: a group never exceeds one
    # partition's rows, however many vehicles share a feed time
    snap = (
        positions.withColumn("_part", F.spark_partition_id())
        .groupBy("source_file", "feed_timestamp", "_part")
        .agg(F.collect_list(ent).alias("entity"))
    )
    msg = F.struct(F.struct(F.unix_seconds("feed_timestamp").alias("timestamp")).alias("header"), "entity")
    return snap.select(
        F.to_json(msg).alias("value"),
        F.date_format("feed_timestamp", "yyyy-MM-dd").alias("date"),
        F.date_format("feed_timestamp", "HH").alias("hour"),
    )
