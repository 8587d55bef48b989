"""Incremental snapshot ingestion with Structured Streaming (SRC1, SRC5, SNK1).

Each run reads only files not seen before (the file source's checkpoint),
decodes them, and lands the rows in the bronze table partitioned by UTC feed
date. ``availableNow`` processes everything pending in bounded micro-batches
and stops, like a scheduled batch job. Landing is idempotent: a batch drops
rows whose (feed_timestamp, entity_id) is already in the table, so a batch
replayed after a failure, or a snapshot delivered twice, lands once. Which
snapshots have landed is the state of the stream, a narrow table with a row for
each: the positions themselves are looked at only for snapshots that come again, so
what a batch reads does not grow with the rows of its day. A store that has both
tables under one pointer (``daily.open_store``) lands a batch wholly or not at
all. Files that cannot be landed go to the rejects table, once each, and stop nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow import schemas
from streetflow.operators.positions import land_if_absent
from streetflow.sources import snapshots as SN
from streetflow.plans.tables import TableStore

KEYS = ["feed_timestamp", "entity_id"]


def snapshot_stream(spark: SparkSession, raw_dir: str, glob: str = "*.json", max_files: int = 1000) -> DataFrame:
    """New snapshot files under ``raw_dir`` (any depth) as a stream of
    (path, modificationTime, length, content). The schema is explicit, as a
    binary file stream requires."""
    return (
        spark.readStream.format("binaryFile")
        .schema(schemas.BINARY_FILE)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(raw_dir)
    )


def _landed(store: TableStore, table: str, snapshots: str, rows: DataFrame) -> DataFrame | None:
    """Keys of landed rows that ``rows`` may repeat. The narrow table of landed
    snapshots tells which of the batch's snapshots are landed: mostly none. Only
    for those that are, the positions are read, by the pushed-down range of their times."""
    if not store.exists(snapshots):
        return None
    dates = [r[0] for r in rows.select("date").distinct().collect()]  # days in this batch
    known = store.read(snapshots).where(F.col("date").isin(dates)).select("feed_timestamp")
    again = rows.select("date", "feed_timestamp").distinct().join(known, "feed_timestamp", "left_semi").groupBy("date").agg(
        F.min("feed_timestamp").alias("low"), F.max("feed_timestamp").alias("high")).collect()  # a row for each day
    if not again:
        return None
    landed = store.read(table).where(F.col("date").isin([r["date"] for r in again]) & F.col("feed_timestamp").between(
        F.lit(min(r["low"] for r in again)), F.lit(max(r["high"] for r in again))))
    return landed.select(*KEYS)


def _lander(store: TableStore, table: str, snapshots: str, rejects: str | None, decode,
            on_missing_header: str):
    def land(batch: DataFrame, batch_id: int) -> None:
        # parsed once, used for the rows, the day lookup and the rejects; lost
        # blocks are recomputed from the batch's files
        if decode is None:
            parsed = SN.messages(batch).select("source_file", "delivered", "msg").persist()
            rows = SN.to_bronze(SN.entities(parsed, on_missing_header))
            bad = SN.rejects(parsed, on_missing_header)
        else:
            parsed = decode(batch).persist()
            rows, bad = SN.to_bronze(parsed), None
            if "reject" in parsed.columns:
                rows = SN.to_bronze(parsed.where("reject is null"))
                bad = parsed.where("reject is not null").select("source_file", F.col("reject").alias("reason"))
        fresh = land_if_absent(rows, _landed(store, table, snapshots, rows), KEYS).drop("delivered")
        landing = {table: store.appended(table, fresh, ["date"])}
        seen = rows.select("feed_timestamp", "date").distinct()
        if store.exists(snapshots):
            seen = seen.join(store.read(snapshots), ["feed_timestamp", "date"], "left_anti")
        landing[snapshots] = store.appended(snapshots, seen, ["date"])
        if rejects is not None and bad is not None:
            # a replayed batch replaces its own rejects
            landing[rejects] = store.replaced(rejects, bad.withColumn("batch_id", F.lit(batch_id)), ["batch_id"])
        store.commit(landing)  # positions and landed snapshots in one step
        parsed.unpersist()

    return land


def ingest(spark: SparkSession, raw_dir: str, store: TableStore, checkpoint: str, table: str = "bronze_positions",
           rejects: str | None = "bronze_rejects", glob: str = "*.json", timeout_s: float | None = None,
           decoder=None, snapshots: str = "landed_snapshots", on_missing_header: str = "null") -> None:
    """Run one ``availableNow`` pass: land every file not seen before, then stop.

    ``decoder(files) -> decoded entities``, as ``snapshots.decode_with`` gives
    them; JSON by default, where a snapshot without header time is rejected, or, with
    ``on_missing_header="max"``, takes its newest vehicle's. Blocks until the pass
    ends, or ``timeout_s`` if given."""
    files = snapshot_stream(spark, raw_dir, glob)
    q = (
        files.writeStream.foreachBatch(_lander(store, table, snapshots, rejects, decoder, on_missing_header))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("snapshot ingestion did not finish in time")
    if q.exception() is not None:
        raise q.exception()
