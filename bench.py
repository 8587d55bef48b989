"""Benchmark: the whole daily job at $BENCH_SF_DIR on local[$BENCH_CPUS].

Stages run in the job's order on a fresh table store, each reading the tables
the previous ones wrote; every stage ends with a write (or, for the serving
queries, a collect of the small map views). Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from streetflow.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="streetflow-bench")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="streetflow-bench-"))

    from pyspark.sql import functions as F

    from streetflow.operators import serving as SV
    from streetflow.operators import speed as SP
    from streetflow.plans import daily
    from streetflow.plans import views as V
    from streetflow.session import scratch_dir
    from streetflow.sources import fixtures as fx
    from streetflow.sources import snapshots as SN
    from streetflow.streaming.ingest import ingest

    store = daily.open_store(spark, scratch_dir(spark, "bench"))
    store.create_schema()
    today = dt.date(2024, 4, 6)
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
        return out

    # warm-up: JVM, Python workers, codegen of common expressions
    spark.range(1000).selectExpr("sum(id)").collect()

    # input preparation, not timed: the collector's snapshot files
    raw = store.path("raw")
    SN.snapshot_messages(fx.positions(spark, sf_dir)).write.partitionBy("date", "hour").text(raw)
    n_pos = spark.read.text(raw).count()

    timed("ingest", lambda: ingest(spark, raw, store, store.path("_checkpoint"), glob="*.txt"))
    timed("route_hour_speed", lambda: SP.route_hour_speed(
        V._fresh_segments(store.read(daily.BRONZE))).collect())
    timed("segments", lambda: daily.segments_job(store, today))
    timed("streets", lambda: daily.load_streets(store, fx.ways(spark, sf_dir)))
    timed("lines", lambda: daily.lines_job(store, V.release_files(spark, sf_dir), fx.shapes(spark, sf_dir),
                                           fx.trips(spark, sf_dir), today))
    timed("segment_streets", lambda: daily.segment_streets_job(store, today))
    timed("gold", lambda: daily.gold_job(store, today, export_to=store.path("export"), enforce_checks=False))

    def serving():
        exported = daily.open_export(spark, store.path("export"))
        speed, geo = exported.read(daily.SPEED), exported.read(daily.GEOMETRY)
        view = SV.load(speed, geo).cache()
        slot = SV.nearest_slot(speed, dt.datetime(2024, 4, 2, 10)).first()
        if slot is None:
            return 0
        dow_name = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"][slot["dow"]]
        sel = SV.select_slot(view, dow_name, int(slot["hour_rome"])).collect()
        SV.legend_totals(view.where((F.col("dow") == slot["dow"]) & (F.col("hour_rome") == slot["hour_rome"]))).collect()
        SV.street_table(view.where((F.col("dow") == slot["dow"]) & (F.col("hour_rome") == slot["hour_rome"]))).collect()
        view.unpersist()
        return len(sel)

    timed("serving", serving)

    job = ["ingest", "segments", "lines", "segment_streets", "gold"]
    total = round(sum(times[k] for k in job), 3)
    segs = store.read(daily.SEGMENTS).count()
    snapped = store.read(daily.SEGMENT_STREETS).count()
    positions = store.read(daily.BRONZE).count()
    try:
        sf = float(sf_dir.rstrip("/").split("sf")[-1])
    except ValueError:
        sf = sf_dir
    print(json.dumps({
        "metric": "daily_job_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "positions": positions,
        "snapshot_lines": n_pos,
        "positions_per_s": round(positions / total, 1) if total else None,
        "segments": segs,
        "snapped_segments": snapped,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
