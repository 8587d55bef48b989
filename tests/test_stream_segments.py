"""Segments of a stream equal those of the batch."""

import random

from pyspark.sql import functions as F

from helpers import T0, positions
from streetflow import schemas
from streetflow.operators import segments as S
from streetflow.streaming.segments import prepare_state, segment_stream

COLS = ["vehicle_id", "trip_id", "from_ts", "to_ts", "duration_s", "distance_m", "speed_kmh", "from_lat", "to_lon",
        "date_rome", "hour_rome"]


def _run(spark, batches, tmp_path, name):
    """Write each batch as a file, in that order, and let the stream read one a time."""
    import time

    src = str(tmp_path / "in")
    for i, b in enumerate(batches):
        positions(spark, b).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.02)
    prepare_state(spark)
    stream = spark.readStream.schema(schemas.VEHICLE_POSITIONS).option("maxFilesPerTrigger", 1).parquet(src)
    q = segment_stream(stream).writeStream.format("memory").queryName(name).outputMode("append").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None and not q.isActive
    state = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    return spark.table(name), state


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_shuffled_arrival_gives_the_batch_segments(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for v in range(6):
        t = T0 + rng.randrange(60)
        for k in range(60):
            t += rng.choice([1, 4, 5, 20, 40, 90, 91, 200])
            for copy in range(rng.choice([1, 1, 2, 3])):
                rows.append(dict(vehicle_id=f"V{v}", vts=t, fts=t + rng.randrange(-20, 121), lat=41.9 + k / 5000 + copy / 1e5,
                                 lon=12.5, trip=rng.choice(["A", "A", "A", "B"]), entity=rng.choice(["x", "y", None]),
                                 source=f"s{copy}"))
    rows.append(dict(vehicle_id="V0", vts=T0 + 10**6, fts=T0 + 500))  # a clock far ahead
    rows.append(dict(vehicle_id="V1", vts=T0, fts=T0 + 500))           # stale: never a fix
    rows.sort(key=lambda r: r["fts"] + rng.randrange(-50, 51))         # order of arrival, within the disorder
    batches = [rows[i:i + 40] for i in range(0, len(rows), 40)]
    expected = _rows(S.vehicle_segments(positions(spark, rows)))
    later = [dict(vehicle_id="Z", vts=T0 + 50_000, fts=T0 + 50_000)], [dict(vehicle_id="Z", vts=T0 + 60_000, fts=T0 + 60_000)]
    got, state = _run(spark, [*batches, *later], tmp_path, "streamed")
    assert len(expected) > 80
    assert _rows(got) == expected
    # what is left: the fixes that are ahead, and the last vehicle's
    assert state <= 8


def test_later_than_the_disorder_is_dropped(spark, tmp_path):
    first = [dict(vehicle_id="V", vts=T0 + 10 * k, fts=T0 + 10 * k, lat=41.9 + k / 10000) for k in range(5)]
    ahead = [dict(vehicle_id="W", vts=T0 + 5000, fts=T0 + 5000)]
    late = [dict(vehicle_id="V", vts=T0 + 15, fts=T0 + 15, lat=41.95)]
    end = [dict(vehicle_id="W", vts=T0 + 9000, fts=T0 + 9000)]
    got, _ = _run(spark, [first, ahead, late, end], tmp_path, "streamed_late")
    assert _rows(got) == _rows(S.vehicle_segments(positions(spark, first)))
    assert got.where(F.col("to_ts") == F.timestamp_seconds(F.lit(T0 + 15))).count() == 0


class _Store:
    """A handle, a map state and a value state in one, which counts calls."""

    def __init__(self):
        self.calls, self.map, self.value, self.timers = 0, {}, None, set()

    def getMapState(self, *_):  # noqa: N802
        return self

    def getValueState(self, *_):  # noqa: N802
        store = self

        class Value:
            exists = staticmethod(lambda: store._call(store.value is not None))
            get = staticmethod(lambda: store._call(store.value))

            @staticmethod
            def update(v):
                store.value = store._call(v)

            @staticmethod
            def clear():
                store.value = store._call(None)

        return Value

    def _call(self, out=None):
        self.calls += 1
        return out

    def containsKey(self, k):  # noqa: N802
        return self._call(k in self.map)

    def getValue(self, k):  # noqa: N802
        return self._call(self.map.get(k))

    def updateValue(self, k, v):  # noqa: N802
        self.map[k] = self._call(v)

    def removeKey(self, k):  # noqa: N802
        self._call(self.map.pop(k))

    def keys(self):
        return iter(self._call(list(self.map)))

    def iterator(self):
        return iter(self._call(list(self.map.items())))

    def registerTimer(self, at):  # noqa: N802
        self._call(self.timers.add(at))


def test_state_calls_do_not_grow_with_fixes():
    """A vehicle's 2,000 fixes of an hour, each twice: a few calls to the state, and all pairs."""
    from types import SimpleNamespace

    from streetflow.config import DEFAULT
    from streetflow.streaming import segments as SS

    store, pair = _Store(), SS.PairFixes(DEFAULT)
    pair.init(store)
    rows = [dict(vehicle_s=T0 + k, feed=T0 + k + copy, entity_id=None, source_file="s", latitude=41.9 + k / 1e6,
                 longitude=12.5, trip_id="A", route_id="R", direction_id=None) for k in range(2000) for copy in (1, 0)]
    at = lambda s: SimpleNamespace(getCurrentWatermarkInMs=lambda: s * 1000)
    assert list(pair.handleInputRows(("V",), iter(rows), at(0))) == []
    first = list(pair.handleExpiredTimer(("V",), at(T0 + 1000 + DEFAULT.max_staleness_s + 1), None))
    assert [r.vehicle_s for r in first] == list(range(T0 + 1, T0 + 1001))
    rest = list(pair.handleExpiredTimer(("V",), at(T0 + 10**5), None))
    assert [r.vehicle_s for r in rest] == list(range(T0 + 1001, T0 + 2000))
    assert all(r.vehicle_s - r.prev_s == 1 and abs(r.latitude - r.prev_lat - 1e-6) < 1e-9 for r in first + rest)
    assert not store.map and store.calls < 40
