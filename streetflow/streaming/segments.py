"""Segments from a stream of positions (WN1, WN2, FIL4-FIL8), as the batch gives them.

Positions come in any order. A fix cannot come with a feed time more than
``max_staleness_s`` after its own time (FIL3), so once the watermark on the feed
time has passed a fix by that much, all fixes up to it are there. Until then a
vehicle's fixes are held in state, one per time, of copies the first sighting;
then a timer pairs them in order. What remains is the vehicle's last fix, and that
expires ``max_gap_s`` later, when nothing can pair with it any more. State is bounded
by the fixes of a vehicle within the watermark's delay and the staleness limit.
A call to the state store costs more than a fix, so fixes are held by the hour, each
hour read and written once for all that a batch brings of a vehicle, and a vehicle's
earliest fix has a timer, not each.
A vehicle clock that is ahead moves no watermark.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streetflow.config import DEFAULT, Config
from streetflow.functions.timefns import epoch_s
from streetflow.operators import positions as P
from streetflow.operators import segments as S

_FIX = "feed long, entity_id string, source_file string, latitude double, longitude double, trip_id string, " \
       "route_id string, direction_id int"
_FIELDS = [c.split()[0] for c in _FIX.split(", ")]
_PAIR = ("vehicle_id string, vehicle_s long, latitude double, longitude double, trip_id string, route_id string, "
         "direction_id int, prev_s long, prev_lat double, prev_lon double, prev_trip_id string")

_PAIRED = Row(*[c.split()[0] for c in _PAIR.split(", ")])


#: Seconds of a vehicle's track that one entry of its state holds.
_SPAN_S = 3600
#: Fixes of one vehicle that a task gathers before it writes them to the state.
_GATHERED = 10_000


class PairFixes(StatefulProcessor):
    """Pairs each vehicle's fixes in the order of their times."""

    def __init__(self, cfg: Config) -> None:
        self.hold_s, self.gap_s = cfg.max_staleness_s, cfg.max_gap_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # fixes: [[vehicle_s, [field, ...]], ...] as JSON
        self.waiting = handle.getMapState("waiting", "span long", "fixes string")
        self.last = handle.getValueState("last", "vehicle_s long, latitude double, longitude double, trip_id string")

    def _ripe(self, vehicle_s: int) -> int:
        """The watermark (ms) from which on a fix and all before it are complete."""
        return (vehicle_s + self.hold_s) * 1000 + 1

    def _held(self, span: int) -> dict[int, tuple]:
        """Fixes of a span of the track by their time."""
        held = self.waiting.getValue((span,))
        return {at: tuple(fix) for at, fix in json.loads(held[0])} if held else {}

    def _hold(self, span: int, fixes: Iterable[tuple[int, tuple]]) -> None:
        self.waiting.updateValue((span,), (json.dumps(list(fixes)),))

    def _add(self, found: dict[int, tuple]) -> None:
        """Hold fixes, of those of one time the first sighting; a timer for the earliest
        of them. Later ones get theirs when it has gone off."""
        by_span: dict[int, dict] = {}
        for at, fix in found.items():
            by_span.setdefault(at // _SPAN_S, {})[at] = fix
        for span, fixes in by_span.items():
            held = self._held(span)
            held.update((at, fix) for at, fix in fixes.items() if at not in held or _sighting(fix) < _sighting(held[at]))
            self._hold(span, held.items())
        if found:
            self.handle.registerTimer(self._ripe(min(found)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        watermark = timerValues.getCurrentWatermarkInMs()
        found: dict[int, tuple] = {}
        for r in rows:
            at, fix = r["vehicle_s"], tuple(r[c] for c in _FIELDS)
            if self._ripe(at) <= watermark:
                continue  # later than the watermark allows: its place in the track has been settled
            if at not in found or _sighting(fix) < _sighting(found[at]):
                found[at] = fix
            if len(found) >= _GATHERED:
                self._add(found)
                found = {}
        self._add(found)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        watermark = timerValues.getCurrentWatermarkInMs()
        last = tuple(self.last.get()) if self.last.exists() else None
        out, ripe, left = [], False, None
        for span in sorted(k[0] for k in self.waiting.keys()):
            if self._ripe(span * _SPAN_S) > watermark:
                left = min(self._held(span))
                break
            held = sorted(self._held(span).items())
            for vehicle_s, fix in held:
                if self._ripe(vehicle_s) > watermark:
                    left = vehicle_s
                    break
                ripe = True
                f = dict(zip(_FIELDS, fix, strict=True))
                if last is not None and vehicle_s - last[0] <= self.gap_s:
                    out.append(_PAIRED(key[0], vehicle_s, f["latitude"], f["longitude"], f["trip_id"], f["route_id"],
                                       f["direction_id"], *last))
                last = (vehicle_s, f["latitude"], f["longitude"], f["trip_id"])
            if left is None:
                self.waiting.removeKey((span,))
                continue
            if left != held[0][0]:
                self._hold(span, [x for x in held if x[0] >= left])
            break
        if left is not None:
            self.handle.registerTimer(self._ripe(left))
        if ripe:
            self.last.update(last)
            self.handle.registerTimer(self._ripe(last[0] + self.gap_s))
        elif last is not None and self._ripe(last[0] + self.gap_s) <= watermark:
            self.last.clear()
        return iter(out)

    def close(self) -> None:
        pass


def _sighting(fix: tuple) -> list:
    """Order in which copies were seen; missing ids first, as Spark sorts them."""
    return [(x is not None, x) for x in fix[:3]]


def prepare_state(spark: SparkSession) -> None:
    """The state store that such processors need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def segment_stream(positions: DataFrame, cfg: Config = DEFAULT, disorder: str = "2 minutes") -> DataFrame:
    """A stream of bronze-shaped positions -> a stream of ``vehicle_segments`` rows.
    ``disorder`` is how far behind the newest feed time a snapshot may come; later
    ones are dropped."""
    fixes = P.clean(positions, cfg).withWatermark("feed_timestamp", disorder).select(
        "vehicle_id", "feed_timestamp", epoch_s("vehicle_timestamp").alias("vehicle_s"),
        epoch_s("feed_timestamp").alias("feed"), *_FIELDS[1:])
    pairs = fixes.groupBy("vehicle_id").transformWithState(PairFixes(cfg), _PAIR, "Append", "EventTime")
    paired = pairs.withColumn("vehicle_timestamp", F.timestamp_seconds("vehicle_s")).withColumn(
        "prev_ts", F.timestamp_seconds("prev_s"))
    return S.with_local_time(S.between(paired, cfg), cfg)
