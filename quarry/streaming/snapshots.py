"""Recoveries from nightly snapshots that arrive over many runs of one stream.

A device's snapshots wait in list state until the watermark has passed them, so they are
taken in order of time though files may come late or out of order. Timers wake a
device when its oldest waiting snapshot is due, and again when it has been silent for so
long that its open outage is given up.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

SNAPSHOT = "us long, is_offline boolean, offline_since long, connect_us long"
RECOVERY = "device_id string, outage_start long, outage_end long, seen_us long"
#: The device of rows that only move the watermark.
TICK = ""


def step(start: int | None, us: int, offline: bool, since: int | None, connect: int | None) -> tuple[int | None, tuple[int, int, int] | None]:
    """The start then open, and the recovery (start, end, seen) that a snapshot closes, if any.

    The latest known offline time replaces an open start. An online snapshot closes the
    outage at its connect time if that is after the start, else at its own; an end
    before the start is passed over and the outage stays open.
    """
    if offline:
        return (since if since is not None else us if start is None else start), None
    if start is None:
        return None, None
    end = connect if connect is not None and connect > start else us
    return (start, None) if end < start else (None, (start, end, us))


class SnapshotState(StatefulProcessor):
    """State of a device: its open start and last snapshot's time, and the snapshots not yet due."""

    def __init__(self, forget_ms: int | None) -> None:
        self._forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", "start long, last long")
        self._waiting = handle.getListState("waiting", SNAPSHOT)

    def handleInputRows(self, key: tuple, rows: Iterator, timerValues: object) -> Iterator[Row]:
        arrived = [(r.us, r.is_offline, r.offline_since, r.connect_us) for r in rows]
        if key[0] != TICK and arrived:
            self._waiting.appendList(arrived)
            # one timer a device: the others are set when it fires
            if not any(True for _ in self._handle.listTimers()):
                self._handle.registerTimer(_due(min(a[0] for a in arrived)))
            else:
                self._sooner(_due(min(a[0] for a in arrived)))
        return iter(())

    def _sooner(self, due: int) -> None:
        for set_for in list(self._handle.listTimers()):
            if set_for > due:
                self._handle.deleteTimer(set_for)
                self._handle.registerTimer(due)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = sorted((tuple(r) for r in self._waiting.get()), key=lambda r: r[0])
        now = [r for r in held if r[0] // 1000 < watermark]
        later = held[len(now) :]
        start, last = self._open.get() if self._open.exists() else (None, None)
        found = []
        for us, offline, since, connect in now:
            start, closed = step(start, us, offline, since, connect)
            last = us
            if closed is not None:
                found.append(Row(device_id=key[0], outage_start=closed[0], outage_end=closed[1], seen_us=closed[2]))
        if self._forget_ms is not None and last is not None and last // 1000 + self._forget_ms < watermark:
            start = None
        if start is None:
            self._open.clear()
        else:
            self._open.update((start, last))
        if later:
            self._waiting.put(later)
            self._handle.registerTimer(_due(later[0][0]))
        else:
            self._waiting.clear()
            if start is not None and self._forget_ms is not None:
                self._handle.registerTimer(last // 1000 + self._forget_ms + 1)
        return iter(found)

    def close(self) -> None:
        pass


def _due(us: int) -> int:
    """The first millisecond of the watermark at which a snapshot is in order."""
    return us // 1000 + 1


def recoveries(snapshots: DataFrame, *, late: str = "1 hour", forget_ms: int | None = None) -> DataFrame:
    """Recoveries from a stream of (device_id, us, is_offline, offline_since, connect_us).

    Snapshots may be ``late`` by so much against the newest one seen; later ones are left
    out by the watermark. Snapshots of ``TICK`` only move it: a last one after the feed's end
    makes all due. With ``forget_ms`` the open outage of a device that has been silent
    for longer is dropped, so devices that are gone leave no state. Needs RocksDB as
    the state store. Equal recoveries of a device are given as often as they occur.
    """
    timed = snapshots.withColumn("_ts", F.timestamp_micros("us")).withWatermark("_ts", late)
    return timed.groupBy("device_id").transformWithState(SnapshotState(forget_ms), RECOVERY, "Append", "EventTime")
