"""Stateful operators on streams of device events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.operators.quality import EPOCH_FLOOR_US

from . import runs

RECOVERY_SCHEMA = "device_id string, outage_start long, outage_end long, seen_us long"


def outage_pairs(marks: DataFrame) -> DataFrame:
    """Closed outages from a stream of (device_id, us, arrival_seq, offline boolean).

    The state of a device is the start of its open outage. Inside a micro-batch events
    are taken in order of time; an event that comes in a later batch counts as later.
    """

    def pair(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["us", "arrival_seq"])
        closed = []
        for us, offline in zip(rows["us"].tolist(), rows["offline"].tolist()):
            if offline:
                start = us if start is None else start
            elif start is not None:
                closed.append((key[0], start, us))
                start = None
        if start is None:
            state.remove()
        else:
            state.update((start,))
        if closed:
            yield pd.DataFrame(closed, columns=["device_id", "outage_start", "outage_end"])

    return marks.groupBy("device_id").applyInPandasWithState(
        pair, "device_id string, outage_start long, outage_end long", "start long", "append", GroupStateTimeout.NoTimeout
    )


_SNAPSHOT = ("us", "is_offline", "offline_since", "connect_us")


def _recover(rows: pd.DataFrame, start: int | None) -> tuple[list[tuple[int, int, int]], int | None]:
    """Recoveries (start, end, seen) in ordered snapshots of a device with an outage open since ``start``, and the start then open."""
    found = []
    for us, offline, since, connect in zip(*(rows[c].tolist() for c in _SNAPSHOT)):
        if offline:
            if not pd.isna(since):
                start = int(since)
            elif start is None:
                start = int(us)
        elif start is not None:
            end = int(connect) if not pd.isna(connect) and connect > start else int(us)
            if end < start:
                continue
            found.append((start, end, int(us)))
            start = None
    return found, start


def recoveries_of(rows: pd.DataFrame) -> pd.DataFrame:
    """Recoveries of one device from its snapshots (us, is_offline, offline_since, connect_us).

    The latest known offline time replaces an open start. An online snapshot closes
    the outage at its connect time if that is after the start, else at its own; an end
    before the start is passed over and the outage stays open.
    """
    ordered = rows.sort_values("us")
    found, _ = _recover(ordered, None)
    out = pd.DataFrame(found, columns=["outage_start", "outage_end", "seen_us"]).drop_duplicates(["outage_start", "outage_end"])
    out.insert(0, "device_id", ordered["device_id"].iloc[0] if len(ordered) else None)
    return out


def recoveries(snapshots: DataFrame) -> DataFrame:
    """``recoveries_of`` for all devices, batch by batch in order of time: a device is never held whole, only its open start."""
    ordered = snapshots.select("device_id", *_SNAPSHOT).repartition("device_id").sortWithinPartitions("device_id", "us")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        device, start = None, None
        for batch in batches:
            for own, rows in batch.groupby("device_id", sort=False):
                found, start = _recover(rows, start if own == device else None)
                device = own
                yield pd.DataFrame([(own, *f) for f in found], columns=["device_id", "outage_start", "outage_end", "seen_us"])

    return ordered.mapInPandas(close, RECOVERY_SCHEMA).groupBy("device_id", "outage_start", "outage_end").agg(F.min("seen_us").alias("seen_us"))


def freshness(events: DataFrame, *, late: str = "1 hour", width: str = "6 hours", slide: str = "3 hours") -> DataFrame:
    """Events and devices per sliding window of a stream with a column ``ts``; a window is final once it is ``late``."""
    timed = events.withWatermark("ts", late)
    counts = timed.groupBy(F.window("ts", width, slide)).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("user_id").alias("devices"))
    return counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "devices")


def last_of_each(events: DataFrame, keys: list[str], order: str, out: str) -> DataFrame:
    """The last event of each identity by ``order``, later batches first on ties; batches go through the folder ``out``."""
    whole = F.struct(*events.columns)

    def reduce(batch: DataFrame, number: int) -> None:
        last = batch.groupBy(*keys).agg(F.max_by(whole, F.col(order)).alias("last"))
        last.select("last.*").write.mode("overwrite").parquet(f"{out}/batch={number}")  # a repeated batch replaces itself

    runs.run_batches(events, reduce)
    seen = events.sparkSession.read.schema(events.schema.add("batch", "long")).parquet(out)
    return seen.groupBy(*keys).agg(F.max_by(whole, F.struct(order, "batch")).alias("last")).select("last.*")


def split_late(batch: DataFrame, now_us: int) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rows with impossible times, of a micro-batch with a column us."""
    bad = F.col("us").isNull() | (F.col("us") < EPOCH_FLOOR_US) | (F.col("us") > now_us)
    return batch.where(~bad), batch.where(bad)
