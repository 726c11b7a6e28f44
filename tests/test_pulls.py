"""The paged source as batch and stream, and snapshots that arrive over several runs."""

from __future__ import annotations

import glob
import json
import random
import tracemalloc

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from quarry.sources import paged, staged_series
from quarry.streaming import runs, snapshots

READINGS = [("d1", "k", t, t / 2) for t in range(0, 40, 2)] + [("d2", "k", t, 1.0) for t in (5, 5, 6)] + [("d2", "z", t, 2.0) for t in range(30)]


@pytest.fixture
def store(spark, tmp_path):
    spark.dataSource.register(paged.SeriesSource)
    staged_series.stage(spark.createDataFrame(READINGS, "device_id string, key string, ts long, value double"), f"{tmp_path}/store", 3)
    return {"client": "quarry.sources.staged_series:StagedSeries", "store": f"{tmp_path}/store", "buckets": "3", "limit": "5", "base_s": "0.001", "start": "0"}


def points(rows):
    return sorted((r.device_id, r.key, r.ts, float(r.value)) for r in rows if r.ts is not None)


def expected(low, high):
    return sorted(set(r for r in READINGS if low <= r[2] <= high))


def test_small_pages_are_complete_under_faults(spark, store):
    rows = spark.read.format("paged_series").options(**store, end="33", faults="busy,expired").load().collect()
    assert points(rows) == expected(0, 33) and {r.completeness for r in rows} == {"complete"}


def test_refused_and_broken_pairs_are_rows(spark, store):
    for fault, error in (("refused=d1|k", "PermanentError: 403"), ("down=d1|k", "RetryableError: 503")):
        rows = spark.read.format("paged_series").options(**store, end="33", faults=fault).load().collect()
        assert [(r.completeness, r.error, r.ts) for r in rows if r.device_id == "d1"] == [("failed", error, None)]
        assert points(rows) == [r for r in expected(0, 33) if r[0] != "d1"]


def test_a_stopped_pull_goes_on_with_its_frozen_window(spark, store, tmp_path):
    out, progress = f"{tmp_path}/out", f"{tmp_path}/progress"

    def run(end, faults=""):
        runs.carry_on(spark.readStream.format("paged_series").options(**store, end=str(end), faults=faults).load(), out, progress)

    def ends():
        return [json.loads(open(f).read().splitlines()[-1])["through"] for f in sorted(glob.glob(f"{progress}/offsets/[0-9]*"))]

    run(10)
    assert points(spark.read.parquet(out).collect()) == expected(0, 10)
    with pytest.raises(StreamingQueryException):
        run(20, "down=d2|z")
    assert points(spark.read.parquet(out).collect()) == expected(0, 10)  # nothing of the broken batch is seen
    run(39)
    run(39)
    run(39)
    assert ends() == [10, 20, 39]
    assert points(spark.read.parquet(out).collect()) == expected(0, 39)


def test_a_task_holds_one_pair_at_a_time(spark, tmp_path, monkeypatch):
    """Batches that cut pairs, and a first call for each that is turned away: every pair whole, and no other held."""
    monkeypatch.setattr(staged_series, "BATCH", 7)
    staged_series.stage(spark.createDataFrame(READINGS, "device_id string, key string, ts long, value double"), f"{tmp_path}/store", 2)
    client, found = staged_series.StagedSeries({"store": f"{tmp_path}/store", "buckets": "2", "faults": "busy"}), []
    for group in client.groups():
        for pair in client.pairs(group):
            assert list(client._points) == [pair]
            page = client.page(*pair)
            with pytest.raises(paged.RetryableError):
                page(0, 100, 100)
            found += [(*pair, p["ts"], p["value"]) for p in page(0, 100, 100)]
    assert sorted(found) == sorted(READINGS)


def _most_held(folder, n, kind, options):
    """The most bytes of Python objects while a task reads one pair of ``n`` readings, each of which must come once."""
    (folder / "bucket=0").mkdir(parents=True)
    times = pa.array(range(0, 1000 * n, 1000), pa.int64())
    pq.write_table(pa.table({"device_id": ["d"] * n, "key": ["k"] * n, "ts": times, "value": pa.array(range(n), pa.float64())}), f"{folder}/bucket=0/part-0.parquet")
    reader = kind({"client": "quarry.sources.staged_series:StagedSeries", "store": str(folder), "buckets": "1", "base_s": "0.001", **options})
    (task,) = reader.partitions({"through": -1}, {"through": 1000 * n}) if kind is paged.SeriesStreamReader else reader.partitions()
    tracemalloc.start()
    try:
        for k, row in enumerate(reader.read(task)):
            assert row[:5] == ("d", "k", 1000 * k, str(float(k)), "complete")
        assert k == n - 1
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("kind", [paged.SeriesReader, paged.SeriesStreamReader])
def test_what_a_task_holds_of_a_pair_does_not_grow_with_it(tmp_path, monkeypatch, kind):
    """A device that sends often has pairs of millions of readings: a page and a batch of them are held; also where a window is halved."""
    monkeypatch.setattr(staged_series, "BATCH", 512)
    monkeypatch.setattr(paged.Spool.__init__, "__defaults__", (512,))
    for name, limit in (("whole", "500"), ("halved", "8")):  # eight a page for a thousand pages do not reach the end
        held = [_most_held(tmp_path / f"{name}-{n}", n, kind, {"start": "0", "end": str(1000 * n), "limit": limit, "faults": "busy"}) for n in (9_000, 36_000)]
        assert held[1] < 1.5 * held[0]


def test_pages_and_halves_give_each_point_once_in_order():
    """Bursts of one time, repeated points and several values a time, against a plain reading; windows are halved where pages run out."""
    draw = random.Random(5)
    for _ in range(60):
        points = sorted(({"ts": draw.randrange(0, 2_000_000, 50_000), "value": draw.randrange(3)} for _ in range(draw.randrange(300))), key=lambda p: p["ts"])
        page = lambda start, end, limit, points=points: [p for p in points if start <= p["ts"] <= end][:limit]
        got = paged.resolve(page, 0, 2_000_000, draw.choice([2, 7, 50]), most_pages=draw.choice([4, 30, 1000]))
        assert [(p["ts"], p["value"]) for p in got.points] == sorted({(p["ts"], p["value"]) for p in points}) or got.completeness == "partial"
        assert got.completeness == "partial" or (got.completeness == "empty_verified") == (not points)


def test_retries_by_kind_of_error():
    waits, renewed = [], []

    def failing(*errors):
        left = list(errors)

        def call():
            if left:
                raise left.pop(0)
            return [1]

        return call

    random.seed(4)
    assert paged.with_retries(failing(paged.RetryableError("a"), paged.RetryableError("b")), sleep=waits.append, jitter=0.2) == [1]
    assert 0.8 <= waits[0] <= 1.2 and 1.6 <= waits[1] <= 2.4 and waits[0] != 1.0
    assert paged.with_retries(failing(paged.AuthError("x")), sleep=waits.append, renew=lambda: renewed.append(1)) == [1] and renewed == [1]
    with pytest.raises(paged.AuthError):
        paged.with_retries(failing(paged.AuthError("x"), paged.AuthError("x")), sleep=waits.append, renew=lambda: None)
    with pytest.raises(paged.PermanentError):
        paged.with_retries(failing(paged.PermanentError("404")), sleep=waits.append)
    assert len(waits) == 2


def test_pacing_is_shared_by_tasks():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    pacer = paged.Pacer(10, 4, clock=lambda: now[0], sleep=sleep)
    for _ in range(6):
        pacer.wait()
    assert now[0] == pytest.approx(5 * 0.4)  # four tasks of 2.5 calls a second
    now[0] += 10
    pacer.wait()
    assert len(slept) == 5  # no debt after a pause


SCHEMA = "device_id string, us long, is_offline boolean, offline_since long, connect_us long"
SECOND = 1_000_000


def deliver(spark, folder, rows):
    spark.createDataFrame([(d, us * SECOND, off, s and s * SECOND, c and c * SECOND) for d, us, off, s, c in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run_snapshots(spark, tmp_path, **options):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    with runs.rocksdb(spark):
        runs.carry_on(snapshots.recoveries(stream, late="100 seconds", **options), f"{tmp_path}/out", f"{tmp_path}/progress")
    found = spark.read.schema(snapshots.RECOVERY).parquet(f"{tmp_path}/out").collect()
    return sorted((r.device_id, r.outage_start // SECOND, r.outage_end // SECOND, r.seen_us // SECOND) for r in found)


def test_recoveries_over_several_runs(spark, tmp_path):
    folder = f"{tmp_path}/in"
    deliver(spark, folder, [("a", 1000, True, 990, None), ("b", 1010, False, None, None), ("b", 1000, True, None, None)])
    assert run_snapshots(spark, tmp_path) == []  # all wait for the watermark
    # a's start is corrected by a snapshot that comes a run late, and its recovery is in the next file
    deliver(spark, folder, [("a", 1200, False, None, 1150), ("a", 1050, True, 1020, None), ("a", 1301, True, 1290, None)])
    assert run_snapshots(spark, tmp_path) == [("a", 1020, 1150, 1200), ("b", 1000, 1010, 1010)]
    assert run_snapshots(spark, tmp_path) == [("a", 1020, 1150, 1200), ("b", 1000, 1010, 1010)]  # a run without files changes nothing
    deliver(spark, folder, [("a", 1500, False, None, 1100), ("c", 1500, True, 1600, None), ("c", 1550, False, None, None), ("c", 1700, False, None, 1650)])
    deliver(spark, folder, [(snapshots.TICK, 5000, False, None, None)])
    # c's first end is before its start, so its outage stays open until 1650
    assert run_snapshots(spark, tmp_path) == [("a", 1020, 1150, 1200), ("a", 1290, 1500, 1500), ("b", 1000, 1010, 1010), ("c", 1600, 1650, 1700)]


def test_silent_devices_are_forgotten(spark, tmp_path):
    folder = f"{tmp_path}/in"
    deliver(spark, folder, [("a", 1000, True, 990, None), ("b", 1000, True, 990, None)])
    deliver(spark, folder, [(snapshots.TICK, 1400, False, None, None)])
    assert run_snapshots(spark, tmp_path, forget_ms=1_000_000) == []
    deliver(spark, folder, [("b", 1500, True, None, None), (snapshots.TICK, 2300, False, None, None)])
    assert run_snapshots(spark, tmp_path, forget_ms=1_000_000) == []
    deliver(spark, folder, [("a", 2310, False, None, None), ("b", 2310, False, None, None), (snapshots.TICK, 9000, False, None, None)])
    assert run_snapshots(spark, tmp_path, forget_ms=1_000_000) == [("b", 990, 2310, 2310)]  # a was silent for 1,200 seconds


def test_scratch_of_a_cluster_must_be_named(spark):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda name, default=None: default)})
        sparkContext = type("S", (), {"master": "local-cluster[2,1,1024]"})

    with pytest.raises(RuntimeError):
        runs.scratch(Cluster(), "x")
