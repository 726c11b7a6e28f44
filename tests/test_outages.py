"""Known answers on evidence, outages, labels, splits, scores and sources."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.functions.scalars import DAY_US, HOUR_US
from quarry.operators import grid, metrics, outages, outputs, quantiles, scoring, splits
from quarry.sources import paged
from quarry.streaming.stateful import recoveries_of

T0 = 1_773_144_000_000_000
ALARM = "device_id string, alarm_id long, alarm_type string, start_us long, clear_us long, ack_us long"
MARK = "device_id string, us long, arrival_seq long, off boolean"


def windows_of(spark, marks, **options):
    df = spark.createDataFrame([("d", T0 + int(m * 60_000_000), i, off) for i, (m, off) in enumerate(marks)], MARK)
    found = outages.outage_windows(df, F.col("off"), ~F.col("off"), **options)
    return sorted(((r.outage_start - T0) // 60_000_000, None if r.outage_end is None else (r.outage_end - T0) // 60_000_000) for r in found.collect())


def test_pairs(spark):
    assert windows_of(spark, [(0, True), (5, True), (20, False), (30, False), (40, True), (42, False), (50, True)]) == [(0, 20), (50, None)]
    assert windows_of(spark, [(0, False)]) == []


def test_acknowledgement_ends_nothing(spark):
    alarms = spark.createDataFrame([("d", 1, "DVR/NVR OFF", T0, T0 + 2 * HOUR_US, T0 + HOUR_US), ("d", 2, "POWER", T0, None, T0 + HOUR_US), ("d", 3, "X", None, T0, T0)], ALARM)
    events = outages.alarms_to_events(alarms).collect()
    assert sorted((e.alarm_id, e.state) for e in events) == [(1, "ACTIVATED"), (1, "CLEARED"), (2, "ACTIVATED")]
    assert {r.alarm_id: r.outage_end for r in outages.alarm_labels(alarms).collect()} == {1: T0 + 2 * HOUR_US, 2: None}


@pytest.mark.parametrize("name,scope", [("CAMERA TAMPER CH 9", "camera"), ("BOI- camera disconnect CH 1", "camera"), ("DVR/NVR OFF", "device")])
def test_camera_channels(spark, name, scope):
    assert outages.alarms_to_events(spark.createDataFrame([("d", 1, name, T0, None, None)], ALARM)).first().scope == scope


SAMPLE = "device_id string, anchor_us long, split string"
WINDOW = "device_id string, outage_start long, outage_end long, duration_minutes double, window_closed boolean"


def label(spark, anchor_h, windows=(), *, split="train", span=30.0, end_h=240, verdict=None):
    s = spark.createDataFrame([("d", T0 + int(anchor_h * HOUR_US), split)], SAMPLE)
    w = [("d", T0 + a * HOUR_US, None if b is None else T0 + b * HOUR_US, None, b is not None) for a, b in windows]
    w.append(("other", T0 - 99 * HOUR_US, T0 - 98 * HOUR_US, 60.0, True))
    spans = spark.createDataFrame([("d", span, 5)], "device_id string, span_days double, n_strong long")
    verdicts = None if verdict is None else spark.createDataFrame([verdict], "device_id string, covered boolean, newest_us long, stale boolean")
    r = outages.label_samples(s, spark.createDataFrame(w, WINDOW), spans, T0 + end_h * HOUR_US, verdicts=verdicts).first()
    return r.y, r.censor_reason


def test_label_ladder(spark):
    assert label(spark, 0, [(2, 5)]) == (1, None)
    assert label(spark, 26, [(2, 5)]) == (0, None)
    assert label(spark, 3, [(2, 5)]) == (None, "inside_verified_outage")
    assert label(spark, 3, [(2, None)]) == (None, "inside_verified_outage")
    assert label(spark, 0, [(2, None)]) == (None, "open_outage_window_unverified")
    assert label(spark, 0, [(2, 5)], end_h=2) == (None, "future_label_coverage_incomplete")
    assert label(spark, 0, [(2, 5)], split="purged") == (None, "split_purge_gap")
    assert label(spark, 0, span=2.0) == (None, "unverified_negative_coverage")
    assert label(spark, 0, verdict=("x", True, T0, False)) == (None, "no_label_source_coverage_for_device")
    assert label(spark, 0, verdict=("d", True, T0, True)) == (None, "label_source_history_stale")
    assert label(spark, 0, verdict=("d", True, T0, False)) == (0, None)
    assert label(spark, 0, [(2, 5)], verdict=("x", True, T0, False)) == (1, None)


def test_without_verified_outages_nothing_is_negative(spark):
    s = spark.createDataFrame([("d", T0, "train")], SAMPLE)
    empty = spark.createDataFrame([], WINDOW)
    spans = spark.createDataFrame([("d", 30.0, 5)], "device_id string, span_days double, n_strong long")
    assert outages.label_samples(s, empty, spans, T0 + 99 * HOUR_US).first().censor_reason == "no_verified_outage_source"


def test_payload_never_leaks_secrets(spark):
    rows = [(1, "LC_EVENT", '{"method":"onDisconnect","password":"hunter2"}'), (2, "SOMETHING_ELSE", '{"data":{"currentAttr":1}}'), (3, "STATS", "{}"), (4, "ERROR", "broken")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], "event_id long, event_type string, payload string, scope string, state string")
    found = outages.classify_events(df).select("event_id", "evidence_type", "evidence_strength").collect()
    assert sorted(tuple(r) for r in found) == [(1, "lc_disconnect", "strong"), (2, "current_attr_snapshot", "weak"), (4, "error_event", "weak")]
    assert "hunter2" not in str(found)


def test_splits_are_pure_ordered_and_purged(spark):
    rows = [(f"c{c}", T0 + (c * 40 + d) * DAY_US + h * HOUR_US) for c in range(4) for d in range(40) for h in (0, 6, 12, 18)]
    df = spark.createDataFrame(rows, "grp string, anchor_us long")
    placed = splits.group_splits(df, "grp")
    split = {r.grp: r.split for r in placed.collect()}
    assert set(split.values()) == set(splits.SPLITS)
    joined = df.join(placed.select("grp", "split"), "grp")
    assert splits.group_overlap(joined, "grp").count() == 0
    report = {r.split: r for r in splits.split_report(splits.purge(joined, 174), "grp").collect()}
    order = [report[s] for s in splits.SPLITS]
    for a, b in zip(order, order[1:]):
        assert b.first_us - a.last_us >= 174 * HOUR_US


def test_two_groups_make_two_splits(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "grp string, anchor_us long")
    assert {r.grp: r.split for r in splits.group_splits(df, "grp").collect()} == {"a": "train", "b": "validation"}


def test_folds_balance(spark):
    rows = spark.createDataFrame([(g,) for g, n in {"a": 5, "b": 4, "c": 3, "d": 2}.items() for _ in range(n)] + [(None,)], "g string")
    assert {r.g: r.fold for r in splits.group_folds(rows, "g", 2).collect()} == {"a": 0, "b": 1, "c": 1, "d": 0}
    assert splits.group_folds(rows.where("false"), "g", 2).count() == 0


def test_turns_equal_placing_groups_one_by_one():
    generator = random.Random(5)
    for folds in (1, 2, 5):
        for _ in range(50):
            sizes = sorted(((generator.randint(1, 400), generator.randint(1, 30)) for _ in range(6)), reverse=True)
            sizes = list(dict(sizes).items())
            load, one_by_one = [0] * folds, []
            for size, groups in sizes:
                for at in range(groups):
                    k = load.index(min(load))
                    load[k] += size
                    one_by_one.append((size, at, k))
            found = [(s, at, near[(at - first) % len(near)]) for s, first, end, near in splits.turns(sizes, folds) for at in range(first, end)]
            assert found == one_by_one


def test_quantiles_and_curves_do_not_depend_on_slices(spark):
    values = [(float(v),) for v in np.random.default_rng(3).integers(0, 900, 4000)] + [(None,)]
    rows = spark.createDataFrame(values, "v double").repartition(3)
    shares = [0.0, 0.4, 0.5, 0.99, 1.0]
    assert quantiles.exact_quantiles(rows, "v", shares) == pytest.approx(np.quantile([v for (v,) in values[:-1]], shares))
    assert quantiles.exact_quantiles(rows.where("v IS NULL"), "v", [0.5]) == [None]


def test_scaler_uses_train_only(spark):
    df = spark.createDataFrame([(float(x), "train") for x in (0, 1, 2)] + [(float(x), "test") for x in (100, 101)], "f double, split string")
    scaler = metrics.fit_scaler(df.where("split = 'train'"), ["f"])
    assert scaler.first().asDict() == {"f__mean": 1.0, "f__std": 1.0}
    assert metrics.apply_scaler(df, scaler, ["f"]).where("split = 'test'").agg(F.min("f")).first()[0] == 99.0
    assert metrics.constant_columns(df.where("split = 'test'"), ["f", "split"]) == ["split"]


def test_missing_is_not_faulty(spark):
    df = spark.createDataFrame([("N/A", None, "95"), ("FAULT", "offline", "95")], "nvr_status_snapshot string, heartbeat_BAS string, disk string")
    calm, bad = scoring.score_daily(df).collect()
    assert (calm.score, calm.reasons) == (20.0, "DISK_CRIT(95%)")
    assert (bad.score, bad.severity) == (65.0, "HIGH")


def test_audit_score(spark):
    df = spark.createDataFrame([("N/A", "120", "10", "3")], "nvr_status string, gap_days string, total_data_mb string, camera_disconnects string")
    row = scoring.score_audit(df).first()
    assert (row.score, row.severity, row.reasons) == (95.0, "CRITICAL", "GAP_90D(+50) | NVR_FAULT(+30) | CAM_DC=3(+15)")


def test_explicit_null_overwrites_the_carry(spark):
    rows = [("d", "k", 0, 1, 5.0), ("d", "k", DAY_US, 2, None)]
    df = spark.createDataFrame(rows, "device_id string, key string, us long, arrival_seq long, value_num double")
    assert [r.value_num for r in grid.daily_last(df, 0, 2).orderBy("day").collect()] == [5.0, None, None]


def test_recoveries_skip_ends_before_starts():
    rows = pd.DataFrame(
        [("d", 10, True, 8.0, None), ("d", 20, False, None, 15.0), ("d", 30, True, 50.0, None), ("d", 40, False, None, None), ("d", 60, False, None, 55.0)],
        columns=["device_id", "us", "is_offline", "offline_since", "connect_us"],
    )
    assert recoveries_of(rows)[["outage_start", "outage_end"]].values.tolist() == [[8, 15], [50, 55]]


def server(points, cap=paged.SERVER_CAP):
    return lambda start, end, limit: [p for p in points if start <= p["ts"] <= end][: min(limit, cap)]


@pytest.mark.parametrize("n,limit", [(250, 100), (300, 100), (12_000, 5000), (0, 100)])
def test_paging_is_complete(n, limit):
    got = paged.resolve(server([{"ts": t, "value": t} for t in range(n)]), 0, 10**6, limit)
    assert (len(got.points), got.completeness) == (n, "complete" if n else "empty_verified")
    assert [p["ts"] for p in got.points] == list(range(n))


def test_bursts_of_one_time():
    points = [{"ts": t, "value": k} for t in (5, 9) for k in range(30)]
    assert len(paged.read_pages(server(points), 0, 100, 10).points) == 60


def test_stuck_and_failing_servers():
    stuck = [{"ts": t, "value": 0} for t in range(10)]
    assert paged.read_pages(lambda a, b, n: stuck, 0, 100, 10).error == "stalled"

    def failing(a, b, n):
        raise paged.RetryableError("timeout")

    assert paged.resolve(failing, 0, 100).completeness == "failed"


def test_retries_wait_as_asked():
    waits, left = [], [paged.RetryableError("429", 7), paged.RetryableError("503"), None]

    def call():
        e = left.pop(0)
        if e:
            raise e
        return [1]

    assert paged.with_retries(call, sleep=waits.append) == [1] and waits == [7.0, 2.0]


CLIENT = """
def page_of_device(device_id, key):
    points = [{"ts": t, "value": device_id + key} for t in range(3)] if key == "k" else []
    return lambda start, end, limit: [p for p in points if start <= p["ts"] <= end][:limit]
"""


def test_source_reports_gaps_as_rows(spark, tmp_path):
    (tmp_path / "quarry_test_client.py").write_text(CLIENT)
    spark.sparkContext.addPyFile(str(tmp_path / "quarry_test_client.py"))
    spark.dataSource.register(paged.SeriesSource)
    df = spark.read.format("paged_series").options(work='[["a", "k"], ["b", "none"]]', start="0", end="10", client="quarry_test_client:page_of_device").load()
    found = sorted((r.device_id, r.ts, r.completeness) for r in df.collect() if r.ts is not None)
    assert found == [("a", t, "complete") for t in range(3)]
    assert [r.completeness for r in df.where("ts IS NULL").collect()] == ["empty_verified"]


def test_safe_cells_and_typed_json(spark):
    df = spark.createDataFrame([("=1", 2), ("ok", -3)], "a string, b int")
    assert [tuple(r) for r in outputs.safe_rows(df).collect()] == [("'=1", "2"), ("ok", "'-3")]
    typed = spark.createDataFrame([(x,) for x in ("n/a", "5.0", "0.12345", "TRUE", 'say "x"')], "t string").select(outputs.json_value(F.col("t")).alias("j"))
    assert [r.j for r in typed.collect()] == [None, "5", "0.1235", "true", '"say \\"x\\""']


@pytest.mark.parametrize("seed", range(6))
def test_cuts_equal_a_full_search(spark, seed):
    import random

    rng = random.Random(seed)
    sizes = [rng.choice([1, 1, 2, 5, 40]) for _ in range(rng.randint(3, 14))]
    df = spark.createDataFrame([(f"g{k:02d}", k) for k, n in enumerate(sizes) for _ in range(n)], "grp string, anchor_us long")
    total, best = sum(sizes), None
    for one in range(1, len(sizes)):
        for two in range(one + 1, len(sizes)):
            parts = (sum(sizes[:one]), sum(sizes[one:two]), sum(sizes[two:]))
            off = round(sum(abs(p - t * total) for p, t in zip(parts, (0.7, 0.15, 0.15))), 6)
            best = min(best or (off, one, two), (off, one, two))
    found = {r.grp: r.split for r in splits.group_splits(df, "grp").collect()}
    assert [found[f"g{k:02d}"] for k in range(len(sizes))] == [splits.SPLITS[(k >= best[1]) + (k >= best[2])] for k in range(len(sizes))]


#: Daily scores whose exact slopes are 0.1, 0.1, a hair below 0, and beyond them one of a score that is missing.
TRENDS = {"a": [60, 100, 89, 54, 100, 38, 100, 100, 60], "b": [100, 68, 69, 53, 59, 100, 100, 55, 84], "c": [100, 48, 100, 46, 76, 78, 88], "d": [5, None, 1, 7, 7, 7, 9, 3]}


@pytest.mark.parametrize("parts", [1, 7])
def test_slopes_on_a_border_are_those_of_the_sql_to_the_last_bit(spark, parts):
    rows = [(device, day, None if v is None else float(v)) for device, values in TRENDS.items() for day, v in enumerate(values)]
    random.Random(parts).shuffle(rows)
    found = {r.device_id: r for r in grid.score_trend(spark.createDataFrame(rows, "device_id string, day int, score double").repartition(parts), least_days=7).collect()}
    con = duckdb.connect()
    con.sql("SET threads = 1")
    for device, values in TRENDS.items():
        listed = ", ".join(f"({x}, {float(v or 0)!r}::DOUBLE)" for x, v in enumerate(values))
        assert con.sql(f"SELECT regr_slope(y, x) FROM (SELECT * FROM (VALUES {listed}) v(x, y) ORDER BY x)").fetchall() == [(found[device].slope,)]
    assert [found[d].direction for d in "abc"] == ["worsening", "worsening", "stable"]
    assert found["c"].slope < 0 and (found["d"].n_days, found["d"].first_score, found["d"].last_score) == (8, 5.0, 3.0)


def test_a_trend_over_one_day_has_no_slope(spark):
    only = grid.score_trend(spark.createDataFrame([("d", 1, 2.0)], "device_id string, day int, score double"), least_days=1).first()
    assert (only.slope, only.direction) == (None, "stable")
