"""Known answers and metamorphic checks of quarantine, policy and point-in-time features."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.functions.scalars import DAY_US, HOUR_US, number
from quarry.operators import quality, trailing
from quarry.plans.features import device_features

T0 = 1_773_144_000_000_000  # 2026-03-10 12:00
READING = "device_id string, key string, us long, arrival_seq long, value_num double, value_text string"
RAW = "device_id string, key string, arrival_seq long, time string, value_num double, value_text string"


def readings(spark, rows):
    return spark.createDataFrame([("d1", k, T0 + int(h * HOUR_US), i, n, t) for i, (k, h, n, t) in enumerate(rows)], READING)


def anchors(spark, *hours, key="k"):
    return spark.createDataFrame([("d1", key, T0 + int(h * HOUR_US)) for h in hours], "device_id string, key string, anchor_us long")


def test_quarantine_known_answer(spark):
    rows = [
        ("2026-03-01 00:00:00", 12.0, None), ("2026-03-01 00:00:00", 13.0, None), ("1970-01-01", 1.0, None), ("1970-01-02T00:00:00Z", 1.0, None),
        ("2027-01-01 00:00:00", 1.0, None), (None, 1.0, None), ("not-a-timestamp", 1.0, None), ("2026-03-02 00:00:00", None, None),
    ]
    raw = spark.createDataFrame([("d1", "v", i, *r) for i, r in enumerate(rows)], RAW)
    stats = quality.quarantine_stats(raw, T0).first()
    assert (stats.epoch_like, stats.future_ts, stats.null_ts, stats.unparseable_ts, stats.no_value, stats.duplicate, stats.clean) == (2, 1, 1, 1, 1, 1, 1)
    clean = quality.quarantine(raw, T0).where("reason IS NULL").collect()
    assert [r.value_num for r in clean] == [13.0]


def test_reason_and_counts_differ_for_a_row_with_two_faults(spark):
    raw = spark.createDataFrame([("d", "k", 0, None, None, None)], RAW)
    assert quality.quarantine(raw, T0).first().reason == "null_ts"
    stats = quality.quarantine_stats(raw, T0).first()
    assert (stats.null_ts, stats.no_value) == (1, 1)


@pytest.mark.parametrize("empty", [True])
def test_empty_tables(spark, empty):
    assert quality.quarantine(spark.createDataFrame([], RAW), T0).count() == 0
    assert trailing.trailing_stats(anchors(spark, 0).limit(0), readings(spark, [("k", 0, 1.0, None)]).limit(0), [24]).count() == 0


def test_future_rows_change_nothing(spark):
    past = [("view", -3, 12.0, None), ("view", -1, 12.5, None), ("view", -2, 12.2, "4G")]
    poison = [("view", 1 / 60, 999.0, None), ("view", 5, 999.0, "x")]
    at = anchors(spark, 0, key="view")
    stats = lambda r: trailing.trailing_stats(at, r, [1, 24]).collect()
    last = lambda r: trailing.asof_backward(at, r, ["value_num"]).collect()
    assert stats(readings(spark, past)) == stats(readings(spark, past + poison))
    assert last(readings(spark, past)) == last(readings(spark, past + poison))


def test_window_bounds(spark):
    r = readings(spark, [("k", h, 1.0, None) for h in range(-24, 1)])
    assert trailing.trailing_stats(anchors(spark, 0), r, [24]).first().n_24h == 24
    assert trailing.trailing_stats(anchors(spark, 0), r, [24], closed=True).first().n_24h == 25


def test_fill_cap_and_age(spark):
    for age, last, stale in ((1, 12.0, 0), (10, None, 0), (30, None, 1)):
        found = trailing.capped_last(trailing.asof_backward(anchors(spark, 0), readings(spark, [("k", -age, 12.0, None)]), ["value_num"])).first()
        assert (found.last, found.stale, found.last_age_h) == (last, stale, float(age))


def test_missing_frac_and_slope(spark):
    one = trailing.trailing_stats(anchors(spark, 0), readings(spark, [("k", -23, 1.0, None)]), [24]).first()
    assert one.missing_frac_24h == pytest.approx(1 - 1 / 288)
    assert one.std_24h is None
    rising = trailing.trailing_stats(anchors(spark, 0), readings(spark, [("k", -h, -2.0 * h, None) for h in range(10)]), [24]).first()
    assert rising.slope_24h == pytest.approx(2.0, rel=1e-6)


def test_text_changes_inside_the_window(spark):
    r = readings(spark, [("k", -30, None, "A"), ("k", -2, None, "OFFLINE"), ("k", -1, None, "4G")])
    found = trailing.text_stats(anchors(spark, 0), r).first()
    assert (found.text_n, found.text_distinct, found.text_changes) == (2, 2, 1)


def test_deviation_from_own_norm(spark):
    calm = [("k", 6 * i, 10.0, None) for i in range(26 * 4)]
    loud = [("k", 26 * 24 + 6 * i, 20.0, None) for i in range(4)]
    end, early = 26 * 24 + 18, 25 * 24
    z = {r.anchor_us: r.z for r in trailing.baseline_z(anchors(spark, early, end), readings(spark, calm + loud)).collect()}
    assert abs(z[T0 + early * HOUR_US]) < 0.5
    assert z[T0 + end * HOUR_US] > 1
    later = trailing.baseline_z(anchors(spark, early), readings(spark, calm + loud + [("k", end + 1, 1e6, None)])).first().z
    assert later == z[T0 + early * HOUR_US]


def test_gap(spark):
    r = readings(spark, [("k", h, 1.0, None) for h in (0, 6, 30, 36)])
    assert trailing.longest_gap(anchors(spark, 36), r).first().gap_max_h == 24


def test_leak_guard(spark):
    bad = spark.createDataFrame([(2, 1)], "source_us long, anchor_us long")
    with pytest.raises(trailing.LeakageError):
        trailing.require_no_leakage(bad)


def test_default_deny_and_output_guard(spark):
    keys = ["humidity", "imei", "fault_score", "ts_severity", "heartbeat", "latitude", "cpu"]
    df = spark.createDataFrame([(k,) for k in keys], "key string").withColumn("reason", quality.policy_reason(F.col("key")))
    found = {r.key: r.reason for r in df.collect()}
    assert found["humidity"] == "unreviewed:not_in_allowlist" and found["cpu"] is None
    assert all(found[k].startswith("denylist:") for k in keys[1:6])
    with pytest.raises(quality.PolicyError):
        quality.guard_columns(df.withColumnRenamed("reason", "y_outage"))


def test_device_policy(spark):
    rows = [
        ("a", "TEST-rig", "recorder", "c", 10, True), ("b", "probe", "simulator", "c", 10, False), ("c", "demo-x", "x", "c", 0, False),
        ("d", "plain", "gw", None, 3, False), ("e", "plain", "gw", "c", 3, True), ("ok", "demo", "demo", None, 0, True), ("no", "plain", "gw", "c", 9, False),
    ]
    d = spark.createDataFrame([r[:5] for r in rows], "device_id string, name string, type string, customer_id string, key_count int")
    found = {r.device_id: r.keep for r in quality.decide_devices(d, require_customer=True, allow=["ok"], deny=["no"]).collect()}
    assert found == {r[0]: r[5] for r in rows}


def test_numbers_are_read_strictly(spark):
    df = spark.createDataFrame([(x,) for x in ("1", " -2.5e3 ", "NaN", "1d", "", ".5", None)], "t string").select(number(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [1.0, -2500.0, None, None, None, 0.5, None]


def test_wide_features_are_wide(spark):
    r = readings(spark, [("view", h, float(h), None) for h in range(48)])
    wide = device_features(r, ["view", "absent"])
    assert "absent__last" in wide.columns and wide.where("absent__last IS NOT NULL").count() == 0
    assert wide.where("max_source_us > anchor_us").count() == 0


def test_grid_rounds_the_start_up(spark):
    b = spark.createDataFrame([("d", T0 + 1, T0 + DAY_US)], "device_id string, start_us long, end_us long")
    found = [r.anchor_us for r in trailing.grid(b, 6 * HOUR_US).collect()]
    assert found[0] == T0 + 6 * HOUR_US and found[-1] == T0 + DAY_US


@pytest.mark.parametrize("seed", range(3))
def test_panes_equal_frames(spark, seed):
    """Windows of whole steps, of parts of a step and of both, with values on the borders and pairs that never change."""
    import random

    rng, step, hour = random.Random(seed), 6 * HOUR_US, HOUR_US
    t0 = 1_704_067_200_000_000
    rows = []
    for key, kind in (("k", "noise"), ("flat", "same"), ("far", "far")):
        for n in range(150):
            us = t0 + (rng.choice([rng.randrange(0, 60 * step), rng.randrange(0, 60) * step, rng.randrange(0, 300) * hour]))
            value = {"noise": round(rng.uniform(-50, 500), 2), "same": 7.1, "far": 1e6 + rng.random()}[kind]
            rows.append(("d", key, us, n, None if rng.random() < 0.1 else value))
    r = spark.createDataFrame(rows, "device_id string, key string, us long, arrival_seq long, value_num double")
    end = spark.createDataFrame([(t0 + 70 * step + 5,)], "end_us long")
    at = spark.createDataFrame([("d", k, t0 + i * step) for k in ("k", "flat", "far") for i in range(71)], "device_id string, key string, anchor_us long")
    hours = [1, 6, 10, 24, 168]
    frames = {(x.key, x.anchor_us): x.asDict() for x in trailing.trailing_stats(at, r, hours).collect()}
    panes = {(x.key, x.anchor_us): x.asDict() for x in trailing.pane_stats(r, hours, step, end).collect()}
    assert panes.keys() <= frames.keys()
    for place, frame in frames.items():
        pane = panes.get(place, {f"{c}_{h}h": v for h in hours for c, v in (("n", 0), ("missing_frac", 1.0))})
        for name in frame.keys() - {"device_id", "key", "anchor_us"}:
            a, b = frame[name], pane.get(name)
            assert (a is None) == (b is None), (place, name)
            assert a is None or a == pytest.approx(b, rel=1e-7, abs=1e-7), (place, name)


def test_a_pivot_takes_over_whole_rows(spark):
    """Values of a key with nulls among them, a key without a row, rows of their own for ``apart``; one aggregate for a key's row."""
    rows = [("d", 1, "x", 1.0, None, None), ("d", 1, "x", None, None, 7), ("d", 1, "y", None, "t", None), ("d", 2, "y", None, None, None), ("e", 1, "z", 9.0, "t", 9)]
    long = spark.createDataFrame(rows, "device_id string, anchor_us long, key string, a double, b string, c int")
    wide = trailing.pivot_features(long, ["x", "y"], ["a", "c", "b"], extra=[F.count(F.lit(1)).alias("n")], apart=["c"])
    assert wide.columns == ["device_id", "anchor_us", "x__a", "x__c", "x__b", "y__a", "y__c", "y__b", "n"]
    assert sorted(tuple(r) for r in wide.collect()) == [
        ("d", 1, 1.0, 7, None, None, None, "t", 3), ("d", 2, None, None, None, None, None, None, 1), ("e", 1, None, None, None, None, None, None, 1)
    ]
    many = trailing.pivot_features(long, ["x", "y"], ["a", "b", "c"])
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("first(") + plan.count("max(") == 2


def test_own_norms_and_gaps_come_in_one_row_with_the_windows(spark):
    """One row per key and anchor; z and gaps are those of the passes of their own, with nulls, equal times and keys of few readings."""
    rng = random.Random(3)
    rows = [(k, rng.randrange(0, 40 * 24 * 2) / 2, None if rng.random() < 0.2 else rng.random() * 100, None) for k, n in (("a", 120), ("b", 60), ("c", 30)) for _ in range(n)]
    r = readings(spark, rows)
    at = trailing.grid(spark.createDataFrame([("d1", T0, T0 + 960 * HOUR_US)], "device_id string, start_us long, end_us long"), 6 * HOUR_US)
    at = at.withColumn("key", F.explode(F.array(*map(F.lit, "abc")))).select("device_id", "key", "anchor_us")
    found = {(x.key, x.anchor_us): x for x in trailing.own_norm_features(at, r, streak_keys=2).collect()}
    assert len(found) == at.count() == trailing.own_norm_features(at, r, streak_keys=2).count()
    z = {(x.key, x.anchor_us): x.z for x in trailing.baseline_z(at, r).collect()}
    gaps = {(x.key, x.anchor_us): x.gap_max_h for x in trailing.longest_gap(at, r.where("value_num IS NOT NULL")).collect()}
    assert sum(v is not None for v in z.values()) > 100 and sum(v is not None for v in gaps.values()) > 100
    for at_key, row in found.items():
        assert row.z == (None if z[at_key] is None else pytest.approx(z[at_key], abs=1e-9))
        assert row.gap_max_h == (gaps[at_key] if at_key[0] in "ab" else None)


def test_texts_are_taken_over_with_the_last_values(spark):
    """A key that is numeric only, one of both kinds and one of texts only: no aggregate for each text column, and columns in their order."""
    r = readings(spark, [("n", 0, 1.0, None), ("b", 1, 2.0, None), ("b", 2, None, "-"), ("t", 3, None, "ok"), ("n", 13, 4.0, None)])
    wide = device_features(r, ["n", "b"], ["b", "t"], hours=[24])
    assert not re.search(r"max\(CASE WHEN \(key#\d+ = ", wide._jdf.queryExecution().optimizedPlan().toString())
    assert [c for c in wide.columns if c.endswith(("__last", "text_n_24h"))] == ["n__last", "b__last", "b__text_n_24h", "t__text_n_24h"]
    last = wide.orderBy(F.col("anchor_us").desc()).first()
    assert (last.b__text_n_24h, last.t__text_n_24h, last.b__text_last_len, last.t__text_bad_flag, last.n__n_24h) == (1, 1, 1, 0, 1)


def test_without_texts_a_device_comes_from_one_pass(spark):
    """Without pivot or join the columns are those of the pivots: equal times, nulls, keys not yet seen, ages at the caps; ``beside`` only where there are anchors."""
    rng = random.Random(5)
    rows = [(k, rng.randrange(0, 20 * 24) / 2, None if rng.random() < 0.2 else rng.random() * 9, "x") for k, n in (("n", 40), ("b", 15)) for _ in range(n)]
    r = readings(spark, [*rows, ("late", 230, 1.0, None), ("n", 6, 1.0, None), ("other", 0, 1.0, None)])
    r = r.union(r.where("key = 'n'").withColumn("device_id", F.lit("d2")))
    keys = ["n", "late", "b"]
    pivoted = device_features(r, keys, keys, hours=[24, 7])
    pivoted = pivoted.drop("g__n_text_keys", *(c for c in pivoted.columns if "__text_" in c))
    beside = spark.createDataFrame([("d1", (T0 // (6 * HOUR_US) + i) * 6 * HOUR_US, i) for i in (-9, 3, 8)], "device_id string, anchor_us long, y int")
    wide = device_features(r, keys, [], hours=[24, 7], beside=beside)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "RepartitionByExpression" not in plan
    assert sorted((x.device_id, x.y) for x in wide.where("y IS NOT NULL").collect()) == [("d1", 3), ("d1", 8)]
    wide = wide.drop("y", "g__n_text_keys")
    assert wide.columns == pivoted.columns and wide.dtypes == pivoted.dtypes and wide.count() == pivoted.count() > 70
    assert wide.exceptAll(pivoted).isEmpty() and pivoted.exceptAll(wide).isEmpty()
