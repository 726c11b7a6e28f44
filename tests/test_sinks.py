"""What is written to files, batches over the cap, and keep-last over several micro-batches."""

from __future__ import annotations

import glob

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import outputs, trailing
from quarry.plans import features
from quarry.sources import by_device, extract, readers
from quarry.streaming import stateful

RAW = "device_id string, key string, arrival_seq long, time string, value_num double, value_text string"


DAY = 19_724  # 2024-01-02


def test_batches_are_records_and_a_rerun_fills_in(spark, tmp_path):
    day = "2024-01-02 00:00:0"
    rows = [("d", "a", i, f"{day}{i}", 1.0, None) for i in range(3)] + [("d", "b", 9, f"{day}1", 1.0, None), ("d", "b", 10, f"{day}2", None, None)]
    rows += [("d", "b", 11, None, 1.0, None), ("d", "c", 12, "2024-01-03 00:00:00", 1.0, None), ("d", "c", 13, "2024-01-05 00:00:00", 1.0, None)]
    raw = spark.createDataFrame(rows, RAW).withColumn("day", F.expr("coalesce(datediff(to_date(time), '1970-01-01'), 0)").cast("long"))
    path, calls = str(tmp_path / "days"), []
    good = extract.telemetry_reader(raw, features.NOW_US)

    def flaky(batch):
        calls.append(batch.name)
        if batch.day == DAY + 1 and batch.part == 2:
            raise RuntimeError("source down")
        return good(batch)

    work = extract.batches(DAY, DAY + 9, ["c", "b", "a"], 1, most_days=2)
    assert [(b.day - DAY, b.keys) for b in work] == [(d, (k,)) for d in (0, 1) for k in "abc"]
    first = {(r.day - DAY, r.part): (r.status, r.n_rows, r.n_written) for r in extract.run(spark, work, flaky, path, cap=3).collect()}
    assert first == {(0, 0): ("over_cap", 3, 0), (0, 1): ("ok", 2, 1), (0, 2): ("empty", 0, 0), (1, 0): ("empty", 0, 0), (1, 1): ("empty", 0, 0), (1, 2): ("failed", None, 0)}
    folder = extract.Folder(spark, path)
    assert [r.arrival_seq for r in folder.rows(raw.drop("day").schema).collect()] == [9]
    calls.clear()
    again = {(r.day - DAY, r.part): r for r in extract.run(spark, work, lambda b: (calls.append(b.name), good(b))[1], path, cap=4).collect()}
    assert sorted(calls) == [work[0].name, work[5].name]  # what was done is not read again
    assert {(r.status, r.attempt) for r in again.values()} == {("ok", 1), ("ok", 2), ("empty", 1)}
    assert sorted(r.arrival_seq for r in folder.rows(raw.drop("day").schema).collect()) == [0, 1, 2, 9, 12]
    assert "source down" not in (again[1, 2].error or "")
    none = extract.Folder(spark, str(tmp_path / "none"))
    assert none.manifest().count() == 0 and none.rows(raw.schema).count() == 0


def test_the_layout_by_device_needs_no_exchange(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{k % 7}", k, float(k)) for k in range(100)], "device_id string, us long, v double")
    table = by_device.save(rows, "by_device_test", str(tmp_path / "t"), 4)
    w = Window.partitionBy("device_id").orderBy("us")
    seen = table.withColumn("before", F.lag("v").over(w)).groupBy("device_id").agg(F.count("before").alias("n"))
    joined = seen.join(by_device.load(spark, "by_device_test").hint("merge"), "device_id")
    assert by_device.exchanges(seen) == 0 and by_device.exchanges(joined) == 0
    assert by_device.exchanges(rows.groupBy("device_id").count()) == 1
    assert sum(r.n for r in seen.collect()) == 93 and joined.count() == 100
    assert by_device.load(spark, "by_device_test", ["d3"]).count() == 14
    assert list(by_device.devices_of(spark, "by_device_test", 3)) == [["d0", "d1", "d2"], ["d3", "d4", "d5"], ["d6"]]
    by_device.save(rows.limit(5), "by_device_test", str(tmp_path / "t"), 4)
    assert spark.table("by_device_test").count() == 5


def test_cache_takes_up_missing_devices_only(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "device_id string, us long")
    by_device.cached(rows.where("device_id = 'a'"), str(tmp_path / "c"))
    changed = rows.withColumn("us", F.col("us") + 10)
    assert sorted((r.device_id, r.us) for r in by_device.cached(changed, str(tmp_path / "c")).collect()) == [("a", 1), ("a", 2), ("b", 13)]
    assert glob.glob(f"{tmp_path}/c/*/*.json.gz")


def test_sheets_begin_with_a_mark_and_hold_no_formula(spark, tmp_path):
    path = str(tmp_path / "sheet")
    outputs.write_csv_bom(spark.createDataFrame([("=1+1", 2)], "cell string, n int").coalesce(1), path)
    assert open(glob.glob(f"{path}/*.csv")[0], "rb").read().startswith(b"\xef\xbb\xbfcell,n\n")
    assert [tuple(r) for r in readers.csv(spark, path).collect()] == [("'=1+1", "2")]


def test_events_without_bridged_alarms(spark, tmp_path):
    root = str(tmp_path / "events")
    outputs.write_parquet(spark.createDataFrame([("d", 1, 5)], "device_id string, us long, day int"), root, by=["day"])
    assert [tuple(r) for r in readers.staged_events(spark, root).collect()] == [("d", 1, "event")]


def test_last_of_each_over_batches(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "k string, seq long, v string"
    for rows in ([("a", 1, "first"), ("b", 7, "newest")], [("a", 3, "newest"), ("b", 2, "older")], [("a", 2, "between")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    found = stateful.last_of_each(stream, ["k"], "seq", str(tmp_path / "out")).collect()
    assert {(r.k, r.seq, r.v) for r in found} == {("a", 3, "newest"), ("b", 7, "newest")}


def test_texts_of_the_wide_features(spark):
    hour, t0 = features.STEP_US // 6, features.START_US
    said = [("k", 0, None, "online"), ("k", 2, None, "No data"), ("k", 3, None, "online"), ("k", 4, None, " -12.5 "), ("n", 5, 1.0, None)]
    r = spark.createDataFrame([("d", k, t0 + h * hour, i, n, t) for i, (k, h, n, t) in enumerate(said)], "device_id string, key string, us long, arrival_seq long, value_num double, value_text string")
    at = spark.createDataFrame([("d", k, t0 + h * hour) for k in "kn" for h in (3, 6, 25)], "device_id string, key string, anchor_us long")
    f = {(x.key, (x.anchor_us - t0) // hour): x for x in trailing.key_features(at, r).collect()}
    got = lambda x: (x.text_n_24h, x.text_distinct_24h, x.text_changes_24h, x.text_last_len, x.text_bad_flag, x.text_last_numeric)
    assert got(f["k", 3]) == (3, 2, 2, 6, 0, 0)
    assert got(f["k", 6]) == (4, 3, 3, 7, 0, 1)
    assert got(f["k", 25]) == (3, 3, 2, 7, 0, 1)
    assert got(f["n", 6]) == (0, 0, 0, None, None, None) and f["n", 6].rows_total == 1 and f["n", 3].missing_frac_24h == 1.0
    assert r.where(F.col("us") > t0 + 3 * hour).count() == 2
