from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry.operators import guards, hierarchy, outputs
from quarry.sources import readers


@pytest.mark.parametrize("text", ["SELECT 1", " with a as (select 1) select * from a ;;", "values (1)", "explain select 1", "TABLE t"])
def test_reads_pass(text):
    assert guards.read_only(text).rstrip(";") == guards.read_only(text)


@pytest.mark.parametrize("text", ["", ";", "DROP TABLE t", "select 1; select 2", "with x as (delete from t returning *) select * from x", "select * from t for update", "Vacuum", "explain insert into t values (1)"])
def test_writes_do_not(text):
    with pytest.raises(guards.WriteStatementError):
        guards.read_only(text)


def test_statuses(spark):
    window = "device_id string, window_closed boolean"
    none, one = spark.createDataFrame([], window), spark.createDataFrame([("d", True)], window)
    assert guards.dataset_status(one, none) == guards.Status.NO_USABLE_DATA
    assert guards.dataset_status(none, one) == guards.Status.NO_VERIFIED_EVIDENCE
    assert guards.dataset_status(one, one) == guards.Status.OK
    assert guards.read_sql(spark, "select 1 as x").first().x == 1


def test_levels_by_name(spark):
    names = {"Zonal Office North": "zo", "SBI LHO Delhi": "lho", "Head Office": "ho", "Local Head Office": "lho", "Main St": None}
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", hierarchy.level_of_name(F.col("n")).alias("level"))
    assert {r.n: r.level for r in df.collect()} == names


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿a,b\n=1,\n".encode())
    assert [tuple(r) for r in readers.csv(spark, str(tmp_path / "bom.csv")).collect()] == [("=1", None)]
    assert readers.csv(spark, str(tmp_path / "bom.csv")).columns == ["a", "b"]
    (tmp_path / "ledger.jsonl").write_text('{"device_id":"d","completeness":"complete","rows":3}\nbroken\n')
    assert [(r.device_id, r.rows) for r in readers.ledger(spark, str(tmp_path / "ledger.jsonl")).collect()] == [("d", 3)]
    assert readers.staged(spark, str(tmp_path / "absent"), 0, 1).count() == 0
    with pytest.raises(readers.SchemaError):
        readers.require_columns(spark.range(1), ["us"])
    (tmp_path / "current_state_1.csv").write_text("device_id\nx\n")
    assert readers.snapshots(spark, str(tmp_path / "current_state_*.csv")).first().source_file == "current_state_1.csv"
    options = readers.jdbc_day_reads("jdbc:x", "t", [("a", "b")], ["k'1"])
    assert options["predicates"] == ["time >= 'a' AND time < 'b' AND key IN ('k''1')"]


def test_empty_columns_go_and_long_cells_are_cut(spark):
    df = spark.createDataFrame([("x" * 50, "n/a", 1), ("y", None, None)], "a string, b string, c int")
    found = outputs.drop_empty_columns(df, most_chars=10)
    assert found.columns == ["a", "c"] and {len(r.a) for r in found.collect()} == {10, 1}
    assert "| rows | 3 |" in outputs.quality_report("T", {"rows": 3})
