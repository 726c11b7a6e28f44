"""Anti-joins and unmatched sides of queries that read whole tables, on a small fixture."""

from __future__ import annotations

from quarry.plans import catalog


def test_unmatched_sides(spark, tmp_path):
    """A device with a score, one without; one with weak evidence only, one with a disconnect beside it."""
    events = [
        (1, "2024-01-02 00:00:00", 1, "view", 9.0), (5, "2024-01-03 00:00:00", 1, "view", 1.0),
        (2, "2024-01-02 00:00:00", 2, "view", 3.0), (3, "2024-01-03 00:00:00", 2, "error", 3.0),
    ]
    rows = spark.createDataFrame(events, "event_id long, ts string, user_id long, event_type string, value double")
    rows.selectExpr("event_id", "CAST(ts AS TIMESTAMP_NTZ) AS ts", "user_id", "event_type", "value", "'{}' AS props").write.parquet(f"{tmp_path}/events.parquet")
    customers = [(k, f"c{k}", 0, 0.0, "m") for k in (1, 2, 3)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "n", 0)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "r")], "r_regionkey long, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    chain = {r.device_id: (r.probability, r.tier) for r in catalog.queries()["nightly_chain"](spark, str(tmp_path)).collect()}
    assert chain == {"1": (0.1, "HEALTHY"), "2": (0.3, "MEDIUM"), "3": (None, "NO_DATA")}
    assert [r.device_id for r in catalog.queries()["set_except"](spark, str(tmp_path)).collect()] == ["1"]
