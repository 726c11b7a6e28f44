"""Listings by pages: every entity once, conditions that reach the service, and calls paced over all tasks."""

from __future__ import annotations

import glob
import json
import os

import pytest

from quarry.sources import registry_pull

ROWS = [(f"i{k:03d}", f"n{k % 50:02d}", "ab"[k % 2], str(k % 3)) for k in range(103)]
SCHEMA = "id string, name string, type string, customer_id string"


@pytest.fixture
def listing(spark, tmp_path):
    spark.dataSource.register(registry_pull.RegistrySource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.json(f"{tmp_path}/store/kind=device")
    (tmp_path / "log").mkdir()

    def read(**options):
        common = {"client": "quarry.sources.registry_pull:StagedRegistry", "store": f"{tmp_path}/store", "kind": "device", "page_size": "10", "base_s": "0.001", "log": f"{tmp_path}/log"}
        return spark.read.format("paged_registry").schema(SCHEMA).options(**(common | options)).load()

    return read


def calls(tmp_path):
    return sorted((int(n.split("-")[0]), n.split("-", 1)[1], json.loads((tmp_path / "log" / n).read_text())) for n in os.listdir(tmp_path / "log"))


@pytest.mark.parametrize("parts", ["1", "4", "50"])
def test_every_entity_once(listing, parts):
    assert sorted(tuple(r) for r in listing(partitions=parts, faults="busy").collect()) == sorted(ROWS)


def test_unknown_kinds_are_empty_and_absent_columns_null(spark, listing, tmp_path):
    assert listing(kind="asset").count() == 0
    spark.createDataFrame([("x", "n")], "id string, name string").write.json(f"{tmp_path}/store/kind=customer")
    assert [tuple(r) for r in listing(kind="customer").collect()] == [("x", "n", None, None)]


def test_conditions_reach_the_service(listing, tmp_path):
    found = listing().where("type = 'a' AND customer_id = '1' AND name > 'n10'").collect()
    assert sorted(tuple(r) for r in found) == sorted(r for r in ROWS if r[2] == "a" and r[3] == "1" and r[1] > "n10")
    assert all(wanted == {"type": "a", "customer_id": "1"} for _, _, wanted in calls(tmp_path))
    assert {page for _, page, _ in calls(tmp_path)} == {"device-0", "device-1"}  # 17 rows fit two pages of ten


def test_pages_are_asked_for_at_the_stated_rate(listing, tmp_path):
    listing(partitions="4", calls_per_second="20").collect()
    times = [t / 1e9 for t, _, _ in calls(tmp_path)]
    assert len(times) == 1 + 11  # the total, then eleven pages
    spread = [t for t in times[1:]]
    # each of four tasks asks at most five times a second
    assert spread[-1] - spread[0] >= 2 * 0.2 - 0.05


def test_a_task_reads_each_slice_once_and_holds_one(spark, tmp_path, monkeypatch):
    """Pages come from the slices that hold them, with and without conditions, and no slice is opened again for each page."""
    import pyarrow.dataset as pads

    registry_pull.stage(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path), "device", slice_rows=10)
    slices = len(glob.glob(f"{tmp_path}/kind=device/part-*"))
    opened, dataset = [], pads.dataset
    monkeypatch.setattr(pads, "dataset", lambda path, **rest: opened.append(path) or dataset(path, **rest))
    for wanted in ({}, {"type": "a"}, {"type": "a", "customer_id": "1"}, {"type": "none"}):
        client, found, number, more = registry_pull.SlicedRegistry({"store": str(tmp_path)}), [], 0, True
        expected = [r for r in ROWS if ("type", r[2]) in wanted.items() or "type" not in wanted]
        expected = [r for r in expected if ("customer_id", r[3]) in wanted.items() or "customer_id" not in wanted]
        opened.clear()
        while more:
            page = client.page("device", number, 7, wanted)
            assert page["total"] == len(expected) and len(page["data"]) <= 7
            found, number, more = found + page["data"], number + 1, page["hasNext"]
        assert number == max(1, -(-len(expected) // 7))
        assert sorted(tuple(r.values()) for r in found) == sorted(expected)
        assert len(opened) == len(set(opened)) <= slices + 1  # the counts, and each slice at most once
        assert client.page("device", 0, 7, {"absent": "x"})["total"] == 0


@pytest.mark.parametrize("parts", ["1", "4", "50"])
def test_a_sliced_listing_through_the_source(spark, listing, tmp_path, parts):
    registry_pull.stage(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/sliced", "device", slice_rows=10)
    registry_pull.stage(spark.createDataFrame([], "id string, name string"), f"{tmp_path}/sliced", "none")
    sliced = {"client": "quarry.sources.registry_pull:SlicedRegistry", "store": f"{tmp_path}/sliced", "faults": "busy", "partitions": parts}
    assert sorted(tuple(r) for r in listing(**sliced).collect()) == sorted(ROWS)
    assert sorted(tuple(r) for r in listing(**sliced).where("type = 'b'").collect()) == sorted(r for r in ROWS if r[2] == "b")
    assert listing(**sliced, kind="none").count() == 0 == listing(**sliced, kind="none").where("type = 'b'").count()
