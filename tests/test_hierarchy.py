"""The relation walk against a plain recursion, and the interval sweep against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import hierarchy, outages


def plain_walk(relations, entities, node, depth=0):
    """Depth first: a field has the value of the first entity that names it."""
    result = {}
    if depth >= hierarchy.MOST_DEPTH:
        return result
    for parent, _ in sorted(((p, o) for c, p, o in relations if c == node), key=lambda x: (x[1], x[0])):
        if parent not in entities:
            continue
        expands, fields = entities[parent]
        for k, v in fields.items():
            result.setdefault(k, v)
        if expands:
            for k, v in plain_walk(relations, entities, parent, depth + 1).items():
                result.setdefault(k, v)
    return result


@pytest.mark.parametrize("seed", range(3))
def test_walk_equals_recursion(spark, seed):
    rng = random.Random(seed)
    names = [f"a{k}" for k in range(14)]
    entities = {n: (rng.random() < 0.85, {f: rng.choice(["", n, f"{n}-{f}"]) for f in rng.sample(["branch_name", "nbg_name", "ho_name", "zo_name", "x"], 2)}) for n in names[:12]}
    pairs = {(rng.choice(names), rng.choice(names)) for _ in range(22)} | {(f"a{k}", f"a{k + 1}") for k in range(11)}
    relations = [(c, p, rng.randint(0, 2)) for c, p in pairs] + [(f"d{k}", rng.choice(names), o) for k in range(8) for o in (0, 1)]
    relations = list({(c, p): (c, p, o) for c, p, o in relations}.values())
    own = {f"d{k}": {"branch_name": "B", "nbg_name": "N" if k == 1 else ""} if k < 3 else {} for k in range(8)} | {"lonely": {}}
    devices = spark.createDataFrame([(d, "c" + d[-1], f) for d, f in own.items()], "device_id string, customer_id string, fields map<string,string>")
    givers = {"c2": ("Bank 2", "Group 2"), "c5": ("", "Group 5"), "c6": ("Bank 6", "")}
    found = hierarchy.merge_hierarchy(
        devices, spark.createDataFrame(relations, "child string, parent string, ord int"),
        spark.createDataFrame([(n, e, f) for n, (e, f) in entities.items()], "id string, expands boolean, fields map<string,string>"),
        spark.createDataFrame([(c, *g) for c, g in givers.items()], "customer_id string, bank_name string, nbg_name string"),
    ).collect()
    for r in found:
        fields = {k: v for k, v in own[r.device_id].items() if v}
        if not fields.get("nbg_name") or not fields.get("branch_name"):
            for k, v in plain_walk(relations, entities, r.device_id).items():
                if not fields.get(k) and v:
                    fields[k] = v
        if not fields.get("nbg_name") and r.customer_id in givers:
            fields |= dict(zip(("bank_name", "nbg_name"), givers[r.customer_id]))
        assert r.fields == {k: v for k, v in fields.items() if v}
        path = [fields[k] for k in hierarchy.PATH_LEVELS if fields.get(k)]
        assert (r.full_path, r.hierarchy_depth) == (" → ".join(path), len(path))
    assert len(found) == len(own)


def test_walk_without_relations(spark):
    none = spark.createDataFrame([], "child string, parent string, ord int")
    entities = spark.createDataFrame([], "id string, expands boolean, fields map<string,string>")
    customers = spark.createDataFrame([], "customer_id string, bank_name string, nbg_name string")
    devices = spark.createDataFrame([("d", None, None)], "device_id string, customer_id string, fields map<string,string>")
    (row,) = hierarchy.merge_hierarchy(devices, none, entities, customers).collect()
    assert (row.fields, row.full_path, row.hierarchy_depth) == ({}, "", 0)


@pytest.mark.parametrize("seed", range(3))
def test_sweep_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    samples = [(f"d{rng.randint(0, 2)}", rng.randint(0, 60), k) for k in range(80)]
    windows = [(f"d{rng.randint(0, 3)}", a, rng.choice([a, a + rng.randint(0, 9), None])) for a in (rng.randint(0, 60) for _ in range(25))]
    frame = spark.createDataFrame(samples, "device_id string, anchor_us long, id int").withColumn("a.b", F.lit(1))
    spans = spark.createDataFrame(windows, "device_id string, outage_start long, outage_end long")
    swept = outages.next_start(outages.sweep(frame, spans, 7), spans)
    assert swept.columns == ["device_id", "anchor_us", "id", "a.b", "inside", "n_ahead", "first_start"]
    plan = swept._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    found = {r.id: (r.inside, r.n_ahead, r.first_start) for r in swept.collect()}
    for d, t, k in samples:
        own = [(a, b) for w, a, b in windows if w == d]
        after = [a for a, _ in own if a > t]
        assert found[k] == (any(b is not None and a <= t <= b for a, b in own), sum(a <= t + 7 for a in after), min(after, default=None))
