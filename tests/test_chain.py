"""Runs of steps: records, skipped steps, reruns; and the nightly report."""

from __future__ import annotations

from quarry.operators import chain, models
from quarry.plans import streams
from quarry.streaming import runs


def test_failures_are_records_and_reruns_go_on(spark, tmp_path):
    calls = []

    def step(name, needs=(), fail=False, **options):
        def work(done):
            calls.append(name)
            if fail:
                raise ValueError("no such thing\nsecond line")
            return spark.range(len(done) + 1)

        return chain.Step(name, work, needs, **options)

    def steps(fail):
        return [step("a"), step("b", fail=fail), step("c", ("b",)), step("d", ("a",))]

    outcome, done, manifest = chain.run(spark, steps(True), str(tmp_path / "r"))
    found = {r.step: (r.status, r.error, r.n_rows, r.attempt) for r in manifest.collect()}
    assert outcome is chain.Outcome.INCOMPLETE and set(done) == {"a", "d"}
    assert found == {"a": ("ok", None, 1, 1), "b": ("failed", "ValueError: no such thing", None, 1), "c": ("skipped", "needs b", None, 1), "d": ("ok", None, 2, 1)}
    calls.clear()
    outcome, done, manifest = chain.run(spark, steps(False), str(tmp_path / "r"))
    assert outcome is chain.Outcome.OK and calls == ["b", "c"] and done["c"].count() == 3
    assert {r.step: (r.status, r.attempt) for r in manifest.collect()} == {"a": ("ok", 1), "b": ("ok", 2), "c": ("ok", 2), "d": ("ok", 1)}
    outcome, done, manifest = chain.run(spark, [step("a", fail=True, tolerated=False), step("b")], str(tmp_path / "s"))
    assert outcome is chain.Outcome.FAILED and not done and manifest.count() == 1


def test_nightly_report_names_every_device(spark, small_tables, tmp_path):
    rows, columns = streams._risk_rows(spark, small_tables)
    rows = runs.written(rows, "risk")
    assert {r.y for r in rows.select("y").distinct().collect()} == {0, 1}
    model = streams._stored_model(spark, rows, columns)
    steps = streams.nightly_steps(spark, small_tables, model)
    outcome, done, _ = chain.run(spark, steps, str(tmp_path / "night"))
    report = {r.device_id: r for r in done["report"].collect()}
    in_service = {r.device_id for r in done["registry"].where("keep").collect()}
    assert outcome is chain.Outcome.OK and set(report) == in_service
    scored = {r.device_id: r for r in done["scores"].collect()}
    last = {r.device_id: r[1] for r in done["features"].groupBy("device_id").agg({"anchor_us": "max"}).collect()}
    for d, r in report.items():
        assert (r.tier == "NO_DATA") == (d not in scored) == (r.note is not None)
        if d in scored:
            assert r.probability == scored[d].probability and r.anchor_us == last[d]
            assert r.tier == ("CRITICAL" if r.probability >= 0.5 else "HIGH" if r.probability >= 0.4 else "MEDIUM" if r.probability >= 0.25 else "HEALTHY")
    # without the readings there is nothing to score, and the run says so
    broken = [chain.Step("readings", lambda done: 1 / 0) if s.name == "readings" else s for s in steps]
    outcome, done, manifest = chain.run(spark, broken, str(tmp_path / "bad"))
    found = {r.step: r.status for r in manifest.collect()}
    assert outcome is chain.Outcome.FAILED and found == {"registry": "ok", "readings": "failed", "features": "skipped"}
    loaded, _ = models.load(spark, model)
    assert loaded.stages[-1].getNumTrees == 5
