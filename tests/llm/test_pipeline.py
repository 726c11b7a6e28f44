"""The pipeline's stages, each on what the one before kept, and the SQL oracles of the queries."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline  # noqa: E402
from oracle import assert_equal  # noqa: E402

from quarry.llm import packing, queries, quality, simhash, suffix_dedup  # noqa: E402
from quarry.llm.storage import documents, settle  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_oracle(spark, small_tables, name):
    assert_equal(queries.queries()[name](spark, small_tables), queries.oracle_sql()[name], small_tables)


def test_stages(spark, small_tables):
    docs = documents(spark, small_tables)
    columns, states = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, small_tables), "stage")
        states.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    start, judged, single, cut, mixed, packed = ({(r.doc_id, r[1]) for r in s.collect()} for s in states)
    model = quality.train(states[0], spark.read.parquet(f"{small_tables}/labels.parquet"))
    assert judged == {x for x in start if x[0] in {r.doc_id for r in quality.judge(states[0], model).where("kept").collect()}}
    groups = simhash.near_copies(states[1]).collect()
    assert {x[0] for x in single} == {r.component_id for r in groups}
    report = {r.doc_id: r for r in suffix_dedup.removal_report(states[2], length=suffix_dedup.PASSAGE).collect()}
    before = dict(single)
    for i, t in cut:
        assert len(before[i].encode()) - len(t.encode()) <= report[i].n_removed
        assert (before[i] == t) == (report[i].n_removed == 0)
    assert mixed <= cut
    assert {i for i, _ in packed} == {i for i, _ in mixed}
    pieces = states[5].toPandas()
    assert pieces.groupby("sequence_id")["length"].sum().max() <= packing.SEQUENCE


def test_awkward_rows_pass_through(spark, small_tables, corpus, no_rows):
    for docs in (corpus.withColumn("a.b", F.lit(1)), no_rows):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = settle(stage(spark, docs, small_tables), "stage")
        corpus_pipeline.STAGES[-1][1](spark, docs, small_tables).count()
