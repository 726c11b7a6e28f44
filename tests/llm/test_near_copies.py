"""The pipeline's near-dedup stage against brute force over all pairs of texts."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline  # noqa: E402

from quarry.llm import simhash  # noqa: E402


def _likeness(a: str, b: str) -> float:
    x, y = set(simhash.shingles(a, 5)), set(simhash.shingles(b, 5))
    return len(x & y) / len(x | y)


def test_near_copies_beyond_two_bits_go(spark, small_tables):
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(5000)}"
    texts = []
    for _ in range(30):
        words = [word() for _ in range(200)]
        for changes in (0, 3, 6, 25):
            copy = list(words)
            for at in rng.choice(200, changes, replace=False):
                copy[at] = word()
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = [simhash.word_simhash(t) for t in texts]
    near = [
        (i, j) for i in range(len(texts)) for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 7 and _likeness(texts[i], texts[j]) >= 0.8
    ]
    assert sum((prints[i] ^ prints[j]).bit_count() > 2 for i, j in near) > 10
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, small_tables).collect()}
    assert not [p for p in near if p[0] in kept and p[1] in kept]
    for i in set(range(len(texts))) - kept:
        assert any(_likeness(texts[i], texts[j]) >= 0.8 for j in kept if j < i)


def test_rounds_and_tasks_give_the_same_groups(spark):
    """Components too large for a task are grouped by rounds, with the result of a plain greedy search."""
    rng = np.random.default_rng(11)
    texts = []
    for b in range(4):
        words = [f"w{b}x{rng.integers(4000)}" for _ in range(150)]
        for changes in (0, 1, 2, 9, 14):
            copy = list(words)
            for at in rng.choice(150, changes, replace=False):
                copy[at] = f"v{rng.integers(9000)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame([(None if k == 3 else k, t) for k, t in enumerate([*texts, "", None])], "doc_id long, text string")
    in_tasks = {r.mark: (r.component, r.component_id) for r in simhash.near_copies(docs).collect()}
    by_rounds = {r.mark: (r.component, r.component_id) for r in simhash.near_copies(docs, task_shingles=0).collect()}
    assert in_tasks == by_rounds and 1 < len({c for c, _ in in_tasks.values()}) < len(in_tasks)


def test_pairs_of_bands_miss_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    moved = [int(v) ^ sum(1 << int(b) for b in rng.choice(64, k % 10, replace=False)) for k, v in enumerate(base)]
    values = sorted({*map(int, base), *moved})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "simhash long"), 7, two_bands=True).collect()
    found = {frozenset((e.a, e.b)) for e in edges}
    near = {frozenset((signed[i], signed[j])) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 7}
    assert found == near
