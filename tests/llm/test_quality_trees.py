"""Boosted trees against plain loops: how they are grown, how they are walked, and what the quality rule keeps."""

from __future__ import annotations

import math

import numpy as np
import pytest

from quarry.llm import boosting, quality
from quarry.llm.storage import documents
from quarry.llm.text_stats import COUNTS, SHAPE


def walk(model: boosting.FlatTrees, row: list[float]) -> float:
    """Probability of one row, node after node."""
    total = model.bias
    for root in model.roots:
        at = int(root)
        while model.feature[at] >= 0 and model.left[at] != at:
            at = int(model.left[at] if row[model.feature[at]] <= model.threshold[at] else model.right[at])
        total += model.value[at]
    return 1 / (1 + math.exp(-total))


def check_growth(model, x, y, monotone, *, depth, rate=0.2, bins=64, ridge=1.0, least=5) -> int:
    """Every split is as good as the best of all thresholds tried on every row, every leaf has no split left and its Newton step.

    Of splits that are equally good any may stand. Returns how many splits there are.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    margin, splits = [model.bias] * n, 0
    p1 = y.mean()
    assert model.bias == pytest.approx(math.log(p1 / (1 - p1)))

    def weight(rows, low, high):
        return min(max(-sum(g[r] for r in rows) / (sum(h[r] for r in rows) + ridge), low), high)

    def loss(rows, w):
        return sum(g[r] for r in rows) * w + 0.5 * (sum(h[r] for r in rows) + ridge) * w * w

    def gain(rows, f, t, low, high):
        """None where the split is not allowed."""
        a, b = [r for r in rows if x[r, f] <= t], [r for r in rows if x[r, f] > t]
        if len(a) < least or len(b) < least:
            return None
        wa, wb = weight(a, low, high), weight(b, low, high)
        if monotone[f] * (wb - wa) < 0:
            return None
        return loss(rows, weight(rows, low, high)) - loss(a, wa) - loss(b, wb), a, b, (wa + wb) / 2

    def check(at, rows, level, low, high):
        nonlocal splits
        tried = [found[0] for f in range(width) for t in edges[f] if (found := gain(rows, f, t, low, high))]
        best = max(tried, default=0.0) if level < depth and len(rows) >= 2 * least else 0.0
        if model.feature[at] < 0 or model.left[at] == at:
            assert best <= 1e-8
            assert model.value[at] == pytest.approx(rate * weight(rows, low, high))
            for r in rows:
                margin[r] += model.value[at]
            return
        splits += 1
        f = int(model.feature[at])
        own, a, b, mid = gain(rows, f, model.threshold[at], low, high)
        assert own == pytest.approx(best, abs=1e-9) and best > 0
        left, right = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[int(monotone[f])]
        check(int(model.left[at]), a, level + 1, *left)
        check(int(model.right[at]), b, level + 1, *right)

    for root in model.roots:
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [q - t for q, t in zip(p, y)], [q * (1 - q) for q in p]
        check(int(root), list(range(n)), 0, -math.inf, math.inf)
    assert model.margin(x) == pytest.approx(margin, abs=1e-9)
    return splits


@pytest.mark.parametrize("seed", range(4))
def test_trees_are_grown_as_by_trying_all_splits(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(60, 3)), 2)
    y = (x[:, 0] + 0.7 * x[:, 1] * x[:, 2] + rng.normal(size=60) > 0).astype(float)
    monotone = np.array([[0, 0, 0], [1, 0, 0], [-1, 1, 0], [1, -1, -1]][seed])
    model = boosting.fit(x, y, monotone, trees=6, depth=3)
    assert check_growth(model, x, y, monotone, depth=3) > 10
    fresh = rng.normal(size=(200, 3))
    assert model.probability(fresh) == pytest.approx([walk(model, list(r)) for r in fresh], abs=1e-12)
    for f in range(3):
        if monotone[f]:
            low, high = fresh.copy(), fresh.copy()
            high[:, f] += rng.random(200)
            assert (monotone[f] * (model.margin(high) - model.margin(low)) >= -1e-12).all()


def test_kept_equals_a_plain_walk(spark, small_tables):
    docs = documents(spark, small_tables)
    model = quality.train(docs, spark.read.parquet(f"{small_tables}/labels.parquet"))
    rows = quality.judge(docs, model).collect()
    kept = 0
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        score = walk(model, list(quality.features(np.array([[r[c] for c in (*COUNTS, *SHAPE)]], np.int64))[0]))
        assert r.score == pytest.approx(score, abs=1e-12)
        assert r.kept == (not r.base_failed and r.score >= 0.5)
        kept += r.kept
    assert 0 < kept < len(rows)
