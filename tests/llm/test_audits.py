"""Whitening, source divergence and url filters against brute force; tables that concurrent runs write."""

from __future__ import annotations

import math
import os
import re
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from oracle import assert_equal
from pyspark.sql import functions as F

from quarry.llm import divergence, mixing, oracles, storage, suffix_dedup, url_filters, whitening

# ---- whitening


def brute_whitening(vectors: list[list[float]]) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """Whole entries, deviations, eigenvalues and eigenvectors (columns), by two plain passes."""
    x = np.array([[math.floor(1024 * float(np.float32(e))) + 100_000 for e in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    deviations = [sum(int(n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    centred = x - sums / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return centred, deviations, values[::-1], columns[:, ::-1]


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    data = (rng.normal(size=(240, 11)) @ rng.normal(size=(11, 11)) + 7).astype(np.float32).tolist()
    rows = [(i, v, None) for i, v in enumerate(data)]
    rows += [(900, None, 1), (901, [1.0] * 10 + [None], 1), (902, [math.nan] + [1.0] * 10, 1), (903, [math.inf] * 11, 1), (904, [1.0], 1), (905, [], 1)]
    rows += [(None, data[5], 1), (7, data[7], 1)]
    fit_list = [*data, data[5], data[7]]
    centred, deviations, values, columns = brute_whitening(fit_list)
    found = whitening.whitened_rows(vectors_frame(spark, rows).withColumn("n", F.lit("x"))).collect()
    assert len(found) == len(fit_list) * 8
    assert {r.n for r in found} == {len(fit_list)} and {r.component for r in found} == set(range(1, 9))
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9
    by = {(r.vec_id, r.component): r for r in found if r.vec_id is not None}
    for i in range(240):
        for k in range(8):
            r = by[i, k + 1]
            assert r.deviation == deviations[i]
            assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
            assert abs(r.whitened) == pytest.approx(abs(centred[i] @ columns[:, k]) / math.sqrt(values[k]), abs=1e-8)
    # one sign for all rows of a component
    for k in range(8):
        signs = {np.sign(by[i, k + 1].whitened * (centred[i] @ columns[:, k])) for i in range(240)}
        assert len(signs) == 1


def test_pairs_in_several_jobs_agree(spark):
    rng = np.random.default_rng(5)
    vectors = whitening.usable(vectors_frame(spark, [(i, rng.normal(size=6).astype(np.float32).tolist(), 0) for i in range(50)]))
    n, sums = whitening._exact_sums(vectors, 6)
    whole = whitening.covariance(vectors, n, sums)
    assert (whole == whitening.covariance(vectors, n, sums, pairs_per_job=4)).all()


def test_whitening_cases(spark):
    empty = whitening.whitened_rows(vectors_frame(spark, []))
    assert empty.count() == 0 and dict(empty.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double",
    }
    assert whitening.whitened_rows(vectors_frame(spark, [(1, None, 0), (2, [None], 0)])).count() == 0
    assert whitening.whitened_rows(vectors_frame(spark, [(k, [1.0, 2.0], 0) for k in range(5)])).count() == 0  # nothing varies
    flat = whitening.whitened_rows(vectors_frame(spark, [(k, [float(k), 2.0 * k, 1.0], 0) for k in range(6)])).collect()
    assert {r.component for r in flat} == {1} and flat[0].explained == pytest.approx(1.0)
    far = whitening.whitened_rows(vectors_frame(spark, [(0, [3e38, 1.0], 0), (1, [-3e38, 2.0], 0), (2, [0.0, 5.0], 0)])).collect()
    assert {r.vec_id for r in far} == {0, 1, 2} and all(math.isfinite(r.whitened) for r in far)


# ---- divergence


def brute_audit(rows: list[tuple], least: int, most: int) -> set[tuple]:
    terms = [[("" if lang is None else lang), ("" if source is None else source), [
        "".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    ]] for _, text, lang, source, *_ in rows]
    out = set()
    for lang in {t[0] for t in terms}:
        own = [t for t in terms if t[0] == lang]
        df = Counter(w for t in own for w in set(t[2]))
        kept = sorted(w for w, n in df.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, words in own:
            counts[source].update(w for w in words if w in set(kept))
        whole = sum(counts.values(), Counter())

        def shares(c: Counter) -> dict[str, int]:
            mass = sum(c.values()) + 2 * len(kept)
            return {w: 1 + 1_000_000_000 * (c[w] + 2) // mass for w in kept}

        def apart(p: int, q: int) -> int:
            return (p - q) ** 2 // (p + q)

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(sum(apart(p[s][w], p[o][w]) for w in kept), o) for o in counts if o != s]
            telling = [(apart(p[s][w], q[w]), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, items, limit in (("pair", pairs, None), ("term", telling, most)):
                for k, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]):
                    out.add((lang, s, part, item, value, k + 1))
    return out


def test_audit_equals_brute_force(spark, corpus):
    rng = np.random.default_rng(1)
    words = ["alpha", "Beta", "gamma", "Été", "été", "x1y", "naïve", "\U00010400z", "omega"]
    rows = [
        (k, " ".join(rng.choice(words, rng.integers(0, 12))), ["en", "fr", None][k % 3], [f"s{k % 4}", None, "", "s9"][k % 4 if k % 5 else 1], 0)
        for k in range(120)
    ]
    rows += [(1, None, "de", "a", 0), (1, "12 34", "de", "b", 0), (None, "x", "lonely", "a", 0), (3, "A a A", "en", "s0", 0), (3, "A a A", "en", "s0", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    found = [tuple(r) for r in divergence.audit(df.withColumn("term", F.lit(1)), least_documents=3, most_terms=4).collect()]
    assert len(found) == len(set(found)) and set(found) == brute_audit(rows, 3, 4)


def test_audit_cases(spark, corpus, no_rows):
    rows = [tuple(r)[:5] for r in corpus.collect()]
    assert {tuple(r) for r in divergence.audit(corpus, least_documents=2).collect()} == brute_audit(rows, 2, 10)
    assert {r.value for r in divergence.audit(corpus).collect()} == {0}  # no term in ten documents
    assert divergence.audit(no_rows).count() == 0


def test_shares_beyond_long_products(spark):
    big = 10**12
    (row,) = spark.range(1).select(divergence.share(F.lit(big), F.lit(3 * big)).alias("p")).collect()
    assert row.p == 1 + 1_000_000_000 * (big + 2) // (3 * big)


# ---- url filters

PAGES = [
    # a component: an unruled net page, its canonical com/de page (not in the table), and a mirror by redirect
    (1, "https://a.example.net/x?utm_source=feed", '<link rel="canonical" href="https://b.com/de/7">'),
    (2, "http://A.example.net/x/#top", "<p>no link</p>"),
    (3, "https://m.net/mirror", "<META HTTP-EQUIV='refresh' CONTENT='0; url=https://a.example.net/x'>"),
    # explicit allow in the same component stays allowed
    (4, "https://good.org/page", "<link href='//m.net/mirror' rel='canonical'>"),
    # other pages
    (5, "https://free.net/y", "<!-- <link rel=canonical href=https://b.com/de/7> --><script>'<link rel=canonical href=https://b.com/de/7>'</script>"),
    (6, "https://example.org/en/12", ""), (7, "https://sub.example.org/es/", None), (8, "https://example.org/es", None),
    (9, None, None), (10, "no scheme", None), (None, "https://b.com/fr/1", None), (11, "", '<link rel="canonical" href="http://m.net/mirror">'),
    (11, "https://xexample.org/en/1", None), (12, "http://c.com/de/", None), (13, "http://c.com/de", None), (14, "http://d.com/fr/", None),
    (15, "https://free.net/z?b=1&utm_id=2", '<link rel="canonical" href="/rel">'), (16, "https://free.net/rel", '<link rel="canonical" href="?q=1&amp;r=2">'),
    (17, "http://free.net:80/rel?q=1&r=2#f", '<link rel=canonical href=http://e.com/de/q>'), (18, "mailto://", '<link rel="canonical" href="mailto:x@y">'),
    (19, "https://com/fr/", ""), (20, "ftp://user@h.com:8080/de/1?x=://y/", ""),
]
EXPECTED = {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "allow", 9: "allow", 10: "allow", None: "allow",
            12: "block", 13: "block", 14: "allow", 15: "block", 16: "block", 17: "block", 18: "allow", 19: "allow", 20: "allow"}


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_blocks_reach_aliases(spark, tmp_path):
    frame = pages_frame(spark, PAGES).withColumns({"rule": F.lit(1), "node": F.lit(2)})
    found = url_filters.judge(frame)
    rows = found.collect()
    assert len(rows) == len(PAGES)
    assert {r.page_id: r.verdict for r in rows if r.page_id != 11} == EXPECTED
    assert sorted((r.host, r.verdict) for r in rows if r.page_id == 11) == [("", "block"), ("xexample.org", "allow")]
    rules = {r.page_id: r.rule for r in rows if r.page_id != 11}
    assert (rules[6], rules[7], rules[8], rules[4], rules[None], rules[1]) == ("example.org/en/1", "example.org/es/", "org/", "org/", "com/fr/", None)
    assert {r.page_id: (r.host, r.path) for r in rows}[20] == ("user@h.com:8080", "/de/1")
    frame.coalesce(1).write.parquet(f"{tmp_path}/out")
    part = next(f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".parquet"))
    os.rename(f"{tmp_path}/out/{part}", f"{tmp_path}/pages.parquet")
    assert_equal(found, oracles.URL_FILTERS, str(tmp_path))


def test_components_of_long_chains_and_stars(spark):
    """A chain of redirects to a blocked page, and a hub that a hundred pages name, equal a walk of the edges."""
    chain = [(k, f"https://n.net/c{k}", f'<link rel="canonical" href="/c{k + 1}">') for k in range(30)]
    chain.append((30, "https://n.net/c30", '<link rel="canonical" href="https://w.com/de/end">'))
    star = [(100 + k, f"https://s.net/p{k}", '<link rel="canonical" href="https://hub.net/">') for k in range(100)]
    found = {r.page_id: r.verdict for r in url_filters.judge(pages_frame(spark, chain + star)).collect()}
    assert {found[k] for k in range(31)} == {"block"} and {found[100 + k] for k in range(100)} == {"allow"}
    star.append((300, "https://hub.net", '<meta http-equiv="refresh" content="3;url=http://v.com/de/">'))
    found = {r.page_id: r.verdict for r in url_filters.judge(pages_frame(spark, star)).collect()}
    assert set(found.values()) == {"block"}


def test_url_filter_cases(spark):
    assert url_filters.judge(pages_frame(spark, [])).count() == 0
    frame = pages_frame(spark, PAGES).withColumn("a.b", F.lit(1))
    kept = url_filters.kept_pages(frame)
    assert kept.columns == frame.columns
    assert {r.page_id for r in kept.collect()} == {4, 5, 8, 9, 10, None, 11, 14, 18, 19, 20}
    ties = (url_filters.Rule("block", "e.net", "/a"), url_filters.Rule("allow", "e.net", "/a"))
    (row,) = url_filters.judge(pages_frame(spark, [(1, "http://e.net/a", None)]), ties).collect()
    assert (row.rule, row.verdict) == ("e.net/a", "allow")


def test_no_python_worker_runs(spark):
    plan = url_filters.judge(pages_frame(spark, PAGES))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- tables that operators write


def test_concurrent_runs_keep_their_own_tables(spark, corpus):
    expected = sorted((r.doc_id or -1, r.n_removed) for r in suffix_dedup.removal_report(corpus).collect())

    def run(_: int) -> list:
        return sorted((r.doc_id or -1, r.n_removed) for r in suffix_dedup.removal_report(corpus).collect())

    with ThreadPoolExecutor(3) as pool:
        assert all(found == expected for found in pool.map(run, range(3)))


def test_passing_removes_all_but_kept(spark):
    folder = storage.shared_folder(spark)
    before = set(os.listdir(folder))
    with storage.passing(spark):
        with storage.passing(spark):
            storage.settle(spark.range(3), "inner")
            kept = storage.settle(spark.range(4), "kept", keep=True)
        assert kept.count() == 4 and len(set(os.listdir(folder)) - before) == 1
    assert set(os.listdir(folder)) == before
    outer = storage.settle(spark.range(5), "outer", keep=True)
    assert outer.count() == 5 and len(set(os.listdir(folder)) - before) == 1


# ---- mixing without usable keys


def test_null_and_repeated_keys_meet_targets(spark, docs_rows):
    for key in (None, 7):
        frame = spark.createDataFrame([(key, t, s) for t, s in docs_rows], "doc_id long, text string, source string")
        by, equal = defaultdict(list), Counter((s, t) for t, s in docs_rows)
        for r in mixing.mix(frame).collect():
            by[r.source].append(r)
        for source, rows in by.items():
            largest = max(n * len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for (s, t), n in equal.items() if s == source)
            assert abs(sum(r.taken for r in rows) - rows[0].target) <= largest / 2 + 1e-6
        assert mixing.mixed(frame).count() == sum(r.copies for rs in by.values() for r in rs)


@pytest.fixture(scope="module")
def docs_rows(spark, small_tables):
    return [(r.text, r.source) for r in storage.documents(spark, small_tables).select("text", "source").collect()]
