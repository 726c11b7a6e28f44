"""The ten operators against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import (
    bit_filter, boosting, components, fingerprints, induced_sort, language, licenses, mixing, packing, quality, sharding, simhash,
    suffix_dedup, text_stats, token_counts,
)
from quarry.llm.storage import documents

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="session")
def docs(spark, small_tables):
    return documents(spark, small_tables)


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


# ---- sharding


def jump(key: int, n: int) -> int:
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, -1, 7, 10**18, -(2**63), 2**63 - 1, *range(100, 160)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for r in df.select("k", sharding.jump_buckets(F.col("k"), 1, 24, 25, 1000).alias("b")).collect():
        assert (r.b.b1, r.b.b24, r.b.b25, r.b.b1000) == tuple(jump(r.k, n) for n in (1, 24, 25, 1000))


def test_sharding_cases(corpus, no_rows):
    rows = sharding.shard(corpus, 24).collect()
    assert len(rows) == corpus.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r["size"] for r in rows if r.doc_id in (3, 4)} == {8}
    assert sharding.shard(no_rows, 24).count() == 0


# ---- SimHash


def plain_simhash(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values: np.ndarray, budget: int) -> np.ndarray:
    i, j = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= budget)
    return simhash.unite(np.arange(len(values)), i, j)


@pytest.mark.parametrize("seed", range(12))
def test_trie_walk_equals_all_pairs(seed):
    rng = np.random.default_rng(seed)
    v = rng.integers(0, 2**63, 4, dtype=np.uint64)[rng.integers(0, 4, 300)]
    for _ in range(seed % 6):
        v = v ^ np.where(rng.random(300) < 0.7, np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64), np.uint64(0))
    v = np.unique(v)
    for budget in (0, 1, 2, 3):
        assert (simhash.trie_roots(v, 0, budget, most_pairs=50 if seed % 2 else 1 << 19) == brute_roots(v, budget)).all()


@pytest.mark.parametrize("bucket_rows", [20_000, 5])
def test_near_duplicates_equal_brute_force(spark, bucket_rows):
    base = " ".join(f"w{i}" for i in range(400))
    near = [base.replace(f"w{k} ", f"v{k} ", 1) for k in range(10, 60)]
    rows = [(i, t) for i, t in enumerate([base, base, *near, "", "   ", "other text entirely", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in simhash.near_duplicates(df, bucket_rows=bucket_rows).collect()}
    prints = np.array([plain_simhash(t) for _, t in rows], np.uint64)
    roots = brute_roots(prints, 2)
    assert len(set(roots)) < len(set(prints.tolist()))  # some links are between different fingerprints
    for (i, _), p, r in zip(rows, prints, roots):
        assert (found[i].fingerprint, found[i].component_id) == (f"{int(p):016x}", int(r))


def test_simhash_cases(corpus, no_rows):
    rows = simhash.near_duplicates(corpus).collect()
    assert len(rows) == corpus.count()
    zero = {r.doc_id: r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {3: 3, 4: 3, 5: 3, None: 3}
    kept = simhash.one_per_group(corpus)
    assert kept.columns == corpus.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 6, 7, 8, 9, 10, 11]
    assert simhash.near_duplicates(no_rows).count() == 0 and simhash.one_per_group(no_rows).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 200), (202, 201), (200, 202), (300, 300)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 202: 200}


# ---- quality


def plain_repeats(text: str) -> int:
    words, places = re.findall(r"[^\x20\x09-\x0D]+", text), defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    return len({j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 5)})


def test_text_statistics(texts):
    many = " ".join(f"w{i}" for i in range(7000))
    for t in [*texts.values(), many + " " + many, "a\n\na\n \na\nb", "### $ <x> |", ""]:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines, seen, dup = t.split("\n"), set(), 0
        for line in lines:
            has = bool(re.search(r"[^\x20\x09-\x0D]", line))
            dup += has and line in seen
            seen |= {line} if has else set()
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, plain_repeats(t))
        assert text_stats.text_stats(t)[:5] == expected


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(3)
    x = rng.random((800, 3))
    y = ((x[:, 0] + 0.3 * x[:, 1] + 0.1 * rng.standard_normal(800)) < 0.6).astype(float)
    model = boosting.fit(x, y, np.array([-1, 0, 0]))
    assert np.mean((model.probability(x) > 0.5) == y) > 0.9
    grid = np.linspace(0, 1, 50)
    for row in rng.random((30, 3)):
        p = model.probability(np.stack([grid, np.full(50, row[1]), np.full(50, row[2])], axis=1))
        assert (np.diff(p) <= 1e-12).all()


def test_quality_on_held_out_labels(spark, small_tables, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(documents(spark, "/root/testdata/sf0.01"), labels)
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{small_tables}/labels.parquet").collect()}
    found = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    right = [(found[i].score >= 0.5) == bool(q) for i, q in known.items()]
    assert np.mean(right) > 0.95


def test_quality_cases(spark, corpus, no_rows):
    rows = quality.judge(corpus, None).collect()
    assert len(rows) == corpus.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (3, 4, 5))
    assert all(r.kept for r in rows if r.doc_id in (1, 2))
    assert quality.judge(no_rows, None).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(corpus, nothing) is None
    assert quality.train(corpus, spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")) is None


# ---- packing


def check_packing(rows, expected_ids):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, ids in expected_ids.items():
        at = 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(part))
            assert k == 0 or r.length == 2048
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return len(by_sequence)


def test_packing_round_trip(docs, texts):
    tokenizer = Tokenizer.from_file(BPE)
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in texts.items()}
    rows = packing.pack_documents(docs, BPE).collect()
    lengths = np.array([r.length for r in rows])
    assert check_packing(rows, ids) <= packing.lower_bound(lengths, 2048) + 1


def test_encoder_equals_tokenizers():
    from quarry.llm.byte_pairs import WordCachedEncoder

    tokenizer, encoder = Tokenizer.from_file(BPE), WordCachedEncoder(BPE, most=5)
    for t in ["", " ", "  two  spaces ", "a b\tc\n\nd e", "it's we'll 123abc !!?? ü 日本", "x <|endoftext|> y", "a b c", "tab\t end", "  em", "line.\nNext one"]:
        assert encoder.encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_bounds_hold_and_exchange_helps(spark):
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 101, rng.integers(1, 40))
        bins = packing.best_fit_decreasing(lengths, 100)
        assert np.bincount(bins, lengths).max() <= 100
        assert packing.lower_bound(lengths, 100) <= bins.max() + 1
    assert packing.lower_bound(np.full(10, 51), 100) == 10
    rows = [(i, 0, int(n)) for i, n in enumerate(rng.integers(1, 70, 3000))]
    df = spark.createDataFrame(rows, "uid long, piece int, length long")
    one = packing.pack(df, capacity=100, group_rows=100, rounds=1).select("sequence_id").distinct().count()
    more = packing.pack(df, capacity=100, group_rows=100).select("sequence_id").distinct().count()
    bound = packing.lower_bound(np.array([r[2] for r in rows]), 100)
    assert bound <= more and more - bound <= (one - bound) / 2


def test_packing_cases(corpus, no_rows):
    rows = packing.pack_documents(corpus, BPE).collect()
    assert sum(r.piece == 0 for r in rows) == corpus.count()
    assert {r.length for r in rows if r.doc_id in (3, 4)} == {1}
    check_packing(rows, {})
    assert packing.pack_documents(no_rows, BPE).count() == 0


# ---- token counts


def test_counts_equal_a_full_search(texts):
    trie = token_counts.unigram_trie(PIECES)

    def brute(word: str) -> int:
        best = [(0, 0)]
        for end in range(1, len(word) + 1):
            options = []
            for start in range(end):
                score = trie.scores.get(word[start:end])
                if score is not None:
                    options.append((best[start][0] + score, best[start][1] - 1))
            if word[end - 1] not in trie.scores:
                n = len(word[end - 1].encode())
                options.append((best[end - 1][0] + n * ((trie.byte_value + 1) // token_counts.TIES), best[end - 1][1] - n))
            best.append(max(options))
        return -best[-1][1]

    words = sorted({w for t in texts.values() for w in token_counts.words_of(t)})[::7] + ["日本語😀", "z" * 90, "ñandú"]
    counter = token_counts.Counter(trie, most=100)
    for w in words:
        assert counter.count([[w]]) == [brute(token_counts.SPACE_MARK + w)]


def test_very_long_words_are_counted_whole():
    trie = token_counts.unigram_trie(PIECES)
    unknown = chr(0x20000)  # four bytes, no piece
    (mark,) = trie.count_all([token_counts.SPACE_MARK])
    words = sorted([token_counts.SPACE_MARK + "z" * 90, token_counts.SPACE_MARK + unknown * 263_000])
    found = dict(zip(words, trie.count_all(words)))
    assert found[token_counts.SPACE_MARK + unknown * 263_000] == mark + 4 * 263_000 > 1 << 20


def test_token_count_cases(corpus, no_rows):
    rows = token_counts.token_counts(corpus, PIECES).collect()
    assert len(rows) == corpus.count()
    assert all((r.n_words, r.n_tokens) == (0, 0) for r in rows if r.doc_id in (3, 4, 5))
    assert token_counts.token_counts(no_rows, PIECES).count() == 0


# ---- fingerprints


def test_fingerprints_equal_a_driver_loop(docs, texts):
    order = sorted(texts, reverse=True)
    found = {r.doc_id: r for r in fingerprints.fingerprint(docs).collect()}
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[fingerprints.canonical(t)].append(i)
    for k, i in enumerate(order):
        t, following, r = texts[i], texts[order[(k + 1) % len(order)]], found[i]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        same = groups[fingerprints.canonical(t)]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == xxhash.xxh3_128_hexdigest(fingerprints.canonical(t))
        assert r.edited_fingerprint == xxhash.xxh3_128_hexdigest(fingerprints.canonical(edited))
        assert (r.near_edited, r.near_next) == (fingerprints.canonical(t) == fingerprints.canonical(edited), fingerprints.canonical(t) == fingerprints.canonical(following))
        assert (r.group_id, r.group_rows) == (min(same), len(same))


def test_fingerprint_cases(spark, corpus, no_rows):
    rows = fingerprints.fingerprint(corpus).collect()
    assert len(rows) == corpus.count()
    by = {r.doc_id: r for r in rows}
    assert by[9].fingerprint == by[10].fingerprint and by[9].group_id == by[10].group_id == 9
    assert by[3].fingerprint == by[4].fingerprint == by[5].fingerprint and by[3].n_chars == 0
    assert fingerprints.fingerprint(no_rows).count() == 0
    alone = fingerprints.fingerprint(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert (alone.near_next, alone.edited_sha256) == (1.0, hashlib.sha256(b"abab").hexdigest())


def test_collisions_join_no_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["aa", "ab", "aa", "b"])], "doc_id long, text string")
    rows = fingerprints.fingerprint(df, digest=lambda form: form[:1].decode()).collect()
    assert {r.doc_id: (r.group_id, r.group_rows) for r in rows} == {0: (0, 2), 1: (1, 1), 2: (0, 2), 3: (3, 1)}


def test_bit_filter_loses_nothing(spark):
    ids = spark.range(5000)
    wanted = ids.where("id % 7 = 0 OR id IS NULL")
    passed = bit_filter.maybe_in(ids, "id", wanted)
    assert passed.join(wanted, "id").count() == wanted.count() and passed.count() < 1500


# ---- mixing


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert sum(r["size"] for r in rows) * 1.5 == pytest.approx(sum(rs[0].target for rs in by.values()))
    for rs in by.values():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r["size"] for r in rs) / 2 + 1e-6
        assert rs[0].target <= 2 * rs[0].source_size
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(5)).collect())
    assert mixing.mixed(docs).count() == sum(r.copies for r in rows)


def test_smaller_budgets_are_nested(docs):
    small = {r.doc_id for r in mixing.mix(docs, share=0.3).collect() if r.copies}
    large = {r.doc_id for r in mixing.mix(docs, share=0.6).collect() if r.copies}
    assert small and small < large


def test_mix_cases(corpus, no_rows):
    rows = mixing.mix(corpus).collect()
    assert len(rows) == corpus.count()
    assert all(r["size"] == 0 for r in rows if r.doc_id in (3, 4, 5))
    mixed = mixing.mixed(corpus)
    assert mixed.columns == corpus.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(no_rows).count() == 0 and mixing.mixed(no_rows).count() == 0


# ---- language


def test_languages_of_held_out_texts(docs):
    profiles = language.learn(docs)
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs, profiles).collect()
    test = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in test]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_cases(corpus, no_rows, docs):
    profiles = language.learn(docs)
    rows = language.identify(corpus, profiles).collect()
    assert len(rows) == corpus.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (3, 4, 5, 11))
    assert language.identify(no_rows, profiles).count() == 0
    nothing = language.learn(no_rows)
    assert nothing.names == () and language.predict_text("some words", nothing) == ("und", 0.0)
    assert language.learn(corpus).names


def plain_bundle(text: str, vectors: language.TrigramVectors) -> list[int]:
    """Trigram by trigram and number by number, from the vectors of letters alone."""
    letters = [0]
    for c in text.lower():
        if c.isalpha() or letters[-1]:
            letters.append(ord(c) if c.isalpha() else 0)
    if letters[-1]:
        letters.append(0)
    total, size = [0] * 64, 64
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        va, vb, vc = vectors.letter(a), vectors.letter(b), vectors.letter(c)
        for i in range(size):
            total[i] += int(va[i - 2]) * int(vb[i - 1]) * int(vc[i])
    return total


@pytest.mark.parametrize("text", ["", "1 2 3", "x", "abc abcd Ünï 日本", "日本語 日本 にほん", "Ελληνικά και Кириллица! x9y", "ab" * 300])
def test_bundles_equal_plain_sums(text, monkeypatch):
    vectors = language.TrigramVectors(dimensions=64)
    assert vectors.bundle(text).tolist() == plain_bundle(text, vectors)
    monkeypatch.setattr(language, "_BLOCK", 5)
    monkeypatch.setattr(vectors, "_owner", np.full(language._SLOTS, -1, np.int64))
    assert vectors.bundle(text).tolist() == plain_bundle(text, vectors)


def test_letters_of_any_script_have_vectors_of_their_own():
    vectors = language.TrigramVectors()
    a, b = (vectors.letter(ord(c)).astype(int) for c in "日本")
    assert abs(int(a @ b)) < 200 and (a == vectors.letter(ord("日"))).all()


def test_profiles_and_predictions_equal_a_plain_loop(docs):
    profiles = language.learn(docs)
    vectors = language.TrigramVectors()
    rows = [r for r in docs.collect() if r.text is not None]
    sums: dict[str, np.ndarray] = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            sums[r.lang] = sums.get(r.lang, 0) + vectors.bundle(r.text)
    assert profiles.names == tuple(sorted(sums))
    for name, found in zip(profiles.names, profiles.vectors):
        assert np.allclose(found, sums[name] / np.linalg.norm(sums[name]))
    said = {r.doc_id: r.lang_pred for r in language.identify(docs, profiles).collect()}
    for r in rows[:200]:
        if any(c.isalpha() for c in r.text):
            likeness = {n: float(v @ vectors.bundle(r.text)) for n, v in sums.items()}
            assert said[r.doc_id] == max(sorted(likeness), key=lambda n: likeness[n] / np.linalg.norm(sums[n]))


# ---- suffix dedup


def brute_removed(texts: list[bytes], length: int) -> list[np.ndarray]:
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    masks = []
    for t in texts:
        m = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                m[i : i + length] = True
        masks.append(m)
    return masks


@pytest.mark.parametrize("seed", range(8))
def test_induced_sort_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    length, letters = int(rng.choice([8, 13, 16, 40])), int(rng.choice([1, 2, 5]))
    pool = [bytes(rng.integers(97, 97 + letters, rng.integers(1, 150), dtype=np.uint8)) for _ in range(4)]
    strings = [b"".join(pool[k] for k in rng.integers(0, 4, rng.integers(1, 6))) for _ in range(12)]
    count = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
    expected = [i + length <= len(s) and count[s[i : i + length]] > 1 for s in strings for i in range(len(s))]
    for memory in (1024, 1 << 20):  # with and without runs on disk
        assert np.concatenate([*induced_sort.repeated_starts(iter(strings), length, memory_rows=memory)]).tolist() == expected


@pytest.mark.parametrize("block", [7, 200])
def test_common_prefixes_equal_brute_force(monkeypatch, block):
    """Blocks far smaller than the input: queues on disk, several levels of recursion."""
    plain = induced_sort.Scratch.__init__

    def small(self, folder, memory_rows):
        plain(self, folder, memory_rows)
        self.memory_rows = self.block = block

    monkeypatch.setattr(induced_sort.Scratch, "__init__", small)
    rng = np.random.default_rng(block)
    for letters in (1, 2, 3, 26):
        pool = [bytes(rng.integers(97, 97 + letters, rng.integers(1, 60), dtype=np.uint8)) for _ in range(3)]
        strings = [b"".join(pool[k] for k in rng.integers(0, 3, rng.integers(0, 4))) for _ in range(9)] + [b"a" * 90]
        count = Counter(s[i:j] for s in strings for i in range(len(s)) for j in range(i + 1, min(i + 30, len(s)) + 1))
        for s, shared in zip(strings, induced_sort.common_prefixes(strings, 30)):
            expected = [max([j for j in range(1, min(30, len(s) - i) + 1) if count[s[i : i + j]] > 1], default=0) for i in range(len(s))]
            assert shared.tolist() == expected


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(5)
    shared = bytes(rng.integers(0, 256, 900, dtype=np.uint8))
    a, b = bytes(rng.integers(0, 256, 500, dtype=np.uint8)) + shared, shared + bytes(rng.integers(0, 256, 77, dtype=np.uint8))
    anchor = lambda data: {s: k for k, _, first, n, _ in suffix_dedup.segments(data, 400, 128).tolist() for s in range(first, first + n)}
    x, y = anchor(a), anchor(b)
    assert sorted(x) == list(range(len(a) - 399))
    assert all(x[500 + i] == y[i] for i in range(501))


def test_runs_of_one_byte_make_few_segments():
    for data in (b"a" * 200_000, b"ab" * 100_000):
        rows = suffix_dedup.segments(data, 400, 128)
        assert len(rows) < 100 and rows[:, 3].sum() == len(data) - 399


@pytest.mark.parametrize("options", [{}, {"shard_segments": 1}, {"memory_rows": 1500}])
def test_removal_equals_brute_force(docs, texts, options):
    length = suffix_dedup.LENGTH
    found = {r.doc_id: r for r in suffix_dedup.removal_report(docs, **options).collect()}
    data = {i: t.encode() for i, t in texts.items()}
    for (i, t), mask in zip(data.items(), brute_removed(list(data.values()), length)):
        edges = np.diff(np.r_[0, mask.astype(int), 0])
        kept = hashlib.sha256(np.frombuffer(t, np.uint8)[~mask].tobytes()).hexdigest()
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), mask.sum(), (edges == 1).sum(), kept)
    for i, mask in zip(data, brute_removed(list(data.values()), suffix_dedup.PASSAGE)):
        assert found[i].n_repeated == mask.sum()
    assert any(0 < r.n_removed < r.n_bytes for r in found.values())


def test_removal_cases(corpus, no_rows):
    rows = suffix_dedup.removal_report(corpus).collect()
    assert len(rows) == corpus.count()
    by = {r.doc_id: r for r in rows}
    assert (by[7].n_removed, by[8].n_removed) == (600, 600)
    assert by[3].kept_sha256 == by[4].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[6].n_removed > 0
    cut = suffix_dedup.without_repeats(corpus)
    assert cut.columns == corpus.columns and cut.count() == corpus.count()
    kept = {r.doc_id: r.text for r in cut.collect()}
    assert (kept[7], kept[8], kept[3], kept[4]) == ("é" * 50 + "ü" * 30, "xtail", None, "")
    assert suffix_dedup.removal_report(no_rows).count() == 0


def test_cuts_keep_whole_characters():
    data = "aéb".encode()
    assert suffix_dedup.whole_characters(data, [(0, 2)]) == [(0, 1)]
    assert suffix_dedup.whole_characters(data, [(2, 4)]) == [(3, 4)]
    assert suffix_dedup.merged([{"a": 5, "b": 9}, {"a": 0, "b": 5}, {"a": 20, "b": 21}]) == [(0, 9), (20, 21)]


# ---- licenses


def test_alignment_is_increasing_and_covers_edits():
    t = licenses.words_of(licenses.TEMPLATES["GPL-3.0"])
    text = licenses.words_of("x y This work was licensed under the new GNU General License version 3 z")
    pairs = licenses.align(t, text)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
    assert all(t[i] == text[j] for i, j in pairs)
    assert len(pairs) >= 9


def test_scan_finds_every_notice_and_no_other(docs, texts):
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    notices = {n: licenses.TEMPLATES[n] for n in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT")}
    for i, t in texts.items():
        there = {n for n, notice in notices.items() if notice in t}
        assert {f.license for f in found[i].found} >= there
        assert bool(found[i].n_found) == bool(there)


def test_coverage_is_that_of_the_best_window():
    """Against brute force over all windows: stray words before a notice, insertions, losses."""
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    rng = np.random.default_rng(4)
    for name, template in licenses.TEMPLATES.items():
        own = licenses.words_of(template)
        for k in range(8):
            notice = list(own)
            for at in sorted(rng.integers(0, len(notice), k // 2).tolist(), reverse=True):
                notice[at : at + int(rng.integers(0, 2))] = [b"zzz"] * int(rng.integers(0, 4))
            stray = [own[int(i)] for i in rng.integers(0, len(own), 4)]
            text = stray + [b"x%d" % i for i in range(int(rng.integers(0, 40)))] + notice + [b"y"] * 30 + stray
            best = max(len(licenses.align(own, text[a : a + scanner.span(own)])) for a in range(len(text))) / len(own)
            found = [c for n, c, _, _ in scanner.scan(b" ".join(text).decode())[1] if n == name]
            assert (max(found, default=0) == best) if best >= 0.8 else not found
    mit = licenses.TEMPLATES["MIT-text"]
    for gap in (1, 30, 38, 80):
        found = scanner.scan("the " + "word " * gap + mit)[1]
        assert ("MIT-text", 1.0) in [f[:2] for f in found]


def test_repeated_notices_and_full_texts():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    mit = licenses.TEMPLATES["MIT"]
    n, found = scanner.scan(f"Foo. {mit} Bar baz.\n{mit.upper()}\n" + licenses.TEMPLATES["MIT-text"])
    assert [(f[0], f[1]) for f in found if f[0] == "MIT"] == [("MIT", 1.0)] * 2
    assert ("MIT-text", 1.0) in [f[:2] for f in found]


def test_license_cases(corpus, no_rows):
    rows = licenses.scan(corpus).collect()
    assert len(rows) == corpus.count() and all(r.n_found == 0 and r.license is None for r in rows)
    assert licenses.scan(no_rows).count() == 0
