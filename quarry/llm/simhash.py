"""SimHash near-duplicates by a binary trie self-join with a Hamming budget.

Fingerprints are leaves of a binary trie. The join walks pairs of trie nodes of one
depth from the root, counts the bits in which their paths differ, and drops a pair as
soon as the count passes the budget.

To deal the walk to tasks: of budget + 1 bands of bits, two linked fingerprints agree
in one at least. So there is one trie per band, with that band's bits at the top, and
below its first levels, where no difference is spent, each subtree is a task's own
work. A task reports a spanning forest of its links, never all pairs of a group.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bit_filter import maybe_in, surely_not_in
from .components import components
from .storage import extended, settle

BITS = 64
SEED = 42
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None, width: int) -> list[int]:
    """64-bit hashes of a text's lower-cased word shingles, repeats included.

    Fewer words than ``width`` make one shingle; no word makes none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]


def simhash(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text's lower-cased word shingles, repeats included; no word gives 0."""
    return _majority(shingles(text, width))


def word_simhash(text: str | None) -> int:
    """The same of a text's different words: an edited word moves one of them, and not ``width`` shingles."""
    words = {*(text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()}
    return _majority([xxhash.xxh64_intdigest(w, SEED) for w in words])


def _majority(hashes: list[int]) -> int:
    """The bits that are set in over half of the hashes."""
    if not hashes:
        return 0
    values = np.array(hashes, ">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 65536):
        ones += np.unpackbits(values[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values)).tobytes(), "big")


def with_simhash(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """doc_id and simhash (the 64 bits as a signed long) of every row."""
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t, width) for t in batch.column("_text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "simhash"])

    return rows.mapInArrow(hashed, extended(rows, ["doc_id"], "simhash long"))


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after linking items i and j; a root is its component's smallest item."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            higher = root[root]
            if np.array_equal(higher, root):
                break
            root = higher


def trie_roots(values: np.ndarray, top: int, budget: int, *, most_pairs: int = 1 << 19) -> np.ndarray:
    """Component roots of sorted different uint64 ``values`` that agree in their ``top`` first bits.

    A trie node is a range of the sorted values. All node pairs of a level are
    expanded together, at most ``most_pairs`` at once; what exceeds this waits, so
    memory stays bounded. Node pairs inside one component are dropped.
    """
    n = len(values)
    root = np.arange(n)
    ones: dict[int, np.ndarray] = {}

    def split(level: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if level not in ones:
            bit = (values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            ones[level] = np.r_[0, np.cumsum(bit, dtype=np.int64)]
        return high - (ones[level][high] - ones[level][low])

    prefix = values >> np.uint64(BITS - top) if top else np.zeros(n, np.uint64)
    first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
    end = np.r_[first[1:], n]
    many = end - first > 1
    low, high = first[many], end[many]
    waiting = [(top, low, high, low, high, np.zeros(len(low), np.int64))]
    while waiting:
        level, al, ah, bl, bh, spent = waiting.pop()
        if len(al) > most_pairs:
            half = len(al) // 2
            waiting.append((level, al[half:], ah[half:], bl[half:], bh[half:], spent[half:]))
            waiting.append((level, al[:half], ah[:half], bl[:half], bh[:half], spent[:half]))
            continue
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():
            i, j = al[single], bl[single]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            root = unite(root, i[near], j[near])
            al, ah, bl, bh, spent = (x[~single] for x in (al, ah, bl, bh, spent))
        if not len(al) or level == BITS:
            continue
        change = np.cumsum(np.r_[0, root[1:] != root[:-1]])
        whole = (change[ah - 1] == change[al]) & (change[bh - 1] == change[bl]) & (root[al] == root[bl])
        al, ah, bl, bh, spent = (x[~whole] for x in (al, ah, bl, bh, spent))
        am, bm = split(level, al, ah), split(level, bl, bh)
        own = al == bl
        other = ~own
        pairs = [
            (al, am, bl, bm, spent), (am, ah, bm, bh, spent), (al, am, bm, bh, spent + 1),
            (am[other], ah[other], bl[other], bm[other], spent[other] + 1),
        ]
        al, ah, bl, bh, spent = (np.concatenate(x) for x in zip(*pairs))
        # an empty side, too many differences, or a leaf with itself
        live = (ah > al) & (bh > bl) & (spent <= budget) & ((al != bl) | (ah - al > 1))
        waiting.append((level + 1, *(x[live] for x in (al, ah, bl, bh, spent))))
    return root


def _bands(budget: int) -> list[tuple[int, int]]:
    """(first bit, bits) of budget + 1 bands."""
    cuts = [round(BITS * k / (budget + 1)) for k in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _orders(budget: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each pair of budget + 2 bands, all (first bit, bits) with that pair at the top, and the pair's bits.

    Two values that differ in ``budget`` bits agree in two of these bands at least.
    """
    bands = _bands(budget + 1)
    return [([x, y, *(b for b in bands if b not in (x, y))], x[1] + y[1]) for x, y in combinations(bands, 2)]


def _in_order(v: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(len(v), np.uint64)
    for first, bits in order:
        out = (out << np.uint64(bits)) | ((v >> np.uint64(BITS - first - bits)) & np.uint64((1 << bits) - 1))
    return out


def _out_of_order(v: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    out, at = np.zeros(len(v), np.uint64), 0
    for first, bits in order:
        part = (v >> np.uint64(BITS - at - bits)) & np.uint64((1 << bits) - 1)
        out |= part << np.uint64(BITS - first - bits)
        at += bits
    return out


def _in_all_orders(values: DataFrame, orders: list[tuple[list[tuple[int, int]], int]]) -> DataFrame:
    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("simhash").to_numpy().view(np.uint64)
            for k, (order, top) in enumerate(orders):
                turned = _in_order(v, order)
                bucket = (turned >> np.uint64(BITS - top)).view(np.int64)
                band = pa.array(np.full(len(v), k, np.int32))
                yield pa.RecordBatch.from_arrays([band, pa.array(turned.view(np.int64)), pa.array(bucket)], names=["band", "turned", "bucket"])

    return values.select("simhash").mapInArrow(turn, "band int, turned long, bucket long")


def links(values: DataFrame, budget: int, *, bucket_rows: int = 20_000, two_bands: bool = False) -> DataFrame:
    """Edges (a, b) that connect the different longs of ``values`` (column simhash) just as
    all pairs at ``budget`` or fewer differing bits would.

    Rows meet in buckets of equal band. A bucket of over ``bucket_rows`` values is cut
    into chunks by hash, and every pair of chunks is a bucket of its own, so no task
    holds more than two chunks at a time, and every pair still meets. With
    ``two_bands`` a bucket is of two equal bands of budget + 2: more tries, but of far
    smaller buckets, which a budget of many bits needs.
    """
    spark = values.sparkSession
    bands = _bands(budget)
    turned = [
        F.shiftleft("simhash", a).bitwiseOR(F.shiftrightunsigned("simhash", BITS - a)) if a else F.col("simhash") for a, _ in bands
    ]
    # shifts of 64 would leave the value as it is, hence the case of the first band
    rows = values.select(F.col("simhash"), F.explode(F.array(*(
        F.struct(F.lit(k).alias("band"), t.alias("turned"), F.shiftrightunsigned(t, BITS - bits).alias("bucket"))
        for k, (t, (_, bits)) in enumerate(zip(turned, bands))
    ))).alias("_b")).select("_b.*")
    if two_bands:
        orders = _orders(budget)
        rows = settle(_in_all_orders(values, orders), "orders")
    counts = settle(
        rows.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("band", "bucket", F.ceil(F.col("n") / bucket_rows).alias("chunks")),
        "buckets",
    )
    chunk = F.pmod(F.xxhash64("turned"), F.col("chunks"))
    dealt = (
        rows.join(counts, ["band", "bucket"])
        .withColumn("_c", chunk)
        .withColumn("_d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("band", "bucket", "turned", F.least("_c", "_d").alias("p"), F.greatest("_c", "_d").alias("q"))
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = dealt.repartition(n, "band", "bucket", "p", "q").sortWithinPartitions("band", "p", "q", "bucket")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for band, turned in _runs(batches):
            first, bits = (0, orders[band][1]) if two_bands else bands[band]
            order = np.unique(turned.view(np.uint64))
            root = trie_roots(order, bits, budget)
            low = np.flatnonzero(root != np.arange(len(order)))
            back = [
                (v >> np.uint64(first)) | (v << np.uint64(BITS - first)) if first else v for v in (order[low], order[root[low]])
            ]
            if two_bands:
                back = [_out_of_order(v, orders[band][0]) for v in back]
            yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in back], names=["a", "b"])

    return together.mapInArrow(walk, "a long, b long")


def _runs(batches: Iterator[pa.RecordBatch], rows: int = 1 << 18) -> Iterator[tuple[int, np.ndarray]]:
    """Values of one band and chunk pair at a time; whole buckets, about ``rows`` values together."""
    held: list[np.ndarray] = []
    count, at, bucket = 0, None, None
    for batch in batches:
        band, p, q, b, turned = (batch.column(c).to_numpy() for c in ("band", "p", "q", "bucket", "turned"))
        if not len(band):
            continue
        new = np.r_[True, (band[1:] != band[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1]) | (b[1:] != b[:-1])]
        starts = np.flatnonzero(new).tolist()
        for s, e in zip(starts, [*starts[1:], len(band)]):
            group = (int(band[s]), int(p[s]), int(q[s]))
            if held and (group != at or (count >= rows and int(b[s]) != bucket)):
                yield at[0], np.concatenate(held)
                held, count = [], 0
            at, bucket = group, int(b[s])
            held.append(turned[s:e])
            count += e - s
    if held:
        yield at[0], np.concatenate(held)


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3, budget: int = 2, bucket_rows: int = 20_000
) -> DataFrame:
    """doc_id, simhash, fingerprint (16 hex digits), component_id and component for every row.

    component_id is the smallest doc_id that links of ``budget`` or fewer bits reach;
    component is the component's smallest simhash.
    Null and empty texts, and texts without a word, have fingerprint 0 and link like
    any other. Repeated rows are rows of one component; null ids take part but never
    name a component unless all its ids are null. An empty table gives an empty
    result. Other columns are not read.

    Copies are merged by fingerprint before anything is joined.
    """
    hashed = settle(with_simhash(docs, key=key, text=text, width=width), "simhash")
    distinct = settle(hashed.groupBy("simhash").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    found = components(links(distinct.select("simhash"), budget, bucket_rows=bucket_rows))
    rooted = distinct.join(found.withColumnRenamed("node", "simhash"), "simhash", "left").select(
        "simhash", "first_id", F.coalesce("root", "simhash").alias("root")
    )
    rooted = settle(rooted, "simhash-roots")
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = settle(rooted.join(names, "root").select("simhash", "component_id", F.col("root").alias("component")), "simhash-labels")
    return hashed.join(labels, "simhash").select(
        "doc_id", "simhash", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id", "component"
    )


def one_per_group(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id.

    Same columns. Of repeated rows one stays, of a group without an id one of its
    texts. Rows that share an id but belong to different groups all stay.
    """
    groups = near_duplicates(docs, key=key, text=text, **options).select("doc_id", F.col("simhash").alias("mark"), "component_id", "component")
    marks = functools.partial(with_simhash, width=options.get("width", 3))
    return _one_of_each(docs, groups, lambda rows: marks(rows, key="row", text="_t").withColumnRenamed("simhash", "mark"), key, text)


def _one_of_each(docs: DataFrame, groups: DataFrame, marked: Callable[[DataFrame], DataFrame], key: str, text: str) -> DataFrame:
    """One row of each component of ``groups`` (doc_id, mark, component_id, component).

    ``marked`` gives doc_id and mark of rows with the columns row and _t, the text.
    """
    groups = settle(groups, "groups")
    rows = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    chosen = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component").agg(
        F.min("mark").alias("mark"), F.min("doc_id").alias("__group_id")
    )
    chosen = chosen.join(rows, F.col("__group_id").eqNullSafe(F.col("doc_id"))).select("__group_id", "mark", "n")
    chosen = settle(chosen, "chosen")
    # most rows are neither to go nor in doubt: the bit filter lets them stay where they are
    go = groups.select("doc_id").distinct().join(
        chosen.where("n = 1 AND __group_id IS NOT NULL").select("__group_id"), F.col("doc_id") == F.col("__group_id"), "left_anti"
    )
    go = settle(go, "doubtful")
    kept = surely_not_in(docs, key, go)
    rest = maybe_in(docs, key, go)
    kept = kept.unionByName(
        rest.join(chosen.where("n = 1 AND __group_id IS NOT NULL").select("__group_id"), F.col(f"`{key}`") == F.col("__group_id"), "left_semi")
    )
    unclear = chosen.where("n > 1 OR __group_id IS NULL").select("__group_id", F.col("mark").alias("__group_mark"))
    if unclear.isEmpty():
        return kept
    # ids of more than one row: tell the rows apart by mark, and keep one of each that is wanted
    again = rest.join(unclear.select("__group_id").distinct(), F.col(f"`{key}`").eqNullSafe(F.col("__group_id")), "left_semi")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    hashed = marked(again.select(row.alias("row"), F.col(f"`{text}`").alias("_t")))
    wanted = hashed.join(
        unclear, (F.col("mark") == F.col("__group_mark")) & F.col(f"doc_id.`{key}`").eqNullSafe(F.col("__group_id")), "left_semi"
    )
    one = wanted.groupBy(F.col(f"doc_id.`{key}`").alias("__group_id"), "mark").agg(F.first("doc_id").alias("row"))
    return kept.unionByName(one.select("row.*"))


def with_names(docs: DataFrame, *, key: str, text: str, shingle: int, sets: bool = False) -> DataFrame:
    """doc_id, mark and, of every row, ``word_simhash`` as simhash or, with ``sets``, the set of its ``shingle``-word shingles as words.

    The mark is a hash of that set, so texts of one mark have Jaccard similarity 1.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            texts = batch.column("_text").to_pylist()
            own = [np.unique(np.array(shingles(t, shingle), np.uint64)) for t in texts]
            marks = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in own], np.uint64).view(np.int64)
            out = [batch.column("doc_id"), pa.array(marks)]
            if sets:
                ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own).view(np.int64))))
            else:
                out.append(pa.array(np.array([word_simhash(t) for t in texts], np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "mark", "words" if sets else "simhash"])

    return rows.mapInArrow(named, extended(rows, ["doc_id"], f"mark long, {'words array<long>' if sets else 'simhash long'}"))


def _heads(sets: list[np.ndarray], least: float) -> np.ndarray:
    """For each of the ordered sets its head: the first that is no other's, and as alike as ``least``."""
    head = np.full(len(sets), -1)
    sizes = np.array([len(x) for x in sets])
    rest = np.arange(len(sets))
    while len(rest):
        first, others = rest[0], rest[1:]
        head[first] = first
        if not len(others):
            break
        own, every = sets[first], np.concatenate([sets[k] for k in others])
        # every set but one has a shingle
        met = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every if len(own) else np.zeros(len(every), bool)
        upto = np.append(0, np.cumsum(met))
        ends = np.cumsum(sizes[others])
        common = upto[ends] - upto[ends - sizes[others]]
        alike = common >= least * (sizes[others] + len(own) - common)
        head[others[alike]] = first
        rest = others[~alike]
    return head


def _grouped_in_tasks(members: DataFrame, least: float) -> DataFrame:
    """(mark, head) of whole components (root, first_id, mark, words), each worked out in one task."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["root", F.col("first_id").isNull(), "first_id", "mark"]
    dealt = members.select("root", "first_id", "mark", "words").repartition(n, "root").sortWithinPartitions(*order).select("root", "mark", "words")

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, np.ndarray]]:
            for batch in batches:
                words = batch.column("words")
                ends, flat = words.offsets.to_numpy(), words.values.to_numpy().view(np.uint64)
                for k, (root, mark) in enumerate(zip(batch.column("root").to_pylist(), batch.column("mark").to_pylist())):
                    yield root, mark, flat[ends[k] : ends[k + 1]]

        for _, own in itertools.groupby(rows(), lambda r: r[0]):
            _, marks, sets = zip(*own)
            marks = np.array(marks, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(marks), pa.array(marks[_heads(list(sets), least)])], names=["mark", "head"])

    return dealt.mapInArrow(group, "mark long, head long")


def near_copies(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", budget: int = 7, shingle: int = 5, least: float = 0.8, task_shingles: int = 1 << 22
) -> DataFrame:
    """doc_id, mark, component_id and component for every row: groups around one text each.

    Every text of a group has an exact Jaccard similarity of ``least`` or more, over its
    set of ``shingle``-word shingles, with the group's text of the smallest doc_id; no two
    of these head texts are as alike and within ``budget`` bits of each other's word SimHash.
    Texts without a word are one group.

    The trie walk joins texts to components. In a component the first text is compared with
    all others and takes those that are alike; so does the first of the rest, and so on. A
    group of n texts costs n comparisons, not n squared. A component of up to
    ``task_shingles`` shingles is grouped inside one task, a larger one by rounds over the
    cluster, a head each, until what is left of it is as small; the groups are the same.
    """
    named = settle(with_names(docs, key=key, text=text, shingle=shingle), "named")
    texts = settle(named.groupBy("mark").agg(F.min("simhash").alias("simhash"), F.min("doc_id").alias("first_id")), "named-distinct")
    found = components(links(texts.select("simhash").distinct(), budget, two_bands=True)).withColumnRenamed("node", "simhash")
    roots = settle(texts.join(found, "simhash", "left").select("mark", "first_id", F.coalesce("root", "simhash").alias("root")), "near-roots")
    several = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("root")
    left = settle(roots.join(several, "root").select("mark", "first_id", "root"), "near-several")
    ids = left.select("first_id", "mark")
    sets = with_names(maybe_in(docs, key, ids.select("first_id")), key=key, text=text, shingle=shingle, sets=True)
    words = settle(sets.join(ids.select("mark"), "mark", "left_semi").dropDuplicates(["mark"]).select("mark", "words"), "near-words")
    taken = texts.select("mark", F.col("mark").alias("head")).limit(0)
    while True:
        members = left.join(words, "mark")
        first = F.min(F.struct(F.col("first_id").isNull(), F.col("first_id"), F.col("mark")))
        sizes = members.groupBy("root").agg(F.sum(F.size("words")).alias("n"), first.alias("first"))
        sizes = settle(sizes.select("root", "n", F.col("first.mark").alias("head")), "near-sizes")
        small, large = sizes.where(F.col("n") <= task_shingles).select("root"), sizes.where(F.col("n") > task_shingles).select("root", "head")
        taken = taken.unionByName(settle(_grouped_in_tasks(members.join(small, "root", "left_semi"), least), "near-taken"))
        if large.isEmpty():
            break
        pairs = members.join(large, "root").where("mark <> head")
        both = pairs.join(words.select(F.col("mark").alias("head"), F.col("words").alias("others")), "head")
        common = F.size(F.array_intersect("words", "others"))
        alike = common >= least * (F.size("words") + F.size("others") - common)
        judged = settle(both.select("mark", "first_id", "root", "head", alike.alias("alike")), "near-judged")
        taken = taken.unionByName(judged.where("alike").select("mark", "head"))
        left = judged.where("NOT alike").select("mark", "first_id", "root")
    grouped = settle(texts.join(taken, "mark", "left").select("mark", "first_id", F.coalesce("head", "mark").alias("component")), "near-groups")
    names = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labels = settle(grouped.join(names, "component").select("mark", "component_id", "component"), "near-labels")
    return named.join(labels, "mark").select("doc_id", "mark", "component_id", "component")


def without_near_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 5, **options) -> DataFrame:
    """``docs`` with one row of each group of ``near_copies``, chosen as ``one_per_group`` does."""
    named = functools.partial(with_names, key="row", text="_t", shingle=shingle)
    return _one_of_each(docs, near_copies(docs, key=key, text=text, shingle=shingle, **options), named, key, text)
