"""Removal of byte strings that occur more than once in a corpus, by suffix sorting.

A byte goes if it lies in a string of ``length`` bytes that starts at another place
too. To find these strings without sorting all suffixes of the corpus in one place:

1. Every text is cut into segments of starts by local anchors: a start belongs to the
   least hash among the ``gram``-byte strings inside its ``length`` bytes. Equal
   strings have equal anchors, so they meet under the anchor's hash.
2. Anchors that occur once in the corpus are dropped with their starts. Copies of a
   segment (with all bytes that its starts cover) are merged and counted before anything
   is sorted; a segment that occurs twice is repeated throughout.
3. What is left are different segments under one anchor, mostly at the ends of repeated
   passages. One copy of each is dealt by anchor to shards, whose suffixes are put in
   order by external induced sorting (``induced_sort``) with their common prefixes.
4. An anchor with more than ``shard_segments`` different segments, which would be much
   for one task, is split first: its segments are cut anew, by steps 1 to 3, with anchors
   of nearly ``length`` bytes, and at last of all ``length`` bytes.

Copies are told apart by 128 bits (anchor and name), texts by their MD5, so equal texts
are worked on once. Bytes are not compared again where these agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bit_filter import maybe_in, surely_not_in
from .induced_sort import repeated_starts
from .storage import passing, settle

LENGTH = 400
#: Fifty tokens of about four bytes: the usual length of a passage that is worth removing.
PASSAGE = 200
#: Positions share a 64-bit word with hashes, so texts are anchored in blocks of up to 2^24 starts.
_BLOCK = 1 << 23
_POSITION = np.uint64((1 << 24) - 1)

_rng = np.random.default_rng(400)
_BYTE_HASH = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _rng.integers(0, 1 << 62, 16, dtype=np.uint64) * np.uint64(4) + np.uint64(1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes: by doubling, then from two halves that may overlap."""
    h, size, k = _BYTE_HASH[data], 1, 0
    while 2 * size <= gram:
        h = h[:-size] * _FACTORS[k] + h[size:]
        size, k = 2 * size, k + 1
    if size < gram:
        h = h[: len(data) - gram + 1] * _FACTORS[k] + h[gram - size :]
    h = (h ^ (h >> np.uint64(32))) * _FACTORS[-1]
    return h ^ (h >> np.uint64(29))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values, from running minima to both sides of block ends."""
    if width == 1:
        return x
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, width)
    to_end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    from_start = np.minimum.accumulate(blocks, axis=1).ravel()
    n = len(x) - width + 1
    return np.minimum(to_end[:n], from_start[width - 1 : width - 1 + n])


def segments(data: bytes, length: int, gram: int) -> np.ndarray:
    """Rows (anchor hash, segment hash, first start, number of starts, places) of a text's segments.

    The segment hash covers all bytes of its starts. Neighbouring starts of one anchor hash
    are one segment even where the anchor's string stands in several places (``places`` is
    1 or 2, for more), so a run of one byte has few segments. A segment has at most
    8 x ``length`` starts.
    """
    whole = np.frombuffer(data, np.uint8)
    found = [_NONE]
    for block in range(0, len(data) - length + 1, _BLOCK):
        part = whole[block : block + _BLOCK + length - 1]
        h = gram_hashes(part, gram)
        least = _sliding_least((h & ~_POSITION) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        place = (least & _POSITION).astype(np.int64)
        anchor = h[place]
        n = len(anchor)
        moves = np.cumsum(np.append(False, place[1:] != place[:-1]))
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        size = np.diff(np.append(first, n))
        if size.max() > 8 * length:
            cuts = [np.arange(s, s + c, 8 * length) for s, c in zip(first.tolist(), size.tolist())]
            first = np.concatenate(cuts)
            size = np.diff(np.append(first, n))
        rows = np.empty((len(first), 5), np.int64)
        rows[:, 0], rows[:, 2], rows[:, 3] = anchor[first].view(np.int64), first + block, size
        rows[:, 4] = 1 + (moves[first + size - 1] > moves[first])
        digest, view, rest = xxhash.xxh3_64_intdigest, memoryview(data), length - 1
        names = [digest(view[s : s + c + rest]) for s, c in zip(rows[:, 2].tolist(), size.tolist())]
        rows[:, 1] = np.array(names, np.uint64).view(np.int64)
        found.append(rows)
    return np.concatenate(found)


_NONE = np.empty((0, 5), np.int64)


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def _identity(text: Column) -> Column:
    return F.unhex(F.md5(_bytes(text)))


_SEGMENTS = "segments array<struct<anchor: long, name: long, first: int, starts: int, places: int>>"


def _segment_lists(found: list[np.ndarray]) -> pa.Array:
    rows = np.concatenate([_NONE, *found])
    ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
    fields = [pa.array(rows[:, k].astype(t)) for k, t in enumerate((np.int64, np.int64, np.int32, np.int32, np.int32))]
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, names=["anchor", "name", "first", "starts", "places"]))


def _few_rows(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Segments take about as much room as their texts, so few rows at a time."""
    return (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))


def _described(docs: DataFrame, length: int, gram: int, columns: list[str]) -> DataFrame:
    """``columns``, text_id, n_bytes, full_sha256 and segments of every row (with a column ``text``)."""
    rows = docs.select(*columns, _identity(F.col("text")).alias("text_id"), _bytes(F.col("text")).alias("_bytes"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_bytes")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [*columns, "text_id"]
        for batch in _few_rows(batches):
            data = batch.column("_bytes").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept), pa.array(map(len, data), pa.int64()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                    _segment_lists([segments(d, length, gram) for d in data]),
                ],
                names=[*kept, "n_bytes", "full_sha256", "segments"],
            )

    return rows.mapInArrow(describe, f"{kinds}, n_bytes long, full_sha256 string, {_SEGMENTS}")


def _described_spans(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """text_id, copies and segments of texts (text_id, copies, data, ranges), inside their merged ranges only."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_rows(batches):
            out = []
            for data, ranges in zip(batch.column("data").to_pylist(), batch.column("ranges").to_pylist()):
                parts = [(a, segments(data[a:b], length, gram)) for a, b in merged(ranges) if b - a >= length]
                for a, rows in parts:
                    rows[:, 2] += a
                out.append(np.concatenate([_NONE, *(rows for _, rows in parts)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_id"), batch.column("copies"), _segment_lists(out)], names=["text_id", "copies", "segments"]
            )

    return texts.select("text_id", "copies", "data", "ranges").mapInArrow(describe, f"text_id binary, copies long, {_SEGMENTS}")


def _suffix_ranges(pieces: DataFrame, length: int, memory_rows: int) -> DataFrame:
    """(anchor, name, a, b): starts a to b - 1 of a segment are repeated, for segments with bytes.

    A shard is closed at the first anchor after ``memory_rows`` bytes; an anchor's own
    segments are one shard however many they are, on disk beyond ``memory_rows``.
    """
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.select("anchor", "name", "bytes").repartition(n, "anchor").sortWithinPartitions("anchor")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "name", "bytes"))))
        ahead = next(rows, None)
        while ahead is not None:
            keys: list[tuple[int, int]] = []

            def shard() -> Iterator[bytes]:
                nonlocal ahead
                size = 0
                while ahead is not None and (size <= memory_rows or ahead[0] == keys[-1][0]):
                    keys.append(ahead[:2])
                    size += len(ahead[2])
                    yield ahead[2]
                    ahead = next(rows, None)

            out = []
            # the keys are there once the first flags are
            for flags, (anchor, name) in zip(repeated_starts(shard(), length, memory_rows=memory_rows), keys):
                edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).view(np.int8))).tolist()
                out += [(anchor, name, s, e) for s, e in zip(edges[::2], edges[1::2])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _RANGE.values())], names=list(_RANGE))

    return dealt.mapInArrow(sort, "anchor long, name long, a int, b int")


_RANGE = {"anchor": pa.int64(), "name": pa.int64(), "a": pa.int32(), "b": pa.int32()}


def _repeats(described: DataFrame, texts: DataFrame, length: int, grams: tuple[int, ...], shard_segments: int, memory_rows: int) -> tuple[DataFrame, DataFrame]:
    """(text_id, ranges): byte ranges [a, b) of repeated strings, which may overlap; and the texts
    (text_id, data) of these and some others.

    ``described`` has text_id, copies and segments by the first of ``grams``; texts of one
    id may stand in several rows. ``texts`` has text_id and data, an id once or more.
    """
    each = described.select("text_id", "copies", F.explode("segments").alias("s")).select("text_id", "copies", "s.*")
    meeting = each.groupBy("anchor").agg(F.sum(F.col("copies") * F.col("places")).alias("total")).where("total > 1").select("anchor")
    meeting = settle(meeting, "meeting")
    # copies of a text are merged here; from now on a row is a segment of one text. Its text and place
    # are the grouping key, not its anchor: so the join may split the rows of a frequent anchor
    same = [F.min(c).alias(c) for c in ("anchor", "name", "starts", "places")]
    several = maybe_in(each, "anchor", meeting).join(meeting, "anchor")
    candidates = settle(several.groupBy("text_id", "first").agg(*same, F.sum("copies").alias("copies")), "candidates")
    named = settle(
        candidates.groupBy("anchor", "name").agg(
            F.sum("copies").alias("n"), F.min(F.struct("text_id", "first", "starts")).alias("one"), F.max("places").alias("places")
        ),
        "named",
    )
    # different segments of one anchor may share strings, and so may the places of a single one
    variants = named.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants"), F.max(F.when(F.col("n") == 1, F.col("places"))).alias("most"))
    variants = variants.where("variants > 1 OR most > 1").drop("most")
    mixed = settle(named.join(variants, "anchor").select("anchor", "name", "n", "one.*", "variants"), "mixed")

    # only texts that may lose something are shuffled on; one row each
    ids = candidates.select("text_id").distinct()
    wanted = maybe_in(texts, "text_id", ids).join(ids, "text_id", "left_semi")
    wanted = settle(wanted.groupBy("text_id").agg(F.first("data").alias("data")), "texts", keep=True)

    covered = F.substring("data", F.col("first") + 1, F.col("starts") + length - 1)
    pieces = settle(mixed.join(wanted, "text_id").select("anchor", "name", "n", "variants", covered.alias("bytes")), "pieces")
    ranges = _suffix_ranges(pieces.where(F.col("variants") <= shard_segments), length, memory_rows)
    hot = pieces.where(F.col("variants") > shard_segments)
    if len(grams) > 1 and not hot.isEmpty():
        id_ = F.unhex(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in ("anchor", "name"))))
        cut = hot.select(id_.alias("text_id"), F.col("n").alias("copies"), F.col("bytes").alias("data"), "anchor", "name")
        whole = F.array(F.struct(F.lit(0).alias("a"), F.length("data").alias("b")))
        finer = settle(_described_spans(cut.withColumn("ranges", whole), length, grams[1]), "finer")
        found, _ = _repeats(finer, cut.select("text_id", "data"), length, grams[1:], shard_segments, memory_rows)
        spread = cut.select("text_id", "anchor", "name").join(found, "text_id").select("anchor", "name", F.explode("ranges").alias("s"))
        ranges = ranges.unionByName(spread.select("anchor", "name", F.col("s.a").alias("a"), (F.col("s.b") - length + 1).alias("b")))
    whole = named.where("n > 1").select("anchor", "name", F.lit(0).alias("a"), F.lit(None).cast("int").alias("b"))
    single = named.where("n = 1").select("anchor", "name")
    hits = whole.unionByName(ranges.join(single, ["anchor", "name"], "left_semi"))
    spans = (
        candidates.join(hits, ["anchor", "name"])
        .select(
            "text_id",
            F.struct(
                (F.col("first") + F.col("a")).alias("a"),
                (F.col("first") + F.coalesce(F.col("b"), F.col("starts")) + length - 1).alias("b"),
            ).alias("s"),
        )
        # a text's ranges are no more than its segments and the runs inside them
        .groupBy("text_id")
        .agg(F.collect_set("s").alias("ranges"))
    )
    return settle(spans, "spans", keep=True), wanted


def _grams(length: int) -> tuple[int, ...]:
    """About a third of ``length`` for texts; for hot anchors fifteen bytes less than ``length``, then all of it."""
    return max(length * 8 // 25, 1), max(length - 15, 1), length


def find_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, shard_segments: int = 4096, memory_rows: int = 1 << 20
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Described rows (doc_id, text_id, n_bytes, full_sha256), (text_id, ranges) of texts with
    repeats, and (text_id, data) of these texts and some others.
    """
    plain = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = settle(_described(plain, length, _grams(length)[0], ["doc_id"]), "described", keep=True)
    texts = plain.select(_identity(F.col("text")).alias("text_id"), _bytes(F.col("text")).alias("data"))
    spans, texts = _repeats(rows.withColumn("copies", F.lit(1).cast("long")), texts, length, _grams(length), shard_segments, memory_rows)
    return rows.drop("segments"), spans, texts


def merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted maximal [a, b) ranges of overlapping or touching ones."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in ranges or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in spans)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(a for a, _ in spans), len(data)]))


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans less the bytes of characters that they cut."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """``docs`` with repeated strings cut out of the text, whole characters only.

    Same columns and rows. Null texts stay null; a text of which all is repeated
    becomes empty. See ``removal_report`` for other cases.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for data, ranges in zip(batch.column("data").to_pylist(), batch.column("ranges").to_pylist()):
                kept.append(_without(data, whole_characters(data, merged(ranges))).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), pa.array(kept, pa.string())], names=["__cut_id", "__cut_kept"])

    with passing(docs.sparkSession):
        _, spans, texts = find_repeats(docs, key=key, text=text, **options)
        changed = settle(texts.join(spans, "text_id").mapInArrow(cut, "__cut_id binary, __cut_kept string"), "cut-texts", keep=True)
    own = F.col(f"`{text}`")
    named = docs.withColumn("__cut_text_id", _identity(own))
    ids = changed.select("__cut_id")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # texts that lose nothing are most; the bit filter lets them stay where they are
    same = surely_not_in(named, "__cut_text_id", ids).select(columns)
    rest = maybe_in(named, "__cut_text_id", ids).join(changed, F.col("__cut_text_id") == F.col("__cut_id"), "left")
    new = F.when(own.isNotNull(), F.coalesce("__cut_kept", own))
    return same.unionByName(rest.select(*(new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns)))


def removal_report(
    docs: DataFrame, *, length: int = LENGTH, passage: int | None = PASSAGE, shard_segments: int = 4096, memory_rows: int = 1 << 20, **names: str
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and n_repeated for every row.

    n_repeated counts the bytes inside strings of ``passage`` bytes (at most ``length``; None:
    the same) that also start elsewhere; the other columns are for ``length``. A string of
    ``length`` bytes is made of repeated strings of ``passage`` bytes, so it is sought
    only inside what these cover.

    Null and empty texts have no bytes; texts under ``length`` bytes lose nothing. Very long
    texts are cut into segments in blocks of 2^23 starts, with nothing lost between blocks.
    Repeated rows lose everything if they are long enough, as does every copy. Null
    ids are rows like any other. Columns besides key and text are not read; an empty
    table gives an empty result.
    """
    passage = min(passage or length, length)
    limits = {"shard_segments": shard_segments, "memory_rows": memory_rows}
    with passing(docs.sparkSession):
        rows, short, texts = find_repeats(docs, length=passage, **limits, **names)
    spans = short.withColumnRenamed("ranges", "all_ranges")
    if passage < length:
        with passing(docs.sparkSession):
            copies = rows.groupBy("text_id").agg(F.count(F.lit(1)).alias("copies"))
            inside = texts.join(short, "text_id").join(copies, "text_id")
            described = settle(_described_spans(inside, length, _grams(length)[0]), "described")
            long, _ = _repeats(described, texts, length, _grams(length), **limits)
        spans = spans.join(long, "text_id", "left")
    else:
        spans = spans.withColumn("ranges", F.col("all_ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text_id, data, ranges, every in zip(*(batch.column(c).to_pylist() for c in ("text_id", "data", "ranges", "all_ranges"))):
                found = merged(ranges)
                kept = hashlib.sha256(_without(data, found)).hexdigest()
                out.append((text_id, sum(b - a for a, b in found), len(found), kept, sum(b - a for a, b in merged(every))))
            types = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["text_id", "r", "s", "k", "p"])

    changed = texts.join(spans, "text_id").mapInArrow(cut, "text_id binary, r long, s long, k string, p long")
    zero = F.lit(0).cast("long")
    return rows.join(changed, "text_id", "left").select(
        "doc_id", "n_bytes", F.coalesce("r", zero).alias("n_removed"), F.coalesce("s", zero).alias("n_spans"),
        F.coalesce("k", "full_sha256").alias("kept_sha256"), F.coalesce("p", zero).alias("n_repeated"),
    )
