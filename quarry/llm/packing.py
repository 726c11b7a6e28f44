"""Best-fit packing of tokenized documents, certified by lower bounds.

Documents are tokenized once into pieces; pieces shorter than a sequence are packed
in partitions of bounded size by best-fit decreasing. Dual feasible functions give a
lower bound on the bins of each partition. Where a partition has more bins than its
bound, it gives up the pieces of its emptiest bins; such pieces from all partitions
meet in fewer, mixed partitions and are packed anew, until nothing is left to
exchange or the rounds are over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_pairs import encoder
from .storage import settle

SEQUENCE = 2048
END_ID = 0


def tokenized_pieces(
    docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text", length: int = SEQUENCE, with_ids: bool = False
) -> DataFrame:
    """Every document's ids and an end id, cut into pieces of at most ``length``.

    Returns doc_id, uid (different for each row of the input), piece, start, length,
    ids_crc32 and, if asked, ids (little-endian uint32). Only the first piece may be
    shorter than ``length``. A null text is empty: one piece with the end id.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"), F.monotonically_increasing_id().alias("uid"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "uid", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, uid, content in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "uid", "_text"))):
                ids = encode(content or "") + end
                total = len(ids) // 4
                bounds = [0, *range(total % length or length, total + 1, length)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[4 * a : 4 * b]
                    for column, v in zip(out, (doc_id, uid, piece, a, b - a, zlib.crc32(part), part)):
                        column.append(v)
            types = [batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    schema = f"doc_id {kind}, uid long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(cut, schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best bound of two families of dual feasible functions.

    The first counts items over capacity - k in full, drops those under k and keeps
    the rest in proportion, for every k up to half; with k = 0 it is the sum bound.
    The second maps x / capacity to floor((m + 1) x / capacity) / m, but leaves x
    where (m + 1) x / capacity is whole.
    """
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1]
    size = np.arange(capacity + 1)
    items, mass = np.cumsum(count), np.cumsum(count * size)
    k = np.arange(capacity // 2 + 1)
    large = items[-1] - items[capacity - k]
    middle = mass[capacity - k] - np.where(k > 0, mass[np.maximum(k - 1, 0)], 0)
    best = int(np.max(large + -(-middle // capacity)))
    for m in range(1, 33):
        scaled = (m + 1) * size
        whole = scaled % capacity == 0
        # in units of 1 / (m * capacity), so that everything stays an integer
        value = np.where(whole, m * size, (scaled // capacity) * capacity)
        best = max(best, int(-(-(count * value).sum() // (m * capacity))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """A bin number per item; items by falling length, each to the fullest bin that takes it."""
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if some bin has room r
    made = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        fitting = open_rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, at, made = capacity, made, made + 1
        bins[item] = at
        room -= need
        by_room[room].append(at)
        open_rooms |= 1 << room
    return bins


def _pack_group(lengths: np.ndarray, capacity: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """A bin per item, and which items are loose.

    A group with more bins than its bound releases its emptiest bins, ``slack`` times
    as many as it could save. A certified group keeps its bins; only the emptiest one,
    if not full, is released to meet those of other groups.
    """
    bins = best_fit_decreasing(lengths, capacity)
    made = int(bins.max()) + 1
    gap = made - lower_bound(lengths, capacity)
    fill = np.bincount(bins, lengths, made)
    emptiest = np.argsort(fill, kind="stable")[: max(1, int(np.ceil(gap * slack)))]
    return bins, np.isin(bins, emptiest[fill[emptiest] < capacity])


def pack(
    pieces: DataFrame, *, capacity: int = SEQUENCE, group_rows: int = 16_384, rounds: int = 4, slack: float = 4.0
) -> DataFrame:
    """Add sequence_id and offset to rows that have uid, piece and a length of 1 to ``capacity``.

    Rows are dealt by hash to groups of about ``group_rows`` and packed as the module
    says; a group's loose rows, those of its part-filled emptiest bins, go to the
    next round. What the last round packs stays. All columns are carried along; a
    column named sequence_id or offset is replaced. Sequence ids are unique, not
    gapless. Empty tables give an empty result; equal pieces are interchangeable.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rest = pieces.select(columns)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    schema = f"{fields}, sequence_id long, offset long, _loose boolean"
    done: list[DataFrame] = []
    n_rows = rest.count()
    for turn in range(rounds):
        n_groups = max(1, -(-n_rows // group_rows))
        last = turn == rounds - 1 or (turn > 0 and n_groups == 1)

        def packed(batches: Iterator[pa.RecordBatch], turn: int = turn, last: bool = last) -> Iterator[pa.RecordBatch]:
            for group, table in _groups(batches):
                lengths = table.column("length").to_numpy().astype(np.int64)
                bins, loose = _pack_group(lengths, capacity, slack)
                order = np.argsort(bins, kind="stable")
                bins, lengths = bins[order], lengths[order]
                first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
                before = np.cumsum(lengths) - lengths
                offset = before - np.repeat(before[first], np.diff(np.r_[first, len(bins)]))
                # a group has at most one bin a row; rounds and groups have ranges of their own
                number = ((np.int64(group) << 24) + bins) * rounds + turn
                out = table.take(pa.array(order)).append_column("sequence_id", pa.array(number))
                out = out.append_column("offset", pa.array(offset)).append_column("_loose", pa.array(loose[order] & (not last)))
                yield from out.drop_columns(["_group"]).to_batches()

        group = F.pmod(F.xxhash64("uid", "piece", F.lit(turn)), F.lit(n_groups))
        dealt = rest.withColumn("_group", group).repartition(n_groups, "_group").sortWithinPartitions("_group")
        result = settle(dealt.mapInArrow(packed, schema), f"packing-{turn}")
        done.append(result.where(~F.col("_loose")).drop("_loose"))
        rest = result.where("_loose").select(columns)
        n_rows = 0 if last else rest.count()
        if not n_rows:
            break
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    return placed


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The runs of equal ``_group`` in sorted batches, put together across batches."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        group = batch.column("_group").to_numpy()
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and group[a] != at:
                yield at, pa.Table.from_batches(held).combine_chunks()
                held = []
            at = int(group[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield at, pa.Table.from_batches(held).combine_chunks()


def pack_documents(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text", length: int = SEQUENCE) -> DataFrame:
    """Tokenize and pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts are empty, empty texts are one end id; repeated rows and null ids are
    packed as rows of their own. Columns besides key and text are not read.
    """
    pieces = settle(tokenized_pieces(docs, vocabulary, key=key, text=text, length=length), "pieces")
    return pack(pieces, capacity=length).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
