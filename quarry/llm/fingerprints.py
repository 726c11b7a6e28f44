"""Exact fingerprints of canonical texts.

A text's canonical form is Unicode-normalised (NFKC), case-folded and has every run
of white space as one space, none at the ends. Its fingerprint is the 128-bit xxh3
of the UTF-8 bytes. Rows are grouped by it, and where a bucket holds more than one
row its canonical bytes are compared, so a collision can never join two texts.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bit_filter import maybe_in
from .storage import settle

Digest = Callable[[bytes], str]


def canonical(text: str | None) -> bytes:
    """Canonical bytes; a null text counts as empty. Folding can undo normal form, so it is made again."""
    folded = unicodedata.normalize("NFKC", text or "").casefold()
    return " ".join(unicodedata.normalize("NFKC", folded).split()).encode("utf-8", "surrogatepass")


def with_digest(docs: DataFrame, *, key: str = "doc_id", text: str = "text", digest: Digest = xxhash.xxh3_128_hexdigest) -> DataFrame:
    """doc_id, digest and canonical bytes of every row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [canonical(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(digest, forms), pa.string()), pa.array(forms, pa.binary())],
                names=["doc_id", "digest", "canonical"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(hashed, f"doc_id {kind}, digest string, canonical binary")


def verified_groups(
    docs: DataFrame,
    digests: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    digest: Digest = xxhash.xxh3_128_hexdigest,
) -> DataFrame:
    """One row per different canonical text among rows whose digest is not unique.

    ``digests`` has doc_id and digest of all rows of ``docs``. Returns digest, group_id
    (smallest doc_id of the text), rows, and rank among the texts of one digest: 0
    unless two different texts collide. Grouping by digest and bytes is the byte
    comparison; Spark merges copies before it shuffles them, so a group of any size
    leaves one row per task.
    """
    shared = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    among = digests.join(shared, "digest", "left_semi").select(F.col("doc_id").alias("_id")).distinct()
    among = settle(among, "fingerprint-shared")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    # the filter keeps most texts out of the shuffle that the join may need
    texts = maybe_in(rows, "doc_id", among).join(among, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    groups = with_digest(texts, digest=digest).groupBy("digest", "canonical").agg(
        F.min("doc_id").alias("group_id"), F.count(F.lit(1)).alias("rows")
    )
    by_text = Window.partitionBy("digest").orderBy("canonical")
    return groups.withColumn("rank", F.row_number().over(by_text) - 1)


_EDIT_FIELDS = {
    "n_chars": "long",
    "edited_sha256": "string",
    "fingerprint": "string",
    "edited_fingerprint": "string",
    "near_edited": "double",
    "near_next": "double",
}


def _edit_row(content: str, following: str, digest: Digest) -> tuple:
    half = len(content) // 2
    changed = content[: len(content) - half] + following[:half]
    own, other, near = canonical(content), canonical(changed), canonical(following)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return len(content), sha, digest(own), digest(other), float(own == other), float(own == near)


def fingerprint_edits(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", digest: Digest = xxhash.xxh3_128_hexdigest
) -> DataFrame:
    """Fingerprints of every text and of its edit with the head of the next document.

    The edit replaces the last floor(n_chars / 2) code points by the first as many
    (or all) of the next text in descending order of key, the first following the
    last. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next. An exact fingerprint has no degrees: likeness is 1 if
    the canonical bytes are equal and 0 otherwise.

    A null text counts as empty; null keys come last. Rows with equal keys follow each
    other by text. A single row is its own next. An empty table gives an empty result.
    Other columns are not read.

    Texts are shuffled once, to ranges of the key. A task sees all neighbours but the
    one after its last row, so it leaves its first and last texts aside, and these
    pairs (two rows a task) are finished afterwards.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    down = F.col("doc_id").desc_nulls_last()
    in_order = rows.repartitionByRange(n, down).sortWithinPartitions(down, F.col("text").desc())
    fields = ", ".join(f"{c} {t}" for c, t in _EDIT_FIELDS.items())
    edge_fields = f"slice int, edge string, text string, doc_id {kind}, {fields}"

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last = TaskContext.get().partitionId(), None
        nothing = (None,) * len(_EDIT_FIELDS)
        for batch in batches:
            out = []
            for doc_id, content in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if last is None:
                    out.append((at, "first", content, doc_id, *nothing))
                else:
                    out.append((at, None, None, last[0], *_edit_row(last[1], content, digest)))
                last = (doc_id, content)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=schema)
        if last is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (at, "last", last[1], last[0], *nothing)))], schema=schema)

    names = ["slice", "edge", "text", "doc_id", *_EDIT_FIELDS]
    schema = _arrow(edge_fields, docs)
    found = settle(in_order.mapInArrow(pairs, edge_fields), "edits")

    firsts = found.where("edge = 'first'").select(F.col("slice").alias("_next"), F.col("text").alias("following"))
    everything = Window.partitionBy()
    follows = firsts.select("_next").select(  # one number per task that had rows
        F.col("_next").alias("slice"),
        F.coalesce(F.lead("_next").over(Window.orderBy("_next")), F.min("_next").over(everything)).alias("_next"),
    )
    lasts = found.where("edge = 'last'").select("slice", "doc_id", "text").join(follows, "slice").join(firsts, "_next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = [
                (doc_id, *_edit_row(content, following, digest))
                for doc_id, content, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")))
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(closed.names, x)) for x in edits], schema=closed)

    closed = _arrow(f"doc_id {kind}, {fields}", docs)
    done = lasts.select("doc_id", "text", "following").mapInArrow(close, f"doc_id {kind}, {fields}")
    return found.where("edge IS NULL").select("doc_id", *_EDIT_FIELDS).unionByName(done)


def _arrow(ddl: str, df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def fingerprint(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", digest: Digest = xxhash.xxh3_128_hexdigest
) -> DataFrame:
    """``fingerprint_edits`` and each row's verified group of equal canonical texts.

    Adds group_id (smallest doc_id with the same canonical text) and group_rows. Texts
    that share a fingerprint by collision only are in different groups. Nulls, empty
    texts, ties and clashing columns are treated as in ``fingerprint_edits``.
    """
    edits = settle(fingerprint_edits(docs, key=key, text=text, digest=digest), "fingerprints")
    digests = edits.select("doc_id", F.col("fingerprint").alias("digest"))
    groups = settle(verified_groups(docs, digests, key=key, text=text, digest=digest), "fingerprint-groups")
    collided = settle(groups.where("rank > 0").select("digest").distinct(), "fingerprint-collisions")
    result = ["doc_id", *_EDIT_FIELDS, "group_id", "group_rows"]

    simple = groups.join(collided, "digest", "left_anti").select(
        F.col("digest").alias("fingerprint"), F.col("group_id").alias("_g"), F.col("rows").alias("_n")
    )
    grouped = edits.join(simple, "fingerprint", "left").select(
        *edits.columns,
        F.coalesce("_g", "doc_id").alias("group_id"),
        F.coalesce("_n", F.lit(1).cast("long")).alias("group_rows"),
    )
    if collided.isEmpty():
        return grouped.select(result)
    ids = digests.join(collided, "digest", "left_semi").select(F.col("doc_id").alias("_id")).distinct()
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    exact = (
        with_digest(texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"), digest=digest)
        .join(groups, ["digest", "canonical"])
        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("fingerprint"), "group_id", F.col("rows").alias("group_rows"))
        .distinct()
    )
    clash = F.broadcast(collided.withColumnRenamed("digest", "fingerprint"))  # chance collisions of 128 bits
    return (
        grouped.join(clash, "fingerprint", "left_anti").select(result)
        .unionByName(
            edits.join(clash, "fingerprint", "left_semi")
            .join(exact, (edits["fingerprint"] == exact["fingerprint"]) & edits["doc_id"].eqNullSafe(exact["_id"]))
            .drop(exact["fingerprint"]).select(result)
        )
    )
