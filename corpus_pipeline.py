"""A corpus pipeline in five stages, each an operator at work on what the one before kept.

All stages but the last return the columns of their input, also columns that the
operators do not know. Nulls may stand in any column; a stage's docstring says what
becomes of them. An empty table passes through all stages and gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import mixing, packing, quality, simhash, suffix_dedup
from quarry.llm.storage import documents, settle

VOCABULARY = "byte_bpe_50k.json"

#: Learnt trees, fingerprints and removed byte ranges cannot be stated in SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the boosted trees keep.

    Null, empty and very short texts have under ten words and go. Without usable labels
    the base rule alone decides. Repeated rows are judged alike; a null id is no reason to go.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    columns = docs.columns
    quoted = [F.col(f"`{c}`") for c in columns]
    judged = quality.judge(docs.withColumn("_row", F.struct(*quoted)), model, keep=("_row",))
    return judged.where("kept").select("_row.*").select(quoted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id.

    Candidates are within 7 bits of the SimHash of their different words; the others of a
    group have a five-word Jaccard similarity of 0.8 or more with the one that stays.

    Of repeated rows one stays. Texts without a word, null ones too, are one group; rows
    without an id belong to the groups of their texts and stay only where no id is there.
    """
    return simhash.without_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated strings of 200 bytes (``suffix_dedup.PASSAGE``); n_chars follows the text.

    Rows all stay: a text of which everything is repeated becomes empty, a null text stays null.
    """
    cut = suffix_dedup.without_repeats(docs, length=suffix_dedup.PASSAGE)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select([F.col(f"`{c}`") for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for: not at all, once or twice.

    Null sources are one source, the last. Rows of one id, or without one, share a decision.
    """
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens.

    A null or empty text is a piece of the end id alone. Rows are packed each for itself,
    so a document that the mix repeats has its pieces twice.
    """
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing to target weights", source_mix),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
