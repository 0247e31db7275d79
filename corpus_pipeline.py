"""A training corpus from `documents`: toxicity, near-duplicates, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwatch.llm import byte_bpe, mixing, simhash, toxicity
from tillwatch.llm.common import table
from tillwatch.sources.store import Store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labelled ones among them all.

    A null or empty text scores like a sentence without any known word. A text is scored whole, however long.
    Equal texts score alike, so repeated rows all stay or all go. Without labels of both classes, or rows, nothing goes.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of SimHash near-duplicates.

    Texts without words (null, empty) have one fingerprint and are one group; a null doc_id stays only where a group
    has no other. Of rows with the same doc_id and text the first by a hash of all columns stays, so repeated
    rows become one. An empty table stays empty.
    """
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most twice.

    A null source is a source of its own. Texts without words (null, empty) have no size and are taken by their own
    draw. Rows that agree in doc_id, text and source share the copies taken of them all as evenly as whole numbers can,
    the first by a hash of all columns before the others. An empty table stays empty.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each copy.

    A null or empty text has no ids; texts are encoded whole. Each row gives one, repeated ones too.
    """
    return byte_bpe.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: SQL cannot express the stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each but the last written as Parquet in the shared folder and read again.

    A stage's files go once the next stage's are written, so the folder holds at most two sets of texts.
    """
    docs = table(spark, sf_dir, "documents")
    store = Store(spark)
    before = None
    for name, stage in STAGES[:-1]:
        docs = store.keep(stage(spark, docs, sf_dir), name)
        if before:
            store.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
