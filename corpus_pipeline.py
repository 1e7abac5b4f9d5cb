"""The corpus pipeline: from all documents to the token ids of a mixed training set.

Quality classifier, exact dedup, SimHash near-dedup, source mixing, SentencePiece encoding. Each
stage works on what the stage before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textgate.llm import exact_dedup, mixing, pieces, quality, simhash
from textgate.plans.fixtures import table
from textgate.session import materialise

#: Documents that score less are rejected.
QUALITY = 0.3
#: Words of a shingle, and the bits in which two fingerprints of a group differ at most.
SHINGLE, BITS = 3, 3


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, accepts."""
    return quality.accept(docs, quality.quality_model(docs, table(spark, sf_dir, "labels")), QUALITY)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each text."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of linked fingerprints."""
    return simhash.keep_smallest(docs, shingle=SHINGLE, most=BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_ids, n_byte_ids, round_trip of every row."""
    return pieces.encode(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", accept_quality),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier and the fingerprints have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
