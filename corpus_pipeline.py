"""From raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir), where docs is all that its predecessor kept, and
returns a frame that is written as Parquet and read again. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskfeatures.llm import mixing, near_dedup, pieces, pii, quality
from riskfeatures.llm.common import read, stored
from riskfeatures.llm.queries import piece_model


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the given labels."""
    scored = quality.classify(spark, docs, read(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose runs of five words are alike to 0.8."""
    return near_dedup.deduplicate(docs, k=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind."""
    return pii.mask_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents whose tokens have flattened shares of source, language and topic."""
    return mixing.mix(docs).where("sampled").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and digests of ids and decoded text."""
    return pieces.digests(pieces.encode_pieces(spark, docs, piece_model()))


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
    ("pieces", encode),
]

# Classifier, raking and encoding are not SQL; tests hold the rows against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole documents table."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
