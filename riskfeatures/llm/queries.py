"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment, ann, chat, language_model, license_scan, mixing, near_dedup, pieces, pii, quality, spelling, spotsigs, suffix_dedup,
)
from .common import read

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every text: places of base phrases, labels and score."""
    return license_scan.digests(license_scan.scan_licenses(read(spark, sf_dir, "documents")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability and decision of every document for flattened target shares."""
    return mixing.digests(mixing.mix(read(spark, sf_dir, "documents")))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, on runs of four words."""
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), k=4)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts, spans and their digest."""
    return pii.digests(pii.pii_spans(read(spark, sf_dir, "documents")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered role and canonical form of every turn."""
    return chat.digests(chat.recover_roles(read(spark, sf_dir, "conversations")))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the strings of 50 bytes that an earlier document has."""
    return suffix_dedup.digests(suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    vectors = read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, counts and round trip of every text, as digests."""
    return pieces.digests(pieces.encode_pieces(spark, read(spark, sf_dir, "documents"), piece_model()))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labelled ones that are not held out."""
    docs, labels = (read(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.digests(quality.classify(spark, docs, labels))


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and edited texts, and their likeness."""
    return spotsigs.fingerprints(spark, read(spark, sf_dir, "documents"))


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text under word frequencies and under the trained model."""
    return language_model.score_texts(spark, read(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent long word with its near words, form and root."""
    return spelling.group_variants(read(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and pair counts of two tokenizers over every text."""
    import public_tokenizers

    return alignment.align(
        spark, read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, piece_model()
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_mixing": op2_mixing,
    "op3_near_dedup": op3_near_dedup,
    "op4_pii": op4_pii,
    "op5_chat": op5_chat,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_ann": op7_ann,
    "op8_pieces": op8_pieces,
    "op9_quality": op9_quality,
    "op10_spotsigs": op10_spotsigs,
    "op11_language_model": op11_language_model,
    "op12_spelling": op12_spelling,
    "op13_alignment": op13_alignment,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op3_near_dedup": near_dedup.oracle(),
    "op4_pii": pii.oracle(),
    "op6_suffix_dedup": suffix_dedup.oracle(),
    "op10_spotsigs": spotsigs.oracle(),
}
