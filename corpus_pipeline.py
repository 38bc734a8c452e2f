"""A training corpus from documents: classify, clean lines, drop near copies, mix, pack."""

from __future__ import annotations

import math

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm.common import SAVED, release, save, table
from quotewright.llm.line_dedup import drop_spread_lines, near_copies
from quotewright.llm.mixing import mix_sources
from quotewright.llm.packing import pack_documents
from quotewright.llm.quality_model import classify
from quotewright.llm.simhash import drop_near_copies

#: Slots after which the schedule repeats, and how many spans of it are packed apart at most.
PERIOD, SPANS = 1000, 64
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity is over their language's threshold."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return classify(docs, trusted).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site lines out of the texts, but for near copies and texts of nothing else: the next stage judges these."""
    cleaned = drop_spread_lines(docs, least_sites=8, copies=near_copies).withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document, the one with the smallest id, of each group of near copies (0.8 over five-word shingles)."""
    return drop_near_copies(docs, words=5, similarity=0.8).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the schedule, all of them."""
    return mix_sources(docs).orderBy("slot", "doc_id").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 2048 tokens, numbered by the schedule.

    The schedule is that of the mixing stage, whose order a table doesn't hold. It is cut into at most ``SPANS`` spans of whole
    periods; each is packed apart, so sequences in the order of their numbers have the sources' target weights.
    """
    mixed = mix_sources(docs)
    last = mixed.agg(F.max("slot")).first()[0] or 0
    periods = math.ceil((last + 1) / (SPANS * PERIOD))
    mixed = mixed.withColumn("span", F.floor(F.col("slot") / (periods * PERIOD)).cast("long"))
    packed = pack_documents(mixed, public_tokenizers.path("byte_bpe_50k.json"), group_col="span")
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing", mixing),
    ("best-fit packing", packing),
]

#: A trained model, near copies and packing can't be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; a stage's tables are removed once its result is written."""
    docs, first = table(spark, sf_dir, "documents"), len(SAVED)
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = save(docs, "stage")
            release(spark, first)
    return docs
