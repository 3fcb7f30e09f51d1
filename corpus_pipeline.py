"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a frame that is written and read again before the next one. The
last stage returns pieces of sequences; the others the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import decontaminate, jaccard, packing, quality, secrets, tokens
from ridgeline.llm.common import stored
from ridgeline.session import small_batches
from ridgeline.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    small_batches(spark)
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the least doc_id."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets blotted out; n_chars follows the text."""
    found = secrets.scan_secrets(docs, keep=tuple(docs.columns))
    clean = secrets.redact(F.col("doc.text"), F.col("spans"))
    text = found.select("doc", clean.alias("text"))
    return text.select(*[F.col("text").alias(c) if c == "text"
                         else F.char_length("text").cast("long").alias(c) if c == "n_chars"
                         else F.col("doc")[c].alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids (little-endian, 32 bits) and the ids' CRC-32."""
    from ridgeline.llm.queries import TOKENIZER

    pieces = packing.pack_documents(docs, TOKENIZER, room=tokens.SHARED)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("secret_scan", secret_scan), ("packing", packing_stage)]

#: The near-duplicate search and the tokenizer are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), texts=True)
    return docs
