"""Queries of the subpackage: one per operator, and the corpus pipeline."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ridgeline.llm import (
    decontaminate,
    jaccard,
    packing,
    quality,
    runs,
    secrets,
    sharding,
    simhash,
    spelling,
    tokens,
    toxicity,
    urls,
    warc,
)
from ridgeline.llm.common import stored
from ridgeline.session import scratch_path
from ridgeline.sources.tables import table

#: Path of the tokenizer; a parameter of the deployment.
TOKENIZER = os.environ.get("RIDGELINE_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")
SHARDS = 40
RULES = [urls.Rule("allow", "com/"), urls.Rule("block", "example.com/en/"),
         urls.Rule("allow", "www.example.com/en/"), urls.Rule("block", "net/es/"), urls.Rule("block", "net/fr/")]


def held_out() -> Column:
    """One fifth of the documents, by the CRC-32 of doc_id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids, one row per piece."""
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("text_md5")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All benchmark passages that documents hold, with their place and edits."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written to token files and read back."""
    path = tokens.token_files(table(spark, sf_dir, "documents"), TOKENIZER)
    return tokens.ids_crc32(tokens.read_tokens(spark, path))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside the held-out fold."""
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.size("passages").alias("n_passages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; equal texts share a shard."""
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and places of the base patterns, and all spans."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"),
                        count(2).alias("n_hex"),
                        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))


def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC files, read back as a replica, and audited against the manifest."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, path)
    rows = warc.audit(stored(warc.manifest(pages)), stored(warc.read_warc(spark, path)))
    return rows.select(F.col("key").alias("page_id"), "file", "offset", "length", F.col("found_hash").alias("sha256"),
                       "status")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: a rule's, else the language models'."""
    judged = urls.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    features = quality.quality_features(table(spark, sf_dir, "documents"))
    features = stored(features.select(F.struct("doc.doc_id").alias("doc"), "lang", "f"))
    judged = quality.judge_quality(features, quality.language_references(features))
    return judged.select("doc.doc_id", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines",
                         "f.n_repeat_words", "base_failed", "kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of all documents, one run in 97 with a letter left out."""
    found = spelling.letter_runs(table(spark, sf_dir, "documents"), keep=("doc_id",))
    name = F.concat(F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    found = found.select("run", F.crc32(name.cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    short = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    words = found.select(F.when(F.col("h") % 97 == 0, short).otherwise(F.col("run")).alias("word"))
    counts = (words.where(F.char_length("word") >= 5).groupBy("word").agg(F.count("*").alias("n"))
              .where("n >= 3"))
    return spelling.spelling_variants(counts)


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and its component over fingerprints at most 2 bits apart."""
    rows = simhash.simhash_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def periodic_tenth(doc: dict, n: int) -> np.ndarray | None:
    """Places of the words of a document: one in ten repeats a phrase from some word on."""
    if doc["doc_id"] is None or not n:
        return None
    h = zlib.crc32(str(doc["doc_id"]).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return places


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the strongest of them, and its words without repeats."""
    rows = runs.detect_runs(table(spark, sf_dir, "documents"), keep=("doc_id",), arrange=periodic_tenth)

    def stronger(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(a != b, F.when(a > b, -1).otherwise(1))
                .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))))
    best = F.get(F.array_sort("runs", stronger), F.lit(0))
    return (rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_packing, op2_jaccard_join, op3_decontamination, op4_token_files, op5_toxicity, op6_sharding,
    op7_secrets, op8_warc_audit, op9_url_filter, op10_quality, op11_spelling_variants, op12_simhash,
    op13_periodic_runs)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE_SQL: dict[str, str] = {
    "op8_warc_audit": """
WITH r AS (
  SELECT page_id, CAST(floor(page_id / 1024.0) AS BIGINT) AS file,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || CAST(page_id AS VARCHAR) || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || regexp_replace(coalesce(url, ''), '[\\r\\n]', ' ', 'g') || chr(13) || chr(10)
         || 'Content-Type: text/html' || chr(13) || chr(10)
         || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10)
         || chr(13) || chr(10) || coalesce(html, '') AS rec
  FROM pages)
SELECT page_id, file,
       CAST(coalesce(sum(strlen(rec) + 4) OVER (PARTITION BY file ORDER BY page_id, sha256(rec)
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
       CAST(strlen(rec) AS BIGINT) AS length, sha256(rec) AS sha256, 'ok' AS status
FROM r
""",
}
