"""Incremental mood job: text files (track_id, lyrics, language) arriving in a
folder are routed, chunked, scored and voted batch by batch, and the moods
are merged by document into a keyed sink.

The batch operators are stateless per document (every chunk of a document
arrives in the same file), so each micro-batch is an ordinary DataFrame job
run through ``foreachBatch``. Progress is kept in a checkpoint folder under
the cluster's shared ``spark.checkpoint.dir`` so a restarted query resumes
where it stopped. The sink holds one row per document (``sources.keyed``): a
replayed batch, or all of them after a lost checkpoint, changes nothing, and a
document that arrives again replaces its mood.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridgeline.functions.rules import normalise_label
from ridgeline.operators import sentiment
from ridgeline.sources.io import TEXT_LANGUAGE_SCHEMA
from ridgeline.sources.keyed import BUCKETS, merge_by_key, recover


def moods_batch(texts: DataFrame, routes: Mapping[str, str] | None = None, *, size: int = 512,
                threshold: float = 0.75) -> DataFrame:
    """(track_id, language, mood) for one batch of texts. Without ``routes``
    the fixed per-language route table applies (rule and chunking per
    language)."""
    if routes is None:
        chunks = sentiment.explode_chunks_by_language(texts, "lyrics", "language")
        scored = sentiment.score_chunks_lexicon(chunks)
        raw = sentiment.raw_label_by_language("language")
        scored = scored.withColumn("__raw", raw).withColumn(
            "chunk_label", sentiment.normalise_by_language("__raw", "score", "language",
                                                           threshold=threshold))
        counted = sentiment.count_labels(scored, ["track_id", "language"], "chunk_label")
        return sentiment.vote(counted).select("track_id", "language", "mood")
    routed = sentiment.route_by_language(texts, "language", routes)
    chunks = sentiment.explode_chunks(routed, "lyrics", size=size)
    scored = sentiment.score_chunks_lexicon(chunks)
    label = (F.when(F.col("route") == "stars", normalise_label("stars", rule="stars"))
             .when(F.col("route") == "binary_threshold",
                   normalise_label("label", "score", "binary_threshold", threshold=threshold)))
    counted = sentiment.count_labels(scored.withColumn("chunk_label", label),
                                     ["track_id", "language"], "chunk_label")
    return sentiment.vote(counted).select("track_id", "language", "mood")


def start_mood_stream(spark: SparkSession, source: str, sink: str,
                      routes: Mapping[str, str] | None = None, *,
                      checkpoint: str | None = None, fmt: str = "json", available_now: bool = True,
                      max_files_per_trigger: int | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Start the incremental job; ``available_now`` processes what is there
    and stops (batch-style scheduling with exactly-once bookkeeping)."""
    reader = spark.readStream.schema(TEXT_LANGUAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source)

    def publish(batch: DataFrame, batch_id: int) -> None:
        merge_by_key(moods_batch(batch, routes), sink, "track_id", buckets=buckets)

    recover(spark, sink)
    w = (stream.writeStream.foreachBatch(publish)
         .option("checkpointLocation", checkpoint or f"{sink.rstrip('/')}-checkpoint"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
