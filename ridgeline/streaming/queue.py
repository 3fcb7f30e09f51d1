"""Work-queue enrichment as a stream: batches of items without a text (the
output of ``batching.assign_batches`` written as CSV partitioned by
``batch_id``) are picked up as they arrive and attached to a text table with
a stream-static left join (D9: a NULL text/language pair when nothing is
found). Each micro-batch is written under its own (batch_id, epoch)
partitions with dynamic overwrite, so a replayed micro-batch replaces
exactly its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ridgeline.operators import enrich
from ridgeline.sources.io import publish_partitioned

QUEUE_SCHEMA = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("new_artist", T.StringType()),
    T.StructField("row_index", T.LongType()),
    T.StructField("batch_id", T.IntegerType()),
])


def enrich_queue(queue: DataFrame, texts: DataFrame) -> DataFrame:
    """(track_id, lyrics, language, batch_id) for queue items; texts keyed by
    track_id (one row per id)."""
    out = enrich.enrich_status(queue, texts, "track_id", "track_id",
                               required=["name", "new_artist"])
    return out.select("track_id", "lyrics", "language", "batch_id")


def start_queue_stream(spark: SparkSession, queue_dir: str, texts: DataFrame, sink: str, *,
                       checkpoint: str | None = None, available_now: bool = True,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = (spark.readStream.schema(QUEUE_SCHEMA).option("header", "true")
              .option("basePath", queue_dir))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(queue_dir)

    def publish(batch: DataFrame, epoch: int) -> None:
        # A queue batch can span several files and so several micro-batches:
        # (batch_id, epoch) partitions keep every micro-batch's rows apart,
        # and a replayed micro-batch replaces only its own.
        out = enrich_queue(batch, texts).withColumn("epoch", F.lit(epoch))
        publish_partitioned(out, sink, ["batch_id", "epoch"], replace_only=True)

    w = (stream.writeStream.foreachBatch(publish)
         .option("checkpointLocation", checkpoint or f"{sink.rstrip('/')}-checkpoint"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
