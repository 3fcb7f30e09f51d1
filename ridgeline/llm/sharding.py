"""Sharding by longest-processing-time scheduling.

Groups that must stay together (equal texts) go, largest first, to the
least-loaded shard through a heap. Groups of at least a set share of all bytes
are items of their own; the countless small ones are dealt by hash into chunks
within size classes, and a chunk is an item. Their number is bounded by
parameters (shards x pieces and size classes), so the heap runs over a few
thousand items whatever the input; no group is looked at by two shards.

Null text counts as empty (no bytes); empty texts are equal to each other.
Repeated rows are equal texts and share a shard, each with a slot of its own.
An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import stored

ROW_BYTES = 16           # per row, beside its text
PIECES = 32              # chunks a shard gets of the bulk of the bytes
CLASSES_PER_DOUBLING = 2
SLOT_ROWS = 100_000      # most rows, about, that one window numbers


def lpt(sizes: Sequence[int], shards: int) -> list[int]:
    """Shard of each item: descending size, each to the least-loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, s = heap[0]
        heapq.heapreplace(heap, (load + sizes[i], s))
        out[i] = s
    return out


def chunk_counts(class_bytes: dict[int, int], shards: int) -> dict[int, int]:
    """Chunks of each size class. The larger documents hold the bulk and get chunks of
    1 / PIECES of a shard; the smallest tenth and hundredth of the bytes, which the heap
    deals last, get chunks 10 and 100 times finer and level the shards."""
    total, below, out = max(1, sum(class_bytes.values())), 0, {}
    for c in sorted(class_bytes):
        below += class_bytes[c]
        finer = 100 if below * 100 <= total else 10 if below * 10 <= total else 1
        out[c] = max(1, math.ceil(class_bytes[c] * shards * PIECES * finer / total))
    return out


def assign_shards(docs: DataFrame, shards: int = 40, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns key, size, text_crc32, shard, slot (0.. in each shard)."""
    spark = docs.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(
        F.col(key).alias("key"), F.octet_length(value).cast("long").alias("bytes"),
        F.crc32(F.encode(value, "UTF-8")).alias("crc"), F.md5(value).alias("same")))
    rows = (rows.withColumn("size", F.col("bytes") + ROW_BYTES)
            .withColumn("class", F.floor(F.log2("size") * CLASSES_PER_DOUBLING).cast("int")))

    class_bytes = {r["class"]: r["b"] for r in rows.groupBy("class").agg(F.sum("size").alias("b")).collect()}
    counts = chunk_counts(class_bytes, shards)
    large = max(1, sum(class_bytes.values()) // (shards * PIECES))
    # at most shards * PIECES groups can hold that many bytes
    big = (rows.groupBy("same").agg(F.sum("size").alias("b")).where(F.col("b") >= large)
           .orderBy("same").collect())
    chunks = spark.createDataFrame(sorted(counts.items()), "class int, n_chunks int")
    alone = spark.createDataFrame([(r["same"], i) for i, r in enumerate(big)], "same string, big int")
    dealt = (rows.join(F.broadcast(chunks), "class").join(F.broadcast(alone), "same", "left")
             .withColumn("chunk", F.when(F.col("big").isNull(),
                                         F.pmod(F.xxhash64("same"), F.col("n_chunks")).cast("int")))
             .withColumn("class", F.when(F.col("big").isNull(), F.col("class"))))
    items = dealt.groupBy("class", "chunk", "big").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    items.sort(key=lambda r: (r["big"] is None, r["big"] or 0, r["class"] or 0, r["chunk"] or 0))
    to = lpt([r["b"] for r in items], shards)
    plan = spark.createDataFrame(
        [(-1 if r["class"] is None else r["class"], r["chunk"] if r["big"] is None else r["big"], s)
         for r, s in zip(items, to, strict=True)], "item_class int, item int, shard int")
    placed = (dealt.withColumns({"item_class": F.coalesce("class", F.lit(-1)),
                                 "item": F.coalesce("chunk", "big")})
              .join(F.broadcast(plan), ["item_class", "item"])
              .select("key", "size", "crc", "shard"))
    spread = max(16, math.ceil(sum(r["n"] for r in items) / (shards * SLOT_ROWS)))
    return _slots(placed, spread).select(F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"),
                                         "shard", "slot")


def _slots(placed: DataFrame, spread: int) -> DataFrame:
    """Gapless numbers within each shard: rows are numbered within ``spread`` parts of
    the shard, and each part starts where the parts before it end."""
    parts = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(spread)).cast("int"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (parts.groupBy("shard", "part").count()
              .withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0)))
              .select("shard", "part", "start"))
    own = Window.partitionBy("shard", "part").orderBy("key", "crc", "size")
    return (parts.withColumn("at", F.row_number().over(own) - 1)
            .join(F.broadcast(starts), ["shard", "part"])      # shards x spread rows
            .withColumn("slot", F.col("start") + F.col("at")))
