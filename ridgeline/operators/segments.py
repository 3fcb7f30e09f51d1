"""The text of a key as numbered segments of bounded length.

``enrich.assemble_text`` gives one value per key, which one task must hold. Here
the same text is cut every ``size`` characters, so that a key of any size is many
rows in many tasks:

1. Parts are range-partitioned by key and order and sorted within partitions; a key
   of many parts spans several partitions. Each task adds up the lengths of a key's
   parts as they pass (separators included).
2. Only the first key of a partition can have begun before it. One row per partition
   (first and last key, their lengths) gives what to add to it: the only step that
   sees all partitions, of the size of their number.
3. A part knows its place in the text now. It is cut where segments end, and pieces
   meet by key and segment: at most ``size`` characters a group, whatever the key.

The segments of a key, joined, are exactly what ``assemble_text`` gives: parts in
``order``, null texts left out, one separator between parts (also around empty
ones). A key without a text has no row. Null keys are one key. Parts that are equal
in key and order take any order, as there. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.session import materialize


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, length) in order, with the partition, the number of the key's run
    within it, and the characters of the key before each part here."""
    part, run, before, last, begun = TaskContext.get().partitionId(), -1, 0, None, False
    for b in batches:
        if not b.num_rows:
            continue
        key, length = b.column(0), b.column(2).to_numpy().astype(np.int64)
        # a new run where the key differs from the row before; null equals null
        codes = pc.fill_null(pa.array(key).dictionary_encode().indices, -1).to_numpy()
        new = np.concatenate([[not begun or key[0].as_py() != last], codes[1:] != codes[:-1]])
        total = np.concatenate([[0], np.cumsum(length)])
        starts = np.flatnonzero(new)
        runs = run + np.cumsum(new)
        # characters within the batch before the row, less those before its run
        begin = np.concatenate([[0], total[starts]]) if not new[0] else total[starts]
        of_row = np.cumsum(new) - (0 if not new[0] else 1)
        at = total[:-1] - begin[of_row] + np.where(of_row == 0, 0 if new[0] else before, 0)
        before, last, run, begun = int(at[-1] + length[-1]), key[len(key) - 1].as_py(), int(runs[-1]), True
        yield pa.RecordBatch.from_arrays(
            [key, b.column(1), b.column(2), pa.array(np.full(b.num_rows, part, np.int32)), pa.array(runs), pa.array(at)],
            names=["key", "text", "length", "part", "run", "place"])


def _carried(ends: list) -> list[tuple[int, int]]:
    """(partition, characters of its first key in earlier partitions)."""
    out, key, held, begun = [], None, 0, False
    for e in ends:
        carry = held if begun and e["first"] == key else 0
        out.append((e["part"], carry))
        held = e["tail"] + (carry if e["runs"] == 0 else 0)
        key, begun = e["last"], True
    return out


def assemble_segments(df: DataFrame, key: str, text: str, order: Sequence[str], *, size: int, sep: str = " ",
                      exclude: tuple[str, Sequence[str]] | None = None, out: str | None = None,
                      partitions: int | None = None) -> DataFrame:
    """Rows key, segment (from 0), and the text's characters [segment * size, (segment + 1) * size).
    ``exclude=(col, values)`` drops a category first, and null categories, as ``assemble_text``."""
    if size < 1:
        raise ValueError("size must be positive")
    spark = df.sparkSession
    if exclude is not None:
        df = df.filter(~F.col(exclude[0]).isin(list(exclude[1])))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(key).asc_nulls_first(), *[F.col(o).asc_nulls_last() for o in order]]
    # every part brings the separator before it; the key's first part gives it back below
    rows = (df.where(F.col(text).isNotNull()).repartitionByRange(n, *by).sortWithinPartitions(*by)
            .select(F.col(key).alias("key"), F.col(text).alias("text"),
                    (F.char_length(text) + len(sep)).cast("long").alias("length")))
    kind = rows.schema["key"].dataType.simpleString()
    placed = materialize(rows.mapInArrow(
        _places, f"key {kind}, text string, length long, part int, run long, place long"), as_table=True)
    ends = (placed.groupBy("part").agg(
        F.min_by("key", F.struct("run", "place")).alias("first"), F.max_by("key", F.struct("run", "place")).alias("last"),
        F.max(F.struct("run", (F.col("place") + F.col("length")).alias("end"))).alias("top")).orderBy("part")
        .select("part", "first", "last", F.col("top.run").alias("runs"), F.col("top.end").alias("tail")).collect())
    if not ends:
        return placed.select(F.col("key").alias(key), F.lit(0).cast("long").alias("segment"), F.col("text").alias(out or text))
    carried = spark.createDataFrame(_carried(ends), "part int, carry long")
    at = F.col("place") + F.when(F.col("run") == 0, F.col("carry")).otherwise(0)
    whole = placed.join(carried, "part").withColumn("at", at)
    # the first part has no separator, so all others begin len(sep) earlier than counted
    first = F.col("at") == 0
    piece = whole.select("key", F.when(first, F.col("text")).otherwise(F.concat(F.lit(sep), "text")).alias("text"),
                         F.when(first, 0).otherwise(F.col("at") - len(sep)).alias("begin"),
                         (F.col("length") - F.when(first, len(sep)).otherwise(0)).alias("n"))
    last = F.floor((F.col("begin") + F.greatest(F.col("n"), F.lit(1)) - 1) / size)
    cut = piece.select("key", "text", "begin", F.explode(F.sequence(F.floor(F.col("begin") / size), last)).alias("segment"))
    start = F.greatest(F.col("segment") * size - F.col("begin"), F.lit(0))
    stop = (F.col("segment") + 1) * size - F.col("begin")
    pieces = cut.select("key", "segment", "begin", F.substring("text", start.cast("int") + 1, (stop - start).cast("int")).alias("t"))
    joined = pieces.groupBy("key", "segment").agg(F.expr("listagg(t, '') WITHIN GROUP (ORDER BY begin)").alias("t"))
    return joined.select(F.col("key").alias(key), "segment", F.col("t").alias(out or text))
