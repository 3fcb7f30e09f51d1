"""Dense global row index and fixed-size batches without a single
partition.

A window without PARTITION BY moves every row into one task. Instead:

1. range-partition by the order keys and sort inside each partition;
2. tag rows with ``monotonically_increasing_id`` (partition id in the upper
   bits, position inside the partition in the lower 33 bits);
3. checkpoint to the shared checkpoint folder, so a lost executor cannot
   recompute a different partitioning and shift the ids;
4. count rows per partition (one row per partition), turn the counts into
   offsets with a running sum over those few rows, and broadcast them -- their
   size is bounded by the partition count, not by the data;
5. index = offset of the partition + position + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.session import checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def dense_index(df: DataFrame, order: Sequence[Column | str], *, index: str = "row_index",
                partitions: int | None = None) -> DataFrame:
    """Add ``index`` = 1..N following ``order``. Make the order total (end
    with a unique column): the result is then deterministic, and range
    partitioning can split even a value shared by a third of the rows
    across partitions instead of sending it to one task."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    staged = (
        df.repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("__mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    pid = F.shiftright(F.col("__mid"), 33)
    counts = staged.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    out = staged.join(F.broadcast(offsets), pid == F.col("__pid"))
    pos = F.col("__mid").bitwiseAND(F.lit(_LOW_BITS))
    return out.withColumn(index, F.col("__off") + pos + 1).drop("__mid", "__pid", "__off")


def assign_batches(df: DataFrame, size: int, order: Sequence[Column | str], *,
                   index: str = "row_index", batch: str = "batch_id",
                   partitions: int | None = None) -> DataFrame:
    """Dense index plus ``batch = (index - 1) div size`` (INT)."""
    out = dense_index(df, order, index=index, partitions=partitions)
    return out.withColumn(batch, F.expr(f"(`{index}` - 1) div {int(size)}").cast("int"))
