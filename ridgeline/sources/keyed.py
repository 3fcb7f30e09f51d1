"""A sink that holds one row per key, whatever is sent to it how often.

Rows live in hash buckets of their key (folders ``bucket=n``). A batch is merged by
key: of the buckets that it touches, rows of other keys are kept, rows of its keys are
replaced, and only these buckets are written. Sending a batch again, in part or after
later ones of the same content, changes nothing, so a lost checkpoint or a replay needs
no bookkeeping of batches.

The merged buckets are first written whole to a folder beside the sink and then put in
place by a dynamic partition overwrite. If a driver is lost between the two steps, or
within the second, ``recover`` puts the folder in place again: nothing is lost, because
it holds all rows of the buckets it names. One writer at a time, as in a stream.

A batch with several rows of a key keeps the one that is greatest by ``latest`` (columns;
by default all others, so the choice does not depend on order). Null keys are one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def staging_path(path: str) -> str:
    return f"{path.rstrip('/')}-merging"


def _exists(spark: SparkSession, path: str) -> bool:
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name))


def _put(staged: DataFrame, path: str) -> None:
    (staged.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def recover(spark: SparkSession, path: str) -> None:
    """Finish a merge that a lost driver left half done; harmless after a whole one."""
    if _exists(spark, f"{staging_path(path)}/_SUCCESS"):      # written whole
        _put(spark.read.parquet(staging_path(path)), path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """All rows, one per key."""
    return spark.read.parquet(path).drop("bucket")


def merge_by_key(batch: DataFrame, path: str, key: str, *, latest: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Merge ``batch`` into the sink at ``path``. The number of buckets is the sink's for good."""
    spark = batch.sparkSession
    rest = [c for c in batch.columns if c != key]
    rank = F.struct(*(latest or rest)) if (latest or rest) else F.lit(1)
    row = F.struct(*rest) if rest else F.lit(1)
    # no two rows of a key leave this step, and a hot key is one row per task before it
    new = batch.groupBy(key).agg(F.max_by(row, rank).alias("row"))
    new = new.select(key, *([f"row.`{c}`" for c in rest]), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"))
    if _exists(spark, path):
        # at most ``buckets`` numbers
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
        if not touched:
            return
        old = spark.read.schema(new.schema).parquet(path).where(F.col("bucket").isin(touched))
        sent = new.select(F.col(key).alias("__k"))
        kept = old.join(sent, old[key].eqNullSafe(sent["__k"]), "left_anti")
        new = kept.select(*new.columns).unionByName(new)
    new.repartition("bucket").write.mode("overwrite").parquet(staging_path(path))
    _put(spark.read.schema(new.schema).parquet(staging_path(path)), path)
