"""Session construction and cluster-shared settings."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splits a hot key's partition.
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def cluster_conf(input_tb: float, *, executors: int = 1000, cores_per_executor: int = 4,
                 target_partition_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    Start with enough shuffle partitions that a partition of the largest
    shuffle (the line items, shuffled once by order key) is about
    ``target_partition_mb``; AQE coalesces small ones at runtime and splits
    skewed ones (a key holding a large share of the rows) in joins.
    Scan splits stay at 256 MB so a task's input fits comfortably in memory.
    """
    slots = executors * cores_per_executor
    parts = max(slots * 2, int(input_tb * 1024 * 1024 / target_partition_mb))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{target_partition_mb * 4}m",
        "spark.sql.files.maxPartitionBytes": "256m",
        # dimension broadcasts are decided on measured sizes; keep the bound explicit
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ridgeline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster pass ``master=None`` so spark-submit decides; locally pass
    ``local[N]`` and a shuffle partition count near the core count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only on a ``local*`` master with nothing
    configured (tests) a fresh scratch folder is made, so that reliable
    ``DataFrame.checkpoint()`` works; any other master needs the setting,
    because its executors cannot see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             f"executors share (master is {sc.master})")
        d = tempfile.mkdtemp(prefix="ridgeline-ckpt-")
    if sc.getCheckpointDir() is None:
        if d.startswith("/"):
            os.makedirs(d, exist_ok=True)
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per context, unless their
    path (``PYTHONPATH``) already has it."""
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root in map(os.path.abspath, filter(None, on_path)) or getattr(sc, "_ridgeline_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="ridgeline-code-"), "ridgeline")
    sc.addPyFile(shutil.make_archive(target, "zip", root, os.path.basename(package)))
    sc._ridgeline_shipped = True


def is_local(master: str) -> bool:
    """True for ``local`` and ``local[...]``: one process, one machine."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ridgeline-tables/{name}-{uuid.uuid4().hex}"


#: Parquet options for rows with whole texts. A reader unpacks up to 4096 rows of a row group
#: at a time, in arrays that grow by doubling: with small groups and pages they stay small.
TEXT_LAYOUT = {"parquet.block.size": 2 << 20, "parquet.page.size": 128 << 10,
               "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1,
               "parquet.page.size.row.check.max": 10000, "parquet.dictionary.page.size": 1 << 20}


def small_batches(spark: SparkSession) -> None:
    """Parquet readers of this session unpack 512 rows at a time, unless it is set otherwise: a
    reader's arrays hold a whole batch, and 4096 whole texts are more than 10 MB a task."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "512")


def materialize(df, *, as_table: bool = False, texts: bool = False):
    """Compute ``df`` once and cut its lineage, for intermediate results that
    several branches of a plan read, so the expensive input is not scanned
    once per branch. Both forms survive executor loss.

    By default a reliable ``checkpoint()`` in the shared checkpoint folder.
    ``as_table`` writes a Parquet table under that folder and reads it back
    instead: the optimizer then knows its real size, so joins with it are
    planned from Spark's own size check (worth it for larger intermediates;
    for the small ones here the checkpoint is cheaper). ``texts``: the table
    has TEXT_LAYOUT."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    if not as_table:
        return df.checkpoint(eager=True)
    path = scratch_path(spark, "table")
    df.write.mode("overwrite").options(**(TEXT_LAYOUT if texts else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
