"""Readers for the star-schema Parquet tables (one Parquet dataset per table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str,
          columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of ``{sf_dir}/{name}.parquet``. Selecting ``columns``
    here makes the pruned ``ReadSchema`` explicit; filters applied later are
    still pushed into the scan by Catalyst."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
