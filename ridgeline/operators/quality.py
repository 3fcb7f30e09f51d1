"""Chart quality report as DataFrames (no ``show``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_group(df: DataFrame, group: Sequence[str], out: str = "n_rows") -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(out))


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Keys that occur more than once."""
    return rows_per_group(df, keys, out).filter(F.col(out) > 1)


def rows_behind_duplicates(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Every row whose key is duplicated, with the key's row count.

    The duplicate-key frame is itself an aggregate of ``df``; joining it back
    shuffles both sides on the key (no broadcast: its size grows with the
    data)."""
    return df.join(duplicate_keys(df, keys, out), list(keys), "inner")
