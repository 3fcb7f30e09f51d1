"""Label distributions per entity and period, subsets, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_distribution(df: DataFrame, keys: Sequence[str], out: str = "track_count") -> DataFrame:
    """Rows per (entity, period, label)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def subset(df: DataFrame, col: str, value) -> DataFrame:
    """Rows of one entity."""
    return df.filter(F.col(col) == value)


def exclude(df: DataFrame, col: str, value) -> DataFrame:
    """Rows without one label (``!=`` also drops NULL)."""
    return df.filter(F.col(col) != value)


def log_weights(df: DataFrame, entity: str, label: str, count: str, *, mode: str = "sum",
                period: str = "year", out: str = "weight") -> DataFrame:
    """``log1p`` weight per (entity, label).

    ``mode="sum"`` adds the counts of all periods; ``"latest"`` keeps the
    count of the latest period only (what a dict built from period-sorted
    rows ends up holding)."""
    if mode == "sum":
        total = F.sum(count)
    elif mode == "latest":
        total = F.max_by(F.col(count), F.col(period))
    else:
        raise ValueError(mode)
    return df.groupBy(entity, label).agg(F.log1p(total).alias(out))
