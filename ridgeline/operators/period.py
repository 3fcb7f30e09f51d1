"""A2-A4: calendar window, per-period totals, appearance threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.dates import as_date


def in_period(df: DataFrame, date_col: str, start: str, end: str, *,
              member_col: str | None = None, members: Sequence[str] | DataFrame | None = None,
              fmt: str = "yyyy/MM/dd") -> DataFrame:
    """Keep rows whose date lies in the closed range [start, end]; add
    ``year`` and ISO ``week``.

    ``date_col`` may be text in ``fmt`` (bad text -> NULL -> dropped), a DATE
    or a TIMESTAMP; it is replaced by a DATE column. ``members`` restricts
    ``member_col`` to a list (``isin``) or to the keys of a DataFrame (left
    semi join, which scales to any member count).
    """
    d = as_date(df, date_col, fmt)
    out = (
        df.withColumn(date_col, d)
        .filter(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .withColumn("year", F.year(date_col))
        .withColumn("week", F.weekofyear(date_col))
    )
    if members is not None and member_col is not None:
        if isinstance(members, DataFrame):
            keys = members.select(F.col(members.columns[0]).alias(member_col)).distinct()
            out = out.join(keys, member_col, "left_semi")
        else:
            out = out.filter(F.col(member_col).isin(list(members)))
    return out


def period_totals(df: DataFrame, keys: Sequence[str], measure: str, *,
                  period_col: str = "week", total: str = "total_streams",
                  count: str = "weeks_on_chart", mean: str = "average_streams") -> DataFrame:
    """Sum of ``measure``, number of non-NULL periods, and their quotient.

    A NULL measure is ignored by the sum but its period still counts. Every
    key is a grouping key, so a changed attribute splits an item in two.
    Partial (map-side) aggregation keeps the shuffle to one row per key and
    map task.
    """
    return (
        df.groupBy(*keys)
        .agg(F.sum(measure).alias(total), F.count(period_col).alias(count))
        .withColumn(mean, F.col(total) / F.col(count))
    )


def min_appearances(df: DataFrame, n: int, count: str = "weeks_on_chart") -> DataFrame:
    """HAVING count >= n (inclusive)."""
    return df.filter(F.col(count) >= n)
