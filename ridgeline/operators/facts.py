"""Entity-year fact tables from several indicator sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.dates import clean_year


def clean_years(df: DataFrame, lo: int, hi: int, *, col: str = "year_string",
                out: str = "year") -> DataFrame:
    """Strip footnote marks, cast to INT (junk -> NULL), keep [lo, hi]."""
    return df.withColumn(out, clean_year(col)).filter(F.col(out).between(lo, hi)).drop(col)


def join_indicators(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of indicator frames on ``keys``; an entity-year missing
    from any source disappears."""
    return reduce(lambda a, b: a.join(b, list(keys), "inner"), frames)


def attach_global_series(df: DataFrame, series: DataFrame, on: str = "year") -> DataFrame:
    """C4: inner join with a per-period series (one row per period)."""
    return df.join(series, on, "inner")


def restrict_to_known(df: DataFrame, known: DataFrame, key: str, *,
                      period: str | None = None, lo: int | None = None,
                      hi: int | None = None) -> DataFrame:
    """Rows whose ``key`` occurs in ``known`` (left semi join), optionally
    within [lo, hi] on ``period``. Scales to any number of keys."""
    out = df
    if period is not None:
        out = out.filter(F.col(period).between(lo, hi))
    return out.join(known.select(key).distinct(), key, "left_semi")


def merge_outcome(df: DataFrame, outcome: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join with the outcome measure on ``keys``."""
    return df.join(outcome, list(keys), "inner")


def unmatched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C6 report: rows of ``df`` whose keys have no partner in ``other``."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def membership_flag(df: DataFrame, col: str, members: Sequence | DataFrame,
                    out: str) -> DataFrame:
    """Boolean ``out`` = ``col`` is a member; never NULL.

    ``members`` is a list (``isin``) or a one-column DataFrame of member keys
    (left join against its distinct keys)."""
    if isinstance(members, DataFrame):
        m = members.select(F.col(members.columns[0]).alias(col)).distinct() \
            .withColumn(out, F.lit(True))
        return df.join(m, col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))
    return df.withColumn(out, F.when(F.col(col).isin(list(members)), True).otherwise(False))


def exact_mean(col: str | Column, scale: int = 2, factor: int = 1) -> Column:
    """Mean of a fixed-point measure, summed exactly as DECIMAL and divided
    last, so the result does not depend on the summation order."""
    c = F.col(col) if isinstance(col, str) else col
    s = F.sum(c.cast(f"decimal(18,{scale})"))
    if factor != 1:
        s = s * F.lit(factor)
    return s.cast("double") / F.count(c)


def display_name(code: Column | str) -> Column:
    """'NATION_7' -> 'Nation 7' (first letter upper, rest lower, '_' -> ' ')."""
    c = F.col(code) if isinstance(code, str) else code
    return F.replace(F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20))),
                     F.lit("_"), F.lit(" "))
