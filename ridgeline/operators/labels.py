"""Value remapping, pattern tagging, residual label, flag counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remap_values(df: DataFrame, col: str, mapping: Mapping[str, str] | DataFrame, *,
                 from_col: str = "raw", to_col: str = "mapped") -> DataFrame:
    """B1: replace values of ``col`` through ``mapping``; unlisted values are
    kept. Exact, case-sensitive, single pass (a replaced value is not
    replaced again).

    A dict becomes one CASE expression (no join). A mapping table (one row
    per raw value) is joined with a left equi-join on the raw value;
    Catalyst/AQE broadcast it only when its measured size is below the
    broadcast threshold.
    """
    if isinstance(mapping, DataFrame):
        m = mapping.select(F.col(from_col).alias("__raw"), F.col(to_col).alias("__mapped"))
        out = df.join(m, df[col] == m["__raw"], "left")
        return out.withColumn(col, F.coalesce(F.col("__mapped"), F.col(col))).drop("__raw", "__mapped")
    if not mapping:
        return df
    expr = None
    c = F.col(col)
    for raw, new in mapping.items():
        expr = F.when(c == raw, F.lit(new)) if expr is None else expr.when(c == raw, F.lit(new))
    return df.withColumn(col, expr.otherwise(c))


def count_by(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    """B2: rows per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def drop_unlabelled(df: DataFrame, list_col: str, required: Sequence[str] = ()) -> DataFrame:
    """Drop rows whose list literal is ``[]`` or NULL, and rows with a
    NULL in any ``required`` column."""
    out = df.filter(F.col(list_col) != "[]")
    return out.dropna(subset=list(required)) if required else out


def tag_by_pattern(df: DataFrame, col: str, patterns: Mapping[str, str]) -> DataFrame:
    """One boolean column per label, true when ``col`` matches the
    label's regular expression anywhere (partial, case-sensitive). NULL text
    gives false. All labels are added in one projection."""
    c = F.col(col)
    tags = [F.coalesce(c.rlike(p), F.lit(False)).alias(label) for label, p in patterns.items()]
    keep = [F.col(x) for x in df.columns if x not in patterns]
    return df.select(*keep, *tags)


def residual_flag(flags: Sequence[str]) -> Column:
    """True when none of ``flags`` is true; a NULL flag makes it false."""
    any_true = reduce(lambda a, b: a | b, [F.col(f) for f in flags])
    return F.coalesce(~any_true, F.lit(False))


def residual_label(df: DataFrame, flags: Sequence[str], name: str = "other") -> DataFrame:
    """Add ``name`` = no listed flag is true."""
    return df.withColumn(name, residual_flag(flags))


def count_flags(df: DataFrame, keys: Sequence[str], flags: Sequence[str], *,
                total: str | None = None) -> DataFrame:
    """Per key, how many rows have each flag true (NULL flags ignored),
    all in one aggregate; optionally the row count as ``total``."""
    aggs = [F.count_if(F.col(f)).alias(f) for f in flags]
    if total:
        aggs.append(F.count(F.lit(1)).alias(total))
    return df.groupBy(*keys).agg(*aggs)


def complement_count(total: str | int, flag_count: str) -> Column:
    """Rows without the flag = group size - flag count. ``total`` may be
    a column (the real group size) or a fixed number."""
    t = F.lit(total) if isinstance(total, int) else F.col(total)
    return t - F.col(flag_count)
