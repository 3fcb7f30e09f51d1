"""Long <-> wide reshaping.

Pivots always take the value list explicitly: without it Spark runs an
extra distinct job to discover the columns, and the output schema would
depend on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_AGGS = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "first": F.first}


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str,
            val: str) -> DataFrame:
    """Unpivot ``values`` into (var, val) rows; zeros are kept as rows."""
    return df.unpivot(list(ids), list(values), var, val)


def to_wide(df: DataFrame, ids: Sequence[str], label: str, value: str,
            values: Sequence, *, agg: str = "sum", fill=None) -> DataFrame:
    """pivot ``label`` into one column per listed value.

    Absent cells are NULL unless ``fill`` is given. One shuffle on ``ids``.
    """
    out = df.groupBy(*ids).pivot(label, list(values)).agg(_AGGS[agg](value))
    return out.fillna(fill, subset=[str(v) for v in values]) if fill is not None else out


def heatmap_matrix(df: DataFrame, row: str, col: str, value: str, col_values: Sequence, *,
                   agg: str = "avg", fill=0, total: str = "row_total",
                   order: str | None = None) -> DataFrame:
    """Matrix row x col of ``agg(value)``, NULL filled, with the row
    total. Sort by the total with ``orderBy`` (a distributed range sort);
    ``order`` optionally adds the row's position in that order.

    ``agg="avg"`` reproduces a mean-aggregating pivot table: if two source
    codes map to one display name the cell is their mean; ``"sum"`` adds
    them. The ordering window runs over the matrix rows only (one row per
    distinct ``row`` value), never over the input rows.
    """
    names = [str(v) for v in col_values]
    m = to_wide(df, [row], col, value, col_values, agg=agg, fill=fill)
    m = m.withColumn(total, sum((F.col(f"`{n}`") for n in names), F.lit(0)))
    if order:
        from pyspark.sql import Window

        m = m.withColumn(order, F.row_number().over(
            Window.orderBy(F.col(total).desc(), F.col(row).asc())))
    return m


def label_counts_wide(df: DataFrame, group: Sequence[str], label: str,
                      values: Sequence[str], count_col: str | None = None) -> DataFrame:
    """H4: per group, rows per label value as columns (closed list).
    An absent label gives NULL, not 0."""
    counted = df.groupBy(*group, label).agg(
        (F.count(count_col) if count_col else F.count(F.lit(1))).alias("__n"))
    return counted.groupBy(*group).pivot(label, list(values)).agg(F.sum("__n"))


def series_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], *,
                var: str = "series", val: str = "value") -> DataFrame:
    """(ids, series, value) table for drawing lines or stacked bars.
    All value columns are cast to DOUBLE so they share one column."""
    casted = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return to_long(casted, ids, values, var, val)
