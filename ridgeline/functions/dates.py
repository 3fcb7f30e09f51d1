"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(df: DataFrame, col: str, fmt: str = "yyyy/MM/dd") -> Column:
    """Column ``col`` as DATE.

    Text is parsed with ``fmt``; unparsable text becomes NULL (``try_to_date``)
    instead of failing the job under ANSI mode. Timestamps are truncated.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        return F.try_to_date(F.col(col), fmt)
    if isinstance(dtype, T.DateType):
        return F.col(col)
    return F.to_date(F.col(col))


def clean_year(col: Column | str) -> Column:
    """Year text with footnote marks (``2019*``) as INT; junk becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"[*]", "").try_cast("int")
