"""Names of one source that another does not know, and what they may mean.

Each unmatched name is compared with the known names that share a deletion of it: two
names at an edit distance of d or less become equal after at most d deletions from each.
Deletions of both sides are joined, and candidates verified by their edit distance, so
the work follows the names' own neighbourhoods, not the product of the sources. A name of
n code points has about n^d / d! deletions; names are short.

The nearest known name wins (ties: the first in order); none within ``distance`` gives
nulls. Null names have no proposal and stay in the report. Repeated names are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _shorter(words: Column) -> Column:
    """Each string of an array without one of its code points, and the strings themselves."""
    def cut(w: Column) -> Column:
        n = F.char_length(w)
        places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.concat(F.array(w), F.transform(places, lambda i: F.concat(
            F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, n))))

    return F.array_distinct(F.flatten(F.transform(words, cut)))


def deletions(name: Column, distance: int) -> Column:
    """All results of up to ``distance`` deletions from a name."""
    out = F.array(name)
    for _ in range(distance):
        out = _shorter(out)
    return out


def nearest_names(unknown: DataFrame, known: DataFrame, name: str, *, distance: int = 2) -> DataFrame:
    """Rows name, proposal, distance for every distinct name of ``unknown``."""
    left = unknown.select(F.col(name).alias("name")).distinct()
    right = known.select(F.col(name).alias("proposal")).distinct()
    a = left.select("name", F.explode(deletions(F.col("name"), distance)).alias("rest"))
    b = right.select("proposal", F.explode(deletions(F.col("proposal"), distance)).alias("rest"))
    pairs = a.join(b, "rest").select("name", "proposal").distinct()
    near = pairs.withColumn("distance", F.levenshtein("name", "proposal")).where(F.col("distance") <= distance)
    best = near.groupBy("name").agg(F.min(F.struct("distance", "proposal")).alias("best"))
    return left.join(best, "name", "left").select("name", "best.proposal", "best.distance")


def reconcile(df: DataFrame, other: DataFrame, name: str, *, distance: int = 2) -> DataFrame:
    """The names of ``other`` that ``df`` lacks, each with the nearest name of ``df``."""
    lost = other.select(name).distinct().join(df.select(name).distinct(), name, "left_anti")
    return nearest_names(lost, df, name, distance=distance)
