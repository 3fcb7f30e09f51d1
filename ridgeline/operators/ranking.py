"""Group top-k family: A5 A6 B3 H3 F1 F2 F3.

One core, ``rank_within``: a window partitioned by the group and ordered by
the ranking keys, followed by a filter on the rank. Catalyst turns
``rank/row_number <= k`` into a partial ``WindowGroupLimit`` before the
shuffle and a final one after it, so a hot group ships at most k rows (plus
ties) per map task instead of all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {"keep": F.rank, "one": F.row_number, "dense": F.dense_rank}


def _order(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in cols]


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                k: int, *, ties: str = "keep", rank_col: str | None = "rank") -> DataFrame:
    """Rows whose rank inside ``group`` is <= k.

    ``ties="keep"`` uses ``rank`` (gaps after ties; a group may exceed k),
    ``"one"`` uses ``row_number`` (exactly min(k, group size) rows; make the
    order total for determinism), ``"dense"`` uses ``dense_rank``.
    """
    w = Window.partitionBy(*group).orderBy(*_order(order))
    name = rank_col or "__rank"
    out = df.withColumn(name, _RANKERS[ties]().over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def keep_best(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], *,
              ties: str = "keep") -> DataFrame:
    """A5: one row per logical item (the best by ``order``). With
    ``ties="keep"`` rows equal on every order key all survive."""
    return rank_within(df, group, order, 1, ties=ties, rank_col=None)


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, *,
          ties: str = "keep", rank_col: str = "rank") -> DataFrame:
    """Top k per group, ties kept by default."""
    return rank_within(df, group, order, k, ties=ties, rank_col=rank_col)


def first_n_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                 n: int) -> DataFrame:
    """Exactly the first n rows per group (fewer if the group is smaller).
    Pass a tie-break column last in ``order`` for a deterministic result."""
    return rank_within(df, group, order, n, ties="one", rank_col=None)


def sample_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                       n: int) -> DataFrame:
    """H3: stable equal-size sample: first n rows per group by ``order``."""
    return first_n_rows(df, group, order, n)


def argmax_by(df: DataFrame, group: Sequence[str], label: str, value: str,
              out: str = "most_popular") -> DataFrame:
    """label with the largest value per group; ties go to the largest
    label so the result is deterministic (``max_by`` over a struct key).
    A plain aggregate: partial aggregation keeps one candidate per group and
    map task."""
    key = F.struct(F.col(value), F.col(label))
    return df.groupBy(*group).agg(F.max_by(F.col(label), key).alias(out))


def winner_frequency(df: DataFrame, label: str, period: str, out: str = "n_groups") -> DataFrame:
    """how many groups share each winning label per period."""
    return df.groupBy(label, period).agg(F.count(F.lit(1)).alias(out))


def top_k_labels(df: DataFrame, group: Sequence[str], count: str, k: int, *,
                 label: str | None = None, exclude: Sequence[str] = (),
                 rank_col: str = "ranking") -> DataFrame:
    """top k labels per group by count, ties kept, without ``exclude``d
    labels."""
    if exclude and label:
        df = df.filter(~F.col(label).isin(list(exclude)))
    return rank_within(df, group, [F.col(count).desc()], k, ties="keep", rank_col=rank_col)
