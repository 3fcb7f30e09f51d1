"""Exact quantiles and box statistics of columns of any length.

``percentile`` holds a group's values in one task. Here a value of a given rank is
found by narrowing: an interval that surely holds it is cut at two values near the rank
(a mergeable sketch of the values inside gives them), the rows below and within are
counted exactly, and the interval shrinks to the part that holds the rank, by thousands
of times a round. When few values are left, or the interval is one value, the rank is
read off. Tasks hold sketches and counts, never more than ``few`` values; the result is
exact, because every cut is judged by exact counts.

Quantiles are of type 7 (linear between ranks, the usual default); hinges are Tukey's,
as box plots draw them: the medians of the lower and upper half, the middle value in both.
Null values are left out; a group without values has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.session import materialize

FEW = 4_096
ACCURACY = 2_000


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a row per group and rank) as a stored table: Spark knows its size and sends it to the
    values. Of unknown size, a few groups would take all values into a task each."""
    return materialize(df, as_table=True)


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"__{k}"])
    return on


def select_ranks(values: DataFrame, ranks: DataFrame, keys: Sequence[str], *, value: str = "value",
                 few: int = FEW, accuracy: int = ACCURACY) -> DataFrame:
    """Rows keys..., rank, value: the ``rank``-th value (from 0) of each group. ``values``: keys and
    value, without nulls; ``ranks``: keys and rank, one row per wanted rank (a small table)."""
    named = [F.col(k).alias(f"__{k}") for k in keys]
    own = [f"__{k}" for k in keys]
    v = F.col(value)
    ends = values.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("m"))
    ranks = ranks.select(*keys, F.col("rank").cast("long").alias("rank")).distinct()
    r, e = ranks.select(*named, "rank"), ends.alias("e")
    state = _small(e.join(r, _same(ends, r, keys)).where((F.col("rank") >= 0) & (F.col("rank") < F.col("m"))).select(
        *own, "rank", "lo", "hi", F.lit(0).cast("long").alias("below"), "m"))
    found = None
    while True:
        done = state.where("lo = hi").select(*own, "rank", F.col("lo").alias("v"))
        short = state.where(f"lo < hi and m <= {few}")
        inside = values.join(short, _same(values, short, keys)).where((v >= F.col("lo")) & (v <= F.col("hi")))
        read = (inside.groupBy(*own, "rank", "below").agg(F.sort_array(F.collect_list(v)).alias("all"))
                .select(*own, "rank", F.get("all", (F.col("rank") - F.col("below")).cast("int")).alias("v")))
        part = materialize(done.unionByName(read))
        found = part if found is None else found.unionByName(part)
        state = state.where(f"lo < hi and m > {few}")
        if state.isEmpty():
            return found.select(*[F.col(f"__{k}").alias(k) for k in keys], "rank", F.col("v").alias(value))
        state = _narrow(values, state, keys, own, v, accuracy)


def _narrow(values: DataFrame, state: DataFrame, keys: Sequence[str], own: list[str], v: Column, accuracy: int) -> DataFrame:
    """Each interval cut at two values around its rank."""
    inside = values.join(state, _same(values, state, keys)).where((v >= F.col("lo")) & (v <= F.col("hi")))
    about = [*own, "rank", "lo", "hi", "below", "m"]
    # cut points at even shares of the interval; those beside the rank are chosen by exact counts
    shares = F.array(*[F.lit(i / 64) for i in range(1, 64)])
    at = (F.col("rank") - F.col("below") + 0.5) / F.col("m")
    near = inside.groupBy(*about).agg(F.percentile_approx(v, shares, accuracy).alias("cuts"))
    a = F.get("cuts", F.greatest(F.floor(at * 64) - 2, F.lit(0)).cast("int"))
    b = F.get("cuts", F.least(F.floor(at * 64) + 1, F.lit(62)).cast("int"))
    cut = _small(near.select(*about, a.alias("a"), b.alias("b")))
    inside = values.join(cut, _same(values, cut, keys)).where((v >= F.col("lo")) & (v <= F.col("hi")))
    counted = inside.groupBy(*about, "a", "b").agg(
        F.count_if(v < F.col("a")).alias("n_a"), F.count_if(v <= F.col("b")).alias("n_b"),
        F.max(F.when(v < F.col("a"), v)).alias("under_a"), F.min(F.when(v > F.col("b"), v)).alias("over_b"))
    k = F.col("rank") - F.col("below")
    low, high = k < F.col("n_a"), k >= F.col("n_b")
    return _small(counted.select(
        *own, "rank",
        F.when(low, F.col("lo")).when(high, F.col("over_b")).otherwise(F.col("a")).alias("lo"),
        F.when(low, F.col("under_a")).when(high, F.col("hi")).otherwise(F.col("b")).alias("hi"),
        (F.col("below") + F.when(low, 0).when(high, F.col("n_b")).otherwise(F.col("n_a"))).alias("below"),
        F.when(low, F.col("n_a")).when(high, F.col("m") - F.col("n_b")).otherwise(F.col("n_b") - F.col("n_a")).alias("m")))


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], *, group: Sequence[str] = (),
                    few: int = FEW) -> DataFrame:
    """Rows group..., prob, value: type-7 quantiles of a column per group, one row per prob."""
    values = df.select(*group, F.col(column).cast("double").alias("value")).where("value is not null")
    n = materialize(values.groupBy(*group).agg(F.count("*").alias("n")).where("n > 0"))
    wanted = n.select(*group, "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")).withColumn(
        "h", (F.col("n") - 1) * F.col("prob"))
    ranks = wanted.select(*group, F.explode(F.array(F.floor("h"), F.ceil("h"))).alias("rank"))
    at = select_ranks(values, ranks, group, few=few)
    both = at.select(*[F.col(k).alias(f"__{k}") for k in group], F.col("rank").alias("r"), F.col("value").alias("v"))
    joined = wanted.join(both, _same(wanted, both, group) & F.col("r").isin(F.floor("h"), F.ceil("h")))
    part = F.first("h") - F.floor(F.first("h"))
    return joined.groupBy(*group, "prob").agg(
        (F.min("v") + part * (F.max("v") - F.min("v"))).alias("value"))


def box_hinges(df: DataFrame, y: str, group: Sequence[str] = (), *, whisker: float = 1.5, digits: int | None = 6,
               few: int = FEW) -> DataFrame:
    """Rows group..., n, lower, q1, median, q3, upper, n_outliers: Tukey's hinges and median, and
    the last values within ``whisker`` times the distance of the hinges."""
    values = df.select(*group, F.col(y).cast("double").alias("value")).where("value is not null")
    n = materialize(values.groupBy(*group).agg(F.count("*").alias("n")).where("n > 0"))
    depth = F.floor((F.col("n") + 3) / 2) / 2
    places = {"q1": depth, "median": (F.col("n") + 1) / 2, "q3": F.col("n") + 1 - depth}
    wanted = n.select(*group, F.explode(F.array(*[
        F.struct(F.lit(k).alias("name"), e.cast("double").alias("d")) for k, e in places.items()])).alias("w")).select(*group, "w.*")
    ranks = wanted.select(*group, F.explode(F.array(F.floor("d") - 1, F.ceil("d") - 1)).alias("rank"))
    at = select_ranks(values, ranks, group, few=few)
    both = at.select(*[F.col(k).alias(f"__{k}") for k in group], F.col("rank").alias("r"), F.col("value").alias("v"))
    joined = wanted.join(both, _same(wanted, both, group) & F.col("r").isin(F.floor("d") - 1, F.ceil("d") - 1))
    middle = joined.groupBy(*group, "name").agg(((F.min("v") + F.max("v")) / 2).alias("x"))
    box = middle.groupBy(*group).agg(*[F.max(F.when(F.col("name") == k, F.col("x"))).alias(k) for k in places])
    box = _small(box.select(*[F.col(k).alias(f"__{k}") for k in group], *places))
    reach = whisker * (F.col("q3") - F.col("q1"))
    within = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    out = values.join(box, _same(values, box, group)).groupBy(*group, *places).agg(
        F.count("*").alias("n"), F.min(F.when(within, F.col("value"))).alias("lower"),
        F.max(F.when(within, F.col("value"))).alias("upper"), F.count_if(~within).alias("n_outliers"))
    show = (lambda c: F.round(c, digits).alias(c)) if digits is not None else F.col
    return out.select(*group, "n", *[show(c) for c in ("lower", "q1", "median", "q3", "upper")], "n_outliers")
