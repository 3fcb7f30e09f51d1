"""Least squares for any list of terms, and nested tests, from one pass.

One aggregate per group gives the Gram matrix: counts, means and centred
cross-products of all terms of all models and the outcome. The sweep operator then
solves on that small matrix, with SQL higher-order functions: sweeping a term's
pivot turns its row into its coefficient, the corner into the residual sum of
squares and the swept block into the inverse cross-products that standard errors
need. A model is a choice of rows of the same matrix, and the corner after each
sweep is the residual of the model so far, so nested models and tests by sequence
need no other fit and no other pass.

Rank: a pivot that has shrunk to ``TOLERANCE`` of its own sum of squares is not
swept. Its term is an exact combination of the terms before it, or constant; it
gets a NULL estimate and takes no degree of freedom, as a statistics package does.

A term is a column, or columns joined by ``:`` for their product (booleans count
0 and 1). Rows with a NULL in the outcome or any term of any model are left out,
so that models of one call are fitted to the same rows. A group without rows gives
none; one with fewer rows than terms has NULL errors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.stats import significant

TOLERANCE = 1e-9
CONSTANT = 1e-20     # variance in units of the squared mean that is rounding only
Models = Mapping[str, Sequence[str]]


def interacted(terms: Sequence[str], flag: str) -> list[str]:
    """``terms``, the flag, and every term with the flag."""
    return [*terms, flag, *[f"{t}:{flag}" for t in terms]]


def _all_terms(models: Models) -> list[str]:
    return list(dict.fromkeys(t for terms in models.values() for t in terms))


def gram(df: DataFrame, y: str, terms: Sequence[str], *, group: Sequence[str] = ()) -> DataFrame:
    """Rows group..., n, means, cross (centred sums of products; the outcome comes last)."""
    names = [*terms, y]
    parts = {c for t in names for c in t.split(":")}
    value = {}
    for t in names:
        product = None
        for c in t.split(":"):
            v = F.col(f"`{c}`").cast("double")
            product = v if product is None else product * v
        value[t] = product
    rows = df.dropna(subset=sorted(parts)).select(*group, *[value[t].alias(f"__x{i}") for i, t in enumerate(names)])
    x = [f"__x{i}" for i in range(len(names))]
    moments = [F.count("*").alias("n"), *[F.avg(c).alias(f"{c}m") for c in x],
               *[F.covar_pop(a, b).alias(f"{a}{b}") for a, b in combinations_with_replacement(x, 2)]]
    one = rows.groupBy(*group).agg(*moments).where("n > 0")

    def cell(i: int, j: int) -> Column:
        v = F.col(f"{x[min(i, j)]}{x[max(i, j)]}")
        mean = F.col(f"{x[i]}m")
        return (F.when(v > CONSTANT * mean * mean, v).otherwise(0.0) if i == j else v) * F.col("n")

    k = range(len(x))
    return one.select(*group, "n", F.array(*[F.col(f"{c}m") for c in x]).alias("means"),
                      F.array(*[F.array(*[cell(i, j) for j in k]) for i in k]).alias("cross"))


def sweep(matrix: Column, pivots: Column) -> Column:
    """Sweep a symmetric matrix on ``pivots`` in order. Struct of m (the swept matrix), rss (its
    corner after each pivot) and kept (whether the pivot was swept)."""
    size = F.size(matrix)
    start = F.struct(matrix.alias("m"), F.array().cast("array<double>").alias("rss"),
                     F.array().cast("array<boolean>").alias("kept"))

    def step(state: Column, k: Column) -> Column:
        m = state["m"]
        d = F.get(F.get(m, k), k)
        ok = d > F.lit(TOLERANCE) * F.get(F.get(matrix, k), k)

        def cell(i: Column, j: Column, v: Column) -> Column:
            along, down = F.get(F.get(m, k), j), F.get(F.get(m, i), k)
            return (F.when((i == k) & (j == k), 1 / d).when(i == k, along / d).when(j == k, -down / d)
                    .otherwise(v - down * along / d))

        swept = F.when(ok, F.transform(m, lambda row, i: F.transform(row, lambda v, j: cell(i, j, v)))).otherwise(m)
        return F.struct(swept.alias("m"), state["rss"].alias("rss"),
                        F.concat(state["kept"], F.array(F.coalesce(ok, F.lit(False)))).alias("kept"))

    def with_corner(state: Column, k: Column) -> Column:
        new = step(state, k)
        corner = F.get(F.get(new["m"], size - 1), size - 1)
        return F.struct(new["m"].alias("m"), F.concat(state["rss"], F.array(corner)).alias("rss"),
                        new["kept"].alias("kept"))

    return F.aggregate(pivots, start, with_corner)


def fit_models(df: DataFrame, y: str, models: Models, *, group: Sequence[str] = ()) -> DataFrame:
    """Rows group..., model, n, rank, tss, rss, terms: one per model, from one aggregate of
    ``df``. ``terms``: array of structs term, estimate, factor (its variance in units of the
    residual variance) and rss_after (residual with the terms up to it), the intercept first."""
    every = _all_terms(models)
    one = gram(df, y, every, group=group)
    # each model's rows of the matrix, in its own order, then the outcome
    choices = F.array(*[F.struct(F.lit(name).alias("model"), F.array(*[F.lit(t) for t in terms]).alias("names"),
                                 F.array(*[F.lit(every.index(t)) for t in terms]).alias("rows"))
                        for name, terms in models.items()])
    each = one.select(*group, "n", "means", "cross", F.explode(choices).alias("c"))
    rows = F.concat("c.rows", F.array(F.lit(len(every))))
    matrix = F.transform(rows, lambda i: F.transform(rows, lambda j: F.get(F.get("cross", i), j)))
    each = each.select(*group, "n", "c.model", "c.names", matrix.alias("matrix"),
                       F.transform(rows, lambda i: F.get("means", i)).alias("means"))
    p = F.size("names")
    pivots = F.when(p > 0, F.sequence(F.lit(0), p - 1)).otherwise(F.array().cast("array<int>"))
    # written as one struct column, so that the sweep is computed once per row
    each = each.withColumn("s", sweep(F.col("matrix"), pivots))
    corner = F.get(F.get("matrix", p), p)
    kept = lambda i: F.get("s.kept", i)
    m = lambda i, j: F.get(F.get("s.m", i), j)
    total = lambda f: F.aggregate(pivots, F.lit(0.0), lambda acc, i: acc + F.when(kept(i), f(i)).otherwise(0.0))
    intercept = F.get("means", p) - total(lambda i: m(i, p) * F.get("means", i))
    factor0 = 1 / F.col("n") + total(lambda i: F.get("means", i) * total(lambda j: F.get("means", j) * m(i, j)))
    first = F.struct(F.lit("(intercept)").alias("term"), intercept.alias("estimate"), factor0.alias("factor"),
                     corner.alias("rss_after"))
    others = F.transform(pivots, lambda i: F.struct(
        F.get("names", i).alias("term"), F.when(kept(i), m(i, p)).alias("estimate"),
        F.when(kept(i), m(i, i)).alias("factor"), F.get("s.rss", i).alias("rss_after")))
    rank = F.size(F.filter("s.kept", lambda k: k))
    return each.select(*group, "model", "n", rank.cast("long").alias("rank"), corner.alias("tss"),
                       F.get(F.get("s.m", p), p).alias("rss"), F.concat(F.array(first), others).alias("terms"))


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def coefficient_table(fits: DataFrame, *, group: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """Rows group..., model, term, estimate, std_error, t_value, df."""
    df = F.col("n") - 1 - F.col("rank")
    error = F.sqrt(F.try_divide("rss", F.when(F.col("df") > 0, F.col("df"))) * F.col("t.factor"))
    long = fits.select(*group, "model", "rss", df.alias("df"), F.explode("terms").alias("t"))
    return long.select(*group, "model", "t.term", _round(F.col("t.estimate"), digits).alias("estimate"),
                       _round(error, digits).alias("std_error"),
                       _round(F.try_divide(F.col("t.estimate"), error), digits).alias("t_value"), "df")


def model_table(fits: DataFrame, *, group: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """Rows group..., model, r2, adj_r2, rss, n, df."""
    df = F.col("n") - 1 - F.col("rank")
    r2 = 1 - F.try_divide("rss", "tss")
    adjusted = 1 - (1 - r2) * F.try_divide(F.col("n") - 1, df)
    return fits.select(*group, "model", _round(r2, digits).alias("r2"), _round(adjusted, digits).alias("adj_r2"),
                       (F.col("rss") if digits is None else significant(F.col("rss"))).alias("rss"), "n",
                       df.alias("df"))


def sequential_anova(fits: DataFrame, *, group: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """Rows group..., model, place, term, df, sum_sq, f: each term tested after those before it
    (a dropped term has df 0), against the residual of the whole model."""
    resid = F.try_divide("rss", F.when(F.col("n") - 1 - F.col("rank") > 0, F.col("n") - 1 - F.col("rank")))
    long = fits.select(*group, "model", resid.alias("v"), F.posexplode(
        F.transform(F.slice("terms", 2, F.size("terms")), lambda t, i: F.struct(
            t["term"].alias("term"), t["estimate"].isNotNull().cast("int").alias("df"),
            (F.get("terms", i)["rss_after"] - t["rss_after"]).alias("sum_sq")))).alias("place", "t"))
    show = significant if digits is not None else (lambda c: c)
    sum_sq = F.when(F.col("t.df") > 0, F.col("t.sum_sq"))
    return long.select(*group, "model", "place", "t.term", "t.df", show(sum_sq).alias("sum_sq"),
                       show(F.try_divide(sum_sq, F.col("v"))).alias("f"))


def nested_anova(df: DataFrame, y: str, small: Sequence[str], large: Sequence[str], *, group: Sequence[str] = (),
                 digits: int | None = 6) -> DataFrame:
    """Rows group..., rss0, df0, rss1, df1, f: the F test of ``small`` within ``large`` (which
    holds its terms). The large model is swept with the small one's terms first; the residual
    after them is the small model's, so there is one pass and one fit."""
    missing = [t for t in small if t not in large]
    if missing:
        raise ValueError(f"terms of the small model that the large one lacks: {missing}")
    order = [*small, *[t for t in large if t not in small]]
    one = fit_models(df, y, {"large": order}, group=group)
    at = F.get("terms", F.lit(len(small)))
    rank0 = F.size(F.filter(F.slice("terms", 2, max(len(small), 1)), lambda t: t["estimate"].isNotNull())) if small else F.lit(0)
    both = one.select(*group, at["rss_after"].alias("rss0"), (F.col("n") - 1 - rank0).alias("df0"),
                      F.col("rss").alias("rss1"), (F.col("n") - 1 - F.col("rank")).alias("df1"))
    f = F.try_divide(F.try_divide(F.col("rss0") - F.col("rss1"), F.col("df0") - F.col("df1")),
                     F.try_divide("rss1", F.when(F.col("df1") > 0, F.col("df1"))))
    show = significant if digits is not None else (lambda c: c)
    return both.select(*group, show(F.col("rss0")).alias("rss0"), "df0", show(F.col("rss1")).alias("rss1"), "df1",
                       show(f).alias("f"))


# ------------------------------------------------------------------ SQL twin
def fits_sql(source: str, y: str, models: Models, prefix: str = "fit") -> list[str]:
    """DuckDB CTEs, one list of fitted terms per model: ``{prefix}_{model}`` (term, estimate,
    factor, rss_after, n, rank, tss, rss). Gauss-Jordan elimination written out in columns."""
    every = _all_terms(models)
    names = [*every, y]

    def value(t: str) -> str:
        return " * ".join(f"CAST({c} AS DOUBLE)" for c in t.split(":"))

    where = " AND ".join(f"{c} IS NOT NULL" for c in dict.fromkeys(c for t in names for c in t.split(":")))
    cols = ", ".join(f"{value(t)} AS x{i}" for i, t in enumerate(names))
    k = len(names)
    moments = ", ".join([f"avg(x{i}) AS m{i}" for i in range(k)]
                        + [f"covar_pop(x{i}, x{j}) * count(*) AS c{i}_{j}" for i in range(k) for j in range(i + 1, k)]
                        + [f"CASE WHEN var_pop(x{i}) > {CONSTANT} * avg(x{i}) * avg(x{i}) THEN var_pop(x{i}) ELSE 0 END "
                           f"* count(*) AS c{i}_{i}" for i in range(k)])
    out = [f"{prefix}_gram AS (SELECT count(*) AS n, {moments} FROM (SELECT {cols} FROM {source} WHERE {where}))"]
    for name, terms in models.items():
        rows = [*[every.index(t) for t in terms], k - 1]
        p = len(terms)
        sel = ", ".join([f"m{r} AS m_{i}" for i, r in enumerate(rows)]
                        + [f"c{min(a, b)}_{max(a, b)} AS a_{i}_{j}" for i, a in enumerate(rows) for j, b in enumerate(rows)]
                        + [f"c{r}_{r} AS o_{i}" for i, r in enumerate(rows)])
        step = f"(SELECT n, {sel} FROM {prefix}_gram)"
        for q in range(p):
            cells = []
            for i in range(p + 1):
                for j in range(p + 1):
                    e = (f"1 / a_{q}_{q}" if i == j == q else f"a_{q}_{j} / a_{q}_{q}" if i == q else
                         f"-a_{i}_{q} / a_{q}_{q}" if j == q else f"a_{i}_{j} - a_{i}_{q} * a_{q}_{j} / a_{q}_{q}")
                    cells.append(f"CASE WHEN a_{q}_{q} > {TOLERANCE} * o_{q} THEN {e} ELSE a_{i}_{j} END AS a_{i}_{j}")
            carried = ["n", *[f"m_{i}" for i in range(p + 1)], *[f"o_{i}" for i in range(p + 1)],
                       *[f"rss_{r}" for r in range(q)], *[f"kept_{r}" for r in range(q)]]
            step = f"(SELECT {', '.join(carried)}, {', '.join(cells)}, a_{q}_{q} > {TOLERANCE} * o_{q} AS kept_{q}, " \
                   f"CASE WHEN a_{q}_{q} > {TOLERANCE} * o_{q} THEN a_{p}_{p} - a_{p}_{q} * a_{q}_{p} / a_{q}_{q} " \
                   f"ELSE a_{p}_{p} END AS rss_{q} FROM {step})"
        on = lambda i, e: f"CASE WHEN kept_{i} THEN {e} ELSE 0 END"
        b0 = " - ".join([f"m_{p}", *[on(i, f"a_{i}_{p} * m_{i}") for i in range(p)]])
        v0 = " + ".join(["CAST(1 AS DOUBLE) / n", *[f"CASE WHEN kept_{i} AND kept_{j} THEN m_{i} * m_{j} * a_{i}_{j} ELSE 0 END"
                                                   for i in range(p) for j in range(p)]])
        rank = " + ".join(["0", *[f"CAST(kept_{i} AS INTEGER)" for i in range(p)]])
        rest = f"n, {rank} AS rank, o_{p} AS tss, a_{p}_{p} AS rss"
        selects = [f"SELECT 0 AS place, '(intercept)' AS term, {b0} AS estimate, {v0} AS factor, o_{p} AS rss_after, {rest} FROM {prefix}_{name}_s"]
        selects += [f"SELECT {i + 1}, '{t}', CASE WHEN kept_{i} THEN a_{i}_{p} END, CASE WHEN kept_{i} THEN a_{i}_{i} END, "
                    f"rss_{i}, {rest} FROM {prefix}_{name}_s" for i, t in enumerate(terms)]
        out += [f"{prefix}_{name}_s AS (SELECT * FROM {step})", f"{prefix}_{name} AS ({' UNION ALL '.join(selects)})"]
    return out
