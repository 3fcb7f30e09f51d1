"""Correlation matrices, summaries, least squares, nested F test.

Everything here is an aggregate: one pass over the rows produces a handful
of moments (counts, means, co-moments); the statistics are closed-form
column arithmetic on that one-row (or one-row-per-group) result. Nothing is
collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _num(c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def correlation_matrix(df: DataFrame, cols: Sequence[str], *, group: Sequence[str] = (),
                       digits: int | None = 6, x: str = "x", y: str = "y",
                       r: str = "r") -> DataFrame:
    """Square, symmetric Pearson matrix in long form (group..., x, y, r).

    Booleans enter as 0/1. Rows with a NULL in any of ``cols`` are dropped
    first (a matrix needs complete rows). One aggregate computes the
    distinct moments only (k standard deviations, k(k-1)/2 covariances), per
    group when ``group`` is given; r is arithmetic on that single row, and
    one generator turns it into k*k rows. The diagonal is 1, or NULL for a
    constant column (where a matrix routine would give NaN).

    The cell expressions are built as SQL text (parsed once on the JVM)
    rather than as thousands of Python-side column objects.
    """
    cols = list(cols)
    k = len(cols)
    base = df.dropna(subset=cols)
    num = [f"CAST({_q(c)} AS DOUBLE)" for c in cols]
    aggs = [F.expr(f"stddev_pop({num[i]})").alias(f"__s{i}") for i in range(k)]
    aggs += [F.expr(f"covar_pop({num[i]}, {num[j]})").alias(f"__c{i}_{j}")
             for i in range(k) for j in range(i + 1, k)]
    moments = base.groupBy(*group).agg(*aggs)
    cells = []
    for i in range(k):
        for j in range(k):
            if i == j:
                e = f"CASE WHEN __s{i} > 0 THEN 1.0D END"
            else:
                a, b = min(i, j), max(i, j)
                e = f"CASE WHEN __s{a} > 0 AND __s{b} > 0 THEN __c{a}_{b} / (__s{a} * __s{b}) END"
            if digits is not None:
                e = f"round({e}, {int(digits)})"
            cells.append(f"named_struct({_lit(x)}, {_lit(cols[i])}, {_lit(y)}, {_lit(cols[j])}, "
                         f"{_lit(r)}, CAST({e} AS DOUBLE))")
    gen = f"inline(array({', '.join(cells)}))"
    return moments.selectExpr(*[_q(g) for g in group], gen)


def correlation_matrix_sql(table: str, cols: Sequence[str], *, group: Sequence[str] = (),
                           digits: int = 6) -> str:
    """DuckDB twin of ``correlation_matrix`` over a CTE/table name."""
    cols = list(cols)

    def num(c):
        return f'CAST("{c}" AS DOUBLE)'

    def pair(a, b):
        return (f"CASE WHEN stddev_pop({num(a)}) > 0 AND stddev_pop({num(b)}) > 0 THEN "
                f"covar_pop({num(a)}, {num(b)}) / (stddev_pop({num(a)}) * stddev_pop({num(b)})) END")

    sel = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                e = f"CASE WHEN stddev_pop({num(a)}) > 0 THEN 1.0 END"
            else:
                e = pair(a, b) if i < j else pair(b, a)
            sel.append(f'round({e}, {digits}) AS "{i}:{j}"')
    g = ", ".join(group)
    where = " AND ".join(f'"{c}" IS NOT NULL' for c in cols)
    agg = (f"SELECT {g + ', ' if g else ''}{', '.join(sel)} FROM {table} WHERE {where}"
           + (f" GROUP BY {g}" if g else ""))
    labels = "[" + ", ".join(f"'{c}'" for c in cols) + "]"
    on = ", ".join(f'"{i}:{j}"' for i in range(len(cols)) for j in range(len(cols)))
    return (f"SELECT {g + ', ' if g else ''}"
            f"{labels}[CAST(split_part(pair, ':', 1) AS INTEGER) + 1] AS x, "
            f"{labels}[CAST(split_part(pair, ':', 2) AS INTEGER) + 1] AS y, r "
            f"FROM ({agg}) UNPIVOT INCLUDE NULLS (r FOR pair IN ({on}))")


# ------------------------------------------------------------ preparation
def prepare(df: DataFrame, *, flags: Sequence[str] = (), fill: Sequence[str] = ()) -> DataFrame:
    """text/boolean flags -> BOOLEAN, NULL counts -> 0."""
    out = df
    for f in flags:
        out = out.withColumn(f, F.col(f).cast("boolean"))
    return out.fillna(0, subset=list(fill)) if fill else out


# ------------------------------------------------------------- summaries
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def five_number_summary(df: DataFrame, cols: Sequence[str], *, exact: bool = True,
                        digits: int | None = 6, accuracy: int = 10000) -> DataFrame:
    """(column, min, q1, median, q3, max, mean) per column.

    ``exact=True`` uses ``percentile`` (type-7 interpolation, the default of
    R's ``quantile``); it buffers a column's values, so use it on reduced
    tables. ``exact=False`` uses ``percentile_approx`` (bounded memory) for
    raw data.
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value").dropna(subset=["value"])
    probs = F.array(*[F.lit(p) for p in QUARTILES])
    q = (F.percentile(F.col("value"), probs) if exact
         else F.percentile_approx(F.col("value"), probs, accuracy).cast("array<double>"))
    agg = long.groupBy("column").agg(q.alias("__q"), F.avg("value").alias("mean"))
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    names = ["min", "q1", "median", "q3", "max"]
    return agg.select("column", *[r(F.col("__q")[i]).alias(n) for i, n in enumerate(names)],
                      r(F.col("mean")).alias("mean"))


def group_box_stats(df: DataFrame, y: str, group: Sequence[str], *, digits: int | None = 6,
                    whisker: float = 1.5, exact: bool = True,
                    accuracy: int = 10000) -> DataFrame:
    """Per group quartiles (type 7), IQR, Tukey fences and the number of
    points outside them. The fences are one row per group and are joined
    back to count outliers; AQE broadcasts them once their (tiny) size is
    measured. ``exact=False`` uses ``percentile_approx`` (bounded memory per
    group) for raw data; note R's box edges are Tukey hinges, which can
    differ slightly from type-7 quartiles on small groups."""
    g = list(group)
    base = df.dropna(subset=[y])
    probs = F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])
    yy = F.col(y).cast("double")
    quart = (F.percentile(yy, probs) if exact
             else F.percentile_approx(yy, probs, accuracy).cast("array<double>"))
    q = base.groupBy(*g).agg(quart.alias("__q"), F.count(F.lit(1)).alias("n"))
    q = q.select(*g, "n", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
                 F.col("__q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lower_fence", F.col("q1") - whisker * F.col("iqr")) \
        .withColumn("upper_fence", F.col("q3") + whisker * F.col("iqr"))
    out = base.join(q.select(*g, "lower_fence", "upper_fence"), g).groupBy(*g).agg(
        F.count_if((F.col(y) < F.col("lower_fence")) | (F.col(y) > F.col("upper_fence")))
        .alias("n_outliers"))
    res = q.join(out, g)
    r = (lambda c: F.round(F.col(c), digits).alias(c)) if digits is not None else F.col
    return res.select(*g, "n", *[r(c) for c in ("q1", "median", "q3", "iqr", "lower_fence",
                                                  "upper_fence")], "n_outliers")


# ------------------------------------------------------------ regression
def ols_simple(df: DataFrame, y: str, x: str, *, group: Sequence[str] = (),
               digits: int | None = 6) -> DataFrame:
    """I5 (one predictor): intercept, slope, R^2, n, RSS, residual df."""
    yy, xx = _num(y), _num(x)
    base = df.dropna(subset=[y, x])
    agg = base.groupBy(*group).agg(
        F.regr_intercept(yy, xx).alias("intercept"), F.regr_slope(yy, xx).alias("slope"),
        F.regr_r2(yy, xx).alias("r2"), F.count(F.lit(1)).alias("n"),
        F.var_pop(yy).alias("__vy"))
    out = agg.withColumn("rss", (F.lit(1.0) - F.col("r2")) * F.col("n") * F.col("__vy")) \
        .withColumn("df", F.col("n") - 2).drop("__vy")
    out = out.withColumn("adj_r2", _adjusted("r2", "n", 1))
    return _round(out, ["intercept", "slope", "r2", "adj_r2", "rss"], digits)


def _adjusted(r2: str, n: str, p: int) -> Column:
    """Adjusted R^2 for p predictors plus an intercept."""
    return F.lit(1.0) - F.try_divide((F.lit(1.0) - F.col(r2)) * (F.col(n) - 1), F.col(n) - p - 1)


SUM_SQ_SIG = 10  # sums of squares and F are reported to 10 significant digits


def significant(c: Column, digits: int = SUM_SQ_SIG) -> Column:
    """Round to ``digits`` significant digits (scientific formatting), for
    quantities whose magnitude depends on the data (sums of squares)."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits - 1}e", c).try_cast("double"))


def significant_sql(expr: str, digits: int = SUM_SQ_SIG) -> str:
    return f"CAST(printf('%.{digits - 1}e', {expr}) AS DOUBLE)"


def _round(df: DataFrame, cols: Sequence[str], digits: int | None,
           sig: Sequence[str] = ("rss", "rss0", "rss1", "f")) -> DataFrame:
    if digits is None:
        return df
    out = []
    for c in df.columns:
        if c in sig and c in cols:
            out.append(significant(F.col(c)).alias(c))
        elif c in cols:
            out.append(F.round(F.col(c), digits).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _two_moments(y: str, a: str, b: str) -> list[Column]:
    Y, A, B = _num(y), _num(a), _num(b)
    return [
        F.count(F.lit(1)).alias("n"), F.avg(Y).alias("my"), F.avg(A).alias("ma"),
        F.avg(B).alias("mb"), F.var_pop(Y).alias("vy"), F.var_pop(A).alias("va"),
        F.var_pop(B).alias("vb"), F.covar_pop(A, B).alias("cab"),
        F.covar_pop(Y, A).alias("cya"), F.covar_pop(Y, B).alias("cyb"),
    ]


COLLINEAR = 1e-9  # 1 - r^2 of two predictors at or below this counts as collinear


def _two_solution(m: DataFrame) -> DataFrame:
    det = F.col("va") * F.col("vb") - F.col("cab") * F.col("cab")
    det = F.when(det > COLLINEAR * F.col("va") * F.col("vb"), det)
    # NULL for a constant predictor or an exactly collinear pair
    b1 = F.try_divide(F.col("cya") * F.col("vb") - F.col("cyb") * F.col("cab"), det)
    b2 = F.try_divide(F.col("cyb") * F.col("va") - F.col("cya") * F.col("cab"), det)
    m = m.withColumn("b1", b1).withColumn("b2", b2)
    m = m.withColumn("b0", F.col("my") - F.col("b1") * F.col("ma") - F.col("b2") * F.col("mb"))
    return m.withColumn("rss", F.col("n") * (F.col("vy") - F.col("b1") * F.col("cya")
                                             - F.col("b2") * F.col("cyb")))


def ols_two(df: DataFrame, y: str, a: str, b: str, *, group: Sequence[str] = (),
            digits: int | None = 6) -> DataFrame:
    """I5 (two predictors) from one aggregate of means, variances and
    covariances: b1 = (c_ya v_b - c_yb c_ab) / (v_a v_b - c_ab^2), b2 by
    symmetry, b0 = mean(y) - b1 mean(a) - b2 mean(b),
    RSS = n (v_y - b1 c_ya - b2 c_yb)."""
    m = _two_solution(df.dropna(subset=[y, a, b]).groupBy(*group).agg(*_two_moments(y, a, b)))
    out = m.select(*group, F.col("b0").alias("intercept"), F.col("b1").alias(a),
                   F.col("b2").alias(b),
                   (F.lit(1.0) - F.try_divide(F.col("rss"), F.col("n") * F.col("vy"))).alias("r2"),
                   "rss", "n", (F.col("n") - 3).alias("df"))
    out = out.withColumn("adj_r2", _adjusted("r2", "n", 2))
    return _round(out, ["intercept", a, b, "r2", "adj_r2", "rss"], digits)


def ols_two_by_flag(df: DataFrame, y: str, a: str, b: str, flag: str, *,
                    digits: int | None = 6) -> DataFrame:
    """I5 with every term interacted with a 0/1 flag:
    y ~ (a + b) * flag. Equal to separate fits per flag value: base terms are
    the fit for flag = false, interaction terms the difference; RSS adds up.
    One row: intercept, a, b, flag, a:flag, b:flag, r2, rss, n, df."""
    base = df.dropna(subset=[y, a, b, flag]).withColumn("__f", F.col(flag).cast("boolean"))
    per = _two_solution(base.groupBy("__f").agg(*_two_moments(y, a, b)))

    def pick(c, v):
        return F.max(F.when(F.col("__f") == v, F.col(c)))

    # Total sum of squares from the per-group moments (no second pass):
    # TSS = sum n_g (v_g + m_g^2) - (sum n_g m_g)^2 / N.
    s = per.agg(
        pick("b0", False).alias("i0"), pick("b0", True).alias("i1"),
        pick("b1", False).alias("a0"), pick("b1", True).alias("a1"),
        pick("b2", False).alias("c0"), pick("b2", True).alias("c1"),
        F.sum("rss").alias("rss"), F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("vy") + F.col("my") * F.col("my"))).alias("__s2"),
        F.sum(F.col("n") * F.col("my")).alias("__s1"))
    tss = F.col("__s2") - F.col("__s1") * F.col("__s1") / F.col("n")
    out = s.select(
        F.col("i0").alias("intercept"), F.col("a0").alias(a), F.col("c0").alias(b),
        (F.col("i1") - F.col("i0")).alias(flag),
        (F.col("a1") - F.col("a0")).alias(f"{a}:{flag}"),
        (F.col("c1") - F.col("c0")).alias(f"{b}:{flag}"),
        (F.lit(1.0) - F.try_divide(F.col("rss"), tss)).alias("r2"),
        "rss", "n", (F.col("n") - 6).alias("df"))
    out = out.withColumn("adj_r2", _adjusted("r2", "n", 5))
    return _round(out, ["intercept", a, b, flag, f"{a}:{flag}", f"{b}:{flag}", "r2", "adj_r2", "rss"],
                  digits)


def anova_nested(small: DataFrame, large: DataFrame, *, digits: int | None = 6) -> DataFrame:
    """F test of a nested pair of fits (one row each with rss and df):
    F = ((RSS0 - RSS1) / (df0 - df1)) / (RSS1 / df1)."""
    both = small.select("rss", "df", F.lit(0).alias("__m")).unionByName(
        large.select("rss", "df", F.lit(1).alias("__m")))

    def pick(c, m):
        return F.max(F.when(F.col("__m") == m, F.col(c)))

    j = both.agg(pick("rss", 0).alias("rss0"), pick("df", 0).alias("df0"),
                 pick("rss", 1).alias("rss1"), pick("df", 1).alias("df1"))
    out = j.select("rss0", "df0", "rss1", "df1",
                   F.try_divide(F.try_divide(F.col("rss0") - F.col("rss1"), F.col("df0") - F.col("df1")),
                                F.try_divide(F.col("rss1"), F.col("df1"))).alias("f"))
    return _round(out, ["rss0", "rss1", "f"], digits)


# ------------------------------------------------------------- inference
def _group_fit(y: str, xs: Sequence[str]) -> tuple[list[Column], dict[str, Column]]:
    """Moment aggregates and per-group closed-form fit for 1 or 2 predictors.

    Returns the aggregate list and expressions (over the aggregated row) for:
    b0, b1[, b2], rss, n and the variance factors a11[, a22, a12], v0 (the
    diagonal of (X'X)^-1 without sigma^2)."""
    Y = _num(y)
    X = [_num(x) for x in xs]
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(Y).alias("my"), F.var_pop(Y).alias("vy")]
    for i, x in enumerate(X, 1):
        aggs += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"),
                 F.covar_pop(x, Y).alias(f"c{i}y")]
    if len(X) == 2:
        aggs.append(F.covar_pop(X[0], X[1]).alias("c12"))
    c = F.col
    if len(X) == 1:
        b1 = F.try_divide(c("c1y"), c("v1"))
        e = {"b1": b1, "b0": c("my") - b1 * c("m1"),
             "rss": c("n") * (c("vy") - b1 * c("c1y")),
             "a11": F.try_divide(F.lit(1.0), c("n") * c("v1"))}
        e["v0"] = F.lit(1.0) / c("n") + c("m1") * c("m1") * e["a11"]
    elif len(X) == 2:
        det = c("v1") * c("v2") - c("c12") * c("c12")
        b1 = F.try_divide(c("c1y") * c("v2") - c("c2y") * c("c12"), det)
        b2 = F.try_divide(c("c2y") * c("v1") - c("c1y") * c("c12"), det)
        nd = c("n") * det
        e = {"b1": b1, "b2": b2, "b0": c("my") - b1 * c("m1") - b2 * c("m2"),
             "rss": c("n") * (c("vy") - b1 * c("c1y") - b2 * c("c2y")),
             "a11": F.try_divide(c("v2"), nd), "a22": F.try_divide(c("v1"), nd),
             "a12": F.try_divide(-c("c12"), nd)}
        e["v0"] = (F.lit(1.0) / c("n") + c("m1") * c("m1") * e["a11"]
                   + c("m2") * c("m2") * e["a22"] + 2 * c("m1") * c("m2") * e["a12"])
    else:
        raise ValueError("one or two predictors")
    return aggs, e


def ols_inference(df: DataFrame, y: str, xs: Sequence[str], *, flag: str | None = None,
                  digits: int | None = 6) -> DataFrame:
    """Coefficient table (term, estimate, std_error, t_value, df) of
    ``y ~ xs`` or, with ``flag``, of ``y ~ xs * flag`` (every term
    interacted with a 0/1 flag), from one aggregate of moments per flag value.

    Standard errors use sigma^2 = RSS / (n - k) and the closed-form inverse
    of the centred cross-product matrix; for the interacted model the fit is
    block-diagonal by flag value, so an interaction term's variance is the
    sum of the two groups' variances (pooled sigma^2)."""
    xs = list(xs)
    p = len(xs)
    cols = [y, *xs] + ([flag] if flag else [])
    base = df.dropna(subset=cols)
    aggs, e = _group_fit(y, xs)
    if flag is None:
        fit = base.agg(*aggs).select(*[v.alias(k) for k, v in e.items()], "n")
        k = p + 1
        s2 = F.try_divide(F.col("rss"), F.col("n") - k)
        terms = [("(intercept)", F.col("b0"), s2 * F.col("v0"))]
        terms += [(x, F.col(f"b{i}"), s2 * F.col(f"a{i}{i}")) for i, x in enumerate(xs, 1)]
        dfree = F.col("n") - k
        src = fit
    else:
        per = base.withColumn("__f", F.col(flag).cast("boolean")).groupBy("__f").agg(*aggs) \
            .select("__f", *[v.alias(k) for k, v in e.items()], "n")
        keys = list(e) + ["n"]

        def pick(name, v):
            return F.max(F.when(F.col("__f") == v, F.col(name))).alias(f"{name}_{int(v)}")

        src = per.agg(*[pick(kk, v) for kk in keys for v in (False, True)])
        k = 2 * (p + 1)
        n_all = F.col("n_0") + F.col("n_1")
        s2 = F.try_divide(F.col("rss_0") + F.col("rss_1"), n_all - k)

        def g(name, v):
            return F.col(f"{name}_{v}")

        terms = [("(intercept)", g("b0", 0), s2 * g("v0", 0))]
        terms += [(x, g(f"b{i}", 0), s2 * g(f"a{i}{i}", 0)) for i, x in enumerate(xs, 1)]
        terms += [(flag, g("b0", 1) - g("b0", 0), s2 * (g("v0", 0) + g("v0", 1)))]
        terms += [(f"{x}:{flag}", g(f"b{i}", 1) - g(f"b{i}", 0),
                   s2 * (g(f"a{i}{i}", 0) + g(f"a{i}{i}", 1))) for i, x in enumerate(xs, 1)]
        dfree = n_all - k
    rows = []
    for name, est, var in terms:
        se = F.sqrt(var)
        t = F.try_divide(est, se)
        vals = [est, se, t]
        if digits is not None:
            vals = [F.round(v, digits) for v in vals]
        rows.append(F.struct(F.lit(name).alias("term"), vals[0].alias("estimate"),
                             vals[1].alias("std_error"), vals[2].alias("t_value"),
                             dfree.cast("long").alias("df")))
    return src.select(F.inline(F.array(*rows)))
