"""Least squares by the sweep operator against numpy, with dropped terms and nested tests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.operators import regression

A, B, C, D, FLAG = "a", "b", "c", "d", "flag"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 400
    x = rng.normal(size=(n, 4)) * [1, 10, 0.1, 3] + [0, 100, 5, -2]
    flag = rng.random(n) < 0.4
    y = 3 + x @ [2, -0.5, 4, 0.25] + flag * (1 + x[:, 0]) + rng.normal(size=n)
    rows = [(*map(float, r), bool(f), float(v), "g%d" % (i % 3)) for i, (r, f, v) in enumerate(zip(x, flag, y, strict=True))]
    rows[5] = (None, *rows[5][1:])
    rows[9] = (*rows[9][:5], None, rows[9][6])
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, flag boolean, y double, g string").cache()
    kept = [r for i, r in enumerate(rows) if i not in (5, 9)]
    return df, kept


def column(rows, term):
    at = {"a": 0, "b": 1, "c": 2, "d": 3, "flag": 4}
    out = np.ones(len(rows))
    for part in term.split(":"):
        out = out * np.array([float(r[at[part]]) for r in rows])
    return out


def lstsq(rows, terms):
    X = np.column_stack([np.ones(len(rows)), *[column(rows, t) for t in terms]])
    y = np.array([r[5] for r in rows])
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    rss = float(((y - X @ beta) ** 2).sum())
    df = len(rows) - X.shape[1]
    se = np.sqrt(rss / df * np.diag(np.linalg.inv(X.T @ X)))
    return beta, se, rss, df, float(((y - y.mean()) ** 2).sum())


MODELS = {"p0": [], "p1": [B], "p2": [A, B], "p3": [C, A, D], "p4": [A, B, C, D],
          "p5": [A, B, FLAG, f"{A}:{FLAG}", f"{B}:{FLAG}"], "p6": [A, B, C, D, FLAG, f"{A}:{FLAG}"]}


def test_every_model_of_one_pass_equals_numpy(data):
    df, rows = data
    fits = regression.fit_models(df, "y", MODELS)
    table = regression.coefficient_table(fits, digits=None).collect()
    about = {r.model: r for r in regression.model_table(fits, digits=None).collect()}
    for name, terms in MODELS.items():
        beta, se, rss, dof, tss = lstsq(rows, terms)
        got = [r for r in table if r.model == name]
        assert [r.term for r in got] == ["(intercept)", *terms] and {r.df for r in got} == {dof}
        np.testing.assert_allclose([r.estimate for r in got], beta, rtol=1e-7, atol=1e-8)
        np.testing.assert_allclose([r.std_error for r in got], se, rtol=1e-6)
        np.testing.assert_allclose([r.t_value for r in got], beta / se, rtol=1e-5, atol=1e-6)
        np.testing.assert_allclose(about[name].rss, rss, rtol=1e-9)
        assert about[name].n == len(rows) and about[name].df == dof
        np.testing.assert_allclose(about[name].r2, 1 - rss / tss, rtol=1e-9, atol=1e-9)


def test_groups_are_fitted_apart(data):
    df, rows = data
    table = regression.coefficient_table(
        regression.fit_models(df, "y", {"m": [A, B]}, group=["g"]), group=["g"], digits=None).collect()
    for g in ("g0", "g1", "g2"):
        beta, se, *_ = lstsq([r for r in rows if r[6] == g], [A, B])
        got = [r for r in table if r.g == g]
        np.testing.assert_allclose([r.estimate for r in got], beta, rtol=1e-7)
        np.testing.assert_allclose([r.std_error for r in got], se, rtol=1e-6)


def test_collinear_and_constant_terms_are_dropped(data):
    df, rows = data
    df = df.withColumns({"sum": F.col("a") + 2 * F.col("b"), "one": F.lit(1.0)})
    fits = regression.fit_models(df, "y", {"m": [A, B, "sum", "one", C]})
    got = {r.term: r for r in regression.coefficient_table(fits, digits=None).collect()}
    beta, se, rss, dof, _ = lstsq(rows, [A, B, C])
    for t in ("sum", "one"):
        assert got[t].estimate is None and got[t].std_error is None and got[t].df == dof
    np.testing.assert_allclose([got[t].estimate for t in ("(intercept)", A, B, C)], beta, rtol=1e-7)
    np.testing.assert_allclose([got[t].std_error for t in ("(intercept)", A, B, C)], se, rtol=1e-6)
    steps = regression.sequential_anova(fits, digits=None).collect()
    assert [r.df for r in steps] == [1, 1, 0, 0, 1]


def test_nested_and_sequential_tests(data):
    df, rows = data
    small, large = [A, B], MODELS["p5"]
    r = regression.nested_anova(df, "y", small, [FLAG, *[t for t in large if t != FLAG]], digits=None).first()
    _, _, rss0, df0, _ = lstsq(rows, small)
    _, _, rss1, df1, _ = lstsq(rows, large)
    np.testing.assert_allclose([r.rss0, r.rss1], [rss0, rss1], rtol=1e-9)
    assert (r.df0, r.df1) == (df0, df1)
    np.testing.assert_allclose(r.f, (rss0 - rss1) / (df0 - df1) / (rss1 / df1), rtol=1e-7)
    steps = regression.sequential_anova(regression.fit_models(df, "y", {"m": large}), digits=None).collect()
    before = lstsq(rows, [])[2]
    for i, s in enumerate(steps):
        after = lstsq(rows, large[:i + 1])[2]
        assert s.term == large[i]
        np.testing.assert_allclose([s.sum_sq, s.f], [before - after, (before - after) / (rss1 / df1)], rtol=1e-6, atol=1e-9)
        before = after
    with pytest.raises(ValueError):
        regression.nested_anova(df, "y", [C], [A])


def test_no_rows_and_too_few_rows(data):
    df, _ = data
    assert regression.fit_models(df.where("false"), "y", {"m": [A]}).count() == 0
    few = df.where("a is not null and y is not null").orderBy("a").limit(2)
    got = regression.coefficient_table(regression.fit_models(few, "y", {"m": [A, B]}), digits=None).collect()
    assert [r.std_error for r in got] == [None] * 3 and got[2].estimate is None
    empty = regression.nested_anova(df, "y", [], [A], digits=None).first()
    assert empty.df0 == empty.df1 + 1


def test_one_pass_over_the_rows(data):
    df, _ = data
    plan = regression.nested_anova(df, "y", [A], [A, B])._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("InMemoryTableScan") == 1 or plan.count("Exchange SinglePartition") <= 2
