"""F7, I1-I7 against numpy on a deterministic frame."""

import numpy as np
import pytest

from ridgeline.operators import stats


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 90
    a = rng.normal(5, 2, n).round(6)
    b = rng.normal(1, 0.5, n).round(6)
    flag = np.arange(n) % 2 == 0
    y = (3 + 0.4 * a - 1.1 * b + 0.8 * flag + 0.3 * a * flag + rng.normal(0, 0.3, n)).round(6)
    data = [(float(y[i]), float(a[i]), float(b[i]), bool(flag[i]), 1.0) for i in range(n)]
    df = spark.createDataFrame(data, "y double, a double, b double, f boolean, const double")
    return df, y, a, b, flag


def test_correlation_matrix_matches_numpy(frame):
    df, y, a, b, flag = frame
    out = stats.correlation_matrix(df, ["y", "a", "b", "f", "const"], digits=None)
    got = {(r["x"], r["y"]): r["r"] for r in out.collect()}
    ref = np.corrcoef(np.vstack([y, a, b, flag.astype(float)]))
    names = ["y", "a", "b", "f"]
    for i, x in enumerate(names):
        for j, z in enumerate(names):
            assert got[(x, z)] == pytest.approx(ref[i, j], abs=1e-12)
    assert got[("const", "const")] is None and got[("y", "const")] is None
    assert len(got) == 25


def test_grouped_correlation(frame):
    df, y, a, b, flag = frame
    out = stats.correlation_matrix(df, ["y", "a"], group=["f"], digits=None)
    got = {(r["f"], r["x"], r["y"]): r["r"] for r in out.collect()}
    for fv in (True, False):
        m = flag == fv
        assert got[(fv, "y", "a")] == pytest.approx(np.corrcoef(y[m], a[m])[0, 1], abs=1e-12)


def test_five_number_summary_type7(frame):
    df, y, a, *_ = frame
    out = {r["column"]: r for r in stats.five_number_summary(df, ["y", "a"], digits=None).collect()}
    for name, v in (("y", y), ("a", a)):
        q = np.percentile(v, [0, 25, 50, 75, 100])
        r = out[name]
        assert [r["min"], r["q1"], r["median"], r["q3"], r["max"]] == pytest.approx(q, abs=1e-9)
        assert r["mean"] == pytest.approx(v.mean(), abs=1e-9)


def test_box_stats(frame):
    df, y, a, b, flag = frame
    out = {r["f"]: r for r in stats.group_box_stats(df, "y", ["f"], digits=None).collect()}
    for fv in (True, False):
        v = y[flag == fv]
        q1, q3 = np.percentile(v, [25, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert out[fv]["iqr"] == pytest.approx(q3 - q1, abs=1e-9)
        assert out[fv]["n_outliers"] == int(((v < lo) | (v > hi)).sum())


def _lstsq(X, y):
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    rss = float(((y - X @ beta) ** 2).sum())
    return beta, rss


def test_ols_simple_and_two(frame):
    df, y, a, b, flag = frame
    s = stats.ols_simple(df, "y", "a", digits=None).collect()[0]
    beta, rss = _lstsq(np.column_stack([np.ones_like(a), a]), y)
    assert [s["intercept"], s["slope"]] == pytest.approx(beta, abs=1e-9)
    assert s["rss"] == pytest.approx(rss, rel=1e-9) and s["df"] == 88
    t = stats.ols_two(df, "y", "a", "b", digits=None).collect()[0]
    beta, rss = _lstsq(np.column_stack([np.ones_like(a), a, b]), y)
    assert [t["intercept"], t["a"], t["b"]] == pytest.approx(beta, abs=1e-9)
    assert t["rss"] == pytest.approx(rss, rel=1e-9)
    assert t["r2"] == pytest.approx(1 - rss / ((y - y.mean()) ** 2).sum(), abs=1e-12)
    n = len(y)
    assert t["adj_r2"] == pytest.approx(1 - (rss / (n - 3)) / (((y - y.mean()) ** 2).sum() / (n - 1)),
                                        abs=1e-12)


def test_interacted_model_and_f_test(frame):
    df, y, a, b, flag = frame
    fl = flag.astype(float)
    X1 = np.column_stack([np.ones_like(a), a, b, fl, a * fl, b * fl])
    beta1, rss1 = _lstsq(X1, y)
    m1 = stats.ols_two_by_flag(df, "y", "a", "b", "f", digits=None)
    r = m1.collect()[0]
    assert [r["intercept"], r["a"], r["b"], r["f"], r["a:f"], r["b:f"]] == \
        pytest.approx(beta1, abs=1e-8)
    assert r["rss"] == pytest.approx(rss1, rel=1e-9) and r["df"] == 84
    assert r["r2"] == pytest.approx(1 - rss1 / ((y - y.mean()) ** 2).sum(), abs=1e-12)
    _, rss0 = _lstsq(np.column_stack([np.ones_like(a), a, b]), y)
    m0 = stats.ols_two(df, "y", "a", "b", digits=None)
    f = stats.anova_nested(m0, m1, digits=None).collect()[0]
    expect = ((rss0 - rss1) / 3) / (rss1 / 84)
    assert f["f"] == pytest.approx(expect, rel=1e-9)


def test_prepare(spark):
    df = spark.createDataFrame([("true", None), ("false", 3)], "flag string, n int")
    out = stats.prepare(df, flags=["flag"], fill=["n"]).collect()
    assert [(r["flag"], r["n"]) for r in out] == [(True, 0), (False, 3)]


def _inference(X, y):
    beta, rss = _lstsq(X, y)
    n, k = X.shape
    s2 = rss / (n - k)
    cov = s2 * np.linalg.inv(X.T @ X)
    return beta, np.sqrt(np.diag(cov)), n - k


def test_ols_inference_matches_numpy(frame):
    df, y, a, b, flag = frame
    fl = flag.astype(float)
    out = {r["term"]: r for r in stats.ols_inference(df, "y", ["a", "b"], digits=None).collect()}
    beta, se, dfree = _inference(np.column_stack([np.ones_like(a), a, b]), y)
    for i, t in enumerate(["(intercept)", "a", "b"]):
        assert out[t]["estimate"] == pytest.approx(beta[i], abs=1e-9)
        assert out[t]["std_error"] == pytest.approx(se[i], rel=1e-8)
        assert out[t]["t_value"] == pytest.approx(beta[i] / se[i], rel=1e-8)
        assert out[t]["df"] == dfree
    X1 = np.column_stack([np.ones_like(a), a, b, fl, a * fl, b * fl])
    beta, se, dfree = _inference(X1, y)
    out = {r["term"]: r for r in
           stats.ols_inference(df, "y", ["a", "b"], flag="f", digits=None).collect()}
    for i, t in enumerate(["(intercept)", "a", "b", "f", "a:f", "b:f"]):
        assert out[t]["estimate"] == pytest.approx(beta[i], abs=1e-8)
        assert out[t]["std_error"] == pytest.approx(se[i], rel=1e-7)
        assert out[t]["df"] == dfree
    one = {r["term"]: r for r in stats.ols_inference(df, "y", ["a"], digits=None).collect()}
    beta, se, _ = _inference(np.column_stack([np.ones_like(a), a]), y)
    assert one["a"]["std_error"] == pytest.approx(se[1], rel=1e-8)


def test_distribution_tails():
    from ridgeline.functions.distributions import f_upper_p, t_two_sided_p

    # textbook critical values
    assert t_two_sided_p(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert t_two_sided_p(1.959964, 1e7) == pytest.approx(0.05, abs=1e-6)
    assert t_two_sided_p(0.0, 5) == pytest.approx(1.0)
    assert f_upper_p(4.102821, 2, 10) == pytest.approx(0.05, abs=1e-6)
    assert f_upper_p(2.816466, 3, 84) == pytest.approx(0.044, abs=2e-3)
    # t^2 with (1, df) is F
    assert t_two_sided_p(2.5, 30) == pytest.approx(f_upper_p(6.25, 1, 30), rel=1e-10)


def test_p_value_udfs(spark):
    from pyspark.sql import functions as F

    from ridgeline.functions.distributions import f_test_p, t_test_p

    df = spark.createDataFrame([(2.228139, 10, 4.102821, 2, 10)], "t double, d long, f double, a long, b long")
    r = df.select(t_test_p(F.col("t"), F.col("d")).alias("p"),
                  f_test_p(F.col("f"), F.col("a"), F.col("b")).alias("q")).collect()[0]
    assert r["p"] == pytest.approx(0.05, abs=1e-6) and r["q"] == pytest.approx(0.05, abs=1e-6)


def test_p_values_agree_with_spark_ml(frame, spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from pyspark.sql import functions as F

    from ridgeline.functions.distributions import t_test_p

    df = frame[0]
    inf = stats.ols_inference(df, "y", ["a", "b"], digits=None)
    ours = {r["term"]: r["p"] for r in
            inf.select("term", t_test_p(F.col("t_value"), F.col("df")).alias("p")).collect()}
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = LinearRegression(featuresCol="features", labelCol="y", solver="normal",
                             standardization=False).fit(vec)
    pv = model.summary.pValues  # coefficients first, intercept last
    assert ours["a"] == pytest.approx(pv[0], rel=1e-6, abs=1e-12)
    assert ours["b"] == pytest.approx(pv[1], rel=1e-6, abs=1e-12)
    assert ours["(intercept)"] == pytest.approx(pv[2], rel=1e-6, abs=1e-12)
