"""Property tests: operators against brute force on random small inputs."""

import os

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeline.functions import chunk_chars, majority_label
from ridgeline.operators import batching, period, ranking

# RIDGELINE_PROPERTY_EXAMPLES raises the number of random cases for a deeper run
SETTINGS = settings(max_examples=int(os.environ.get("RIDGELINE_PROPERTY_EXAMPLES", "12")),
                    deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5)),
                   min_size=1, max_size=40)


@SETTINGS
@given(rows=rows_st, k=st.integers(1, 4))
def test_top_k_equals_pandas_min_rank(spark, rows, k):
    df = spark.createDataFrame(rows, "g string, v int")
    got = sorted((r["g"], r["v"], r["rank"]) for r in
                 ranking.top_k(df, ["g"], [F.col("v").desc()], k).collect())
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    pdf["rank"] = pdf.groupby("g")["v"].rank(method="min", ascending=False).astype(int)
    want = sorted(tuple(x) for x in pdf[pdf["rank"] <= k].itertuples(index=False))
    assert got == want


@SETTINGS
@given(rows=rows_st, n=st.integers(1, 5))
def test_first_n_rows_counts(spark, rows, n):
    data = [(g, v, i) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    out = ranking.first_n_rows(df, ["g"], ["v", "id"], n).collect()
    pdf = pd.DataFrame(data, columns=["g", "v", "id"]).sort_values(["g", "v", "id"])
    want = sorted(tuple(x) for x in pdf.groupby("g").head(n).itertuples(index=False))
    assert sorted((r["g"], r["v"], r["id"]) for r in out) == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(1, 3),
                               st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=30))
def test_period_totals_equals_pandas(spark, rows):
    df = spark.createDataFrame(rows, "k string, week int, s bigint")
    got = {r["k"]: (r["total_streams"], r["weeks_on_chart"])
           for r in period.period_totals(df, ["k"], "s").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "week", "s"])
    for key, grp in pdf.groupby("k"):
        total = grp["s"].dropna().sum() if grp["s"].notna().any() else None
        assert got[key][1] == len(grp)
        assert got[key][0] == (None if total is None else int(total))


@SETTINGS
@given(keys=st.lists(st.integers(-50, 50), min_size=1, max_size=60, unique=True),
       parts=st.integers(1, 5))
def test_dense_index_is_rank_of_key(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(parts)
    out = batching.dense_index(df, ["k"], partitions=parts).collect()
    assert sorted((r["k"], r["row_index"]) for r in out) == \
        [(k, i + 1) for i, k in enumerate(sorted(keys))]


@SETTINGS
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=40)), min_size=1, max_size=8),
       size=st.integers(1, 7))
def test_chunks_rebuild_text(spark, texts, size):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["c"] for r in df.select("i", chunk_chars("t", size).alias("c")).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
        else:
            # code-point slices of the text, all full but the last
            want = [t[j:j + size] for j in range(0, len(t), size)]
            assert got[i] == want


@SETTINGS
@given(counts=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 3)),
                       min_size=1, max_size=20))
def test_majority_label_brute_force(spark, counts):
    df = spark.createDataFrame(counts, "p int, u int, n int")
    got = [r["m"] for r in df.select(majority_label("p", "u", "n").alias("m")).collect()]

    def vote(p, u, n):
        if p > u and p > n:
            return "positive"
        if n > u and n > p:
            return "negative"
        return "neutral"

    assert got == [vote(*c) for c in counts]


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["c1", "c2"]), st.sampled_from([2019, 2020]),
                               st.sampled_from(["positive", "neutral", "negative"])),
                     min_size=1, max_size=40))
def test_label_counts_wide_equals_crosstab(spark, rows):
    from ridgeline.operators import reshape

    data = [(c, y, m, i) for i, (c, y, m) in enumerate(rows)]
    df = spark.createDataFrame(data, "country string, year int, mood string, id int")
    out = reshape.label_counts_wide(df, ["country", "year"], "mood",
                                    ["positive", "neutral", "negative"], "id").collect()
    pdf = pd.DataFrame(data, columns=["country", "year", "mood", "id"])
    ct = pd.crosstab([pdf.country, pdf.year], pdf.mood)
    for r in out:
        for m in ("positive", "neutral", "negative"):
            want = int(ct.loc[(r["country"], r["year"]), m]) if m in ct.columns else 0
            assert (r[m] or 0) == want
            assert (r[m] is None) == (want == 0)  # absent label is NULL, not 0
    assert len(out) == len(ct)


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(-5, 5), st.integers(-5, 5), st.integers(-5, 5)),
                     min_size=3, max_size=25))
def test_correlation_matrix_equals_numpy(spark, vals):
    import numpy as np

    from ridgeline.operators import stats

    df = spark.createDataFrame(vals, "a int, b int, c int")
    got = {(r["x"], r["y"]): r["r"] for r in
           stats.correlation_matrix(df, ["a", "b", "c"], digits=None).collect()}
    arr = np.array(vals, dtype=float).T
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            if arr[i].std() == 0 or arr[j].std() == 0:
                assert got[(x, y)] is None
            else:
                assert abs(got[(x, y)] - np.corrcoef(arr[i], arr[j])[0, 1]) < 1e-9
