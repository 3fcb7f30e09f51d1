"""A2-A7, B3, F1-F3, H3 on literal frames."""

from pyspark.sql import functions as F

from ridgeline.operators import period, quality, ranking


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_in_period_parses_text_and_keeps_closed_range(spark):
    df = spark.createDataFrame(
        [("2018/01/01", "gb"), ("2022/12/31", "gb"), ("2017/12/31", "gb"),
         ("2023/01/01", "gb"), ("junk", "gb"), (None, "gb"), ("2019/06/15", "xx")],
        "date string, country string")
    out = period.in_period(df, "date", "2018-01-01", "2022-12-31", member_col="country",
                           members=["gb"])
    got = rows(out, "year", "week")
    assert got == [(2018, 1), (2022, 52)]


def test_in_period_members_as_frame(spark):
    df = spark.createDataFrame([("2019/06/15", "gb"), ("2019/06/15", "xx")],
                               "date string, country string")
    keep = spark.createDataFrame([("gb",)], "c string")
    out = period.in_period(df, "date", "2018-01-01", "2022-12-31", member_col="country",
                           members=keep)
    assert rows(out, "country") == [("gb",)]


def test_period_totals_null_measure_still_counts_week(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, None), ("a", 3, 5), ("b", 1, 7)],
        "track string, week int, streams bigint")
    out = period.period_totals(df, ["track"], "streams")
    got = {r["track"]: (r["total_streams"], r["weeks_on_chart"], r["average_streams"])
           for r in out.collect()}
    assert got == {"a": (15, 3, 5.0), "b": (7, 1, 7.0)}
    assert rows(period.min_appearances(out, 3), "track") == [("a",)]


def test_keep_best_keeps_full_ties(spark):
    # equal total and equal id survive together (rank, not row_number)
    df = spark.createDataFrame(
        [("x", "n", 100, "t1", 1), ("x", "n", 100, "t1", 2), ("x", "n", 50, "t0", 3),
         ("x", "m", 10, "t9", 4)],
        "g string, name string, total int, id string, k int")
    out = ranking.keep_best(df, ["g", "name"], [F.col("total").desc(), "id"])
    assert rows(out, "k") == [(1,), (2,), (4,)]
    one = ranking.keep_best(df, ["g", "name"], [F.col("total").desc(), "id", "k"], ties="one")
    assert rows(one, "k") == [(1,), (4,)]


def test_top_k_ties_at_boundary_exceed_k(spark):
    df = spark.createDataFrame(
        [("g", 10.0), ("g", 9.0), ("g", 9.0), ("g", 8.0), ("h", 1.0)], "g string, v double")
    out = ranking.top_k(df, ["g"], [F.col("v").desc()], 2)
    assert rows(out, "g", "v", "rank") == [("g", 9.0, 2), ("g", 9.0, 2), ("g", 10.0, 1),
                                           ("h", 1.0, 1)]


def test_top_k_plans_window_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = ranking.top_k(df, ["g"], [F.col("v").desc()], 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.count() == 15


def test_first_n_rows_exactly_n(spark):
    df = spark.createDataFrame([("g", i % 3, i) for i in range(10)] + [("h", 0, 1)],
                               "g string, r int, id int")
    out = ranking.first_n_rows(df, ["g"], ["r", "id"], 4)
    assert rows(out, "g", "id") == [("g", 0), ("g", 3), ("g", 6), ("g", 9), ("h", 1)]


def test_argmax_ties_go_to_largest_label_and_winner_frequency(spark):
    df = spark.createDataFrame(
        [("c1", 2020, "pop", 5), ("c1", 2020, "rap", 5), ("c1", 2020, "rock", 1),
         ("c2", 2020, "rock", 9), ("c3", 2020, "rap", 2)],
        "country string, year int, genre string, count int")
    win = ranking.argmax_by(df, ["country", "year"], "genre", "count", "top")
    assert rows(win, "country", "top") == [("c1", "rap"), ("c2", "rock"), ("c3", "rap")]
    freq = ranking.winner_frequency(win, "top", "year", "n")
    assert rows(freq, "top", "n") == [("rap", 2), ("rock", 1)]


def test_top_k_labels_excludes_and_keeps_ties(spark):
    df = spark.createDataFrame(
        [("c", "a", 5), ("c", "b", 4), ("c", "d", 3), ("c", "e", 3), ("c", "explicit", 99)],
        "country string, genre string, count int")
    out = ranking.top_k_labels(df, ["country"], "count", 3, label="genre", exclude=["explicit"])
    assert rows(out, "genre", "ranking") == [("a", 1), ("b", 2), ("d", 3), ("e", 3)]


def test_quality_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert rows(quality.duplicate_keys(df, ["k"]), "k", "n_rows") == [("a", 2)]
    assert rows(quality.rows_behind_duplicates(df, ["k"]), "v") == [(1,), (2,)]
    assert rows(quality.rows_per_group(df, ["k"]), "k", "n_rows") == [("a", 2), ("b", 1)]
