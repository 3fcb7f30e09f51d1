"""B1-B9, C2-C7, F4, G5, H4 on literal frames."""

from ridgeline.operators import facts, labels, reshape


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_remap_single_pass_case_sensitive(spark):
    df = spark.createDataFrame([("A",), ("B",), ("a",), ("C",), (None,)], "g string")
    out = labels.remap_values(df, "g", {"A": "B", "B": "Z"})
    assert rows(out, "g") == sorted([("B",), ("Z",), ("a",), ("C",), (None,)], key=str)
    table = spark.createDataFrame([("A", "B"), ("B", "Z")], "raw string, mapped string")
    assert rows(labels.remap_values(df, "g", table), "g") == rows(out, "g")


def test_drop_unlabelled(spark):
    df = spark.createDataFrame([("['x']", True), ("[]", True), (None, True), ("['y']", None)],
                               "l string, e boolean")
    assert rows(labels.drop_unlabelled(df, "l", ["e"]), "l") == [("['x']",)]


def test_tags_partial_match_null_and_residual(spark):
    df = spark.createDataFrame([("['trap']",), ("['Rap']",), ("['jazz']",), (None,)], "t string")
    tagged = labels.tag_by_pattern(df, "t", {"rap": "rap", "edm": "trap|house"})
    out = labels.residual_label(tagged, ["rap", "edm"], "other")
    assert rows(out, "t", "rap", "edm", "other") == sorted([
        ("['trap']", True, True, False), ("['Rap']", False, False, True),
        ("['jazz']", False, False, True), (None, False, False, True)], key=str)


def test_residual_with_null_flag_is_false(spark):
    df = spark.createDataFrame([(None, False), (False, False), (True, None)], "a boolean, b boolean")
    out = labels.residual_label(df, ["a", "b"], "o")
    assert sorted(r["o"] for r in out.collect()) == [False, False, True]


def test_count_flags_and_complement(spark):
    df = spark.createDataFrame([("g", True), ("g", None), ("g", False), ("h", True)],
                               "k string, f boolean")
    c = labels.count_flags(df, ["k"], ["f"], total="n")
    c = c.withColumn("not_f", labels.complement_count("n", "f"))
    assert rows(c, "k", "f", "n", "not_f") == [("g", 1, 3, 2), ("h", 1, 1, 0)]
    assert rows(labels.count_by(df, ["k"]), "k", "count") == [("g", 3), ("h", 1)]


def test_unpivot_pivot_round_trip_keeps_zeros(spark):
    wide = spark.createDataFrame([(2020, "c", 0, 3), (2021, "c", 2, 0)],
                                 "year int, country string, a bigint, b bigint")
    long = reshape.to_long(wide, ["year", "country"], ["a", "b"], "genre", "count")
    assert long.count() == 4
    back = reshape.to_wide(long, ["year", "country"], "genre", "count", ["a", "b"])
    assert rows(back, "year", "a", "b") == [(2020, 0, 3), (2021, 2, 0)]


def test_pivot_absent_is_null_unless_filled(spark):
    long = spark.createDataFrame([(1, "a", 5)], "k int, g string, v int")
    assert rows(reshape.to_wide(long, ["k"], "g", "v", ["a", "b"]), "a", "b") == [(5, None)]
    assert rows(reshape.to_wide(long, ["k"], "g", "v", ["a", "b"], fill=0), "a", "b") == [(5, 0)]


def test_heatmap_mean_vs_sum_when_names_collide(spark):
    df = spark.createDataFrame([("Chinese", 2020, 2), ("Chinese", 2020, 4), ("English", 2021, 1)],
                               "language string, year int, track_count bigint")
    avg = reshape.heatmap_matrix(df, "language", "year", "track_count", [2020, 2021], agg="avg")
    tot = reshape.heatmap_matrix(df, "language", "year", "track_count", [2020, 2021], agg="sum")
    assert rows(avg, "language", "2020", "2021", "row_total") == [
        ("Chinese", 3.0, 0.0, 3.0), ("English", 0.0, 1.0, 1.0)]
    assert rows(tot, "language", "2020", "row_total") == [("Chinese", 6, 6), ("English", 0, 1)]


def test_label_counts_wide_absent_label_is_null(spark):
    df = spark.createDataFrame([("c", 2020, "positive", 1), ("c", 2020, "neutral", 2)],
                               "country string, year int, mood string, id int")
    out = reshape.label_counts_wide(df, ["country", "year"], "mood",
                                    ["positive", "neutral", "negative"], "id")
    assert rows(out, "positive", "neutral", "negative") == [(1, 1, None)]


def test_clean_years(spark):
    df = spark.createDataFrame([("2019*",), ("n/a",), ("2017",), ("2023",), ("2020",)],
                               "year_string string")
    assert rows(facts.clean_years(df, 2018, 2022), "year") == [(2019,), (2020,)]


def test_join_indicators_restrict_merge_flag_unmatched(spark):
    a = spark.createDataFrame([(2019, "gb", "United Kingdom", 1.0), (2019, "jp", "Japan", 2.0)],
                              "year int, code string, country string, x double")
    b = spark.createDataFrame([(2019, "gb", "United Kingdom", 3.0)],
                              "year int, code string, country string, y double")
    j = facts.join_indicators([a, b], ["year", "code", "country"])
    assert j.count() == 1
    outcome = spark.createDataFrame([("United Kingdom", 2019, 7.0), ("UK", 2019, 6.0),
                                     ("Japan", 2030, 1.0)], "country string, year int, h double")
    known = facts.restrict_to_known(outcome, a, "country", period="year", lo=2018, hi=2022)
    assert rows(known, "country") == [("United Kingdom",)]
    merged = facts.merge_outcome(a, outcome, ["year", "country"])
    assert rows(merged, "code") == [("gb",)]
    miss = facts.unmatched(a, outcome, ["year", "country"])
    assert rows(miss, "code") == [("jp",)]
    flagged = facts.membership_flag(a, "country", ["Japan"], "dev")
    assert rows(flagged, "code", "dev") == [("gb", False), ("jp", True)]
    members = spark.createDataFrame([("Japan",)], "c string")
    assert rows(facts.membership_flag(a, "country", members, "dev"), "code", "dev") == \
        [("gb", False), ("jp", True)]


def test_global_series_join(spark):
    a = spark.createDataFrame([(2019, 1.0), (2020, 2.0)], "year int, x double")
    g = spark.createDataFrame([(2019, 9.0)], "year int, g double")
    assert rows(facts.attach_global_series(a, g), "year", "g") == [(2019, 9.0)]


def test_exact_mean_and_display_name(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("NATION_7", 0.1), ("NATION_7", 0.2), ("UNITED_KINGDOM", 0.3)],
                               "code string, v double")
    out = df.groupBy("code").agg(facts.exact_mean("v", factor=100).alias("m")) \
        .select(facts.display_name("code").alias("name"), "m")
    got = sorted((r["name"], r["m"]) for r in out.collect())
    # decimal sums: 0.1 + 0.2 is exactly 0.3 before the final division
    assert got == [("Nation 7", 15.0), ("United kingdom", 30.0)]
    assert df.select(F.sum("v")).first()[0] != 0.6  # the double sum is not exact
