"""D3-D14, E2-E8 on literal frames."""

from pyspark.sql import functions as F

from ridgeline.functions import (
    chunk_chars,
    chunk_tokens,
    first_of_list_literal,
    majority_label,
    normalise_label,
)
from ridgeline.functions.text import list_items
from ridgeline.operators import batching, enrich, language, sentiment


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_chunk_chars_boundaries(spark):
    texts = ["", "a", "x" * 511, "y" * 512, "z" * 513, "é" * 600, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["c"] for r in df.select(chunk_chars("t", 512).alias("c")).collect()]
    assert got[0] == []
    assert got[1] == ["a"]
    assert [len(c) for c in got[2]] == [511]
    assert [len(c) for c in got[3]] == [512]
    assert [len(c) for c in got[4]] == [512, 1]
    assert [len(c) for c in got[5]] == [512, 88] and "".join(got[5]) == "é" * 600
    assert got[6] is None


def test_explode_chunks_drops_empty_text(spark):
    df = spark.createDataFrame([(1, ""), (2, "ab"), (3, None)], "id int, t string")
    out = sentiment.explode_chunks(df, "t", size=1)
    assert rows(out, "id", "chunk_no", "chunk") == [(2, 0, "a"), (2, 1, "b")]


def test_chunk_tokens(spark):
    df = spark.createDataFrame([("  a b\nc   d e ",), ("",)], "t string")
    got = [r["c"] for r in df.select(chunk_tokens("t", 2).alias("c")).collect()]
    assert got == [["a b", "c d", "e"], []]


def test_first_of_list_literal(spark):
    vals = ["['A', \"B's\"]", "[\"B's\"]", "[]", "abc", None, "['Destiny''s']"]
    df = spark.createDataFrame([(v,) for v in vals], "l string")
    got = [r["f"] for r in df.select(first_of_list_literal("l").alias("f")).collect()]
    assert got[:5] == ["A", "B's", None, None, None]
    second = df.select(F.try_element_at(list_items("l"), F.lit(2)).alias("s")).collect()
    assert second[0]["s"] == "B's"


def test_assemble_text_order_exclusion_nulls(spark):
    df = spark.createDataFrame(
        [(1, 2, "user", "world"), (1, 1, "user", "hello"), (1, 3, "system", "x"),
         (1, 4, None, "y"), (1, 5, "user", None), (2, 1, "assistant", "z")],
        "id int, turn int, role string, text string")
    out = enrich.assemble_text(df, "id", "text", ["turn"], exclude=("role", ["system"]),
                               keep_max=["role"])
    assert rows(out, "id", "text", "role", "n_parts") == [(1, "hello world", "user", 2),
                                                        (2, "z", "assistant", 1)]


def test_without_match_plain_and_null_aware(spark):
    items = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    matched = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(enrich.without_match(items, matched, "k"), "k") == [(2,), (None,)]
    assert enrich.without_match(items, matched, "k", null_aware=True).count() == 0
    clean = spark.createDataFrame([(1,)], "k int")
    assert rows(enrich.without_match(items, clean, "k", null_aware=True), "k") == [(2,)]


def test_match_consolidate_and_enrich_status(spark):
    items = spark.createDataFrame([(1, "s", "a"), (2, "t", "b"), (3, None, "c")],
                                  "id int, name string, artist string")
    corpus = spark.createDataFrame([("s", "a", "hello", "en"), ("s", "a", "bye", "en"),
                                    ("t", "x", "hej", "sv")],
                                   "title string, c_artist string, lyrics string, language string")
    stats = enrich.text_stats_by(corpus, ["title", "c_artist"], "lyrics", lang="language")
    m = enrich.match_items(items, stats, [("name", "title"), ("artist", "c_artist")])
    c = enrich.consolidate_matches(m, "id")
    assert rows(c, "id", "n_docs", "n_chars", "language") == [(1, 2, len("hello bye"), "en")]
    texts = spark.createDataFrame([(1, "la la", "fr"), (3, "x", "de")],
                                  "k int, lyrics string, language string")
    e = enrich.enrich_status(items, texts, "id", "k", required=["name"])
    assert rows(e, "id", "lyrics", "language") == [(1, "la la", "fr"), (2, None, None),
                                                 (3, None, None)]


def test_decode_dimension(spark):
    df = spark.createDataFrame([("gb",), ("global",), ("zz",)], "c string")
    dim = spark.createDataFrame([("gb", "United Kingdom")], "code string, name string")
    out = enrich.decode_dimension(df, "c", dim, special={"global": "Global"})
    assert rows(out, "c") == [("Global",), ("United Kingdom",), ("zz",)]


def test_dense_index_and_batches_across_partitions(spark):
    for n in (51, 100):
        df = spark.range(n).select((F.col("id") * 7 % n).alias("k")).repartition(5)
        out = batching.assign_batches(df, 50, ["k"], partitions=3)
        got = sorted((r["k"], r["row_index"], r["batch_id"]) for r in out.collect())
        assert [g[1] for g in got] == list(range(1, n + 1))
        assert all(b == (i - 1) // 50 for _, i, b in got)
    sizes = rows(out.groupBy("batch_id").count(), "batch_id", "count")
    assert sizes == [(0, 50), (1, 50)]


def test_detect_language_and_recheck(spark):
    df = spark.createDataFrame([
        (1, "The cat and the dog of the house is in the garden"),
        (2, "Le chat et le chien de la maison est dans le jardin avec les enfants"),
        (3, "Der Hund und die Katze sind in dem Haus mit den Kindern"),
        (4, "zzz qqq"), (5, None)], "id int, text string")
    det = language.detect_language(df, "id", "text")
    got = dict(rows(det, "id", "detected"))
    assert got[1] == "en" and got[2] == "fr" and got[3] == "de"
    assert got[4] == "und" and got[5] == "und"
    lab = spark.createDataFrame([(1, "no", "en"), (2, "fr", "xx"), (3, None, "de")],
                                "id int, language string, detected string")
    assert rows(language.recheck_unknown(lab, "language", "detected"), "id", "language") == \
        [(1, "en"), (2, "fr"), (3, None)]
    assert language.recheck_unknown(lab, "language", "detected", drop_null=True).count() == 2


def test_distinct_frequent_keep(spark):
    data = [("en", "t")] * 3 + [("en", None)] + [("fr", "t")] * 2 + [("no", "t")] * 9 + [(None, "t")]
    df = spark.createDataFrame(data, "lang string, text string")
    assert rows(language.distinct_values(df, "lang", "no"), "lang") == [("en",), ("fr",)]
    # strict '>' and NULL-text rows count towards frequency
    assert rows(language.frequent_values(df, "lang", 3, "no"), "lang") == [("en",)]
    assert language.keep_frequent(df, "lang", "text", 3, "no").count() == 3


def test_majority_label_strict(spark):
    cases = [(1, 1, 0, "neutral"), (0, 0, 0, "neutral"), (2, 1, 1, "positive"),
             (1, 2, 2, "neutral"), (0, 1, 2, "negative")]
    df = spark.createDataFrame([c[:3] for c in cases], "p int, u int, n int")
    got = [r["m"] for r in df.select(majority_label("p", "u", "n").alias("m")).collect()]
    assert got == [c[3] for c in cases]


def test_normalise_label_rules(spark):
    df = spark.createDataFrame([("5 stars", 0.9), ("3 stars", 0.9), ("1 star", 0.9), ("x", 0.9),
                                ("LABEL_0", 0.8), ("LABEL_1", 0.74), ("LABEL_1", 0.75),
                                ("1", 0.0), ("-1", 0.0), ("", 0.0)], "l string, s double")
    out = df.select(
        normalise_label("l", rule="stars").alias("stars"),
        normalise_label("l", "s", "binary_threshold").alias("bt"),
        normalise_label("l", rule="signed").alias("sg"),
        normalise_label("l", rule="mapping", mapping={"x": "negative"}).alias("mp"),
        normalise_label("l", rule="identity").alias("id")).collect()
    assert [r["stars"] for r in out[:4]] == ["positive", "neutral", "negative", None]
    assert [r["bt"] for r in out[4:7]] == ["negative", "neutral", "positive"]
    assert [r["sg"] for r in out[7:9]] == ["positive", "negative"]
    assert out[3]["mp"] == "negative" and out[9]["id"] is None


def test_lexicon_scorer_counts_whole_words(spark):
    df = spark.createDataFrame([(1, "Good good bad goodness"), (2, "nothing here")],
                               "id int, chunk string")
    out = sentiment.score_chunks_lexicon(df, positive=["good"], negative=["bad"])
    got = rows(out, "id", "pos_hits", "neg_hits", "stars", "label")
    assert got == [(1, 2, 1, "4 stars", "LABEL_1"), (2, 0, 0, "3 stars", "LABEL_1")]


def test_count_labels_and_vote(spark):
    df = spark.createDataFrame([(1, "positive"), (1, "positive"), (1, None), (2, "negative"),
                                (2, "neutral")], "id int, l string")
    out = sentiment.vote(sentiment.count_labels(df, ["id"], "l"))
    assert rows(out, "id", "positive_count", "neutral_count", "negative_count", "mood") == [
        (1, 2, 0, 0, "positive"), (2, 0, 1, 1, "neutral")]


def test_route_and_unrouted(spark):
    df = spark.createDataFrame([("en",), ("zh-Hant",), (None,)], "lang string")
    assert rows(sentiment.route_by_language(df, "lang", {"en": "stars"}), "lang", "route") == \
        [("en", "stars")]
    assert rows(sentiment.unrouted(df, "lang", {"en": "stars"}), "lang", "n_rows") == \
        [("zh-Hant", 1), (None, 1)]


def test_plug_in_scorer_runs_in_arrow_batches(spark):
    def make_len_scorer():
        # stands in for a model: created once per Python worker
        def score(texts):
            return [("LABEL_1" if len(t) > 3 else "LABEL_0", 0.9) for t in texts]

        return score

    df = spark.createDataFrame([(1, "abcdef"), (2, "ab")], "id int, chunk string")
    out = sentiment.score_chunks_with(df, make_len_scorer)
    lab = out.withColumn("m", normalise_label("label", "score", "binary_threshold"))
    assert rows(lab, "id", "label", "m") == [(1, "LABEL_1", "positive"), (2, "LABEL_0", "negative")]


def test_log_weights_sum_and_latest(spark):
    from ridgeline.operators import distribution

    df = spark.createDataFrame([("c", "en", 2019, 3), ("c", "en", 2020, 1), ("c", "fr", 2019, 0)],
                               "country string, language string, year int, n bigint")
    s = dict(rows(distribution.log_weights(df, "country", "language", "n").select("language", "weight"),
                  "language", "weight"))
    last = dict(rows(distribution.log_weights(df, "country", "language", "n", mode="latest")
                     .select("language", "weight"), "language", "weight"))
    import math
    assert s["en"] == math.log1p(4) and last["en"] == math.log1p(1) and s["fr"] == 0.0


def test_letter_tokens_any_script(spark):
    from ridgeline.functions import letter_tokens

    df = spark.createDataFrame([("Ünïcode, déjà-vu! 42 ЖЖ",)], "t string")
    assert df.select(letter_tokens("t").alias("k")).first()["k"] == ["ünïcode", "déjà", "vu", "жж"]


def test_chunks_by_language_route_sizes(spark):
    df = spark.createDataFrame([(1, "vi", "x" * 300), (2, "en", "y" * 600), (3, "sk", " ".join(["w"] * 501)),
                                (4, "de", "z" * 10), (5, "en", "")], "id int, lang string, t string")
    out = sentiment.explode_chunks_by_language(df, "t", "lang")
    got = sorted((r["id"], r["chunk_no"], len(r["chunk"])) for r in out.collect())
    assert got == [(1, 0, 256), (1, 1, 44), (2, 0, 512), (2, 1, 88), (3, 0, 999), (3, 1, 1)]


def test_normalise_by_language(spark):
    df = spark.createDataFrame([("en", "5 stars", 0.1), ("ko", "LABEL_1", 0.9), ("ko", "LABEL_1", 0.5),
                                ("ru", "POSITIVE", 0.9), ("vi", "Tích cực", 0.9), ("sk", "-1", 0.0),
                                ("tl", "LABEL_0", 0.1), ("tr", "Notr", 0.9), ("de", "5 stars", 0.9)],
                               "lang string, label string, score double")
    got = [r["m"] for r in df.select(
        sentiment.normalise_by_language("label", "score", "lang").alias("m")).collect()]
    assert got == ["positive", "positive", "neutral", "positive", "positive", "negative",
                   "negative", "neutral", None]


def test_decode_dimension_nfc(spark):
    import unicodedata

    composed = unicodedata.normalize("NFC", "Curaçao")
    decomposed = unicodedata.normalize("NFD", "Curaçao")
    assert composed != decomposed
    df = spark.createDataFrame([("cw",)], "c string")
    dim = spark.createDataFrame([("cw", decomposed)], "code string, name string")
    out = enrich.decode_dimension(df, "c", dim, normalize=True).first()["c"]
    assert out == composed


def test_restrict_to_keys(spark):
    big = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    keys = spark.createDataFrame([(3,), (5,), (5,), (500,)], "k long")
    assert sorted(r["k"] for r in enrich.restrict_to_keys(big, keys, "k").collect()) == [3, 5]


def test_default_routes_vote_both_ways(spark):
    from ridgeline.operators import sentiment
    from ridgeline.streaming.moods import moods_batch

    rows = [(f"{code}{i}", code, text) for code in sentiment.LANGUAGE_ROUTES
            for i, text in enumerate(["love love happy joy great", "bad sad awful hate pain"])]
    df = spark.createDataFrame(rows, "track_id string, language string, lyrics string")
    got = {r["track_id"]: r["mood"] for r in moods_batch(df).collect()}
    assert got == {f"{c}{i}": m for c in sentiment.LANGUAGE_ROUTES for i, m in enumerate(["positive", "negative"])}
