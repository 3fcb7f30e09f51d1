"""File-to-file jobs: each stage of the chart / genre / fact / text / mood
analyses as one function (and one command), composed from the operators and
the readers / writers. Parameters default to the values of the original
analyses and can be overridden.

    python -m ridgeline.plans.jobs <job> <input> ... <output>
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.rules import normalise_label
from ridgeline.functions.text import first_of_list_literal
from ridgeline.operators import (
    batching,
    distribution,
    enrich,
    facts,
    labels,
    language,
    period,
    ranking,
    reshape,
    sentiment,
    stats,
)
from ridgeline.session import materialize
from ridgeline.sources import io

# ---- fixed values: defaults of the original analyses -------------------------
CHART_PERIOD = ("2018-01-01", "2022-12-31")
CHART_MIN_WEEKS = 3
CHART_TOP_K = 200
TAG_ROWS = 150
MOOD_ROWS = 110
FREQUENT_MIN = 10
YEARS = (2018, 2022)
BATCH_SIZE = 50
NO_LANGUAGE = "und"  # unreliable detection (never "no": that is Norwegian)
# chart entities kept: nine developed countries, nine developing ones, the world chart
CHART_MEMBERS = ["gb", "jp", "ca", "sg", "au", "no", "be", "hk", "us",
                 "ar", "th", "br", "hn", "my", "ph", "mx", "bg", "tr", "global"]
DEVELOPED_NAMES = ["United Kingdom", "Japan", "Canada", "Singapore", "Australia", "Norway",
                   "Belgium", "Hong Kong", "United States"]
# -------------------------------------------------------------------------------

ITEM_KEYS = ["country", "year", "track_id", "name", "artists", "duration",
             "artist_genres", "explicit"]
TOP_COLUMNS = ITEM_KEYS + ["total_streams", "weeks_on_chart", "average_streams", "rank"]


def chart_top_k(chart: DataFrame, *, members: Sequence[str] | DataFrame | None = None,
                start: str = CHART_PERIOD[0], end: str = CHART_PERIOD[1],
                min_weeks: int = CHART_MIN_WEEKS, k: int = CHART_TOP_K) -> DataFrame:
    """A2-A6 on weekly chart rows: period, totals, threshold, de-duplication,
    top k per country-year (ties kept)."""
    c = period.in_period(chart, "date", start, end,
                         member_col="country" if members is not None else None, members=members)
    t = period.min_appearances(period.period_totals(c, ITEM_KEYS, "streams"), min_weeks)
    best = ranking.keep_best(t, ["country", "year", "name", "artists"],
                             [F.col("total_streams").desc(), "track_id"])
    return ranking.top_k(best, ["country", "year"], [F.col("average_streams").desc()], k) \
        .select(*TOP_COLUMNS)


def chart_job(spark: SparkSession, chart_csv: str, output: str,
              members: Sequence[str] | None = tuple(CHART_MEMBERS), **params) -> None:
    """Weekly chart CSV -> top-k chart CSV, globally ordered by
    (country, year, rank) across many files (no single-task write).
    ``members=None`` keeps every country."""
    top = chart_top_k(io.read_chart(spark, chart_csv),
                      members=list(members) if members is not None else None, **params)
    io.export_sorted_csv(top, output, ["country", "year", "rank"])


def read_top_chart(spark: SparkSession, path: str) -> DataFrame:
    return io.read_csv(spark, path, io.TOP_CHART_SCHEMA)


def genre_remap_job(spark: SparkSession, curated_csv: str, output: str,
                    mapping: Mapping[str, str] | DataFrame) -> None:
    """B1 B2: curated (country, year, name, artists, rank, genre) -> counts
    per (year, country, genre), stored per country."""
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("country", T.StringType()), ("year", T.IntegerType()), ("name", T.StringType()),
        ("artists", T.StringType()), ("rank", T.IntegerType()), ("genre", T.StringType()))])
    songs = io.read_csv(spark, curated_csv, schema)
    counts = labels.count_by(labels.remap_values(songs, "genre", mapping),
                             ["year", "country", "genre"])
    io.publish_partitioned(counts, output, ["country"])


def genre_tag_counts(top: DataFrame, patterns: Mapping[str, str], *, n: int = TAG_ROWS,
                     counted: Sequence[str] | None = None) -> DataFrame:
    """First n labelled rows per country-year, pattern tags, residual
    label, flag counts, non-flag complement, long form."""
    rows = ranking.first_n_rows(labels.drop_unlabelled(top, "artist_genres", ["explicit"]),
                                ["country", "year"], ["rank", "track_id"], n)
    tags = list(patterns)
    tagged = labels.residual_label(labels.tag_by_pattern(
        rows.select("year", "country", "artist_genres", "explicit"), "artist_genres", patterns),
        list(counted or tags), "other")
    wide = labels.count_flags(tagged, ["year", "country"], tags + ["other", "explicit"],
                              total="__n")
    wide = wide.withColumn("non-explicit", labels.complement_count("__n", "explicit")).drop("__n")
    return reshape.to_long(wide, ["year", "country"], tags + ["other", "explicit", "non-explicit"],
                           "genre", "count")


def genre_tag_job(spark: SparkSession, top_csv: str, output: str,
                  patterns: Mapping[str, str], n: int = TAG_ROWS) -> None:
    long = genre_tag_counts(read_top_chart(spark, top_csv), patterns, n=n)
    io.publish_partitioned(long, output, ["country"])


def indicator_facts(spark: SparkSession, indicator_dirs: Mapping[str, str],
                    global_series: Mapping[str, str], outcome_csv: str,
                    developed: Sequence[str] = tuple(DEVELOPED_NAMES), *,
                    years: tuple[int, int] = YEARS) -> DataFrame:
    """Per-entity indicator files (``code_name.csv``: year text,
    value), per-year global series (``year,value``), an outcome file
    (``country,year,value``) -> one fact row per country-year."""
    lo, hi = years
    ind_schema = T.StructType([T.StructField("year_string", T.StringType()),
                               T.StructField("value", T.DoubleType())])
    frames = []
    for name, path in indicator_dirs.items():
        f = io.read_entity_files(spark, path, ind_schema, header=False)
        frames.append(facts.clean_years(f, lo, hi).withColumnRenamed("value", name))
    econ = facts.join_indicators(frames, ["year", "country_code", "country"])
    g_schema = T.StructType([T.StructField("year", T.IntegerType()),
                             T.StructField("value", T.DoubleType())])
    for name, path in global_series.items():
        g = io.read_csv(spark, path, g_schema, header=False).withColumnRenamed("value", name)
        econ = facts.attach_global_series(econ, g, "year")
    econ = materialize(econ)  # entities x years; read by the restriction and the merge
    o_schema = T.StructType([T.StructField("country", T.StringType()),
                             T.StructField("year", T.IntegerType()),
                             T.StructField("outcome", T.DoubleType())])
    outcome = io.read_csv(spark, outcome_csv, o_schema, header=False)
    known = facts.restrict_to_known(outcome, econ, "country", period="year", lo=lo, hi=hi)
    merged = facts.merge_outcome(econ, known, ["year", "country"])
    return facts.membership_flag(merged, "country", list(developed), "developed_country")


def indicator_job(spark: SparkSession, output: str, **kw) -> None:
    out = indicator_facts(spark, **kw)
    cols = ["year", "country", "country_code", "developed_country"] + \
        [c for c in out.columns if c not in ("year", "country", "country_code", "developed_country")]
    io.publish_partitioned(out, output, ["country_code"], cols=cols)


def text_match_job(spark: SparkSession, top_csv: str, corpus_csv: str, matched_out: str,
                   batches_out: str, *, exclude_tag: str = "misc",
                   batch_size: int = BATCH_SIZE) -> None:
    """Distinct items, corpus assembled per id and matched by title;
    matched texts as JSON; items without a text as a work queue in batches
    (CSV partitioned by batch_id)."""
    items = materialize(enrich.distinct_items(read_top_chart(spark, top_csv),
                                              ["track_id", "artists", "name"]))
    corpus = io.read_text_corpus(spark, corpus_csv)
    # only documents with a wanted title are assembled; parts are ordered by their text
    wanted = items.select(F.col("name").alias("title")).distinct()
    ids = corpus.join(wanted, "title", "left_semi").select("id").distinct()
    docs = enrich.assemble_text(corpus.join(ids, "id", "left_semi"), "id", "lyrics", ["lyrics"], exclude=("tag", [exclude_tag]),
                                keep_max=["title", "language"], parts=None)
    by_title = docs.groupBy("title").agg(
        F.expr("listagg(lyrics, ' ') WITHIN GROUP (ORDER BY id)").alias("lyrics"),
        F.max("language").alias("language"))
    m = items.join(by_title, items["name"] == by_title["title"], "left").drop("title")
    matched = (m.filter(F.col("lyrics").isNotNull() & F.col("language").isNotNull())
               .groupBy("track_id").agg(
                   F.expr("listagg(lyrics, ' ') WITHIN GROUP (ORDER BY name, artists)").alias("lyrics"),
                   F.max("language").alias("language")))
    matched.write.mode("overwrite").json(matched_out)
    rest = enrich.without_match(items, matched, "track_id").select(
        "track_id", "name", first_of_list_literal("artists").alias("new_artist"))
    queue = batching.assign_batches(rest, batch_size, ["track_id"])
    io.publish_partitioned(queue, batches_out, ["batch_id"], fmt="csv", header="true")


def language_job(spark: SparkSession, texts_json: str, lists_out: str, parquet_out: str, *,
                 n: int = FREQUENT_MIN, sentinel: str = NO_LANGUAGE) -> None:
    """Distinct and frequent languages (CSV), texts of frequent
    languages as JSON and as Parquet partitioned by language."""
    df = io.read_json(spark, texts_json)
    language.distinct_values(df, "language", sentinel).write.mode("overwrite") \
        .option("header", "true").csv(f"{lists_out}/languages")
    language.frequent_values(df, "language", n, sentinel).write.mode("overwrite") \
        .option("header", "true").csv(f"{lists_out}/frequent")
    keep = language.keep_frequent(df, "language", "lyrics", n, sentinel)
    io.publish_text(keep, f"{lists_out}/texts", parquet_out)


def mood_job(spark: SparkSession, texts_parquet: str, output: str,
             routes: Mapping[str, str] | None = None, *, size: int = 512,
             threshold: float = 0.75) -> None:
    """Moods for every routed language in one job. Without ``routes``
    the fixed per-language table applies (label rule and chunking per
    language); ``routes`` maps language -> 'stars' / 'binary_threshold' for
    the lexicon scorer with ``size``-character chunks."""
    df = io.read_partitioned(spark, texts_parquet).filter(F.col("lyrics").isNotNull())
    if routes is None:
        chunks = sentiment.explode_chunks_by_language(df, "lyrics", "language")
        scored = sentiment.score_chunks_lexicon(chunks)
        raw = sentiment.raw_label_by_language("language")
        label = sentiment.normalise_by_language("__raw", "score", "language", threshold=threshold)
        scored = scored.withColumn("__raw", raw).withColumn("chunk_label", label)
    else:
        routed = sentiment.route_by_language(df, "language", routes)
        chunks = sentiment.explode_chunks(routed, "lyrics", size=size)
        scored = sentiment.score_chunks_lexicon(chunks)
        label = (F.when(F.col("route") == "stars", normalise_label("stars", rule="stars"))
                 .when(F.col("route") == "binary_threshold",
                       normalise_label("label", "score", "binary_threshold", threshold=threshold)))
        scored = scored.withColumn("chunk_label", label)
    counted = sentiment.count_labels(scored, ["track_id", "language"], "chunk_label")
    io.publish_partitioned(sentiment.vote(counted).select("track_id", "language", "mood"),
                           output, ["language"])


def mood_outcome_job(spark: SparkSession, moods_parquet: str, top_csv: str, facts_parquet: str,
                     output: str, *, n: int = MOOD_ROWS) -> None:
    """H2-H6: mood counts of n sampled tracks per country-year against the
    outcome, one CSV (a reduced table)."""
    moods = io.read_partitioned(spark, moods_parquet)
    top = read_top_chart(spark, top_csv)
    joined = enrich.label_items(top.select("country", "year", "track_id"),
                                moods.select("track_id", "mood"), "track_id", "mood")
    sample = ranking.sample_n_per_group(joined, ["country", "year"], ["track_id"], n)
    wide = reshape.label_counts_wide(sample, ["year", "country"], "mood",
                                     ["positive", "neutral", "negative"], "track_id")
    f = io.read_partitioned(spark, facts_parquet)
    out = wide.join(f, (wide["country"] == f["country_code"]) & (wide["year"] == f["year"])) \
        .select(wide["year"], f["country"], "positive", "neutral", "negative", "outcome",
                "developed_country")
    io.export_single_csv(out, output)


def genre_indicator_job(spark: SparkSession, genre_parquet: str, facts_parquet: str,
                        output: str, label_values: Sequence[str],
                        labels_excluded: Sequence[str] = ("explicit", "non-explicit")) -> None:
    """Winner per country-year, winner frequency, top-3 labels, wide
    table joined to the facts, correlation matrix (all as CSV). The label
    list fixes the pivot columns (no discovery job, stable schema)."""
    g = io.read_partitioned(spark, genre_parquet)
    win = ranking.argmax_by(g, ["country", "year"], "genre", "count", "top_genre")
    ranking.winner_frequency(win, "top_genre", "year", "n_countries") \
        .write.mode("overwrite").csv(f"{output}/winner_frequency")
    ranking.top_k_labels(g, ["country", "year"], "count", 3, label="genre",
                         exclude=list(labels_excluded)).write.mode("overwrite").csv(f"{output}/top3")
    wide = reshape.to_wide(g, ["year", "country"], "genre", "count", list(label_values), fill=0)
    f = io.read_partitioned(spark, facts_parquet)
    rates = [c for c, t in f.dtypes if t in ("int", "bigint", "double", "boolean") and c != "year"]
    numeric = [c for c in wide.columns if c not in ("year", "country")] + rates
    joined = wide.join(f, (wide["country"] == f["country_code"]) & (wide["year"] == f["year"])) \
        .select(*[wide[c] for c in wide.columns], *[f[c] for c in rates])
    stats.correlation_matrix(joined, numeric).write.mode("overwrite").option("header", "true") \
        .csv(f"{output}/correlation")


def language_distribution_job(spark: SparkSession, texts_parquet: str, top_csv: str,
                              output: str, names: Mapping[str, str] | None = None,
                              years: Sequence[int] = tuple(range(YEARS[0], YEARS[1] + 1))) -> None:
    """Language counts per country-year, global heatmap matrix
    (with and without English) and log weights (CSV)."""
    lang = io.read_partitioned(spark, texts_parquet).select("track_id", "language")
    top = read_top_chart(spark, top_csv)
    lab = enrich.label_items(top.select("track_id", "year", "country", "rank"), lang,
                             "track_id", "language", sentinel=NO_LANGUAGE)
    dist = materialize(distribution.label_distribution(lab, ["year", "country", "language"]))
    tidy = enrich.decode_dimension(dist, "language", dict(names or {}))
    tidy = enrich.decode_dimension(tidy, "country", {}, special={"global": "Global"})
    dist.write.mode("overwrite").option("header", "true").csv(f"{output}/distribution")
    glob = distribution.subset(tidy, "country", "Global")
    reshape.heatmap_matrix(glob, "language", "year", "track_count", list(years)) \
        .orderBy(F.col("row_total").desc(), "language") \
        .write.mode("overwrite").option("header", "true").csv(f"{output}/heatmap")
    reshape.heatmap_matrix(distribution.exclude(glob, "language", "English"), "language", "year",
                           "track_count", list(years)) \
        .orderBy(F.col("row_total").desc(), "language") \
        .write.mode("overwrite").option("header", "true").csv(f"{output}/heatmap_no_en")
    distribution.log_weights(tidy, "country", "language", "track_count") \
        .write.mode("overwrite").option("header", "true").csv(f"{output}/weights")


JOBS = {
    "chart": chart_job,
    "genre-remap": genre_remap_job,
    "genre-tags": genre_tag_job,
    "indicators": indicator_job,
    "text-match": text_match_job,
    "languages": language_job,
    "moods": mood_job,
    "mood-outcome": mood_outcome_job,
    "genre-indicators": genre_indicator_job,
    "language-distribution": language_distribution_job,
}


def _arg(text: str):
    """Command-line value: JSON objects / lists (mappings, label lists) and
    plain numbers are decoded, everything else stays text."""
    import json
    import re

    if text[:1] in "{[":
        return json.loads(text)
    if re.fullmatch(r"-?\d+", text):
        return int(text)
    if re.fullmatch(r"-?\d+\.\d*", text):
        return float(text)
    return text


def main(argv: Sequence[str]) -> None:
    """``python -m ridgeline.plans.jobs <job> arg ... [key=value ...]``;
    values that look like JSON objects or lists are decoded."""
    from ridgeline.session import get_session

    if not argv or argv[0] not in JOBS:
        raise SystemExit(f"usage: python -m ridgeline.plans.jobs {{{','.join(JOBS)}}} args...")
    pos = [_arg(a) for a in argv[1:] if "=" not in a.split("/")[0] or a.startswith("{")]
    kw = {a.split("=", 1)[0]: _arg(a.split("=", 1)[1]) for a in argv[1:]
          if "=" in a.split("/")[0] and not a.startswith("{")}
    spark = get_session()
    try:
        JOBS[argv[0]](spark, *pos, **kw)
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
