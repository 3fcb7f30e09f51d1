"""Genre labelling and counting (B1-B9), fact table (C2-C7) and the genre
vs indicator analysis (F1-F7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators import facts as fx
from ridgeline.operators import labels, ranking, reshape, stats
from ridgeline.plans import views
from ridgeline.plans.chart_queries import CHART_CTES, chart_top
from ridgeline.plans.registry import register, with_ctes

# ---- fixed values of the genre plan --------------------------------------
# Curated single genre remapping (exact, case-sensitive, single pass).
GENRE_REMAP = {
    "ECONOMY": "Budget",
    "PROMO": "Budget",
    "SMALL": "Compact",
    "MEDIUM": "STANDARD",
    "STANDARD": "Regular",
}
CURATED_TOP = 10  # curated genres exist for the first 10 ranks
FIRST_N = 15  # rows per country-year used for tagging
# Tag label -> partial, case-sensitive pattern over the genre list literal.
TAG_PATTERNS = {
    "warm": "hot|red",
    "cool": "cold|blue",
    "vintage": "old",
    "big": "large|medium",
    "tiny": "small",
    "budget": "economy|promo",
    "fastener": "bolt|rod",
    "tool": "anvil|gear",
    "kitchen": "plate",
    "gadget": "gizmo|widget",
}
TAGS = list(TAG_PATTERNS)
COUNTED = TAGS + ["other", "explicit", "non_explicit"]
NON_LABELS = ["explicit", "non_explicit"]
# --------------------------------------------------------------------------


def remap_counts(spark: SparkSession, d: str) -> DataFrame:
    curated = chart_top(spark, d).filter(F.col("rank") <= CURATED_TOP) \
        .select("country", "year", "name", "artists", "rank", "genre")
    return labels.count_by(labels.remap_values(curated, "genre", GENRE_REMAP),
                           ["year", "country", "genre"])


def first_rows(spark: SparkSession, d: str) -> DataFrame:
    top = labels.drop_unlabelled(chart_top(spark, d), "artist_genres", ["explicit"])
    return ranking.first_n_rows(top, ["country", "year"], ["rank", "track_id"], FIRST_N)


def tag_counts_wide(spark: SparkSession, d: str) -> DataFrame:
    rows = first_rows(spark, d).select("year", "country", "artist_genres", "explicit")
    tagged = labels.residual_label(labels.tag_by_pattern(rows, "artist_genres", TAG_PATTERNS),
                                   TAGS, "other")
    counts = labels.count_flags(tagged, ["year", "country"], TAGS + ["other", "explicit"],
                                total="__n")
    return counts.withColumn("non_explicit", labels.complement_count("__n", "explicit")) \
        .drop("__n")


def tag_counts_long(spark: SparkSession, d: str) -> DataFrame:
    return reshape.to_long(tag_counts_wide(spark, d), ["year", "country"], COUNTED,
                           "genre", "count")


def genre_wide(spark: SparkSession, d: str) -> DataFrame:
    return reshape.to_wide(tag_counts_long(spark, d), ["year", "country"], "genre", "count",
                           COUNTED, fill=0)


RATES = ["gdp_per_capita", "inflation_rate", "unemployment_rate"]


def with_rates(counts: DataFrame, facts: DataFrame, labels_: list[str]) -> DataFrame:
    """counts per country code and year beside that country's name, flag and rates."""
    on = (counts["country"] == facts["country_code"]) & (counts["year"] == facts["year"])
    return counts.join(facts, on).select(counts["year"], facts["country"], *[counts[c] for c in labels_],
                                         facts["developed_country"], *[facts[r] for r in RATES])


def genre_facts(spark: SparkSession, d: str) -> DataFrame:
    return with_rates(genre_wide(spark, d), views.facts(spark, d), COUNTED)


CORR_COLS = COUNTED + ["developed_country", *RATES]
SERIES = TAGS + ["other"]

# ------------------------------------------------------------------ SQL
REMAP_CASE = "CASE " + " ".join(f"WHEN genre = '{k}' THEN '{v}'" for k, v in GENRE_REMAP.items()) \
    + " ELSE genre END"
REMAP_SQL = f"""
remapped AS (
  SELECT year, country, {REMAP_CASE} AS genre FROM topk WHERE rank <= {CURATED_TOP}
),
remap_counts AS (
  SELECT year, country, genre, count(*) AS count FROM remapped GROUP BY year, country, genre
)"""

_TAG_COLS = ",\n         ".join(
    f"coalesce(regexp_matches(artist_genres, '{p}'), false) AS {t}" for t, p in TAG_PATTERNS.items())
TAG_SQL = f"""
firstn AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY country, year
                                 ORDER BY rank ASC NULLS FIRST, track_id ASC NULLS FIRST) AS rn
    FROM topk WHERE artist_genres <> '[]' AND explicit IS NOT NULL)
  WHERE rn <= {FIRST_N}
),
tagged AS (
  SELECT year, country, explicit,
         {_TAG_COLS}
  FROM firstn
),
flagged AS (
  SELECT *, coalesce(NOT ({' OR '.join(TAGS)}), false) AS other FROM tagged
),
tag_wide AS (
  SELECT year, country,
         {', '.join(f'CAST(count_if({t}) AS BIGINT) AS {t}' for t in TAGS + ['other', 'explicit'])},
         CAST(count(*) - count_if(explicit) AS BIGINT) AS non_explicit
  FROM flagged GROUP BY year, country
),
tag_long AS (
  SELECT year, country, genre, count FROM (
    UNPIVOT tag_wide ON {', '.join(COUNTED)} INTO NAME genre VALUE count)
)"""

GENRE_CTES = CHART_CTES + (TAG_SQL,)

GENRE_FACTS_SQL = f"""
genre_facts AS (
  SELECT w.year, f.country,
         {', '.join('w.' + c for c in COUNTED)},
         f.developed_country, f.gdp_per_capita, f.inflation_rate,
         f.unemployment_rate
  FROM tag_wide w JOIN facts f ON w.year = f.year AND w.country = f.country_code
)"""


@register("genre_remap_counts", with_ctes(*CHART_CTES, REMAP_SQL, body="SELECT * FROM remap_counts"))
def q_genre_remap_counts(spark, d):
    return remap_counts(spark, d)


@register("genre_argmax", with_ctes(*CHART_CTES, REMAP_SQL, body="""
SELECT country, year, genre AS top_genre FROM (
  SELECT *, row_number() OVER (PARTITION BY country, year ORDER BY count DESC, genre DESC) AS rn
  FROM remap_counts) WHERE rn = 1"""))
def q_genre_argmax(spark, d):
    return ranking.argmax_by(remap_counts(spark, d), ["country", "year"], "genre", "count",
                             "top_genre")


@register("genre_winner_freq", with_ctes(*CHART_CTES, REMAP_SQL, body="""
SELECT top_genre, year, count(*) AS n_countries FROM (
  SELECT *, row_number() OVER (PARTITION BY country, year ORDER BY count DESC, genre DESC) AS rn,
         genre AS top_genre
  FROM remap_counts) WHERE rn = 1
GROUP BY top_genre, year"""))
def q_genre_winner_freq(spark, d):
    win = ranking.argmax_by(remap_counts(spark, d), ["country", "year"], "genre", "count",
                            "top_genre")
    return ranking.winner_frequency(win, "top_genre", "year", "n_countries")


@register("genre_first_n", with_ctes(*GENRE_CTES, body="""
SELECT country, year, track_id, rank, artist_genres, explicit FROM firstn"""))
def q_genre_first_n(spark, d):
    return first_rows(spark, d).select("country", "year", "track_id", "rank",
                                       "artist_genres", "explicit")


@register("genre_tag_counts", with_ctes(*GENRE_CTES, body="SELECT * FROM tag_long"))
def q_genre_tag_counts(spark, d):
    return tag_counts_long(spark, d)


@register("genre_top3", with_ctes(*GENRE_CTES, body=f"""
SELECT * FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY country, year ORDER BY count DESC) AS INTEGER) AS ranking
  FROM tag_long WHERE genre NOT IN ({', '.join(f"'{x}'" for x in NON_LABELS)}))
WHERE ranking <= 3"""))
def q_genre_top3(spark, d):
    return ranking.top_k_labels(tag_counts_long(spark, d), ["country", "year"], "count", 3,
                                label="genre", exclude=NON_LABELS)


@register("genre_pivot", with_ctes(*GENRE_CTES, body="SELECT * FROM tag_wide"))
def q_genre_pivot(spark, d):
    return genre_wide(spark, d)


@register("genre_facts", with_ctes(*GENRE_CTES, views.FACTS_SQL, GENRE_FACTS_SQL,
                                   body="SELECT * FROM genre_facts"))
def q_genre_facts(spark, d):
    return genre_facts(spark, d)


@register("genre_series", with_ctes(*GENRE_CTES, views.FACTS_SQL, GENRE_FACTS_SQL, body=f"""
SELECT country, year, series, value,
       (series IN ({', '.join(f"'{s}'" for s in SERIES)}) AND value >= 10) AS show_label
FROM (UNPIVOT (SELECT country, year,
                      {', '.join(f'CAST({s} AS DOUBLE) AS {s}' for s in SERIES)},
                      gdp_per_capita / 10000 AS gdp_per_capita_10k,
                      inflation_rate, unemployment_rate FROM genre_facts)
      ON {', '.join(SERIES)}, gdp_per_capita_10k, inflation_rate, unemployment_rate
      INTO NAME series VALUE value)"""))
def q_genre_series(spark, d):
    gf = genre_facts(spark, d).withColumn("gdp_per_capita_10k", F.col("gdp_per_capita") / 10000)
    long = reshape.series_long(gf, ["country", "year"],
                               SERIES + ["gdp_per_capita_10k", "inflation_rate",
                                         "unemployment_rate"])
    return long.withColumn("show_label", F.col("series").isin(SERIES) & (F.col("value") >= 10))


@register("genre_corr", with_ctes(*GENRE_CTES, views.FACTS_SQL, GENRE_FACTS_SQL,
                                  body=stats.correlation_matrix_sql("genre_facts", CORR_COLS)))
def q_genre_corr(spark, d):
    return stats.correlation_matrix(genre_facts(spark, d), CORR_COLS)


# ------------------------------------------------------------ fact table
@register("fact_table", with_ctes(views.FACTS_SQL, body="SELECT * FROM facts"))
def q_fact_table(spark, d):
    return views.facts(spark, d)


@register("fact_unmatched", with_ctes(views.FACTS_SQL, body="""
SELECT e.year, e.country, e.country_code FROM econ e
WHERE NOT EXISTS (SELECT 1 FROM happy h WHERE h.year = e.year AND h.country = e.country)"""))
def q_fact_unmatched(spark, d):
    sums = views.country_year_sums(spark, d)
    econ = views.econ(spark, d, sums)
    return fx.unmatched(econ, views.outcome(spark, d, sums), ["year", "country"]) \
        .select("year", "country", "country_code")


# ------------------------------------------- curated (song) genre variant
# Remapped curated genre values (the closed pivot list).
SONG_GENRES = sorted(set(GENRE_REMAP.values()) | {"LARGE"})


def song_genre_facts(spark: SparkSession, d: str) -> DataFrame:
    """F4 (song variant, absent genre -> 0) joined to the facts."""
    wide = reshape.to_wide(remap_counts(spark, d), ["year", "country"], "genre", "count",
                           SONG_GENRES, fill=0)
    return with_rates(wide, views.facts(spark, d), SONG_GENRES)


SONG_CORR_COLS = SONG_GENRES + ["developed_country", *RATES]
_SONG_CELLS = ", ".join(
    "CAST(coalesce(sum(CASE WHEN genre = '%s' THEN count END), 0) AS BIGINT) AS \"%s\"" % (g, g)
    for g in SONG_GENRES)
_SONG_COLS = ", ".join('w."%s"' % g for g in SONG_GENRES)
SONG_FACTS_SQL = f"""
song_wide AS (
  SELECT year, country, {_SONG_CELLS}
  FROM remap_counts GROUP BY year, country
),
song_facts AS (
  SELECT w.year, f.country, {_SONG_COLS},
         f.developed_country, f.gdp_per_capita, f.inflation_rate,
         f.unemployment_rate
  FROM song_wide w JOIN facts f ON w.year = f.year AND w.country = f.country_code
)"""


@register("genre_song_facts", with_ctes(*CHART_CTES, REMAP_SQL, views.FACTS_SQL, SONG_FACTS_SQL,
                                        body="SELECT * FROM song_facts"))
def q_genre_song_facts(spark, d):
    return song_genre_facts(spark, d)


@register("genre_song_corr", with_ctes(*CHART_CTES, REMAP_SQL, views.FACTS_SQL, SONG_FACTS_SQL,
                                       body=stats.correlation_matrix_sql("song_facts", SONG_CORR_COLS)))
def q_genre_song_corr(spark, d):
    return stats.correlation_matrix(song_genre_facts(spark, d), SONG_CORR_COLS)
