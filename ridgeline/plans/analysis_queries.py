"""Language distribution (G1-G6), mood against the facts (H1-H5) and the
statistics on the fact table (I1-I8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions.distributions import f_test_p, t_test_p
from ridgeline.operators import distribution, enrich, ranking, regression, reshape, stats
from ridgeline.operators.facts import display_name
from ridgeline.plans import views
from ridgeline.plans.chart_queries import CHART_CTES, chart_top
from ridgeline.plans.registry import register, with_ctes
from ridgeline.session import materialize
from ridgeline.plans.text_queries import MOODS_SQL, moods
from ridgeline.sources.tables import table

# ---- fixed values ----------------------------------------------------------
LANGUAGE_NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish",
                  "it": "Italian", "pt": "Portuguese", "nl": "Dutch"}
GLOBAL_CODE, GLOBAL_NAME = "global", "Global"
UNKNOWN_LANGUAGE = "und"
YEARS = [1996, 1997, 1998, 1999, 2000]
MOOD_SAMPLE = 10  # tracks per country-year used for the mood counts
MOODS = ["positive", "neutral", "negative"]
FACT_MEASURES = ["gdp_per_capita", "inflation_rate", "unemployment_rate", "happiness"]
# Quantiles of 6-decimal inputs carry up to 8 decimals; reported at 4.
QUANTILE_DIGITS = 4
# ----------------------------------------------------------------------------


# ------------------------------------------------------------ language (G)
def labelled_chart(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", ["doc_id", "lang"]).select(
        F.col("doc_id").alias("track_id"), F.col("lang").alias("language"))
    return enrich.label_items(chart_top(spark, d).select("track_id", "year", "country", "rank"),
                              docs, "track_id", "language", sentinel=UNKNOWN_LANGUAGE)


def lang_dist(spark: SparkSession, d: str) -> DataFrame:
    return distribution.label_distribution(labelled_chart(spark, d),
                                           ["year", "country", "language"])


def lang_tidy(spark: SparkSession, d: str) -> DataFrame:
    """Per-country and whole-chart ('global') counts with display names."""
    # Per-country counts are small (countries x years x languages) and read
    # twice: materialise them, and add them up for the whole chart instead of
    # counting the chart rows again.
    per = materialize(distribution.label_distribution(labelled_chart(spark, d),
                                                      ["year", "country", "language"]))
    glob = per.groupBy("year", "language").agg(F.sum("track_count").alias("track_count")) \
        .withColumn("country", F.lit(GLOBAL_CODE))
    both = per.unionByName(glob)
    nations = table(spark, d, "nation", ["n_name"]).select(
        F.col("n_name").alias("code"), display_name("n_name").alias("name"))
    dec = enrich.decode_dimension(both, "country", nations, special={GLOBAL_CODE: GLOBAL_NAME})
    return enrich.decode_dimension(dec, "language", LANGUAGE_NAMES)


LANG_SQL = f"""
labelled AS (
  SELECT t.track_id, t.year, t.country, t.rank, d.lang AS language
  FROM topk t JOIN documents d ON t.track_id = d.doc_id WHERE d.lang <> '{UNKNOWN_LANGUAGE}'
),
lang_dist AS (
  SELECT year, country, language, count(*) AS track_count FROM labelled
  GROUP BY year, country, language
),
lang_both AS (
  SELECT * FROM lang_dist
  UNION ALL
  SELECT year, '{GLOBAL_CODE}' AS country, language, count(*) AS track_count FROM labelled
  GROUP BY year, language
),
lang_tidy AS (
  SELECT b.year,
         CASE WHEN b.country = '{GLOBAL_CODE}' THEN '{GLOBAL_NAME}'
              ELSE coalesce(replace(upper(substr(n.n_name, 1, 1)) || lower(substr(n.n_name, 2)), '_', ' '),
                            b.country) END AS country,
         CASE {' '.join(f"WHEN b.language = '{k}' THEN '{v}'" for k, v in LANGUAGE_NAMES.items())}
              ELSE b.language END AS language,
         b.track_count
  FROM lang_both b LEFT JOIN nation n ON b.country = n.n_name
)"""


def _heat_sql(extra_where: str = "") -> str:
    cells = ", ".join(
        f'CAST(coalesce(avg(CASE WHEN year = {y} THEN track_count END), 0) AS DOUBLE) AS "{y}"'
        for y in YEARS)
    total = " + ".join(f'"{y}"' for y in YEARS)
    return (f"SELECT *, CAST({total} AS DOUBLE) AS row_total FROM ("
            f"SELECT language, {cells} FROM lang_tidy "
            f"WHERE country = '{GLOBAL_NAME}' {extra_where} GROUP BY language)")


@register("lang_distribution", with_ctes(*CHART_CTES, LANG_SQL, body="SELECT * FROM lang_dist"))
def q_lang_distribution(spark, d):
    return lang_dist(spark, d)


@register("lang_heatmap", with_ctes(*CHART_CTES, LANG_SQL, body=_heat_sql()))
def q_lang_heatmap(spark, d):
    g = distribution.subset(lang_tidy(spark, d), "country", GLOBAL_NAME)
    return reshape.heatmap_matrix(g, "language", "year", "track_count", YEARS, agg="avg") \
        .orderBy(F.col("row_total").desc(), "language")


@register("lang_heatmap_no_en", with_ctes(*CHART_CTES, LANG_SQL,
                                          body=_heat_sql("AND language <> 'English'")))
def q_lang_heatmap_no_en(spark, d):
    g = distribution.exclude(distribution.subset(lang_tidy(spark, d), "country", GLOBAL_NAME),
                             "language", "English")
    return reshape.heatmap_matrix(g, "language", "year", "track_count", YEARS, agg="avg") \
        .orderBy(F.col("row_total").desc(), "language")


@register("lang_weights", with_ctes(*CHART_CTES, LANG_SQL, body="""
SELECT country, language, round(ln(1 + sum(track_count)), 6) AS weight
FROM lang_tidy GROUP BY country, language"""))
def q_lang_weights(spark, d):
    w = distribution.log_weights(lang_tidy(spark, d), "country", "language", "track_count")
    return w.withColumn("weight", F.round("weight", 6))


# ---------------------------------------------------------------- mood (H)
def chart_moods(spark: SparkSession, d: str, top: DataFrame) -> DataFrame:
    """Moods of the chart's tracks only: the top-k track keys filter the
    documents where they are read, so only those texts are chunked and scored.
    ``top`` is a stored table: Spark knows its size, and broadcasts the keys
    only below its own limit."""
    keys = top.select(F.col("track_id").alias("doc_id"))
    docs = enrich.restrict_to_keys(table(spark, d, "documents", ["doc_id", "text", "lang"]),
                                   keys, "doc_id")
    return moods(spark, d, docs)


def mood_wide(spark: SparkSession, d: str) -> DataFrame:
    top = materialize(chart_top(spark, d).select("country", "year", "track_id"), as_table=True)
    joined = enrich.label_items(top, chart_moods(spark, d, top).select("track_id", "mood"),
                                "track_id", "mood")
    sample = ranking.sample_n_per_group(joined, ["country", "year"], ["track_id"], MOOD_SAMPLE)
    return reshape.label_counts_wide(sample, ["year", "country"], "mood", MOODS, "track_id")


def mood_facts(spark: SparkSession, d: str) -> DataFrame:
    w = mood_wide(spark, d)
    f = views.facts(spark, d)
    j = w.join(f, (w["country"] == f["country_code"]) & (w["year"] == f["year"]))
    return j.select(w["year"], f["country"], w["positive"], w["neutral"], w["negative"],
                    f["happiness"], f["developed_country"])


def mood_scores(spark: SparkSession, d: str) -> DataFrame:
    p = stats.prepare(mood_facts(spark, d), flags=["developed_country"], fill=MOODS)
    # rows sampled in the group: an under-full group still has shares of 10
    n = sum(F.col(m) for m in MOODS)
    scaled = p.select("year", "country", *[(F.col(m) / n * 10).alias(m) for m in MOODS],
                      "happiness", "developed_country")
    comb = F.col("positive") - F.col("negative")
    out = scaled.withColumn("comb", comb).withColumn("in_one", comb + 0.5 * F.col("neutral"))
    return out.select(*[F.round(c, 6).alias(c) if c in MOODS + ["comb", "in_one"] else c
                        for c in out.columns])


MOOD_N = "(coalesce(positive, 0) + coalesce(neutral, 0) + coalesce(negative, 0))"
MOOD_SQL = f"""
mood_joined AS (
  SELECT t.country, t.year, t.track_id, m.mood FROM topk t JOIN moods m ON t.track_id = m.track_id
),
mood_sample AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY country, year ORDER BY track_id) AS rn FROM mood_joined)
  WHERE rn <= {MOOD_SAMPLE}
),
mood_wide AS (
  SELECT year, country,
         {', '.join(f"CAST(sum(CASE WHEN mood = '{m}' THEN 1 END) AS BIGINT) AS {m}" for m in MOODS)}
  FROM mood_sample GROUP BY year, country
),
mood_facts AS (
  SELECT w.year, f.country, w.positive, w.neutral, w.negative, f.happiness, f.developed_country
  FROM mood_wide w JOIN facts f ON w.country = f.country_code AND w.year = f.year
),
mood_scores AS (
  SELECT year, country,
         {', '.join(f'round(coalesce({m}, 0) / {MOOD_N} * 10, 6) AS {m}' for m in MOODS)},
         happiness, developed_country,
         coalesce(nullif(round(coalesce(positive, 0) / {MOOD_N} * 10 - coalesce(negative, 0) / {MOOD_N} * 10, 6), 0), 0) AS comb,
         coalesce(nullif(round(coalesce(positive, 0) / {MOOD_N} * 10 - coalesce(negative, 0) / {MOOD_N} * 10
               + 0.5 * (coalesce(neutral, 0) / {MOOD_N} * 10), 6), 0), 0) AS in_one
  FROM mood_facts
)"""

MOOD_CTES = CHART_CTES + (MOODS_SQL, views.FACTS_SQL, MOOD_SQL)


@register("mood_coverage", with_ctes(*CHART_CTES, MOODS_SQL, body="""
SELECT t.country, t.year, count(*) AS n_rows, CAST(count_if(m.mood IS NULL) AS BIGINT) AS n_unlabelled
FROM topk t LEFT JOIN moods m ON t.track_id = m.track_id GROUP BY t.country, t.year"""))
def q_mood_coverage(spark, d):
    top = materialize(chart_top(spark, d).select("country", "year", "track_id"), as_table=True)
    return enrich.coverage(top, chart_moods(spark, d, top), "track_id", ["country", "year"], "mood")


@register("mood_wide", with_ctes(*MOOD_CTES, body="SELECT * FROM mood_wide"))
def q_mood_wide(spark, d):
    return mood_wide(spark, d)


@register("mood_facts", with_ctes(*MOOD_CTES, body="SELECT * FROM mood_facts"))
def q_mood_facts(spark, d):
    return mood_facts(spark, d)


@register("mood_scores", with_ctes(*MOOD_CTES, body="SELECT * FROM mood_scores"))
def q_mood_scores(spark, d):
    return mood_scores(spark, d)


# ---------------------------------------------------------- statistics (I)
FACTS_BODY = (views.FACTS_SQL,)


def _facts_num(spark, d):
    return views.facts(spark, d).withColumn("developed", F.col("developed_country").cast("int"))


@register("stat_summary", with_ctes(*FACTS_BODY, body=f"""
SELECT "column", round(q[1], {QUANTILE_DIGITS}) AS min, round(q[2], {QUANTILE_DIGITS}) AS q1, round(q[3], {QUANTILE_DIGITS}) AS median,
       round(q[4], {QUANTILE_DIGITS}) AS q3, round(q[5], {QUANTILE_DIGITS}) AS max, round(mean, {QUANTILE_DIGITS}) AS mean
FROM (
  SELECT "column", quantile_cont(value, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q, avg(value) AS mean
  FROM (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FACT_MEASURES)} FROM facts)
        ON {', '.join(FACT_MEASURES)} INTO NAME "column" VALUE value)
  GROUP BY "column")"""))
def q_stat_summary(spark, d):
    return stats.five_number_summary(views.facts(spark, d), FACT_MEASURES, digits=QUANTILE_DIGITS)


@register("stat_box", with_ctes(*FACTS_BODY, """
box AS (
  SELECT developed_country, count(*) AS n,
         quantile_cont(happiness, 0.25) AS q1, quantile_cont(happiness, 0.5) AS median,
         quantile_cont(happiness, 0.75) AS q3
  FROM facts WHERE happiness IS NOT NULL GROUP BY developed_country
)""", body=f"""
SELECT b.developed_country, b.n, round(b.q1, {QUANTILE_DIGITS}) AS q1, round(b.median, {QUANTILE_DIGITS}) AS median,
       round(b.q3, {QUANTILE_DIGITS}) AS q3, round(b.q3 - b.q1, {QUANTILE_DIGITS}) AS iqr,
       round(b.q1 - 1.5 * (b.q3 - b.q1), {QUANTILE_DIGITS}) AS lower_fence,
       round(b.q3 + 1.5 * (b.q3 - b.q1), {QUANTILE_DIGITS}) AS upper_fence,
       (SELECT count(*) FROM facts f WHERE f.developed_country = b.developed_country
          AND (f.happiness < b.q1 - 1.5 * (b.q3 - b.q1) OR f.happiness > b.q3 + 1.5 * (b.q3 - b.q1))
       ) AS n_outliers
FROM box b"""))
def q_stat_box(spark, d):
    return stats.group_box_stats(views.facts(spark, d), "happiness", ["developed_country"],
                                 digits=QUANTILE_DIGITS)


@register("stat_corr_groups", with_ctes(*FACTS_BODY, body=stats.correlation_matrix_sql(
    "facts", FACT_MEASURES, group=["developed_country"])))
def q_stat_corr_groups(spark, d):
    return stats.correlation_matrix(views.facts(spark, d), FACT_MEASURES,
                                    group=["developed_country"])


@register("stat_ols_simple", with_ctes(*FACTS_BODY, body=f"""
SELECT round(intercept, 6) AS intercept, round(slope, 6) AS slope, round(r2, 6) AS r2, n,
       {stats.significant_sql('(1.0 - r2) * n * vy')} AS rss, n - 2 AS df,
       round(1.0 - (1.0 - r2) * (n - 1) / (n - 2), 6) AS adj_r2
FROM (SELECT regr_intercept(happiness, CAST(developed_country AS INTEGER)) AS intercept,
             regr_slope(happiness, CAST(developed_country AS INTEGER)) AS slope,
             regr_r2(happiness, CAST(developed_country AS INTEGER)) AS r2,
             count(*) AS n, var_pop(happiness) AS vy
      FROM facts WHERE happiness IS NOT NULL AND developed_country IS NOT NULL)"""))
def q_stat_ols_simple(spark, d):
    return stats.ols_simple(_facts_num(spark, d), "happiness", "developed")


def _moments_sql(y, a, b, src, group=""):
    g = f"{group}, " if group else ""
    return (f"SELECT {g}count(*) AS n, avg({y}) AS my, avg({a}) AS ma, avg({b}) AS mb, "
            f"var_pop({y}) AS vy, var_pop({a}) AS va, var_pop({b}) AS vb, "
            f"covar_pop({a}, {b}) AS cab, covar_pop({y}, {a}) AS cya, covar_pop({y}, {b}) AS cyb "
            f"FROM {src} WHERE {y} IS NOT NULL AND {a} IS NOT NULL AND {b} IS NOT NULL"
            + (f" {'AND ' + group + ' IS NOT NULL'} GROUP BY {group}" if group else ""))


def _solution_sql(moments: str) -> str:
    return f"""SELECT *, n * (vy - b1 * cya - b2 * cyb) AS rss, my - b1 * ma - b2 * mb AS b0 FROM (
  SELECT *, (cya * vb - cyb * cab) / (CASE WHEN va * vb - cab * cab > {stats.COLLINEAR} * va * vb THEN va * vb - cab * cab END) AS b1,
            (cyb * va - cya * cab) / (CASE WHEN va * vb - cab * cab > {stats.COLLINEAR} * va * vb THEN va * vb - cab * cab END) AS b2
  FROM ({moments}))"""


OLS_Y, OLS_A, OLS_B, OLS_FLAG = "happiness", "gdp_per_capita", "unemployment_rate", "developed_country"

OLS_SQL = f"""
m0 AS ({_solution_sql(_moments_sql(OLS_Y, OLS_A, OLS_B, 'facts'))}),
per_flag AS ({_solution_sql(_moments_sql(OLS_Y, OLS_A, OLS_B, 'facts', OLS_FLAG))}),
m1 AS (
  SELECT max(CASE WHEN NOT {OLS_FLAG} THEN b0 END) AS i0, max(CASE WHEN {OLS_FLAG} THEN b0 END) AS i1,
         max(CASE WHEN NOT {OLS_FLAG} THEN b1 END) AS a0, max(CASE WHEN {OLS_FLAG} THEN b1 END) AS a1,
         max(CASE WHEN NOT {OLS_FLAG} THEN b2 END) AS c0, max(CASE WHEN {OLS_FLAG} THEN b2 END) AS c1,
         sum(rss) AS rss, CAST(sum(n) AS BIGINT) AS n, sum(n * (vy + my * my)) AS s2,
         sum(n * my) AS s1
  FROM per_flag
)"""


@register("stat_ols_two", with_ctes(*FACTS_BODY, OLS_SQL, body=f"""
SELECT round(b0, 6) AS intercept, round(b1, 6) AS {OLS_A}, round(b2, 6) AS {OLS_B},
       round(1.0 - rss / (n * vy), 6) AS r2, {stats.significant_sql('rss')} AS rss, n, n - 3 AS df,
       round(1.0 - (rss / (n * vy)) * (n - 1) / (n - 3), 6) AS adj_r2 FROM m0"""))
def q_stat_ols_two(spark, d):
    return stats.ols_two(views.facts(spark, d), OLS_Y, OLS_A, OLS_B)


@register("mood_ols_two", with_ctes(*MOOD_CTES, f"""
mm AS ({_solution_sql(_moments_sql('happiness', 'comb', 'neutral', 'mood_scores'))})""", body=f"""
SELECT round(b0, 6) AS intercept, round(b1, 6) AS comb, round(b2, 6) AS neutral,
       round(1.0 - rss / (n * vy), 6) AS r2, {stats.significant_sql('rss')} AS rss, n, n - 3 AS df,
       round(1.0 - (rss / (n * vy)) * (n - 1) / (n - 3), 6) AS adj_r2 FROM mm"""))
def q_mood_ols_two(spark, d):
    """Outcome on the mood score and the neutral share."""
    return stats.ols_two(mood_scores(spark, d), "happiness", "comb", "neutral")


# The outcome on the moods: m0 without and m1 with the flag in every term, m3 on the score of all
# moods, m4 on the flag alone. Terms of one call share one pass over the scores.
MOOD_Y, MOOD_FLAG = "happiness", "developed_country"
MOOD_MODELS = {
    "m0": ["comb", "neutral"],
    "m1": ["comb", "neutral", MOOD_FLAG, f"comb:{MOOD_FLAG}", f"neutral:{MOOD_FLAG}"],
    "m3": regression.interacted(["in_one"], MOOD_FLAG),
    "m4": [MOOD_FLAG],
}
MOOD_FIT_CTES = MOOD_CTES + tuple(regression.fits_sql("mood_scores", MOOD_Y, MOOD_MODELS, "mood"))


def _each_model(select: str) -> str:
    return " UNION ALL ".join(select.format(m=m) for m in MOOD_MODELS)


@register("mood_models", with_ctes(*MOOD_FIT_CTES, body=_each_model("""
SELECT '{m}' AS model, term, round(estimate, 6) AS estimate,
       round(sqrt(rss / (n - 1 - rank) * factor), 6) AS std_error,
       round(estimate / sqrt(rss / (n - 1 - rank) * factor), 6) AS t_value, n - 1 - rank AS df FROM mood_{m}""")))
def q_mood_models(spark, d):
    """Coefficients of every mood model, from one aggregate of the scores."""
    return regression.coefficient_table(regression.fit_models(mood_scores(spark, d), MOOD_Y, MOOD_MODELS))


@register("mood_model_fit", with_ctes(*MOOD_FIT_CTES, body=_each_model(f"""
SELECT '{{m}}' AS model, round(1 - rss / tss, 6) AS r2, round(1 - (rss / tss) * (n - 1) / (n - 1 - rank), 6) AS adj_r2,
       {stats.significant_sql('rss')} AS rss, n, n - 1 - rank AS df FROM mood_{{m}} WHERE place = 0""")))
def q_mood_model_fit(spark, d):
    return regression.model_table(regression.fit_models(mood_scores(spark, d), MOOD_Y, MOOD_MODELS))


@register("mood_anova", with_ctes(*MOOD_FIT_CTES, body=f"""
SELECT {stats.significant_sql('a.rss')} AS rss0, a.n - 1 - a.rank AS df0,
       {stats.significant_sql('b.rss')} AS rss1, b.n - 1 - b.rank AS df1,
       {stats.significant_sql('((a.rss - b.rss) / (b.rank - a.rank)) / (b.rss / (b.n - 1 - b.rank))')} AS f
FROM mood_m0 a, mood_m1 b WHERE a.place = 0 AND b.place = 0"""))
def q_mood_anova(spark, d):
    """Does the flag add to the moods? One pass, one sweep of the larger model."""
    a = regression.nested_anova(mood_scores(spark, d), MOOD_Y, MOOD_MODELS["m0"], MOOD_MODELS["m1"])
    return a.withColumns({k: F.col(k).cast("long") for k in ("df0", "df1")})


@register("mood_anova_terms", with_ctes(*MOOD_FIT_CTES, body=f"""
SELECT 'm1' AS model, CAST(place - 1 AS INTEGER) AS place, term, CAST(estimate IS NOT NULL AS INTEGER) AS df,
       CASE WHEN estimate IS NOT NULL THEN {stats.significant_sql('before - rss_after')} END AS sum_sq,
       CASE WHEN estimate IS NOT NULL THEN {stats.significant_sql('(before - rss_after) / (rss / (n - 1 - rank))')} END AS f
FROM (SELECT *, lag(rss_after) OVER (ORDER BY place) AS before FROM mood_m1) WHERE place > 0"""))
def q_mood_anova_terms(spark, d):
    """The terms of m1 one after the other."""
    fits = regression.fit_models(mood_scores(spark, d), MOOD_Y, {"m1": MOOD_MODELS["m1"]})
    return regression.sequential_anova(fits)


@register("mood_corr", with_ctes(*MOOD_CTES, body=stats.correlation_matrix_sql(
    "mood_scores", ["happiness", "positive", "neutral", "negative", "comb"], group=["developed_country"])))
def q_mood_corr(spark, d):
    """I4: correlations of the moods and the outcome per flag."""
    return stats.correlation_matrix(mood_scores(spark, d), ["happiness", "positive", "neutral", "negative", "comb"],
                                    group=["developed_country"])


@register("stat_ols_flag", with_ctes(*FACTS_BODY, OLS_SQL, body=f"""
SELECT round(i0, 6) AS intercept, round(a0, 6) AS {OLS_A}, round(c0, 6) AS {OLS_B},
       round(i1 - i0, 6) AS {OLS_FLAG}, round(a1 - a0, 6) AS "{OLS_A}:{OLS_FLAG}",
       round(c1 - c0, 6) AS "{OLS_B}:{OLS_FLAG}",
       round(1.0 - rss / (s2 - s1 * s1 / n), 6) AS r2, {stats.significant_sql('rss')} AS rss, n, n - 6 AS df,
       round(1.0 - (rss / (s2 - s1 * s1 / n)) * (n - 1) / (n - 6), 6) AS adj_r2
FROM m1"""))
def q_stat_ols_flag(spark, d):
    return stats.ols_two_by_flag(views.facts(spark, d), OLS_Y, OLS_A, OLS_B, OLS_FLAG)


@register("stat_anova", with_ctes(*FACTS_BODY, OLS_SQL, body=f"""
SELECT {stats.significant_sql('m0.rss')} AS rss0, m0.n - 3 AS df0,
       {stats.significant_sql('m1.rss')} AS rss1, m1.n - 6 AS df1,
       {stats.significant_sql('((m0.rss - m1.rss) / ((m0.n - 3) - (m1.n - 6))) / (m1.rss / (m1.n - 6))')} AS f
FROM m0, m1"""))
def q_stat_anova(spark, d):
    return fact_anova(spark, d).withColumns({k: stats.significant(F.col(k)) for k in ("rss0", "rss1", "f")})


FACT_MODELS = {"m0": [OLS_A, OLS_B], "m1": regression.interacted([OLS_A, OLS_B], OLS_FLAG)}


def fact_anova(spark: SparkSession, d: str) -> DataFrame:
    """One row rss0, df0, rss1, df1, f: both models from one pass over the facts."""
    a = regression.nested_anova(views.facts(spark, d), OLS_Y, FACT_MODELS["m0"], FACT_MODELS["m1"], digits=None)
    return a.withColumns({k: F.col(k).cast("long") for k in ("df0", "df1")})


@register("trend_series", with_ctes(*FACTS_BODY, body=f"""
SELECT country, year, series, value FROM (
  UNPIVOT (SELECT country, year, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FACT_MEASURES)}
           FROM facts)
  ON {', '.join(FACT_MEASURES)} INTO NAME series VALUE value)"""))
def q_trend_series(spark, d):
    return reshape.series_long(views.facts(spark, d), ["country", "year"], FACT_MEASURES)


@register("group_lines", with_ctes(*FACTS_BODY, body=f"""
SELECT {OLS_FLAG}, round(regr_intercept({OLS_Y}, {OLS_A}), 6) AS intercept,
       round(regr_slope({OLS_Y}, {OLS_A}), 6) AS slope, round(regr_r2({OLS_Y}, {OLS_A}), 6) AS r2,
       count(*) AS n,
       {stats.significant_sql(f'(1.0 - regr_r2({OLS_Y}, {OLS_A})) * count(*) * var_pop({OLS_Y})')} AS rss,
       count(*) - 2 AS df,
       round(1.0 - (1.0 - regr_r2({OLS_Y}, {OLS_A})) * (count(*) - 1) / (count(*) - 2), 6) AS adj_r2
FROM facts WHERE {OLS_Y} IS NOT NULL AND {OLS_A} IS NOT NULL GROUP BY {OLS_FLAG}"""))
def q_group_lines(spark, d):
    return stats.ols_simple(views.facts(spark, d), OLS_Y, OLS_A, group=[OLS_FLAG])


# ------------------------------------------------------------- inference
def _inference_sql() -> str:
    y, a, b, fl = OLS_Y, OLS_A, OLS_B, OLS_FLAG

    def fit(group: str = "") -> str:
        m = _moments_sql(y, a, b, "facts", group)
        return f"""SELECT *, (1.0 / n + ma * ma * a11 + mb * mb * a22 + 2 * ma * mb * a12) AS v0 FROM (
  SELECT *, my - b1 * ma - b2 * mb AS b0, n * (vy - b1 * cya - b2 * cyb) AS rss,
         vb / (n * det) AS a11, va / (n * det) AS a22, -cab / (n * det) AS a12 FROM (
    SELECT *, (cya * vb - cyb * cab) / det AS b1, (cyb * va - cya * cab) / det AS b2 FROM (
      SELECT *, va * vb - cab * cab AS det FROM ({m}))))"""

    keys = ["b0", "b1", "b2", "rss", "a11", "a22", "v0", "n"]
    piv = ", ".join(f"max(CASE WHEN {v} {fl} THEN {k_} END) AS {k_}_{i}"
                    for k_ in keys for i, v in ((0, "NOT"), (1, "")))
    return f"""
inf0 AS (SELECT *, rss / (n - 3) AS s2 FROM ({fit()})),
infg AS (SELECT *, (rss_0 + rss_1) / (n_0 + n_1 - 6) AS s2, n_0 + n_1 - 6 AS dfree
         FROM (SELECT {piv} FROM ({fit(fl)}))),
inf_rows AS (
  SELECT 'm0' AS model, '(intercept)' AS term, b0 AS est, s2 * v0 AS var, n - 3 AS df FROM inf0
  UNION ALL SELECT 'm0', '{a}', b1, s2 * a11, n - 3 FROM inf0
  UNION ALL SELECT 'm0', '{b}', b2, s2 * a22, n - 3 FROM inf0
  UNION ALL SELECT 'm1', '(intercept)', b0_0, s2 * v0_0, dfree FROM infg
  UNION ALL SELECT 'm1', '{a}', b1_0, s2 * a11_0, dfree FROM infg
  UNION ALL SELECT 'm1', '{b}', b2_0, s2 * a22_0, dfree FROM infg
  UNION ALL SELECT 'm1', '{fl}', b0_1 - b0_0, s2 * (v0_0 + v0_1), dfree FROM infg
  UNION ALL SELECT 'm1', '{a}:{fl}', b1_1 - b1_0, s2 * (a11_0 + a11_1), dfree FROM infg
  UNION ALL SELECT 'm1', '{b}:{fl}', b2_1 - b2_0, s2 * (a22_0 + a22_1), dfree FROM infg
)"""


def inference(spark: SparkSession, d: str, digits: int | None = 6) -> DataFrame:
    """Coefficients of both models, from one aggregate of the facts."""
    return regression.coefficient_table(regression.fit_models(views.facts(spark, d), OLS_Y, FACT_MODELS), digits=digits)


@register("stat_ols_inference", with_ctes(*FACTS_BODY, _inference_sql(), body="""
SELECT model, term, round(est, 6) AS estimate, round(sqrt(var), 6) AS std_error,
       round(est / sqrt(var), 6) AS t_value, CAST(df AS BIGINT) AS df
FROM inf_rows"""))
def q_stat_ols_inference(spark, d):
    return inference(spark, d)


TAIL_STEPS = 20_000  # of the midpoint rule in the oracle's F tail


def f_tail_sql(f: str, d1: str, d2: str) -> str:
    """P(F_{d1,d2} >= f) by quadrature, for the oracle: with u = cos^2 the incomplete
    beta integral becomes one of powers of cosine and sine over a finite range.
    A two-sided t tail is the case f = t^2, d1 = 1."""
    lo = f"atan(sqrt({d1} * ({f}) / {d2}))"
    step = f"((pi() / 2 - {lo}) / {TAIL_STEPS})"
    at = f"({lo} + (i + 0.5) * {step})"
    front = f"2 * exp(lgamma(({d1} + {d2}) / 2.0) - lgamma({d1} / 2.0) - lgamma({d2} / 2.0))"
    return (f"round({front} * sum(pow(cos({at}), {d2} - 1) * pow(sin({at}), {d1} - 1)"
            f" * {step}), 6)")


@register("stat_ols_pvalues", with_ctes(*FACTS_BODY, _inference_sql(), body=f"""
SELECT model, term, round(est, 6) AS estimate, round(t, 6) AS t_value, CAST(df AS BIGINT) AS df,
       {f_tail_sql('t * t', '1', 'df')} AS p_value
FROM (SELECT *, est / sqrt(var) AS t FROM inf_rows), range({TAIL_STEPS}) r(i)
GROUP BY model, term, est, t, df"""))
def q_stat_ols_pvalues(spark, d):
    inf = inference(spark, d, digits=None)
    return inf.select("model", "term", F.round("estimate", 6).alias("estimate"),
                      F.round("t_value", 6).alias("t_value"), "df",
                      F.round(t_test_p(F.col("t_value"), F.col("df")), 6).alias("p_value"))


@register("stat_anova_pvalue", with_ctes(*FACTS_BODY, OLS_SQL, """
test AS (SELECT m0.n - 3 AS df0, m1.n - 6 AS df1,
                ((m0.rss - m1.rss) / ((m0.n - 3) - (m1.n - 6))) / (m1.rss / (m1.n - 6)) AS f FROM m0, m1)""",
                                         body=f"""
SELECT df0, df1, {stats.significant_sql('f')} AS f, {f_tail_sql('f', '(df0 - df1)', 'df1')} AS p_value
FROM test, range({TAIL_STEPS}) r(i) GROUP BY df0, df1, f"""))
def q_stat_anova_pvalue(spark, d):
    a = fact_anova(spark, d)
    p = f_test_p(F.col("f"), F.col("df0") - F.col("df1"), F.col("df1"))
    return a.select("df0", "df1", stats.significant(F.col("f")).alias("f"), F.round(p, 6).alias("p_value"))
