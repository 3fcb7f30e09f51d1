"""Chart ranking queries (A1-A7) on the ``chart`` view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators import period, quality, ranking
from ridgeline.plans import views
from ridgeline.plans.registry import register, with_ctes
from ridgeline.session import materialize

# Fixed parameters of the chart plan.
PERIOD_START, PERIOD_END = "1996-01-01", "2000-12-31"
MIN_WEEKS = 2
TOP_K = 20
ITEM_KEYS = ["country", "year", "track_id", "name", "artists", "duration",
             "artist_genres", "explicit", "genre"]
DEDUP_GROUP = ["country", "year", "name", "artists"]


def chart_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals per (country, year, track and its attributes).

    The attributes come from the track dimension and depend on track_id
    alone, so grouping by (country, year, track_id) and attaching them after
    the aggregate gives the same groups as grouping by all item keys, while
    the dimension join runs on aggregated rows instead of raw chart rows."""
    c = period.in_period(views.chart_events(spark, d), "date", PERIOD_START, PERIOD_END)
    t = period.period_totals(c, ["country", "year", "track_id"], "streams")
    return t.join(views.tracks(spark, d), "track_id").select(
        *ITEM_KEYS, "total_streams", "weeks_on_chart", "average_streams")


def chart_dedup(spark: SparkSession, d: str) -> DataFrame:
    t = period.min_appearances(chart_totals(spark, d), MIN_WEEKS)
    return ranking.keep_best(t, DEDUP_GROUP, [F.col("total_streams").desc(), "track_id"])


def chart_top(spark: SparkSession, d: str, k: int = TOP_K) -> DataFrame:
    return ranking.top_k(chart_dedup(spark, d), ["country", "year"],
                         [F.col("average_streams").desc()], k)


PERIOD_SQL = f"""
period AS (
  SELECT * , CAST(year(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS week
  FROM (SELECT * REPLACE (CAST(date AS DATE) AS date) FROM chart)
  WHERE date BETWEEN DATE '{PERIOD_START}' AND DATE '{PERIOD_END}'
)"""

TOTALS_SQL = """
totals AS (
  SELECT country, year, track_id, name, artists, duration, artist_genres, explicit, genre,
         CAST(sum(streams) AS BIGINT) AS total_streams, count(week) AS weeks_on_chart,
         CAST(sum(streams) AS BIGINT) / count(week) AS average_streams
  FROM period
  GROUP BY country, year, track_id, name, artists, duration, artist_genres, explicit, genre
)"""

DEDUP_SQL = f"""
dedup AS (
  SELECT * EXCLUDE (dup_rank) FROM (
    SELECT *, rank() OVER (PARTITION BY country, year, name, artists
                           ORDER BY total_streams DESC NULLS LAST, track_id ASC NULLS FIRST) AS dup_rank
    FROM totals WHERE weeks_on_chart >= {MIN_WEEKS})
  WHERE dup_rank = 1
)"""

TOPK_SQL = f"""
topk AS (
  SELECT * FROM (
    SELECT *, CAST(rank() OVER (PARTITION BY country, year
                                ORDER BY average_streams DESC NULLS LAST) AS INTEGER) AS rank
    FROM dedup)
  WHERE rank <= {TOP_K}
)"""

CHART_CTES = (views.CHART_SQL, PERIOD_SQL, TOTALS_SQL, DEDUP_SQL, TOPK_SQL)


@register("chart_period_totals", with_ctes(*CHART_CTES[:3], body="SELECT * FROM totals"))
def q_chart_period_totals(spark, d):
    return chart_totals(spark, d)


@register("chart_dedup_best", with_ctes(*CHART_CTES[:4], body="SELECT * FROM dedup"))
def q_chart_dedup_best(spark, d):
    return chart_dedup(spark, d)


@register("chart_topk", with_ctes(*CHART_CTES, body="SELECT * FROM topk"))
def q_chart_topk(spark, d):
    return chart_top(spark, d)


@register("chart_quality", with_ctes(*CHART_CTES[:3], """
dups AS (
  SELECT country, year, name, artists, count(*) AS n_rows
  FROM totals WHERE weeks_on_chart >= 2
  GROUP BY country, year, name, artists HAVING count(*) > 1
)""", body="""
SELECT t.country, t.year, t.name, t.artists, t.track_id, t.total_streams, t.weeks_on_chart,
       d.n_rows
FROM totals t JOIN dups d USING (country, year, name, artists)
WHERE t.weeks_on_chart >= 2"""))
def q_chart_quality(spark, d):
    # The totals are read twice (duplicate keys, rows behind them): write
    # them once instead of repeating the line-item join and aggregate. The
    # self-join stays an aggregate + join (skew-safe under AQE) rather than
    # a window over a possibly hot key.
    t = materialize(period.min_appearances(chart_totals(spark, d), MIN_WEEKS))
    return quality.rows_behind_duplicates(t, DEDUP_GROUP).select(
        "country", "year", "name", "artists", "track_id", "total_streams",
        "weeks_on_chart", "n_rows")


@register("chart_group_sizes", with_ctes(*CHART_CTES, body="""
SELECT country, year, count(*) AS n_rows FROM topk GROUP BY country, year"""))
def q_chart_group_sizes(spark, d):
    """Rows kept per country-year (can exceed k through ties)."""
    return quality.rows_per_group(chart_top(spark, d), ["country", "year"])
