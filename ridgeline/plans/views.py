"""Base views over the star-schema tables, each with its DuckDB twin.

Mapping (chart-like activity records):

* ``chart``: one row per line item: country = nation name of the ordering
  customer, date = order date, position = line number, streams = quantity,
  track_id = part key, name = part name, artists = list literal of the brand,
  artist_genres = list literal of (type, name), genre = part type,
  duration = size, explicit = odd size.
* ``facts``: one row per nation and year built from indicator sources
  (order value, discount, tax) plus an outcome measure (account balance of
  the ordering customers), see ``ridgeline.operators.facts``.
* ``corpus_lengths``: documents titled by the name of the part with the
  same key (text lengths only).

No broadcast hints: dimension joins are left to Catalyst / AQE, which
broadcast a side only after checking its (estimated or measured) size.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.session import materialize
from ridgeline.sources.tables import table


def chart_events(spark: SparkSession, d: str) -> DataFrame:
    """Chart rows without track attributes: (country, date, position,
    streams, track_id).

    Orders are joined to their customer and nation first (an orders-sized
    join), then the line items are joined once on the order key: the
    line-item stream is shuffled at most once, whatever the join strategy."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    n = table(spark, d, "nation", ["n_nationkey", "n_name"])
    oc = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey)
          .select("o_orderkey", "o_orderdate", "n_name"))
    return li.join(oc, li.l_orderkey == oc.o_orderkey).select(
        F.col("n_name").alias("country"),
        F.col("o_orderdate").alias("date"),
        F.col("l_linenumber").alias("position"),
        F.col("l_quantity").cast("bigint").alias("streams"),
        F.col("l_partkey").alias("track_id"),
    )


def tracks(spark: SparkSession, d: str) -> DataFrame:
    """Track attributes, one row per track_id (the part dimension)."""
    p = table(spark, d, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    return p.select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("['"), F.col("p_brand"), F.lit("']")).alias("artists"),
        F.concat(F.lit("['"), F.lower("p_type"), F.lit("', '"), F.col("p_name"), F.lit("']"))
        .alias("artist_genres"),
        F.col("p_type").alias("genre"),
        F.col("p_size").alias("duration"),
        ((F.col("p_size") % 2) == 1).alias("explicit"),
    )


def chart(spark: SparkSession, d: str) -> DataFrame:
    """One row per line item with all track attributes."""
    return chart_events(spark, d).join(tracks(spark, d), "track_id")


CHART_SQL = """
chart AS (
  SELECT n.n_name AS country, o.o_orderdate AS date, l.l_linenumber AS position,
         CAST(l.l_quantity AS BIGINT) AS streams, l.l_partkey AS track_id,
         p.p_name AS name, '[''' || p.p_brand || ''']' AS artists,
         '[''' || lower(p.p_type) || ''', ''' || p.p_name || ''']' AS artist_genres,
         p.p_type AS genre, p.p_size AS duration, (p.p_size % 2 = 1) AS explicit
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def corpus_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Text corpus (id, title, artist, text_len, language): documents titled
    by the part with the same key. Each text's length is taken where the
    documents are read, so the join with the parts moves numbers, not texts."""
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"]).select(
        "doc_id", F.length("text").alias("text_len"), "lang")
    p = table(spark, d, "part", ["p_partkey", "p_name", "p_brand"])
    return docs.join(p, docs.doc_id == p.p_partkey).select(
        F.col("doc_id").alias("id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist"), "text_len", F.col("lang").alias("language"))


CORPUS_SQL = """
corpus AS (
  SELECT d.doc_id AS id, p.p_name AS title, p.p_brand AS artist, d.source AS tag,
         d.text AS lyrics, d.lang AS language
  FROM documents d JOIN part p ON d.doc_id = p.p_partkey
)"""


# ---------------------------------------------------------------- facts
# Fixed parameters of the fact table.
DEVELOPED_REGIONS = ("AMERICA", "EUROPE")
FACT_YEARS = (1996, 2000)


def _orders_by_country(spark: SparkSession, d: str):
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    n = table(spark, d, "nation", ["n_nationkey", "n_name"])
    lo, hi = FACT_YEARS
    o = o.filter((F.col("o_orderdate") >= F.lit(datetime.date(lo, 1, 1)))
                 & (F.col("o_orderdate") < F.lit(datetime.date(hi + 1, 1, 1))))
    # customers with nations first, so that no orders-sized stream is keyed by nation
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    return (o.join(cn, o.o_custkey == cn.c_custkey)
            .select("o_orderkey", "o_custkey", "o_totalprice", "c_acctbal",
                    F.col("n_name").alias("country_code"),
                    F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")))


def country_year_sums(spark: SparkSession, d: str) -> DataFrame:
    """One pass over the orders of FACT_YEARS and the line items for every fact
    source. Every figure is per year, so the range is applied at the orders scan.

    Line items are first summed per order (partial aggregation shrinks them
    before any shuffle), then left-joined to orders with their customer and
    nation (an orders-sized join), summed per customer-year (each buyer once
    for the outcome) and per country-year. Exact DECIMAL sums and counts;
    countries x years rows, written once to the shared checkpoint folder.
    """
    li = table(spark, d, "lineitem", ["l_orderkey", "l_discount", "l_tax"])
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_discount").cast("decimal(18,2)")).alias("od_disc"),
        F.sum(F.col("l_tax").cast("decimal(18,2)")).alias("od_tax"),
        F.count("l_discount").alias("on_disc"), F.count("l_tax").alias("on_tax"),
        F.count(F.lit(1)).alias("on_lines"))
    oc = _orders_by_country(spark, d)
    j = oc.join(per_order, oc.o_orderkey == per_order.l_orderkey, "left")
    with_lines = F.coalesce(F.col("on_lines"), F.lit(0)) > 0
    cy = j.groupBy("o_custkey", "c_acctbal", "country_code", "y").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s_price"),
        F.count("o_totalprice").alias("n_price"),
        F.min("m").alias("m_lo"), F.max("m").alias("m_hi"),
        F.sum("od_disc").alias("s_disc"), F.sum("od_tax").alias("s_tax"),
        F.sum("on_disc").alias("n_disc"), F.sum("on_tax").alias("n_tax"),
        F.sum("on_lines").alias("n_lines"),
        F.min(F.when(with_lines, F.col("m"))).alias("lm_lo"),
        F.max(F.when(with_lines, F.col("m"))).alias("lm_hi"))
    return materialize(
        cy.groupBy("country_code", "y").agg(
            F.sum("s_price").alias("s_price"), F.sum("n_price").alias("n_price"),
            F.min("m_lo").alias("m_lo"), F.max("m_hi").alias("m_hi"),
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("s_bal"),
            F.count("c_acctbal").alias("n_bal"),
            F.sum("s_disc").alias("s_disc"), F.sum("s_tax").alias("s_tax"),
            F.sum("n_disc").alias("n_disc"), F.sum("n_tax").alias("n_tax"),
            F.sum("n_lines").alias("n_lines"),
            F.min("lm_lo").alias("lm_lo"), F.max("lm_hi").alias("lm_hi")))


def order_sums(spark: SparkSession, d: str, sums: DataFrame | None = None) -> DataFrame:
    """Order-side sums per country-year (order value, buyer balances)."""
    sums = country_year_sums(spark, d) if sums is None else sums
    return sums.select("country_code", "y", "s_price", "n_price", "m_lo", "m_hi", "s_bal", "n_bal")


def line_sums(spark: SparkSession, d: str, sums: DataFrame | None = None) -> DataFrame:
    """Line-side sums per country-year, for country-years with line items
    (months spanned by orders that have lines)."""
    sums = country_year_sums(spark, d) if sums is None else sums
    return sums.filter(F.col("n_lines") > 0).select(
        "country_code", "y", "s_disc", "s_tax", "n_disc", "n_tax",
        F.col("lm_lo").alias("m_lo"), F.col("lm_hi").alias("m_hi"))


def _ys():
    """Year as text, marked '*' when the source lacks January or December
    (a provisional figure), to be cleaned by ``clean_years``."""
    return F.concat(F.col("y").cast("string"),
                    F.when((F.col("m_lo") > 1) | (F.col("m_hi") < 12), F.lit("*"))
                    .otherwise(F.lit("")))


def _ratio(s: str, n: str, factor: int = 1):
    return (F.col(s) * factor).cast("double") / F.col(n)


def indicator_sources(spark: SparkSession, d: str, sums: DataFrame | None = None):
    """Raw indicator frames (code, name, year_string, value...) and the
    per-year global series, all derived from the materialised country-year sums.
    The global series adds up the per-country sums (the same value as a
    mean over all rows, without another scan)."""
    from ridgeline.operators.facts import display_name

    sums = country_year_sums(spark, d) if sums is None else sums
    osums, lsums = order_sums(spark, d, sums), line_sums(spark, d, sums)
    gdp = osums.select("country_code", _ys().alias("year_string"),
                       _ratio("s_price", "n_price").alias("gdp_per_capita")) \
        .withColumn("country", display_name("country_code"))
    rates = lsums.select("country_code", _ys().alias("year_string"),
                         _ratio("s_disc", "n_disc", 100).alias("inflation_rate"),
                         _ratio("s_tax", "n_tax", 100).alias("unemployment_rate")) \
        .withColumn("country", display_name("country_code"))
    glob = lsums.groupBy(F.col("y").alias("year")).agg(
        ((F.sum("s_disc") * 100).cast("double") / F.sum("n_disc")).alias("global_inflation_rate"),
        ((F.sum("s_tax") * 100).cast("double") / F.sum("n_tax")).alias("global_unemployment_rate"),
    )
    return gdp, rates, glob


def outcome(spark: SparkSession, d: str, sums: DataFrame | None = None) -> DataFrame:
    """Outcome keyed by display name: mean balance of the customers who
    ordered in the year (each customer once)."""
    from ridgeline.operators.facts import display_name

    osums = order_sums(spark, d, sums)
    return osums.select(display_name("country_code").alias("country"),
                        F.col("y").alias("year"), _ratio("s_bal", "n_bal").alias("happiness"))


def developed_members(spark: SparkSession, d: str) -> DataFrame:
    from ridgeline.operators.facts import display_name

    n = table(spark, d, "nation", ["n_name", "n_regionkey"])
    r = table(spark, d, "region", ["r_regionkey", "r_name"])
    return (n.join(r.filter(F.col("r_name").isin(*DEVELOPED_REGIONS)),
                   n.n_regionkey == r.r_regionkey, "left_semi")
            .select(display_name("n_name").alias("country")))


def econ(spark: SparkSession, d: str, sums: DataFrame | None = None) -> DataFrame:
    """Indicators joined per country-year plus the global series."""
    from ridgeline.operators import facts as fx

    lo, hi = FACT_YEARS
    gdp, rates, glob = indicator_sources(spark, d, sums)
    joined = fx.join_indicators([fx.clean_years(gdp, lo, hi), fx.clean_years(rates, lo, hi)],
                                ["year", "country_code", "country"])
    return fx.attach_global_series(joined, glob, "year")


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Country-year fact table (C2-C7). Every branch below reads only the
    materialised country-year sums, so re-reading this frame never re-scans
    the inputs."""
    from ridgeline.operators import facts as fx

    lo, hi = FACT_YEARS
    sums = country_year_sums(spark, d)
    econ_df = econ(spark, d, sums)
    happy = fx.restrict_to_known(outcome(spark, d, sums), econ_df, "country",
                                 period="year", lo=lo, hi=hi)
    merged = fx.merge_outcome(econ_df, happy, ["year", "country"])
    flagged = fx.membership_flag(merged, "country", developed_members(spark, d), "developed_country")
    r6 = lambda x: F.round(F.col(x), 6).alias(x)
    return flagged.select(
        "year", "country", "country_code", "developed_country",
        r6("gdp_per_capita"), r6("inflation_rate"), r6("unemployment_rate"), r6("happiness"),
        r6("global_inflation_rate"), r6("global_unemployment_rate"),
    )


def _dn(x: str) -> str:
    return f"replace(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)), '_', ' ')"


_YS = "CAST(y AS VARCHAR) || CASE WHEN min(m) > 1 OR max(m) < 12 THEN '*' ELSE '' END"
_Y_CLEAN = "TRY_CAST(regexp_replace(year_string, '[*]', '', 'g') AS INTEGER)"

FACTS_SQL = f"""
oc AS (
  SELECT o.o_orderkey, o.o_totalprice, n.n_name AS country_code,
         CAST(year(o.o_orderdate) AS INTEGER) AS y, CAST(month(o.o_orderdate) AS INTEGER) AS m
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
gdp AS (
  SELECT country_code, {_YS} AS year_string,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS gdp_per_capita
  FROM oc GROUP BY country_code, y
),
rate_sums AS (
  SELECT country_code, y, min(m) AS m_lo, max(m) AS m_hi,
         sum(CAST(l_discount AS DECIMAL(18,2))) AS s_disc, sum(CAST(l_tax AS DECIMAL(18,2))) AS s_tax,
         count(l_discount) AS n_disc, count(l_tax) AS n_tax
  FROM lineitem l JOIN oc ON l.l_orderkey = oc.o_orderkey GROUP BY country_code, y
),
rates AS (
  SELECT country_code,
         CAST(y AS VARCHAR) || CASE WHEN m_lo > 1 OR m_hi < 12 THEN '*' ELSE '' END AS year_string,
         CAST(s_disc * 100 AS DOUBLE) / n_disc AS inflation_rate,
         CAST(s_tax * 100 AS DOUBLE) / n_tax AS unemployment_rate
  FROM rate_sums
),
glob_series AS (
  SELECT y AS year,
         CAST(sum(s_disc) * 100 AS DOUBLE) / sum(n_disc) AS global_inflation_rate,
         CAST(sum(s_tax) * 100 AS DOUBLE) / sum(n_tax) AS global_unemployment_rate
  FROM rate_sums GROUP BY y
),
econ AS (
  SELECT g.year, g.country_code, {_dn('g.country_code')} AS country, g.gdp_per_capita,
         r.inflation_rate, r.unemployment_rate, gl.global_inflation_rate, gl.global_unemployment_rate
  FROM (SELECT *, {_Y_CLEAN} AS year FROM gdp) g
  JOIN (SELECT *, {_Y_CLEAN} AS year FROM rates) r
    ON g.year = r.year AND g.country_code = r.country_code
  JOIN glob_series gl ON g.year = gl.year
  WHERE g.year BETWEEN {FACT_YEARS[0]} AND {FACT_YEARS[1]}
    AND r.year BETWEEN {FACT_YEARS[0]} AND {FACT_YEARS[1]}
),
buyers AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
happy AS (
  SELECT {_dn('n.n_name')} AS country, b.year,
         CAST(sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c.c_acctbal) AS happiness
  FROM buyers b JOIN customer c ON b.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2
),
developed AS (
  SELECT {_dn('n.n_name')} AS country FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name IN ({", ".join(f"'{x}'" for x in DEVELOPED_REGIONS)})
),
facts AS (
  SELECT e.year, e.country, e.country_code,
         (e.country IN (SELECT country FROM developed)) AS developed_country,
         round(e.gdp_per_capita, 6) AS gdp_per_capita, round(e.inflation_rate, 6) AS inflation_rate,
         round(e.unemployment_rate, 6) AS unemployment_rate, round(h.happiness, 6) AS happiness,
         round(e.global_inflation_rate, 6) AS global_inflation_rate,
         round(e.global_unemployment_rate, 6) AS global_unemployment_rate
  FROM econ e JOIN happy h ON e.year = h.year AND e.country = h.country
  WHERE h.year BETWEEN {FACT_YEARS[0]} AND {FACT_YEARS[1]}
)"""
