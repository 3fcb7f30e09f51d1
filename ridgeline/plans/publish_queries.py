"""Readers and writers (A1 C1 C8 D2 D15 E9 H6) as queries: tables are written to the shared
folder by the library's writers and read back by its readers; segmented texts (D3 D5),
exact quantiles and hinges (I2 I7) and the name report (C6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.operators import names, quantiles, segments
from ridgeline.operators import facts as fx
from ridgeline.plans import views
from ridgeline.plans.registry import register, with_ctes
from ridgeline.plans.text_queries import EXCLUDED_ROLES, _routes_sql
from ridgeline.session import scratch_path
from ridgeline.sources import io, keyed
from ridgeline.sources.tables import table
from ridgeline.streaming.moods import start_mood_stream

# ---- fixed values ----------------------------------------------------------
SEGMENT = 512                     # characters of a segment
PUBLISH_BYTES = 4 << 20           # bytes of a writing task
PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
NAME_DISTANCE = 2
FACT_SCHEMA = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("country", T.StringType()),
                            T.StructField("developed_country", T.BooleanType()),
                            T.StructField("gdp_per_capita", T.DoubleType()), T.StructField("happiness", T.DoubleType()),
                            T.StructField("country_code", T.StringType())])
INDICATOR_SCHEMA = T.StructType([T.StructField("custkey", T.LongType()), T.StructField("balance", T.DecimalType(18, 2))])
# ----------------------------------------------------------------------------

FACT_COLUMNS = ", ".join(FACT_SCHEMA.names)


@register("publish_facts", with_ctes(views.FACTS_SQL, body=f"SELECT {FACT_COLUMNS} FROM facts"))
def q_publish_facts(spark, d):
    """The facts in one folder per country, read back with pruned folders' columns."""
    path = scratch_path(spark, "facts")
    io.publish_partitioned(views.facts(spark, d).select(*FACT_SCHEMA.names), path, ["country_code"])
    return io.read_partitioned(spark, path, schema=FACT_SCHEMA).select(*FACT_SCHEMA.names)


@register("export_facts", with_ctes(views.FACTS_SQL, body=f"SELECT {FACT_COLUMNS} FROM facts"))
def q_export_facts(spark, d):
    """H6: the reduced facts as one CSV file."""
    path = scratch_path(spark, "facts-csv")
    io.export_single_csv(views.facts(spark, d).select(*FACT_SCHEMA.names), path)
    return io.read_csv(spark, path, FACT_SCHEMA)


@register("publish_texts", """
SELECT doc_id, lang AS language, md5(text) AS text_md5, copy
FROM documents, (VALUES ('json'), ('parquet')) c(copy)""")
def q_publish_texts(spark, d):
    """Texts as JSON and as Parquet by language, in tasks of bounded size, read back."""
    from ridgeline.sources.sized import publish_sized

    docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    paths = {f: scratch_path(spark, f"texts-{f}") for f in ("json", "parquet")}
    publish_sized(docs, paths, ["lang"], task_bytes=PUBLISH_BYTES)
    both = [io.read_json(spark, paths["json"], docs.schema), io.read_partitioned(spark, paths["parquet"], schema=docs.schema)]
    rows = [b.select("doc_id", F.col("lang").alias("language"), F.md5(F.col("text").cast("binary")).alias("text_md5"),
                     F.lit(f).alias("copy")) for f, b in zip(paths, both, strict=True)]
    return rows[0].unionByName(rows[1])


@register("chart_from_csv", with_ctes(views.CHART_SQL, body="""
SELECT country, track_id, name, artists, artist_genres, explicit, count(*) AS n_rows,
       CAST(sum(streams) AS BIGINT) AS streams, min(CAST(date AS VARCHAR)) AS first_date,
       CAST(sum(position + duration) AS BIGINT) AS numbers
FROM (SELECT * REPLACE (CAST(track_id AS VARCHAR) AS track_id) FROM chart) GROUP BY ALL"""))
def q_chart_from_csv(spark, d):
    """A1: the chart as typed CSV with list literals, totalled per track and country."""
    path = scratch_path(spark, "chart-csv")
    chart = views.chart(spark, d).select(*[F.col(f.name).cast(f.dataType) for f in io.CHART_SCHEMA.fields])
    chart.write.option("header", "true").option("escape", '"').csv(path)
    read = io.read_csv(spark, path, io.CHART_SCHEMA, escape='"')
    return read.groupBy("country", "track_id", "name", "artists", "artist_genres", "explicit").agg(
        F.count("*").alias("n_rows"), F.sum("streams").alias("streams"), F.min("date").alias("first_date"),
        F.sum(F.col("position") + F.col("duration")).alias("numbers"))


@register("entity_files", """
SELECT split_part(n_name, '_', 1) || CAST(n_nationkey AS VARCHAR) AS code, 'The ' || n_name AS name,
       count(*) AS n_rows, min(c_custkey) AS first_key,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def q_entity_files(spark, d):
    """One CSV file per entity, code and name in the file's name, read in one scan."""
    n = table(spark, d, "nation", ["n_nationkey", "n_name"]).select(
        "n_nationkey", F.concat(F.split("n_name", "_")[0], F.col("n_nationkey").cast("string")).alias("code"),
        F.concat(F.lit("The "), "n_name").alias("name"))
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "code", "name", F.col("c_custkey").alias("custkey"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    path = scratch_path(spark, "entities")
    io.write_entity_files(rows, path, "code", "name")
    read = io.read_entity_files(spark, f"{path}/*.csv", INDICATOR_SCHEMA, code="code", name="name", header="true")
    return read.groupBy("code", "name").agg(F.count("*").alias("n_rows"), F.min("custkey").alias("first_key"),
                                            F.sum("balance").cast("double").alias("balance"))


@register("corpus_from_csv", with_ctes(views.CORPUS_SQL, body="""
SELECT id, title, artist, tag, language, length(lyrics) AS n_chars, md5(lyrics) AS lyrics_md5 FROM corpus"""))
def q_corpus_from_csv(spark, d):
    """Texts with line breaks and quotes as CSV, read back whole."""
    docs = table(spark, d, "documents", ["doc_id", "text", "lang", "source"])
    p = table(spark, d, "part", ["p_partkey", "p_name", "p_brand"])
    rows = docs.join(p, docs.doc_id == p.p_partkey).select(
        F.col("p_name").alias("title"), F.col("source").alias("tag"), F.col("p_brand").alias("artist"),
        F.lit(None).cast("int").alias("year"), F.lit(None).cast("long").alias("views"),
        F.lit(None).cast("string").alias("features"), F.col("text").alias("lyrics"), F.col("doc_id").alias("id"),
        F.col("lang").alias("language"))
    path = scratch_path(spark, "corpus")
    io.write_text_corpus(rows, path)
    return io.read_text_corpus(spark, path).select(
        "id", "title", "artist", "tag", "language", F.length("lyrics").cast("long").alias("n_chars"),
        F.md5(F.col("lyrics").cast("binary")).alias("lyrics_md5"))


@register("mood_stream", "WITH " + _routes_sql() + """
SELECT CAST(doc_id AS VARCHAR) AS track_id, lang AS language,
       CASE WHEN positive_count > neutral_count AND positive_count > negative_count THEN 'positive'
            WHEN negative_count > neutral_count AND negative_count > positive_count THEN 'negative'
            ELSE 'neutral' END AS mood
FROM r_counted""")
def q_mood_stream(spark, d):
    """Moods of arriving files merged by document; the whole input is sent a second time
    without its checkpoint, which changes nothing."""
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"]).select(
        F.col("doc_id").cast("string").alias("track_id"), F.col("text").alias("lyrics"), F.col("lang").alias("language"))
    path, sink = scratch_path(spark, "arriving"), scratch_path(spark, "moods")
    docs.write.json(path)
    for run in range(2):
        query = start_mood_stream(spark, path, sink, checkpoint=f"{sink}-checkpoint-{run}", buckets=8)
        query.awaitTermination()
    return keyed.read_keyed(spark, sink)


# ------------------------------------------------------------------ segments
def _segments_sql(source: str, key: str) -> str:
    return f"""
SELECT {key}, i AS segment, substring(text, i * {SEGMENT} + 1, {SEGMENT}) AS text
FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil(length(text) / {SEGMENT}) AS BIGINT)))) AS i FROM ({source}))"""


@register("text_segments", _segments_sql("""
SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS text
FROM conversations WHERE role NOT IN ('system') AND text IS NOT NULL GROUP BY conv_id""", "conv_id"))
def q_text_segments(spark, d):
    """D3: conversations as numbered segments."""
    conv = table(spark, d, "conversations", ["conv_id", "turn", "role", "text"])
    return segments.assemble_segments(conv, "conv_id", "text", ["turn", "text"], size=SEGMENT,
                                      exclude=("role", EXCLUDED_ROLES))


@register("title_segments", "WITH " + views.CORPUS_SQL + _segments_sql("""
SELECT title, string_agg(lyrics, ' ' ORDER BY id) AS text FROM corpus WHERE lyrics IS NOT NULL GROUP BY title""", "title"))
def q_title_segments(spark, d):
    """All texts of a title, hot titles in many segments and tasks."""
    docs = table(spark, d, "documents", ["doc_id", "text"])
    p = table(spark, d, "part", ["p_partkey", "p_name"])
    texts = docs.join(p, docs.doc_id == p.p_partkey).select(F.col("p_name").alias("title"), "text", "doc_id")
    return segments.assemble_segments(texts, "title", "text", ["doc_id"], size=SEGMENT)


# ------------------------------------------------------------------ quantiles
@register("stat_quantiles", f"""
SELECT l_returnflag, p AS prob, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), p), 4) AS value
FROM lineitem, (VALUES {', '.join(f'(CAST({p} AS DOUBLE))' for p in PROBS)}) v(p) GROUP BY l_returnflag, p"""
          .replace("quantile_cont(CAST(l_extendedprice AS DOUBLE), p)",
                   "list_extract(quantile_cont(CAST(l_extendedprice AS DOUBLE), [" + ", ".join(map(str, PROBS)) + "]), "
                   "CAST(list_position([" + ", ".join(f"CAST({p} AS DOUBLE)" for p in PROBS) + "], p) AS INTEGER))"))
def q_stat_quantiles(spark, d):
    """I2 on raw rows: exact quantiles of every line item's price."""
    li = table(spark, d, "lineitem", ["l_returnflag", "l_extendedprice"])
    q = quantiles.exact_quantiles(li, "l_extendedprice", PROBS, group=["l_returnflag"])
    return q.withColumn("value", F.round("value", 4))


@register("stat_box_hinges", with_ctes(views.FACTS_SQL, """
ranked AS (
  SELECT developed_country, happiness AS v, row_number() OVER (PARTITION BY developed_country ORDER BY happiness) AS i,
         count(*) OVER (PARTITION BY developed_country) AS n FROM facts WHERE happiness IS NOT NULL
),
hinges AS (
  SELECT developed_country, n, avg(v) FILTER (i IN (floor(d4), ceil(d4))) AS q1,
         avg(v) FILTER (i IN (floor((n + 1) / 2), ceil((n + 1) / 2))) AS median,
         avg(v) FILTER (i IN (floor(n + 1 - d4), ceil(n + 1 - d4))) AS q3
  FROM (SELECT *, floor((n + 3) / 2) / 2 AS d4 FROM ranked) GROUP BY developed_country, n
)""", body="""
SELECT h.developed_country, h.n,
       round(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS lower,
       round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS upper,
       count(*) FILTER (NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM hinges h JOIN ranked r ON h.developed_country = r.developed_country
GROUP BY h.developed_country, h.n, q1, median, q3"""))
def q_stat_box_hinges(spark, d):
    """The boxes as a box plot draws them."""
    return quantiles.box_hinges(views.facts(spark, d), "happiness", ["developed_country"], digits=4)


# ------------------------------------------------------------------ names
SPELT_SQL = f"""
spelt AS (
  SELECT CASE n_nationkey % 3 WHEN 0 THEN substr(name, 1, 1 + n_nationkey % 4) || substr(name, 3 + n_nationkey % 4)
                              WHEN 1 THEN name || 's' ELSE name END AS country
  FROM (SELECT n_nationkey, {views._dn('n_name')} AS name FROM nation) WHERE n_nationkey % 7 <> 3
)"""


def spelt(spark: SparkSession, d: str) -> DataFrame:
    """Country names of a source with gaps and misspellings."""
    n = table(spark, d, "nation", ["n_nationkey", "n_name"]).where("n_nationkey % 7 <> 3")
    k, name = F.col("n_nationkey").cast("int"), fx.display_name("n_name")
    cut = F.concat(F.substring(name, F.lit(1), 1 + k % 4), F.substring(name, 3 + k % 4, F.lit(1 << 20)))
    return n.select(F.when(k % 3 == 0, cut).when(k % 3 == 1, F.concat(name, F.lit("s"))).otherwise(name).alias("country"))


@register("fact_name_report", with_ctes(views.FACTS_SQL, SPELT_SQL, body=f"""
SELECT name, min(proposal) FILTER (distance = least_distance) AS proposal, CAST(min(least_distance) AS INTEGER) AS distance
FROM (
  SELECT *, min(distance) OVER (PARTITION BY name) AS least_distance FROM (
    SELECT s.name, e.country AS proposal, levenshtein(s.name, e.country) AS distance
    FROM (SELECT DISTINCT country AS name FROM spelt WHERE country NOT IN (SELECT country FROM econ)) s
    LEFT JOIN (SELECT DISTINCT country FROM econ) e ON levenshtein(s.name, e.country) <= {NAME_DISTANCE}))
GROUP BY name"""))
def q_fact_name_report(spark, d):
    """Names of the other source that the indicators lack, and the nearest they have."""
    return names.reconcile(views.econ(spark, d), spelt(spark, d), "country", distance=NAME_DISTANCE)


@register("fact_unmatched_gaps", with_ctes(views.FACTS_SQL, SPELT_SQL, body="""
SELECT year, country, country_code FROM econ WHERE country NOT IN (SELECT country FROM spelt)"""))
def q_fact_unmatched_gaps(spark, d):
    """Indicator rows without a partner in a source with gaps."""
    return fx.unmatched(views.econ(spark, d), spelt(spark, d), ["country"]).select("year", "country", "country_code")
