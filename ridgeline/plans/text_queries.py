"""Text, language and sentiment queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgeline.functions.rules import normalise_label
from ridgeline.functions.text import first_of_list_literal
from ridgeline.operators import batching, enrich, language, ngrams, polarity, sentiment
from ridgeline.plans import views
from ridgeline.plans.chart_queries import CHART_CTES, chart_top
from ridgeline.plans.registry import register, with_ctes
from ridgeline.session import materialize
from ridgeline.sources.tables import table

# ---- fixed values of the text plan -----------------------------------------
EXCLUDED_ROLES = ["system"]  # category left out of assembled conversations
BATCH_SIZE = 50
FREQUENT_MIN = 120  # a language is frequent with more than this many rows
CHUNK_CHARS = 512
CHUNK_TOKENS = 500
# Language -> scorer output shape used to normalise chunk labels.
ROUTES = {"en": "stars", "fr": "stars", "es": "stars", "it": "stars", "nl": "stars",
          "de": "binary_threshold"}
THRESHOLD = 0.75
# -----------------------------------------------------------------------------


def items(spark: SparkSession, d: str) -> DataFrame:
    return enrich.distinct_items(chart_top(spark, d), ["track_id", "name", "artists"])


def matched(spark: SparkSession, d: str, it: DataFrame | None = None) -> DataFrame:
    it = (items(spark, d) if it is None else it).withColumn("artist", first_of_list_literal("artists"))
    stats = enrich.text_stats_by(views.corpus_lengths(spark, d), ["title", "artist"], "lyrics",
                                 lang="language", length_col="text_len") \
        .withColumnRenamed("artist", "c_artist")
    m = enrich.match_items(it, stats, [("name", "title"), ("artist", "c_artist")])
    return enrich.consolidate_matches(m, "track_id")


def matched_texts(spark: SparkSession, d: str) -> DataFrame:
    """D3-D5 with the texts: items matched by title alone, and per track the texts of the
    title's documents in order. Only documents of a wanted title are read into a join. A
    track of one item has its title's text as it is, so only other tracks' are shuffled."""
    spellings = F.count(F.lit(1)).over(Window.partitionBy("track_id"))
    it = materialize(items(spark, d).withColumn("spellings", spellings))
    p = table(spark, d, "part", ["p_partkey", "p_name"])
    titles = p.join(it.select(F.col("name").alias("p_name")).distinct(), "p_name", "left_semi")
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    by_title = enrich.assemble_text(
        docs.join(titles, docs.doc_id == titles.p_partkey), "p_name", "text", ["doc_id", "text"],
        keep_max=["lang"], out="lyrics", parts=None).withColumnRenamed("lang", "language")
    by_title = by_title.filter(F.col("lyrics").isNotNull() & F.col("language").isNotNull())
    texts = lambda own, keep: enrich.spread_matches(own, by_title, ("name", "p_name"), keep)
    more = enrich.assemble_text(texts(it.filter("spellings > 1"), ["track_id", "name", "artists"]), "track_id",
                                "lyrics", ["name", "artists"], keep_max=["language"], parts=None)
    return texts(it.filter("spellings = 1"), ["track_id"]).unionByName(more)


def small_pages(spark: SparkSession) -> None:
    """Parquet writers of this session suit whole texts of titles, unless it is set otherwise.
    They look at the size of a page and of a row group every two rows (by default a hundred rows
    are held before), keep no least and greatest text, and write a text that many tracks in a
    row have once, in the dictionary, which takes texts of 64 MB (by default of 1 MB)."""
    settings = {"parquet.page.size.row.check.min": 2, "parquet.page.size.row.check.max": 2,
                "parquet.block.size": 32 << 20, "parquet.dictionary.page.size": 64 << 20,
                "parquet.column.statistics.enabled#lyrics": "false"}
    for key, value in settings.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(value))


def unmatched(spark: SparkSession, d: str) -> DataFrame:
    # Items feed both sides of the anti join; they are few (top-k per
    # country-year), so they are materialised once instead of recomputing
    # the chart ranking per side.
    it = materialize(items(spark, d))
    return enrich.without_match(it, matched(spark, d, it), "track_id")


def mood_chunks(docs: DataFrame) -> DataFrame:
    return sentiment.explode_chunks(sentiment.route_by_language(docs, "lang", ROUTES), "text", size=CHUNK_CHARS)


def learn_lexicon(spark: SparkSession, d: str) -> DataFrame:
    chunks = mood_chunks(table(spark, d, "documents", ["doc_id", "text", "lang"]))
    return polarity.learn_polarity(chunks, ["doc_id", "chunk_no"], sentiment.POSITIVE_WORDS, sentiment.NEGATIVE_WORDS)


_LEXICONS: dict[tuple, DataFrame] = {}


def mood_lexicon(spark: SparkSession, d: str) -> DataFrame:
    """The lexicon of the documents as they are now, learnt once per application and stored as
    a table in the shared folder; other files (path, size, time) are learnt anew."""
    about = table(spark, d, "documents").select("_metadata.file_path", "_metadata.file_size",
                                                "_metadata.file_modification_time").distinct()
    seen = about.agg(F.sum(F.xxhash64(*about.columns).cast("decimal(38,0)")), F.count("*")).first()
    key = (spark.sparkContext.applicationId, d, *seen)
    if key not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[key] = materialize(learn_lexicon(spark, d), as_table=True)
    return _LEXICONS[key]


def moods(spark: SparkSession, d: str, docs: DataFrame | None = None) -> DataFrame:
    """Mood per document: route -> chunk -> score -> normalise -> count ->
    vote. Output (track_id, language, counts..., mood). The scorer's lexicon
    is learnt from all routed documents; ``docs`` restricts the documents that
    are scored (default: all)."""
    if docs is None:
        docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    chunks = mood_chunks(docs)
    key = ["doc_id", "chunk_no"]
    lexicon = mood_lexicon(spark, d)
    scored = sentiment.score_chunks_polarity(chunks, [*key, "route"], lexicon)
    label = (F.when(F.col("route") == "stars", normalise_label("stars", rule="stars"))
             .when(F.col("route") == "binary_threshold",
                   normalise_label("label", "score", "binary_threshold", threshold=THRESHOLD)))
    counted = sentiment.count_labels(scored.withColumn("chunk_label", label),
                                     ["doc_id", "lang"], "chunk_label")
    return sentiment.vote(counted).select(
        F.col("doc_id").alias("track_id"), F.col("lang").alias("language"),
        "positive_count", "neutral_count", "negative_count", "mood")


# ------------------------------------------------------------------ SQL
ITEMS_SQL = """
items AS (SELECT DISTINCT track_id, name, artists FROM topk),
items_a AS (SELECT *, json_extract_string(replace(artists, '''', '"'), '$[0]') AS artist FROM items)"""

MATCH_SQL = views.CORPUS_SQL + """,
cstats AS (
  SELECT title, artist, count(lyrics) AS n_docs,
         CAST(sum(length(lyrics)) + 1 * (count(lyrics) - 1) AS BIGINT) AS n_chars,
         max(language) AS language
  FROM corpus GROUP BY title, artist
),
matched AS (
  SELECT i.track_id, c.n_docs, c.n_chars, c.language
  FROM items_a i LEFT JOIN cstats c ON i.name = c.title AND i.artist = c.artist
),
consolidated AS (
  SELECT track_id, CAST(sum(n_docs) AS BIGINT) AS n_docs,
         CAST(sum(n_chars) + count(*) - 1 AS BIGINT) AS n_chars, max(language) AS language
  FROM matched WHERE n_docs IS NOT NULL AND n_docs > 0 AND language IS NOT NULL
  GROUP BY track_id
),
unmatched AS (
  SELECT DISTINCT track_id, name, artists FROM items
  WHERE track_id NOT IN (SELECT track_id FROM consolidated)
)"""

TEXT_CTES = CHART_CTES + (ITEMS_SQL, MATCH_SQL)

_LETTERS = r"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}]+'), lambda t: t <> '')"


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys(words)) + "]"


def _route_case() -> str:
    return "CASE " + " ".join(f"WHEN lang = '{k}' THEN '{v}'" for k, v in ROUTES.items()) + " END"


MOODS_SQL = f"""
routed AS (
  SELECT doc_id, lang, text, {_route_case()} AS route FROM documents
),
chunked AS (
  SELECT doc_id, lang, route, i, substring(text, i * {CHUNK_CHARS} + 1, {CHUNK_CHARS}) AS chunk FROM (
    SELECT *, unnest(range(0, CAST(ceil(length(text) / {CHUNK_CHARS}) AS BIGINT))) AS i
    FROM routed WHERE route IS NOT NULL)
),{polarity.lexicon_sql('chunked', "concat_ws(':', doc_id, i)", sentiment.POSITIVE_WORDS, sentiment.NEGATIVE_WORDS,
                        _LETTERS.format(x='chunk'))},
hits AS (
  SELECT doc_id, i, sum(CAST(polarity > 0 AS INTEGER)) AS pos, sum(CAST(polarity < 0 AS INTEGER)) AS neg
  FROM (SELECT doc_id, i, lang, unnest({_LETTERS.format(x='chunk')}) AS word FROM chunked) JOIN lexicon USING (lang, word)
  GROUP BY doc_id, i
),
scored AS (
  SELECT *, least(greatest(pos_hits - neg_hits, -2), 2) + 3 AS stars_n,
         CASE WHEN pos_hits >= neg_hits THEN 'LABEL_1' ELSE 'LABEL_0' END AS label,
         (greatest(pos_hits, neg_hits) + 1) / (pos_hits + neg_hits + 2) AS score
  FROM (
    SELECT c.doc_id, c.lang, c.route, coalesce(h.pos, 0) AS pos_hits, coalesce(h.neg, 0) AS neg_hits
    FROM chunked c LEFT JOIN hits h ON c.doc_id = h.doc_id AND c.i = h.i)
),
labelled AS (
  SELECT doc_id, lang,
         CASE WHEN route = 'stars' THEN
                CASE WHEN stars_n IN (4, 5) THEN 'positive' WHEN stars_n = 3 THEN 'neutral'
                     WHEN stars_n IN (1, 2) THEN 'negative' END
              WHEN route = 'binary_threshold' THEN
                CASE WHEN label = 'LABEL_0' AND score >= {THRESHOLD} THEN 'negative'
                     WHEN label = 'LABEL_1' AND score >= {THRESHOLD} THEN 'positive'
                     WHEN label IN ('LABEL_0', 'LABEL_1') AND score < {THRESHOLD} THEN 'neutral' END
         END AS chunk_label
  FROM scored
),
counted AS (
  SELECT doc_id, lang,
         CAST(sum(CASE WHEN chunk_label = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive_count,
         CAST(sum(CASE WHEN chunk_label = 'neutral' THEN 1 ELSE 0 END) AS BIGINT) AS neutral_count,
         CAST(sum(CASE WHEN chunk_label = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative_count
  FROM labelled GROUP BY doc_id, lang
),
moods AS (
  SELECT doc_id AS track_id, lang AS language, positive_count, neutral_count, negative_count,
         CASE WHEN positive_count > neutral_count AND positive_count > negative_count THEN 'positive'
              WHEN negative_count > neutral_count AND negative_count > positive_count THEN 'negative'
              ELSE 'neutral' END AS mood
  FROM counted
)"""


# ------------------------------------------------------------- queries
@register("text_assemble", """
SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS text, max(role) AS role,
       count(text) AS n_parts
FROM conversations WHERE role NOT IN ('system') GROUP BY conv_id""")
def q_text_assemble(spark, d):
    conv = table(spark, d, "conversations", ["conv_id", "turn", "role", "text"])
    # (turn, text) makes the order total even if a turn number repeats
    return enrich.assemble_text(conv, "conv_id", "text", ["turn", "text"],
                                exclude=("role", EXCLUDED_ROLES), keep_max=["role"])


@register("text_match", with_ctes(*TEXT_CTES, body="SELECT * FROM consolidated"))
def q_text_match(spark, d):
    return matched(spark, d)


@register("text_match_lyrics", with_ctes(*TEXT_CTES, body="""
SELECT track_id, string_agg(lyrics, ' ' ORDER BY name, artists) AS lyrics, max(language) AS language
FROM items JOIN (
  SELECT title, string_agg(lyrics, ' ' ORDER BY id, lyrics) AS lyrics, max(language) AS language
  FROM corpus GROUP BY title) t ON name = title
WHERE t.lyrics IS NOT NULL AND t.language IS NOT NULL
GROUP BY track_id"""))
def q_text_match_lyrics(spark, d):
    small_pages(spark)
    return matched_texts(spark, d)


@register("text_unmatched", with_ctes(*TEXT_CTES, body="SELECT * FROM unmatched"))
def q_text_unmatched(spark, d):
    return unmatched(spark, d)


@register("text_batches", with_ctes(*TEXT_CTES, body=f"""
SELECT track_id, name, new_artist, row_index,
       CAST((row_index - 1) // {BATCH_SIZE} AS INTEGER) AS batch_id
FROM (SELECT track_id, name,
             json_extract_string(replace(artists, '''', '"'), '$[0]') AS new_artist,
             row_number() OVER (ORDER BY track_id) AS row_index
      FROM unmatched)"""))
def q_text_batches(spark, d):
    u = unmatched(spark, d).select("track_id", "name",
                                   first_of_list_literal("artists").alias("new_artist"))
    return batching.assign_batches(u, BATCH_SIZE, ["track_id"])


@register("list_first", """
SELECT track_id, literal,
       regexp_extract(literal, '^\\[''([^'']*)''', 1) AS first_item,
       regexp_extract(literal, ', "(.*)"\\]$', 1) AS second_item
FROM (SELECT p_partkey AS track_id,
             '[''' || p_brand || ''', "' || p_name || '''s"]' AS literal FROM part)""")
def q_list_first(spark, d):
    p = table(spark, d, "part", ["p_partkey", "p_brand", "p_name"])
    lit = F.concat(F.lit("['"), F.col("p_brand"), F.lit("', \""), F.col("p_name"), F.lit("'s\"]"))
    from ridgeline.functions.text import list_items

    return p.select(F.col("p_partkey").alias("track_id"), lit.alias("literal")).select(
        "track_id", "literal",
        first_of_list_literal("literal").alias("first_item"),
        F.try_element_at(list_items("literal"), F.lit(2)).alias("second_item"))


@register("enrich_status", with_ctes(*CHART_CTES, ITEMS_SQL, body="""
SELECT i.track_id, i.name, i.artists,
       CASE WHEN i.name IS NOT NULL AND i.artists IS NOT NULL THEN d.text END AS lyrics,
       CASE WHEN i.name IS NOT NULL AND i.artists IS NOT NULL AND d.text IS NOT NULL
            THEN d.lang END AS language
FROM items i LEFT JOIN documents d ON i.track_id = d.doc_id"""))
def q_enrich_status(spark, d):
    # The items (top-k tracks) are few: materialise them once and keep only
    # the documents they need, filtered where the documents are read, before
    # the left join. A stored table has a known size, so Spark broadcasts the
    # keys below its own limit and no text is shuffled.
    it = materialize(items(spark, d), as_table=True)
    docs = enrich.restrict_to_keys(table(spark, d, "documents", ["doc_id", "text", "lang"]),
                                   it.select(F.col("track_id").alias("doc_id")), "doc_id")
    return enrich.enrich_status(it, docs, "track_id", "doc_id", text="text",
                                lang="lang", required=["name", "artists"]) \
        .withColumnRenamed("text", "lyrics").withColumnRenamed("lang", "language")


@register("lang_distinct", f"""
SELECT DISTINCT lang FROM documents WHERE lang <> '{language.UNKNOWN}'""")
def q_lang_distinct(spark, d):
    return language.distinct_values(table(spark, d, "documents", ["lang"]), "lang",
                                    language.UNKNOWN)


@register("lang_frequent", f"""
SELECT lang, count(*) AS n_rows FROM documents WHERE lang <> '{language.UNKNOWN}'
GROUP BY lang HAVING count(*) > {FREQUENT_MIN}""")
def q_lang_frequent(spark, d):
    return language.frequent_values(table(spark, d, "documents", ["lang"]), "lang",
                                    FREQUENT_MIN, language.UNKNOWN, count="n_rows")


@register("lang_keep", f"""
SELECT doc_id, lang, source, n_chars FROM documents
WHERE lang IS NOT NULL AND text IS NOT NULL AND lang <> '{language.UNKNOWN}'
  AND lang IN (SELECT lang FROM documents WHERE lang <> '{language.UNKNOWN}'
               GROUP BY lang HAVING count(*) > {FREQUENT_MIN})""")
def q_lang_keep(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "lang", "source", "n_chars", "text"])
    return language.keep_frequent(docs, "lang", "text", FREQUENT_MIN, language.UNKNOWN) \
        .select("doc_id", "lang", "source", "n_chars")


def _profile_values() -> str:
    return ", ".join(f"('{w}', '{lg}')" for w, lg in language.profile_rows())

def _detect_sql() -> str:
    return f"""
prof(token, language) AS (VALUES {_profile_values()}),
toks AS (SELECT doc_id, unnest({_LETTERS.format(x='text')}) AS token FROM documents),
hits AS (SELECT doc_id, language, count(*) AS hits FROM toks JOIN prof USING (token)
         GROUP BY doc_id, language),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, language ASC) AS rn
           FROM hits),
best AS (
  SELECT doc_id, max(CASE WHEN rn = 1 THEN language END) AS lang1,
         CAST(coalesce(max(CASE WHEN rn = 1 THEN hits END), 0) AS BIGINT) AS best_hits,
         CAST(coalesce(max(CASE WHEN rn = 2 THEN hits END), 0) AS BIGINT) AS second_hits
  FROM ranked GROUP BY doc_id
),
detected AS (
  SELECT d.doc_id, d.lang,
         coalesce(CASE WHEN b.best_hits >= 3 AND b.best_hits >= 2.0 * b.second_hits THEN b.lang1 END,
                  '{language.UNKNOWN}') AS detected,
         coalesce(b.best_hits, 0) AS best_hits, coalesce(b.second_hits, 0) AS second_hits
  FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id
)"""



@register("lang_detect", "WITH " + _detect_sql() + """
SELECT doc_id, lang, detected, best_hits, second_hits FROM detected""")
def q_lang_detect(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    return language.label_by_words(docs, "text").drop("text")


@register("lang_recheck", "WITH " + _detect_sql() + f"""
SELECT doc_id, CASE WHEN detected = '{language.UNKNOWN}' THEN lang ELSE detected END AS language
FROM detected""")
def q_lang_recheck(spark, d):
    """D10 + D11: detected language with the unreliable sentinel replaced by
    a second opinion (here the language recorded with the document)."""
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    both = language.label_by_words(docs, "text", out="language")
    return language.recheck_unknown(both, "language", "lang", sentinel=language.UNKNOWN) \
        .select("doc_id", "language")


@register("text_chunks", f"""
SELECT doc_id, lang, CAST(i AS INTEGER) AS chunk_no,
       substring(text, i * {CHUNK_CHARS} + 1, {CHUNK_CHARS}) AS chunk
FROM (SELECT *, unnest(range(0, CAST(ceil(length(text) / {CHUNK_CHARS}) AS BIGINT))) AS i
      FROM documents)""")
def q_text_chunks(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "lang", "text"])
    return sentiment.explode_chunks(docs, "text", size=CHUNK_CHARS)


@register("text_token_chunks", f"""
SELECT doc_id, lang, CAST(i AS INTEGER) AS chunk_no,
       array_to_string(list_slice(toks, i * {CHUNK_TOKENS} + 1, (i + 1) * {CHUNK_TOKENS}), ' ') AS chunk
FROM (SELECT *, unnest(range(0, CAST(ceil(len(toks) / {CHUNK_TOKENS}) AS BIGINT))) AS i
      FROM (SELECT doc_id, lang,
                   list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '') AS toks
            FROM documents))""")
def q_text_token_chunks(spark, d):
    docs = table(spark, d, "documents", ["doc_id", "lang", "text"])
    return sentiment.explode_chunks(docs, "text", mode="tokens", size=CHUNK_TOKENS)


@register("mood_lexicon", with_ctes(MOODS_SQL, body="SELECT * FROM lexicon"))
def q_mood_lexicon(spark, d):
    """E5: the polarity of words as the corpus gives it, learnt anew at each call."""
    return learn_lexicon(spark, d)


@register("mood_vote", with_ctes(MOODS_SQL, body="SELECT * FROM moods"))
def q_mood_vote(spark, d):
    return moods(spark, d)


@register("mood_unrouted", f"""
SELECT lang, count(*) AS n_rows FROM documents
WHERE lang NOT IN ({', '.join(f"'{k}'" for k in sentiment.LANGUAGE_ROUTES)}) OR lang IS NULL GROUP BY lang""")
def q_mood_unrouted(spark, d):
    return sentiment.unrouted(table(spark, d, "documents", ["lang"]), "lang", sentiment.LANGUAGE_ROUTES)


@register("lang_detect_accuracy", "WITH " + _detect_sql() + """
SELECT lang, count(*) AS n_docs, CAST(count_if(detected = lang) AS BIGINT) AS n_agree,
       CAST(count_if(detected = 'und') AS BIGINT) AS n_unknown,
       round(count_if(detected = lang) / count(*), 6) AS agreement
FROM detected GROUP BY lang""")
def q_lang_detect_accuracy(spark, d):
    """D10 report: agreement of the detected language with the language
    recorded for each document, per recorded language."""
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    return agreement(language.label_by_words(docs, "text"))


def agreement(labelled: DataFrame) -> DataFrame:
    """Of each recorded language, how many documents were labelled so."""
    return labelled.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col("detected") == F.col("lang")).alias("n_agree"),
        F.count_if(F.col("detected") == language.UNKNOWN).alias("n_unknown"),
        F.round(F.count_if(F.col("detected") == F.col("lang")) / F.count(F.lit(1)), 6)
        .alias("agreement"))


NGRAM_SQL = ngrams.label_sql("documents", "doc_id", _LETTERS.format(x="text"))


def labelled_by_ngrams(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    return ngrams.label_language(docs, "text", "lang", keep=("doc_id", "lang"))


@register("lang_ngrams", "WITH " + NGRAM_SQL + "SELECT * FROM by_ngrams")
def q_lang_ngrams(spark, d):
    """D10 with profiles learnt from the labelled documents."""
    return labelled_by_ngrams(spark, d)


@register("lang_ngram_accuracy", "WITH " + NGRAM_SQL + """
SELECT lang, count(*) AS n_docs, CAST(count_if(detected = lang) AS BIGINT) AS n_agree,
       CAST(count_if(detected = 'und') AS BIGINT) AS n_unknown,
       round(count_if(detected = lang) / count(*), 6) AS agreement
FROM by_ngrams GROUP BY lang""")
def q_lang_ngram_accuracy(spark, d):
    return agreement(labelled_by_ngrams(spark, d))


@register("lang_ngram_profile", "WITH " + NGRAM_SQL + """
SELECT lang, gram, CAST(place AS INTEGER) AS place FROM ng_profile""")
def q_lang_ngram_profile(spark, d):
    return ngrams.learn_profiles(table(spark, d, "documents", ["text", "lang"]), "text", "lang")


@register("lang_ngram_recheck", "WITH " + _detect_sql() + "," + NGRAM_SQL + f"""
SELECT w.doc_id, CASE WHEN w.detected = '{language.UNKNOWN}' THEN n.detected ELSE w.detected END AS language
FROM detected w JOIN by_ngrams n ON w.doc_id = n.doc_id""")
def q_lang_ngram_recheck(spark, d):
    """D10 + D11: labels by words, and by n-grams where the words are not enough; each text is
    read once for the profiles and once for both labels, without a join."""
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    profiles = ngrams.collect_profiles(ngrams.learn_profiles(docs, "text", "lang"))
    words = language.label_by_words(docs, "text", out="language")
    both = ngrams.label_by_profiles(words, "text", profiles, keep=("doc_id", "language"))
    return language.recheck_unknown(both, "language", "detected", sentinel=language.UNKNOWN) \
        .select("doc_id", "language")


# --------------------------------------------- moods over the route table
def moods_by_language(spark: SparkSession, d: str) -> DataFrame:
    """E1-E8 with the fixed per-language route table: per-language chunking
    and label rule in one pass; unrouted languages get no mood."""
    docs = table(spark, d, "documents", ["doc_id", "text", "lang"])
    chunks = sentiment.explode_chunks_by_language(docs, "text", "lang")
    scored = sentiment.score_chunks_lexicon(chunks)
    raw = sentiment.raw_label_by_language("lang")
    labelled = scored.withColumn("raw_label", raw).withColumn(
        "chunk_label", sentiment.normalise_by_language("raw_label", "score", "lang",
                                                       threshold=THRESHOLD))
    counted = sentiment.count_labels(labelled, ["doc_id", "lang"], "chunk_label")
    return sentiment.vote(counted).select(
        F.col("doc_id").alias("track_id"), F.col("lang").alias("language"),
        "positive_count", "neutral_count", "negative_count", "mood")


def _routes_sql() -> str:
    routes = sentiment.LANGUAGE_ROUTES

    def case(i):
        return "CASE " + " ".join(f"WHEN lang = '{k}' THEN {v[i]!r}" .replace('"', "'")
                                  for k, v in routes.items()) + " END"

    def rule_sql(code, rule):
        if rule == "stars":
            return ("CASE WHEN raw_label IN ('4 stars', '5 stars') THEN 'positive' "
                    "WHEN raw_label = '3 stars' THEN 'neutral' "
                    "WHEN raw_label IN ('1 star', '2 stars') THEN 'negative' END")
        if rule == "binary_threshold":
            return (f"CASE WHEN raw_label = 'LABEL_0' AND score >= {THRESHOLD} THEN 'negative' "
                    f"WHEN raw_label = 'LABEL_1' AND score >= {THRESHOLD} THEN 'positive' "
                    f"WHEN raw_label IN ('LABEL_0', 'LABEL_1') AND score < {THRESHOLD} THEN 'neutral' END")
        if rule == "binary":
            return ("CASE WHEN raw_label = 'LABEL_0' THEN 'negative' "
                    "WHEN raw_label = 'LABEL_1' THEN 'positive' ELSE 'neutral' END")
        if rule == "signed":
            return ("CASE WHEN raw_label = '1' THEN 'positive' WHEN raw_label = '-1' THEN 'negative' "
                    "ELSE 'neutral' END")
        if rule == "lower":
            return "lower(raw_label)"
        if rule == "identity":
            return "CASE WHEN raw_label <> '' THEN raw_label END"
        if rule == "mapping":
            m = sentiment.LABEL_MAPS[code]
            return "CASE " + " ".join(f"WHEN raw_label = '{a}' THEN '{b}'" for a, b in m.items()) + " END"
        raise ValueError(rule)

    def raw_sql(code, rule):
        if rule == "stars":
            return "CASE WHEN stars_n = 1 THEN '1 star' ELSE CAST(stars_n AS VARCHAR) || ' stars' END"
        if rule.startswith("binary"):
            return "label"
        names = {"positive": "positive", "neutral": "neutral", "negative": "negative"}
        if rule == "signed":
            names = {"positive": "1", "neutral": "0", "negative": "-1"}
        if rule == "mapping":
            names = {mood: raw for raw, mood in sentiment.LABEL_MAPS[code].items()}
        return (f"CASE WHEN pos_hits > neg_hits THEN '{names['positive']}' "
                f"WHEN neg_hits > pos_hits THEN '{names['negative']}' ELSE '{names['neutral']}' END")

    raw = "CASE " + " ".join(f"WHEN lang = '{k}' THEN {raw_sql(k, r)}" for k, (r, _, _) in routes.items()) + " END"
    norm = "CASE " + " ".join(f"WHEN lang = '{k}' THEN {rule_sql(k, r)}"
                              for k, (r, _, _) in routes.items()) + " END"
    return f"""
r_routed AS (
  SELECT doc_id, lang, text, {case(1)} AS mode, {case(2)} AS size,
         list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '') AS toks
  FROM documents
),
r_chunked AS (
  SELECT doc_id, lang,
         CASE WHEN mode = 'chars' THEN substring(text, i * size + 1, size)
              ELSE array_to_string(list_slice(toks, i * size + 1, (i + 1) * size), ' ') END AS chunk
  FROM (SELECT *, unnest(range(0, CAST(ceil((CASE WHEN mode = 'chars' THEN length(text)
                                                   ELSE len(toks) END) / size) AS BIGINT))) AS i
        FROM r_routed WHERE mode IS NOT NULL)
),
r_scored AS (
  SELECT *, {raw} AS raw_label
  FROM (
    SELECT *, least(greatest(pos_hits - neg_hits, -2), 2) + 3 AS stars_n,
           CASE WHEN pos_hits >= neg_hits THEN 'LABEL_1' ELSE 'LABEL_0' END AS label,
           (greatest(pos_hits, neg_hits) + 1) / (pos_hits + neg_hits + 2) AS score
    FROM (
      SELECT *, len(list_filter(toks, lambda t: list_contains({_sql_list(sentiment.POSITIVE_WORDS)}, t))) AS pos_hits,
                len(list_filter(toks, lambda t: list_contains({_sql_list(sentiment.NEGATIVE_WORDS)}, t))) AS neg_hits
      FROM (SELECT *, {_LETTERS.format(x='chunk')} AS toks FROM r_chunked)))
),
r_counted AS (
  SELECT doc_id, lang,
         CAST(sum(CASE WHEN chunk_label = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive_count,
         CAST(sum(CASE WHEN chunk_label = 'neutral' THEN 1 ELSE 0 END) AS BIGINT) AS neutral_count,
         CAST(sum(CASE WHEN chunk_label = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative_count
  FROM (SELECT doc_id, lang, {norm} AS chunk_label FROM r_scored)
  GROUP BY doc_id, lang
)"""


@register("mood_vote_routes", "WITH " + _routes_sql() + """
SELECT doc_id AS track_id, lang AS language, positive_count, neutral_count, negative_count,
       CASE WHEN positive_count > neutral_count AND positive_count > negative_count THEN 'positive'
            WHEN negative_count > neutral_count AND negative_count > positive_count THEN 'negative'
            ELSE 'neutral' END AS mood
FROM r_counted""")
def q_mood_vote_routes(spark, d):
    return moods_by_language(spark, d)
