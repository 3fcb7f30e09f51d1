"""E5: a polarity scorer learnt from the corpus.

A fixed list knows few words. Here a few seed words of either polarity spread
it over the words that occur near them, for each language apart:

1. Each word keeps a sketch: the ``sample`` chunks of least hash among those that
   hold it (all of them, if fewer). The sketches are the edges of a graph of words
   and chunks with at most ``sample`` edges per word, however often the word
   occurs; the hash is the chunk's own, so frequent words meet in the same chunks.
   The chunks of an eighth of the hashes are counted first, and of ever smaller shares:
   the least share with ``sample`` chunks bounds a frequent word's sketch, and another
   reading sends only the chunks below it. So a word in every chunk moves a few times
   ``sample`` rows in all. A bound leaves out nothing that a sketch holds.
2. In each round a chunk takes the mean polarity of its words in the graph, and a
   word the mean of its chunks less the mean of the language, shrunk towards zero
   for words of few chunks and scaled by the words' mean size; seeds keep their
   polarity. So a word of every context has none, and a corpus with more seeds of
   one kind does not lean to it. No pair of words is ever formed.
3. The lexicon is the seeds and, at either end of a language's words in order of
   polarity, as many words as make up a share of ``tail`` of all occurrences (chunks
   of each word): so either mood is as common in the corpus as the other, whatever
   the seeds. The ends are found in a histogram of polarity, never by a sort of all
   words. It scores chunks by a join; Spark broadcasts it only if its size allows.

All values are whole numbers (millionths), each mean is one division of exact
sums, and ties do not matter, so any engine and any partitioning gives the same
lexicon. A language without a seed in the corpus has no lexicon: its chunks have
no hits. Null texts have no words; rows of equal key are parts of one chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.session import materialize

UNIT = 1_000_000


@dataclass(frozen=True)
class Spread:
    sample: int = 64         # chunks of a word's sketch
    least_chunks: int = 3    # words of fewer chunks are left out
    shrink: int = 4          # chunks of no polarity added to each word's
    rounds: int = 2
    spread: int = 100_000    # mean size of a language's polarities
    bucket: int = 1_000      # width of the histogram's buckets
    tail: int = 25_000       # millionths of all occurrences in the lexicon, at either end
    known: int = 100_000     # words whose bound is known where chunks are read; others send all chunks


def letter_words(text: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def chunk_hash(keys: Sequence[str]) -> Column:
    """Sixty bits of the MD5 of a chunk's key: its place in the order of sketches."""
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def frequent_words(words: DataFrame, spread: Spread) -> DataFrame:
    """Rows lang, word, bound: words with at least ``sample`` chunks of a hash below ``bound``, the
    least such share of all hashes; the most frequent ``known`` of them. Only the largest share is read."""
    bounds = [1 << k for k in range(57, 41, -2)]
    counted = words.where(F.col("at") < bounds[0]).groupBy("lang", "word").agg(
        *[F.count_if(F.col("at") < b).alias(f"n_{b}") for b in bounds])
    least = F.coalesce(*[F.when(F.col(f"n_{b}") >= spread.sample, F.lit(b)) for b in reversed(bounds)])
    found = counted.select("lang", "word", least.alias("bound"), f"n_{bounds[0]}").where("bound is not null")
    return found.orderBy(F.col(f"n_{bounds[0]}").desc(), "lang", "word").limit(spread.known).select("lang", "word", "bound")


def word_sketches(chunks: DataFrame, keys: Sequence[str], lang: str, chunk: str, spread: Spread) -> DataFrame:
    """Rows lang, word, chunks (hashes of the first), n_chunks (of all), for words of enough chunks."""
    # the hash comes before the explosion, else it would be made anew for every word
    named = chunks.where(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), chunk_hash(keys).alias("at"), F.col(chunk).alias("chunk"))
    words = named.select("lang", "at", F.explode(F.array_distinct(letter_words(F.col("chunk")))).alias("word"))
    bounds = materialize(frequent_words(words, spread), as_table=True)
    # all chunks of the few frequent words are counted in the tasks
    frequent = materialize(words.join(bounds, ["lang", "word"]).groupBy("lang", "word", "bound").agg(
        F.count("*").alias("n_all")), as_table=True)
    # what lies above a word's bound is in no sketch
    rows = words.join(frequent, ["lang", "word"], "left").where(F.col("bound").isNull() | (F.col("at") < F.col("bound")))
    # a number leads the sort: languages alone are long runs of equal prefixes
    listed = rows.groupBy(F.xxhash64("lang", "word").alias("h"), "lang", "word").agg(
        F.sort_array(F.collect_list("at")).alias("all"), F.coalesce(F.max("n_all"), F.count("*")).alias("n_chunks"))
    first = F.array_distinct(F.slice("all", 1, spread.sample))
    return listed.select("lang", "word", first.alias("chunks"), "n_chunks").where(F.size("chunks") >= spread.least_chunks)


def _whole(total: Column, n: Column) -> Column:
    return F.round(total / n).cast("long")


def _round(words: DataFrame, links: DataFrame, spread: Spread) -> DataFrame:
    """Polarity of all words after one more round. ``links``: at, lang, ids (of the chunk's words)."""
    held = words.select("lang", "polarity", F.explode("chunks").alias("at"))
    of_chunk = held.groupBy("at", "lang").agg(_whole(F.sum("polarity"), F.count("*")).alias("c"))
    near = (links.join(of_chunk, ["at", "lang"]).select("c", F.explode("ids").alias("id")).groupBy("id")
            .agg(F.sum("c").alias("total"), F.count("*").alias("n")))
    near = materialize(words.join(near, "id").drop("polarity"), as_table=True)
    middle = near.groupBy("lang").agg(_whole(F.sum("total"), F.sum("n")).alias("middle"))
    raw = near.join(middle, "lang").withColumn(
        "raw", _whole(F.col("total") - F.col("middle") * F.col("n"), F.col("n") + spread.shrink))
    width = raw.where("seed = 0").groupBy("lang").agg(_whole(F.sum(F.abs("raw")), F.count("*")).alias("width"))
    scaled = F.round(F.col("raw") * F.lit(float(spread.spread)) / F.col("width")).cast("long")
    polarity = (F.when(F.col("seed") != 0, F.col("seed") * F.lit(UNIT)).when(F.coalesce("width", F.lit(0)) == 0, 0)
                .otherwise(F.greatest(F.least(scaled, F.lit(UNIT)), F.lit(-UNIT))))
    return raw.join(width, "lang", "left").select("id", "lang", "word", "chunks", "n_chunks", "seed",
                                                  polarity.cast("long").alias("polarity"))


def learn_polarity(chunks: DataFrame, keys: Sequence[str], positive: Sequence[str], negative: Sequence[str], *,
                   lang: str = "lang", chunk: str = "chunk", spread: Spread = Spread()) -> DataFrame:
    """Rows lang, word, polarity (long, millionths) of the lexicon. ``keys`` name a chunk."""
    seed = (F.when(F.col("word").isin(*positive), 1).when(F.col("word").isin(*negative), -1).otherwise(0))
    words = word_sketches(chunks, keys, lang, chunk, spread).withColumn("seed", seed)
    # in the rounds a number stands for a word; it is stored, so that it stays the same
    words = materialize(words.withColumns({"polarity": (F.col("seed") * F.lit(UNIT)).cast("long"),
                                           "id": F.monotonically_increasing_id()}), as_table=True)
    # without a seed nothing spreads: such languages take no part in the rounds
    seeded = words.where("seed <> 0").select("lang").distinct()
    words = words.join(seeded, "lang", "left_semi")
    links = materialize(words.select("id", "lang", F.explode("chunks").alias("at")).groupBy("at", "lang").agg(
        F.collect_list("id").alias("ids")), as_table=True)
    for _ in range(spread.rounds):
        words = _round(words, links, spread)
    return ends_of_scale(words, spread)


def ends_of_scale(words: DataFrame, spread: Spread) -> DataFrame:
    """The seeds, and the words of both tails of each language's histogram of polarity."""
    placed = words.withColumn("bucket", F.floor(F.col("polarity") / spread.bucket))
    mass = placed.where("seed = 0").groupBy("lang", "bucket").agg(F.sum("n_chunks").alias("n"))
    order = Window.partitionBy("lang").orderBy("bucket").rangeBetween(Window.unboundedPreceding, 0)
    below, total = F.sum("n").over(order), F.sum("n").over(Window.partitionBy("lang"))
    ends = (mass.withColumns({"below": below, "total": total})
            .withColumn("above", F.col("total") - F.col("below") + F.col("n")))
    share = F.lit(spread.tail) * F.col("total")
    sides = ends.select("lang", "bucket", (F.col("below") * UNIT <= share).alias("low"),
                        (F.col("above") * UNIT <= share).alias("high"))
    chosen = (F.col("seed") != 0) | (F.col("low") & (F.col("polarity") < 0)) | (F.col("high") & (F.col("polarity") > 0))
    return placed.join(sides, ["lang", "bucket"], "left").where(chosen).select("lang", "word", "polarity")


def polarity_hits(chunks: DataFrame, keys: Sequence[str], lexicon: DataFrame, *, lang: str = "lang",
                  chunk: str = "chunk") -> DataFrame:
    """Columns ``keys`` and ``lang`` of every chunk, pos_hits and neg_hits: occurrences of words of
    either polarity. Chunks and hits meet in one aggregation, so chunks without any stay."""
    # the language may be null, which groups but does not join
    found = chunks.select(*keys, lang, F.explode(letter_words(F.col(chunk))).alias("word"))
    entry = lexicon.select(F.col("lang").alias("__lang"), "word", "polarity")
    hits = found.join(entry, (found[lang] == entry["__lang"]) & (found["word"] == entry["word"])).select(
        *keys, lang, (F.col("polarity") > 0).cast("int").alias("pos"), (F.col("polarity") < 0).cast("int").alias("neg"))
    none = chunks.select(*keys, lang, F.lit(0).alias("pos"), F.lit(0).alias("neg"))
    return (none.unionByName(hits).groupBy(*keys, lang)
            .agg(F.sum("pos").alias("pos_hits"), F.sum("neg").alias("neg_hits")))


# ------------------------------------------------------------------ SQL twin
def lexicon_sql(chunked: str, key: str, positive: Sequence[str], negative: Sequence[str], words: str,
                spread: Spread = Spread()) -> str:
    """DuckDB CTEs ending in ``lexicon`` (lang, word, polarity). ``chunked``: a relation with
    lang and the chunk; ``key``: the text of a chunk's key; ``words``: its list of words."""
    def listed(ws: Sequence[str]) -> str:
        return ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys(ws))

    out = f"""
pw AS (SELECT DISTINCT lang, substr(md5({key}), 1, 15) AS spot, unnest({words}) AS word FROM {chunked}),
edges AS (
  SELECT lang, word, spot FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, word ORDER BY spot) AS place,
           count(*) OVER (PARTITION BY lang, word) AS n FROM pw)
  WHERE place <= {spread.sample} AND n >= {spread.least_chunks}
),
seeds AS (
  SELECT DISTINCT lang, word, CASE WHEN word IN ({listed(positive)}) THEN 1
                                   WHEN word IN ({listed(negative)}) THEN -1 ELSE 0 END AS seed FROM edges
),
p0 AS (SELECT lang, word, seed, CAST(seed * {UNIT} AS BIGINT) AS p FROM seeds
       WHERE lang IN (SELECT lang FROM seeds WHERE seed <> 0))"""
    for r in range(1, spread.rounds + 1):
        out += f""",
c{r} AS (SELECT lang, spot, CAST(round(CAST(sum(p) AS DOUBLE) / count(*)) AS BIGINT) AS c
         FROM edges JOIN p{r - 1} USING (lang, word) GROUP BY lang, spot),
near{r} AS (SELECT lang, word, sum(c) AS total, count(*) AS n FROM edges JOIN c{r} USING (lang, spot) GROUP BY lang, word),
mid{r} AS (SELECT lang, CAST(round(CAST(sum(total) AS DOUBLE) / sum(n)) AS BIGINT) AS middle FROM near{r} GROUP BY lang),
raw{r} AS (SELECT lang, word, CAST(round(CAST(total - middle * n AS DOUBLE) / (n + {spread.shrink})) AS BIGINT) AS raw
           FROM near{r} JOIN mid{r} USING (lang)),
wid{r} AS (SELECT lang, CAST(round(CAST(sum(abs(raw)) AS DOUBLE) / count(*)) AS BIGINT) AS width
           FROM raw{r} JOIN p0 USING (lang, word) WHERE seed = 0 GROUP BY lang),
p{r} AS (
  SELECT lang, word, seed,
         CASE WHEN seed <> 0 THEN seed * {UNIT} WHEN coalesce(width, 0) = 0 THEN 0
              ELSE greatest(least(CAST(round(raw * CAST({spread.spread} AS DOUBLE) / width) AS BIGINT),
                                  {UNIT}), -{UNIT}) END AS p
  FROM raw{r} JOIN p0 USING (lang, word) LEFT JOIN wid{r} USING (lang)
)"""
    last = f"p{spread.rounds}"
    return out + f""",
placed AS (SELECT *, CAST(floor(p / CAST({spread.bucket} AS DOUBLE)) AS BIGINT) AS bucket FROM {last}
           JOIN (SELECT lang, word, count(*) AS n_chunks FROM pw GROUP BY lang, word) USING (lang, word)),
mass AS (SELECT lang, bucket, sum(n_chunks) AS n FROM placed WHERE seed = 0 GROUP BY lang, bucket),
sides AS (
  SELECT lang, bucket, below * {UNIT} <= {spread.tail} * total AS low,
         (total - below + n) * {UNIT} <= {spread.tail} * total AS high
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY lang) AS total
        FROM mass)
),
lexicon AS (
  SELECT lang, word, CAST(p AS BIGINT) AS polarity FROM placed LEFT JOIN sides USING (lang, bucket)
  WHERE seed <> 0 OR (low AND p < 0) OR (high AND p > 0)
)"""
