"""Language identification by ranked character n-grams.

A language's profile is its most frequent n-grams of letters in order, learnt from
texts whose language is known: any language with labelled text is offered, without a
word list. A text is compared by the out-of-place measure: its own most frequent
n-grams in order, and for each the distance of its place from the place in the
profile (the profile's length where it is not there); the least sum wins.

Learning counts words first and cuts only distinct words into n-grams, so what is
shuffled are counts of words and n-grams, summed before and after. Profiles have a
proven bound (``languages`` x ``top`` rows) and go to the tasks with the code;
labelling then works within each row, without a shuffle or a join. Profiles can be
stored and used on other texts (``learn_profiles``, ``label_by_profiles``).

A text is labelled ``und`` if it has fewer than ``least_grams`` n-grams, if no profile
was learnt, or if the runner-up is nearer than ``margin`` thousandths of the best sum.
Null texts have no n-grams. Equal sums go to the smaller code, equal counts to the
smaller n-gram, so results do not depend on the order of rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat
from sys import intern

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.operators.language import UNKNOWN
from ridgeline.operators.polarity import letter_words

Profiles = dict[str, dict[str, int]]


@dataclass(frozen=True)
class Ngrams:
    sizes: tuple[int, ...] = (1, 2, 3)
    top: int = 300            # n-grams of a profile
    languages: int = 64       # profiles, those of most text
    least_grams: int = 25     # occurrences below which a text is not judged
    margin: int = 20          # thousandths of the best sum


def learn_profiles(df: DataFrame, text: str, lang: str, ngrams: Ngrams = Ngrams(), *,
                   unknown: str = UNKNOWN) -> DataFrame:
    """Rows lang, gram, place (from 0) of the texts whose language is neither null nor ``unknown``."""
    words = (df.where(F.col(lang) != unknown).select(F.col(lang).alias("lang"), F.explode(letter_words(F.col(text))).alias("word"))
             .groupBy("lang", "word").agg(F.count("*").alias("n")))
    padded = F.concat(F.lit("_"), F.col("word"), F.lit("_"))

    def cuts(n: int) -> Column:
        places = F.when(F.length(padded) >= n, F.sequence(F.lit(1), F.length(padded) - (n - 1)))
        return F.coalesce(F.transform(places, lambda i: F.substring(padded, i, n)), F.array().cast("array<string>"))

    cut = F.concat(*[cuts(n) for n in ngrams.sizes])
    grams = (words.select("lang", "n", F.explode(cut).alias("gram")).where("gram <> '_'")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = (grams.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < ngrams.top)
              .select("lang", "gram", "place", "n"))
    # the languages of most text, by their n-grams
    mass = ranked.groupBy("lang").agg(F.sum("n").alias("m")).orderBy(F.col("m").desc(), "lang").limit(ngrams.languages)
    return ranked.join(mass, "lang", "left_semi").select("lang", "gram", "place")


def collect_profiles(profiles: DataFrame, ngrams: Ngrams = Ngrams()) -> Profiles:
    """Profiles as a dictionary; at most ``languages`` x ``top`` rows."""
    out: Profiles = {}
    for r in profiles.limit(ngrams.languages * ngrams.top).collect():
        out.setdefault(r["lang"], {})[r["gram"]] = r["place"]
    return out


@lru_cache(maxsize=50_000)
def grams_of(word: str, sizes: tuple[int, ...]) -> tuple[str, ...]:
    """N-grams of a word; equal ones are one object, however many remembered words have it."""
    p = f"_{word}_"
    return tuple(intern(g) for n in sizes for g in (p[i:i + n] for i in range(len(p) - n + 1)) if g != "_")


def text_grams(words: list[str], ngrams: Ngrams) -> tuple[list[str], int]:
    """A text's most frequent n-grams in order, and how many it has."""
    counts: Counter[str] = Counter()
    short = [w for w in words if len(w) < 64]
    for part in (short, [w for w in words if len(w) >= 64]):
        of = grams_of if part is short else grams_of.__wrapped__
        counts.update(chain.from_iterable(map(of, part, repeat(ngrams.sizes))))
    least = sorted(counts.values(), reverse=True)[:ngrams.top][-1:] or [0]
    ranked = sorted([(-n, g) for g, n in counts.items() if n >= least[0]])
    return [g for _, g in ranked[:ngrams.top]], counts.total()


def nearest(words: list[str], profiles: Profiles, ngrams: Ngrams) -> tuple[str | None, int | None, int | None]:
    """Language of the least out-of-place sum (None if not reliable), that sum and the runner-up's."""
    grams, n = text_grams(words, ngrams)
    if n < ngrams.least_grams or not profiles:
        return None, None, None
    sums = sorted((sum(abs(place[g] - i) if g in place else ngrams.top for i, g in enumerate(grams)), code)
                  for code, place in profiles.items())
    best, second = sums[0], sums[1][0] if len(sums) > 1 else None
    sure = second is None or (second - best[0]) * 1000 >= ngrams.margin * best[0]
    return best[1] if sure else None, best[0], second


def label_by_profiles(df: DataFrame, text: str, profiles: Profiles, ngrams: Ngrams = Ngrams(), *,
                      keep: tuple[str, ...], out: str = "detected", unknown: str | None = UNKNOWN) -> DataFrame:
    """Columns ``keep`` of ``df`` and out, best_distance, second_distance."""
    import regex

    rows = df.select(F.struct(*keep).alias("row"), F.lower(F.col(text)).alias("text"))
    letters = r"\p{L}+"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(letters).findall
        for batch in batches:
            found = [nearest(find(t) if t else [], profiles, ngrams) for t in (x.as_py() for x in batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([unknown if f[0] is None else f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                names=["row", "label", "best_distance", "second_distance"])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, label string, best_distance long, second_distance long"
    return rows.mapInArrow(run, schema).select("row.*", F.col("label").alias(out), "best_distance", "second_distance")


def label_language(df: DataFrame, text: str, lang: str, ngrams: Ngrams = Ngrams(), *, keep: tuple[str, ...],
                   out: str = "detected", unknown: str = UNKNOWN) -> DataFrame:
    """Learn the profiles from the labelled rows of ``df`` and label all of its rows."""
    profiles = collect_profiles(learn_profiles(df, text, lang, ngrams, unknown=unknown), ngrams)
    return label_by_profiles(df, text, profiles, ngrams, keep=keep, out=out, unknown=unknown)


# ------------------------------------------------------------------ SQL twin
def label_sql(source: str, key: str, words: str, ngrams: Ngrams = Ngrams(), unknown: str = UNKNOWN) -> str:
    """DuckDB CTEs ending in ``by_ngrams`` (key, lang, detected, best_distance, second_distance)."""
    p = "'_' || word || '_'"
    cut = "list_concat(" + ", ".join(
        f"[substr({p}, i, {n}) for i in range(1, length({p}) - {n} + 2)]" for n in ngrams.sizes[:2]) + ")"
    for n in ngrams.sizes[2:]:
        cut = f"list_concat({cut}, [substr({p}, i, {n}) for i in range(1, length({p}) - {n} + 2)])"
    return f"""
ng_words AS (SELECT {key}, lang, word, count(*) AS n FROM (SELECT {key}, lang, unnest({words}) AS word FROM {source})
             GROUP BY {key}, lang, word),
ng_grams AS (SELECT {key}, lang, gram, sum(n) AS n FROM (SELECT {key}, lang, n, unnest({cut}) AS gram FROM ng_words)
             WHERE gram <> '_' GROUP BY {key}, lang, gram),
ng_profile AS (
  SELECT lang, gram, place FROM (
    SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, gram) - 1 AS place
    FROM ng_grams WHERE lang <> '{unknown}' GROUP BY lang, gram)
  WHERE place < {ngrams.top}
),
ng_text AS (
  SELECT * FROM (SELECT {key}, gram, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, gram) - 1 AS place,
                        sum(n) OVER (PARTITION BY {key}) AS total FROM ng_grams)
  WHERE place < {ngrams.top} AND total >= {ngrams.least_grams}
),
ng_sums AS (
  SELECT t.{key}, c.lang AS code, sum(coalesce(abs(p.place - t.place), {ngrams.top})) AS s
  FROM ng_text t, (SELECT DISTINCT lang FROM ng_profile) c
  LEFT JOIN ng_profile p ON p.lang = c.lang AND p.gram = t.gram GROUP BY t.{key}, c.lang
),
ng_best AS (
  SELECT {key}, max(CASE WHEN r = 1 THEN code END) AS code, max(CASE WHEN r = 1 THEN s END) AS s1,
         max(CASE WHEN r = 2 THEN s END) AS s2
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY s, code) AS r FROM ng_sums) GROUP BY {key}
),
by_ngrams AS (
  SELECT d.{key}, d.lang,
         CASE WHEN b.code IS NOT NULL AND (s2 IS NULL OR (s2 - s1) * 1000 >= {ngrams.margin} * s1) THEN b.code
              ELSE '{unknown}' END AS detected,
         CAST(s1 AS BIGINT) AS best_distance, CAST(s2 AS BIGINT) AS second_distance
  FROM {source} d LEFT JOIN ng_best b ON d.{key} = b.{key}
)"""
