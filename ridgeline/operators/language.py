"""Language detection from a word profile, re-labelling of unknown
values, distinct and frequent values.

Detection by words counts the hits of each language's words in a text. For a
fixed list this happens within the row (``label_by_words``); for a profile given
as a frame the texts' letter runs are joined to it and counted per document and
language (``detect_language``). ``operators.ngrams`` learns n-gram profiles.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# ---- fixed values: function words per language ---------------------------
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was on with be as by this are at from an or".split(),
    "fr": "le la les des et un une est que qui dans pour sur par du au aux avec pas elle".split(),
    "de": "der die das und den von zu mit sich auf des ist nicht dem ein eine im für als".split(),
    "es": "el la los las de que y en del por con una para es se al lo como más su".split(),
    "it": "il di che e la per un non una sono della con gli le del questo ma".split(),
    "pt": "o a os as de que e do da em um uma para com não por mais se".split(),
    "nl": "de het een en van in is dat op te met voor niet zijn aan er".split(),
}
# --------------------------------------------------------------------------

UNKNOWN = "und"


def profile_rows(words: Mapping[str, Sequence[str]] = FUNCTION_WORDS, *,
                 distinctive: bool = True) -> list[tuple[str, str]]:
    """(token, language) pairs of a word list. With ``distinctive`` a word
    listed for several languages is left out, so every hit votes for one
    language only."""
    pairs = [(w, lang) for lang, ws in words.items() for w in dict.fromkeys(ws)]
    if not distinctive:
        return pairs
    seen: dict[str, int] = {}
    for w, _ in pairs:
        seen[w] = seen.get(w, 0) + 1
    return [(w, lang) for w, lang in pairs if seen[w] == 1]


def profile_frame(spark: SparkSession, words: Mapping[str, Sequence[str]] = FUNCTION_WORDS,
                  *, distinctive: bool = True) -> DataFrame:
    """(token, language) rows of a fixed word list."""
    return spark.createDataFrame(profile_rows(words, distinctive=distinctive),
                                 "token string, language string")


def detect_language(df: DataFrame, key: str, text: str, *, profile: DataFrame | None = None,
                    min_hits: int = 3, min_ratio: float = 2.0, out: str = "detected",
                    unknown: str | None = UNKNOWN) -> DataFrame:
    """One row per input key with the detected language.

    A language counts one hit per token of the text found in its profile.
    The best language is reliable when it has at least ``min_hits`` hits and
    at least ``min_ratio`` times the hits of the runner-up; otherwise the
    result is ``unknown`` (``'und'``; pass None for NULL). Texts without
    any hit also get ``unknown``. Ties on hits go to the smaller code.
    Returns (key, out, best_hits, second_hits).
    """
    # The built-in profile is a fixed word list (a proven size bound), so it
    # is broadcast; a caller's profile is joined without a hint and AQE
    # broadcasts it only if its measured size is small.
    prof = F.broadcast(profile_frame(df.sparkSession)) if profile is None else profile
    # Empty strings from the split never match the profile, so no filter
    # (and no lambda) is needed before the join.
    toks = df.select(F.col(key), F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}]+"))
                     .alias("token"))
    hits = (toks.join(prof, "token")
            .groupBy(key, "language").agg(F.count(F.lit(1)).alias("hits")))
    # At most one row per profile language per key: the arrays are bounded.
    per_doc = hits.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.negative(F.col("hits")).alias("nh"),
                                             F.col("language").alias("lang")))).alias("__ranked"),
    )
    best = F.get(F.col("__ranked"), 0)
    second_hits = F.coalesce(-F.get(F.col("__ranked"), 1)["nh"], F.lit(0))
    best_hits = -best["nh"]
    reliable = (best_hits >= min_hits) & (best_hits >= F.lit(min_ratio) * second_hits)
    unk = F.lit(unknown).cast("string")
    labelled = per_doc.select(
        F.col(key),
        F.when(reliable, best["lang"]).otherwise(unk).alias(out),
        best_hits.cast("long").alias("best_hits"),
        second_hits.cast("long").alias("second_hits"),
    )
    everyone = df.select(key).distinct()
    return everyone.join(labelled, key, "left").select(
        key, F.coalesce(F.col(out), unk).alias(out),
        F.coalesce("best_hits", F.lit(0).cast("long")).alias("best_hits"),
        F.coalesce("second_hits", F.lit(0).cast("long")).alias("second_hits"))


def label_by_words(df: DataFrame, text: str, *, words: Mapping[str, Sequence[str]] = FUNCTION_WORDS,
                   min_hits: int = 3, min_ratio: float = 2.0, out: str = "detected",
                   unknown: str | None = UNKNOWN) -> DataFrame:
    """D10 for a fixed word list, within each row: the columns of ``df`` and out, best_hits and
    second_hits by the rules of ``detect_language``, without a join or a shuffle. One scan of
    the text finds all listed words; they are then counted per language."""
    by_lang: dict[str, list[str]] = {}
    for w, lang in profile_rows(words):
        by_lang.setdefault(lang, []).append(w)
    alt = "|".join(re.escape(w) for w in sorted((w for ws in by_lang.values() for w in ws), key=lambda w: (-len(w), w)))
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"(?<!\p{{L}})(?:{alt})(?!\p{{L}})"), 0)

    def count(lang: str) -> Column:
        listed = F.array(*[F.lit(w) for w in by_lang[lang]])
        n = F.size(F.filter("__found", lambda w: F.array_contains(listed, w)))
        return F.struct((-n).cast("long").alias("minus"), F.lit(lang).alias("lang"))

    marked = df.withColumn("__found", F.coalesce(found, F.array().cast("array<string>"))).withColumn(
        "__ranked", F.array_sort(F.array(*[count(lang) for lang in by_lang])))
    best, second = F.get("__ranked", F.lit(0)), F.get("__ranked", F.lit(1))
    best_hits, second_hits = -best["minus"], -second["minus"]
    reliable = (best_hits >= min_hits) & (best_hits >= F.lit(min_ratio) * second_hits)
    return (marked.withColumns({out: F.when(reliable, best["lang"]).otherwise(F.lit(unknown).cast("string")),
                                "best_hits": best_hits, "second_hits": second_hits}).drop("__found", "__ranked"))


def recheck_unknown(df: DataFrame, col: str, detected: str, *, sentinel: str = "no",
                    drop_null: bool = False) -> DataFrame:
    """Replace the sentinel by the detected value in one pass.
    ``drop_null=True`` reproduces splitting on ``= sentinel`` / ``!= sentinel``,
    where NULL rows satisfy neither side and vanish."""
    out = df.withColumn(col, F.when(F.col(col) == sentinel, F.col(detected)).otherwise(F.col(col)))
    return out.filter(F.col(col).isNotNull()) if drop_null else out


def distinct_values(df: DataFrame, col: str, sentinel: str | None = None) -> DataFrame:
    """Distinct values except the sentinel (``!=`` also drops NULL)."""
    base = df if sentinel is None else df.filter(F.col(col) != sentinel)
    return base.select(col).distinct()


def frequent_values(df: DataFrame, col: str, n: int, sentinel: str | None = None,
                    count: str | None = None) -> DataFrame:
    """Values with strictly more than n rows."""
    base = df if sentinel is None else df.filter(F.col(col) != sentinel)
    agg = base.groupBy(col).agg(F.count(F.lit(1)).alias(count or "__n")).filter(
        F.col(count or "__n") > n)
    return agg if count else agg.select(col)


def keep_frequent(df: DataFrame, col: str, text: str, n: int,
                  sentinel: str | None = None) -> DataFrame:
    """Rows with non-NULL text and a frequent value. Frequency counts
    all rows of the value, NULL-text rows included. The frequent set has one
    row per distinct value; the semi join lets AQE broadcast it when small."""
    freq = frequent_values(df, col, n, sentinel)
    base = df.filter(F.col(col).isNotNull() & F.col(text).isNotNull())
    if sentinel is not None:
        base = base.filter(F.col(col) != sentinel)
    return base.join(freq, col, "left_semi")
