"""Route by language, chunk, score chunks, normalise labels, count
and vote -- one job for every language instead of one script per language.

Chunks are scored by a word list counted with one regular-expression scan per
chunk (JVM-side, no Python worker, no shuffle), or by a lexicon learnt from the
corpus (``operators.polarity``). A user-supplied
model can be plugged in with ``score_chunks_with`` (Arrow batches through
``mapInPandas``; the callable is created once per Python worker).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.rules import NEGATIVE, NEUTRAL, POSITIVE, majority_label
from ridgeline.operators.polarity import polarity_hits

# ---- fixed values: polarity word lists ------------------------------------
POSITIVE_WORDS = (
    "good great best love happy joy win free beautiful wonderful haha "
    "bon bien heureux amour joie belle "
    "gut liebe glück schön froh "
    "bueno feliz amor alegría bonito"
).split()
NEGATIVE_WORDS = (
    "bad worst hate sad fail lose pain awful terrible "
    "idiot pathetic moron disgusting loser clown worthless trash stupid scum "
    "mauvais triste haine douleur mal "
    "schlecht hass traurig schmerz "
    "malo odio triste dolor"
).split()
# --------------------------------------------------------------------------

# ---- fixed values: one route per language (label rule, chunking) -----------
# rule names as in ridgeline.functions.rules.normalise_label; chunking is
# (mode, size): code-point slices or whitespace-token groups.
LANGUAGE_ROUTES = {
    "fr": ("stars", "chars", 512), "en": ("stars", "chars", 512), "nl": ("stars", "chars", 512),
    "it": ("stars", "chars", 512), "es": ("stars", "chars", 512),
    "ms": ("identity", "chars", 512), "pt": ("identity", "chars", 512),
    "id": ("identity", "chars", 512), "zh": ("identity", "chars", 512),
    "zh-Hant": ("identity", "chars", 512), "ja": ("identity", "chars", 512),
    "ko": ("binary_threshold", "chars", 512), "bg": ("binary_threshold", "chars", 512),
    "ro": ("binary_threshold", "chars", 512),
    "pl": ("identity", "chars", 512),
    "ru": ("lower", "chars", 512),
    "sv": ("mapping", "chars", 512),
    "sk": ("signed", "tokens", 500),
    "fil": ("binary", "tokens", 500), "tl": ("binary", "tokens", 500),
    "th": ("mapping", "chars", 512),
    "tr": ("mapping", "chars", 512),
    "vi": ("mapping", "chars", 256),
}
LABEL_MAPS = {
    "sv": {"NEGATIVE": "negative", "POSITIVE": "positive", "NEUTRAL": "neutral"},
    "th": {"neg": "negative", "pos": "positive", "neu": "neutral"},
    "tr": {"Notr": "neutral", "Positive": "positive", "Negative": "negative"},
    "vi": {"Tiêu cực": "negative", "Tích cực": "positive", "Trung tính": "neutral"},
}
# --------------------------------------------------------------------------


def explode_chunks_by_language(df: DataFrame, text: str, lang: str, *,
                               routes: Mapping[str, tuple[str, str, int]] = LANGUAGE_ROUTES,
                               pos: str = "chunk_no", out: str = "chunk") -> DataFrame:
    """E2-E4 for every language in one pass: each row is cut with its
    language's chunking (character slices or token groups, per-language
    size). Rows of languages without a route are dropped (see
    ``unrouted``)."""
    def case(i):
        e = None
        for code, r in routes.items():
            e = F.when(F.col(lang) == code, F.lit(r[i])) if e is None else \
                e.when(F.col(lang) == code, F.lit(r[i]))
        return e

    keep = [c for c in df.columns if c != text]
    t = F.col(text)
    norm = F.trim(F.regexp_replace(t, r"\s+", " "))
    base = df.select(*keep, t.alias("__t"), case(1).alias("__mode"), case(2).alias("__size"),
                     # only texts cut by tokens are split
                     F.when((case(1) == "tokens") & (norm != ""), F.split(norm, " ")).alias("__toks")) \
        .filter(F.col("__mode").isNotNull())
    units = F.when(F.col("__mode") == "chars", F.length("__t")).otherwise(F.size("__toks"))
    n = F.ceil(units / F.col("__size")).cast("int")
    ex = base.select(*keep, "__t", "__mode", "__size", "__toks",
                     F.posexplode(F.when(units > 0, F.sequence(F.lit(0), n - 1))).alias(pos, "__i"))
    start = F.col("__i") * F.col("__size") + 1
    chunk = F.when(F.col("__mode") == "chars", F.col("__t").substr(start, F.col("__size"))) \
        .otherwise(F.array_join(F.slice("__toks", start, F.col("__size")), " "))
    return ex.select(*keep, pos, chunk.alias(out))


def raw_label_by_language(lang: str, *, routes: Mapping[str, tuple[str, str, int]] = LANGUAGE_ROUTES,
                          maps: Mapping[str, Mapping[str, str]] = LABEL_MAPS) -> Column:
    """E5: the scorer's raw label in the vocabulary of the row's route: stars,
    two classes, signs, the route's own mood names or plain moods. Needs the
    columns of ``score_chunks_lexicon``."""
    def pick(pos: str, neu: str, neg: str) -> Column:
        return (F.when(F.col("pos_hits") > F.col("neg_hits"), F.lit(pos))
                .when(F.col("neg_hits") > F.col("pos_hits"), F.lit(neg)).otherwise(F.lit(neu)))

    e = None
    for code, (rule, _, _) in routes.items():
        if rule == "mapping":
            names = {mood: raw for raw, mood in maps[code].items()}
            v = pick(names[POSITIVE], names[NEUTRAL], names[NEGATIVE])
        else:
            v = {"stars": F.col("stars"), "signed": pick("1", "0", "-1")}.get(
                rule, F.col("label") if rule.startswith("binary") else pick(POSITIVE, NEUTRAL, NEGATIVE))
        e = F.when(F.col(lang) == code, v) if e is None else e.when(F.col(lang) == code, v)
    return e


def normalise_by_language(label: str, score: str, lang: str, *,
                          routes: Mapping[str, tuple[str, str, int]] = LANGUAGE_ROUTES,
                          maps: Mapping[str, Mapping[str, str]] = LABEL_MAPS,
                          threshold: float = 0.75) -> Column:
    """E6 for every language at once: the label rule of each row's language
    (one CASE over the fixed route table, no join)."""
    from ridgeline.functions.rules import normalise_label

    e = None
    for code, (rule, _, _) in routes.items():
        v = normalise_label(label, score, rule, mapping=maps.get(code), threshold=threshold)
        e = F.when(F.col(lang) == code, v) if e is None else e.when(F.col(lang) == code, v)
    return e


def route_by_language(df: DataFrame, lang: str, routes: Mapping[str, str],
                      out: str = "route") -> DataFrame:
    """Keep rows whose language has a route and add the route name.
    Routes are a fixed, small mapping: a CASE expression, no join."""
    expr = None
    for code, route in routes.items():
        expr = F.when(F.col(lang) == code, F.lit(route)) if expr is None else \
            expr.when(F.col(lang) == code, F.lit(route))
    return df.withColumn(out, expr).filter(F.col(out).isNotNull())


def unrouted(df: DataFrame, lang: str, routes: Mapping[str, str]) -> DataFrame:
    """Languages present in the data without a route, with row counts."""
    return (df.filter(~F.col(lang).isin(list(routes)) | F.col(lang).isNull())
            .groupBy(lang).agg(F.count(F.lit(1)).alias("n_rows")))


def explode_chunks(df: DataFrame, text: str, *, mode: str = "chars", size: int = 512,
                   pos: str = "chunk_no", out: str = "chunk") -> DataFrame:
    """Split text into chunks (``chars``: code-point slices,
    ``tokens``: whitespace tokens) and explode them with their position. An
    empty chunk list drops the row (plain ``posexplode``).

    Character chunks are generated as chunk numbers (``sequence``) and cut
    with ``substring`` after the explode, which keeps the step inside
    whole-stage code generation (no lambda functions)."""
    keep = [c for c in df.columns if c != text]
    if mode == "chars":
        t = F.col(text)
        n = F.ceil(F.length(t) / F.lit(size)).cast("int")
        idx = F.when(F.length(t) > 0, F.sequence(F.lit(0), n - 1))
        ex = df.select(*keep, t.alias("__t"), F.posexplode(idx).alias(pos, "__i"))
        return ex.select(*keep, pos, F.col("__t").substr(F.col("__i") * size + 1, F.lit(size))
                         .alias(out))
    # Whitespace runs -> one space, trimmed, so a plain split yields only
    # non-empty tokens; chunk numbers are exploded and each chunk is a slice.
    norm = F.trim(F.regexp_replace(F.col(text), r"\s+", " "))
    toks = F.when(norm != "", F.split(norm, " "))
    n = F.ceil(F.size("__toks") / F.lit(size)).cast("int")
    ex = (df.select(*keep, toks.alias("__toks"))
          .select(*keep, "__toks",
                  F.posexplode(F.when(F.col("__toks").isNotNull(), F.sequence(F.lit(0), n - 1)))
                  .alias(pos, "__i")))
    return ex.select(*keep, pos, F.array_join(
        F.slice("__toks", F.col("__i") * size + 1, F.lit(size)), " ").alias(out))


def _word_pattern(words: Sequence[str]) -> str:
    alt = "|".join(re.escape(w) for w in sorted(dict.fromkeys(words), key=lambda w: (-len(w), w)))
    return rf"(?<!\p{{L}})(?:{alt})(?!\p{{L}})"


def score_chunks_lexicon(df: DataFrame, chunk: str = "chunk", *,
                         positive: Sequence[str] = POSITIVE_WORDS,
                         negative: Sequence[str] = NEGATIVE_WORDS) -> DataFrame:
    """E5 (default scorer): counts of positive and negative lexicon words in
    the chunk (whole lower-cased letter-run tokens), and the scorer's raw
    outputs in two common shapes: ``stars`` ('1 star' .. '5 stars',
    3 + clipped difference) and a two-class ``label``/``score`` pair
    (LABEL_1 when positive >= negative; score = (winner + 1) / (total + 2))."""
    # One regex scan per chunk extracts every lexicon word; the (short)
    # array of matches is then split by polarity.
    found = F.regexp_extract_all(F.lower(F.col(chunk)), F.lit(_word_pattern(list(positive) + list(negative))), 0)
    pos_arr = F.array(*[F.lit(w) for w in dict.fromkeys(positive)])
    neg_arr = F.array(*[F.lit(w) for w in dict.fromkeys(negative)])
    out = (df.withColumn("__found", found)
           .withColumn("pos_hits", F.size(F.filter("__found", lambda w: F.array_contains(pos_arr, w))))
           .withColumn("neg_hits", F.size(F.filter("__found", lambda w: F.array_contains(neg_arr, w))))
           .drop("__found"))
    return raw_outputs(out)


def raw_outputs(df: DataFrame) -> DataFrame:
    """``stars``, ``label`` and ``score`` from the columns pos_hits and neg_hits."""
    diff = F.least(F.greatest(F.col("pos_hits") - F.col("neg_hits"), F.lit(-2)), F.lit(2)) + 3
    stars = F.when(diff == 1, F.lit("1 star")).otherwise(F.concat(diff.cast("string"), F.lit(" stars")))
    win = F.greatest("pos_hits", "neg_hits")
    return (df.withColumn("stars", stars)
            .withColumn("label", F.when(F.col("pos_hits") >= F.col("neg_hits"), F.lit("LABEL_1"))
                        .otherwise(F.lit("LABEL_0")))
            .withColumn("score", (win + 1) / (F.col("pos_hits") + F.col("neg_hits") + 2)))


def score_chunks_polarity(chunks: DataFrame, keys: Sequence[str], lexicon: DataFrame, *, lang: str = "lang",
                          chunk: str = "chunk") -> DataFrame:
    """E5 (learnt scorer): the same outputs from the polarity lexicon of the corpus
    (``operators.polarity``), one row per chunk: keys, lang, hits, stars, label, score."""
    return raw_outputs(polarity_hits(chunks, keys, lexicon, lang=lang, chunk=chunk))


def score_chunks_with(df: DataFrame, make_scorer: Callable[[], Callable], chunk: str = "chunk",
                      label: str = "label", score: str = "score") -> DataFrame:
    """E5 (plug-in scorer): ``make_scorer()`` is called once per Python
    worker and returns ``f(list[str]) -> list[(label, score)]``; chunks go to
    it in Arrow batches."""
    schema = T.StructType(list(df.schema.fields) + [T.StructField(label, T.StringType()),
                                                     T.StructField(score, T.DoubleType())])

    def run(batches):
        f = make_scorer()
        for pdf in batches:
            res = f(pdf[chunk].tolist())
            pdf[label] = [r[0] for r in res]
            pdf[score] = [float(r[1]) for r in res]
            yield pdf

    return df.mapInPandas(run, schema)


def count_labels(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Per key, chunks labelled positive / neutral / negative (NULL
    labels count nowhere)."""
    def n(v):
        return F.sum(F.when(F.col(label) == v, 1).otherwise(0)).alias(f"{v}_count")

    return df.groupBy(*keys).agg(n(POSITIVE), n(NEUTRAL), n(NEGATIVE))


def vote(df: DataFrame, out: str = "mood") -> DataFrame:
    """Strict majority over the three counts."""
    return df.withColumn(out, majority_label("positive_count", "neutral_count", "negative_count"))
