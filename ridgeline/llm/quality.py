"""Quality rules: fixed base rules, then distribution divergence.

A document's histogram of character classes and of common words is compared to
references of its language by Jensen-Shannon distance. References are means
over all documents of a language, one row per value of ``lang``.
Only DataFrame functions are used.

Null text counts as empty: no words, so the base rule rejects it. Texts under
the minimum lengths are not judged by the histograms. A language without
common words here is judged by its character classes only, one without a
reference not at all; a null language is compared to every reference. Repeated rows get the same result
each. Columns of the input never clash with the operator's: they travel inside
one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import SPACE, let, stored, words_of

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that".split(),
    "de": "der die und in den von zu das".split(),
    "fr": "de la le et les des en un".split(),
    "es": "de la que el en y a los".split(),
}
SYMBOLS = r"[#*$%&|<>]"
#: Character classes; beside them ``wide`` (bytes that UTF-8 needs beyond one a
#: character) and the rest, which are lower-case ASCII letters in most languages.
CLASSES = {"upper": r"[A-Z]", "digit": r"[0-9]", "stop": r"[.,;:!?'\"()-]", "symbol": SYMBOLS}
#: Bits of a window's place in window_keys.
PLACE_BITS = 21
VOCABULARY = sorted({w for ws in COMMON_WORDS.values() for w in ws})


@dataclass(frozen=True)
class QualityRules:
    """Thresholds. Distances are Jensen-Shannon, base 2, from 0 to 1."""

    min_words: int = 50            # base rule
    max_repeat_pct: int = 50       # base rule: share of words in repeated 3-word windows
    char_words: int = 50           # words from which the character classes are judged
    word_words: int = 200          # words from which the common words are judged
    max_char_distance: float = 0.14    # of an endless text; short ones vary more, so
    char_slack: float = 0.9            # char_slack / sqrt(words) is added
    max_word_distance: float = 0.255
    min_documents: int = 20        # that make a reference of a language not in COMMON_WORDS


def _windows(words: Column, size: int, item) -> Column:
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), item))


def window_keys(words: Column, size: int = 3) -> Column:
    """One long for each window of ``size`` words: a hash of the words above
    PLACE_BITS bits of its place."""
    return _windows(words, size, lambda i: F.shiftleft(
        F.xxhash64(*[words[i + k] for k in range(size)]), PLACE_BITS).bitwiseOR(i.cast("long")))


def repeated_window_words(words: Column, keys: Column, size: int = 3) -> Column:
    """Words covered by a window of ``size`` words that occurs twice or more in the
    text. ``keys``: window_keys in ascending order, so that equal windows are
    neighbours. The words of neighbours are compared too; a text in which two
    different windows share a hash, or with more windows than places, is done by
    sorting the windows themselves."""
    step = F.lit(1 << PLACE_BITS)
    place = lambda j: keys[j].bitwiseAND(step - 1).cast("int")
    same = F.filter(F.sequence(F.lit(0), F.size(keys) - 2),
                    lambda j: F.shiftrightunsigned(keys[j].bitwiseXOR(keys[j + 1]), PLACE_BITS) == 0)
    differ = lambda j: ~(F.slice(words, place(j) + 1, size) == F.slice(words, place(j + 1) + 1, size))
    cover = lambda p: [p + k for k in range(size)]
    count = lambda pairs: F.size(F.array_distinct(F.flatten(
        F.transform(pairs, lambda j: F.array(*cover(place(j)), *cover(place(j + 1)))))))
    plain = F.size(words) < (1 << PLACE_BITS)
    by_hash = let(same, lambda pairs: F.when(plain & ~F.exists(pairs, differ), count(pairs)))
    return (F.when(F.size(words) <= size, F.lit(0))
            .otherwise(F.coalesce(by_hash, _repeated_by_words(words, size))))


def _repeated_by_words(words: Column, size: int) -> Column:
    windows = _windows(words, size, lambda i: F.struct(
        F.concat_ws(" ", *[words[i + k] for k in range(size)]).alias("w"), i.alias("i")))

    def covered(s: Column) -> Column:
        pairs = F.filter(F.sequence(F.lit(0), F.size(s) - 2), lambda j: s[j]["w"] == s[j + 1]["w"])
        return F.size(F.array_distinct(F.flatten(F.transform(pairs, lambda j: F.array(
            *[s[j]["i"] + k for k in range(size)], *[s[j + 1]["i"] + k for k in range(size)])))))

    return let(F.array_sort(windows), covered)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda v: F.size(v) - F.size(F.array_distinct(v)))


def quality_features(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """Struct ``doc`` with the input row, and ``f``: word and line counts and the two
    histograms (``chars`` by class, ``common`` by word of VOCABULARY, then the rest)."""
    t = F.coalesce(F.col("doc")[text], F.lit(""))
    df = docs.select(F.struct("*").alias("doc"))
    df = df.select("doc", F.col("doc")[lang].alias("lang"), t.alias("text"), words_of(t).alias("words"))
    long = lambda c: c.cast("long")
    common = F.filter(F.transform("words", F.lower), lambda w: w.isin(VOCABULARY))
    df = df.select(
        "doc", "lang", "text", "words", long(F.size("words")).alias("n_words"),
        window_keys(F.col("words")).alias("keys"),
        long(F.char_length(F.array_join("words", ""))).alias("word_chars"),
        long(F.octet_length("text") - F.char_length("text")).alias("wide"),
        F.concat(F.lit(" "), F.array_join(common, "  "), F.lit(" ")).alias("hits"),
        *[long(F.regexp_count("text", F.lit(p))).alias(k) for k, p in CLASSES.items()])
    df = df.withColumn("keys", F.sort_array("keys"))
    hit = [(F.length("hits") - F.length(F.replace("hits", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)
           for w in VOCABULARY]
    df = df.withColumn("counts", F.array(*[long(F.round(h)) for h in hit]))
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    lower = F.greatest(F.lit(0), F.col("word_chars") - sum(F.col(k) for k in CLASSES))
    return df.select("doc", "lang", F.struct(
        "n_words", "word_chars", F.col("symbol").alias("n_symbols"),
        long(duplicate_lines(F.col("text"))).alias("n_dup_lines"),
        long(repeated_window_words(F.col("words"), F.col("keys"))).alias("n_repeat_words"),
        F.array(lower, *CLASSES, "wide").alias("chars"),
        F.concat("counts", F.array(F.col("n_words") - total)).alias("common")).alias("f"))


def _shares(counts: Column) -> Column:
    total = F.greatest(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x), F.lit(1.0))
    return let(total, lambda n: F.transform(counts, lambda c: c / n))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.when(total < 0, 0.0).otherwise(total))     # null where a side is null


def base_failed(f: Column, rules: QualityRules) -> Column:
    return (f["n_words"] < rules.min_words) | (100 * f["n_repeat_words"] > rules.max_repeat_pct * f["n_words"])


def language_references(features: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Mean shares (lang, chars, common) by value of lang over all documents that are long
    enough; ``common`` is null for languages without common words. Written once, so that
    joins see its real size."""
    rows = (features.where(F.col("lang").isNotNull() & (F.col("f.n_words") >= rules.min_words))
            .select("lang", _shares(F.col("f.chars")).alias("c"), _shares(F.col("f.common")).alias("w")))
    mean = lambda name, n: F.array(*[F.avg(F.col(name)[i]) for i in range(n)])
    known = F.col("lang").isin(list(COMMON_WORDS))
    out = rows.groupBy("lang").agg(mean("c", len(CLASSES) + 2).alias("chars"),
                                   mean("w", len(VOCABULARY) + 1).alias("common"), F.count("*").alias("n"))
    return stored(out.where(known | (F.col("n") >= rules.min_documents))
                  .select("lang", "chars", F.when(known, F.col("common")).alias("common")))


def judge_quality(features: DataFrame, references: DataFrame,
                  rules: QualityRules = QualityRules()) -> DataFrame:
    """Adds ``base_failed``, the distances to the reference of the row's lang (the least to
    any where it is null; null where not judged) and ``kept``."""
    own = references.select(F.col("lang").alias("__lang"), F.struct("chars", "common").alias("own"))
    every = references.agg(F.collect_list(F.struct("chars", "common")).alias("every"))
    df = features.join(own, F.col("lang") == F.col("__lang"), "left").crossJoin(F.broadcast(every))

    def near(shares: Column, key: str) -> Column:
        least = F.array_min(F.transform("every", lambda r: js_distance(shares, r[key])))
        return F.when(F.col("lang").isNull(), least).otherwise(js_distance(shares, F.col("own")[key]))

    n = F.col("f.n_words")
    df = df.withColumns({
        "char_distance": F.when(n >= rules.char_words, near(_shares(F.col("f.chars")), "chars")),
        "word_distance": F.when(n >= rules.word_words, near(_shares(F.col("f.common")), "common")),
        "base_failed": base_failed(F.col("f"), rules)}).drop("__lang", "own", "every")
    most = rules.max_char_distance + rules.char_slack / F.sqrt(F.greatest(n, F.lit(1)))
    far = (F.coalesce(F.col("char_distance") > most, F.lit(False))
           | F.coalesce(F.col("word_distance") > rules.max_word_distance, F.lit(False)))
    return df.withColumn("kept", ~(F.col("base_failed") | far))


def quality_filter(docs: DataFrame, rules: QualityRules = QualityRules(), *, text: str = "text",
                   lang: str = "lang") -> DataFrame:
    """Rows of ``docs`` that the rules keep, unchanged. The rows are written once with
    their features, which both the references and the verdicts read."""
    features = stored(quality_features(docs, text=text, lang=lang), texts=True)
    return judge_quality(features, language_references(features, rules), rules).where("kept").select("doc.*")
