"""Text assembly, matching, anti-matching, decoding.

Scale notes:
* A match is always joined against a frame that is unique on the join key
  (the corpus is pre-aggregated per key first), so a popular title never
  produces items x documents pairs.
* Consolidation keeps distributive statistics (document count, characters,
  language); concatenated text is built only per assembly key
  (``assemble_text``), ordered explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_items(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (cols); an id with two spellings stays twice."""
    return df.select(*cols).distinct()


def _ordered_concat(text: str, order: Sequence[str], sep: str) -> Column:
    """What ``listagg(text, sep) WITHIN GROUP (ORDER BY order)`` gives, with each text held once:
    listagg holds a text that is also ordered by twice, and joins in a buffer that doubles."""
    before = order[:order.index(text)] if text in order else order  # equal texts take any order
    own = [F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(before)]
    t = F.col(f"`{text}`")
    parts = F.collect_list(F.when(t.isNotNull(), F.struct(*own, t.alias("text"))))
    return F.when(F.size(parts) > 0, F.concat_ws(sep, F.sort_array(parts)["text"]))


def assemble_text(df: DataFrame, key: str | Sequence[str], text: str, order: Sequence[str], *,
                  exclude: tuple[str, Sequence[str]] | None = None,
                  keep_max: Sequence[str] = (), sep: str = " ", out: str | None = None,
                  parts: str | None = "n_parts") -> DataFrame:
    """D3: join all text parts of a key in ``order``; keep ``max`` of other
    columns.

    ``exclude=(col, values)`` drops a category first; like ``col != v`` it
    also drops NULL categories. NULL texts are skipped. The order is explicit
    (nulls first), so the result is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if exclude is not None:
        c, vals = exclude
        df = df.filter(~F.col(c).isin(list(vals)))
    aggs = [_ordered_concat(text, order, sep).alias(out or text)]
    aggs += [F.max(c).alias(c) for c in keep_max]
    if parts:
        aggs.append(F.count(text).alias(parts))
    return df.groupBy(*keys).agg(*aggs)


def text_stats_by(df: DataFrame, key: Sequence[str], text: str, *, lang: str | None = None,
                  sep_len: int = 1, length_col: str | None = None) -> DataFrame:
    """D3 (distributive form): per key, number of non-NULL texts, characters
    of their ``sep``-joined concatenation, and max language. Mergeable
    partial aggregates, so a hot key costs one row per map task.

    ``length_col`` names a precomputed ``length(text)`` column (NULL for a
    NULL text): computing it where the texts are read keeps the texts
    themselves out of any join or shuffle before this aggregate."""
    n = F.col(length_col) if length_col else F.length(text)
    aggs = [
        F.count(n).alias("n_docs"),
        (F.sum(n) + F.lit(sep_len) * (F.count(n) - 1)).alias("n_chars"),
    ]
    if lang:
        aggs.append(F.max(lang).alias(lang))
    return df.groupBy(*key).agg(*aggs)


def match_items(items: DataFrame, corpus_by_key: DataFrame,
                on: Sequence[tuple[str, str]]) -> DataFrame:
    """Left outer equi-join of items to a corpus that is unique on the
    corpus keys (exact, case-sensitive). Unmatched items keep NULLs."""
    cond = None
    for left, right in on:
        e = items[left] == corpus_by_key[right]
        cond = e if cond is None else cond & e
    # drop the corpus-side keys by reference: unambiguous even when an item
    # column has the same name
    return items.join(corpus_by_key, cond, "left").drop(*[corpus_by_key[r] for _, r in on])


def spread_matches(items: DataFrame, corpus_by_key: DataFrame, on: tuple[str, str],
                   keep: Sequence[str]) -> DataFrame:
    """D4 for a corpus of large rows, unique on its key: every item that has a match (its columns
    ``keep``) with the row it matches. A compiled join makes all matches of a row before it
    gives the first, so every item's copy of a text is in memory at once. Here the items of a
    key are one list that meets the row once. The list goes through a function that Spark does
    not compile; so it does not compile the unfolding either, which makes one row at a time."""
    left, right = on
    lists = items.groupBy(F.col(left).alias("__key")).agg(F.collect_list(F.struct(*keep)).alias("__items"))
    both = corpus_by_key.join(lists, corpus_by_key[right] == lists["__key"])
    own = F.transform("__items", lambda i: i)
    cols = [own[c].alias(c) for c in keep]
    cols += [F.array_repeat(c, F.size("__items")).alias(c) for c in corpus_by_key.columns if c != right]
    return both.select(F.inline(F.arrays_zip(*cols)))


def consolidate_matches(df: DataFrame, key: str, *, lang: str = "language") -> DataFrame:
    """Per item id, combine every match with a language: documents and
    characters add up (one separator between matches), max language."""
    m = df.filter(F.col("n_docs").isNotNull() & (F.col("n_docs") > 0) & F.col(lang).isNotNull())
    return m.groupBy(key).agg(
        F.sum("n_docs").alias("n_docs"),
        (F.sum("n_chars") + F.count(F.lit(1)) - 1).alias("n_chars"),
        F.max(lang).alias(lang),
    )


def without_match(items: DataFrame, matched: DataFrame, key: str, *,
                  null_aware: bool = False) -> DataFrame:
    """Items whose key has no match (left anti join, then distinct).

    ``null_aware=True`` reproduces ``NOT IN (subquery)``: if the matched set
    holds a NULL key the result is empty, and NULL item keys never qualify.
    """
    keys = matched.select(F.col(key)).distinct()
    out = items.join(keys, key, "left_anti")
    if null_aware:
        has_null = matched.filter(F.col(key).isNull()).exists()
        out = out.filter(F.col(key).isNotNull() & ~has_null)
    return out.distinct()


def enrich_status(items: DataFrame, texts: DataFrame, key: str, text_key: str, *,
                  text: str = "lyrics", lang: str = "language",
                  required: Sequence[str] = ()) -> DataFrame:
    """Attach {text, language} to each item by key (left join against a
    key-unique text table); a NULL pair when a required input is NULL or
    nothing is found."""
    t = texts.select(F.col(text_key).alias("__k"), F.col(text).alias("__t"),
                     F.col(lang).alias("__l"))
    j = items.join(t, items[key] == t["__k"], "left")
    ok = F.lit(True)
    for r in required:
        ok = ok & F.col(r).isNotNull()
    s = F.when(ok & F.col("__t").isNotNull(),
               F.struct(F.col("__t").alias(text), F.col("__l").alias(lang)))
    return j.withColumn("__s", s).select(
        *[F.col(c) for c in items.columns],
        F.col(f"__s.{text}").alias(text), F.col(f"__s.{lang}").alias(lang))


def decode_dimension(df: DataFrame, col: str, dim: DataFrame | Mapping[str, str], *,
                     code: str = "code", name: str = "name",
                     special: Mapping[str, str] | None = None, out: str | None = None,
                     normalize: bool = False) -> DataFrame:
    """Code -> display name through a dimension (left join, code kept
    when unknown); ``special`` overrides before the lookup. ``normalize``
    NFC-normalises the dimension's names once, on the (small) dimension
    table, so equal names compare equal whatever their source encoding."""
    target = out or col
    if normalize and isinstance(dim, DataFrame):
        from ridgeline.functions.text import nfc

        dim = dim.withColumn(name, nfc(name))
    if isinstance(dim, Mapping):
        expr = F.col(col)
        lut = None
        for k, v in dim.items():
            lut = F.when(F.col(col) == k, F.lit(v)) if lut is None else lut.when(F.col(col) == k, F.lit(v))
        decoded = F.coalesce(lut, expr) if lut is not None else expr
        res = df.withColumn("__name", decoded)
    else:
        d = dim.select(F.col(code).alias("__code"), F.col(name).alias("__name"))
        res = df.join(d, df[col] == d["__code"], "left").drop("__code") \
            .withColumn("__name", F.coalesce(F.col("__name"), F.col(col)))
    if special:
        sp = None
        for k, v in special.items():
            sp = F.when(F.col(col) == k, F.lit(v)) if sp is None else sp.when(F.col(col) == k, F.lit(v))
        res = res.withColumn("__name", F.coalesce(sp, F.col("__name")))
    return res.withColumn(target, F.col("__name")).drop("__name")


def label_items(chart: DataFrame, labelled: DataFrame, key: str, label: str,
                sentinel: str | None = None) -> DataFrame:
    """G1/H2: inner join of chart rows with item labels on ``key`` (one chart
    row per label row), sentinel labels excluded."""
    lab = labelled if sentinel is None else labelled.filter(F.col(label) != sentinel)
    return chart.join(lab, key, "inner")


def coverage(chart: DataFrame, labelled: DataFrame, key: str, group: Sequence[str],
             label: str) -> DataFrame:
    """H1: per group, rows and rows without a label (left join)."""
    lab = labelled.select(key, label)
    j = chart.join(lab, key, "left")
    return j.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label).isNull()).alias("n_unlabelled"),
    )


def restrict_to_keys(big: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``big`` whose ``key`` occurs in ``keys`` (left semi join). Spark
    picks the join from the measured size of the distinct keys."""
    return big.join(keys.select(F.col(key)).distinct(), key, "left_semi")
