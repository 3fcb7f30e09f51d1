"""Secret scan with corpus-wide ownership frequency.

Base patterns find assignments, access keys and hexadecimal strings. Beside
them, long mixed strings are candidates. For every candidate value the corpus
is asked how many distinct repositories and owners hold it: values of many
owners are copied examples, values of one owner (or few) look live. Live mixed
strings are added to the spans; base spans always stay. Only DataFrame
functions are used; nothing but spans and hashes is shuffled.

Null text counts as empty and has no spans. Repeated rows keep their own rows
with equal spans; a row's repository and owner count once each. A null owner or
repository counts as one of its kind. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import let, stored

# The base patterns, and a cheap test that every match passes.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"""(?i)(?:password|passwd|secret|token|key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{14,}"     # AKIA[A-Z0-9]+ of 18 or more: a run is taken whole, so short ones hide none
HEX = r"[0-9a-f]{16,}"
MIXED = r"[A-Za-z0-9_+/-]{24,}"
KINDS = ("assign", "access", "hex", "mixed")
MIN_ASSIGN = 12


@dataclass(frozen=True)
class Ownership:
    """A value is live-looking up to so many owners and repositories."""

    max_owners: int = 2
    max_repos: int = 10


def matches(text: Column, pattern: str, hint: str, value_group: int = 0) -> Column:
    """Array of structs (start, end, value) of the leftmost non-overlapping matches, in
    code points. The text between matches and the matches add up to the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    between = F.split(text, pattern, -1)
    pieces = F.arrays_zip(between.alias("gap"), found.alias("hit"), values.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(acc: Column, p: Column) -> Column:
        a = acc["at"] + F.char_length(p["gap"])
        b = a + F.char_length(p["hit"])
        spans = F.concat(acc["spans"], F.array(F.struct(a.alias("start"), b.alias("end"), p["value"].alias("value"))))
        return F.struct(b.alias("at"), spans.alias("spans"))

    def walk(z: Column) -> Column:     # the last gap has no match after it
        return F.aggregate(F.slice(z, F.lit(1), F.size(z) - 1),
                           F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)["spans"]

    return F.when(text.rlike(hint), let(pieces, walk)).otherwise(empty)


def _kind(spans: Column, k: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))


def base_spans(text: Column) -> Column:
    """Structs (start, kind, end, value) by start, then kind; kind is an index of KINDS."""
    assign = F.filter(matches(text, ASSIGN, ASSIGN_HINT, 2), lambda s: F.char_length(s["value"]) >= MIN_ASSIGN)
    return F.concat(_kind(assign, 0), _kind(matches(text, ACCESS, ACCESS), 1),
                    _kind(matches(text, HEX, HEX), 2))


def mixed_spans(text: Column) -> Column:
    """Long strings with a digit and letters of both cases."""
    has = lambda s: (s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]")
                     & s["value"].rlike("[A-Z]"))
    return _kind(F.filter(matches(text, MIXED, MIXED), has), 3)


def scan_secrets(docs: DataFrame, ownership: Ownership = Ownership(), *, text: str = "text",
                 owner: str = "source", repo: str = "doc_id", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: struct ``doc`` (columns ``keep``) and ``spans``: structs
    (start, kind, end, value_hash, n_repos, n_owners, live) by start, then kind. Mixed
    candidates are there only if live and apart from every base span."""
    value = F.coalesce(F.col(text), F.lit(""))
    # the plan's first projection holds the spans, so each text is scanned once
    rows = docs.select(F.struct(*keep).alias("doc"), F.col(owner).cast("string").alias("owner"),
                       F.col(repo).cast("string").alias("repo"), base_spans(value).alias("base"),
                       mixed_spans(value).alias("mixed"))
    hashed = F.transform(F.concat("base", "mixed"), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.sha2(s["value"], 256).alias("value")))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc", "owner", "repo",
                              hashed.alias("spans")))
    hits = rows.select("row", "owner", "repo", F.explode("spans").alias("s"))
    # distinct (value, owner, repository), then sums: no step gathers one value's rows
    counts = (hits.groupBy(F.col("s.value").alias("value"), "owner", "repo").agg(F.lit(1).alias("x"))
              .groupBy("value", "owner").agg(F.count("*").alias("repos"))
              .groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners")))
    live = (F.col("n_owners") <= ownership.max_owners) & (F.col("n_repos") <= ownership.max_repos)
    judged = (hits.withColumn("value", F.col("s.value")).join(counts, "value")
              .select("row", F.struct(F.col("s.start").alias("start"), F.col("s.kind").alias("kind"),
                                      F.col("s.end").alias("end"), F.col("value").alias("value_hash"),
                                      "n_repos", "n_owners", live.alias("live")).alias("s")))
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    clear = lambda s, all_: ~F.exists(all_, lambda b: (b["kind"] < 3) & (b["start"] < s["end"])
                                      & (s["start"] < b["end"]))
    kept = F.filter("spans", lambda s: (s["kind"] < 3) | (s["live"] & clear(s, F.col("spans"))))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return (rows.select("row", "doc").join(spans.select("row", kept.alias("spans")), "row", "left")
            .select("doc", F.coalesce("spans", empty).alias("spans")))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """Text with every span replaced by ``mark``; overlapping spans become one mark.
    Spans are by start."""
    def step(acc: Column, s: Column) -> Column:
        more = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                                                       acc["out"].alias("out"))) \
            .otherwise(F.struct(s["end"].alias("at"), more.alias("out")))

    def close(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, close)).otherwise(text)
