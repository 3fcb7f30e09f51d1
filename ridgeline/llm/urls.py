"""URL filter: path rules first, then a character language-model ratio.

Two smoothed variable-order Markov models, one of accepted and one of rejected
URLs, are compared by their length-normalised log-likelihood difference. Both
are one Spark table of the n-grams that occur, which grows with the input; no two
n-grams share a count. URLs are scored by joining their n-grams to it; only the
most frequent ones, at most ``FREQUENT``, are broadcast.

Null URLs and URLs without ``://`` have an empty host and path. Their score is
the models' score of the empty string; every row gets a verdict. Repeated rows
are judged alike and stay repeated. With no training URL of either class the
models abstain and the verdict is ``allow``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import stored

ORDER = 5            # longest context, in characters
FREQUENT = 10_000    # one n-gram of so many occurrences is summed without a join
SMOOTHING = 2.0      # weight of the shorter context's estimate
ALPHABET = 256       # characters beyond it share the last symbol
BINS = 400           # of the calibration histogram, over scores from -4 to 4
RANGE = 4.0
BITS = 9             # of a symbol in a gram: 6 symbols fit a long
UNIT = 1e12          # scores are summed as whole multiples of 1 / UNIT, in any order alike


@dataclass(frozen=True)
class Rule:
    """``host/path`` that allows or blocks a host, its subdomains and all paths
    that start with the rule's."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Pattern of the longest rule that fits, else null."""
    found = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                    F.lit(r.pattern))
             for r in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def _grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every character, which is it (lowest BITS) and the ORDER before it, and
    the text's number. Each text starts after ORDER start symbols and ends with an end
    symbol."""
    codes = [np.zeros(ORDER, np.int64)]
    owner = [np.full(ORDER, -1)]
    for i, t in enumerate(texts):
        c = np.minimum(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32), ALPHABET - 2) + 1
        codes += [c.astype(np.int64), np.array([ALPHABET]), np.zeros(ORDER, np.int64)]
        owner += [np.full(len(c) + 1, i), np.full(ORDER, -1)]
    x, who = np.concatenate(codes), np.concatenate(owner)
    at = np.flatnonzero(who >= 0)
    return sum(x[at - k] << (BITS * k) for k in range(ORDER + 1)), who[at]


def gram_counts(texts: DataFrame) -> DataFrame:
    """Rows (gram, n, n0, n1) from (t, y): occurrences in all texts, and in the rejected
    and accepted ones to learn from (y 0, 1, else null). Each batch sums its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                grams, who = _grams(b.column(0).to_pylist())
                y = pc.fill_null(b.column(1), -1).to_numpy()[who]
                gram, at = np.unique(grams, return_inverse=True)
                count = lambda rows, at=at, gram=gram: np.bincount(at[rows], minlength=len(gram))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (gram, count(y > -2), count(y == 0), count(y == 1))],
                    names=["gram", "n", "n0", "n1"])

    return (texts.select("t", "y").mapInArrow(run, "gram long, n long, n0 long, n1 long").groupBy("gram")
            .agg(*[F.sum(c).alias(c) for c in ("n", "n0", "n1")]))


def gram_scores(counts: DataFrame) -> DataFrame:
    """Rows (gram, n, s): log p(accepted model) - log p(rejected model) of the gram's last
    character after the others, times UNIT. From order to order, at most ALPHABET + 1
    grams share a context or a shorter gram, so no key is large."""
    below = None
    for order in range(ORDER + 1):
        gram = F.col("gram").bitwiseAND(F.lit((1 << (BITS * (order + 1))) - 1))
        own = counts.groupBy(gram.alias("gram")).agg(*[F.sum(c).alias(c) for c in ("n", "n0", "n1")])
        context = Window.partitionBy(F.shiftright("gram", BITS))
        own = own.withColumns({f"c{k}": F.sum(f"n{k}").over(context) for k in (0, 1)})
        if below is None:
            own = own.withColumns({f"q{k}": F.lit(1.0 / (ALPHABET + 1)) for k in (0, 1)})
        else:
            short = F.col("gram").bitwiseAND(F.lit((1 << (BITS * order)) - 1))
            own = own.withColumn("short", short).join(below, "short")
        below = own.select("gram", "n", *[((F.col(f"n{k}") + SMOOTHING * F.col(f"q{k}"))
                                           / (F.col(f"c{k}") + SMOOTHING)).alias(f"q{k}") for k in (0, 1)])
        if order < ORDER:
            below = below.select(F.col("gram").alias("short"), "q0", "q1")
    return below.select("gram", "n", F.round((F.log("q1") - F.log("q0")) * UNIT).cast("long").alias("s"))


def score_texts(texts: DataFrame, model: DataFrame) -> DataFrame:
    """Rows (id, score) from (id, t): mean over characters of the grams' scores. A text's
    frequent grams are summed in its task; the others are joined to the model."""
    total = model.agg(F.sum("n")).first()[0] or 0
    top = model.where(F.col("n") * FREQUENT >= total).select("gram", "s").orderBy("gram").toArrow()
    shared = texts.sparkSession.sparkContext.broadcast((top["gram"].to_numpy(), top["s"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value = shared.value
        for b in batches:
            if b.num_rows:
                grams, who = _grams(b.column(1).to_pylist())
                at = np.minimum(np.searchsorted(known, grams), max(len(known) - 1, 0))
                hit = known[at] == grams if len(known) else np.zeros(len(grams), bool)
                summed = np.zeros(b.num_rows, np.int64)
                np.add.at(summed, who[hit], value[at[hit]])
                ids = b.column(0).to_numpy()
                none = np.zeros((~hit).sum(), np.int64)
                # a text's own row has a gram that no other has, and none of the model
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v)) for v in (
                        (ids, ids[who[~hit]]), (-1 - ids, grams[~hit]), (summed, none),
                        (np.bincount(who, minlength=b.num_rows), none))], names=["id", "gram", "own", "n"])

    rows = texts.select("id", "t").mapInArrow(run, "id long, gram long, own long, n long")
    joined = rows.join(model.select("gram", "s"), "gram", "left")
    return joined.groupBy("id").agg(
        (F.sum(F.col("own") + F.coalesce("s", F.lit(0))) / F.sum("n") / UNIT).alias("score"))


def fit_and_score(df: DataFrame, text: Column, accepted: Column) -> tuple[DataFrame | None, float]:
    """Scores (t, score) of all distinct texts, and the threshold. The models learn from
    four fifths of the texts (by hash) where ``accepted`` is not null, the threshold from
    the others. None if a class has no text to learn from."""
    rows = df.select(text.alias("t"), accepted.cast("int").alias("y")).groupBy("t").agg(F.max("y").alias("y"))
    texts = stored(rows.withColumn("id", F.monotonically_increasing_id()))
    held = F.pmod(F.xxhash64("t"), F.lit(5)) == 0
    counts = stored(gram_counts(texts.select("t", F.when(~held, F.col("y")).alias("y"))))
    learnt = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    if not (learnt["n0"] and learnt["n1"]):
        return None, 0.0
    scored = stored(texts.join(score_texts(texts, stored(gram_scores(counts))), "id").select("t", "y", "score"))
    at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + RANGE) * BINS / (2 * RANGE))))
    bins = scored.where(held & F.col("y").isNotNull()).groupBy("y", at.alias("bin")).count().collect()
    return scored.select("t", "score"), _threshold(bins)


def _threshold(counts: list) -> float:
    """Score at which the two classes' error rates are least in sum; the middle of the
    best bins, so a wide gap between the classes is cut in half."""
    h = np.zeros((2, BINS))
    for r in counts:
        h[int(r["y"]), int(r["bin"])] += r["count"]
    share = h / np.maximum(h.sum(axis=1, keepdims=True), 1)
    below = np.concatenate([np.zeros((2, 1)), share.cumsum(axis=1)], axis=1)
    error = below[1] + (1 - below[0])          # accepted below the cut, rejected above it
    if not (h.sum(axis=1) > 0).all():
        return 0.0
    best = np.flatnonzero(error <= error.min() + 1e-12)
    run = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    mid = max(run, key=len).mean()
    return float(mid * 2 * RANGE / BINS - RANGE)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], *, url: str = "url",
               keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """``keep`` columns, host, path, rule (pattern or null), score and verdict of every
    row. The URLs that the rules decide teach the two models; the models read the
    whole URL after the scheme and decide the rest."""
    df = pages.select(*[F.col(k) for k in keep], F.col(url).alias("__url"))
    host, path = host_of(F.col("__url")), path_of(F.col("__url"))
    df = df.withColumns({"host": host, "path": path})
    df = df.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    allowed = F.col("rule").isin([r.pattern for r in rules if r.verdict == "allow"])
    decided = F.when(F.col("rule").isNotNull(), allowed)
    rest = F.regexp_replace(F.coalesce(F.col("__url"), F.lit("")), r"(?s)^.*?://", "")
    scores, threshold = fit_and_score(df, rest, decided)
    if scores is None:
        scored = df.withColumn("score", F.lit(0.0))
    else:
        scored = df.withColumn("__t", rest).join(scores.withColumnRenamed("t", "__t"), "__t", "left").drop("__t")
    verdict = F.when(F.coalesce(decided, F.col("score") >= F.lit(threshold)), F.lit("allow")).otherwise(F.lit("block"))
    return scored.withColumn("verdict", verdict).drop("__url")
