"""Toxicity by maximum-scoring segments of token log-odds.

Tokens are words and their beginnings; each has a log-odds of toxic against
other documents under an informative Dirichlet prior (the words of both
classes together). A linear-time scan finds all maximal-scoring segments of a
text (Ruzzo and Tompa). A segment's score is calibrated by the extreme-value
law of local scores (Karlin and Altschul): its expected number in a text of the
length, over non-toxic text. A document's score is a logistic function of its
best segments' significance, fitted on the training rows.

Labels are learnt from a bounded sample: at most ``Training.rows`` rows of each
class, by hash, of the rows that the caller marks as training. All texts are
scored whole. Null and empty texts have no segment and score like a text
without evidence. Repeated rows score alike. Without rows of both classes every
score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import stored

WORD = re.compile(r"[^\W\d_]+")
LENGTHS = (6, 4)            # beginnings of a word that stand for it if it is rare


@dataclass(frozen=True)
class Training:
    rows: int = 10_000           # most training rows of each class
    prior: float = 20.0          # weight of the prior, in documents
    min_documents: int = 4       # support from which a token counts for itself
    level: float = 0.01          # expected number by chance below which a segment is significant


def parts_of(word: str) -> list[str]:
    """The word, then its beginnings with a mark, longest first."""
    return [word] + [word[:n] + "~" for n in LENGTHS if len(word) >= n]


@dataclass
class Model:
    """Log-odds by token, the drift of unknown tokens, and the calibration."""

    odds: dict[str, float]
    drift: float
    decay: float = 1.0           # lambda of the extreme-value law
    scale: float = 1.0           # K
    level: float = 0.01
    slope: float = 0.0
    offset: float = -10.0

    def scores(self, text: str) -> np.ndarray:
        """Score of each word in turn: the strongest log-odds of its parts; the drift makes
        the expected score of a word negative."""
        get, memo = self.odds.get, self._memo
        out = []
        for w in WORD.findall(text.lower()):
            s = memo.get(w)
            if s is None:
                s = max((get(p, 0.0) for p in parts_of(w)), key=abs) - self.drift
                if len(memo) < 300_000:
                    memo[w] = s
            out.append(s)
        return np.array(out)

    @property
    def _memo(self) -> dict[str, float]:
        return self.__dict__.setdefault("memo", {})

    def significance(self, score: float, words: int) -> float:
        """- log of the expected number of segments of this score in so many words."""
        return self.decay * score - math.log(max(self.scale * words, 1e-9))


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end) in one pass. Runs of positive
    scores come first, so the pass is over runs, not words."""
    if not len(scores):
        return []
    up = scores > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], up.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[list] = []       # start, end, sum before it, sum to its end
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        seg = [a, b, total[a], total[b]]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= seg[2]:
                j -= 1
            if j < 0 or stack[j][3] >= seg[3]:
                stack.append(seg)
                break
            seg = [stack[j][0], seg[1], stack[j][2], seg[3]]
            del stack[j:]
    return [(float(s[3] - s[2]), s[0], s[1]) for s in stack]


def training_sample(labels: DataFrame, use: Column, training: Training, *, key: str, label: str) -> DataFrame:
    """At most ``rows`` rows of each class, the first by hash of the key."""
    rows = labels.where(use & F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
    order = [F.xxhash64("key"), F.col("key")]
    return rows.where("y = 1").orderBy(*order).limit(training.rows).unionByName(
        rows.where("y = 0").orderBy(*order).limit(training.rows)).dropDuplicates(["key"])


def class_weights(labels: DataFrame, use: Column, training: Training, *, label: str) -> dict[int, float]:
    """Training rows of each class that one of the sample stands for, counted over all rows."""
    rows = labels.where(use & F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("y")).count().collect()
    return {r["y"]: max(1.0, r["count"] / max(1, training.rows)) for r in rows}


def sure_odds(a: float, b: float, toxic: float, other: float, sds: float = 3.0) -> float:
    """Log-odds of a token of ``a`` toxic and ``b`` other documents, moved towards 0 by the
    uncertainty of its toxic share: down to the bound of the share's score interval, which
    also holds where a count is 0. 0 if the sign is not sure."""
    t, o = a / toxic, b / other
    z = math.log(t / (1 - t + 1e-9)) - math.log(o / (1 - o + 1e-9))
    if z < 0:
        return -sure_odds(b, a, other, toxic, sds) if b > 0 else 0.0
    n, share, s2 = a + b, a / (a + b), sds * sds
    low = (share + s2 / (2 * n) - sds * math.sqrt(share * (1 - share) / n + s2 / (4 * n * n))) / (1 + s2 / n)
    return max(0.0, z - math.log(a / b) + math.log(low / (1 - low)))


def fit_odds(texts: DataFrame, training: Training) -> Model:
    """Log-odds from a frame (text, y). A token counts once per document, so that one
    document cannot make a token. Every token of the sample with enough documents is
    weighed, in the tasks; the driver gets those whose side is sure, which the bounded
    sample bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            toxic: Counter = Counter()
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tokens = {p for w in set(WORD.findall((t or "").lower())) for p in parts_of(w)}
                tokens.add("")            # the empty token counts documents
                seen.update(tokens)
                if y:
                    toxic.update(tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), pa.array([toxic[w] for w in seen], pa.int64()),
                 pa.array(seen.values(), pa.int64())], names=["token", "toxic", "n"])

    counts = stored(texts.select("text", "y").mapInArrow(run, "token string, toxic long, n long").groupBy("token")
                    .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
                    .where(F.col("n") >= training.min_documents))
    of_all = counts.where("token = ''").first()
    toxic, other = (int(of_all["toxic"]), int(of_all["n"] - of_all["toxic"])) if of_all else (0, 0)
    model, prior = Model({}, drift=0.1, level=training.level), training.prior
    if not (toxic and other):
        return model

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, n = b.column(1).to_numpy(), b.column(2).to_numpy()
            # the prior: both classes together; only what is surely toxic, or surely not, moves the score
            odds = [sure_odds(x + prior * p, m - x + prior * p, toxic + prior, other + prior)
                    for x, m, p in zip(a.tolist(), n.tolist(), (n / (toxic + other)).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(odds, pa.float64())], names=["token", "odds"])

    sure = counts.where("token <> ''").mapInArrow(weigh, "token string, odds double").where("odds <> 0")
    table = sure.toArrow()
    model.odds = dict(zip(table["token"].to_pylist(), table["odds"].to_pylist(), strict=True))
    return model


def _features(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """keep columns, n_words, best (the best segment's score), evidence and passages (the
    significant segments, best first) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + ["n_words long, best double, evidence double",
                          "passages array<struct<start:int,end:int,score:double,expected:double>>"])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                                ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            words, best, total, found = [], [], [], []
            for t in b.column(b.num_columns - 1):
                s = m.scores(t.as_py() or "")
                segments = maximal_segments(s)
                sure = [(x, a, z, v) for x, a, z in segments if (v := m.significance(x, max(len(s), 1))) > -math.log(m.level)]
                words.append(len(s))
                best.append(max((x for x, _, _ in segments), default=0.0))
                total.append(evidence(v for *_, v in sure))
                found.append([{"start": a, "end": z, "score": x, "expected": math.exp(-min(700.0, v))}
                              for x, a, z, v in sorted(sure, key=lambda q: (-q[0], q[1]))])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(words, pa.int64()), pa.array(best, pa.float64()),
                 pa.array(total, pa.float64()), pa.array(found, arrow)],
                names=[*keep, "n_words", "best", "evidence", "passages"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def extreme_value_fit(best: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """decay and scale of P(best < x) = exp(-scale * words * exp(-decay * x)) on best scores of
    non-toxic texts: decay by the method of moments, scale by maximum likelihood with the
    texts' lengths, times the share of texts that have a segment at all."""
    seen = best > 0
    if seen.sum() < 20:
        return 1.0, 0.01
    sd = max(float(best[seen].std()), 0.25)
    decay = math.pi / (sd * math.sqrt(6))
    return decay, float(seen.mean() * seen.sum() / np.sum(words[seen] * np.exp(-decay * best[seen])))


def evidence(significances: Iterable[float]) -> float:
    """Significance of all significant segments together, on a scale of logarithms that has no
    upper end; 0 where there is none."""
    return math.log1p(sum(significances))


def calibrate(model: Model, rows: DataFrame, weights: dict[int, float]) -> None:
    """Extreme-value law from the non-toxic training rows (text, y), then a logistic fit
    of the label on the evidence under that law; the weights of the classes make their
    prior that of all training rows, whatever the bound on the sample. Two numbers of
    each row reach the driver, in either step."""
    table = _features(rows, model, ["y"]).select("y", "n_words", "best").toArrow()
    y, words, best = (table[c].to_numpy().astype(float) for c in ("y", "n_words", "best"))
    if not (0 < y.sum() < len(y)):
        return
    model.decay, model.scale = extreme_value_fit(best[y == 0], np.maximum(words[y == 0], 1.0))
    table = _features(rows, model, ["y"]).select("y", "evidence").toArrow()
    y, x = (table[c].to_numpy().astype(float) for c in ("y", "evidence"))
    weight = np.array([weights.get(int(k), 1.0) for k in y])
    weight *= len(y) / weight.sum()
    w, c = logistic_fit(x, y, weight)
    model.slope, model.offset = max(w, 0.0), c


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of a weighted logistic regression, with a small ridge on the slope.
    Newton steps, halved until the loss falls, so that no step leaves the minimum behind."""
    def loss(v: np.ndarray) -> float:
        z = v[0] * x + v[1]
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * v[0] ** 2)

    v = np.array([0.0, math.log(max((weight * y).sum(), 1e-9) / max((weight * (1 - y)).sum(), 1e-9))])
    now = loss(v)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(v[0] * x + v[1], -500, 500)))
        g = np.array([(weight * (p - y) * x).sum() + ridge * v[0], (weight * (p - y)).sum()])
        q = weight * p * (1 - p)
        h = np.array([[(q * x * x).sum() + ridge, (q * x).sum()], [(q * x).sum(), q.sum() + 1e-9]])
        step, share = np.linalg.solve(h, g), 1.0
        while share > 1e-6 and not loss(v - share * step) <= now - 1e-4 * share * float(g @ step):
            share /= 2
        if share <= 1e-6:
            break
        v = v - share * step
        now = loss(v)
        if np.abs(share * step).max() < 1e-10:
            break
    return float(v[0]), float(v[1])


def score_toxicity(docs: DataFrame, labels: DataFrame, use: Column, training: Training = Training(), *,
                   key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Rows key, score (0 to 1), n_words and passages: the significant segments (start and
    end in words, score, expected number by chance). ``use`` marks the rows of ``labels``
    that may be learnt from. The sample (at most 2 * rows small rows) is broadcast; no
    text is shuffled."""
    sample = F.broadcast(training_sample(labels, use, training, key=key, label=label))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    learnt = stored(texts.join(sample, "key"))
    model = fit_odds(learnt, training)
    if model.odds:
        calibrate(model, learnt, class_weights(labels, use, training, label=label))
    score = F.lit(0.0) if not model.odds else 1.0 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(
        F.lit(30.0), model.slope * F.col("evidence") + model.offset))))
    return (_features(texts, model, ["key"])
            .select(F.col("key").alias(key), score.alias("score"), "n_words", "passages"))
