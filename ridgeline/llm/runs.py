"""Periodic runs of words: repetitions as maximal pairs of the suffix order.

A run of period q and length n is a stretch whose words repeat after q words and
which neither neighbour continues. Its first n - q and its last n - q words are
the same phrase, q apart, with different words before them and after them: a
maximal pair. The converse holds too, so the maximal pairs of phrases of m words
at a distance q <= m / (least repeats - 1) are exactly the runs of length m + q;
no stretch is extended word by word. Of pairs that span one stretch the least
distance is its period, the others are multiples.

Per text: suffixes are ordered by prefix doubling (numpy, many texts at a time),
common prefixes of neighbours follow from the doubled ranks, and the tree of LCP
intervals is walked bottom-up. An interval holds its positions in order and, for
every word that precedes some, the class list of these positions. Two children
of an interval are different in the word after the phrase; pairs between them
are taken from lists of different classes, so they are maximal on both sides.
Places of a phrase that lie within a fraction of its length of each other are
spaced by its period and preceded by the same word, all but the first; so a
place looks up the classes at the two ends of its window only, and the work per
place is a few binary searches, also in a text of one word repeated.

A run has a phrase of ``least_phrase`` words twice; texts without one (by hashes
of that many words, which never miss one) have no run and are not sorted.

Null text has no words. Equal rows give equal results, an empty table none, extra
columns are ignored unless named in ``keep``. A text is one value of one row; its
arrays are in proportion to its words, and long texts are worked on alone.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.tokens import text_slices

RUNS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
Run = tuple[int, int, int]


@dataclass(frozen=True)
class RunRule:
    least_length: int = 24      # words of a run
    least_repeats: int = 3      # length in periods
    slice_bytes: int = 1_000_000

    def __post_init__(self) -> None:
        if self.least_repeats < 3:
            raise ValueError("least_repeats below 3: places of a phrase need not be spaced by its period")

    @property
    def least_phrase(self) -> int:
        """Least m with m >= (repeats - 1) q and m + q >= length for some q >= 1."""
        return -(-self.least_length * (self.least_repeats - 1) // self.least_repeats)


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word of all texts, and each text's end."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = split.flatten().dictionary_encode()
    index = np.asarray(coded.indices).astype(np.int64)
    keep = index != pc.index(coded.dictionary, "").as_py()
    ends = np.concatenate([[0], np.cumsum(keep)])[np.asarray(split.offsets)[1:] - split.offsets[0].as_py()]
    return coded.dictionary, index[keep], ends.astype(np.int64)


def with_repeats(words: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Texts in which some phrase of ``size`` words may occur twice (all that have one)."""
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    room = ends[text] - np.arange(len(words)) >= size
    done, h = 1, pd.util.hash_array(words)
    while done < size:
        step = min(done, size - done)
        h = h[:len(h) - step] * np.uint64(0x9E3779B97F4A7C15) + (h[step:] ^ np.uint64(done + step))
        h ^= h >> np.uint64(29)
        done += step
    at = np.flatnonzero(room[:len(h)])
    h, text = h[at] ^ pd.util.hash_array(text[at]), text[at]
    order = np.argsort(h)
    same = np.flatnonzero(np.diff(h[order]) == 0)
    return np.unique(text[order[same]])


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a sequence that ends in a word of its own, in order, and the common
    prefix of each with the next. ``words`` are numbers."""
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    levels, n = [rank], len(words)
    while rank.max() < n - 1:
        step = 1 << (len(levels) - 1)
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
    order = np.argsort(rank)
    a, b, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 2, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        for x in (a, b, lcp):
            x[same] += 1 << k
    return order, lcp


class Places:
    """Positions of the phrase of an LCP interval, whole and by the word before them."""

    def __init__(self, place: int, before: int) -> None:
        self.all, self.classes = [place], {before: [place]}

    def add(self, other: Places) -> None:
        _put(self.all, other.all)
        for word, places in other.classes.items():
            _put(self.classes.setdefault(word, []), places)


def _put(into: list[int], places: list[int]) -> None:
    if not into or places[0] > into[-1]:
        into += places
    elif len(places) * 8 > len(into):
        into += places
        into.sort()             # two sorted runs: merged
    else:
        for x in places:
            insort(into, x)


def join_children(one: Places, two: Places, phrase: int, reach: int, before: list[int],
                  found: Callable[[int, int, int], None]) -> Places:
    """Report the maximal pairs (left place, right place, phrase) between two children of an
    interval that lie within ``reach``; return the places of both."""
    large, small = (one, two) if len(one.all) >= len(two.all) else (two, one)
    spots = large.all
    for word, places in small.classes.items():
        for x in places:
            # to the right: all in the window are of one class
            i = bisect_right(spots, x)
            if i < len(spots) and spots[i] <= x + reach:
                other = before[spots[i]]
                if other != word:
                    members = large.classes[other]
                    for y in members[bisect_right(members, x):bisect_right(members, x + reach)]:
                        found(x, y, phrase)
            # to the left: only the first of the window can be of another class
            i = bisect_left(spots, x - reach)
            if i < len(spots) and spots[i] < x and before[spots[i]] != word:
                found(spots[i], x, phrase)
    large.add(small)
    return large


def maximal_pairs(order: np.ndarray, lcp: np.ndarray, before: list[int], least: int, repeats: int,
                  found: Callable[[int, int, int], None]) -> None:
    """All maximal pairs of phrases of ``least`` words or more at a distance of at most
    phrase / (repeats - 1), bottom-up over the LCP intervals."""
    deep = lcp >= least
    edges = np.flatnonzero(np.diff(np.concatenate([[0], deep.astype(np.int8), [0]])))
    for a, z in edges.reshape(-1, 2).tolist():
        suffixes, depths = order[a:z + 1].tolist(), lcp[a:z].tolist()
        open_: list[tuple[int, Places]] = []
        for i, x in enumerate(suffixes):
            child, depth = Places(x, before[x]), depths[i] if i < len(depths) else 0
            while open_ and open_[-1][0] > depth:
                m, parent = open_.pop()
                child = join_children(parent, child, m, m // (repeats - 1), before, found)
            if open_ and open_[-1][0] == depth:
                m, parent = open_.pop()
                child = join_children(parent, child, m, m // (repeats - 1), before, found)
            if depth:
                open_.append((depth, child))


def find_runs(words: np.ndarray, ends: np.ndarray, rule: RunRule) -> dict[int, list[Run]]:
    """Runs (start, length, period) of the texts that have any, by start, then period."""
    texts = with_repeats(words, ends, rule.least_phrase)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    if not len(texts):
        return {}
    # one sequence: every text, then a word that occurs nowhere else
    sizes = ends[texts] - begins[texts] + 1
    close = np.cumsum(sizes)
    line = np.zeros(int(close[-1]), np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(line)) - (close - sizes)[owner]
    inner = place < (sizes - 1)[owner]
    line[inner] = words[(begins[texts][owner] + place)[inner]] + len(texts)
    line[~inner] = np.arange(len(texts))
    order, lcp = suffix_order(line)
    before = np.concatenate([[-1], line[:-1]]).tolist()
    periods: dict[tuple[int, int], int] = {}

    def found(x: int, y: int, phrase: int) -> None:
        q = y - x
        if phrase + q >= rule.least_length:
            span = (x, phrase + q)
            if q < periods.get(span, q + 1):
                periods[span] = q

    maximal_pairs(order, lcp, before, rule.least_phrase, rule.least_repeats, found)
    out: dict[int, list[Run]] = {}
    for (x, length), q in periods.items():
        k = int(owner[x])
        out.setdefault(int(texts[k]), []).append((int(place[x]), length, q))
    for runs in out.values():
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Mask of the words that no run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        step[start + q] += 1
        step[start + length] -= 1
    return np.cumsum(step[:n]) == 0


def detect_runs(docs: DataFrame, rule: RunRule = RunRule(), *, text: str = "text", keep: tuple[str, ...] = (),
                arrange: Callable[[dict, int], np.ndarray | None] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` and n_words, runs, collapsed: the text's words joined by
    one space, without those that a run repeats. ``arrange`` (the kept columns as a dict,
    number of words) may give the places of the words to use instead of a text's own."""
    rows = docs.select(F.col(text).alias("__text"), F.struct(*keep).alias("doc"))
    fields = rows.schema["doc"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, 0, rule.slice_bytes):
                distinct, words, ends = text_words(b.column(0))
                cuts = np.concatenate([[0], ends])
                if arrange:
                    for i, d in enumerate(b.column(1).to_pylist()):
                        a, z = cuts[i:i + 2]
                        places = arrange(d, int(z - a))
                        if places is not None:
                            words[a:z] = words[a:z][places]
                runs = find_runs(words, ends, rule)
                mask = np.ones(len(words), bool)
                for i, found in runs.items():
                    mask[cuts[i]:cuts[i + 1]] = kept_words(int(cuts[i + 1] - cuts[i]), found)
                left = np.concatenate([[0], np.cumsum(mask)])[cuts]
                lists = pa.LargeListArray.from_arrays(pa.array(left), distinct.take(pa.array(words[mask])))
                listed = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.get(i, ())]
                          for i in range(b.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(1), pa.array(np.diff(cuts)),
                     pa.array(listed, pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))),
                     pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())], names=["doc", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, f"doc {fields.simpleString()}, {RUNS}").select("doc.*", "n_words", "runs", "collapsed")
