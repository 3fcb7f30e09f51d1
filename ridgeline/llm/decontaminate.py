"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts are sequences of normalised words (case, punctuation and spacing do not
count). The CGK random walk embeds a sequence so that edit distance becomes
Hamming distance: a random bit per (step, word) says whether the walk moves on.
Agreement of two embeddings falls with the number of edits, not with their share,
so items are cut into parts, so many that one part of any copy has at most
``part_edits`` edits, whatever the item's size. Windows of a part's size are
embedded, sampled positions of the embedding are their LSH keys, and the
repetitions that bring recall to the target are measured on simulated edits.
Text around a window that shares a key with a part is searched for the whole
item by exact edit distance on words.

Before embedding, windows are left out that cannot be within the edit distance:
each edit breaks at most two pairs of neighbouring words, so a window must hold
enough pairs that occur in items of its size. That test is exact; it loses nothing.

The benchmark is the stated query set: it is read in blocks of bounded size,
and each block is searched against all rows. Null and empty texts have no
windows. A text shorter than an item by more than the edit distance cannot
match it; a window that the document's end cuts off may lack as many words. Items without words match
nothing; repeated items and rows each give their matches. An empty table on
either side gives no matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.tokens import text_slices

BATCH_CHARS = 4_000_000      # text searched at a time
WINDOWS = 20_000              # windows embedded at a time
BLOCK_WORDS = 200_000       # words of benchmark items broadcast at a time
STRIP = "[^\\p{L}\\p{N}]+"    # what does not count in a word


@dataclass(frozen=True)
class Search:
    max_edit_share: float = 0.2       # edits per word of the item
    samples: int = 3                  # embedding positions in a key
    part_edits: int = 1               # most edits in the least edited part of a copy
    target_recall: float = 0.98       # of a part with the most edits
    seed: int = 11

    def most(self, size: int) -> int:
        return int(self.max_edit_share * size)

    def parts(self, size: int) -> tuple[int, int, int]:
        """Number of parts of an item, their words, and the edits that one of them has at
        most: with fewer than (part_edits + 1) edits a part on average, one has part_edits."""
        most = self.most(size)
        n = most // (self.part_edits + 1) + 1
        return n, size // n, most // n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_lists(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Normalised words of all texts as one dictionary array, and each text's end in it."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    raw = split.flatten().dictionary_encode()
    clean = pc.utf8_lower(pc.replace_substring_regex(raw.dictionary, STRIP, ""))
    words = clean.dictionary_encode()
    index = np.asarray(words.indices)[np.asarray(raw.indices)]
    empty = pc.index(words.dictionary, "").as_py()
    keep = index != empty
    done = np.concatenate([[0], np.cumsum(keep)])
    ends = done[np.asarray(split.offsets)[1:] - split.offsets[0].as_py()]
    return pa.DictionaryArray.from_arrays(pa.array(index[keep]), words.dictionary), ends


def embed(search: Search, words: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int,
          repetitions: int) -> np.ndarray:
    """LSH keys [repetition, window] of the windows of ``size`` words from the starts, not
    beyond the stops. A step of the walk reads the word it stands on, and a random bit
    of (step, word) moves it on; a key is made of the words at sampled steps."""
    rng = np.random.default_rng((search.seed, size))
    sampled = np.argsort(rng.random((repetitions, 2 * size)), axis=1)[:, :search.samples]
    salt = rng.integers(0, 1 << 63, (repetitions, 1), dtype=np.uint64)
    stops = np.minimum(starts + size, stops)
    at = np.tile(starts, (repetitions, 1))
    key = np.zeros(at.shape, np.uint64)
    for step in range(int(sampled.max()) + 1):
        inside = at < stops
        word = np.where(inside, words[np.minimum(at, len(words) - 1)], -1).astype(np.uint64)
        own = (sampled == step).any(axis=1)
        if own.any():
            key[own] = _mix(key[own] * np.uint64(31) + word[own] + np.uint64(step))
        move = _mix(word * np.uint64(0x9E3779B97F4A7C15) + salt + np.uint64(step * 0x5851F42D)) & np.uint64(1)
        at += inside & move.astype(bool)
    return key


@lru_cache(maxsize=256)
def repetitions(search: Search, size: int, edits: int, trials: int = 150, most: int = 200) -> int:
    """Keys that a part of ``size`` words needs for the target recall at so many edits:
    the least number at which simulated copies inside a text reach it on average, for
    deletions, insertions and substitutions each."""
    if not edits:
        return 1                     # copies without an edit share every key
    rng = np.random.default_rng(search.seed)
    need = 1
    for kind in ("delete", "insert", "replace"):
        pieces = []
        for _ in range(trials):
            item = rng.integers(0, 1 << 40, size).tolist()
            copy = list(item)
            for _ in range(edits):
                k = int(rng.integers(len(copy)))
                copy[k:k + (kind != "insert")] = [] if kind == "delete" else [int(rng.integers(1 << 40))]
            pieces += [item, copy + rng.integers(0, 1 << 40, size).tolist()]
        stops = np.cumsum([len(p) for p in pieces])
        starts = stops - [len(p) for p in pieces]
        keys = embed(search, np.concatenate(pieces).astype(np.int64), starts, stops, size, most)
        agree = (keys[:, ::2] == keys[:, 1::2]).mean(axis=0)
        while need < most and (1 - (1 - agree) ** need).mean() < search.target_recall:
            need += 1
    return need


def _last_row(a: np.ndarray, b: np.ndarray, most: int, row: np.ndarray) -> np.ndarray | None:
    """Least edits * (len(b) + 1) + start of ``a`` against the words of ``b`` before each
    place, from the row of no word of ``a``; None if all have more than ``most`` edits."""
    unit = len(b) + 1
    place = np.arange(unit) * unit
    for i, x in enumerate(a, 1):
        best = np.minimum(row[1:] + unit, row[:-1] + unit * (b != x))
        row = np.concatenate([[i * unit], best])
        row = np.minimum.accumulate(row - place) + place      # insertions along the row
        if row.min() >= (most + 1) * unit:
            return None
    return row


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> tuple[int, int]:
    """Least Levenshtein distance of ``a`` to a beginning of ``b``, and the length of that
    beginning (of equal ones, nearest to a's length); most + 1 and 0 if it is larger."""
    unit = len(b) + 1
    row = _last_row(a, b, most, np.arange(unit) * unit)
    if row is None:
        return most + 1, 0
    n = min(np.flatnonzero(row == row.min()).tolist(), key=lambda j: (abs(j - len(a)), j))
    return int(row[n]) // unit, n


def best_place(a: np.ndarray, b: np.ndarray, most: int) -> tuple[int, int, int]:
    """Least Levenshtein distance of ``a`` to any piece of ``b``, and the piece's start and
    end: of equal ones the first, its length nearest to a's; most + 1, 0, 0 if larger."""
    unit = len(b) + 1
    row = _last_row(a, b, most, np.arange(unit))
    if row is None:
        return most + 1, 0, 0
    edits, start = row // unit, row % unit
    ends = np.flatnonzero(edits == edits.min()).tolist()
    n = min(ends, key=lambda j: (start[j], abs(j - start[j] - len(a)), j))
    return int(edits[n]), int(start[n]), n


@dataclass
class Index:
    """Items of one block: their words as numbers, and LSH keys of their parts."""

    search: Search
    vocabulary: list[str]
    items: list[tuple[int, np.ndarray]]          # item id, word numbers
    sizes: np.ndarray = field(init=False)
    base: int = field(init=False)
    pairs: np.ndarray = field(init=False)        # all pairs of neighbouring words in items
    of_size: np.ndarray = field(init=False)      # [pair, size]: an item of the size holds the pair
    repeats: int = field(init=False)             # most times that one pair occurs in one item
    codes: list[np.ndarray] = field(init=False)  # each item's pairs
    # by (words, edits) of the parts: item and offset of each, sorted keys and their parts by repetition
    parts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]] = field(init=False)

    def __post_init__(self) -> None:
        self.sizes = np.unique([len(w) for _, w in self.items]).astype(np.int64)
        self.base = max(1, len(self.vocabulary))
        codes = [w[:-1] * self.base + w[1:] for _, w in self.items]
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]))
        self.of_size = np.zeros((len(self.pairs), len(self.sizes)), bool)
        for (_, w), c in zip(self.items, codes, strict=True):
            self.of_size[np.searchsorted(self.pairs, c), np.searchsorted(self.sizes, len(w))] = True
        self.repeats = max([1, *(int(np.unique(c, return_counts=True)[1].max()) for c in codes if len(c))])
        self.codes = [np.unique(c) for c in codes]
        self.parts = {}
        words = np.concatenate([np.zeros(0, np.int64), *[w for _, w in self.items]])
        begin = np.cumsum([0, *[len(w) for _, w in self.items]])
        own: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for i, (_, w) in enumerate(self.items):
            number, size, edits = self.search.parts(len(w))
            own.setdefault((size, edits), []).extend((i, k * size) for k in range(number))
        for (size, edits), places in own.items():
            item, offset = np.array(places, np.int64).T
            starts = begin[item] + offset
            keys = embed(self.search, words, starts, starts + size, size, repetitions(self.search, size, edits))
            orders = [np.argsort(k, kind="stable") for k in keys]
            self.parts[size, edits] = item, offset, [(k[o], o) for k, o in zip(keys, orders, strict=True)]

    def most(self, size: int) -> int:
        return self.search.most(size)

    def candidates(self, words: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(size, starts) of the windows that can be within the edits allowed. Words outside
        the vocabulary are negative; begins and ends are the documents' places. A window
        that is d edits from an item of n words holds n - 1 - 2 d of its pairs of
        neighbouring words, so windows with fewer known pairs are left out; one pair counts
        as often as an item can hold it, at either end of a run of it."""
        n = len(words)
        if not n or not len(self.sizes):
            return
        pair = np.zeros(n, bool)
        both = np.flatnonzero((words[:-1] >= 0) & (words[1:] >= 0))
        code = words[both] * self.base + words[both + 1]
        at = np.minimum(np.searchsorted(self.pairs, code), max(len(self.pairs) - 1, 0))
        pair[both] = self.pairs[at] == code if len(self.pairs) else False
        last = ends[ends > begins] - 1
        pair[last] = False                                   # no pair spans two documents
        # of a run of one pair only its first and last ones can be the item's
        at = np.flatnonzero(pair)
        code = words[at] * self.base + words[np.minimum(at + 1, n - 1)]
        new = np.concatenate([[True], (np.diff(code) != 0) | (np.diff(at) != 1)])[:len(at)]
        run = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        place, length = np.arange(len(at)) - first[run], np.bincount(run)[run] if len(at) else run
        pair[at[(place >= self.repeats) & (place < length - self.repeats)]] = False
        places = np.flatnonzero(pair)
        number = np.searchsorted(self.pairs, words[places] * self.base + words[np.minimum(places + 1, n - 1)])
        hits = np.concatenate([[0], np.cumsum(pair)])
        needs = [m - 1 - 2 * self.most(m) for m in self.sizes.tolist()]
        far = np.minimum(np.arange(n) + int(self.sizes.max()), n)
        starts = np.flatnonzero(hits[far] - hits[:-1] >= min(needs))
        doc = np.searchsorted(ends, starts, side="right")
        for k, (size, need) in enumerate(zip(self.sizes.tolist(), needs, strict=True)):
            own = places[self.of_size[number, k]]
            end = np.minimum(starts + size, ends[doc])
            # a copy that ends the document may lack as many words as edits are allowed
            whole = end - starts >= size - self.most(size)
            good = whole & (np.searchsorted(own, end - 1) - np.searchsorted(own, starts) >= need)
            if good.any():
                yield size, starts[good]

    def places(self, words: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows document, item, place, each once and in order: the item may begin at about
        that place, for a part of it shares a key with the window where the part would be."""
        near: dict[tuple[int, int], np.ndarray] = {}
        for size, starts in self.candidates(words, begins, ends):
            stop = np.minimum(starts + size + self.most(size), ends[np.searchsorted(ends, starts, side="right")])
            edge = np.bincount(starts, minlength=len(words) + 1) - np.bincount(stop, minlength=len(words) + 1)
            inside = np.cumsum(edge)[:-1] > 0
            part = self.search.parts(size)[1:]
            near[part] = near[part] | inside if part in near else inside
        found = [np.zeros((3, 0), np.int64)]
        for (size, edits), inside in near.items():
            item, offset, tables = self.parts[size, edits]
            at = np.flatnonzero(inside)
            doc = np.searchsorted(ends, at, side="right")
            whole = ends[doc] - at >= size - edits
            at, doc = at[whole], doc[whole]
            for a in range(0, len(at), WINDOWS):
                p, d = at[a:a + WINDOWS], doc[a:a + WINDOWS]
                hits = []
                for keys, (known, order) in zip(embed(self.search, words, p, ends[d], size, len(tables)), tables, strict=True):
                    first = np.searchsorted(known, keys)
                    n = np.searchsorted(known, keys, side="right") - first
                    w = np.repeat(np.arange(len(p)), n)
                    part = order[np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + first[w]]
                    hits.append(np.stack([d[w], item[part], p[w] - offset[part]]))
                found.append(np.unique(np.concatenate(hits, axis=1), axis=1))
        return np.unique(np.concatenate(found, axis=1), axis=1).T

    def find(self, words: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """Best place (edits, start, end) of each (document, item) within the item's edits; of
        equal edits the first. Places near each other are searched together."""
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        rows = self.places(words, begins, ends)
        if not len(rows):
            return found
        sizes = np.array([len(w) for _, w in self.items])[rows[:, 1]]
        most = np.array([self.most(n) for n in range(int(self.sizes.max()) + 1)])[sizes]
        new = (np.diff(rows[:, :2], axis=0) != 0).any(axis=1) | (np.diff(rows[:, 2]) > (sizes + 2 * most)[1:])
        first = np.flatnonzero(np.concatenate([[True], new]))
        last = np.concatenate([first[1:], [len(rows)]]) - 1
        code = np.where((words[:-1] >= 0) & (words[1:] >= 0), words[:-1] * self.base + words[1:], -1)
        low = np.maximum(rows[first, 2] - most[first], begins[rows[first, 0]])
        high = np.minimum(rows[last, 2] + sizes[first] + most[first], ends[rows[first, 0]])
        for (d, i), n, k, a, b in zip(rows[first, :2].tolist(), sizes[first].tolist(), most[first].tolist(),
                                      low.tolist(), high.tolist(), strict=True):
            best = found.get((d, i), (k + 1,))
            if not best[0]:
                continue                                  # an exact copy before this place
            if np.isin(code[a:b - 1], self.codes[i]).sum() < n - 1 - 2 * k:
                continue
            edits, start, end = best_place(self.items[i][1], words[a:b], k)
            if edits <= k:
                at = a - int(begins[d])
                found[d, i] = min(best, (edits, at + start, at + end))
        return found


def item_blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """Items in id order, in blocks of at most BLOCK_WORDS words (one item at least)."""
    rows = benchmark.where(F.col(text).isNotNull()).select(item, text).orderBy(item, text)
    block: list[tuple[int, str]] = []
    size = 0
    for r in rows.toLocalIterator():
        n = len(r[1].split())
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += n
    if block:
        yield block


def build_index(block: list[tuple[int, str]], search: Search) -> Index:
    words, ends = word_lists(pa.array([t for _, t in block], pa.string()))
    index = np.asarray(words.indices)
    cuts = np.concatenate([[0], ends])
    items = [(i, index[a:b].astype(np.int64)) for (i, _), a, b in zip(block, cuts, cuts[1:], strict=False) if b > a]
    return Index(search, words.dictionary.to_pylist(), items)


def find_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), *, key: str = "doc_id",
               text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows key, item_id, edits, n_words (of the item), start_word, end_word: the best
    window of each document for each item it holds."""
    spark = docs.sparkSession
    schema = "key long, item_id long, edits int, n_words int, start_word int, end_word int"
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, item, item_text):
        index = spark.sparkContext.broadcast(build_index(block, search))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ix = index.value
            vocabulary = pa.array(ix.vocabulary, pa.large_string())
            for batch in batches:
                for b in text_slices(batch, 1, BATCH_CHARS):
                    words, ends = word_lists(b.column(1))
                    number = pc.fill_null(pc.index_in(words.dictionary.cast(pa.large_string()), vocabulary), -1)
                    numbers = np.asarray(number).astype(np.int64)[np.asarray(words.indices)]
                    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                    hits = [(*at, *w) for at, w in sorted(ix.find(numbers, begins, ends).items())]
                    if hits:
                        d, i, e, s, z = (np.array(c) for c in zip(*hits, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array(d)), pa.array([ix.items[k][0] for k in i], pa.int64()),
                             pa.array(e.astype(np.int32)),
                             pa.array([len(ix.items[k][1]) for k in i], pa.int32()),
                             pa.array(s.astype(np.int32)), pa.array(z.astype(np.int32))],
                            names=["key", "item_id", "edits", "n_words", "start_word", "end_word"])

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out.withColumnRenamed("key", key)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), *,
                      key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without any leak, unchanged; rows of a null key are judged by their
    text's hash."""
    mark = F.coalesce(F.col(key), F.xxhash64(text)).alias("__mark")
    marked = docs.select(F.struct("*").alias("doc"), mark, F.col(text).alias("__text"))
    leaks = find_leaks(marked, benchmark, search, key="__mark", text="__text").select("__mark").distinct()
    return marked.select("doc", "__mark").join(leaks, "__mark", "left_anti").select("doc.*")


def best_leak(leaks: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: its leak of the lowest share of edits."""
    order = Window.partitionBy(key).orderBy(F.col("edits") / F.col("n_words"), "item_id", "start_word")
    return leaks.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
