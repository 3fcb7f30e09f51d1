"""Token ids of whole texts, and their Parquet file format.

``Encoder`` gives exactly the ids of the tokenizers library. The vocabulary's
pre-tokenizer never joins characters across white space, so each distinct
piece between white space is encoded by the library once and remembered.

``write_tokens`` / ``read_tokens``: files in ascending key order, with the ids
as a list column (dictionary encoding), small row groups and pages with page
indexes, and lengths and places in columns of their own, so that a reader of
metadata touches no ids and a reader of some keys skips row groups and pages.

Null text counts as empty: it has only the end id. Equal keys stay together
in the order of their texts' hashes. An empty table writes empty files.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from ridgeline.session import scratch_path

END_ID = 2
CACHE_BYTES = 64 << 20        # text of remembered strings
#: Letters, then ASCII marks but for the apostrophe (some vocabularies join it to letters).
WORD_AND_MARKS = r"^(?P<word>\p{L}+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
LETTERS = r"^\p{L}+$"
TOGETHER = 256                # words encoded as one text
ROW_GROUP_BYTES = 8 << 20
PAGE_BYTES = 64 << 10


@dataclass(frozen=True)
class Room:
    """What a worker's encoder may hold. With less room more strings are encoded again, so a
    task that does nothing else takes more of it."""

    pieces: int = 1_000_000      # remembered strings between white space
    words: int = 1_000_000       # remembered words without their marks
    chars: int = 4_000_000       # text encoded at a time


SHARED = Room(pieces=300_000, words=600_000, chars=2_000_000)      # in an executor that has other work


class Memory:
    """Ids of strings, kept until there are more than ``most``. The strings are an Arrow array:
    each call hashes only the asked ones, and looks the kept ones up among them."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.known = pa.array([], pa.large_string())
        self.ids = np.zeros(1 << 20, np.uint32)
        self.starts, self.lengths = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)
        self.used = self.bytes = 0

    def slots(self, strings: pa.Array, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Number of each of the distinct ``strings``; ``learn`` gives the lengths and ids of new ones."""
        size = pc.sum(pc.binary_length(strings)).as_py() or 0
        if len(self.known) and (len(self.known) + len(strings) > self.most or self.bytes + size > CACHE_BYTES):
            self.known, self.used, self.bytes = pa.array([], pa.large_string()), 0, 0
        slot = np.full(len(strings), -1, np.int64)
        place = pc.index_in(self.known, value_set=strings)
        slot[np.asarray(place.drop_null())] = np.flatnonzero(np.asarray(place.is_valid()))
        new = np.flatnonzero(slot < 0)
        if len(new):
            strings = strings.take(pa.array(new))
            lengths, flat = learn(strings)
            n, k = len(self.known), len(new)
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            while n + k > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
                self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.ids[self.used:self.used + len(flat)] = flat
            self.starts[n:n + k] = self.used + np.cumsum(lengths) - lengths
            self.lengths[n:n + k] = lengths
            self.used += len(flat)
            self.bytes += pc.sum(pc.binary_length(strings)).as_py() or 0
            slot[new] = np.arange(n, n + k)
            self.known = pa.concat_arrays([self.known, strings])
        return slot

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of the strings of these numbers, one after the other."""
        lengths = self.lengths[slots]
        done = np.cumsum(lengths)
        at = np.repeat(self.starts[slots] - (done - lengths), lengths)
        at += np.arange(len(at))
        return lengths, self.ids[at]


class Encoder:
    """Ids of texts by the tokenizers library, with a memory of pieces and of their words."""

    def __init__(self, path: str, end_id: int | None = END_ID, room: Room = Room()):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([] if end_id is None else [end_id], np.uint32)
        self.pieces, self.words = Memory(room.pieces), Memory(room.words)
        self.closes: dict[str, bool] = {}         # of letters met at the end of words

    def _tokenize(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the vocabulary marks the last id of a word, words of letters are encoded many
        as one text, which costs less than one by one, and cut at the marks."""
        if self.symbols is None:
            return self._tokenize_each(strings)
        ends, sizes = self.symbols
        joined = np.array(pc.match_substring_regex(strings, LETTERS))
        at = np.flatnonzero(joined)
        words, n_bytes = strings.take(pa.array(at)).to_pylist(), np.asarray(pc.binary_length(strings))
        lengths, flat = np.zeros(len(strings), np.int64), []
        texts = [" ".join(words[i:i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        for i, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            mine, ids = at[i * TOGETHER:(i + 1) * TOGETHER], np.array(e.ids, np.uint32)
            cuts = np.concatenate([[0], np.flatnonzero(ends[ids]) + 1])
            if (len(cuts) == len(mine) + 1 and cuts[-1] == len(ids)
                    and np.array_equal(np.add.reduceat(sizes[ids], cuts[:-1]), n_bytes[mine])):
                lengths[mine] = np.diff(cuts)
                flat.append(ids)
            else:                              # some word has several ends, or is changed in length
                joined[mine] = False
        if not joined.all():
            lengths[~joined], rest = self._tokenize_each(strings.filter(pa.array(~joined)))
            ids = np.empty(int(lengths.sum()), np.uint32)
            own = np.repeat(joined, lengths)
            ids[own], ids[~own] = np.concatenate([*flat, np.empty(0, np.uint32)]), rest
            return lengths, ids
        return lengths, np.concatenate([*flat, np.empty(0, np.uint32)])

    def _tokenize_each(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(strings.to_pylist(), add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return lengths, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))

    @cached_property
    def symbols(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Whether an id closes a word, and its length without that mark (bytes, in a byte-level
        vocabulary), for each id; None for a vocabulary without such a mark."""
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not mark:
            return None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        ends, sizes = (np.zeros(max(vocabulary.values()) + 1, t) for t in (bool, np.int64))
        for symbol, i in vocabulary.items():
            ends[i], sizes[i] = symbol.endswith(mark), len(symbol.removesuffix(mark))
        return ends, sizes

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A piece of letters and closing marks is a word and its marks: the vocabulary's
        pre-tokenizer cuts there, and lower-cases. Any other piece is kept whole."""
        if not self.cuts_words:
            return self._tokenize(pieces)
        parts = pc.extract_regex(pieces, WORD_AND_MARKS)
        word, marks = pc.struct_field(parts, 0), pc.fill_null(pc.struct_field(parts, 1), "")
        cut = self._closing(pc.fill_null(word, ""))
        word, marks = pc.if_else(cut, pc.ascii_lower(word), pieces), pc.if_else(cut, marks, "")
        both = pa.concat_arrays([word, marks]).dictionary_encode()
        slot = self.words.slots(both.dictionary, self._tokenize)[np.asarray(both.indices)]
        lengths, ids = self.words.gather(slot.reshape(2, -1).T.ravel())
        return lengths.reshape(-1, 2).sum(axis=1), ids

    def _closing(self, words: pa.Array) -> pa.Array:
        """Whether the pre-tokenizer cuts before marks after these words: not where the last
        letter is normalised to one with an accent of its own. Tried once for each letter."""
        last = pc.utf8_slice_codeunits(words, start=-1, stop=sys.maxsize)
        for c in pc.unique(last).to_pylist():
            if c and c not in self.closes:
                spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(c + ","))
                self.closes[c] = spans[-1][0] == ","
        return pc.is_in(last, value_set=pa.array([c for c, yes in self.closes.items() if yes], last.type))

    @cached_property
    def cuts_words(self) -> bool:
        """Whether the tokenizer encodes letters and the marks after them apart, in lower
        case. Told by the normaliser and the pre-tokenizer themselves."""
        normalizer, cutter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normalizer is None or cutter is None:
            return False
        samples = ["Ab" + chr(c) * 2 for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]
        return all(normalizer.normalize_str(t) == t.lower()
                   and [span for _, span in cutter.pre_tokenize_str(t.lower())] == [(0, 2), (2, 4)] for t in samples)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and each text's end in it; each text is closed by the end id."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(texts)
        pieces = split.flatten().dictionary_encode()
        slot = self.pieces.slots(pieces.dictionary, self._learn)
        lengths, ids = self.pieces.gather(slot[np.asarray(pieces.indices)])
        done = np.concatenate([[0], np.cumsum(lengths)])
        ends = done[np.asarray(split.offsets)[1:] - split.offsets[0].as_py()]
        k = len(self.end)
        if k:
            ids = np.insert(ids, np.repeat(ends, k), np.tile(self.end, len(ends)))
            ends = ends + k * np.arange(1, len(ends) + 1)
        return ids.astype(np.uint32, copy=False), ends


@lru_cache(maxsize=1)
def encoder(path: str, end_id: int | None = END_ID, room: Room = Room()) -> Encoder:
    """One per worker process."""
    return Encoder(path, end_id, room)


def text_slices(batch: pa.RecordBatch, column: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``chars`` bytes of text each; at least one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    part = np.cumsum(sizes) // chars
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, key: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, files: int | None = None, room: Room = SHARED) -> None:
    """Write one row per document to ``path``: key, part (number of the file), part_start
    (ids before it in that file), n_tokens, ids. Ascending keys within and over the
    parts; a task encodes its part in order and holds one batch at a time."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = (rows.repartitionByRange(files, F.col("key").asc_nulls_first())
            .sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = encoder(tokenizer, end_id, room), TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in text_slices(batch, 1, room.chars):
                ids, ends = enc.encode(b.column(1))
                starts = np.concatenate([[0], ends[:-1]])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                                 pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.full(len(ends), part, np.int32)), pa.array(before + starts),
                     pa.array(ends - starts), lists], names=["key", "part", "part_start", "n_tokens", "ids"])
                before += len(ids)

    out = rows.mapInArrow(run, "key long, part int, part_start long, n_tokens long, ids array<int>")
    (out.withColumnRenamed("key", key).write.mode("overwrite")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.page.row.count.limit", 1000).option("parquet.enable.dictionary", "true")
     .option("parquet.dictionary.page.size", 1 << 20).option("compression", "zstd").parquet(path))


def read_tokens(spark: SparkSession, path: str, *, key: str = "doc_id", ids: bool = True) -> DataFrame:
    """Rows key, start (ids of all documents before it), n_tokens and, if asked for, ids.
    The starts come from the metadata columns: one total per part."""
    schema = (StructType().add(key, LongType()).add("part", IntegerType()).add("part_start", LongType())
              .add("n_tokens", LongType()).add("ids", ArrayType(IntegerType())))
    rows = spark.read.schema(schema).parquet(path)
    totals = sorted(tuple(r) for r in rows.groupBy("part").agg(F.sum("n_tokens")).collect())
    before, starts = 0, []
    for part, n in totals:                 # one row per file
        starts.append((part, before))
        before += n
    offsets = spark.createDataFrame(starts, "part int, before long")
    return (rows.join(F.broadcast(offsets), "part")
            .select(key, (F.col("before") + F.col("part_start")).alias("start"), "n_tokens",
                    *(["ids"] if ids else [])))


def ids_crc32(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``df`` with the list column replaced by ``ids_crc32``: CRC-32 of the ids as
    little-endian unsigned 32-bit integers."""
    import zlib

    keep = [c for c in df.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.num_columns - 1)
            cuts, flat = np.asarray(lists.offsets), np.asarray(lists.values, np.uint32)
            sums = [zlib.crc32(flat[a:z].astype("<u4").tobytes()) for a, z in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sums, pa.int64())],
                                             names=[*keep, "ids_crc32"])

    out = StructType([df.schema[c] for c in keep]).add("ids_crc32", LongType())
    return df.select(*keep, ids).mapInArrow(run, out)


def token_files(docs: DataFrame, tokenizer: str, **kw) -> str:
    """write_tokens to a fresh folder beside the checkpoints; returns its path."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, **kw)
    return path
