"""Near duplicates by a chosen-path similarity join on word shingles.

Two texts are linked if the Jaccard similarity of their sets of word 5-grams
is at least 0.8. The join works on distinct texts:

1. Each text gets a fixed-size MinHash sketch: one token per hash function, and
   two texts share a token with the probability of their similarity.
2. Chosen paths: a bucket of texts is split on tokens sampled by a hash of its
   path, so that similar texts follow shared tokens into the same small bucket;
   buckets above a limit are split again. A bucket that a split does not thin
   out holds similar texts and becomes one candidate class. Small buckets are
   compared by brute force on the sketches. Runs repeat with fresh paths until
   the target recall.
3. Candidate links make candidate classes (connected components by min-label
   propagation over tables). Within each class every pair of texts is verified
   exactly, in blocks, on the sets of shingles; the tasks return counts of
   links and spanning links, never all pairs.

Result: one row per document with its class and its number of links. Classes
are the connected components of exact links. A text of fewer than five words
has one shingle of all its words; texts without words (null and empty too) are
linked only to equal texts; a null text counts as empty. Repeated rows are
copies of each other. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import released, sifted, stored, whole_groups
from ridgeline.llm.tokens import text_slices


@dataclass(frozen=True)
class JaccardJoin:
    words: int = 5
    similarity: float = 0.8
    sketch: int = 64              # tokens of a sketch
    children: int = 2             # tokens on which a bucket is split
    bucket: int = 48              # texts up to which a bucket is compared by brute force
    estimate: float = 0.5         # share of equal tokens that makes a candidate link
    thin: float = 0.5             # a child of this share of its parent's texts is not thinner
    depth: int = 12               # most splits in a row
    target_recall: float = 0.999
    block_texts: int = 512        # texts (and shingles) of one side of a block of pairs
    block_shingles: int = 400_000
    seed: int = 5

    @property
    def runs(self) -> int:
        """A pair of similarity s survives a split with probability f = 1 - (1 - s f)^children;
        by the fixed point of f, so many runs miss it less often than the target allows."""
        f = 1.0
        for _ in range(200):
            f = 1 - (1 - self.similarity * f) ** self.children
        return max(2, math.ceil(math.log(1 - self.target_recall) / math.log(max(1 - f, 1e-9))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all texts, and each text's end among them. Words
    are runs without ASCII white space; repeats within a text are kept here."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    raw = split.flatten().dictionary_encode()
    hashes = pd.util.hash_array(raw.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    index = np.asarray(raw.indices)
    empty = pc.index(raw.dictionary, "").as_py()
    keep = index != empty
    h = hashes[index[keep]] if len(index) else np.zeros(0, np.uint64)
    ends = np.concatenate([[0], np.cumsum(keep)])[np.asarray(split.offsets)[1:] - split.offsets[0].as_py()]
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    n = ends - begins
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out_ends = np.cumsum(count)
    first = np.repeat(begins - (out_ends - count), count) + np.arange(int(out_ends[-1]) if len(count) else 0)
    length = np.repeat(np.minimum(n, size), count)
    out = np.zeros(len(first), np.uint64)
    for k in range(size):
        inside = k < length
        word = h[np.minimum(first + k, max(len(h) - 1, 0))] if len(h) else out
        out = np.where(inside, _mix(out * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(k + 1)), out)
    return out, out_ends


def sketches(hashes: np.ndarray, ends: np.ndarray, size: int, seed: int) -> np.ndarray:
    """MinHash sketch of each text with shingles; zeros for one without."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    full = np.flatnonzero(ends > begins)
    out = np.zeros((len(ends), size), np.uint32)
    if len(full):
        rng = np.random.default_rng(seed)
        a = rng.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for i in range(size):
            v = ((hashes * a[i] + b[i]) >> np.uint64(32)).astype(np.uint32)
            out[full, i] = np.minimum.reduceat(v, begins[full])
    return out


def text_sketches(docs: DataFrame, join: JaccardJoin, *, key: str, text: str) -> DataFrame:
    """Rows doc, same (MD5 of the text), n_shingles, sketch (list of ints)."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.md5(value).alias("same"), value.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, 2, 500_000):
                h, ends = shingles(b.column(2), join.words)
                sk = sketches(h, ends, join.sketch, join.seed).view(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, sk.size + 1, join.sketch, dtype=np.int32)), pa.array(sk.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(np.diff(ends, prepend=0).astype(np.int32)), lists],
                    names=["doc", "same", "n_shingles", "sketch"])

    return rows.mapInArrow(released(run), "doc long, same string, n_shingles int, sketch array<int>")


def _children(path: Column, join: JaccardJoin) -> Column:
    """Sampled positions of a path's split: the first of all positions by hash."""
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(join.sketch - 1)), lambda i: F.struct(
        F.xxhash64(path, i, F.lit(join.seed)).alias("h"), i.alias("i"))))
    return F.transform(F.slice(ranked, 1, join.children), lambda s: s["i"])


def _bucket_links(batches: Iterator[pa.RecordBatch], join: JaccardJoin) -> Iterator[pa.RecordBatch]:
    """Spanning links of candidates within each bucket (rows sorted by path)."""
    for table in whole_groups(batches, "path"):
        path = table["path"].to_numpy()
        node = table["node"].combine_chunks()
        sk = np.asarray(table["sketch"].combine_chunks().flatten()).reshape(len(path), -1)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
        left, right = [], []
        for a, z in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            root = list(range(z - a))
            part = sk[a:z]
            for i in range(1, z - a):
                near = np.flatnonzero((part[:i] == part[i]).mean(axis=1) >= join.estimate)
                for j in near.tolist():
                    while root[j] != j:
                        j = root[j]
                    if j != i and root[j] != i:
                        root[j] = i
                        left.append(a + j)
                        right.append(a + i)
        yield pa.RecordBatch.from_arrays([node.take(pa.array(left, pa.int64())), node.take(pa.array(right, pa.int64()))],
                                         names=["a", "b"])


def candidate_links(texts: DataFrame, join: JaccardJoin) -> DataFrame:
    """Links (a, b) between nodes whose components hold every pair above the similarity,
    up to the target recall. ``texts``: node, sketch."""
    runs = F.array(*[F.xxhash64(F.lit(join.seed), F.lit(r)) for r in range(join.runs)])
    rows = (texts.select("node", "sketch", F.explode(runs).alias("path"))
            .withColumn("parent_n", F.lit(None).cast("long")))
    links = None
    for depth in range(join.depth + 1):
        i = F.explode(_children(F.col("path"), join)).alias("i")
        split = stored(rows.select("node", "sketch", "parent_n", "path", i).select(
            "node", "parent_n", F.xxhash64("path", "i", F.col("sketch")[F.col("i")]).alias("path")))
        # sizes first: a text alone in its bucket moves no sketch; as a table of their own, so that
        # Spark can split the join on a path that holds many texts
        sizes = stored(split.groupBy("path").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1"))
        rows = stored(split.join(sizes, "path").join(texts, "node").select(
            "path", "node", "n", "first", "sketch",
            F.coalesce(F.col("n") >= join.thin * F.col("parent_n"), F.lit(False)).alias("dense")))
        small = rows.where(F.col("n") <= join.bucket).select("path", "node", "sketch")
        found = (small.repartition("path").sortWithinPartitions("path")
                 .mapInArrow(released(lambda b: _bucket_links(b, join)), "a long, b long"))
        large = rows.where(F.col("n") > join.bucket)
        last = F.lit(depth == join.depth)
        star = (large.where(F.col("dense") | last).where("first <> node")
                .select(F.col("first").alias("a"), F.col("node").alias("b")))
        found = found.unionByName(star)
        links = found if links is None else links.unionByName(found)
        rows = large.where(~(F.col("dense") | last)).select(
            "node", "sketch", "path", F.col("n").alias("parent_n"))
        if rows.isEmpty():
            break
    return links.distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows node, class (least node of its component) for all nodes of ``links`` (a, b):
    least labels spread along links and jump along labels until nothing changes."""
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("class")))
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a")
                .agg(F.min("class").alias("near")))
        lower = (labels.join(near, labels["node"] == near["a"], "left")
                 .select("node", F.col("class").alias("old"), F.least("class", "near").alias("to")))
        jump = lower.join(labels.select(F.col("node").alias("to"), F.col("class").alias("far")), "to", "left")
        new = stored(jump.select("node", "old", F.least("to", "far").alias("class")))
        if new.where(F.col("class") != F.col("old")).isEmpty():
            return new.select("node", "class")
        labels = new.select("node", "class")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs. Shingles held by one text only are left
    out; the others become columns of 0 and 1, multiplied a slice at a time."""
    n = len(sets)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    column, owner = number[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), np.float32)
    width = 2048
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, z = np.searchsorted(column, [at, at + width])
        m = np.zeros((n, width), np.float32)
        m[owner[a:z], column[a:z] - at] = 1
        out += m @ m.T
    return out


def _verify(batches: Iterator[pa.RecordBatch], join: JaccardJoin) -> Iterator[pa.RecordBatch]:
    """Of every block of pairs (rows sorted by block): per text its links (weighted by
    copies) and one link to a text of its component here."""
    for table in whole_groups(batches, "block"):
        keys = table["block"].combine_chunks().dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            t = table.slice(a, z - a)
            node, side = t["node"].to_numpy(), t["side"].to_numpy()
            h, ends = shingles(t["text"].combine_chunks(), join.words)
            sets = [np.unique(x) for x in np.split(h, ends[:-1])]
            size = np.array([len(s) for s in sets], np.float32)
            inter = _overlaps(sets)
            # exact in integers: J >= s  <=>  inter >= s * union
            union = size[:, None] + size[None, :] - inter
            linked = (inter * 1000 >= join.similarity * 1000 * union - 1e-6) & (union > 0)
            np.fill_diagonal(linked, False)
            if (side == 1).any():          # two blocks: only pairs across
                linked &= side[:, None] != side[None, :]
            counted = linked @ t["copies"].to_numpy().astype(np.float64)
            root = np.arange(len(node))
            for i in range(len(node)):      # label by the least reachable text
                if root[i] == i:
                    todo = [i]
                    while todo:
                        k = todo.pop()
                        new = np.flatnonzero(linked[k] & (root > i))
                        root[new] = i
                        todo += new.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(node[root]),
                 pa.array(counted.astype(np.int64))], names=["node", "to", "links"])


def verified_links(texts: DataFrame, classes: DataFrame, join: JaccardJoin) -> DataFrame:
    """Rows node, to, links. ``texts``: node, text, n_shingles, copies of the texts in
    candidate classes. A class is cut into blocks by its number of texts and shingles,
    and every pair of blocks is one group."""
    size = classes.groupBy("class").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / join.block_texts), F.ceil(F.col("s") / join.block_shingles), F.lit(1))
    plan = (classes.join(size, "class").where("n > 1").withColumn("k", blocks.cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    pairs = (plan.select("node", "class", "own", other)
             .select("node", (F.col("own") > F.col("other")).cast("int").alias("side"),
                     F.concat_ws(":", F.col("class").cast("string"), F.least("own", "other").cast("string"),
                                 F.greatest("own", "other").cast("string")).alias("block")))
    rows = pairs.join(texts.select("node", "text", "copies"), "node")
    return (rows.repartition("block").sortWithinPartitions("block", "node")
            .mapInArrow(released(lambda b: _verify(b, join)), "node long, to long, links long"))


def near_duplicates(docs: DataFrame, join: JaccardJoin = JaccardJoin(), *, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Rows key, text_md5, class_id (least key of the class), n_links (other documents at or
    above the similarity, copies included), n_copies (documents of the same text)."""
    rows = stored(text_sketches(docs, join, key=key, text=text))
    distinct = stored(rows.groupBy("same").agg(
        F.min("doc").alias("doc"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch")).withColumn("node", F.monotonically_increasing_id()))
    links = stored(candidate_links(distinct.where("n_shingles > 0").select("node", "sketch"), join))
    about = distinct.select("node", "same", "doc", "copies", "n_shingles")
    candidates = stored(components(links).join(about, "node"))
    exact = stored(verified_links(_texts(docs, candidates, key, text), candidates, join))
    counts = exact.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(exact.where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")))
    named = linked.join(about.select("node", "doc"), "node")
    least = named.groupBy("class").agg(F.min("doc").alias("class_id"))
    classes = named.join(least, "class").select("node", "class_id")
    of_text = (about.join(classes, "node", "left").join(counts, "node", "left")
               .select("same", F.coalesce("class_id", "doc").alias("class_id"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.col("copies").alias("n_copies")))
    return (rows.select("doc", "same").join(of_text, "same")
            .select(F.col("doc").alias(key), F.col("same").alias("text_md5"), "class_id", "n_links", "n_copies"))


def _texts(docs: DataFrame, candidates: DataFrame, key: str, text: str) -> DataFrame:
    """Rows node, text, copies: the text of one document of each candidate. Few documents are
    candidates, so most others are sifted out where they are read."""
    value = F.coalesce(F.col(text), F.lit(""))
    full = docs.select(F.col(key).cast("long").alias("doc"), F.md5(value).alias("same"), value.alias("text"))
    c = candidates.select("node", "copies", F.col("same").alias("c_same"), F.col("doc").alias("c_doc"))
    full = sifted(full, F.xxhash64("same", "doc"), candidates.select(F.xxhash64("same", "doc").alias("h")))
    on = (full["same"] == c["c_same"]) & full["doc"].eqNullSafe(c["c_doc"])
    return full.join(c, on).select("node", "text", "copies").dropDuplicates(["node"])


def keep_one(docs: DataFrame, join: JaccardJoin = JaccardJoin(), *, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """Rows of ``docs`` without near duplicates: of each class the document of the least key
    stays (of repeated rows, one)."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(key).alias("__key"), F.col(text).alias("__text"))
    classes = near_duplicates(rows, join, key="__key", text="__text")
    chosen = (classes.where(F.col("__key").eqNullSafe(F.col("class_id")))
              .select(F.col("__key").alias("k"), F.col("text_md5").alias("m")).distinct())
    marked = rows.withColumn("__m", F.md5(F.coalesce("__text", F.lit(""))))
    same = (marked["__m"] == chosen["m"]) & marked["__key"].cast("long").eqNullSafe(chosen["k"])
    return marked.join(chosen, same, "left_semi").dropDuplicates(["__key", "__m"]).select("doc.*")
