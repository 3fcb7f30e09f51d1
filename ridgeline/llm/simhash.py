"""Near duplicates by SimHash fingerprints and a vantage-point tree of shards.

Fingerprint: 64 bits; a bit is set if it is set in more than half of the 64-bit
hashes (XXH64, seed 42, which Spark's ``xxhash64`` is) of the text's word
shingles. Hashes are made on the JVM, bits are counted with numpy per batch.

Search: all pairs of distinct fingerprints within a Hamming distance, exactly.
The tree has a vantage point and one level per range of bits; a level parts
fingerprints by their distance from the vantage point on its range. By the
triangle inequality two fingerprints at distance d differ by at most d in these
distances, and as the ranges share no bit, by at most d over all levels: a branch
whose differences add up to more is pruned. A path of distances names a shard.
Each fingerprint is stored in its own shard and is a query to its own and to
those shards that overlap its boundary and hold anything at all (found on the
table of shards, not of fingerprints). One direction of each pair of shards is
enough. In a shard's cells queries meet stored fingerprints by XOR and popcount.

Size: the tree is as deep as the number of fingerprints asks for; a shard above
``leaf`` fingerprints (a cluster of near copies) is parted again on finer ranges,
and cut into cells at the finest; many queries to one shard are spread over
copies of it. No cell holds more than ``leaf`` stored fingerprints and about
``work`` comparisons; cells return spanning links, never all pairs.

Equal fingerprints are linked without a search. Null text counts as empty; a
text without words has fingerprint zero, linked like any other. Rows with equal
keys are separate documents of one name; a component named by null keys only has
a null id. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import let, stored, whole_groups, words_of
from ridgeline.llm.jaccard import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SimHash:
    words: int = 3
    distance: int = 2
    vantage: int = 0x1F83D9ABFB41BD6B
    levels: tuple[int, ...] = (4, 6, 8, 12, 16)      # ranges of bits: depth of the tree, then finer
    leaf: int = 4096                 # stored fingerprints of a cell
    work: int = 1 << 28              # comparisons of a cell
    hashes: int = 250_000            # hashes whose bits are counted at a time
    shares: int = 16                 # tasks to which the copies of one fingerprint are dealt


def shingle_hashes(text: Column, size: int) -> Column:
    """XXH64 hashes of a text's word shingles (fewer words: one of all of them)."""
    def of(w: Column) -> Column:
        n = F.size(w)
        each = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(
            F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)])))
        return (F.when(n >= size, each).when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", w))))
                .otherwise(F.array().cast("array<bigint>")))

    return let(words_of(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)), of)


def majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``hashes``; zero for an empty run."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    out, full = np.zeros(len(ends), np.uint64), np.flatnonzero(ends > begins)
    if len(full):
        two, half = np.uint64(0x0000000100000001), (ends - begins)[full]
        for bit in range(32):                      # two counters of 32 bits at a time
            both = np.add.reduceat((hashes >> np.uint64(bit)) & two, begins[full])
            for count, at in ((both & np.uint64(0xFFFFFFFF), bit), (both >> np.uint64(32), bit + 32)):
                out[full] |= (2 * count.astype(np.int64) > half).astype(np.uint64) << np.uint64(at)
    return out


def fingerprints(docs: DataFrame, method: SimHash = SimHash(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows doc (the key), fp (fingerprint, long)."""
    rows = docs.select(F.col(key).alias("doc"), shingle_hashes(F.col(text), method.words).alias("h"))
    doc_type = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.asarray(batch.column(1).offsets)[1:].astype(np.int64)
            part = ends // method.hashes
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if z > a:
                    b = batch.slice(a, z - a)
                    sizes = np.diff(np.asarray(b.column(1).offsets)).astype(np.int64)
                    fp = majority(np.asarray(b.column(1).flatten()).view(np.uint64), np.cumsum(sizes))
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc", "fp"])

    return rows.mapInArrow(run, f"doc {doc_type}, fp long")


def _ranges(levels: int) -> list[tuple[int, int]]:
    """Bits cut into ``levels`` ranges: (mask as a signed long, width)."""
    cuts = [64 * i // levels for i in range(levels + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [(m - (1 << 64) if m >> 63 else m, m.bit_count()) for m in masks]


def _radix(levels: int, distance: int) -> int:
    """Base of a path's digits: a step of up to ``distance`` beyond either end names no shard."""
    return max(w for _, w in _ranges(levels)) + 1 + 2 * distance


def shard_of(fp: Column, levels: int, method: SimHash) -> Column:
    """Path of a fingerprint: its distances from the vantage point, one digit per level."""
    path = F.lit(0).cast("long")
    for mask, _ in _ranges(levels):
        d = F.bit_count(fp.bitwiseXOR(F.lit(method.vantage)).bitwiseAND(F.lit(mask))).cast("long")
        path = path * _radix(levels, method.distance) + d + method.distance
    return path


def boundary_steps(levels: int, distance: int) -> list[int]:
    """Differences of paths whose digits differ by at most ``distance`` in total."""
    radix, steps = _radix(levels, distance), {(0, 0)}
    for _ in range(levels):
        steps = {(p * radix + s, used + abs(s)) for p, used in steps
                 for s in range(used - distance, distance - used + 1)}
    return sorted({p for p, _ in steps})


def _cell_links(batches: Iterator[pa.RecordBatch], method: SimHash) -> Iterator[pa.RecordBatch]:
    """Spanning links (a, b) of each cell (rows sorted by cell): a query and a stored
    fingerprint near it, or two stored ones near the same query."""
    for table in whole_groups(batches, "cell"):
        cell, stored_ = table["cell"].to_numpy(), table["stored"].to_numpy()
        fps = table["fp"].to_numpy().view(np.uint64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]]).tolist()
        left, right = [], []
        for a, z in zip(cuts, cuts[1:], strict=False):
            here, is_stored = fps[a:z], stored_[a:z]
            points, queries = here[is_stored], here[~is_stored]
            if not len(points):
                continue
            label, step = np.arange(len(points)), max(1, (1 << 20) // len(points))
            for at in range(0, len(queries), step):
                q = queries[at:at + step]
                apart = np.bitwise_count(q[:, None] ^ points[None, :])
                row, col = np.nonzero((apart > 0) & (apart <= method.distance))
                if not len(row):
                    continue
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                left.append(q[row[begin]])
                right.append(points[col[begin]])
                several = np.diff(np.append(begin, len(row))) > 1
                for b, e in zip(begin[several].tolist(), np.append(begin, len(row))[1:][several].tolist(), strict=True):
                    near = col[b:e]
                    labels, first = np.unique(label[near], return_index=True)
                    if len(labels) > 1:
                        left.append(np.repeat(points[near[first[0]]], len(labels) - 1))
                        right.append(points[near[first[1:]]])
                        label[np.isin(label, labels[1:])] = labels[0]
        none = [np.zeros(0, np.uint64)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left or none).view(np.int64)),
                                          pa.array(np.concatenate(right or none).view(np.int64))], names=["a", "b"])


def _search(points: DataFrame, levels: int, first: bool, last: bool, method: SimHash) -> tuple[DataFrame, DataFrame]:
    """One depth of the tree. ``points``: fp, stored (else only a query). Returns the links
    of shards that are small enough, and the points that go on to finer ranges. At the
    first depth all points are stored, so that one direction of the steps will do."""
    steps = [s for s in boundary_steps(levels, method.distance) if s >= 0 or not first]
    steps = F.explode(F.array(*[F.lit(s).cast("long") for s in steps]))
    placed = stored(points.withColumn("shard", shard_of(F.col("fp"), levels, method)))
    shards = stored(placed.groupBy("shard").agg(F.count("*").alias("queries"),
                                                F.count_if("stored").alias("n")))
    pairs = (shards.select("shard", "queries", steps.alias("step"))
             .select("shard", "queries", (F.col("shard") + F.col("step")).alias("target"))
             .join(shards.where("n > 0").select(F.col("shard").alias("target"), "n"), "target"))
    pairs = stored(pairs)
    # cells of a shard: blocks of stored points, each copied once per share of the queries
    blocks = F.ceil(F.col("n") / method.leaf) if last else F.lit(1)
    cells = pairs.groupBy("target").agg(F.first("n").alias("n"), F.sum("queries").alias("q")).select(
        "target", "n", blocks.cast("int").alias("blocks"),
        F.ceil(F.col("q") * F.least("n", F.lit(method.leaf)) / method.work).cast("int").alias("shares"))
    large = F.lit(False) if last else F.col("n") > method.leaf
    cells = stored(cells.withColumn("large", large))
    targets = pairs.select("shard", "target").join(cells, "target").groupBy("shard").agg(
        F.max("large").alias("goes_on"),
        F.collect_list(F.when(~F.col("large"), F.struct("target", "blocks", "shares"))).alias("targets"))
    cell = F.xxhash64("target", "block", "share").alias("cell")

    def at(n: Column) -> Column:
        return F.pmod(F.xxhash64("fp"), n)

    held = (placed.where("stored").join(cells.where("not large").withColumnRenamed("target", "shard"), "shard")
            .select("fp", F.col("shard").alias("target"), at(F.col("blocks")).alias("block"), "shares")
            .select("fp", "target", "block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
            .select(cell, "fp", F.lit(True).alias("stored")))
    asked = placed.join(targets, "shard")
    sent = (asked.select("fp", F.explode("targets").alias("t"))
            .select("fp", "t.target", "t.blocks", at(F.col("t.shares")).cast("int").alias("share"))
            .select("fp", "target", "share", F.explode(
                F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"))
            .select(cell, "fp", F.lit(False).alias("stored")))
    links = (held.unionByName(sent).repartition("cell").sortWithinPartitions("cell")
             .mapInArrow(lambda b: _cell_links(b, method), "a long, b long"))
    rest = asked.where("goes_on").join(
        cells.where("large").select(F.col("target").alias("shard"), "large"), "shard", "left")
    return links, rest.select("fp", (F.col("stored") & F.coalesce("large", F.lit(False))).alias("stored"))


def near_links(fps: DataFrame, method: SimHash = SimHash()) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct ``fps`` (fp) within the distance."""
    points = stored(fps.select("fp", F.lit(True).alias("stored")))
    n, levels = points.count(), list(method.levels)
    likely = lambda k: math.prod(math.comb(w, w // 2) / 2 ** w for _, w in _ranges(k))
    while len(levels) > 1 and n * likely(levels[0]) > method.leaf / 2:
        levels.pop(0)
    links = None
    for k in levels:
        found, rest = _search(points, k, k == levels[0], k == levels[-1], method)
        found = stored(found)
        links = found if links is None else links.unionByName(found)
        if k != levels[-1]:
            points = stored(rest)
            if points.isEmpty():
                break
    return links.distinct()


def simhash_duplicates(docs: DataFrame, method: SimHash = SimHash(), *, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Rows key, fp (long), component_id (least key reachable over links of fingerprints)."""
    rows = stored(fingerprints(docs, method, key=key, text=text))
    distinct = stored(rows.groupBy("fp").agg(F.min("doc").alias("least"), F.count("*").alias("n")))
    classes = components(near_links(distinct.select("fp"), method)).withColumnRenamed("node", "fp")
    least = (distinct.join(classes, "fp").groupBy("class").agg(F.min("least").alias("component_id")))
    of_fp = distinct.join(classes.join(least, "class"), "fp", "left").select(
        "fp", "n", "class", F.when(F.col("class").isNotNull(), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    # a fingerprint of one document without links names it itself; the others' components are
    # dealt to several tasks, so that many copies of one text are not one task's
    shares = F.sequence(F.lit(0), F.lit(method.shares - 1))
    of_many = of_fp.where((F.col("n") > 1) | F.col("class").isNotNull()).select(
        "fp", "component_id", F.explode(shares).alias("share"))
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("doc"), F.lit(method.shares)).cast("int"))
    return dealt.join(of_many, ["fp", "share"], "left").select(
        F.col("doc").alias(key), "fp", F.coalesce("component_id", "doc").alias("component_id"))
