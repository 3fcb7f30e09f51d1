"""Spelling variants: exact neighbours of words by a dictionary of trie-node pairs.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. The nodes of the trie of all words (prefixes) and of the trie of
all reversed words (suffixes) are numbered. A word then is in as many integer
pairs (prefix node, suffix node) as it has places:

* skipped: prefix of i and suffix after position i, the word without that code
  point; words that share such a pair differ by one replaced code point;
* inserted: prefix of i and suffix from position i, the whole word; a word whose
  skipped pair equals it has one code point more.

So one grouping by the pair gives every neighbour, without comparing words. A
pair belongs to one prefix, one suffix and one length, hence a group holds at
most one word per code point of the alphabet and one shorter word, whatever the
number of words; a group returns one row per member (its number of neighbours
there and the best of them), never its pairs. A code point equal to the one
before it is not skipped twice for the same result.

Numbering: words are sorted over range partitions; a task gives each word the
nodes below the longest common prefix with its predecessor, and the first and
last word of each partition (one row per partition) tell which nodes an earlier
partition has numbered already. Numbers grow with the words, so a word's last
node also orders words by code points.

Input: one row per word with its count. Null words are left out, an empty word
has its neighbours of one code point, repeated rows of a word are added up, and
an empty table gives no rows. Long words take memory in proportion to their
length. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import let, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INSERTED, SKIPPED, SKIPPED_AGAIN = 0, 1, 2


@dataclass(frozen=True)
class Variants:
    ratio: int = 2          # a form occurs at least this many times as often as its variant


def letter_runs(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` as doc, and run: each maximal run of Latin letters (ASCII and U+00C0 to
    U+00FF) of each text, A to Z lower-cased. Null texts have none."""
    split = F.split(F.translate(F.col(text), UPPER, LOWER), "[^a-z\u00C0-\u00FF]+")
    return docs.select(F.struct(*keep).alias("doc"), F.explode(split).alias("run")).where("run <> ''")


def common_prefix(a: str, b: str) -> int:
    """Number of code points that both words begin with."""
    if b.startswith(a):
        return len(a)
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _task_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted words of one partition, numbered from 0 within it."""
    part, place, free, path = TaskContext.get().partitionId(), 0, 0, []
    first, before = None, ""
    for batch in batches:
        flat, ends, shared, places, used = [], [0], [], [], []
        words = batch.column(0).to_pylist()
        for w in words:
            first = w if first is None else first
            old = common_prefix(before, w)
            path[old:] = range(free, free + len(w) - old)
            free += len(w) - old
            before = w
            flat += path
            ends.append(len(flat))
            shared.append(common_prefix(first, w))
            places.append(place)
            used.append(free)
            place += 1
        nodes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([part] * len(words), pa.int32()), pa.array(places, pa.int64()),
             pa.array(used, pa.int64()), pa.array(shared, pa.int32()), nodes],
            names=["word", "part", "place", "used", "shared", "nodes"])


def trie_nodes(words: DataFrame) -> DataFrame:
    """Rows word, nodes of distinct non-null ``words``: the number of the trie node of each
    prefix, the empty one (0) first."""
    schema = "word string, part int, place long, used long, shared int, nodes array<long>"
    local = stored(words.select("word").repartitionByRange("word").sortWithinPartitions("word")
                   .mapInArrow(_task_nodes, schema))
    # one row per partition: where its numbers start, and the nodes of its first word that
    # the last word before it has already
    ends = (local.groupBy("part").agg(F.min_by("word", "place").alias("first"), F.max("used").alias("used"),
                                      F.max_by(F.struct("word", "shared", "nodes"), "place").alias("last"))
            .orderBy("part").collect())
    starts, offset, last_word, last_path = [], 1, "", []
    for e in ends:
        known = last_path[:common_prefix(last_word, e["first"])]
        starts.append((e["part"], offset, known))
        last = e["last"]
        kept = known[:last["shared"]]
        last_word, last_path = last["word"], kept + [offset + x for x in last["nodes"][len(kept):]]
        offset += e["used"]
    if not starts:
        return local.select("word", "nodes")
    start = words.sparkSession.createDataFrame(starts, "part int, offset long, known array<long>")
    number = lambda x, i: F.when(i < F.least(F.col("shared"), F.size("known")), F.col("known")[i])
    nodes = F.transform("nodes", lambda x, i: number(x, i).otherwise(x + F.col("offset")))
    return (local.join(start, "part")
            .select("word", F.concat(F.array(F.lit(0).cast("long")), nodes).alias("nodes")))


def node_pairs(words: DataFrame) -> DataFrame:
    """Rows prefix, suffix (nodes), kind, id (the word's last prefix node), n: all pairs of all
    words. ``words``: word, n, prefixes, suffixes (nodes of the word and of its reverse)."""
    size = F.size("prefixes") - 1
    letters = F.filter(F.split("word", ""), lambda c: c != "")

    def pair(i, length, kind):
        return F.struct(F.col("prefixes")[i].alias("prefix"), F.col("suffixes")[length].alias("suffix"),
                        kind.cast("int").alias("kind"))

    def skipped(chars):
        return F.transform(F.sequence(F.lit(0), size - 1), lambda i: pair(
            i, size - 1 - i, F.when((i > 0) & (F.get(chars, i) == F.get(chars, i - 1)), SKIPPED_AGAIN)
            .otherwise(SKIPPED)))

    inserted = F.transform(F.sequence(F.lit(0), size), lambda i: pair(i, size - i, F.lit(INSERTED)))
    both = F.when(size > 0, F.concat(let(letters, skipped), inserted)).otherwise(inserted)
    return (words.select(F.col("prefixes")[size].alias("id"), "n", F.explode(both).alias("p"))
            .select("p.prefix", "p.suffix", "p.kind", "id", "n"))


def neighbours(pairs: DataFrame) -> DataFrame:
    """Rows id, n_near, best (struct of the negative count and the id of the near word with the
    largest count, then the first in order). ``pairs`` as of ``node_pairs``."""
    member = F.struct((-F.col("n")).alias("minus_n"), "id", "kind")
    groups = (pairs.groupBy("prefix", "suffix").agg(F.sort_array(F.collect_list(member)).alias("all"))
              .where(F.size("all") > 1)
              .select(F.filter("all", lambda m: m["kind"] > INSERTED).alias("skipped"),
                      F.filter("all", lambda m: m["kind"] == SKIPPED).alias("longer"),
                      F.filter("all", lambda m: m["kind"] == INSERTED).alias("shorter")))

    def near(id_, count, best):
        return F.struct(id_.alias("id"), count.cast("long").alias("n_near"), best.alias("best"))

    def word(m):
        return F.struct(m["minus_n"].alias("minus_n"), m["id"].alias("id"))

    def of_skipped(m, i):
        other = F.when(i == 0, F.get("skipped", F.lit(1))).otherwise(F.get("skipped", F.lit(0)))
        cut = F.when(m["kind"] == SKIPPED, F.get("shorter", F.lit(0)))
        found = F.array_min(F.array_compact(F.array(
            F.when(other.isNotNull(), word(other)), F.when(cut.isNotNull(), word(cut)))))
        return near(m["id"], F.size("skipped") - 1 + F.when(cut.isNotNull(), 1).otherwise(0), found)

    def of_shorter(m):
        return near(m["id"], F.size("longer"), F.when(F.size("longer") > 0, word(F.get("longer", F.lit(0)))))

    rows = F.concat(F.transform("skipped", of_skipped), F.transform("shorter", of_shorter))
    return (groups.select(F.explode(rows).alias("r")).where("r.n_near > 0").groupBy("r.id")
            .agg(F.sum("r.n_near").alias("n_near"), F.min("r.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """Rows id, root: the end of each chain of ``forms`` (id, form_id). Counts grow along a
    chain by the ratio, so it has no cycle and few steps; each round doubles the step."""
    now = stored(forms.select("id", F.col("form_id").alias("root")))
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("far"))
        new = stored(now.join(ahead, "root", "left").select(
            "id", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        if new.where("moved").isEmpty():
            return new.select("id", "root")
        now = new.select("id", "root")


def spelling_variants(words: DataFrame, variants: Variants = Variants(), *, word: str = "word",
                      n: str = "n") -> DataFrame:
    """Rows word, form, root, n, n_near, form_n for every distinct word: ``form`` is the near
    word of the largest count (ties: the first in code-point order) if that count is at least
    ``ratio`` times the word's, ``root`` the end of the chain of forms."""
    counted = stored(words.where(F.col(word).isNotNull())
                     .groupBy(F.col(word).alias("word")).agg(F.sum(F.col(n).cast("long")).alias("n")))
    backward = trie_nodes(counted.select(F.reverse("word").alias("word")))
    suffixes = backward.select(F.reverse("word").alias("word"), F.col("nodes").alias("suffixes"))
    prefixes = trie_nodes(counted).withColumnRenamed("nodes", "prefixes")
    nodes = stored(counted.join(prefixes, "word").join(suffixes, "word"))
    found = neighbours(node_pairs(nodes))
    better = -F.col("best.minus_n") >= F.lit(variants.ratio) * F.col("n")
    about = stored(nodes.select(F.element_at("prefixes", -1).alias("id"), "word", "n").join(found, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(better, F.col("best.id")).alias("form_id"), F.when(better, -F.col("best.minus_n")).alias("form_n")))
    ends = roots(about.where("form_id is not null").select("id", "form_id"))
    name = about.select("id", "word")
    forms = name.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    tops = name.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    return (about.join(ends.select("id", F.col("root").alias("root_id")), "id", "left")
            .join(forms, "form_id", "left").join(tops, "root_id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
