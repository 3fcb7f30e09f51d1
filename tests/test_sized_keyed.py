"""Publishing by size, the keyed sink, exact quantiles and name proposals."""

import collections
import glob
import os
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ridgeline.operators import names, quantiles
from ridgeline.sources import io, keyed, sized
from ridgeline.streaming.moods import start_mood_stream


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_publishing_deals_a_hot_group_and_packs_small_ones(spark, tmp_out):
    rng = random.Random(1)
    rows = [(i, "en" if i % 2 else f"l{i % 60}", "x" * rng.randint(0, 400)) for i in range(6000)]
    rows += [(7000, None, "no language"), (7001, "en", None), (7002, "xx", "")] + [(8000, "rep", "same text")] * 50
    df = spark.createDataFrame(rows, "id long, language string, lyrics string").repartition(3)
    size = sum(17 + len(r[1] or "") + len(r[2] or "") - 8 for r in rows)
    limit = 40_000
    j, p = os.path.join(tmp_out, "j"), os.path.join(tmp_out, "p")
    for _ in range(2):          # a second run replaces the first
        sized.publish_sized(df, {"json": j, "parquet": p}, ["language"], task_bytes=limit)
    back = io.read_partitioned(spark, p).select("id", "language", "lyrics")
    assert bag(back) == bag(df) == bag(io.read_json(spark, j, df.schema))
    files = glob.glob(f"{p}/**/*.parquet", recursive=True)
    tasks = collections.Counter()
    for f in files:
        t = pq.ParquetFile(f).read()
        tasks[os.path.basename(f).split("-")[1]] += sum(
            9 + len(str(x["lyrics"] or "")) + 2 for x in t.to_pylist())
    assert len(tasks) >= size // limit and max(tasks.values()) <= 1.4 * limit
    assert len(files) <= 63 + len(tasks) + 1
    assert len(glob.glob(f"{p}/language=en/*.parquet")) >= 6


def test_publish_text_is_one_computation(spark, tmp_out):
    counter = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            counter.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(str(i), "t", "en") for i in range(100)], "track_id string, lyrics string, language string")
    io.publish_text(df.mapInArrow(seen, df.schema), os.path.join(tmp_out, "j"), os.path.join(tmp_out, "p"))
    assert counter.value == 100 and io.read_partitioned(spark, os.path.join(tmp_out, "p")).count() == 100


def test_merging_replaces_rows_and_only_touched_buckets(spark, tmp_out):
    path = os.path.join(tmp_out, "sink")
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int, w string")
    first = [(f"k{i}", i, "a") for i in range(200)] + [(None, -1, "a")]
    keyed.merge_by_key(frame(first), path, "k", buckets=16)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    second = [("k3", 1000, "b"), ("k3", 999, "b"), ("new", 5, "b"), (None, -2, "b"), (None, -3, "b")]
    for _ in range(2):          # a replay changes nothing
        keyed.merge_by_key(frame(second), path, "k", latest=["v"], buckets=16)
    want = {k: (k, v, w) for k, v, w in first} | {"k3": ("k3", 1000, "b"), "new": ("new", 5, "b"), None: (None, -2, "b")}
    assert bag(keyed.read_keyed(spark, path).select("k", "v", "w")) == collections.Counter(want.values())
    kept = [f for f, t in before.items() if os.path.exists(f) and os.path.getmtime(f) == t]
    assert len(before) - 3 <= len(kept) < len(before)
    keyed.merge_by_key(frame([]), path, "k", buckets=16)
    assert keyed.read_keyed(spark, path).count() == len(want)


def test_a_merge_cut_off_is_finished(spark, tmp_out):
    path = os.path.join(tmp_out, "sink")
    df = spark.createDataFrame([(i, "a") for i in range(50)], "k int, v string")
    keyed.merge_by_key(df, path, "k", buckets=4)
    put, keyed._put = keyed._put, lambda *a: None
    try:                        # the driver is lost before the second step ...
        keyed.merge_by_key(df.withColumn("v", F.lit("b")), path, "k", buckets=4)
    finally:
        keyed._put = put
    gone = glob.glob(f"{path}/bucket=1/*")       # ... or within it
    for f in gone:
        os.replace(f, os.path.join(tmp_out, os.path.basename(f) + ".gone"))
    keyed.recover(spark, path)
    assert bag(keyed.read_keyed(spark, path).select("k", "v")) == collections.Counter((i, "b") for i in range(50))


def test_mood_stream_without_its_checkpoint_has_one_row_per_document(spark, tmp_out):
    src, sink = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "moods")
    write = lambda name, rows: spark.createDataFrame(rows, "track_id string, lyrics string, language string").coalesce(
        1).write.mode("append").json(os.path.join(src, name))
    write(".", [(f"t{i}", "good " * 3, "en") for i in range(5)])
    for n in range(2):
        q = start_mood_stream(spark, src, sink, {"en": "stars"}, checkpoint=os.path.join(tmp_out, f"lost{n}"))
        q.awaitTermination(120)
    write(".", [("t1", "bad bad bad", "en"), ("t9", "bad", "en")])
    start_mood_stream(spark, src, sink, {"en": "stars"}, checkpoint=os.path.join(tmp_out, "lost1")).awaitTermination(120)
    got = {r.track_id: r.mood for r in keyed.read_keyed(spark, sink).collect()}
    assert got == {**{f"t{i}": "positive" for i in range(5)}, "t1": "negative", "t9": "negative"}
    assert keyed.read_keyed(spark, sink).count() == len(got)


# ------------------------------------------------------------------ quantiles

@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    rows = [("wide", float(x)) for x in rng.normal(size=3000) * 10.0 ** rng.integers(-12, 12, 3000)]
    rows += [("ties", float(x)) for x in np.where(rng.random(2500) < 0.6, 7.0, rng.integers(0, 20, 2500))]
    rows += [("one", 4.5), ("two", 1.0), ("two", 2.0), (None, 3.0), (None, 9.0), (None, 5.0), ("same", 2.0), ("same", 2.0),
             ("nulls", None), ("wide", None)]
    rows += [("few", float(x)) for x in range(9)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5).cache(), rows


def groups(rows):
    out = collections.defaultdict(list)
    for g, v in rows:
        if v is not None:
            out[g].append(v)
    return out


@pytest.mark.parametrize("few", [4096, 50])
def test_quantiles_equal_numpy(numbers, few):
    df, rows = numbers
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.g, r.prob): r.value for r in quantiles.exact_quantiles(df, "v", probs, group=["g"], few=few).collect()}
    want = {(g, p): np.quantile(v, p) for g, v in groups(rows).items() for p in probs}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-12)
    assert quantiles.exact_quantiles(df.where("false"), "v", probs).count() == 0


def fivenum(v):
    x, n = sorted(v), len(v)
    n4 = (n + 3) // 2 / 2
    at = lambda d: 0.5 * (x[int(np.floor(d)) - 1] + x[int(np.ceil(d)) - 1])
    return at(n4), at((n + 1) / 2), at(n + 1 - n4)


@pytest.mark.parametrize("few", [4096, 60])
def test_hinges_equal_fivenum(numbers, few):
    df, rows = numbers
    got = {r.g: r for r in quantiles.box_hinges(df, "v", ["g"], digits=None, few=few).collect()}
    for g, v in groups(rows).items():
        q1, med, q3 = fivenum(v)
        inside = [x for x in v if q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1)]
        r = got.pop(g)
        assert (r.n, r.q1, r.median, r.q3, r.lower, r.upper, r.n_outliers) == (
            len(v), q1, med, q3, min(inside), max(inside), len(v) - len(inside))
    assert not got


# ------------------------------------------------------------------ names

def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_name_proposals_equal_brute_force(spark, distance):
    rng = random.Random(5)
    known = ["".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 7))) for _ in range(120)]
    lost = ["".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 8))) for _ in range(120)] + known[:5]
    k = spark.createDataFrame([(w, 1) for w in known] + [(None, 1)], "name string, proposal int").repartition(3)
    u = spark.createDataFrame([(w, 1) for w in lost] + [(None, 1), (lost[0], 2)], "name string, distance int")
    got = bag(names.reconcile(k, u, "name", distance=distance))
    want = collections.Counter()
    for w in set(lost) - set(known):
        best = min(((levenshtein(w, x), x) for x in known), default=None)
        want[(w, best[1], best[0]) if best[0] <= distance else (w, None, None)] += 1
    want[None, None, None] += 1
    assert got == want


def test_quantiles_do_not_deal_values_by_group(spark, monkeypatch):
    df = spark.createDataFrame([("ab"[i % 2], float(i)) for i in range(2000)], "g string, v double")
    seen = []
    same = quantiles._same

    def spy(a, b, keys):
        if a.columns == ["g", "value"]:
            seen.append(a.join(b, same(a, b, keys))._jdf.queryExecution().sparkPlan().toString())
        return same(a, b, keys)

    monkeypatch.setattr(quantiles, "_same", spy)
    got = {(r.g, r.prob): r.value for r in quantiles.exact_quantiles(df, "v", [0.5, 1.0], group=["g"], few=16).collect()}
    assert got == {("a", 0.5): 999.0, ("a", 1.0): 1998.0, ("b", 0.5): 1000.0, ("b", 1.0): 1999.0}
    assert seen and all("BroadcastHashJoin" in x and "SortMergeJoin" not in x for x in seen)
