"""Spelling variants, SimHash components and periodic runs against brute force, on the
smallest tables, on random input and on odd rows."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ridgeline.llm import queries, runs, simhash, spelling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n long, word string, fp long, runs long, doc string"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 300
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "a b c d e f g"), (None, None),
       (7, LONG), (8, LONG + "omega"), (9, "x " * 5000), (10, "😀 naïve x ́y Öl ÖL"), (11, "y" * 20000)]
LOWER_AZ = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "en", 1, "clash", 2, 3, "clash") for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def odd_dir(odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    odd.write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def empty_dir(odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    odd.limit(0).write.parquet(f"{path}/documents.parquet")
    return path


def texts(spark, path):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]


def bag(rows):
    return collections.Counter(map(tuple, rows))


# ------------------------------------------------------------ spelling variants

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_variants(n):
    by_size = collections.defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    near = {w: [v for s in (-1, 0, 1) for v in by_size[len(w) + s] if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return out


def noisy_counts(docs):
    c = collections.Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER_AZ)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    return {w: k for w, k in c.items() if len(w) >= 5 and k >= 3}


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_op11_equals_brute_force(spark, odd_dir, empty_dir):
    for path in (SF, odd_dir, empty_dir):
        got = queries.op11_spelling_variants(spark, path).select(*COLUMNS).collect()
        assert bag(got) == bag(brute_variants(noisy_counts(texts(spark, path))))


def test_variants_of_dense_random_words(spark):
    rng = random.Random(3)
    n = {"".join(rng.choice("abé😀") for _ in range(rng.randint(0, 6))): rng.randint(1, 40) for _ in range(700)}
    words = spark.createDataFrame([*n.items(), (None, 5)], "word string, n int").repartition(7)
    got = spelling.spelling_variants(words).select(*COLUMNS).collect()
    assert bag(got) == bag(brute_variants(n))


def test_trie_nodes_are_one_per_prefix_over_partitions(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(400)} | {"a" * 3000})
    got = {r.word: r.nodes for r in spelling.trie_nodes(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    of = {}
    for w in words:
        assert len(got[w]) == len(w) + 1
        for i in range(len(w) + 1):
            assert of.setdefault(w[:i], got[w][i]) == got[w][i]
    assert len(set(of.values())) == len(of)
    assert [got[w][-1] for w in words] == sorted(got[w][-1] for w in words)


# ------------------------------------------------------------ SimHash

def brute_fingerprint(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER_AZ))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, distance=2):
    fps, root = sorted(set(fps)), {}
    for i, f in enumerate(fps):
        root[f] = f
        for g in fps[:i]:
            if (f ^ g).bit_count() <= distance:
                a, b = f, g
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
    def top(f):
        while root[f] != f:
            f = root[f]
        return f
    return {f: top(f) for f in fps}


def test_op12_equals_brute_force(spark, odd_dir, empty_dir):
    for path in (SF, odd_dir, empty_dir):
        docs = [(d, brute_fingerprint(t)) for d, t in texts(spark, path)]
        of = brute_components([f for _, f in docs])
        least = {}
        for d, f in docs:
            if d is not None:
                least[of[f]] = min(d, least.get(of[f], d))
        got = queries.op12_simhash(spark, path).select("doc_id", "fingerprint", "component_id").collect()
        assert bag(got) == bag((d, f"{f:016x}", least.get(of[f])) for d, f in docs)


@pytest.mark.parametrize("leaf", [4096, 6, 1])
def test_clustered_fingerprints_through_every_depth(spark, leaf):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = set(rng.integers(0, 1 << 63, 200, dtype=np.uint64).tolist())
    for c in centres:                      # clusters of near copies, some bits off a centre
        for _ in range(60):
            f = int(c)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                f ^= 1 << int(b)
            fps.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    method = simhash.SimHash(leaf=leaf, work=40)
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), method)
    got = {r.node: r["class"] for r in simhash.components(links).collect()}
    want = brute_components(fps)
    classes = collections.defaultdict(set)
    for (f,) in signed:
        classes[got.get(f, f)].add(f % (1 << 64))
    expected = collections.defaultdict(set)
    for f, c in want.items():
        expected[c].add(f)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


# ------------------------------------------------------------ periodic runs

def brute_runs(words, least=24, repeats=3):
    n, spans = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, repeats * q):
                spans.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted((s, length, q) for (s, length), q in spans.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_row(d, text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    places = queries.periodic_tenth({"doc_id": d}, len(w))
    w = w if places is None else [w[i] for i in places]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (d, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op13_equals_brute_force(spark, odd_dir, empty_dir):
    for path in (SF, odd_dir, empty_dir):
        got = queries.op13_periodic_runs(spark, path).collect()
        assert bag(got) == bag(brute_row(d, t) for d, t in texts(spark, path))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_periodic_texts(seed):
    rng = random.Random(seed)
    rule = runs.RunRule(least_length=rng.choice([3, 4, 8, 24]), least_repeats=rng.choice([3, 4]))
    made = []
    for _ in range(30):
        w = []
        while len(w) < rng.choice([0, 40, 150]):
            phrase = [rng.choice("ab") for _ in range(rng.randint(1, 7))]
            w += (phrase * rng.randint(1, 9))[:rng.randint(1, 60)]
        made.append(w)
    made.append(["a"] * 400)
    flat = np.array([ord(x) for w in made for x in w], np.int64)
    got = runs.find_runs(flat, np.cumsum([len(w) for w in made]), rule)
    for i, w in enumerate(made):
        assert got.get(i, []) == brute_runs(w, rule.least_length, rule.least_repeats)


def test_a_run_rule_needs_three_repeats():
    with pytest.raises(ValueError):
        runs.RunRule(least_repeats=2)


def test_odd_rows_keep_named_columns_only(spark, odd):
    got = runs.detect_runs(odd, keep=("doc_id", "n", "doc"))
    assert got.columns == ["doc_id", "n", "doc", "n_words", "runs", "collapsed"] and got.count() == len(ODD)
    named = odd.select(F.col("doc_id").alias("fp"), F.col("text").alias("doc"))
    assert simhash.simhash_duplicates(named.withColumnsRenamed({"fp": "id", "doc": "t"}), key="id", text="t").count() == len(ODD)
