"""The learnt polarity lexicon and the n-gram language labels."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import ngrams, polarity, sentiment

SCHEMA = "doc long, chunk_no int, lang string, chunk string, word string, polarity long"


def brute_lexicon(rows, positive, negative, s):
    """The docstring of operators.polarity, in plain Python."""
    half = lambda a, b: (abs(a) * 2 + b) // (2 * b) * (1 if a >= 0 else -1)
    where = collections.defaultdict(set)
    for doc, no, lang, chunk in rows:
        at = int(hashlib.md5(f"{doc}:{no}".encode()).hexdigest()[:15], 16)
        for w in {w for w in re.split(r"[\W\d_]+", (chunk or "").lower()) if w}:
            where[lang, w].add(at)
    n = {k: len(v) for k, v in where.items()}
    held = {k: sorted(v)[:s.sample] for k, v in where.items() if n[k] >= s.least_chunks}
    seed = {k: 1 if k[1] in positive else -1 if k[1] in negative else 0 for k in held}
    langs = {k[0] for k in held if seed[k]}
    held = {k: v for k, v in held.items() if k[0] in langs}
    p = {k: seed[k] * polarity.UNIT for k in held}
    for _ in range(s.rounds):
        by = collections.defaultdict(list)
        for k, v in held.items():
            for at in v:
                by[k[0], at].append(p[k])
        c = {k: half(sum(v), len(v)) for k, v in by.items()}
        total = {k: sum(c[k[0], at] for at in v) for k, v in held.items()}
        out = {}
        for lang in langs:
            ks = [k for k in held if k[0] == lang]
            middle = half(sum(total[k] for k in ks), sum(len(held[k]) for k in ks))
            raw = {k: half(total[k] - middle * len(held[k]), len(held[k]) + s.shrink) for k in ks}
            free = [k for k in ks if not seed[k]]
            width = half(sum(abs(raw[k]) for k in free), len(free)) if free else 0
            for k in ks:
                v = half(raw[k] * s.spread, width) if width else 0
                out[k] = seed[k] * polarity.UNIT or max(-polarity.UNIT, min(polarity.UNIT, v))
        p = out
    lexicon = set()
    for lang in langs:
        mass = collections.Counter()
        for k in held:
            if k[0] == lang and not seed[k]:
                mass[p[k] // s.bucket] += n[k]
        all_ = sum(mass.values())
        for k in held:
            if k[0] == lang:
                b = p[k] // s.bucket
                low = sum(v for x, v in mass.items() if x <= b) * polarity.UNIT <= s.tail * all_
                high = sum(v for x, v in mass.items() if x >= b) * polarity.UNIT <= s.tail * all_
                if seed[k] or (low and p[k] < 0) or (high and p[k] > 0):
                    lexicon.add((*k, p[k]))
    return lexicon


@pytest.fixture(scope="module")
def chunks(spark):
    rng = random.Random(11)
    good, bad, plain = (["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)] for _ in range(3))
    rows = []
    for i in range(400):
        side, seed = ((good, "joy"), (bad, "pain"))[i % 2]
        words = rng.choices(side, k=6) + rng.choices(plain, k=8) + ([seed] if rng.random() < 0.4 else [])
        rng.shuffle(words)
        rows.append((i, i % 3, ("en", "xx")[i % 10 == 0], " ".join(words).title()))
    rows += [(900, 0, "zz", "no seed here " * 3), (901, 0, "en", None), (902, 0, "en", ""), (903, 0, None, "joy joy"),
             (904, 0, "en", "joy " + "aaaaa " * 5000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    return df, rows, good, bad


@pytest.mark.parametrize("spread", [polarity.Spread(tail=200_000), polarity.Spread(sample=9, rounds=3, tail=400_000, shrink=1)])
def test_lexicon_equals_brute_force_and_finds_the_sides(chunks, spread):
    df, rows, good, bad = chunks
    got = polarity.learn_polarity(df, ["doc", "chunk_no"], ["joy"], ["pain"], spread=spread).collect()
    assert {tuple(r) for r in got} == brute_lexicon(rows, ["joy"], ["pain"], spread)
    side = {r.word: r.polarity > 0 for r in got if r.lang == "en"}
    right = [w for w, up in side.items() if (w in good or w == "joy") == up]
    assert len(side) > 20 and len(right) > (0.9 if spread.sample > 9 else 0.7) * len(side)
    assert not [r for r in got if r.lang == "zz"]


def test_chunks_without_hits_stay(spark, chunks):
    df, rows, *_ = chunks
    lexicon = spark.createDataFrame([("en", "joy", 5), ("en", "aaaaa", -5)], "lang string, word string, polarity long")
    got = {(r.doc, r.chunk_no): r for r in sentiment.score_chunks_polarity(df, ["doc", "chunk_no"], lexicon).collect()}
    assert len(got) == len(rows)
    for doc, no, lang, chunk in rows:
        words = (chunk or "").lower().split() if lang == "en" else []
        r = got[doc, no]
        assert (r.pos_hits, r.neg_hits) == (words.count("joy"), words.count("aaaaa"))
    assert got[904, 0].stars == "1 star" and got[900, 0].stars == "3 stars" and got[903, 0].pos_hits == 0


def test_no_chunks_give_no_lexicon(chunks):
    assert polarity.learn_polarity(chunks[0].where("false"), ["doc", "chunk_no"], ["joy"], ["pain"]).count() == 0


def test_sketch_of_a_frequent_word_moves_few_chunks(spark):
    rows = [(i, 0, "en", f"often word{i % 1500} word{i % 1500} {'some ' * (i % 3 == 0)}") for i in range(6000)] + [
        (i, 0, "en", "often twice") for i in range(40)] + [(9000, 0, None, "often")]
    df = spark.createDataFrame(rows, "doc long, chunk_no int, lang string, chunk string").repartition(3)
    s = polarity.Spread(sample=5)
    words = df.select("lang", polarity.chunk_hash(["doc", "chunk_no"]).alias("at"),
                      F.explode(F.array_distinct(polarity.letter_words(F.col("chunk")))).alias("word"))
    bound = {r.word: r.bound for r in polarity.frequent_words(words.where("lang = 'en'"), s).collect()}
    assert {"often", "some"} <= set(bound)
    at = lambda i: int(hashlib.md5(f"{i}:0".encode()).hexdigest()[:15], 16)
    assert 5 <= sum(at(i) < bound["often"] for i in range(6000)) < 100
    got = {r.word: r for r in polarity.word_sketches(df, ["doc", "chunk_no"], "lang", "chunk", s).collect()}
    want = sorted([at(i) for i in range(6000)] + [at(i) for i in range(40)])[:5]
    assert set(got["often"].chunks) == set(want) and got["often"].n_chunks == 6040
    assert set(got["some"].chunks) == set(sorted(at(i) for i in range(0, 6000, 3))[:5]) and got["some"].n_chunks == 2000
    assert set(got["twice"].chunks) == set(sorted(at(i) for i in range(40))[:5]) and got["twice"].n_chunks == 40


# ------------------------------------------------------------------ n-grams

def test_remembered_grams_are_shared():
    first, second = ngrams.grams_of("wording", (1, 2, 3)), ngrams.grams_of("wordless", (1, 2, 3))
    assert first[1] == second[1] == "o" and first[first.index("wor")] is second[second.index("wor")]


def brute_grams(text, sizes):
    out = collections.Counter()
    for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
        p = f"_{w}_"
        for n in sizes:
            for i in range(len(p) - n + 1):
                if p[i:i + n] != "_":
                    out[p[i:i + n]] += 1
    return out


TEXTS = [("aa", "tak to je velmi dobry den a noc " * 6), ("aa", "dobry vecer to je den"), ("bb", "goed dag het is een zeer mooie nacht " * 5),
         ("bb", "mooie avond het is dag"), (None, "to je dobry den a velmi tak"), ("und", "het is een goed mooie dag"),
         ("aa", None), ("bb", ""), (None, "x"), ("cc", "ж" * 30000 + " это очень добрый день"), (None, "очень добрый вечер и день это жж")]


@pytest.mark.parametrize("conf", [ngrams.Ngrams(), ngrams.Ngrams(sizes=(1, 2, 3, 4, 5), top=40, margin=0),
                                  ngrams.Ngrams(languages=2, least_grams=3)])
def test_ngram_labels_equal_brute_force(spark, conf):
    df = spark.createDataFrame([(i, t, g, "clash") for i, (g, t) in enumerate(TEXTS)],
                               "id int, text string, lang string, row string").repartition(3)
    counts = collections.defaultdict(collections.Counter)
    for lang, text in TEXTS:
        if lang not in (None, "und"):
            counts[lang] += brute_grams(text, conf.sizes)
    first = lambda c: sorted(c, key=lambda g: (-c[g], g))[:conf.top]
    mass = {k: sum(c[g] for g in first(c)) for k, c in counts.items() if c}
    langs = sorted(mass, key=lambda k: (-mass[k], k))[:conf.languages]
    profiles = {k: {g: i for i, g in enumerate(first(counts[k]))} for k in langs}
    assert ngrams.collect_profiles(ngrams.learn_profiles(df, "text", "lang", conf), conf) == profiles
    got = {r.id: r for r in ngrams.label_language(df, "text", "lang", conf, keep=("id", "row")).collect()}
    assert len(got) == len(TEXTS) and got[0].row == "clash"
    for i, (_, text) in enumerate(TEXTS):
        c = brute_grams(text, conf.sizes)
        sums = sorted((sum(abs(p[g] - j) if g in p else conf.top for j, g in enumerate(first(c))), k) for k, p in profiles.items())
        if sum(c.values()) < conf.least_grams:
            want = ("und", None, None)
        else:
            sure = (sums[1][0] - sums[0][0]) * 1000 >= conf.margin * sums[0][0]
            want = (sums[0][1] if sure else "und", sums[0][0], sums[1][0])
        assert (got[i].detected, got[i].best_distance, got[i].second_distance) == want
    if conf.languages > 2:
        assert got[4].detected == "aa" and got[5].detected == "bb"


def test_no_profile_labels_nothing(spark):
    df = spark.createDataFrame([(1, "to je dobry den a velmi tak", None)], "id int, text string, lang string")
    assert ngrams.label_language(df, "text", "lang", keep=("id",)).first().detected == "und"
    assert ngrams.label_language(df.where(F.lit(False)), "text", "lang", keep=("id",)).count() == 0


def test_labels_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, "to je", "aa")], "id int, text string, lang string")
    out = ngrams.label_by_profiles(df, "text", {"aa": {"t": 0}}, keep=("id",))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
