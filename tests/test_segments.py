"""Segmented texts joined again equal the assembled text, hot keys included."""

import random

import pytest

from ridgeline.operators import enrich, segments

SCHEMA = "k string, o int, t string, role string, segment string"


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(9)
    rows = [("hot", i, "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 30))), "u", "clash") for i in range(600)]
    rows += [(f"k{rng.randint(0, 80)}", i, "x" * rng.choice([0, 1, 5, 300]), rng.choice(["u", "system", None]), "clash")
             for i in range(500)]
    rows += [(None, 1, "no key", "u", ""), (None, 2, "at all", "u", ""), ("null", 1, None, "u", ""), ("empty", 1, "", "u", ""),
             ("twoempty", 1, "", "u", ""), ("twoempty", 2, "", "u", ""), ("long", 1, "y" * 20000, "u", "")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(6).cache()


@pytest.mark.parametrize(("size", "partitions", "sep", "exclude"),
                         [(64, 7, " ", None), (1000, 3, ", ", ("role", ["system"])), (1, 5, "", None)])
def test_segments_joined_equal_the_text(parts, size, partitions, sep, exclude):
    got = segments.assemble_segments(parts, "k", "t", ["o"], size=size, sep=sep, exclude=exclude, partitions=partitions).collect()
    want = enrich.assemble_text(parts.where("t is not null"), "k", "t", ["o"], sep=sep, exclude=exclude).collect()
    texts = {}
    for r in sorted(got, key=lambda r: r.segment):
        assert len(r.t) <= size and r.segment == (len(texts.get(r.k, "")) + size - 1) // size
        texts[r.k] = texts.get(r.k, "") + r.t
    assert texts == {r.k: r.t for r in want}
    assert len(got) == len({(r.k, r.segment) for r in got})
    full = {(r.k, r.segment) for r in got if len(r.t) < size}
    assert len({k for k, _ in full}) == len(full)          # only a key's last segment is short


def test_a_hot_key_is_many_tasks(parts):
    before = segments._places
    placed = []

    def spy(ends):
        placed.append(ends)
        return before_carried(ends)

    before_carried, segments._carried = segments._carried, spy
    try:
        segments.assemble_segments(parts, "k", "t", ["o"], size=64, partitions=8).count()
    finally:
        segments._carried = before_carried
    assert before is segments._places
    assert sum(e["first"] == "hot" or e["last"] == "hot" for e in placed[0]) >= 3


def test_no_parts_and_bad_size(parts):
    assert segments.assemble_segments(parts.where("false"), "k", "t", ["o"], size=10).count() == 0
    with pytest.raises(ValueError):
        segments.assemble_segments(parts, "k", "t", ["o"], size=0)
