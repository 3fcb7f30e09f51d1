"""text_match_lyrics where many tracks share a title with a long text."""

import datetime
import glob
import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ridgeline.operators import enrich

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TRACKS, CHARS = 300, 3 << 20
RUN = """
import sys
import __spark_entry__ as E
from ridgeline.session import get_session
d, out = sys.argv[1:]
spark = get_session("local[1]", 2, extra={"spark.driver.memory": "600m", "spark.local.dir": f"{out}/local",
                                          "spark.sql.warehouse.dir": f"{out}/warehouse"})
E.queries()["text_match_lyrics"](spark, d).write.parquet(f"{out}/rows")
"""


def _tables(d: str) -> None:
    day = datetime.date(1997, 5, 5)
    parts, lines = range(TRACKS), [(k, n) for k in range(TRACKS) for n in (1, 2)]
    tables = {
        "nation": {"n_nationkey": [0], "n_name": ["N"]},
        "customer": {"c_custkey": [0], "c_nationkey": [0]},
        "orders": {"o_orderkey": [0], "o_custkey": [0], "o_orderdate": [day]},
        "lineitem": {"l_orderkey": [0] * len(lines), "l_partkey": [k for k, _ in lines],
                     "l_linenumber": [n for _, n in lines], "l_quantity": [5.0] * len(lines)},
        # one title by many artists: all of them are first in the country and year
        "part": {"p_partkey": list(parts), "p_name": ["T"] * TRACKS, "p_brand": [f"B{k}" for k in parts],
                 "p_type": ["K"] * TRACKS, "p_size": [1] * TRACKS},
        "documents": {"doc_id": [2, 1, 5], "text": ["b" * CHARS, "a", None], "lang": ["en", None, "fr"]},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{d}/{name}.parquet")


def test_copies_of_a_long_text_are_not_held_together(tmp_out):
    d, out = f"{tmp_out}/tables", f"{tmp_out}/out"
    os.makedirs(d)
    os.makedirs(out)
    _tables(d)
    ran = subprocess.run([sys.executable, "-c", RUN, d, out], cwd=REPO, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]
    files = glob.glob(f"{out}/rows/*.parquet")
    tracks = []
    for f in files:
        for b in pq.ParquetFile(f).iter_batches(batch_size=8):
            tracks += b.column("track_id").to_pylist()
            assert set(b.column("language").to_pylist()) == {"fr"}
            for text in b.column("lyrics"):
                assert text.as_buffer().to_pybytes() == b"a " + b"b" * CHARS
    assert sorted(tracks) == list(range(TRACKS))
    # a text that all tracks of a file have is written once
    assert sum(os.path.getsize(f) for f in files) < 4 * CHARS


def test_spread_matches_is_the_inner_join(spark):
    items = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, "b", None), (3, None, "y"), (None, "a", "z"), (4, "c", "x")],
                                  "i int, k string, v string")
    corpus = spark.createDataFrame([("a", "ta", None), ("b", None, 2), ("d", "td", 3), (None, "tn", 4)], "key string, t string, n int")
    got = enrich.spread_matches(items, corpus, ("k", "key"), ["i", "v"])
    want = items.join(corpus, items.k == corpus.key).select("i", "v", "t", "n")
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got) == rows(want) and len(rows(got)) == 4


def test_assembled_text_is_listagg(spark):
    rows = [(1, 2, "b", "x"), (1, None, "n", "x"), (1, 2, "a", None), (1, 3, None, "y"), (1, 1, "", "x"), (1, 2, "a", "z"),
            (2, 1, None, "x"), (None, 2, "é", "x"), (None, 1, "~", "x"), (3, 1, "", "x")]
    df = spark.createDataFrame(rows, "k int, o int, t string, w string")
    for order in (["o", "t"], ["t"], ["t", "o"], ["w", "o", "t"]):
        got = enrich.assemble_text(df, "k", "t", order, keep_max=["w"], sep=", ")
        want = df.groupBy("k").agg(F.expr(f"listagg(t, ', ') WITHIN GROUP (ORDER BY {', '.join(order)})").alias("t"),
                                   F.max("w").alias("w"), F.count("t").alias("n_parts"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), order
