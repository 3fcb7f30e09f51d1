"""Readers, writers and the incremental mood job, round-tripped through a
fresh scratch folder."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.sources import io
from ridgeline.streaming.moods import moods_batch, start_mood_stream


def test_read_chart_permissive(spark, tmp_out):
    p = os.path.join(tmp_out, "chart.csv")
    with open(p, "w") as f:
        f.write("date,country,position,streams,track_id,artists,artist_genres,duration,explicit,name\n")
        f.write("2019/01/04,gb,1,3000000000,t1,\"['A']\",\"['pop']\",200,true,Song\n")
        f.write("2019/01/11,gb,x,10,t1,\"['A']\",[],200,false,Song\n")
    rows = io.read_chart(spark, p).orderBy("date").collect()
    assert rows[0]["streams"] == 3000000000 and rows[0]["explicit"] is True
    assert rows[1]["position"] is None and rows[1]["artist_genres"] == "[]"


def test_read_entity_files_codes_from_names(spark, tmp_out):
    d = os.path.join(tmp_out, "inflation")
    os.makedirs(d)
    for code, name, vals in (("gb", "United Kingdom", [("2019*", 1.5), ("2020", 0.9)]),
                             ("jp", "Japan", [("2019", 0.5)])):
        with open(os.path.join(d, f"{code}_{name}.csv"), "w") as f:
            for y, v in vals:
                f.write(f"{y},{v}\n")
    schema = T.StructType([T.StructField("year_string", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    df = io.read_entity_files(spark, d, schema, header=False)
    got = sorted((r["country_code"], r["country"], r["year_string"]) for r in df.collect())
    assert got == [("gb", "United Kingdom", "2019*"), ("gb", "United Kingdom", "2020"),
                   ("jp", "Japan", "2019")]


def test_read_text_corpus_multiline(spark, tmp_out):
    p = os.path.join(tmp_out, "corpus.csv")
    with open(p, "w") as f:
        f.write("title,tag,artist,year,views,features,lyrics,id,language\n")
        f.write('Song,pop,A,2019,10,{},"line one\nline ""two""",1,en\n')
    r = io.read_text_corpus(spark, p).collect()
    assert len(r) == 1 and r[0]["lyrics"] == 'line one\nline "two"' and r[0]["id"] == 1


def test_publish_partitioned_is_rerunnable(spark, tmp_out):
    out = os.path.join(tmp_out, "facts")
    df = spark.createDataFrame([(2019, "gb", 1.0), (2019, "jp", 2.0)],
                               "year int, country_code string, v double")
    io.publish_partitioned(df, out, ["country_code"], cols=["year", "v", "country_code"])
    io.publish_partitioned(df.filter("country_code = 'gb'"), out, ["country_code"], replace_only=True)
    back = io.read_partitioned(spark, out)
    assert back.columns[-1] == "country_code"
    assert sorted((r["country_code"], r["v"]) for r in back.collect()) == [("gb", 1.0), ("jp", 2.0)]
    sub = io.read_partitioned(spark, os.path.join(out, "country_code=gb"), base_path=out)
    assert [r["country_code"] for r in sub.collect()] == ["gb"]
    # by default the whole output is replaced: vanished groups do not stay
    io.publish_partitioned(df.filter("country_code = 'gb'"), out, ["country_code"])
    assert [r["country_code"] for r in io.read_partitioned(spark, out).collect()] == ["gb"]


def test_publish_partitioned_bounds_files(spark, tmp_out):
    import glob

    out = os.path.join(tmp_out, "many")
    df = spark.range(0, 1000, 1, 16).select("id", (F.col("id") % 5).alias("k"))
    io.publish_partitioned(df, out, ["k"])
    assert len(glob.glob(f"{out}/k=*/part-*")) == 5


def test_single_and_sorted_csv(spark, tmp_out):
    df = spark.range(20).select(F.col("id").cast("int").alias("k"))
    one = os.path.join(tmp_out, "one")
    io.export_single_csv(df, one)
    assert len([f for f in os.listdir(one) if f.endswith(".csv")]) == 1
    many = os.path.join(tmp_out, "many")
    io.export_sorted_csv(df, many, ["k"], partitions=3)
    back = [r["k"] for r in io.read_csv(spark, many, T.StructType(
        [T.StructField("k", T.IntegerType())])).collect()]
    assert sorted(back) == list(range(20))


def test_publish_text_and_json_reader(spark, tmp_out):
    df = spark.createDataFrame([("t1", "hello", "en"), ("t2", "salut", "fr")],
                               "track_id string, lyrics string, language string")
    j, p = os.path.join(tmp_out, "j"), os.path.join(tmp_out, "p")
    io.publish_text(df, j, p)
    io.publish_text(df, j, p)
    assert io.read_json(spark, j).count() == 2
    assert io.read_partitioned(spark, p).count() == 2


def test_mood_stream_matches_batch(spark, tmp_out):
    src = os.path.join(tmp_out, "incoming")
    os.makedirs(src)
    recs = [{"track_id": f"t{i}", "lyrics": ("good " * (i % 3) + "bad " * (i % 2)) * 3,
             "language": "en"} for i in range(6)]
    for k in range(2):
        with open(os.path.join(src, f"part{k}.json"), "w") as f:
            for r in recs[k * 3:(k + 1) * 3]:
                f.write(json.dumps(r) + "\n")
    sink = os.path.join(tmp_out, "moods")
    routes = {"en": "stars"}
    q = start_mood_stream(spark, src, sink, routes, max_files_per_trigger=1)
    q.awaitTermination(120)
    got = sorted((r["track_id"], r["mood"]) for r in io.read_partitioned(spark, sink).collect())
    batch = moods_batch(io.read_json(spark, src), routes)
    assert got == sorted((r["track_id"], r["mood"]) for r in batch.collect())
    # t0 has empty text: no chunk, hence no mood
    assert len(got) == 5 and "t0" not in dict(got)
    # the per-language route table gives the same moods for English
    table_moods = moods_batch(io.read_json(spark, src))
    assert sorted((r["track_id"], r["mood"]) for r in table_moods.collect()) == got


def test_bucketed_tables_join_without_shuffle(spark, tmp_out):
    from pyspark.sql import functions as F

    li = spark.range(2000).select((F.col("id") % 300).alias("k"), F.col("id").alias("v"))
    od = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    io.write_bucketed(li, "t_li_bucketed", "k", 4)
    io.write_bucketed(od, "t_od_bucketed", "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("t_li_bucketed").join(spark.table("t_od_bucketed"), "k")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.sql("DROP TABLE IF EXISTS t_li_bucketed")
        spark.sql("DROP TABLE IF EXISTS t_od_bucketed")


def test_queue_stream_matches_batch(spark, tmp_out):
    from pyspark.sql import functions as F

    from ridgeline.operators import batching
    from ridgeline.streaming.queue import enrich_queue, start_queue_stream

    items = spark.createDataFrame([(f"t{i}", f"n{i}", "a" if i % 4 else None) for i in range(120)],
                                  "track_id string, name string, new_artist string")
    queue = batching.assign_batches(items, 50, ["track_id"])
    qdir = os.path.join(tmp_out, "queue")
    io.publish_partitioned(queue, qdir, ["batch_id"], fmt="csv", header="true")
    texts = spark.createDataFrame([(f"t{i}", f"text {i}", "en") for i in range(0, 120, 3)],
                                  "track_id string, lyrics string, language string")
    sink = os.path.join(tmp_out, "enriched")
    q = start_queue_stream(spark, qdir, texts, sink,
                           max_files_per_trigger=1)
    q.awaitTermination(180)
    got = io.read_partitioned(spark, sink)
    assert got.count() == 120
    want = enrich_queue(queue.select("track_id", "name", "new_artist", "row_index", "batch_id"),
                        texts)
    key = ["track_id", "lyrics", "language"]
    assert sorted(tuple(r) for r in got.select(*key).collect()) == \
        sorted(tuple(r) for r in want.select(*key).collect())
    # an item with a NULL artist gets no text even if one exists (t0, t12, ...)
    assert got.filter((F.col("track_id") == "t0")).first()["lyrics"] is None
    assert got.filter((F.col("track_id") == "t3")).first()["lyrics"] == "text 3"
