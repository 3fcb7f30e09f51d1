"""Matched texts against the documents themselves."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as E
from ridgeline.plans import text_queries

SF = "/root/testdata/sf0.001"


def test_matched_texts_are_the_documents_of_the_title(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    names = {r["p_partkey"]: r["p_name"] for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    want = {}
    for i in text_queries.items(spark, SF).collect():
        found = [docs[k] for k in sorted(docs) if names.get(k) == i["name"]]
        texts = [d["text"] for d in found if d["text"] is not None]
        if texts and any(d["lang"] is not None for d in found):
            want.setdefault(i["track_id"], []).append((i["name"], i["artists"], " ".join(texts)))
    got = {r["track_id"]: r["lyrics"] for r in E.queries()["text_match_lyrics"](spark, SF).collect()}
    assert got and got == {k: " ".join(t for *_, t in sorted(v)) for k, v in want.items()}


def test_few_large_texts_are_not_held_before_a_write(spark, tmp_out):
    E.queries()["text_match_lyrics"](spark, SF)
    long = spark.range(40, numPartitions=1).select(F.repeat(F.sha2(F.col("id").cast("string"), 256), 3000).alias("lyrics"))
    long.write.options(**{"compression": "none", "parquet.block.size": str(1 << 20)}).mode("overwrite").parquet(tmp_out)
    files = glob.glob(f"{tmp_out}/*.parquet")
    assert len(files) == 1 and pq.ParquetFile(files[0]).num_row_groups > 3
