"""What stays in an executor's memory while rows with whole texts are read and workers wait."""

import glob
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridgeline.llm import common, quality


def texts(spark, rows: int, words: int):
    some = F.transform(F.sequence(F.lit(1), F.lit(words)), lambda i: F.sha2((F.col("doc_id") * words + i).cast("string"), 256))
    return common.stored(spark.range(rows, numPartitions=1).withColumnRenamed("id", "doc_id")
                         .withColumns({"text": F.concat_ws(" ", some), "lang": F.lit("en")}))


def groups(frame) -> list[int]:
    """Bytes of each row group of the files that ``frame`` reads."""
    out = []
    for path in {urlparse(f).path for f in frame.inputFiles()}:
        for file in glob.glob(path):
            meta = pq.ParquetFile(file).metadata
            out += [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    return out


def test_quality_rules_read_their_texts_in_small_groups(spark):
    sizes = groups(quality.quality_filter(texts(spark, 160, 1000)))
    assert sum(sizes) > 8 << 20 and max(sizes) < 4 << 20


def test_stored_texts_are_the_rows_given(spark):
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x " * 300_000), (2, None)], "doc_id long, text string")
    back = common.stored(odd, texts=True)
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(tuple, back.collect()), key=key) == sorted(map(tuple, odd.collect()), key=key)
    assert common.stored(odd.where("false"), texts=True).collect() == []


def test_the_pipeline_reads_few_texts_at_a_time_unless_set(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    for given, want in ((None, 512), ("100", 100)):
        session = spark.newSession()
        if given:
            session.conf.set(key, given)
        corpus_pipeline.quality_rules(session, docs, "")
        assert int(session.conf.get(key)) == want


class Pool:
    released = 0

    def release_unused(self):
        self.released += 1


@pytest.fixture()
def pool(monkeypatch):
    pool = Pool()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    return pool


def test_a_worker_gives_freed_memory_back_after_its_rows(pool):
    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    run = common.released(lambda rows: (b for b in rows))
    rows = run(iter(batches))
    assert next(rows) is batches[0] and not pool.released
    assert list(rows) == batches[1:] and pool.released == 1


def test_a_worker_gives_freed_memory_back_after_a_failure(pool):
    def fails(rows):
        yield next(rows)
        raise ValueError("spoilt")

    with pytest.raises(ValueError, match="spoilt"):
        list(common.released(fails)(iter([pa.RecordBatch.from_pydict({"x": [1]})])))
    assert pool.released == 1
