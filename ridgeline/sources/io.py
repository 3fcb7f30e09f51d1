"""Readers and writers.

Readers declare schemas (no inference pass over the data). Writers use
dynamic partition overwrite, so re-running a job replaces the partitions it
produces instead of appending duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Weekly chart rows as delivered (text date, list literals as text).
CHART_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("streams", T.LongType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("artists", T.StringType()),
    T.StructField("artist_genres", T.StringType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("explicit", T.BooleanType()),
    T.StructField("name", T.StringType()),
])

# Top-k chart as written by the ranking job (sums are BIGINT, means DOUBLE).
TOP_CHART_SCHEMA = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("artists", T.StringType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("artist_genres", T.StringType()),
    T.StructField("explicit", T.BooleanType()),
    T.StructField("total_streams", T.LongType()),
    T.StructField("weeks_on_chart", T.LongType()),
    T.StructField("average_streams", T.DoubleType()),
    T.StructField("rank", T.IntegerType()),
])

# Text corpus: one row per text part.
CORPUS_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("artist", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("views", T.LongType()),
    T.StructField("features", T.StringType()),
    T.StructField("lyrics", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("language", T.StringType()),
])

TEXT_LANGUAGE_SCHEMA = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("lyrics", T.StringType()),
    T.StructField("language", T.StringType()),
])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             *, header: bool = True, **options) -> DataFrame:
    """CSV scan. With ``schema`` malformed cells become NULL (PERMISSIVE);
    without it every column is a string (no inference pass)."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_chart(spark: SparkSession, path: str | Sequence[str],
               schema: T.StructType = CHART_SCHEMA) -> DataFrame:
    """A1: typed weekly chart CSV with a header line."""
    return read_csv(spark, path, schema)


def read_entity_files(spark: SparkSession, path: str, schema: T.StructType, *,
                      fmt: str = "csv", code: str = "country_code", name: str = "country",
                      **options) -> DataFrame:
    """One file per entity named ``<code>_<name>.<ext>``; a single scan
    of the whole directory (parallel over files) adds the code and the name
    taken from the file name (``_metadata.file_name``)."""
    r = spark.read.format(fmt).schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(path)
    # The metadata file name is URL-encoded (a space arrives as %20).
    fname = F.try_url_decode(F.col("_metadata.file_name"))
    return (df.withColumn(code, F.regexp_extract(fname, r"^([^_]+)_", 1))
            .withColumn(name, F.regexp_extract(fname, r"^[^_]+_(.*)\.[^.]+$", 1)))


def write_entity_files(df: DataFrame, path: str, code: str, name: str) -> None:
    """The layout that ``read_entity_files`` reads: ``path/<code>_<name>.csv``, one file per entity.
    One task writes an entity; the files are then renamed, entity by entity."""
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}-parts"
    entity = F.concat_ws("_", code, name)
    rest = [c for c in df.columns if c not in (code, name)]
    (df.select(*rest, entity.alias("entity")).repartition("entity").sortWithinPartitions("entity")
     .write.mode("overwrite").option("header", "true").partitionBy("entity").csv(folder))
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(path))
    for status in fs.globStatus(hadoop.Path(f"{folder}/entity=*/*.csv")):
        part = status.getPath()
        named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(
            part.getParent().getName().split("=", 1)[1])
        if not fs.rename(part, hadoop.Path(f"{path}/{named}.csv")):
            raise OSError(f"cannot rename {part.toString()}")


def write_text_corpus(df: DataFrame, path: str) -> None:
    """Texts as the CSV that ``read_text_corpus`` reads: every value is quoted and kept as it is."""
    (df.write.mode("overwrite").option("header", "true").option("escape", '"').option("quoteAll", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def read_text_corpus(spark: SparkSession, path: str | Sequence[str],
                     schema: T.StructType = CORPUS_SCHEMA) -> DataFrame:
    """CSV with quoted multi-line fields and ``"`` as escape. Multi-line
    CSV files cannot be split, so read once and store as Parquet."""
    return read_csv(spark, path, schema, multiLine=True, escape='"', quote='"')


def read_json(spark: SparkSession, path: str | Sequence[str],
              schema: T.StructType = TEXT_LANGUAGE_SCHEMA) -> DataFrame:
    """JSON-lines scan with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_partitioned(spark: SparkSession, path: str, *, fmt: str = "parquet",
                     base_path: str | None = None, schema: T.StructType | None = None, **options) -> DataFrame:
    """Hive-partitioned scan; ``base_path`` keeps the partition columns when
    reading a sub-directory. Filters on partition columns prune folders. Without
    a ``schema`` the partition columns' types are inferred from the folders."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if base_path:
        r = r.option("basePath", base_path)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def publish_partitioned(df: DataFrame, path: str, by: Sequence[str], *,
                        cols: Sequence[str] | None = None, fmt: str = "parquet",
                        mode: str = "overwrite", replace_only: bool = False,
                        files_per_partition: int = 1, **options) -> None:
    """Ordered projection written hive-style. The whole output is
    replaced, so groups that a re-run no longer has are gone; with
    ``replace_only`` just the partitions present in ``df`` are replaced (sinks
    written batch by batch). Rows are dealt by the partition columns first, to
    at most ``files_per_partition`` tasks each (raise it where one partition
    is large). The partition columns end up last when read back."""
    out = df.select(*cols) if cols else df
    rest = [c for c in out.columns if c not in by]
    salt = F.pmod(F.xxhash64(*(rest or by)), F.lit(files_per_partition))
    w = (out.repartition(*by, salt).write.mode(mode).format(fmt).partitionBy(*by)
         .option("partitionOverwriteMode", "dynamic" if replace_only else "static"))
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def publish_text(df: DataFrame, json_path: str | None, parquet_path: str,
                 by: Sequence[str] = ("language",)) -> None:
    """A JSON copy and a Parquet copy partitioned by ``by``, both replaced whole. The
    texts are computed once and dealt to tasks by their size (``sources.sized``)."""
    from ridgeline.sources.sized import publish_sized

    publish_sized(df, {**({"json": json_path} if json_path else {}), "parquet": parquet_path}, list(by))


def export_single_csv(df: DataFrame, path: str, *, header: bool = True) -> None:
    """H6: one CSV file. Only for reduced results (the data goes through one
    task); use ``export_sorted_csv`` for large tables."""
    df.coalesce(1).write.mode("overwrite").option("header", header).csv(path)


def export_sorted_csv(df: DataFrame, path: str, order: Sequence[str], *,
                      partitions: int | None = None, header: bool = True) -> None:
    """Globally ordered CSV in many files: range partitioning by ``order``
    and a sort inside each partition; file names follow the order."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .write.mode("overwrite").option("header", header).csv(path))


def write_bucketed(df: DataFrame, table: str, key: str | Sequence[str], buckets: int, *,
                   sort: bool = True, mode: str = "overwrite") -> None:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``key``.

    Two tables bucketed by the same key into the same number of buckets join
    without a shuffle (e.g. line items and orders by order key, written once
    and joined by many jobs)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)
