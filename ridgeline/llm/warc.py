"""WARC archives and their Merkle fixity audit.

``write_warc`` writes records as compressed WARC files: a file holds a range
of keys, in key order, and each record is a gzip member of its own, closed by an
empty member. Records are compressed where they are read, so that only compressed
ones are shuffled. Offsets and lengths are those of the uncompressed archive, so
they are known beforehand and do not depend on the compressor.
``manifest`` gives the offsets, lengths and hashes that the files should have,
``read_warc`` those that a replica's files do have. Damaged bytes spoil the
record that holds them; reading goes on at the next empty member. ``audit`` builds a hash
tree over each: leaves are ordered offset ranges of a file, inner nodes join a
fixed number of neighbours, a file's nodes join in its root, and the files' roots in
the archive's. It compares the roots and descends only into branches that
differ, down to the ranges and records that are damaged, missing or extra.

Null URLs and bodies count as empty. A null key goes to file -1. Repeated rows
are records each; equal keys are ordered by hash. Empty tables have no files
and equal, empty trees.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import stored

FILE_KEYS = 1024              # keys of one file
RANGE_BYTES = 64 << 10        # leaf: records that begin in this range of offsets
FANOUT = 16
END = "\r\n\r\n"
GZIP = 31                     # zlib's number for the gzip format
_HEAD = re.compile(rb"WARC/1\.0\r\n(.*?)\r\n\r\n", re.S)
_ID = re.compile(rb"(?im)^WARC-Record-ID: *<urn:page:(-?\d+)> *\r?$")


def record(key: Column, url: Column, body: Column) -> Column:
    """Text of a WARC resource record, without the blank lines that end it."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(key.cast("string"), F.lit("-1")), F.lit(">\r\nWARC-Target-URI: "),
                    F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " "),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body)


def _records(pages: DataFrame, key: str, url: str, body: str) -> DataFrame:
    text = record(F.col(key), F.col(url), F.col(body))
    return pages.select(F.coalesce(F.floor(F.col(key) / FILE_KEYS), F.lit(-1)).cast("long").alias("file"),
                        F.coalesce(F.col(key).cast("long"), F.lit(-1)).alias("key"), text.alias("text"))


def pack(data: bytes) -> bytes:
    """A gzip member, without a time stamp: equal records give equal members."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return deflate.compress(data) + deflate.flush()


BETWEEN = pack(b"")           # closes a record


def write_warc(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", body: str = "html") -> None:
    """One file per range of keys under ``path``/file=N."""
    rows = _records(pages, key, url, body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [v.as_buffer().to_pybytes() for v in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                     pa.array([pack(t + END.encode()) for t in texts], pa.binary())],
                    names=["file", "key", "hash", "member"])

    members = rows.mapInArrow(run, "file long, key long, hash string, member binary")
    # the text writer puts out a string's bytes as they are; one byte a character in the separator
    (members.repartition("file").sortWithinPartitions("file", "key", "hash")
     .select("file", F.col("member").cast("string").alias("member"))
     .write.mode("overwrite").partitionBy("file").option("encoding", "ISO-8859-1")
     .option("lineSep", BETWEEN.decode("latin-1")).text(path))


def manifest(pages: DataFrame, *, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Rows file, key, offset, length, hash of the records as they should be written. Only
    lengths and hashes are shuffled."""
    rows = _records(pages, key, url, body).select(
        "file", "key", F.octet_length("text").cast("long").alias("length"), F.sha2("text", 256).alias("hash"))
    before = Window.partitionBy("file").orderBy("key", "hash").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("file", "key", F.coalesce(F.sum(F.col("length") + len(END)).over(before), F.lit(0))
                       .cast("long").alias("offset"), "length", "hash")


def _separator(content: bytes, at: int) -> int:
    """Where the next empty member begins, or the content ends."""
    found = content.find(BETWEEN, at)
    return len(content) if found < 0 else found


def _inflate(content: bytes, at: int, wbits: int = GZIP) -> tuple[bytes, int] | None:
    """The sound member (or, by ``wbits``, bare stream) at ``at`` and its end."""
    inflate, parts = zlib.decompressobj(wbits), []
    try:
        while not inflate.eof and at < len(content):
            end = _separator(content, at + 1)       # it may lie within the member: read on
            parts.append(inflate.decompress(content[at:end]))
            at = end
    except zlib.error:
        return None
    return (b"".join(parts), at - len(inflate.unused_data)) if inflate.eof else None


def _spoilt(content: bytes, at: int) -> tuple[int, int]:
    """Uncompressed length and end of a member that fails its check. Its last four bytes give the
    length, unless the stream agrees with the checksum before them: then it is they that are damaged."""
    end = _separator(content, at)
    found = _inflate(content, at + 10, -zlib.MAX_WBITS)
    if found and zlib.crc32(found[0]) == int.from_bytes(content[found[1]:found[1] + 4], "little"):
        return len(found[0]), found[1] + 8
    return int.from_bytes(content[max(at, end - 4):end], "little"), end


def parse(content: bytes) -> Iterator[tuple[int, int, int, str]]:
    """(key, offset, length, sha256) of each record. One that is not as it was written, or whose
    closing member is not, has key -1 and the hash of its compressed bytes; the offsets after it hold."""
    at = offset = 0
    while at < len(content):
        found = _inflate(content, at)
        if found:
            data, end = found
            size = len(data)
        else:
            size, end = _spoilt(content, at)
        text = data[:-len(END)] if found and data.endswith(END.encode()) and content.startswith(BETWEEN, end) else None
        head = _HEAD.match(text) if text else None
        name = _ID.search(head[1]) if head else None
        digest = hashlib.sha256(content[at:end] if text is None else text).hexdigest()
        yield int(name[1]) if name else -1, offset, max(size - len(END), 0), digest
        at, offset = end + len(BETWEEN), offset + size


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows file, key, offset, length, hash of the records in the files."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.txt").load(path)
             .select(F.regexp_extract("path", r"/file=(-?\d+)/", 1).cast("long").alias("file"), "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = list(parse(content.as_py()))
                key, offset, length, digest = zip(*rows, strict=True) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(rows), pa.int64()), pa.array(key, pa.int64()), pa.array(offset, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(digest, pa.string())],
                    names=["file", "key", "offset", "length", "hash"])

    return files.mapInArrow(run, "file long, key long, offset long, length long, hash string")


def _joined(order: list[str]) -> Column:
    """Hash of the children's hashes in order."""
    pairs = F.array_sort(F.collect_list(F.struct(*order, "hash")))
    return F.sha2(F.array_join(F.transform(pairs, lambda p: p["hash"]), ""), 256).alias("hash")


def _up(level: DataFrame, within: list[str]) -> DataFrame:
    """Parents of a level's nodes."""
    up = F.floor(F.col("node") / FANOUT).cast("long").alias("parent")
    return level.groupBy(*within, up).agg(_joined(["node"])).withColumnRenamed("parent", "node")


def tree(records: DataFrame, last_leaf: int, last_file: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels within the files (file, node, hash), from the leaves up to a root per file,
    and over the files (node, hash), from those roots up to one. A leaf has the records
    of one range of offsets, an inner node at most FANOUT children."""
    leaf = F.floor(F.col("offset") / RANGE_BYTES).cast("long").alias("node")
    inner = [stored(records.groupBy("file", leaf).agg(_joined(["offset", "length"])))]
    while last_leaf > 0:
        last_leaf //= FANOUT
        inner.append(_up(inner[-1], ["file"]))
    outer = [stored(inner[-1].select(_number(F.col("file")).alias("node"), "hash"))]
    while last_file > 0:
        last_file //= FANOUT
        outer.append(_up(outer[-1], []))
    return inner, outer


def _number(file: Column) -> Column:
    """Files in one row of numbers from 0: 0, -1, 1, -2, ..."""
    return F.when(file >= 0, file * 2).otherwise(-file * 2 - 1)


def _differing(x: DataFrame, y: DataFrame, keys: list[str], parents: DataFrame | None) -> DataFrame:
    """Nodes whose hashes differ or that one side lacks, below ``parents`` only."""
    if parents is not None:
        up = parents.withColumnRenamed("node", "parent")
        x, y = (z.withColumn("parent", F.floor(F.col("node") / FANOUT).cast("long"))
                .join(up, up.columns, "left_semi") for z in (x, y))
    both = x.select(*keys, F.col("hash").alias("h")).join(y.select(*keys, F.col("hash").alias("g")), keys, "full")
    return stored(both.where(~F.col("h").eqNullSafe(F.col("g"))).select(*keys))


def damaged_ranges(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Leaves (file, node) in which the two replicas differ: the roots are compared first,
    and only branches below differing nodes are read on."""
    both = expected.select("file", "offset").unionByName(found.select("file", "offset"))
    ends = both.agg(F.max(F.floor(F.col("offset") / RANGE_BYTES)), F.max(_number(F.col("file")))).first()
    a, b = (tree(r, int(ends[0] or 0), int(ends[1] or 0)) for r in (expected, found))
    bad = None
    for x, y in zip(reversed(a[1]), reversed(b[1]), strict=True):
        bad = _differing(x, y, ["node"], bad)
        if bad.isEmpty():
            return expected.sparkSession.createDataFrame([], "file long, node long")
    number = F.col("node")
    bad = bad.select(F.when(number % 2 == 0, F.floor(number / 2)).otherwise(-F.floor((number + 1) / 2))
                     .cast("long").alias("file"), F.lit(0).cast("long").alias("node"))
    for x, y in zip(reversed(a[0][:-1]), reversed(b[0][:-1]), strict=True):
        bad = _differing(x, y, ["file", "node"], bad)
    return bad


def audit(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows file, key, offset, length, hash, found_hash, status of all records of both
    replicas: ok, damaged (another hash at the offset), missing or extra. Only records
    in leaves that differ are compared one by one."""
    bad = damaged_ranges(expected, found)
    leaf = F.floor(F.col("offset") / RANGE_BYTES).cast("long")
    e, f = expected.withColumn("node", leaf), found.withColumn("node", leaf)
    fine = e.join(bad, ["file", "node"], "left_anti").select(
        "file", "key", "offset", "length", "hash", F.col("hash").alias("found_hash"), F.lit("ok").alias("status"))
    e, f = e.join(bad, ["file", "node"], "left_semi"), f.join(bad, ["file", "node"], "left_semi")
    status = (F.when(F.col("found_hash").isNull(), "missing").when(F.col("hash").isNull(), "extra")
              .when(F.col("hash") != F.col("found_hash"), "damaged").otherwise("ok"))
    checked = (e.select("file", "key", "offset", "length", "hash")
               .join(f.select("file", "offset", F.col("key").alias("k"), F.col("length").alias("n"),
                              F.col("hash").alias("found_hash")), ["file", "offset"], "full")
               .select("file", F.coalesce("key", "k").alias("key"), "offset",
                       F.coalesce("length", "n").alias("length"), "hash", "found_hash", status.alias("status")))
    return fine.unionByName(checked)
