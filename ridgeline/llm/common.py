"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.session import materialize

#: ASCII white space, the separator of words.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs without ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def stored(df: DataFrame, *, texts: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut,
    a lost executor loses nothing, and joins see its real size. ``texts``: its rows
    carry whole texts, which are read in small portions."""
    return materialize(df, as_table=True, texts=texts)


Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for mapInArrow, after which the worker gives freed memory back, Arrow's and (where
    the C library can) its own: a worker waits for its next task, and holds it beside the
    executor's other work till then."""
    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return whole


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of a partition sorted by ``key``, one table per run of whole groups:
    a group that spans Arrow batches is put together before it is handed on."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key))
        last, n = keys[batch.num_rows - 1].as_py(), batch.num_rows
        cut = n
        while cut and keys[cut - 1].as_py() == last:
            cut -= 1
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            if held and held[0].column(batch.schema.get_field_index(key))[0].as_py() != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


SIEVE_BITS = 1 << 26          # 8 MB: what a sieve takes at most in the driver and each worker
BITS_PER_KEY = 12
PROBES = 6


def sifted(rows: DataFrame, hashed: Column, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose hash (a long) is not in the column ``h`` of ``wanted``:
    a Bloom filter ahead of a join, so that rows which cannot match are not shuffled. All
    others stay, and the join decides. Where ``wanted`` is so long that a filter of SIEVE_BITS
    would let most rows through, they all go to the join."""
    n = wanted.count()
    if n > SIEVE_BITS // 4:
        return rows
    bits = min(SIEVE_BITS, 1 << max(6, math.ceil(math.log2(max(1, n) * BITS_PER_KEY))))
    low, high = F.col("h").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("h", 32)
    probes = F.array(*[(low + high.bitwiseOR(1) * i).bitwiseAND(bits - 1) for i in range(PROBES)])
    word = F.shiftright("at", 6)
    found = (wanted.select(F.explode(probes).alias("at"))
             .groupBy(word.alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("set"))
             .toArrow())                        # at most SIEVE_BITS / 64 rows
    words = np.zeros(bits // 64, np.uint64)
    words[np.asarray(found["word"])] = np.asarray(found["set"]).view(np.uint64)

    @F.pandas_udf("boolean")
    def may_hold(h: pd.Series) -> pd.Series:
        x = h.to_numpy(np.int64).view(np.uint64)
        low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
        keep = np.ones(len(x), bool)
        for i in range(PROBES):
            at = (low + high * np.uint64(i)) & np.uint64(bits - 1)
            keep &= (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return pd.Series(keep)

    return rows.where(may_hold(hashed))
