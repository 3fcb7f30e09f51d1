"""Publishing by groups with tasks and files of bounded size.

Dealing rows by their group alone gives a hot group (a language with most texts) to
one task, and many small groups a task each. Here the groups' bytes lie one after
another on a line, which is cut every ``task_bytes``: a hot group covers many cuts, and
small ones share one. The line is a table of one row per group; a row's place on it is
its group's start plus an even share of the group's bytes, and the cut it falls in is
its task (``repartitionById``: no second hashing that could put two cuts together).

The input is computed once, into a table in the shared folder, from which sizes are
counted and every format is written. There are at most as many files as groups and
tasks together. Null group values are a group of their own; repeated rows are rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.session import materialize

TASK_BYTES = 256 << 20


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: the bytes of its strings and binaries, 8 for every other column."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = F.lit(8 * (len(df.columns) - len(wide)) + 1).cast("long")
    return reduce(lambda a, c: a + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)), wide, fixed)


def deal_by_size(stored: DataFrame, by: Sequence[str], task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows of ``stored`` (a table: its rows must not change between reads) dealt to tasks of
    about ``task_bytes``, groups together where they are small."""
    named = [F.col(c).alias(f"__g{i}") for i, c in enumerate(by)]
    sizes = stored.select(*named, row_bytes(stored).alias("__b")).groupBy(*[f"__g{i}" for i in range(len(by))]).agg(
        F.sum("__b").alias("__group"))
    order = Window.orderBy(*[f"__g{i}" for i in range(len(by))]).rowsBetween(Window.unboundedPreceding, -1)
    line = materialize(sizes.withColumn("__start", F.coalesce(F.sum("__group").over(order), F.lit(0))))
    total = line.agg(F.sum("__group")).first()[0] or 1
    tasks = -(-total // task_bytes)
    # an even share by the row's own place in the table, so that equal rows are spread too
    share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) / F.lit(float(1 << 30))
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(by)])
    placed = stored.withColumn("__share", share).join(line, same)
    cut = F.least(F.floor((F.col("__start") + F.col("__share") * F.col("__group")) / task_bytes), F.lit(tasks - 1))
    return placed.repartitionById(int(tasks), cut.cast("int")).select(*stored.columns)


def publish_sized(df: DataFrame, paths: Mapping[str, str], by: Sequence[str], *, task_bytes: int = TASK_BYTES,
                  flat: Sequence[str] = ("json",)) -> None:
    """Write ``df`` to every ``paths`` entry (format -> path), replaced whole and partitioned by
    ``by``; formats in ``flat`` are written without group folders."""
    stored = materialize(df, as_table=True)
    for fmt, path in paths.items():
        w = deal_by_size(stored, by, task_bytes).write.mode("overwrite").format(fmt)
        (w if fmt in flat else w.partitionBy(*by).option("partitionOverwriteMode", "static")).save(path)
