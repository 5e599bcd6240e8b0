"""Values that run along sorted rows, without one task per key.

Rows are range-sorted by key and order. A window runs inside each partition's part of a key; what
a key's earlier partitions left is an offset. A key goes on from one partition into the next at
most once per partition, so that the table of offsets has no more rows than there are partitions.
Rows whose inputs are small by the planner's sizes stay one piece per key: then even one key of
all rows is little work, and the sort isn't worth its two extra passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import written

SMALL = 64 << 20


def input_bytes(df: DataFrame) -> int:
    """Size of df's inputs by the planner's statistics; what has none counts as very large."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def pieces(df: DataFrame, keys: list[str], order: list[Column | str], small: int = SMALL) -> tuple[DataFrame, bool]:
    """df range-sorted, with its keys as a struct in `_k` (nulls are equal) and the partition's number in `_p`; and whether it was split.

    Written twice: the range sort reads its input twice, and so do the offsets and the rows. With
    inputs of at most `small` bytes nothing is moved, `_p` is null and a key is one piece.
    """
    keyed = df.withColumn("_k", F.struct(*keys) if keys else F.lit(0))
    if input_bytes(df) <= small:
        return keyed.withColumn("_p", F.lit(None).cast("int")), False
    source = written(keyed, "unsorted")
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    return written(source.repartitionByRange("_k", *by).withColumn("_p", F.spark_partition_id()), "ranged"), True


def inside(order: list[Column | str]):
    """The window of a partition's part of a key."""
    return Window.partitionBy("_p", "_k").orderBy(*order)


def earlier():
    """The window of a key's earlier partitions, over one row per partition and key."""
    return Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)


def with_offsets(rows: DataFrame, offsets: DataFrame, split: bool) -> DataFrame:
    """rows with their part's offsets (at most one row per partition, so always small); null where a key begins."""
    if split:
        return rows.join(F.broadcast(offsets), ["_p", "_k"], "left")
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in offsets.schema if f.name not in ("_p", "_k")])


def numbered(df: DataFrame, keys: list[str], order: list[Column | str], out: str) -> DataFrame:
    """Row number (from 1) within the keys, by a total order."""
    x, split = pieces(df, keys, order)
    sizes = x.groupBy("_p", "_k").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.sum("_n").over(earlier()))
    offsets = sizes.filter("_before > 0").select("_p", "_k", "_before")
    counted = with_offsets(x.withColumn(out, F.row_number().over(inside(order))), offsets, split)
    return counted.withColumn(out, (F.col(out) + F.coalesce("_before", F.lit(0))).cast("bigint")).drop("_p", "_k", "_before")


def running(df: DataFrame, keys: list[str], order: list[Column | str], value: str, out: str) -> DataFrame:
    """Sum of a whole number up to and with each row, within the keys, by a total order."""
    x, split = pieces(df, keys, order)
    offsets = x.groupBy("_p", "_k").agg(F.sum(value).alias("_n")).withColumn("_before", F.sum("_n").over(earlier())).filter("_before IS NOT NULL")
    summed = x.withColumn(out, F.sum(value).over(inside(order).rowsBetween(Window.unboundedPreceding, 0)))
    met = with_offsets(summed, offsets.select("_p", "_k", "_before"), split)
    return met.withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).drop("_p", "_k", "_before")


def gap_parts(df: DataFrame, keys: list[str], time: Column, apart: Column, order: list[Column | str], out: str) -> DataFrame:
    """Number (from 0) of the parts of each key's rows that cuts separate.

    time: a number that rises with the order. apart: a condition on the gap to the row before, in
    the column `_gap` (null at a key's first row, which makes no cut), and on the row's own columns.
    """
    x, split = pieces(df.withColumn("_t", time), keys, order)
    w = inside(order)
    new = F.coalesce(apart, F.lit(False)).cast("int")
    flagged = x.withColumn("_gap", F.col("_t") - F.lag("_t").over(w)).withColumn("_new", new)
    first = F.min_by(F.struct(*[c for c in df.columns], "_t"), F.struct(*[_plain(c) for c in order]))
    parts = flagged.groupBy("_p", "_k").agg(first.alias("_first"), F.max("_t").alias("_last"), F.sum("_new").alias("_inner"))
    by = Window.partitionBy("_k").orderBy("_p")
    parts = parts.withColumn("_gap", F.col("_first._t") - F.lag("_last").over(by)).select("*", *[F.col(f"_first.{c}").alias(c) for c in df.columns if c not in ("_p", "_k")])
    parts = parts.withColumn("_start", new).withColumn("_off", F.coalesce(F.sum(F.col("_inner") + F.col("_start")).over(earlier()), F.lit(0)) + F.col("_start"))
    offsets = parts.filter(F.col("_gap").isNotNull()).select("_p", "_k", "_off")
    summed = flagged.withColumn(out, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return with_offsets(summed, offsets, split).withColumn(out, F.col(out) + F.coalesce("_off", F.lit(0))).drop("_p", "_k", "_t", "_gap", "_new", "_off")


def _plain(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
