"""Top rows per group, capacity and load partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators.ranged import earlier, inside, pieces, with_offsets


def top(df: DataFrame, keys: list[str], order: list[Column], n: int | Column, rank: str = "place") -> DataFrame:
    """First n rows of each group; with a literal n the engine cuts groups before its shuffle. n may be a column."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n)


def cumulative_nodes(df: DataFrame, load: str, tie: str, nodes: int, out: str = "node") -> DataFrame:
    """Rows by falling load onto nodes of about equal sums: after each row the node moves on, by at most one, once the running sum reaches average * (node + 1).

    Running sums come from range partitions and their offsets, so no task sees all rows. Since
    the loads fall, a row larger than the average moves the node one step only; the rule is
    sequential, its state (the node) is bounded by `nodes` and follows each partition's sums.
    """
    order = [F.desc(load), F.asc(tie)]
    x, split = pieces(df, [], order)
    total = x.agg(F.coalesce(F.sum(load), F.lit(0)).alias("t")).first()["t"]
    average = total / nodes if nodes else 0
    summed = _summed(x, split, order, load, "_sum", "_row")
    # Node of a row: moves by one per row at most, so node(row) = min over earlier rows k of (reach(k) + rows since)
    reach = F.floor((F.col("_sum") - F.col(load)) / average) if average else F.lit(0)
    bound = running_min(summed.withColumn("_reach", (reach - F.col("_row")).cast("bigint")), "_row", "_reach", "_low")
    node = F.least(F.col("_row") + F.least(F.col("_low"), F.lit(0)), F.lit(nodes - 1))
    return bound.withColumn(out, F.greatest(node, F.lit(0)).cast("int")).drop("_sum", "_row", "_reach", "_low")


def running_sum(df: DataFrame, order: list[Column], value: str, out: str, row: str) -> DataFrame:
    """Exact running sums and row numbers (from 0) over a total order, by range partitions and their offsets."""
    return _summed(*pieces(df, [], order), order, value, out, row)


def _summed(x: DataFrame, split: bool, order: list[Column], value: str, out: str, row: str) -> DataFrame:
    totals = x.groupBy("_p", "_k").agg(F.sum(value).alias("_t"), F.count(F.lit(1)).alias("_c"))
    offsets = totals.select("_p", "_k", F.sum("_t").over(earlier()).alias("_o"), F.sum("_c").over(earlier()).alias("_oc")).filter("_oc > 0")
    w = inside(order)
    y = x.withColumn("_s", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.row_number().over(w))
    y = with_offsets(y, offsets, split)
    return y.withColumn(out, F.col("_s") + F.coalesce("_o", F.lit(0))).withColumn(row, F.col("_n") - 1 + F.coalesce("_oc", F.lit(0))).drop("_s", "_n", "_o", "_oc", "_p", "_k")


def running_min(df: DataFrame, order: str, value: str, out: str, block: int = 1 << 20) -> DataFrame:
    """Running minimum over a dense row number: within blocks of rows, then over the blocks' minima."""
    x = df.withColumn("_b", F.floor(F.col(order) / block))
    w = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inside = x.withColumn("_m", F.min(value).over(w))
    blocks = x.groupBy("_b").agg(F.min(value).alias("_t"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    carry = blocks.select("_b", F.min("_t").over(before).alias("_c"))
    return inside.join(F.broadcast(carry), "_b").withColumn(out, F.least("_m", "_c")).drop("_b", "_m", "_c")
