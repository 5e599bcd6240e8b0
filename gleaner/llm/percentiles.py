"""Percentiles by cumulative frequencies, all in SQL expressions.

Rows are reduced to counts per group and value. The counts are range-sorted by group and value, so
that a hot group spreads over as many partitions as it fills; totals per partition and group give
offsets, which the running sums inside a partition are compared with to pick the first value that
reaches a target rank. Counts of days or partitions add up, so states combine without loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import written

METRICS = ["crawl_time", "connect_time", "donwload_speed", "response_code"]


def _rounded(value: Column, rel_error: float) -> Column:
    """The value, or with rel_error > 0 the middle of its logarithmic bin, off by at most that share of the value."""
    if not rel_error:
        return value
    base = 2 * F.lit(rel_error) / (1 - rel_error) + 1
    edge = F.pow(base, F.floor(F.log(value) / F.log(base)))
    return F.when(value == 0, value).otherwise(edge * (2 * base / (1 + base)))


def value_counts(
    df: DataFrame, id_col: str, keys: dict[str, Column], metrics: list[str] = METRICS, rel_error: float = 0.0
) -> DataFrame:
    """The state: n per group, metric and value. Add states up with combine().

    Null, NaN, infinite and negative values are no measurements; rows with the same id_col count
    once (the first by its values where they differ), rows with null id_col each. Null group keys
    are a group of their own. rel_error bounds the values' relative error and with it the size of
    a group's state; 0 keeps the values.
    """
    parts = df.select(
        F.col(id_col).alias("_id"),
        *[c.alias(k) for k, c in keys.items()],
        *[F.col(m).cast("double").alias(m) for m in metrics],
    )
    # rows without id need no comparison: a number of their own spreads them and keeps each
    alone = F.when(F.col("_id").isNull(), F.monotonically_increasing_id())
    first = Window.partitionBy("_id", "_alone").orderBy(*keys, *metrics)
    once = parts.withColumn("_alone", alone).withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r", "_id", "_alone")
    long = once.unpivot(list(keys), metrics, "metric", "value").filter(
        (F.col("value") >= 0) & (F.col("value") < float("inf")) & ~F.isnan("value")
    )
    rounded = _rounded(F.col("value") + F.lit(0.0), rel_error)  # -0.0 becomes 0.0
    return long.groupBy(*keys, "metric", rounded.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def combine(states: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of several days or partitions as one state with fewer group keys."""
    return states.groupBy(*keys, "metric", "value").agg(F.sum("n").alias("n"))


def percentiles(states: DataFrame, keys: list[str], percents: tuple[int, ...] = (50, 90, 99)) -> DataFrame:
    """Per group and metric: n and p<percent>, the smallest value whose running count reaches ceil(percent % of n).

    An empty state gives no rows.
    """
    group = [*keys, "metric"]
    # written once: the range sort reads its input twice, to sample it and to sort it
    counts = written(states.select(F.struct(*group).alias("_g"), "value", "n"), "value-counts")  # a struct keeps null keys equal
    ranged = written(counts.repartitionByRange("_g", "value").withColumn("_p", F.spark_partition_id()), "ranged-counts")
    upto = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = (
        ranged.groupBy("_p", "_g")
        .agg(F.sum("n").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy("_g")))
    )
    # ranks that a partition holds of a group, counted from its first row of the group
    ranks = F.array(*[F.struct(F.lit(p).alias("p"), (F.floor((F.col("_total") * p + 99) / 100) - F.col("_upto") + F.col("_n")).alias("rank")) for p in percents])
    targets = pieces.select("_p", "_g", "_total", F.filter(ranks, lambda t: (t["rank"] > 0) & (t["rank"] <= F.col("_n"))).alias("_targets"))
    within = Window.partitionBy("_p", "_g").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ranged.withColumn("_run", F.sum("n").over(within)).join(targets.filter(F.size("_targets") > 0), ["_p", "_g"])
    reached = running.select(
        "_g", "_total", "value", F.filter("_targets", lambda t: (t["rank"] <= F.col("_run")) & (t["rank"] > F.col("_run") - F.col("n"))).alias("_hit")
    ).filter(F.size("_hit") > 0)
    value_of = lambda p: F.max(F.when(F.exists("_hit", lambda t: t["p"] == p), F.col("value"))).alias(f"p{p}")
    return reached.groupBy("_g").agg(F.max("_total").alias("n"), *[value_of(p) for p in percents]).select("_g.*", "n", *[f"p{p}" for p in percents])
