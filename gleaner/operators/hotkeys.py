"""Per-key results where a few keys hold most rows: a tree of aggregations.

Level 0 combines fixed-size chunks of the input where they are read (Arrow kernels inside one
mapInArrow, no shuffle). States of keys that are frequent within their chunk then go through
fan-in rounds: in each round `fan_in` states of a key meet, so no task ever receives all
partials of a hot key. States of infrequent keys go straight to the last aggregation, which
itself combines before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import written

STATE = (
    "field string, key_value string, chunk bigint, hot boolean, n bigint, "
    "first_ts timestamp, last_ts timestamp, value_sum double, value_n bigint"
)


def _chunk_states(fields: list[str], chunk_rows: int, hot_rows: int):
    """The level-0 combiner: record batches in, one state per (chunk, field, key) out."""

    def one(chunk: pa.Table, field: str, number: int) -> pa.RecordBatch | None:
        keyed = chunk.filter(pc.fill_null(pc.not_equal(chunk[field], ""), False))
        if not keyed.num_rows:
            return None
        g = keyed.group_by(field).aggregate(
            [(field, "count"), ("at", "min"), ("at", "max"), ("value", "sum"), ("value", "count")]
        )
        n = g[f"{field}_count"]
        size = g.num_rows
        return pa.Table.from_arrays(
            [
                pa.array([field] * size, pa.string()),
                g[field].cast(pa.string()),
                pa.array([number] * size, pa.int64()),
                pc.greater_equal(n, hot_rows),
                n,
                g["at_min"],
                g["at_max"],
                g["value_sum"],
                g["value_count"],
            ],
            names=["field", "key_value", "chunk", "hot", "n", "first_ts", "last_ts", "value_sum", "value_n"],
        ).combine_chunks()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 24
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush():
            nonlocal held, rows, number
            chunk = pa.Table.from_batches(held)
            for field in fields:
                if (out := one(chunk, field, number)) is not None:
                    yield from out.to_batches()
            number += 1
            held, rows = [], 0

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, chunk_rows - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == chunk_rows:
                    yield from flush()
        if rows:
            yield from flush()

    return combine


def _merged() -> list[Column]:
    sums = [F.sum(c).alias(c) for c in ("n", "value_sum", "value_n")]
    return [*sums, F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")]


def key_totals(
    df: DataFrame,
    fields: list[str],
    at: str,
    value: str,
    chunk_rows: int = 65536,
    fan_in: int = 8,
    hot_share: float = 0.001,
) -> DataFrame:
    """Count, first and last time and the sum and number of values, per field and key.

    Null and empty keys are no keys; null and NaN values don't enter value_sum and value_n (a
    key without any value has value_sum null and value_n 0); repeated rows count each time. An
    empty input gives an empty result. Columns besides those named don't matter.

    chunk_rows: rows combined at once at level 0. fan_in: states of a key that meet in a round.
    hot_share: share of its chunk from which a key's state goes through the rounds; it decides
    the path only, never the result.
    """
    spark = df.sparkSession
    rows = df.count()  # from the files' footers
    rounds = max(1, math.ceil(math.log(max(2, rows / chunk_rows), fan_in)))
    source = df.select(
        *[F.col(f).cast("string").alias(f) for f in fields],
        F.col(at).alias("at"),
        F.when(~F.isnan(value), F.col(value).cast("double")).alias("value"),
    )
    hot_rows = max(2, int(chunk_rows * hot_share))
    states = written(source.mapInArrow(_chunk_states(fields, chunk_rows, hot_rows), STATE), "chunk-states")
    tree = states.filter("hot").withColumn("slot", F.pmod(F.xxhash64("chunk"), F.lit(fan_in**rounds)))
    for _ in range(rounds):
        tree = (
            tree.withColumn("slot", F.floor(F.col("slot") / fan_in))
            .groupBy("field", "key_value", "slot")
            .agg(*_merged())
        )
    columns = ["field", "key_value", "n", "first_ts", "last_ts", "value_sum", "value_n"]
    parts = states.filter("NOT hot").select(columns).unionByName(tree.select(columns))
    return parts.groupBy("field", "key_value").agg(*_merged())


def frequent_keys(df: DataFrame, fields: list[str], at: str, value: str, share_percent: int = 1, **tree) -> DataFrame:
    """Keys that hold at least share_percent of all rows of df (repeated rows and rows without key counted)."""
    rows = df.count()
    return key_totals(df, fields, at, value, **tree).filter(F.col("n") * 100 >= F.lit(share_percent * rows))
