"""Joins beyond equality: as-of, nearest, ranges, latest row with commands, salted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators import ranged


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, tie: str, value: str, out: str) -> DataFrame:
    """Each left row with `value` of the latest right row of its keys whose time is not later; null if none.

    One range sort of the union by keys and time in place of a join on a range; a hot key spreads
    over as many partitions as it fills. A right row at the same time counts; of several at one
    time, that with the largest value. Null times never match. left keeps its columns; `tie` is a
    left column that names its rows uniquely.
    """
    l = left.withColumn("_side", F.lit(1)).withColumn("_value", F.lit(None).cast(right.schema[value].dataType))
    r = right.select(*keys, time, F.col(value).alias("_value")).withColumn("_side", F.lit(0))
    order = [F.col(time).asc_nulls_first(), "_side", "_value", tie]
    both, split = ranged.pieces(r.unionByName(l, allowMissingColumns=True), keys, order)
    shown = F.when(F.col("_side") == 0, F.struct(F.col(time).alias("at"), F.col("_value").alias("v")))
    last = F.last(shown, True).over(ranged.inside(order).rowsBetween(Window.unboundedPreceding, 0))
    before = both.groupBy("_p", "_k").agg(F.max(shown).alias("_m")).withColumn("_before", F.last("_m", True).over(ranged.earlier()))
    met = ranged.with_offsets(both.withColumn("_last", last), before.filter("_before IS NOT NULL").select("_p", "_k", "_before"), split)
    return (
        met.withColumn("_last", F.coalesce("_last", "_before"))
        .filter("_side = 1")
        .withColumn(out, F.when(F.col(time).isNotNull() & F.col("_last.at").isNotNull(), F.col("_last.v")))
        .drop("_side", "_value", "_last", "_before", "_p", "_k")
    )


def nearest(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, within_s: int) -> DataFrame:
    """Pairs (left_id, right_id, gap_s): for each left row (columns ts, id) its nearest right row of the keys, at most within_s away.

    The nearest is the last one before or the first one after. Time buckets of within_s, into each
    of which the right rows of its neighbours come too, split a hot key; in a bucket both are found
    by one sort, without pairs. Ties go to the smaller right_id.
    """
    width = within_s * 1_000_000
    none = F.lit(None).cast(right.schema[right_id].dataType)
    l = left.select(*keys, F.col(left_id), micros("ts").alias("_t"), none.alias("_r"), F.lit(1).alias("_side"))
    l = l.withColumn("_b", F.floor(F.col("_t") / width)).filter("_t IS NOT NULL")
    r = right.select(*keys, F.lit(None).cast(left.schema[left_id].dataType).alias(left_id), micros("ts").alias("_t"), F.col(right_id).alias("_r"), F.lit(0).alias("_side"))
    r = r.filter("_t IS NOT NULL").withColumn("_b", F.explode(F.array(*[F.floor(F.col("_t") / width) + d for d in (-1, 0, 1)])))
    both = l.unionByName(r)
    shown = F.when(F.col("_side") == 0, F.struct("_t", "_r"))
    w = Window.partitionBy(*keys, "_b")
    # of several at one time the smallest id: it comes last in the one order and last in the other
    before = F.last(shown, True).over(w.orderBy("_t", "_side", F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0))
    after = F.last(shown, True).over(w.orderBy(F.desc("_t"), "_side", F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0))
    near = lambda c: F.when(F.abs(F.col("_t") - F.col(f"{c}._t")) <= width, F.struct(F.abs(F.col("_t") - F.col(f"{c}._t")).alias("gap"), F.col(f"{c}._r").alias(right_id)))
    met = both.withColumn("_x", before).withColumn("_y", after).filter("_side = 1")
    best = met.withColumn("m", F.least(near("_x"), near("_y"))).filter("m IS NOT NULL")
    return best.select(*keys, left_id, F.col(f"m.{right_id}").alias(right_id), (F.col("m.gap") / 1e6).alias("gap_s"))


def in_ranges(points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, block_bits: int = 16) -> DataFrame:
    """points that lie in at least one range, both ends inclusive (left-semi), joined on blocks of 2**block_bits values.

    A range meets the points of its blocks only; both sides can be large.
    """
    size = 1 << block_bits
    blocks = ranges.select(F.col(start).alias("_a"), F.col(end).alias("_z")).withColumn(
        "_k", F.explode(F.sequence(F.floor(F.col("_a") / size), F.floor(F.col("_z") / size)))
    )
    p = points.withColumn("_k", F.floor(F.col(point) / size))
    cond = (p["_k"] == blocks["_k"]) & (p[point] >= blocks["_a"]) & (p[point] <= blocks["_z"])
    return p.join(blocks, cond, "left_semi").drop("_k")


def latest_with_commands(rows: DataFrame, commands: DataFrame, key: str, ts: str, cmd: str, fails: str, max_fails: int = 3) -> DataFrame:
    """Latest row of each key (ts > 0), with commands applied that are not older: any 'D' deletes, each 'R' adds a failure, max_fails delete.

    rows: key, ts, fails and more; the tie of equal ts falls to the largest row. commands: key, ts, cmd.
    """
    rest = [c for c in rows.columns if c not in (key, ts)]
    latest = rows.filter(F.col(ts) > 0).groupBy(key).agg(F.max(F.struct(ts, *rest)).alias("_r"))
    flat = latest.select(key, *[F.col(f"_r.{c}").alias(c) for c in [ts, *rest]])
    c = commands.select(F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.col(cmd).alias("_cmd"))
    # commands are combined per key and time before they meet the rows
    per = c.groupBy("_key", "_ts").agg(F.bool_or(F.col("_cmd") == "D").alias("_d"), F.count_if(F.col("_cmd") == "R").alias("_n"))
    met = flat.join(per, (flat[key] == per["_key"]) & (per["_ts"] >= flat[ts]), "left")
    out = met.groupBy(key, ts, *rest).agg(F.coalesce(F.bool_or("_d"), F.lit(False)).alias("_d"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"))
    return (
        out.withColumn(fails, (F.coalesce(F.col(fails), F.lit(0)) + F.col("_n")).cast("bigint"))
        .filter(~F.col("_d") & (F.col(fails) < max_fails))
        .drop("_d", "_n")
    )


def salted(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Join with the left side spread over `salts` copies of the right: for hot keys where adaptive skew handling doesn't apply."""
    l = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    r = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return l.join(r, [*keys, "_salt"], how).drop("_salt")


def ip_number(ip: Column) -> Column:
    """A dotted quad as number; null for anything else."""
    p = F.split(ip, r"\.")
    ok = ip.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    return F.when(ok, sum((p[i].cast("bigint") * (1 << (24 - 8 * i)) for i in range(4)), F.lit(0)))
