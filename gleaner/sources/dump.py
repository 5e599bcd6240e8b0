"""The five-part dump: version, hint and five parts with their lengths; -1 marks an absent part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = ["brief", "content", "parsed_data", "graph", "alt"]
VERSIONS = (-2, -3)


def _int(value: Column) -> Column:
    """A 32-bit integer as four bytes, the lowest first."""
    byte = lambda i: F.lpad(F.hex(F.shiftrightunsigned(value.cast("int"), 8 * i).bitwiseAND(255)), 2, "0")
    return F.unhex(F.concat(*[byte(i) for i in range(4)]))


def _read(data: Column, at: Column) -> Column:
    """The 32-bit integer at a place (from 1); null beyond the end."""
    four = F.substring(data, 1, 0) if at is None else F.substr(data, at, F.lit(4))
    h = F.hex(four)
    swapped = F.concat(*[F.substr(h, F.lit(7 - 2 * i), F.lit(2)) for i in range(4)])
    n = F.conv(swapped, 16, 10).cast("bigint")
    return F.when(F.length(four) == 4, F.when(n >= 2**31, n - 2**32).otherwise(n)).cast("int")


def encode(parts: dict[str, Column], hint: Column | None = None, version: int = -3) -> Column:
    """One binary value of five nullable binary parts; empty parts stay apart from absent ones."""
    if version not in VERSIONS:
        raise ValueError(f"unknown version {version}")
    pieces = [_int(F.lit(version)), _int(F.lit(0) if hint is None else hint)]
    for name in PARTS:
        p = parts.get(name)
        p = F.lit(None).cast("binary") if p is None else p
        pieces += [_int(F.coalesce(F.length(p), F.lit(-1))), F.coalesce(p, F.unhex(F.lit("")))]
    return F.concat(*pieces)


def decode(df: DataFrame, column: str) -> DataFrame:
    """df with `ok` and the five parts; ok is false, and all parts null, for short or mismatched values, unknown versions and negative lengths but -1.

    One fold over the parts carries the place, so that the expression stays small.
    """
    data = F.col(column)
    start = F.struct(
        F.lit(9).alias("at"), F.coalesce(_read(data, F.lit(1)).isin(*VERSIONS), F.lit(False)).alias("ok"), F.array().cast("array<binary>").alias("parts")
    )

    def sized(state: Column, _: Column) -> Column:
        n = _read(data, state["at"])
        step = F.struct(n.alias("n"), state["at"].alias("at"), state["ok"].alias("ok"), state["parts"].alias("parts"))
        return F.element_at(F.transform(F.array(step), taken), 1)

    def taken(x: Column) -> Column:
        size = F.greatest(x["n"], F.lit(0))
        fits = F.coalesce((x["n"] >= -1) & (x["at"] + 3 + size <= F.length(data)), F.lit(False))
        part = F.when(fits & (x["n"] >= 0), F.substr(data, x["at"] + 4, x["n"]))
        return F.struct((x["at"] + 4 + size).cast("int").alias("at"), (x["ok"] & fits).alias("ok"), F.concat(x["parts"], F.array(part)).alias("parts"))

    folded = df.withColumn("_d", F.aggregate(F.sequence(F.lit(1), F.lit(len(PARTS))), start, sized))
    ok = F.coalesce(F.col("_d.ok") & (F.col("_d.at") - 1 == F.length(column)), F.lit(False))
    out = folded.withColumn("ok", ok)
    return out.select(*df.columns, "ok", *[F.when(F.col("ok"), F.col("_d.parts")[i]).alias(n) for i, n in enumerate(PARTS)])


def family_rows(df: DataFrame, key: str) -> DataFrame:
    """key, family, value: a row for each part that isn't absent."""
    return df.unpivot(key, PARTS, "family", "value").filter("value IS NOT NULL")
