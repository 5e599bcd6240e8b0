"""TSV tables with a dead-letter side, path-tagged inputs and routed outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_tsv(spark: SparkSession, paths: str | list[str], schema: T.StructType, optional: int = 0) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows with all fields (the last `optional` may be missing), cast by schema; bad rows with `line` and `reason`.

    Reasons: 'fields' for a wrong number of fields, 'key' for an empty first field, 'cast' for a
    value its type can't take. Empty values are null.
    """
    n = len(schema.fields)
    lines = spark.read.text(paths).withColumnRenamed("value", "line")
    cells = lines.withColumn("c", F.split("line", "\t", -1))
    value = lambda i: F.when(F.try_element_at("c", F.lit(i + 1)) != "", F.try_element_at("c", F.lit(i + 1)))
    typed = [value(i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    miscast = F.lit(False)
    for i, f in enumerate(schema.fields):
        miscast = miscast | (value(i).isNotNull() & value(i).try_cast(f.dataType).isNull())
    reason = F.when(~F.size("c").between(n - optional, n), "fields").when(value(0).isNull(), "key").when(miscast, "cast")
    judged = cells.withColumn("reason", reason)
    return judged.filter("reason IS NULL").select(*typed), judged.filter("reason IS NOT NULL").select("line", "reason")


def read_tagged(spark: SparkSession, sources: dict[str, tuple[str, dict[str, Column]]]) -> DataFrame:
    """Several tables as one: {tag: (path, {column: expression})}, with the tag in `src`."""
    out = None
    for tag, (path, columns) in sources.items():
        part = spark.read.parquet(path).select(F.lit(tag).alias("src"), *[c.alias(n) for n, c in columns.items()])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def write_routed(df: DataFrame, path: str, by: str, rows_per_file: int = 0) -> None:
    """One folder per value of `by`; files are split at rows_per_file rows."""
    writer = df.write.partitionBy(by).option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def split_bad(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad) by a reason expression that is null for good rows; bad rows keep it in `reason`."""
    judged = df.withColumn("reason", reason)
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")
