"""Queries for skewed keys (p2) and drifting schemas (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import drift, hotkeys
from gleaner.sources import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "crawl_job")
    return hotkeys.frequent_keys(jobs, ["url", "ip"], "arrived_ts", "importance").select("field", "key_value")


def p2_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "crawl_job")
    return hotkeys.key_totals(jobs, ["url", "ip"], "arrived_ts", "importance").select(
        "field",
        "key_value",
        F.col("n").alias("jobs"),
        F.col("first_ts").alias("first_arrival"),
        F.col("last_ts").alias("last_arrival"),
        # the small addend makes ties fall the same way whatever the order of summation
        F.round(F.try_divide(F.col("value_sum"), F.col("value_n")) + 1e-9, 6).alias("mean_importance"),
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(table(spark, sf_dir, "raw_batches"))


def p5_lifespans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.lifespans(drift.catalogue(drift.record_fields(table(spark, sf_dir, "raw_batches"))))


def p5_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.consistent_table(table(spark, sf_dir, "raw_batches"), json=True)


QUERIES = {
    "p2_found": p2_found,
    "p2_by_key": p2_by_key,
    "p5_found": p5_found,
    "p5_lifespans": p5_lifespans,
    "p5_table": p5_table,
}

_BY_KEY = """
SELECT '{f}' AS field, {f} AS key_value, count(*) AS jobs, min(arrived_ts) AS first_arrival,
       max(arrived_ts) AS last_arrival, round(avg(importance) FILTER (NOT isnan(importance)) + 1e-9, 6) AS mean_importance
FROM crawl_job WHERE {f} <> '' GROUP BY {f}
"""

ORACLE = {
    "p2_found": """
SELECT field, key_value FROM (
  SELECT 'url' AS field, url AS key_value, count(*) AS n FROM crawl_job WHERE url <> '' GROUP BY url
  UNION ALL SELECT 'ip', ip, count(*) FROM crawl_job WHERE ip <> '' GROUP BY ip)
WHERE n * 100 >= (SELECT count(*) FROM crawl_job)""",
    "p2_by_key": _BY_KEY.format(f="url") + " UNION ALL " + _BY_KEY.format(f="ip"),
}
