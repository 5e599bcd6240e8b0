"""Registration of named queries, and views of the tables in the roles of the logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.sources import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, with_: str = ""):
    """Register the decorated function under its name, with the equivalent SQL if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = (f"WITH {with_} " if with_ else "") + sql
        return f

    return add


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as search log: sid, mid, ts, query, se, rank, url."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("sid"),
        F.col("o_custkey").alias("mid"),
        F.col("o_orderdate").alias("ts"),
        F.concat(F.lit("q"), F.col("l_partkey") % 97).alias("query"),
        F.col("l_returnflag").alias("se"),
        F.col("l_linenumber").alias("rank"),
        F.concat(F.lit("u"), F.col("l_partkey")).alias("url"),
    )


SEARCH = """s AS (SELECT l_orderkey AS sid, o_custkey AS mid, o_orderdate AS ts, 'q' || (l_partkey % 97) AS query, l_returnflag AS se,
l_linenumber AS rank, 'u' || l_partkey AS url FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def pv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs as page views: mid, ts, url, ref_url, id; rows without mid are left out."""
    return (
        table(spark, sf_dir, "crawl_job")
        .filter("ip <> '' AND url <> ''")
        .select(
            F.col("ip").alias("mid"),
            F.col("arrived_ts").alias("ts"),
            "url",
            F.coalesce("referer", F.lit("")).alias("ref_url"),
            F.col("job_id").alias("id"),
        )
    )


PV = """pv AS (SELECT ip AS mid, arrived_ts AS ts, url, coalesce(referer, '') AS ref_url, job_id AS id FROM crawl_job WHERE ip <> '' AND url <> '')"""

HOST_SQL = "lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1))"
PATH_SQL = "regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
QUERY_SQL = "regexp_extract({0}, '^[^?#]*\\?([^#]*)', 1)"
HASH_SQL = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"


def host_sql(c: str) -> str:
    return HOST_SQL.format(c)
