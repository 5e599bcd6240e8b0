"""Named queries over training data, with the equivalent SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import leak, mojibake, pii, residue, seen, tokens
from gleaner.llm import percentiles as pct
from gleaner.sources import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = seen.status_signs(table(spark, sf_dir, "crawl_status"))
    return seen.seen_before(known, table(spark, sf_dir, "new_url"), "new_id", "clicked_url")


def p1_wrong(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of wrong answers with 64, 40 and 24 bits of the sign kept."""
    known = table(spark, sf_dir, "crawl_status").select(
        seen.url_key(F.col("clicked_url")).alias("key"),
        F.when(F.col("clicked_url").isNull(), F.col("sign")).alias("stored"),
    )
    known = known.select("key", F.coalesce(seen.sign_of(F.col("key")), "stored").alias("sign")).filter("sign IS NOT NULL")
    new = table(spark, sf_dir, "new_url").select(F.col("new_id").alias("id"), seen.url_key(F.col("clicked_url")).alias("key"))
    parts = [seen.wrong_answers(known, new, bits) for bits in (64, 40, 24)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p3_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = table(spark, sf_dir, "archive_data").select(F.col("archive_id").alias("rec_id"), "title")
    products = table(spark, sf_dir, "product_info").select("rec_id", "title")
    return mojibake.damaged([("archive_data", archive), ("product_info", products)])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_damaged(spark, sf_dir).select("tab", "rec_id")


def p4_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(table(spark, sf_dir, "archive_data"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_reasons(spark, sf_dir).filter("coalesce(title_why, cdoc_why) IS NOT NULL").select("archive_id")


def p4_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that hold real content."""
    return p4_reasons(spark, sf_dir).filter("coalesce(title_why, cdoc_why) IS NULL").select("archive_id")


def _states(spark: SparkSession, sf_dir: str, rel_error: float = 0.0) -> DataFrame:
    day = F.date_from_unix_date(F.floor(F.col("crawl_timestamp") / F.lit(86_400_000_000)).cast("int"))  # UTC, whatever the session
    keys = {"host": F.col("host"), "link_from": F.col("link_from"), "day": day}
    return pct.value_counts(table(spark, sf_dir, "crawl_info"), "info_id", keys, rel_error=rel_error)


def p6_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pct.percentiles(_states(spark, sf_dir), ["host", "link_from", "day"])


def p6_host_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily states, rounded to within 0.5 %, combined per host over all days and sources."""
    states = pct.combine(_states(spark, sf_dir, rel_error=0.005), ["host"])
    return pct.percentiles(states, ["host"])


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"))


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).filter("kind = 'verbatim'").select("doc_id", "item_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def p9_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redacted(table(spark, sf_dir, "documents"))


_KEYS = r"""
WITH a AS (SELECT 0 AS new_id, clicked_url AS u, sign AS s FROM crawl_status
           UNION ALL SELECT new_id, clicked_url, NULL FROM new_url),
b AS (SELECT new_id, u, s, regexp_replace(split_part(u, '#', 1), '^\s+|\s+$', '', 'g') AS t FROM a),
c AS (SELECT new_id, u, s, t, regexp_extract(t, '^(.*?://[^/?]*)', 1, 's') AS h FROM b),
d AS (SELECT new_id, u, s, lower(h) || substr(t, length(h) + 1) AS k FROM c),
e AS (SELECT new_id, CASE WHEN k <> '' THEN substr(md5(k), 1, 16)
                          WHEN u IS NULL AND s IS NOT NULL THEN printf('%016x', CAST(CASE WHEN s < 0 THEN CAST(s AS HUGEINT) + 18446744073709551616 ELSE s END AS UBIGINT)) END AS k FROM d)
"""

_P6 = """
WITH once AS (SELECT DISTINCT info_id, host, link_from, CAST(make_timestamp(crawl_timestamp) AS DATE) AS day,
                     crawl_time, connect_time, donwload_speed, CAST(response_code AS DOUBLE) AS response_code FROM crawl_info),
long AS (UNPIVOT once ON crawl_time, connect_time, donwload_speed, response_code INTO NAME metric VALUE value),
ok AS (SELECT host, link_from, day, metric, list_sort(list(value)) AS v, count(*) AS n FROM long
       WHERE value >= 0 AND NOT isinf(value) AND NOT isnan(value) GROUP BY ALL)
SELECT host, link_from, day, metric, n, v[(n * 50 + 99) // 100] AS p50, v[(n * 90 + 99) // 100] AS p90,
       v[(n * 99 + 99) // 100] AS p99 FROM ok
"""

QUERIES = {
    "p1_found": p1_found,
    "p1_wrong": p1_wrong,
    "p3_found": p3_found,
    "p3_damaged": p3_damaged,
    "p4_found": p4_found,
    "p4_reasons": p4_reasons,
    "p4_kept": p4_kept,
    "p6_percentiles": p6_percentiles,
    "p6_host_days": p6_host_days,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p9_found": p9_found,
    "p9_redacted": p9_redacted,
}

ORACLE = {
    "p1_found": _KEYS
    + """SELECT new_id FROM (SELECT new_id, row_number() OVER (PARTITION BY k ORDER BY new_id) AS r FROM e WHERE k IS NOT NULL)
WHERE new_id > 0 AND r > 1""",
    "p6_percentiles": _P6,
}
