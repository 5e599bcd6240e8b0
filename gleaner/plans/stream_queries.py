"""Streams (148-167) over the files that are there now."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import urls
from gleaner.operators import joins
from gleaner.plans.base import HASH_SQL, host_sql, query
from gleaner.sources import table
from gleaner.streaming import jobs, limiter

BLACK = "luomei-mall|calderon"


@query(f"SELECT job_id, url FROM crawl_job WHERE regexp_matches(lower(url), '^https?://') AND {host_sql('url')} <> '' AND NOT regexp_matches(url, '{BLACK}')")
def r148_stream_ingest(spark, d):
    return jobs.run(jobs.ingest(jobs.read_stream(spark, d, "crawl_job"), BLACK).select("job_id", "url"), "ingest")


@query()
def r149_stream_dedup(spark, d):
    s = jobs.dedup_within(jobs.read_stream(spark, d, "crawl_job"), "arrived_ts", "30 days")
    return jobs.run(s.select("dedup", "job_id"), "dedup")


@query()
def r150_stream_dedup_refreshing(spark, d):
    s = jobs.read_stream(spark, d, "crawl_job").filter("url <> ''")
    return jobs.run(jobs.dedup_refreshing(s, F.col("url"), "arrived_ts", "job_id", 3600), "refreshing").drop("ts")


@query(
    """SELECT j.job_id FROM crawl_job j LEFT JOIN (SELECT clicked_url AS url, max(latest_crawl_timestamp) AS at FROM crawl_status WHERE is_crawled AND clicked_url IS NOT NULL GROUP BY 1) s ON j.url = s.url
WHERE NOT coalesce(epoch_us(j.arrived_ts) - s.at < 86400000000 AND s.at <= epoch_us(j.arrived_ts), false)"""
)
def r151_stream_revisit(spark, d):
    s = table(spark, d, "crawl_status").filter("is_crawled AND clicked_url IS NOT NULL")
    status = s.groupBy(F.col("clicked_url").alias("url")).agg(F.max("latest_crawl_timestamp").alias("at"))
    stream = jobs.read_stream(spark, d, "crawl_job").select("job_id", "url", "arrived_ts")
    return jobs.run(jobs.not_revisited(stream, status, joins.micros("arrived_ts")).select("job_id"), "revisit")


@query("SELECT job_id, s AS score, CASE WHEN s * 1000 >= 500 THEN h % 10 WHEN s * 1000 >= 100 THEN 10 + h % 20 WHEN s * 1000 >= 10 THEN 30 + h % 20 ELSE 50 + h % 50 END AS slot FROM (SELECT job_id, coalesce(importance, 0.5) AS s, " + HASH_SQL.format("url") + " AS h FROM crawl_job) WHERE s >= 0.01")
def r152_stream_score(spark, d):
    return jobs.run(jobs.scored(jobs.read_stream(spark, d, "crawl_job")).select("job_id", "score", "slot"), "score")


@query(
    f"""SELECT job_id, ({HASH_SQL.format("w")} % 1048576 + {HASH_SQL.format("url")} % 3) % 16 AS queue FROM (SELECT job_id, url, coalesce(nullif(ip, ''), {host_sql('url')}) AS w FROM crawl_job)"""
)
def r153_stream_dispatch(spark, d):
    return jobs.run(jobs.dispatch(jobs.read_stream(spark, d, "crawl_job"), 16).select("job_id", "queue"), "dispatch")


@query()
def r154_rate_limiter(spark, d):
    j = table(spark, d, "crawl_job").filter("ip <> ''")
    return limiter.simulate(j, "ip", "arrived_ts", "job_id", fetch_s=30, rules=[limiter.Rule(3, 0.01)], burst=2)


@query("SELECT job_id FROM crawl_job WHERE epoch_us(arrived_ts) - epoch_us(submitted_ts) <= 240000000")
def r155_stream_timeout(spark, d):
    return jobs.run(jobs.in_time(jobs.read_stream(spark, d, "crawl_job"), "submitted_ts", "arrived_ts").select("job_id"), "timeout")


@query(
    """SELECT info_id, CASE WHEN again THEN 'request' ELSE 'result' END AS target, CASE WHEN again THEN tries + 1 ELSE tries END AS tries FROM
(SELECT info_id, coalesce(update_fail_times, 0) AS tries, coalesce(update_fail_times, 0) < 2 AND NOT coalesce(response_code IN (200, 404), false) AS again FROM crawl_info)"""
)
def r156_stream_retries(spark, d):
    s = jobs.read_stream(spark, d, "crawl_info").select("info_id", "response_code", F.coalesce("update_fail_times", F.lit(0)).alias("tries"))
    return jobs.run(jobs.route(s).select("info_id", "target", "tries"), "retries")


@query("SELECT job_id FROM crawl_job WHERE submitted_ts >= TIMESTAMP '2014-07-02'")
def r157_late_rule(spark, d):
    return jobs.run(jobs.read_stream(spark, d, "crawl_job").filter("submitted_ts >= TIMESTAMP_NTZ '2014-07-02'").select("job_id"), "late")


@query("SELECT time_bucket(INTERVAL 10 MINUTE, arrived_ts) AS start, count(*) AS n FROM crawl_job GROUP BY 1")
def r158_stream_windows(spark, d):
    """Tumbling windows; read as a batch so that the last windows, which a watermark would hold back, are there."""
    j = table(spark, d, "crawl_job").groupBy(F.window("arrived_ts", "10 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return j.select("w.start", "n")


@query(
    f"SELECT DISTINCT clicked_url AS url, depth + 1 AS depth FROM new_url WHERE clicked_url <> '' AND depth < 5 AND regexp_matches({host_sql('clicked_url')}, '^(shop|news)\\.')"
)
def r159_extractor(spark, d):
    """Links of results become new urls, bounded in depth, by a pattern of the site."""
    u = F.col("clicked_url")
    s = table(spark, d, "new_url").filter((u != "") & (F.col("depth") < 5) & urls.host(u).rlike(r"^(shop|news)\."))
    return s.select(u.alias("url"), (F.col("depth") + 1).alias("depth")).distinct()


@query(
    """SELECT p.job_id, count(c.url) AS parts, count(*) FILTER (c.url IS NULL) AS missing FROM (SELECT DISTINCT job_id, url FROM crawl_job WHERE resource_type = 1) p
LEFT JOIN (SELECT DISTINCT url, referer FROM crawl_job WHERE resource_type IN (2, 3) AND referer IS NOT NULL) c ON c.referer = p.url GROUP BY p.job_id"""
)
def r160_sub_resources(spark, d):
    """Style sheets and images attached to the page that refers to them; each is read once."""
    j = table(spark, d, "crawl_job")
    parents = j.filter("resource_type = 1").select("job_id", "url").distinct()
    parts = j.filter("resource_type IN (2, 3) AND referer IS NOT NULL").select(F.col("url").alias("part"), F.col("referer").alias("url")).distinct()
    per = parts.groupBy("url").agg(F.count(F.lit(1)).alias("parts"))  # before the join: a hot page keeps one row
    return parents.join(per, "url", "left").groupBy("job_id").agg(
        F.coalesce(F.sum("parts"), F.lit(0)).alias("parts"), F.count_if(F.col("parts").isNull()).alias("missing")
    )


@query("SELECT job_id, to_json({'url': url, 'tries': tried_times}) AS job FROM crawl_job")
def r165_task_push(spark, d):
    return table(spark, d, "crawl_job").select("job_id", F.to_json(F.struct("url", F.col("tried_times").alias("tries"))).alias("job"))


@query("SELECT a.archive_id, a.title, coalesce(n.score, 0) AS news_score FROM archive_data a LEFT JOIN (SELECT host, count(*) + 1 AS score FROM archive_data WHERE host LIKE 'news.%' GROUP BY host) n ON a.host = n.host")
def r167_composite_document(spark, d):
    a = table(spark, d, "archive_data")
    news = a.filter("host LIKE 'news.%'").groupBy("host").agg((F.count(F.lit(1)) + 1).alias("score"))
    met = a.join(news, "host", "left")
    doc = met.select("archive_id", F.struct("title", F.coalesce("score", F.lit(0)).alias("news_score")).alias("doc"))
    return doc.select("archive_id", "doc.title", "doc.news_score")
