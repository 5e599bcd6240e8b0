"""Aggregations and deduplication (66-93)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleaner.functions import urls
from gleaner.operators import joins
from gleaner.plans.base import HASH_SQL, PV, SEARCH, host_sql, pv_log, query, search_log
from gleaner.sources import table


@query("SELECT event_type AS query, count(DISTINCT user_id) AS uv FROM events GROUP BY event_type")
def r066_query_uv(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("query")).agg(F.countDistinct("user_id").alias("uv"))


@query("SELECT query, se AS site, count(DISTINCT mid) AS uv FROM s GROUP BY query, se HAVING count(DISTINCT mid) > 1", SEARCH)
def r067_vertical_query_uv(spark, d):
    per = search_log(spark, d).groupBy("query", F.col("se").alias("site")).agg(F.countDistinct("mid").alias("uv"))
    return per.filter("uv > 1")


@query(
    """SELECT query, count(DISTINCT id) AS ids FROM (SELECT query, CAST(mid AS VARCHAR) AS id FROM s
UNION ALL SELECT 'q' || (value::BIGINT % 97), 'e' || user_id FROM events WHERE value IS NOT NULL AND value = floor(value)) GROUP BY query""",
    SEARCH,
)
def r068_query_count_two_sources(spark, d):
    v = F.col("value")
    ev = table(spark, d, "events").filter(v.isNotNull() & (v == F.floor(v)))
    ev = ev.select(F.concat(F.lit("q"), v.cast("bigint") % 97).alias("query"), F.concat(F.lit("e"), F.col("user_id")).alias("id"))
    logs = search_log(spark, d).select("query", F.col("mid").cast("string").alias("id"))
    return logs.unionByName(ev).groupBy("query").agg(F.countDistinct("id").alias("ids"))


@query(
    """SELECT k AS query, class, count(DISTINCT user_id) AS users FROM (SELECT user_id, json_extract_string(props, '$.k') AS k,
CASE WHEN event_type IN ('view','click') THEN 'browse' WHEN event_type = 'purchase' THEN 'shop' ELSE 'other' END AS class FROM events) GROUP BY k, class"""
)
def r069_query_vertical_click(spark, d):
    t = F.col("event_type")
    kind = F.when(t.isin("view", "click"), "browse").when(t == "purchase", "shop").otherwise("other")
    ev = table(spark, d, "events").select("user_id", F.get_json_object("props", "$.k").alias("query"), kind.alias("class"))
    return ev.groupBy("query", "class").agg(F.countDistinct("user_id").alias("users"))


@query(
    """SELECT url, se, query, CAST(sum(n) AS BIGINT) AS count FROM (SELECT url, se, query, 1 AS n FROM s WHERE ts >= TIMESTAMP '1997-01-01'
UNION ALL SELECT url, se, query, count(*) FROM s WHERE ts < TIMESTAMP '1997-01-01' GROUP BY ALL) GROUP BY url, se, query""",
    SEARCH,
)
def r070_url_query_incremental(spark, d):
    log = search_log(spark, d).select("url", "se", "query", "ts")
    history = log.filter("ts < TIMESTAMP '1997-01-01'").groupBy("url", "se", "query").agg(F.count(F.lit(1)).alias("n"))
    today = log.filter("ts >= TIMESTAMP '1997-01-01'").select("url", "se", "query", F.lit(1).cast("bigint").alias("n"))
    return history.unionByName(today).groupBy("url", "se", "query").agg(F.sum("n").alias("count"))


@query(
    """SELECT url, query, n, CAST(row_number() OVER (PARTITION BY url ORDER BY n DESC, query) AS BIGINT) AS place
FROM (SELECT url, query, count(*) AS n FROM s WHERE se IN ('A', 'R') GROUP BY url, query)""",
    SEARCH,
)
def r071_url_query_counts_sorted(spark, d):
    n = search_log(spark, d).filter(F.col("se").isin("A", "R")).groupBy("url", "query").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy("url").orderBy(F.desc("n"), "query")).cast("bigint"))


@query("SELECT url, ref_url, count(*) AS n FROM pv WHERE ref_url <> '' GROUP BY url, ref_url", PV)
def r072_url_ref_pairs(spark, d):
    return pv_log(spark, d).filter("ref_url <> ''").groupBy("url", "ref_url").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT host, n // 2 AS daily FROM (SELECT {host_sql('url')} AS host, count(*) AS n FROM pv GROUP BY ALL) WHERE n // 2 >= 6", PV)
def r073_site_pv_daily(spark, d):
    """Page views per host over days + 1 (here 1 + 1), whole numbers, from 6."""
    n = pv_log(spark, d).groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("host", F.expr("n div 2").alias("daily")).filter("daily >= 6")


_HOSTS = f"h AS (SELECT host, count(*) AS n, avg(crawl_time) FILTER (crawl_time >= 0 AND NOT isinf(crawl_time) AND NOT isnan(crawl_time)) AS load FROM crawl_info WHERE host IS NOT NULL GROUP BY host)"


@query("SELECT host, n, round(n / coalesce(load, 3) + 1e-9, 4) AS seconds FROM h", _HOSTS)
def r074_host_load_time(spark, d):
    ok = "crawl_time >= 0 AND crawl_time < double('Infinity') AND NOT isnan(crawl_time)"
    per = table(spark, d, "crawl_info").filter("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"avg(crawl_time) FILTER (WHERE {ok})").alias("load")
    )
    return per.select("host", "n", F.round(F.col("n") / F.coalesce("load", F.lit(3)) + 1e-9, 4).alias("seconds"))


@query(
    """SELECT ip, count(*) AS n, sum(tried_times) AS load, round(count(*) / nullif(sum(tried_times), 0) + 1e-9, 6) AS ratio
FROM crawl_job WHERE ip <> '' GROUP BY ip"""
)
def r075_ip_load_time(spark, d):
    per = table(spark, d, "crawl_job").filter("ip <> ''").groupBy("ip").agg(F.count(F.lit(1)).alias("n"), F.sum("tried_times").alias("load"))
    return per.withColumn("ratio", F.round(F.try_divide("n", "load") + 1e-9, 6))


@query(
    """SELECT host, count(*) AS total, count(*) FILTER (response_code = 200) AS success, count(*) FILTER (response_code <> 200) AS fail,
round(count(*) FILTER (response_code <> 200) / count(*) + 1e-9, 6) AS fail_ratio FROM crawl_info GROUP BY host"""
)
def r076_host_success(spark, d):
    fail = F.count_if(F.col("response_code") != 200)
    return table(spark, d, "crawl_info").groupBy("host").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("response_code") == 200).alias("success"),
        fail.alias("fail"),
        F.round(fail / F.count(F.lit(1)) + 1e-9, 6).alias("fail_ratio"),
    )


@query(
    f"""SELECT ip, count(*) AS total, count(*) FILTER (tried_times = 0) AS first_tries, count(DISTINCT {host_sql('url')}) AS hosts,
array_to_string(list_sort(list(DISTINCT {host_sql('url')}))[1:5], ' ') AS sample FROM crawl_job WHERE ip <> '' GROUP BY ip"""
)
def r077_status_by_ip(spark, d):
    """Sample hosts are the first five by name: hosts per ip are combined before they are listed."""
    jobs = table(spark, d, "crawl_job").filter("ip <> ''").select("ip", urls.host(F.col("url")).alias("host"), "tried_times")
    per = jobs.groupBy("ip", "host").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tried_times") == 0).alias("f"))
    w = Window.partitionBy("ip").orderBy("host")
    ranked = per.withColumn("r", F.row_number().over(w))
    return ranked.groupBy("ip").agg(
        F.sum("n").alias("total"),
        F.sum("f").alias("first_tries"),
        F.count("host").alias("hosts"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("r") <= 5, F.col("host")))), " ").alias("sample"),
    )


@query("SELECT DISTINCT url FROM crawl_job WHERE NOT use_proxy")
def r078_directly_crawled(spark, d):
    return table(spark, d, "crawl_job").filter(~F.col("use_proxy")).select("url").distinct()


@query(f"SELECT {host_sql('url')} AS host, count(*) AS n FROM crawl_info GROUP BY ALL ORDER BY n DESC, host")
def r079_site_crawl_counts(spark, d):
    n = table(spark, d, "crawl_info").groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))
    return n.orderBy(F.desc("n"), "host")


@query("SELECT ref_url AS hub, count(DISTINCT url) AS links FROM pv WHERE ref_url <> '' GROUP BY ref_url HAVING count(DISTINCT url) >= 5", PV)
def r080_hub_pages(spark, d):
    n = pv_log(spark, d).filter("ref_url <> ''").groupBy(F.col("ref_url").alias("hub")).agg(F.countDistinct("url").alias("links"))
    return n.filter("links >= 5")


_WEIGHT = f"CASE WHEN {host_sql('ref_url')} LIKE 'wiki.%' THEN 10.0 WHEN {host_sql('url')} LIKE 'wiki.%' THEN 5.0 WHEN regexp_matches({host_sql('url')}, '^(bbs|blog|forum)\\.') THEN 0.4 ELSE 1.0 END"


@query(
    f"""SELECT url, round(sum(w), 4) AS uv, max(ref) AS ref FROM (SELECT mid, url, max({_WEIGHT}) AS w, max(ref_url) AS ref FROM pv GROUP BY mid, url)
GROUP BY url HAVING sum(w) > 1.99 AND url NOT IN (SELECT clicked_url FROM crawl_status WHERE is_crawled AND clicked_url IS NOT NULL)""",
    PV,
)
def r081_url_uv_score(spark, d):
    """Per user the largest weight of a url, summed over users; recently crawled urls left out; from 1.99."""
    h, ref = urls.host(F.col("url")), urls.host(F.col("ref_url"))
    weight = F.when(ref.startswith("wiki."), 10.0).when(h.startswith("wiki."), 5.0).when(h.rlike(r"^(bbs|blog|forum)\."), 0.4).otherwise(1.0)
    user = pv_log(spark, d).groupBy("mid", "url").agg(F.max(weight).alias("w"), F.max("ref_url").alias("ref"))
    crawled = table(spark, d, "crawl_status").filter("is_crawled").select(F.col("clicked_url").alias("url"))
    score = user.groupBy("url").agg(F.sum("w").alias("uv"), F.max("ref").alias("ref")).filter("uv > 1.99")
    return score.join(crawled, "url", "left_anti").select("url", F.round("uv", 4).alias("uv"), "ref")


@query("SELECT lower(trim(url)) AS url, count(*) AS uv, min(job_id) AS first_job FROM crawl_job GROUP BY ALL")
def r082_normalised_uv(spark, d):
    key = F.lower(F.trim("url")).alias("url")
    return table(spark, d, "crawl_job").groupBy(key).agg(F.count(F.lit(1)).alias("uv"), F.min("job_id").alias("first_job"))


@query("SELECT DISTINCT url FROM archive_data WHERE url IS NOT NULL")
def r083_distinct_page_urls(spark, d):
    return table(spark, d, "archive_data").filter("url IS NOT NULL").select("url").distinct()


@query(
    """SELECT r.url, r.ts, r.fails + coalesce(sum(c.n), 0)::BIGINT AS fails FROM r LEFT JOIN c ON r.url = c.url AND c.ts >= r.ts
GROUP BY r.url, r.ts, r.fails HAVING NOT coalesce(bool_or(c.d), false) AND r.fails + coalesce(sum(c.n), 0) < 3""",
    """r AS (SELECT url, max(crawl_timestamp) AS ts, arg_max(coalesce(update_fail_times, 0), (crawl_timestamp, coalesce(update_fail_times, -1)))::BIGINT AS fails FROM crawl_info WHERE crawl_timestamp > 0 GROUP BY url),
c AS (SELECT clicked_url AS url, latest_crawl_timestamp AS ts, bool_or(NOT is_crawled) AS d, count(*) FILTER (is_crawled AND successive_failed_times > 0) AS n
FROM crawl_status WHERE clicked_url IS NOT NULL GROUP BY clicked_url, latest_crawl_timestamp)""",
)
def r084_latest_with_commands(spark, d):
    rows = table(spark, d, "crawl_info").select("url", F.col("crawl_timestamp").alias("ts"), F.col("update_fail_times").alias("fails"))
    s = table(spark, d, "crawl_status").filter("clicked_url IS NOT NULL")
    cmd = F.when(~F.col("is_crawled"), "D").when(F.col("successive_failed_times") > 0, "R").otherwise("-")
    commands = s.select(F.col("clicked_url").alias("url"), F.col("latest_crawl_timestamp").alias("ts"), cmd.alias("cmd"))
    return joins.latest_with_commands(rows, commands, "url", "ts", "cmd", "fails")


@query(
    "SELECT url, max(crawl_timestamp) AS latest, nullif(CAST(arg_max(coalesce(response_code, -9), (crawl_timestamp, info_id)) AS BIGINT), -9) AS response_code FROM crawl_info GROUP BY url"
)
def r085_latest_page(spark, d):
    at = F.struct("crawl_timestamp", "info_id")
    return table(spark, d, "crawl_info").groupBy("url").agg(F.max("crawl_timestamp").alias("latest"), F.max_by("response_code", at).alias("response_code"))


@query(
    f"""SELECT url, CASE WHEN file_timestamp > 0 THEN file_timestamp ELSE crawl_timestamp END AS changed FROM crawl_info
WHERE content_type LIKE 'text/html%' AND {HASH_SQL.format('url')} % 16 BETWEEN 0 AND 7"""
)
def r086_update_candidates(spark, d):
    """Pages of a range of shards with their last change: the file's time, else the crawl's."""
    c = table(spark, d, "crawl_info").filter(F.col("content_type").startswith("text/html") & urls.shard(F.col("url"), 16).between(0, 7))
    return c.select("url", F.when(F.col("file_timestamp") > 0, F.col("file_timestamp")).otherwise(F.col("crawl_timestamp")).alias("changed"))


@query("SELECT url, string_agg(m || ':' || t, ',' ORDER BY m) AS md5_times FROM (SELECT url, md5(url || '#' || priority) AS m, max(job_id) AS t FROM crawl_job GROUP BY ALL) GROUP BY url")
def r087_md5_map(spark, d):
    """Latest time of each md5 of a url, as one list; md5s of a url are few (one per form of it)."""
    m = F.md5(F.concat_ws("#", "url", "priority")).alias("m")
    latest = table(spark, d, "crawl_job").groupBy("url", m).agg(F.max("job_id").alias("t"))
    return latest.groupBy("url").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "m", "t"))), ",").alias("md5_times"))


@query("SELECT mid, ts, url FROM pv", PV)
def r088_pv_sort_combine(spark, d):
    """Page views clustered by user and sorted by time within the user."""
    return pv_log(spark, d).select("mid", "ts", "url").repartition("mid").sortWithinPartitions("mid", "ts")


@query(
    f"""SELECT ip, sum(n)::BIGINT AS urls, count(*) AS hosts, array_to_string(list(host || '=' || n ORDER BY n DESC, host)[1:3], ' ') AS top
FROM (SELECT ip, {host_sql('url')} AS host, count(*) AS n FROM crawl_job WHERE ip <> '' GROUP BY ALL) GROUP BY ip"""
)
def r089_ip_hosts(spark, d):
    per = table(spark, d, "crawl_job").filter("ip <> ''").groupBy("ip", urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))
    r = per.withColumn("r", F.row_number().over(Window.partitionBy("ip").orderBy(F.desc("n"), "host")))
    top = F.transform(F.array_sort(F.collect_list(F.when(F.col("r") <= 3, F.struct("r", "host", "n")))), lambda x: F.concat_ws("=", x["host"], x["n"]))
    return r.groupBy("ip").agg(F.sum("n").alias("urls"), F.count(F.lit(1)).alias("hosts"), F.array_join(top, " ").alias("top"))


@query(
    "SELECT query, url, se, arg_max(rank, (ts, sid, rank)) AS rank, count(*) AS show, count(*) FILTER (rank = 1) AS click FROM s WHERE se IN ('A', 'R') GROUP BY query, url, se",
    SEARCH,
)
def r090_train_data(spark, d):
    return search_log(spark, d).filter(F.col("se").isin("A", "R")).groupBy("query", "url", "se").agg(
        F.max_by("rank", F.struct("ts", "sid", "rank")).alias("rank"),
        F.count(F.lit(1)).alias("show"),
        F.count_if(F.col("rank") == 1).alias("click"),
    )


@query(
    "SELECT query, se, rank, arg_max(url, (n, url)) AS url FROM (SELECT query, se, rank, url, count(*) AS n FROM s GROUP BY ALL) GROUP BY query, se, rank",
    SEARCH,
)
def r091_most_frequent_url(spark, d):
    n = search_log(spark, d).groupBy("query", "se", "rank", "url").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("query", "se", "rank").agg(F.max_by("url", F.struct("n", "url")).alias("url"))


@query(
    """SELECT host, count(*) AS pages, count(*) FILTER (ok) AS success, count(*) FILTER (NOT ok) AS fail, round(count(*) FILTER (ok) / count(*) + 1e-9, 6) AS rate
FROM (SELECT url, max(host) AS host, bool_or(coalesce(response_code = 200, false)) AS ok FROM crawl_info GROUP BY url) GROUP BY host"""
)
def r092_page_evaluation(spark, d):
    """Per site the pages that were fetched at least once, as a true ratio."""
    ok = F.bool_or(F.coalesce(F.col("response_code") == 200, F.lit(False)))
    page = table(spark, d, "crawl_info").groupBy("url").agg(F.max("host").alias("host"), ok.alias("ok"))
    return page.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if("ok").alias("success"),
        F.count_if(~F.col("ok")).alias("fail"),
        F.round(F.count_if("ok") / F.count(F.lit(1)) + 1e-9, 6).alias("rate"),
    )


@query(
    """SELECT url, CASE WHEN a AND r THEN 1 WHEN a THEN 2 WHEN r THEN 3 ELSE 4 END AS level FROM
(SELECT url, bool_or(se = 'A') AS a, bool_or(se = 'R') AS r, count(DISTINCT mid) AS uv FROM s GROUP BY url) WHERE a OR r OR uv >= 30""",
    SEARCH,
)
def r093_level_voting(spark, d):
    """1 shown by both engines, 2 and 3 by one, 4 by users alone."""
    per = search_log(spark, d).groupBy("url").agg(F.bool_or(F.col("se") == "A").alias("a"), F.bool_or(F.col("se") == "R").alias("r"), F.countDistinct("mid").alias("uv"))
    level = F.when(F.col("a") & F.col("r"), 1).when(F.col("a"), 2).when(F.col("r"), 3).otherwise(4)
    return per.filter("a OR r OR uv >= 30").select("url", level.alias("level"))
