"""Ranking, top-N, scheduling and sessions (94-107), small jobs (168-185)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleaner.functions import urls
from gleaner.operators import matching, ranged, topn
from gleaner.plans.base import HASH_SQL, PV, SEARCH, host_sql, pv_log, query, search_log
from gleaner.sources import table

_SCORED = "w AS (SELECT query, CASE WHEN se IN ('A', 'R') THEN se ELSE 'Other' END AS se, url, sum(greatest(12 - rank, 1))::BIGINT AS score FROM s GROUP BY ALL)"


def _scored(spark, d):
    se = F.when(F.col("se").isin("A", "R"), F.col("se")).otherwise("Other").alias("se")
    return search_log(spark, d).groupBy("query", se, "url").agg(F.sum(F.greatest(12 - F.col("rank"), F.lit(1))).cast("bigint").alias("score"))


@query(
    "SELECT query, se, url, CAST(r AS BIGINT) AS place, score FROM (SELECT *, row_number() OVER (PARTITION BY query, se ORDER BY score DESC, url DESC) AS r FROM w) WHERE r <= 200",
    f"{SEARCH}, {_SCORED}",
)
def r094_top_by_score(spark, d):
    best = topn.top(_scored(spark, d), ["query", "se"], [F.desc("score"), F.desc("url")], 200)
    return best.select("query", "se", "url", F.col("place").cast("bigint").alias("place"), "score")


@query(
    """SELECT query, se, string_agg(md5(url) || '=' || least(score, 2147483647), ' ' ORDER BY score DESC, url DESC) AS urls
FROM (SELECT *, row_number() OVER (PARTITION BY query, se ORDER BY score DESC, url DESC) AS r FROM w) WHERE r <= 50 GROUP BY query, se""",
    f"{SEARCH}, {_SCORED}",
)
def r095_top_as_record(spark, d):
    """The first fifty as one record per query and engine, with url signs and saturated counts."""
    best = topn.top(_scored(spark, d), ["query", "se"], [F.desc("score"), F.desc("url")], 50)
    item = F.struct("place", F.concat_ws("=", F.md5("url"), F.least("score", F.lit(2147483647))).alias("v"))
    return best.groupBy("query", "se").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]), " ").alias("urls"))


@query(
    "SELECT url, query, n FROM (SELECT url, query, count(*) AS n, row_number() OVER (PARTITION BY url ORDER BY count(*) DESC, query) AS r FROM s GROUP BY url, query) WHERE r <= 3",
    SEARCH,
)
def r096_heap_top(spark, d):
    n = search_log(spark, d).groupBy("url", "query").agg(F.count(F.lit(1)).alias("n"))
    return topn.top(n, ["url"], [F.desc("n"), F.asc("query")], 3).drop("place")


@query("SELECT mid, ts, url, id FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, id, url) AS r FROM pv) WHERE r <= 100", PV)
def r097_first_100(spark, d):
    return topn.top(pv_log(spark, d), ["mid"], [F.asc("ts"), F.asc("id"), F.asc("url")], 100).select("mid", "ts", "url", "id")


_CAPACITY = f"""k AS (SELECT host, greatest(1, CAST(floor((count(*) // 15) * 0.5) AS BIGINT)) AS k FROM (SELECT {host_sql('url')} AS host FROM crawl_job) GROUP BY host),
u AS (SELECT url, min(resource_type) AS type, min(priority) AS pri, {host_sql('url')} AS host FROM crawl_job GROUP BY url)"""


@query(
    "SELECT url, host, type FROM (SELECT u.*, k.k, row_number() OVER (PARTITION BY u.host, type = 1 ORDER BY type, pri, length(url), url) AS r FROM u LEFT JOIN k ON u.host = k.host) WHERE type <> 1 OR k IS NULL OR r <= k",
    _CAPACITY,
)
def r098_capacity_top(spark, d):
    """K per host from its page views and connections; other types than pages bypass."""
    j = table(spark, d, "crawl_job")
    k = j.groupBy(urls.host(F.col("url")).alias("host")).agg(F.greatest(F.lit(1), F.floor(F.expr("count(1) div 15") * 0.5)).alias("k"))
    u = j.groupBy("url").agg(F.min("resource_type").alias("type"), F.min("priority").alias("pri")).withColumn("host", urls.host(F.col("url")))
    x = u.join(k, "host", "left").withColumn("page", F.col("type") == 1).withColumn("size", F.length("url"))
    r = ranged.numbered(x, ["host", "page"], ["type", "pri", "size", "url"], "r")
    return r.filter("type <> 1 OR k IS NULL OR r <= k").select("url", "host", "type")


@query(
    f"""SELECT url, ip, CASE WHEN {host_sql('url')} LIKE 'cdn.%' OR r > 20 THEN 'PROXY' ELSE 'DIRECT' END AS way FROM
(SELECT ip, url, row_number() OVER (PARTITION BY ip ORDER BY url) AS r FROM (SELECT DISTINCT ip, url FROM crawl_job WHERE ip <> ''))"""
)
def r099_direct_or_proxy(spark, d):
    u = table(spark, d, "crawl_job").filter("ip <> ''").select("ip", "url").distinct()
    first = topn.top(u, ["ip"], [F.col("url")], 20, "r")  # cut before the shuffle, so a busy address is small
    way = F.when(urls.host(F.col("url")).startswith("cdn.") | F.col("r").isNull(), "PROXY").otherwise("DIRECT")
    return u.join(first, ["ip", "url"], "left").select("url", "ip", way.alias("way"))


@query(
    f"SELECT url, host, CAST((r - 1) // 40 AS BIGINT) AS task FROM (SELECT url, host, row_number() OVER (PARTITION BY host ORDER BY url) AS r FROM (SELECT DISTINCT url, {host_sql('url')} AS host FROM crawl_job))"
)
def r100_task_buckets(spark, d):
    u = table(spark, d, "crawl_job").select("url").distinct().withColumn("host", urls.host(F.col("url")))
    return ranged.numbered(u, ["host"], ["url"], "r").select("url", "host", F.expr("(r - 1L) div 40").alias("task"))


@query(
    f"""SELECT job_id, f.fetcher, CAST((r - 1) // 10 AS BIGINT) AS batch FROM (SELECT job_id, ip, {HASH_SQL.format('ip')} % 43 AS fetcher,
row_number() OVER (PARTITION BY ip ORDER BY job_id) AS r FROM (SELECT DISTINCT job_id, ip FROM crawl_job WHERE ip <> '')) f"""
)
def r101_fetcher_of_key(spark, d):
    j = table(spark, d, "crawl_job").filter("ip <> ''").select("job_id", "ip").distinct()
    r = ranged.numbered(j, ["ip"], ["job_id"], "r")
    return r.select("job_id", urls.shard(F.col("ip"), 43).alias("fetcher"), F.expr("(r - 1L) div 10").alias("batch"))


_NODES = """a AS (SELECT ip, count(*) AS load FROM crawl_job WHERE ip <> '' GROUP BY ip),
b AS (SELECT ip, load, sum(load) OVER (ORDER BY load DESC, ip) - load AS before, row_number() OVER (ORDER BY load DESC, ip) - 1 AS i, (SELECT sum(load) FROM a) / 43.0 AS average FROM a),
c AS (SELECT ip, load, i, min(CAST(floor(before / average) AS BIGINT) - i) OVER (ORDER BY i) AS low FROM b)"""


@query("SELECT ip, load, CAST(greatest(0, least(i + least(low, 0), 42)) AS INTEGER) AS node FROM c", _NODES)
def r102_cumulative_load(spark, d):
    per = table(spark, d, "crawl_job").filter("ip <> ''").groupBy("ip").agg(F.count(F.lit(1)).alias("load"))
    return topn.cumulative_nodes(per, "load", "ip", 43)


@query("SELECT node, CAST(sum(load) AS BIGINT) AS urls FROM (SELECT load, greatest(0, least(i + least(low, 0), 42)) AS node FROM c) GROUP BY node", _NODES)
def r169_nodes_by_count(spark, d):
    return r102_cumulative_load(spark, d).groupBy("node").agg(F.sum("load").alias("urls"))


@query("SELECT sid, mid, ts, rank, url, row_number() OVER (PARTITION BY sid ORDER BY mid, ts, rank, url) AS place FROM s", SEARCH)
def r103_secondary_sort(spark, d):
    """Rows of a page in order, with their place."""
    s = search_log(spark, d).select("sid", "mid", "ts", "rank", "url")
    return ranged.numbered(s, ["sid"], ["mid", "ts", "rank", "url"], "place")


@query("SELECT url, n, row_number() OVER (ORDER BY n DESC, url) AS place FROM (SELECT url, count(*) AS n FROM crawl_job GROUP BY url)")
def r104_global_sort(spark, d):
    """All urls by falling count, with their place in the order."""
    n = table(spark, d, "crawl_job").groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    return ranged.numbered(n, [], [F.desc("n"), F.col("url").asc_nulls_last()], "place")


@query("SELECT job_id, importance, row_number() OVER (ORDER BY importance DESC, job_id) AS place FROM crawl_job WHERE importance IS NOT NULL")
def r171_sort_by_double(spark, d):
    """Jobs by falling importance, with their place in the order; repeated rows are alike, so their order doesn't show."""
    j = table(spark, d, "crawl_job").filter("importance IS NOT NULL").select("job_id", "importance")
    return ranged.numbered(j, [], [F.desc("importance"), "job_id"], "place")


@query(
    """SELECT id, mid, session, md5(mid || chr(9) || strftime(min(ts) OVER (PARTITION BY mid, session), '%Y%m%d%H%M%S') || chr(9) || session) AS signature FROM
(SELECT *, CAST(sum(n) OVER (PARTITION BY mid ORDER BY ts, id, url) AS BIGINT) AS session FROM (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY mid ORDER BY ts, id, url) > 1800000000 THEN 1 ELSE 0 END AS n
FROM (SELECT DISTINCT * FROM pv)))""",
    PV,
)
def r107_gap_sessions(spark, d):
    """Sessions by gaps alone, with their signatures."""
    s = matching.session_id(pv_log(spark, d).distinct(), "mid", "ts", 1800, ["id", "url"])
    return s.select("id", "mid", F.col("session").cast("bigint").alias("session"), "signature")


@query()
def r105_page_sessions(spark, d):
    return matching.page_sessions(pv_log(spark, d).distinct())


@query()
def r106_search_sessions(spark, d):
    ev = table(spark, d, "events").select("user_id", "ts", "event_id", F.concat_ws(" ", "event_type", F.get_json_object("props", "$.k")).alias("query"))
    return matching.search_sessions(ev, "user_id", "ts", "query", ["event_id"]).select("event_id", "user_id", "session")


@query(f"SELECT url, {HASH_SQL.format('url')} % 43 AS fetcher FROM (SELECT DISTINCT url FROM crawl_job)")
def r123_shard(spark, d):
    return table(spark, d, "crawl_job").select("url").distinct().withColumn("fetcher", urls.shard(F.col("url"), 43))


@query(f"SELECT DISTINCT {host_sql('url')} AS host FROM crawl_job")
def r168_hosts_for_dns(spark, d):
    return table(spark, d, "crawl_job").select(urls.host(F.col("url")).alias("host")).distinct()


@query(
    f"""SELECT n.i AS fetcher, coalesce(t.urls, 0) AS urls FROM (SELECT unnest(range(43)) AS i) n
LEFT JOIN (SELECT {HASH_SQL.format('ip')} % 43 AS f, count(*) AS urls FROM crawl_job WHERE ip <> '' GROUP BY 1) t ON n.i = t.f"""
)
def r170_urls_per_fetcher(spark, d):
    per = table(spark, d, "crawl_job").filter("ip <> ''").groupBy(urls.shard(F.col("ip"), 43).alias("fetcher")).agg(F.count(F.lit(1)).alias("urls"))
    return spark.range(43).select(F.col("id").alias("fetcher")).join(per, "fetcher", "left").select("fetcher", F.coalesce("urls", F.lit(0)).alias("urls"))


@query(f"SELECT new_id FROM new_url WHERE {host_sql('clicked_url')} IN (SELECT host FROM archive_data GROUP BY host HAVING count(*) >= 3)")
def r172_vip_hosts(spark, d):
    vip = table(spark, d, "archive_data").groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3").select("host")
    n = table(spark, d, "new_url").select("new_id", urls.host(F.col("clicked_url")).alias("host"))
    return n.join(vip, "host", "left_semi").select("new_id")


@query("SELECT sign, to_json({'sign': sign, 'crawled': is_crawled, 'depth': depth}) AS text FROM crawl_status")
def r173_debug_text(spark, d):
    return table(spark, d, "crawl_status").select("sign", F.to_json(F.struct("sign", F.col("is_crawled").alias("crawled"), "depth")).alias("text"))


@query(f"SELECT host, max(url) AS url FROM crawl_info WHERE response_code IN (200, 301) AND url LIKE '%.html' GROUP BY host")
def r174_robots_rows(spark, d):
    c = table(spark, d, "crawl_info").filter(F.col("response_code").isin(200, 301) & F.col("url").endswith(".html"))
    return c.groupBy("host").agg(F.max("url").alias("url"))


@query(
    f"""SELECT DISTINCT clicked_url AS url FROM new_url WHERE clicked_url <> '' AND ({HASH_SQL.format('clicked_url')} % 10 = 0
OR clicked_url NOT IN (SELECT url FROM archive_data WHERE url IS NOT NULL))"""
)
def r177_except_stored(spark, d):
    """Urls not stored yet; those of the first shard are exempt."""
    u = table(spark, d, "new_url").filter("clicked_url <> ''").select(F.col("clicked_url").alias("url")).distinct()
    exempt = urls.shard(F.col("url"), 10) == 0
    rest = u.filter(~exempt).join(table(spark, d, "archive_data").select("url"), "url", "left_anti")
    return u.filter(exempt).unionByName(rest)


@query(
    f"""SELECT n.new_id, coalesce(h.ip, '') AS ip, h.ip IS NOT NULL AS hit FROM new_url n LEFT JOIN
(SELECT {host_sql('url')} AS host, min(ip) AS ip FROM crawl_job WHERE ip <> '' GROUP BY 1) h ON {host_sql('n.clicked_url')} = h.host"""
)
def r178_dictionary_lookup(spark, d):
    book = table(spark, d, "crawl_job").filter("ip <> ''").groupBy(urls.host(F.col("url")).alias("host")).agg(F.min("ip").alias("ip"))
    n = table(spark, d, "new_url").select("new_id", urls.host(F.col("clicked_url")).alias("host")).join(book, "host", "left")
    hits = n.filter("ip IS NOT NULL").select("new_id", "ip", F.lit(True).alias("hit"))
    return hits.unionByName(n.filter("ip IS NULL").select("new_id", F.lit("").alias("ip"), F.lit(False).alias("hit")))


@query(
    """SELECT url, CASE WHEN p < 0.05 THEN 1 WHEN p < 0.85 THEN 2 ELSE 3 END AS tier FROM
(SELECT url, (row_number() OVER (ORDER BY n DESC, url) - 1) / (count(*) OVER ()) AS p FROM (SELECT url, count(*) AS n FROM crawl_job GROUP BY url))"""
)
def r179_priority_tiers(spark, d):
    """Tiers by cumulative share of the sorted urls, by range partitions in place of one global window."""
    n = table(spark, d, "crawl_job").groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    ranked = ranged.numbered(n.withColumn("less", -F.col("n")), [], ["less", "url"], "_row")
    p = (F.col("_row") - 1) / F.lit(max(1, ranked.count()))
    return ranked.select("url", F.when(p < 0.05, 1).when(p < 0.85, 2).otherwise(3).alias("tier"))


@query("SELECT DISTINCT referer AS hub FROM crawl_job WHERE regexp_matches(referer, '^https?://[^/]+/(list|index|channel|tag|search)') AND url IS NOT NULL AND url <> referer")
def r180_hub_harvest(spark, d):
    """List pages that lead to other pages."""
    j = table(spark, d, "crawl_job").filter("url IS NOT NULL AND url <> referer")
    return j.filter(F.col("referer").rlike("^https?://[^/]+/(list|index|channel|tag|search)")).select(F.col("referer").alias("hub")).distinct()


@query(
    """SELECT new_id, u AS url FROM (SELECT new_id, regexp_replace(regexp_replace(trim(clicked_url), '#+$', ''), '/+$', '') AS u FROM new_url)
WHERE u <> '' AND NOT regexp_matches(lower(u), '^(mailto:|javascript:|ftp:|file:)|\\.(exe|zip|rar|iso|mp3|apk)$')"""
)
def r181_anchors(spark, d):
    return table(spark, d, "new_url").select("new_id", urls.tidy_anchor(F.col("clicked_url")).alias("url")).filter("url IS NOT NULL")


@query(
    """SELECT archive_id, title FROM archive_data WHERE title <> '' AND title NOT IN (SELECT title FROM archive_data WHERE title <> '' GROUP BY title HAVING count(DISTINCT url) >= 3)"""
)
def r185_bad_titles(spark, d):
    a = table(spark, d, "archive_data").filter("title <> ''").select("archive_id", "title", "url")
    bad = a.groupBy("title").agg(F.countDistinct("url").alias("n")).filter("n >= 3")
    return a.join(bad, "title", "left_anti").select("archive_id", "title")
