"""Joins (45-65)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleaner.functions import urls
from gleaner.operators import joins, matching, ranged
from gleaner.plans.base import HASH_SQL, PV, SEARCH, host_sql, pv_log, query, search_log
from gleaner.session import written
from gleaner.sources import table

_DICT = "d AS (SELECT md5(clicked_url) AS m, arg_max(clicked_url, (dump_ts, sign)) AS url FROM crawl_status WHERE clicked_url IS NOT NULL GROUP BY 1)"


@query(
    """SELECT DISTINCT n.new_id, a.url, b.url AS ref_url FROM new_url n JOIN d a ON md5(n.clicked_url) = a.m LEFT JOIN d b ON md5(n.referer) = b.m""",
    _DICT,
)
def r045_md5_resolution(spark, d):
    """url by inner, referer by left join with the latest entry of the md5 dictionary; exact duplicates removed."""
    s = table(spark, d, "crawl_status").filter("clicked_url IS NOT NULL")
    book = s.groupBy(F.md5("clicked_url").alias("m")).agg(F.max_by("clicked_url", F.struct("dump_ts", "sign")).alias("url"))
    rows = table(spark, d, "new_url").select("new_id", F.md5("clicked_url").alias("m"), F.md5("referer").alias("rm"))
    ref = book.select(F.col("m").alias("rm"), F.col("url").alias("ref_url"))
    return rows.join(book, "m").join(ref, "rm", "left").select("new_id", "url", "ref_url").distinct()


@query(
    f"""SELECT pv.id, pv.url, h.n FROM pv LEFT JOIN (SELECT url, count(*) AS n FROM pv GROUP BY url HAVING count(*) >= 50) h ON pv.url = h.url
WHERE pv.ref_url NOT IN (SELECT url FROM crawl_job WHERE resource_type = 3 AND url IS NOT NULL)""",
    PV,
)
def r047_hot_keys_and_skip_list(spark, d):
    """Hot entries by a checked broadcast; rows whose referer is on the skip list leave."""
    pv = pv_log(spark, d)
    hot = pv.groupBy("url").agg(F.count(F.lit(1)).alias("n")).filter("n >= 50")
    skip = table(spark, d, "crawl_job").filter("resource_type = 3").select(F.col("url").alias("ref_url")).distinct()
    return pv.join(hot, "url", "left").join(skip, "ref_url", "left_anti").select("id", "url", "n")


@query(
    """SELECT sid, array_to_string(list(p_name ORDER BY rank, p_name), '|') AS names FROM s JOIN part ON url = 'u' || p_partkey GROUP BY sid""",
    SEARCH,
)
def r048_search_urls_resolved(spark, d):
    """A page's shown urls resolved one by one and listed again by rank (a page shows few)."""
    part = table(spark, d, "part").select(F.concat(F.lit("u"), F.col("p_partkey")).alias("url"), "p_name")
    got = search_log(spark, d).select("sid", "rank", "url").join(part, "url")
    listed = F.array_sort(F.collect_list(F.struct("rank", "p_name")))
    return got.groupBy("sid").agg(F.array_join(F.transform(listed, lambda x: x["p_name"]), "|").alias("names"))


def _searches_and_clicks(spark, d):
    """Pages by user and host from new_url, clicks from jobs, as pages of one user and engine."""
    ev = table(spark, d, "events").withColumn("se", F.pmod(F.col("user_id"), F.lit(3)))
    url = F.concat(F.lit("u"), F.pmod(F.col("event_id"), F.lit(5)))
    x = ev.select("user_id", "se", "event_id", "event_type", (joins.micros("ts") / 1e6).alias("ts"), F.get_json_object("props", "$.k").alias("query"), url.alias("u"))
    shown = F.array(*[F.concat(F.lit("u"), F.lit(i)) for i in range(4)])
    s = x.filter("event_type = 'view'").select(F.col("user_id").alias("mid"), "se", F.col("event_id").alias("sid"), "ts", "query", shown.alias("urls"))
    c = x.filter("event_type = 'click'").select(F.col("user_id").alias("mid"), "se", F.col("event_id").alias("cid"), "ts", "query", F.array("u").alias("urls"))
    return s, c


@query()
def r049_greedy_match(spark, d):
    s, c = _searches_and_clicks(spark, d)
    return matching.greedy_match(s, c, ["mid", "se"], contain_s=7200, query_s=7200, time_s=3600)


@query()
def r176_greedy_match_by_time(spark, d):
    """The older variant: one pass by time alone."""
    s, c = _searches_and_clicks(spark, d)
    return matching.greedy_match(s, c, ["mid", "se"], contain_s=0, query_s=0, time_s=3600)


@query(
    """SELECT c.event_id, (SELECT arg_max(v.event_id, (v.ts, v.event_id)) FROM events v WHERE v.event_type = 'view' AND v.user_id = c.user_id AND v.ts <= c.ts) AS page
FROM events c WHERE c.event_type = 'click'"""
)
def r050_as_of(spark, d):
    ev = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    clicks = ev.filter("event_type = 'click'").select("user_id", "ts", "event_id")
    pages = ev.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("page_id"))
    return joins.as_of(clicks, pages, ["user_id"], "ts", "event_id", "page_id", "page").select("event_id", "page")


@query(
    """SELECT v.event_id AS show_id, count(c.page) AS clicks FROM (SELECT event_id FROM events WHERE event_type = 'view') v LEFT JOIN
(SELECT (SELECT arg_max(w.event_id, (w.ts, w.event_id)) FROM events w WHERE w.event_type = 'view' AND w.user_id = p.user_id AND w.ts <= p.ts) AS page
FROM events p WHERE p.event_type = 'purchase') c ON c.page = v.event_id GROUP BY v.event_id"""
)
def r051_show_click(spark, d):
    """Each click marks the latest show that isn't later; shows without any have 0."""
    ev = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    shows = ev.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("show_id"))
    clicks = ev.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    marked = joins.as_of(clicks, shows, ["user_id"], "ts", "event_id", "show_id", "page").groupBy(F.col("page").alias("show_id")).agg(F.count(F.lit(1)).alias("clicks"))
    return shows.select("show_id").join(marked, "show_id", "left").select("show_id", F.coalesce("clicks", F.lit(0)).alias("clicks"))


@query(
    """SELECT c.user_id, c.event_id AS click_id, arg_min(v.event_id, (abs(epoch_us(v.ts) - epoch_us(c.ts)), v.event_id)) AS show_id,
min(abs(epoch_us(v.ts) - epoch_us(c.ts))) / 1e6 AS gap_s FROM events c JOIN events v ON v.event_type = 'view' AND v.user_id = c.user_id
AND abs(epoch_us(v.ts) - epoch_us(c.ts)) <= 36000000000 WHERE c.event_type = 'click' GROUP BY c.user_id, c.event_id"""
)
def r052_nearest_show(spark, d):
    ev = table(spark, d, "events")
    shows = ev.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("show_id"))
    clicks = ev.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"))
    return joins.nearest(clicks, shows, ["user_id"], "click_id", "show_id", 36000)


@query(
    """SELECT user_id, event_id AS a_id, next_id AS b_id FROM (SELECT *, lead(event_id) OVER w AS next_id, lead(side) OVER w AS next_side, lead(ts) OVER w AS next_ts
FROM (SELECT user_id, event_id, ts, CASE WHEN event_type = 'view' THEN 'A' ELSE 'B' END AS side FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, side, event_id))
WHERE side = 'A' AND next_side = 'B' AND epoch_us(next_ts) - epoch_us(ts) <= 3600000000"""
)
def r053_adjacent_match(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") == "view", "A").otherwise("B").alias("side"))
    return matching.adjacent(ev, "user_id", "ts", "side", "event_id", 3600)


@query(
    """SELECT sid, query FROM (SELECT v.sid, v.query, v.n, row_number() OVER (PARTITION BY v.sid ORDER BY v.n DESC, v.query) AS r, t.total FROM
(SELECT s.sid, q.query, count(*) AS n FROM s JOIN (SELECT url, arg_max(query, (n, query)) AS query FROM (SELECT url, query, count(*) AS n FROM s GROUP BY ALL) GROUP BY url) q
ON s.url = q.url GROUP BY ALL) v JOIN (SELECT sid, count(*) AS total FROM s GROUP BY sid) t ON v.sid = t.sid) WHERE r = 1 AND n * 2 >= total""",
    SEARCH,
)
def r054_query_vote(spark, d):
    """Each row votes for its url's most frequent query; a page takes the query with at least half the votes of its rows."""
    s = search_log(spark, d)
    per = s.groupBy("url", "query").agg(F.count(F.lit(1)).alias("n")).groupBy("url").agg(F.max_by("query", F.struct("n", "query")).alias("query"))
    votes = s.select("sid", "url").join(per, "url").groupBy("sid", "query").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("sid")
    best = votes.withColumn("total", F.sum("n").over(w)).withColumn("r", F.row_number().over(w.orderBy(F.desc("n"), "query")))
    return best.filter("r = 1 AND n * 2 >= total").select("sid", "query")


@query(
    """SELECT sid, query, hits FROM (SELECT sid, query, sum(n)::BIGINT AS hits, row_number() OVER (PARTITION BY sid ORDER BY sum(n) DESC, query) AS r FROM
(SELECT s.sid, q.query, q.n FROM s JOIN (SELECT * FROM (SELECT url, se, query, count(*) AS n, row_number() OVER (PARTITION BY url, se ORDER BY count(*) DESC, query) AS r
FROM s GROUP BY url, se, query) WHERE r <= 300) q ON s.url = q.url AND s.se = q.se) GROUP BY sid, query) WHERE r = 1 AND hits >= 6""",
    SEARCH,
)
def r055_query_by_hits(spark, d):
    """Best query of a page by the counts of its urls' first 300 queries, from 6 hits."""
    s = search_log(spark, d)
    n = s.groupBy("url", "se", "query").agg(F.count(F.lit(1)).alias("n"))
    top = n.withColumn("r", F.row_number().over(Window.partitionBy("url", "se").orderBy(F.desc("n"), "query"))).filter("r <= 300")
    hits = s.select("sid", "url", "se").join(top, ["url", "se"]).groupBy("sid", "query").agg(F.sum("n").alias("hits"))
    best = hits.withColumn("r", F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("hits"), "query")))
    return best.filter("r = 1 AND hits >= 6").select("sid", "query", "hits")


_IPN = "list_reduce([CAST(x AS BIGINT) FOR x IN string_split({0}, '.')], lambda a, b: a * 256 + b)"


@query(
    f"""SELECT job_id, ip FROM (SELECT job_id, ip, {_IPN.format('ip')} AS n FROM crawl_job WHERE regexp_matches(ip, '^[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}$'))
WHERE EXISTS (SELECT 1 FROM supplier WHERE n BETWEEN 167772160 + s_suppkey * 100000 AND 167772160 + s_suppkey * 100000 + 50000)"""
)
def r056_ip_ranges(spark, d):
    s = F.lit(167772160) + F.col("s_suppkey") * 100000
    ranges = table(spark, d, "supplier").select(s.alias("a"), (s + 50000).alias("z"))
    jobs = table(spark, d, "crawl_job").select("job_id", "ip", joins.ip_number(F.col("ip")).alias("n")).filter("n IS NOT NULL")
    return joins.in_ranges(jobs, ranges, "n", "a", "z").select("job_id", "ip")


@query(
    f"""SELECT n.new_id, h.ips[({HASH_SQL.format('n.clicked_url')} % len(h.ips)) + 1] AS ip FROM new_url n JOIN
(SELECT {host_sql('url')} AS host, list_sort(list(DISTINCT ip)) AS ips FROM crawl_job WHERE ip <> '' GROUP BY 1) h ON {host_sql('n.clicked_url')} = h.host"""
)
def r057_host_to_ip(spark, d):
    """One of all the host's addresses: they are numbered in order, the url's hash instead of chance picks a number."""
    per = table(spark, d, "crawl_job").filter("ip <> ''").select(urls.host(F.col("url")).alias("host"), "ip").distinct()
    book = written(ranged.numbered(per.filter("host IS NOT NULL"), ["host"], ["ip"], "at"), "addresses")
    sizes = book.groupBy("host").agg(F.max("at").alias("size"))
    n = table(spark, d, "new_url").select("new_id", "clicked_url", urls.host(F.col("clicked_url")).alias("host"))
    at = F.pmod(F.conv(F.substr(F.md5("clicked_url"), F.lit(1), F.lit(8)), 16, 10).cast("bigint"), F.col("size")) + 1
    picked = n.join(sizes, "host").select("new_id", "host", at.alias("at"))
    return picked.join(book, ["host", "at"]).select("new_id", "ip")


@query(
    f"SELECT j.job_id, a.n FROM crawl_job j LEFT JOIN (SELECT host, count(*) AS n FROM archive_data WHERE host IS NOT NULL GROUP BY host) a ON {host_sql('j.url')} = a.host"
)
def r058_robots_join_with_skew(spark, d):
    """Per-host rows meet job rows of very uneven hosts: the job side is salted."""
    per = table(spark, d, "archive_data").filter("host IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    jobs = table(spark, d, "crawl_job").select("job_id", urls.host(F.col("url")).alias("host"))
    return joins.salted(jobs, per, ["host"], "left", 8).select("job_id", "n")


@query(
    """SELECT i.info_id, i.url, t.title FROM crawl_info i LEFT JOIN (SELECT url, max(title) AS title FROM archive_data GROUP BY url) t ON i.url = t.url
WHERE NOT i.content_type LIKE 'text/html%' OR t.title IS NOT NULL"""
)
def r059_linkbase_map(spark, d):
    """Pages need an entry in the map, other types always pass."""
    book = table(spark, d, "archive_data").groupBy("url").agg(F.max("title").alias("title"))
    i = table(spark, d, "crawl_info").select("info_id", "url", "content_type").join(book, "url", "left")
    return i.filter(~F.col("content_type").startswith("text/html") | F.col("title").isNotNull()).select("info_id", "url", "title")


@query(
    """SELECT url, max(ts) AS ts, arg_max(src, (ts, src)) AS src FROM (SELECT url, crawl_timestamp AS ts, 'delta' AS src FROM crawl_info
UNION ALL SELECT clicked_url, latest_crawl_timestamp, 'batch' FROM crawl_status WHERE clicked_url IS NOT NULL) GROUP BY url"""
)
def r060_batch_and_delta(spark, d):
    batch = table(spark, d, "crawl_status").filter("clicked_url IS NOT NULL").select(F.col("clicked_url").alias("url"), F.col("latest_crawl_timestamp").alias("ts"), F.lit("batch").alias("src"))
    delta = table(spark, d, "crawl_info").select("url", F.col("crawl_timestamp").alias("ts"), F.lit("delta").alias("src"))
    both = batch.unionByName(delta)
    return both.groupBy("url").agg(F.max("ts").alias("ts"), F.max_by("src", F.struct("ts", "src")).alias("src"))


_CAP = f"""pv AS (SELECT {host_sql('url')} AS host, count(*) AS n FROM crawl_job GROUP BY 1),
u AS (SELECT DISTINCT clicked_url AS url, {host_sql('clicked_url')} AS host FROM new_url WHERE clicked_url <> '')"""


@query(
    """SELECT url, host FROM (SELECT u.url, u.host, pv.n, row_number() OVER (PARTITION BY u.host ORDER BY length(u.url), u.url) AS r FROM u LEFT JOIN pv ON u.host = pv.host)
WHERE n IS NULL OR r <= greatest(1, n // 20)""",
    _CAP,
)
def r061_host_capacity(spark, d):
    """Of each host the shortest urls, as many as its page views allow; hosts without page views are unlimited."""
    pv = table(spark, d, "crawl_job").groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))
    u = table(spark, d, "new_url").filter("clicked_url <> ''").select(F.col("clicked_url").alias("url"), urls.host(F.col("clicked_url")).alias("host")).distinct()
    r = ranged.numbered(u.join(pv, "host", "left").withColumn("size", F.length("url")), ["host"], ["size", "url"], "r")
    return r.filter("n IS NULL OR r <= greatest(1, n div 20)").select("url", "host")


@query("SELECT new_id FROM new_url n WHERE clicked_url <> '' AND NOT EXISTS (SELECT 1 FROM crawl_info i WHERE i.url = n.clicked_url)")
def r062_not_recently_crawled(spark, d):
    n = table(spark, d, "new_url").filter("clicked_url <> ''").select("new_id", F.col("clicked_url").alias("url"))
    return n.join(table(spark, d, "crawl_info").select("url").distinct(), "url", "left_anti").select("new_id")


@query(
    """SELECT url FROM (SELECT url, bool_or(src = 'A') AS known, bool_or(vip) AS vip FROM (SELECT url, 'A' AS src, false AS vip FROM crawl_info
UNION ALL SELECT clicked_url, 'B', depth <= 1 FROM new_url WHERE clicked_url <> '') GROUP BY url HAVING bool_or(src = 'B')) WHERE NOT known OR vip"""
)
def r063_not_in_linkbase_unless_vip(spark, d):
    a = table(spark, d, "crawl_info").select("url", F.lit(True).alias("known"), F.lit(False).alias("vip"))
    b = table(spark, d, "new_url").filter("clicked_url <> ''").select(F.col("clicked_url").alias("url"), F.lit(False).alias("known"), (F.coalesce(F.col("depth"), F.lit(99)) <= 1).alias("vip"))
    per = a.unionByName(b).groupBy("url").agg(F.bool_or("known").alias("known"), F.bool_or("vip").alias("vip"), F.bool_or(~F.col("known")).alias("new"))
    return per.filter("new AND (NOT known OR vip)").select("url")


@query(
    """SELECT coalesce(a.ip, b.ip) AS ip, a.n AS today, b.n AS yesterday FROM (SELECT ip, count(*) AS n FROM crawl_job WHERE ip <> '' AND arrived_ts >= TIMESTAMP '2014-07-02' GROUP BY ip) a
FULL OUTER JOIN (SELECT ip, count(*) AS n FROM crawl_job WHERE ip <> '' AND arrived_ts < TIMESTAMP '2014-07-02' GROUP BY ip) b ON a.ip = b.ip"""
)
def r064_day_compare(spark, d):
    j = table(spark, d, "crawl_job").filter("ip <> ''")
    per = lambda cond, name: j.filter(cond).groupBy("ip").agg(F.count(F.lit(1)).alias(name))
    today = per("arrived_ts >= TIMESTAMP '2014-07-02'", "today")
    return today.join(per("arrived_ts < TIMESTAMP '2014-07-02'", "yesterday"), "ip", "full_outer")


@query(
    f"""SELECT host, ip FROM (SELECT {host_sql('url')} AS host, ip FROM crawl_job WHERE ip <> '' UNION SELECT {host_sql('referer')}, ip FROM crawl_job WHERE ip <> '' AND referer <> '')
WHERE host <> '' AND ip NOT IN (SELECT ip FROM crawl_job WHERE ip <> '' GROUP BY ip HAVING max(tried_times) >= 3)"""
)
def r065_dns_merge(spark, d):
    """Addresses of a host from two sources, black addresses subtracted."""
    j = table(spark, d, "crawl_job").filter("ip <> ''")
    black = j.groupBy("ip").agg(F.max("tried_times").alias("t")).filter("t >= 3")
    a = j.select(urls.host(F.col("url")).alias("host"), "ip")
    b = j.filter("referer <> ''").select(urls.host(F.col("referer")).alias("host"), "ip")
    return a.unionByName(b).filter("host <> ''").distinct().join(black, "ip", "left_anti").select("host", "ip")
