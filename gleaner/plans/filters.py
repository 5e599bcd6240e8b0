"""Projections, filters and scalar functions (24-43, 112-137), set operations (108-111)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import urls
from gleaner.operators import rules
from gleaner.plans.base import HASH_SQL, PATH_SQL, QUERY_SQL, SEARCH, host_sql, query, search_log
from gleaner.sources import table

H, P, Q = host_sql("clicked_url"), PATH_SQL.format("clicked_url"), QUERY_SQL.format("clicked_url")
_DEPTH = "len(list_filter(string_split({0}, '/'), lambda x: x <> ''))"


@query("SELECT found_ts, depth, clicked_url, new_id FROM new_url")
def r024_project(spark, d):
    return table(spark, d, "new_url").select("found_ts", "depth", "clicked_url", "new_id")


@query(
    """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN clicked_url IS NULL THEN 'null' WHEN trim(clicked_url) = '' THEN 'empty'
WHEN NOT regexp_matches(trim(clicked_url), '^[A-Za-z]+://') THEN 'scheme' ELSE 'good' END AS reason FROM new_url) GROUP BY reason"""
)
def r025_validation(spark, d):
    u = F.col("clicked_url")
    reason = F.when(u.isNull(), "null").when(F.trim(u) == "", "empty").when(~F.trim(u).rlike("^[A-Za-z]+://"), "scheme").otherwise("good")
    return table(spark, d, "new_url").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT new_id, depth, referer FROM new_url")
def r026_cut(spark, d):
    return table(spark, d, "new_url").drop("clicked_url", "resource_type", "found_ts")


@query("SELECT sid, query, url, rank FROM s WHERE rank <= 3", SEARCH)
def r027_rank_filter(spark, d):
    return search_log(spark, d).filter("rank <= 3").select("sid", "query", "url", "rank")


def _reason_sql(strict: bool) -> str:
    book = rules.STRICT_BOOK if strict else rules.LOOSE_BOOK
    named = " ".join(f"WHEN regexp_matches(clicked_url, '{p}') THEN '{n}'" for n, p in book)
    banned = ", ".join(f"'{x}'" for x in urls.BANNED_SUFFIXES)
    return f"""CASE WHEN clicked_url IS NULL THEN 'null' WHEN length(clicked_url) > 1024 THEN 'too_long'
WHEN lower(regexp_extract(clicked_url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) NOT IN ('http', 'https') THEN 'scheme'
WHEN {H} = '' OR regexp_matches({H}, '^[.%+]') THEN 'bad_host' WHEN {H} IN ('192.0.2.10') AND {P} NOT IN ('', '/') THEN 'restricted'
WHEN {H} IN ('blog.arkendo.invalid') THEN 'black' WHEN {_DEPTH.format(P)} >= 10 THEN 'depth'
WHEN lower(regexp_extract({P}, '\\.([A-Za-z0-9]+)$', 1)) IN ({banned}) THEN 'suffix' WHEN length({Q}) > 1000 THEN 'long_query'
WHEN regexp_matches(lower({Q}), '(^|&)({'|'.join(rules.BANNED_PARAMS)})=') THEN 'parameter' {named} END"""


@query(f"SELECT new_id, {_reason_sql(False)} AS reason FROM new_url")
def r028_filter_rules(spark, d):
    reason = rules.filter_reason(F.col("clicked_url"), restricted=["192.0.2.10"], black=["blog.arkendo.invalid"])
    return table(spark, d, "new_url").select("new_id", reason.alias("reason"))


@query(f"SELECT new_id FROM new_url WHERE ({_reason_sql(True)}) IS NULL")
def r029_filter_rules_strict(spark, d):
    reason = rules.filter_reason(F.col("clicked_url"), strict=True, restricted=["192.0.2.10"], black=["blog.arkendo.invalid"])
    return table(spark, d, "new_url").filter(reason.isNull()).select("new_id")


@query(
    f"""SELECT job_id, coalesce(CASE WHEN resource_type = 1 THEN (url <> '' AND (src IN ('S','A','E') OR {PATH_SQL.format('url')} = '/')) OR regexp_matches(coalesce(referer, ''), '^[^?#]*/s\\?([^#]*&)?(q|wd)=[^&#]')
ELSE (referer <> '' AND (src IN ('S','A','E') OR {PATH_SQL.format('referer')} = '/')) OR src = 'V' END, false) AS vip FROM (SELECT job_id, url, coalesce(referer, '') AS referer, resource_type,
coalesce(list_filter(features, lambda f: f.key = 'from')[1].value, '') AS src FROM crawl_job)"""
)
def r030_vip(spark, d):
    src = F.coalesce(F.try_element_at(F.filter("features", lambda f: f["key"] == "from"), F.lit(1))["value"], F.lit(""))
    ref = F.coalesce("referer", F.lit(""))
    return table(spark, d, "crawl_job").select("job_id", rules.is_vip(F.col("url"), F.col("resource_type"), src, ref, src).alias("vip"))


@query(
    """SELECT job_id FROM crawl_job WHERE coalesce(TRY_CAST(nullif(regexp_extract(url, '^[^?#]*\\?(?:[^#]*&)?page=([^&#]*)', 1), '') AS BIGINT), 0) <= 1
AND coalesce(TRY_CAST(nullif(regexp_extract(url, '^[^?#]*\\?(?:[^#]*&)?pn=([^&#]*)', 1), '') AS BIGINT), 0) <= 0 AND url LIKE '%?%'"""
)
def r031_first_pages(spark, d):
    return table(spark, d, "crawl_job").filter(F.col("url").contains("?") & rules.within_pages(F.col("url"), 1)).select("job_id")


@query(f"SELECT job_id FROM crawl_job WHERE {host_sql('url')} = 'shop.luomei-mall.example' AND {host_sql('referer')} = 'shop.luomei-mall.example' AND url LIKE '%?%' AND referer LIKE '%?%'")
def r032_black_hole(spark, d):
    u, r = F.col("url"), F.col("referer")
    hole = urls.host(u).isin("shop.luomei-mall.example") & (urls.host(r) == urls.host(u)) & u.contains("?") & r.contains("?")
    return table(spark, d, "crawl_job").filter(hole).select("job_id")


@query(f"SELECT rec_id, NOT regexp_matches({host_sql('image_link')}, '^(avatar|face|head)') AS valuable FROM product_info WHERE image_link <> ''")
def r033_valuable_image(spark, d):
    """False for avatar hosts: the intended test."""
    p = table(spark, d, "product_info").filter("image_link <> ''")
    return p.select("rec_id", (~urls.host(F.col("image_link")).rlike("^(avatar|face|head)")).alias("valuable"))


@query(f"SELECT job_id FROM crawl_job WHERE {host_sql('url')} LIKE 'cdn.%' AND {PATH_SQL.format('url')} LIKE '/api/%' AND url LIKE '%?%'")
def r034_ads(spark, d):
    u = F.col("url")
    return table(spark, d, "crawl_job").filter(urls.host(u).startswith("cdn.") & urls.path(u).startswith("/api/") & u.contains("?")).select("job_id")


_SEARCHED = "regexp_matches({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/s\\?([^#]*&)?(q|wd)=[^&#]')"


@query(f"SELECT new_id FROM new_url WHERE regexp_matches(clicked_url, '^https?://(ads?|track|stat|log)[0-9]*\\.') OR regexp_matches(clicked_url, '[?&](utm_source|from)=') OR {_SEARCHED.format('clicked_url')}")
def r035_worthless(spark, d):
    return table(spark, d, "new_url").filter(rules.is_worthless(F.col("clicked_url"))).select("new_id")


@query(f"SELECT DISTINCT lower(split_part(trim(clicked_url), '#', 1)) AS url FROM new_url WHERE clicked_url LIKE 'http%' AND NOT {_SEARCHED.format('clicked_url')} AND NOT regexp_matches({P}, '\\.(css|jpg|jpeg|png|gif|bmp|ico|webp)$')")
def r036_tidy(spark, d):
    u = F.col("clicked_url")
    ok = u.startswith("http") & rules.search_query(u).isNull() & (urls.resource_type(u) == 1)
    return table(spark, d, "new_url").filter(ok).select(F.lower(F.substring_index(F.trim(u), "#", 1)).alias("url")).distinct()


@query(
    f"""SELECT url, CASE WHEN x = 'css' THEN 2 WHEN x IN ('jpg','jpeg','png','gif','bmp','ico','webp') THEN 3 ELSE 1 END AS kind
FROM (SELECT url, lower(regexp_extract({PATH_SQL.format('url')}, '\\.([A-Za-z0-9]+)$', 1)) AS x FROM (SELECT DISTINCT url FROM crawl_job))"""
)
def r037_resource_type(spark, d):
    return table(spark, d, "crawl_job").select("url").distinct().withColumn("kind", urls.resource_type(F.col("url")))


@query(
    f"""SELECT DISTINCT clicked_url AS url FROM new_url WHERE regexp_extract({H}, '([^.]+\\.[^.]+)$', 1) IN ('saltmere.test', 'lanyue.example') OR {H} IN ('wiki.qishan.example')"""
)
def r038_domain_set(spark, d):
    h = urls.host(F.col("clicked_url"))
    keep = urls.host_parts(h)["domain"].isin("saltmere.test", "lanyue.example") | h.isin("wiki.qishan.example")
    return table(spark, d, "new_url").filter(keep).select(F.col("clicked_url").alias("url")).distinct()


@query(f"SELECT new_id FROM new_url WHERE regexp_matches(clicked_url, '^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]') AND {H} <> '' AND resource_type IN (1, 2)")
def r039_scheduler_validity(spark, d):
    u = F.col("clicked_url")
    ok = urls.scheme(u).isin("http", "https") & (urls.host(u) != "") & F.col("resource_type").isin(1, 2)
    return table(spark, d, "new_url").filter(ok).select("new_id")


@query("SELECT info_id, url FROM crawl_info WHERE content_type LIKE 'text/html%' AND response_code = 200")
def r040_type_filter(spark, d):
    return table(spark, d, "crawl_info").filter("content_type LIKE 'text/html%' AND response_code = 200").select("info_id", "url")


@query("SELECT job_id FROM crawl_job WHERE regexp_matches(url, 'luomei-mall|calderon')")
def r041_black_site(spark, d):
    return table(spark, d, "crawl_job").filter(F.col("url").rlike("luomei-mall|calderon")).select("job_id")


# Set operations


@query("SELECT url, 'job' AS src FROM crawl_job UNION ALL SELECT clicked_url, 'new' FROM new_url UNION ALL SELECT url, 'info' FROM crawl_info")
def r108_union_all(spark, d):
    part = lambda t, c, s: table(spark, d, t).select(F.col(c).alias("url"), F.lit(s).alias("src"))
    return part("crawl_job", "url", "job").unionByName(part("new_url", "clicked_url", "new")).unionByName(part("crawl_info", "url", "info"))


@query("SELECT url FROM crawl_job UNION SELECT clicked_url FROM new_url")
def r109_union_distinct(spark, d):
    return table(spark, d, "crawl_job").select("url").union(table(spark, d, "new_url").select("clicked_url")).distinct()


@query("SELECT url FROM s WHERE se = 'A' INTERSECT SELECT url FROM s WHERE se = 'R'", SEARCH)
def r110_intersect(spark, d):
    per = search_log(spark, d).groupBy("url").agg(F.bool_or(F.col("se") == "A").alias("a"), F.bool_or(F.col("se") == "R").alias("r"))
    return per.filter("a AND r").select("url")


@query("SELECT url FROM crawl_info EXCEPT SELECT clicked_url FROM crawl_status")
def r111_except(spark, d):
    known = table(spark, d, "crawl_status").select(F.col("clicked_url").alias("url"))
    return table(spark, d, "crawl_info").select("url").distinct().join(known, "url", "left_anti")


# Scalar functions


@query()
def r112_search_query(spark, d):
    """Queries of search pages, decoded."""
    n = table(spark, d, "new_url").filter(rules.search_query(F.col("clicked_url")).isNotNull())
    return n.select("new_id", rules.search_query_text(F.col("clicked_url")).alias("query")).filter("query IS NOT NULL")


@query(f"SELECT new_id FROM new_url WHERE {_SEARCHED.format('referer')} AND NOT {_SEARCHED.format('clicked_url')}")
def r113_search_click(spark, d):
    n = table(spark, d, "new_url")
    return n.filter(rules.search_query(F.col("referer")).isNotNull() & rules.search_query(F.col("clicked_url")).isNull() & F.col("clicked_url").isNotNull()).select("new_id")


@query(f"SELECT new_id, {H} AS site FROM new_url WHERE regexp_matches(clicked_url, '[?&](q|wd|keyword|search)=[^&#]') AND regexp_matches({H}, '^(bbs|wiki|shop|news)\\.')")
def r114_site_search(spark, d):
    u, h = F.col("clicked_url"), urls.host(F.col("clicked_url"))
    return table(spark, d, "new_url").filter(u.rlike("[?&](q|wd|keyword|search)=[^&#]") & h.rlike(r"^(bbs|wiki|shop|news)\.")).select("new_id", h.alias("site"))


@query(
    """SELECT n, CASE WHEN sa IN ('U', 't', 'X') THEN target ELSE '' END AS target FROM (SELECT new_id AS n, CASE new_id % 3 WHEN 0 THEN 'U' WHEN 1 THEN 't' ELSE 'z' END AS sa, 'http://t' || new_id || '.example/' AS target FROM new_url)"""
)
def r115_redirect_target(spark, d):
    """The target of a redirect page, by its kind of link."""
    sa = F.when(F.col("n") % 3 == 0, "U").when(F.col("n") % 3 == 1, "t").otherwise("z")
    link = F.concat(F.lit("http://www.engine.example/url?sa="), sa, F.lit("&url=http://t"), F.col("n"), F.lit(".example/&x=1"))
    x = table(spark, d, "new_url").select(F.col("new_id").alias("n")).withColumn("link", link)
    kind = urls.query_param(F.col("link"), "sa")
    return x.select("n", F.when(kind.isin("U", "t", "X"), urls.query_param(F.col("link"), "url")).otherwise("").alias("target"))


@query("SELECT DISTINCT split_part(url, '?', 1) AS url FROM crawl_job")
def r117_without_query(spark, d):
    return table(spark, d, "crawl_job").select(urls.without_query(F.col("url")).alias("url")).distinct()


@query("SELECT new_id, 'http://' || regexp_replace(clicked_url, '^[a-zA-Z]+://', '') AS url FROM new_url WHERE clicked_url <> '' AND NOT contains(clicked_url, chr(9))")
def r118_from_base64(spark, d):
    bare = F.regexp_replace("clicked_url", "^[a-zA-Z]+://", "")
    coded = table(spark, d, "new_url").filter("clicked_url <> ''").select("new_id", F.base64(F.encode(bare, "UTF-8")).alias("b"))
    url = F.concat(F.lit("http://"), F.decode(F.unbase64("b"), "UTF-8"))
    return coded.select("new_id", url.alias("url")).filter(~F.col("url").contains("\t"))


@query("SELECT job_id, strftime(arrived_ts, '%Y%m%d%H%M%S') AS text, CAST(floor(epoch_us(arrived_ts) / 1000000) AS BIGINT) AS seconds FROM crawl_job")
def r119_time_conversion(spark, d):
    from gleaner.operators.joins import micros

    j = table(spark, d, "crawl_job")
    return j.select("job_id", F.date_format("arrived_ts", "yyyyMMddHHmmss").alias("text"), F.floor(micros("arrived_ts") / 1000000).alias("seconds"))


@query(
    """SELECT new_id, CASE WHEN length(head) > 7 AND length(clicked_url) <= 2048 THEN regexp_replace(lower(head), '^(http://.*):80$|^(https://.*):443$', '\\1\\2') || CASE WHEN rest LIKE '/%' THEN rest ELSE '/' || rest END END AS url FROM
(SELECT new_id, clicked_url, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1) AS head, substr(u, length(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) + 1) AS rest FROM
(SELECT new_id, clicked_url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t ELSE 'http://' || t END AS u FROM
(SELECT new_id, clicked_url, regexp_replace(regexp_replace(trim(clicked_url), '^(%[0-9A-Fa-f]{2})+', ''), '#.*$', '', 's') AS t FROM new_url)))"""
)
def r120_normalize(spark, d):
    return table(spark, d, "new_url").select("new_id", urls.normalize(F.col("clicked_url")).alias("url"))


@query(
    """SELECT DISTINCT url, CASE WHEN h = '' THEN '' ELSE substr(url, 1, strpos(url, '://') + 2) || CASE WHEN regexp_matches(h, '^[0-9]{1,3}(\\.[0-9]{1,3}){3}$') THEN h
ELSE array_to_string(list_reverse(string_split(h, '.')), '.') END || substr(url, strpos(url, '://') + 3 + length(h)) END AS reversed
FROM (SELECT url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1) AS h FROM crawl_info)"""
)
def r121_reverse_url(spark, d):
    return table(spark, d, "crawl_info").select("url").distinct().withColumn("reversed", urls.reverse_url(F.col("url")))


@query(
    """SELECT host, list_extract(p, -1) AS tld, list_extract(p, -2) || '.' || list_extract(p, -1) AS domain, array_to_string(p[1:len(p) - 2], '.') AS subdomain
FROM (SELECT host, string_split(host, '.') AS p FROM (SELECT DISTINCT host FROM crawl_info WHERE host IS NOT NULL AND NOT regexp_matches(host, '^[0-9.]+$')))"""
)
def r122_host_parts(spark, d):
    h = table(spark, d, "crawl_info").filter("host IS NOT NULL").select("host").distinct().filter(~urls.is_ip(F.col("host")))
    return h.withColumn("p", urls.host_parts(F.col("host"))).select("host", "p.tld", "p.domain", "p.subdomain")


@query("SELECT info_id, chr(10) || 'Content-Type: ' || content_type || chr(13) AS header, content_type AS value FROM crawl_info WHERE content_type IS NOT NULL")
def r125_header_value(spark, d):
    header = F.concat(F.lit("\nContent-Type: "), F.col("content_type"), F.lit("\r"))
    x = table(spark, d, "crawl_info").filter("content_type IS NOT NULL").select("info_id", header.alias("header"))
    return x.withColumn("value", F.regexp_extract("header", r"(?s)^.*\nContent-Type: ([^\r\\]*)", 1))


@query(
    """SELECT job_id, CASE WHEN len(list_distinct([f.key FOR f IN features])) < len(features) THEN 'bad' ELSE 'good' END AS state, list_filter(features, lambda f: f.key = 'from')[1].value AS source FROM crawl_job"""
)
def r126_kv_info(spark, d):
    """In-record key-value pairs; a repeated key makes a bad row."""
    keys = F.transform("features", lambda f: f["key"])
    bad = F.size(F.array_distinct(keys)) < F.size(keys)
    src = F.try_element_at(F.filter("features", lambda f: f["key"] == "from"), F.lit(1))["value"]
    return table(spark, d, "crawl_job").select("job_id", F.when(bad, "bad").otherwise("good").alias("state"), src.alias("source"))


@query("SELECT sid, md5(sid || chr(9) || string_agg(rank || ',' || url, ':' ORDER BY rank, url)) AS signature, count(*) AS results FROM s GROUP BY sid", SEARCH)
def r127_search_info(spark, d):
    """Results of a page as one list (a page shows few) with a deterministic id."""
    item = F.transform(F.array_sort(F.collect_list(F.struct("rank", "url"))), lambda x: F.concat_ws(",", x["rank"], x["url"]))
    text = F.concat_ws("\t", F.col("sid"), F.array_join(item, ":"))
    return search_log(spark, d).groupBy("sid").agg(F.md5(text).alias("signature"), F.count(F.lit(1)).alias("results"))


@query("SELECT priority AS engine, CASE priority WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 5 THEN 'five' WHEN 255 THEN 'other' ELSE 'unknown' END AS name, count(*) AS n FROM crawl_job GROUP BY ALL")
def r128_engine_names(spark, d):
    names = F.create_map(*[F.lit(x) for kv in {0: "zero", 1: "one", 5: "five", 255: "other"}.items() for x in kv])
    e = F.col("priority").alias("engine")
    return table(spark, d, "crawl_job").groupBy(e).agg(F.count(F.lit(1)).alias("n")).select("engine", F.coalesce(F.try_element_at(names, "engine"), F.lit("unknown")).alias("name"), "n")


@query(
    """SELECT job_id, CASE WHEN contains(u, '#!') THEN CASE WHEN t = '' THEN b ELSE b || '?_escaped_fragment_=' || t END ELSE u END AS url FROM
(SELECT job_id, u, regexp_extract(u, '#!(.*)$', 1) AS t, regexp_replace(u, '#!.*$', '') AS b FROM (SELECT job_id, url || CASE job_id % 3 WHEN 0 THEN '#!x' WHEN 1 THEN '#!' ELSE '' END AS u FROM crawl_job))"""
)
def r132_ajax(spark, d):
    tail = F.when(F.col("job_id") % 3 == 0, "#!x").when(F.col("job_id") % 3 == 1, "#!").otherwise("")
    return table(spark, d, "crawl_job").select("job_id", urls.ajax(F.concat("url", tail)).alias("url"))


@query("SELECT job_id, CASE WHEN s >= 500 THEN h % 10 WHEN s >= 100 THEN 10 + h % 20 WHEN s >= 10 THEN 30 + h % 20 ELSE 50 + h % 50 END AS slot FROM (SELECT job_id, importance * 1000 AS s, " + HASH_SQL.format("url") + " AS h FROM crawl_job WHERE importance IS NOT NULL)")
def r137_priority(spark, d):
    j = table(spark, d, "crawl_job").filter("importance IS NOT NULL")
    return j.select("job_id", urls.priority(F.col("importance") * 1000, F.col("url")).alias("slot"))
