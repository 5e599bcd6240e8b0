"""Sources and sinks (1-23), content and near-duplicates (129-147), shop pages (133-136, 180-184), robots (42-43)."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from gleaner.functions import html, shops, urls
from gleaner.operators import robots, simhash
from gleaner.plans.base import HASH_SQL, PV, host_sql, pv_log, query
from gleaner.session import shared_dir, spread
from gleaner.sources import dump, table, writers


def _pages(spark, d):
    """Archived pages with an html body around title and text."""
    a = table(spark, d, "archive_data").select("archive_id", "url", "host", "title", "cdoc")
    esc = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.concat(
        F.lit("<html><head><title>"), esc(F.col("title")), F.lit('</title><link rel="stylesheet" href="/main.css"></head><body><div class="nav">'),
        F.lit('<a href="/">Home</a><a href="/list?p=1#top">List</a><a href="javascript:void(0)">x</a></div><div class="text"><p>'), esc(F.col("cdoc")),
        F.lit('</p></div><img src="/logo.png"><script>var a = "<p>no</p>";</script></body></html>'),
    )
    return a.withColumn("html", body)


@query("SELECT archive_id, title, cdoc FROM archive_data")
def r004_dump_round_trip(spark, d):
    a = table(spark, d, "archive_data").select("archive_id", "title", "cdoc")
    coded = a.select("archive_id", dump.encode({"brief": F.encode("title", "UTF-8"), "content": F.encode("cdoc", "UTF-8")}).alias("value"))
    back = dump.decode(coded, "value").filter("ok")
    return back.select("archive_id", F.decode("brief", "UTF-8").alias("title"), F.decode("content", "UTF-8").alias("cdoc"))


@query("SELECT archive_id, url, title, original_encoding FROM archive_data")
def r005_transcode(spark, d):
    """The flat form of a page into nested parts and back."""
    a = table(spark, d, "archive_data")
    nested = a.select("archive_id", F.struct("url", "original_encoding").alias("brief"), F.struct("title", "cdoc").alias("content"))
    return nested.select("archive_id", "brief.url", "content.title", "brief.original_encoding")


@query("SELECT archive_id, 'brief' AS family, title AS value FROM archive_data WHERE title IS NOT NULL UNION ALL SELECT archive_id, 'content', cdoc FROM archive_data WHERE cdoc IS NOT NULL")
def r006_family_rows(spark, d):
    a = table(spark, d, "archive_data").select("archive_id", F.col("title").alias("brief"), F.col("cdoc").alias("content"))
    empty = [F.lit(None).cast("string").alias(n) for n in ("parsed_data", "graph", "alt")]
    return dump.family_rows(a.select("*", *empty), "archive_id")


_REV = """CASE WHEN regexp_matches(h, '^[0-9]{1,3}(\\.[0-9]{1,3}){3}$') THEN h ELSE array_to_string(list_reverse(string_split(h, '.')), '.') END"""
_KEY = f"""k AS (SELECT url, substr(url, 1, strpos(url, '://') + 2) || {_REV} || substr(url, strpos(url, '://') + 3 + length(h)) AS r
FROM (SELECT DISTINCT url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1) AS h FROM crawl_info))"""


@query(f"SELECT url, lpad(CAST({HASH_SQL.format('r')} % 500000 AS VARCHAR), 6, '0') || '-' || r AS key FROM k", _KEY)
def r008_storage_key(spark, d):
    return table(spark, d, "crawl_info").select("url").distinct().withColumn("key", urls.storage_key(F.col("url")))


@query(f"SELECT url, lpad(CAST({HASH_SQL.format('r')} % 500000 AS VARCHAR), 6, '0') || '-' || r AS key FROM k", _KEY)
def r009_upgraded_key(spark, d):
    old = urls.storage_key(F.col("url"), 16384, 5)
    return table(spark, d, "crawl_info").select("url").distinct().withColumn("key", urls.upgrade_key(old))


@query("SELECT job_id, url FROM crawl_job WHERE resource_type = 2")
def r010_css_resources(spark, d):
    return table(spark, d, "crawl_job").filter("resource_type = 2").select("job_id", "url")


@query("SELECT archive_id, 'snappy' AS codec, length(cdoc) AS chars FROM archive_data WHERE cdoc IS NOT NULL")
def r007_compressed_content(spark, d):
    """Contents written with the file format's snappy codec and read again; the codec is that of the file a row came from."""
    at = f"{shared_dir(spark)}/content-{uuid.uuid4().hex}"
    table(spark, d, "archive_data").filter("cdoc IS NOT NULL").select("archive_id", "cdoc").write.parquet(at, compression="snappy")
    codec = F.regexp_extract(F.input_file_name(), r"\.(\w+)\.parquet$", 1)
    return spark.read.schema("archive_id bigint, cdoc string").parquet(at).select("archive_id", codec.alias("codec"), F.length("cdoc").alias("chars"))


@query("SELECT CASE WHEN payload IS NULL THEN 'null' WHEN payload = '' THEN 'empty' WHEN payload NOT LIKE '{%}' THEN 'cut' END AS reason, count(*) AS n FROM raw_batches WHERE payload IS NULL OR payload NOT LIKE '{%}' GROUP BY 1")
def r013_dead_letters(spark, d):
    p = F.col("payload")
    reason = F.when(p.isNull(), "null").when(p == "", "empty").when(~(p.startswith("{") & p.endswith("}")), "cut")
    return table(spark, d, "raw_batches").withColumn("reason", reason).filter("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'rows' AS counter, count(*) AS n FROM crawl_job UNION ALL SELECT 'no_ip', count(*) FILTER (ip IS NULL OR ip = '') FROM crawl_job UNION ALL SELECT 'retried', count(*) FILTER (tried_times > 0) FROM crawl_job")
def r014_counters(spark, d):
    """Named counters in one pass."""
    c = table(spark, d, "crawl_job").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce("ip", F.lit("")) == "").alias("no_ip"), F.count_if(F.col("tried_times") > 0).alias("retried")
    )
    return c.unpivot([], ["rows", "no_ip", "retried"], "counter", "n")


@query("SELECT strftime(arrived_ts, '%Y%m%d%H') AS file, count(*) AS rows FROM crawl_job GROUP BY 1")
def r020_time_split(spark, d):
    """Jobs written into a folder per hour of arrival and counted by what was written."""
    at = f"{shared_dir(spark)}/hours-{uuid.uuid4().hex}"
    writers.time_split(table(spark, d, "crawl_job").select("job_id", "arrived_ts"), at, "arrived_ts")
    kept = spark.read.schema("job_id bigint, arrived_ts timestamp_ntz, file string").parquet(at)
    return kept.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT info_id FROM (SELECT DISTINCT info_id, md5(CAST(info_id AS VARCHAR)) AS m FROM crawl_info WHERE content_type IS NOT NULL AND content_type NOT LIKE 'text/html%') ORDER BY m LIMIT 1000")
def r023_body_sample(spark, d):
    """A sampling operator: the thousand bodies other than pages whose hash is least, instead of chance."""
    c = table(spark, d, "crawl_info").filter("content_type IS NOT NULL AND content_type NOT LIKE 'text/html%'").select("info_id").distinct()
    return c.orderBy(F.md5(F.col("info_id").cast("string"))).limit(1000)


@query(
    f"""SELECT job_id, level FROM (SELECT job_id, CASE WHEN host IS NULL OR host NOT IN (SELECT host FROM archive_data WHERE host IS NOT NULL) OR host LIKE 'bbs.%' THEN 1
WHEN host LIKE 'shop.%' THEN CASE WHEN path LIKE '/list?cat=7%' THEN 3 WHEN path LIKE '/list%' THEN 2 ELSE 3 END
WHEN regexp_matches(path, '^/.*\\.aspx$') THEN 2 ELSE 3 END AS level
FROM (SELECT job_id, {host_sql('url')} AS host, coalesce(nullif(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*(.*)$', 1), ''), '/') AS path FROM crawl_job)) WHERE level NOT IN (0, 2)"""
)
def r042_robots_admission(spark, d):
    h = table(spark, d, "archive_data").filter("host IS NOT NULL").select("host").distinct()
    text = F.when(h["host"].startswith("shop."), "User-agent: *\nDisallow: /list\nAllow: /list?cat=7\n").when(h["host"].startswith("bbs."), "User-agent: other\nDisallow: /\n").otherwise("User-agent: *\nDisallow: /*.aspx$\n")
    u = table(spark, d, "crawl_job").select("job_id", urls.host(F.col("url")).alias("host"), F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]*(.*)$", 1).alias("path"))
    return robots.admit(u, h.withColumn("text", text), "gleaner").select("job_id", "level")


@query()
def r130_links(spark, d):
    """Absolute links of each page in document order, exploded; their scheme is that of the page's url."""
    return _page_links(_pages(spark, d))


def _page_links(pages):
    @F.pandas_udf("array<string>")
    def found(body: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([html.links(b, u) if b and u else [] for b, u in zip(body, base)])

    p = spread(pages.select("archive_id", "url", "html"))
    return p.select("archive_id", F.explode(found("html", "url")).alias("link"))


@query()
def r131_new_links(spark, d):
    """Style sheets and images of pages whose parent is important, as new links."""

    @F.pandas_udf("array<struct<url:string,kind:int>>")
    def found(body: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([[{"url": x, "kind": k} for k, n in ((2, "css"), (3, "img")) for x in html.links(b, u, n)] for b, u in zip(body, base)])

    p = spread(_pages(spark, d).filter("url IS NOT NULL").select("archive_id", "url", "html"))
    return p.select("archive_id", F.explode(found("html", "url")).alias("x")).select("archive_id", "x.url", "x.kind").distinct()


@query()
def r138_main_content(spark, d):
    @F.pandas_udf("string")
    def content(body: pd.Series) -> pd.Series:
        return body.map(html.main_content)

    p = spread(_pages(spark, d).select("archive_id", "html"))
    return p.select("archive_id", content("html").alias("content"))


@query()
def r139_term_counts(spark, d):
    return simhash.term_counts(table(spark, d, "archive_data"), "archive_id", "title", "cdoc").groupBy("term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"))


@query()
def r140_simhash(spark, d):
    return simhash.simhashes(table(spark, d, "archive_data"), "archive_id", "title", "cdoc")


@query(
    """SELECT archive_id, md5(coalesce(regexp_extract(host, '([^.]+\\.[^.]+)$', 1), '')) AS domain_sign, md5(coalesce(title, '')) AS title_sign, md5(coalesce(cdoc, '')) AS content_sign
FROM archive_data WHERE host IS NOT NULL AND NOT regexp_matches(host, '^[0-9.]+$')"""
)
def r141_page_signature(spark, d):
    a = table(spark, d, "archive_data").filter("host IS NOT NULL AND NOT host RLIKE '^[0-9.]+$'")
    sign = lambda c: F.md5(F.coalesce(c, F.lit("")))
    return a.select("archive_id", sign(urls.host_parts(F.col("host"))["domain"]).alias("domain_sign"), sign(F.col("title")).alias("title_sign"), sign(F.col("cdoc")).alias("content_sign"))


@query(
    """SELECT archive_id FROM archive_data a JOIN (SELECT md5(cdoc) AS s, min(length(url)) AS l FROM archive_data WHERE cdoc <> '' GROUP BY 1 HAVING count(*) > 1) b
ON md5(a.cdoc) = b.s WHERE a.cdoc <> '' AND length(a.url) > b.l"""
)
def r142_bad_pages(spark, d):
    a = table(spark, d, "archive_data").filter("cdoc <> ''").select("archive_id", "url", F.md5("cdoc").alias("s"))
    bad = a.groupBy("s").agg(F.min(F.length("url")).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("s", "least")
    return simhash.bad_pages(a, bad, "s", "url", "least").select("archive_id")


@query()
def r143_near_pairs(spark, d):
    """Pairs of class representatives (distinct simhashes) within three bits."""
    return simhash.near_pairs(simhash.simhashes(table(spark, d, "archive_data"), "archive_id", "title", "cdoc"))


@query()
def r144_assigned_classes(spark, d):
    """Each page with its class: the least id of the pages with its simhash."""
    s = simhash.simhashes(table(spark, d, "archive_data"), "archive_id", "title", "cdoc")
    per = s.groupBy("simhash").agg(F.min("archive_id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
    return s.join(per, "simhash").select("archive_id", "simhash", "class_id", "copies")


@query("SELECT archive_id, cdoc AS text FROM archive_data WHERE cdoc IS NOT NULL")
def r145_to_text(spark, d):
    """Bodies of bytes back to text by the charset they declare.

    A body is in its original_encoding and declares it, where that holds the text; else it is UTF-8
    and declares that, or the unknown name it came with.
    """

    @F.pandas_udf("struct<b:binary,declared:string>")
    def coded(text: pd.Series, name: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([html.to_bytes(t, n) for t, n in zip(text, name)], columns=["b", "declared"])

    a = table(spark, d, "archive_data").filter("cdoc IS NOT NULL")
    a = spread(a.select("archive_id", "cdoc", "original_encoding"))
    return _to_text(a.select("archive_id", coded("cdoc", "original_encoding").alias("x")).select("archive_id", "x.*"))


def _to_text(bodies):
    @F.pandas_udf("string")
    def text(body: pd.Series, declared: pd.Series) -> pd.Series:
        return pd.Series([html.to_text(b, c) for b, c in zip(body, declared)])

    return spread(bodies).select("archive_id", text("b", "declared").alias("text"))


@query("SELECT archive_id, length(coalesce(title, '')) || ' ' || length(coalesce(cdoc, '')) AS sizes FROM archive_data")
def r146_content_sizes(spark, d):
    n = lambda c: F.length(F.coalesce(c, F.lit("")))
    return table(spark, d, "archive_data").select("archive_id", F.concat_ws(" ", n("title"), n("cdoc")).alias("sizes"))


@query(f"SELECT a.archive_id, g.n AS anchors FROM archive_data a JOIN (SELECT host, max(n) AS n FROM (SELECT {host_sql('url')} AS host, ref_url, count(*) AS n FROM pv WHERE ref_url <> '' GROUP BY ALL) GROUP BY host HAVING max(n) >= 10) g ON a.host = g.host", PV)
def r147_graph_enrichment(spark, d):
    """Pages with the count of their host's most frequent referer, from ten on."""
    pv = pv_log(spark, d).filter("ref_url <> ''").groupBy(urls.host(F.col("url")).alias("host"), "ref_url").agg(F.count(F.lit(1)).alias("n"))
    g = pv.groupBy("host").agg(F.max("n").alias("anchors")).filter("anchors >= 10")
    return table(spark, d, "archive_data").select("archive_id", "host").join(g, "host").select("archive_id", "anchors")


@query("SELECT rec_id, CASE WHEN item_id <> '' THEN 'http://item.shop.example/item.htm?id=' || item_id END AS detail, CASE WHEN item_id <> '' THEN 'http://m.shop.example/i' || item_id || '.htm' END AS mobile FROM product_info")
def r133_item_urls(spark, d):
    p = table(spark, d, "product_info").withColumn("u", F.concat(F.lit("http://item.shop.example/item.htm?spm=a&id="), "item_id", F.lit("&x=1")))
    return p.select("rec_id", shops.item_detail(F.col("u")).alias("detail"), shops.mobile(F.col("u")).alias("mobile"))


@query("SELECT rec_id, 'http://list.shop.example/s?q=' || seller_id || '&s=' || (i * 44) AS url FROM product_info, (SELECT unnest(range(1, 4)) AS i) WHERE seller_id <> ''")
def r184_list_expansion(spark, d):
    """The next three list pages of each seller."""
    p = table(spark, d, "product_info").filter("seller_id <> ''")
    u = F.concat(F.lit("http://list.shop.example/s?s=44&q="), "seller_id")
    return p.select("rec_id", F.explode(shops.next_pages(u, 3, 44)).alias("url"))


@query("SELECT rec_id, item_id, title FROM product_info")
def r134_json_page(spark, d):
    """Items of JSON list pages, wrapped in a callback."""
    p = table(spark, d, "product_info")
    items = F.to_json(F.struct(F.array(F.struct("item_id", "title", "price")).alias("items"), F.lit(7).alias("page_count")))
    page = p.select("rec_id", F.concat(F.lit("jsonp12("), items, F.lit(");")).alias("body")).withColumn("x", shops.json_page(F.col("body")))
    return page.select("rec_id", F.explode("x.items").alias("i")).select("rec_id", "i.item_id", "i.title")


@query("SELECT rec_id, CAST(rec_id % 100 AS INTEGER) AS pages FROM product_info")
def r135_page_count(spark, d):
    body = F.concat(F.lit("<em>1</em> 共"), (F.col("rec_id") % 100).cast("string"), F.lit("页"))
    return table(spark, d, "product_info").select("rec_id", shops.page_count(body).alias("pages"))


@query("SELECT rec_id, TRY_CAST(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE) AS price FROM product_info")
def r136_price(spark, d):
    return table(spark, d, "product_info").select("rec_id", shops.price(F.col("price")).alias("price"))


@query()
def r182_page_projection(spark, d):
    """Title, text and distinct links of style sheets, images and anchors, in document order, of every page with a body."""
    return _projection(_pages(spark, d).filter("cdoc <> ''"))


def _projection(pages):
    @F.pandas_udf("struct<title:string,text:string,css:array<string>,img:array<string>,anchors:array<string>>")
    def parsed(body: pd.Series, base: pd.Series) -> pd.DataFrame:
        def text(n):
            return "".join(x.text for x in html._leaves(n)) if not html._hidden(n) else ""

        def find(n, cls):
            if n.attrs.get("class") == cls:
                return n
            return next((r for k in n.kids if (r := find(k, cls)) is not None), None)

        rows = []
        for b, u in zip(body, base):
            t = html.parse(b)
            links = [html.links(t, u or "", kind) for kind in ("css", "img", "a")]
            rows.append((" ".join(t.title.split())[:1024], text(find(t.root, "text") or t.root)[:1048576], *links))
        return pd.DataFrame(rows, columns=["title", "text", "css", "img", "anchors"])

    return spread(pages.select("archive_id", "url", "html")).select("archive_id", parsed("html", "url").alias("x")).select("archive_id", "x.*")
