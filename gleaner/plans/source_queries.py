"""Sources and sinks through files (1, 2, 11, 12, 116, 129)."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import html, urls
from gleaner.plans.base import host_sql, query
from gleaner.session import shared_dir, spread
from gleaner.sources import dump, table, text


@query("SELECT event_id, user_id, event_type, value FROM events")
def r001_tsv_scan(spark, d):
    """Events written as TSV and read again with types and a dead-letter side."""
    at = f"{shared_dir(spark)}/tsv-{uuid.uuid4().hex}"
    fields = ["event_id", "user_id", "event_type", "value"]
    line = F.concat_ws("\t", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    table(spark, d, "events").select(line.alias("value")).write.text(at)
    types = [T.LongType(), T.LongType(), T.StringType(), T.DoubleType()]
    good, _ = text.read_tsv(spark, at, T.StructType([T.StructField(f, t) for f, t in zip(fields, types)]))
    return good


@query(
    """SELECT 'job' AS src, url, priority FROM crawl_job UNION ALL SELECT 'new', clicked_url, NULL FROM new_url UNION ALL SELECT 'status', clicked_url, priority FROM crawl_status"""
)
def r002_tagged_inputs(spark, d):
    return text.read_tagged(
        spark,
        {
            "job": (f"{d}/crawl_job.parquet", {"url": F.col("url"), "priority": F.col("priority")}),
            "new": (f"{d}/new_url.parquet", {"url": F.col("clicked_url")}),
            "status": (f"{d}/crawl_status.parquet", {"url": F.col("clicked_url"), "priority": F.col("priority")}),
        },
    ).select("src", "url", "priority")


@query("SELECT archive_id, 'content' AS family, cdoc AS value FROM archive_data WHERE cdoc IS NOT NULL UNION ALL SELECT archive_id, 'alt', title FROM archive_data WHERE title IS NOT NULL")
def r011_dump_to_rows(spark, d):
    """Flat pages re-encoded as dumps, and the dumps' parts as rows."""
    a = table(spark, d, "archive_data")
    coded = a.select("archive_id", dump.encode({"content": F.encode("cdoc", "UTF-8"), "alt": F.encode("title", "UTF-8")}, version=-2).alias("value"))
    parts = dump.decode(coded, "value").filter("ok").drop("value", "ok")
    return dump.family_rows(parts, "archive_id").withColumn("value", F.decode("value", "UTF-8"))


@query("SELECT link_from AS site, count(*) AS n FROM crawl_info WHERE link_from <> '' GROUP BY link_from")
def r012_multi_output(spark, d):
    """Rows routed into a folder per source, read back by folder."""
    at = f"{shared_dir(spark)}/routed-{uuid.uuid4().hex}"
    rows = table(spark, d, "crawl_info").filter("link_from <> ''").select("info_id", "url", F.col("link_from").alias("site"))
    text.write_routed(rows, at, "site", rows_per_file=1_000_000)
    schema = T.StructType([T.StructField("info_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("site", T.StringType())])
    return spark.read.schema(schema).parquet(at).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT DISTINCT CASE WHEN NOT contains(clicked_url, '/link?url=') THEN clicked_url WHEN regexp_matches(x, '^https?(://|%3[Aa]%2[Ff]%2[Ff])') THEN
replace(replace(replace(x, '%3A', ':'), '%2F', '/'), '%3F', '?') END AS target FROM (SELECT clicked_url, regexp_extract(clicked_url, '[?&]url=([^&#]*)', 1) AS x FROM new_url WHERE clicked_url <> '')"""
)
def r116_plain_targets(spark, d):
    """Targets of urls: of redirect links the url they carry, null where it is scrambled (`urls.redirect_target` takes a key); others pass."""
    u = F.col("clicked_url")
    return table(spark, d, "new_url").filter(u != "").select(urls.redirect_target(u).alias("target")).distinct()


@query()
def r129_foreign_anchors(spark, d):
    """Anchors of a page that lead to another domain than its own."""
    return _foreign_anchors(table(spark, d, "new_url"))


def _foreign_anchors(new_urls):
    @F.pandas_udf("array<string>")
    def found(body: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([html.links(b, u) for b, u in zip(body, base)])

    n = new_urls.filter("referer LIKE 'http%' AND clicked_url LIKE 'http%'")
    escaped = F.col("referer")
    for c, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&#39;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(c), F.lit(entity))
    body = F.concat(F.lit("<a href='/own'>o</a><a href='"), escaped, F.lit("'>r</a>"))
    pages = spread(n.select("new_id", "clicked_url", body.alias("html")))
    links = pages.select("new_id", "clicked_url", F.explode(found("html", "clicked_url")).alias("link"))
    last_two = lambda u: F.regexp_extract(urls.host(u), r"([^.]+\.[^.]+)$", 1)
    return links.filter(last_two(F.col("link")) != last_two(F.col("clicked_url"))).select("new_id", "link")
