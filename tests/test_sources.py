"""Readers, codec, streams and small operators on rows of our own."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import html, shops, urls
from gleaner.operators import joins, matching, robots, rules, simhash, topn
from gleaner.sources import dump, text
from gleaner.streaming import jobs, limiter
from gleaner.streaming.limiter import DROP, FULL, OK, Limiter, Rule


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_tsv_with_dead_letters(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("m1\t5\tx\nm2\tzz\tx\n\t1\tx\nm3\t7\nm4\nm5\t1\ty\tz\n", encoding="utf-8")
    schema = T.StructType([T.StructField("mid", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])
    good, bad = text.read_tsv(spark, str(tmp_path), schema, optional=1)
    assert {tuple(r) for r in good.collect()} == {("m1", 5, "x"), ("m3", 7, None)}
    assert sorted(r.reason for r in bad.collect()) == ["cast", "fields", "fields", "key"]


def test_routed_and_tagged(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n int, site string")
    text.write_routed(df, f"{tmp_path}/out", "site", rows_per_file=1)
    assert spark.read.parquet(f"{tmp_path}/out/site=a").count() == 2
    got = text.read_tagged(spark, {"x": (f"{tmp_path}/out/site=a", {"n": F.col("n")}), "y": (f"{tmp_path}/out/site=b", {"n": F.col("n"), "m": F.lit(1)})})
    assert sorted((r.src, r.n) for r in got.collect()) == [("x", 1), ("x", 3), ("y", 2)]
    good, bad = text.split_bad(df, F.when(F.col("n") > 2, "big"))
    assert good.count() == 2 and [r.reason for r in bad.collect()] == ["big"]


def test_dump_codec(spark):
    parts = {"brief": F.lit(b"abc").cast("binary"), "content": F.lit(b"").cast("binary"), "alt": F.lit(b"z" * 70000).cast("binary")}
    whole = bytes(one(spark, dump.encode(parts))[0])
    cases = [whole, whole[:-1], whole + b"x", whole[:7], b"", None, b"\x01" + whole[1:], whole[:8] + b"\xfe\xff\xff\xff" + whole[12:]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, value binary")
    got = {r.i: r for r in dump.decode(df, "value").collect()}
    assert [got[i].ok for i in range(8)] == [True] + [False] * 7
    assert (bytes(got[0].brief), bytes(got[0].content), got[0].graph, len(got[0].alt)) == (b"abc", b"", None, 70000)
    assert all(got[i].brief is None for i in range(1, 8))


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTP://A.Example:80/x#f", "http://a.example/x"),
        ("%20%20a.example", "http://a.example/"),
        ("https://a.example:443?q", "https://a.example/?q"),
        ("", None),
    ],
)
def test_normalize(spark, url, want):
    assert one(spark, urls.normalize(F.lit(url))) == (want,)


def test_url_parts(spark):
    assert one(spark, urls.reverse_url(F.lit("http://www.a.com.cn:8/x"))) == ("http://cn.com.a.www:8/x",)
    assert tuple(one(spark, urls.host_parts(F.lit("www.b.a.com.cn")))[0]) == ("com.cn", "a.com.cn", "www.b")
    assert tuple(one(spark, urls.host_parts(F.lit("a..cn")))[0]) == (None, None, None)
    assert one(spark, urls.ajax(F.lit("http://a/#!b")))[0] == "http://a/?_escaped_fragment_=b"
    assert one(spark, urls.storage_key(F.lit("http://a.example/")))[0][6:] == "-http://example.a/"
    assert one(spark, urls.tidy_anchor(F.lit(" http://a/x/#")))[0] == "http://a/x"


def test_search_queries(spark):
    q = lambda u: one(spark, rules.search_query(F.lit(u)))[0]
    assert q("http://e.example/s?x=1&q=Night++Bus%20es") == "night bus es"
    assert q("http://e.example/search?q=%E6%B0%B4%E6%9D%AF") == "水杯"
    assert q("http://e.example/s?q=") is None and q("http://e.example/x?q=a") is None
    assert one(spark, rules.filter_reason(F.lit("http://a.example/x.exe")))[0] == "suffix"
    assert one(spark, rules.filter_reason(F.lit("ftp://a.example/")))[0] == "scheme"
    assert one(spark, rules.filter_reason(F.lit("http://a.example/?token=1")))[0] == "parameter"


def test_shop_urls(spark):
    u = F.lit("http://l.example/s?s=44&sort=x&q=a")
    assert one(spark, shops.next_pages(u, 2, 60))[0] == ["http://l.example/s?sort=x&q=a&s=60", "http://l.example/s?sort=x&q=a&s=120"]
    assert one(spark, shops.item_list(u, ["q", "z"]))[0] == "http://l.example/s?q=a"
    assert len(one(spark, shops.sort_variants(u))[0]) == 5
    assert one(spark, shops.image_url(F.lit("http://i/a.jpg_220x220.jpg")))[0] == "http://i/a.jpg"
    assert one(spark, shops.price(F.lit("￥1,234.50")))[0] == 1234.5
    assert one(spark, shops.comment_link(F.lit("x1")))[0] is None


def test_html():
    page = "<html><head><title> A  b </title></head><body><div><a href='/'>Home</a><a href='x#f'>x</a><a href='javascript:y'>n</a></div><div><p>Long text that matters. " * 1 + "More words follow here.</p></div><script>no</script><div style='display: none'>hidden</div></body></html>"
    assert html.main_content(page) == "Long text that matters. More words follow here."
    assert html.title(page) == "A b"
    assert html.links(page, "http://a.example/d/") == ["http://a.example", "http://a.example/d/x"]
    assert html.main_content("") == "" and html.main_content("<p>unclosed") == "unclosed"
    assert html.to_text("水杯".encode("gbk"), None) == "水杯" and html.to_text(None, None) is None


def test_near_pairs_match_brute_force(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) - 2**63 for _ in range(60)]
    values = base + [b ^ (1 << r.randint(0, 62)) ^ (1 << r.randint(0, 62)) for b in base] + base[:10]
    want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(set(values), 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    got = {(x.a, x.b) for x in simhash.near_pairs(spark.createDataFrame([(v,) for v in values], "simhash bigint")).collect()}
    assert got == want and want


def test_robots_levels():
    text_ = "User-agent: *\nDisallow: /a\nAllow: /a/b\nDisallow: /*.gif$\n\nUser-agent: Mine\nDisallow: /\n"
    r = robots.Robots(text_)
    assert (r.level("other", "/a/x"), r.level("other", "/a/b/c"), r.level("other", "/x.gif"), r.level("mine-bot", "/")) == (2, 3, 2, 0)
    assert robots.Robots("").level("x", "/") == 1 and robots.Robots("User-agent: y\nDisallow: /").level("x", "/") == 1


def test_rate_limiter():
    lim = Limiter([Rule(2, 1.0)], burst=2, max_failures=2)
    assert lim.check(0) == OK
    lim.register(0)
    lim.register(1)
    assert lim.check(2) == 2_000_000 and lim.check(2_000_000) == FULL  # the frequency comes first
    lim.release(True)
    assert lim.check(2) == 2_000_000 and lim.check(2_000_000) == OK
    lim.release(False)
    lim.release(False)
    assert lim.check(3_000_000) == DROP
    assert Rule.parse("10.0.0.1 3 2.5 22:00-06:00")[1].holds(0) and not Rule.parse("10.0.0.1 3 2.5 22:00-06:00")[1].holds(43200)
    with pytest.raises(ValueError):
        Rule.parse("10.0.0.1 3 2.5")


def test_simulated_limits_hold(spark):
    t0 = dt.datetime(2014, 7, 1)
    r = random.Random(2)
    rows = [(f"ip{i % 3}", i, t0 + dt.timedelta(seconds=r.randint(0, 600))) for i in range(400)] + [(None, 999, t0)]
    df = spark.createDataFrame(rows, "ip string, id int, ts timestamp")
    got = limiter.simulate(df, "ip", "ts", "id", fetch_s=20, rules=[Rule(2, 0.1)], burst=3).collect()
    at = {i: t for _, i, t in rows}
    for ip in ("ip0", "ip1", "ip2"):
        ok = sorted(at[x.id] for x in got if x.ip == ip and x.decision == "ok")
        assert all(sum(0 <= (b - a).total_seconds() < 20 for b in ok) <= 2 for a in ok) and ok
    assert len(got) == 400


def test_as_of_and_nearest_with_ties_and_nulls(spark):
    t = lambda s: None if s is None else dt.datetime(2014, 7, 1) + dt.timedelta(seconds=s)
    left = spark.createDataFrame([("a", t(5), 1), ("a", t(0), 2), ("b", t(9), 3), ("a", None, 4)], "k string, ts timestamp, id int")
    right = spark.createDataFrame([("a", t(5), 10), ("a", t(5), 11), ("a", t(1), 12), (None, t(1), 13), ("a", None, 14)], "k string, ts timestamp, v int")
    assert {r.id: r.got for r in joins.as_of(left, right, ["k"], "ts", "id", "v", "got").collect()} == {1: 11, 2: None, 3: None, 4: None}
    assert {(r.id, r.v) for r in joins.nearest(left, right, ["k"], "id", "v", 3).collect()} == {(1, 10), (2, 12)}


def test_ranges_match_brute_force(spark):
    r = random.Random(3)
    ranges = [(a, a + r.randint(0, 200000)) for a in (r.randint(0, 10**6) for _ in range(30))]
    points = [r.randint(0, 1_300_000) for _ in range(500)]
    got = joins.in_ranges(spark.createDataFrame([(p,) for p in points], "n bigint"), spark.createDataFrame(ranges, "a bigint, z bigint"), "n", "a", "z")
    assert sorted(x.n for x in got.collect()) == sorted(p for p in points if any(a <= p <= z for a, z in ranges))


def test_cumulative_nodes_match_the_sequential_rule(spark):
    r = random.Random(4)
    rows = sorted(((f"k{i}", int(r.paretovariate(1))) for i in range(300)), key=lambda x: (-x[1], x[0]))
    average, node, total, want = sum(w for _, w in rows) / 7, 0, 0, {}
    for k, w in rows:
        want[k] = node
        total += w
        if node < 6 and total >= average * (node + 1):
            node += 1
    got = topn.cumulative_nodes(spark.createDataFrame(rows, "k string, w bigint").repartition(4), "w", "k", 7).collect()
    assert {x.k: x.node for x in got} == want


def test_greedy_passes(spark):
    s = spark.createDataFrame([("m", 1, 0.0, "q", ["a", "b"]), ("m", 2, 50.0, "r", ["c"])], "k string, sid int, ts double, query string, urls array<string>")
    c = spark.createDataFrame([("m", 7, 40.0, "q", ["a"]), ("m", 8, 52.0, "z", ["x"]), ("n", 9, 0.0, "q", ["a"])], "k string, cid int, ts double, query string, urls array<string>")
    assert {(x.sid, x.cid, x.step) for x in matching.greedy_match(s, c, ["k"]).collect()} == {(1, 7, 1), (2, 8, 3)}


def test_page_sessions(spark):
    t = lambda m: dt.datetime(2014, 7, 1) + dt.timedelta(minutes=m)
    rows = [("u", t(0), "http://x.a.example/1", "", 1), ("u", t(20), "http://y.a.example/2", "", 2), ("u", t(45), "http://z.other.example/", "", 3), ("u", t(46), "http://z.other.example/2", "", 4), ("v", t(0), "http://q.example/", "", 5), ("u", t(200), "http://q.example/9", "http://z.other.example/2", 6)]
    df = spark.createDataFrame(rows, "mid string, ts timestamp, url string, ref_url string, id int")
    assert {r.id: r.session for r in matching.page_sessions(df).collect()} == {1: 1, 2: 1, 3: 2, 4: 2, 5: 1, 6: 2}


def test_stream_dedup_refreshes(spark, tmp_path):
    t = lambda s: dt.datetime(2014, 7, 1) + dt.timedelta(seconds=s)
    rows = [(1, "u", t(0)), (2, "u", t(50)), (3, "u", t(100)), (4, "w", t(0)), (5, "u", t(120)), (6, "u", t(201))]
    spark.createDataFrame(rows, "job_id bigint, url string, at timestamp").coalesce(1).write.parquet(f"{tmp_path}/jobs.parquet")
    s = jobs.dedup_refreshing(jobs.read_stream(spark, str(tmp_path), "jobs"), F.col("url"), "at", "job_id", 100)
    assert {r.id for r in jobs.run(s, "t").collect()} == {1, 3, 4, 6}


def test_routes(spark, tmp_path):
    df = spark.createDataFrame([(1, 200, 0), (2, 500, 0), (3, 500, 2), (4, 404, 0), (5, None, 1)], "id int, response_code int, tries int")
    routed = jobs.route(df)
    assert {r.id: (r.target, r.tries) for r in routed.collect()} == {1: ("result", 0), 2: ("request", 1), 3: ("result", 2), 4: ("result", 0), 5: ("request", 2)}
    jobs.write_routes(routed, 0, {"request": f"{tmp_path}/a", "result": f"{tmp_path}/b"})
    assert spark.read.parquet(f"{tmp_path}/a").count() == 2


def test_registered_functions(spark):
    from gleaner.functions.registry import register

    assert "link_rows" in register(spark)
    page = "<title>T</title><a href=\"/x\">a</a><img src=\"i.png\">"
    spark.createDataFrame([(page, "http://a.example/"), (None, None)], "h string, u string").createOrReplaceTempView("pages_for_test")
    assert [tuple(r) for r in spark.sql("SELECT page_title(h), size(page_links(h, u)) FROM pages_for_test").collect()] == [("T", 1), (None, 0)]
    rows = spark.sql("SELECT l.link, l.kind FROM pages_for_test p, LATERAL link_rows(p.h, p.u) l").collect()
    assert {tuple(r) for r in rows} == {("http://a.example/x", "a"), ("http://a.example/i.png", "img")}
