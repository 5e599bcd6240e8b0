"""Operators on rows that their SQL or their first form left out."""

import hashlib
import json
from urllib.parse import quote_plus

from gleaner.functions import html
from gleaner.operators import drift
from gleaner.plans import content, filters, general, join_queries, source_queries
from test_general import batches


def test_consistent_table_keeps_unlisted_fields(spark, tmp_path):
    files = {
        ("f", 1): [{"rec_no": 1, "response_code": 404, "agent": {"name": "a"}}, {"rec_no": 2, "response_code": 301}],
        ("f", 2): [{"rec_no": 1, "status": 404, "css": ["x", "y"], "ver": "2.1"}, {"rec_no": 2, "status": 301, "css": None}],
        ("f", 3): [{"rec_no": 2, "o'k": 301}, {"rec_no": 1, "o'k": 404}],
    }
    b = batches(spark, files)
    assert drift.derived_aliases(b)["response_code"] == ["response_code", "http_code", "o'k", "status"]
    b.write.parquet(str(tmp_path / "raw_batches.parquet"))
    got = {(r.batch_no, r.rec_no): r for r in general.p5_table(spark, str(tmp_path)).collect()}
    assert [got[k].response_code for k in sorted(got)] == [404, 301, 404, 301, 404, 301]
    assert json.loads(got[1, 1].others) == {"agent": {"name": "a"}}
    assert got[2, 1].others == '{"css":["x","y"],"ver":"2.1"}'  # types stay, names sorted
    assert got[3, 2].others == "{}"


def test_alias_of_two_quantities_goes_with_the_majority(spark):
    names = [("score", "w"), ("w", "score"), ("dns_time", "w"), ("x", "dns_time"), ("x", "score")]
    files = {}
    for i, (old, new) in enumerate(names):
        files |= {(f"f{i}", 1): [{"rec_no": 1, old: 0.5}], (f"f{i}", 2): [{"rec_no": 1, new: 0.5}]}
    derived = drift.derived_aliases(batches(spark, files))
    assert "w" in derived["score"] and "w" not in derived["dns_time"]
    assert all("x" not in of for of in derived.values())


def test_consistent_table_keeps_values_that_casts_refuse(spark):
    records = [
        {"rec_no": 1, "crawl_time": "4.331s", "simhash": "0c3900b5f529080", "dns_time": None},
        {"rec_no": 2, "fetch_seconds": "soon", "page_sig": "ff00000000000000", "score": "0.5"},
        {"rec_no": "x", "response_code": "4o4", "http_code": 200, "header_size": 5.5, "simhash": "-9"},
        {"rec_no": 4, "simhash": "1234567890123456789", "link_score": 0.25, "page_score": 0.75, "score": 0.25},
        {"rec_no": 5, "simhash": "not one", "crawl_time": "1.2.3s", "is_truncated": "maybe"},
    ]
    got = drift.consistent_table(batches(spark, {("f", 1): records})).orderBy("raw_id").collect()
    assert [r.crawl_time for r in got] == [4.331, None, None, None, None]
    assert [r.simhash for r in got] == [0x0C3900B5F529080, 0xFF00000000000000 - 2**64, -9, 1234567890123456789, None]
    assert [(r.response_code, r.score, r.rec_no) for r in got[1:4]] == [(None, 0.5, 2), (200, None, None), (None, 0.25, 4)]
    assert [r.others for r in got] == [
        {},
        {"fetch_seconds": "soon"},
        {"rec_no": "x", "response_code": "4o4", "header_size": "5.5"},
        {"page_score": "0.75"},
        {"simhash": "not one", "crawl_time": "1.2.3s", "is_truncated": "maybe"},
    ]


def test_search_queries_of_all_scripts(spark, tmp_path):
    words = ["水杯", "café crème", "ночной автобус", "night bus 7", "50% off", "a&b=c#d", "C++", "   ", "ナイト"]
    links = [f"http://e.example/s?x=1&q={quote_plus(w)}" for w in words] + ["http://e.example/x?q=a", None, "", "http://e.example/s?q=%CB%AE%B1%AD+A", "http://e.example/s?q=100%"]
    n = spark.createDataFrame(list(enumerate(links)), "new_id bigint, clicked_url string")
    n.write.parquet(str(tmp_path / "new_url.parquet"))
    got = {r.new_id: r.query for r in filters.r112_search_query(spark, str(tmp_path)).collect()}
    assert got == {i: w.lower() for i, w in enumerate(words) if w.strip()} | {len(words) + 3: "水杯 a", len(words) + 4: "100%"}


def test_every_address_of_a_host_can_be_chosen(spark, tmp_path):
    jobs = [(f"http://{h}.example/{i}", f"10.0.0.{i % n}") for h, n in (("a", 40), ("b", 3)) for i in range(80)]
    jobs += [("http://c.example/", ""), ("http://d.example/", None), (None, "10.9.9.9"), ("", "10.9.9.8")]
    links = [f"http://{h}.example/p{i}" for h in "abcd" for i in range(400)] + [None, "", "x"]
    spark.createDataFrame(jobs, "url string, ip string").write.parquet(str(tmp_path / "crawl_job.parquet"))
    spark.createDataFrame(list(enumerate(links)), "new_id bigint, clicked_url string").write.parquet(str(tmp_path / "new_url.parquet"))
    book = {h: sorted({ip for u, ip in jobs if ip and u and u.startswith(f"http://{h}.")}) for h in "ab"}
    want = {}
    for i, u in enumerate(links[:800]):
        ips = book[u[7]]
        want[i] = ips[int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % len(ips)]
    got = [r for r in join_queries.r057_host_to_ip(spark, str(tmp_path)).collect() if r.new_id < 1600]
    assert len(got) == 800 and {r.new_id: r.ip for r in got} == want
    assert set(want.values()) == {f"10.0.0.{i}" for i in range(40)}


def test_links_of_pages_of_any_scheme(spark, tmp_path):
    pages = ["http://a.example/x", "https://b.example:8443/y?z=1", "HTTPS://c.example/", "", None, "ftp://d.example/"]
    rows = [(i, u, "h", "t", "text") for i, u in enumerate(pages)]
    spark.createDataFrame(rows, "archive_id bigint, url string, host string, title string, cdoc string").write.parquet(str(tmp_path / "archive_data.parquet"))
    got = [tuple(r) for r in content.r130_links(spark, str(tmp_path)).orderBy("archive_id", "link").collect()]
    roots = ["http://a.example", "https://b.example:8443", "https://c.example"]
    assert got == [(i, f"{u}{x}") for i, u in enumerate(roots) for x in ("", "/list?p=1")]


def test_foreign_anchors_with_any_character(spark, tmp_path):
    referers = ["http://a.example/s?q=1&lt=2&copy;=3", "http://a.example/x y", "http://a.example/<b>\"q\"", "http://a.example/it's", "http://w.own.test/?a&b", "https://a.example/z?&amp;", None, ""]
    rows = [(i, "https://www.own.test/p", r) for i, r in enumerate(referers)]
    spark.createDataFrame(rows, "new_id bigint, clicked_url string, referer string").write.parquet(str(tmp_path / "new_url.parquet"))
    got = {r.new_id: r.link for r in source_queries.r129_foreign_anchors(spark, str(tmp_path)).collect()}
    assert got == {i: r for i, r in enumerate(referers) if r and "own.test" not in r}

ARCHIVE = "archive_id bigint, url string, host string, original_encoding string, title string, cdoc string"


def test_bodies_of_all_charsets_round_trip(spark, tmp_path):
    texts = ["plain", "水杯 台灯", "ночь", "café ½", "ナイトバス", "", "mixed 水 ночь é"]
    names = ["UTF-8", "GB18030", "CP936", "Big5", "LATIN-1", "KOI8-R", "SHIFT_JIS", "UTF-16", "ASCII", "x-unknown", "", None]
    cases = [(t, n) for t in texts for n in names] + [(None, "UTF-8")]
    rows = [(i, "http://a.example/", "a", n, "t", t) for i, (t, n) in enumerate(cases)]
    spark.createDataFrame(rows, ARCHIVE).write.parquet(str(tmp_path / "archive_data.parquet"))
    got = {r.archive_id: r.text for r in content.r145_to_text(spark, str(tmp_path)).collect()}
    assert got == {i: t for i, (t, _) in enumerate(cases) if t is not None}
    assert html.to_bytes("水杯", "gbk") == ("水杯".encode("gbk"), "gbk")  # not UTF-8 under another name
    assert html.to_bytes("水杯", "LATIN-1") == ("水杯".encode(), "utf-8")


def test_every_page_is_projected_with_its_links(spark, tmp_path):
    pages = [("a  b", "x  y "), ("，Ａ", "全角！Ｂ — …"), (None, "é & <b>"), ("", "\ttab"), ("t" * 2000, "z" * 1048580), ("no body", ""), ("none", None)]
    rows = [(i, "https://a.example/d/x" if i != 2 else None, "a", None, t, c) for i, (t, c) in enumerate(pages)]
    spark.createDataFrame(rows, ARCHIVE).write.parquet(str(tmp_path / "archive_data.parquet"))
    got = {r.archive_id: r for r in content.r182_page_projection(spark, str(tmp_path)).collect()}
    assert {i: (r.title, r.text) for i, r in got.items()} == {i: (" ".join((t or "").split())[:1024], c[:1048576]) for i, (t, c) in enumerate(pages) if c}
    for i, r in got.items():
        want = (["/main.css"], ["/logo.png"], ["", "/list?p=1"]) if i != 2 else ([], [], [])
        assert (r.css, r.img, r.anchors) == tuple([f"https://a.example{x}" for x in of] for of in want)
