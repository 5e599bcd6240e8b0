"""Search engines, searches inside sites, clicks and suffixes against known urls."""

from urllib.parse import quote

from pyspark.sql import functions as F

from gleaner.functions import urls
from gleaner.operators import books

SEARCHES = {
    "http://www.google.com/search?hl=en&q=night+bus&start=10": ("google", "general", "night bus"),
    "https://www.google.co.uk/#hl=en&q=Caf%C3%A9": ("google", "general", "café"),
    "http://images.google.com/images?q=lamp": ("google", "vertical", "lamp"),
    "http://www.baidu.com/s?wd=" + quote("水杯".encode("gbk")) + "&pn=10": ("baidu", "general", "水杯"),
    "http://www.baidu.com/s?wd=" + quote("水杯") + "&ie=utf-8": ("baidu", "general", "水杯"),
    "http://www.baidu.com/s?ie=gb2312&word=" + quote("台灯".encode("gbk")): ("baidu", "general", "台灯"),
    "http://zhidao.baidu.com/search?word=x%20%20Y": ("baidu", "vertical", "x y"),
    "http://www.sogou.com/web?query=%u6C34%u676F&page=2": ("sogou", "general", "水杯"),
    "http://www.so.com/s?q=100%": ("so", "general", "100%"),
    "http://cn.bing.com/search?q=a%26b&first=11": ("bing", "general", "a&b"),
    "http://yandex.ru/yandsearch?text=%D0%BD%D0%BE%D1%87%D1%8C&p=1": ("yandex", "general", "ночь"),
    "http://www.baidu.com/s?wd=": None,
    "http://www.baidu.com/": None,
    "http://www.other.example/s?wd=x": None,
    "": None,
}
SITES = {
    "http://s.taobao.com/search?q=" + quote("水杯".encode("gbk")): ("taobao", "水杯"),
    "http://search.jd.com/Search?keyword=%E5%8F%B0%E7%81%AF&enc=utf-8": ("jd", "台灯"),
    "http://search.suning.com/lamp/cityId=9017": ("suning", "lamp"),
    "http://s.weibo.com/weibo/%25E6%25B0%25B4": ("weibo", "%e6%b0%b4"),
    "http://www.amazon.com/s?k=night+lamp": ("amazon", "night lamp"),
    "http://en.wikipedia.org/w/index.php?search=%u6C34": ("wikipedia", "水"),
    "http://www.jd.com/": None,
}
G = "http://www.google.com/search?q=x"
CLICKS = {
    ("http://a.example/", G): True,
    ("http://www.youtube.com/watch", G): False,
    ("http://maps.google.com/x", G): False,
    ("http://a.example/?gclid=1", G): False,
    (G, G): False,
    ("http://www.baidu.com/s?wd=y", G): False,
    ("http://a.example/", "http://images.google.com/images?q=lamp"): False,
    ("http://a.example/", "http://b.example/"): False,
    ("", G): False,
}
PAGES = {
    "http://www.baidu.com/s?wd=x": True, "http://www.baidu.com/s?wd=x&pn=10": True, "http://www.baidu.com/s?wd=x&pn=20": False,
    "http://www.sogou.com/web?query=x&page=2": True, "http://www.sogou.com/web?query=x&page=3": False,
    "http://www.bing.com/search?q=x&first=11": True, "http://www.bing.com/search?q=x&first=21": False,
    "http://www.so.com/s?q=x&pn=two": False, "http://other.example/s?q=x": False,
}
HOSTS = {
    "www.a.com": ("com", "a.com", "www"), "x.y.a.com.cn": ("com.cn", "a.com.cn", "x.y"), "a.co.uk": ("co.uk", "a.co.uk", ""), "www.a.or.jp": ("or.jp", "a.or.jp", "www"),
    "a.gd.cn": ("gd.cn", "a.gd.cn", ""), "b.a.de": ("de", "a.de", "b"), "com.de": ("de", "com.de", ""), "a.com.pl": ("com.pl", "a.com.pl", ""), "a.example": ("example", "a.example", ""),
    "10.0.0.1": (None, None, None), "localhost": (None, None, None), "co.uk": (None, None, None),
}


def test_books(spark):
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    u = F.col("u")
    got = {r.u: tuple(r.s) if r.s else None for r in one([(x,) for x in SEARCHES], "u string").select("u", books.search(u).alias("s")).collect()}
    assert got == SEARCHES
    got = {r.u: tuple(r.s) if r.s else None for r in one([(x,) for x in SITES], "u string").select("u", books.site_search(u).alias("s")).collect()}
    assert got == SITES
    got = {(r.t, r.r): r.c for r in one(list(CLICKS), "t string, r string").select("t", "r", books.search_click(F.col("t"), F.col("r")).alias("c")).collect()}
    assert got == CLICKS
    got = {r.u: r.p for r in one([(x,) for x in PAGES], "u string").select("u", books.within_pages(u, 2).alias("p")).collect()}
    assert got == PAGES
    nulls = one([(None, None)], "u string, r string").select(books.search(u), books.site_search(u), books.search_click(u, F.col("r")), books.within_pages(u, 1)).first()
    assert list(nulls) == [None, None, False, False]


def test_suffixes(spark):
    df = spark.createDataFrame([(h,) for h in HOSTS], "h string").select("h", urls.host_parts(F.col("h")).alias("p"))
    assert {r.h: tuple(r.p) for r in df.collect()} == HOSTS


def test_redirect_targets(spark):
    rows = {"http://e.example/link?url=http%3A%2F%2Fa.example%2F": "http://a.example/", "http://a.example/x": "http://a.example/x", "http://e.example/link?url=Zz9": None}
    df = spark.createDataFrame([(x,) for x in rows], "u string")
    assert {r.u: r.t for r in df.select("u", urls.redirect_target(F.col("u")).alias("t")).collect()} == rows
    keyed = urls.redirect_target(F.col("u"), lambda v: F.concat(F.lit("http://k.example/"), F.lower(v)))
    assert {r.u: r.t for r in df.select("u", keyed.alias("t")).collect()}["http://e.example/link?url=Zz9"] == "http://k.example/zz9"
