"""Search engines, searches inside sites and redirects, told by books of rules.

Written from the engines' public url forms; every function takes another book. A rule names a host
(or the end of one), a path, the parameters that carry the query, and what is left of it undecoded.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import urls


@dataclass(frozen=True)
class Engine:
    """A search engine's result pages. page: parameter of the page (size 1) or of the first result (size: results a page)."""

    name: str
    host: str
    path: str
    params: tuple[str, ...]
    kind: str = "general"
    page: str = ""
    size: int = 1
    first: int = 0
    own: str = ""


# Public url forms of search engines.
ENGINES = (
    Engine("google", r"(www\.)?google\.[a-z.]+", r"/(search|webhp)?", ("q",), "general", "start", 10, 0, r"(.*\.)?(google\.[a-z.]+|youtube\.com|gstatic\.com)"),
    Engine("google", r"(images|news|video|scholar|maps)\.google\.[a-z.]+", r"/.*", ("q",), "vertical", "start", 10),
    Engine("bing", r"(www|cn)\.bing\.com", r"/search", ("q",), "general", "first", 10, 1, r"(.*\.)?(bing\.com|microsoft\.com|msn\.com)"),
    Engine("bing", r"(www|cn)\.bing\.com", r"/(images|videos|news|maps|shop)/?.*", ("q",), "vertical", "first", 10, 1),
    Engine("yahoo", r"([a-z]+\.)?search\.yahoo\.(com|co\.jp)", r"/search.*", ("p",), "general", "b", 10, 1, r"(.*\.)?yahoo\.(com|co\.jp)"),
    Engine("baidu", r"(www|m)\.baidu\.com", r"/(s|baidu|.*/s)", ("wd", "word"), "general", "pn", 10, 0, r"(.*\.)?(baidu\.com|hao123\.com|bdimg\.com|bdstatic\.com)"),
    Engine("baidu", r"(image|video|news|zhidao|tieba|wenku|baike|map|music|mp3)\.baidu\.com", r"/.*", ("word", "wd", "kw", "q", "key"), "vertical", "pn", 10),
    Engine("sogou", r"(www|m|wap)\.sogou\.com", r"/(web|sogou|web/.*)", ("query", "keyword"), "general", "page", 1, 1, r"(.*\.)?(sogou\.com|sohu\.com)"),
    Engine("sogou", r"(pic|news|v|weixin|zhishi|mp3)\.sogou\.com", r"/.*", ("query",), "vertical", "page", 1, 1),
    Engine("so", r"(www|m)\.so\.com", r"/s", ("q",), "general", "pn", 1, 1, r"(.*\.)?(so\.com|360\.cn|haosou\.com)"),
    Engine("so", r"(image|news|video|wenda|baike)\.so\.com", r"/.*", ("q",), "vertical", "pn", 1, 1),
    Engine("youdao", r"(www\.)?youdao\.com", r"/search", ("q",), "general", "start", 10, 0, r"(.*\.)?(youdao\.com|163\.com)"),
    Engine("soso", r"(www\.)?soso\.com", r"/q", ("w", "query"), "general", "pg", 1, 1, r"(.*\.)?(soso\.com|qq\.com)"),
    Engine("yandex", r"(www\.)?yandex\.[a-z.]+", r"/(search|yandsearch).*", ("text",), "general", "p", 1, 0, r"(.*\.)?(yandex\.[a-z.]+|ya\.ru)"),
    Engine("duckduckgo", r"(www\.)?duckduckgo\.com", r"/(html/?)?", ("q",), "general", "s", 30, 0, r"(.*\.)?duckduckgo\.com"),
    Engine("naver", r"search\.naver\.com", r"/search\.naver", ("query",), "general", "start", 10, 1, r"(.*\.)?naver\.com"),
    Engine("ask", r"(www\.)?ask\.com", r"/web", ("q",), "general", "page", 1, 1, r"(.*\.)?ask\.com"),
)

# Public url forms of searches inside sites: (site, host, pattern whose first group is the query).
SITES = (
    ("taobao", r"(s|list)\.taobao\.com", r"[?&](?:q|keyword)=([^&#]+)"),
    ("tmall", r"list\.tmall\.com", r"[?&]q=([^&#]+)"),
    ("jd", r"search\.jd\.com", r"[?&]keyword=([^&#]+)"),
    ("suning", r"search\.suning\.com", r"^[^?#]*//[^/]+/([^/?#]+)/"),
    ("dangdang", r"search\.dangdang\.com", r"[?&]key=([^&#]+)"),
    ("amazon", r"(www|m)\.amazon\.[a-z.]+", r"[?&](?:field-keywords|keywords|k)=([^&#]+)"),
    ("ebay", r"(www|m)\.ebay\.[a-z.]+", r"[?&](?:_nkw|kw)=([^&#]+)"),
    ("douban", r"(www|movie|book|music|search)\.douban\.com", r"[?&](?:q|search_text)=([^&#]+)"),
    ("zhihu", r"www\.zhihu\.com", r"/search\?(?:[^#]*&)?q=([^&#]+)"),
    ("weibo", r"s\.weibo\.com", r"/(?:weibo|user)/([^/?&#]+)"),
    ("youku", r"(www\.soku|so\.youku)\.com", r"/(?:v|search_video/q_)(?:\?keyword=|)([^/?&#]+)"),
    ("youtube", r"(www|m)\.youtube\.com", r"[?&]search_query=([^&#]+)"),
    ("wikipedia", r"[a-z-]+\.(?:m\.)?wikipedia\.org", r"[?&]search=([^&#]+)"),
    ("github", r"github\.com", r"/search\?(?:[^#]*&)?q=([^&#]+)"),
    ("stackoverflow", r"stackoverflow\.com", r"/search\?(?:[^#]*&)?q=([^&#]+)"),
    ("csdn", r"(so|www)\.csdn\.net", r"[?&]q=([^&#]+)"),
    ("58", r"[a-z]+\.58\.com", r"[?&]key=([^&#]+)"),
)


def decoded(raw: Column, declared: Column | None = None) -> Column:
    """Escaped text (%XX, %uXXXX, + for a blank) as text: by the charset it declares, else UTF-8, else GB18030; single spaces, lower case, null if nothing is left.

    Plain ASCII and UTF-8 stay with the engine's own expressions; only other bytes go to Python.
    """

    @F.pandas_udf("string")
    def other(values: pd.Series, charset: pd.Series) -> pd.Series:
        def text(b: bytes | None, name: str | None) -> str | None:
            if b is None:
                return None
            for c in (name, "gb18030"):
                try:
                    return b.decode(c) if c else None
                except (UnicodeDecodeError, LookupError):
                    continue
            return None

        out = []
        for b, name in zip(values, charset):
            got = text(b, name if isinstance(name, str) and name else None)
            out.append(got if got is not None or b is None else text(b, "gb18030"))
        return pd.Series(out, dtype=object)

    value = F.regexp_replace(F.replace(raw, F.lit("+"), F.lit(" ")), r"%(?!u[0-9A-Fa-f]{4}|[0-9A-Fa-f]{2})", "%25")
    parts = F.regexp_extract_all(value, F.lit("%u[0-9A-Fa-f]{4}|%[0-9A-Fa-f]{2}|[^%]+"), F.lit(0))
    wide = lambda t: F.hex(F.encode(F.decode(F.unhex(F.substring(t, 3, 4)), "UTF-16BE"), "UTF-8"))
    digits = F.transform(
        parts, lambda t: F.when(t.rlike("^%u"), wide(t)).when(t.startswith("%"), F.substring(t, 2, 2)).otherwise(F.hex(F.encode(t, "UTF-8")))
    )
    data = F.unhex(F.array_join(digits, ""))
    named = F.lower(declared) if declared is not None else F.lit("")
    utf8 = F.when(named.isin("", "utf-8", "utf8"), F.try_validate_utf8(data.cast("string")))
    ascii_ = F.when(~value.contains("%"), value)
    text = F.coalesce(ascii_, utf8, other(F.when(ascii_.isNull() & utf8.isNull(), data), named))
    plain = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.when(plain != "", plain)


def _raw(url: Column, rule: Engine) -> Column:
    values = [urls.query_param(url, p) for p in rule.params]
    return F.coalesce(*[F.when(v != "", v) for v in values])


def _first(url: Column, book: tuple[Engine, ...], value) -> Column:
    """`value(rule)` of the first rule that the url fits and that finds a query in it."""
    h, p = urls.host(url), urls.path(url)
    out = None
    for rule in book:
        fits = h.rlike(f"^(?:{rule.host})$") & p.rlike(f"^(?:{rule.path})$") & _raw(url, rule).isNotNull()
        out = F.when(fits, value(rule)) if out is None else out.when(fits, value(rule))
    return out


def _unfragmented(url: Column) -> Column:
    """Engines that keep the query behind '#': as if it stood behind '?'."""
    return F.regexp_replace(url, r"^(https?://[^/]*/[^?#]*)#", "$1?")


def search(url: Column, book: tuple[Engine, ...] = ENGINES) -> Column:
    """engine, kind ('general' or 'vertical') and query of a result page; null if the url is none."""
    u = _unfragmented(url)
    charset = F.coalesce(*[F.when(urls.query_param(u, p) != "", urls.query_param(u, p)) for p in ("ie", "enc", "charset")])
    query = decoded(_first(u, book, lambda r: _raw(u, r)), F.coalesce(charset, F.lit("")))
    name, kind = _first(u, book, lambda r: F.lit(r.name)), _first(u, book, lambda r: F.lit(r.kind))
    return F.when(query.isNotNull(), F.struct(name.alias("engine"), kind.alias("kind"), query.alias("query")))


def within_pages(url: Column, n: int, book: tuple[Engine, ...] = ENGINES) -> Column:
    """Whether a result page of a known engine is among its first n; unknown hosts and page numbers that are none fail."""
    u = _unfragmented(url)

    def place(rule: Engine) -> Column:
        v = urls.query_param(u, rule.page)
        last = rule.first + (n - 1) * rule.size if rule.size > 1 else rule.first + n - 1
        return (v == "") | (v.try_cast("bigint") <= last)

    return F.coalesce(_first(u, book, place), F.lit(False))


def search_click(target: Column, referer: Column, book: tuple[Engine, ...] = ENGINES) -> Column:
    """Whether a page was reached from a general result page and is no page of that engine, no result page and no advertisement link."""
    r = _unfragmented(referer)
    own = _first(r, book, lambda x: F.lit(f"^(?:{x.own or x.host})$"))
    general = _first(r, book, lambda x: F.lit(x.kind == "general"))
    host = urls.host(target)
    away = (host != "") & ~F.regexp_like(host, own) & _first(_unfragmented(target), book, lambda x: F.lit(True)).isNull()
    return F.coalesce(general & away & ~target.rlike(r"[?&](gclid|msclkid|bd_vid)=|/aclk\?"), F.lit(False))


def site_search(url: Column, book=SITES) -> Column:
    """site and query of a search inside a site; null if the url is none."""
    h = urls.host(url)
    name = raw = None
    for site, host, pattern in book:
        got = F.regexp_extract(url, pattern, 1)
        fits = h.rlike(f"^(?:{host})$") & (got != "")
        name = F.when(fits, site) if name is None else name.when(fits, site)
        raw = F.when(fits, got) if raw is None else raw.when(fits, got)
    query = decoded(raw)
    return F.when(query.isNotNull(), F.struct(name.alias("site"), query.alias("query")))
