"""Rule books as data: url filters, search engines, admission. First matching rule gives the reason."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import urls

# Banned query parameters, hosts and patterns of the default rule books.
BANNED_PARAMS = ["sid", "sessionid", "phpsessid", "jsessionid", "token"]
LOOSE_BOOK = [("calendar", r"/calendar/"), ("print", r"[?&]print=1"), ("login", r"/(login|logout|register)\b"), ("cart", r"/(cart|checkout)\b")]
STRICT_BOOK = LOOSE_BOOK + [("api", r"/api/"), ("sort", r"[?&](sort|order)="), ("archive", r"/archive/")]
# Parameters that carry a result page's number or offset, by engine host label.
PAGE_PARAMS = {"start": 10, "pn": 10, "first": 10, "page": 1, "pg": 1}
# Query parameters of search pages by path.
SEARCH_BOOK = [("/s", "q"), ("/search", "q"), ("/web", "query"), ("/find", "wd"), ("/s", "wd")]


def filter_reason(url: Column, strict: bool = False, max_length: int = 1024, max_depth: int = 10, restricted: list[str] | None = None, black: list[str] | None = None) -> Column:
    """Why a url is filtered, or null: the first of the rules in order that applies.

    too_long; bad_host (begins with '.', '%' or '+', or is empty); scheme (not http or https);
    restricted (host of the list, other than its home page); black (host of the list); depth;
    suffix; long_query; parameter; then the rules of the book by name.
    """
    h, p, q = urls.host(url), urls.path(url), urls.query(url)
    suffix = F.lower(F.regexp_extract(p, r"\.([A-Za-z0-9]+)$", 1))
    params = "|".join(BANNED_PARAMS)
    rules: list[tuple[str, Column]] = [
        ("too_long", F.length(url) > max_length),
        ("scheme", ~urls.scheme(url).isin("http", "https")),
        ("bad_host", (h == "") | h.rlike(r"^[.%+]")),
        ("restricted", h.isin(restricted or [""]) & ~p.isin("", "/")),
        ("black", h.isin(black or [""])),
        ("depth", urls.depth(url) >= max_depth),
        ("suffix", suffix.isin(urls.BANNED_SUFFIXES)),
        ("long_query", F.length(q) > 1000),
        ("parameter", F.lower(q).rlike(rf"(^|&)({params})=")),
        *[(name, url.rlike(pattern)) for name, pattern in (STRICT_BOOK if strict else LOOSE_BOOK)],
    ]
    out = None
    for name, cond in rules:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return F.when(url.isNull(), "null").otherwise(out)


def _search_value(url: Column) -> Column:
    """The query of a search page as it stands in the url, stray percent signs escaped; null if the url is none."""
    p = urls.path(url)
    u = F.regexp_replace(url, r"^(https?://[^/]*/)#", "$1?")
    hit = None
    for path, param in SEARCH_BOOK:
        value = urls.query_param(u, param)
        cond = (p == path) & (value != "")
        hit = F.when(cond, value) if hit is None else hit.when(cond, value)
    return F.regexp_replace(hit, r"%(?![0-9A-Fa-f]{2})", "%25")


def _plain(query: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(query), r"\s+", " "))
    return F.when(plain != "", plain)


def search_query(url: Column) -> Column:
    """The query of a search page, decoded as UTF-8, lower-case, single spaces; null if the url is none."""
    return _plain(F.try_url_decode(_search_value(url)))


def search_query_text(url: Column) -> Column:
    """As search_query, where escapes that are no UTF-8 are read as GB18030 (GBK), in Python for these only."""

    @F.pandas_udf("string")
    def gb18030(raw: pd.Series) -> pd.Series:
        def text(b: bytes | None) -> str | None:
            try:
                return b if b is None else b.decode("gb18030")
            except UnicodeDecodeError:
                return None

        return raw.map(text)

    value = F.replace(_search_value(url), F.lit("+"), F.lit(" "))
    parts = F.regexp_extract_all(value, F.lit("%[0-9A-Fa-f]{2}|[^%]+"), F.lit(0))
    digits = F.transform(parts, lambda t: F.when(t.startswith("%"), F.substring(t, 2, 2)).otherwise(F.hex(F.encode(t, "UTF-8"))))
    raw = F.unhex(F.array_join(digits, ""))
    utf8 = F.try_validate_utf8(raw.cast("string"))
    return _plain(F.coalesce(utf8, gb18030(F.when(utf8.isNull(), raw)), F.try_url_decode(_search_value(url))))


def within_pages(url: Column, n: int) -> Column:
    """Whether a search page is among the first n: an absent or empty page parameter passes."""
    ok = F.lit(True)
    for name, size in PAGE_PARAMS.items():
        v = urls.query_param(url, name)
        ok = ok & ((v == "") | (v.try_cast("bigint") <= (n - 1) * size + (0 if size > 1 else 1)))
    return ok


def is_vip(url: Column, kind: Column, source: Column, parent: Column, parent_source: Column) -> Column:
    """Pages: source S, A or E, a home page, or a parent that is a search page. Other types: the same of the parent, or source V."""
    top = lambda u, s: (u != "") & (s.isin("S", "A", "E") | (urls.path(u) == "/"))
    page = top(url, source) | search_query(parent).isNotNull()
    part = top(parent, parent_source) | (parent_source == "V")
    return F.coalesce(F.when(kind == 1, page).otherwise(part), F.lit(False))


def is_worthless(url: Column) -> Column:
    """Ads, trackers, search pages and session pages: nothing to learn from."""
    return url.rlike(r"^https?://(ads?|track|stat|log)[0-9]*\.") | url.rlike(r"[?&](utm_source|from)=") | search_query(url).isNotNull()
