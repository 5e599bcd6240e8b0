"""Shop urls and list pages: rewriting, paging and parsing, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.urls import query_param

# Sort orders of list pages.
SORTS = {"wide": ["default", "renqi-desc", "sale-desc", "credit-desc", "price-asc"], "narrow": ["s", "d", "p"]}


def item_detail(url: Column) -> Column:
    """An item's url with nothing but its id; null without one."""
    n = query_param(url, "id")
    return F.when(n.rlike("^[0-9]+$"), F.concat(F.substring_index(url, "?", 1), F.lit("?id="), n))


def mobile(url: Column) -> Column:
    """The mobile form of an item's url."""
    n = query_param(url, "id")
    host = F.regexp_extract(url, r"^https?://[^./]*\.([^/:?#]+)", 1)
    return F.when(n.rlike("^[0-9]+$") & (host != ""), F.concat(F.lit("http://m."), host, F.lit("/i"), n, F.lit(".htm")))


def item_list(url: Column, keep: list[str]) -> Column:
    """A list url with only the parameters of `keep`, in that order."""
    parts = [F.when(query_param(url, k) != "", F.concat(F.lit(f"{k}="), query_param(url, k))) for k in keep]
    q = F.concat_ws("&", *parts)
    base = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    return F.when(q == "", base).otherwise(F.concat(base, F.lit("?"), q))


def without_param(url: Column, name: str) -> Column:
    u = F.regexp_replace(url, rf"([?&]){name}=[^&#]*", "$1")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(u, r"&{2,}", "&"), r"\?&", "?"), r"[?&]$", "")


def with_param(url: Column, name: str, value: Column) -> Column:
    bare = without_param(url, name)
    return F.concat(bare, F.when(bare.contains("?"), F.lit("&")).otherwise(F.lit("?")), F.lit(f"{name}="), value)


def next_pages(url: Column, pages: int, size: int, name: str = "s") -> Column:
    """The next `pages` list pages: the offset parameter set to (i + 1) * size."""
    return F.transform(F.sequence(F.lit(1), F.lit(pages)), lambda i: with_param(url, name, (i * size).cast("string")))


def sort_variants(url: Column, kind: str = "wide") -> Column:
    return F.array(*[with_param(url, "sort", F.lit(s)) for s in SORTS[kind]])


def comment_link(item_id: Column) -> Column:
    return F.when(item_id.rlike("^[0-9]+$"), F.format_string("http://rate.shop.example/feed?auctionNumId=%s&currentPageNum=1", item_id))


def image_url(url: Column) -> Column:
    """The original of a scaled image: '_220x220.jpg' after the name goes."""
    return F.regexp_replace(url, r"(\.(?:jpg|png|gif|jpeg))_[0-9]+x[0-9]+[a-z0-9]*\.(?:jpg|webp)$", "$1")


def json_page(body: Column, item_schema: str = "item_id string, title string, price string") -> Column:
    """Items and page count of a JSON list page, bare or wrapped in a callback."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(body), r"^[A-Za-z_$][\w$.]*\(", ""), r"\)\s*;?$", "")
    return F.from_json(bare, f"items array<struct<{item_schema.replace(' ', ':').replace(',:', ',')}>>, page_count int")


def page_count(html: Column, pattern: str = r"(?:共|of |页码\D{0,5})\s*([0-9]+)\s*(?:页|pages)?") -> Column:
    """The number of pages that a list page names; null if none."""
    return F.regexp_extract(html, pattern, 1).try_cast("int")


def price(text: Column) -> Column:
    """A price written freely: currency signs, thousands and spaces left out; null if it is none."""
    bare = F.regexp_replace(text, r"[^0-9.]", "")
    return bare.try_cast("double")
