"""URL functions as Column expressions: parts, normal forms, keys and shards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*)://"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"
IPV4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"

# Labels below a country's that make a public suffix with it, countries that have none, other long suffixes.
SECOND_LEVEL = "com net org gov edu ac co mil or ne go gob gouv gov nom info biz name web sch school ltd plc me lg re pe firm gen ind id in asn res".split()
FLAT_COUNTRIES = "de fr nl be ch at dk se no fi cz eu us io me tv cc ws ru it es pt pl".split()
LONG_SUFFIXES = ["com.pl", "net.pl", "org.pl", "edu.pl", "gov.pl", "com.es", "org.es", "nom.es", "gob.es", "com.ru", "msk.ru", "spb.ru", "com.pt", "edu.pt", "gov.it", "edu.it", "asso.fr", "gouv.fr", "gv.at", "ac.at", "co.at", "or.at"]
PROVINCES = "bj sh tj cq he sx nm ln jl hl js zj ah fj jx sd ha hb hn gd gx hi sc gz yn xz sn gs qh nx xj tw hk mo".split()  # below cn
# Resource types by suffix.
CSS_SUFFIXES = ["css"]
IMAGE_SUFFIXES = ["jpg", "jpeg", "png", "gif", "bmp", "ico", "webp"]
BANNED_SUFFIXES = ["exe", "zip", "rar", "iso", "mp3", "mp4", "avi", "apk", "pdf", "doc", "xls"]


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME, 1))


def host(url: Column) -> Column:
    """Lower-case host without port and user; '' where there is none."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, QUERY, 1)


def query_param(url: Column, name: str) -> Column:
    """First value of a query parameter; '' where it is absent or empty."""
    return F.regexp_extract(url, rf"^[^?#]*\?(?:[^#]*&)?{name}=([^&#]*)", 1)


def is_ip(h: Column) -> Column:
    return h.rlike(IPV4)


def depth(url: Column) -> Column:
    """Number of non-empty path segments."""
    return F.size(F.filter(F.split(path(url), "/"), lambda x: x != ""))


def normalize(url: Column, max_length: int = 2048) -> Column:
    """Trimmed, without leading %XX, without fragment, http added, scheme and host in lower case, '/' as least path; null if too long or empty."""
    u = F.regexp_replace(F.trim(url), r"^(%[0-9A-Fa-f]{2})+", "")
    u = F.regexp_replace(u, r"(?s)#.*$", "")
    u = F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), u).otherwise(F.concat(F.lit("http://"), u))
    head = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1)
    rest = F.substr(u, F.length(head) + 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    head = F.regexp_replace(F.lower(head), r"^(http://.*):80$|^(https://.*):443$", "$1$2")
    return F.when((F.length(head) > 7) & (F.length(url) <= max_length), F.concat(head, rest))


def reverse_host(h: Column) -> Column:
    """Labels of a host in reverse; an address stays."""
    return F.when(is_ip(h), h).otherwise(F.array_join(F.reverse(F.split(h, r"\.")), "."))


def reverse_url(url: Column) -> Column:
    """The url with its host's labels in reverse; '' where there is no host."""
    h = F.regexp_extract(url, HOST, 1)
    at = F.instr(url, "://") + 3
    rest = F.substr(url, at + F.length(h))
    return F.when(h == "", "").otherwise(F.concat(F.substr(url, F.lit(1), at - 1), reverse_host(h), rest))


def shard(url: Column, shards: int) -> Column:
    """Stable, balanced shard: MD5 of the url modulo shards."""
    return F.pmod(F.conv(F.substr(F.md5(url), F.lit(1), F.lit(8)), 16, 10).cast("bigint"), F.lit(shards))


def storage_key(url: Column, shards: int = 500000, width: int = 6) -> Column:
    """Shard in `width` digits, '-', reversed url."""
    r = reverse_url(url)
    return F.concat(F.lpad(shard(r, shards).cast("string"), width, "0"), F.lit("-"), r)


def upgrade_key(old: Column, old_width: int = 5) -> Column:
    """A key of the old form (five digits) in the new one."""
    r = F.substr(old, F.lit(old_width + 2))
    return F.concat(F.lpad(shard(r, 500000).cast("string"), 6, "0"), F.lit("-"), r)


def host_parts(h: Column) -> Column:
    """Struct of tld, domain (registrable) and subdomain; nulls for addresses, single labels and empty labels."""
    labels = F.split(h, r"\.")
    n = F.size(labels)
    two = F.concat_ws(".", F.try_element_at(labels, F.lit(-2)), F.try_element_at(labels, F.lit(-1)))
    last, second = F.try_element_at(labels, F.lit(-1)), F.try_element_at(labels, F.lit(-2))
    country = (F.length(last) == 2) & ~last.isin(FLAT_COUNTRIES) & second.isin(SECOND_LEVEL)
    k = F.when(two.isin(LONG_SUFFIXES) | country | ((last == "cn") & second.isin(PROVINCES)), 2).otherwise(1)
    ok = ~is_ip(h) & (n > k) & ~h.contains("..") & ~h.startswith(".") & ~h.endswith(".")
    part = lambda a, size: F.array_join(F.slice(labels, F.greatest(a, F.lit(1)), F.greatest(size, F.lit(0))), ".")
    return F.struct(
        F.when(ok, part(n - k + 1, k)).alias("tld"),
        F.when(ok, part(n - k, k + 1)).alias("domain"),
        F.when(ok, part(F.lit(1), n - k - 1)).alias("subdomain"),
    )


def resource_type(url: Column) -> Column:
    """1 page, 2 style sheet, 3 image, by the path's suffix."""
    suffix = F.lower(F.regexp_extract(path(url), r"\.([A-Za-z0-9]+)$", 1))
    return F.when(suffix.isin(CSS_SUFFIXES), 2).when(suffix.isin(IMAGE_SUFFIXES), 3).otherwise(1)


def ajax(url: Column) -> Column:
    """a#!b becomes a?_escaped_fragment_=b, a#! becomes a."""
    tail = F.regexp_extract(url, r"#!(.*)$", 1)
    base = F.regexp_replace(url, r"#!.*$", "")
    return F.when(~url.contains("#!"), url).when(tail == "", base).otherwise(F.concat(base, F.lit("?_escaped_fragment_="), tail))


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def tidy_anchor(url: Column) -> Column:
    """A trimmed link without trailing '#' and then '/'; null for mail, script and binary links."""
    u = F.regexp_replace(F.regexp_replace(F.trim(url), "#+$", ""), "/+$", "")
    bad = F.lower(u).rlike(r"^(mailto:|javascript:|ftp:|file:)|\.(exe|zip|rar|iso|mp3|apk)$")
    return F.when((u != "") & ~bad, u)


def priority(score: Column, jitter_of: Column) -> Column:
    """500 and more: 0-9, 100: 10-29, 10: 30-49, else 50-99; spread inside by a hash instead of chance."""
    h = F.conv(F.substr(F.md5(jitter_of), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    return (
        F.when(score >= 500, F.pmod(h, F.lit(10)))
        .when(score >= 100, 10 + F.pmod(h, F.lit(20)))
        .when(score >= 10, 30 + F.pmod(h, F.lit(20)))
        .otherwise(50 + F.pmod(h, F.lit(50)))
    )


def redirect_target(url: Column, unscramble=None) -> Column:
    """Where a redirect link ('/link?url=...') leads: the url it carries, decoded; other urls pass.

    unscramble: what makes a url of a value that is none (a Column function that holds the service's key); without it such targets are null.
    """
    carried = F.coalesce(F.try_url_decode(query_param(url, "url")), query_param(url, "url"))
    other = unscramble(query_param(url, "url")) if unscramble else F.lit(None).cast("string")
    return F.when(~url.contains("/link?url="), url).when(carried.rlike("^https?://"), carried).otherwise(other)
