"""Matching of logs that needs order within a user: greedy passes, adjacent rows, sessions.

Each works on one user's rows in order. A user's rows are cut at gaps that no rule spans, and the
cuts are numbered by range partitions (`ranged`), so that a busy user is many groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators.joins import micros
from gleaner.operators.ranged import gap_parts, running


def by_gap(df: DataFrame, user: list[str], ts: str, gap_s: int, order: list[str], out: str = "part") -> DataFrame:
    """Number the parts of each user's rows that gaps of more than gap_s seconds separate."""
    return gap_parts(df, user, micros(ts), F.col("_gap") > gap_s * 1_000_000, [ts, *order], out)


def session_id(df: DataFrame, user: str, ts: str, gap_s: int, order: list[str]) -> DataFrame:
    """session (number within the user) and its signature: MD5 of user, first time and number."""
    parts = by_gap(df, [user], ts, gap_s, order, "session")
    w = Window.partitionBy(user, "session")
    first = F.date_format(F.min(ts).over(w), "yyyyMMddHHmmss")
    return parts.withColumn("signature", F.md5(F.concat_ws("\t", F.col(user), first, F.col("session"))))


def greedy_match(searches: DataFrame, clicks: DataFrame, keys: list[str], contain_s: float = 120, query_s: float = 120, time_s: float = 5) -> DataFrame:
    """Search pages and click groups of one user and engine, matched in three passes; each is used once.

    searches: keys, sid, ts (seconds), query, urls (array); clicks: keys, cid, ts, query, urls.
    Pass 1: all clicked urls among the first ten shown, least gap below contain_s. Pass 2: equal
    query and contained, below query_s. Pass 3: gap below time_s. Order: time, then id. Result:
    keys, sid, cid, step. A user's day is cut where no pass reaches across, which bounds a group.
    """
    reach = int(max(contain_s, query_s, time_s))
    s = searches.select(*keys, F.lit(0).alias("side"), F.col("sid").alias("id"), "ts", "query", F.slice("urls", 1, 10).alias("urls"))
    c = clicks.select(*keys, F.lit(1).alias("side"), F.col("cid").alias("id"), "ts", "query", "urls")
    both = s.unionByName(c).filter("ts IS NOT NULL")
    both = gap_parts(both, keys, F.col("ts"), F.col("_gap") > reach, ["ts", "side", "id"], "_part")
    part = Window.partitionBy(*keys, "_part")  # parts with one side only can't match
    both = both.withColumn("_sides", F.max("side").over(part) - F.min("side").over(part)).filter("_sides = 1").drop("_sides")
    types = {f.name: f.dataType.simpleString() for f in both.schema}
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], f"sid {types['id']}", f"cid {types['id']}", "step int"])

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts", "id"], kind="stable")
        free_s = [r for r in pdf.itertuples(index=False) if r.side == 0]
        free_c = [r for r in pdf.itertuples(index=False) if r.side == 1]
        found = []
        shown = {r.id: set(r.urls) for r in free_s}

        def inside(a, b):
            return set(b.urls) <= shown[a.id]

        steps = (
            (1, contain_s, inside),
            (2, query_s, lambda a, b: a.query == b.query and inside(a, b)),
            (3, time_s, lambda a, b: True),
        )
        for step, limit, fits in steps:
            for b in list(free_c):
                near = [(abs(a.ts - b.ts), a.ts, a.id, a) for a in free_s if abs(a.ts - b.ts) < limit and fits(a, b)]
                if near:
                    a = min(near, key=lambda x: x[:3])[3]
                    found.append((a.id, b.id, step))
                    free_s.remove(a)
                    free_c.remove(b)
        out = pd.DataFrame(found, columns=["sid", "cid", "step"])
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0] if len(pdf) else None)
        return out

    return both.groupBy(*keys, "_part").applyInPandas(match, schema)


def adjacent(df: DataFrame, user: str, ts: str, side: str, id_col: str, gap_s: int) -> DataFrame:
    """Pairs of an 'A' row and the 'B' row right after it (by time, then id) of one user, at most gap_s apart; each row in one pair.

    All in windows: a run of alternating rows is paired from its start, so that every second step
    of a run makes no pair.
    """
    w = Window.partitionBy(user).orderBy(ts, side, id_col)
    x = df.withColumn("_next", F.lead(F.struct(id_col, side, ts)).over(w))
    ok = (F.col(side) == "A") & (F.col(f"_next.{side}") == "B")
    near = micros(f"_next.{ts}") - micros(ts) <= gap_s * 1_000_000
    return x.filter(ok & near).select(user, F.col(id_col).alias("a_id"), F.col(f"_next.{id_col}").alias("b_id"))


def term_overlap(a: Column, b: Column) -> Column:
    """Twice the number of common terms over the number of all terms of two queries; 0 for empty ones."""
    x, y = (F.array_distinct(F.filter(F.split(F.lower(c), r"\W+"), lambda t: t != "")) for c in (a, b))
    return F.coalesce(F.try_divide(2.0 * F.size(F.array_intersect(x, y)), F.size(x) + F.size(y)), F.lit(0.0))


def search_sessions(df: DataFrame, user: str, ts: str, query: str, order: list[str]) -> DataFrame:
    """Sessions of searches: a row goes on with the session of the row before if its query is the
    same, or shares a fifth of the terms within 30 minutes, or comes within 10 minutes. A new
    session whose first query occurs in the one before is merged back."""
    w = Window.partitionBy(user).orderBy(ts, *order)
    gap = (micros(ts) - micros(F.lag(ts).over(w))) / 1e6
    before = F.lag(query).over(w)
    goes_on = (F.col(query) == before) | ((term_overlap(F.col(query), before) >= 0.2) & (gap < 1800)) | (gap < 600)
    x = df.withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("_s", F.sum("_new").over(w))
    # the first query of a session, and whether the session before holds it
    first = x.groupBy(user, "_s").agg(F.min_by(query, F.struct(ts, *order)).alias("_q"))
    held = x.select(user, (F.col("_s") + 1).alias("_s"), F.col(query).alias("_q")).distinct().withColumn("_back", F.lit(1))
    flags = first.join(held, [user, "_s", "_q"], "left").select(user, "_s", F.coalesce("_back", F.lit(0)).alias("_back"))
    ws = Window.partitionBy(user).orderBy("_s")
    final = flags.withColumn("session", F.sum(1 - F.col("_back")).over(ws))
    return x.join(final.select(user, "_s", "session"), [user, "_s"]).drop("_new", "_s")


def page_sessions(df: DataFrame, user: str = "mid", ts: str = "ts", url: str = "url", ref: str = "ref_url", order: str = "id") -> DataFrame:
    """Sessions of page views: with a referer, the session goes on within 30 minutes or if the
    referer was seen in it; without, within 5 minutes, or within 30 if the hosts are alike (same
    registrable domain) or the page before is the user's home page (most frequent page without
    referer, at least 3 times or 15 %).

    A page without referer 30 minutes or more after the one before begins a session whatever came
    before: there a user's rows are cut. The parts stream through in order, each through one task,
    and their sessions are numbered on afterwards.
    """
    from gleaner.functions import urls

    h = F.col(url)
    home = (
        df.filter(F.col(ref) == "")
        .groupBy(user, F.col(url).alias("_home"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_all", F.sum("_n").over(Window.partitionBy(user)))
        .withColumn("_r", F.row_number().over(Window.partitionBy(user).orderBy(F.desc("_n"), "_home")))
        .filter("_r = 1 AND (_n >= 3 OR _n >= 0.15 * _all)")
        .select(user, "_home")
    )
    domain = F.coalesce(urls.host_parts(urls.host(h))["domain"], urls.host(h))
    rows = df.join(home, user, "left").select(user, ts, url, ref, order, domain.alias("_domain"), "_home")
    cut = (F.col(ref) == "") & (F.col("_gap") >= 1800 * 1_000_000)
    rows = gap_parts(rows, [user], micros(ts), cut, [ts, order], "_part")
    rows = rows.repartition(user, "_part").sortWithinPartitions(user, "_part", ts, order)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"{user} {types[user]}, {ts} {types[ts]}, {url} string, {order} {types[order]}, _started int"

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who, at, domain_before, url_before, seen = None, None, None, None, set()
        for pdf in parts:
            started = []
            for u, part, t, page, r, dom, home_page in zip(pdf[user], pdf["_part"], pdf[ts], pdf[url], pdf[ref], pdf["_domain"], pdf["_home"]):
                same = False
                if (u, part) != who:
                    who = u, part
                else:
                    gap = (t - at).total_seconds()
                    if r:
                        same = gap < 1800 or r in seen
                    else:
                        same = gap < 300 or (gap < 1800 and (dom == domain_before or url_before == home_page))
                if not same:
                    seen = set()
                at, domain_before, url_before = t, dom, page
                seen.add(page)
                started.append(int(not same))
            yield pdf[[user, ts, url, order]].assign(_started=started)

    return running(rows.mapInPandas(scan, schema), [user], [ts, order], "_started", "session").drop("_started")
