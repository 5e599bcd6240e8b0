"""Values of queries that have no SQL: links, terms, simhashes, classes, stream duplicates, search sessions."""

import collections
import datetime as dt
import math
import random

import xxhash
from pyspark.sql import functions as F

from gleaner.operators import matching, simhash
from gleaner.plans import content, stream_queries

PAGE = "archive_id bigint, url string, host string, title string, cdoc string"
PAGES = [
    (1, "http://a.example/x", "a", "Blue lamp", "The lamp is blue, the lamp is old. 水杯很好"),
    (2, "https://b.example/d/y", "b", "Blue lamp", "The lamp is blue, the lamp is old. 水杯很好"),
    (3, "http://c.example/", "c", None, "Night buses stop near the mill every hour"),
    (4, None, None, "", ""),
    (5, "http://e.example/", "e", "水杯评测", None),
]


def pages(spark, tmp_path):
    spark.createDataFrame(PAGES, PAGE).write.parquet(str(tmp_path / "archive_data.parquet"))
    return str(tmp_path)


def counts():
    out = {}
    for i, _, _, title, text in PAGES:
        c = collections.Counter(simhash.terms(text or ""))
        for t in simhash.terms(title or ""):
            c[t] += 10
        if c:
            out[i] = c
    return out


def test_terms():
    assert list(simhash.terms("The Été 水杯好 x1y 水")) == ["the", "été", "水杯", "杯好", "x", "y"]


def test_new_links_and_terms(spark, tmp_path):
    at = pages(spark, tmp_path)
    links = {tuple(r) for r in content.r131_new_links(spark, at).select("archive_id", "url", "kind").collect()}
    roots = {1: "http://a.example", 2: "https://b.example", 3: "http://c.example", 5: "http://e.example"}
    assert links == {(i, f"{r}{u}", k) for i, r in roots.items() for u, k in (("/main.css", 2), ("/logo.png", 3))}
    want = collections.Counter()
    docs = collections.Counter()
    for c in counts().values():
        want.update(c)
        docs.update(c.keys())
    got = {r.term: (r.n, r.docs) for r in content.r139_term_counts(spark, at).collect()}
    assert got == {t: (n, docs[t]) for t, n in want.items()}


def test_simhash_and_classes(spark, tmp_path):
    at = pages(spark, tmp_path)
    per = counts()
    idf = {t: math.log((len(per) + 1) / (sum(t in c for c in per.values()) + 1)) for c in per.values() for t in c}
    want = {}
    for i, c in per.items():
        total, sums = sum(c.values()), [0.0] * 64
        for t, n in c.items():
            w = (1 if n > 0.1 * total else n) * idf[t] / total
            for b in range(64):
                sums[b] += w if xxhash.xxh64_intdigest(t) >> b & 1 else -w
        v = sum(1 << b for b in range(64) if sums[b] > 1e-12)
        want[i] = v - 2**64 if v >= 2**63 else v
    got = {r.archive_id: r.simhash for r in content.r140_simhash(spark, at).collect()}
    assert got.keys() == want.keys() and got[1] == got[2]
    assert all(bin((got[i] ^ want[i]) & (2**64 - 1)).count("1") <= 1 for i in want)  # sums at zero may fall either way
    classes = {r.archive_id: (r.class_id, r.copies) for r in content.r144_assigned_classes(spark, at).collect()}
    assert classes == {1: (1, 2), 2: (1, 2), 3: (3, 1), 5: (5, 1)}


def test_stream_dedup_keeps_the_first_within_the_watermark(spark, tmp_path):
    t0 = dt.datetime(2014, 7, 1)
    rows = [(i, f"http://a.example/{i % 7}", t0 + dt.timedelta(minutes=i)) for i in range(50)]
    df = spark.createDataFrame(rows, "job_id bigint, url string, arrived_ts timestamp_ntz").withColumn("tried_times", F.lit(0))
    df = df.withColumn("features", F.expr("CAST(array() AS array<struct<key: string, value: string>>)"))
    df.write.parquet(str(tmp_path / "crawl_job.parquet"))
    got = stream_queries.r149_stream_dedup(spark, str(tmp_path)).collect()
    assert len({r.dedup for r in got}) == len(got) == 7


def test_search_sessions_match_the_sequential_rule(spark):
    r = random.Random(4)
    words = ["night bus", "night bus mill", "lamp", "blue lamp", "tent"]
    rows, t = [], dt.datetime(2014, 7, 1)
    for i in range(300):
        t += dt.timedelta(seconds=r.choice([30, 300, 700, 1500, 2500]))
        rows.append((r.choice("uv"), t, r.choice(words), i))
    df = spark.createDataFrame(rows, "u string, ts timestamp, q string, id int")
    got = {x.id: x.session for x in matching.search_sessions(df, "u", "ts", "q", ["id"]).collect()}
    for user in "uv":
        own = [x for x in rows if x[0] == user]
        parts = []
        for k, (_, t, q, i) in enumerate(own):
            new = True
            if k:
                _, before, p, _ = own[k - 1]
                gap, a, b = (t - before).total_seconds(), set(q.split()), set(p.split())
                new = not (q == p or (2 * len(a & b) / (len(a) + len(b)) >= 0.2 and gap < 1800) or gap < 600)
            if new:
                parts.append([])
            parts[-1].append((i, q))
        session = 0
        for k, part in enumerate(parts):
            if not k or part[0][1] not in {q for _, q in parts[k - 1]}:
                session += 1
            assert {got[i] for i, _ in part} == {session}
