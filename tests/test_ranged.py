"""Numbers, gaps, as-of and nearest rows over range partitions, against brute force, with a hot key, nulls and ties."""

import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import joins, matching, ranged, topn
from gleaner.streaming import limiter


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    key = lambda: "hot" if r.random() < 0.5 else r.choice([None, "a", "b", "c"])
    return [(i, key(), r.randint(0, 400), r.random() < 0.5) for i in range(1200)]


def frame(spark, rows):
    # many small partitions: keys go on from one into the next
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return spark.createDataFrame(rows, "id bigint, k string, t bigint, side boolean").repartition(7)


def test_numbered(spark, rows):
    got = {x.id: x.n for x in ranged.numbered(frame(spark, rows), ["k"], ["t", "id"], "n").collect()}
    want = {}
    for k in {x[1] for x in rows}:
        want |= {x[0]: n for n, x in enumerate(sorted((x for x in rows if x[1] == k), key=lambda x: (x[2], x[0])), 1)}
    assert got == want
    assert ranged.numbered(frame(spark, rows).limit(0), ["k"], ["t"], "n").collect() == []


def test_gap_parts(spark, rows):
    rows = [x for x in rows if x[2] % 9 < 3]
    df = frame(spark, rows)
    got = {x.id: x.part for x in ranged.gap_parts(df, ["k"], F.col("t"), (F.col("_gap") > 4) & F.col("side"), ["t", "id"], "part").collect()}
    want = {}
    for k in {x[1] for x in rows}:
        part, last = 0, None
        for i, _, t, side in sorted((x for x in rows if x[1] == k), key=lambda x: (x[2], x[0])):
            part += last is not None and t - last > 4 and side
            want[i], last = part, t
    assert got == want and max(got.values()) > 3


def test_as_of_and_nearest(spark, rows):
    df = frame(spark, rows).withColumn("ts", F.when(F.col("t") < 395, F.timestamp_seconds(F.col("t") * 7)))
    left = df.filter("side").select("k", "ts", "id")
    right = df.filter("NOT side").select("k", "ts", F.col("id").alias("r"))
    l = [x for x in rows if x[3]]
    r = [x for x in rows if not x[3] and x[2] < 395]
    got = {x.id: x.out for x in joins.as_of(left, right, ["k"], "ts", "id", "r", "out").collect()}
    for i, k, t, _ in l:
        before = [(y[2], y[0]) for y in r if y[1] == k and y[2] <= t]
        assert got[i] == (max(before)[1] if before and t < 395 else None)
    near = {x.id: (x.gap_s, x.r) for x in joins.nearest(left, right, ["k"], "id", "r", 60).collect()}
    want = {}
    for i, k, t, _ in l:
        close = [(abs(y[2] - t) * 7.0, y[0]) for y in r if y[1] == k and abs(y[2] - t) * 7 <= 60]
        if close and t < 395:
            want[i] = min(close)
    assert near == want


def test_nodes(spark, rows):
    df = frame(spark, rows).groupBy("t").agg(F.count(F.lit(1)).alias("load"))
    got = sorted((-x.load, x.t, x.node) for x in topn.cumulative_nodes(df, "load", "t", 5).collect())
    average, total, node, want = sum(-x[0] for x in got) / 5, 0, 0, []
    for n, (load, _, _) in enumerate(got):
        want.append(node)
        total -= load
        if total >= average * (node + 1) and node < 4:
            node += 1
    assert [x[2] for x in got] == want


def test_page_sessions_cut_and_go_on(spark):
    r = random.Random(12)
    rows, t = [], 0
    for i in range(600):
        t += r.choice([10, 200, 700, 1700, 1900, 4000])
        rows.append(("u" if r.random() < 0.7 else "v", t, f"http://{r.choice('ab')}{r.randint(0, 4)}.example/", r.choice(["", "", "http://a1.example/"]), i))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.createDataFrame(rows, "mid string, s bigint, url string, ref_url string, id bigint").withColumn("ts", F.timestamp_seconds("s")).drop("s").repartition(5)
    got = {x.id: x.session for x in matching.page_sessions(df).collect()}
    for user in "uv":
        own = [x for x in rows if x[0] == user]
        first = [x[2] for x in own if x[3] == ""]
        top = min(set(first), key=lambda u: (-first.count(u), u))
        home = top if first.count(top) >= 3 or first.count(top) >= 0.15 * len(first) else None
        session, seen, last = 1, set(), None
        for _, t, url, ref, i in own:
            if last:
                gap = t - last[0]
                same = (gap < 1800 or ref in seen) if ref else gap < 300 or (gap < 1800 and (last[1] in (url, home)))
                if not same:
                    session, seen = session + 1, set()
            last = (t, url)
            seen.add(url)
            assert got[i] == session
        assert max(got[x[4]] for x in own) > 20


def test_limits_of_a_cut_key_are_those_of_the_whole(spark):
    r = random.Random(13)
    jobs, t = [], 0
    for i in range(800):
        t += r.choice([0, 1, 3, 10, 40, 300])
        jobs.append(("hot" if r.random() < 0.8 else r.choice(["b", None]), t, i))
    df = frame(spark, [(i, k, t, True) for k, t, i in jobs]).withColumn("ts", F.timestamp_seconds("t"))
    rules = [limiter.Rule(2, 0.1)]
    got = {x.id: (x.decision, x.wait_s) for x in limiter.simulate(df, "k", "ts", "id", fetch_s=20, rules=rules, burst=3).collect()}
    for key in ("hot", "b"):
        one, busy = limiter.Limiter(rules=rules, burst=3), []
        for k, t, i in jobs:
            if k == key:
                for _ in [x for x in busy if x <= t]:
                    one.release(True)
                busy = [x for x in busy if x > t]
                state = one.check(t * 1_000_000)
                if state == limiter.OK:
                    one.register(t * 1_000_000)
                    busy.append(t + 20)
                want = {limiter.OK: "ok", limiter.FULL: "full"}.get(state, "wait")
                assert got[i] == (want, state / 1e6 - t if want == "wait" else 0.0)
    assert len(got) == sum(k is not None for k, _, _ in jobs)


def test_rest_after_failures_and_limit_of_all():
    one = limiter.Limiter(hold_after=2, hold_s=(5, 9), max_failures=4)
    for n in range(4):
        assert one.check(n * 100_000_000) == limiter.OK
        one.register(n * 100_000_000)
        one.release(False, n * 100_000_000 + 1)
        rest = one.check(n * 100_000_000 + 2)
        assert rest == limiter.OK if n < 1 else rest == limiter.DROP if n == 3 else 5_000_000 <= rest - n * 100_000_000 <= 9_000_001
    f = limiter.Fetcher(max_total=2, keep=1)
    for a in "ab":
        assert f.check(a, 0) == limiter.OK
        f.register(a, 0)
    assert f.check("c", 0) == limiter.FULL
    f.release("a", True, 1)
    assert f.check("c", 1) == limiter.OK and f.connections == 1
