"""Elias-Fano codes, seen keys and percentiles against brute force."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.llm import percentiles as pct
from gleaner.llm import seen
from gleaner.llm.seen import EliasFano, SeenIndex, seen_before, status_signs, sign_of, url_key, wrong_answers


@settings(max_examples=200, deadline=None)
@given(st.integers(4, 64), st.data())
def test_elias_fano_is_a_set(bits, data):
    top = 2**bits - 1
    values = sorted(data.draw(st.sets(st.integers(0, top), max_size=200)))
    probes = data.draw(st.lists(st.integers(0, top), max_size=50)) + values[:50] + [0, top]
    code = EliasFano(np.array(values, np.uint64), bits)
    assert code.decode().tolist() == values
    assert code.contains(np.array(probes, np.uint64)).tolist() == [p in set(values) for p in probes]


def test_index_grows_by_merging():
    r = random.Random(1)
    index, known = SeenIndex(max_segment=1000), set()
    for _ in range(60):
        batch = np.unique(np.array([r.getrandbits(64) % 10**5 * 10**14 for _ in range(r.randint(1, 300))], np.uint64))
        hit = index.contains(batch)
        assert hit.tolist() == [int(b) in known for b in batch]
        index.merge(batch[~hit])
        known |= set(batch.tolist())
    assert sum(s.n for s in index.segments) == len(known)


def test_code_is_small():
    values = np.unique(np.random.default_rng(0).integers(0, 2**63, 100_000).astype(np.uint64))
    assert EliasFano(values).nbytes * 8 / len(values) < 2 + 64 - math.log2(len(values)) + 3


def key(u):
    if u is None:
        return None
    u = u.split("#")[0].strip()
    i = u.find("://")
    if i >= 0:
        ends = [p for p in (u.find("/", i + 3), u.find("?", i + 3)) if p >= 0]
        j = min(ends, default=len(u))
        u = u[:j].lower() + u[j:]
    return u or None


def sign(k):
    return int.from_bytes(hashlib.md5(k.encode()).digest()[:8], "big", signed=True)


URLS = ["http://A.example/x", "HTTP://a.example/x", " http://a.example/x\t", "http://a.example/X", "http://a.example/x#f", "http://a.example?Q=1", "x", "", "  ", "#y", None, "http://中.example/路"]


def test_url_key(spark):
    got = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", url_key(F.col("u")).alias("k"), sign_of(url_key(F.col("u"))).alias("s")).collect()
    assert [r.k for r in got] == [key(u) for u in URLS]
    assert [r.s for r in got] == [None if key(u) is None else sign(key(u)) for u in URLS]


def test_seen_before_matches_brute_force(spark):
    r = random.Random(2)
    pool = URLS + [f"http://h.example/{i}" for i in range(200)]
    status = [(sign(key(u)) if u and key(u) and r.random() < 0.5 else 0, u if r.random() < 0.7 else None) for u in (r.choice(pool) for _ in range(80))]
    new = [(i, r.choice(pool) if r.random() < 0.6 else "http://hot.example/") for i in range(1, 1500)]
    r.shuffle(new)
    s = spark.createDataFrame([(*x, "n") for x in status], "sign bigint, clicked_url string, id string").repartition(3)
    n = spark.createDataFrame([(*x, 1) for x in new], "new_id bigint, clicked_url string, sign int").repartition(5)
    seen = {sign(key(u)) for _, u in status if key(u)} | {x for x, u in status if u is None}
    want = set()
    for i, u in sorted(new):
        if key(u):
            if sign(key(u)) in seen:
                want.add(i)
            seen.add(sign(key(u)))
    assert {x.new_id for x in seen_before(status_signs(s), n, "new_id", "clicked_url").collect()} == want
    assert seen_before(status_signs(s), n.limit(0), "new_id", "clicked_url").collect() == []
    assert seen_before(status_signs(s.limit(0)), n.filter("new_id = 1"), "new_id", "clicked_url").collect() == []


def test_generations_of_codes(spark):
    r = random.Random(7)
    signs = [r.getrandbits(64) - 2**63 for _ in range(3000)] + [0, -1, 1, 2**63 - 1, -(2**63)]
    as_df = lambda part: spark.createDataFrame([(s, i) for i, s in enumerate(part)], "sign bigint, id bigint")
    for bits, lead in ((64, 3), (30, 2)):
        codes, known = seen.encode(as_df(signs[:1000] * 2), bits, lead, 64), set(signs[:1000])
        assert {x.n for x in codes.collect()} and max(x.n for x in codes.collect()) <= 64 + 10000
        for k in range(1000, 3005, 700):
            batch = r.sample(signs[: k + 700], 600)
            kept = lambda s: (s & (2**64 - 1)) >> (64 - bits)
            old = {kept(s) for s in known}
            want = {}
            for i, s in enumerate(batch):
                if kept(s) not in old:
                    want.setdefault(kept(s), i)
            got = {x.id for x in seen.unknown(codes, as_df(batch), bits, lead).collect()}
            assert got == set(want.values())
            codes = spark.createDataFrame(seen.next_generation(codes, as_df(batch), bits, lead).collect(), seen.CODES)
            known |= set(batch)
        assert sum(x.n for x in codes.collect()) == len({kept(s) for s in known})
    assert seen.encode(as_df([]), 64, 3).collect() == []


def test_few_bits_give_wrong_answers_at_a_known_rate(spark):
    n = spark.range(1, 4001).select("id", F.concat(F.lit("http://h.example/"), F.col("id")).alias("key"))
    none = spark.createDataFrame([], "key string, sign bigint")
    assert wrong_answers(none, n, 64).first().wrong == 0
    rate = wrong_answers(none, n, 16).first().wrong_share
    assert 0.01 < rate < 0.06  # about n / 2 / 2**16


def test_percentiles_match_brute_force(spark):
    r = random.Random(4)
    odd = [None, float("nan"), float("inf"), -1.0, 0.0, -0.0]
    rows = []
    for i in range(3000):
        g = None if r.random() < 0.05 else ("hot" if r.random() < 0.5 else f"g{r.randint(0, 5)}")
        v = r.choice(odd) if r.random() < 0.2 else round(r.lognormvariate(0, 3), r.randint(0, 4))
        rows.append((i, g, v, float(r.choice([200, 404, 0]))))
    rows += rows[:500]  # repeated rows count once
    df = spark.createDataFrame([(*x, 1) for x in rows], "info_id bigint, g string, a double, b double, n int").repartition(4)
    got = {(x.g, x.metric): (x.n, x.p50, x.p90, x.p99) for x in pct.percentiles(pct.value_counts(df, "info_id", {"g": F.col("g")}, ["a", "b"]), ["g"]).collect()}
    values = defaultdict(list)
    for _, g, a, b in {x[0]: x for x in rows}.values():
        for m, v in (("a", a), ("b", b)):
            if v is not None and 0 <= v < math.inf:
                values[g, m].append(v)
    want = {k: (len(v), *[sorted(v)[(len(v) * p + 99) // 100 - 1] for p in (50, 90, 99)]) for k, v in values.items()}
    assert got == want


def test_rounded_states_combine_within_the_bound(spark):
    r = random.Random(5)
    rows = [(i, f"d{i % 7}", r.lognormvariate(1, 2)) for i in range(2000)]
    df = spark.createDataFrame(rows, "info_id bigint, day string, a double")
    states = pct.value_counts(df, "info_id", {"day": F.col("day")}, ["a"], rel_error=0.01)
    got = pct.percentiles(pct.combine(states, []), []).first()
    exact = sorted(v for _, _, v in rows)
    for p in (50, 90, 99):
        assert abs(got[f"p{p}"] / exact[(len(exact) * p + 99) // 100 - 1] - 1) <= 0.01 * (1 + 1e-9)
    one = pct.value_counts(df, "info_id", {}, ["a"], rel_error=0.005).collect()
    assert sum(x.n for x in one) == len(rows) and all(min(abs(x.value / v - 1) for v in exact) <= 0.005 * (1 + 1e-9) for x in one)
    assert pct.percentiles(pct.value_counts(df.limit(0), "info_id", {"day": F.col("day")}, ["a"]), ["day"]).collect() == []
