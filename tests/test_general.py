"""Hot keys and schema drift against brute force, with nulls, ties, repeats and empty tables."""

import datetime as dt
import json
import random
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gleaner.operators import drift, hotkeys

JOBS = "job_id bigint, url string, ip string, importance double, arrived_ts timestamp, field string, n bigint, chunk string"


def jobs(spark, rows):
    t0 = dt.datetime(2014, 7, 1)
    data = [(i, u, ip, w, None if s is None else t0 + dt.timedelta(seconds=s), "x", 1, "y") for i, (u, ip, w, s) in enumerate(rows)]
    return spark.createDataFrame(data, JOBS)


def brute(rows):
    out = defaultdict(list)
    for u, ip, w, s in rows:
        for f, k in (("url", u), ("ip", ip)):
            if k:
                out[f, k].append((w, s))
    return {
        k: (len(v), min((s for _, s in v if s is not None), default=None), sum(w for w, _ in v if w is not None and w == w), sum(w is not None and w == w for w, _ in v))
        for k, v in out.items()
    }


def totals(df, **tree):
    return {(r.field, r.key_value): r for r in hotkeys.key_totals(df, ["url", "ip"], "arrived_ts", "importance", **tree).collect()}


def test_hot_keys_match_brute_force(spark):
    r = random.Random(3)
    rows = [
        ("hot" if r.random() < 0.4 else r.choice([None, "", f"u{r.randint(0, 300)}", "long" * 5000]), r.choice([None, "", "a", "b"]), r.choice([None, float("nan"), 0.25, 0.5]), r.choice([None, r.randint(0, 9999)]))
        for _ in range(3000)
    ]
    got, want = totals(jobs(spark, rows).repartition(5), chunk_rows=100, fan_in=3, hot_share=0.05), brute(rows)
    assert got.keys() == want.keys()
    for k, (n, first, total, count) in want.items():
        assert got[k].n == n and got[k].value_n == count
        assert abs((got[k].value_sum or 0) - total) < 1e-6
        assert (got[k].first_ts is None) == (first is None)


def test_path_does_not_change_the_result(spark):
    rows = [("a" if i % 3 else f"k{i}", "x", 0.5, i) for i in range(500)]
    one = {k: v.n for k, v in totals(jobs(spark, rows), chunk_rows=10, fan_in=2, hot_share=0.01).items()}
    two = {k: v.n for k, v in totals(jobs(spark, rows), chunk_rows=65536, hot_share=1.0).items()}
    assert one == two


def test_frequent_keys_count_all_rows(spark):
    rows = [("a", None, None, None)] * 1 + [(f"u{i}", "", None, None) for i in range(99)]
    got = hotkeys.frequent_keys(jobs(spark, rows), ["url", "ip"], "arrived_ts", "importance").collect()
    assert len(got) == 100  # each url holds exactly one percent
    assert hotkeys.frequent_keys(jobs(spark, rows[:0]), ["url", "ip"], "arrived_ts", "importance").collect() == []


BATCH = "raw_id bigint, feed string, batch_no int, file_name string, received_ts timestamp, payload string, name string, kind string"


def batches(spark, files):
    """files: {(feed, batch): [payload or dict]}"""
    rows, i = [], 0
    for (feed, no), records in files.items():
        for p in records:
            i += 1
            rows.append((i, feed, no, None, None, json.dumps(p) if isinstance(p, dict) else p, "a", "b"))
    return spark.createDataFrame(rows, BATCH)


def found(spark, files):
    return sorted(tuple(r) for r in drift.changes(batches(spark, files)).collect())


def test_each_kind_of_change(spark):
    files = {
        ("f", 1): [{"rec_no": 1, "a": 1, "b": 2.5, "c": "x", "d": True}, {"rec_no": 2, "a": 3, "b": 1.0, "c": "y", "d": False}],
        ("f", 2): [{"rec_no": 2, "a": "3", "z": 1.0, "C": "y"}, {"rec_no": 3, "a": "4", "z": 9.5, "C": "q", "new": None}],
        ("g", 2): [{"rec_no": 1, "k": [1]}],
        ("g", 4): [{"rec_no": 1, "m": {"x": 1}}],
    }
    assert found(spark, files) == [
        ("f", 2, "added", "", "new"),
        ("f", 2, "removed", "d", ""),
        ("f", 2, "renamed", "b", "z"),
        ("f", 2, "renamed", "c", "C"),
        ("f", 2, "retyped", "a", "a"),
    ]


def test_unreadable_repeated_and_null(spark):
    files = {
        ("f", 1): [{"rec_no": 1, "a": 1, "b": None}, {"rec_no": 1, "a": 1, "b": None}, '{"rec_no": 2, "zzz', "", None, "[1]"],
        ("f", 2): [{"rec_no": 1, "a": 2, "b": 5}],
        ("f", 3): ["", None],
        ("f", 4): [{"rec_no": 1, "a": 2}],
        (None, 1): [{"rec_no": 1, "x": 2}],
    }
    got = found(spark, files)
    assert ("f", 2, "retyped", "b", "b") not in got
    assert {g for g in got if g[1] == 3} == {("f", 3, "removed", n, "") for n in ("a", "b", "rec_no")}
    assert {g for g in got if g[1] == 4} == {("f", 4, "added", "", n) for n in ("a", "rec_no")}
    assert found(spark, {}) == []


def test_differing_values_are_no_renaming(spark):
    files = {("f", 1): [{"rec_no": 1, "a": 1}], ("f", 2): [{"rec_no": 1, "b": 2}]}
    assert found(spark, files) == [("f", 2, "added", "", "b"), ("f", 2, "removed", "a", "")]


def test_lifespans_and_table(spark):
    files = {
        ("f", 1): [{"rec_no": 1, "crawl_timestamp": 1404172800000000, "score": 5000, "is_truncated": "false"}],
        ("f", 2): [{"rec_no": 1, "crawler_timestamp": "2014-07-01T00:00:01", "link_score": 0.5, "truncated": 1, "agent": "x"}],
        ("f", 3): [{"rec_no": 1, "fetched_at": 1404172802.5, "page_score": "0.25"}],
        ("f", 4): [{"rec_no": 1, "crawl_timestamp": 1404172800000000}],
    }
    spans = {(r.name, r.first_batch, r.last_batch) for r in drift.lifespans(drift.catalogue(drift.record_fields(batches(spark, files)))).collect()}
    assert ("crawl_timestamp", 1, 1) in spans and ("crawl_timestamp", 4, 4) in spans and ("rec_no", 1, 4) in spans
    got = {r.batch_no: r for r in drift.consistent_table(batches(spark, files)).collect()}
    assert [got[i].crawl_timestamp for i in (1, 2, 3)] == [1404172800000000, 1404172801000000, 1404172802500000]
    assert [got[i].score for i in (1, 2, 3)] == [0.5, 0.5, 0.25]
    assert [got[i].is_truncated for i in (1, 2)] == [False, True]
    assert got[2].others == {"agent": "x"}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from("abcd"), st.sampled_from([1, 2, 1.5, "s", None, True]), max_size=4), min_size=2, max_size=4))
def test_added_and_removed_names_agree_with_sets(spark, forms):
    files = {("f", i): [{"rec_no": i, **form}] for i, form in enumerate(forms)}  # no record is sent again
    want = set()
    for i in range(1, len(forms)):
        want |= {(i, "added", n) for n in forms[i].keys() - forms[i - 1].keys()}
        want |= {(i, "removed", n) for n in forms[i - 1].keys() - forms[i].keys()}
    assert {(b, c, o or n) for _, b, c, o, n in found(spark, files) if c != "retyped"} == want
