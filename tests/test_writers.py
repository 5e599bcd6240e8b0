"""Split files, escaped lines and counters."""

import datetime as dt
from pathlib import Path

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.sources import writers

T0 = dt.datetime(2014, 7, 1, 22, 59)


def test_time_split(spark, tmp_path):
    rows = [(i, T0 + dt.timedelta(minutes=i) if i else None) for i in range(130)]
    at = str(tmp_path / "out")
    writers.time_split(spark.createDataFrame(rows, "id int, ts timestamp"), at, "ts")
    got = {r.file: r.n for r in spark.read.schema("id int, ts timestamp, file string").parquet(at).groupBy("file").agg(F.count("*").alias("n")).collect()}
    assert got == {None: 1, "2014070123": 60, "2014070200": 60, "2014070201": 9}


def test_time_split_of_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(i, T0 + dt.timedelta(minutes=i)) for i in range(10)], "id int, ts timestamp").write.parquet(source)
    stream = spark.readStream.schema("id int, ts timestamp").parquet(source)
    q = writers.time_split_stream(stream, out, str(tmp_path / "cp"), "ts", every="1 second")
    q.processAllAvailable()
    q.stop()
    assert sorted(p.name for p in Path(out).glob("file=*")) == ["file=2014070122", "file=2014070123"]


def test_size_split(spark, tmp_path):
    lines = ["x" * n + "é" for n in (1, 5, 30, 200, 3, 3, 3)] * 20 + [None, ""]
    at = tmp_path / "out"
    writers.size_split(spark.createDataFrame([(x,) for x in lines], "line string").repartition(2), "line", str(at), 100)
    files = [f for f in at.rglob("*.txt")]
    assert sorted(x for f in files for x in f.read_text().split("\n")[:-1]) == sorted(x for x in lines if x is not None)
    assert all(f.stat().st_size <= 100 or f.read_text().count("\n") == 1 for f in files) and len(files) > 20


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab\\\t\n\rtn", max_size=12), min_size=1, max_size=30))
def test_lines_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").withColumn("e", writers.escape_line(F.col("t")))
    got = df.select("t", "e", writers.unescape_line(F.col("e")).alias("b")).collect()
    assert all(r.b == r.t and (r.e is None or not set(r.e) & set("\t\n\r")) for r in got)


def test_counters_fill_on_the_way(spark):
    df, seen = writers.counted(spark.range(100), "even", even=F.col("id") % 2 == 0, big=F.col("id") > 89)
    df.filter("id < 5").write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 100, "even": 50, "big": 10}
