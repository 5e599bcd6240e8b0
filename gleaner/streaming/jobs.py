"""The job stream, stage by stage. Every stage works on batch DataFrames too."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gleaner.functions import urls
from gleaner.session import shared_dir


def read_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A table's files as a stream; its schema is that of the table."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path[:-1] + "[t]")  # a pattern stands for a folder of files as well as for one file


def kafka_stream(spark: SparkSession, servers: str, topic: str, group: str, per_trigger: int = 100_000) -> DataFrame:
    """Jobs of a Kafka topic (needs Spark's Kafka package): key, value, partition, offset, timestamp. Backpressure in place of load shedding."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("kafka.group.id", group).option("maxOffsetsPerTrigger", per_trigger).load()


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Keyed rows (key, value) to a topic."""
    writer = df.select(F.col("key").cast("string"), F.col("value").cast("string")).writeStream.format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).start()


def run(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now, into the shared folder, and read the result."""
    at = f"{shared_dir(stream.sparkSession)}/{name}-{uuid.uuid4().hex}"
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint")
    q.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/out")


def ingest(jobs: DataFrame, black: str) -> DataFrame:
    """Valid jobs only: http(s) urls with a host that match no black pattern."""
    u = F.col("url")
    return jobs.filter(urls.scheme(u).isin("http", "https") & (urls.host(u) != "") & ~u.rlike(black))


def job_id(partition: Column, offset: Column) -> Column:
    """Partition in the upper 8 bits, offset below."""
    return F.shiftleft(partition.cast("bigint"), 56).bitwiseOR(offset.cast("bigint"))


def dedup_key() -> Column:
    """Tries, '_', and the dedup_key feature or the url."""
    feature = F.try_element_at(F.filter("features", lambda f: f["key"] == "dedup_key"), F.lit(1))["value"]
    return F.concat_ws("_", F.coalesce("tried_times", F.lit(0)), F.coalesce(feature, F.col("url")))


def dedup_within(jobs: DataFrame, ts: str, interval: str) -> DataFrame:
    """One job per key within the interval, with state bounded by the watermark."""
    keyed = jobs.withColumn("dedup", dedup_key()).withColumn(ts, F.col(ts).cast("timestamp"))
    return keyed.withWatermark(ts, interval).dropDuplicatesWithinWatermark(["dedup"])


def dedup_refreshing(jobs: DataFrame, key: Column, ts: str, id_col: str, interval_s: int) -> DataFrame:
    """key, id, ts of jobs whose key wasn't admitted within interval_s before; an admitted job renews the key's time.

    State: the last admitted time of a key; it times out with the watermark.
    """
    rows = jobs.select(key.alias("key"), F.col(id_col).cast("bigint").alias("id"), F.col(ts).cast("timestamp").alias("ts"))

    def admit(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        keep = []
        for pdf in parts:
            pdf = pdf.sort_values(["ts", "id"])
            for i, t in zip(pdf["id"], pdf["ts"]):
                at = t.value // 1000
                if last is None or at - last >= interval_s * 1_000_000 or at < last - interval_s * 1_000_000:
                    keep.append((k[0], i, t))
                    last = at
        state.update((last,))
        state.setTimeoutTimestamp(max(last // 1000 + interval_s * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(keep, columns=["key", "id", "ts"])

    watermarked = rows.withWatermark("ts", f"{interval_s} seconds")
    return watermarked.groupBy("key").applyInPandasWithState(
        admit, "key string, id bigint, ts timestamp", "last bigint", "append", GroupStateTimeout.EventTimeTimeout
    )


def not_revisited(jobs: DataFrame, status: DataFrame, now_us: Column, age_s: int = 86400) -> DataFrame:
    """Jobs (url) whose page wasn't crawled within age_s before now_us (a column of the job). status: url, at (one row per url)."""
    met = jobs.join(status.select("url", F.col("at").alias("_at")), "url", "left")
    fresh = F.col("_at").isNotNull() & (now_us - F.col("_at") < age_s * 1_000_000) & (F.col("_at") <= now_us)
    return met.filter(~F.coalesce(fresh, F.lit(False))).drop("_at")


def scored(jobs: DataFrame, default: float = 0.5, threshold: float = 0.01) -> DataFrame:
    """Jobs with score (importance, else the default) from the threshold, with their priority slot."""
    score = F.coalesce("importance", F.lit(default))
    return jobs.withColumn("score", score).filter(F.col("score") >= threshold).withColumn("slot", urls.priority(F.col("score") * 1000, F.col("url")))


def dispatch(jobs: DataFrame, queues: int, spread_over: int = 3) -> DataFrame:
    """Jobs with their queue: hash of address or host, spread over a few neighbours by the url's hash."""
    who = F.coalesce(F.when(F.col("ip") != "", F.col("ip")), urls.host(F.col("url")))
    return jobs.withColumn("queue", F.pmod(urls.shard(who, 1 << 20) + urls.shard(F.col("url"), spread_over), F.lit(queues)))


def in_time(jobs: DataFrame, submitted: str, now: str, max_ms: int = 240_000) -> DataFrame:
    """Jobs that haven't been queued longer than max_ms."""
    from gleaner.operators.joins import micros

    return jobs.filter(micros(now) - micros(submitted) <= max_ms * 1000)


def route(results: DataFrame, code: str = "response_code", tries: str = "tries", max_tries: int = 2) -> DataFrame:
    """Results with `target`: 'request' (with one try more and the proxy flipped) while tries are left and the code is neither 200 nor 404, else 'result'."""
    again = (F.col(tries) < max_tries) & ~F.coalesce(F.col(code).isin(200, 404), F.lit(False))
    out = results.withColumn("target", F.when(again, "request").otherwise("result"))
    return out.withColumn(tries, F.when(again, F.col(tries) + 1).otherwise(F.col(tries)))


def write_routes(batch: DataFrame, _: int, targets: dict[str, str]) -> None:
    """foreachBatch sink: each target's rows to its folder; the batch is computed once."""
    batch.persist()
    for target, path in targets.items():
        batch.filter(F.col("target") == target).drop("target").write.mode("append").parquet(path)
    batch.unpersist()
