"""Files split by time or by size, escaped lines, and counters that a job fills on the way."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def time_split(df: DataFrame, at: str, ts: str, pattern: str = "yyyyMMddHH", form: str = "parquet") -> None:
    """Write df into one folder per piece of time (file=<time by pattern>); a busy piece keeps as many files as it has tasks.

    Null times go to the folder of nulls. The same call serves a stream, inside foreachBatch.
    """
    df.withColumn("file", F.date_format(ts, pattern)).write.mode("append").partitionBy("file").format(form).save(at)


def time_split_stream(stream: DataFrame, at: str, checkpoint: str, ts: str, pattern: str = "yyyyMMddHH", every: str = "1 minute"):
    """Start a query that appends a stream to folders by time, a new file per trigger."""
    split = stream.withColumn("file", F.date_format(ts, pattern))
    return split.writeStream.partitionBy("file").option("checkpointLocation", checkpoint).trigger(processingTime=every).start(at, format="parquet")


def size_split(df: DataFrame, column: str, at: str, max_bytes: int) -> None:
    """Write the lines of a text column into files of at most max_bytes of UTF-8 (a longer line gets a file of its own).

    Each task fills one file after the other: part=<task>/file=<number>. Null lines are left out.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, file, filled = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = pc.add(pc.binary_length(batch.column(0)), 1).to_numpy(zero_copy_only=False)
            files = np.empty(len(sizes), np.int64)
            for i, size in enumerate(sizes.tolist()):
                if filled and filled + size > max_bytes:
                    file, filled = file + 1, 0
                filled += size
                files[i] = file
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([part] * len(files), pa.int64()), pa.array(files)], names=["value", "part", "file"])

    lines = df.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL")
    lines.mapInArrow(number, "value string, part bigint, file bigint").write.partitionBy("part", "file").text(at)


def escape_line(text: Column) -> Column:
    """Text that fits into one field of one line: tab, line breaks and backslashes escaped."""
    for raw, kept in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(kept))
    return text


def unescape_line(text: Column) -> Column:
    """The text that escape_line was given; a backslash before anything else stays."""

    def plain(part: Column) -> Column:
        for raw, kept in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            part = F.replace(part, F.lit(kept), F.lit(raw))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def counted(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """df, and an observation that holds, once an action has run, the number of rows and of rows for which each condition holds.

    The counters are filled while the rows pass, without a job of their own.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()]), seen
