"""Page signatures and near-duplicate detection by weighted simhash and Hamming block tables."""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import spread, written

_TERM = re.compile(r"[a-zà-ÿ]+|[一-鿿の]")
BLOCKS = (13, 13, 13, 13, 12)


def terms(text: str) -> Iterator[str]:
    """Accepted terms: words of letters, and pairs of adjacent Han characters."""
    before = ""
    for m in _TERM.finditer(text.lower()):
        t = m[0]
        if len(t) == 1 and t >= "一":
            if before:
                yield before + t
            before = t
        else:
            before = ""
            yield t


def term_counts(df: DataFrame, id_col: str, title: str, text: str, title_weight: int = 10) -> DataFrame:
    """id_col, term, n: terms of the title count title_weight times. Null and empty texts have none."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, words, counts = [], [], []
            for i, (a, b) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                c = Counter(terms(b or ""))
                for t in terms(a or ""):
                    c[t] += title_weight
                at += [i] * len(c)
                words += c.keys()
                counts += c.values()
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=[id_col, "term", "n"])

    kind = df.schema[id_col].dataType.simpleString()
    return spread(df.select(id_col, title, text)).mapInArrow(scan, f"`{id_col}` {kind}, term string, n bigint")


def simhashes(df: DataFrame, id_col: str, title: str, text: str, cap: float = 0.1) -> DataFrame:
    """id_col, simhash (64 bits) of every document that has terms.

    Weight of a term: tf * idf / sum(tf); tf is cut to 1 where the term has more than `cap` of
    all. idf comes from the corpus by a join, so no vocabulary goes to the driver.
    """
    counts = written(term_counts(df, id_col, title, text), "terms")
    docs = counts.select(id_col).distinct().count()
    idf = counts.groupBy("term").agg(F.log((F.lit(docs) + 1) / (F.count(F.lit(1)) + 1)).alias("idf"))
    weighed = counts.join(idf, "term")
    per = weighed.groupBy(id_col).agg(F.collect_list(F.struct("term", "n", "idf")).alias("t"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(64, dtype=np.uint64)
        known: dict[str, int] = {}
        for batch in batches:
            out = []
            for row in batch.column(1).to_pylist():
                total = sum(x["n"] for x in row)
                h, w = [], []
                for x in row:
                    tf = 1 if x["n"] > cap * total else x["n"]
                    got = known.get(x["term"])
                    if got is None:
                        if len(known) > 1 << 19:
                            known.clear()
                        got = known[x["term"]] = xxhash.xxh64_intdigest(x["term"])
                    h.append(got)
                    w.append(tf * x["idf"] / total)
                ones = (np.array(h, np.uint64)[:, None] >> bits & np.uint64(1)).astype(np.float64) * 2 - 1
                order = np.argsort(np.array(h, np.uint64))  # one order of summation, whatever the rows' order
                sums = (ones[order] * np.array(w)[order][:, None]).sum(0)
                out.append(int(((sums > 0).astype(np.uint64) << bits).sum().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], names=[id_col, "simhash"])

    kind = df.schema[id_col].dataType.simpleString()
    return per.mapInArrow(scan, f"`{id_col}` {kind}, simhash bigint")


def near_pairs(values: DataFrame, column: str = "simhash", distance: int = 3) -> DataFrame:
    """a < b, distance: all pairs of distinct values at most `distance` (up to 3) bits apart.

    64 bits lie in five blocks; two values within 3 bits agree in at least two blocks, so ten
    keys of two blocks each find every pair. Equal values are one class and never paired. A key that
    many values share is split by the engine's skew handling; each pair comes from one table only.
    """
    if distance > 3:
        raise ValueError("ten keys of two blocks find distances up to 3")
    starts = np.concatenate([[0], np.cumsum(BLOCKS)[:-1]]).tolist()
    block = lambda i: F.shiftrightunsigned("v", starts[i]).bitwiseAND((1 << BLOCKS[i]) - 1)
    keys = [
        F.struct(F.lit(k).alias("table"), (F.shiftleft(block(i), 13).bitwiseOR(block(j))).alias("key"))
        for k, (i, j) in enumerate(itertools.combinations(range(5), 2))
    ]
    v = values.select(F.col(column).alias("v")).filter("v IS NOT NULL").distinct()
    keyed = v.withColumn("k", F.explode(F.array(*keys))).select("v", "k.table", "k.key")
    a, b = keyed.select(F.col("v").alias("a"), "table", "key"), keyed.select(F.col("v").alias("b"), "table", "key")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    far = F.bit_count(differ)
    same = [F.shiftrightunsigned(differ, starts[i]).bitwiseAND((1 << BLOCKS[i]) - 1) == 0 for i in range(5)]
    first = F.coalesce(*[F.when(same[i] & same[j], F.lit(k)) for k, (i, j) in enumerate(itertools.combinations(range(5), 2))])
    met = a.join(b, ["table", "key"]).filter("a < b").withColumn("distance", far).filter(F.col("distance") <= distance)
    return met.filter(F.col("table") == first).select("a", "b", "distance")  # each pair once, from its first table


def bad_pages(pages: DataFrame, bad: DataFrame, signature: str, url: str, least: str) -> DataFrame:
    """Pages whose signature is in `bad` (signature, least: shortest url that counts) with an url longer than that."""
    per = bad.groupBy(signature).agg(F.min(least).alias("_least"))
    return pages.join(per, signature).filter(F.length(url) > F.col("_least")).drop("_least")
