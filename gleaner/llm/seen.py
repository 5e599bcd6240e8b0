"""Has this key been seen before? Elias-Fano indexes of sorted hash partitions.

A key is known by 64 bits of its MD5. The leading bits choose the partition and needn't be kept;
the rest of a partition's signs are a sorted set, kept as Elias-Fano codes: the high bits in unary,
the low bits packed. The codes are rows of a table: a new batch is probed against them by successor
search and merged in, one partition at a time, which makes the next generation of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import written

_ONE = np.uint64(1)


class EliasFano:
    """A sorted set of unsigned integers below 2**bits, in about 2 + bits - log2(n) bits each."""

    def __init__(self, values: np.ndarray, bits: int = 64):
        n = self.n = len(values)
        self.bits = bits
        low = self.low_bits = int(max(0, min(63, bits - max(1, n).bit_length() + 1)))
        values = values.astype(np.uint64, copy=False)
        high = (values >> np.uint64(low)).astype(np.int64)
        ones = high + np.arange(n, dtype=np.int64)
        self.zeros = int(high[-1]) + 1 if n else 1
        self.words = np.zeros((n + self.zeros) // 64 + 1, np.uint64)
        np.bitwise_or.at(self.words, ones >> 6, _ONE << (ones & 63).astype(np.uint64))
        counts = np.bitwise_count(~self.words).astype(np.int64)
        self.zeros_before = np.concatenate([[0], np.cumsum(counts)])
        self.packed = np.zeros(n * low // 64 + 2, np.uint64)
        if low and n:
            rest = values & np.uint64((1 << low) - 1)
            at = np.arange(n, dtype=np.int64) * low
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(self.packed, word, rest << shift)
            over = (at & 63) + low > 64
            np.bitwise_or.at(self.packed, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))

    @classmethod
    def load(cls, n: int, bits: int, low_bits: int, zeros: int, words: bytes, packed: bytes) -> EliasFano:
        """A code as its row keeps it."""
        code = cls.__new__(cls)
        code.n, code.bits, code.low_bits, code.zeros = n, bits, low_bits, zeros
        code.words, code.packed = np.frombuffer(words, np.uint64), np.frombuffer(packed, np.uint64)
        code.zeros_before = np.concatenate([[0], np.cumsum(np.bitwise_count(~code.words).astype(np.int64))])
        return code

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.packed.nbytes + self.zeros_before.nbytes

    def _lows(self, i: np.ndarray) -> np.ndarray:
        low = self.low_bits
        if not low:
            return np.zeros(len(i), np.uint64)
        at = i * low
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # a shift by 64 is not defined: shift twice
        upper = (self.packed[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return ((self.packed[word] >> shift) | upper) & np.uint64((1 << low) - 1)

    def _select_zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero (from 0) in the unary part."""
        word = np.searchsorted(self.zeros_before, k, side="right") - 1
        rest = k - self.zeros_before[word]
        bits = ~self.words[word]
        place = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            part = bits & np.uint64((1 << width) - 1)
            below = np.bitwise_count(part).astype(np.int64)
            up = rest >= below
            rest = np.where(up, rest - below, rest)
            place += np.where(up, width, 0)
            bits = np.where(up, bits >> np.uint64(width), part)
        return word * 64 + place

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each x: the index of the first value >= x within x's high bits, and whether it equals x."""
        if not self.n or not len(x):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        inside = high < self.zeros
        h = np.where(inside, high, 0)
        start = np.where(h == 0, 0, self._select_zero(np.maximum(h - 1, 0)) + 1 - h)
        end = np.where(inside, self._select_zero(h) - h, start)
        rest = x & np.uint64((1 << self.low_bits) - 1)
        lo, hi = start.copy(), end.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            less = self._lows(np.minimum(mid, self.n - 1)) < rest
            lo = np.where(open_ & less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        hit = lo < end
        hit[hit] = self._lows(lo[hit]) == rest[hit]
        return lo, hit

    def contains(self, x: np.ndarray) -> np.ndarray:
        return self.successor(x.astype(np.uint64, copy=False))[1]

    def decode(self) -> np.ndarray:
        bits = np.unpackbits(self.words.view(np.uint8), bitorder="little")
        i = np.arange(self.n, dtype=np.int64)
        high = (np.flatnonzero(bits) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._lows(i)


class SeenIndex:
    """Elias-Fano segments of falling size; small ones are merged sequentially into their neighbour.

    A merge decodes at most two segments of at most max_segment keys, which bounds the memory
    that isn't coded.
    """

    def __init__(self, bits: int = 64, max_segment: int = 1 << 22):
        self.bits, self.max_segment = bits, max_segment
        self.segments: list[EliasFano] = []

    def contains(self, x: np.ndarray) -> np.ndarray:
        known = np.zeros(len(x), bool)
        for segment in self.segments:
            rest = np.flatnonzero(~known)
            known[rest] = segment.contains(x[rest])
        return known

    def merge(self, new: np.ndarray) -> None:
        """Add sorted distinct keys of which none is known."""
        while len(new) and self.segments and self.segments[-1].n <= 2 * len(new) <= self.max_segment:
            old = self.segments.pop().decode()
            both = np.empty(len(old) + len(new), np.uint64)
            at = np.searchsorted(old, new) + np.arange(len(new))
            fill = np.ones(len(both), bool)
            fill[at] = False
            both[at], both[fill] = new, old
            new = both
        if len(new):
            self.segments.append(EliasFano(new, self.bits))


def url_key(url: Column) -> Column:
    """The url without everything from the first '#', trimmed, scheme and host in lower case; null if none is left."""
    trimmed = F.regexp_replace(F.substring_index(url, "#", 1), r"(?U)^\s+|\s+$", "")
    head = F.regexp_extract(trimmed, r"(?s)^(.*?://[^/?]*)", 1)
    key = F.concat(F.lower(head), F.substr(trimmed, F.length(head) + 1))
    return F.when(F.length(key) > 0, key)


def sign_of(key: Column) -> Column:
    """First 8 bytes of the key's MD5, big-endian, as signed 64-bit integer."""
    return F.conv(F.substr(F.md5(key), F.lit(1), F.lit(16)), 16, -10).cast("bigint")


CODES = "part int, n bigint, bits int, low_bits int, zeros bigint, words binary, packed binary"


def part_bits(rows: int, cores: int, keys_per_part: int = 1 << 20) -> int:
    """Leading bits that choose the partition: about keys_per_part keys each, and at least two partitions a core."""
    return max(1, math.ceil(math.log2(max(1, rows / keys_per_part))), math.ceil(math.log2(2 * cores)))


def _placed(df: DataFrame, bits: int, lead: int) -> DataFrame:
    """df with `part`, the leading bits of the kept bits of `sign`, and `rest`, the others."""
    kept = F.shiftrightunsigned("sign", 64 - bits) if bits < 64 else F.col("sign")
    part = F.shiftrightunsigned("sign", 64 - lead).cast("int")
    return df.withColumn("part", part).withColumn("rest", kept.bitwiseAND((1 << (bits - lead)) - 1))


def _row(part: int, code: EliasFano) -> tuple:
    return part, code.n, code.bits, code.low_bits, code.zeros, code.words.tobytes(), code.packed.tobytes()


def _table(rows: list[tuple]) -> pa.Table:
    types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    names = ("part", "n", "bits", "low_bits", "zeros", "words", "packed")
    return pa.table({k: pa.array([r[j] for r in rows], t) for j, (k, t) in enumerate(zip(names, types))})


def _index(codes: pa.Table, bits: int, max_segment: int) -> SeenIndex:
    index = SeenIndex(bits, max_segment)
    for r in codes.sort_by([("n", "descending")]).to_pylist():
        index.segments.append(EliasFano.load(r["n"], r["bits"], r["low_bits"], r["zeros"], r["words"], r["packed"]))
    return index


def encode(signs: DataFrame, bits: int, lead: int, max_segment: int = 1 << 22) -> DataFrame:
    """The table of codes of a column `sign` (nulls and repeats left out); a partition's signs are coded as they stream by."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size = None, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if size:
                values = np.unique(np.concatenate(held))
                yield from _table([_row(part, EliasFano(values, bits - lead))]).to_batches()
            held, size = [], 0

        for batch in batches:
            parts, rest = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 1))
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts[a] != part or size >= max_segment:
                    yield from flush()
                    part = int(parts[a])
                held.append(rest[a:b].view(np.uint64))
                size += b - a
        yield from flush()

    known = signs.filter("sign IS NOT NULL").select("sign").distinct()  # combined before the shuffle
    placed = _placed(known, bits, lead).select("part", "rest")
    return placed.repartitionById(1 << lead, F.col("part")).sortWithinPartitions("part", "rest").mapInArrow(scan, CODES)


def _batch(new: DataFrame, bits: int, lead: int) -> DataFrame:
    """The first id of each kept sign of a batch: a hot key meets its partition combined."""
    placed = _placed(new.filter("sign IS NOT NULL"), bits, lead)
    return placed.groupBy("part", "rest").agg(F.min("id").alias("id"))


def unknown(codes: DataFrame, new: DataFrame, bits: int, lead: int, max_segment: int = 1 << 22) -> DataFrame:
    """Ids of the new records (`sign`, `id`) whose sign isn't coded, the first id of each sign. Reads nothing but the codes."""

    def probe(old: pa.Table, batch: pa.Table) -> pa.Table:
        rest = batch["rest"].to_numpy().view(np.uint64)
        known = _index(old, bits - lead, max_segment).contains(rest)
        return pa.table({"id": batch["id"].filter(pa.array(~known))})

    firsts = _batch(new, bits, lead)
    return codes.groupBy("part").cogroup(firsts.groupBy("part")).applyInArrow(probe, "id bigint")


def next_generation(codes: DataFrame, new: DataFrame, bits: int, lead: int, max_segment: int = 1 << 22) -> DataFrame:
    """The table of codes with the batch's signs merged in: equal or smaller segments are decoded and coded anew, the others stay."""

    def merge(old: pa.Table, batch: pa.Table) -> pa.Table:
        index = _index(old, bits - lead, max_segment)
        rest = np.unique(batch["rest"].to_numpy().view(np.uint64))
        index.merge(rest[~index.contains(rest)])
        part = (old if old.num_rows else batch)["part"][0].as_py()
        return _table([_row(part, s) for s in index.segments])

    firsts = _batch(new, bits, lead).drop("id")
    return codes.groupBy("part").cogroup(firsts.groupBy("part")).applyInArrow(merge, CODES)


def fresh_ids(known: DataFrame, new: DataFrame, bits: int = 64, rows: int | None = None) -> DataFrame:
    """Ids of the new records whose sign is neither known nor that of a new record with a smaller id.

    known: one column `sign`; new: `sign` and `id` (unique). Rows with null sign are left out.
    bits: bits of the sign that are kept; fewer bits take less memory and give wrong answers
    (a new key taken for a known one) at a rate near n / 2**bits. With 64, only two keys with the
    same 64 bits of MD5 are confused. rows: about how many there are at most, if that is known; it
    only decides how many partitions there are.
    """
    rows = max(known.count(), new.count()) if rows is None else rows
    lead = min(bits - 1, part_bits(rows, known.sparkSession.sparkContext.defaultParallelism))
    codes = written(encode(known, bits, lead), "seen-codes")
    return unknown(codes, new, bits, lead)


def seen_before(known: DataFrame, new: DataFrame, id_col: str, url_col: str, bits: int = 64) -> DataFrame:
    """The ids of the records of `new` whose key occurred before, by the ids' order.

    Null and empty urls, and urls of which the rules leave nothing, have no key and are never
    seen before. Equal ids are not expected; id_col null is left out. Either table may be empty.
    """
    rows = max(known.count(), new.count())  # from the files' footers
    keyed = new.select(F.col(id_col).alias("id"), sign_of(url_key(F.col(url_col))).alias("sign")).filter(
        "id IS NOT NULL AND sign IS NOT NULL"
    )
    return keyed.select("id").join(fresh_ids(known, keyed, bits, rows), "id", "left_anti").withColumnRenamed("id", id_col)


def status_signs(status: DataFrame) -> DataFrame:
    """Signs of the status dumps: by clicked_url where there is one, else the stored sign."""
    by_url = sign_of(url_key(F.col("clicked_url")))
    return status.select(F.when(F.col("clicked_url").isNotNull(), by_url).otherwise(F.col("sign")).alias("sign"))


def wrong_answers(known_keys: DataFrame, new: DataFrame, bits: int) -> DataFrame:
    """Share of wrong answers when only `bits` bits of the sign are kept, against the keys themselves.

    known_keys: columns `key` and `sign` (key null where only the sign is known); new: `id`, `key`.
    """
    keyed = new.filter("key IS NOT NULL").withColumn("sign", sign_of(F.col("key")))
    fresh = fresh_ids(known_keys.select("sign"), keyed.select("id", "sign"), bits).select("id", F.lit(True).alias("fresh"))
    by_key = known_keys.filter("key IS NOT NULL").select("key").distinct().withColumn("old", F.lit(True))
    by_sign = known_keys.filter("key IS NULL").select("sign").distinct().withColumn("old_sign", F.lit(True))
    firsts = (
        keyed.groupBy("key", "sign")
        .agg(F.min("id").alias("id"))
        .join(by_key, "key", "left")
        .join(by_sign, "sign", "left")
        .filter("old IS NULL AND old_sign IS NULL")
        .select("id", F.lit(True).alias("truly_fresh"))
    )
    judged = keyed.select("id").join(fresh, "id", "left").join(firsts, "id", "left")
    wrong = F.coalesce(F.col("fresh"), F.lit(False)) != F.coalesce(F.col("truly_fresh"), F.lit(False))
    return judged.agg(
        F.count(F.lit(1)).alias("answers"), F.count_if(wrong).alias("wrong"), F.count_if(F.col("fresh").isNull()).alias("seen")
    ).select(
        F.lit(bits).alias("bits"), "answers", "seen", "wrong", F.try_divide(F.col("wrong"), F.col("answers")).alias("wrong_share")
    )
