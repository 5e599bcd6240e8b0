"""Evaluation texts leaking into training text, by template canonicalisation.

Items and documents become sequences of words (12 in a window) or, for Chinese, of characters
(20). Numbers, units and names become typed placeholders, in two forms: word by word, names left
alone (form 0), and with whole numbers and names as one placeholder each (form 1). Windows of the
templates are hash-joined. Windows whose words are equal are a verbatim leak. Along an alignment of
a document with an item, the slots of all its windows are compared: where every value of the item
is replaced by one value throughout, and some by another one, the item is re-parameterised.

Consecutive matching windows of a document form a run; equal runs of many documents are joined
once and linked to their documents afterwards, as equal items are.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import spread, written

# Number words, units, measure words and marks of names that become placeholders.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million half double"
).split()
UNITS = (
    "mm cm m km g kg mg t l ml s sec min h hour hours minute minutes second seconds day days week weeks month months "
    "year years metre metres meter meters kilometre kilometres gram grams kilogram kilograms litre litres liter liters "
    "percent degree degrees euro euros dollar dollars mile miles foot feet inch inches pound pounds ounce ounces cent cents"
).split()
HAN_NUMBERS = "零〇一二两三四五六七八九十百千万亿半"
HAN_UNITS = (
    "平方米 立方米 平方厘米 千米 公里 厘米 毫米 分米 千克 公斤 毫克 毫升 分钟 小时 星期 个月 美元 欧元 人民币 米 克 吨 升 秒 天 周 月 年 岁 元 角 分 块 "
    "个 只 本 支 把 箱 台 辆 件 条 张 位 名 颗 棵 枚 袋 瓶 杯 盒 包 斤 两 亩 里 度 次 倍 页"
).split()
HAN_SURNAMES = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范石廖贾夏韦付方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤"
HAN_TITLES = "先生 女士 老师 同学 师傅 医生 教授 经理 小姐 大爷 大妈 阿姨 叔叔".split()
HAN_AFTER_NAME = "有 和 与 把 给 说 想 买 卖 从 在 是 每 用 要 去 对 比 将 先 又 的 家 走 跑 骑 种 做 写 读 看".split()

WORDS, CHARS = 12, 20
_TAG = re.compile(r"<[!/?]?[A-Za-z][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[^\W_]+|[.!?:](?=\s|$)")
_HAN = re.compile("[⺀-⿟㐀-鿿豈-﫿\U00020000-\U0002ffff]")
_HAN_SLOT = re.compile(
    rf"(?P<number>[{HAN_NUMBERS}0-9]+)(?P<unit>{'|'.join(HAN_UNITS)})?"
    rf"|(?P<name>[{HAN_SURNAMES}小老阿][㐀-鿿]{{0,2}}?(?:{'|'.join(HAN_TITLES)})"
    rf"|[小老阿][㐀-鿿](?={'|'.join(HAN_AFTER_NAME)})|[{HAN_SURNAMES}][㐀-鿿]{{1,2}}?(?={'|'.join(HAN_AFTER_NAME)}))"
)
_SEED = np.uint64(0x9E3779B97F4A7C15)
_INVISIBLE = re.compile("[­؜᠎​-‏‪-‮⁠-⁯﻿]")
LITERAL, NUMBER, UNIT, NAME, END = range(5)
OUT = "id bigint, lang string, form int, run binary, h array<bigint>, r array<bigint>, slots array<array<string>>"


def _without_comments(text: str, tag: str) -> str:
    parts, at = [], 0
    while (a := text.find("<!--", at)) >= 0 and (b := text.find("-->", a + 4)) >= 0:
        parts += [text[at:a], tag]
        at = b + 3
    return "".join([*parts, text[at:]]) if parts else text


def _without_tags(text: str, tag: str) -> str:
    return _TAG.sub(tag, _without_comments(text, tag)) if "<" in text else text


def plain(text: str, tag: str) -> str:
    """Without tags and comments (each replaced by `tag`), entities, invisible characters and width; letter case stays."""
    text = _without_tags(text, tag)
    if "&" in text:
        text = _without_tags(html.unescape(html.unescape(text)), tag)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        text = "".join(c for c in text if unicodedata.category(c) != "Cf") if _INVISIBLE.search(text) else text
        text = text.replace("’", "")
    return text.replace("'", "")


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: whether it counts as a character, and whether it is part of a number."""
    letters = np.fromiter((chr(c).isalnum() if not 0xD800 <= c < 0xE000 else False for c in range(0x30000)), bool, 0x30000)
    numbers = np.zeros(0x30000, bool)
    numbers[[ord(c) for c in HAN_NUMBERS + "0123456789"]] = True
    return letters, numbers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _windows(x: np.ndarray, k: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of each k consecutive entries (uint64, wraps around), or of those that begin at the given places."""
    out = np.zeros(max(0, len(x) - k + 1) if at is None else len(at), np.uint64)
    for j in range(k):
        out *= _SEED
        out += x[j : j + len(out)] if at is None else x[at + j]
    return _mix(out)


def _sums(x: np.ndarray, k: int) -> np.ndarray:
    """Sum of each k consecutive entries."""
    total = np.concatenate([[0], np.cumsum(x)])
    return total[k:] - total[:-k] if len(x) >= k else total[:0]


_TYPED = np.array([0, *[xxhash.xxh64_intdigest(k) for k in ("<number>", "<unit>", "<name>", "<end>")]], np.uint64)


class _Words(dict):
    """Index of each word in growing arrays of its hash and kind; starts anew when it holds `most`."""

    def __init__(self, kind, most: int = 1 << 18):
        self.kind, self.most = kind, most
        self.hashes, self.kinds = np.zeros(most, np.uint64), np.zeros(most, np.int8)

    def __missing__(self, word: str) -> int:
        i = len(self)
        self.hashes[i], self.kinds[i] = xxhash.xxh64_intdigest(word.lower()), self.kind(word)
        self[word] = i
        return i

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) + len(words) > self.most:
            self.clear()
            if len(words) > self.most:
                self.__init__(self.kind, 2 * len(words))
        i = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.hashes[i], self.kinds[i]


def _by_word(numbers: frozenset[str], units: frozenset[str]):
    return lambda w: NUMBER if w[0].isdigit() or w in numbers else UNIT if w in units else LITERAL


def _by_token(numbers: frozenset[str], units: frozenset[str]):
    def kind(t: str) -> int:
        low = t.lower()
        if low in ".!?:":
            return END
        return NUMBER if t[0].isdigit() or low in numbers else UNIT if low in units else NAME if t[0].isupper() else LITERAL

    return kind


class Form:
    """Windows of several texts in one form: template hashes, the text each belongs to, whether it counts, and on demand words and slots."""

    def __init__(self, form: int, size: int, typed: np.ndarray, raw: np.ndarray, owner: np.ndarray, slots, counts=None):
        self.form, self.size, self.raw, self.slots = form, size, raw, slots
        self.h = _windows(typed, size)
        self.owner = owner[: len(self.h)]
        self.counts = self.owner == owner[size - 1 :][: len(self.h)]  # none across the border of two texts
        if counts is not None:
            self.counts &= counts

    def words(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the words of the windows that begin at the given places; 0 in form 1, whose words don't tell."""
        return np.zeros(len(at), np.uint64) if self.form else _windows(self.raw, self.size, at)


def _owners(parts: list) -> np.ndarray:
    return np.repeat(np.arange(len(parts)), [len(p) for p in parts])


class Templates:
    """Windows of texts in both forms."""

    def __init__(self):
        numbers, units = frozenset(NUMBER_WORDS), frozenset(UNITS)
        self.words, self.tokens = _Words(_by_word(numbers, units)), _Words(_by_token(numbers, units))

    def english(self, texts: list[str]) -> Iterator[Form]:
        parts = [_WORD.findall(t.lower()) for t in texts]
        words = [w for p in parts for w in p]
        raw, kinds = self.words.look_up(words)
        slots = lambda i: [words[j] for j in range(i, i + WORDS) if kinds[j]]
        yield Form(0, WORDS, np.where(kinds > 0, _TYPED[kinds], raw), raw, _owners(parts), slots)
        parts = [[*_TOKEN.findall(t), "."] if len(p) >= WORDS else [] for t, p in zip(texts, parts)]
        tokens = [w for p in parts for w in p]
        hashes, kinds1 = self.tokens.look_up(tokens)
        yield self._merged(tokens, hashes, kinds1, _owners(parts), WORDS, " ")

    def chinese(self, texts: list[str]) -> Iterator[Form]:
        letters, numbers = _tables()
        parts = []
        for t in texts:
            code = np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            parts.append(code[letters[np.minimum(code, 0x2FFFF)]])
        owner = _owners(parts)
        raw = np.concatenate([np.zeros(0, np.uint32), *parts])
        kinds = numbers[np.minimum(raw, 0x2FFFF)].astype(np.int8)
        own = raw.astype(np.uint64) + np.uint64(1)
        slots = lambda i: [chr(raw[j]) for j in range(i, i + CHARS) if kinds[j]]
        yield Form(0, CHARS, np.where(kinds > 0, _TYPED[kinds], own), own, owner, slots)
        flat = raw.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        kinds1 = np.zeros(len(raw), np.int8)
        for m in _HAN_SLOT.finditer(flat):
            if m["name"]:
                kinds1[m.start() : m.end()] = NAME
            else:
                kinds1[m.start("number") : m.end("number")] = NUMBER
                if m["unit"]:
                    kinds1[m.start("unit") : m.end("unit")] = UNIT
        yield self._merged(flat, own, kinds1, owner, CHARS, "")

    @staticmethod
    def _merged(tokens, hashes: np.ndarray, kinds: np.ndarray, owner: np.ndarray, size: int, glue: str) -> Form:
        """Form 1: neighbours of one kind are one placeholder, but for a sentence's first word, whose capital says little.

        At least half of a window stays literal, and something differs from form 0.
        """
        first = np.ones(len(kinds), bool)
        first[1:] = (kinds[1:] == LITERAL) | (kinds[1:] != kinds[:-1]) | (owner[1:] != owner[:-1])
        if glue:
            first[1:2] = True
            first[2:] |= kinds[:-2] == END
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(kinds))
        words = kinds[starts] != END
        starts, ends = starts[words], ends[words]
        own = kinds[starts]
        slots = lambda i: [glue.join(tokens[starts[j] : ends[j]]).lower() for j in range(i, i + size) if own[j]]
        differs = (own == NAME) | (own == UNIT) | (ends - starts > 1) | ((own == NUMBER) & (size == WORDS))
        counts = (2 * _sums(own == LITERAL, size) >= size) & (_sums(differs, size) > 0)
        return Form(1, size, np.where(own > 0, _TYPED[own], hashes[starts]), hashes[:0], owner[starts], slots, counts)


class Wanted:
    """Which template hashes to look for: sorted arrays, or beyond their bound a bitmap that lets others through too."""

    def __init__(self, arrays: dict[str, np.ndarray] | None, bitmap: np.ndarray | None, han: bool):
        self.arrays, self.bitmap, self.han = arrays, bitmap, han  # han: every Chinese window has a Han character

    def among(self, lang: str, h: np.ndarray) -> np.ndarray:
        if self.arrays is not None:
            own = self.arrays[lang]
            if not len(own):
                return np.zeros(len(h), bool)
            return own[np.minimum(np.searchsorted(own, h), len(own) - 1)] == h
        bit = h & np.uint64(64 * len(self.bitmap) - 1)
        return (self.bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _scan(langs: tuple[str, ...] | None, wanted=None):
    """Record batches (id, lang, text) in, runs of windows out; wanted: a broadcast Wanted, None for all windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        look = wanted.value if wanted is not None else None

        def runs(lang: str, ids: list, texts: list[str]) -> Iterator[tuple]:
            for f in templates.english(texts) if lang == "en" else templates.chinese(texts):
                at = np.flatnonzero(f.counts if look is None else f.counts & look.among(lang, f.h))
                if not len(at):
                    continue
                h, r, owner = f.h[at], f.words(at), f.owner[at]
                cuts = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner) != 0)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                    held = [f.slots(i) for i in at[a:b].tolist()]
                    slots = repr(held).encode("utf-8", "surrogatepass")
                    key = xxhash.xxh3_128_digest(lang.encode() + bytes([f.form]) + h[a:b].tobytes() + r[a:b].tobytes() + slots)
                    yield ids[owner[a]], lang, f.form, key, h[a:b].view(np.int64), r[a:b].view(np.int64), held

        def some(rows: list[tuple]) -> pa.RecordBatch:
            """Runs of the texts of some rows (id, lang, text); a run that a text has several times counts once."""
            found: dict[tuple, tuple] = {}
            for as_lang in ("en", "zh"):
                own = [(i, t) for i, lang, t in rows if langs or lang == as_lang]
                if as_lang == "zh" and look is not None and look.han:
                    own = [(i, t) for i, t in own if "&" in t or _HAN.search(t)]
                # once with tags removed, in English also, where that differs, with tags taken for white space
                flat = [(i, plain(t, "")) for i, t in own]
                if as_lang == "en":
                    flat += [(i, plain(t, " ")) for i, t in own if "<" in t or "&" in t]
                if flat:
                    for row in runs(as_lang, [i for i, _ in flat], [t for _, t in flat]):
                        found.setdefault((row[0], row[3]), row)
            columns = list(zip(*found.values())) or [()] * 7
            longs = pa.list_(pa.int64())
            types = (pa.int64(), pa.string(), pa.int32(), pa.binary(), longs, longs, pa.list_(pa.list_(pa.string())))
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names=["id", "lang", "form", "run", "h", "r", "slots"]
            )

        for batch in batches:
            held: list[tuple] = []
            size = 0
            for ident, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text and ident is not None:
                    held.append((ident, lang, text))
                    size += len(text)
                    if size >= 1 << 18:
                        yield some(held)
                        held, size = [], 0
            if held:
                yield some(held)

    return scan


def _wanted(windows: DataFrame, items: DataFrame, max_bytes: int) -> Wanted:
    """The items' template hashes in at most max_bytes, as arrays (8 bytes each) or as a bitmap."""
    hashes = windows.select((F.col("lang") == "en").alias("en"), "h").distinct()
    few = hashes.limit(max_bytes // 8 + 1).toPandas()
    bare = F.regexp_replace("text", r"[^\p{L}\p{N}]", "")
    han = items.filter("lang = 'zh'").filter(bare.rlike("[^㐀-鿿]{20}")).isEmpty()
    if 8 * len(few) <= max_bytes:
        english, h = few.en.to_numpy(bool), few.h.to_numpy(np.int64).view(np.uint64)
        return Wanted({"en": np.sort(h[english]), "zh": np.sort(h[~english])}, None, han)
    words = 1 << max(0, (max_bytes // 8).bit_length() - 1)
    bits = hashes.selectExpr(f"shiftright(h & {64 * words - 1}, 6) AS w", "shiftleft(1L, CAST(h & 63 AS INT)) AS bit")
    some = bits.groupBy("w").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most `words` rows
    bitmap = np.zeros(words, np.uint64)
    bitmap[some.w.to_numpy(np.int64)] = some.bits.to_numpy(np.int64).view(np.uint64)
    return Wanted(None, bitmap, han)


def _flat(runs: DataFrame, key: str) -> DataFrame:
    """One row per window of the runs: key, lang, form, at (place in the run), h, r, slots."""
    windows = F.arrays_zip(F.sequence(F.lit(0), F.size("h") - 1).alias("at"), "h", "r", "slots")
    return runs.select(key, "lang", "form", F.explode(windows).alias("w")).select(key, "lang", "form", "w.*")


def leaks(docs: DataFrame, items: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """One row per document, item and kind ('verbatim' or 'reparameterised') with the windows of the longest match.

    docs: doc_id, text. items: item_id, lang ('en' by words, 'zh' by characters), text. Null and
    empty texts, null ids and texts shorter than a window never match; repeated documents and items
    match each under their own id; an empty table gives no rows. Names are told inside each text
    (capitals; in Chinese, surnames before a title or a verb), so that a text's templates depend
    on nothing else. A window of form 1 counts if at least half of it is literal.

    The items' template hashes go to the workers, in max_bytes at most: as a sorted array, or where
    that is larger as a bitmap, which lets more of the documents' windows through to the join.
    """
    spark = docs.sparkSession
    own = items.select(F.col("item_id").cast("bigint").alias("item_id"), "lang", "text").filter("item_id IS NOT NULL AND text <> '' AND lang IN ('en', 'zh')")
    texts = own.groupBy("lang", "text").agg(F.min("item_id").alias("id"))
    item_windows = written(_flat(spread(texts.select("id", "lang", "text"), 1).mapInArrow(_scan(None), OUT), "id"), "item-windows")
    wanted = spark.sparkContext.broadcast(_wanted(item_windows, own, max_bytes))
    source = spread(docs.select(F.col("doc_id").cast("bigint").alias("id"), F.lit("").alias("lang"), "text"))
    found = written(source.mapInArrow(_scan(("en", "zh"), wanted), OUT), "runs")
    runs = found.groupBy("run").agg(*[F.first(c).alias(c) for c in ("lang", "form", "h", "r", "slots")])
    left = _flat(runs, "run")
    right = item_windows.select("lang", "form", "h", F.col("id").alias("item"), F.col("at").alias("item_at"), F.col("r").alias("item_r"), F.col("slots").alias("item_slots"))
    met = left.join(right, ["lang", "form", "h"])
    pairs = F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    aligned = met.groupBy("run", "item", "form", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.count_if((F.col("form") == 0) & (F.col("r") == F.col("item_r"))).alias("equal"),
        F.count(F.lit(1)).alias("n"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
    )
    replaced = F.exists("pairs", lambda p: p["a"] != p["b"])
    consistent = F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"]))) == F.size("pairs")
    kinds = F.array_compact(
        F.array(
            F.when(F.col("equal") > 0, F.struct(F.lit("verbatim").alias("kind"), F.col("equal").alias("windows"))),
            F.when(replaced & consistent, F.struct(F.lit("reparameterised").alias("kind"), F.col("n").alias("windows"))),
        )
    )
    by_run = aligned.select("run", "item", F.explode(kinds).alias("k")).groupBy("run", "item", "k.kind").agg(F.max("k.windows").alias("windows"))
    same_items = own.join(texts.withColumnRenamed("id", "item"), ["lang", "text"]).select("item", "item_id")
    return (
        found.select(F.col("id").alias("doc_id"), "run")
        .distinct()
        .join(by_run, "run")
        .join(same_items, "item")
        .groupBy("doc_id", "item_id", "kind")
        .agg(F.max("windows").alias("windows"))
    )
