"""Text decoded with a wrong encoding: improbable runs and inverse mappings inside them.

Adjacent character pairs of the whole corpus are scored by their term of the corpus' mutual
information, p(ab) * log(p(ab) / (p(a) p(b))). A text's improbable runs are its maximal scoring
segments, where a pair scores the higher the smaller its term is. Only inside runs encodings are
undone: encode with the encoding that was used wrongly, decode with the right one. A run is damaged
if the outcome consists of probable pairs where the run did not, if it is what replacement characters
turn into, or if it holds characters that no text has (replacement, C1 controls, private use).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import spread, written

# Encodings met on the web, as used wrongly and as the text's own.
USED = "cp1252 gb18030 cp950 cp932 euc_jp euc_kr cp1251 koi8_r mac_roman cp866 iso8859_5 cp1250 iso8859_2 cp437 iso8859_15 mac_cyrillic".split()
OWN = "utf_8 gb18030 cp950 cp932 euc_jp cp1251 koi8_r cp1252 mac_roman iso8859_5 cp866 euc_kr iso8859_2".split()
SINGLE = frozenset("cp1252 cp1251 koi8_r mac_roman cp866 iso8859_5 cp1250 iso8859_2 cp437 iso8859_15 mac_cyrillic".split())

# Characters that Unicode gives no text: replacement, C1 controls, private use.
MARKS = re.compile("[\ufffd\x80-\x9f\ue000-\uf8ff]")
LOST = "\ufffd".encode()  # bytes that no mapping brings back

_WIDE = re.compile(r"[^\x00-\x7f](?:[\x20-\x7f]{0,2}[^\x00-\x7f])*")


def pair_counts(texts: DataFrame) -> DataFrame:
    """Counts of adjacent character pairs with a non-ASCII character, and (pair -1) of all pairs; texts: one column.

    Pairs that two digits or other ASCII characters form are only counted in the total.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = "\n".join(t for t in batch.column(0).to_pylist() if t)
            code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            a, b = code[:-1], code[1:]
            ok = (a != 10) & (b != 10)
            wide = ok & ((a > 127) | (b > 127))
            pairs, n = np.unique(a[wide] << 21 | b[wide], return_counts=True)
            pairs, n = np.append(pairs, -1), np.append(n, int(ok.sum()))
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    return spread(texts).mapInArrow(scan, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def probable_pairs(counts: DataFrame, least: float) -> dict[str, tuple[float, float]]:
    """log p and the term of the mutual information of each pair whose term is at least `least`.

    A pair of probability p has at most the term p * log(1 / p) (its characters can't be rarer
    than the pair), so fewer than about 16 / least pairs qualify: the bound of what is
    broadcast, whatever the corpus.
    """
    row = counts.filter("pair = -1").first()
    total = F.lit(float(row["n"]) if row else 0.0)
    enough = counts.filter("pair >= 0").filter(F.col("n") > 1).filter(F.col("n") * F.log(total) >= total * least)
    by = lambda c, name: counts.filter("pair >= 0").groupBy(c.alias(name)).agg(F.sum("n").alias(f"n_{name}"))
    left, right = F.shiftright("pair", 21), F.col("pair").bitwiseAND((1 << 21) - 1)
    terms = (
        enough.withColumn("a", left)
        .withColumn("b", right)
        .join(by(left, "a"), "a")
        .join(by(right, "b"), "b")
        .withColumn("p", F.col("n") / total)
        .withColumn("term", F.col("p") * F.log(F.col("n") * total / (F.col("n_a") * F.col("n_b"))))
        .filter(F.col("term") >= least)
        .select("a", "b", F.log("p").alias("logp"), "term")
    )
    few = terms.toPandas()
    return {chr(a) + chr(b): (p, t) for a, b, p, t in zip(few.a, few.b, few.logp, few.term)}


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence of scores, in one pass.

    None of them can be extended or cut without losing score, and they don't overlap.
    """
    found: list[list] = []  # start, end, sum before the start, sum up to the end
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        own = [i, i + 1, total, total + s]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= own[2]:
                j -= 1
            if j < 0 or found[j][3] >= own[3]:
                found.append(own)
                break
            own[0], own[2] = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, after - before) for a, b, before, after in found]


class Restorer:
    """Finds and undoes wrong decodings, given the corpus' probable pairs (`probable_pairs`) and the least term."""

    def __init__(self, pairs: dict[str, tuple[float, float]], least: float, depth: int = 3, marks: bool = True):
        self.logp, self.floor, self.depth, self.marks = {k: p for k, (p, _) in pairs.items()}, math.log(least) - 4, depth, marks
        # 1 for pairs below the least term, 0 at four times it, -1 from sixteen times on
        self.score = {k: min(1.0, max(-1.0, math.log(4 * least / t) / math.log(4))) for k, (_, t) in pairs.items()}
        for used in USED:  # what replacement characters turn into is improbable, however often it occurs
            turned = (LOST * 4).decode(used, "ignore")
            self.score |= {p: 1.0 for p in map("".join, zip(turned, turned[1:])) if not p.isascii()}
        self.known: dict[str, tuple | None] = {}
        self.singles = {}
        for name in SINGLE:
            table = {}
            for byte in range(256):
                try:
                    table[bytes([byte]).decode(name)] = byte
                except UnicodeDecodeError:
                    pass
            for byte in range(128, 160):  # bytes without a character pass as C1 controls
                table.setdefault(chr(byte), byte)
            self.singles[name] = table

    def runs(self, text: str) -> list[tuple[int, int]]:
        """Maximal scoring segments of the pairs' scores (-0.2 for pairs of ASCII), as character spans.

        Damage that occurs often makes pairs that are probable, though hardly common: that they
        score up to four times the least term lets them be tried. A single pair of two Han
        characters is no run: damage changes more than one of them.
        """
        get = self.score.get
        scores = [-0.2 if p.isascii() else get(p, 1.0) for p in map("".join, zip(text, text[1:]))]
        if self.marks and MARKS.search(text):
            for m in MARKS.finditer(text):
                for i in (m.start() - 1, m.start()):
                    if 0 <= i < len(scores):
                        scores[i] = 1.0
        han = lambda c: "㐀" <= c <= "鿿"
        return [(a, b + 1) for a, b, _ in maximal_segments(scores) if b - a > 1 or not (han(text[a]) and han(text[b]))] or (
            [(0, 1)] if len(text) == 1 and self.marks and MARKS.search(text) else []
        )

    def _encode(self, text: str, used: str) -> bytes | None:
        if used in self.singles:
            table = self.singles[used]
            try:
                return bytes([table[c] for c in text])
            except KeyError:
                return None
        try:
            return text.encode(used)
        except UnicodeEncodeError:
            return None

    def _undo(self, run: str, depth: int) -> tuple[list[tuple[str, str]], bool]:
        """What the run may have been, as (text, encodings), and whether it is what lost characters turn into."""
        out, seen, lost = [], {run}, False
        for used in USED:
            coded = self._encode(run, used)
            if coded is None or len(coded) == len(run) and run.isascii():
                continue
            lost = lost or LOST in coded
            for own in OWN:
                if own == used or own != "utf_8" and depth < self.depth - 1:
                    continue  # more than two steps only happen through UTF-8
                try:
                    back = coded.decode(own)
                except UnicodeDecodeError:
                    continue
                if back in seen or depth < self.depth and MARKS.search(back):
                    continue
                seen.add(back)
                out.append((back, f"{own}>{used}"))
                if depth > 1 and own == "utf_8" and not back.isascii():
                    deeper, gone = self._undo(back, depth - 1)
                    lost = lost or gone
                    out += [(b, f"{e} {own}>{used}") for b, e in deeper if b not in seen]
        return out, lost

    def _rate(self, text: str) -> tuple[float, float, int]:
        """Sum of log p, share of probable pairs and number of pairs with a non-ASCII character."""
        get, floor = self.logp.get, self.floor
        scores = [get(p, floor) for p in map("".join, zip(text, text[1:])) if not p.isascii()]
        if not scores:
            return 0.0, 1.0, 0
        return sum(scores), sum(s > floor for s in scores) / len(scores), len(scores)

    def _hopeless(self, text: str) -> bool:
        """Whether too many pairs are improbable for a share of 0.6; stops at the first that settles it."""
        logp, left = self.logp, 0.4 * (len(text) - 1)
        for p in map("".join, zip(text, text[1:])):
            if p not in logp and not p.isascii():
                left -= 1
                if left < 0:
                    return True
        return False

    def restore(self, text: str | None) -> tuple[bool, str | None, str | None]:
        """Whether text is damaged, what it was (null if that can't be had) and the encodings undone."""
        if not text or text.isascii():
            return False, None, None
        spans = self.runs(text)
        if not spans:
            return False, None, None
        wide = [m.span() for m in _WIDE.finditer(text)]
        fixed, undone, shift, done, damaged, lost = text, [], 0, 0, False, False
        for a, b in spans:
            if a < done:
                continue
            marked = self.marks and bool(MARKS.search(text, a, b))
            damaged = damaged or marked
            if "\ufffd" in text[a:b]:
                lost = lost or self.marks  # nothing around a lost character can be undone as a whole
                continue
            outer = [(x, y) for x, y in wide if x < b and y > a]
            left, right = min([a, *[x for x, _ in outer]]), max([b, *[y for _, y in outer]])
            best = None
            # the run, the run up to where its non-ASCII surroundings end, and one character more or less
            for x, y in dict.fromkeys([(left, right), (a, b), (left, b), (a, right), (a + 1, b), (a, b - 1), (a + 1, b - 1), (a - 1, b)]):
                if x < done or y - x < 1:
                    continue
                got, gone = self._best(text[x:y], text[:x][-1:], text[y:][:1])
                lost = lost or gone
                if got is None:
                    continue
                if best is None or got[0] > best[0]:
                    best = (*got, x, y)
                if got[3] == 1.0:
                    break
            if best:
                _, back, how, _, x, y = best
                fixed = fixed[: x + shift] + back + fixed[y + shift :]
                shift += len(back) - (y - x)
                undone.append(how)
                done = y
        whole = undone and not lost and not MARKS.search(fixed)
        return damaged or lost or bool(undone), fixed if whole else None, " + ".join(undone) or None

    def _best(self, run: str, left: str, right: str) -> tuple[tuple[float, str, str, float] | None, bool]:
        """Gain, text, encodings and share of probable pairs of the best inverse mapping that makes a run probable; whether characters are lost."""
        key = left + "\0" + run + "\0" + right
        if key in self.known:
            return self.known[key]
        best, lost = None, False
        if not run.isascii():
            before, share, _ = self._rate(left + run + right)
            few = sum(c > "\x7f" for c in run) < 3
            options, lost = self._undo(run, self.depth)
            for back, how in options:
                whole = left + back + right
                if self._hopeless(whole):
                    continue
                after, share_after, pairs = self._rate(whole)
                if not pairs or share_after < 0.6 or after <= before + 2 + 0.5 * pairs:
                    continue
                used, own = how.split(" ")[-1].split(">")[::-1]
                if used in SINGLE and own in SINGLE and (_same(left, run[:1]) or _same(run[-1:], right) or (few and share > 0)):
                    continue  # damage between alphabets doesn't stop inside a word; a letter alone must fit nowhere
                gain = after - before - 8 * len(MARKS.findall(back))
                if best is None or gain > best[0]:
                    best = gain, back, how, share_after
        if len(self.known) >= 1 << 17:
            self.known.clear()
        self.known[key] = best, lost
        return best, lost


def _same(a: str, b: str) -> bool:
    """Whether two characters are letters of one block beyond ASCII."""
    return bool(a and b) and a > "\x7f" and b > "\x7f" and a.isalpha() and b.isalpha() and ord(a) >> 8 == ord(b) >> 8


def damaged(tables: list[tuple[str, DataFrame]], least: float = 1e-4, depth: int = 3, marks: bool = True) -> DataFrame:
    """tab, rec_id, title, restored and undone of every damaged text; tables: (name, DataFrame of rec_id, title).

    restored is null where the text can't be had. Null and empty titles are no case; copies each
    get their row. Pairs are counted over all titles of all tables. least: the term of the mutual
    information from which a pair is probable. depth: how many wrong decodings of one text are
    undone one after the other. marks: whether characters that no text has count as evidence.
    """
    spark = tables[0][1].sparkSession
    rows = None
    for name, df in tables:
        part = df.select(F.lit(name).alias("tab"), F.col("rec_id").cast("bigint").alias("rec_id"), "title").filter("title <> ''")
        rows = part if rows is None else rows.unionByName(part)
    counts = written(pair_counts(rows.select("title")), "pairs")  # read several times below
    shared = spark.sparkContext.broadcast(probable_pairs(counts, least))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value, least, depth, marks)
        for batch in batches:
            keep, restored, undone = [], [], []
            titles = batch.column(2).to_pylist()
            once = {t: restorer.restore(t) for t in set(titles)}  # copies are rated once
            for i, text in enumerate(titles):
                found, fixed, how = once[text]
                if found:
                    keep.append(i)
                    restored.append(fixed)
                    undone.append(how)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(restored, pa.string()), pa.array(undone, pa.string())],
                names=["tab", "rec_id", "title", "restored", "undone"],
            )

    return spread(rows).mapInArrow(scan, "tab string, rec_id bigint, title string, restored string, undone string")
