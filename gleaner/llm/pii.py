"""Personal information inside free text: found, listed and replaced by typed placeholders.

The model labels every character of every text. Where the text around a decoded span has a known
shape of its kind, that shape gives the exact ends and the written form; elsewhere the span stands
as decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gleaner.llm import pii_grammar as grammar
from gleaner.llm.pii_model import Model
from gleaner.session import spread


AROUND = 64  # characters on both sides of a decoded span in which its shape may lie


def settle(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the decoded spans, without overlaps.

    A shape belongs to a span if they overlap and are of one kind. A number whose shape fits
    another kind of number than the decoded one keeps its shape's kind. Spans without a shape
    follow the others and keep their decoded ends.
    """
    out: list[tuple[int, int, str, str]] = []

    def add(a: int, b: int, kind: str, value: str) -> None:
        if not any(p < b and a < q for p, q, _, _ in out):
            out.append((a, b, kind, value))

    numbers = ("phone", "id_number")
    shapeless = []
    for x, y, said in spans:
        if said == "person":
            continue
        at = max(0, x - AROUND)
        shapes = [
            (at + a, at + b, kind, value)
            for a, b, kind, value in grammar.candidates(text[at : y + AROUND])
            if at + a < y and x < at + b and (kind == said or (kind in numbers and said in numbers))
        ]
        for shape in shapes:
            add(*shape)
        if not shapes:
            shapeless.append((x, y, said))
    for x, y, said in shapeless:
        if got := grammar.as_decoded(text, x, y, said):
            add(*got[:2], said, got[2])
    for x, y, said in spans:
        if said == "person" and (got := grammar.name_at(text, x, y)):
            add(got[0], got[1], "person", got[2])
    return sorted(out)


def redact(text: str, found: list[tuple[int, int, str, str]]) -> str:
    """The text with [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] and [PERSON] in place of what was found."""
    parts, at = [], 0
    for a, b, kind, _ in found:
        parts += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*parts, text[at:]])


def _each(batches: Iterator[pa.RecordBatch], weights: str | None, at_once: int):
    """(slice, its texts, what was found in each) of slices of the record batches."""
    model = Model.load(weights)
    for batch in batches:
        for start in range(0, batch.num_rows, at_once):
            part = batch.slice(start, at_once)
            texts = part.column(1).to_pylist()
            spans = model.spans([t or "" for t in texts])
            yield part, texts, [settle(t, s) if t else [] for t, s in zip(texts, spans)]


def _one_thread() -> None:
    """Executors run one worker per core: more BLAS threads inside one only get in each other's way."""
    import ctypes
    import glob
    import os

    import numpy

    for lib in glob.glob(os.path.join(os.path.dirname(numpy.__file__), "..", "numpy.libs", "*openblas*")):
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            try:
                getattr(ctypes.CDLL(lib), name)(1)
                return
            except (AttributeError, OSError):
                continue


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: str | None = None, at_once: int = 256) -> DataFrame:
    """id_col, kind, found_value: each distinct row once. Null and empty texts give none."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _one_thread()
        for part, _, found in _each(batches, weights, at_once):
            rows = [(i, *kv) for i, f in enumerate(found) for kv in dict.fromkeys((k, v) for _, _, k, v in f)]
            ids = part.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            columns = [ids, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "kind", "found_value"])

    kind = df.schema[id_col].dataType.simpleString()
    source = spread(df.select(id_col, text_col))
    return source.mapInArrow(scan, f"`{id_col}` {kind}, kind string, found_value string").distinct()


def redacted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: str | None = None, at_once: int = 256) -> DataFrame:
    """id_col and text_col with placeholders, one row per row of df; null texts stay null, all other text is kept."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _one_thread()
        for part, texts, found in _each(batches, weights, at_once):
            out = [t if t is None else redact(t, f) for t, f in zip(texts, found)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], names=[id_col, text_col])

    kind = df.schema[id_col].dataType.simpleString()
    return spread(df.select(id_col, text_col)).mapInArrow(scan, f"`{id_col}` {kind}, `{text_col}` string")
