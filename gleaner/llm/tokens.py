"""Encoding by a public byte-level BPE tokenizer, cut at forced boundaries.

A pair of bytes that occurs inside no vocabulary token can't be merged across: between two such
bytes there is always a cut. The pre-tokens of a text are cut there, the fragments are encoded
independently (most of them are single tokens or already known) and their ids concatenated.
Long runs without white space, which cost a merge loop more than linear time, fall into pieces.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from gleaner.session import spread

TOKENIZERS = "/opt/tokenizers"
# Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """ids(text) for a rank file; keeps up to max_known pre-tokens with their ids."""

    def __init__(self, file: str, max_known: int = 1 << 19):
        with open(file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.merge = coding._core_bpe.encode_single_piece
        self.split = regex.compile(PATTERN).findall
        self.inside = np.zeros(65536, bool)  # pairs of bytes that some token holds
        for token in self.ranks:
            if len(token) > 1:
                b = np.frombuffer(token, np.uint8).astype(np.int32)
                self.inside[b[:-1] * 256 + b[1:]] = True
        self.known: dict[str, list[int]] = {}
        self.max_known = max_known

    def fragments(self, piece: bytes) -> list[bytes]:
        """The piece cut at every pair of bytes that no token holds."""
        if len(piece) < 2:
            return [piece]
        b = np.frombuffer(piece, np.uint8).astype(np.int32)
        cuts = (np.flatnonzero(~self.inside[b[:-1] * 256 + b[1:]]) + 1).tolist()
        return [piece[i:j] for i, j in zip([0, *cuts], [*cuts, len(piece)])]

    def _piece(self, word: str) -> list[int]:
        piece = word.encode()
        rank = self.ranks.get(piece)
        if rank is not None:
            return [rank]
        out: list[int] = []
        for part in self.fragments(piece):
            rank = self.ranks.get(part)
            if rank is not None:
                out.append(rank)
            else:
                out.extend(self.merge(part))
        return out

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self.known, []
        for word in self.split(text):
            got = known.get(word)
            if got is None:
                got = self._piece(word)
                if len(word) <= 64:
                    if len(known) >= self.max_known:
                        known.clear()
                    known[word] = got
            out.append(got)
        return list(itertools.chain.from_iterable(out))


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", file: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """id_col and ids, one row per row of df, without special tokens.

    Null and empty texts give an empty list; strings that spell a special token are ordinary
    text; white space is text. Repeated rows give repeated rows; ids may be null.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):  # bounds the lists held at once
                part = batch.slice(start, 2000)
                ids = [np.asarray(encoder.ids(t), np.int32) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return spread(df.select(id_col, text_col)).mapInArrow(scan, f"`{id_col}` {kind}, ids array<int>")
