"""Byte-level BPE as a tree reduction over an associative join, and back.

A piece (one match of the split pattern) is encoded by halves: short leaves by plain lowest-rank-first merging, then
neighbours are joined. A join re-encodes a window of the last tokens of the left and the first of the right side, and
doubles that side of the window whose outer boundary isn't yet stable.

Why a stable boundary is final: call two neighbours ``a b`` settled if merging the bytes of ``a + b`` alone gives
``[a, b]``. Take a sequence whose neighbours are all settled, and the first merge that would cross a boundary in
a run over the whole text. Up to there the run, seen in the two tokens at that boundary alone, is the run over their
bytes (lowest rank first and leftmost among equals hold in every part of a text), so that run would cross it too,
against their being settled. So no merge crosses, and the sequence is the encoding. Conversely neighbours in an
encoding are settled. So only the two outer boundaries of a window need a test. ``+`` of two encodings is therefore
exact, and associative; across pieces it is concatenation, as no merge crosses a piece.

Defined cases: a null or empty text has no tokens and decodes to no bytes; repeated rows are encoded one by one; an
empty table gives an empty result; other columns of the input are neither read nor returned.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF_BYTES = 24
SHORT_BYTES = 64
CACHED_PIECES = 150_000
CACHED_PAIRS = 100_000
ROWS_PER_BATCH = 512


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class BytePairs:
    """Encoding and decoding by one rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._settled: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """Lowest-rank-first merging, leftmost among equals."""
        n = len(data)
        if n < 2:
            return [data] if data else []
        if n <= SHORT_BYTES:
            return self._merge_short(data)
        ranks = self.ranks
        # A heap of neighbours: n log n for a long window.
        part: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            left, j = part[i], after[i]
            if left is None or j >= n or len(left) + len(part[j]) != size:
                continue  # one of the two has been merged since
            both = part[i] = left + part[j]
            part[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(both + part[k])) is not None:
                    heapq.heappush(heap, (r, i, size + len(part[k])))
            h = before[i]
            if h >= 0 and (r := ranks.get(part[h] + both)) is not None:
                heapq.heappush(heap, (r, h, len(part[h]) + size))
        return [p for p in part if p is not None]

    def _merge_short(self, data: bytes) -> list[bytes]:
        """The same by scanning a list of neighbours' ranks, which is quicker for few bytes."""
        get, none = self.ranks.get, len(self.tokens)
        part = [data[i : i + 1] for i in range(len(data))]
        rank = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while rank and (low := min(rank)) < none:
            i = rank.index(low)
            both = part[i] = part[i] + part[i + 1]
            del part[i + 1], rank[i]
            if i:
                rank[i - 1] = get(part[i - 1] + both, none)
            if i < len(rank):
                rank[i] = get(both + part[i + 1], none)
        return part

    def settled(self, a: bytes, b: bytes) -> bool:
        known = self._settled.get((a, b))
        if known is None:
            if len(self._settled) >= CACHED_PAIRS:
                self._settled.clear()
            known = self._settled[a, b] = self.merge(a + b) == [a, b]
        return known

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of the bytes of two encodings in a row."""
        if not left or not right:
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join(left[-i:] + right[:j]))
            left_ok = i >= len(left) or self.settled(left[-i - 1], window[0])
            right_ok = j >= len(right) or self.settled(window[-1], right[j])
            if left_ok and right_ok:
                return left[: max(0, len(left) - i)] + window + right[j:]
            i, j = i * (1 if left_ok else 2), j * (1 if right_ok else 2)

    def tree(self, data: bytes) -> list[bytes]:
        """Encode halves, join them."""
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def encode_piece(self, data: bytes) -> list[int]:
        """A piece that is itself a token stays one; else the tree."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else list(map(self.ranks.__getitem__, self.tree(data)))

    def decode(self, ids: bytes) -> bytes:
        """Concatenation of the tokens' bytes; ids are little-endian unsigned 32-bit integers."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Pieces(dict):
    """piece -> its ids as bytes; bounded: the last full generation is kept for pieces that come again."""

    def __init__(self, pairs: BytePairs):
        super().__init__()
        self.pairs, self.unsure, self.last = pairs, set(), {}

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.last.get(piece)) is not None:
            self[piece] = ids
            return ids
        found = self.pairs.encode_piece(piece.encode())
        ids = struct.pack(f"<{len(found)}I", *found)
        if not piece.isascii() and max(piece) > "\xff" and (new := {c for c in piece if unicodedata.category(c) == "Cn"}):
            self.unsure |= new
            return ids
        if len(self) >= CACHED_PIECES:
            self.last = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _latin_split() -> re.Pattern:
    """public_tokenizers.PATTERN for texts of code points below 256, with the classes written out for ``re``.

    The alternatives begin with different characters, so their order doesn't matter; letters come first.
    """
    of = lambda kind: "".join(re.escape(c) for c in map(chr, range(256)) if kind(c))
    letter, number, space = of(lambda c: unicodedata.category(c)[0] == "L"), of(lambda c: unicodedata.category(c)[0] == "N"), of(lambda c: regex.match(r"\s", c))
    return re.compile(rf" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class TextCodec:
    """Whole texts: the pattern splits, each piece is encoded on its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pairs = BytePairs(ranks)
        self.pattern = pattern
        self.split = regex.compile(pattern)
        self.latin = _latin_split() if pattern == public_tokenizers.PATTERN else None
        self.pieces = _Pieces(self.pairs)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        split = self.latin if self.latin and is_latin(text) else self.split
        ids = b"".join(map(self.pieces.__getitem__, split.findall(text)))
        if self.pieces.unsure:
            ids = b"".join(map(self.pieces.__getitem__, self._older(self.pieces.unsure).findall(text)))
            self.pieces.unsure = set()
        return ids

    def _older(self, chars: set[str]) -> regex.Pattern:
        """The pattern with the classes L and N as the tiktoken library knows them.

        ``regex`` may know a later Unicode version. That matters for characters which Python's own tables don't
        know either, so only a text that has some (``chars``) asks the library, character by character.
        """
        import tiktoken

        bytes_only = {bytes([i]): i for i in range(256)}
        pattern = self.pattern
        others = ""
        for name in ("L", "N"):
            known = tiktoken.Encoding(name, pat_str=rf"\p{{{name}}}", mergeable_ranks=bytes_only, special_tokens={})
            wrong = "".join(regex.escape(c) for c in sorted(chars) if regex.match(rf"\p{{{name}}}", c) and not known.encode_ordinary(c))
            if wrong:
                others += wrong
                pattern = pattern.replace(rf" ?\p{{{name}}}+", rf" ?(?:(?![{wrong}])\p{{{name}}})+")
        if others:
            pattern = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[{others}]|[^\s\p{{L}}\p{{N}}])")
        return regex.compile(pattern)


_CODECS: dict[tuple, TextCodec] = {}


def _codec(key: tuple, ranks: dict[bytes, int], pattern: str) -> TextCodec:
    """One codec for a Python worker, which serves many tasks."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = TextCodec(ranks, pattern)
    return _CODECS[key]


def bpe_round_trip(documents: DataFrame, vocabulary: str, pattern: str = public_tokenizers.PATTERN, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ids (binary: little-endian unsigned 32-bit token ids) and decoded (binary: the bytes of those ids).

    ``vocabulary`` is the path of a rank file on the driver; its table (tens of thousands of short entries, the same
    for any input) is broadcast.
    """
    ranks = documents.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    name = (vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODECS.get(name) or _codec(name, ranks.value, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b = whole.slice(at, ROWS_PER_BATCH)
                ids = [codec.encode(x) for x in b.column(1).to_pylist()]
                decoded = [codec.pairs.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=["_key", "ids", "decoded"])

    d = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = T.StructType([T.StructField("_key", d.schema["_key"].dataType), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    return d.mapInArrow(run, out).select(F.col("_key").alias(key), "ids", "decoded")


def token_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)))
