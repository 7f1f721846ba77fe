"""Token ids as flat binary files: unsigned integers, 64-bit document offsets, read through memory maps.

Format. A data set is a folder of shards, each of two files, and of ``manifest`` (Parquet, a row for each shard):

* ``<shard>.ids``: the ids of the shard's documents one after another, little-endian unsigned integers of ``width`` bytes
  (2 if the vocabulary and the end id fit, else 4), nothing else.
* ``<shard>.idx``: little-endian 64-bit integers, nothing else: ``n_docs + 1`` offsets into the ids (in ids, from 0), then
  ``n_docs`` document ids, then ``n_docs`` flags (1: the document has an id, 0: its id is null and the number is 0).
* manifest: shard, ids_file, idx_file, width, n_docs, n_tokens, first_n_docs and first_n_tokens. The last two are the
  bases: documents and ids in all earlier shards, by prefix sums over the shards' counts. A document's place in the data
  set is its shard's base plus its offset, so shards never have to be rewritten, and the only thing that one task sees of
  all others is a row of counts.

Writing: rows are dealt to range partitions of doc_id and sorted there, so shards follow one another in ascending order;
a task encodes its rows and streams them into its two files. A file's name holds the task attempt, and only the files of
attempts whose manifest row came through count, so a lost or repeated task leaves nothing double.

Reading: a task maps the files of its shard into memory (a store that can't be mapped is read by byte ranges through
``pyarrow.fs``) and takes the documents of its range.

Encoding: the tokenizers library encodes. Byte-level BPE never merges across the pieces that its pattern cuts a text
into, so pieces that come again take their ids from a bounded cache; texts outside latin-1, whose pieces depend on the
library's own character tables, go through the library whole.

Defined cases: a null or empty text is the end id alone; a null doc_id comes before all others; rows of equal doc_id
follow one another in the order of their texts' hash (equal rows in any order, which changes nothing); special tokens'
strings in a text are ordinary text; an empty table makes a data set without shards, and no rows; ids must be integers;
other columns of the input are neither read nor returned.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import _latin_split, is_latin
from .common import bases, in_partitions, shared_folder, table, written

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
CACHED_PIECES = 350_000
PIECES_PER_ROW = 256
ROWS_PER_BATCH = 512
DOCS_PER_RANGE = 16_384
READ_TASKS = 20_000

SHARD = "shard long, ids_file string, idx_file string, width int, n_docs long, n_tokens long"
_TOKENS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


class Encoder:
    """Ids of whole texts by a tokenizers file, as unsigned integers of ``width`` bytes, the end id behind each text."""

    def __init__(self, tokenizer: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.library.encode_special_tokens = True
        self.width = 2 if max(self.library.get_vocab_size(True), end_id or 0) <= 0xFFFF else 4
        self.end = b"" if end_id is None else end_id.to_bytes(self.width, "little")
        self.split = _latin_split()
        self.pieces: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}
        # Pieces are only cut here if the file's pattern is the one that ``split`` writes out.
        self.cuts = _plain_byte_level(tokenizer)
        # A byte-level token's name has a character for each byte.
        vocabulary = self.library.get_vocab(True)
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for name, i in vocabulary.items():
            self.token_bytes[i] = len(name)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in found]

    def _piece_ids(self, pieces: Iterable[str]) -> list[tuple[str, bytes]]:
        """Pieces with their ids. Pieces of a space and letters go through the library in rows, which its pattern cuts
        into the same pieces again; the bytes that tokens stand for tell where a piece ends."""
        words, others = [], []
        for p in pieces:
            (words if p[0] == " " and p[1:].isalpha() else others).append(p)
        rows = ["".join(words[i : i + PIECES_PER_ROW]) for i in range(0, len(words), PIECES_PER_ROW)]
        found = self.library.encode_batch_fast(rows, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), f"<u{self.width}")
        # Every word begins with the only space in it.
        data = np.frombuffer("".join(rows).encode(), np.uint8)
        cuts = np.append(np.flatnonzero(data == 32)[1:], len(data)) if words else np.empty(0, np.int64)
        ends = np.cumsum(self.token_bytes[ids])
        last = np.searchsorted(ends, cuts)
        if len(words) and not np.array_equal(ends[last], cuts):
            raise ValueError("the tokenizer merges across the pieces of its pattern")
        raw, at = ids.tobytes(), ((last + 1) * self.width).tolist()
        out = [(w, raw[i:j]) for w, i, j in zip(words, [0, *at], at)]
        return out + list(zip(others, self._ids(others)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        if len(self.pieces) >= CACHED_PIECES:
            # The last full generation is kept for pieces that come again.
            self.last, self.pieces = self.pieces, {}
        known, whole, waiting, new = self.pieces, [], [], set()
        for i, x in enumerate(texts):
            if not x:
                continue
            if not (self.cuts and is_latin(x)):
                whole.append(i)
                continue
            pieces = self.split.findall(x)
            ids = list(map(known.get, pieces))
            if None in ids:
                gaps = {j: pieces[j] for j, v in enumerate(ids) if v is None}
                new.update(gaps.values())
                waiting.append((i, ids, gaps))
            else:
                out[i] = b"".join(ids)
        again = new & self.last.keys()
        known.update((p, self.last[p]) for p in again)
        known.update(self._piece_ids(new - again))
        for i, ids, gaps in waiting:
            for j, p in gaps.items():
                ids[j] = known[p]
            out[i] = b"".join(ids)
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        return [ids + self.end for ids in out]


def _plain_byte_level(tokenizer: str) -> bool:
    spec = json.loads(tokenizer)
    pre = spec.get("pre_tokenizer") or {}
    return (
        pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
    )


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(key: tuple, tokenizer: str, end_id: int | None) -> Encoder:
    """One encoder for a Python worker, which serves many tasks."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer, end_id)
    return _ENCODERS[key]


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + os.path.abspath(folder))


def write_tokens(documents: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Writes the data set into ``folder``; returns its manifest. ``tokenizer`` is the path of a tokenizers file on the
    driver; its content (a vocabulary, the same for any input) is broadcast."""
    spark = documents.sparkSession
    if not isinstance(documents.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be an integer")
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    name = (tokenizer, end_id)
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    d = documents.select(F.col(key).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ordered = in_partitions(d.withColumn("_hash", F.xxhash64("_text")), "_id", "_hash").select("part", "_id", "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, ends, ids, has = None, [0], [], []
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                    b = whole.slice(at, ROWS_PER_BATCH)
                    if out is None:
                        encoder = _ENCODERS.get(name) or _encoder(name, spec.value, end_id)
                        task = TaskContext.get()
                        fs, root = _open(folder)
                        shard = b.column(0)[0].as_py()
                        base = f"part-{shard:06d}-{task.taskAttemptId()}"
                        out = fs.open_output_stream(f"{root}/{base}.ids", compression=None)
                    for i, x in zip(b.column(1).to_pylist(), encoder.encode(b.column(2).to_pylist())):
                        out.write(x)
                        ends.append(ends[-1] + len(x) // encoder.width)
                        ids.append(i or 0)
                        has.append(i is not None)
        finally:
            if out is not None:
                out.close()
        if out is not None:
            with fs.open_output_stream(f"{root}/{base}.idx", compression=None) as f:
                for numbers in (ends, ids, has):
                    f.write(np.array(numbers, "<i8").tobytes())
            yield pa.RecordBatch.from_pydict({
                "shard": [shard], "ids_file": [f"{base}.ids"], "idx_file": [f"{base}.idx"], "width": pa.array([encoder.width], pa.int32()),
                "n_docs": [len(ids)], "n_tokens": [ends[-1]],
            })

    shards = written(ordered.mapInArrow(write, SHARD), "token-shards")
    bases(shards, "shard", "n_docs", "n_tokens").write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{SHARD}, first_n_docs long, first_n_tokens long").parquet(f"{folder}/manifest")


def _mapped(fs: pafs.FileSystem, path: str, kind: str, start: int, n: int) -> np.ndarray:
    """``n`` numbers of a file from the ``start``-th on: a view of the mapped file, or of the bytes read if the store isn't local."""
    kind_ = np.dtype(kind)
    if n == 0:
        return np.empty(0, kind_)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind_, "r", start * kind_.itemsize, (n,))
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_at(n * kind_.itemsize, start * kind_.itemsize), kind_)


class Shard:
    """Two files of a data set; ids of a document are a view of the mapped file, nothing is copied."""

    def __init__(self, fs: pafs.FileSystem, root: str, ids_file: str, idx_file: str, width: int, n_docs: int):
        self.fs, self.ids_path, self.idx_path, self.kind, self.n_docs = fs, f"{root}/{ids_file}", f"{root}/{idx_file}", f"<u{width}", n_docs

    def part(self, first: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of documents [first, first + n): offsets (n + 1), doc ids, flags, and the ids from the first offset on."""
        ends = _mapped(self.fs, self.idx_path, "<i8", first, n + 1)
        keys = _mapped(self.fs, self.idx_path, "<i8", self.n_docs + 1 + first, n)
        has = _mapped(self.fs, self.idx_path, "<i8", 2 * self.n_docs + 1 + first, n)
        return ends, keys, has, _mapped(self.fs, self.ids_path, self.kind, int(ends[0]), int(ends[-1] - ends[0]))


class TokenFiles:
    """Random access by position, for a trainer: ``files[i]`` is the ids of the i-th document in ascending order."""

    def __init__(self, folder: str, manifest: list):
        self.fs, self.root = _open(folder)
        self.rows = sorted(manifest, key=lambda r: r["shard"])
        self.firsts = np.array([r["first_n_docs"] for r in self.rows])

    def __len__(self) -> int:
        return sum(r["n_docs"] for r in self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < len(self):
            raise IndexError(i)
        r = self.rows[int(np.searchsorted(self.firsts, i, "right")) - 1]
        shard = Shard(self.fs, self.root, r["ids_file"], r["idx_file"], r["width"], r["n_docs"])
        return shard.part(i - r["first_n_docs"], 1)[3]


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame, ids: bool = True) -> DataFrame:
    """The documents of a data set: doc_id, start (ids before it), n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers) and ids (those bytes; null if ``ids`` is false)."""
    step = F.lit(DOCS_PER_RANGE).cast("long")
    ranges = manifest.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, step)).alias("first"))
    tasks = max(1, min(ranges.count(), READ_TASKS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for b in batches:
            for ids_file, idx_file, width, n_docs, base, first in zip(*(c.to_pylist() for c in b.columns)):
                shard = Shard(fs, root, ids_file, idx_file, width, n_docs)
                end = min(first + DOCS_PER_RANGE, n_docs)
                for at in range(first, end, ROWS_PER_BATCH):
                    ends, keys, has, tokens = shard.part(at, min(ROWS_PER_BATCH, end - at))
                    cuts = (ends - ends[0]).tolist()
                    whole = memoryview(tokens.astype("<u4").tobytes())
                    raw = [whole[4 * x : 4 * y] for x, y in zip(cuts, cuts[1:])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([k if h else None for k, h in zip(keys.tolist(), has.tolist())], pa.int64()),
                        pa.array(ends[:-1] + base, pa.int64()), pa.array(np.diff(ends), pa.int64()),
                        pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                        pa.array([bytes(x) for x in raw] if ids else [None] * len(raw), pa.binary()),
                    ], schema=_TOKENS)

    columns = ("ids_file", "idx_file", "width", "n_docs", "first_n_tokens", "first")
    return ranges.select(*columns).repartition(tasks).mapInArrow(read, TOKENS)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    manifest = write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY))
    return read_tokens(spark, folder, manifest, ids=False).drop("ids")
