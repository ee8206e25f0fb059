"""Token files: a wavelet matrix for each shard of the corpus.

Ids are stored as bit-planes from the highest bit down. After each plane the ids are parted stably by
its bit, zeros first, which makes access, counting and occurrence lookup a walk of one rank or
select a plane. A plane is cut into blocks that are compressed one by one, with the number of ones
before each block, so a query inflates only the blocks that it touches.

File: ``DLWM0001``, length of the header (u32), the header in JSON, the parts that it lists.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import load, materialize, new_path, shuffle_partitions, text_of
from .packing import tokenizer_file
from .tokens import encoder

MAGIC = b"DLWM0001"
BLOCK_BITS = 1 << 17
#: Ids in a file, a longer document apart: documents are never split.
SHARD_TOKENS = 1 << 21


def encode_file(ids: np.ndarray, doc_ids: list[int | None], sizes: np.ndarray, bits: int = 16) -> bytes:
    """The file of one shard. ``sizes``: ids of each document, in the order of ``doc_ids``."""
    a, parts, planes = ids.astype(np.uint16 if bits <= 16 else np.uint32), [], []
    pack = zstandard.ZstdCompressor(level=1).compress

    def put(raw: bytes) -> list[int]:
        parts.append(raw)
        return [sum_[0], sum_.__setitem__(0, sum_[0] + len(raw)) or len(raw)]

    sum_ = [0]
    for bit in range(bits - 1, -1, -1):
        one = (a & a.dtype.type(1 << bit)) != 0
        raw = np.packbits(one).tobytes()
        ones, zeros = np.flatnonzero(one), np.flatnonzero(~one)
        a = np.concatenate([a[zeros], a[ones]])
        before = np.searchsorted(ones, np.arange(0, len(one) + 1, BLOCK_BITS)).tolist()
        blocks = [put(pack(raw[i : i + BLOCK_BITS // 8])) for i in range(0, len(raw), BLOCK_BITS // 8)]
        planes.append({"zeros": len(zeros), "before": before, "blocks": blocks})
    null = np.array([d is None for d in doc_ids], np.bool_)
    table = put(pack(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + null.tobytes() + np.asarray(sizes, "<i8").tobytes()))
    header = json.dumps({"n": len(ids), "bits": bits, "docs": len(doc_ids), "planes": planes, "table": table}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *parts])


class TokenFile:
    """Reader of one file: decoding, access, counting and occurrence lookup."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("no token file")
        n = int.from_bytes(data[8:12], "little")
        self.head, self._data, self._at = json.loads(data[12 : 12 + n]), memoryview(data), 12 + n
        self.n, self.bits, self.planes = self.head["n"], self.head["bits"], self.head["planes"]
        self._block = lru_cache(256)(self._load)

    def _part(self, where: list[int]) -> bytes:
        a = self._at + where[0]
        return zstandard.ZstdDecompressor().decompress(self._data[a : a + where[1]])

    def _load(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        bits = np.unpackbits(np.frombuffer(self._part(self.planes[plane]["blocks"][block]), np.uint8))
        return bits, np.cumsum(bits, dtype=np.int32)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        raw, m = self._part(self.head["table"]), self.head["docs"]
        ids, null = np.frombuffer(raw, "<i8", m).tolist(), np.frombuffer(raw, np.bool_, m, 8 * m)
        return [None if x else i for i, x in zip(ids, null, strict=True)], np.frombuffer(raw, "<i8", m, 9 * m)

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane up: each step undoes one parting."""
        v = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for k in range(self.bits - 1, -1, -1):
            p = self.planes[k]
            one = np.unpackbits(np.frombuffer(b"".join(map(self._part, p["blocks"])), np.uint8), count=self.n).view(np.bool_)
            u = np.empty_like(v)
            u[np.flatnonzero(~one)] = v[: p["zeros"]]
            u[np.flatnonzero(one)] = v[p["zeros"] :] | v.dtype.type(1 << (self.bits - 1 - k))
            v = u
        return v

    def _rank1(self, plane: int, i: int) -> int:
        """Ones before position ``i`` in a plane."""
        b, r = divmod(i, BLOCK_BITS)
        return self.planes[plane]["before"][b] + (int(self._block(plane, b)[1][r - 1]) if r else 0)

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, p in enumerate(self.planes):
            bit = int(self._block(k, i // BLOCK_BITS)[0][i % BLOCK_BITS])
            ones = self._rank1(k, i)
            i, value = (p["zeros"] + ones, value << 1 | 1) if bit else (i - ones, value << 1)
        return value

    def _span(self, symbol: int, a: int, b: int) -> tuple[int, int]:
        for k, p in enumerate(self.planes):
            x, y = self._rank1(k, a), self._rank1(k, b)
            a, b = (p["zeros"] + x, p["zeros"] + y) if symbol >> (self.bits - 1 - k) & 1 else (a - x, b - y)
        return a, b

    def rank(self, symbol: int, i: int) -> int:
        """Occurrences of ``symbol`` before position ``i``."""
        a, b = self._span(symbol, 0, i)
        return b - a

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _select(self, plane: int, bit: int, nth: int) -> int:
        """Position of the ``nth`` (from 0) ``bit`` in a plane."""
        before, n = self.planes[plane]["before"], len(self.planes[plane]["blocks"])
        rank = lambda b: before[b] if bit else b * BLOCK_BITS - before[b]
        lo, hi = 0, n - 1
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if rank(mid) <= nth else (lo, mid - 1)
        bits, _ = self._block(plane, lo)
        return lo * BLOCK_BITS + int(np.flatnonzero(bits == bit)[nth - rank(lo)])

    def select(self, symbol: int, nth: int) -> int:
        """Position of the ``nth`` occurrence (from 0) of ``symbol``."""
        a, b = self._span(symbol, 0, self.n)
        if not 0 <= nth < b - a:
            raise IndexError(nth)
        i = a + nth
        for k in range(self.bits - 1, -1, -1):
            bit = symbol >> (self.bits - 1 - k) & 1
            i = self._select(k, bit, i - self.planes[k]["zeros"] if bit else i)
        return i


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:/") else (fs.LocalFileSystem(), uri)


def _write(path: str, tokenizer: str, end: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(tokenizer, end), TaskContext.get()
        part, shard, held, docs, sizes = task.partitionId(), 0, [], [], []
        files, folder = _open(path)
        files.create_dir(folder, recursive=True)

        def flush() -> pa.RecordBatch:
            nonlocal shard
            ids = np.concatenate(held)
            # the attempt's number keeps a lost attempt's file apart; only listed files are read
            name = f"{part:06d}-{shard:06d}-{task.taskAttemptId()}.dlwm"
            with files.open_output_stream(f"{folder}/{name}") as out:
                out.write(encode_file(ids, docs, np.array(sizes), 16 if enc.library.get_vocab_size() <= 1 << 16 else 32))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "path": [f"{path}/{name}"], "n_docs": [len(docs)], "n_ids": [len(ids)]})
            shard += 1
            held.clear(), docs.clear(), sizes.clear()
            return row

        for batch in batches:
            ids_, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b, ids, n in enc.chunks(texts):
                held.append(ids.astype(np.uint16) if enc.library.get_vocab_size() <= 1 << 16 else ids)
                docs += ids_[a:b]
                sizes += n.tolist()
                if sum(map(len, held)) >= shard_tokens:
                    yield flush()
        if docs:
            yield flush()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            files, name = _open(path)
            with files.open_input_file(name) as f:
                shard = TokenFile(f.read())
            docs, sizes = shard.documents()
            raw = memoryview(np.ascontiguousarray(shard.decode(), "<u4")).cast("B")
            ends = np.cumsum(sizes)
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(docs, pa.int64()), "start": base + ends - sizes, "n_tokens": sizes, "ids_crc32": pa.array(crc, pa.int64())})


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the corpus in ascending doc_id order (nulls first); returns the list of files.

    Columns: part, shard (their order is that of the ids), path, n_docs, n_ids, base (ids in all files before).
    A null text is empty, its document the end id alone; repeated doc_ids are documents of their own.
    An empty table writes no file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).withColumn("place", F.monotonically_increasing_id())
    # rows that share a doc_id, or have none, may be very many: the place in the scan parts them over tasks
    rows = rows.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "place").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "place").drop("place")
    files = materialize(rows.mapInArrow(_write(path, tokenizer_path, end_id, shard_tokens), "part int, shard int, path string, n_docs long, n_ids long"), "token-files")
    # one row for each partition of the write, a number that this function has set
    before = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("ahead"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    return files.withColumn("inside", inside).join(before, "part").select("part", "shard", "path", "n_docs", "n_ids", (F.col("inside") + F.col("ahead")).alias("base"))


def read_token_files(files: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32."""
    n = max(1, min(10_000, files.count() // 2))
    return files.select("path", "base").repartition(n, "path").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    files = write_token_files(load(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), 1)
    return read_token_files(materialize(files, "token-list"))
