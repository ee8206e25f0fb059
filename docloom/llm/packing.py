"""Packing by power-of-two decomposition.

A document's ids are cut into as many full sequences as fit and then into pieces whose lengths are
the binary digits of the rest. Each piece is a sequence by itself, so nothing is padded and
no sequence crosses documents; sequences of equal length form a bucket, from which batches are drawn.
One pass over the documents, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, text_of
from .tokens import encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int"


def pieces(n: int, most: int) -> list[int]:
    """Lengths of the pieces of a document with ``n`` ids, longest first; ``most`` is a power of two."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 2, -1, -1) if rest >> b & 1]


def _pack(path: str, end: int, most: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, number = encoder(path, end), TaskContext.get().partitionId() << 33
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, _, ids, sizes in enc.chunks(texts):
                ids, at = np.ascontiguousarray(ids, "<u4"), 0
                raw, rows = memoryview(ids).cast("B"), []
                for k, n in enumerate(sizes.tolist()):
                    start = 0
                    for length in pieces(n, most):
                        p = 4 * (at + start)
                        rows.append((doc_ids[a + k], start, length, zlib.crc32(raw[p : p + 4 * length]), n, number, 0, length.bit_length() - 1))
                        start, number = start + length, number + 1
                    at += n
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 7 + [pa.int32()], strict=True)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]
                if with_ids:
                    lengths = np.array([r[2] for r in rows])
                    cols.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, max_length: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document; with ``with_ids`` also its ids.

    ``sequence_id`` is the task's number and a running count in it, unique even where rows repeat
    a doc_id (each row is a document). A null or empty text has the end id alone; doc_id may be null.
    An empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(_pack(tokenizer_path, end_id, max_length, with_ids), SCHEMA + (", ids array<int>" if with_ids else ""))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
