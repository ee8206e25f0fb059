"""SimHash near-duplicates through Golay-code fuzzy hashing.

The 64 bits are parted into segments of 23, 23 and 18 bits (the last one padded with zeros). The
binary Golay code of length 23 is perfect: each word has one codeword within 3 bits. A word's keys are
the codewords to which it and the words one bit away decode: one where its own codeword
is within 2 bits, else six or so. Two words at most one bit apart share a key: the one's own decoding is among the other's.

Three errors over three segments leave these cases, and each is an equality join:
every segment has at most one (key of all three), or one has two or more, so that of the other two
one is equal and one has at most one error. Every candidate pair is verified by its bit count,
and fingerprints, not documents, are joined: documents with equal fingerprints are a class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import re
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_groups, load, materialize, text_of, unused
from .graph import components

SEED, NEAR = 42, 3
_SPACE = re.compile(rb"[\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str) -> int:
    """64 bits: 1 where over half of the XXH64 values of the 3-word shingles have a 1."""
    words = _SPACE.sub(b" ", text.encode("utf-8", "surrogatepass").translate(_LOWER)).strip(b" ")
    if not words:
        return 0
    ends = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = [0, *(ends + 1).tolist()]
    if len(starts) <= 3:
        return xxhash.xxh64_intdigest(words, SEED)
    stops = [*ends[2:].tolist(), len(words)]
    h, n = xxhash.xxh64_intdigest, len(stops)
    counts = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 15):
        values = np.array([h(words[x:y], SEED) for x, y in zip(starts[a : a + (1 << 15)], stops[a : a + (1 << 15)], strict=False)], ">u8")
        counts += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["doc_id", "mark", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp) of every row; mark is a hash of the text, fp the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of(docs)).alias("mark"), text_of(docs).alias("text"))
    return rows.mapInArrow(_prints, "doc_id long, mark long, fp long")


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error pattern of at most 3 bits, and the syndromes of the single bits.

    The code is cyclic with generator x^11+x^10+x^6+x^5+x^4+x^2+1; a word's syndrome is its remainder.
    """

    def rest(x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for b in range(22, 10, -1):
            x ^= np.where(x >> b & 1, 0xC75 << (b - 11), 0)
        return x

    one = rest(1 << np.arange(23))
    table = np.zeros(2048, np.int64)
    for i in range(23):
        table[one[i]] = 1 << i
        for j in range(i):
            table[one[i] ^ one[j]] = 1 << i | 1 << j
            for k in range(j):
                table[one[i] ^ one[j] ^ one[k]] = 1 << i | 1 << j | 1 << k
    return table, one


def decode(words: np.ndarray) -> np.ndarray:
    """Index (the 12 information bits) of the codeword within 3 bits of each 23-bit word."""
    table, one = golay()
    syndrome = np.zeros(len(words), np.int64)
    for b in range(23):
        syndrome ^= np.where(words >> b & 1, one[b], 0)
    return (words ^ table[syndrome]) >> 11


def near_indices(words: np.ndarray, bits: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``words``, index) of all codewords to which a word or one a bit away decodes."""
    every = np.stack([decode(words)] + [decode(words ^ (1 << b)) for b in range(bits)], axis=1)
    every.sort(axis=1)
    new = np.ones(every.shape, np.bool_)
    new[:, 1:] = every[:, 1:] != every[:, :-1]
    return np.nonzero(new)[0], every[new]


def _cross(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per position all combinations of two lists of indices, as index_a << 12 | index_b."""
    nb = np.bincount(b[0], minlength=n)
    first = np.cumsum(nb) - nb
    reps = nb[a[0]]
    total = np.cumsum(reps)
    inner = np.arange(total[-1] if len(total) else 0) - np.repeat(total - reps, reps)
    left = np.repeat(np.arange(len(a[0])), reps)
    pos = a[0][left]
    return pos, a[1][left] << 12 | b[1][first[pos] + inner]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, key, side) of fingerprints: two within 3 bits share a key, one on side 0 and the other on side 1.

    For the segments A and C side 0 has the near indices and side 1 the own one; for B it is the reverse,
    which keeps both sides of the threefold key small.
    """
    u = fp.view(np.uint64)
    widths = (23, 23, 18)
    seg = [(u >> np.uint64(41)).astype(np.int64), (u >> np.uint64(18) & np.uint64(0x7FFFFF)).astype(np.int64), (u & np.uint64(0x3FFFF)).astype(np.int64)]
    n, at = len(fp), np.arange(len(fp))
    own = [decode(s) for s in seg]
    near = [near_indices(s, w) for s, w in zip(seg, widths, strict=True)]
    out = []

    def put(kind: int, side: int, pos: np.ndarray, key: np.ndarray) -> None:
        out.append((pos, np.int64(kind) << 56 | key, np.full(len(pos), side, np.int8)))

    pos, key = _cross(near[0], near[2], n)
    put(0, 0, pos, (key >> 12 << 24) | (own[1][pos] << 12) | (key & 4095))
    put(0, 1, near[1][0], own[0][near[1][0]] << 24 | near[1][1] << 12 | own[2][near[1][0]])
    kind = 1
    for exact in range(3):
        for fuzzy in range(3):
            if exact != fuzzy:
                put(kind, 0, near[fuzzy][0], seg[exact][near[fuzzy][0]] << 12 | near[fuzzy][1])
                put(kind, 1, at, seg[exact] << 12 | own[fuzzy])
                kind += 1
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_ = batch.column(0).to_numpy(zero_copy_only=False)
        for a in range(0, len(all_), 20_000):
            fp = np.ascontiguousarray(all_[a : a + 20_000])
            pos, key, side = fuzzy_keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(fp[pos]), pa.array(key), pa.array(side)], ["fp", "key", "side"])


def near_pairs(prints: DataFrame) -> DataFrame:
    """(a, b, with a < b) of the distinct fingerprints ``fp`` that differ in at most 3 bits.

    Sound and complete; a crowded key is split over tasks by the engine's skew handling, since
    the join is on equal keys and needs no key's rows together.
    """
    keys = materialize(prints.select("fp").mapInArrow(_keys, "fp long, key long, side byte"), "keys")
    left = keys.where("side = 0").select("key", F.col("fp").alias("a"))
    right = keys.where("side = 1").select("key", F.col("fp").alias("b"))
    # both orders of a close pair meet, so one order is enough
    return left.join(right, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= NEAR)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, fingerprint, n_near, component_id, mark (hash of the text), first (of its component).

    A null, empty or blank text has fingerprint zero and is linked like any other; repeated rows are
    rows of their own, linked to each other. Component ids are smallest doc_ids (nulls are left
    out of the minimum). An empty table gives an empty result; other columns are ignored.
    """
    prints = materialize(fingerprints(docs), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("low")), "classes")
    pairs = materialize(near_pairs(classes), "pairs")
    links = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = links.join(classes.select(F.col("fp").alias("b"), "n"), "b").groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("others"))
    comp = materialize(components(pairs), "components").select(F.col("node").alias("fp"), "component")
    named = classes.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lows = named.groupBy("component").agg(F.min("low").alias("first"))
    full = (
        named.join(lows, "component").join(others, "fp", "left")
        .select("fp", "n", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_near"), F.col("first.doc_id").alias("component_id"), F.col("first.mark").alias("first_mark"))
    )
    out = join_groups(prints, materialize(full, "classes"), "fp", "n", "inner")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "n_near", "component_id", "mark", (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("mark") == F.col("first_mark"))).alias("first"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that come first in their component, by doc_id and then a hash of the text.

    Of rows that share both (repeated rows) all stay; exact deduplication is for them.
    """
    id_, mark = unused(docs.columns, "_id", "_mark")
    near = near_duplicates(docs).where("first").select(F.col("doc_id").alias(id_), F.col("mark").alias(mark)).distinct()
    return docs.join(near, F.col("doc_id").cast("long").eqNullSafe(near[id_]) & (F.xxhash64(text_of(docs)) == near[mark]), "left_semi")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents")).drop("mark", "first")
