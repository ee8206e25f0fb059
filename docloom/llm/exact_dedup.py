"""Exact deduplication with a sharded minimal perfect hash over the digests already known.

Texts are normalised and hashed by the JVM in the scan, so no text is ever shuffled. Digests are
spread over shards by their leading bits. A shard of the index is a minimal perfect hash built
level by level: a key settles at the first level where no other key shares its bit, and the rank
of that bit is its slot. A slot holds the full digest and the winner's locator, so a lookup
compares all 32 bytes and a stranger that falls on an occupied slot is told apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, join_groups, load, materialize, text_of, unused

GAMMA = 2.0
#: Digests in one shard of the index, on average: 40 bytes each, some 8 MB.
SHARD_KEYS = 200_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(words: np.ndarray, level: int) -> np.ndarray:
    """One 64-bit hash per digest and level (splitmix finaliser over two of its words)."""
    with np.errstate(over="ignore"):
        x = words[:, 1] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * _M1
        x ^= words[:, 2]
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash over distinct 32-byte digests: every key has its own slot in 0..n-1."""

    def __init__(self, digests: np.ndarray):
        """``digests``: uint8 array (n, 32) of distinct rows."""
        words = np.ascontiguousarray(digests).view(np.uint64).reshape(-1, 4)
        left, self.bits, self.base, done = np.arange(len(words)), [], [], 0
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            at = (_mix(words[left], len(self.bits)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.bool_)
            bits[at[alone]] = True
            self.bits.append(bits)
            self.base.append(done + np.cumsum(bits) - 1)
            done += int(alone.sum())
            left = left[~alone]
            if len(self.bits) > 200:
                raise ValueError("digests are not distinct")
        self.n = len(words)
        self.slots = np.zeros((self.n, 32), np.uint8)
        if self.n:
            self.slots[self.slot(digests)] = digests

    def slot(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; some slot or -1 for a digest that is no key."""
        words = np.ascontiguousarray(digests).view(np.uint64).reshape(-1, 4)
        out, open_ = np.full(len(words), -1, np.int64), np.arange(len(words))
        for level, (bits, base) in enumerate(zip(self.bits, self.base, strict=True)):
            if not len(open_):
                break
            at = (_mix(words[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = base[at[hit]]
            open_ = open_[~hit]
        return out

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest that is a key, byte for byte; else -1."""
        at = self.slot(digests)
        ok = at >= 0
        ok[ok] = (self.slots[at[ok]] == digests[ok]).all(axis=1)
        return np.where(ok, at, -1)


def _digests(table: pa.Table) -> np.ndarray:
    column = table.column("digest").combine_chunks()
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, 32)


_GROUP = "digest binary, keep_id long, group_size long, n_first long, known boolean"


def _lookup(known: pa.Table, new: pa.Table) -> pa.Table:
    """Look a shard's new digests up in the hash over its known ones."""
    a, b = _digests(known), _digests(new)
    index = PerfectHash(a)
    cols = {}
    for c in ("keep_id", "group_size", "n_first"):
        for name, side in ((c, known), ("new_" + c, new)):
            cols[name] = side.column(c).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).copy()
    none, new_none = (x.column("keep_id").is_null().to_numpy().copy() for x in (known, new))  # no id at all: after every id
    row = np.empty(index.n, np.int64)  # winner locators by slot
    if index.n:
        row[index.slot(a)] = np.arange(index.n)
    at = index.find(b) if index.n else np.full(len(b), -1)
    member = at >= 0
    to = row[at[member]] if index.n else np.zeros(0, np.int64)
    keep, first = cols["keep_id"], cols["n_first"]
    cols["group_size"][to] += cols["new_group_size"][member]
    nk, nf, nn = cols["new_keep_id"][member], cols["new_n_first"][member], new_none[member]
    same = (nn == none[to]) & (nn | (nk == keep[to]))
    less = ~same & (none[to] & ~nn | (nn == none[to]) & (nk < keep[to]))
    first[to] = np.where(less, nf, np.where(same, first[to] + nf, first[to]))
    keep[to], none[to] = np.where(less, nk, keep[to]), np.where(less, nn, none[to])
    out = [np.concatenate([cols[c], cols["new_" + c][~member]]) for c in ("keep_id", "group_size", "n_first")]
    digests = known.column("digest").to_pylist() + new.column("digest").filter(pa.array(~member)).to_pylist()
    return pa.table({
        "digest": pa.array(digests, pa.binary()), "keep_id": pa.array(out[0], pa.int64(), mask=np.concatenate([none, new_none[~member]])), "group_size": out[1], "n_first": out[2],
        "known": np.r_[np.ones(len(a), bool), np.zeros(int((~member).sum()), bool)],
    })


def digest_groups(rows: DataFrame) -> DataFrame:
    """One row per digest: smallest doc_id, rows, and rows that have that smallest doc_id."""
    return (
        rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"), F.coalesce(F.min_by("n", "doc_id"), F.sum("n")).alias("n_first"))
    )


def match_history(history: DataFrame, new: DataFrame, n_digests: int) -> DataFrame:
    """Groups over both sides; ``known``: the digest was in ``history``. Both sides as of :func:`digest_groups`."""
    shards = max(1, -(-n_digests // SHARD_KEYS))
    shard = F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")
    # the shards, not the rows, are the groups: the leading bits of SHA-256 spread them evenly
    left, right = (x.withColumn("shard", shard).groupBy("shard") for x in (history, new))
    return left.cogroup(right).applyInArrow(_lookup, _GROUP)


def exact_dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Label every row with the row that stays of all rows with an equal text.

    Equal: identical once each run of ASCII white space is one space. A null text counts as empty.
    Of equal texts the smallest doc_id stays; nulls in doc_id come last, and among rows that share
    the text and the smallest doc_id (repeated rows) exactly one stays. ``history``: groups of
    :func:`digest_groups` that earlier batches left; without it the lower half of the id range
    is the history and the upper half is looked up in it, which gives the same groups as any split.
    An empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest(docs).alias("digest")), "digests")
    groups = _groups(rows, history)
    out = join_groups(rows, groups, "digest", "group_size", "inner")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    tied = first & (F.col("n_first") > 1)
    one = out.where(~tied).withColumn("kept", first)
    if out.where(tied).isEmpty():
        many = one.limit(0)
    else:  # repeated rows: the one at the first place in the written table stays; the places of a text are a minimum, not a list
        again = materialize(out.where(tied), "repeated")
        again = again.withColumn("place", F.struct("_metadata.file_path", "_metadata.row_index"))
        places = again.groupBy("digest").agg(F.min("place").alias("stays"), F.count(F.lit(1)).alias("c"))
        many = join_groups(again, materialize(places, "places"), "digest", "c", "inner").withColumn("kept", F.col("place") == F.col("stays")).select(one.columns)
    return one.unionByName(many).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), "known")


def _digest(docs: DataFrame) -> Column:
    return F.unhex(F.sha2(F.regexp_replace(text_of(docs), SPACE, " ").cast("binary"), 256))


def _groups(rows: DataFrame, history: DataFrame | None) -> DataFrame:
    if history is None:
        low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
        mid = F.lit(None if low is None else low + (high - low) // 2)
        early = F.coalesce(F.col("doc_id") <= mid, F.lit(False))
        old, new = digest_groups(rows.where(early)), digest_groups(rows.where(~early))
        n_digests = rows.count()
    else:
        old, new, n_digests = history, digest_groups(rows), history.count() + rows.count()
    return materialize(match_history(old, new, n_digests), "groups")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each text, with all columns of ``docs``, whatever their names.

    Rules as for :func:`exact_dedup`; of repeated rows one stays.
    """
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest(docs).alias("digest")), "digests")
    digest, keep, n_first = unused(docs.columns, "_digest", "_keep", "_first")
    groups = _groups(rows, None).select(F.col("digest").alias(digest), F.col("keep_id").alias(keep), F.col("n_first").alias(n_first))
    # each text's winner is one row, so the join's key (text and doc_id) is never a hot one
    same = (_digest(docs) == groups[digest]) & F.col("doc_id").cast("long").eqNullSafe(groups[keep])
    if groups.where(groups[n_first] > 1).isEmpty():
        return docs.join(groups, same, "left_semi")
    kept = docs.join(groups, same)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.where(groups[n_first] == 1).select(*columns).unionByName(kept.where(groups[n_first] > 1).dropDuplicates([digest]).select(*columns))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(load(spark, sf_dir, "documents")).drop("known")


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.text_sha256 = g.text_sha256
"""
