"""Removal of repeated substrings with suffix arrays.

A repeat is a string of ``length`` bytes that starts at two places or more. Every such window picks an anchor: the
leftmost smallest hash of a 64-byte gram within it. The choice depends on the window's bytes alone, so equal windows
pick equal anchors, and the windows of a text fall into runs, about one for 170 bytes, that share an anchor. Only the hashes of
the anchor and of the run's whole context travel at first:

* a context that occurs twice is covered whole, and nothing more need be known about its copies;
* of the contexts that share an anchor without being equal, one of each kind goes to the shard of that anchor;
* all other text, the bulk of it, is left where it is.

A shard concatenates its contexts and sorts their suffixes by Larsson-Sadakane refinement; Kasai's algorithm gives the
common prefixes, and neighbours with ``length`` bytes in common are repeats. Contexts of one anchor that fill more than one
shard are merged by binary search of each shard's windows in the other's suffix array. Anchors with very many different contexts
have their windows hashed one by one instead, which needs no group in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_groups, load, materialize, shuffle_partitions, text_of
from .passages import shared_passages

LENGTH, GRAM = 400, 64
#: Bytes of a shard. Anchors with more different contexts than CROWD have their windows hashed.
SHARD, CROWD = 1 << 20, 4096
_PLACE = 20
_PIECE = (1 << _PLACE) - 1


# --- suffix arrays ---------------------------------------------------------------------------------------------------


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one big-endian number; zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data)]).view(">u8").ravel().astype(np.uint64)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order.

    Larsson-Sadakane: sort by the first 8 bytes, then, with twice the depth each time, sort only
    within groups that are still equal, by the rank of what follows.
    """
    n = len(data)
    key = _words(data)
    sa = np.argsort(key)
    new = np.ones(n, np.bool_)
    new[1:] = key[sa[1:]] != key[sa[:-1]]
    if n:  # a suffix of under 8 bytes is padded; a longer one with equal bytes comes after it
        tail = np.maximum(0, 8 - (n - sa))
        mixed = np.flatnonzero(~new & ((tail > 0) | np.r_[False, tail[:-1] > 0]))
        if len(mixed):
            sa = np.lexsort((-np.maximum(0, 8 - (n - np.arange(n))), key))
            t = np.maximum(0, 8 - (n - sa))
            new[1:] = (key[sa[1:]] != key[sa[:-1]]) | (t[1:] != t[:-1])
    rank = np.empty(n, np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[sa] = group
    h = 8
    while h < n:
        alone = new & np.r_[new[1:], True]
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        start, place = sa[at], group[at]
        follow = np.where(start + h < n, rank[np.minimum(start + h, n - 1)] + 1, 0)
        order = np.argsort(place * (n + 1) + follow)  # one number for both, below 2 ** 63 for any shard
        sa[at], follow = start[order], follow[order]
        fresh = np.ones(len(at), np.bool_)
        fresh[1:] = (place[1:] != place[:-1]) | (follow[1:] != follow[:-1])
        new[at] = fresh
        group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[sa[at]] = group[at]
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int, stride: int = 128) -> np.ndarray:
    """Bytes, up to ``most``, that each suffix has in common with the one before it in order.

    Kasai: the suffix that starts one byte later has at most one byte less in common. Stretches of
    ``stride`` positions go through the text side by side, eight bytes at a comparison.
    """
    n = len(data)
    words = np.concatenate([_words(data), np.zeros(8, np.uint64)])
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int64)
    heads = np.arange(0, n, stride)
    length = np.zeros(len(heads), np.int64)
    for step in range(stride):
        i = heads + step
        live = np.flatnonzero(i < n)
        i, length = i[live], np.maximum(length[live] - 1, 0)
        heads = heads[live]
        j = before[i]
        length[j < 0] = 0
        act = np.flatnonzero((j >= 0) & (length < most))
        while len(act):
            a, b = i[act] + length[act], j[act] + length[act]
            room = n - np.maximum(a, b)
            x = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
            same = np.full(len(act), 8, np.int64)
            hit = x != 0
            if hit.any():
                y, c = x[hit], np.zeros(int(hit.sum()), np.int64)
                for k in range(1, 8):
                    c += (y >> np.uint64(64 - 8 * k)) == 0
                same[hit] = c
            got = np.minimum(same, np.maximum(room, 0))
            length[act] += got
            act = act[(got == 8) & (length[act] < most)]
        out[i] = length
    out = np.minimum(out, most)
    lcp = np.zeros(n, np.int64)
    lcp[1:] = out[sa[1:]]
    return lcp


def _less(words_a: np.ndarray, a: np.ndarray, words_b: np.ndarray, b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(a < b, a == b) for the ``length`` bytes from the places on; length is a multiple of 8."""
    less, same, act = np.zeros(len(a), np.bool_), np.zeros(len(a), np.bool_), np.arange(len(a))
    for k in range(0, length, 8):
        if not len(act):
            return less, same
        x, y = words_a[a[act] + k], words_b[b[act] + k]
        less[act[x < y]] = True
        act = act[x == y]
    same[act] = True
    return less, same


class Shard:
    """Contexts in one text with the suffix array over all places where a whole window starts."""

    def __init__(self, contexts: list[bytes], length: int):
        self.length, self.sizes = length, np.array([len(c) for c in contexts])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(contexts), np.uint8)
        n = len(self.data)
        ok = np.zeros(n + 1, np.int64)
        np.add.at(ok, self.starts, 1)
        np.add.at(ok, np.maximum(self.starts, self.starts + self.sizes - length + 1), -1)
        valid = np.cumsum(ok[:n]) > 0
        sa = suffix_array(self.data)
        lcp = common_prefixes(self.data, sa, length)
        at = np.flatnonzero(valid[sa])
        self.sa = sa[at]
        # the common prefix with the next valid suffix is the least on the way to it
        lcp = np.minimum.reduceat(lcp[: at[-1] + 1], np.r_[0, at[:-1] + 1]) if len(at) else lcp[:0]
        if len(at):
            lcp[0] = 0
        self.covered = np.zeros(n, np.bool_)
        pair = np.flatnonzero(lcp >= length)
        self.covered[self.sa[pair]] = True
        self.covered[self.sa[pair - 1]] = True
        self.words = _words(self.data)

    def merge(self, other: "Shard") -> None:
        """Mark the windows that the two shards share, by binary search of this one's in the other's array."""
        if not len(self.sa) or not len(other.sa):
            return
        mine = self.sa
        lo, hi = np.zeros(len(mine), np.int64), np.full(len(mine), len(other.sa), np.int64)
        while (act := np.flatnonzero(lo < hi)).size:
            mid = (lo[act] + hi[act]) // 2
            less, _ = _less(other.words, other.sa[mid], self.words, mine[act], self.length)
            lo[act] = np.where(less, mid + 1, lo[act])
            hi[act] = np.where(less, hi[act], mid)
        inside = np.flatnonzero(lo < len(other.sa))
        _, same = _less(other.words, other.sa[lo[inside]], self.words, mine[inside], self.length)
        hit = inside[same]
        self.covered[mine[hit]] = True
        # all of the other's windows that equal a hit, not only the first
        first, act = lo[hit], np.arange(len(hit))
        step = first.copy()
        while len(act):
            other.covered[other.sa[step[act]]] = True
            step[act] += 1
            act = act[step[act] < len(other.sa)]
            _, same = _less(other.words, other.sa[np.minimum(step[act], len(other.sa) - 1)], self.words, mine[hit[act]], self.length)
            act = act[same]

    def runs(self) -> list[list[int]]:
        """For each context first and last covered window start, in turn, from its own start."""
        out = []
        for a, n in zip(self.starts.tolist(), self.sizes.tolist(), strict=True):
            c = self.covered[a : a + n].astype(np.int8)
            d = np.diff(np.r_[0, c, 0])
            out.append(np.stack([np.flatnonzero(d == 1), np.flatnonzero(d == -1) - 1], axis=1).ravel().tolist())
        return out


def repeated_runs(contexts: list[bytes], length: int = LENGTH, shard: int = SHARD) -> list[list[int]]:
    """Covered window starts of each context, over shards of some ``shard`` bytes that are merged."""
    parts, part, size = [], [], 0
    for c in contexts:
        part.append(c)
        size += len(c)
        if size >= shard:
            parts.append(Shard(part, length))
            part, size = [], 0
    if part:
        parts.append(Shard(part, length))
    for i, a in enumerate(parts):
        for b in parts[:i]:
            a.merge(b)
    return [r for p in parts for r in p.runs()]


# --- anchors ---------------------------------------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    mult, span = np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while span < GRAM:
            h = h[:-span] * mult + h[span:]
            h ^= h >> np.uint64(29)
            mult *= np.uint64(0xD1342543DE82EF95)
            span *= 2
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def anchor_runs(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, last window start, anchor hash) of every run; texts are data[start:stop]."""
    wide = length - GRAM + 1
    h = _gram_hashes(data)
    key = (h & ~np.uint64(_PIECE)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= wide:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < wide:
        key = np.minimum(key[: -(wide - span)], key[wide - span :])
    picked = (key & np.uint64(_PIECE)).astype(np.int64)
    n = np.maximum(0, stops - starts - length + 1)
    total = np.cumsum(n)
    if not total[-1]:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    places = np.repeat(starts - (total - n), n) + np.arange(total[-1])
    own = picked[places]
    head = np.ones(len(places), np.bool_)
    head[1:] = (own[1:] != own[:-1]) | (places[1:] != places[:-1] + 1)
    head[(total - n)[n > 0]] = True
    first = np.flatnonzero(head)
    last = np.r_[first[1:], len(places)] - 1
    return places[first], places[last], h[own[first]]


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h64 = xxhash.xxh3_64_intdigest
        for batch in batches:
            ranks, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            texts = batch.column(2).to_pylist()
            queue, held = [], 0  # (row, offset of the piece, bytes)

            def go() -> pa.RecordBatch:
                raw = b"".join(p for _, _, p in queue)
                sizes = np.array([len(p) for _, _, p in queue])
                ends = np.cumsum(sizes)
                a, b, h = anchor_runs(np.frombuffer(raw, np.uint8), ends - sizes, ends, length)
                piece = np.searchsorted(ends, a, side="right")
                shift = np.array([o for _, o, _ in queue]) - (ends - sizes)
                rows = np.array([r for r, _, _ in queue])[piece]
                ctx = np.array([h64(raw[x:y]) for x, y in zip(a.tolist(), (b + length).tolist(), strict=True)], np.uint64)
                return pa.RecordBatch.from_arrays(
                    [pa.array(ranks[rows]), pa.array(marks[rows]), pa.array((a + shift[piece]).astype(np.int32)), pa.array((b + length + shift[piece]).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(ctx.view(np.int64))],
                    ["rank", "mark", "lo", "hi", "anchor", "context"],
                )

            for row, text in enumerate(texts):
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) < length:
                    continue
                # a very long text goes in pieces that overlap by one window less a byte
                for at in range(0, len(raw) - length + 1, 500_000):
                    queue.append((row, at, raw[at : at + 500_000 + length - 1]))
                    held += len(queue[-1][2])
                    if held >= 400_000:
                        yield go()
                        queue, held = [], 0
            if queue:
                yield go()

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that a document is to send."""
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            raw = zstandard.decompress(text)
            out += [(w["anchor"], w["context"], w["crowded"], raw[w["lo"] : w["hi"]]) for w in wanted]
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)], ["anchor", "context", "crowded", "data"])


def _sort_shards(length: int, shard: int):
    """Contexts come sorted by anchor; a shard has whole anchors unless one alone is larger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[int, int]] = []
        data: list[bytes] = []
        size = 0

        def go() -> pa.RecordBatch:
            nonlocal size
            runs = repeated_runs(data, length, 2 * shard)
            out = [(*k, r) for k, r in zip(keys, runs, strict=True) if r]
            keys.clear(), data.clear()
            size = 0
            cols = list(zip(*out, strict=True)) if out else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.list_(pa.int32())), strict=True)], ["anchor", "context", "runs"])

        for batch in batches:
            for anchor, context, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if size >= shard and anchor != keys[-1][0]:
                    yield go()
                keys.append((anchor, context))
                data.append(raw)
                size += len(raw)
        if keys:
            yield go()

    return run


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, context, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                n = len(raw) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor] * n, pa.int64()), pa.array([context] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([xxhash.xxh3_128_digest(raw[i : i + length]) for i in range(n)], pa.binary())],
                    ["anchor", "context", "at", "window"],
                )

    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([squeeze(t.encode("utf-8", "surrogatepass")) for t in batch.column(3).to_pylist()], pa.binary())], ["rank", "mark", "doc_id", "text"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text, spans, shared in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans", "n_shared")), strict=True):
            raw, kept, at, gone, united = zstandard.decompress(text), [], 0, 0, []
            for a, b in sorted((s["lo"], s["hi"]) for s in spans or ()):
                if united and a <= united[-1][1]:
                    united[-1][1] = max(united[-1][1], b)
                else:
                    united.append([a, b])
            for a, b in united:
                kept.append(raw[at:a])
                gone, at = gone + b - a, b
            rest = b"".join([*kept, raw[at:]])
            out.append((doc, len(raw), gone, len(united), hashlib.sha256(rest).hexdigest(), shared or 0, rest, [x for u in united for x in u]))
        cols = list(zip(*out, strict=True)) if out else [[]] * 8
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in _OUT.split(", ")])


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long, kept binary, spans array<int>"


def suffix_dedup(docs: DataFrame, length: int = LENGTH, shard: int = SHARD, crowd: int = CROWD, passage_words: int | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared, kept (the bytes left), spans (start and end in turn).

    ``n_shared`` tells, with ``passage_words``, that the document has so many words in a row in common with another one, which may
    be under ``length`` bytes; see :func:`passages.shared_passages`. It has no part in what is removed.

    A null text is empty. Texts shorter than ``length`` lose nothing. Rows that share a doc_id are documents
    of their own, and a repeated row is a repeat of the other. An empty table gives an empty result; other columns are ignored.
    ``length`` is a multiple of 8, and above 64.
    """
    if length % 8 or length <= GRAM:
        raise ValueError("length must be a multiple of 8 above 64")
    # a document's key: its doc_id, and a hash of its text and of whether the doc_id is null; equal rows have one key and equal runs
    doc_id, text = docs["doc_id"].cast("long"), text_of(docs)
    rows = docs.select(F.coalesce(doc_id, F.lit(0)).alias("rank"), F.xxhash64(doc_id.isNull(), text).alias("mark"), doc_id.alias("doc_id"), text.alias("text"))
    anchors = materialize(rows.select("rank", "mark", "text").mapInArrow(_anchors(length), "rank long, mark long, lo int, hi int, anchor long, context long"), "anchors")
    n = shuffle_partitions(docs.sparkSession)
    kinds = materialize(anchors.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rank", "mark", "lo", "hi")).alias("one")), "contexts")
    many = materialize(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "many")
    whole = kinds.where("n > 1").select("anchor", "context", "n", F.lit(None).cast("array<int>").alias("runs"))
    send = join_groups(kinds, many, "anchor", "kinds", "inner").select(F.col("one.rank").alias("rank"), F.col("one.mark").alias("mark"), F.struct("anchor", "context", F.col("one.lo").alias("lo"), F.col("one.hi").alias("hi"), (F.col("kinds") > crowd).alias("crowded")).alias("w"))
    send = send.groupBy("rank", "mark").agg(F.collect_list("w").alias("wanted"))  # no more than the document's own runs
    texts = rows.mapInArrow(_squeeze, "rank long, mark long, doc_id long, text binary")
    sent = texts.drop("doc_id").join(send, ["rank", "mark"]).select("text", "wanted").mapInArrow(_fetch, "anchor long, context long, crowded boolean, data binary")
    sent = materialize(sent, "sent").dropDuplicates(["anchor", "context"])  # repeated rows send twice
    quiet = sent.where(~F.col("crowded")).select("anchor", "context", "data").repartition(n, "anchor").sortWithinPartitions("anchor", "context")
    sorted_ = quiet.mapInArrow(_sort_shards(length, shard), "anchor long, context long, runs array<int>")
    windows = sent.where("crowded").select("anchor", "context", "data").mapInArrow(_windows(length), "anchor long, context long, at int, window binary")
    hashed = sorted_.limit(0)
    if not many.where(F.col("kinds") > crowd).isEmpty():
        windows = materialize(windows, "windows")
        twice = materialize(windows.groupBy("window").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "twice")
        hashed = join_groups(windows, twice, "window", "c", "inner").groupBy("anchor", "context").agg(F.flatten(F.collect_list(F.array("at", "at"))).alias("runs"))
    partly = sorted_.unionByName(hashed).join(kinds.where("n = 1").select("anchor", "context", "n"), ["anchor", "context"])
    hits = materialize(whole.unionByName(partly.select("anchor", "context", "n", "runs")), "hits")
    covered = join_groups(anchors, hits, ["anchor", "context"], "n", "inner")
    pairs = F.when(F.col("runs").isNull(), F.array(F.struct(F.col("lo").alias("lo"), F.col("hi").alias("hi")))).otherwise(
        F.transform(F.sequence(F.lit(0), (F.size("runs") / 2).cast("int") - 1), lambda i: F.struct((F.col("lo") + F.get("runs", 2 * i)).alias("lo"), (F.col("lo") + F.get("runs", 2 * i + 1) + length).alias("hi")))
    )
    spans = covered.select("rank", "mark", pairs.alias("p")).groupBy("rank", "mark").agg(F.flatten(F.collect_list("p")).alias("spans"))
    if passage_words is None:
        spans = spans.withColumn("n_shared", F.lit(None).cast("long"))
    else:
        named = rows.select("rank", "mark", F.xxhash64("rank", "mark").alias("doc"), "text")
        found = named.drop("text").join(shared_passages(named, passage_words), "doc").drop("doc").distinct()
        spans = spans.join(found, ["rank", "mark"], "full")
    return texts.join(spans, ["rank", "mark"], "left").select("doc_id", "text", "spans", "n_shared").mapInArrow(_remove, _OUT)


#: Passages of over 50 words are reported, though they may be under 400 bytes.
PASSAGE_WORDS = 51


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(load(spark, sf_dir, "documents"), passage_words=PASSAGE_WORDS)
    return out.withColumn("repeats_passage", F.col("n_shared") > 0).drop("kept", "spans")
