"""Documents that share a passage of words with another document.

Of the hashes of all grams of words in a document the least one in each window is selected. A passage of ``words`` words holds a whole
window, so two documents that share it select the same gram. Only the selected hashes are grouped, one in ten words or so.

:func:`shared_passages` stops there, and may tell a run that is a little shorter. :func:`shared_runs` goes on: of the documents found it
hashes each run of ``words`` words over a shared gram, and counts those that another document has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialize

#: Words whose hash a worker keeps at a time.
KEEP = 250_000
_MULT, _STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95), np.uint64(0xBF58476D1CE4E5B9)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def gram_of(words: int) -> int:
    """Words of a gram: the power of two that leaves a window of two fifths or more."""
    gram = 1
    while 2 * gram <= 0.65 * words:
        gram *= 2
    return gram


def _double(h: np.ndarray, span: int, mult: np.uint64) -> np.ndarray:
    """Hashes of the runs of 2 * ``span`` words, given those of ``span`` words."""
    h = h[:-span] * mult + h[span:]
    return h ^ (h >> np.uint64(29))


def least(hashes: np.ndarray, words: int) -> np.ndarray:
    """The gram hash that each run of ``words`` words selects, given the hashes of its words; none for under ``words`` words."""
    if len(hashes) < words:
        return hashes[:0]
    gram, span = gram_of(words), 1
    h, mult = hashes, _MULT
    with np.errstate(over="ignore"):
        while span < gram:
            h = _double(h, span, mult)
            mult *= _STEP
            span *= 2
        h = (h ^ (h >> np.uint64(30))) * _MIX
        h = h ^ (h >> np.uint64(27))
    window, span = words - gram + 1, 1
    while 2 * span <= window:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < window:
        h = np.minimum(h[: -(window - span)], h[window - span :])
    return h


def selected(hashes: np.ndarray, words: int) -> np.ndarray:
    """The distinct selected gram hashes of a text."""
    return np.unique(least(hashes, words))


def runs(hashes: np.ndarray, words: int) -> np.ndarray:
    """A hash of each run of ``words`` words, in the order of :func:`least`; put together from runs of powers of two."""
    n = len(hashes) - words + 1
    if n < 1:
        return hashes[:0]
    h, mult, span, at, out = hashes, _MULT, 1, 0, np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        while True:
            if words & span:
                out = (out ^ (out >> np.uint64(30))) * _MIX + h[at : at + n]
                at += span
            if 2 * span > words:
                return out ^ (out >> np.uint64(31))
            h = _double(h, span, mult)
            mult *= _STEP
            span *= 2


def _select(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Words()
        for batch in batches:
            parts, sizes = [], []
            for text in batch.column(1):
                each = text.as_py().encode("utf-8", "surrogatepass").split()
                got = selected(np.fromiter(map(seen.__getitem__, each), np.uint64, len(each)), words) if len(each) >= words else np.zeros(0, np.uint64)
                parts.append(got)
                sizes.append(len(got))
                if len(seen) > KEEP:
                    seen.clear()
            docs = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))], ["doc", "gram"])

    return run


def _run(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Words()
        for batch in batches:
            parts, sizes = [], []
            for text, grams in zip(batch.column(1), batch.column(2), strict=True):
                each = text.as_py().encode("utf-8", "surrogatepass").split()
                hashes = np.fromiter(map(seen.__getitem__, each), np.uint64, len(each))
                wanted = np.isin(least(hashes, words), grams.values.to_numpy().view(np.uint64))
                got = np.unique(runs(hashes, words)[wanted])
                parts.append(got)
                sizes.append(len(got))
                if len(seen) > KEEP:
                    seen.clear()
            docs = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))], ["doc", "run"])

    return run


def _hits(found: DataFrame, key: str) -> DataFrame:
    """The rows (doc, ``key``, n) of the keys that more than one document has."""
    groups = found.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select(key, "n")
    return join_groups(found, materialize(groups, "shared"), key, "n", "inner")


def shared_passages(rows: DataFrame, words: int = 51) -> DataFrame:
    """(doc, n_shared) of the documents that share selected grams with others, and how many.

    ``rows``: doc (a long that names a document) and text, not null. Every document that shares a run of ``words`` words of the
    kind ``[^\\x20\\x09-\\x0D]+`` with another one is there; one that shares no run of ``gram_of(words)`` words is not. Rows with equal
    ``doc`` are one document. A gram that very many documents have is joined by broadcast of that gram alone.
    """
    found = materialize(rows.select("doc", "text").mapInArrow(_select(words), "doc long, gram long"), "grams")
    return _hits(found, "gram").groupBy("doc").agg(F.count_distinct("gram").alias("n_shared"))


def shared_runs(rows: DataFrame, words: int = 51) -> DataFrame:
    """(doc, n_shared_runs) of the documents that share a run of ``words`` words with another one, and how many different runs.

    ``rows`` as in :func:`shared_passages`. Equal runs select equal grams, so none is lost; a run that no other document has is not
    counted, but for 64 bits of hash.
    """
    found = materialize(rows.select("doc", "text").mapInArrow(_select(words), "doc long, gram long"), "grams")
    grams = _hits(found, "gram").groupBy("doc").agg(F.collect_set("gram").alias("grams"))  # no more than the document's own
    found = materialize(rows.select("doc", "text").join(grams, "doc").mapInArrow(_run(words), "doc long, run long"), "runs")
    return _hits(found, "run").groupBy("doc").agg(F.count_distinct("run").alias("n_shared_runs"))
