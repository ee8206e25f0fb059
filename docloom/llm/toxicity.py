"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is its character n-grams with marks at both ends, and itself; each hashes to a row of the
embedding table. A document is the mean over its words of the mean of their rows, and a linear softmax over
that mean gives the score. Embeddings and softmax are trained together, so a misspelling that no label
covers still has the vectors of the n-grams that it shares with words that one does.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, text_of

#: A bucket is held in two bytes.
BUCKETS, DIM, GRAMS = 1 << 16, 8, (3, 4, 5)
#: Labelled rows of either class that the model is fitted on at most, chosen by a hash of doc_id, and the characters that
#: either class has at most: beyond them fewer rows are taken, and each with its whole text.
SAMPLE, SAMPLE_CHARS = 4000, 40_000_000
#: Passes over the sample: as many as make ``SEEN`` rows in all, within bounds, so that few labels are seen more often.
EPOCHS, SEEN, BATCH, RATE = (12, 100), 96_000, 64, 1.0
THRESHOLD = 0.3
#: Words whose score, and whose buckets in training, are kept at a time.
KEEP, BAG_KEEP = 250_000, 200_000
#: A word keeps digits and signs that stand for letters inside it, so that "id1ot" and "f*ol" are one word.
_WORD = re.compile(r"[^\W_](?:[\w*@$!'\u2019]*[^\W_])?")


def buckets_of(word: str) -> list[int]:
    """Rows of the embedding table for a word: itself and its n-grams."""
    raw = f"<{word}>"
    return [zlib.crc32(raw.encode("utf-8", "surrogatepass")) % BUCKETS] + [
        zlib.crc32(raw[i : i + n].encode("utf-8", "surrogatepass")) % BUCKETS for n in GRAMS for i in range(len(raw) - n + 1) if n < len(raw)
    ]


def _bag(text: str, seen: dict[str, array]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights, which sum to one."""
    rows, sizes, counts = array("H"), array("l"), array("l")
    for w, n in Counter(_WORD.findall(text.lower())).items():
        b = seen.get(w)
        if b is None:
            if len(seen) >= BAG_KEEP:
                seen.clear()
            b = seen[w] = array("H", buckets_of(w))
        rows.extend(b)
        sizes.append(len(b))
        counts.append(n)
    if not rows:
        return np.zeros(0, np.uint16), np.zeros(0, np.float32)
    size = np.frombuffer(sizes, np.int64)
    total = np.bincount(np.frombuffer(rows, np.uint16), np.repeat(np.frombuffer(counts, np.int64) / size, size))
    at = np.flatnonzero(total)
    return at.astype(np.uint16), (total[at] / total[at].sum()).astype(np.float32)


def train(texts: Iterable[str], labels: list[int], prior: float, seed: int = 7) -> tuple[np.ndarray, float]:
    """One score for each bucket, and the bias, from whole texts; see :func:`train_bags`."""
    seen: dict[str, list[int]] = {}
    return train_bags([_bag(t, seen) for t in texts], labels, prior, seed)


def train_bags(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], prior: float, seed: int = 7) -> tuple[np.ndarray, float]:
    """One score for each bucket, and the bias: the trained embeddings times the trained softmax, as far as
    two classes need it. ``prior``: share of label 1 among all labelled rows, which the sample need not have.
    """
    y = np.array(labels)
    if len(set(labels)) < 2:
        return np.zeros(BUCKETS), float(np.log(min(max(prior, 1e-6), 1 - 1e-6)) - np.log1p(-min(max(prior, 1e-6), 1 - 1e-6)))
    rng = np.random.default_rng(seed)
    table, soft, bias = rng.normal(0, 0.3, (BUCKETS, DIM)), rng.normal(0, 0.3, (2, DIM)), np.zeros(2)
    acc_t, acc_s, acc_b = np.full(BUCKETS, 1e-8), np.full((2, DIM), 1e-8), np.full(2, 1e-8)
    share = np.bincount(y, minlength=2) / len(y)
    scale = 0.5 / share  # both classes weigh alike in training; the bias is set right afterwards
    full = [i for i in range(len(y)) if len(bags[i][0])]
    epochs = min(max(SEEN // max(len(full), 1), EPOCHS[0]), EPOCHS[1])
    batch = min(BATCH, max(16, len(full) // 32))
    for epoch in range(epochs):
        rate, order = RATE * (1 - epoch / epochs), rng.permutation(full)
        for k in range(0, len(order), batch):
            some = order[k : k + batch]
            rows = np.concatenate([bags[i][0] for i in some]).astype(np.int64)
            weight = np.concatenate([bags[i][1] for i in some])
            sizes = np.array([len(bags[i][0]) for i in some])
            mean = np.add.reduceat(table[rows] * weight[:, None], np.cumsum(sizes) - sizes)
            z = mean @ soft.T + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - np.eye(2)[y[some]]) * scale[y[some]][:, None] / len(some)
            g_soft, g_bias, g_mean = g.T @ mean, g.sum(axis=0), g @ soft
            spread = np.repeat(g_mean, sizes, axis=0) * weight[:, None]
            # over the whole table: rows that are not touched have a gradient of zero, and no sort is needed
            g_table = np.stack([np.bincount(rows, spread[:, d], BUCKETS) for d in range(DIM)], axis=1)
            acc_t += (g_table**2).mean(axis=1)
            table -= (rate / np.sqrt(acc_t))[:, None] * g_table
            acc_s += g_soft**2
            acc_b += g_bias**2
            soft -= rate * g_soft / np.sqrt(acc_s)
            bias -= rate * g_bias / np.sqrt(acc_b)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    return table @ (soft[1] - soft[0]), float(bias[1] - bias[0] + np.log(prior / (1 - prior)))


def _fit(prior: float, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, labels, used, seen = [], [], [0, 0], {}
        for batch in batches:  # in the order of the hash; a text is gone as soon as its bag is there
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                used[toxic] += len(text)
                if used[toxic] <= most or toxic not in labels:
                    bags.append(_bag(text, seen))
                    labels.append(toxic)
        if not bags:
            return  # labels, but none of their documents
        seen.clear()
        scores, bias = train_bags(bags, labels, prior)
        yield pa.RecordBatch.from_pydict({"weights": pa.array([np.r_[scores, bias].astype("<f8").tobytes()], pa.binary())})

    return run


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Scores of all buckets and, last, the bias: half a megabyte, whatever the input.

    ``labels``: doc_id, toxic (0 or 1; rows with a null in either are left out). At most ``SAMPLE`` rows of
    either class are used, whole texts of them, and fewer where these have over ``SAMPLE_CHARS`` characters; equal pairs of labels
    count once, and a document with both labels is an example of both. Without any labelled row the score is one half throughout.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").distinct()
    n = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if not n:
        return np.zeros(BUCKETS + 1)
    parts = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for c in (0, 1)]
    chosen = parts[0].unionByName(parts[1])  # at most 2 * SAMPLE pairs of numbers
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = text.join(F.broadcast(chosen), "doc_id").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "toxic", F.xxhash64("text"))
    got = rows.select("toxic", "text").mapInArrow(_fit(n.get(1, 0) / sum(n.values()), SAMPLE_CHARS), "weights binary").collect()
    return np.frombuffer(got[0][0], "<f8") if got else np.zeros(BUCKETS + 1)


class _Scores(dict):
    """Score of a word: the mean over its buckets."""

    def __init__(self, table: list[float]):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> float:
        b, t = buckets_of(word), self.table
        self[word] = s = sum([t[i] for i in b]) / len(b)
        return s


def _score(weights, at: int | None):
    """``at``: the field of the row that holds the text; None where it comes as a column of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        bias, seen = float(table[-1]), _Scores(table.tolist())
        for batch in batches:
            out = []
            for text in batch.column(1) if at is None else batch.column(0).field(at):
                words = _WORD.findall((text.as_py() or "").lower())
                z = bias + (sum(map(seen.__getitem__, words)) / len(words) if words else 0.0)
                out.append(1.0 / (1.0 + np.exp(-z)) if z > -700 else 0.0)
                if len(seen) > KEEP:
                    seen.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["row", "score"])

    return run


def held_out(doc_id) -> "F.Column":
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def score_toxicity(docs: DataFrame, weights: np.ndarray, keep: list[str] | None = None, column: str = "score") -> DataFrame:
    """The columns ``keep`` (all by default) and the score of every row, from its text alone, as ``column``.

    A null or empty text, or one without a letter, has the score of the bias. Repeated rows have equal scores. An
    empty table gives an empty result.
    """
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    at = keep.index("text") if "text" in keep and keep.count("text") == 1 and docs.schema["text"].dataType.simpleString() == "string" else None
    rows = docs.select(row) if at is not None else docs.select(row, text_of(docs).alias("text"))  # a text travels once
    schema = rows.select("row", F.lit(0.0).alias("score")).schema
    for field in schema:
        field.nullable = True
    return rows.mapInArrow(_score(shared, at), schema).select("row.*", F.col("score").alias(column))


def model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> np.ndarray:
    labels = load(spark, sf_dir, "labels")
    return fit(docs, labels.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score_toxicity(docs.select("doc_id", "text"), model(spark, docs, sf_dir), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
