"""Quality rules: fixed limits first, then robust multivariate outliers per language and source.

A document's statistics are transformed to near-symmetric features. For every language and source the
minimum-covariance-determinant estimate is found by concentration steps over all of its rows: from a
few starts, take the share of rows that lie nearest by Mahalanobis distance, estimate mean and covariance
from them, and repeat; of the starts, the least determinant counts. Each step is one aggregation of sums; the distance that bounds the share comes
from a histogram with a fixed number of bins, so a group that holds most rows costs no more than others.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import load, materialize, text_of

FEATURES = ("f_length", "f_word", "f_symbol", "f_lines", "f_repeat")
#: Share of the rows that the estimate rests on, steps, and sound rows a group must have for an estimate of its own.
SHARE, STEPS, LEAST = 0.75, 6, 30
#: Stands for all languages or all sources in the key of a pooled estimate.
POOL = "\0\0"
#: Share of a normal group that is rejected at most.
TAIL = 1e-7
#: Smallest standard deviation of a feature, in its own unit, that an estimate may have.
#: With it each feature can reject by itself: over 23 repeated lines, or 24 % of the words, where the group has none.
FLOOR = (0.5, 0.1, 0.5, 0.5, 0.5)


def chi_square_below(x: float, k: int) -> float:
    """Share of chi-square with ``k`` degrees of freedom up to ``x``: the series of the incomplete gamma function."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-17:
        n += 1
        term *= x / (a + n)
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a)) if x > 0 else 0.0


def chi_square_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    while hi - lo > 1e-9 * hi:
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_below(mid, k) < p else (lo, mid)
    return hi


#: Squared distances beyond this are outliers.
CUTOFF = chi_square_quantile(1 - TAIL, len(FEATURES))
#: The share cut off makes a covariance too small; times this it is that of all rows, where they are normal.
SCALE = SHARE / chi_square_below(chi_square_quantile(SHARE, len(FEATURES)), len(FEATURES) + 2)
_WORDS, _SYMBOLS = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[#*$%&|<>]")


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = _WORDS.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if _WORDS.search(x)]
    repeat = 0
    if n > 3:
        triples = list(zip(words, words[1:], words[2:], strict=False))
        found = Counter(triples)
        if len(found) < len(triples):
            upto = 0  # words before this are counted
            for i, t in enumerate(triples):
                if found[t] > 1:
                    repeat += i + 3 - max(upto, i)
                    upto = i + 3
    return n, sum(map(len, words)), len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeat


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for batch in batches:
        got = np.array([statistics(t) for t in batch.column(0).to_pylist()], np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(1, batch.num_columns)), *(pa.array(np.ascontiguousarray(got[:, k])) for k in range(5))], [*batch.schema.names[1:], *names])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the five statistics and base_failed."""
    rows = docs.select(text_of(docs).alias("_text"), F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    rows = rows.mapInArrow(_stats, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def feature_columns() -> dict[str, Column]:
    """The features, from the columns of the statistics."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "f_length": F.log1p(F.col("n_words").cast("double")),
        "f_word": F.log1p(F.col("word_chars") / n),
        "f_symbol": F.log1p(100.0 * F.col("n_symbols") / n),
        "f_lines": F.log1p(F.col("n_dup_lines").cast("double")),
        "f_repeat": F.log1p(100.0 * F.col("n_repeat_words") / n),
    }


def _features(stats: DataFrame) -> DataFrame:
    """The statistics with the features and the group's key, in which a null is a value."""
    return stats.withColumns(feature_columns() | {"lang": F.coalesce("lang", F.lit("\0")), "source": F.coalesce("source", F.lit("\0"))})


def _moments(rows: DataFrame) -> DataFrame:
    """Count, mean and covariance sums of the features for each language, source and start."""
    sums = [F.sum(a).alias(f"s_{i}") for i, a in enumerate(FEATURES)] + [F.sum(F.col(a) * F.col(b)).alias(f"s_{i}_{j}") for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if j <= i]
    return rows.groupBy("lang", "source", "start").agg(F.count(F.lit(1)).alias("n"), *sums)


def _invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Mean and inverse covariance of each group from its sums, with the floor on the deviations."""
    for pdf in batches:
        out = []
        for r in pdf.to_dict("records"):
            k, n = len(FEATURES), max(r["n"], 1)
            mean = np.array([r[f"s_{i}"] / n for i in range(k)])
            cov = np.array([[r[f"s_{max(i, j)}_{min(i, j)}"] / n - mean[i] * mean[j] for j in range(k)] for i in range(k)])
            cov = cov * SCALE
            np.fill_diagonal(cov, np.maximum(np.diag(cov), np.square(FLOOR)))
            values, vectors = np.linalg.eigh(cov)
            values = np.maximum(values, min(FLOOR) ** 2 / 10)  # features that move together, and rounding
            out.append({"lang": r["lang"], "source": r["source"], "start": r["start"], "mean": mean.tolist(), "inv": ((vectors / values) @ vectors.T).ravel().tolist(), "logdet": float(np.log(values).sum())})
        yield pd.DataFrame(out, columns=["lang", "source", "start", "mean", "inv", "logdet"])


def _middles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Two starts of each group from the quartiles: scales of the quartiles' distance, and of the floor."""
    for pdf in batches:
        out = []
        for r in pdf.to_dict("records"):
            q = np.array([r[f"q_{i}"] for i in range(len(FEATURES))])
            for start, scale in ((1, np.maximum((q[:, 2] - q[:, 0]) / 1.349, FLOOR)), (2, np.array(FLOOR))):
                out.append({"lang": r["lang"], "source": r["source"], "start": start, "mean": q[:, 1].tolist(), "inv": np.diag(scale**-2.0).ravel().tolist(), "logdet": float(2 * np.log(scale).sum())})
        yield pd.DataFrame(out, columns=["lang", "source", "start", "mean", "inv", "logdet"])


def _distance(at: str, inv: str) -> Column:
    k = len(FEATURES)
    d = [F.col(f) - F.col(at)[i] for i, f in enumerate(FEATURES)]
    total = None
    for i in range(k):
        for j in range(i + 1):
            term = d[i] * d[j] * F.col(inv)[i * k + j] * (1 if i == j else 2)
            total = term if total is None else total + term
    return F.greatest(total, F.lit(0.0))


def robust_estimates(features: DataFrame) -> DataFrame:
    """lang, source, mean, inv: the estimate for each language and source.

    Groups with fewer than ``LEAST`` sound rows take that of all sound rows of their language, and where these are too few
    as well, that of all sound rows. The starts are the mean and covariance of all rows that pass the fixed rules, and the medians
    with two scales.
    """
    sound = features.where(~F.col("base_failed"))
    groups = materialize(features.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n")), "groups")
    n_lang = groups.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    own, pooled = F.col("n") >= LEAST, F.col("n_lang") >= LEAST
    key = groups.join(n_lang, "lang").select("lang", "source", F.when(own | pooled, F.col("lang")).otherwise(POOL).alias("at_lang"), F.when(own, F.col("source")).otherwise(POOL).alias("at_source"))
    key = materialize(key, "keys")
    pools = key.where(F.col("at_source") == POOL).select("at_lang").distinct()
    by_lang = sound.join(pools.withColumnRenamed("at_lang", "lang"), "lang", "left_semi").withColumn("source", F.lit(POOL))
    over_all = sound.withColumns({"lang": F.lit(POOL), "source": F.lit(POOL)})
    sound = sound.join(key.where(F.col("at_source") != POOL).select("lang", "source"), ["lang", "source"], "left_semi").unionByName(by_lang)
    if pools.where(F.col("at_lang") == POOL).head(1):
        sound = sound.unionByName(over_all)
    sound = materialize(sound.select("lang", "source", *FEATURES), "sound")  # read some dozen times below
    size = materialize(sound.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_all")), "sizes")
    schema = "lang string, source string, start int, mean array<double>, inv array<double>, logdet double"
    middles = sound.groupBy("lang", "source").agg(*(F.percentile_approx(a, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q_{i}") for i, a in enumerate(FEATURES)))
    first = _moments(sound.withColumn("start", F.lit(0))).mapInPandas(_invert, schema).unionByName(middles.mapInPandas(_middles, schema))
    est = materialize(first.join(size, ["lang", "source"]), "estimates")
    bin_ = F.floor(F.log1p("d2") * 512).cast("int")  # a bin is 0.2 % wide
    for _ in range(STEPS):
        # the table of groups is small beside the rows: the engine broadcasts it or not by its size
        near = sound.join(est, ["lang", "source"]).withColumn("d2", _distance("mean", "inv")).withColumn("bin", bin_)
        counts = near.groupBy("lang", "source", "start", "bin").agg(F.count(F.lit(1)).alias("c"), F.first("n_all").alias("n_all"))
        w = W.partitionBy("lang", "source", "start").orderBy("bin")
        limit = counts.withColumn("before", F.sum("c").over(w) - F.col("c")).where(F.col("before") < SHARE * F.col("n_all")).groupBy("lang", "source", "start").agg(F.max("bin").alias("last"))
        inner = near.join(limit, ["lang", "source", "start"]).where("bin <= last")
        est = materialize(_moments(inner).mapInPandas(_invert, schema).join(size, ["lang", "source"]), "estimates")
    best = F.min_by(F.struct("mean", "inv"), F.struct("logdet", "start"))
    est = est.groupBy("lang", "source").agg(best.alias("best")).select("lang", "source", "best.mean", "best.inv")
    est = est.select(F.col("lang").alias("at_lang"), F.col("source").alias("at_source"), "mean", "inv")
    return key.join(est, ["at_lang", "at_source"]).select("lang", "source", "mean", "inv")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Statistics and verdict of every row.

    A null or empty text has no words and fails the fixed rules. Nulls in lang or source are a group of their
    own. Groups with fewer than ``LEAST`` sound rows are judged by a pooled estimate. Repeated
    rows are judged alike; an empty table gives an empty result.
    """
    stats = materialize(document_statistics(docs), "statistics")
    features = _features(stats)
    out = features.join(robust_estimates(features), ["lang", "source"], "left").withColumn("distance2", F.when(F.col("mean").isNotNull(), _distance("mean", "inv")))
    kept = ~F.col("base_failed") & (F.col("distance2").isNull() | (F.col("distance2") <= CUTOFF))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance2")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(load(spark, sf_dir, "documents"))
