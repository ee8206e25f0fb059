"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source fall into at most ``BLOCKS`` blocks by a hash of doc_id; a permutation of the blocks
gives the order in which they are drawn, over and over. A source's quota is the exact number of block
draws that its target needs; the last block is drawn in part, by whole documents, and where a document is much beside the target, a
few more of fitting sizes close the gap.
The quotas are then parted among output shards: a node of a binary tree splits its vector of quotas
by a multivariate hypergeometric draw whose generator is seeded by the node, so each shard walks down to its
own share alone, and the shards' ranges of draws are disjoint and complete. Within a shard documents are
put in a random order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, load, materialize, text_of

#: Blocks of a source: the tables of blocks have at most so many rows a source.
BLOCKS = 256
#: Sources whose table is broadcast; beyond it the joins with it are left to the engine.
FEW_SOURCES = 20_000
#: Output shards at least, and words of a shard where that makes more.
SHARDS, SHARD_WORDS = 64, 50_000_000
#: A gap of more than this share of the target is closed by further documents, at most so many.
NEAR, PICKS = 0.0005, 12
WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, sid, n_docs, source_size, target) of (source, size) rows.

    Sources by code point, null last, have the weights in turn; together the targets are ``share`` of
    all words; none exceeds ``most`` times its source's words, and the excess goes to the others by weight.
    Filling by the ratio of cap to weight does that in one pass over the sources.
    """
    s = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("sid", F.lit(len(weights))).cast("int") + 1))
    s = s.withColumn("cap", most * F.col("source_size")).withColumn("total", share * F.sum("source_size").over(everything))
    before = W.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("taken", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", (F.col("total") - F.col("capped")) / (F.sum("weight").over(everything) - F.col("taken")))
    level = F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("sid"), F.col("level")))).over(everything)
    s = s.withColumn("fill", level["level"])
    return s.select("source", "sid", "n_docs", "source_size", F.when(F.col("fill").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("fill") * F.col("weight"))).alias("target"))


def split_path(quotas: np.ndarray, shard: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first draw, number of draws) of each source in one shard, by walking down the splitting tree."""
    first, lo, hi = np.zeros_like(quotas), 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        n = int(quotas.sum())
        left = n * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        part = rng.multivariate_hypergeometric(quotas, left, method="marginals") if n else quotas
        if shard < mid:
            quotas, hi = part, mid
        else:
            first, quotas, lo = first + part, quotas - part, mid
    return first, quotas


def _shares(quotas: np.ndarray, shards: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"]:
                first, n = split_path(quotas, int(shard), shards, seed)
                sid = np.repeat(np.arange(len(n)), n)
                draw = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[sid]
                yield pd.DataFrame({"sid": sid.astype(np.int32), "draw": draw, "shard": np.int32(shard)})

    return run


def _largest(sizes: np.ndarray, gap: float, most: int) -> tuple[list[int], float]:
    """Places of at most ``most`` ascending sizes, the largest that fits into what is left each time, and what is left."""
    used: list[int] = []
    while len(used) < most and gap > 0:
        k = int(np.searchsorted(sizes, gap, side="right")) - 1
        while k >= 0 and k in used:
            k -= 1
        if k < 0:
            break
        used.append(k)
        gap -= sizes[k]
    return used, gap


def _close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents that close a source's gap: the largest that fit, or one more and without some that are taken."""
    held = [pdf for pdf in batches if len(pdf)]
    for sid, rows in pd.concat(held).groupby("sid") if held else ():
        rows = rows.sort_values(["size", "h"])
        free, taken = rows[~rows["taken"]], rows[rows["taken"]]
        sizes, size_t = free["size"].to_numpy(), taken["size"].to_numpy()
        used, gap = _largest(sizes, float(rows["gap"].iloc[0]), PICKS)
        over = [k for k in range(int(np.searchsorted(sizes, gap, side="right")), len(sizes)) if k not in used][:1]
        drop: list[int] = []
        if over:
            without, excess = _largest(size_t, float(sizes[over[0]]) - gap, PICKS)
            if excess < gap:
                used, drop = used + over, without
        picked = np.r_[free["h"].to_numpy()[used], taken["h"].to_numpy()[drop]].astype(np.int64)
        yield pd.DataFrame({"sid": np.full(len(picked), sid, np.int32), "pick": picked, "off": np.arange(len(picked)) >= len(used)})


def _partial_blocks(sizes: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sid, block, cut) of the block that each target ends in, and (sid, pick, off) of the documents that close the gap, ``off`` where one goes.

    ``sizes``: sid, block, size, h, target. Of the block that the rest of a target ends in the documents up to the hash ``cut`` are taken: as many
    as fit. The cut is found by the leading bits of the hash first, so no task sorts a block of a large source whole.
    """
    edge = cells.where("words > 0 and ahead < rest and ahead + words > rest").select("sid", "block", (F.col("rest") - F.col("ahead")).alias("missing"), "target")
    inside = sizes.join(edge.drop("target"), ["sid", "block"]).groupBy("sid", "block", "h", "missing").agg(F.sum("size").alias("size")).withColumn("top", F.shiftright("h", 52))
    inside = materialize(inside, "edge-blocks")
    upto = lambda by: F.sum("size").over(W.partitionBy("sid").orderBy(by).rowsBetween(W.unboundedPreceding, 0))
    tops = inside.groupBy("sid", "block", "top", "missing").agg(F.sum("size").alias("size")).withColumn("sum", upto("top"))
    tops = tops.where(F.col("sum") > F.col("missing")).groupBy("sid").agg(F.min(F.struct("top", (F.col("missing") - F.col("sum") + F.col("size")).alias("left"))).alias("t")).select("sid", "t.*")
    last = inside.join(tops, ["sid", "top"]).withColumn("sum", upto("h"))
    fits = F.col("sum") <= F.col("left")
    cut = last.groupBy("sid", "block").agg(F.coalesce(F.max(F.when(fits, F.col("h"))), F.shiftleft(F.max("top"), 52) - 1).alias("cut"), (F.max("left") - F.coalesce(F.max(F.when(fits, F.col("sum"))), F.lit(0))).alias("gap"))
    cut = materialize(cut, "cuts")
    # sources whose gap matters beside the target: small ones, so that one task has all sizes of one
    open_ = cut.join(edge.select("sid", "target"), "sid").where(F.col("gap") > NEAR * F.col("target")).select("sid", "gap", F.col("block").alias("e_block"), "cut")
    whole = cells.select("sid", "block", ((F.col("ahead") + F.col("words") <= F.col("rest")) & (F.col("rest") > 0)).alias("whole"))
    mine = sizes.join(open_, "sid").where("size > 0").join(whole, ["sid", "block"]).withColumn("taken", F.col("whole") | ((F.col("block") == F.col("e_block")) & (F.col("h") <= F.col("cut"))))
    mine = mine.groupBy("sid", "h", "gap", "taken").agg(F.sum("size").alias("size")).groupBy("sid", "gap", "taken", "size").agg(F.min("h").alias("h"))
    picks = mine.repartition("sid").mapInPandas(_close, "sid int, pick long, off boolean")
    return cut.select("sid", "block", "cut"), materialize(picks, "picks")


def mix_plan(docs: DataFrame, seed: int = 42, weights: tuple[int, ...] = WEIGHTS, shard_words: int = SHARD_WORDS, size: str | None = None, shards: int = SHARDS) -> DataFrame:
    """``_row`` (all columns of ``docs``, whatever their names), ``_size, _source_size, _target, _times, _shards``; ``size``: a column with the words, if counted.

    ``_times``: how often the mix takes the document, 0, 1 or 2; ``_shards``: where, one entry for each time.
    A null text has no words and follows its block; a null source is a source of its own; repeated rows
    are taken alike; an empty table stays empty. The plan depends on the rows and the seed only. The driver holds 16 bytes a source.
    """
    spark = docs.sparkSession
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("source").cast("string").alias("source"), (F.col(size) if size else n_words(text_of(docs))).alias("_size"), key.alias("_h"))
    counted = materialize(marked.select("source", F.col("_size").alias("size"), F.col("_h").alias("h")), "sizes")
    sources = materialize(source_targets(counted, weights), "sources")
    count = sources.count()
    by = sources.withColumnRenamed("source", "s_source")
    by = F.broadcast(by) if count <= FEW_SOURCES else by
    block = F.pmod("h", F.least("n_docs", F.lit(BLOCKS))).cast("int")
    sizes = counted.join(by, F.col("s_source").eqNullSafe(F.col("source"))).select("sid", block.alias("block"), "size", "h", "target", "source_size")
    cells = sizes.groupBy("sid", "block").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    order = W.partitionBy("sid").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "sid", "block"), "block")  # at most BLOCKS rows each
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    cells = (
        cells.withColumn("pos", F.row_number().over(order) - 1).withColumn("ahead", F.sum("words").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("words"))
        .withColumn("full", full).withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
    )
    cells = materialize(cells, "cells")
    cut, picks = _partial_blocks(sizes.drop("source_size"), cells)
    # the block of a picked document follows from its hash
    picks = picks.join(sources.select("sid", "n_docs"), "sid").groupBy("sid", F.pmod("pick", F.least("n_docs", F.lit(BLOCKS))).cast("int").alias("block")).agg(F.collect_set(F.when(~F.col("off"), F.col("pick"))).alias("picks"), F.collect_set(F.when(F.col("off"), F.col("pick"))).alias("drops"))
    blocks = (
        cells.join(cut, ["sid", "block"], "left").join(picks, ["sid", "block"], "left").withColumn("whole", (F.col("ahead") + F.col("words") <= F.col("rest")) & (F.col("rest") > 0))
        .withColumn("draws", F.col("full") + (F.col("whole") | F.col("cut").isNotNull() | F.coalesce(F.size("picks") > 0, F.lit(False))).cast("int"))
        .select("sid", "block", "pos", "full", "whole", "cut", "picks", "drops", "draws")
    )
    blocks = materialize(blocks, "blocks")
    quota = {r[0]: r[1] for r in blocks.groupBy("sid").agg(F.sum("draws")).collect()}  # two numbers a source
    quotas = np.array([quota.get(i, 0) for i in range(count)], np.int64)
    words = (sources.agg(F.sum("target")).first()[0] or 0.0) if count else 0.0
    n_shards = max(1, min(int(quotas.sum()), max(shards, int(np.ceil(words / shard_words)))))
    shares = spark.range(n_shards, numPartitions=min(n_shards, 1000) if n_shards > SHARDS else 4).mapInPandas(_shares(quotas, n_shards, seed), "sid int, draw long, shard int")
    # draw d of a source is its block at place d of the permuted order, then the order again
    sized = blocks.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("sid")))
    drawn = sized.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(2)))).where("k <= draws").withColumn("draw", (F.col("pos") + (F.col("k") - 1) * F.col("n")).cast("long"))
    # draws are numbered without gaps in (k, pos) order
    numbered = drawn.withColumn("draw", (F.row_number().over(W.partitionBy("sid").orderBy("draw")) - 1).cast("long"))
    where = numbered.join(shares, ["sid", "draw"], "left").groupBy("sid", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "shard"))), lambda x: x["shard"]).alias("shards"))
    plan = materialize(blocks.join(where, ["sid", "block"], "left").select(F.col("sid").alias("b_sid"), F.col("block").alias("b_block"), "full", "whole", "cut", "picks", "drops", "shards"), "plan")
    out = marked.join(by.withColumnsRenamed({"sid": "_sid", "source_size": "_source_size", "target": "_target"}), F.col("s_source").eqNullSafe(marked["source"]))
    out = out.withColumn("_block", F.pmod("_h", F.least("n_docs", F.lit(BLOCKS))).cast("int"))
    # a hot source is BLOCKS keys here
    out = out.join(plan, (F.col("_sid") == F.col("b_sid")) & (F.col("_block") == F.col("b_block")))
    part = F.coalesce(F.col("_h") <= F.col("cut"), F.lit(False)) | F.coalesce(F.array_contains("picks", F.col("_h")), F.lit(False))
    once = (F.col("whole") | part) & ~F.coalesce(F.array_contains("drops", F.col("_h")), F.lit(False))
    out = out.withColumn("_times", F.col("full") + once.cast("int")).withColumn("_shards", F.slice(F.coalesce("shards", F.array().cast("array<int>")), 1, F.col("_times")))
    return out.select("_row", "_size", "_source_size", "_target", "_times", "_shards", "_h")


def mixed(docs: DataFrame, seed: int = 42, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, shard by shard, in random order within a shard."""
    plan = mix_plan(docs, seed, **options)
    rows = plan.select("_row", F.posexplode("_shards").alias("_copy", "_shard"), F.xxhash64(F.lit(seed + 1), "_h", "_copy").alias("_order"))
    return rows.repartition("_shard", F.pmod("_order", F.lit(64))).sortWithinPartitions("_shard", "_order").select("_row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    docs = materialize(docs.select("doc_id", "source", n_words(text_of(docs)).alias("size")), "sizes")
    plan = mix_plan(docs, size="size")
    return plan.select(F.col("_row.doc_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_times") * F.col("_size")).cast("long").alias("taken"), F.col("_times").alias("times"), F.col("_shards").alias("shards"))
