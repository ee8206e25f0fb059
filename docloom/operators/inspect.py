"""Quality statistics over narrative records."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def verdict_histogram(df: DataFrame, verdict: Column, order: Column) -> DataFrame:
    """Rows of each verdict, most common first, the first seen first among equals, and its share; a null verdict is UNKNOWN; an empty table
    has no verdicts."""
    g = df.groupBy(F.upper(F.coalesce(verdict, F.lit("UNKNOWN"))).alias("verdict")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # over the verdicts, a few rows
    return g.select("verdict", "n", (F.col("n") / F.sum("n").over(everything)).alias("ratio"), "first_seen").orderBy(F.desc("n"), "first_seen")


def summary(df: DataFrame, verdict: Column, page: Column, section: Column) -> DataFrame:
    """One row of totals, zeros for an empty table; a null page or section counts as one value."""
    distinct = lambda c: F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
    g = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.upper(F.coalesce(verdict, F.lit("UNKNOWN"))) == "PASS").alias("passed"), distinct(page).alias("pages"), distinct(section).alias("sections"))
    return g.select("total", "passed", (F.col("total") - F.col("passed")).alias("failed"), F.coalesce(F.try_divide("passed", "total"), F.lit(0.0)).alias("pass_ratio"), "pages", "sections")


def sentence_violations(df: DataFrame, text: str, least: int = 2, most: int = 3) -> DataFrame:
    """Rows whose number of sentences is out of range, with that number; a null text has none."""
    return df.withColumn("sentence_count", T.n_sentences(F.coalesce(text, F.lit('')))).where(~F.col("sentence_count").between(least, most))


def filtered(df: DataFrame, page: str | None = None, section: str | None = None) -> DataFrame:
    """Records whose page and section hold the given words, whatever their case; null is empty."""
    for name, word in (("page", page), ("section", section)):
        if word is not None:
            df = df.where(F.contains(F.lower(F.coalesce(name, F.lit(""))), F.lit(word.lower())))
    return df


def token_counter(path: str):
    """A function of a text column that counts its tokens with a tokenizer file; the library comes from the worker."""

    @F.pandas_udf("long")
    def count(text: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer

        t = _tokenizers.get(path) or _tokenizers.setdefault(path, Tokenizer.from_file(path))
        return pd.Series([len(x.ids) for x in t.encode_batch_fast(text.fillna("").tolist(), add_special_tokens=False)])

    return count


_tokenizers: dict = {}


def token_statistics(df: DataFrame, n: Column) -> DataFrame:
    """total, mean (0 for no rows), longest and number of entries, from a column of counts."""
    c = df.select(n.cast("long").alias("n"))
    return c.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean"), F.max("n").alias("longest"), F.count(F.lit(1)).alias("entries"))


def merge_statistics(df: DataFrame, narrative: Column, blocks: Column) -> DataFrame:
    """records, code_blocks (those with a reference and a code) and matched; the matched references are a list of each row,
    ``refs`` of :func:`text.merge_code`."""
    truthy = F.filter(blocks, lambda b: (F.coalesce(b["reference"], F.lit("")) != "") & (F.coalesce(b["code"], F.lit("")) != ""))
    m = df.select(F.coalesce(F.size(truthy), F.lit(0)).alias("b"), T.merge_code(narrative, blocks)["matched"].alias("m"))
    return m.agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.sum("b"), F.lit(0)).alias("code_blocks"), F.coalesce(F.sum("m"), F.lit(0)).alias("matched"))


def shown(with_code: bool = False) -> Column:
    """A record as the inspector prints it."""
    rule, strip = "=" * 72, lambda name: T.strip(F.coalesce(name, F.lit("")))
    critic = F.concat(F.lit("Critic: "), F.nullif(strip("critic"), F.lit("")))
    parts = [F.lit(rule), F.concat(F.coalesce("page", F.lit("<unknown page>")), F.lit(" :: "), F.coalesce("section", F.lit("<unknown section>"))), F.concat(F.lit("Verdict: "), F.coalesce("verdict", F.lit("UNKNOWN")), F.lit(" | Misalignment: "), F.coalesce("misalignment", F.lit("none"))), critic, F.concat(F.lit("\nNarrative:\n "), strip("narrative"))]
    if with_code:
        full = F.filter(F.transform("code_blocks", lambda b, i: F.struct(i.alias("i"), b["reference"].alias("r"), T.strip(b["code"]).alias("c"))), lambda x: x["c"] != "")
        parts.append(F.nullif(F.array_join(F.transform(full, lambda x: F.concat(F.lit("\nCode "), (x["i"] + 1).cast("string"), F.coalesce(F.concat(F.lit(" ["), F.nullif(x["r"], F.lit("")), F.lit("]")), F.lit("")), F.lit(":\n```\n"), x["c"], F.lit("\n```"))), "\n"), F.lit("")))
    return F.concat(F.concat_ws("\n", *parts), F.lit("\n"))


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in the order of a hash of seed and key: the same ones each time, on any cluster; null keys come first."""
    return df.orderBy(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
