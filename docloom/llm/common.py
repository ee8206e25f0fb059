"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize, new_path, shared_dir

__all__ = ["HOT_SHARE", "SPACE", "WORD", "join_groups", "load", "materialize", "new_path", "ranked", "shared_dir", "shuffle_partitions", "text_of", "unused"]

#: A key with at least this share of all rows is hot; there are at most its reciprocal many.
HOT_SHARE = 1 / 1000
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, how: str = "left") -> DataFrame:
    """Join rows to one row per key, without one task for a hot key.

    ``groups`` has one row per ``key`` (a column or several) and its number of rows in ``size``. Keys with at least
    ``HOT_SHARE`` of all rows are at most 1/HOT_SHARE many, whatever the input, so they are
    broadcast; every other key has fewer rows than that share and is joined by a shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(1000, int(total * HOT_SHARE))
    hot = groups.where(F.col(size) >= least)
    keys = [key] if isinstance(key, str) else key
    first = list({r[0] for r in hot.select(keys[0]).limit(int(1 / HOT_SHARE) + 1).collect()})
    if not first:
        return rows.join(groups, key, how)
    # rows that may be of a hot key, by its first column; the few others among them find no partner there
    flag = F.coalesce(rows[keys[0]].isin(first), F.lit(False))
    warm = rows.where(flag)
    cold = groups.where(F.col(size) < least)
    rest = rows.where(~flag)
    if len(keys) > 1:  # rows that share the first column only
        rest = rest.unionByName(warm.join(F.broadcast(hot.select(*keys)), keys, "left_anti"))
        warm = warm.join(F.broadcast(hot.select(*keys)), keys, "left_semi")
    return warm.join(F.broadcast(hot), key, how).unionByName(rest.join(cold, key, how))


def ranked(docs: DataFrame) -> list[Column]:
    """no_id, rank and mark of each row: rows sort by doc_id, nulls last, and then by a hash of the text.

    Every long is a doc_id that may occur, so a null has a flag instead of a number of its own.
    """
    doc_id = docs["doc_id"].cast("long")
    return [doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("rank"), F.xxhash64(text_of(docs)).alias("mark")]


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores added until no column has it, whatever its case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
