"""Outlines, pages and sections: ordered line tables and windows over them."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import text as T
from ..storage import materialize


def line_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line): one row a line, its number from 0."""
    return docs.select(key, F.posexplode(T.lines(F.col(text))).alias("line_no", "line"))


def running(key: str) -> W:
    return W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)


def outline(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ord, level, number, title, parent_ord): the list items of an outline, in order, at any depth.

    The parent is the nearest earlier item of a smaller level. Levels are spaces by two. An outline is one text of one row, so its items are an
    array and nothing is shuffled. A null or empty text has no items; rows that share a key give the items of each.
    """
    found = F.filter(T.lines(F.col(text)), lambda x: x.rlike(r"^\s*-\s+"))
    number = r"^(\d+(?:\.\d+)*)\s+(.*)$"
    level = lambda x: F.floor((F.length(x) - F.length(F.ltrim(x))) / 2).cast("int")
    items = F.transform(found, lambda x, i: F.struct(i.alias("ord"), level(x).alias("level"), F.regexp_extract(T.strip(x), r"^-\s+(.*)$", 1).alias("item")))
    parent = lambda all_: F.transform(all_, lambda c: F.struct(c["ord"].alias("ord"), c["level"].alias("level"), c["item"].alias("item"), F.array_max(F.transform(F.filter(all_, lambda p: (p["ord"] < c["ord"]) & (p["level"] < c["level"])), lambda p: p["ord"])).alias("parent_ord")))
    each = docs.select(F.col(f"`{key}`").alias("_k"), F.inline(T.once(items, parent)))
    title = F.when(F.col("item").rlike(number), F.regexp_extract("item", number, 2)).otherwise(F.col("item"))
    return each.select(F.col("_k").alias(key), "ord", "level", F.nullif(F.regexp_extract("item", number, 1), F.lit("")).alias("number"), T.strip(title).alias("title"), "parent_ord")


def sections(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, page_ord, page_title, page_key, section_ord, section_key, heading, text) of wiki markdown.

    A line ``# Page:`` starts a page and a heading of level 2 a section; the first section of each page is its
    introduction. Sections of one page with equal keys are one, at the place and with the heading of the first. A page whose key comes
    again has the content of the last one and the place of the first, ``page_ord`` from 0. A text without a page, null or empty gives no
    rows; rows that share a key are read as one text each and must not (a key names a document).
    """
    t = docs.select(F.col(f"`{key}`").alias("_k"), F.posexplode(T.lines(F.col(text))).alias("line_no", "line")).withColumn("s", T.strip(F.col("line")))
    t = t.withColumn("is_page", F.col("s").rlike(r"^# Page:")).withColumn("page", F.sum(F.col("is_page").cast("int")).over(running("_k"))).where("page > 0")
    inside = W.partitionBy("_k", "page").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    t = t.withColumn("page_title", F.first(F.when(F.col("is_page"), F.regexp_extract("s", r"^# Page:\s*(.*)$", 1)), ignorenulls=True).over(inside))
    t = t.withColumn("is_section", F.col("s").rlike(r"^##\s+")).withColumn("sec", F.sum(F.col("is_section").cast("int")).over(inside))
    t = t.withColumn("heading", F.when(F.col("is_section"), T.strip(F.regexp_extract("s", r"^##\s+(.*)$", 1))))
    own_title = F.lower("s") == F.lower(F.concat(F.lit("# "), F.col("page_title")))
    parts = t.groupBy("_k", "page", "page_title", "sec").agg(
        F.max("heading").alias("heading"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_page") & ~F.col("is_section") & ~own_title, F.struct("line_no", "line")))), lambda x: x["line"]), "\n").alias("body")
    )
    parts = parts.withColumn("body", F.regexp_replace("body", "^\n+|\n+$", "")).withColumn("section_key", F.when(F.col("sec") == 0, F.lit("__intro__")).otherwise(T.heading_key(F.col("heading"))))
    merged = parts.groupBy("_k", "page", "page_title", "section_key").agg(
        F.min("sec").alias("sec"), F.min_by("heading", "sec").alias("heading"), F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("sec", "body"))), lambda x: x["body"]), lambda x: x != ""), "\n\n").alias("text")
    )
    merged = merged.withColumn("page_key", T.heading_key(F.col("page_title")))
    same = W.partitionBy("_k", "page_key")
    last = merged.withColumns({"last": F.max("page").over(same), "first": F.min("page").over(same)}).where("page = last")
    return last.select(F.col("_k").alias(key), (F.col("first") - 1).cast("int").alias("page_ord"), "page_title", "page_key", (F.row_number().over(same.orderBy("sec")) - 1).alias("section_ord"), "section_key", "heading", "text")


def full_text(secs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the page's whole text: its sections that are not blank, stripped, in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("section_ord", "text"))), lambda x: T.strip(x["text"]))
    return secs.groupBy(*keys).agg(F.array_join(F.filter(parts, lambda x: x != ""), "\n\n").alias("full_text"))


def filter_content(secs: DataFrame, keys: list[str], page: str | None = None, section: str | None = None, contains: str | None = None) -> DataFrame:
    """``keys``, page_title, heading, block: what a page (by its key), a section (resolved as :func:`resolve_section` does) and a word,
    whatever its case, leave. ``keys`` name a page. Without a section it is the whole page. What matches nothing gives no rows."""
    if page is not None:
        secs = secs.where(F.col("page_key") == T.heading_key(F.lit(page)))
    if section is not None:
        names = secs.select(*keys).distinct().withColumn("_name", F.lit(section))
        got = resolve_section(names, secs, keys, "_name").select(*keys, "page_title", "heading", "text")
    else:
        got = full_text(secs, [*keys, "page_title"]).withColumn("heading", F.lit(None).cast("string")).withColumnRenamed("full_text", "text")
    if contains is not None:
        got = got.where(F.contains(F.lower("text"), F.lit(contains.lower())))
    head = F.concat(F.lit("# "), F.col("page_title"), F.coalesce(F.concat(F.lit(" :: "), F.col("heading")), F.lit("")))
    return got.select(*keys, "page_title", "heading", F.concat(head, F.lit("\n\n"), F.col("text")).alias("block"))


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


def resolve_section(names: DataFrame, secs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Each name's section on its page: the exact key, else the first that contains or is contained, else the most
    similar by matching blocks (at least 0.35; earlier ones first). Names without any are dropped; :func:`unresolved` has them.
    """
    want = names.withColumn("want", T.heading_key(F.col(name)))
    pairs = want.join(secs, keys)
    tier = F.when(F.col("section_key") == F.col("want"), 1).when(F.contains("section_key", "want") | F.contains("want", "section_key"), 2).otherwise(3)
    pairs = pairs.withColumn("tier", tier).withColumn("best", F.min("tier").over(W.partitionBy(*keys, name))).where("tier = best")
    near = pairs.where("tier = 3 and want <> '__intro__' and section_key <> '__intro__'").withColumn("score", _ratio("want", "section_key")).where("score >= 0.35")
    every = pairs.where("tier < 3").withColumn("score", F.lit(1.0)).unionByName(near)
    first = W.partitionBy(*keys, name).orderBy("tier", F.desc("score"), "section_ord")
    return every.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn", "best", "want")


def unresolved(names: DataFrame, resolved: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The names that no section answers, with an ``error``."""
    left = names.join(resolved.select(*keys, name), [*keys, name], "left_anti")
    return left.withColumn("error", F.concat(F.lit("no section is called "), F.coalesce(F.col(name), F.lit("(none)"))))


def sanitize_outline(docs: DataFrame, key: str, text: str, replacements: list[tuple[str, str]], excludes: list[str]) -> DataFrame:
    """(key, outline): literal replacements in order, lines with an excluded token dropped, runs of blank lines collapsed, ends trimmed.

    A null text gives a null, an empty one an empty outline; rows pass one by one, so keys may repeat.
    """
    c = F.col(text)
    for old, new in replacements:
        c = F.replace(c, F.lit(old), F.lit(new))
    kept = F.filter(T.lines(c), lambda x: ~F.exists(F.array(*[F.lit(e) for e in excludes]), lambda e: F.contains(x, e)) if excludes else F.lit(True))
    joined = F.array_join(F.transform(kept, lambda x: F.rtrim(x, F.lit(T.WHITE))), "\n")
    return docs.select(key, F.regexp_replace(F.regexp_replace(joined, "\n{3,}", "\n\n"), "^\n+|\n+$", "").alias("outline"))


def outline_segment(docs: DataFrame, key: str, text: str, repo: Column) -> DataFrame:
    """(key, segment): the lines under the header of a repository, else the first stretch, else the whole text.

    An outline is one text of one row, so its lines are an array and nothing is shuffled. A null text is null; keys may repeat.
    """
    head = lambda x: F.regexp_extract(T.strip(x), r"^Available pages for (.*):$", 1)

    def cut(s: Column) -> Column:
        heads = F.filter(F.transform(s["lines"], lambda x, i: F.struct(i.alias("i"), head(x).alias("h"))), lambda h: h["h"] != "")
        return T.once(F.struct(s["lines"].alias("lines"), s["repo"].alias("repo"), heads.alias("heads")), chosen)

    def chosen(s: Column) -> Column:
        first = F.coalesce(F.get(F.filter(s["heads"], lambda h: h["h"] == s["repo"]), F.lit(0)), F.get(s["heads"], F.lit(0)))["i"]
        return T.once(F.struct(s["lines"].alias("lines"), s["heads"].alias("heads"), F.coalesce(first, F.lit(0)).alias("a")), stretch)

    def stretch(s: Column) -> Column:
        after = F.array_min(F.transform(F.filter(s["heads"], lambda h: h["i"] > s["a"]), lambda h: h["i"]))
        return T.strip(F.array_join(F.slice(s["lines"], s["a"] + 1, F.coalesce(after, F.size(s["lines"])) - s["a"]), "\n"))

    return docs.select(key, T.once(F.struct(T.lines(F.col(text)).alias("lines"), repo.alias("repo")), cut).alias("segment"))


def strip_markdown(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, plain): prose of markdown: no fences, tables or charts; marks of headings and lists dropped; single blank lines.

    Whether a line stands in a fence is the parity of the fence lines up to it. A null text is empty; ``key`` names a document
    (documents that share one are read as one) and may have any name; lines of one document are in one task.
    """
    t = docs.select(F.col(f"`{key}`").alias("_k"), F.posexplode(T.lines(F.col(text))).alias("line_no", "line")).withColumn("s", T.strip(F.col("line"))).withColumn("fence", F.col("s").startswith("```"))
    t = t.withColumn("inside", F.sum(F.col("fence").cast("int")).over(running("_k")) % 2 == 1).where(~F.col("fence") & ~F.col("inside") & ~T.is_table_line(F.col("line")))
    t = t.withColumn("plain", T.plain_line(F.col("line")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "plain"))), lambda x: x["plain"]), "\n")
    got = t.groupBy("_k").agg(body.alias("_b"))
    out = docs.select(F.col(f"`{key}`").alias(key)).join(got, F.col(f"`{key}`").eqNullSafe(F.col("_k")), "left")
    return out.select(F.col(f"`{key}`"), T.strip(F.regexp_replace(F.coalesce("_b", F.lit("")), "\n{3,}", "\n\n")).alias("plain"))


def preceding_context(t: DataFrame, key: str, line: str) -> DataFrame:
    """The closest earlier line that is not blank, beside each line, as ``context``; null where there is none.

    ``t`` has ``line_no``, which orders the lines of a ``key``; null lines are blank.
    """
    before = W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    return t.withColumn("context", F.last(F.nullif(T.strip(F.col(line)), F.lit("")), ignorenulls=True).over(before))


def in_details(t: DataFrame, key: str, line: str) -> DataFrame:
    """Whether each line is within a details block, as ``in_details``; ``t`` as for :func:`preceding_context`."""
    s = T.strip(F.col(line))
    flag = F.when(s.startswith("<details"), 1).when(s.startswith("</details"), 0)
    return t.withColumn("in_details", F.coalesce(F.last(flag, ignorenulls=True).over(running(key)), F.lit(0)) == 1)


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """``df`` with ``batch``: numbers of runs of ``size`` consecutive rows in order, over the whole table.

    Rows are sorted over the cluster; a partition's first number comes from the counts of those before it, one number a partition.
    """
    pid, rn = "_part", "_rn"
    placed = materialize(df.repartitionByRange(*order).withColumn(pid, F.spark_partition_id()), "batches")
    counts = placed.groupBy(pid).agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.sum("_n").over(W.orderBy(pid)) - F.col("_n")).drop("_n")
    numbered = placed.withColumn(rn, F.row_number().over(W.partitionBy(pid).orderBy(*order))).join(counts, pid)
    return numbered.withColumn("batch", F.floor((F.col("_before") + F.col(rn) - 1) / size)).drop(pid, rn, "_before")


def first_rows(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key, by ``order``; a null is a key of its own; among ties any one row stays."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")


def chunks(secs: DataFrame, page: str, title: str, order: str, body: Column) -> DataFrame:
    """(page, title, chunk): one text a page, its title and its formatted sections in order; null sections are left out."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), body.alias("b")))), lambda x: x["b"])
    return secs.groupBy(page, title).agg(F.concat(F.lit("[Page] "), F.col(title), F.lit("\n\n"), F.array_join(parts, "\n\n")).alias("chunk"))
