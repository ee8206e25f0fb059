"""Sinks: records as JSON lines or text; layout is a matter of the export alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def narrative_text(with_critic: bool = False) -> Column:
    """A record as text. The critic's text is left out where it is empty."""
    parts = [F.concat(F.lit("# "), F.col("page"), F.lit(" :: "), F.col("section")), F.concat(F.lit("Narrative:\n"), F.col("narrative"))]
    if with_critic:
        parts.append(F.concat(F.lit("Critic:\n"), F.nullif("critic", F.lit(""))))
    parts.append(F.concat(F.lit("Metadata:\nverdict="), F.coalesce("verdict", F.lit("UNKNOWN")), F.lit(" misalignment="), F.coalesce(F.nullif("misalignment", F.lit("")), F.lit("none")), F.lit(" learnability="), F.coalesce(F.col("learnability").cast("string"), F.lit("None"))))
    return F.concat_ws("\n\n", *parts)


def merged_text() -> Column:
    """A record with its code put in as text under a head; ``text`` may be empty."""
    return F.concat_ws("\n", F.concat(F.lit("# "), F.col("page"), F.lit(" :: "), F.col("section")), F.nullif("text", F.lit("")))


def write_narratives(df: DataFrame, path: str, form: str = "json", with_critic: bool = False) -> None:
    """Records as JSON lines or as text; without a record nothing is written."""
    if df.isEmpty():
        return
    if form == "json":
        df.write.mode("overwrite").json(path)
    else:
        df.select(narrative_text(with_critic).alias("value")).write.mode("overwrite").option("lineSep", "\n\n").text(path)


def write_dataset(chunks: DataFrame, subsections: DataFrame, path: str, as_json: bool = False) -> None:
    """Chunks (repo, page_ord, text) in order as text, unless ``as_json``, and both tables as JSON lines beside it."""
    if not as_json:
        write_concatenated(chunks, f"{path}/text", "text", ["repo", "page_ord"])
    chunks.write.mode("overwrite").json(f"{path}/chunks")
    subsections.write.mode("overwrite").json(f"{path}/subsections")


def persist(chunks: DataFrame, subsections: DataFrame, path: str) -> None:
    """Both tables appended, a folder a repository: what is there is never written again, so progress costs what is new."""
    for name, df in (("chunks", chunks), ("subsections", subsections)):
        df.write.mode("append").partitionBy("repo").parquet(f"{path}/{name}")


def upload(spark: SparkSession, path: str, target: str) -> None:
    """Copy files or folders to a folder of any file system that Hadoop knows, which is made; what is there is replaced."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    a, b = at(path), at(target)
    b.getFileSystem(conf).mkdirs(b)
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), at(b, a.getName()), False, True, conf)


def json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def concatenated(df: DataFrame, by: str, text: str, order: str) -> DataFrame:
    """(by, text): one text of the rows of each document in order, between blank lines, empty ones left out."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])
    return df.groupBy(by).agg(F.array_join(F.filter(parts, lambda x: x != ""), "\n\n").alias("text"))


def write_concatenated(df: DataFrame, path: str, text: str, order: list[str]) -> None:
    """All texts in order, between blank lines, empty ones left out: part files whose names sort as the texts do, never one row."""
    df.where(F.col(text) != "").orderBy(*order).select(F.col(text).alias("value")).write.mode("overwrite").option("lineSep", "\n\n").text(path)
