"""Sources: wiki tables, repository files and archives, narrative records, lists of repositories."""

from __future__ import annotations

import ast
import io
import shutil
import subprocess
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T

WIKI = "repo_name string, content string, hdfs_path string"
RECORD = (
    "repo string, page string, section string, original_context string, narrative string, critic string, verdict string, misalignment string, learnability double, "
    "critic_history array<string>, code_blocks array<struct<reference:string,code:string>>"
)


def part_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the ``part-*`` files below a folder, by name; the contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).select("path").orderBy("path")


def wiki_parts(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The ``part-*`` files of a wiki table with each row's place, ``file_path`` and ``file_row``. Without any file it is an error."""
    if part_files(spark, path).isEmpty():
        raise FileNotFoundError(f"no part file below {path}")
    df = spark.read.schema(WIKI).option("pathGlobFilter", "part-*").parquet(path)
    return df.select(*(columns or df.columns), F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("file_row"))


def inspect_parts(spark: SparkSession, path: str, columns: list[str] | None = None, keys: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Rows of part files as JSON (``value``), in file order: of some columns, of the named keys with null for missing ones, at most ``limit``."""
    df = spark.read.option("pathGlobFilter", "part-*").parquet(path)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    names = columns or df.columns
    df = df.select(*names, *place)
    if limit is not None:
        df = df.orderBy("_file", "_row").limit(limit)
    shown = select_keys(df.select(*names), keys).columns if keys else names
    value = F.to_json(F.struct(*[F.col(f"`{k}`") if k in names else F.lit(None).cast("string").alias(k) for k in shown]), {"ignoreNullFields": "false"})
    return df.select(value.alias("value"), "_file", "_row").orderBy("_file", "_row").select("value")


def schema_of(spark: SparkSession, path: str) -> DataFrame:
    """(name, type) of the columns of part files, from the first footer."""
    fields = spark.read.option("pathGlobFilter", "part-*").parquet(path).schema.fields
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in fields], "name string, type string")


def select_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The named columns, null where there is none."""
    return df.select(*[F.col(f"`{k}`") if k in df.columns else F.lit(None).cast("string").alias(k) for k in keys])


def page_rows(df: DataFrame, key: str, content: str) -> DataFrame:
    """(key, page_ord, id, title, content) from a JSON list of pages; elements that are no pages, or have no title, are left out."""
    each = df.select(key, F.posexplode(F.from_json(content, "array<string>")).alias("page_ord", "_e"))
    each = each.withColumn("_p", F.from_json("_e", "struct<page_plan:string,content:string>"))
    plan = F.from_json("_p.page_plan", "struct<id:string,title:string>")
    return each.withColumn("_plan", plan).select(key, "page_ord", F.coalesce(T.strip(F.col("_plan.id")), F.lit("")).alias("id"), T.strip(F.col("_plan.title")).alias("title"), F.coalesce("_p.content", F.lit("")).alias("content")).where("title <> ''")


def wiki_texts(content: Column) -> Column:
    """(outline, markdown, error) of a JSON list of pages: an outline item and a page of markdown for each element that has a title."""
    each = F.from_json(content, "array<string>")
    page = lambda e: F.from_json(e, "struct<page_plan:string,content:string>")
    plan = lambda p: F.from_json(p["page_plan"], "struct<id:string,title:string>")
    bare = lambda c: T.strip(F.coalesce(c, F.lit("")))

    def decoded(e: Column) -> Column:
        return T.once(page(e), lambda p: T.once(plan(p), lambda q: F.struct(bare(q["id"]).alias("id"), bare(q["title"]).alias("title"), bare(p["content"]).alias("content"))))

    pages = lambda all_: F.filter(F.transform(all_, decoded), lambda p: p["title"] != "")
    outline = lambda ps: F.array_join(F.transform(ps, lambda p: F.concat(F.lit("- "), T.strip(F.concat_ws(" ", p["id"], p["title"])))), "\n")
    text = lambda ps: T.strip(F.array_join(F.transform(ps, lambda p: F.concat(F.lit("# Page: "), p["title"], F.lit("\n\n"), p["content"], F.lit("\n"))), "\n\n"))
    error = lambda all_, ps: (
        F.when(all_.isNull() & F.try_parse_json(F.coalesce(content, F.lit(""))).isNull(), F.lit("the content is no JSON")).when(all_.isNull() | (F.size(all_) == 0), F.lit("the content is no list of pages, or an empty one"))
        .when(F.size(ps) == 0, F.lit("no page of the content has a title"))
    )
    none = F.array().cast("array<struct<id:string,title:string,content:string>>")
    return T.once(F.struct(each.alias("a")), lambda s: T.once(F.coalesce(pages(s["a"]), none), lambda ps: F.struct(outline(ps).alias("outline"), text(ps).alias("markdown"), error(s["a"], ps).alias("error"))))


def index_targets(targets: DataFrame, wiki: DataFrame) -> DataFrame:
    """(repo, commit, content, error) of each target: the first wiki row of its name, by file and row; ``error`` where there is none.

    Names are stripped on both sides; of equal targets the first by commit counts, nulls first; a blank name is an error of its own.
    """
    place = [F.col(c) for c in ("file_path", "file_row") if c in wiki.columns] or [F.lit(0)]
    # the minimum by place is partly aggregated before the shuffle, so a name that is everywhere is no large group
    first = wiki.where("repo_name is not null").groupBy(T.strip(F.col("repo_name")).alias("repo")).agg(F.min_by(F.struct("content"), F.struct(*place)).alias("_w"))
    want = targets.groupBy(T.strip(F.coalesce("repo", F.lit(""))).alias("repo")).agg(F.min("commit").alias("commit"))
    got = want.join(first, "repo", "left")
    error = F.when(F.col("repo") == "", F.lit("the name of a repository is blank")).when(F.col("_w").isNull(), F.concat(F.lit("no wiki row is called "), F.col("repo")))
    return got.select("repo", "commit", F.col("_w.content").alias("content"), error.alias("error"))


def repo_files(spark: SparkSession, path: str, repo: str) -> DataFrame:
    """repo, path, text of every file below a checkout."""
    df = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    full = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/")
    return df.select(F.lit(repo).alias("repo"), F.substring(full, len(path.rstrip("/")) + 2, 1 << 30).alias("path"), F.col("value").alias("text"))


@contextmanager
def checkout(url: str, commit: str | None = None, git: str = "git") -> Iterator[str]:
    """A folder of the driver with a clone, for :func:`repo_files`; removed afterwards. A failure carries what git said."""
    if not shutil.which(git):
        raise FileNotFoundError(f"{git} is needed to clone a repository")
    parent = tempfile.mkdtemp(prefix="docloom-clone-")
    folder = f"{parent}/repo"
    try:
        steps = [["clone", "--filter=blob:none", url, folder]] + ([["-C", folder, "checkout", commit]] if commit else [])
        for step in steps:
            done = subprocess.run([git, *step], capture_output=True, text=True)
            if done.returncode:
                raise RuntimeError(f"failed to clone {url}: {done.stderr.strip()}")
        yield folder
    finally:
        shutil.rmtree(parent, ignore_errors=True)


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each archive, some megabytes at a time."""
    for batch in batches:
        for origin, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            with zipfile.ZipFile(io.BytesIO(data.as_py())) as z:
                names = [n for n in z.namelist() if not n.endswith("/")]
                roots = {n.split("/", 1)[0] for n in names}
                cut = len(next(iter(roots))) + 1 if len(roots) == 1 and all("/" in n for n in names) else 0
                rows: list[tuple[str, str, str]] = []
                held = 0
                for n in names:
                    rows.append((origin, n[cut:], z.read(n).decode("utf-8", "replace")))
                    held += len(rows[-1][2])
                    if held > 4_000_000 or n == names[-1]:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["archive", "path", "text"])
                        rows, held = [], 0


def zip_files(spark: SparkSession, glob: str, cache: str | None = None) -> DataFrame:
    """archive, path, text of the files in zip archives; a single root folder is left out of the paths.

    ``cache``: a folder where the table is kept; a complete one there is read instead of the archives.
    """
    schema = "archive string, path string, text string"
    read = lambda: spark.read.format("binaryFile").load(glob).select("path", "content").mapInArrow(_unzip, schema)
    if cache is None:
        return read()
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{cache}/_SUCCESS")
    if not mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
        read().write.mode("overwrite").parquet(cache)
    return spark.read.schema(schema).parquet(cache)


def narratives(spark: SparkSession, path: str) -> DataFrame:
    """Narrative records from a JSON list, one record a line, or an object with ``records``."""
    raw = spark.read.schema(RECORD + ", records array<struct<" + RECORD.replace(" string", ":string").replace(" double", ":double").replace(" array", ":array") + ">>").option("multiLine", True).json(path)
    return raw.where("records is null").drop("records").unionByName(raw.where("records is not null").select(F.inline("records")))


def keyed_texts(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(pos, text) of the list of strings under a key."""
    return spark.read.schema(f"`{key}` array<string>").option("multiLine", True).json(path).select(F.posexplode(F.col(f"`{key}`")).alias("pos", "text"))


def narrative_texts(records: DataFrame) -> DataFrame:
    """The narratives of records that are not blank, stripped."""
    return records.select(T.strip(F.col("narrative")).alias("narrative")).where("narrative <> ''")


@F.pandas_udf(StringType())
def decode_page_text(text: pd.Series) -> pd.Series:
    """A page's text from a dump: a quoted literal, with or without a comma behind it, is decoded; anything else stays."""
    out = []
    for t in text:
        s = (t or "").strip()
        s = s[:-1].rstrip() if s.endswith(",") else s
        try:
            got = ast.literal_eval(s) if len(s) > 1 and s[0] == s[-1] == '"' else t
        except (SyntaxError, ValueError):
            got = t
        out.append(got if isinstance(got, str) else t)
    return pd.Series(out, dtype=object)


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of page dumps, decoded."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), decode_page_text("value").alias("text"))


def expand_repos(tokens: Iterable[str], inside: tuple[str, ...] = ()) -> list[str]:
    """Repository names from tokens: lists with commas, and ``@file`` with a token a line, itself expanded; blank lines and comments are left out."""
    out: list[str] = []
    for token in map(str.strip, tokens):
        if token.startswith("@"):
            path = str(Path(token[1:]).expanduser().resolve())
            if path in inside:
                raise ValueError(f"the list {path} names itself")
            lines = Path(path).read_text(encoding="utf-8").splitlines()
            out += expand_repos([x for x in lines if x.strip() and not x.strip().startswith("#")], (*inside, path))
        elif "," in token:
            out += expand_repos(token.split(","), inside)
        elif token:
            out.append(token)
    return out


def repo_targets(spark: SparkSession, tokens: Iterable[str], default_commit: str | None = None) -> DataFrame:
    """pos, repo, commit of the expanded tokens, in order; a list of repositories is a setting, so it is expanded by the driver."""
    rows = spark.createDataFrame(list(enumerate(expand_repos(tokens))), "pos long, _v string")
    return rows.select("pos", T.repo_target(F.col("_v"), default_commit).alias("t")).select("pos", "t.*")


def repo_list(spark: SparkSession, path: str, default_commit: str | None = None) -> DataFrame:
    """repo, commit from lines with commas; blank lines and comments are left out; of equal ones the first in the file stays, in order."""
    df = spark.read.text(path).withColumn("_line", F.monotonically_increasing_id()).where(~T.strip(F.col("value")).startswith("#"))
    each = df.select("_line", F.posexplode(F.split("value", ",")).alias("_at", "v")).where(T.strip(F.col("v")) != "").select("_line", "_at", T.repo_target(F.col("v"), default_commit).alias("t"))
    return each.groupBy("t").agg(F.min(F.struct("_line", "_at")).alias("_first")).orderBy("_first").select("t.*")


def valid_blocks(df: DataFrame, blocks: str, product: str) -> DataFrame:
    """Tool answers with ``valid``: they have text and none of it reports a failure."""
    bad = lambda b: F.lower(T.strip(b)).startswith("error fetching wiki for") | (F.lower(b).contains("repository not found") & F.lower(b).contains(product.lower())) | F.lower(T.strip(b)).rlike("^[^.\n]*currently indexing")
    return df.withColumn("valid", (F.size(blocks) > 0) & ~F.exists(blocks, bad))


def text_blocks(payload: str) -> "F.Column":
    """The texts in a tool's answer."""
    each = F.from_json(F.get_json_object(payload, "$.result.content"), "array<string>")
    got = F.transform(each, lambda e: F.from_json(e, "struct<type:string,text:string>"))
    return F.transform(F.filter(got, lambda e: (e["type"] == "text") & (e["text"] != "")), lambda e: e["text"])
