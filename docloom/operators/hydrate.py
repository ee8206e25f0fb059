"""Hydration: citations in section texts become the source lines that they name."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import references as R
from ..functions import text as T
from ..storage import materialize


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


_S, _N, _I = StringType(), LongType(), IntegerType()
_KEY = {"path": _S, "start": _I, "end": _I}
_MOST = (1 << 31) - 1


@F.pandas_udf(_struct(text=_S, wanted=ArrayType(_struct(**_KEY))))
def _hydrate(text: pd.Series, known: pd.Series) -> pd.DataFrame:
    rows = []
    for t, k in zip(text, known, strict=True):
        h = R.Hydrator({(x["path"], x["start"], x["end"]): x["snippet"] for x in (k if k is not None else ())})
        rows.append((h.run(t or ""), [(p, a, b) for p, a, b in sorted(h.wanted) if max(a, b) <= _MOST]))
    return pd.DataFrame(rows, columns=["text", "wanted"])


def snippet(text: Column, start: Column, end: Column) -> Column:
    """Lines of a file; from 1, to the end for ``end`` 0, one line where the end is before the start; null where there is none."""
    def cut(rows: Column) -> Column:
        first = F.greatest(start, F.lit(1))
        n = F.when(end <= 0, F.size(rows)).otherwise(F.greatest(end - first + 1, F.lit(1)))
        return F.when(first <= F.size(rows), F.nullif(F.rtrim(F.array_join(F.slice(rows, first, n), "\n"), F.lit(T.WHITE)), F.lit("")))

    return T.once(T.lines(text), cut)


def hydrate_sections(secs: DataFrame, files: DataFrame, keys: list[str], text: str, rounds: int | None = None) -> DataFrame:
    """``secs`` with ``text`` hydrated. ``files``: repo, path, text; ``secs`` has repo, and ``keys`` (repo may be one) name a row.

    A snippet that is put in may itself hold references, and each of the four passes of the rules sees what those before put in, so
    references are looked up in rounds, until a round finds none in the files (or after ``rounds``): an equality join on repository and path, from which
    the lines travel and never a file. Rows without an open reference leave the rounds. A null text is empty; a null path or file text has no
    lines; of files with one path any one counts; an empty table of either side is no error. Other columns of ``secs`` pass through.
    """
    keys = list(dict.fromkeys([*keys, "repo"]))
    known = F.array().cast("array<struct<path:string,start:int,end:int,snippet:string>>")
    have = secs.select(*keys, F.col(text).alias("_t"), known.alias("_known")).withColumn("_h", _hydrate("_t", "_known"))
    lines = files.select("repo", "path", F.col("text").alias("_file")).where("path is not null and _file is not null")
    done, number = None, 0
    while rounds is None or number < rounds:
        number += 1
        have = materialize(have, "hydrated")
        open_ = have.where(F.size("_h.wanted") > 0)
        wanted = open_.select(*keys, F.explode("_h.wanted").alias("_w")).select(*keys, "_w.*")
        found = wanted.join(lines, ["repo", "path"]).select(*keys, F.struct("path", "start", "end", snippet(F.col("_file"), F.col("start"), F.col("end")).alias("snippet")).alias("_x"))
        got = materialize(found.where("_x.snippet is not null").groupBy(*keys).agg(F.array_sort(F.collect_set("_x")).alias("_new")), "snippets")
        if got.isEmpty():
            break
        same = [have[k].eqNullSafe(got[k]) for k in keys]
        settled = have.join(got, same, "left_anti").select(*keys, F.col("_h.text").alias("_hydrated"))
        done = settled if done is None else done.unionByName(settled)
        # what a round asked for and did not get is known to be nothing
        asked = F.transform("_h.wanted", lambda w: F.struct(w["path"].alias("path"), w["start"].alias("start"), w["end"].alias("end"), F.lit(None).cast("string").alias("snippet")))
        is_new = lambda w: F.exists("_new", lambda x: (x["path"] == w["path"]) & (x["start"] == w["start"]) & (x["end"] == w["end"]))
        more = F.concat("_known", "_new", F.filter(asked, lambda w: ~is_new(w)))
        have = have.join(got, same).select(*[have[k] for k in keys], "_t", more.alias("_known")).withColumn("_h", _hydrate("_t", "_known"))
    else:
        have = materialize(have, "hydrated")
    rest = have.select(*keys, F.col("_h.text").alias("_hydrated"))
    done = rest if done is None else done.unionByName(rest)
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    done = done.withColumnsRenamed(names)
    joined = secs.join(done, [secs[k].eqNullSafe(done[n]) for k, n in names.items()], "left").drop(*names.values())
    return joined.withColumn(text, F.col("_hydrated")).drop("_hydrated")


_BLOCK = ArrayType(_struct(label=_S, code=_S, language=_S, mermaid=_S))


@F.pandas_udf(_BLOCK)
def code_blocks(text: pd.Series) -> pd.Series:
    return pd.Series([R.code_blocks(t or "") for t in text])


@F.pandas_udf(ArrayType(_struct(explanation=_S, code=_S, language=_S, mermaid=_S)))
def split_blocks(text: pd.Series) -> pd.Series:
    return pd.Series([R.split_blocks(t or "") for t in text])


@F.pandas_udf(ArrayType(_S))
def section_sources(text: pd.Series) -> pd.Series:
    return pd.Series([R.section_sources(t or "") for t in text])


@F.pandas_udf(ArrayType(_struct(label=_S, path=_S, start=_N, end=_N, page_line=_N, context=_S)))
def citations(text: pd.Series) -> pd.Series:
    return pd.Series([R.citations(t or "") for t in text])


@F.pandas_udf(_struct(line=_S, code=_S))
def labels(text: pd.Series) -> pd.DataFrame:
    """The label that a line names, and the one that code names."""
    return pd.DataFrame([(R.label_of_line(t or ""), R.label_of_code(t or "")) for t in text], columns=["line", "code"], dtype=object)


@F.pandas_udf(_struct(**_KEY))
def parse_reference(text: pd.Series) -> pd.DataFrame:
    """Path and lines that a text refers to; null where there is none, or where a number is no line."""
    found = [R.parse_reference(t or "") for t in text]
    return pd.DataFrame([k if k and max(k[1:]) <= _MOST else (None, None, None) for k in found], columns=["path", "start", "end"]).astype({"path": object, "start": "Int32", "end": "Int32"})


@F.pandas_udf(ArrayType(_struct(path=_S, value=_S)))
def json_strings(text: pd.Series) -> pd.Series:
    """Every string of a JSON text with its path, in order; none where it is no JSON."""
    return pd.Series([list(R.json_strings(R.decoded(t))) for t in text])


@F.pandas_udf(StringType())
def json_without_links(text: pd.Series) -> pd.Series:
    """A JSON text with markdown links as their labels in every string; null where it is no JSON."""
    return pd.Series([R.json_without_links(t) for t in text], dtype=object)


@F.pandas_udf(StringType())
def first_event(body: pd.Series) -> pd.Series:
    """The first message of an event stream as JSON; null where there is none."""
    return pd.Series([R.first_event_text(b) for b in body], dtype=object)


@F.pandas_udf(StringType())
def chat_content(answer: pd.Series) -> pd.Series:
    """The text of a chat answer in JSON; null where it has none."""
    return pd.Series([R.chat_content(x) if isinstance(x := R.decoded(a), dict) else None for a in answer], dtype=object)
