"""Substring deduplication by line or paragraph hashing.

Each unit is normalised and hashed in one pass; only digests travel. The earliest occurrence by
(doc_id, position) of each digest stays, and the others are removed, with their offsets in the
original text retained. Counts are aggregated before the shuffle, and the rows of a digest that is everywhere are joined
by broadcast of that digest, so no task gets a hot one whole.

Long sentences are hashed beside the units, and only counted: a passage that was put into the middle of a paragraph is no
unit, but the sentences in it tell which documents have it. Not where all of them are short or only partly shared: for that, runs of
words are counted on request, wherever they start. The query leaves these out, as its SQL has no such column.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, join_groups, load, materialize, ranked, text_of
from .passages import shared_runs

#: Units with fewer words stay. By default every unit that is not blank is hashed.
MIN_WORDS = 1
#: Words that a sentence has at least to tell a shared passage.
SENTENCE_WORDS = 16
_SPACE = re.compile(SPACE)
_SENTENCE = re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+|\n")


def units(text: str, kind: str = "line") -> list[tuple[int, int]]:
    """Start and end of each unit, by code points, without the separators."""
    out, at = [], 0
    for m in re.finditer("\n" if kind == "line" else r"\n(?:[\x20\x09-\x0D]*\n)+", text):
        out.append((at, m.start()))
        at = m.end()
    return [*out, (at, len(text))]


def digest(unit: str, salt: bytes = b"") -> tuple[int, bytes]:
    """Number of words, and the hash of the unit with each run of white space as one space."""
    plain = _SPACE.sub(" ", unit).strip(" ")
    return plain.count(" ") + 1 if plain else 0, hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16, salt=salt).digest()


def _explode(kind: str, least: int, sentence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for no_id, rank, mark, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for k, (a, b) in enumerate(units(text, kind)):
                    if b - a >= 2 * least - 1:
                        n, d = digest(text[a:b])
                        if n >= least:
                            rows.append((d, no_id, rank, mark, k))
                for x in _SENTENCE.split(text):
                    if len(x) >= 2 * sentence - 1:
                        n, d = digest(x, b"sentence")
                        if n >= sentence:
                            rows.append((d, no_id, rank, mark, -1))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["digest", "no_id", "rank", "mark", "unit"])

    return run


_OUT = "doc_id long, n_units long, n_removed long, removed_chars long, spans string, n_repeated long, n_shared_sentences long, n_shared_runs long, kept_text string"


def _cut(kind: str):
    glue = "\n" if kind == "line" else "\n\n"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, gone, repeated, shared, runs in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                every = units(text, kind)
                drop = set(gone or ())
                kept = text if not drop else glue.join(text[a:b] for k, (a, b) in enumerate(every) if k not in drop)
                spans = [every[k] for k in sorted(drop)]
                rows.append((doc, len(every), len(spans), sum(b - a for a, b in spans), ",".join(f"{a}-{b}" for a, b in spans), repeated or 0, shared or 0, runs, kept))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in _OUT.split(", ")])

    return run


def unit_dedup(docs: DataFrame, kind: str = "line", min_words: int = MIN_WORDS, sentence_words: int = SENTENCE_WORDS, passage_words: int | None = None) -> DataFrame:
    """Per row: doc_id, n_units, n_removed, removed_chars, spans (start-end of what went, by code points), n_repeated (units
    that occur again somewhere, those that stay included), n_shared_sentences (sentences of ``sentence_words`` words that
    another document has as well), n_shared_runs (different runs of ``passage_words`` words that another document has as well,
    whatever the units, see :func:`passages.shared_runs`; null without ``passage_words``), kept_text.

    A null text is empty and has one empty unit; blank units always stay. A null doc_id ranks last. Rows that share doc_id and text are one
    occurrence: what stays of one stays of all. Empty tables stay empty; other columns are ignored.
    """
    rows = docs.select(*ranked(docs), text_of(docs).alias("text"))
    key = ["no_id", "rank", "mark"]
    found = materialize(rows.select(*key, "text").mapInArrow(_explode(kind, min_words, sentence_words), "digest binary, no_id boolean, rank long, mark long, unit int"), "units")
    place, doc = F.struct(*key, "unit"), F.struct(*key)
    groups = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.max(place).alias("last")).where("n > 1")
    # within one document, repeated rows of it included, a sentence is not shared
    groups = materialize(groups.where("first.unit >= 0 or not (first.no_id = last.no_id and first.rank = last.rank and first.mark = last.mark)").drop("last"), "repeats")
    again = join_groups(found, groups, "digest", "n", "inner").withColumn("gone", F.when((F.col("unit") >= 0) & (place != F.col("first")), F.col("unit")))
    # no more than the document's own units; repeated rows of a document count once
    again = again.groupBy(*key).agg(F.collect_set("gone").alias("gone"), F.count_distinct(F.when(F.col("unit") >= 0, F.col("unit"))).alias("repeated"), F.count_distinct(F.when(F.col("unit") < 0, F.col("digest"))).alias("shared"))
    runs = F.lit(None).cast("long")
    if passage_words is not None:
        named = rows.select(*key, F.xxhash64(*key).alias("doc"), "text")
        told = named.drop("text").join(shared_runs(named, passage_words), "doc").drop("doc").distinct()
        again, runs = again.join(told, key, "full"), F.coalesce("n_shared_runs", F.lit(0))
    out = rows.join(again, key, "left").select(F.when(~F.col("no_id"), F.col("rank")).alias("doc_id"), "text", "gone", "repeated", "shared", runs.alias("runs"))
    return out.mapInArrow(_cut(kind), _OUT)


def passage_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id and kept_text of every row, without repeated paragraphs and then without repeated lines.

    White space is one space in a digest, so a wrapped paragraph is found whatever the width of its lines. Units under
    ``min_words`` stay. Nulls, repeated rows and empty tables as in :func:`unit_dedup`.
    """
    left = unit_dedup(docs, "paragraph", min_words).select("doc_id", F.col("kept_text").alias("text"))
    return unit_dedup(left, "line", min_words).select("doc_id", "kept_text")


def op5_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = unit_dedup(load(spark, sf_dir, "documents")).drop("n_shared_runs")
    return out.withColumn("repeats_passage", F.col("n_shared_sentences") > 0).withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256)).drop("kept_text")


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS unit FROM d),
u AS (
  SELECT doc_id, unit, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a,
    trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain FROM l
), r AS (
  SELECT *, plain <> '' AND row_number() OVER (PARTITION BY plain ORDER BY doc_id, unit) > 1 AS gone, plain <> '' AND count(*) OVER (PARTITION BY plain) > 1 AS again FROM u
), s AS (
  SELECT DISTINCT doc_id, trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS x
  FROM (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(t, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), '\n', chr(1), 'g'), chr(1))) AS x FROM d)
), p AS (
  SELECT doc_id, count(*) AS n FROM (SELECT doc_id, count(*) OVER (PARTITION BY x) AS n_docs FROM s WHERE len(string_split(x, ' ')) >= {SENTENCE_WORDS}) WHERE n_docs > 1 GROUP BY doc_id
)
SELECT r.doc_id, count(*) AS n_units, count(*) FILTER (WHERE gone) AS n_removed, coalesce(sum(length(line)) FILTER (WHERE gone), 0)::BIGINT AS removed_chars,
  coalesce(string_agg(a || '-' || (a + length(line)), ',' ORDER BY unit) FILTER (WHERE gone), '') AS spans, count(*) FILTER (WHERE again) AS n_repeated,
  coalesce(any_value(p.n), 0) AS n_shared_sentences, coalesce(any_value(p.n), 0) > 0 AS repeats_passage,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY unit) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM r LEFT JOIN p ON r.doc_id = p.doc_id GROUP BY r.doc_id
"""
