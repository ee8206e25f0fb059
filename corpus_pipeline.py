"""The corpus pipeline: toxic documents go, then exact copies, then near copies; sources are mixed; documents are packed.

Each stage works on what the one before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import load, materialize, unused
from docloom.llm.exact_dedup import drop_copies
from docloom.llm.mixing import mixed
from docloom.llm.packing import pack, tokenizer_file
from docloom.llm.simhash import one_of_each
from docloom.llm.toxicity import THRESHOLD, model, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below the threshold, from a model fitted on ``labels`` of ``sf_dir``.

    A null or empty text has the score of the model's bias, so such documents stay or go together. Repeated rows are scored
    alike; an empty table stays empty. All columns are kept, whatever their names.
    """
    (score,) = unused(docs.columns, "toxicity_score")
    return score_toxicity(docs, model(spark, docs, sf_dir), column=score).where(F.col(score) < THRESHOLD).drop(score)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of the smallest doc_id; nulls in doc_id come last.

    A null text is the empty text. Of repeated rows one stays; an empty table stays empty; all columns are kept.
    """
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that of the smallest doc_id; nulls in doc_id come last.

    Null, empty and blank texts are one component. Rows that share doc_id and text stay or go together (the stage before left
    one of them); an empty table stays empty; all columns are kept.
    """
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it: not at all, once or twice.

    A null source is a source of its own; a document without words goes with its block; repeated rows are taken alike; an
    empty table stays empty; all columns are kept.
    """
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, of each row by itself: a document that the mix has twice is packed twice.

    A null or empty text is one piece with the end id; doc_id may be null; an empty table gives no piece.
    """
    return pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact_copies), ("simhash near-dedup", near_copies), ("mixing", mix), ("packing", packing)]

#: Training, XXH64 votes and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
