"""The wiki pipeline: targets and wiki rows to chunks, subsections and errors, all repositories in one plan.

Every step works on rows of all repositories at once; what a loop would do one page after the other is an order column. A repository that
fails is a row of the errors and no row of the results.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import readers
from ..storage import materialize
from . import hydrate, narrate, wiki


class WikiRun(NamedTuple):
    """chunks: repo, page_ord, label, text. subsections: repo, page_ord, section_ord and a narrative record. errors: repo, error."""

    chunks: DataFrame
    subsections: DataFrame
    errors: DataFrame


def py_repr(c: Column) -> Column:
    """A text as a Python literal."""
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(raw), F.lit(shown))
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("\\'")), F.lit("'")))


def format_subsection(r: str | None = None) -> Column:
    """A record as the text of its section in a chunk."""
    c = lambda name: F.col(f"{r}.{name}" if r else name)
    context = T.strip(F.coalesce(c("original_context"), F.lit("")))
    history = F.array_join(F.transform(c("critic_history"), py_repr), ", ")
    meta = F.format_string("Metadata: verdict=%s misalignment=%s learnability=%.3f", c("verdict"), F.coalesce(c("misalignment"), F.lit("none")), c("learnability"))
    return T.strip(
        F.concat(
            F.lit("[Section] "), c("section"), F.when(context != "", F.concat(F.lit("\n\nOriginal Context:\n"), context)).otherwise(F.lit("")), F.lit("\n\nNarrative:\n"), T.strip(c("narrative")),
            F.lit("\n\nCritic:\n"), T.strip(c("critic")), F.lit("\n\n"), meta, F.when(F.size(c("critic_history")) > 0, F.concat(F.lit("\ncritic_history=["), history, F.lit("]"))).otherwise(F.lit("")),
        )
    )


def page_entries(outline: DataFrame, skip_pages: list[str] | None = None, max_pages: int | None = None) -> DataFrame:
    """(repo, page_key, node_title, entry): the first item of each page key in outline order, without those to skip, numbered from 0."""
    o = outline.withColumn("page_key", T.heading_key(F.col("title")))
    first = o.groupBy("repo", "page_key").agg(F.min("ord").alias("ord"), F.min_by("title", "ord").alias("node_title"))
    if skip_pages:
        first = first.where(~F.col("page_key").isin(*[T.heading_key(F.lit(p)) for p in skip_pages]))
    first = first.withColumn("entry", F.row_number().over(W.partitionBy("repo").orderBy("ord")) - 1)
    return (first.where(F.col("entry") < max_pages) if max_pages else first).drop("ord")


def join_pages(entries: DataFrame, secs: DataFrame, on_missing: str = "error") -> tuple[DataFrame, DataFrame]:
    """The sections of the pages that entries name, and (repo, error) of entries without a page.

    ``on_missing``: "error" leaves out the whole repository of such an entry, "skip" only the entry.
    """
    if on_missing not in ("error", "skip"):
        raise ValueError("on_missing is 'error' or 'skip'")
    known = secs.select("repo", "page_key").distinct()
    missing = entries.join(known, ["repo", "page_key"], "left_anti").select("repo", F.concat(F.lit("no page is called "), F.col("node_title")).alias("error"), "entry")
    if on_missing == "error":
        entries = entries.join(missing.select("repo").distinct(), "repo", "left_anti")
    return entries.join(secs, ["repo", "page_key"]), missing.groupBy("repo").agg(F.min_by("error", "entry").alias("error"))


def run_wiki(
    targets: DataFrame, wiki_rows: DataFrame, files: DataFrame | None = None, *, skip_pages: list[str] | None = None, max_pages: int | None = None, max_sections: int | None = None,
    on_missing: str = "error", writer: narrate.Model | None = None, critic: narrate.Model | None = None, rounds: int = 1,
) -> WikiRun:
    """Chunks, subsections and errors of the targets.

    ``targets``: repo, commit; equal targets count once, and blank ones are errors. ``wiki_rows``: repo_name, content, and
    file_path and file_row, if there, for the order: of rows with one name the first counts. ``files``: repo, path, text; without
    them citations stay. Null contents and those that are no list of pages are errors. An empty table of targets gives empty results.
    """
    found = readers.index_targets(targets, wiki_rows)
    decoded = found.where("error is null").select("repo", readers.wiki_texts(F.col("content")).alias("w")).select("repo", "w.*")
    errors = found.where("error is not null").select("repo", "error").unionByName(decoded.where("error is not null").select("repo", "error"))
    good = decoded.where("error is null")
    # read several times below: the keys of the pages alone, then the texts
    secs = materialize(wiki.sections(good, "repo", "markdown"), "sections")
    if max_sections:
        secs = secs.where(F.col("section_ord") < max_sections)
    entries = materialize(page_entries(wiki.outline(good, "repo", "outline"), skip_pages, max_pages), "entries")
    none = good.join(entries.select("repo").distinct(), "repo", "left_anti").select("repo", F.lit("no page of the outline is left").alias("error"))
    pages, missing = join_pages(entries, secs, on_missing)
    rows = pages.select(
        "repo", F.col("entry").alias("page_ord"), "section_ord", F.col("page_title").alias("page"), F.coalesce(F.nullif("heading", F.lit("")), F.col("page_title")).alias("section"), "text"
    )
    if files is not None:
        rows = hydrate.hydrate_sections(rows, files, ["repo", "page_ord", "section_ord"], "text")
    rows = rows.withColumn("code_blocks", hydrate.code_blocks("text"))
    subsections = narrate.narrate(rows, ["repo", "page_ord", "section_ord"], writer, critic, rounds).withColumn("original_context", T.strip(F.col("original_context")))
    if writer is not None or critic is not None:  # each answer is asked for once, whatever is read of the run
        subsections = materialize(subsections, "subsections")
    chunks = page_chunks(subsections)
    errors = errors.unionByName(none)
    if on_missing == "error":
        errors = errors.unionByName(missing)
    return WikiRun(chunks, subsections, errors)


def page_chunks(subsections: DataFrame) -> DataFrame:
    """repo, page_ord, label, text: one text a page, of its sections in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("section_ord", format_subsection().alias("body")))), lambda x: x["body"])
    return subsections.groupBy("repo", "page_ord", "page").agg(F.array_join(parts, "\n\n").alias("_body")).select("repo", "page_ord", T.heading_key(F.col("page")).alias("label"), T.strip(F.concat(F.lit("[Page] "), F.col("page"), F.lit("\n\n"), F.col("_body"))).alias("text"))


def failures_text(errors: DataFrame) -> DataFrame:
    """One row: how many repositories failed, and which, in order; for the message of a job that ends in failure."""
    names = F.array_join(F.array_sort(F.collect_list("repo")), ", ")
    return errors.agg(F.count(F.lit(1)).alias("n_failed"), F.concat(F.lit("Failed to process repositories: "), names).alias("message"))


def hydrated_document(docs: DataFrame, files: DataFrame | None = None, title: str = "Wiki Structure") -> DataFrame:
    """(repo, document): the outline, then each page of it once, in outline order: introduction and sections with their sources put in.

    ``docs``: repo, outline, markdown. Items without a page are left out, but not the items below them. A page none of whose sections has a text is
    there as a whole. Blank parts leave no line. Null texts are empty; repositories without a page have the outline alone.
    """
    secs = materialize(wiki.sections(docs, "repo", "markdown"), "sections")
    entries, _ = join_pages(page_entries(wiki.outline(docs, "repo", "outline")), secs, "skip")
    entries = entries.withColumn("_bare", T.strip(F.col("text")) == "")
    rows = entries.withColumn("_some", F.max((~F.col("_bare") & (F.col("section_key") != "__intro__")).cast("int")).over(W.partitionBy("repo", "entry")))
    head = F.concat(F.lit("# "), F.col("page_title"))
    intro = F.col("section_key") == "__intro__"
    parts = rows.where(~F.col("_bare")).select("repo", "entry", "section_ord", F.when(intro, F.concat(head, F.lit(" :: Introduction"))).otherwise(F.concat(head, F.lit(" :: "), F.coalesce(F.nullif("heading", F.lit("")), F.col("node_title")))).alias("head"), "text")
    # pages whose introduction alone has a text have it once more as the whole page, as no section was written
    whole = wiki.full_text(rows.where("_some = 0"), ["repo", "entry", "page_title"]).select("repo", "entry", F.lit(1 << 30).alias("section_ord"), head.alias("head"), F.col("full_text").alias("text"))
    parts = parts.unionByName(whole)
    if files is not None:
        parts = hydrate.hydrate_sections(parts, files, ["repo", "entry", "section_ord"], "text")
    each = parts.select("repo", "entry", "section_ord", F.concat_ws("\n", F.col("head"), F.nullif(T.strip(F.col("text")), F.lit(""))).alias("part"))
    body = each.groupBy("repo").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entry", "section_ord", "part"))), lambda x: x["part"]), "\n").alias("_body"))
    top = F.concat_ws("\n", F.lit(f"# {title}"), F.nullif(T.strip(F.coalesce("outline", F.lit(""))), F.lit("")))
    return docs.join(body, "repo", "left").select("repo", F.concat_ws("\n", top, F.col("_body")).alias("document"))
