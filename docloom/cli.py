"""Jobs for ``spark-submit``: python -m docloom.cli JOB ... ; each is a thin call of an operator."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import config
from .functions import text as T
from .functions.chat import ChatModel
from .operators import hydrate, inspect, pipeline, wiki
from .sources import readers, remote, sinks


def session() -> SparkSession:
    return SparkSession.builder.appName("docloom").getOrCreate()


def log_to_stderr(level: str) -> None:
    logging.basicConfig(level=getattr(logging, level.upper(), logging.INFO), format="%(asctime)s %(levelname)s %(name)s: %(message)s")


def show(df: DataFrame, column: str = "value") -> None:
    """Print a column, row by row, as rows arrive; bytes that the terminal does not know are replaced."""
    for row in df.select(column).toLocalIterator():
        print((row[0] or "").encode(sys.stdout.encoding or "utf-8", "replace").decode(sys.stdout.encoding or "utf-8"))


def _models(a: argparse.Namespace) -> tuple[ChatModel | None, ChatModel | None]:
    v = vars(a)
    writer = ChatModel(config.chat_config(v, "design_")) if a.design_use else None
    return writer, ChatModel(config.chat_config(v, "judge_", config.prompt_text(a.judge_prompt, "judge prompt"))) if a.judge_use else None


def dataset(a: argparse.Namespace) -> int:
    """Chunks and narratives of the targets, from a wiki table and archives, or from a tool server."""
    names = readers.expand_repos(a.targets)
    if wrong := config.check_settings(vars(a), len(names)):
        print("\n".join(wrong), file=sys.stderr)
        return 2
    spark = session()
    targets = readers.repo_targets(spark, names, a.commit)
    rows = readers.wiki_parts(spark, a.wiki_dir)
    files = None
    if a.archives:
        files = readers.zip_files(spark, a.archives, a.cache).withColumn("repo", F.regexp_extract("archive", r"([^/]+)\.zip$", 1)).select(F.expr("replace(repo, '__', '/')").alias("repo"), "path", "text")
    writer, critic = _models(a)
    run = pipeline.run_wiki(targets, rows, files, skip_pages=a.skip_page, max_pages=a.max_pages, max_sections=a.max_sections, on_missing=a.on_missing, writer=writer, critic=critic, rounds=a.judge_rounds)
    sinks.persist(run.chunks, run.subsections, f"{a.output_dir}/tables")
    done = {name: spark.read.parquet(f"{a.output_dir}/tables/{name}") for name in ("chunks", "subsections")}
    sinks.write_dataset(done["chunks"], done["subsections"], f"{a.output_dir}/dataset", a.output_format == "json")
    sinks.write_narratives(done["subsections"], f"{a.output_dir}/narratives", a.narrative_format, "critic" in config.narrative_modes(a.narrative_modes))
    if a.upload:
        sinks.upload(spark, f"{a.output_dir}/dataset", a.upload)
    failed = pipeline.failures_text(run.errors).first()
    if failed.n_failed:
        print(failed.message, file=sys.stderr)
    return int(failed.n_failed > 0)


def export(a: argparse.Namespace) -> int:
    """The hydrated document of a repository."""
    spark = session()
    docs = remote.remote_wikis(spark, a.server, [a.repo], a.product)
    # the stretch of the outline that is the repository's own
    outline = wiki.outline_segment(docs, "repo", "outline", F.col("repo")).withColumnRenamed("segment", "outline")
    with readers.checkout(a.url, a.commit) as folder:
        name = a.repo.partition("@")[0]
        document = pipeline.hydrated_document(docs.drop("outline").join(outline, "repo"), readers.repo_files(spark, folder, name), a.title)
        if a.output:
            document.select(F.col("document").alias("value")).write.mode("overwrite").text(a.output)
        else:
            show(document, "document")
    return 0


def contents(a: argparse.Namespace) -> int:
    """The pages and sections of a repository's wiki that the filters leave."""
    docs = remote.remote_wikis(session(), a.server, [a.repo], a.product)
    got = wiki.filter_content(wiki.sections(docs, "repo", "markdown"), ["repo", "page_key"], a.page, a.section, a.contains)
    if got.isEmpty():
        print("nothing matches", file=sys.stderr)
        return 1
    show(got, "block")
    return 0


def structure(a: argparse.Namespace) -> int:
    """The outline of a repository's wiki, tidied, or the tools of the server."""
    if a.tools:
        with remote.Session(a.server, a.product) as s:
            print("\n".join(f"- {t['name']}: {t['description']}" for t in s.tools()))
        return 0
    docs = remote.remote_wikis(session(), a.server, [a.repo], a.product)
    pairs = [(x.partition("=")[0], x.partition("=")[2]) for x in a.replace]
    show(wiki.sanitize_outline(docs, "repo", "outline", pairs, a.exclude), "outline")
    return 0


def ask(a: argparse.Namespace) -> int:
    """The JSON answer to a question about a repository."""
    with remote.Session(a.server, a.product) as s:
        print(s.ask_json(a.repo, a.question, a.retries))
    return 0


def inspected(a: argparse.Namespace) -> int:
    """Counts, failures and a sample of narrative records."""
    records = inspect.filtered(readers.narratives(session(), a.path), a.page, a.section).withColumn("_order", F.monotonically_increasing_id())
    inspect.summary(records, F.col("verdict"), F.col("page"), F.col("section")).show(truncate=False)
    inspect.verdict_histogram(records, F.col("verdict"), F.col("_order")).show(truncate=False)
    inspect.sentence_violations(records, "narrative", a.least, a.most).select("page", "section", "sentence_count").show(10, truncate=False)
    chosen = records.where(T.is_failure(F.col("verdict"), F.col("misalignment"))) if a.failures else inspect.sample(records, "_order", a.sample, a.seed)
    show(chosen.select(inspect.shown(a.code).alias("value")))
    return 0


def find(a: argparse.Namespace) -> int:
    """Citations of page dumps, or the pages without their links."""
    spark = session()
    pages = readers.page_texts(spark, a.path)
    if a.path.endswith(".json"):
        each = spark.read.text(a.path, wholetext=True).select(F.inline(hydrate.json_strings("value")))
        pages = each.select("path", F.col("value").alias("text"))
    if a.strip_links:
        bare = pages.select(T.strip_links(F.col("text")).alias("value"))
        bare.write.mode("overwrite").text(a.output) if a.output else show(bare)
        return 0
    found = pages.select("path", F.inline(hydrate.citations("text")))
    show(found.select(F.concat_ws(" ", "label", *([F.concat(F.lit("line "), F.col("page_line").cast("string")), "context"] if a.with_context else [])).alias("value")))
    return 0


def merge(a: argparse.Namespace) -> int:
    """Narratives with their code put in, as text, and how many references were found."""
    records = readers.narratives(session(), a.path).withColumn("_order", F.monotonically_increasing_id())
    merged = records.withColumn("text", T.merge_code(F.coalesce("narrative", F.lit("")), F.col("code_blocks"))["text"]).select("_order", sinks.merged_text().alias("value"))
    sinks.write_concatenated(merged, a.output, "value", ["_order"])
    inspect.merge_statistics(records, F.coalesce("narrative", F.lit("")), F.col("code_blocks")).show()
    return 0


def concat(a: argparse.Namespace) -> int:
    """Narratives as prose, without their markdown."""
    records = readers.narrative_texts(readers.narratives(session(), a.path)).withColumn("_order", F.monotonically_increasing_id())
    plain = wiki.strip_markdown(records, "_order", "narrative") if not a.keep_markdown else records.withColumnRenamed("narrative", "plain")
    sinks.write_concatenated(plain, a.output, "plain", ["_order"])
    return 0


def clean(a: argparse.Namespace) -> int:
    """Texts without addresses and tags, line by line."""
    session().read.text(a.path, wholetext=True).select(T.clean_lines(F.col("value"), a.strict_urls).alias("value")).write.mode("overwrite").text(a.output)
    return 0


def tokens(a: argparse.Namespace) -> int:
    """Token counts of a list of texts: total, mean and the longest five."""
    texts = readers.keyed_texts(session(), a.path, a.key)
    n = inspect.token_counter(a.tokenizer)("text") if a.tokenizer else T.n_tokens(F.col("text"))
    counted = texts.select("pos", n.alias("n"))
    inspect.token_statistics(counted, F.col("n")).show()
    counted.orderBy(F.desc("n"), "pos").limit(5).show()
    return 0


def parts(a: argparse.Namespace) -> int:
    """Rows or columns of part files."""
    spark = session()
    if a.show_schema:
        readers.schema_of(spark, a.path).show(1000, truncate=False)
    else:
        show(readers.inspect_parts(spark, a.path, a.columns, a.keys, a.limit))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docloom", description=__doc__)
    top.add_argument("--log-level", default="INFO")
    jobs = top.add_subparsers(required=True, metavar="JOB")

    def job(f, *positional: str, **options) -> argparse.ArgumentParser:
        p = jobs.add_parser("inspect" if f is inspected else f.__name__, help=f.__doc__, description=f.__doc__)
        p.set_defaults(job=f)
        for name in positional:
            p.add_argument(name)
        for name, value in options.items():
            flag = "--" + name.replace("_", "-")
            if value is False:
                p.add_argument(flag, action="store_true")
            elif isinstance(value, list):
                p.add_argument(flag, nargs="*", default=value or None)
            else:
                kind = value if isinstance(value, type) else type(value)
                p.add_argument(flag, type=kind, default=None if isinstance(value, type) else value)
        return p

    chat = {f"{who}_{name}": kind for who in ("design", "judge") for name, kind in dict(use=False, model=str, host="localhost", port=8000, path="/v1/chat/completions", server_url=str, server_urls=[], temperature=0.0, top_p=float, max_tokens=131072, api_key=str, service=str, timeout=120.0, retries=2, backoff=2.0).items()}
    p = job(
        dataset, wiki_dir=str, archives=str, cache=str, commit=str, output_dir="result_data", output=str, output_format="text", narrative_output=str, narrative_output_dir=str, narrative_format="json", narrative_modes=[], skip_page=[],
        max_pages=int, max_sections=int, on_missing="error", judge_rounds=1, judge_prompt=str, upload=str, **chat,
    )
    p.add_argument("targets", nargs="+")
    server = dict(server=str, product="wiki")
    job(export, "repo", "url", commit=str, output=str, title="Wiki Structure", **server)
    job(contents, "repo", page=str, section=str, contains=str, **server)
    job(structure, "repo", tools=False, **server).set_defaults(replace=[], exclude=[])
    for name in ("--replace", "--exclude"):
        jobs.choices["structure"].add_argument(name, nargs="*", default=[])
    job(ask, "repo", "question", retries=2, **server)
    job(inspected, "path", page=str, section=str, least=2, most=3, failures=False, sample=0, seed=0, code=False)
    job(find, "path", with_context=False, strip_links=False, output=str)
    job(merge, "path", "output")
    job(concat, "path", "output", keep_markdown=False)
    job(clean, "path", "output", strict_urls=False)
    job(tokens, "path", key="chunks", tokenizer=str)
    job(parts, "path", columns=[], keys=[], limit=int, show_schema=False)
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    log_to_stderr(a.log_level)
    try:
        return a.job(a)
    except (config.SettingError, remote.ToolError, FileNotFoundError) as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
