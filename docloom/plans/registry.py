"""Queries of the wiki operators over the tables, each with the SQL for the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import hydrate, inspect, narrate, wiki
from ..sources import readers, sinks

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL fragments, from the same lists as the columns ---------------------------------------------------------------


def s_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def s_any(x: str, words) -> str:
    return f"regexp_matches(lower({x}), '{'|'.join(w.replace('-', chr(92) + '-') for w in words)}')"


def s_tokens(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '\S+'))"


def s_sentences(x: str) -> str:
    cut = rf"string_split(regexp_replace({s_strip(x)}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"
    return f"list_filter(list_transform({cut}, lambda s: {s_strip('s')}), lambda s: s <> '')"


def s_learn(x: str) -> str:
    n = s_tokens(x)
    return f"round(least((CASE WHEN {n} >= 80 THEN 0.4::DOUBLE WHEN {n} >= 40 THEN 0.2::DOUBLE ELSE 0::DOUBLE END) + (CASE WHEN {s_any(x, T.VERBS)} THEN 0.3::DOUBLE ELSE 0::DOUBLE END) + (CASE WHEN {s_any(x, T.NOUNS)} THEN 0.3::DOUBLE ELSE 0::DOUBLE END), 1::DOUBLE), 3)"


def s_misaligned(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {s_any(x, p)} THEN '{k}'" for k, p in T.MISALIGNED) + " ELSE 'none' END"


def s_key(x: str) -> str:
    return rf"coalesce(nullif(regexp_replace(lower(regexp_replace({s_strip(x)}, '^\d+(?:\.\d+)*\s+', '')), '[^a-z0-9]+', '', 'g'), ''), '__intro__')"


def s_lines(x: str) -> str:
    return f"(CASE WHEN {x} = '' THEN []::VARCHAR[] WHEN {x} LIKE '%' || chr(10) THEN string_split({x}, chr(10))[:-2] ELSE string_split({x}, chr(10)) END)"


def s_clean(x: str) -> str:
    a = rf"regexp_replace(regexp_replace(regexp_replace({x}, '{T.ADDRESS}', '', 'g'), '<[^>\n]+>', '', 'g'), '<[^>]*$', '')"
    tidy = s_strip(rf"regexp_replace({a}, '\s{{2,}}', ' ', 'g')")
    tidy = f"""regexp_replace(regexp_replace({tidy}, '^"+|"+$', '', 'g'), '^''+|''+$', '', 'g')"""
    return f"CASE WHEN {s_strip(a)} LIKE '<%' OR {s_strip(a)} LIKE '%>' THEN '' ELSE {tidy} END"


# --- scoring and cleaning --------------------------------------------------------------------------------------------


@query(f"SELECT lang, {s_learn('text')} AS learnability, count(*) AS n FROM documents GROUP BY ALL")
def learnability_by_lang(spark, d):
    return table(spark, d, "documents").groupBy("lang", T.learnability(F.col("text")).alias("learnability")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, len(s)::BIGINT AS n_sentences, coalesce(s[1], '') AS first_sentence FROM (SELECT doc_id, {s_sentences('text')} AS s FROM documents)")
def sentence_split_stats(spark, d):
    s = table(spark, d, "documents").select("doc_id", T.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.coalesce(F.get("s", F.lit(0)), F.lit("")).alias("first_sentence"))


@query(f"SELECT doc_id, {s_tokens('text')}::BIGINT AS n_tokens, {s_learn('text')} AS learnability FROM documents")
def learnability_scores(spark, d):
    return table(spark, d, "documents").select("doc_id", T.n_tokens(F.col("text")).cast("long").alias("n_tokens"), T.learnability(F.col("text")).alias("learnability"))


@query(f"SELECT doc_id, array_to_string(list_filter(list_transform({s_lines('text')}, lambda l: {s_clean('l')}), lambda l: l <> ''), chr(10)) AS cleaned FROM documents")
def clean_lines_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_lines(F.col("text")).alias("cleaned"))


@query(f"SELECT page_id, array_to_string(list_filter(list_transform({s_lines('html')}, lambda l: {s_clean('l')}), lambda l: l <> ''), chr(10)) AS cleaned FROM pages")
def clean_html_pages(spark, d):
    return table(spark, d, "pages").select("page_id", T.clean_lines(F.col("html")).alias("cleaned"))


@query(f"SELECT page_id, {s_key('h')} AS heading_key FROM (SELECT page_id, nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '') AS h FROM pages)")
def heading_keys(spark, d):
    h = F.nullif(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), F.lit(""))
    return table(spark, d, "pages").select("page_id", T.heading_key(h).alias("heading_key"))


_CRITIC = "CASE conv_id % 4 WHEN 0 THEN 'FAIL' || chr(10) || 'missing intent. ' || text WHEN 1 THEN 'PASS ' || text WHEN 2 THEN 'unsure: contradiction ' || text ELSE '' END"
_ANSWER = _CRITIC.replace("chr(10)", "char(10)")


@query(f"SELECT conv_id, turn, {s_misaligned(_CRITIC)} AS kind FROM conversations")
def misalignment_classify(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.misalignment(F.expr(_ANSWER)).alias("kind"))


@query(
    f"""SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'FAIL' WHEN 2 THEN 'UNKNOWN' ELSE 'PASS' END AS verdict,
    CASE conv_id % 4 WHEN 0 THEN {s_strip("'missing intent. ' || text")} WHEN 2 THEN {s_strip("'unsure: contradiction ' || text")} WHEN 3 THEN 'Critic returned an empty response.'
      ELSE coalesce(nullif({s_strip("substr(string_split('PASS ' || " + s_strip('text') + ", chr(10))[1], 5)")}, ''), 'x') END AS answer,
    CASE conv_id % 4 WHEN 0 THEN {s_misaligned("'missing intent. ' || text")} ELSE 'none' END AS kind FROM conversations"""
)
def verdict_parser(spark, d):
    v = table(spark, d, "conversations").select("conv_id", "turn", T.section_verdict(F.expr(_ANSWER)).alias("v"))
    return v.select("conv_id", "turn", F.col("v.verdict").alias("verdict"), F.col("v.text").alias("answer"), F.col("v.misalignment").alias("kind"))


@query(f"SELECT doc_id, CASE WHEN length(t) <= 200 THEN t ELSE regexp_replace(substr(t, 1, 197), '\\s+$', '') || '...' END AS short FROM (SELECT doc_id, {s_strip('text')} AS t FROM documents)")
def truncate_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", T.truncate(F.col("text"), 200).alias("short"))


_HIDDEN = "(lower(l) LIKE 'in the %' AND lower(l) LIKE '% repository%') OR regexp_matches(lower(l), '^(system prompt|user|assistant):') OR l LIKE 'Source:%'"
_TALK = "role || ': ' || text || chr(10) || text || chr(10) || 'Source: x' || chr(10) || 'in the old repository'"


@query(f"SELECT conv_id, turn, regexp_replace(array_to_string(list_filter(list_transform(string_split({s_strip(_TALK)}, chr(10)), lambda l: {s_strip('l')}), lambda l: NOT ({_HIDDEN})), chr(10)), '^\\n+|\\n+$', '', 'g') AS visible FROM conversations")
def sanitize_visible(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.visible_text(F.expr(_TALK.replace("chr(10)", "char(10)"))).alias("visible"))


_LINKED = "'see [ ' || p_name || ' ](x/' || p_partkey || '.py) and ![' || p_brand || '](b.png)'"


@query("SELECT p_partkey, 'see ' || p_name || ' and ' || p_brand AS plain FROM part")
def strip_links(spark, d):
    return table(spark, d, "part").select("p_partkey", T.strip_links(F.expr(_LINKED)).alias("plain"))


_CODE = "'class ' || replace(p_name, ' ', '_') || ':' || chr(10) || '  def run_' || p_size || '(self):' || chr(10) || '    total = ' || p_size || chr(10) || '    def total' "


@query("SELECT p_partkey, replace(p_name, ' ', '_') || ',run_' || p_size || ',total' AS symbols FROM part")
def code_symbols(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(T.code_symbols(F.expr(_CODE.replace("chr(10)", "char(10)"))), ",").alias("symbols"))


_LABEL = "CASE p_partkey % 5 WHEN 0 THEN 'src/' || p_size || '.py:' || p_size || '-' || (p_size + 9) WHEN 1 THEN 'src/' || p_size || '.py:' || p_size WHEN 2 THEN 'Source: src/' || p_size || '.py' WHEN 3 THEN 'image::' || p_size ELSE ' ' END"


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 < 3 THEN 'src/' || p_size || '.py' END AS path, CASE p_partkey % 5 WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 2 THEN 1 END AS first_line,
  CASE p_partkey % 5 WHEN 0 THEN p_size + 9 WHEN 1 THEN p_size WHEN 2 THEN 80 END AS last_line FROM part""")
def label_ranges(spark, d):
    r = table(spark, d, "part").select("p_partkey", T.label_range(F.expr(_LABEL)).alias("r"))
    return r.select("p_partkey", F.col("r.path").alias("path"), F.col("r.start").alias("first_line"), F.col("r.end").alias("last_line"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'src/' || p_size || '.py:' || p_size || '-' || (p_size + 9) WHEN 1 THEN 'src/' || p_size || '.py:' || p_size END AS label FROM part")
def reference_labels(spark, d):
    return table(spark, d, "part").select("p_partkey", T.reference_label(F.expr(_LABEL)).alias("label"))


@query(f"""SELECT doc_id, coalesce(s[1], '') AS design_intent, array_to_string(list_filter(s[2:], lambda x: {s_any('x', T.NEEDS)})[:3], '|') AS constraints,
  array_to_string(list_filter(s[2:], lambda x: {s_any('x', T.NOUNS)} OR contains(lower(x), 'total'))[:3], '|') AS mechanisms FROM (SELECT doc_id, {s_sentences('text')} AS s FROM documents)""")
def scaffolds(spark, d):
    s = table(spark, d, "documents").select("doc_id", T.scaffold(F.col("text"), F.lit("total = 1")).alias("s"))
    return s.select("doc_id", F.col("s.design_intent").alias("design_intent"), F.array_join("s.constraints", "|").alias("constraints"), F.array_join("s.key_mechanisms", "|").alias("mechanisms"))


@query("SELECT p_partkey, replace(p_name, ' ', '_') || '_' || regexp_replace(substr(p_type, 1, 12), '[^A-Za-z0-9]', '-', 'g') AS slug, replace(p_name, ' ', '') AS repo, p_brand AS commit_id FROM part")
def slugs_and_targets(spark, d):
    t = T.repo_target(F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("")), F.lit("@"), F.col("p_brand")))
    return table(spark, d, "part").select("p_partkey", T.slug(F.col("p_name"), F.col("p_type")).alias("slug"), t["repo"].alias("repo"), t["commit"].alias("commit_id"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'python' WHEN 1 THEN 'cpp' ELSE 'text' END AS language FROM part")
def file_languages(spark, d):
    path = F.expr("concat('a.b/c.', element_at(array('py', 'HPP', 'unknown'), p_size % 3 + 1))")
    return table(spark, d, "part").select("p_partkey", T.language(path).alias("language"))


_PROSE = "'File: a.py' || chr(10) || chr(10) || '```py' || chr(10) || 'x' || chr(10) || chr(10) || 'y' || chr(10) || '```' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'end'"


_HEADED = "CASE turn % 3 WHEN 0 THEN '# ' || text WHEN 1 THEN 'Design intent: ' || text ELSE text END"
_PAGE = "'File: a.py' || chr(10) || chr(10) || '```py' || chr(10) || 'x' || chr(10) || chr(10) || 'y' || chr(10) || '```' || chr(10) || chr(10) || " + _HEADED + " || CASE WHEN turn % 2 = 0 THEN chr(10) || chr(10) || 'end' ELSE '' END"


def s_summary(x: str) -> str:
    parts = f"list_filter(list_transform(string_split({s_strip(f"regexp_replace({x}, '(?is)```.*?```', '', 'g')")}, chr(10) || chr(10)), lambda q: {s_strip('q')}), lambda q: q <> '')"
    return f"coalesce(list_filter({parts}, lambda q: NOT regexp_matches(lower(q), '^(file:|source:|design intent:|table of|#)'))[1], ({parts})[1], '')"


@query(f"SELECT conv_id, turn, {s_summary(_PAGE)} AS summary FROM conversations")
def summary_paragraphs(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.summary_paragraph(F.expr(_PAGE.replace("chr(10)", "char(10)"))).alias("summary"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"k": ' || event_id || '}' WHEN 1 THEN 'json' || chr(10) || '{"k": ' || event_id || '}' WHEN 2 THEN 'no braces ' || event_id ELSE '{a} and {' || event_id || '}' END AS found FROM events""")
def json_from_answers(spark, d):
    text = """CASE event_id % 4 WHEN 0 THEN concat('answer ```json {"k": ', event_id, '} ``` done') WHEN 1 THEN concat(' ```json\\n{"k": ', event_id, '}\\n``` {x}') WHEN 2 THEN concat(' no braces ', event_id, ' ') ELSE concat('so {a} and {', event_id, '} ```') END"""
    return table(spark, d, "events").select("event_id", T.json_from_answer(F.expr(text)).alias("found"))


@query("SELECT p_partkey, replace(p_name, ' ', '_') || '_' || regexp_replace(substr(p_type, 1, 12), '[^A-Za-z0-9]', '-', 'g') || '_dataset.txt' AS dataset, replace(p_name, ' ', '_') || '_narratives.json' AS narratives FROM part")
def output_names(spark, d):
    return table(spark, d, "part").select("p_partkey", T.output_name(F.col("p_name"), F.col("p_type"), "dataset").alias("dataset"), T.output_name(F.col("p_name"), None, "narratives", True).alias("narratives"))


# --- inspection ------------------------------------------------------------------------------------------------------

_VERDICTS = "(SELECT d.doc_id, d.lang, d.source, d.text, CASE l.quality WHEN 1 THEN 'pass' WHEN 0 THEN 'fail' END AS verdict, CASE WHEN l.toxic = 1 THEN 'intent_code_mismatch' WHEN l.toxic = 0 THEN 'none' END AS kind FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def _verdicts(spark, d):
    lab = table(spark, d, "labels").select("doc_id", F.expr("CASE quality WHEN 1 THEN 'pass' WHEN 0 THEN 'fail' END").alias("verdict"), F.expr("CASE WHEN toxic = 1 THEN 'intent_code_mismatch' WHEN toxic = 0 THEN 'none' END").alias("kind"))
    return table(spark, d, "documents").join(lab, "doc_id", "left")


@query(f"SELECT upper(coalesce(verdict, 'UNKNOWN')) AS verdict, count(*) AS n, count(*) / sum(count(*)) OVER () AS ratio, min(doc_id) AS first_seen FROM {_VERDICTS} GROUP BY 1")
def verdict_histogram(spark, d):
    return inspect.verdict_histogram(_verdicts(spark, d), F.col("verdict"), F.col("doc_id"))


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE verdict = 'pass') AS passed, count(*) FILTER (WHERE verdict IS DISTINCT FROM 'pass') AS failed, (count(*) FILTER (WHERE verdict = 'pass')) / count(*) AS pass_ratio, count(DISTINCT lang) AS pages, count(DISTINCT kind) + max((kind IS NULL)::INT)::BIGINT AS sections FROM {_VERDICTS}")
def verdict_summary(spark, d):
    return inspect.summary(_verdicts(spark, d), F.col("verdict"), F.col("lang"), F.col("kind"))


@query(f"SELECT doc_id, verdict, kind FROM {_VERDICTS} WHERE upper(coalesce(verdict, 'UNKNOWN')) <> 'PASS' OR coalesce(kind, '') NOT IN ('', 'none')")
def failures(spark, d):
    return _verdicts(spark, d).where(T.is_failure(F.col("verdict"), F.col("kind"))).select("doc_id", "verdict", "kind")


@query(f"SELECT doc_id, n AS sentence_count FROM (SELECT doc_id, len({s_sentences('text')})::INT AS n FROM documents) WHERE NOT (n BETWEEN 2 AND 3)")
def sentence_violations(spark, d):
    return inspect.sentence_violations(table(spark, d, "documents"), "text").select("doc_id", "sentence_count")


@query("SELECT doc_id, source FROM documents WHERE contains(lower(source), 'rc1') AND contains(lower(lang), 'e')")
def inspector_filter(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.col("source").alias("page"), F.col("lang").alias("section"))
    return inspect.filtered(docs, "RC1", "e").select("doc_id", "source")


@query(f"SELECT sum(n)::BIGINT AS total, avg(n) AS mean, max(n) AS longest, count(*) AS entries FROM (SELECT {s_tokens('text')}::BIGINT AS n FROM documents)")
def token_statistics(spark, d):
    return inspect.token_statistics(table(spark, d, "documents"), T.n_tokens(F.col("text")))


@query(f"SELECT doc_id, {s_tokens('text')}::BIGINT AS n FROM documents ORDER BY n DESC, doc_id LIMIT 5")
def top5_by_tokens(spark, d):
    return table(spark, d, "documents").select("doc_id", T.n_tokens(F.col("text")).cast("long").alias("n")).orderBy(F.desc("n"), "doc_id").limit(5)


@query("SELECT doc_id, lang FROM documents ORDER BY md5('7-' || doc_id), doc_id LIMIT 10")
def random_sample(spark, d):
    return inspect.sample(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 10, seed=7)


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 20")
def row_limit(spark, d):
    return table(spark, d, "documents").orderBy("doc_id").select("doc_id", "lang").limit(20)


# --- keys, order and sets --------------------------------------------------------------------------------------------


@query("SELECT lang, string_agg(source, ',' ORDER BY o) AS sources FROM (SELECT lang, source, min(doc_id) AS o FROM documents GROUP BY ALL) GROUP BY lang")
def ordered_distinct_sources(spark, d):
    g = table(spark, d, "documents").groupBy("lang", "source").agg(F.min("doc_id").alias("o"))
    return g.groupBy("lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "source"))), lambda x: x["source"]), ",").alias("sources"))


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey")
def first_row_wins_index(spark, d):
    return wiki.first_rows(table(spark, d, "orders"), ["o_custkey"], ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT o_custkey, min(o_orderkey) AS place, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey")
def last_wins_overwrite(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("place"), F.max_by("o_totalprice", "o_orderkey").alias("o_totalprice"))


@query("SELECT c.c_custkey, c.c_name, o.o_orderkey FROM customer c LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey")
def target_lookup(spark, d):
    index = wiki.first_rows(table(spark, d, "orders"), ["o_custkey"], ["o_orderkey"]).select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return table(spark, d, "customer").join(index, "c_custkey", "left").select("c_custkey", "c_name", "o_orderkey")


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents WHERE source NOT IN ('src1', 'src2')) WHERE rn <= 3")
def skip_and_first_sections(spark, d):
    skip = spark.createDataFrame([("src1",), ("src2",)], "source string")
    left = table(spark, d, "documents").join(skip, "source", "left_anti")
    return left.withColumn("rn", F.row_number().over(W.partitionBy("source").orderBy("doc_id"))).where("rn <= 3").select("doc_id", "source")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch FROM documents")
def batch_numbering(spark, d):
    return wiki.batches(table(spark, d, "documents").select("doc_id"), ["doc_id"], 64).select("doc_id", "batch")


@query("SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def concatenate(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").unionAll(table(spark, d, "benchmark").select("item_id", "text"))


@query("SELECT doc_id, NULL::VARCHAR AS missing, lang FROM documents")
def key_projection(spark, d):
    return readers.select_keys(table(spark, d, "documents"), ["doc_id", "missing", "lang"])


@query("SELECT conv_id, count(*) FILTER (WHERE length(text) < 20) AS n_errors, string_agg(turn || ': short', '; ' ORDER BY turn) FILTER (WHERE length(text) < 20) AS errors FROM conversations GROUP BY conv_id")
def error_rollup(spark, d):
    bad = F.length("text") < 20
    rows = F.array_sort(F.collect_list(F.when(bad, F.struct("turn", F.concat(F.col("turn").cast("string"), F.lit(": short")).alias("m")))))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.count_if(bad).alias("n_errors"), F.nullif(F.array_join(F.transform(rows, lambda x: x["m"]), "; "), F.lit("")).alias("errors"))


# --- wiki markdown ---------------------------------------------------------------------------------------------------


def _wiki(spark, d):
    c = table(spark, d, "conversations")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", F.expr("concat('## ', role, char(10), text, char(10), '### sub', char(10))").alias("s")))), lambda x: x["s"])
    head = F.expr("concat('# Page: ', conv_id, ' Conversation ', conv_id, char(10), 'intro', char(10))")
    return c.groupBy("conv_id").agg(F.array_join(parts, "").alias("body")).select("conv_id", F.concat(head, "body").alias("md"))


_BODY = r"regexp_replace(text || chr(10) || '### sub' || chr(10), '^\n+|\n+$', '', 'g')"
_SECTIONS = f"""(SELECT conv_id, '__intro__' AS section_key, NULL AS heading, 'intro' AS text, -1 AS o FROM (SELECT DISTINCT conv_id FROM conversations)
 UNION ALL SELECT conv_id, {s_key('role')}, role, string_agg({_BODY}, chr(10) || chr(10) ORDER BY turn), min(turn) FROM conversations GROUP BY conv_id, role)"""


@query(f"SELECT conv_id, 0 AS page_ord, conv_id || ' Conversation ' || conv_id AS page_title, row_number() OVER (PARTITION BY conv_id ORDER BY o) - 1 AS section_ord, section_key, heading, text FROM {_SECTIONS}")
def page_section_split(spark, d):
    return wiki.sections(_wiki(spark, d), "conv_id", "md").drop("page_key")


@query(f"SELECT conv_id, '[Page] ' || conv_id || ' Conversation ' || conv_id || chr(10) || chr(10) || string_agg('## ' || coalesce(heading, 'Overview') || chr(10) || text, chr(10) || chr(10) ORDER BY o) AS chunk FROM {_SECTIONS} GROUP BY conv_id")
def chunk_assembly(spark, d):
    s = wiki.sections(_wiki(spark, d), "conv_id", "md")
    body = F.concat(F.lit("## "), F.coalesce("heading", F.lit("Overview")), F.lit("\n"), F.col("text"))
    return wiki.chunks(s, "conv_id", "page_title", "section_ord", body).select("conv_id", "chunk")


@query(f"SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY o) FILTER (WHERE trim(text) <> '') AS full_text FROM {_SECTIONS} GROUP BY conv_id")
def page_full_text(spark, d):
    s = wiki.sections(_wiki(spark, d), "conv_id", "md")
    return wiki.full_text(s, ["conv_id"])


@query(f"SELECT conv_id, section_key, '# ' || conv_id || ' Conversation ' || conv_id || coalesce(' :: ' || heading, '') || chr(10) || chr(10) || text AS block FROM {_SECTIONS} WHERE section_key = 'user' AND contains(lower(text), 'th')")
def content_filter(spark, d):
    got = wiki.filter_content(wiki.sections(_wiki(spark, d), "conv_id", "md"), ["conv_id"], section="User", contains="TH")
    return got.select("conv_id", T.heading_key(F.col("heading")).alias("section_key"), "block")


# the key of "Assist" is contained in one key, and of the others only "system" is similar enough (matching blocks "s", "st": 6/12)
@query(f"SELECT conv_id, 'Assist' AS name, CASE WHEN bool_or(section_key = 'assistant') THEN 'assistant' ELSE 'system' END AS section_key FROM {_SECTIONS} WHERE section_key IN ('assistant', 'system') GROUP BY conv_id")
def section_resolution(spark, d):
    s = wiki.sections(_wiki(spark, d), "conv_id", "md")
    return wiki.resolve_section(s.select("conv_id", F.lit("Assist").alias("name")).distinct(), s, ["conv_id"], "name").select("conv_id", "name", "section_key")


# no key contains "asistent" or is in it; the similarity is twice the letters in matching blocks over all letters
@query(f"""SELECT conv_id, 'Asistent' AS name, section_key, 2 * CASE section_key WHEN 'assistant' THEN 7 ELSE 4 END / (8 + length(section_key))::DOUBLE AS score
  FROM (SELECT conv_id, CASE WHEN bool_or(section_key = 'assistant') THEN 'assistant' ELSE 'system' END AS section_key FROM {_SECTIONS} WHERE section_key IN ('assistant', 'system') GROUP BY conv_id)""")
def section_resolution_similar(spark, d):
    s = wiki.sections(_wiki(spark, d), "conv_id", "md")
    return wiki.resolve_section(s.select("conv_id", F.lit("Asistent").alias("name")).distinct(), s, ["conv_id"], "name").select("conv_id", "name", "section_key", "score")


def _outline(spark, d):
    n = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("ns"))
    r = table(spark, d, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey"))
    body = F.array_join(F.transform("ns", lambda x: F.concat(F.lit("\n  - "), F.col("r_regionkey").cast("string"), F.lit("."), x["n_nationkey"].cast("string"), F.lit(" "), x["n_name"])), "")
    return r.select("r_regionkey", F.concat(F.lit("- "), F.col("r_regionkey").cast("string"), F.lit(" "), F.col("r_name"), body, F.lit("\n- Appendix")).alias("md"))


@query("""SELECT r_regionkey, 0::BIGINT AS ord, 0::BIGINT AS level, r_regionkey::VARCHAR AS number, r_name AS title, NULL::BIGINT AS parent_ord FROM region
 UNION ALL SELECT n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey), 1, n_regionkey || '.' || n_nationkey, n_name, 0 FROM nation
 UNION ALL SELECT n_regionkey, count(*) + 1, 0, NULL, 'Appendix', NULL FROM nation GROUP BY n_regionkey""")
def outline_parents(spark, d):
    o = wiki.outline(_outline(spark, d), "r_regionkey", "md")
    return o.select("r_regionkey", F.col("ord").cast("long"), F.col("level").cast("long"), "number", "title", F.col("parent_ord").cast("long"))


@query("""SELECT r_regionkey, coalesce(string_agg(line, chr(10) ORDER BY o) FILTER (WHERE NOT contains(line, 'A')), '') AS outline FROM (
  SELECT r_regionkey, -1 AS o, '- ' || r_regionkey || ' ' || r_name AS line FROM region
  UNION ALL SELECT n_regionkey, n_nationkey, '  - ' || n_regionkey || '.' || n_nationkey || ' ' || n_name FROM nation) GROUP BY r_regionkey""")
def outline_sanitizer(spark, d):
    return wiki.sanitize_outline(_outline(spark, d), "r_regionkey", "md", [("Appendix", "Annex")], ["A"])


@query("SELECT s_suppkey, i AS ord, i AS level, CASE WHEN i > 0 THEN i - 1 END AS parent_ord FROM supplier, range(12 + s_suppkey % 20) AS t(i)")
def outline_any_depth(spark, d):
    text = F.expr("concat_ws('\n', transform(sequence(0, cast(11 + s_suppkey % 20 as int)), i -> concat(repeat('  ', i), '- item ', i)))")
    o = wiki.outline(table(spark, d, "supplier").select("s_suppkey", text.alias("md")), "s_suppkey", "md")
    return o.select("s_suppkey", F.col("ord").cast("long"), F.col("level").cast("long"), F.col("parent_ord").cast("long"))


@query("SELECT r_regionkey, 'Available pages for ' || r_name || ':' || chr(10) || '- 1 ' || r_name AS segment FROM region")
def outline_segment(spark, d):
    text = F.expr("concat('Available pages for other:', char(10), '- 0 other', char(10), 'Available pages for ', r_name, ':', char(10), '- 1 ', r_name)")
    docs = table(spark, d, "region").select("r_regionkey", "r_name", text.alias("t"))
    return wiki.outline_segment(docs, "r_regionkey", "t", F.col("r_name"))


_MD = "'# Title ' || conv_id || chr(10) || '```' || chr(10) || 'code' || chr(10) || '```' || chr(10) || '| a | b |' || chr(10) || '- item' || chr(10) || chr(10) || chr(10) || chr(10) || '1. one' || chr(10)"


@query("SELECT DISTINCT conv_id, 'Title ' || conv_id || chr(10) || 'item' || chr(10) || chr(10) || 'one' AS plain FROM conversations")
def fence_parity_strip(spark, d):
    docs = table(spark, d, "conversations").select("conv_id").distinct().select("conv_id", F.expr(_MD.replace("chr(10)", "char(10)")).alias("md"))
    return wiki.strip_markdown(docs, "conv_id", "md")


@query(f"SELECT conv_id, turn, last_value(nullif({s_strip('text')}, '') IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS context FROM conversations")
def preceding_context(spark, d):
    t = table(spark, d, "conversations").withColumn("line_no", F.col("turn"))
    return wiki.preceding_context(t, "conv_id", "text").select("conv_id", "turn", "context")


@query("SELECT conv_id, turn, turn >= 1 AND (turn < 3 OR NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = conversations.conv_id AND c.turn = 3)) AS in_details FROM conversations")
def details_state(spark, d):
    mark = F.when(F.col("turn") == 1, "<details>").when(F.col("turn") == 3, "</details>").otherwise("x")
    t = table(spark, d, "conversations").select("conv_id", "turn", F.col("turn").alias("line_no"), mark.alias("line"))
    return wiki.in_details(t, "conv_id", "line").select("conv_id", "turn", "in_details")


@query("SELECT conv_id, (turn)::BIGINT AS page_ord, turn::VARCHAR AS id, role AS title, text AS content FROM conversations")
def page_json_decode(spark, d):
    page = F.struct(F.struct(F.col("turn").cast("string").alias("id"), F.col("role").alias("title")).alias("page_plan"), F.col("text").alias("content"))
    packed = table(spark, d, "conversations").groupBy("conv_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("turn", page.alias("p")))), lambda x: x["p"])).alias("json"))
    return readers.page_rows(packed, "conv_id", "json").withColumn("page_ord", F.col("page_ord").cast("long"))


@query("SELECT doc_id, doc_id % 3 <> 0 AS valid FROM documents")
def response_validation(spark, d):
    blocks = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("Error fetching wiki for x"))).otherwise(F.array("text"))
    return readers.valid_blocks(table(spark, d, "documents").select("doc_id", blocks.alias("b")), "b", "wiki").select("doc_id", "valid")


@query("SELECT doc_id, text AS block FROM documents WHERE text <> ''")
def text_block_extraction(spark, d):
    payload = F.expr("""concat('{"result":{"content":[{"type":"image","text":"no"},', to_json(named_struct('type', 'text', 'text', text)), ']}}')""")
    return table(spark, d, "documents").select("doc_id", F.explode(readers.text_blocks(payload)).alias("block"))


from . import runs  # noqa: E402, F401  registers the queries of whole runs
