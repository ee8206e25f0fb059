"""Queries of references, hydration, narratives and whole wiki runs. Inputs vary by row, so that every branch has rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import chat, config
from ..functions import text as T
from ..operators import hydrate, inspect, narrate, pipeline, wiki
from ..sources import readers, sinks
from .registry import query, s_learn, s_lines, s_strip, s_summary, table


def spark_sql(x: str) -> str:
    """An expression that both engines know, but for the name of one function."""
    return x.replace("chr(10)", "char(10)")


def expr(x: str):
    return F.expr(spark_sql(x))


# --- merging and templates -------------------------------------------------------------------------------------------

_REF = "p_brand || '.py'"
_SEEN = f"CASE p_partkey % 3 WHEN 0 THEN 'nothing ' ELSE 'see ' || {_REF} || ' and ' || {_REF} END"
_MERGED = f"CASE p_partkey % 3 WHEN 0 THEN 'nothing' || chr(10) || chr(10) || {_REF} || chr(10) || p_type ELSE 'see ' || {_REF} || chr(10) || p_type || ' and ' || {_REF} END"


def _blocks():
    block = lambda r, c: F.struct(r.alias("reference"), c.alias("code"))
    return F.array(block(expr(_REF), F.concat(F.lit(" "), F.col("p_type"))), block(F.lit("zz.py"), F.when(F.col("p_size") % 2 == 0, "Q")), block(F.lit("README.md"), F.lit("no")), block(F.lit(" "), F.lit("no")))


@query(f"""SELECT p_partkey, {_MERGED} || CASE p_size % 2 WHEN 0 THEN chr(10) || chr(10) || 'zz.py' || chr(10) || 'Q' ELSE '' END AS merged, CASE p_partkey % 3 WHEN 0 THEN 0 ELSE 1 END AS matched,
  CASE p_partkey % 3 WHEN 0 THEN '' ELSE {_REF} END AS refs FROM part""")
def merge_first_occurrence(spark, d):
    m = table(spark, d, "part").select("p_partkey", T.merge_code(expr(_SEEN), _blocks()).alias("m"))
    return m.select("p_partkey", F.col("m.text").alias("merged"), F.col("m.matched").alias("matched"), F.array_join("m.refs", ",").alias("refs"))


@query("SELECT count(*) AS records, sum(3 + (p_size % 2 = 0)::INT)::BIGINT AS code_blocks, sum((p_partkey % 3 <> 0)::INT)::BIGINT AS matched FROM part")
def merge_statistics(spark, d):
    return inspect.merge_statistics(table(spark, d, "part"), expr(_SEEN), _blocks())


@query(f"SELECT p_partkey, '# ' || p_brand || ' :: ' || p_type || chr(10) || {_MERGED} || CASE p_size % 2 WHEN 0 THEN chr(10) || chr(10) || 'zz.py' || chr(10) || 'Q' ELSE '' END AS shown FROM part")
def merged_texts(spark, d):
    m = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("page"), F.col("p_type").alias("section"), T.merge_code(expr(_SEEN), _blocks())["text"].alias("text"))
    return m.select("p_partkey", sinks.merged_text().alias("shown"))


_USED = "CASE p_size % 3 WHEN 0 THEN 'a.py, ' || p_brand WHEN 1 THEN p_brand ELSE '' END"
_INTENT = "CASE p_size % 4 WHEN 0 THEN '' ELSE 'to ' || p_type END"
_PY = "'```python' || chr(10) || 'x = ' || p_size || chr(10) || '```'"
_NO_CODE = "'[error] Failed to build ' || m || ' narrative: ''NoneType'' object has no attribute ''rstrip'''"


@query(f"""SELECT p_partkey, m AS mode, CASE m
  WHEN 'code' THEN CASE WHEN p_partkey % 7 = 0 THEN {_NO_CODE} ELSE 'In the r repository, consider the following component.' || chr(10) || chr(10) || 'File: ' || p_name || '.py'
    || CASE WHEN {_INTENT} <> '' THEN chr(10) || chr(10) || 'Design intent: ' || {_INTENT} ELSE '' END || chr(10) || chr(10) || {_PY} || chr(10) || chr(10) || 's1'
    || chr(10) || chr(10) || CASE WHEN {_USED} <> '' THEN 'Continue with: ' || {_USED} || '.' ELSE 'This component integrates with other modules in the repository.' END END
  WHEN 'structure' THEN 'The training pipeline relies on a shared data structure.' || chr(10) || chr(10) || p_name || ' acts as the central interface between rollout and training stages.' || chr(10)
    || CASE WHEN {_USED} <> '' THEN 'It connects the following components: ' || {_USED} || '.' ELSE 'It connects several components across the repository.' END
  WHEN 'comment' THEN CASE WHEN p_partkey % 7 = 0 THEN {_NO_CODE} ELSE CASE WHEN {_INTENT} <> '' THEN {_INTENT} ELSE 'a ' || p_brand END || chr(10) || chr(10) || {_PY} END
  ELSE p_name || ' appears across multiple modules.' || chr(10) || chr(10) || 'Definition: ' || p_name || '.py' || chr(10) || 'Design intent: ' || CASE WHEN {_INTENT} <> '' THEN {_INTENT} ELSE 'a ' || p_brand END
    || chr(10) || 'Follow-on topics: ' || CASE WHEN {_USED} <> '' THEN {_USED} ELSE '(not detected)' END || '.' || chr(10) || chr(10) || 's1' END AS narrative
  FROM part, (SELECT unnest(['code', 'structure', 'comment', 'cross']) AS m)""")
def narratives_by_mode(spark, d):
    used = F.expr("CASE p_size % 3 WHEN 0 THEN array('a.py', '', p_brand) WHEN 1 THEN array(p_brand) ELSE array() END")
    code = F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit("x = "), F.col("p_size").cast("string"), F.lit("\n")))
    items = table(spark, d, "part").select(
        "p_partkey", F.lit("r").alias("repo"), F.concat("p_name", F.lit(".py")).alias("file"), F.col("p_name").alias("symbol"), code.alias("code"), F.when(F.col("p_size") % 4 != 0, F.concat(F.lit("to "), "p_type")).alias("design_intent"),
        F.concat(F.lit("a "), "p_brand").alias("summary"), F.array(F.lit("s1")).alias("design_sources"), used.cast("array<string>").alias("used_by"),
    )
    return narrate.build_narratives(items, ["all"]).select("p_partkey", "mode", "narrative")


# --- references ------------------------------------------------------------------------------------------------------

_SPOT = "'src/' || p_size || '.py:' || p_size || '-' || (p_size + 2)"


@query(f"""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN {_SPOT} WHEN 1 THEN 'docs/a.md' WHEN 2 THEN 'b.py:7' WHEN 3 THEN {_SPOT} END AS from_line,
  CASE p_partkey % 6 WHEN 2 THEN 'b.py:7' WHEN 4 THEN {_SPOT} END AS from_code FROM part""")
def labels_inferred(spark, d):
    text = f"""CASE p_partkey % 6 WHEN 0 THEN '- see [x y](z) and [' || {_SPOT} || '](t)' WHEN 1 THEN '**Sources:** docs/a.md; other' WHEN 2 THEN '* b.py:7' WHEN 3 THEN 'in ' || {_SPOT} || ' it is'
      WHEN 4 THEN '```' || chr(10) || 'Source: ' || {_SPOT} || ' x' ELSE 'null' END"""
    got = table(spark, d, "part").select("p_partkey", hydrate.labels(expr(text)).alias("l"))
    return got.select("p_partkey", F.col("l.line").alias("from_line"), F.col("l.code").alias("from_code"))


@query(f"""SELECT p_partkey, CASE p_partkey % 7 WHEN 6 THEN NULL WHEN 3 THEN 'LICENSE' WHEN 4 THEN 'a-b/c.txt' ELSE 'src/' || p_size || '.py' END AS path,
  CASE p_partkey % 7 WHEN 0 THEN p_size WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN p_size END AS first_line,
  CASE p_partkey % 7 WHEN 0 THEN p_size + 2 WHEN 1 THEN 0 WHEN 2 THEN 3 WHEN 3 THEN 80 WHEN 4 THEN 0 WHEN 5 THEN p_size + 2 END AS last_line FROM part""")
def parsed_references(spark, d):
    text = f"""CASE p_partkey % 7 WHEN 0 THEN {_SPOT} WHEN 1 THEN './src/' || p_size || '.py' WHEN 2 THEN '- Source: src/' || p_size || '.py:3' WHEN 3 THEN 'LICENSE' WHEN 4 THEN '[a-b/c.txt]()'
      WHEN 5 THEN 'x [y z] then ' || {_SPOT} || ' end' ELSE '-- no path here' END"""
    got = table(spark, d, "part").select("p_partkey", hydrate.parse_reference(expr(text)).alias("r"))
    return got.select("p_partkey", F.col("r.path").alias("path"), F.col("r.start").alias("first_line"), F.col("r.end").alias("last_line"))


@query("""SELECT conv_id, turn, unnest(['a', 'b[0]', 'b[1].c']) AS path, unnest([role, text, conv_id || ' x']) AS value FROM conversations WHERE turn % 5 <> 4""")
def json_string_walk(spark, d):
    value = F.expr("concat('{\"a\": ', to_json(cast(role as variant)), ', \"n\": 1, \"b\": [', to_json(cast(text as variant)), ', {\"c\": \"', conv_id, ' x\"}]}')")
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 5 != 4, value).otherwise(F.lit("no json")).alias("j"))
    return rows.select("conv_id", "turn", F.inline(hydrate.json_strings("j")))


@query("SELECT p_partkey, '{\"a\": [\"see ' || p_name || '\", 1, {\"b\": \"' || p_brand || '\"}]}' AS bare FROM part")
def json_links_stripped(spark, d):
    text = "'{\"a\":[\"see [ ' || p_name || '](x)\",1,{\"b\":\"![' || p_brand || '](y.png)\"}]}'"
    return table(spark, d, "part").select("p_partkey", hydrate.json_without_links(expr(text)).alias("bare"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{\"id\": ' || event_id || '}' WHEN 1 THEN '{\"id\": ' || event_id || ', \"a\": \"x y\"}' WHEN 2 THEN '[' || event_id || ']' END AS message FROM events")
def event_stream_messages(spark, d):
    text = """CASE event_id % 4 WHEN 0 THEN ': hello' || chr(10) || 'event: message' || chr(10) || 'data: {"id":' || chr(10) || 'data:  ' || event_id || '}' || chr(10) || 'data: {"id": 0}'
      WHEN 1 THEN 'id: 4' || chr(10) || 'data: {"id": ' || event_id || ', "a": "x' || chr(10) || 'data:  y"}' || chr(10) || 'event: close'
      WHEN 2 THEN 'data: [' || chr(10) || event_id || chr(10) || 'data: ]' ELSE 'event: close' || chr(10) || 'data: {}' END"""
    return table(spark, d, "events").select("event_id", hydrate.first_event(expr(text)).alias("message"))


@query("SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL WHEN 3 THEN 'a' || event_id || 'b' ELSE 't' || event_id END AS content FROM events")
def chat_contents(spark, d):
    text = """CASE event_id % 5 WHEN 0 THEN '{"choices":[{"message":{"content":"t' || event_id || '"}}]}' WHEN 1 THEN '{"choices":[{"message":{"content":null},"delta":{"content":"t' || event_id || '"}}]}'
      WHEN 2 THEN '{"choices":[{"text":""},{"output":{"value":"t' || event_id || '"}}]}' WHEN 3 THEN '{"choices":[{"message":{"content":[{"type":"text","text":"a' || event_id || '"},"b",null]}}]}' ELSE '{"choices":[]}' END"""
    return table(spark, d, "events").select("event_id", hydrate.chat_content(expr(text)).alias("content"))


@F.pandas_udf(StructType([StructField("hint", StringType()), StructField("detail", StringType())]))
def _bad_request(body: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([chat.bad_request(b) for b in body], columns=["hint", "detail"])


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'context length exceeded (context_length_exceeded)' WHEN 1 THEN 'probable max_tokens limit' WHEN 2 THEN 'probable context length limit' WHEN 3 THEN 'odd' ELSE 'cause unknown' END AS hint,
  CASE event_id % 5 WHEN 0 THEN 'm' || event_id WHEN 1 THEN 'too many tokens ' || event_id WHEN 2 THEN 'Context of ' || event_id || ' token' WHEN 3 THEN 'x' ELSE '<empty response body>' END AS detail FROM events""")
def bad_request_hints(spark, d):
    text = """CASE event_id % 5 WHEN 0 THEN '{"error":{"message":"m' || event_id || '","code":"context_length_exceeded"}}' WHEN 1 THEN '{"error":{"message":"too many tokens ' || event_id || '"}}' WHEN 2 THEN 'Context of ' || event_id || ' token'
      WHEN 3 THEN '{"error":{"message":"x","type":"odd "}}' ELSE ' ' END"""
    got = table(spark, d, "events").select("event_id", _bad_request(expr(text)).alias("h"))
    return got.select("event_id", "h.hint", "h.detail")


@F.pandas_udf(StringType())
def _endpoint(url: pd.Series) -> pd.Series:
    return pd.Series([config.endpoint(u, "::1", 80, "/v1/c") for u in url], dtype=object)


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'http://h' || p_size || '/v1/c' WHEN 1 THEN 'https://h:' || p_size || '/x' WHEN 2 THEN 'http://[::1]:80/p' || p_size WHEN 3 THEN 'http://h/y' END AS endpoint FROM part")
def endpoint_urls(spark, d):
    text = "CASE p_partkey % 5 WHEN 0 THEN ' h' || p_size || '/' WHEN 1 THEN 'https://h:' || p_size || '/x/?q=1#f' WHEN 2 THEN 'http:///p' || p_size WHEN 3 THEN 'h/y//' ELSE ' ' END"
    return table(spark, d, "part").select("p_partkey", _endpoint(expr(text)).alias("endpoint"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'a' || chr(10) || '\"' || p_name WHEN 1 THEN '\"' || p_name ELSE ' ' || p_name || ',' END AS text FROM part")
def page_text_decode(spark, d):
    text = "CASE p_partkey % 3 WHEN 0 THEN ' \"a' || char(92) || 'n' || char(92) || '\"' || p_name || '\" , ' WHEN 1 THEN '\"' || p_name ELSE ' ' || p_name || ',' END"
    return table(spark, d, "part").select("p_partkey", readers.decode_page_text(F.expr(text)).alias("text"))


@query("""SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'a' || chr(10) || role || chr(10) || 'b' ELSE {0} END AS text, CASE turn % 3 WHEN 0 THEN 'graph ' || conv_id END AS mermaid FROM conversations""".replace("{0}", s_strip("text")))
def mermaid_blocks(spark, d):
    text = "CASE turn % 3 WHEN 0 THEN 'a' || chr(10) || '```Mermaid' || chr(10) || ' graph ' || conv_id || chr(10) || '```' || role || chr(10) || 'b```mermaid' || chr(10) || 'x```' ELSE text END"
    m = table(spark, d, "conversations").select("conv_id", "turn", T.mermaid(expr(text)).alias("m"))
    return m.select("conv_id", "turn", F.col("m.text").alias("text"), F.col("m.mermaid").alias("mermaid"))


_CITED = "CASE turn % 4 WHEN 0 THEN '**Sources:** [src/' || turn || '.py:3-4](), [b.md]()' WHEN 1 THEN '<details>' || chr(10) || '- [src/' || turn || '.py:9](x)' || chr(10) || '</details>' WHEN 2 THEN 'as [Source: c.py:5-' || (turn + 5) || '] says' ELSE '**sources:** [d.py:1]()' END"


@query("""SELECT conv_id, turn, unnest(l) AS label, unnest(p) AS path, unnest(a) AS first_line, unnest(b) AS last_line, k AS page_line, context FROM (SELECT conv_id, turn, CASE turn % 4 WHEN 1 THEN '<details>' ELSE role END AS context,
  CASE turn % 4 WHEN 0 THEN ['src/' || turn || '.py:3-4', 'b.md'] WHEN 1 THEN ['src/' || turn || '.py:9'] ELSE ['Source: c.py:5-' || (turn + 5)] END AS l, CASE turn % 4 WHEN 0 THEN ['src/' || turn || '.py', 'b.md'] WHEN 1 THEN ['src/' || turn || '.py'] ELSE ['c.py'] END AS p,
  CASE turn % 4 WHEN 0 THEN [3, 1] WHEN 1 THEN [9] ELSE [5] END::BIGINT[] AS a, CASE turn % 4 WHEN 0 THEN [4, 80] WHEN 1 THEN [9] ELSE [turn + 5] END::BIGINT[] AS b, CASE turn % 4 WHEN 1 THEN 4 ELSE 3 END::BIGINT AS k
  FROM conversations WHERE turn % 4 <> 3)""")
def citation_facts(spark, d):
    text = expr(f"role || chr(10) || chr(10) || {_CITED} || chr(10) || 'below'")
    c = table(spark, d, "conversations").select("conv_id", "turn", F.inline(hydrate.citations(text)))
    return c.select("conv_id", "turn", "label", "path", F.col("start").alias("first_line"), F.col("end").alias("last_line"), "page_line", "context")


@query("""SELECT conv_id, turn, unnest(CASE turn % 3 WHEN 0 THEN [role || ' text'] WHEN 1 THEN [role || ' text', 'between'] ELSE [] END) AS explanation,
  unnest(CASE turn % 3 WHEN 0 THEN ['x = ' || turn] WHEN 1 THEN ['x = ' || turn, 'y'] ELSE [] END) AS code, unnest(CASE turn % 3 WHEN 0 THEN ['python'] WHEN 1 THEN ['python', 'text'] ELSE [] END) AS language FROM conversations""")
def fenced_blocks(spark, d):
    first = "role || ' text' || chr(10) || '```Python' || chr(10) || 'x = ' || turn || chr(10) || '```' || chr(10)"
    text = expr(f"CASE turn % 3 WHEN 0 THEN {first} WHEN 1 THEN {first} || 'between' || chr(10) || '```' || chr(10) || 'y' || chr(10) || '```' ELSE role || chr(10) || '```' || chr(10) || chr(10) || '```' END")
    return table(spark, d, "conversations").select("conv_id", "turn", F.inline(hydrate.split_blocks(text))).select("conv_id", "turn", "explanation", "code", "language")


@query("SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'src/' || turn || '.py:1,docs/x.md' WHEN 1 THEN 'a/b.py,src/' || turn || '.py:1' ELSE 'e/f.py:2' END AS sources FROM conversations")
def section_source_labels(spark, d):
    text = expr("""CASE turn % 3 WHEN 0 THEN '**SOURCES:** [src/' || turn || '.py:1](), [docs/x.md]()' || chr(10) || '**Sources:** src/' || turn || '.py:1; ??'
      WHEN 1 THEN '**Sources:** a/b.py, src/' || turn || '.py:1, a/b.py' ELSE '- [no/no.py:1]()' || chr(10) || '<details>' || chr(10) || '- [e/f.py:2]()' || chr(10) || '</details>' END""")
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(hydrate.section_sources(text), ",").alias("sources"))


@query("""SELECT conv_id, turn, unnest(CASE turn % 3 WHEN 0 THEN ['a/1.py:1', 'a/2.py:2'] WHEN 1 THEN ['k.py:4'] ELSE ['z/w.py'] END) AS label, unnest(CASE turn % 3 WHEN 0 THEN ['one', 'two'] WHEN 1 THEN [role] ELSE ['# z/w.py' || chr(10) || 'z/w.py x'] END) AS code FROM conversations""")
def marker_code_blocks(spark, d):
    text = expr("""CASE turn % 3 WHEN 0 THEN '**Sources:** [a/1.py:1](), [a/2.py:2]()' || chr(10) || '```' || chr(10) || 'one' || chr(10) || '```' || chr(10) || '```' || chr(10) || 'never' || chr(10) || '```' || chr(10) || '**Sources:** [a/3.py:3]()' || chr(10) || '```' || chr(10) || 'two' || chr(10) || '```'
      WHEN 1 THEN 'see k.py:4' || chr(10) || '**Sources:**' || chr(10) || '```py' || chr(10) || role || chr(10) || '```' ELSE '**Sources:**' || chr(10) || '```' || chr(10) || '# z/w.py' || chr(10) || 'z/w.py x' || chr(10) || '```' END""")
    return table(spark, d, "conversations").select("conv_id", "turn", F.inline(hydrate.code_blocks(text))).select("conv_id", "turn", "label", "code")


# --- hydration -------------------------------------------------------------------------------------------------------

_FILE = "src/' || turn || '.py"
_CITING = f"""CASE turn % 8 WHEN 0 THEN 'see [{_FILE}:1]()' WHEN 1 THEN 'see [{_FILE}:1-2]()' WHEN 2 THEN 'see [{_FILE}:9]()' WHEN 3 THEN '[all](./{_FILE})' WHEN 4 THEN '- {_FILE}:2'
  WHEN 5 THEN '```' || chr(10) || '{_FILE}:1' || chr(10) || '- {_FILE}:2' || chr(10) || '```' WHEN 6 THEN '<details>[{_FILE}:1]()</details>' ELSE '[x](http://a.b) [y](no/file.py)' END"""
_NL = "' || chr(10) || '"


def _fence(head: str, *body: str) -> str:
    return f"'{head}{_NL}```python{_NL}' || " + " || chr(10) || ".join(body) + f" || '{_NL}{_NL}```'"


@query(f"""SELECT conv_id, turn, CASE turn % 8 WHEN 0 THEN {_fence(f'see {_FILE}:1', 'role')} WHEN 1 THEN {_fence(f'see {_FILE}:1-2', 'role', "'second'")} WHEN 2 THEN 'see {_FILE}:9'
  WHEN 3 THEN {_fence(_FILE, 'role', "'second'")} WHEN 4 THEN '- {_FILE}:2' || chr(10) || {_fence(f'{_FILE}:2', "'second'")}
  WHEN 5 THEN '```{_NL}' || role || '{_NL}{_NL}' || role || '{_NL}```python{_NL}' || role || '{_NL}```{_NL}second{_NL}{_NL}second{_NL}```python{_NL}second{_NL}```{_NL}{_NL}```'
  WHEN 6 THEN '<details>[{_FILE}:1]()</details>' ELSE '[x](http://a.b) [y](no/file.py)' END AS text FROM conversations""")
def hydrated_sections(spark, d):
    c = table(spark, d, "conversations")
    files = c.select(F.col("conv_id").alias("repo"), expr(f"'{_FILE}'").alias("path"), F.expr("concat(role, char(10), 'second')").alias("text"))
    secs = c.select("conv_id", "turn", F.col("conv_id").alias("repo"), expr(_CITING).alias("text"))
    return hydrate.hydrate_sections(secs, files, ["conv_id", "turn"], "text").select("conv_id", "turn", "text")


def s_rstrip(x: str) -> str:
    return rf"nullif(regexp_replace({x}, '\s+$', ''), '')"


@query(f"SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN {s_rstrip(s_lines('text') + '[1]')} WHEN 1 THEN {s_rstrip('text')} END AS snippet FROM conversations")
def file_snippets(spark, d):
    start, end = F.when(F.col("turn") % 3 == 2, 100_000).otherwise(1), F.when(F.col("turn") % 3 == 1, 0).when(F.col("turn") % 3 == 0, 1).otherwise(100_002)
    return table(spark, d, "conversations").select("conv_id", "turn", hydrate.snippet(F.col("text"), start, end).alias("snippet"))


# --- narratives ------------------------------------------------------------------------------------------------------


def s_stub(subject: str, first: str | None = None) -> str:
    """The fixed narrative, from the same words as the column: its parts are those of a stub about a name that is cut out."""
    head = f"'Before writing it, here is how ' || {subject} || ' fits together. Callers already rely on what surrounds it, so it must fit in without breaking them. The limits come first, then what can wait, and the risky parts last, with a check for each way to fail.'"
    return head if first is None else f"{head} || CASE WHEN {first} IS NULL THEN '' ELSE ' The centre is likely `' || {first} || '`, whose inputs and effects need a check.' END"


_PASS = f"'{narrate.NO_CRITIC}'"
_CODE_TEXT = "'intro. ' || text || chr(10) || '**Sources:** [src/a.py:' || turn || '-' || (turn + 2) || ']()' || chr(10) || '```python' || chr(10) || CASE WHEN turn % 3 = 0 THEN '' ELSE '# note' || chr(10) || 'total = ' || turn END || chr(10) || '```'"
_HAS = "turn % 3 <> 0"
_STUB = f"CASE WHEN {_HAS} THEN {s_stub('role', repr('total = ') + ' || turn')} ELSE {s_stub('role')} END"
_FULL = f"{_STUB} || CASE WHEN {_HAS} THEN chr(10) || chr(10) || 'With that plan the code goes into src/a.py:' || turn || '-' || (turn + 2) || ':' || chr(10) || '# note' || chr(10) || 'total = ' || turn ELSE '' END"


def _records(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.col("conv_id").cast("string").alias("page"), F.col("role").alias("section"), expr(_CODE_TEXT).alias("text"))
    return narrate.narrate(c.withColumn("code_blocks", hydrate.code_blocks("text")), ["conv_id", "turn"])


@query(f"""SELECT conv_id, turn, {_FULL} AS narrative, {_PASS} AS critic, 'PASS' AS verdict, 'none' AS misalignment, {s_learn('(' + _STUB + ')')} AS learnability, {_PASS} AS history,
  CASE WHEN {_HAS} THEN 'src/a.py:' || turn || '-' || (turn + 2) END AS reference, CASE WHEN {_HAS} THEN '# note' || chr(10) || 'total = ' || turn END AS code FROM conversations""")
def narrative_records(spark, d):
    first = F.get("code_blocks", F.lit(0))
    return _records(spark, d).select("conv_id", "turn", "narrative", "critic", "verdict", "misalignment", "learnability", F.array_join("critic_history", "|").alias("history"), first["reference"].alias("reference"), first["code"].alias("code"))


@query(f"""SELECT conv_id, turn, '# ' || conv_id || ' :: ' || role || chr(10) || chr(10) || 'Narrative:' || chr(10) || {_FULL} || chr(10) || chr(10) || 'Critic:' || chr(10) || {_PASS} || chr(10) || chr(10)
  || 'Metadata:' || chr(10) || 'verdict=PASS misalignment=none learnability=' || {s_learn('(' + _STUB + ')')}::VARCHAR AS text FROM conversations""")
def narrative_text(spark, d):
    return _records(spark, d).select("conv_id", "turn", sinks.narrative_text(True).alias("text"))


def _writer(task: str, parts: dict) -> str:
    """A stand-in for a model: it shows which parts it got, fails on one kind of row and says nothing on another."""
    if parts["text"].startswith("5"):
        raise ConnectionError("no model")
    if task == "rewrite_section":
        return "" if parts["text"].startswith("4") else f" draft {parts['section']}\nSource: hidden"
    return f"{parts['narrative']} +{parts['misalignment']}"


def _critic(task: str, parts: dict) -> str:
    kind = parts["text"][:1]
    if kind == "3":
        raise ConnectionError("no critic")
    if kind == "2":
        return "hm"
    return "FAIL\nmissing intent" if kind == "1" and parts["narrative"].count("+") < 2 else "pass fine"


_KIND = "(conv_id + turn) % 6"
_SKETCH = s_stub("role")


@query(f"""SELECT conv_id, turn, CASE {_KIND} WHEN 1 THEN 'draft ' || role || ' +code_without_purpose +code_without_purpose' WHEN 2 THEN 'draft ' || role || ' +none +none' WHEN 3 THEN 'draft ' || role || ' +intent_code_mismatch +intent_code_mismatch' WHEN 0 THEN 'draft ' || role ELSE {_SKETCH} END AS narrative,
  CASE {_KIND} WHEN 2 THEN 'UNKNOWN' WHEN 3 THEN 'FAIL' ELSE 'PASS' END AS verdict, CASE {_KIND} WHEN 3 THEN 'intent_code_mismatch' ELSE 'none' END AS misalignment,
  CASE {_KIND} WHEN 1 THEN 'missing intent|missing intent|fine' WHEN 2 THEN 'hm|hm|hm' WHEN 3 THEN 'Critic inference failed; please review manually.|Critic inference failed; please review manually.|Critic inference failed; please review manually.' ELSE 'fine' END AS history FROM conversations""")
def narrative_loop(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.lit("p").alias("page"), F.col("role").alias("section"), expr(f"cast({_KIND} as string)").alias("text"))
    c = c.withColumn("code_blocks", hydrate.code_blocks(F.lit("")))
    return narrate.narrate(c, ["conv_id", "turn"], _writer, _critic, 3).select("conv_id", "turn", "narrative", "verdict", "misalignment", F.array_join("critic_history", "|").alias("history"))


@query(f"""SELECT p_partkey, {s_stub("CASE p_partkey % 2 WHEN 0 THEN p_name ELSE 'this ' || CASE p_size % 2 WHEN 0 THEN 'python' ELSE 'code' END || ' change' END", "CASE p_size % 3 WHEN 0 THEN NULL ELSE 'x = ' || p_size END")} AS rewrite,
  'PASS' AS verdict, {_PASS} AS critic, CASE p_size % 3 WHEN 0 THEN '' ELSE 'x' END AS anchors FROM part""")
def block_results(spark, d):
    b = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("explanation"), F.when(F.col("p_size") % 2 == 0, "python").otherwise("").alias("language"), expr("CASE p_size % 3 WHEN 0 THEN '# only a note' ELSE '# note' || chr(10) || '  x = ' || p_size END").alias("code"), F.lit(None).cast("string").alias("mermaid"))
    return narrate.narrate_blocks(b, ["p_partkey"]).select("p_partkey", "rewrite", "verdict", "critic", F.array_join("scaffold.code_anchors", ",").alias("anchors"))


@query(f"SELECT conv_id, turn, coalesce(nullif({s_summary('CASE turn % 3 WHEN 0 THEN NULL ELSE text END')}, ''), role) AS summary FROM conversations")
def page_summaries(spark, d):
    pages = table(spark, d, "conversations").withColumn("body", F.when(F.col("turn") % 3 != 0, F.col("text")))
    return narrate.summarise_pages(pages, "role", "body").select("conv_id", "turn", "summary")


@query("SELECT p_partkey, '```' || CASE p_size % 2 WHEN 0 THEN 'go' ELSE 'text' END || chr(10) || p_name || chr(10) || '```' || CASE p_size % 3 WHEN 0 THEN chr(10) || chr(10) || '```sql' || chr(10) || 'b' || chr(10) || '```' ELSE '' END AS joined FROM part")
def joined_code_blocks(spark, d):
    block = lambda l, c: F.struct(c.alias("code"), l.alias("language"))  # noqa: E731, E741
    blocks = F.array(block(F.when(F.col("p_size") % 2 == 0, "go"), F.concat("p_name", F.lit("\n"))), block(F.lit("x"), F.lit(" ")), block(F.lit("sql"), F.when(F.col("p_size") % 3 == 0, "b").otherwise("")))
    return table(spark, d, "part").select("p_partkey", narrate.joined_code(blocks).alias("joined"))


@query("SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE text <> '') AS text FROM conversations GROUP BY conv_id")
def concatenated_texts(spark, d):
    return sinks.concatenated(table(spark, d, "conversations"), "conv_id", "text", "turn")


@query(f"""SELECT conv_id, turn, repeat('=', 72) || chr(10) || conv_id || ' :: ' || role || chr(10) || 'Verdict: PASS | Misalignment: none' || chr(10) || 'Critic: ' || {_PASS} || chr(10) || chr(10) || 'Narrative:' || chr(10) || ' ' || {_FULL}
  || CASE WHEN {_HAS} THEN chr(10) || chr(10) || 'Code 1 [src/a.py:' || turn || '-' || (turn + 2) || ']:' || chr(10) || '```' || chr(10) || '# note' || chr(10) || 'total = ' || turn || chr(10) || '```' ELSE '' END || chr(10) AS shown FROM conversations""")
def inspected_records(spark, d):
    return _records(spark, d).select("conv_id", "turn", inspect.shown(True).alias("shown"))


# --- whole runs ------------------------------------------------------------------------------------------------------

_TITLE = "'Talk ' || conv_id"


def _wiki_rows(spark, d):
    """A wiki row for each conversation: a page with a section a turn, one with a repeated heading, and some that are broken."""
    c = table(spark, d, "conversations")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.expr("concat('## ', role, ' ', turn, char(10), text)").alias("s")))), lambda x: x["s"]), "\n")
    g = c.groupBy("conv_id").agg(body.alias("body"))
    page = lambda i, title, content: F.struct(F.struct(F.lit(i).alias("id"), title.alias("title")).alias("page_plan"), content.alias("content"))
    pages = F.to_json(F.array(page("1", expr(_TITLE), F.col("body")), page("", F.lit(" "), F.lit("no title")), page("2", F.lit("Notes"), F.lit("first\n## A\none\n## a\ntwo"))))
    content = F.when(F.col("conv_id") % 10 == 3, "oops").when(F.col("conv_id") % 10 == 4, "[]").when(F.col("conv_id") % 10 == 5, "[1]").otherwise(pages)
    return g.select(F.concat(F.lit(" r"), "conv_id").alias("repo_name"), content.alias("content"), F.lit(None).cast("string").alias("hdfs_path"))


def _targets(spark, d):
    c = table(spark, d, "conversations").select("conv_id").distinct()
    return c.select(F.expr("concat('r', conv_id)").alias("repo"), F.lit(None).cast("string").alias("commit")).unionByName(c.where("conv_id % 20 = 0").select(F.expr("concat('gone', conv_id)").alias("repo"), F.lit("abc").alias("commit")))


_GOOD = "conv_id % 10 NOT IN (3, 4, 5)"


@query("""SELECT 'r' || conv_id AS repo, CASE conv_id % 10 WHEN 3 THEN 'the content is no JSON' WHEN 4 THEN 'the content is no list of pages, or an empty one' ELSE 'no page of the content has a title' END AS error FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 10 IN (3, 4, 5)
  UNION ALL SELECT 'gone' || conv_id, 'no wiki row is called gone' || conv_id FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 20 = 0""")
def wiki_run_errors(spark, d):
    return pipeline.run_wiki(_targets(spark, d), _wiki_rows(spark, d)).errors


def s_wiki_sections() -> str:
    """repo, page_ord, section_ord, page, section, text of the pages of the rows above."""
    return f"""(SELECT 'r' || conv_id AS repo, 0 AS page_ord, 0 AS section_ord, {_TITLE} AS page, {_TITLE} AS section, '' AS text FROM (SELECT DISTINCT conv_id FROM conversations) WHERE {_GOOD}
      UNION ALL SELECT 'r' || conv_id, 0, row_number() OVER (PARTITION BY conv_id ORDER BY turn), {_TITLE}, role || ' ' || turn, {s_strip('text')} FROM conversations WHERE {_GOOD}
      UNION ALL SELECT 'r' || conv_id, 1, unnest([0, 1]), 'Notes', unnest(['Notes', 'A']), unnest(['first', 'one' || chr(10) || chr(10) || 'two']) FROM (SELECT DISTINCT conv_id FROM conversations) WHERE {_GOOD})"""


_SEC_STUB = s_stub("section")


@query(f"SELECT repo, page_ord, section_ord, page, section, text AS original_context, {_SEC_STUB} AS narrative, 'PASS' AS verdict, {s_learn('(' + _SEC_STUB + ')')} AS learnability FROM {s_wiki_sections()}")
def wiki_run_subsections(spark, d):
    s = pipeline.run_wiki(_targets(spark, d), _wiki_rows(spark, d)).subsections
    return s.select("repo", "page_ord", "section_ord", "page", "section", "original_context", "narrative", "verdict", "learnability")


@query(f"""SELECT repo, page_ord, CASE page_ord WHEN 0 THEN 'talk' || substr(repo, 2) ELSE 'notes' END AS label, '[Page] ' || page || chr(10) || chr(10) || string_agg('[Section] ' || section
  || CASE WHEN text <> '' THEN chr(10) || chr(10) || 'Original Context:' || chr(10) || text ELSE '' END || chr(10) || chr(10) || 'Narrative:' || chr(10) || {_SEC_STUB} || chr(10) || chr(10) || 'Critic:' || chr(10) || {_PASS}
  || chr(10) || chr(10) || 'Metadata: verdict=PASS misalignment=none learnability=' || printf('%.3f', {s_learn('(' + _SEC_STUB + ')')}) || chr(10) || 'critic_history=[''' || {_PASS} || ''']', chr(10) || chr(10) ORDER BY section_ord) AS text FROM {s_wiki_sections()} GROUP BY repo, page_ord, page""")
def wiki_run_chunks(spark, d):
    return pipeline.run_wiki(_targets(spark, d), _wiki_rows(spark, d)).chunks


@query("""SELECT count(*) AS n_failed, 'Failed to process repositories: ' || string_agg(repo, ', ' ORDER BY repo) AS message FROM (SELECT 'r' || conv_id AS repo FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 10 IN (3, 4, 5)
  UNION ALL SELECT 'gone' || conv_id FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 20 = 0)""")
def wiki_run_failures(spark, d):
    return pipeline.failures_text(pipeline.run_wiki(_targets(spark, d), _wiki_rows(spark, d)).errors)


def _documents(spark, d):
    good = readers.index_targets(_targets(spark, d), _wiki_rows(spark, d)).select("repo", readers.wiki_texts(F.col("content")).alias("w")).select("repo", "w.*").where("error is null and markdown is not null")
    # an item without a page, which has items below it, and an item that comes twice
    more = F.concat(F.lit("- Missing\n  "), F.replace(F.col("outline"), F.lit("\n"), F.lit("\n  ")), F.lit("\n- Notes"))
    return good.select("repo", more.alias("outline"), "markdown")


@query(f"""SELECT repo, '# Wiki Structure' || chr(10) || '- Missing' || chr(10) || '  - 1 ' || any_value(page) FILTER (WHERE page_ord = 0) || chr(10) || '  - 2 Notes' || chr(10) || '- Notes' || chr(10)
  || string_agg('# ' || page || CASE WHEN section = page THEN ' :: Introduction' ELSE ' :: ' || section END || chr(10) || text, chr(10) ORDER BY page_ord, section_ord) FILTER (WHERE text <> '') AS document FROM {s_wiki_sections()} GROUP BY repo""")
def hydrated_documents(spark, d):
    return pipeline.hydrated_document(_documents(spark, d))


@query(f"SELECT 'r' || conv_id AS repo, 'Missing' AS node, NULL AS page FROM (SELECT DISTINCT conv_id FROM conversations) WHERE {_GOOD} UNION ALL SELECT 'r' || conv_id, unnest([{_TITLE}, 'Notes']), unnest([{_TITLE}, 'Notes']) FROM (SELECT DISTINCT conv_id FROM conversations) WHERE {_GOOD}")
def outline_page_join(spark, d):
    docs = _documents(spark, d)
    entries = pipeline.page_entries(wiki.outline(docs, "repo", "outline"))
    pages, missing = pipeline.join_pages(entries, wiki.sections(docs, "repo", "markdown"), "skip")
    return pages.select("repo", F.col("node_title").alias("node"), F.col("page_title").alias("page")).distinct().unionByName(missing.select("repo", F.regexp_extract("error", "called (.*)", 1).alias("node"), F.lit(None).cast("string").alias("page")))


@query(f"SELECT 'r' || conv_id AS repo, CASE WHEN {_GOOD} THEN '- 1 ' || {_TITLE} || chr(10) || '- 2 Notes' ELSE '' END AS outline FROM (SELECT DISTINCT conv_id FROM conversations)")
def wiki_page_texts(spark, d):
    rows = readers.index_targets(_targets(spark, d), _wiki_rows(spark, d)).where("content is not null")
    return rows.select("repo", readers.wiki_texts(F.col("content"))["outline"].alias("outline"))


@query(f"SELECT conv_id, 'Qqzz' AS name, 'no section is called Qqzz' AS error FROM (SELECT DISTINCT conv_id FROM conversations)")
def unresolved_sections(spark, d):
    c = table(spark, d, "conversations")
    secs = wiki.sections(c.groupBy("conv_id").agg(F.expr("concat('# Page: P', char(10), '## ', max(role), char(10), 'x')").alias("md")), "conv_id", "md")
    names = secs.select("conv_id", F.lit("Qqzz").alias("name")).distinct()
    return wiki.unresolved(names, wiki.resolve_section(names, secs, ["conv_id"], "name"), ["conv_id"], "name")


