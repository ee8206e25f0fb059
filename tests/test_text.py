"""Worked examples of the text rules, and properties of the windows."""

import json
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import references as R
from docloom.functions import text as T
from docloom.operators import hydrate, narrate, wiki
from docloom.sources import readers, sinks
from docloom.streaming import ingest


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [r[0] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_heading_keys(spark):
    assert column(spark, [None, "1.2 Training Loop!", "12.1", "3 Things", "概述", "C++", " C "], T.heading_key) == ["__intro__", "trainingloop", "121", "things", "__intro__", "c", "c"]


def test_clean_lines(spark):
    assert column(spark, ["visit https://x.com/a now", "mail me@x.org", "<b>hi</b> there", "x > y >", "abc.community rest"], T.clean_line) == ["visit now", "mail", "hi there", "", "munity rest"]


def test_learnability(spark):
    w = " word" * 40
    assert column(spark, [" w" * 10, w, w * 2, w * 2 + " ensures pipelines"], T.learnability) == [0.0, 0.2, 0.4, 1.0]


def test_verdicts(spark):
    got = column(spark, ["PASS", "PASS good", "FAIL\nmissing intent", "", '{"verdict":"aligned"}'], T.section_verdict)
    assert [tuple(x)[0] for x in got] == ["PASS", "PASS", "FAIL", "PASS", "UNKNOWN"]
    assert got[0].text == "Narrative follows the expected arc." and got[1].text == "good" and got[2].misalignment == "code_without_purpose" and got[4].text == '{"verdict":"aligned"}'


def test_label_ranges_agree(spark):
    labels = ["a/b.py:10-20", "a/b.py:7", "a/b.py", "Source: x.md", "a.py#L1-L5", "image::foo", " "]
    want = [("a/b.py", 10, 20), ("a/b.py", 7, 7), ("a/b.py", 1, 80), ("x.md", 1, 80), ("a.py#L1-L5", 1, 80), None, None]
    assert [R.label_range(x) for x in labels] == want
    assert [tuple(x) if x else None for x in column(spark, labels, T.label_range)] == want


FILES = {"src/a.py": "\n".join(f"L{i}" for i in range(1, 6)), "src/long.py": "\n".join(f"L{i}" for i in range(1, 101)), "LICENSE": "one\ntwo", "empty.py": ""}


def test_hydration():
    run = lambda t: R.Hydrator(R.FileSnippets(FILES)).run(t)
    assert run("[src/a.py:2-3]()") == "src/a.py:2-3\n```python\nL2\nL3\n\n```"
    assert run("[src/a.py:9-12]()") == "src/a.py:9-12"
    assert "L80\n" in run("[src/long.py]()") and "L81" not in run("[src/long.py]()").split("\n```\n")[0]
    assert "L100" in run("[x](src/long.py)")
    assert run("LICENSE").startswith("LICENSE\nLICENSE:1-80\n```text\none\ntwo")
    assert run("see [x](https://a.b/c) and [y](no.py)") == "see [x](https://a.b/c) and [y](no.py)"
    assert run("<details>[src/a.py:1]()</details>") == "<details>[src/a.py:1]()</details>"
    assert R.snippet(FILES["src/a.py"], 4, 2) == "L4" and R.snippet("", 1, 0) is None
    assert R.parse_reference("../x.py") == ("../x.py", 1, 0) and R.Hydrator(R.FileSnippets({"../x.py": "a"})).get(("../x.py", 1, 0)) is None


def test_hydrated_frame_equals_the_rules(spark):
    files = dict(FILES) | {"src/b.py": "src/a.py:1"}
    texts = ["[src/b.py:1]()", "x", "```\nsrc/a.py:1-2\n```", None]
    fs = spark.createDataFrame([("r", p, t) for p, t in files.items()], "repo string, path string, text string")
    secs = spark.createDataFrame([(i, "r", t) for i, t in enumerate(texts)], "i long, repo string, text string")
    got = {r.i: r.text for r in hydrate.hydrate_sections(secs, fs, ["i"], "text").collect()}
    assert got == {i: R.Hydrator(R.FileSnippets(files)).run(t or "") for i, t in enumerate(texts)}


def test_sections_merge(spark):
    md = "x\n# Page: A\nhello\n## S\nx\n### sub\ny\n## S\nz"
    got = wiki.sections(spark.createDataFrame([(1, md)], "k long, md string"), "k", "md").orderBy("section_ord").collect()
    assert [(r.section_key, r.text) for r in got] == [("__intro__", "hello"), ("s", "x\n### sub\ny\n\nz")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=30))
def test_outline_parent_is_the_stack_parent(spark, levels):
    md = "\n".join("  " * n + f"- {i} t" for i, n in enumerate(levels))
    got = {r.ord: r.parent_ord for r in wiki.outline(spark.createDataFrame([(1, md)], "k long, md string"), "k", "md").collect()}
    stack, want = [], {}
    for i, n in enumerate(levels):
        while stack and stack[-1][0] >= n:
            stack.pop()
        want[i] = stack[-1][1] if stack else None
        stack.append((n, i))
    assert got == want


def test_narrate_loop(spark):
    secs = spark.createDataFrame([(1, "p", "s", "text", [])], "row_id long, page string, section string, text string, code_blocks array<struct<label:string,code:string,language:string,mermaid:string>>")
    writer = lambda task, r: "second" if task == "refine_section" else "first"
    critic = lambda task, r: "PASS fine" if r["narrative"] == "second" else "FAIL\nmissing intent"
    r = narrate.narrate(secs, "row_id", writer, critic, rounds=3).first()
    assert (r.narrative, r.verdict, r.critic, r.critic_history) == ("second", "PASS", "fine", ["missing intent", "fine"])
    assert narrate.narrate(secs, "row_id").first().verdict == "PASS"


def test_json_and_events():
    assert list(R.json_strings({"a": ["x", {"b": "y"}], "c": 1})) == [("a[0]", "x"), ("a[1].b", "y")]
    assert R.first_event('event: message\ndata: {"a":\ndata: 1}\n\n') == {"a": 1}
    with pytest.raises(ValueError):
        R.first_event("event: close\ndata: {}")
    assert R.chat_content({"choices": [{"message": {"content": [{"text": "a"}, "b"]}}]}) == "ab" and R.chat_content({}) is None


def test_sources_and_sinks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("root/src/a.py", "x")
        z.writestr("root/b.md", "y")
    assert sorted((r.path, r.text) for r in readers.zip_files(spark, str(tmp_path / "r.zip")).collect()) == [("b.md", "y"), ("src/a.py", "x")]
    (tmp_path / "co" / "d").mkdir(parents=True)
    (tmp_path / "co" / "d" / "f.txt").write_text("hi\nyou\n")
    assert [(r.path, r.text.rstrip()) for r in readers.repo_files(spark, str(tmp_path / "co"), "r").collect()] == [("d/f.txt", "hi\nyou")]
    (tmp_path / "repos").write_text("# c\na@1, b\n\n")
    assert sorted((r.repo, r.commit) for r in readers.repo_list(spark, str(tmp_path / "repos"), "z").collect()) == [("a", "1"), ("b", "z")]
    pages = json.dumps([{"page_plan": {"id": "1", "title": "T"}, "content": "c"}, 5, {"page_plan": {"title": " "}}])
    wiki_df = spark.createDataFrame([("r", pages, "h")], readers.WIKI)
    wiki_df.write.parquet(str(tmp_path / "w"))
    assert [(r.id, r.title) for r in readers.page_rows(readers.wiki_parts(spark, str(tmp_path / "w")), "repo_name", "content").collect()] == [("1", "T")]
    q = ingest.follow_parts(spark, str(tmp_path / "w"), lambda b: b.select("repo_name"), str(tmp_path / "o"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1
    rec = spark.createDataFrame([("r", "p", "s", "o", "n", "c", "PASS", "none", 0.5, ["h"], [("x.py", "y")])], readers.RECORD)
    sinks.write_narratives(rec, str(tmp_path / "n"))
    assert readers.narratives(spark, str(tmp_path / "n")).count() == 1


def test_narrative_templates(spark):
    from docloom.operators import narrate

    schema = "id int, repo string, file string, symbol string, code string, language string, body string, design_intent string, summary string, design_sources array<string>, used_by array<string>"
    rows = [(1, "r", "a.py", "f", "x = 1\n", None, " b ", "why", "s", ["S1"], ["g", "", "h"]), (2, "r", None, "q", "", "go", None, None, "sum", None, None), (3, "r", "b", "z", None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = {(x.id, x.mode): x.narrative for x in narrate.build_narratives(df, ["code", "all"]).collect()}
    assert len(got) == 12
    assert got[1, "code"] == "In the r repository, consider the following component.\n\nFile: a.py\n\nDesign intent: why\n\nOriginal context:\nb\n\n```python\nx = 1\n```\n\nS1\n\nContinue with: g, h."
    assert got[2, "code"] == "In the r repository, consider the following component.\n\nFile: N/A\n\nThis component integrates with other modules in the repository."
    assert got[1, "structure"].endswith("components: g, h.") and got[2, "comment"] == "sum\n\n```go\n\n```"
    assert got[1, "cross"].endswith("Design intent: why\nFollow-on topics: g, h.\n\nS1") and "Follow-on topics: (not detected)." in got[2, "cross"]
    assert got[3, "code"].startswith("[error] Failed to build code narrative:")
    assert {x.mode for x in narrate.build_narratives(df, ["nope"]).collect()} == {"code"}


def test_hydration_follows_four_files(spark):
    files = {"a.py": "[x](b.py)", "b.py": "c.py:1-1", "c.py": "d.py:1-1", "d.py": "last"}
    text = "[a.py]()"
    want = R.Hydrator(R.FileSnippets(files)).run(text)
    df = spark.createDataFrame([(1, "r", text)], "i int, repo string, text string")
    fs = spark.createDataFrame([("r", k, v) for k, v in files.items()], "repo string, path string, text string")
    assert "last" in want
    assert hydrate.hydrate_sections(df, fs, ["i"], "text").first().text == want
    assert hydrate.hydrate_sections(df, fs, ["i"], "text", rounds=3).first().text != want
