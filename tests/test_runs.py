"""Whole runs, settings, remote sources and sinks: worked examples, odd rows and failures."""

import json
import re
import shutil
import subprocess

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import chat, config
from docloom.functions import references as R
from docloom.functions import text as T
from docloom.operators import hydrate, inspect, narrate, pipeline, wiki
from docloom.sources import readers, remote, sinks


def wiki_rows(spark, pages, repo="a/b"):
    content = json.dumps([{"page_plan": {"id": str(i + 1), "title": t}, "content": c} for i, (t, c) in enumerate(pages)])
    return spark.createDataFrame([(f" {repo} ", content, "h", "p2", 0), (repo, "[]", "h", "p3", 0)], "repo_name string, content string, hdfs_path string, file_path string, file_row long")


def targets(spark, *repos):
    return spark.createDataFrame([(r, None) for r in repos], "repo string, commit string")


def test_run_wiki_hydrates_and_orders(spark):
    rows = wiki_rows(spark, [("One", "intro\n## S\nsee [x.py:1]()\n**Sources:** [x.py:1]()\n```py\ncode\n```"), ("1.1 Two", "t"), ("Three", "u\n## A\nv\n## B\nw")])
    files = spark.createDataFrame([("a/b", "x.py", "L1\nL2"), ("a/b", None, "n"), ("a/b", "y.py", None)], "repo string, path string, text string")
    run = pipeline.run_wiki(targets(spark, "a/b", "a/b", "gone", " ", None), rows, files, skip_pages=["Two"], max_sections=2)
    subs = run.subsections.orderBy("page_ord", "section_ord").collect()
    assert [(x.page, x.section) for x in subs] == [("One", "One"), ("One", "S"), ("Three", "Three"), ("Three", "A")]
    assert "x.py:1\n```python\nL1" in subs[1].original_context and subs[1].code_blocks[0].reference == "x.py:1" and subs[0].critic_history == [narrate.NO_CRITIC]
    chunks = run.chunks.orderBy("page_ord").collect()
    assert [(x.label, x.page_ord) for x in chunks] == [("one", 0), ("three", 1)] and chunks[0].text.startswith("[Page] One\n\n[Section] One\n\nOriginal Context:\nintro\n\nNarrative:\n")
    assert sorted(x.error for x in run.errors.collect()) == ["no wiki row is called gone", "the name of a repository is blank"]
    assert pipeline.failures_text(run.errors).first().n_failed == 2
    assert [x.page for x in pipeline.run_wiki(targets(spark, "a/b"), rows, max_pages=1).subsections.select("page").distinct().collect()] == ["One"]
    empty = pipeline.run_wiki(targets(spark).limit(0), rows, files)
    assert empty.chunks.count() == empty.subsections.count() == empty.errors.count() == 0


def test_missing_pages_fail_or_are_left_out(spark):
    docs = spark.createDataFrame([("r", "- Gone\n  - A\n- a\n- B", "# Page: A\nx\n# Page: B\n\n# Page: A\ny\n## H\n")], "repo string, outline string, markdown string")
    entries, secs = pipeline.page_entries(wiki.outline(docs, "repo", "outline")), wiki.sections(docs, "repo", "markdown")
    assert [(x.node_title, x.entry) for x in entries.orderBy("entry").collect()] == [("Gone", 0), ("A", 1), ("B", 2)]
    pages, missing = pipeline.join_pages(entries, secs, "error")
    assert pages.count() == 0 and missing.first().error == "no page is called Gone"
    assert pipeline.join_pages(entries, secs, "skip")[0].count() == 3
    with pytest.raises(ValueError):
        pipeline.join_pages(entries, secs, "x")
    # the last content of a page at the place of the first; a page whose sections have no text is there as a whole
    assert [(x.page_ord, x.text) for x in secs.where("section_key = '__intro__'").orderBy("page_ord").collect()] == [(0, "y"), (1, "")]
    assert pipeline.hydrated_document(docs).first().document == "# Wiki Structure\n- Gone\n  - A\n- a\n- B\n# A :: Introduction\ny\n# A\ny\n# B"


def test_sections_take_any_key_name(spark):
    for key in ("page", "sec", "line", "s", "heading", "first"):
        got = wiki.sections(spark.createDataFrame([(1, "# Page: A\nx"), (2, None)], f"{key} long, md string"), key, "md").collect()
        assert [(x[key], x.page_title, x.text) for x in got] == [(1, "A", "x")]
        assert wiki.outline(spark.createDataFrame([(1, "- a\n" + "\n".join("  " * i + f"- {i}" for i in range(30)))], f"{key} long, md string"), key, "md").count() == 31


def test_python_literals(spark):
    texts = ["a", "it's", 'say "x" it\'s', "a\\b\nc\td", ""]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(pipeline.py_repr(F.col("t")).alias("r"), "i").orderBy("i").collect()
    assert [x.r for x in got] == [repr(t) for t in texts]


def test_narratives_survive_failing_models_and_repeated_keys(spark):
    schema = "k long, page string, section string, text string, code_blocks array<struct<label:string,code:string,language:string,mermaid:string>>"
    secs = spark.createDataFrame([(1, "p", "s", "t", None), (1, "p", "s", None, []), (None, "p", None, "t", [])], schema)

    def broken(task, parts):
        raise OSError("down")

    got = narrate.narrate(secs, "k", broken, broken, 2).collect()
    assert len(got) == 3 and all((x.verdict, x.misalignment, len(x.critic_history)) == ("FAIL", "intent_code_mismatch", 2) for x in got)
    assert narrate.narrate(secs.limit(0), "k", broken).count() == 0
    assert narrate.judge("fail: too low level", True) == ("FAIL", ": too low level", "low_level_too_early") and narrate.judge("PASS a\nb", True)[1] == "a\nb" and narrate.judge("PASS a\nb")[1] == "a"
    pages = spark.createDataFrame([("T", "# x"), ("T", None), ("T", "```\nc\n```\n\nprose")], "title string, text string")
    assert sorted(x.summary for x in narrate.summarise_pages(pages, "title", "text").collect()) == ["# x", "T", "prose"]
    assert {x.summary for x in narrate.summarise_pages(pages, "title", "text", lambda task, p: " said ").collect()} == {"said"}


@settings(max_examples=300, deadline=None)
@given(st.text("ab.@-_%+/ :)comwhtpsC\n", max_size=40))
def test_quick_addresses_are_the_same(text):
    assert re.sub(T.QUICK_ADDRESS, "", text) == re.sub(T.ADDRESS, "", text)


def test_settings(tmp_path):
    assert config.narrative_modes(["Rewrite", "cross", "x", "code"]) == ["code", "critic"] and config.narrative_modes(None) == ["code"]
    assert config.url_list(["a, b", "", "a"]) == ["a", "b"] and config.url_list([]) is None
    assert config.endpoint_pool(["h", "http://h/v1", " "], "::1", 80, "/v1", "x:1/y/") == ["http://h/v1", "http://x:1/y"] and config.endpoint_pool([], "::1", 80, "v1") == ["http://[::1]:80/v1"]
    (tmp_path / "p").write_text("be kind")
    assert config.prompt_text(f"@{tmp_path}/p") == "be kind" and config.prompt_text("as is") == "as is" and config.prompt_text("") is None
    with pytest.raises(config.SettingError):
        config.prompt_text("@/no/such/file")
    assert config.check_settings({}, 0) == [] and config.check_settings({"output": "x", "judge_use": True, "max_pages": 0}, 0) == ["output needs targets", "judge_use needs targets", "judge_use needs judge_model", "max_pages must be at least 1"]
    assert config.check_settings({"output": "x", "wiki_dir": "/no/such"}, 2) == ["several targets need output_dir", "wiki_dir is no folder"]
    c = config.chat_config({"judge_model": "m", "judge_max_tokens": 0, "judge_server_urls": ["a,b"]}, "judge_", "strict")
    assert c.max_tokens is None and c.endpoints() == ["http://a/v1/chat/completions", "http://b/v1/chat/completions"] and c.prompts["critique_block"] == "strict"


def test_chat_retries_and_turns():
    calls, slept = [], []
    answer = json.dumps({"choices": [{"message": {"content": "hi"}}]})

    def post(url, body, headers, timeout):
        calls.append((url, body, headers))
        if len(calls) < 3:
            raise OSError("reset")
        return 200, answer

    assert chat.post_with_retry("u", {}, post=post, sleep=slept.append) == json.loads(answer) and slept == [2.0, 4.0]
    with pytest.raises(chat.ChatError, match="context length exceeded"):
        chat.post_with_retry("u", {}, post=lambda *a: (400, '{"error": {"code": "context_length_exceeded", "message": "m"}}'), sleep=slept.append)
    with pytest.raises(chat.ChatError, match="after 1 retries"):
        chat.post_with_retry("u", {}, retries=1, post=lambda *a: (500, ""), sleep=slept.append)
    calls.clear()
    model = chat.ChatModel(config.ChatConfig("m", server_urls=["a", "b"], api_key="k", retries=0), lambda *a: calls.append(a) or (200, answer))
    assert [model("rewrite_section", {"page": "P", "code": "x" * 9000, "stub": "s"}) for _ in range(3)] == ["hi"] * 3
    assert [c[0].split("/")[2] for c in calls] == ["a", "b", "a"] and calls[0][2]["Authorization"] == "Bearer k" and len(calls[0][1]["messages"][1]["content"]) < 6100 and "max_tokens" not in calls[0][1]
    closed = iter([chat.ChatError("Connection is closed by peer"), None])

    def flaky(*a):
        if (e := next(closed)) is not None:
            raise e
        return 200, answer

    assert chat.ChatModel(config.ChatConfig("m"), flaky).chat([]) == "hi"
    with pytest.raises(chat.ChatError, match="no message"):
        chat.ChatModel(config.ChatConfig("m"), lambda *a: (200, "{}")).chat([])


def fake_server():
    """A function of its own each time, so that workers get it by value."""

    def fake_send(method, url, body, headers, timeout):
        if method == "DELETE":
            raise OSError("gone")
        result = {"initialize": {}, "tools/list": {"tools": [{"name": "ask", "description": "d"}]}}.get(body["method"])
        if body["method"] == "tools/call":
            a = body["params"]["arguments"]
            text = {"read_wiki_structure": "- 1 A", "read_wiki_contents": "# Page: A\nx", "ask_question": 'so: {"a": 1}' if body["id"] > 2 else "hm"}[body["params"]["name"]]
            result = {"content": [{"type": "image"}, {"type": "text", "text": "Error fetching wiki for x" if a["repoName"] == "bad" else text}]}
        return {"mcp-session-id": "7"}, "event: message\ndata: " + json.dumps({"result": result})

    return fake_send


def test_remote_wikis(spark):
    fake_send = fake_server()
    with remote.Session("u", send=fake_send) as s:
        assert s.tools() == [{"name": "ask", "description": "d"}] and s.ask_json("r", "q") == {"a": 1}
        with pytest.raises(remote.ToolError):
            s.text("read_wiki_structure", "bad")
    with pytest.raises(remote.ToolError):
        remote.Session("u", send=lambda *a: ({}, "data: {}"))
    got = {x.repo: (x.outline, x.error) for x in remote.remote_wikis(spark, "u", ["a", "b@1", "bad"], per_task=2, send=fake_send).collect()}
    assert got == {"a": ("- 1 A", None), "b": ("- 1 A", None), "bad": (None, "Error fetching wiki for x")}
    assert remote.json_part("```json\n{}\n```") == "json\n{}" and remote.json_part("x {a} y") == "{a}" and remote.json_part(" t ") == "t"


def test_readers(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "other.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        readers.wiki_parts(spark, str(tmp_path / "w"))
    wiki_rows(spark, [("A", "x")]).drop("file_path", "file_row").coalesce(1).write.parquet(str(tmp_path / "p"))
    assert [x.value for x in readers.inspect_parts(spark, str(tmp_path / "p"), ["repo_name"], ["repo_name", "no"], 1).collect()] == ['{"repo_name":" a/b ","no":null}']
    assert readers.schema_of(spark, str(tmp_path / "p")).first().name == "repo_name" and readers.part_files(spark, str(tmp_path / "p")).count() == 1
    (tmp_path / "list").write_text("# c\nx@1, y\n@" + str(tmp_path / "more") + "\n")
    (tmp_path / "more").write_text("z\n\n")
    assert readers.expand_repos(["q", f"@{tmp_path}/list", " "]) == ["q", "x@1", "y", "z"]
    assert [(x.repo, x.commit) for x in readers.repo_targets(spark, ["a@2,b"], "d").orderBy("pos").collect()] == [("a", "2"), ("b", "d")]
    (tmp_path / "more").write_text(f"@{tmp_path}/list")
    with pytest.raises(ValueError):
        readers.expand_repos([f"@{tmp_path}/list"])
    (tmp_path / "repos").write_text("b\na\nb, c\n")
    assert [x.repo for x in readers.repo_list(spark, str(tmp_path / "repos")).collect()] == ["b", "a", "c"]
    (tmp_path / "page.txt").write_text('"a\\nb",')
    assert readers.page_texts(spark, str(tmp_path / "page.txt")).first().text == "a\nb"
    got = spark.createDataFrame([("oops",), ("[]",), (None,), ("[1]",), ('{"a": 1}',), ('[{"page_plan": {"id": "2", "title": " T "}, "content": " c "}, 7]',)], "c string").select(readers.wiki_texts(F.col("c")).alias("w")).collect()
    assert [x.w.error for x in got] == ["the content is no JSON", "the content is no list of pages, or an empty one", "the content is no JSON", "no page of the content has a title", "the content is no list of pages, or an empty one", None]
    assert (got[-1].w.outline, got[-1].w.markdown) == ("- 2 T", "# Page: T\n\nc")


@pytest.mark.skipif(not shutil.which("git"), reason="no git")
def test_checkout(spark, tmp_path):
    at = tmp_path / "origin"
    at.mkdir()
    (at / "f.txt").write_text("hi")
    for step in (["init", "-q"], ["add", "."], ["-c", "user.name=a", "-c", "user.email=a@b", "commit", "-qm", "x"]):
        subprocess.run(["git", "-C", str(at), *step], check=True)
    with readers.checkout(str(at)) as folder:
        assert [x.path for x in readers.repo_files(spark, folder, "r").collect() if not x.path.startswith(".git")] == ["f.txt"]
    with pytest.raises(RuntimeError, match="failed to clone"):
        with readers.checkout(str(tmp_path / "none")):
            pass


def test_archives_are_cached(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("root/a.py", "x")
    for _ in range(2):
        assert [x.text for x in readers.zip_files(spark, str(tmp_path / "r.zip"), str(tmp_path / "cache")).collect()] == ["x"]
        (tmp_path / "r.zip").unlink(missing_ok=True)


def test_sinks(spark, tmp_path):
    chunks = spark.createDataFrame([("r", 0, "l", "one"), ("r", 1, "m", ""), ("q", 0, "l", "two")], "repo string, page_ord int, label string, text string")
    sinks.write_dataset(chunks, chunks, str(tmp_path / "d"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "d" / "text").glob("part-*")))
    assert text == "two\n\none\n\n" and spark.read.json(str(tmp_path / "d" / "chunks")).count() == 3
    sinks.persist(chunks.where("page_ord = 0"), chunks.limit(0), str(tmp_path / "x"))
    sinks.persist(chunks.where("page_ord = 1"), chunks.limit(1), str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x" / "chunks")).count() == 3
    sinks.upload(spark, str(tmp_path / "d" / "chunks"), f"file://{tmp_path}/up/load")
    assert spark.read.json(str(tmp_path / "up" / "load" / "chunks")).count() == 3
    rec = spark.createDataFrame([("p", "s", "n", "", None, None, None)], "page string, section string, narrative string, critic string, verdict string, misalignment string, learnability double")
    assert rec.select(sinks.narrative_text(True).alias("t")).first().t == "# p :: s\n\nNarrative:\nn\n\nMetadata:\nverdict=UNKNOWN misalignment=none learnability=None"
    sinks.write_narratives(rec.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_token_counts(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([("a b",), (None,)], "t string")
    n = inspect.token_counter(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert inspect.token_statistics(df, n("t")).first().entries == 2


def test_hydration_leaves_other_rows_and_odd_keys(spark):
    secs = spark.createDataFrame([(1, "r", "[a.py:1]()", 7), (None, "r", "[a.py:2]()", 8), (3, "q", "[a.py:1]()", 9), (4, None, None, 1)], "path long, repo string, text string, _t int")
    files = spark.createDataFrame([("r", "a.py", "x\ny"), ("r", "a.py", "x\ny")], "repo string, path string, text string")
    got = {x.path: (x.text, x["_t"]) for x in hydrate.hydrate_sections(secs.withColumnRenamed("path", "k"), files, ["k"], "text").withColumnRenamed("k", "path").collect()}
    assert got[1] == ("a.py:1\n```python\nx\n\n```", 7) and got[None][0].startswith("a.py:2\n") and got[3] == ("a.py:1", 9) and got[4] == ("", 1)
    assert hydrate.hydrate_sections(secs.withColumnRenamed("path", "k").limit(0), files, ["k"], "text").count() == 0
    assert R.Hydrator({}).run("[a.py]()") == "a.py"
