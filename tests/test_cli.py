"""The jobs, on small inputs."""

import json

from docloom import cli
from docloom.sources import readers


def text_of(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_dataset_job(spark, tmp_path, capsys):
    content = json.dumps([{"page_plan": {"id": "1", "title": "One"}, "content": "intro\n## S\ntext"}])
    spark.createDataFrame([("a", content, "h")], readers.WIKI).coalesce(1).write.parquet(str(tmp_path / "w"))
    out = str(tmp_path / "o")
    assert cli.main(["dataset", "a", "gone", "--wiki-dir", str(tmp_path / "w"), "--output-dir", out, "--narrative-format", "text"]) == 1
    assert "gone" in capsys.readouterr().err
    assert text_of(tmp_path / "o" / "dataset" / "text").startswith("[Page] One") and "# One :: S" in text_of(tmp_path / "o" / "narratives")
    assert cli.main(["dataset", "a", "--max-pages", "0", "--wiki-dir", str(tmp_path / "w")]) == 2
    (tmp_path / "empty").mkdir()
    assert cli.main(["dataset", "a", "--wiki-dir", str(tmp_path / "empty")]) == 1


def test_record_jobs(spark, tmp_path, capsys):
    (tmp_path / "n.json").write_text(json.dumps([{"page": "P", "section": "S", "narrative": "# see a.py\n\nand", "verdict": "FAIL", "code_blocks": [{"reference": "a.py", "code": "X"}]}]))
    assert cli.main(["inspect", str(tmp_path / "n.json"), "--failures", "--code"]) == 0
    assert "P :: S" in capsys.readouterr().out
    assert cli.main(["merge", str(tmp_path / "n.json"), str(tmp_path / "m")]) == 0 and text_of(tmp_path / "m") == "# P :: S\n# see a.py\nX\n\nand\n\n"
    assert cli.main(["concat", str(tmp_path / "n.json"), str(tmp_path / "c")]) == 0 and text_of(tmp_path / "c") == "see a.py\n\nand\n\n"
    (tmp_path / "p.txt").write_text("visit http://a.b\n**Sources:** [x.py:1](y)\n")
    capsys.readouterr()
    assert cli.main(["find", str(tmp_path / "p.txt"), "--with-context"]) == 0 and "x.py:1 line 2 visit http://a.b" in capsys.readouterr().out
    assert cli.main(["find", str(tmp_path / "p.txt"), "--strip-links"]) == 0 and "**Sources:** x.py:1" in capsys.readouterr().out
    assert cli.main(["clean", str(tmp_path / "p.txt"), str(tmp_path / "cl")]) == 0 and text_of(tmp_path / "cl").startswith("visit\n")
    (tmp_path / "t.json").write_text('{"chunks": ["a b", "c"]}')
    assert cli.main(["tokens", str(tmp_path / "t.json")]) == 0
    spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1).write.parquet(str(tmp_path / "q"))
    capsys.readouterr()
    assert cli.main(["parts", str(tmp_path / "q"), "--keys", "b", "c", "--limit", "1"]) == 0 and '{"b":"x","c":null}' in capsys.readouterr().out
    assert cli.main(["parts", str(tmp_path / "q"), "--show-schema"]) == 0
