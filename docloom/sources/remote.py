"""Wikis from a remote tool server: JSON-RPC calls over HTTP with event-stream answers, and a data source over them."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.references import first_event

#: Takes a method (POST or DELETE), the address, a body, headers and a timeout; gives the answer's headers and text.
Send = Callable[[str, str, dict | None, dict, float], tuple[dict, str]]
PROTOCOL = "2024-11-05"


class ToolError(RuntimeError):
    """A tool call that gave no text."""


def http_send(method: str, url: str, body: dict | None, headers: dict, timeout: float) -> tuple[dict, str]:
    request = urllib.request.Request(url, json.dumps(body).encode() if body is not None else None, headers, method=method)
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return {k.lower(): v for k, v in r.headers.items()}, r.read().decode("utf-8", "replace")


def text_blocks(answer: dict) -> list[str]:
    """The texts in a tool's answer."""
    items = (answer.get("result") or {}).get("content") or []
    return [x["text"] for x in items if isinstance(x, dict) and x.get("type") == "text" and x.get("text")]


def checked(blocks: list[str], tool: str, product: str) -> list[str]:
    """The blocks, unless there are none or one of them reports a failure."""
    if not blocks:
        raise ToolError(f"{tool} gave no text")
    for b in blocks:
        low = b.strip().lower()
        if low.startswith("error fetching wiki for") or ("repository not found" in low and product.lower() in low) or low.startswith(f"{product.lower()} is currently indexing"):
            raise ToolError(b.strip())
    return blocks


class Session:
    """An open session; a context manager that closes it, whatever the server says to that."""

    def __init__(self, url: str, product: str = "wiki", send: Send = http_send):
        self.url, self.product, self.send, self._ids = url, product, send, count(2)
        headers, body = send("POST", url, self._call(1, "initialize", {"protocolVersion": PROTOCOL, "clientInfo": {"name": "docloom", "version": "1"}, "capabilities": {}}), self._headers(None), 30)
        self.id = headers.get("mcp-session-id")
        if not self.id:
            raise ToolError("the server gave no session id")
        if "error" in (got := first_event(body)):
            raise ToolError(f"no session: {got['error']}")

    @staticmethod
    def _call(number: int, method: str, params: dict | None = None) -> dict:
        return {"jsonrpc": "2.0", "id": number, "method": method} | ({"params": params} if params is not None else {})

    @staticmethod
    def _headers(session: str | None) -> dict:
        return {"Content-Type": "application/json", "Accept": "application/json, text/event-stream", "MCP-Protocol-Version": PROTOCOL} | ({"Mcp-Session-Id": session} if session else {})

    def request(self, method: str, params: dict | None = None) -> dict:
        return first_event(self.send("POST", self.url, self._call(next(self._ids), method, params), self._headers(self.id), 60)[1])

    def tools(self) -> list[dict]:
        """name and description of each tool."""
        return [{"name": t.get("name", ""), "description": t.get("description", "")} for t in (self.request("tools/list").get("result") or {}).get("tools") or []]

    def call(self, tool: str, arguments: dict) -> dict:
        return self.request("tools/call", {"name": tool, "arguments": arguments})

    def text(self, tool: str, repo: str, commit: str | None = None) -> str:
        """The text of ``read_wiki_structure`` or ``read_wiki_contents`` for a repository."""
        return "\n\n".join(checked(text_blocks(self.call(tool, {"repoName": repo} | ({"repoCommit": commit} if commit else {}))), tool, self.product))

    def ask_json(self, repo: str, question: str, retries: int = 2):
        """The JSON in an answer, asked again up to ``retries`` times."""
        last = "no text"
        for _ in range(retries + 1):
            if blocks := text_blocks(self.call("ask_question", {"repoName": repo, "question": question})):
                last = "\n".join(blocks)
                try:
                    return json.loads(json_part(last))
                except ValueError:
                    continue
        raise ToolError(f"no JSON after {retries + 1} tries; last: {last}")

    def close(self) -> None:
        try:
            self.send("DELETE", self.url, None, self._headers(self.id), 5)
        except OSError:
            pass

    def __enter__(self) -> Session:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def json_part(text: str) -> str:
    """What stands in a fence that begins the text, its language included; else the first brace to the last one; else the text."""
    s = text.strip()
    if s.startswith("```") and (end := s.find("```", 3)) > 3 and s[3:end]:
        return s[3:end].strip()
    a, b = s.find("{"), s.rfind("}")
    return s[a : b + 1] if 0 <= a <= b else s


class _Part(InputPartition):
    def __init__(self, repos: list[tuple[str, str | None]]):
        super().__init__(None)
        self.repos = repos


class RemoteReader(DataSourceReader):
    def __init__(self, url: str, repos: list[tuple[str, str | None]], product: str, per_task: int, send: Send):
        self.url, self.repos, self.product, self.per_task, self.sender = url, repos, product, per_task, send

    def partitions(self) -> list[InputPartition]:
        return [_Part(self.repos[i : i + self.per_task]) for i in range(0, len(self.repos), self.per_task)] or [_Part([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.repos:
            return
        with Session(self.url, self.product, self.sender) as s:
            for repo, commit in partition.repos:
                row = {"repo": repo, "outline": None, "markdown": None, "error": None}
                try:
                    row |= {"outline": s.text("read_wiki_structure", repo, commit), "markdown": s.text("read_wiki_contents", repo, commit)}
                except (ToolError, OSError, ValueError) as e:
                    row["error"] = str(e)
                yield pa.RecordBatch.from_pylist([row], pa.schema([(k, pa.string()) for k in row]))


def source(send: Send = http_send) -> type[DataSource]:
    """The data source class, over a transport: (repo, outline, markdown, error), one row a repository, some repositories a task.

    Options: url, product, per_task, and repos: ``repo`` or ``repo@commit``, one a line.
    """

    class WikiSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "wiki"

        def schema(self) -> str:
            return "repo string, outline string, markdown string, error string"

        def reader(self, schema) -> DataSourceReader:
            o = self.options
            repos = [(r.partition("@")[0].strip(), r.partition("@")[2].strip() or None) for r in (o.get("repos") or "").split("\n") if r.strip()]
            return RemoteReader(o["url"], repos, o.get("product") or "wiki", int(o.get("per_task") or 8), send)

    return WikiSource


def remote_wikis(spark: SparkSession, url: str, repos: Iterable[str], product: str = "wiki", per_task: int = 8, send: Send = http_send) -> DataFrame:
    """(repo, outline, markdown, error) of repositories from a tool server, as :func:`operators.pipeline.hydrated_document` takes them."""
    spark.dataSource.register(source(send))
    return spark.read.format("wiki").option("url", url).option("product", product).option("per_task", per_task).option("repos", "\n".join(repos)).load()
