"""Source references in text: branchy rules, in plain Python for Arrow batches."""

from __future__ import annotations

import json
import re

from .text import LANGUAGES

_SUFFIX = {f".{end}": name for name, ends in LANGUAGES.items() for end in ends}
_RANGE = re.compile(r"([A-Za-z0-9_.\-/]+):(\d+)(?:-(\d+))?")
_FENCE = re.compile(r"```([^\n`]*)\n(.*?)```", re.S)
Key = tuple[str, int, int]


def label_range(label: str) -> Key | None:
    """Path and lines of a label; lines 1 to 80 without a range."""
    s = label.strip()
    if not s or s.lower().startswith("image::"):
        return None
    if s.lower().startswith("source:"):
        s = s[7:].strip()
    m = re.search(r":(\d+)(?:-(\d+))?$", s)
    if m is None:
        return (s, 1, 80) if s else None
    path = s[: m.start()].strip()
    return (path, int(m[1]), int(m[2] or m[1])) if path else None


def _tidy(path: str) -> str:
    p = path.strip()
    if p[:1] == "[" and "]" in p:
        p = p.lstrip("[").partition("]")[0].strip()
    return p.removeprefix("./")


def _sound(path: str) -> bool:
    return bool(re.fullmatch(r"[A-Za-z0-9_./][A-Za-z0-9_.\-/]*", path))


def _one(text: str, bare_ok: bool) -> Key | None:
    """A reference in a single candidate: a whole path, a label with lines, or the last path with lines in it."""
    p = _tidy(text)
    if ":" not in text and _sound(p) and ("/" in p or "." in p):
        return p, 1, 0
    if (got := label_range(text)) and _sound(q := _tidy(got[0])):
        return q, got[1], got[2]
    for m in reversed(list(_RANGE.finditer(text))):
        if _sound(q := _tidy(m[1])):
            return q, int(m[2]), int(m[3] or m[2])
    return (p, 1, 0) if _sound(p) and (bare_ok or "/" in p or "." in p) else None


def parse_reference(text: str) -> Key | None:
    """(path, first line, last line; 0 to the end) that a string names; brackets from the right come first."""
    s = text.strip()
    for inner in reversed(re.findall(r"\[([^\]]+)\]", s)):
        c = inner.strip()
        if c.lower().startswith("source:"):
            c = c[7:].strip()
        if got := _one(c, True):
            return got
    s = s[:-2].strip() if s.endswith("()") else s
    s = s[1:-1].strip() if s.startswith("[") and s.endswith("]") else s
    s = s[2:].strip() if s.startswith("- ") else s
    s = s[7:].strip() if s.lower().startswith("source:") else s
    return _one(s, False)


def snippet(text: str | None, start: int, end: int) -> str | None:
    """Lines of a file; from 1, to the end for ``end`` 0, one line where the end is before the start."""
    rows = (text or "").splitlines()
    a = max(start - 1, 0)
    if a >= len(rows):
        return None
    return "\n".join(rows[a:] if end <= 0 else rows[a : max(end, a + 1)]).rstrip() or None


def fenced(key: Key, body: str) -> str:
    path, a, b = key
    name = path if b <= 0 else f"{path}:{a}" if b <= a else f"{path}:{a}-{b}"
    dot = path.rpartition("/")[2]
    kind = _SUFFIX.get("." + dot.rpartition(".")[2].lower(), "text") if "." in dot.lstrip(".") else "text"
    return f"{name}\n```{kind}\n{body.rstrip()}\n```"


class FileSnippets:
    """What is known of each reference, from whole files: for one section and a few files at hand."""

    def __init__(self, files: dict[str, str]):
        self.files = files

    def __contains__(self, key: Key) -> bool:
        return True

    def get(self, key: Key) -> str | None:
        return snippet(self.files.get(key[0]), key[1], key[2])


class Hydrator:
    """Puts source lines in the place of references. ``snippets``: what is known of each, None where there is nothing;
    ``wanted`` collects the references that were asked for and are not known."""

    def __init__(self, snippets: dict[Key, str | None] | FileSnippets):
        self.snippets, self.wanted, self.used = snippets, set(), set()

    def get(self, key: Key | None) -> str | None:
        if key is None or ".." in key[0].split("/") or key[0].startswith("/"):
            return None
        if key not in self.snippets:
            self.wanted.add(key)
        return self.snippets.get(key)

    def _put(self, key: Key | None, otherwise: str) -> str:
        got = self.get(key)
        if not got:
            return otherwise
        self.used.add(key)
        return fenced(key, got)

    def _link(self, m: re.Match) -> str:
        target = m[2].strip()
        target = target[1:-1].strip() if target.startswith("<") and target.endswith(">") else target
        target = target.removeprefix("./")
        if re.match(r"(?i)https?://|mailto:", target):
            return m[0]
        return self._put(parse_reference(target), m[0])

    def _lines(self, text: str) -> str:
        out = []
        for line in text.splitlines():
            out.append(line)
            s = line.strip()
            key = parse_reference(s[7:].strip() if s.lower().startswith("source:") else s) if s else None
            if key is None and s.startswith("- "):
                key = parse_reference(s[2:])
            if (got := self.get(key)) and key not in self.used:
                self.used.add(key)
                out.append(fenced(key, got))
        return "\n".join(out)

    def _fence(self, m: re.Match) -> str:
        found = []
        for line in filter(None, map(str.strip, m[2].splitlines())):
            line = line[2:].strip() if line[:2] in ("- ", "* ", "• ") else line
            key = parse_reference(line[7:].strip() if line.lower().startswith("source:") else line)
            got = self.get(key)
            if not got:
                found = []
                break
            found.append((key, got))
        self.used.update(k for k, _ in found)
        body = "\n\n".join(g.rstrip() for _, g in found) if found else m[2]
        return f"```{m[1].strip()}\n{body}\n```"

    def run(self, text: str) -> str:
        """Bracket tokens, links, lines, then fences; details blocks stay as they are."""
        held: list[str] = []

        def hold(m: re.Match) -> str:
            held.append(m[0])
            return f"\x00{len(held) - 1}\x00"

        text = re.sub(r"(?is)<details\b[^>]*>.*?</details>", hold, text)
        text = re.sub(r"\[([^\]]+)\]\(\)", lambda m: self._put(label_range(m[1].strip()), m[1].strip()), text)
        text = re.sub(r"\[([^\]]+)\]\(([^)]+)\)", self._link, text)
        text = _FENCE.sub(self._fence, self._lines(text))
        return re.sub("\x00(\\d+)\x00", lambda m: held[int(m[1])], text)


def usable_label(label: str | None) -> str | None:
    s = (label or "").strip()
    if not s or s.lower() in {"null", "none", ".", ".."} or "://" in s or s.startswith("//"):
        return None
    if "/" not in s and ":" not in s and not s.lower().endswith((".md", ".rst", ".txt")):
        return None
    return s if re.fullmatch(r"[A-Za-z0-9_.\-/]+(?::\d+(?:-\d+)?)?", s) else None


def _first(candidates) -> str | None:
    return next((x for x in map(usable_label, candidates) if x), None)


def label_of_line(line: str) -> str | None:
    s = line.strip()
    if not s or s.startswith("```"):
        return None
    for mark in ("- ", "* ", "• "):
        s = s[2:].strip() if s.startswith(mark) else s
    if got := _first(re.findall(r"\[([^\]]+)\]", s)):
        return got
    for mark in ("**sources:**", "**source:**", "sources:", "source:"):
        if (at := s.lower().find(mark)) >= 0:
            rest = s[at + len(mark) :].strip()
            return _first([rest, *re.split(r"[;,\s]+", rest)])
    return _first([s, *re.findall(r"[A-Za-z0-9_.\-/]+(?::\d+(?:-\d+)?)?", s)])


def link_labels(text: str) -> list[str]:
    """Labels of links that name lines, distinct, in order."""
    return list(dict.fromkeys(x.strip() for x in re.findall(r"\[([^\]]+)\]\([^)]*\)", text) if label_range(x)))


def section_sources(text: str) -> list[str]:
    """Labels on source lines and in details lists: distinct, in order."""
    found, inside = [], False
    for line in text.splitlines():
        s = line.strip()
        if s.startswith(("<details", "</details")):
            inside = s.startswith("<details")
        elif m := re.search(r"(?i)\*\*sources:\*\*", line):
            rest = line[m.end() :]
            links = link_labels(rest)
            found += [usable_label(x) for x in links] if links else [usable_label(x) or label_of_line(x) for x in re.split("[;,]", rest)]
        elif inside and s.startswith("- ["):
            links = link_labels(s)
            found += [usable_label(x) for x in links] if links else [label_of_line(s)]
    return list(dict.fromkeys(x for x in found if x))


def label_of_code(code: str) -> str | None:
    for s in filter(None, map(str.strip, code.splitlines())):
        s = s[2:].strip() if s[:2] in ("- ", "* ", "• ") else s
        s = s[7:].strip() if s.lower().startswith("source:") else s
        if s and (got := usable_label(s.split()[0])):
            return got
    return None


def code_blocks(text: str, strict: bool = False) -> list[dict]:
    """The first fence after each source line, with a label: the next distinct source label in turn, else the nearest
    label above, else one from the code. ``strict`` (an addition) takes labels only from the marker's own line."""
    marks = [m.span() for m in re.finditer(r"(?i)\*\*sources:\*\*", text)]
    labels, out, done = iter(section_sources(text)), [], 0
    for k, (a, b) in enumerate(marks):
        if a < done:
            continue
        m = _FENCE.search(text, b, marks[k + 1][0] if k + 1 < len(marks) else len(text))
        if m is None or not (code := m[2].strip("\n")):
            done = m.end() if m else b
            continue
        done = m.end()
        label = label_of_line(text[a:].split("\n", 1)[0]) if strict else next(labels, None)
        if not label:
            for line in reversed(text[: m.start()].rstrip("\n").splitlines()):
                if (label := label_of_line(line)) or line.strip().startswith("```"):
                    break
        kind = m[1].strip().lower() or "text"
        out.append({"label": usable_label(label) or label_of_code(code) or "", "code": code, "language": kind, "mermaid": code if kind == "mermaid" else None})
    return out


def split_blocks(text: str) -> list[dict]:
    """Each fence with the explanation before it."""
    out, last = [], 0
    for m in _FENCE.finditer(text):
        code = m[2].strip("\n")
        if code.strip():
            before = text[last : m.start()].strip()
            diagram = re.search(r"(?is)```mermaid\s*\n(.*?)```", before)
            out.append({"explanation": before, "code": code, "language": m[1].strip().lower() or "text", "mermaid": diagram[1].strip() if diagram else None})
            last = m.end()
    return out


def citations(text: str) -> list[dict]:
    """Citation facts of a page: label, path, lines, place, and the closest line above that is not blank."""
    rows, inside, out, seen = text.splitlines(), False, [], set()

    def add(label: str, key: Key | None, n: int) -> None:
        if key is None or label.startswith("#") or key[0].startswith("#") or "://" in key[0] or "mailto:" in key[0] or "diagram" in key[0].lower() or (label, *key) in seen:
            return
        seen.add((label, *key))
        context = next((r.strip() for r in reversed(rows[: n - 1]) if r.strip()), "")
        out.append({"label": label, "path": key[0], "start": key[1], "end": key[2], "page_line": n, "context": context})

    for n, line in enumerate(rows, 1):
        s = line.strip()
        if s.startswith("<details"):
            inside = True
        elif s.startswith("</details"):
            inside = False
        elif "**Sources:**" in line or (inside and s.startswith("- [")):
            for label in link_labels(line.partition("**Sources:**")[2] if "**Sources:**" in line else s):
                add(label, label_range(label), n)
        for m in re.finditer(r"\[Source:\s*([^\]:]+)(?::(\d+)(?:-(\d+))?)?\]", line):
            a = int(m[2] or 1)
            add(m[0][1:-1], (m[1].strip(), a, int(m[3] or a)), n)
    return out


def json_strings(value, path: str = ""):
    """(path, string) of every string in a decoded JSON value, in order."""
    if isinstance(value, str):
        yield path, value
    elif isinstance(value, dict):
        for k, v in value.items():
            yield from json_strings(v, f"{path}.{k}" if path else str(k))
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from json_strings(v, f"{path}[{i}]")


def first_event(body: str):
    """The first JSON message of an event stream: data lines are joined until they parse."""
    held = ""
    for line in body.splitlines():
        if line.startswith("event:") and line[6:].strip() == "close":
            break
        if line.startswith("data:"):
            held += line[5:].removeprefix(" ")
        elif line and not line.startswith((":", "event:", "id:", "retry:")):
            held += line
        try:
            return json.loads(held)
        except ValueError:
            continue
    raise ValueError("no JSON message in the stream")


def chat_content(response: dict) -> str | None:
    """The text of a chat answer, from message, delta, text or output, lists joined."""

    def flat(x) -> str | None:
        if isinstance(x, str):
            return x
        if isinstance(x, list):
            return "".join(filter(None, map(flat, x))) or None
        if isinstance(x, dict):
            return next((y for k in ("text", "content", "value", "output_text") if (y := flat(x.get(k)))), None)
        return None

    for choice in response.get("choices") or []:
        for part in ((choice.get("message") or {}).get("content"), (choice.get("delta") or {}).get("content"), choice.get("text"), choice.get("output")):
            if got := flat(part):
                return got
    return None


def decoded(text: str | None):
    """A JSON value; None where the text is no JSON."""
    try:
        return json.loads(text or "")
    except ValueError:
        return None


def without_links(value):
    """A JSON value with markdown links as their labels in every string; keys stay."""
    if isinstance(value, str):
        return re.sub(r"!?\[([^\]]+)\]\([^)]*\)", lambda m: m[1].strip(), value)
    if isinstance(value, dict):
        return {k: without_links(v) for k, v in value.items()}
    return [without_links(v) for v in value] if isinstance(value, list) else value


def json_without_links(text: str | None) -> str | None:
    try:
        return json.dumps(without_links(json.loads(text or "")), ensure_ascii=False)
    except ValueError:
        return None


def first_event_text(body: str | None) -> str | None:
    try:
        return json.dumps(first_event(body or ""), ensure_ascii=False)
    except ValueError:
        return None
