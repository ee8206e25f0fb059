"""Column functions for text: all built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VERBS = sorted("govern mediate allocate control stabilize optimize distribute synchronize schedule manage enforce ensure orchestrate coordinate".split())
NOUNS = sorted("backend adapter engine manager scheduler worker module component service pipeline trainer controller".split())
NEEDS = sorted("consistency stability scalability resource latency throughput tradeoff trade-off limit constraint requires need must".split())
#: Misalignment kinds in the order in which they are tried, each with the phrases that tell it.
MISALIGNED = (
    ("code_without_purpose", ("missing intent", "without explaining")),
    ("intent_without_how", ("missing mechanism", "no structural rationale")),
    ("abrupt_implementation", ("code appears without context", "jumps straight to code")),
    ("low_level_too_early", ("implementation detail before design", "too low level")),
    ("intent_code_mismatch", ("inconsistent with code", "contradiction")),
)
DOMAINS = "ai|app|cn|co|com|dev|io|net|org|tech"
#: Addresses: with a scheme, with www, of mail, or a bare domain, tried at each place in this order.
ADDRESS = rf"(?i)(?:https?://[^\s)]+|www\.[^\s)]+|[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{{2,}}|[a-z0-9.-]+\.(?:com|net|org|io|ai|dev|co|tech|app|cn)(?:/[^\s)]*)?)"
#: The same addresses. A run of letters is tried at its start only, as a match from within it would have begun there; so the
#: time is linear in the text.
QUICK_ADDRESS = rf"(?i)(?:https?://[^\s)]+|www\.[^\s)]+|(?<![a-z0-9._%+-])[a-z0-9._%+-]++@[a-z0-9.-]+\.[a-z]{{2,}}|(?<![a-z0-9.-])[a-z0-9.-]+\.(?:com|net|org|io|ai|dev|co|tech|app|cn)(?:/[^\s)]*)?)"
#: What every text with an address has.
_HINT = r"(?i)://|www\.|@|\.(?:com|net|org|io|ai|dev|co|tech|app|cn)"
#: White space of any script, and the separators among the control characters.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space, of any script, at both ends."""
    return F.btrim(c, F.lit(WHITE))


def once(c: Column, work) -> Column:
    """``work`` of an expression that it uses several times and that is to be computed once."""
    return F.get(F.transform(F.array(c), work), F.lit(0))


def lines(c: Column) -> Column:
    """Lines, whatever ends them; a last empty line is no line, and an empty text has none."""
    every = F.split(c, "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")
    return once(every, lambda e: F.when(F.element_at(e, -1) == "", F.slice(e, 1, F.size(e) - 1)).otherwise(e))


def heading_key(c: Column) -> Column:
    """The key by which headings match: number and all but ASCII letters and digits dropped; null or nothing: ``__intro__``."""
    bare = F.regexp_replace(strip(c), r"^\d+(?:\.\d+)*\s+", "")
    return F.coalesce(F.nullif(F.regexp_replace(F.lower(bare), "[^a-z0-9]+", ""), F.lit("")), F.lit("__intro__"))


def sentences(c: Column) -> Column:
    """Parts that end with ``.``, ``!`` or ``?`` before white space; blank ones dropped."""
    return F.filter(F.transform(F.split(strip(c), r"(?<=[.!?])\s+"), strip), lambda s: s != "")


def n_sentences(c: Column) -> Column:
    """The number of sentences: no part between boundaries is blank, once the ends are stripped."""
    return once(strip(c), lambda t: F.when(t == "", 0).otherwise(F.size(F.split(t, r"(?<=[.!?])\s+"))))


def n_tokens(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\S+"))


def any_of(c: Column, words: list[str]) -> Column:
    """Whether any of the words is in the lower-case text."""
    return once(F.lower(c), lambda t: has_any(t, words))


def has_any(low: Column, words: list[str]) -> Column:
    out = F.contains(low, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(low, F.lit(w))
    return out


def at_least_tokens(c: Column, n: int) -> Column:
    """Whether there are ``n`` tokens, without a look at those behind."""
    return c.rlike(rf"^\s*(?:\S++\s++){{{n - 1}}}\S")


def learnability(c: Column) -> Column:
    words = once(F.lower(c), lambda t: F.when(has_any(t, VERBS), F.lit(0.3)).otherwise(F.lit(0.0)).cast("double") + F.when(has_any(t, NOUNS), F.lit(0.3)).otherwise(F.lit(0.0)).cast("double"))
    score = F.when(at_least_tokens(c, 80), F.lit(0.4)).when(at_least_tokens(c, 40), F.lit(0.2)).otherwise(F.lit(0.0)).cast("double") + words
    return F.round(F.least(score, F.lit(1.0)), 3)


def misalignment(c: Column) -> Column:
    out = F.when(F.lower(c) == "", F.lit("none"))
    for kind, phrases in MISALIGNED:
        out = out.when(any_of(c, list(phrases)), F.lit(kind))
    return out.otherwise(F.lit("none"))


def constraints(c: Column) -> Column:
    """The first three of some sentences that state a need."""
    return F.slice(F.filter(c, lambda s: any_of(s, NEEDS)), 1, 3)


def mechanisms(c: Column, anchors: Column) -> Column:
    return F.slice(F.filter(c, lambda s: any_of(s, NOUNS) | F.exists(anchors, lambda a: F.contains(F.lower(s), F.lower(a)))), 1, 3)


def code_symbols(c: Column) -> Column:
    """Names of classes, then functions, then assigned names: the first eight distinct ones."""
    name = r"([A-Za-z_]\w*)"
    found = [F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in (rf"class\s+{name}", rf"def\s+{name}", rf"{name}\s*=\s*")]
    return F.slice(F.array_distinct(F.concat(*found)), 1, 8)


def scaffold(text: Column, code: Column) -> Column:
    s = sentences(text)
    rest = F.when(F.size(s) > 1, F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    anchors = code_symbols(code)
    return F.struct(F.coalesce(F.get(s, F.lit(0)), F.lit("")).alias("design_intent"), constraints(rest).alias("constraints"), mechanisms(rest, anchors).alias("key_mechanisms"), anchors.alias("code_anchors"))


def truncate(c: Column, limit: int = 4000) -> Column:
    t = strip(c)
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.regexp_replace(F.substring(t, 1, limit - 3), r"(?U)\s+$", ""), F.lit("...")))


def truncated(text: str, limit: int = 4000) -> str:
    """As :func:`truncate`, of one text."""
    t = text.strip()
    return t if len(t) <= limit else t[: limit - 3].rstrip() + "..."


def _bare(c: Column, strict_urls: bool) -> Column:
    """Without addresses and tags."""
    address = QUICK_ADDRESS.replace("cn)", r"cn)\b") if strict_urls else QUICK_ADDRESS
    x = F.when(c.rlike(_HINT), F.regexp_replace(c, address, "")).otherwise(c)
    return once(x, lambda t: F.when(F.contains(t, F.lit("<")), F.regexp_replace(F.regexp_replace(t, r"<[^>\n]+>", ""), r"<[^>]*$", "")).otherwise(t))


def _tidy(x: Column) -> Column:
    """White space collapsed, and quotes at the ends dropped; nothing where half a tag is left. ``x`` is used often."""
    tidy = strip(F.when(x.rlike(r"\s\s"), F.regexp_replace(x, r"\s{2,}", " ")).otherwise(x))
    return once(strip(x), lambda t: F.when(t.startswith("<") | t.endswith(">"), F.lit("")).otherwise(F.btrim(F.btrim(tidy, F.lit('"')), F.lit("'"))))


def clean_line(c: Column, strict_urls: bool = False) -> Column:
    """A line without addresses and tags. ``strict_urls`` (an addition) gives bare domains a right boundary."""
    return once(_bare(c, strict_urls), _tidy)


def clean_lines(c: Column, strict_urls: bool = False) -> Column:
    """Every line cleaned, empty ones dropped."""
    bare = F.transform(lines(c), lambda x: _bare(x, strict_urls))
    return F.array_join(F.filter(F.transform(bare, _tidy), lambda x: x != ""), "\n")


def strip_links(c: Column) -> Column:
    """Markdown links and images as their labels."""
    blank = F.regexp_replace(c, r"!?\[\s*\]\([^)]*\)", "")
    return F.regexp_replace(blank, r"!?\[\s*([^\]]+?)\s*\]\([^)]*\)", "$1")


def is_table_line(c: Column) -> Column:
    s = strip(c)
    return (s != "") & ((s.startswith("|") & s.endswith("|")) | (s.contains("|") & ~s.contains("http") & (F.size(F.split(s, r"\|")) > 2)))


#: Characters of box drawings and block charts.
CHART = "[─-╿▀-▟■-◿]"


def plain_line(c: Column) -> Column:
    """A line of markdown without its mark."""
    s = strip(c)
    return (
        F.when(s == "", s).when(s.startswith("#"), strip(F.regexp_replace(s, "^#+", ""))).when(s.rlike("^[-*]"), strip(F.regexp_replace(s, "^[-*]+", "")))
        .when(s.rlike(r"^\d[.)\]]"), strip(F.substring(s, 3, 1 << 30))).when(s.rlike(CHART), F.lit("")).otherwise(s)
    )


def visible_text(c: Column) -> Column:
    """Lines that a reader should see: no prompts, roles or source lines; blank lines at the ends go."""
    ls = F.transform(lines(strip(c)), strip)
    low = lambda x: F.lower(x)
    hidden = lambda x: (low(x).startswith("in the ") & low(x).contains(" repository")) | low(x).rlike("^(system prompt|user|assistant):") | x.startswith("Source:")
    return F.regexp_replace(F.array_join(F.filter(ls, lambda x: ~hidden(x)), "\n"), "^\n+|\n+$", "")


def label_range(c: Column) -> Column:
    """(path, start, end) of a citation label; lines 1 to 80 without a range; null for a blank or an image."""
    s = strip(c)
    s = strip(F.when(F.lower(s).startswith("source:"), F.substring(s, 8, 1 << 30)).otherwise(s))
    at = r"^(.*?):(\d+)(?:-(\d+))?$"
    a, b = F.nullif(F.regexp_extract(s, at, 2), F.lit("")).try_cast("int"), F.nullif(F.regexp_extract(s, at, 3), F.lit("")).try_cast("int")
    path = F.when(s.rlike(at), strip(F.regexp_extract(s, at, 1))).otherwise(s)
    return F.when((s != "") & ~F.lower(s).startswith("image::") & (path != ""), F.struct(path.alias("path"), F.coalesce(a, F.lit(1)).alias("start"), F.coalesce(b, a, F.lit(80)).alias("end")))


def reference_label(c: Column) -> Column:
    """A label that can name code, else null."""
    s = strip(c)
    ok = ~F.lower(s).isin("null", "none", ".", "..", "") & ~s.contains("://") & ~s.startswith("//") & (s.contains("/") | s.contains(":") | F.lower(s).rlike(r"\.(md|rst|txt)$")) & s.rlike(r"^[\w.\-/]+(?::\d+(?:-\d+)?)?$") & s.rlike(r"^[A-Za-z0-9_.\-/:]+$")
    return F.when(ok, s)


def section_verdict(c: Column) -> Column:
    """(verdict, text, misalignment) from a critic's answer about a section."""
    s = strip(c)
    head = strip(F.get(F.split(s, "\n"), F.lit(0)))
    inline = strip(F.substring(head, 5, 1 << 30))
    rest = strip(F.when(F.locate("\n", s) > 0, F.substring(s, F.locate("\n", s) + 1, F.lit(1 << 30))).otherwise(F.lit("")))
    both = strip(F.concat_ws("\n", F.nullif(inline, F.lit("")), F.nullif(rest, F.lit(""))))
    good, bad = F.upper(head).startswith("PASS"), F.upper(head).startswith("FAIL")
    text = (
        F.when(s == "", F.lit("Critic returned an empty response.")).when(good, F.coalesce(F.nullif(inline, F.lit("")), F.nullif(rest, F.lit("")), F.lit("Narrative follows the expected arc.")))
        .when(bad, F.coalesce(F.nullif(both, F.lit("")), F.lit("Critic did not explain the failure."))).otherwise(s)
    )
    verdict = F.when((s == "") | good, F.lit("PASS")).when(bad, F.lit("FAIL")).otherwise(F.lit("UNKNOWN"))
    return F.struct(verdict.alias("verdict"), text.alias("text"), F.when(bad, misalignment(both)).otherwise(F.lit("none")).alias("misalignment"))


def summary_paragraph(c: Column) -> Column:
    """The first paragraph of prose, fences left out; else the first paragraph; else nothing."""
    bare = strip(F.regexp_replace(c, r"(?is)```.*?```", ""))
    parts = F.filter(F.transform(F.split(bare, "\n\n"), strip), lambda p: p != "")
    prose = F.filter(parts, lambda p: ~F.lower(p).rlike("^(file:|source:|design intent:|table of|#)"))
    return F.coalesce(F.get(prose, F.lit(0)), F.get(parts, F.lit(0)), F.lit(""))


def mermaid(c: Column) -> Column:
    """(text without diagrams, the first diagram)."""
    fence = r"(?is)```mermaid\s*\n(.*?)```"
    return F.struct(strip(F.regexp_replace(c, fence, "")).alias("text"), F.nullif(strip(F.regexp_extract(c, fence, 1)), F.lit("")).alias("mermaid"))


def slug(c: Column, commit: Column | None = None) -> Column:
    s = F.translate(c, "/ ", "__")
    return s if commit is None else F.when(commit.isNull(), s).otherwise(F.concat(s, F.lit("_"), F.regexp_replace(F.substring(commit, 1, 12), "[^A-Za-z0-9]", "-")))


def repo_target(c: Column, default_commit: str | None = None) -> Column:
    """(repo, commit) of ``repo[@commit]``."""
    parts = F.split(strip(c), "@", 2)
    return F.struct(strip(F.get(parts, F.lit(0))).alias("repo"), F.coalesce(F.nullif(strip(F.get(parts, F.lit(1))), F.lit("")), F.lit(default_commit)).alias("commit"))


def output_name(repo: Column, commit: Column | None, kind: str, as_json: bool = False) -> Column:
    """The name of an output file of a repository: dataset or narratives, as text or JSON."""
    return F.concat(slug(repo, commit), F.lit(f"_{kind}.{'json' if as_json else 'txt'}"))


def json_from_answer(c: Column) -> Column:
    """What stands in a fence that begins a model's answer, its language included; else the first brace to the last one; else the answer."""

    def part(t: Column) -> Column:
        fenced, braced = F.regexp_extract(t, r"(?s)^```(.+?)```", 1), F.regexp_extract(t, r"(?s)\{.*\}", 0)
        return F.when(t.rlike(r"(?s)^```.+?```"), strip(fenced)).when(braced != "", braced).otherwise(t)

    return once(strip(c), part)


def is_failure(verdict: Column, kind: Column) -> Column:
    return (F.upper(F.coalesce(verdict, F.lit("UNKNOWN"))) != "PASS") | ~F.lower(F.coalesce(kind, F.lit(""))).isin("", "none")


LANGUAGES = {
    "python": ("py",), "rust": ("rs",), "go": ("go",), "typescript": ("ts",), "tsx": ("tsx",), "javascript": ("js",), "jsx": ("jsx",), "json": ("json",), "yaml": ("yml", "yaml"), "toml": ("toml",),
    "ini": ("cfg", "ini"), "bash": ("bash", "sh"), "markdown": ("md",), "rst": ("rst",), "text": ("txt",), "sql": ("sql",), "java": ("java",), "c": ("h", "c"), "cpp": ("hpp", "cpp"),
}


def language(path: Column) -> Column:
    """Language by the file's suffix."""
    known = F.create_map(*[F.lit(x) for name, ends in LANGUAGES.items() for e in ends for x in (e, name)])
    return F.coalesce(F.try_element_at(known, F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))), F.lit("text"))


def merge_code(narrative: Column, blocks: Column) -> Column:
    """(text, matched, refs): each block's code after the first mention of its reference in the text as it is by then, or at the end;
    ``refs``: the references that were found, in order. Null blocks are none."""
    bare = F.transform(blocks, lambda b: F.struct(strip(F.coalesce(b["reference"], F.lit(""))).alias("reference"), strip(F.coalesce(b["code"], F.lit(""))).alias("code")))
    usable = F.filter(bare, lambda b: (b["reference"] != "") & (b["code"] != "") & ~F.lower(b["reference"]).startswith("readme"))
    none = F.array().cast("array<string>")
    zero = F.struct(narrative.alias("text"), none.alias("refs"), none.alias("rest"))

    def step(acc: Column, b: Column) -> Column:
        put, found = F.concat(b["reference"], F.lit("\n"), b["code"]), F.contains(acc["text"], b["reference"])
        return F.struct(
            F.when(found, F.overlay(acc["text"], put, F.position(b["reference"], acc["text"]), F.length(b["reference"]))).otherwise(acc["text"]).alias("text"),
            F.when(found, F.array_append(acc["refs"], b["reference"])).otherwise(acc["refs"]).alias("refs"), F.when(found, acc["rest"]).otherwise(F.array_append(acc["rest"], put)).alias("rest"),
        )

    done = F.aggregate(F.coalesce(usable, F.array().cast("array<struct<reference:string,code:string>>")), zero, step)
    text = lambda d: F.when(F.size(d["rest"]) > 0, F.concat_ws("\n\n", F.rtrim(d["text"], F.lit(WHITE)), F.array_join(d["rest"], "\n\n"))).otherwise(d["text"])
    return once(done, lambda d: F.struct(strip(text(d)).alias("text"), F.size(d["refs"]).alias("matched"), d["refs"].alias("refs")))
