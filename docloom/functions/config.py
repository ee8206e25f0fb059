"""Settings and their rules: modes, endpoints, prompts, arguments. Plain Python for the driver, as none of it is data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import urlsplit, urlunsplit

_MODES = {"code": "code", "rewrite": "code", "critic": "critic", "critique": "critic", "cross": "critic"}


class SettingError(ValueError):
    """A setting that does not fit."""


def narrative_modes(modes: Iterable[str] | None) -> list[str]:
    """Modes by their aliases, distinct, in order; unknown ones are left out; 'code' where none is left."""
    return list(dict.fromkeys(_MODES[m.lower()] for m in modes or () if m.lower() in _MODES)) or ["code"]


def url_list(values: Iterable[str] | None) -> list[str] | None:
    """Distinct addresses of comma-separated lists, in order."""
    return list(dict.fromkeys(p.strip() for v in values or () for p in (v or "").split(",") if p.strip())) or None


def host_in_url(host: str) -> str:
    """A host for an address: an IPv6 one in brackets."""
    h = host.strip()
    return f"[{h}]" if ":" in h and h[:1] != "[" and h[-1:] != "]" else h


def build_url(server_url: str | None, host: str, port: int, path: str) -> str:
    return server_url or f"http://{host_in_url(host)}:{port}/{path.removeprefix('/')}"


def endpoint(value: str | None, host: str, port: int, path: str) -> str | None:
    """An address with scheme and path, without query, fragment and last slashes; without a host it is a path on the default one."""
    raw = "" if value is None else str(value).strip()
    if not raw:
        return None
    u = urlsplit(raw if "://" in raw else f"http://{raw}")
    if not u.netloc:
        return build_url(None, host, port, u.path or path)
    p = path if u.path in ("", "/") else u.path
    return urlunsplit((u.scheme or "http", u.netloc, "/" + p.removeprefix("/").rstrip("/"), "", "")).rstrip("/")


def endpoint_pool(urls: Iterable[str], host: str, port: int, path: str, fallback: str | None = None) -> list[str]:
    """Distinct endpoints, the fallback last; the default one where there is none."""
    found = [e for u in [*urls, fallback] if (e := endpoint(u, host, port, path))]
    return list(dict.fromkeys(found)) or [build_url(None, host, port, path)]


def prompt_text(given: str | None, what: str = "prompt") -> str | None:
    """A literal prompt, or the file that ``@path`` names."""
    if not given:
        return None
    if not given.startswith("@"):
        return given
    path = Path(given[1:]).expanduser()
    if not path.exists():
        raise SettingError(f"{what} file not found: {path}")
    return path.read_text(encoding="utf-8")


@dataclass
class ChatConfig:
    """Where and how a chat model is asked."""

    model: str
    host: str = "localhost"
    port: int = 8000
    path: str = "/v1/chat/completions"
    temperature: float = 0.0
    top_p: float | None = None
    max_tokens: int | None = None
    api_key: str | None = None
    service: str | None = None
    timeout: float = 60.0
    retries: int = 2
    backoff: float = 2.0
    server_url: str | None = None
    server_urls: list[str] | None = None
    prompts: Mapping[str, str] = field(default_factory=dict)

    def endpoints(self) -> list[str]:
        """The pool where there is one, else the one address."""
        if self.server_urls:
            return endpoint_pool(self.server_urls, self.host, self.port, self.path, self.server_url)
        return [build_url(self.server_url, self.host, self.port, self.path)]


def chat_config(args: Mapping[str, object], prefix: str, system_prompt: str | None = None) -> ChatConfig:
    """The settings with a prefix, such as ``design_``; 0 or nothing for max_tokens and top_p is no limit."""
    get = lambda name, default=None: args.get(f"{prefix}{name}") if args.get(f"{prefix}{name}") is not None else default
    return ChatConfig(
        model=str(get("model", "")), host=str(get("host", "localhost")), port=int(get("port", 8000)), path=str(get("path", "/v1/chat/completions")), temperature=float(get("temperature", 0.0)),
        top_p=get("top_p") or None, max_tokens=get("max_tokens") or None, api_key=get("api_key"), service=get("service"), timeout=float(get("timeout", 60.0)), retries=int(get("retries", 2)),
        backoff=float(get("backoff", 2.0)), server_url=get("server_url"), server_urls=url_list(get("server_urls")), prompts={"critique_section": system_prompt, "critique_block": system_prompt} if system_prompt else {},
    )


#: (what is wrong, when): ``a`` has the settings, ``n`` is the number of targets.
_RULES = (
    ("output needs targets", lambda a, n: a("output") and not n),
    ("output_format needs targets", lambda a, n: a("output_format", "text") != "text" and not n),
    ("design_use needs targets", lambda a, n: a("design_use") and not n),
    ("judge_use needs targets", lambda a, n: a("judge_use") and not n),
    ("design_use needs design_model", lambda a, n: a("design_use") and not a("design_model")),
    ("judge_use needs judge_model", lambda a, n: a("judge_use") and not a("judge_model")),
    ("narrative_output needs targets", lambda a, n: a("narrative_output") and not n),
    ("narrative_modes needs narrative_output", lambda a, n: a("narrative_modes") and not a("narrative_output")),
    *((f"{name} must be at least 1", lambda a, n, name=name: a(name) is not None and a(name) < 1) for name in ("judge_rounds", "max_pages", "max_sections", "max_workers", "repo_workers", "repo_batch_size")),
    ("several targets need output_dir", lambda a, n: n > 1 and a("output") and not a("output_dir")),
    ("several targets need narrative_output_dir", lambda a, n: n > 1 and a("narrative_output") and not a("narrative_output_dir")),
    ("wiki_dir is no folder", lambda a, n: a("wiki_dir") and "://" not in str(a("wiki_dir")) and not Path(str(a("wiki_dir"))).expanduser().is_dir()),
)


def check_settings(args: Mapping[str, object], n_targets: int) -> list[str]:
    """What is wrong with the settings, in the order of the rules."""
    a = lambda name, default=None: default if args.get(name) is None else args[name]
    return [what for what, wrong in _RULES if wrong(a, n_targets)]
