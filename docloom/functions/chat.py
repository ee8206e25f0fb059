"""A chat model over HTTP, as the narratives take one. The transport is a parameter, so that tests and clusters have their own."""

from __future__ import annotations

import json
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from itertools import count

from .config import ChatConfig
from .references import chat_content
from .text import truncated

#: Takes an address, the body, headers and a timeout; gives the status and the text of the answer, or raises OSError.
Post = Callable[[str, dict, dict, float], tuple[int, str]]


class ChatError(RuntimeError):
    """A chat call that gave no answer."""


def http_post(url: str, body: dict, headers: dict, timeout: float) -> tuple[int, str]:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.status, r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def summarised(text: str | None, limit: int = 500) -> str:
    """The start of a body for a message."""
    s = (text or "").strip()
    return "<empty response body>" if not s else s if len(s) <= limit else f"{s[:limit]}... [truncated]"


def bad_request(body: str | None) -> tuple[str, str]:
    """(hint, detail) of the body of a refused request."""
    try:
        value = json.loads(body or "")
    except ValueError:
        low = (body or "").lower()
        if "context" in low and "token" in low:
            hint = "probable context length limit"
        else:
            hint = "probable max_tokens limit" if "max token" in low or "too many tokens" in low else "cause unknown"
        return hint, summarised(body)
    error = value.get("error") if isinstance(value, dict) else None
    if not isinstance(error, dict):
        return "cause unknown", summarised(json.dumps(value) if isinstance(value, dict) else str(value))
    message, code, kind = str(error.get("message") or ""), error.get("code"), error.get("type")
    code, low = code.strip() if isinstance(code, str) else "", message.lower()
    if code in ("context_length_exceeded", "max_context_length_exceeded", "context_length"):
        hint = f"context length exceeded ({code})"
    elif code in ("too_many_tokens", "max_tokens_exceeded"):
        hint = f"token limit exceeded ({code})"
    elif code:
        hint = code
    elif "context length" in low or "token limit" in low:
        hint = "probable context length limit"
    elif "max tokens" in low or "too many tokens" in low:
        hint = "probable max_tokens limit"
    else:
        hint = kind.strip() if isinstance(kind, str) and kind.strip() else "cause unknown"
    return hint, summarised(message or json.dumps(error))


def post_with_retry(url: str, body: dict, headers: dict | None = None, timeout: float = 60.0, retries: int = 2, backoff: float = 2.0, post: Post = http_post, sleep=time.sleep) -> dict:
    """The decoded answer. A refused request (400) fails at once; other failures are tried again, each after a longer wait."""
    for attempt in count(1):
        try:
            status, text = post(url, body, headers or {}, timeout)
            if status == 400:
                hint, detail = bad_request(text)
                raise ChatError(f"refused with status 400 ({hint}): {detail}")
            if status >= 400:
                raise OSError(f"status {status}")
            return json.loads(text)
        except (OSError, ValueError) as e:
            if attempt > retries:
                raise ChatError(f"no answer after {retries} retries: {e}") from e
            sleep(backoff * attempt)
    raise AssertionError


#: What each task asks of the model, unless the settings have a prompt of their own.
PROMPTS = {
    "rewrite": "Write the thoughts of an engineer who is about to write the code below: limits, options that were turned down and why. Plain prose, no lists, no summary of the text.",
    "critique": "Does the text give reasons from before the code was there, and not a description of the code? Begin with PASS or FAIL; after FAIL say what is missing.",
    "refine": "Revise the draft so that the remark is met. Keep what already gives limits and choices; plain prose.",
    "summarise": "Sum up in three or four sentences what the page says about features, duties and dependencies.",
}


def messages_for(task: str, parts: dict, prompts: dict | None = None) -> list[dict]:
    """The messages of a task (see :data:`operators.narrate.Model`); long parts are shortened."""
    limits = {"code": 6000, "narrative": 4000}
    shown = [f"{k}: {truncated(str(v), limits[k]) if k in limits else str(v).strip()}" for k, v in parts.items() if k != "stub" and isinstance(v, (str, int, float)) and str(v).strip()]
    system = (prompts or {}).get(task) or PROMPTS[task.split("_")[0]]
    return [{"role": "system", "content": system}, {"role": "user", "content": "\n\n".join(shown)}]


class ChatModel:
    """A callable model; tasks go round the endpoints in turn, and a closed connection is tried once on the next one.

    It is pickled with its settings alone, so each worker has its own turn.
    """

    def __init__(self, config: ChatConfig, post: Post = http_post):
        self.config, self.post = config, post
        self._start()

    def _start(self) -> None:
        self._turn, self._lock = 0, threading.Lock()

    def __getstate__(self) -> dict:
        return {"config": self.config, "post": self.post}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._start()

    def chat(self, messages: list[dict]) -> str:
        c, pool = self.config, self.config.endpoints()
        body = {"model": c.model, "messages": messages, "temperature": c.temperature} | {k: v for k, v in (("max_tokens", c.max_tokens), ("top_p", c.top_p)) if v is not None}
        headers = {k: v for k, v in (("Authorization", c.api_key and f"Bearer {c.api_key}"), ("Destination-Service", c.service or (len(pool) > 1 and "openai"))) if v}
        for again in (True, False):
            with self._lock:
                url, self._turn = pool[self._turn % len(pool)], self._turn + 1
            try:
                answer = post_with_retry(url, body, headers, c.timeout, c.retries, c.backoff, self.post)
                break
            except ChatError as e:
                if not again or "connection is closed" not in str(e).lower():
                    raise
        text = chat_content(answer)
        if text is None:
            raise ChatError("the answer has no message")
        return text

    def __call__(self, task: str, parts: dict) -> str:
        return self.chat(messages_for(task, parts, dict(self.config.prompts)))
