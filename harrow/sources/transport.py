"""Ways to fetch a URL: from memory, from a fixture file, or over HTTP."""

from __future__ import annotations

import gzip
import json
import time
import urllib.error
import urllib.request
from dataclasses import dataclass, field
from typing import Protocol

Answer = tuple[int | None, str | None, str | None]


class Transport(Protocol):
    """A fetcher that tasks can carry: status, body and error of a URL."""

    def get(self, url: str) -> Answer: ...


@dataclass
class MemoryTransport:
    """Answers by URL; any other URL gets 404."""

    answers: dict[str, tuple[int | None, str]] = field(default_factory=dict)

    def get(self, url: str) -> Answer:
        status, body = self.answers.get(url, (404, ""))
        return (status, body, None) if status is not None else (None, None, body)


@dataclass
class FixtureTransport:
    """Answers from a JSON Lines file of url, status and body that every executor can open."""

    path: str
    _answers: dict | None = None

    def get(self, url: str) -> Answer:
        if self._answers is None:
            with open(self.path, encoding="utf-8") as f:
                self._answers = {x["url"]: (x.get("status"), x.get("body", "")) for x in map(json.loads, f)}
        return MemoryTransport(self._answers).get(url)


@dataclass
class HttpTransport:
    """HTTP with a timeout, a least delay between the requests of a task, and optional proxy."""

    timeout: float = 45.0
    delay: float = 0.0
    user_agent: str = "harrow/1.0"
    proxy: str | None = None
    _last: float = 0.0

    def get(self, url: str) -> Answer:
        if (wait := self._last + self.delay - time.monotonic()) > 0:
            time.sleep(wait)
        self._last = time.monotonic()
        handlers = [urllib.request.ProxyHandler({"http": self.proxy, "https": self.proxy})] if self.proxy else []
        request = urllib.request.Request(url, headers={"User-Agent": self.user_agent, "Accept-Encoding": "gzip"})
        try:
            with urllib.request.build_opener(*handlers).open(request, timeout=self.timeout) as r:
                return r.status, _text(r.read(), r.headers.get("Content-Encoding")), None
        except urllib.error.HTTPError as e:
            return e.code, _text(e.read(), e.headers.get("Content-Encoding")), None
        except (OSError, ValueError) as e:
            return None, None, f"request failed: {e}"


def _text(raw: bytes, encoding: str | None) -> str:
    return (gzip.decompress(raw) if encoding == "gzip" else raw).decode("utf-8", "replace")
