"""Polite page fetching for the landing of pages; the transport is given by the caller.

The engine itself reads landed tables. A transport is any function of (url, headers,
timeout) that returns :class:`Answer` or raises ``OSError``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser


class FetchError(Exception):
    """A page that can't be had."""


@dataclass(frozen=True)
class Answer:
    status: int
    text: str = ""
    encoding: str | None = "utf-8"
    headers: dict[str, str] = field(default_factory=dict)
    raw: bytes = b""

    def decoded(self) -> Answer:
        """With the text that the bytes are in the answer's encoding, UTF-8 where it has none or one that isn't known."""
        try:
            text = self.raw.decode(self.encoding or "utf-8", "replace")
        except LookupError:
            text = self.raw.decode("utf-8", "replace")
        return replace(self, text=text)


@dataclass(frozen=True)
class Page:
    url: str
    html: str | None
    etag: str | None = None
    last_modified: str | None = None
    not_modified: bool = False


#: Answers that are worth another attempt.
AGAIN = frozenset((429, 500, 502, 503, 504))


class Fetcher:
    """One request after another: a least delay, attempts with growing waits, robots rules a host."""

    def __init__(self, transport: Callable[[str, dict[str, str], float], Answer], delay: float = 1.5, timeout: float = 30, attempts: int = 4, backoff: float = 2, robots: bool = False, agent: str = "sijill", sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.transport, self.delay, self.timeout, self.attempts, self.backoff, self.robots, self.agent = transport, delay, timeout, attempts, backoff, robots, agent
        self.sleep, self.clock, self.last = sleep, clock, None
        self.rules: dict[str, RobotFileParser | None] = {}

    def _ask(self, url: str, headers: dict[str, str]) -> Answer:
        if self.last is not None and (wait := self.last + self.delay - self.clock()) > 0:
            self.sleep(wait)
        try:
            return self.transport(url, {"User-Agent": self.agent} | headers, self.timeout)
        finally:
            self.last = self.clock()

    def _allowed(self, url: str) -> bool:
        """Rules that can't be read allow everything."""
        place = urlsplit(url)
        if place.netloc not in self.rules:
            rules = None
            try:
                answer = self._ask(f"{place.scheme}://{place.netloc}/robots.txt", {})
                if answer.status == 200:
                    rules = RobotFileParser()
                    rules.parse(answer.text.splitlines())
            except OSError:
                pass
            self.rules[place.netloc] = rules
        rules = self.rules[place.netloc]
        return rules is None or rules.can_fetch(self.agent, url)

    def fetch(self, url: str, etag: str | None = None, last_modified: str | None = None) -> Page:
        """With validators the request is conditional: an unchanged page has no text and keeps them."""
        if self.robots and not self._allowed(url):
            raise FetchError(f"robots.txt disallows {url}")
        headers = {k: v for k, v in (("If-None-Match", etag), ("If-Modified-Since", last_modified)) if v}
        why = ""
        for attempt in range(self.attempts):
            if attempt:
                self.sleep(self.backoff**attempt)
            try:
                answer = self._ask(url, headers)
            except OSError as error:
                why = str(error)
                continue
            if answer.status == 304 and headers:
                return Page(url, None, etag, last_modified, True)
            if answer.status in AGAIN:
                why = f"status {answer.status}"
                continue
            if answer.status >= 400:
                raise FetchError(f"status {answer.status}: {url}")
            own = {k.lower(): v for k, v in answer.headers.items()}
            guessed = (answer.encoding or "").lower() in ("", "iso-8859-1")
            text = answer.raw.decode("utf-8", "replace") if guessed and answer.raw else answer.text
            return Page(url, text, own.get("etag"), own.get("last-modified"))
        raise FetchError(f"{self.attempts} attempts: {url}: {why}")
