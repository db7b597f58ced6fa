"""Clients that answer prompts.  A client is an object with ``generate(requests) -> replies``."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol


@dataclass(frozen=True)
class Request:
    """One prompt: text, images as data URLs, each with a caption if there are any, and the
    model's arguments."""

    prompt: str
    images: tuple[str, ...] = ()
    max_tokens: int = 10_000
    schema: str | None = None
    captions: tuple[str, ...] = ()


@dataclass(frozen=True)
class Reply:
    """An answer, or an error where ok is false, with its token counts."""

    ok: bool
    text: str | None = None
    error: str | None = None
    input_tokens: int = 0
    output_tokens: int = 0


class Client(Protocol):
    def generate(self, requests: Sequence[Request]) -> list[Reply]: ...


class Throttled(Exception):
    """The provider asks to come back later."""


def backoff(attempt: int, first: float = 60.0, factor: float = 2.0, most: float = 300.0) -> float:
    """Seconds to wait after a failed attempt, counted from 0."""
    return min(first * factor**attempt, most)


@dataclass
class RetryingClient:
    """Calls one request at a time through call(), in a pool of threads.

    Throttling is tried again after growing waits; any other error becomes a reply that is not
    ok, or is raised where strict.  A row's failure leaves the others alone.
    """

    call: Callable[[Request], Reply]
    attempts: int = 3
    threads: int = 4
    strict: bool = False
    first_wait: float = 60.0
    most_wait: float = 300.0
    sleep: Callable[[float], None] = field(default=time.sleep, repr=False)

    def _one(self, request: Request) -> Reply:
        for attempt in range(self.attempts):
            try:
                return self.call(request)
            except Throttled as error:
                if attempt + 1 == self.attempts:
                    return Reply(False, error=f"{type(error).__name__}: {error}")
                self.sleep(backoff(attempt, self.first_wait, 2.0, self.most_wait))
            except Exception as error:
                if self.strict:
                    raise
                return Reply(False, error=f"{type(error).__name__}: {error}")
        raise AssertionError("unreachable")

    def generate(self, requests: Sequence[Request]) -> list[Reply]:
        with ThreadPoolExecutor(max(1, self.threads)) as pool:
            return list(pool.map(self._one, requests))


@dataclass
class OfflineClient:
    """A stand-in whose replies depend on nothing but the prompt, for tests and dry runs.

    With a schema (a JSON object of field names and kinds 'text', 'flag', 'grade' or 'list')
    the reply is a JSON object, whose flags and grades are hashes of the prompt's hash and the
    field's name; every fail_every-th prompt, by its hash, fails.
    """

    fail_every: int = 0

    def generate(self, requests: Sequence[Request]) -> list[Reply]:
        return [self._one(r) for r in requests]

    def _one(self, request: Request) -> Reply:
        digest = hashlib.md5(request.prompt.encode()).hexdigest()
        if self.fail_every and int(digest[:8], 16) % self.fail_every == 0:
            return Reply(False, error="OfflineError: chosen to fail", input_tokens=len(request.prompt) // 4)
        draw = lambda k: int(hashlib.md5(f"{digest}|{k}".encode()).hexdigest()[:8], 16)
        if request.schema is None:
            text = f"summary {digest[:12]}"
        else:
            makers = {"text": lambda k: f"{k} {digest[:8]}", "flag": lambda k: draw(k) % 2 == 1, "grade": lambda k: draw(k) % 5 + 1, "list": lambda k: [f"{k} {digest[:8]} {n}" for n in range(3)]}
            text = json.dumps({k: makers[kind](k) for k, kind in json.loads(request.schema).items()})
        return Reply(True, text, None, len(request.prompt) // 4, len(text) // 4)
