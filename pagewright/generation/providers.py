"""Clients of model providers: what a request looks like on the wire, and a client from settings."""

from __future__ import annotations

import base64
import json
import os
import re
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pagewright.generation.client import Client, OfflineClient, Reply, Request, RetryingClient, Throttled
from pagewright.generation.config import ProviderConfig

_DATA_URL = re.compile(r"data:image/(png|jpe?g);base64,(.*)", re.S)

#: Generation arguments, and what they are called in a converse request.
CONVERSE_NAMES = {"temperature": "temperature", "top_p": "topP", "stop": "stopSequences", "max_tokens": "maxTokens", "max_completion_tokens": "maxTokens"}
#: Error codes by which a provider asks to come back later.
THROTTLING = ("ThrottlingException", "TooManyRequestsException", "ServiceUnavailableException", "ModelNotReadyException")


def instruction(schema: str) -> str:
    """What asks for a reply that fits a schema of field names and kinds."""
    return f"Reply with one JSON object and nothing else. Its fields and their kinds: {schema}"


def count_of(value: Any) -> int:
    """A token count: whole numbers that aren't negative, 0 for anything else."""
    return value if isinstance(value, int) and not isinstance(value, bool) and value >= 0 else 0


def request_parts(request: Request) -> list[dict[str, Any]]:
    """The request as one user turn: text, images with their captions, and what is asked for."""
    parts: list[dict[str, Any]] = [{"type": "text", "text": request.prompt}]
    for place, url in enumerate(request.images):
        if place < len(request.captions):
            parts.append({"type": "text", "text": request.captions[place]})
        parts.append({"type": "image_url", "image_url": url})
    return parts


# --- converse -------------------------------------------------------------------------------


def converse_blocks(content: str | list[dict[str, Any]]) -> list[dict[str, Any]]:
    """Content blocks of a turn; image URLs become bytes with their format."""
    if isinstance(content, str):
        return [{"text": content}]
    if not isinstance(content, list):
        raise ValueError(f"content must be text or a list of parts, not {type(content).__name__}")
    blocks = []
    for part in content:
        kind = part.get("type")
        if kind == "text" and isinstance(part.get("text"), str):
            blocks.append({"text": part["text"]})
        elif kind == "image_url" and isinstance(part.get("image_url"), str) and (found := _DATA_URL.fullmatch(part["image_url"])):
            blocks.append({"image": {"format": "png" if found[1] == "png" else "jpeg", "source": {"bytes": base64.b64decode(found[2], validate=True)}}})
        else:
            raise ValueError(f"not a part that can be sent: {kind}")
    return blocks


def converse_body(messages: list[dict[str, Any]], arguments: dict[str, Any], schema: str | None = None) -> dict[str, Any]:
    """messages, system and inferenceConfig of a converse request.

    System turns are gathered apart, as text only; a schema's instruction ends the last user
    turn, or makes one.  Arguments that the request has no place for are an error.
    """
    unknown = sorted(set(arguments) - set(CONVERSE_NAMES))
    if unknown:
        raise ValueError(f"unknown generation arguments: {unknown}")
    turns, system = [], []
    for message in messages:
        role, blocks = message.get("role"), converse_blocks(message.get("content"))
        if role == "system":
            if any("text" not in b for b in blocks):
                raise ValueError("a system turn holds text only")
            system += blocks
        elif role in ("user", "assistant"):
            turns.append({"role": role, "content": blocks})
        else:
            raise ValueError(f"unknown role: {role}")
    if schema is not None:
        last = next((t for t in reversed(turns) if t["role"] == "user"), None)
        if last is None:
            turns.append({"role": "user", "content": []})
            last = turns[-1]
        last["content"].append({"text": instruction(schema)})
    settings: dict[str, Any] = {}
    for name in ("max_completion_tokens", "max_tokens", "temperature", "top_p", "stop"):  # of two limits the second counts
        if name in arguments:
            settings[CONVERSE_NAMES[name]] = arguments[name]
    if "stopSequences" in settings:
        stop = settings["stopSequences"]
        stop = [stop] if isinstance(stop, str) else stop
        if not isinstance(stop, list) or not all(isinstance(x, str) for x in stop):
            raise ValueError("stop must be a string or a list of strings")
        settings["stopSequences"] = stop
    return {"messages": turns, **({"system": system} if system else {}), **({"inferenceConfig": settings} if settings else {})}


@dataclass
class ConverseCall:
    """One request through a converse function, ``converse(modelId=..., messages=...)``.

    The function comes from connect(), which is called once in each process, so that the object
    travels to the tasks without it.
    """

    model: str
    connect: Callable[[], Callable[..., dict[str, Any]]]
    arguments: dict[str, Any] = field(default_factory=dict)

    def __getstate__(self) -> dict[str, Any]:
        return {k: v for k, v in self.__dict__.items() if k != "_converse"}

    def __call__(self, request: Request) -> Reply:
        if "_converse" not in self.__dict__:
            self._converse = self.connect()
        body = converse_body([{"role": "user", "content": request_parts(request)}], {"max_tokens": request.max_tokens, **self.arguments}, request.schema)
        try:
            answer = self._converse(modelId=self.model, **body)
        except Exception as error:
            code = getattr(error, "response", {}).get("Error", {}).get("Code", type(error).__name__)
            if code in THROTTLING:
                raise Throttled(str(error)) from error
            raise
        blocks = answer.get("output", {}).get("message", {}).get("content", [])
        usage = answer.get("usage") or {}
        return Reply(True, "".join(b.get("text", "") for b in blocks), None, count_of(usage.get("inputTokens")), count_of(usage.get("outputTokens")))


# --- chat completions over HTTP -------------------------------------------------------------


def post(url: str, headers: dict[str, str], body: bytes, timeout: float) -> tuple[int, bytes]:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json", **headers})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read()
    except urllib.error.HTTPError as error:
        return error.code, error.read()


@dataclass
class CompletionCall:
    """One request to an endpoint of chat completions; the key is read where the call is made."""

    model: str
    url: str
    key_variable: str = "MODEL_API_KEY"
    arguments: dict[str, Any] = field(default_factory=dict)
    timeout: float = 3_600.0
    send: Callable[[str, dict[str, str], bytes, float], tuple[int, bytes]] = post

    def __call__(self, request: Request) -> Reply:
        parts = [p if p["type"] == "text" else {"type": "image_url", "image_url": {"url": p["image_url"]}} for p in request_parts(request)]
        if request.schema is not None:
            parts.append({"type": "text", "text": instruction(request.schema)})
        body = {"model": self.model, "max_tokens": request.max_tokens, **self.arguments, "messages": [{"role": "user", "content": parts}]}
        key = os.environ.get(self.key_variable, "")
        status, answer = self.send(self.url, {"Authorization": f"Bearer {key}"} if key else {}, json.dumps(body).encode(), self.timeout)
        if status in (429, 503):
            raise Throttled(f"HTTP {status}")
        if status != 200:
            raise RuntimeError(f"HTTP {status}: {answer[:200].decode(errors='replace')}")
        read = json.loads(answer)
        usage = read.get("usage") or {}
        return Reply(True, read["choices"][0]["message"]["content"], None, count_of(usage.get("prompt_tokens")), count_of(usage.get("completion_tokens")))


# --- from settings --------------------------------------------------------------------------


@dataclass
class _Connect:
    region: str | None

    def __call__(self) -> Callable[..., dict[str, Any]]:
        try:
            import boto3
        except ImportError as error:
            raise RuntimeError("the provider 'converse' needs its SDK, boto3") from error
        return boto3.client("bedrock-runtime", region_name=self.region).converse


def make_client(config: ProviderConfig, role: str = "text", url: str | None = None, connect: Callable[[], Callable[..., dict[str, Any]]] | None = None, threads: int = 4) -> Client:
    """The client of a role: 'offline', 'converse' or 'completions' (which needs a url).

    Arguments of the role are checked here, before any task runs.  The threads of each task are
    bounded by max_concurrency; tasks times threads is what a provider meets.
    """
    arguments = config.arguments(role)
    if config.provider == "offline":
        return OfflineClient()
    if config.provider == "converse":
        converse_body([], arguments)
        call: Callable[[Request], Reply] = ConverseCall(config.model(role), connect or _Connect(config.region), arguments)
    elif config.provider == "completions":
        if not url:
            raise ValueError("the provider 'completions' needs a url")
        call = CompletionCall(config.model(role), url, arguments=arguments)
    else:
        raise ValueError(f"unknown provider: {config.provider}")
    return RetryingClient(call, config.attempts, config.concurrency(threads), first_wait=config.first_wait, most_wait=config.most_wait)
