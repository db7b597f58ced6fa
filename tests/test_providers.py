from __future__ import annotations

import base64
import json
import pickle

import pytest

from pagewright.generation.client import OfflineClient, Request, RetryingClient, Throttled
from pagewright.generation.config import ProviderConfig
from pagewright.generation.providers import CompletionCall, ConverseCall, converse_body, count_of, make_client, request_parts

URL = "data:image/jpg;base64," + base64.b64encode(b"bytes").decode()


def test_messages_of_a_converse_request():
    messages = [{"role": "system", "content": "be short"}, {"role": "user", "content": [{"type": "text", "text": "look"}, {"type": "image_url", "image_url": URL}]}, {"role": "assistant", "content": "yes"}]
    body = converse_body(messages, {"max_tokens": 5, "max_completion_tokens": 9, "stop": "x", "top_p": 0.5}, '{"a": "text"}')
    assert body["system"] == [{"text": "be short"}] and [m["role"] for m in body["messages"]] == ["user", "assistant"]
    user = body["messages"][0]["content"]
    assert user[1] == {"image": {"format": "jpeg", "source": {"bytes": b"bytes"}}} and '{"a": "text"}' in user[2]["text"]
    assert body["inferenceConfig"] == {"maxTokens": 5, "stopSequences": ["x"], "topP": 0.5}
    assert converse_body([], {}) == {"messages": []}
    assert converse_body([], {}, "{}")["messages"][0]["role"] == "user"
    for bad, arguments in (([{"role": "tool", "content": "x"}], {}), ([{"role": "system", "content": [{"type": "image_url", "image_url": URL}]}], {}), ([{"role": "user", "content": 5}], {}), ([{"role": "user", "content": [{"type": "image_url", "image_url": "http://x"}]}], {}), ([], {"seed": 1}), ([], {"stop": 3})):
        with pytest.raises(ValueError):
            converse_body(bad, arguments)


def test_captions_stand_before_their_images():
    parts = request_parts(Request("ask", (URL, URL), captions=("Images of section 1", "Images of section 2")))
    assert [p.get("text", "image") for p in parts] == ["ask", "Images of section 1", "image", "Images of section 2", "image"]


class Busy(Exception):
    response = {"Error": {"Code": "ThrottlingException"}}


def test_converse_retries_throttling_and_reads_usage():
    seen = []

    def converse(**body):
        seen.append(body)
        if len(seen) == 1:
            raise Busy("later")
        return {"output": {"message": {"content": [{"text": "fi"}, {"text": "ne"}]}}, "usage": {"inputTokens": 7, "outputTokens": -2}}

    config = ProviderConfig({"text": "m"}, {"text": {"temperature": 0.1}}, provider="converse", max_concurrency=2)
    client = make_client(config, connect=lambda: converse)
    assert isinstance(client, RetryingClient) and client.threads == 2
    client.sleep = lambda seconds: seen.append(seconds)
    reply = client.generate([Request("hello", schema='{"a": "text"}')])[0]
    assert (reply.ok, reply.text, reply.input_tokens, reply.output_tokens) == (True, "fine", 7, 0)
    assert seen[1] == 60.0 and seen[2]["modelId"] == "m" and seen[2]["inferenceConfig"] == {"maxTokens": 10_000, "temperature": 0.1}
    call = ConverseCall("m", dict)
    assert "_converse" not in pickle.loads(pickle.dumps(call)).__dict__
    assert [count_of(x) for x in (3, -1, True, 2.0, None, "4")] == [3, 0, 0, 0, 0, 0]


def test_completions():
    sent = []

    def send(url, headers, body, timeout):
        sent.append((url, headers, json.loads(body)))
        return {1: (429, b""), 2: (500, b"no"), 3: (200, json.dumps({"choices": [{"message": {"content": "ok"}}], "usage": {"prompt_tokens": 3, "completion_tokens": 1}}).encode())}[len(sent)]

    call = CompletionCall("m", "http://host/v1", "NO_SUCH_KEY", {"temperature": 0}, send=send)
    with pytest.raises(Throttled):
        call(Request("x"))
    with pytest.raises(RuntimeError, match="HTTP 500"):
        call(Request("x"))
    reply = call(Request("x", (URL,), 20, "{}"))
    assert (reply.text, reply.input_tokens, reply.output_tokens) == ("ok", 3, 1)
    body = sent[-1][2]
    assert body["max_tokens"] == 20 and body["temperature"] == 0 and body["messages"][0]["content"][1]["image_url"] == {"url": URL}


def test_clients_from_settings():
    assert isinstance(make_client(ProviderConfig({"text": "m"})), OfflineClient)
    for config in (ProviderConfig({"text": "m"}, provider="completions"), ProviderConfig({"text": "m"}, provider="other"), ProviderConfig({"text": "m"}, {"text": {"seed": 1}}, provider="converse")):
        with pytest.raises(ValueError):
            make_client(config)
    assert make_client(ProviderConfig({"text": "m"}, provider="completions"), url="http://x").call.url == "http://x"
