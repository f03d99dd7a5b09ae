"""Reviewers: anything that answers a prompt. One asks a chat service over HTTP, one decides by rules."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

from graphloom.operators.responses import parse_winner

#: What a chat service is told: its task, the edits there are, and the form of the answer.
SYSTEM = """You review one entity of a knowledge graph made from scanned API manuals. You see the entity, its edges and its neighbours.
Decide whether it is a real API element (keep), scan noise (delete) or the same as another one (merge). Improve its fields only where the text shown supports it.

Edits:
- {"op": "update_field", "field": "description|entity_type|syntax|return_value|remarks|header|deprecated", "value": "..."}
- {"op": "add_edge", "target": "NAME", "edge_type": "..."}
- {"op": "delete_edge", "target": "NAME", "edge_type": "..."} (without edge_type: of any type)
- {"op": "add_node", "name": "NAME", "entity_type": "...", "description": "..."}
- {"op": "delete_node", "reason": "..."}
- {"op": "merge_into", "target_id": "ID of the other entity", "reason": "..."}

Answer with one JSON object and nothing else:
{"verdict": "keep|delete|merge", "confidence": 0.0 to 1.0, "summary": "one sentence", "operations": [edits, or none]}"""
#: What it is told when it compares two extractions of one document.
JUDGE = """You compare two extractions, A and B, of the same scanned API manual by samples of their entities: correct names, clear descriptions, filled fields, little scan noise.
Answer with one JSON object and nothing else: {"winner": "A" or "B", "confidence": 0.0 to 1.0, "reason": "one sentence"}"""
#: What a reviewer is: a prompt in, an answer or None out.
Reviewer = Callable[[str], str | None]


@dataclass(frozen=True)
class ChatConfig:
    """Where and how fast to ask."""

    api_base_url: str
    api_key: str
    model_name: str
    batch_size: int = 10
    max_workers: int = 4
    requests_per_min: int = 60
    max_retries: int = 3
    retry_backoff_base: float = 0.5


def load_config(path: str, provider: str = "deepseek") -> ChatConfig | None:
    """The configuration in a JSON file, None if there is no file. A local provider gets lower limits."""
    try:
        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
    except FileNotFoundError:
        return None
    limits = {k: raw[k] for k in ("batch_size", "max_workers", "requests_per_min", "max_retries", "retry_backoff_base") if k in raw}
    if provider != "ollama":
        return ChatConfig(raw["api_base_url"], raw["api_key"], raw["model_name"], **limits)
    own = raw.get("ollama", {})
    limits |= {"max_workers": min(limits.get("max_workers", 4), 2), "requests_per_min": min(limits.get("requests_per_min", 60), 30)}
    return ChatConfig(own.get("api_base_url", "http://localhost:11434") + "/v1", "ollama", own.get("model_name", "qwen3:1.7b"), **limits)


@dataclass
class ChatClient:
    """A reviewer over HTTP with pacing and retries; ``send`` and ``sleep`` can be replaced in tests.

    Each worker has a copy that paces itself; ``share`` is the number of workers among which the requests per minute are divided.
    """

    config: ChatConfig
    system: str = SYSTEM
    share: int = 1
    send: Callable[[urllib.request.Request], tuple[int, bytes]] | None = None
    sleep: Callable[[float], None] = time.sleep
    calls: int = 0
    errors: int = 0
    tokens_in: int = 0
    tokens_out: int = 0
    _last: float = field(default=0.0, repr=False)

    def _wait_turn(self) -> None:
        wait = 60.0 * self.share / self.config.requests_per_min - (time.monotonic() - self._last)
        if wait > 0 and self._last:
            self.sleep(wait)
        self._last = time.monotonic()

    def _post(self, request: urllib.request.Request) -> tuple[int, bytes]:
        if self.send is not None:
            return self.send(request)
        try:
            with urllib.request.urlopen(request, timeout=120) as r:
                return r.status, r.read()
        except urllib.error.HTTPError as e:
            return e.code, b""

    def __call__(self, prompt: str) -> str | None:
        messages = [{"role": "system", "content": self.system}, {"role": "user", "content": prompt}]
        body = {"model": self.config.model_name, "messages": messages, "temperature": 0.3, "max_tokens": 2048}
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.config.api_key}"}
        request = urllib.request.Request(f"{self.config.api_base_url}/chat/completions", json.dumps(body).encode(), headers)
        base = self.config.retry_backoff_base
        for attempt in range(self.config.max_retries):
            self._wait_turn()
            self.calls += 1
            try:
                status, data = self._post(request)
            except (TimeoutError, OSError):
                self.errors += 1
                self.sleep(base * 2**attempt + 2)
                continue
            if status == 200:
                answer = json.loads(data)
                used = answer.get("usage", {})
                self.tokens_in += used.get("prompt_tokens", 0)
                self.tokens_out += used.get("completion_tokens", 0)
                return answer["choices"][0]["message"]["content"]
            self.errors += 1
            if status != 429 and status < 500:
                return None
            self.sleep(base * 2**attempt + (1 if status == 429 else 0))
        return None


def keep_all(prompt: str) -> str:
    """A reviewer without a service: keeps everything as it is."""
    return json.dumps({"verdict": "keep", "confidence": 1.0, "summary": "", "operations": []})


@dataclass
class Judge:
    """Puts samples of two extractions to a reviewer; "A", "B" or None."""

    ask: Reviewer

    def __call__(self, a: list[dict], b: list[dict]) -> str | None:
        shown = lambda rows: json.dumps([{"name": r["name"], "type": r["entity_type"], "description": (r["description"] or "")[:100], "confidence": r["confidence"]} for r in rows], ensure_ascii=False, indent=1)
        return parse_winner(self.ask(f"A:\n{shown(a)}\n\nB:\n{shown(b)}"))
