"""Language model backends: a protocol, a deterministic stand-in, requests within budget, and their conversations."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame

from ..functions import vocab as V
from ..storage import ship
from .store import json_hash

MAX_TRIES = 3
_CJK = re.compile("[" + re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), V.CJK) + "]")


class BudgetError(ValueError):
    """A request that its model could not hold."""


class Backend(Protocol):
    """Answers a prompt and a payload with an object. Backends are sent to executors, so they must be picklable."""

    def identity(self) -> str: ...

    def complete(self, prompt: str, payload: dict[str, Any]) -> dict[str, Any]: ...


def parse_object(text: str) -> dict[str, Any]:
    """The text as a JSON object, or else what lies from its first brace to its last."""
    for candidate in (text, text[text.find("{") : text.rfind("}") + 1]):
        try:
            value = json.loads(candidate)
        except ValueError:
            continue
        if isinstance(value, dict):
            return value
    raise ValueError("no JSON object in the answer")


def token_estimate(text: str) -> int:
    cjk = len(_CJK.findall(text))
    return max(1, (6 * cjk + 3 * (len(text) - cjk)) // 10 + 1)


def check_budget(text: str, output: int) -> int:
    n = token_estimate(text)
    if output <= 0 or output > V.MAX_OUTPUT or n + output > V.MAX_CONTEXT:
        raise BudgetError(f"{n} tokens in, {output} out")
    return n


def retried(call: Callable[[], Any], retryable: Callable[[Exception], bool], tries: int = MAX_TRIES, wait: float = 1.0) -> Any:
    """``call``, again after ever longer waits while its errors are worth it."""
    for k in range(tries):
        try:
            return call()
        except Exception as e:
            if k == tries - 1 or not retryable(e):
                raise
            time.sleep(wait * 2**k)


def worth_retrying(error: Exception) -> bool:
    """Time-outs, lost connections, rate limits and server errors."""
    status = getattr(error, "status_code", None)
    return isinstance(error, (TimeoutError, ConnectionError)) or status == 429 or (status or 0) >= 500


class RuleBackend:
    """Answers by rule, the same each time: overview, extraction, grouping, digest and resolution. Serves tests and offline runs."""

    def identity(self) -> str:
        return "rules-1"

    def complete(self, prompt: str, payload: dict[str, Any]) -> dict[str, Any]:
        task = payload.get("task", "")
        if task not in _RULES:
            raise ValueError(f"unknown task {task!r}")
        return _RULES[task](payload)


def _overview(p: dict[str, Any]) -> dict[str, Any]:
    lines = [x.strip() for x in p["text"].split("\n") if x.strip()]
    if not lines:
        return {"segments": []}
    return {"segments": [{"segment_id": "segment-0001", "start_quote": lines[0][:80], "end_quote": lines[-1][-80:], "title": lines[0][:40], "summary": ""}]}


def _extraction(p: dict[str, Any]) -> dict[str, Any]:
    """A concept for each capitalised word that a block begins with, and an item for each block."""
    concepts, items, seen = [], [], {}
    for b in p["blocks"]:
        m = re.search(r"\w+", b["text"])
        if not m:
            continue
        surface = m.group()
        if surface not in seen:
            seen[surface] = f"c{len(seen) + 1}"
            concepts.append({"concept_id": seen[surface], "surface": surface, "concept_type": "other", "canonical_name": "", "summary": "", "aliases": [], "observed_surfaces": [surface], "source_block_refs": [b["block_id"]], "grounding": "source_grounded"})
        items.append({"item_id": f"i{len(items) + 1}", "item_type": "statement", "summary": b["text"].strip()[:80], "source_block_refs": [b["block_id"]], "concept_refs": [seen[surface]], "grounding": "source_grounded"})
    return {"concepts": concepts, "atomic_items": items}


def _grouping(p: dict[str, Any]) -> dict[str, Any]:
    refs = [i["item_id"] for i in p["items"]]
    edges = [{"source": a, "target": b, "edge_type": "precedes"} for a, b in zip(refs, refs[1:], strict=False)]
    return {"logical_groups": [{"group_id": "g1", "group_type": "temporal_sequence", "item_refs": refs, "edges": edges}] if refs else []}


def _digest(p: dict[str, Any]) -> dict[str, Any]:
    names = [c["name"] for c in p["concepts"]]
    return {"digest": f"{len(names) + p.get('n_omitted', 0)} concepts: " + ", ".join(names[:10])}


def _proposals(rows: list[dict[str, Any]], have: list[dict[str, Any]], kind: str, make: Callable[[dict[str, Any], str | None], dict[str, Any]]) -> list[dict[str, Any]]:
    """A proposal for each row, with the first of ``have`` that is of its kind."""
    first: dict[str, str] = {}
    for r in have:
        first.setdefault(r.get(kind, "other"), r.get("concept_id") or r.get("group_id") or "")
    return [make(r, first.get(r.get(kind, "other"))) for r in rows]


def _resolution(p: dict[str, Any]) -> dict[str, Any]:
    """Links a concept to the first candidate of its type."""
    make = lambda c, hit: {"proposal_type": "link" if hit else "new_concept", "target_refs": [c["concept_id"]], "registry_ref": hit or "", "changes": {}, "implicit_refs": []}
    return {"status": "complete", "resolution_proposals": _proposals(p["concepts"], p["registry"], "concept_type", make), "unresolved_items": []}


def _group_resolution(p: dict[str, Any]) -> dict[str, Any]:
    """Continues the first group of a group's type."""
    make = lambda g, hit: {"proposal_type": "continue" if hit else "new_thread", "unit_group_ref": g["group_id"], "registry_group_ref": hit or "", "changes": {}}
    return {"status": "complete", "group_resolution_proposals": _proposals(p["groups"], p["registry_groups"], "group_type", make)}


def _mentions(p: dict[str, Any]) -> dict[str, Any]:
    """The first sentence as evidence and its first capitalised word as a mention."""
    quote = re.split(r"(?<=[.!?。！？])", p["text"].strip(), maxsplit=1)[0]
    name = re.search(r"[A-Z\u4e00-\u9fff]\w*", quote)
    evidence = [{"evidence_id": "e1", "quote": quote}] if quote else []
    mentions = [{"mention_id": "m1", "surface": name.group(), "evidence_span_ids": ["e1"]}] if name else []
    return {"unit_id": p.get("unit_id", ""), "evidence_spans": evidence, "entity_mentions": mentions, "location_mentions": [], "atom_mentions": [], "time_expressions": [], "thread_candidates": [], "warnings": []}


def _digest_update(p: dict[str, Any]) -> dict[str, Any]:
    return {"digest": (p.get("previous_digest", "") + "\n" + _digest(p)["digest"]).strip()}


_RULES = {
    "overview": _overview, "extraction": _extraction, "grouping": _grouping, "digest": _digest, "digest_update": _digest_update, "mentions": _mentions,
    "cross_unit_concept_resolution": _resolution, "cross_unit_group_resolution": _group_resolution, "repair_extraction": lambda p: {"repairs": []},
}


class HttpBackend:
    """A chat service over HTTP that answers with JSON: waits and tries again when it is busy, cut short or not JSON."""

    def __init__(self, url: str, model: str, key: str = "", output: int = 4096, timeout: float = 300.0, tries: int = MAX_TRIES, wait: float = 1.0):
        if output <= 0 or output > V.MAX_OUTPUT:
            raise BudgetError(f"{output} tokens out")
        self.url, self.model, self.key, self.output, self.timeout, self.tries, self.wait = url, model, key, output, timeout, tries, wait

    def identity(self) -> str:
        return f"http:{self.model}:{self.output}"

    def complete(self, prompt: str, payload: dict[str, Any]) -> dict[str, Any]:
        body = json.dumps(payload, ensure_ascii=False)
        check_budget(prompt + body, self.output)
        messages = [{"role": "system", "content": prompt}, {"role": "user", "content": body}]
        return retried(lambda: self._asked(messages), lambda e: worth_retrying(e) or isinstance(e, CutShort), self.tries, self.wait)

    def _asked(self, messages: list[dict[str, str]]) -> dict[str, Any]:
        import urllib.error
        import urllib.request

        data = json.dumps({"model": self.model, "messages": messages, "max_tokens": self.output, "response_format": {"type": "json_object"}}).encode()
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        try:
            with urllib.request.urlopen(urllib.request.Request(self.url, data, headers), timeout=self.timeout) as r:  # noqa: S310 - the caller's own service
                choice = json.loads(r.read())["choices"][0]
        except urllib.error.HTTPError as e:
            e.status_code = e.code  # type: ignore[attr-defined]
            raise
        except urllib.error.URLError as e:
            raise ConnectionError(str(e.reason)) from e
        if choice.get("finish_reason") == "length":
            raise CutShort("the answer was cut short")
        try:
            return parse_object(choice["message"]["content"])
        except ValueError as e:
            raise CutShort(str(e)) from e


class CutShort(ValueError):
    """An answer that ended too early or is no JSON object; the next one may be whole."""


def backend_of(name: str, url: str = "", model: str = "", key: str = "") -> Backend:
    """The backend that a command names: ``rules``, or ``http`` with its service."""
    if name == "rules":
        return RuleBackend()
    if name != "http" or not url or not model:
        raise ValueError("a backend is rules, or http with a url and a model")
    return HttpBackend(url, model, key)


def answers(payloads: DataFrame, backend: Backend, prompt: str, output: int = 4096) -> DataFrame:
    """``key, answer, error, model`` for rows of ``key, payload`` (JSON): a call for each row, in the tasks that hold them.

    Payloads beyond the budget and answers that are no object give an error and no answer; other rows go on.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, payload in zip(pdf["key"], pdf["payload"], strict=True):
                try:
                    check_budget(prompt + payload, output)
                    got = retried(lambda p=payload: backend.complete(prompt, json.loads(p)), worth_retrying)
                    rows.append((key, json.dumps(got, sort_keys=True, ensure_ascii=False), None, backend.identity()))
                except ValueError as e:
                    rows.append((key, None, str(e), backend.identity()))
            yield pd.DataFrame(rows, columns=["key", "answer", "error", "model"])

    ship(payloads.sparkSession)
    return payloads.select("key", "payload").mapInPandas(run, "key string, answer string, error string, model string")


@dataclass
class Conversation:
    """An ordered log of messages, named by the hash of how it began."""

    conversation_id: str
    messages: list[dict[str, str]]
    turns: list[dict[str, Any]] = field(default_factory=list)

    @classmethod
    def begin(cls, system: str, user: Any) -> Conversation:
        first = [{"role": "system", "content": system}, {"role": "user", "content": user if isinstance(user, str) else json.dumps(user, sort_keys=True, ensure_ascii=False)}]
        return cls("conv-" + json_hash(first)[:16], first)

    def say(self, role: str, content: str, **turn: Any) -> None:
        self.messages.append({"role": role, "content": content})
        if turn:
            self.turns.append(turn)

    def last_answer(self) -> str:
        return next((m["content"] for m in reversed(self.messages) if m["role"] == "assistant"), "")

    def to_dict(self) -> dict[str, Any]:
        return asdict(self)

    @classmethod
    def from_dict(cls, data: dict[str, Any]) -> Conversation:
        return cls(data["conversation_id"], list(data["messages"]), list(data.get("turns", [])))


#: The instructions of each task, in parts; their hash is part of every cached answer's key.
PROMPTS = {
    "overview": ["Split the text into segments that follow one another.", "Quote the first and the last words of each segment exactly."],
    "extraction": ["List the concepts and the single statements of the segment.", "Name for each the blocks it stands on."],
    "grouping": ["Group the statements of the unit and say how they follow from each other."],
    "digest": ["Say in a few lines what the book's concepts are."],
    "digest_update": ["Add to what was said of the book what the new concepts change."],
    "mentions": ["List quotes of the text and the names that they hold."],
    "cross_unit_concept_resolution": ["Say which concepts of the unit are concepts of the book, and which of its own belong together or apart.", "Call tools to look up what you need; end with the status complete."],
    "cross_unit_group_resolution": ["Say which groups of the unit continue or change groups of the book.", "Call tools to look up what you need; end with the status complete."],
    "repair_extraction": ["Mend the errors of the package."],
}


def prompt_of(task: str) -> str:
    return "\n\n".join([*PROMPTS[task], "Answer with one JSON object."])
