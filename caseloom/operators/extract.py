"""Extraction by language models: a provider answers prompts, answers become records; a cache saves repeated calls."""

from __future__ import annotations

import json
import os
import re
import urllib.request
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import canonical_hash

KINDS = ("entities", "events", "conversations", "identity_signals")


_ASK = 'Answer with JSON only: {"items": [...]}. Quote the text exactly; confidence is between 0 and 1. Each item has '
#: What a model is asked for, by kind, if nothing else is given.
PROMPTS = {
    "entities": f"List the people, organisations and places named in the text. {_ASK}entity, type, quote, confidence.",
    "events": f"List the events that the text tells of. {_ASK}event, date (as written, or null), quote, confidence.",
    "conversations": f"List the utterances in the text. {_ASK}speaker, quote, confidence.",
    "identity_signals": f"List the birth dates (dob), addresses (address) and case numbers (case_id) of people in the text. {_ASK}person, attribute, value, quote, confidence.",
}


class Provider(Protocol):
    name: str
    model: str

    def ask(self, kind: str, text: str) -> str:
        """The answer to the kind's prompt over a text; raises ConnectionError, ValueError (configuration) or others."""


class Rules:
    """An offline provider: regular expressions instead of a model, so that the pipeline runs without a network."""

    name = model = "rules"

    def ask(self, kind: str, text: str) -> str:
        items: list[dict] = []
        if kind == "entities":
            items = [{"entity": m.group(), "type": "person", "quote": m.group(), "confidence": 0.6} for m in re.finditer(r"\b[A-Z][a-z]+ [A-Z][a-z]+\b", text)]
        elif kind == "events":
            items = [{"event": m.group(1).lower(), "date": m.group(2), "quote": m.group(), "confidence": 0.5} for m in re.finditer(r"\b(\w+ed)\b[^.\n]{0,60}?(\d{4}-\d{2}-\d{2})", text)]
        elif kind == "conversations":
            items = [{"speaker": m.group(1), "quote": m.group(2).strip(), "confidence": 0.7} for m in re.finditer(r"(?m)^([A-Z][A-Za-z .]{0,40}): (.+)$", text)]
        elif kind == "identity_signals":
            items = [{"person": m.group(1), "attribute": "dob", "value": m.group(2), "quote": m.group(), "confidence": 0.6} for m in re.finditer(r"\b([A-Z][a-z]+ [A-Z][a-z]+), born (\d{4}-\d{2}-\d{2})", text)]
        return json.dumps({"items": items})


def from_env_file(variable: str, path: str = ".env") -> str | None:
    """The variable's value in a file of NAME=value lines; quotes around it are dropped. No file, no value."""
    try:
        with open(path, encoding="utf-8") as f:
            for line in f:
                name, sign, value = line.strip().removeprefix("export ").partition("=")
                if sign and name.strip() == variable:
                    return value.strip().strip("\"'") or None
    except OSError:
        pass
    return None


class Http:
    """A chat endpoint (ollama, openai or gemini), temperature 0. The key is read where the call is made, never shipped."""

    #: Address, and the environment variable of the key.
    SERVERS = {"ollama": ("http://localhost:11434/api/generate", None), "openai": ("https://api.openai.com/v1/chat/completions", "OPENAI_API_KEY"), "gemini": ("https://generativelanguage.googleapis.com/v1beta/models/{model}:generateContent", "GEMINI_API_KEY")}

    def __init__(self, name: str, model: str, prompts: dict[str, str], url: str | None = None, timeout: float = 120) -> None:
        self.name, self.model, self.prompts, self.timeout = name, model, prompts, timeout
        self.url = (url or self.SERVERS[name][0]).format(model=model)

    def body(self, kind: str, text: str) -> dict:
        prompt = f"{self.prompts[kind]}\n\n{text}"
        if self.name == "ollama":
            return {"model": self.model, "prompt": prompt, "stream": False, "options": {"temperature": 0}}
        if self.name == "openai":
            return {"model": self.model, "temperature": 0, "messages": [{"role": "user", "content": prompt}]}
        return {"contents": [{"parts": [{"text": prompt}]}], "generationConfig": {"temperature": 0}}

    def said(self, answer: dict) -> str:
        if self.name == "ollama":
            return answer["response"]
        return answer["choices"][0]["message"]["content"] if self.name == "openai" else answer["candidates"][0]["content"]["parts"][0]["text"]

    def ask(self, kind: str, text: str) -> str:
        head = {"Content-Type": "application/json"}
        if variable := self.SERVERS[self.name][1]:
            if not (key := os.environ.get(variable) or from_env_file(variable)):
                raise ValueError(f"{variable} is not set")
            head |= {"Authorization": f"Bearer {key}"} if self.name == "openai" else {"x-goog-api-key": key}
        request = urllib.request.Request(self.url, json.dumps(self.body(kind, text)).encode(), head)
        with urllib.request.urlopen(request, timeout=self.timeout) as r:
            return self.said(json.load(r))


def provider(name: str = "rules", model: str | None = None, url: str | None = None) -> Provider:
    """A provider by name: rules (offline), ollama, openai or gemini."""
    if name == "rules":
        return Rules()
    if name not in Http.SERVERS:
        raise ValueError(f"unknown provider {name}")
    return Http(name, model or "llama3", PROMPTS, url)


def parse_answer(answer: str) -> tuple[list[dict], str | None]:
    """Items, and invalid_json or missing_items."""
    try:
        got = json.loads(re.sub(r"^\s*```(?:json)?|```\s*$", "", answer.strip()))
    except ValueError:
        return [], "invalid_json"
    if not isinstance(got, dict) or not isinstance(got.get("items"), list):
        return [], "missing_items"
    return [i for i in got["items"] if isinstance(i, dict)], None


def extracted(chunks: DataFrame, kind: str, provider: Provider, cache: DataFrame | None = None, version: str = "v1", retry_errors: bool = False) -> DataFrame:
    """file_id, chunk_id, page_range, items (JSON text), n_items, model, error, text_hash, extractor_version of each chunk.

    A cached answer (same version, chunk and text) is taken instead of a call; cached errors are tried again if asked for.
    """
    rows = chunks.withColumn("text_hash", canonical_hash(F.col("text"))).withColumn("page_range", F.array("page_start", "page_end"))
    out = "file_id string, chunk_id string, page_range array<int>, items string, n_items int, model string, error string, text_hash string, extractor_version string"
    key = ["chunk_id", "text_hash"]
    todo, held = rows, None
    if cache is not None:
        held = cache.where(F.col("extractor_version") == version)
        held = held.where(F.col("error").isNull()) if retry_errors else held
        todo = rows.join(held.select(*key), key, "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for r in b.itertuples(index=False):
                try:
                    items, error = parse_answer(provider.ask(kind, r.text or ""))
                except ValueError:
                    items, error = [], f"{provider.name}_config_error"
                except OSError:
                    items, error = [], f"{provider.name}_unavailable"
                except Exception:  # one chunk's failure is its record's error
                    items, error = [], f"{provider.name}_error"
                made.append((r.file_id, r.chunk_id, list(r.page_range), json.dumps(items), len(items), getattr(provider, "model", provider.name), error, r.text_hash, version))
            yield pd.DataFrame(made, columns=[c.split(" ")[0] for c in out.split(", ")])

    fresh = todo.select("file_id", "chunk_id", "page_range", "text", "text_hash").mapInPandas(run, out)
    if held is None:
        return fresh
    known = rows.select("file_id", "page_range", *key).join(held.select(*key, "items", "n_items", "model", "error", "extractor_version"), key)
    return fresh.unionByName(known.select(*fresh.columns))


def two_pass(chunks: DataFrame, kind: str, small: Provider, large: Provider, large_ids: DataFrame) -> DataFrame:
    """The small model over all chunks, the large one over those that failed and those routed to it; both with a pass name."""
    first = extracted(chunks, kind, small).withColumn("pass", F.lit("small"))
    again = first.where(F.col("error").rlike("invalid_json|refus")).select("chunk_id").union(large_ids.select("chunk_id")).distinct()
    second = extracted(chunks.join(again, "chunk_id", "left_semi"), kind, large).withColumn("pass", F.lit("large"))
    return first.unionByName(second)
