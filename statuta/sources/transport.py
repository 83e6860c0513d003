"""Calls to services outside: model transports, retries and pacing; all are injected."""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from ..functions.text import RETRYABLE

API_MODES = ("chat", "responses", "azure-inference")
PROVIDERS = ("anthropic", "azure")
# The kinds of analysis.
ANALYSIS_TYPES = ("summary", "structure", "content", "json")


class Transport(Protocol):
    def invoke(self, prompt: str) -> str: ...


@dataclass
class Pace:
    """Waits in seconds: after a call, after each ``batch`` calls, and before a retry (doubling)."""

    delay: float = 5.0
    batch: int = 3
    batch_delay: float = 30.0
    attempts: int = 3
    backoff: float = 60.0


def is_retryable(error: str) -> bool:
    low = error.lower()
    return any(k.lower() in low for k in RETRYABLE)


def call_with_retry(transport: Transport, prompt: str, pace: Pace | None = None, sleep: Callable[[float], None] = time.sleep) -> tuple[str, str | None, str | None, int]:
    """(status, reply, error, attempts); status is ok, error or exhausted."""
    pace = pace or getattr(transport, "pace", None) or Pace(delay=0, batch_delay=0, backoff=0)
    error = ""
    for attempt in range(1, pace.attempts + 1):
        try:
            reply = transport.invoke(prompt)
        except Exception as e:  # a service's client may raise anything
            error = str(e)
            if not is_retryable(error):
                return "error", None, error, attempt
            if pace.backoff:
                sleep(pace.backoff * 2 ** (attempt - 1))
        else:
            if pace.delay:
                sleep(pace.delay)
            return "ok", reply, None, attempt
    return "exhausted", None, error, pace.attempts


def cool_down(index: int, pace: Pace, sleep: Callable[[float], None] = time.sleep) -> None:
    """Waits after call ``index`` (from 0) if it's the last of a batch, whatever its outcome."""
    if pace.batch and pace.batch_delay and (index + 1) % pace.batch == 0:
        sleep(pace.batch_delay)


@dataclass
class EchoTransport:
    """A stand-in without a service: answers by a function, and fails where told to."""

    answer: Callable[[str], str] = lambda prompt: prompt.rsplit("Content:\n", 1)[-1]
    fail: Callable[[str], str | None] = lambda prompt: None
    pace: Pace = field(default_factory=lambda: Pace(0, 3, 0, 3, 0))

    def invoke(self, prompt: str) -> str:
        error = self.fail(prompt)
        if error:
            raise RuntimeError(error)
        return self.answer(prompt)


def check_api_mode(value: str | None, name: str) -> str:
    if value not in API_MODES:
        raise ValueError(f"{name} must be one of {', '.join(API_MODES)}, not {value!r}")
    return value


def build_transport(config: dict, registry: dict[str, Callable[[dict], Transport]]) -> Transport:
    """A transport for a configuration with a provider; ``registry`` holds a maker for each provider."""
    provider = (config.get("provider") or "").lower()
    if provider not in registry:
        raise ValueError(f"provider must be one of {', '.join(sorted(registry))}, not {provider!r}")
    if provider == "azure":
        if not (config.get("endpoint") or os.environ.get("AZURE_INFERENCE_ENDPOINT")) or not (config.get("credential") or config.get("api_key") or os.environ.get("AZURE_INFERENCE_CREDENTIAL")):
            raise ValueError("azure needs an endpoint and a credential")
        check_api_mode(config.get("api_style") or os.environ.get("AZURE_INFERENCE_API_STYLE"), "api_style")
    return registry[provider]({"temperature": 0, "max_tokens": 4096} | config)


def classify_pages(pages, ask: Callable[[bytes], str], lanes: int = 8):
    """(doc_id, page_no, reply) for page images (doc_id, page_no, image); a failed call gives an ERROR: reply."""

    def run(frames):
        for pdf in frames:
            replies = []
            for image in pdf["image"]:
                try:
                    replies.append(ask(image))
                except Exception as e:
                    replies.append(f"ERROR: {e}")
            yield pdf[["doc_id", "page_no"]].assign(reply=replies)

    return pages.select("doc_id", "page_no", "image").repartition(lanes).mapInPandas(run, "doc_id long, page_no int, reply string")


def analyze(texts, ask: Callable[[str, str], str], types: tuple[str, ...] = ("summary",), limit: int = 4000):
    """(doc_id, analysis_type, result, error) for each text and type, on the first ``limit`` characters; errors are collected."""
    from pyspark.sql import functions as F

    for t in types:
        if t not in ANALYSIS_TYPES:
            raise ValueError(f"unknown analysis type {t!r}")

    def run(frames):
        for pdf in frames:
            out = []
            for doc, kind, text in zip(pdf["doc_id"], pdf["analysis_type"], pdf["text"], strict=True):
                try:
                    out.append((doc, kind, ask(kind, text), None))
                except Exception as e:
                    out.append((doc, kind, None, str(e)))
            import pandas as pd

            yield pd.DataFrame(out, columns=["doc_id", "analysis_type", "result", "error"])

    each = texts.select("doc_id", F.explode(F.array(*[F.lit(t) for t in types])).alias("analysis_type"), F.left("text", F.lit(limit)).alias("text"))
    return each.mapInPandas(run, "doc_id long, analysis_type string, result string, error string")
