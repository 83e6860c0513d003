"""Recognition and vision services, page images and the cache of recognised pages.

Requests are plain JSON sent by ``post``, which tests and other clients replace;
what depends on a document format (opening, rendering) is injected as well.
"""

from __future__ import annotations

import base64
import json
import os
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rescue import cached_pages, missing_pages
from .transport import check_api_mode

#: (url, headers, payload, timeout) to (status, body).
Post = Callable[[str, dict[str, str], dict, float], tuple[int, str]]

CACHE_SCHEMA = "doc_id long, mtime timestamp, page_no int, markdown string, error string, run string"
#: Least number of tokens that services let a reply have.
LEAST_TOKENS = 16


def post_json(url: str, headers: dict[str, str], payload: dict, timeout: float) -> tuple[int, str]:
    request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json", **headers})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return reply.status, reply.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def data_url(content: bytes, kind: str) -> str:
    return f"data:{kind};base64,{base64.b64encode(content).decode()}"


@dataclass(frozen=True)
class Recogniser:
    """Reads documents by a recognition service; any failure is tried again after 1, 2, ... seconds."""

    endpoint: str
    key: str
    model: str = "document-ai"
    attempts: int = 3
    timeout: float = 120.0
    post: Post = post_json
    sleep: Callable[[float], None] = time.sleep

    def request(self, document: bytes, images: bool = False) -> dict:
        return {"model": self.model, "document": {"type": "document_url", "document_url": data_url(document, "application/pdf")}, "include_image_base64": images}

    def read(self, document: bytes) -> str:
        """The document's text: its pages' markdown, joined by a line break."""
        error = ""
        for attempt in range(self.attempts):
            if attempt:
                self.sleep(2 ** (attempt - 1))
            try:
                status, body = self.post(self.endpoint, {"Authorization": f"Bearer {self.key}"}, self.request(document), self.timeout)
                if status != 200:
                    raise RuntimeError(f"status {status}")
                text = "\n".join(p["markdown"] for p in json.loads(body).get("pages") or [] if p.get("markdown"))
                if not text.strip():
                    raise RuntimeError("no text in the reply")
                return text
            except Exception as e:  # a client may raise anything
                error = str(e)
        raise RuntimeError(f"recognition failed after {self.attempts} attempts: {error}")


@dataclass(frozen=True)
class Vision:
    """Asks a vision model about an image; ``mode`` is one of the modes that transport names."""

    endpoint: str
    key: str
    deployment: str
    mode: str
    max_tokens: int = LEAST_TOKENS
    temperature: float = 0.0
    timeout: float = 120.0
    post: Post = post_json

    @classmethod
    def configured(cls, env: dict[str, str] | None = None, **given) -> Vision:
        """From given values, then those of ``env`` (by default the process environment)."""
        env = dict(os.environ) if env is None else env
        names = {"key": "AZURE_API_KEY", "endpoint": "AZURE_MULTIMODAL_ENDPOINT", "deployment": "AZURE_MULTIMODAL_DEPLOYMENT", "mode": "AZURE_MULTIMODAL_API_STYLE"}
        values = {k: given.pop(k, None) or env.get(v) for k, v in names.items()}
        absent = [names[k] for k in ("key", "endpoint", "deployment") if not values[k]]
        if absent:
            raise ValueError(f"a vision service needs {', '.join(absent)}")
        check_api_mode(values["mode"], names["mode"])
        given["max_tokens"] = max(given.get("max_tokens", LEAST_TOKENS), LEAST_TOKENS)
        return cls(**values, **given)

    def request(self, prompt: str, image: bytes | None = None, detail: str = "low") -> tuple[str, dict]:
        """(path under the endpoint, payload)."""
        url = data_url(image, "image/png") if image is not None else None
        if self.mode == "responses":
            content = [{"type": "input_text", "text": prompt}] + ([{"type": "input_image", "image_url": url, "detail": detail}] if url else [])
            return "responses", {"model": self.deployment, "input": [{"role": "user", "content": content}], "max_output_tokens": self.max_tokens, "temperature": self.temperature}
        content = [{"type": "text", "text": prompt}] + ([{"type": "image_url", "image_url": {"url": url, "detail": detail}}] if url else [])
        return "chat/completions", {"model": self.deployment, "messages": [{"role": "user", "content": content}], "max_tokens": self.max_tokens, "temperature": self.temperature}

    def reply(self, body: str) -> str:
        found = json.loads(body)
        if self.mode == "responses":
            parts = [c.get("text") or "" for o in found.get("output") or [] for c in o.get("content") or [] if c.get("type") == "output_text"]
            return (found.get("output_text") or "".join(parts)).strip()
        return (found["choices"][0]["message"].get("content") or "").strip()

    def ask(self, prompt: str, image: bytes | None = None, detail: str = "low") -> str:
        path, payload = self.request(prompt, image, detail)
        key = {"api-key": self.key} if self.mode == "azure-inference" else {"Authorization": f"Bearer {self.key}"}
        status, body = self.post(f"{self.endpoint.rstrip('/')}/{path}", key, payload, self.timeout)
        if status != 200:
            raise RuntimeError(f"status {status}: {body[:200]}")
        return self.reply(body)


def reachable(recogniser: Recogniser | None, vision: Vision | None) -> dict[str, str]:
    """For each service ok or what is wrong; recognition is only looked at for its settings, as a call needs a document."""
    out = {"recognition": "ok" if recogniser and recogniser.endpoint and recogniser.key else "not configured", "vision": "not configured"}
    if vision:
        try:
            vision.ask("Say hello")
            out["vision"] = "ok"
        except Exception as e:
            out["vision"] = f"failed: {e}"
    return out


def page_images(documents: DataFrame, wanted: DataFrame, count: Callable[[bytes], int], render: Callable[[bytes, list[int], float], list[bytes]], dpi: int = 120) -> DataFrame:
    """(doc_id, page_no, image) for the pages (doc_id, page_no) of ``documents`` (doc_id, content).

    A document is opened once for all its pages, in their order; a page that it
    doesn't have is refused.  ``render`` takes the scale, which is 1 at 72 dpi.
    """
    lists = wanted.groupBy("doc_id").agg(F.sort_array(F.collect_set("page_no")).alias("pages"))

    def run(frames):
        import pandas as pd

        for pdf in frames:
            rows = []
            for doc, content, pages in zip(pdf["doc_id"], pdf["content"], pdf["pages"], strict=True):
                pages, last = [int(p) for p in pages], count(content)
                if bad := [p for p in pages if not 1 <= p <= last]:
                    raise ValueError(f"document {doc} has pages 1 to {last}, not {bad[0]}")
                rows += [(doc, p, image) for p, image in zip(pages, render(content, pages, dpi / 72), strict=True)]
            yield pd.DataFrame(rows, columns=["doc_id", "page_no", "image"])

    return documents.select("doc_id", "content").join(lists, "doc_id").mapInPandas(run, "doc_id long, page_no int, image binary")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, mtime, page_no, markdown) of the pages that were read; a page that was read twice counts once."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "doc_id long, mtime timestamp, page_no int, markdown string")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(path).where("error is null")
    return rows.groupBy("doc_id", "mtime", "page_no").agg(F.min("markdown").alias("markdown"))


def recognise_pages(wanted: DataFrame, read: Callable[[bytes], str], cache: str, lanes: int = 4) -> DataFrame:
    """(doc_id, page_no, markdown) for pages (doc_id, mtime, page_no, document), one document a page.

    Pages that the cache at ``cache`` lacks are read and appended to it, ``lanes`` at
    a time.  What could be read is kept even if a page fails; then this fails,
    and the next call reads only the rest.
    """
    spark, run_id = wanted.sparkSession, uuid.uuid4().hex
    todo = missing_pages(wanted, read_cache(spark, cache)).dropDuplicates(["doc_id", "mtime", "page_no"])

    def run(frames):
        import pandas as pd

        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                try:
                    rows.append((r.doc_id, r.mtime, r.page_no, read(bytes(r.document)), None, run_id))
                except Exception as e:
                    rows.append((r.doc_id, r.mtime, r.page_no, None, str(e), run_id))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CACHE_SCHEMA.split(", ")])

    todo.select("doc_id", "mtime", "page_no", "document").repartition(lanes).mapInPandas(run, CACHE_SCHEMA).write.mode("append").parquet(cache)
    bad = spark.read.schema(CACHE_SCHEMA).parquet(cache).where((F.col("run") == run_id) & F.col("error").isNotNull()).orderBy("doc_id", "page_no").first()
    if bad:
        raise RuntimeError(f"page {bad.page_no} of document {bad.doc_id}: {bad.error}")
    return cached_pages(wanted.select("doc_id", "mtime", "page_no").distinct(), read_cache(spark, cache))
