"""Chunks through a model: prompts, providers, the typed envelope, routing.

The provider is called in one Arrow pass. The envelope is written once and both routes read it, so
no reply is paid for twice but where a task is tried again.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.schema import Schemas
from tessera.functions.text import parse_reply, stated_confidence
from tessera.runtime import ship_package

#: Parameters of the call and those that travel in its extra body.
DIRECT = ("temperature", "top_p")
EXTRA = ("top_k", "min_p", "repeat_penalty", "num_predict")
#: Statuses under 500 that may pass: timeout, conflict, too early, too many requests.
RETRIED = (408, 409, 425, 429)
VARIABLES = ("source_file", "source_section", "content", "extraction_instructions", "json_schema")


@dataclass
class Reply:
    content: str
    tokens_in: int = 0
    tokens_out: int = 0
    latency_ms: int = 0
    model: str = ""
    endpoint: str = ""


class Provider(Protocol):
    model: str
    endpoint: str

    def extract(self, system: str, user: str, response_format: dict | None = None) -> Reply: ...


@dataclass
class RuleProvider:
    """A deterministic function of the user prompt, for tests and dry runs."""

    rule: Callable[[str], str]
    model: str = "rule"
    endpoint: str = "local"

    def extract(self, system: str, user: str, response_format: dict | None = None) -> Reply:
        text = self.rule(user)
        return Reply(text or "", len(user.split()), len((text or "").split()), 0, self.model, self.endpoint)


@dataclass
class HttpProvider:
    """Chat completions over HTTP: known parameters only, nulls dropped, bounded retries of what may succeed later."""

    endpoint: str
    model: str
    timeout: float = 300
    max_retries: int = 3
    parameters: dict[str, Any] = field(default_factory=dict)

    def body(self, system: str, user: str, response_format: dict | None = None) -> dict[str, Any]:
        given = {k: v for k, v in self.parameters.items() if v is not None and k in DIRECT + EXTRA}
        out = {"model": self.model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}], **given}
        return out | ({"response_format": response_format} if response_format is not None else {})

    def extract(self, system: str, user: str, response_format: dict | None = None) -> Reply:
        data = json.dumps(self.body(system, user, response_format)).encode()
        ask = urllib.request.Request(f"{self.endpoint.rstrip('/')}/v1/chat/completions", data, {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ.get('MODEL_API_KEY', 'none')}"})
        began = time.monotonic()
        for attempt in range(self.max_retries + 1):
            try:
                with urllib.request.urlopen(ask, timeout=self.timeout) as r:
                    got = json.load(r)
                break
            except OSError as e:
                refused = isinstance(e, urllib.error.HTTPError) and e.code < 500 and e.code not in RETRIED
                if refused or attempt == self.max_retries:
                    raise
                time.sleep(min(8, 0.5 * 2**attempt))
        usage = got.get("usage") or {}
        text = got["choices"][0]["message"].get("content") or ""
        return Reply(text, usage.get("prompt_tokens") or 0, usage.get("completion_tokens") or 0, int((time.monotonic() - began) * 1000), got.get("model") or self.model, self.endpoint)


class Prompts:
    """Everything that is the same for all chunks is rendered once, on the driver."""

    def __init__(self, config: dict[str, Any]):
        wanted, prompts = config.get("extraction") or {}, config.get("prompts") or {}
        self.core, self.genre = wanted.get("core", True), wanted.get("genre") or None
        self.schemas = Schemas(config)
        self.schema_version, self.version = str(wanted.get("schema_version", "")), str(prompts.get("version", ""))
        suffix = self.schemas.prompt_suffix(self.genre) if self.genre else ""
        self.system = prompts.get("system", "").rstrip() + ("\n" + suffix.rstrip() if suffix else "")
        self.constants = {"extraction_instructions": self.schemas.instructions(self.core, self.genre), "json_schema": json.dumps(self.schemas.json_schema(self.core, self.genre), ensure_ascii=False, indent=2)}
        self.pieces = split_template(prompts.get("user_template", ""), self.constants)

    def user(self, chunk: dict[str, Any]) -> str:
        return "".join(p if kind == "text" else str(chunk.get(p) or "") for kind, p in self.pieces)

    def user_column(self) -> Column:
        return render(self.pieces)


def split_template(template: str, constants: dict[str, str]) -> list[tuple[str, str]]:
    """("text", literal) and ("name", variable) pieces; doubled braces are braces, unknown names raise."""
    from string import Formatter

    out: list[tuple[str, str]] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            out.append(("text", literal))
        if name is not None:
            if name not in VARIABLES:
                raise KeyError(name)
            out.append(("text", constants[name]) if name in constants else ("name", name))
    return out


def render(pieces: list[tuple[str, str]]) -> Column:
    """The template over chunk columns, as one concat: what stands in a chunk is never substituted again."""
    return F.concat(F.lit(""), *[F.lit(p) if kind == "text" else F.coalesce(F.col(p).cast("string"), F.lit("")) for kind, p in pieces])


ENVELOPE = (
    "chunk_id string, source_file string, source_page int, source_section string, source_position string, chunk_index int, is_structured boolean, extraction_result string, fallback_text string, extraction_method string, "
    "extraction_mode string, extracted_at string, latency_ms long, model_name string, model_endpoint string, token_usage_input long, token_usage_output long, confidence_score double, thinking_content string, schema_version string, "
    "prompt_version string, validation_status string, parse_error string, raw_response string, stated_confidence double"
)
_NAMES = [x.strip().split(" ")[0] for x in ENVELOPE.split(",")]
_KEPT = _NAMES[:6]


def envelope(chunk: dict[str, Any], provider: Provider, prompts: Prompts, clock: Callable[[], datetime]) -> dict[str, Any]:
    """One chunk's result: parsed, unparseable or failed. Never raises. The wording of fallback texts is a fixed value."""
    base = {k: chunk[k] for k in _KEPT} | {
        "is_structured": False, "extraction_result": None, "fallback_text": "", "extraction_method": "direct_prompt", "extraction_mode": "metadata_only", "extracted_at": clock().isoformat(), "latency_ms": 0, "model_name": provider.model,
        "model_endpoint": provider.endpoint, "token_usage_input": 0, "token_usage_output": 0, "confidence_score": 0.0, "thinking_content": "", "schema_version": prompts.schema_version, "prompt_version": prompts.version,
        "validation_status": "pending", "parse_error": None, "raw_response": None, "stated_confidence": None,
    }
    content = chunk["content"] or ""
    try:
        reply = provider.extract(prompts.system, prompts.user(chunk))
    except Exception as e:  # noqa: BLE001  any failure of a call is a fallback row
        return base | {"parse_error": str(e), "fallback_text": f"EXTRACTION ERROR: {e}\n\nORIGINAL CONTENT:\n{content[:3000]}"}
    base |= {"latency_ms": reply.latency_ms, "model_name": reply.model, "model_endpoint": reply.endpoint, "token_usage_input": reply.tokens_in, "token_usage_output": reply.tokens_out}
    value, error = parse_reply(reply.content)
    if value is None:
        return base | {"parse_error": error, "raw_response": reply.content[:500], "fallback_text": f"LLM response not valid JSON: {error}\nRAW RESPONSE:\n{reply.content[:3000]}\n\nORIGINAL CONTENT:\n{content[:3000]}"}
    sure = value.get("confidence_score", 0.0)
    return base | {
        "is_structured": True,
        "extraction_result": json.dumps(value, ensure_ascii=False),
        "confidence_score": float(sure) if isinstance(sure, (int, float)) else None,
        "thinking_content": str(value.get("thinking") or ""),
        "stated_confidence": stated_confidence(value),
    }


def extract(chunks: DataFrame, provider: Provider, prompts: Prompts, concurrency: int = 4, clock: Callable[[], datetime] | None = None) -> DataFrame:
    """doc and the envelope of each chunk; at most ``concurrency`` calls a task at a time."""
    ship_package(chunks.sparkSession)
    clock = clock or (lambda: datetime.now(timezone.utc))
    asked = chunks.select("doc", *_KEPT, "content")
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
    schema = pa.schema([("doc", pa.string())] + [(x.strip().split(" ")[0], types[x.strip().split(" ")[1]]) for x in ENVELOPE.split(",")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(concurrency) as pool:
            for b in batches:
                rows = b.to_pylist()
                for a in range(0, len(rows), 256):
                    part = rows[a : a + 256]
                    got = list(pool.map(lambda r: envelope(r, provider, prompts, clock), part))
                    yield pa.RecordBatch.from_pylist([{"doc": r["doc"], **g} for r, g in zip(part, got)], schema=schema)

    return asked.mapInArrow(run, "doc string, " + ENVELOPE)


def structured(results: DataFrame) -> DataFrame:
    return results.where(F.coalesce("is_structured", F.lit(False)))


def unstructured(results: DataFrame) -> DataFrame:
    return results.where(~F.coalesce("is_structured", F.lit(False)))


def fallback_block(chunk_id: Column, source: Column, page: Column, section: Column, at: Column, text: Column) -> Column:
    """The text block of a chunk that gave no structured result; missing values have defaults. Its layout is a fixed value."""
    or_ = lambda c, d: F.coalesce(c.cast("string"), F.lit(d))
    return F.concat_ws(
        "\n", F.lit("=" * 60), F.concat(F.lit("CHUNK: "), or_(chunk_id, "unknown")), F.concat(F.lit("SOURCE: "), or_(source, "unknown"), F.lit(", Page "), or_(page, "0")), F.concat(F.lit("SECTION: "), or_(section, "")),
        F.concat(F.lit("EXTRACTED AT: "), or_(at, "")), F.lit("-" * 60), or_(text, ""), F.lit("=" * 60),
    )
