"""Declared pipelines: a YAML file to a graph of DataFrames, and the batch command line."""

from __future__ import annotations

import argparse
import importlib
import os
import re
import sys
from collections.abc import Mapping
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.schema import Schemas, ddl
from tessera.operators import all_info as A
from tessera.operators import extract as E
from tessera.operators import sections as S
from tessera.operators.merge import run_summary
from tessera.runtime import Scratch
from tessera.sources import docx, sinks

#: Ways to cut a document; sections by heading are the only one.
STRATEGIES = ("heading",)


def _filled(text: str, env: Mapping[str, str]) -> str:
    """The text with every ``${NAME:default}`` replaced, read from left to right; other dollar signs stay."""
    out, at = [], 0
    while (begin := text.find("${", at)) >= 0:
        end = text.find("}", begin)
        name, colon, default = text[begin + 2 : max(end, begin + 2)].partition(":")
        known = end > 0 and bool(colon) and name.replace("_", "a").isalnum()
        stop = end + 1 if known else begin + 2
        out += [text[at:begin], env.get(name, default) if known else text[begin:stop]]
        at = stop
    return "".join(out) + text[at:]


def substitute(tree: Any, env: Mapping[str, str] | None = None) -> Any:
    """A copy of a parsed configuration with its strings filled from the environment; results stay strings."""
    env = os.environ if env is None else env
    match tree:
        case str():
            return _filled(tree, env)
        case list():
            return [substitute(x, env) for x in tree]
        case dict():
            return dict(zip(tree, (substitute(x, env) for x in tree.values())))
    return tree


def load_config(path: str, section: str, genre: str = "") -> dict[str, Any]:
    """The model section of a configuration, its genre's file beside it included; no such genre file: core only."""
    file = Path(path)
    if not file.is_file():
        raise FileNotFoundError(path)
    config = substitute((yaml.safe_load(file.read_text(encoding="utf-8")) or {}).get(section) or {})
    wanted = config.setdefault("extraction", {})
    if genre:
        wanted["genre"] = genre
    name = wanted.get("genre")
    if name:
        if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
            raise ValueError(f"bad genre name {name!r}")
        genres = config.setdefault("schemas", {}).setdefault("genres", {})
        beside = file.parent / "genres" / f"{name}.yaml"
        if name not in genres and beside.is_file():
            genres[name] = yaml.safe_load(beside.read_text(encoding="utf-8"))
    return config


def provider_of(config: dict[str, Any]) -> E.Provider:
    llm = config.get("llm") or {}
    return E.HttpProvider(llm["endpoint"], llm["model"], float(llm.get("timeout", 300)), int(llm.get("max_retries", 3)), llm.get("parameters") or {})


def merge_results(results: DataFrame, config: dict[str, Any], scratch: Scratch) -> DataFrame:
    """Envelopes to one row a document."""
    wanted = config.get("extraction") or {}
    fields = Schemas(config).combined(wanted.get("core", True), wanted.get("genre"))
    named = {"chunk_index": "ci", "chunk_id": "cid", "is_structured": "ok", "extraction_result": "extraction", "stated_confidence": "confidence"}
    chunks = results.select("doc", *[F.col(a).alias(b) for a, b in named.items()])
    return A.all_info(chunks, fields, scratch)


def extract_documents(spark: SparkSession, elements: DataFrame, config: dict[str, Any], provider: E.Provider, max_tokens: int = 4000, overlap_tokens: int = 200, max_chunks: int = 0, concurrency: int = 4) -> tuple[DataFrame, DataFrame]:
    """(envelopes, merged documents). Envelopes are written once; every consumer reads that table."""
    scratch = Scratch(spark, "extract")
    chunks = S.head_chunks(S.chunk_sections(S.build_sections(elements), max_tokens, overlap_tokens), max_chunks)
    results = scratch.keep(E.extract(chunks, provider, E.Prompts(config), concurrency), "envelopes")
    return results, merge_results(results, config, scratch)


# --- declared pipelines ------------------------------------------------------------------------


def options(required: tuple[str, ...] = (), **optional: Any):
    """Declares a plug-in's options: those it needs, and those it may be given with their defaults."""

    def mark(plugin):
        plugin.required_options, plugin.optional_options = required, optional
        return plugin

    return mark


@options(("file_path",), image_mode="metadata_only")
def docx_source(spark: SparkSession, spec: dict[str, Any]) -> DataFrame:
    if not spec.get("file_path"):
        raise ValueError("a docx source needs file_path")
    rule = spec.get("chunking") or {}
    if rule.get("strategy", "heading") not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}")
    elements = docx.read_reported(spark, spec["file_path"], spec.get("image_mode", "metadata_only"))
    return S.chunk_sections(S.build_sections(elements), int(rule.get("max_tokens", 4000)), int(rule.get("overlap_tokens", 200)))


@options(("config",))
def model_transform(spark: SparkSession, tables: dict[str, DataFrame], spec: dict[str, Any]) -> dict[str, DataFrame]:
    """The first table through the model, to every sink; it is written once before they read it."""
    config = spec["config"]
    results = E.extract(next(iter(tables.values())), spec.get("provider") or provider_of(config), E.Prompts(config))
    results = Scratch(spark, "transform").keep(results, "envelopes")
    return {"json_output": results, "txt_fallback": results}


@options(("output_dir",))
def json_sink(df: DataFrame, spec: dict[str, Any]) -> None:
    sinks.write_json(df, spec["output_dir"])


@options(("output_dir",))
def fallback_sink(df: DataFrame, spec: dict[str, Any]) -> None:
    sinks.write_fallback(df, spec["output_dir"])


def load(name: str, spec: Mapping[str, Any] | None = None):
    """A plug-in by dotted path: a callable of this package or of the caller. A spec lacking what it needs is an error."""
    module, _, attribute = name.rpartition(".")
    plugin = getattr(importlib.import_module(module), attribute)
    missing = [x for x in getattr(plugin, "required_options", ()) if not (spec or {}).get(x)]
    if spec is not None and missing:
        raise ValueError(f"{name} needs {', '.join(missing)}")
    return plugin


def with_defaults(plugin, spec: Mapping[str, Any]) -> dict[str, Any]:
    return {**getattr(plugin, "optional_options", {}), **spec}


def run_pipeline(spark: SparkSession, plan: dict[str, Any]) -> dict[str, DataFrame]:
    """sources, transform and sinks of a parsed plan, each a dotted path with options."""
    # every part is found and its options are checked before anything runs
    step = plan["transform"]
    sources, transform, ends = ([(load(s["module"], s), s) for s in part] for part in (plan["sources"], [step], plan["sinks"]))
    tables = {s["name"]: f(spark, with_defaults(f, s)) for f, s in sources}
    out = transform[0][0](spark, tables, with_defaults(transform[0][0], step))
    for f, s in ends:
        f(out[s["name"]], with_defaults(f, s))
    return out


# --- command line ------------------------------------------------------------------------------


def check_drift(config: dict[str, Any], folder: str, check_only: bool) -> bool:
    """Whether the column lists under a folder are those of the schemas; writes them unless only asked."""
    ok, schemas = True, Schemas(config)
    for name in schemas.sections:
        file, want = Path(folder) / f"{name}.sql", ddl(name, schemas.fields(name))
        have = file.read_text(encoding="utf-8") if file.is_file() else None
        if have == want:
            print(f"OK {file}")
        elif check_only:
            ok = False
            first = next((f"line {n}: {b!r} is not {a!r}" for n, (a, b) in enumerate(zip(want.splitlines(), (have or "").splitlines()), 1) if a != b), "lengths differ")
            print(f"MISSING {file}" if have is None else f"OUT OF SYNC {file}: {first}")
        else:
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_text(want, encoding="utf-8")
            print(f"WROTE {file}")
    return ok


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="tessera")
    sub = top.add_subparsers(dest="command", required=True)
    run = sub.add_parser("extract", help="documents to structured JSON")
    run.add_argument("docx")
    run.add_argument("--output-dir", default="output/extractions")
    run.add_argument("--max-chunks", type=int, default=0)
    sync = sub.add_parser("sync", help="write or check the schemas' column lists")
    sync.add_argument("--folder", default="schemas")
    sync.add_argument("--check", action="store_true")
    for p in (run, sync):
        p.add_argument("--config", required=True)
        p.add_argument("--section", default="engine")
        p.add_argument("--genre", default="")
    args = top.parse_args(argv)
    config = load_config(args.config, args.section, args.genre)
    if args.command == "sync":
        return 0 if check_drift(config, args.folder, args.check) else 1
    spark = SparkSession.builder.getOrCreate()
    results, merged = extract_documents(spark, docx.read_reported(spark, args.docx), config, provider_of(config), max_chunks=args.max_chunks)
    sinks.write_documents(merged, args.output_dir)
    sinks.write_json(results, args.output_dir)
    s = run_summary(results.select(F.col("is_structured").alias("ok"), F.col("confidence_score").alias("confidence"), "latency_ms")).first()
    print(f"{s['succeeded']}/{s['chunks']} chunks, mean confidence {s['mean_confidence'] or 0:.3f}, mean latency {s['mean_latency_ms'] or 0:.0f} ms")
    return 0


if __name__ == "__main__":
    sys.exit(main())
