"""Sinks: structured results as JSON by document, fallbacks as text, and Spark's own formats."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators.extract import ENVELOPE, fallback_block, structured, unstructured

FORMATS = ("parquet", "orc", "csv", "json", "text", "jdbc")


def stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


#: Columns of the envelope that serve the run and are not part of a written result.
INTERNAL = ("doc", "raw_response", "parse_error", "chunk_index", "stated_confidence")


def by_source(results: DataFrame) -> DataFrame:
    """source_file, results: structured envelopes of a file as a JSON array in chunk order; no name: "unknown".

    An envelope has all its keys, in their order, nulls too; its extraction is an object, as the model wrote it.
    """
    rows = structured(results).withColumn("source_file", F.coalesce("source_file", F.lit("unknown")))
    names = [c for c in results.columns if c not in INTERNAL]
    at = names.index("extraction_result") if "extraction_result" in names else len(names)
    inner = [F.regexp_replace(F.to_json(F.struct(*part), {"ignoreNullFields": "false"}), "^\\{|\\}$", "") for part in (names[:at], names[at + 1 :]) if part]
    if at < len(names):
        inner.insert(min(at, 1), F.concat(F.lit('"extraction_result":'), F.coalesce("extraction_result", F.lit("null"))))
    body = F.concat(F.lit("{"), F.concat_ws(",", *inner), F.lit("}"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id", body.alias("v")))), lambda x: x["v"])
    return rows.groupBy("source_file").agg(F.concat(F.lit("["), F.array_join(listed, ",\n"), F.lit("]")).alias("results"))


def write_named(files: DataFrame, folder: str) -> None:
    """files(file, value as JSON text): one indented file a row, ``<folder>/<file>.json``.

    A file is written beside its place and then moved, so no reader meets half a file and an attempt that
    is repeated replaces its own. No rows: no files.
    """
    uri = folder if "://" in folder else f"file://{os.path.abspath(folder)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            if b.num_rows:
                store, base = fs.FileSystem.from_uri(uri)
                store.create_dir(base, recursive=True)
            for name, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = f"{base}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression=None) as f:
                    f.write(json.dumps(json.loads(value), ensure_ascii=False, indent=2).encode())
                store.move(part, f"{base}/{name}.json")
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["file"])

    files.select("file", "value").mapInArrow(run, "file string").write.format("noop").mode("overwrite").save()


def _named(path: Column, now: datetime | None, prefix: str = "") -> Column:
    """A document's name, a hash so that equal stems stay apart, the time."""
    return F.concat(F.lit(prefix), F.concat_ws("_", X.stem(path), X.name_hash(path), F.lit(stamp(now))))


def write_json(results: DataFrame, folder: str, now: datetime | None = None) -> None:
    """One indented JSON array of structured results a document."""
    write_named(by_source(results).select(_named(F.col("source_file"), now).alias("file"), F.col("results").alias("value")), folder)


def write_documents(merged: DataFrame, folder: str, now: datetime | None = None) -> None:
    """One indented JSON object a merged document."""
    write_named(merged.select(_named(F.col("doc"), now, "all_info_").alias("file"), F.col("all_info").alias("value")), folder)


def fallback_text(results: DataFrame) -> DataFrame:
    """chunk order and block of every result that is not structured."""
    return unstructured(results).select("source_file", "chunk_index", fallback_block(F.col("chunk_id"), F.col("source_file"), F.col("source_page"), F.col("source_section"), F.col("extracted_at"), F.col("fallback_text")).alias("block"))


def write_fallback(results: DataFrame, folder: str, now: datetime | None = None) -> str | None:
    """Blocks in document and chunk order, a blank line between them, as text parts of one folder; none: no folder."""
    rows = fallback_text(results)
    if rows.isEmpty():
        return None
    path = f"{folder.rstrip('/')}/fallback_{stamp(now)}"
    rows.orderBy("source_file", "chunk_index").select(F.concat("block", F.lit("\n"))).write.text(path)
    return path


def write(df: DataFrame, kind: str, path: str | None = None, mode: str = "append", partition_by: list[str] | None = None, **options) -> None:
    if kind not in FORMATS:
        raise ValueError(f"format is one of {FORMATS}")
    w = df.write.format(kind).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path) if path else w.save()


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes written as JSON lines; lines that can't be parsed are skipped."""
    return spark.read.schema("doc string, " + ENVELOPE).option("mode", "DROPMALFORMED").json(path)
