"""One row per document from chunk extractions: claims by schema, merge, JSON in schema order."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.schema import CHUNK_ONLY, Field
from tessera.functions.text import fold_text
from tessera.operators import merge
from tessera.runtime import Scratch, ship_package, spread

_CLAIM = pa.schema([("doc", pa.string()), ("ci", pa.int32()), ("pos", pa.int32()), ("cid", pa.string()), ("field", pa.string()), ("rule", pa.string()), ("value", pa.string()), ("fold", pa.string()), ("anon", pa.bool_()),
                    ("key", pa.string()), ("nested_rank", pa.int32()), ("nested", pa.string()), ("values", pa.list_(pa.string()))])
CLAIM = "doc string, ci int, pos int, cid string, field string, rule string, value string, fold string, anon boolean, key string, nested_rank int, nested string, values array<string>"


def absent(v: object) -> bool:
    return v is None or v == "" or (isinstance(v, list) and not v)


def shown(v: object) -> str:
    return json.dumps(v, ensure_ascii=False)


def claims_of(extraction: dict, fields: list[Field]) -> Iterator[dict]:
    """The claims one chunk makes, in its own order; values are JSON, list items plain text."""
    for f in fields:
        if f.name in CHUNK_ONLY or f.name not in extraction or absent(extraction[f.name]):
            continue
        v = extraction[f.name]
        if f.is_entity:
            for pos, item in enumerate(v if isinstance(v, list) else ()):
                if not isinstance(item, dict):
                    continue
                name = item.get(f.identity) if f.identity else None
                key = {"field": f.name, "pos": pos, "anon": absent(name), "key": None if absent(name) else fold_text(name)}
                yield {**key, "rule": "entity"}
                for n, g in enumerate(f.fields):
                    x = item.get(g.name)
                    if g.is_list:
                        # what is absent makes no difference to a later fill, but is written out by a first one
                        given = [None if y is None else str(y) for y in x] if isinstance(x, list) else [] if absent(x) else [str(x)]
                        yield {**key, "rule": "entity_list", "nested_rank": n, "nested": g.name, "values": given}
                    elif not absent(x):
                        yield {**key, "rule": "entity_field", "nested_rank": n, "nested": g.name, "value": shown(x), "fold": fold_text(x)}
        elif f.is_list:
            for pos, x in enumerate(v if isinstance(v, list) else [v]):
                if not absent(x):
                    yield {"field": f.name, "pos": pos, "rule": "list", "value": str(x)}
        else:
            yield {"field": f.name, "pos": 0, "rule": "collect" if f.merge == "collect" else "first", "value": shown(v), "fold": fold_text(v)}


def claims(chunks: DataFrame, fields: list[Field]) -> DataFrame:
    """chunks(doc, ci, cid, extraction as JSON text or null) -> claims; the only Python pass of the merge."""
    ship_package(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, ci, cid, text in zip(*(c.to_pylist() for c in b.columns)):
                if text is not None:
                    rows += [{"doc": doc, "ci": ci, "cid": cid, **c} for c in claims_of(json.loads(text), fields)]
            yield pa.RecordBatch.from_pylist(rows, schema=_CLAIM)

    stated = chunks.where("extraction is not null").select("doc", F.col("ci").cast("int"), "cid", "extraction")
    return spread(stated).mapInArrow(run, CLAIM)


def _by_doc(df: DataFrame, order, value, name: str) -> DataFrame:
    """doc, field, name: a JSON array of the values in order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"]), ",")
    return df.groupBy("doc", "field").agg(F.concat(F.lit("["), joined, F.lit("]")).alias(name))


def _json_string(c):
    """A text as a JSON string; null stays null."""
    j = F.to_json(F.struct(c.alias("x")))
    return F.when(c.isNotNull(), F.substr(j, F.lit(6), F.char_length(j) - 6))


def _object(pairs: list) -> object:
    """A JSON object from (key column, value column) pairs."""
    parts = []
    for n, (k, v) in enumerate(pairs):
        parts += [F.lit("," if n else ""), k, F.lit(":"), v]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def all_info(chunks: DataFrame, fields: list[Field], scratch: Scratch | None = None) -> DataFrame:
    """chunks(doc, ci, cid, ok, extraction, confidence) -> doc, all_info: the document's table as JSON text.

    Fields come in schema order, with null or [] where nothing was stated; then _provenance and _stats.
    Rows of a document with failed chunks only have the empty shape.
    """
    fields = [f for f in fields if f.name not in CHUNK_ONLY]
    scratch = scratch or Scratch(chunks.sparkSession, "all-info")
    c = scratch.keep(claims(chunks, fields), "claims")
    rule = lambda r: c.where(F.col("rule") == r)
    values = []
    lists = merge.list_union(rule("list"))
    values.append(_by_doc(lists, F.col("first"), _json_string(F.col("value")), "value"))
    source = _object([(_json_string(F.lit("value")), F.col("value")), (_json_string(F.lit("source_chunk_ids")), F.to_json("src"))])
    values.append(_by_doc(merge.collect_values(rule("collect")), F.col("first"), source, "value"))
    firsts = scratch.keep(merge.first_non_null(rule("first")), "first")
    values.append(firsts.select("doc", "field", "value"))
    keys = ["doc", "field", "anon", "akey"]
    heads = merge.entities(rule("entity"))
    plain = merge.entity_fields(rule("entity_field"))
    listed = merge.entity_lists(rule("entity_list"))
    cells = plain.select(*keys, "nested_rank", "value", "conflicts").unionByName(listed.select(*keys, "nested_rank", F.to_json("items").alias("value")), allowMissingColumns=True)
    rows = cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("nested_rank", "value"))).alias("cell"), F.array_sort(F.flatten(F.collect_list("conflicts"))).alias("conflicts"))
    rows = heads.join(rows.select(*[F.col(k).alias(f"r_{k}") for k in keys], "cell", "conflicts"), (F.col("doc") == F.col("r_doc")) & (F.col("field") == F.col("r_field")) & (F.col("anon") == F.col("r_anon")) & (F.col("akey") == F.col("r_akey")), "left")
    body = F.lit(None).cast("string")
    for f in fields:
        if f.is_entity:
            pairs = [(_json_string(F.lit(g.name)), F.coalesce(F.try_element_at("cell", F.lit(n)), F.lit("[]" if g.is_list else "null"))) for n, g in enumerate(f.fields)]
            clash = F.transform(
                F.coalesce("conflicts", F.array().cast("array<struct<ci:int,pos:int,nested_rank:int,nested:string,value:string,cid:string>>")),
                lambda x: _object([(_json_string(F.lit("field")), _json_string(x["nested"])), (_json_string(F.lit("value")), x["value"]), (_json_string(F.lit("chunk_id")), _json_string(x["cid"]))]),
            )
            pairs += [(_json_string(F.lit("source_chunk_ids")), F.to_json("src")), (_json_string(F.lit("conflicts")), F.concat(F.lit("["), F.array_join(clash, ","), F.lit("]")))]
            body = F.when(F.col("field") == f.name, _object(pairs)).otherwise(body)
    values.append(_by_doc(rows.withColumn("body", body), F.col("first"), F.col("body"), "value"))
    found = values[0]
    for v in values[1:]:
        found = found.union(v)
    table = found.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("found"))
    entry = F.concat(_json_string(F.col("value")), F.lit(":"), F.to_json("src"))
    traced = lists.groupBy("doc", "field").agg(F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", entry.alias("v")))), lambda x: x["v"]), ","), F.lit("}")).alias("value"))
    traced = traced.union(firsts.select("doc", "field", F.to_json("src"))).groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("traced"))
    whole = merge.stats(chunks).join(table, "doc", "left").join(traced, "doc", "left")
    pairs = [(_json_string(F.lit(f.name)), F.coalesce(F.try_element_at("found", F.lit(f.name)), F.lit("[]" if f.is_entity or f.is_list or f.merge == "collect" else "null"))) for f in fields]
    kept = F.array_compact(F.array(*[F.concat(_json_string(F.lit(f.name)), F.lit(":"), F.try_element_at("traced", F.lit(f.name))) for f in fields]))
    number = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("null"))
    pairs.append((F.lit('"_provenance"'), F.concat(F.lit("{"), F.array_join(kept, ","), F.lit("}"))))
    pairs.append((F.lit('"_stats"'), _object([(F.lit(f'"{n}"'), number(n)) for n in ("chunks_merged", "chunks_failed", "confidence_min", "confidence_avg")])))
    return whole.select("doc", _object(pairs).alias("all_info"))
