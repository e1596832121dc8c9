"""Driver queries for sources, sinks, declared pipelines and the schema language, with equivalent SQL.

Each goes the way a user's run goes: Word files are packed and parsed, a declared plan writes its files
and they are read back, results pass through the merge of a configuration.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import queries as Q
from tessera.functions import schema as C
from tessera.operators import extract as E
from tessera.plans import pipeline as P
from tessera.runtime import Scratch, read_table, ship_package
from tessera.sources import docx, sinks, tables

_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
_STYLES = f'<w:styles {_NS}><w:style w:type="paragraph" w:styleId="Title2"><w:name w:val="Heading 2"/></w:style></w:styles>'


def word_file(text: str) -> bytes:
    """A Word file of a text's lines: short ones are headings, every seventh breaks a page."""
    body = []
    for n, line in enumerate(text.split("\n")):
        style = '<w:pPr><w:pStyle w:val="Title2"/></w:pPr>' if 0 < len(line.strip()) < 40 else ""
        broken = '<w:br w:type="page"/>' if n % 7 == 6 else ""
        body.append(f'<w:p>{style}<w:r><w:t xml:space="preserve">{escape(line, {chr(13): "&#13;"})}</w:t>{broken}</w:r></w:p>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/styles.xml", _STYLES)
        z.writestr("word/document.xml", f"<w:document {_NS}><w:body>{''.join(body)}</w:body></w:document>")
    return out.getvalue()


def word_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The documents as Word files, parsed and cut into chunks: the same chunks as from their lines."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 64):
                part = b.slice(a, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([word_file(t) for t in part.column(1).to_pylist()], pa.binary())], names=["path", "content"])

    texts = Q._documents(spark, d).select(F.col("doc_id").cast("string").alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    return Q.chunk_rows(docx.elements_of(docx.parse_files(texts.mapInArrow(run, "path string, content binary"))))


#: The configuration of the queries below; its strings are filled from an environment.
CONFIG = {
    "extraction": {"core": True, "genre": "house", "schema_version": "${VERSION:2}"},
    "prompts": {"version": "${PROMPT:7}", "system": "Read ${WHAT:plans}. Keep ${THIS}.\n\n", "user_template": "{content}"},
    "schemas": {
        "core": {
            "system_prompt_suffix": "never shown",
            "fields": [
                {"name": "n", "type": "int", "description": "length", "constraints": {"ge": 40, "lt": 200}},
                {"name": "confidence_score", "type": "float", "description": "how sure", "constraints": {"ge": 0, "le": 0.8, "default": 0.5}},
                {"name": "thinking", "description": "steps"},
            ],
        },
        "genres": {
            "house": {
                "system_prompt_suffix": "Mind the rooms.  ",
                "fields": [
                    {"name": "words", "type": "list[str]", "description": "terms"},
                    {"name": "rooms", "type": "list[object]", "description": "rooms", "identity": "name", "fields": [{"name": "name", "type": "str", "description": "its name"}, {"name": "width", "type": "float?", "description": "metres", "constraints": {"gt": 0}}]},
                ],
            }
        },
    },
}
_ENVIRONMENT = {"WHAT": "houses", "PROMPT": ""}


def schema_texts(spark: SparkSession, d: str) -> DataFrame:
    """What the model is told: the JSON Schema's properties, the system prompt, the instructions, the versions."""
    prompts = E.Prompts(P.substitute(CONFIG, _ENVIRONMENT))
    built = json.loads(prompts.constants["json_schema"])
    rows = [("property", k, json.dumps(v, sort_keys=True)) for k, v in built["properties"].items()]
    rows += [("required", "", ",".join(built["required"])), ("system", "", prompts.system), ("instructions", "", prompts.constants["extraction_instructions"])]
    rows += [("version", "prompt", prompts.version), ("version", "schema", prompts.schema_version)]
    return spark.createDataFrame(rows, "kind string, name string, value string")


def strict_check(spark: SparkSession, d: str) -> DataFrame:
    """Replies as typed rows, and the fields that are missing or out of bounds."""
    fields = C.Schemas(CONFIG).fields("core")
    n = F.char_length("text")
    reply = F.to_json(F.struct(F.when(n % 4 != 0, n).alias("n"), F.when(n % 3 != 0, n % 10 / 10).alias("confidence_score")))
    t = Q._turns(spark, d).withColumn("v", F.from_json(reply, C.struct_type(fields)))
    return t.select(F.col("doc").alias("conv_id"), F.col("ci").cast("long").alias("turn"), F.col("v.n").alias("n"), F.array_join(C.violations(F.col("v"), fields), ",").alias("bad"))


def merged_results(spark: SparkSession, d: str) -> DataFrame:
    """Envelopes through a configuration's merge: core and genre fields in order, those of one chunk only left out."""
    m = P.merge_results(Q._envelopes(spark, d), CONFIG, Scratch(spark, "merged"))
    got = lambda p: F.get_json_object("all_info", p)
    stats = [got(f"$._stats.{k}").cast("long").alias(k) for k in ("chunks_merged", "chunks_failed")] + [F.round(got(f"$._stats.confidence_{k}").cast("double"), 6).alias(f"confidence_{k}") for k in ("min", "avg")]
    return m.select(F.col("doc").cast("long").alias("conv_id"), F.array_join(F.json_object_keys("all_info"), ",").alias("keys"), got("$.n").cast("long").alias("n"), got("$._provenance.n").alias("sources"), *stats)


def turns_source(spark: SparkSession, spec: dict) -> DataFrame:
    """A plug-in: a conversation's turns as chunks."""
    return Q.turn_chunks(spark, spec["sf_dir"])


def declared_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """A declared plan whose second source is not read; its JSON and text files, read back."""
    folder = Scratch(spark, "declared").path
    source = {"module": f"{__name__}.turns_source", "sf_dir": d}
    plan = {
        "sources": [{"name": "turns", **source}, {"name": "other", **source}],
        "transform": {"module": "tessera.plans.pipeline.model_transform", "config": CONFIG, "provider": E.RuleProvider(Q._reply_rule)},
        "sinks": [{"name": "json_output", "module": "tessera.plans.pipeline.json_sink", "output_dir": folder}, {"name": "txt_fallback", "module": "tessera.plans.pipeline.fallback_sink", "output_dir": folder}],
    }
    P.run_pipeline(spark, plan)
    results = "chunk_id string, source_file string, source_position string, extraction_result struct<n: long>, model_name string, validation_status string"
    told = spark.read.schema(results).option("multiLine", True).json(f"{folder}/*.json")
    told = told.select(F.lit("json").alias("sink"), "chunk_id", "source_file", "source_position", F.col("extraction_result.n").alias("n"), "model_name", "validation_status")
    lines = spark.read.text(f"{folder}/fallback_*").where(F.col("value").startswith("CHUNK: "))
    return told.unionByName(lines.select(F.lit("txt").alias("sink"), F.substring("value", 8, 1 << 30).alias("chunk_id")), allowMissingColumns=True)


def corrupt_results(spark: SparkSession, d: str) -> DataFrame:
    """Results written as JSON lines, every fifth turn's cut short: the others come back."""
    e = Q._envelopes(spark, d)
    line = F.to_json(F.struct(*[F.col(c) for c in e.columns]))
    folder = Scratch(spark, "lines").folder("results")
    e.select(F.when(F.col("chunk_index") % 5 == 0, F.substring(line, 1, 30)).otherwise(line)).write.text(folder)
    return sinks.read_results(spark, folder).select("chunk_id", "is_structured", "extraction_result")


def table_formats(spark: SparkSession, d: str) -> DataFrame:
    """The customers written to and read from each file format, partitioned by nation."""
    scratch = Scratch(spark, "formats")
    customers = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name")
    out = None
    for kind in ("parquet", "orc", "csv", "json"):
        path, options = scratch.folder(kind), {"header": True} if kind == "csv" else {}
        sinks.write(customers, kind, path, partition_by=["c_nationkey"], **options)
        back = tables.read(spark, kind, path, **options)
        rows = back.select(F.lit(kind).alias("format"), F.col("c_nationkey").cast("long").alias("nation"), F.col("c_custkey").cast("long").alias("key"), F.col("c_name").alias("name"))
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {f.__name__: f for f in (word_chunks, schema_texts, strict_check, merged_results, declared_pipeline, corrupt_results, table_formats)}

_SCHEMA_ROWS = """VALUES ('property', 'n', '{"description": "length", "exclusiveMaximum": 200, "minimum": 40, "type": "integer"}'),
    ('property', 'confidence_score', '{"default": 0.5, "description": "how sure", "maximum": 0.8, "minimum": 0, "type": "number"}'),
    ('property', 'thinking', '{"description": "steps", "type": ["string", "null"]}'),
    ('property', 'words', '{"description": "terms", "items": {"type": "string"}, "type": "array"}'),
    ('property', 'rooms', '{"description": "rooms", "items": {"properties": {"name": {"description": "its name", "type": "string"}, "width": {"description": "metres", "exclusiveMinimum": 0, "type": ["number", "null"]}}, "required": ["name"], "type": "object"}, "type": "array"}'),
    ('required', '', 'n,confidence_score'), ('system', '', 'Read houses. Keep ${THIS}.' || chr(10) || 'Mind the rooms.'), ('version', 'prompt', ''), ('version', 'schema', '2'),
    ('instructions', '', '### Core（必填）' || chr(10) || '- n: length' || chr(10) || '- confidence_score: how sure' || chr(10) || '- thinking: steps' || chr(10) || '### House Genre（house領域）' || chr(10) || '- words: terms' || chr(10) || '- rooms: rooms（每筆包含：name、width）')"""

ORACLE_SQL = {
    "word_chunks": Q.ORACLE_SQL["document_chunks"],
    "schema_texts": f"SELECT * FROM ({_SCHEMA_ROWS}) AS x(kind, name, value)",
    "strict_check": f"""WITH {Q._T} SELECT conv_id, turn::BIGINT AS turn, CASE WHEN length(text) % 4 <> 0 THEN length(text) END AS n,
        concat_ws(',', CASE WHEN length(text) % 4 = 0 OR length(text) < 40 OR length(text) >= 200 THEN 'n' END, CASE WHEN length(text) % 3 <> 0 AND length(text) % 10 > 8 THEN 'confidence_score' END) AS bad FROM t""",
    "merged_results": f"""WITH {Q._ENV}, f AS (SELECT conv_id, arg_min(length(text), turn) FILTER (ok) AS n, count(*) FILTER (ok) AS chunks_merged, count(*) FILTER (NOT ok) AS chunks_failed,
        round(min(length(text) % 10 / 10.0::DOUBLE) FILTER (ok), 6) AS confidence_min, round(avg(length(text) % 10 / 10.0::DOUBLE) FILTER (ok), 6) AS confidence_avg FROM v GROUP BY conv_id),
        s AS (SELECT conv_id, '["' || string_agg(cid, '","' ORDER BY turn) || '"]' AS sources FROM v JOIN f USING (conv_id) WHERE ok AND length(text) = n GROUP BY conv_id)
        SELECT f.*, sources, 'n,words,rooms,_provenance,_stats' AS keys FROM f LEFT JOIN s USING (conv_id)""",
    "declared_pipeline": f"""WITH {Q._ENV} SELECT 'json' AS sink, cid AS chunk_id, source_file, 'turn ' || turn AS source_position, length(text) AS n, 'rule' AS model_name, 'pending' AS validation_status FROM v WHERE ok
        UNION ALL SELECT 'txt', cid, NULL, NULL, NULL, NULL, NULL FROM v WHERE NOT ok""",
    "corrupt_results": f"WITH {Q._ENV} SELECT cid AS chunk_id, ok AS is_structured, CASE WHEN ok THEN reply END AS extraction_result FROM v WHERE turn % 5 <> 0",
    "table_formats": "SELECT format, c_nationkey::BIGINT AS nation, c_custkey::BIGINT AS key, c_name AS name FROM customer, (VALUES ('parquet'), ('orc'), ('csv'), ('json')) AS f(format)",
}
