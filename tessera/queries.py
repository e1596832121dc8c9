"""Driver queries for the document engine, each over its whole tables, with equivalent SQL.

Stand-ins: a document's lines are paragraphs (short ones headings, every seventh breaks a page), a
conversation is a document whose turns are chunks, and rules over text replace the model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.functions import text as X
from tessera.functions.schema import parse_field
from tessera.operators import all_info as A
from tessera.operators import extract as E
from tessera.operators import merge as M
from tessera.operators import sections as S
from tessera.runtime import Scratch, read_table, spread
from tessera.sources import sinks, tables

MAX_TOKENS, OVERLAP = 400, 60
TEMPLATE = "## {source_file}\n### {source_section}\n{content}\n{extraction_instructions}\n{{json}}"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(read_table(spark, d, "documents"))


def _elements(spark: SparkSession, d: str) -> DataFrame:
    short = (F.col("text") != "") & (F.char_length("text") < 40)
    return tables.text_elements(_documents(spark, d), F.col("doc_id"), "text", short, F.col("ord") % 7 == 6)


def _turns(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "conversations")
    return c.select(F.col("conv_id").alias("doc"), F.col("turn").cast("int").alias("ci"), F.concat_ws("_", "conv_id", "turn").alias("cid"), "role", F.coalesce("text", F.lit("")).alias("text"))


def token_estimate(spark, d):
    return _documents(spark, d).select("doc_id", X.token_estimate(F.col("text")).alias("tokens"))


def chunk_id_hash(spark, d):
    name = F.concat(F.lit("/data/"), F.col("source"), F.lit("."), F.col("lang"), F.lit(".docx"))
    return _documents(spark, d).select("doc_id", X.chunk_id(name, F.col("doc_id")).alias("chunk_id"), X.base_name(name).alias("base"), X.stem(name).alias("stem"))


def position_string(spark, d):
    n = F.col("n_chars")
    part = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 4 + 1)
    return _documents(spark, d).select("doc_id", X.position(F.col("source"), n % 3 + 1, n % 3 + 1 + F.col("doc_id") % 2, F.col("doc_id") % 10, F.col("doc_id") % 10 + 4, part).alias("position"))


def page_running_count(spark, d):
    return S.annotate(_elements(spark, d)).select(F.col("doc").cast("long").alias("doc_id"), F.col("ord").cast("long").alias("ord"), F.col("page").cast("long").alias("page"), F.col("para").cast("long").alias("para"), F.col("section").cast("long").alias("section"))


def _sections(spark, d):
    return S.build_sections(_elements(spark, d)).withColumn("doc_id", F.col("doc").cast("long"))


def paragraph_ranges(spark, d):
    return _sections(spark, d).select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("section", "page_start", "page_end", "para_start", "para_end")])


def section_by_heading(spark, d):
    return _sections(spark, d).select("doc_id", F.col("section").cast("long").alias("section"), "heading", F.size("paragraphs").cast("long").alias("n_paragraphs"), F.md5(F.array_join("paragraphs", "\n")).alias("body_md5"))


def preamble_heading(spark, d):
    return _sections(spark, d).where("section = 0").select("doc_id", "heading")


def html_sections(spark, d):
    e = tables.html_elements(read_table(spark, d, "pages"), F.col("page_id"), "html")
    return S.build_sections(e).select(F.col("doc").cast("long").alias("page_id"), F.col("section").cast("long").alias("section"), "heading", F.array_join("parts", "\n").alias("body"))


def identity_fold(spark, d):
    return _documents(spark, d).select("doc_id", F.md5(X.identity_fold(F.col("text"))).alias("fold_md5"))


def tables_and_images(spark, d):
    """Every fifth line a table of its words, every fourth one with an image."""
    e = _elements(spark, d).withColumn("kind", F.when(F.col("ord") % 5 == 3, F.lit("tbl")).otherwise(F.lit("p")))
    cells = F.filter(F.array(*[F.slice(F.split("text", " "), n, 2) for n in (1, 3)]), lambda r: F.size(r) > 0)
    e = e.withColumn("text", F.when((F.col("kind") == "tbl") & (F.col("text") != ""), S.table_markdown(cells)).otherwise(F.col("text")))
    image = F.struct(F.concat(F.lit("rId"), F.col("ord").cast("string")).alias("image_ref"), (F.col("ord") + 1).cast("int").alias("page_estimate"), F.lit("metadata_only").alias("mode"))
    e = e.withColumn("images", F.when(F.col("ord") % 4 == 2, F.array(image)).otherwise(F.array().cast(S.IMAGE)))
    c = S.chunk_sections(S.build_sections(e), MAX_TOKENS, OVERLAP)
    return c.select(F.col("doc").cast("long").alias("doc_id"), F.col("chunk_index").cast("long").alias("chunk_index"), "source_position", F.md5("content").alias("content_md5"), "image_refs")


def _packed(spark, d, overlap):
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), X.strip), lambda x: x != "")
    c = _documents(spark, d).select("doc_id", F.posexplode(S.pack(lines, MAX_TOKENS, overlap)).alias("chunk", "lines"))
    content = F.array_join("lines", "\n")
    return c.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.size("lines").cast("long").alias("n_lines"), X.token_estimate(content).alias("tokens"), F.md5(content).alias("content_md5"))


def pack_chunks(spark, d):
    return _packed(spark, d, 0)


def pack_chunks_overlap(spark, d):
    return _packed(spark, d, OVERLAP)


def document_chunks(spark, d):
    return chunk_rows(_elements(spark, d))


def chunk_rows(elements: DataFrame) -> DataFrame:
    c = S.chunk_sections(S.build_sections(elements), MAX_TOKENS, OVERLAP)
    whole = [F.col(x).cast("long").alias(x) for x in ("source_page", "source_page_end", "chunk_index", "token_estimate")]
    return c.select(F.col("doc").cast("long").alias("doc_id"), "chunk_id", "source_section", "source_position", F.md5("content").alias("content_md5"), "content_type", "image_refs", *whole)


def full_text(spark, d):
    t = S.full_text(_turns(spark, d).select("doc", F.col("ci").alias("chunk_index"), F.col("text").alias("content")))
    return t.select(F.col("doc").alias("conv_id"), F.md5("full_text").alias("text_md5"), F.char_length("full_text").cast("long").alias("n_chars"))


def head_chunks(spark, d):
    return S.head_chunks(_turns(spark, d).withColumnRenamed("ci", "chunk_index"), 2).select(F.col("doc").alias("conv_id"), F.col("chunk_index").cast("long").alias("turn"), "role")


def table_markdown(spark, d):
    row = lambda c, n: F.slice(F.split(c, " "), n, 3)
    rows = F.filter(F.array(*[row(F.col("text"), n) for n in (1, 4, 7)]), lambda r: F.size(r) > 0)
    return _turns(spark, d).select(F.col("doc").alias("conv_id"), F.col("ci").cast("long").alias("turn"), S.table_markdown(rows).alias("markdown"))


def _replies(spark, d):
    """Something like a model's reply: a comma too many, sometimes a fence."""
    body = F.concat(F.lit('{"t": "'), F.regexp_replace("text", '["\\\\\\\\]', ""), F.lit('", "n": [1, 2, ],\n}'))
    fenced = F.when(F.col("ci") % 3 == 0, F.concat(F.lit(" ```json\n"), body, F.lit("\n```"))).when(F.col("ci") % 3 == 1, F.concat(F.lit("```\n"), body, F.lit("\n```\nafter"))).otherwise(body)
    return _turns(spark, d).select(F.col("doc").alias("conv_id"), F.col("ci").cast("long").alias("turn"), fenced.alias("reply"))


def strip_code_fence(spark, d):
    return _replies(spark, d).select("conv_id", "turn", F.md5(X.strip_fence(F.col("reply"))).alias("inner_md5"))


def clean_json(spark, d):
    return _replies(spark, d).select("conv_id", "turn", F.md5(X.clean_json(F.concat("reply", F.lit("\u0001\u000b")))).alias("clean_md5"))


def render_prompt(spark, d):
    pieces = E.split_template(TEMPLATE, {"extraction_instructions": "- title: a title", "json_schema": "{}"})
    c = _turns(spark, d).select("doc", "ci", F.col("role").alias("source_file"), F.col("cid").alias("source_section"), F.col("text").alias("content"))
    return c.select(F.col("doc").alias("conv_id"), F.col("ci").cast("long").alias("turn"), F.md5(E.render(pieces)).alias("prompt_md5"))


def _reply_rule(user: str) -> str:
    """A reply that SQL can say as well; user is a turn's text."""
    return "not json" if len(user) % 5 == 0 else '{"n": %d, "confidence_score": %s, "thinking": "t"}' % (len(user), len(user) % 10 / 10)


def turn_chunks(spark: SparkSession, d: str) -> DataFrame:
    """A conversation's turns as chunks of a document."""
    return _turns(spark, d).select(
        F.col("doc").cast("string").alias("doc"), F.col("cid").alias("chunk_id"), F.concat("role", F.lit(".docx")).alias("source_file"), (F.col("ci") + 1).alias("source_page"), F.lit("turn").alias("source_section"), F.concat(F.lit("turn "), "ci").alias("source_position"),
        F.col("ci").alias("chunk_index"), F.col("text").alias("content"),
    )


def _envelopes(spark, d):
    prompts = E.Prompts({"prompts": {"version": "1", "system": "s", "user_template": "{content}"}, "extraction": {"core": True, "schema_version": "1"}})
    return E.extract(turn_chunks(spark, d), E.RuleProvider(_reply_rule), prompts)


def extract_envelope(spark, d):
    shown = [c for c in E._NAMES if c not in ("extracted_at", "latency_ms", "source_page", "chunk_index", "token_usage_input", "token_usage_output", "fallback_text")]
    return _envelopes(spark, d).select(*shown, F.col("source_page").cast("long").alias("source_page"), F.md5("fallback_text").alias("fallback_md5"))


def route_structured(spark, d):
    return E.structured(_envelopes(spark, d)).select("chunk_id", "extraction_result")


def route_fallback(spark, d):
    return E.unstructured(_envelopes(spark, d)).select("chunk_id", "parse_error")


def fallback_block(spark, d):
    e = _envelopes(spark, d).withColumn("extracted_at", F.lit("2000-01-01T00:00:00+00:00"))
    return sinks.fallback_text(e).select("source_file", F.col("chunk_index").cast("long").alias("turn"), F.md5("block").alias("block_md5"))


def group_by_source(spark, d):
    rows = E.structured(_envelopes(spark, d))
    return rows.groupBy(F.coalesce("source_file", F.lit("unknown")).alias("source_file")).agg(F.count(F.lit(1)).alias("results"), F.min("chunk_id").alias("first_chunk"))


# --- merge -------------------------------------------------------------------------------------


def _list_claims(spark, d):
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]{4,}"), F.lit(0))
    return _turns(spark, d).select("doc", "ci", "cid", F.lit("words").alias("field"), F.posexplode(words).alias("pos", "value"))


def _first_word(text):
    return F.regexp_extract(text, "[A-Za-z]+", 0)


def _scalar_claims(spark, d):
    t = _turns(spark, d).withColumn("value", _first_word(F.col("text")))
    value = F.when(F.col("ci") % 2 == 1, F.upper("value")).otherwise(F.col("value"))
    t = t.where(~X.is_absent(F.col("value")) & (F.char_length("text") % 2 == 0))
    return t.select("doc", "ci", F.lit(0).alias("pos"), "cid", F.lit("title").alias("field"), value.alias("value"), X.ascii_fold(value).alias("fold"))


def _joined(src="src"):
    return F.array_join(src, ",")


def merge_list_union(spark, d):
    u = M.list_union(_list_claims(spark, d))
    rank = F.row_number().over(Window.partitionBy("doc", "field").orderBy("first"))
    return u.select(F.col("doc").alias("conv_id"), "value", rank.cast("long").alias("place"))


def merge_list_provenance(spark, d):
    return M.list_union(_list_claims(spark, d)).select(F.col("doc").alias("conv_id"), "value", _joined().alias("chunks"))


def merge_first_non_null(spark, d):
    return M.first_non_null(_scalar_claims(spark, d)).select(F.col("doc").alias("conv_id"), "value")


def merge_scalar_provenance(spark, d):
    return M.first_non_null(_scalar_claims(spark, d)).select(F.col("doc").alias("conv_id"), _joined().alias("chunks"))


def merge_collect(spark, d):
    return M.collect_values(_scalar_claims(spark, d)).select(F.col("doc").alias("conv_id"), "value", _joined().alias("chunks"))


def _items(spark, d):
    """Sentences as objects: a name, its width, at times a height, and its words."""
    t = _turns(spark, d).select("doc", "ci", "cid", F.posexplode(F.split("text", "\\.")).alias("pos", "s"))
    name = F.regexp_extract("s", "[A-Za-z]{2,}", 0)
    shown = F.when(F.col("ci") % 2 == 1, F.upper(name)).otherwise(name)
    n = F.char_length("s")
    return t.select(
        "doc", "ci", "cid", "pos", F.lit("rooms").alias("field"), (name == "").alias("anon"), X.ascii_fold(shown).alias("key"), shown.alias("name"), F.concat((n % 3).cast("string"), F.lit(" wide")).alias("width"),
        F.when(n % 2 == 1, F.concat((n % 5).cast("string"), F.lit(" high"))).alias("height"), F.regexp_extract_all("s", F.lit("[a-z]{6,}"), F.lit(0)).alias("words"),
    )


def _nested(spark, d):
    fields = F.array(F.struct(F.lit(1).alias("nested_rank"), F.lit("width").alias("nested"), F.col("width").alias("value")), F.struct(F.lit(2).alias("nested_rank"), F.lit("height").alias("nested"), F.col("height").alias("value")))
    t = _items(spark, d).select("doc", "ci", "cid", "pos", "field", "anon", "key", F.inline(fields))
    return t.where("value is not null").withColumn("fold", X.ascii_fold(F.col("value")))


def merge_entities(spark, d):
    e = M.entities(_items(spark, d)).where("not anon").select("doc", "akey", "first", _joined().alias("chunks"))
    v = M.entity_fields(_nested(spark, d)).where("not anon").groupBy("doc", "akey").agg(F.max(F.when(F.col("nested") == "width", F.col("value"))).alias("width"), F.max(F.when(F.col("nested") == "height", F.col("value"))).alias("height"))
    names = M.collect_values(_items(spark, d).where("not anon").select("doc", "field", "ci", "pos", "cid", F.col("key").alias("fold"), F.col("name").alias("value"))).select("doc", F.col("fold").alias("akey"), F.col("value").alias("name"))
    out = e.join(v, ["doc", "akey"], "left").join(names, ["doc", "akey"])
    return out.select(F.col("doc").alias("conv_id"), "name", "width", "height", "chunks")


def entity_conflicts(spark, d):
    c = M.entity_conflicts(_nested(spark, d))
    return c.select(F.col("doc").alias("conv_id"), "akey", F.col("nested").alias("field"), "value", F.col("cid").alias("chunk_id"), F.col("pos").cast("long").alias("pos"))


def entity_anonymous(spark, d):
    e = M.entities(_items(spark, d)).where("anon")
    return e.select(F.col("doc").alias("conv_id"), F.col("first.ci").cast("long").alias("turn"), F.col("first.pos").cast("long").alias("pos"), _joined().alias("chunks"))


def entity_nested_list(spark, d):
    t = _items(spark, d).withColumn("nested_rank", F.lit(3)).withColumn("nested", F.lit("words")).withColumnRenamed("words", "values")
    return M.entity_lists(t).where("not anon").select(F.col("doc").alias("conv_id"), "akey", F.array_join("items", ",").alias("items"))


def _chunk_stats(spark, d):
    n = F.char_length("text")
    return _turns(spark, d).select("doc", (n % 4 != 0).alias("ok"), F.when(n % 3 != 0, (n % 8) / 8.0).alias("confidence"), (n * 3).alias("latency_ms"))


def merge_stats(spark, d):
    return M.stats(_chunk_stats(spark, d)).withColumnRenamed("doc", "conv_id")


def run_summary(spark, d):
    return M.run_summary(_chunk_stats(spark, d))


FIELDS = [parse_field({"name": "title"}), parse_field({"name": "words", "type": "list[str]"}), parse_field({"name": "missing", "type": "int?"})]
ENTITY_FIELDS = [
    *FIELDS,
    parse_field({"name": "seen", "merge": "collect"}),
    parse_field({"name": "rooms", "type": "list[object]", "identity": "name", "fields": [{"name": "name"}, {"name": "width"}, {"name": "height"}, {"name": "words", "type": "list[str]"}]}),
]


def _extractions(spark, d, *columns):
    t = _turns(spark, d).withColumn("title", F.when(F.char_length("text") % 2 == 0, _first_word(F.col("text")))).withColumn("words", F.regexp_extract_all("text", F.lit("[A-Za-z]{4,}"), F.lit(0))).withColumn("seen", F.col("title"))
    return t.select(F.col("doc").cast("string").alias("doc"), "ci", "cid", F.lit(True).alias("ok"), F.to_json(F.struct("title", "words", *columns)).alias("extraction"), F.lit(None).cast("double").alias("confidence"))


def all_info(spark, d):
    return A.all_info(_extractions(spark, d), FIELDS).select(F.col("doc").cast("long").alias("conv_id"), "all_info")


def all_info_entities(spark, d):
    rooms = F.transform(F.split("text", "\\."), lambda s: F.struct(F.regexp_extract(s, "[A-Za-z]{2,}", 0).alias("name"), F.concat((F.char_length(s) % 3).cast("string"), F.lit(" wide")).alias("width"), F.regexp_extract_all(s, F.lit("[a-z]{6,}"), F.lit(0)).alias("words")))
    t = _turns(spark, d).withColumn("rooms", rooms).withColumn("seen", _first_word(F.col("text")))
    c = t.select(F.col("doc").cast("string").alias("doc"), "ci", "cid", (F.char_length("text") % 7 != 0).alias("ok"), F.when(F.char_length("text") % 7 != 0, F.to_json(F.struct("seen", "rooms"))).alias("extraction"), F.lit(0.5).alias("confidence"))
    return A.all_info(c, ENTITY_FIELDS, Scratch(spark, "all-info")).select(F.col("doc").cast("long").alias("conv_id"), "all_info")


_LINES = r"""el AS (SELECT doc_id, ord, regexp_replace(t, '^\s+|\s+$', '', 'g') AS text FROM
    (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS ord FROM documents))"""
_TOK = "trunc(len(regexp_extract_all({0}, '[\\x{{4E00}}-\\x{{9FFF}}]'))::DOUBLE * 0.7::DOUBLE + len(regexp_extract_all({0}, '[a-zA-Z0-9]+'))::DOUBLE + (length({0}) - len(regexp_extract_all({0}, '[\\x{{4E00}}-\\x{{9FFF}}]')))::DOUBLE * 0.3::DOUBLE)::BIGINT"
_ANNOTATED = (
    _LINES
    + """, an AS (SELECT *, text <> '' AND length(text) < 40 AS hd, sum((text <> '' AND length(text) < 40)::INT) OVER w AS sec, sum((ord % 7 = 6)::INT) OVER w + 1 AS page, row_number() OVER w - 1 AS para
    FROM el WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
)
_SECTIONS = (
    _ANNOTATED
    + """, own AS (SELECT doc_id, sec, max(text) FILTER (hd) AS title, max(page) FILTER (hd) AS page_at, max(para) FILTER (hd) AS para_at, max(page) AS last_page, max(para) AS last_para,
        coalesce(list(text ORDER BY ord) FILTER (NOT hd AND text <> ''), []) AS paras FROM an GROUP BY doc_id, sec),
    nx AS (SELECT *, coalesce(lead(page_at) OVER w, last_page) AS page_end, coalesce(lead(para_at) OVER w - 1, last_para) AS para_end FROM own WINDOW w AS (PARTITION BY doc_id ORDER BY sec)),
    sc AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec) - 1 AS section FROM nx WHERE len(paras) > 0),
    s AS (SELECT doc_id, section, coalesce(title, CASE WHEN section = 0 THEN list_filter(paras, lambda p: length(p) BETWEEN 2 AND 80)[1] END, '(document start)') AS heading, paras,
        coalesce(page_at, 1) AS page_start, page_end, coalesce(para_at, 0) AS para_start, para_end FROM sc)"""
)
_T = "t AS (SELECT conv_id, turn, role, conv_id || '_' || turn AS cid, coalesce(text, '') AS text FROM conversations)"
_ENV = _T + """, v AS (SELECT *, role || '.docx' AS source_file, length(text) % 5 <> 0 AS ok,
    '{"n": ' || length(text) || ', "confidence_score": ' || (length(text) % 10 / 10.0::DOUBLE)::VARCHAR || ', "thinking": "t"}' AS reply,
    'Expecting value: line 1 column 1 (char 0)' AS err FROM t)"""
_FALLBACK = "'LLM response not valid JSON: ' || err || chr(10) || 'RAW RESPONSE:' || chr(10) || 'not json' || chr(10) || chr(10) || 'ORIGINAL CONTENT:' || chr(10) || substr(text, 1, 3000)"
_FOLD = "regexp_replace(replace(lower({0}), 'ß', 'ss'), '\\s+', '', 'g')"
_LIST = _T + """, w AS (SELECT conv_id, turn, cid, unnest(regexp_extract_all(text, '[A-Za-z]{4,}')) AS value, unnest(range(len(regexp_extract_all(text, '[A-Za-z]{4,}')))) AS pos FROM t)"""
_SCALAR = (
    _T
    + """, c AS (SELECT conv_id, turn, cid, CASE WHEN turn % 2 = 1 THEN upper(w) ELSE w END AS value FROM (SELECT *, regexp_extract(text, '[A-Za-z]+') AS w FROM t) WHERE w <> '' AND length(text) % 2 = 0),
    f AS (SELECT *, """
    + _FOLD.format("value")
    + """ AS fold FROM c),
    g AS (SELECT conv_id, fold, arg_min(value, turn) AS value, min(turn) AS first, string_agg(cid, ',' ORDER BY turn) AS chunks FROM f GROUP BY conv_id, fold)"""
)
_ITEMS = (
    _T
    + """, st AS (SELECT conv_id, turn, cid, unnest(string_split(text, '.')) AS s, unnest(range(len(string_split(text, '.')))) AS pos FROM t),
    i AS (SELECT *, n = '' AS anon, CASE WHEN turn % 2 = 1 THEN upper(n) ELSE n END AS name, lower(n) AS key, (length(s) % 3)::VARCHAR || ' wide' AS width,
        CASE WHEN length(s) % 2 = 1 THEN (length(s) % 5)::VARCHAR || ' high' END AS height, regexp_extract_all(s, '[a-z]{6,}') AS words FROM (SELECT *, regexp_extract(s, '[A-Za-z]{2,}') AS n FROM st)),
    k AS (SELECT *, CASE WHEN anon THEN turn || '/' || pos ELSE key END AS akey FROM i)"""
)


def _pack_sql(overlap: int) -> str:
    carry = f"r.ct + p.t > {MAX_TOKENS} AND {'r.lt <= ' + str(overlap) if overlap else 'FALSE'}"
    return f"""WITH RECURSIVE {_LINES}, p AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS n, text, {_TOK.format("text")} AS t FROM el WHERE text <> ''),
    r AS (SELECT doc_id, n, t AS lt, t AS ct, 0 AS k, FALSE AS carry FROM p WHERE n = 1 UNION ALL
        SELECT p.doc_id, p.n, p.t, CASE WHEN {carry} THEN r.lt + p.t WHEN r.ct + p.t > {MAX_TOKENS} THEN p.t ELSE r.ct + p.t END, r.k + (r.ct + p.t > {MAX_TOKENS})::INT, {carry} FROM r JOIN p ON p.doc_id = r.doc_id AND p.n = r.n + 1),
    m AS (SELECT doc_id, k, n FROM r UNION ALL SELECT doc_id, k, n - 1 FROM r WHERE carry),
    c AS (SELECT m.doc_id, m.k, count(*) AS n_lines, string_agg(p.text, chr(10) ORDER BY m.n) AS content FROM m JOIN p ON p.doc_id = m.doc_id AND p.n = m.n GROUP BY m.doc_id, m.k)
    SELECT doc_id, k::BIGINT AS chunk, n_lines, {_TOK.format("content")} AS tokens, md5(content) AS content_md5 FROM c"""


_DOC_CHUNKS = f"""WITH RECURSIVE {_SECTIONS}, wh AS (SELECT *, array_to_string(paras, chr(10)) AS whole FROM s), ft AS (SELECT *, {_TOK.format("whole")} <= {MAX_TOKENS} AS fits FROM wh),
    p AS (SELECT doc_id, section, n, x AS text, {_TOK.format("x")} AS t FROM (SELECT doc_id, section, unnest(paras) AS x, unnest(range(1, len(paras) + 1)) AS n FROM ft WHERE NOT fits)),
    r AS (SELECT doc_id, section, n, t AS lt, t AS ct, 0 AS k, FALSE AS carry FROM p WHERE n = 1 UNION ALL
        SELECT p.doc_id, p.section, p.n, p.t, CASE WHEN r.ct + p.t > {MAX_TOKENS} AND r.lt <= {OVERLAP} THEN r.lt + p.t WHEN r.ct + p.t > {MAX_TOKENS} THEN p.t ELSE r.ct + p.t END, r.k + (r.ct + p.t > {MAX_TOKENS})::INT,
            r.ct + p.t > {MAX_TOKENS} AND r.lt <= {OVERLAP} FROM r JOIN p ON p.doc_id = r.doc_id AND p.section = r.section AND p.n = r.n + 1),
    m AS (SELECT doc_id, section, k, n FROM r UNION ALL SELECT doc_id, section, k, n - 1 FROM r WHERE carry),
    c AS (SELECT m.doc_id, m.section, m.k, string_agg(p.text, chr(10) ORDER BY m.n) AS content, (m.k + 1)::VARCHAR AS part FROM m JOIN p USING (doc_id, section, n) GROUP BY m.doc_id, m.section, m.k
        UNION ALL SELECT doc_id, section, 0, whole, NULL FROM ft WHERE fits),
    x AS (SELECT c.*, s.heading, s.page_start, s.page_end, s.para_start, s.para_end, row_number() OVER (PARTITION BY c.doc_id ORDER BY c.section, c.k) - 1 AS ix FROM c JOIN s USING (doc_id, section))
    SELECT doc_id, substr(md5(doc_id::VARCHAR), 1, 8) || '_' || ix AS chunk_id, heading AS source_section,
        'heading: ' || heading || ', p.' || page_start || CASE WHEN page_end <> page_start THEN '-' || page_end ELSE '' END || ', para ' || para_start || '-' || para_end || coalesce(', part ' || part, '') AS source_position,
        md5(content) AS content_md5, 'text' AS content_type, '[]' AS image_refs, page_start::BIGINT AS source_page, page_end::BIGINT AS source_page_end, ix::BIGINT AS chunk_index, {_TOK.format("content")} AS token_estimate FROM x"""

_T_MARK = "chr(10) || '[表格]' || chr(10)"
_TABLES_IMAGES = f"""WITH RECURSIVE {_LINES}, wd AS (SELECT *, ord % 5 = 3 AS tbl, list_filter([string_split(text, ' ')[1:2], string_split(text, ' ')[3:4]], lambda x: len(x) > 0) AS rw FROM el),
    md AS (SELECT doc_id, ord, tbl, text AS raw, CASE WHEN tbl AND text <> '' THEN array_to_string(rw[1], ' | ') || CASE WHEN len(rw) > 1 THEN chr(10) || array_to_string(list_transform(rw[1], lambda x: '---'), ' | ') || chr(10) || array_to_string(rw[2], ' | ') ELSE '' END ELSE text END AS text FROM wd),
    an AS (SELECT *, NOT tbl AND raw <> '' AND length(raw) < 40 AS hd, sum((NOT tbl AND raw <> '' AND length(raw) < 40)::INT) OVER w AS sec, sum((ord % 7 = 6)::INT) OVER w + 1 AS page, sum((NOT tbl)::INT) OVER w - 1 AS para
        FROM md WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    im AS (SELECT doc_id, sec - hd::INT AS sec, '[' || string_agg('{{"image_ref":"rId' || ord || '","page_estimate":' || (ord + 1) || ',"mode":"metadata_only"}}', ',' ORDER BY ord) || ']' AS images FROM an WHERE ord % 4 = 2 GROUP BY ALL),
    own AS (SELECT doc_id, sec, max(raw) FILTER (hd) AS title, max(page) FILTER (hd) AS page_at, max(para) FILTER (hd) AS para_at, max(page) AS last_page, max(para) AS last_para,
        coalesce(list(text ORDER BY ord) FILTER (NOT hd AND NOT tbl AND text <> ''), []) AS paras, coalesce(list({_T_MARK} || text ORDER BY ord) FILTER (tbl AND text <> ''), []) AS tbls FROM an GROUP BY doc_id, sec),
    nx AS (SELECT *, coalesce(lead(page_at) OVER w, last_page) AS page_end, coalesce(lead(para_at) OVER w - 1, last_para) AS para_end FROM own WINDOW w AS (PARTITION BY doc_id ORDER BY sec)),
    s AS (SELECT nx.doc_id, row_number() OVER (PARTITION BY nx.doc_id ORDER BY nx.sec) - 1 AS section, title, paras, paras || tbls AS parts, coalesce(page_at, 1) AS page_start, page_end, coalesce(para_at, 0) AS para_start, para_end, coalesce(images, '[]') AS images
        FROM nx LEFT JOIN im ON im.doc_id = nx.doc_id AND im.sec = nx.sec WHERE len(paras) + len(tbls) > 0),
    ft AS (SELECT *, array_to_string(parts, chr(10)) AS whole, coalesce(title, CASE WHEN section = 0 THEN list_filter(paras, lambda p: length(p) BETWEEN 2 AND 80)[1] END, '(document start)') AS heading FROM s),
    fz AS (SELECT *, {_TOK.format("whole")} <= {MAX_TOKENS} AS fits FROM ft),
    p AS (SELECT doc_id, section, n, x AS text, {_TOK.format("x")} AS t FROM (SELECT doc_id, section, unnest(parts) AS x, unnest(range(1, len(parts) + 1)) AS n FROM fz WHERE NOT fits)),
    r AS (SELECT doc_id, section, n, t AS lt, t AS ct, 0 AS k, FALSE AS carry FROM p WHERE n = 1 UNION ALL
        SELECT p.doc_id, p.section, p.n, p.t, CASE WHEN r.ct + p.t > {MAX_TOKENS} AND r.lt <= {OVERLAP} THEN r.lt + p.t WHEN r.ct + p.t > {MAX_TOKENS} THEN p.t ELSE r.ct + p.t END, r.k + (r.ct + p.t > {MAX_TOKENS})::INT,
            r.ct + p.t > {MAX_TOKENS} AND r.lt <= {OVERLAP} FROM r JOIN p ON p.doc_id = r.doc_id AND p.section = r.section AND p.n = r.n + 1),
    m AS (SELECT doc_id, section, k, n FROM r UNION ALL SELECT doc_id, section, k, n - 1 FROM r WHERE carry),
    c AS (SELECT m.doc_id, m.section, m.k, string_agg(p.text, chr(10) ORDER BY m.n) AS content, (m.k + 1)::VARCHAR AS part FROM m JOIN p USING (doc_id, section, n) GROUP BY m.doc_id, m.section, m.k
        UNION ALL SELECT doc_id, section, 0, whole, NULL FROM fz WHERE fits),
    x AS (SELECT c.*, z.heading, z.page_start, z.page_end, z.para_start, z.para_end, z.images, max(c.k) OVER (PARTITION BY c.doc_id, c.section) AS last_k, row_number() OVER (PARTITION BY c.doc_id ORDER BY c.section, c.k) - 1 AS ix FROM c JOIN fz z USING (doc_id, section))
    SELECT doc_id, ix::BIGINT AS chunk_index, 'heading: ' || heading || ', p.' || page_start || CASE WHEN page_end <> page_start THEN '-' || page_end ELSE '' END || ', para ' || para_start || '-' || para_end || coalesce(', part ' || part, '') AS source_position,
        md5(content) AS content_md5, CASE WHEN part IS NULL OR (k = 0 AND last_k > 0) THEN images ELSE '[]' END AS image_refs FROM x"""

_HTML = r"""WITH b AS (SELECT page_id, regexp_replace(replace(coalesce(html, ''), chr(1), ' '), '(?is)<script\b.*?</script>|<style\b.*?</style>', '', 'g') AS h FROM pages),
    k AS (SELECT page_id, string_split(regexp_replace(h, '(?i)<((?:h[1-6]|p|li)(?:\s[^>]*)?>)', chr(1) || '\1', 'g'), chr(1)) AS bs FROM b),
    e AS (SELECT page_id, unnest(bs[2:]) AS x, unnest(range(len(bs[2:]))) AS ord FROM k),
    t AS (SELECT page_id, ord, lower(regexp_extract(x, '^(\w+)', 1)) AS tag, regexp_replace(regexp_replace(regexp_replace(x, '^[^>]*>', ''), '(?is)</(?:h[1-6]|p|li)>.*$', ''), '(?s)<[^>]*>', '', 'g') AS y FROM e),
    u AS (SELECT page_id, ord, tag, regexp_replace(regexp_replace(replace(replace(replace(replace(replace(y, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS text FROM t),
    a AS (SELECT *, tag IN ('h1', 'h2', 'h3', 'h4') AND text <> '' AS hd, sum((tag IN ('h1', 'h2', 'h3', 'h4') AND text <> '')::INT) OVER (PARTITION BY page_id ORDER BY ord) AS sec FROM u),
    o AS (SELECT page_id, sec, max(text) FILTER (hd) AS title, coalesce(list(text ORDER BY ord) FILTER (NOT hd AND text <> ''), []) AS paras FROM a GROUP BY page_id, sec),
    s AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY sec) - 1 AS section FROM o WHERE len(paras) > 0)
    SELECT page_id, section::BIGINT AS section, coalesce(title, CASE WHEN section = 0 THEN list_filter(paras, lambda p: length(p) BETWEEN 2 AND 80)[1] END, '(document start)') AS heading, array_to_string(paras, chr(10)) AS body FROM s"""

_ALL_ENTITIES = _T + """, g AS (SELECT * FROM t WHERE length(text) % 7 <> 0),
    sv AS (SELECT conv_id, turn, cid, v, lower(v) AS fold FROM (SELECT *, regexp_extract(text, '[A-Za-z]+') AS v FROM g) WHERE v <> ''),
    sg AS (SELECT conv_id, fold, arg_min(v, turn) AS v, min(turn) AS first, '["' || string_agg(cid, '","' ORDER BY turn) || '"]' AS src FROM sv GROUP BY conv_id, fold),
    seen AS (SELECT conv_id, '[' || string_agg('{"value":"' || v || '","source_chunk_ids":' || src || '}', ',' ORDER BY first) || ']' AS seen FROM sg GROUP BY conv_id),
    st AS (SELECT conv_id, turn, cid, unnest(string_split(text, '.')) AS s, unnest(range(len(string_split(text, '.')))) AS pos FROM g),
    i AS (SELECT conv_id, turn, cid, pos, regexp_extract(s, '[A-Za-z]{2,}') AS name, (length(s) % 3)::VARCHAR || ' wide' AS width, regexp_extract_all(s, '[a-z]{6,}') AS words FROM st),
    k AS (SELECT *, CASE WHEN name = '' THEN turn || '/' || pos ELSE lower(name) END AS akey, row_number() OVER (PARTITION BY conv_id, CASE WHEN name = '' THEN turn || '/' || pos ELSE lower(name) END ORDER BY turn, pos) AS rk FROM i),
    e AS (SELECT conv_id, akey, arg_min(name, (turn, pos)) AS name, arg_min(width, (turn, pos)) AS width, min((turn, pos)) AS first, '["' || string_agg(cid, '","' ORDER BY turn, pos) || '"]' AS src FROM k GROUP BY conv_id, akey),
    cf AS (SELECT k.conv_id, k.akey, '[' || string_agg('{"field":"width","value":"' || k.width || '","chunk_id":"' || k.cid || '"}', ',' ORDER BY turn, pos) || ']' AS conflicts FROM k JOIN e USING (conv_id, akey) WHERE k.width <> e.width GROUP BY k.conv_id, k.akey),
    wa AS (SELECT conv_id, akey, turn, pos, rk, unnest(words) AS w, unnest(range(len(words))) AS p FROM k),
    wb AS (SELECT *, row_number() OVER (PARTITION BY conv_id, akey, w ORDER BY turn, pos, p) AS nth FROM wa),
    wl AS (SELECT conv_id, akey, '["' || string_agg(w, '","' ORDER BY turn, pos, p) || '"]' AS words FROM wb WHERE rk = 1 OR nth = 1 GROUP BY conv_id, akey),
    rooms AS (SELECT conv_id, '[' || string_agg('{"name":' || CASE WHEN name = '' THEN 'null' ELSE '"' || name || '"' END || ',"width":"' || width || '","height":null,"words":' || coalesce(words, '[]') || ',"source_chunk_ids":' || src || ',"conflicts":' || coalesce(conflicts, '[]') || '}', ',' ORDER BY first) || ']' AS rooms
        FROM e LEFT JOIN cf USING (conv_id, akey) LEFT JOIN wl USING (conv_id, akey) GROUP BY conv_id),
    n AS (SELECT conv_id, count(*) FILTER (length(text) % 7 <> 0) AS good, count(*) FILTER (length(text) % 7 = 0) AS bad FROM t GROUP BY conv_id)
    SELECT conv_id, '{"title":null,"words":[],"missing":null,"seen":' || coalesce(seen, '[]') || ',"rooms":' || coalesce(rooms, '[]') || ',"_provenance":{},"_stats":{"chunks_merged":' || good || ',"chunks_failed":' || bad
        || CASE WHEN good > 0 THEN ',"confidence_min":0.5,"confidence_avg":0.5}}' ELSE ',"confidence_min":null,"confidence_avg":null}}' END AS all_info FROM n LEFT JOIN seen USING (conv_id) LEFT JOIN rooms USING (conv_id)"""

_REPLY = """rp AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN ' ```json' || chr(10) || b || chr(10) || '```' WHEN 1 THEN '```' || chr(10) || b || chr(10) || '```' || chr(10) || 'after' ELSE b END AS reply, b
    FROM (SELECT *, '{"t": "' || regexp_replace(text, '["\\\\]', '', 'g') || '", "n": [1, 2, ],' || chr(10) || '}' AS b FROM t))"""

QUERIES = {
    f.__name__: f
    for f in (
        token_estimate, chunk_id_hash, position_string, page_running_count, paragraph_ranges, section_by_heading, preamble_heading, html_sections, identity_fold, tables_and_images, pack_chunks, pack_chunks_overlap, document_chunks, full_text, head_chunks, table_markdown,
        strip_code_fence, clean_json, render_prompt, extract_envelope, route_structured, route_fallback, fallback_block, group_by_source, merge_list_union, merge_list_provenance, merge_first_non_null, merge_scalar_provenance, merge_collect,
        merge_entities, entity_conflicts, entity_anonymous, entity_nested_list, merge_stats, run_summary, all_info, all_info_entities,
    )
}

ORACLE_SQL = {
    "token_estimate": f"SELECT doc_id, {_TOK.format('text')} AS tokens FROM documents",
    "chunk_id_hash": "SELECT doc_id, substr(md5(source || '.' || lang || '.docx'), 1, 8) || '_' || doc_id AS chunk_id, source || '.' || lang || '.docx' AS base, source || '.' || lang AS stem FROM documents",
    "position_string": """SELECT doc_id, 'heading: ' || source || ', p.' || (n_chars % 3 + 1) || CASE WHEN doc_id % 2 = 1 THEN '-' || (n_chars % 3 + 2) ELSE '' END || ', para ' || (doc_id % 10) || '-' || (doc_id % 10 + 4)
        || CASE WHEN doc_id % 2 = 0 THEN ', part ' || (doc_id % 4 + 1) ELSE '' END AS position FROM documents""",
    "page_running_count": f"WITH {_ANNOTATED} SELECT doc_id, ord::BIGINT AS ord, page::BIGINT AS page, para::BIGINT AS para, sec::BIGINT AS section FROM an",
    "paragraph_ranges": f"WITH {_SECTIONS} SELECT doc_id, section::BIGINT AS section, page_start::BIGINT AS page_start, page_end::BIGINT AS page_end, para_start::BIGINT AS para_start, para_end::BIGINT AS para_end FROM s",
    "section_by_heading": f"WITH {_SECTIONS} SELECT doc_id, section::BIGINT AS section, heading, len(paras)::BIGINT AS n_paragraphs, md5(array_to_string(paras, chr(10))) AS body_md5 FROM s",
    "preamble_heading": f"WITH {_SECTIONS} SELECT doc_id, heading FROM s WHERE section = 0",
    "html_sections": _HTML,
    "identity_fold": "SELECT doc_id, md5(regexp_replace(replace(lower(nfc_normalize(coalesce(text, ''))), 'ß', 'ss'), '\\s+', '', 'g')) AS fold_md5 FROM documents",
    "tables_and_images": _TABLES_IMAGES,
    "pack_chunks": _pack_sql(0),
    "pack_chunks_overlap": _pack_sql(OVERLAP),
    "document_chunks": _DOC_CHUNKS,
    "full_text": "SELECT conv_id, md5(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn)) AS text_md5, length(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn)) AS n_chars FROM conversations GROUP BY conv_id",
    "head_chunks": "SELECT conv_id, turn, role FROM conversations WHERE turn < 2",
    "table_markdown": f"""WITH {_T}, r AS (SELECT conv_id, turn, list_transform(list_filter([w[1:3], w[4:6], w[7:9]], lambda x: len(x) > 0), lambda x: array_to_string(x, ' | ')) AS l FROM (SELECT *, string_split(text, ' ') AS w FROM t))
        SELECT conv_id, turn, array_to_string(CASE WHEN len(l) > 1 THEN l[1:1] || [array_to_string(list_transform(string_split(l[1], ' | '), lambda x: '---'), ' | ')] || l[2:] ELSE l END, chr(10)) AS markdown FROM r""",
    "strip_code_fence": f"""WITH {_T}, {_REPLY} SELECT conv_id, turn, md5(CASE turn % 3 WHEN 0 THEN b WHEN 1 THEN b || chr(10) || 'after' ELSE regexp_replace(b, '^\\s+|\\s+$', '', 'g') END) AS inner_md5 FROM rp""",
    "clean_json": f"""WITH {_T}, {_REPLY} SELECT conv_id, turn, md5(regexp_replace(regexp_replace(reply || chr(1) || chr(11), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', ' ', 'g'), ',\\s*([}}\\]])', '\\1', 'g')) AS clean_md5 FROM rp""",
    "render_prompt": f"WITH {_T} SELECT conv_id, turn, md5('## ' || role || chr(10) || '### ' || cid || chr(10) || text || chr(10) || '- title: a title' || chr(10) || '{{json}}') AS prompt_md5 FROM t".replace("{{", "{").replace("}}", "}"),
    "extract_envelope": f"""WITH {_ENV} SELECT cid AS chunk_id, source_file, 'turn' AS source_section, 'turn ' || turn AS source_position, ok AS is_structured, CASE WHEN ok THEN reply END AS extraction_result, 'direct_prompt' AS extraction_method,
        'metadata_only' AS extraction_mode, 'rule' AS model_name, 'local' AS model_endpoint, CASE WHEN ok THEN length(text) % 10 / 10.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence_score, CASE WHEN ok THEN 't' ELSE '' END AS thinking_content,
        '1' AS schema_version, '1' AS prompt_version, 'pending' AS validation_status, CASE WHEN NOT ok THEN err END AS parse_error, CASE WHEN NOT ok THEN 'not json' END AS raw_response, CASE WHEN ok THEN length(text) % 10 / 10.0::DOUBLE END AS stated_confidence, (turn + 1)::BIGINT AS source_page,
        md5(CASE WHEN ok THEN '' ELSE {_FALLBACK} END) AS fallback_md5 FROM v""",
    "route_structured": f"WITH {_ENV} SELECT cid AS chunk_id, reply AS extraction_result FROM v WHERE ok",
    "route_fallback": f"WITH {_ENV} SELECT cid AS chunk_id, err AS parse_error FROM v WHERE NOT ok",
    "fallback_block": f"""WITH {_ENV} SELECT source_file, turn, md5(repeat('=', 60) || chr(10) || 'CHUNK: ' || cid || chr(10) || 'SOURCE: ' || source_file || ', Page ' || (turn + 1) || chr(10) || 'SECTION: turn' || chr(10)
        || 'EXTRACTED AT: 2000-01-01T00:00:00+00:00' || chr(10) || repeat('-', 60) || chr(10) || {_FALLBACK} || chr(10) || repeat('=', 60)) AS block_md5 FROM v WHERE NOT ok""",
    "group_by_source": f"WITH {_ENV} SELECT source_file, count(*) AS results, min(cid) AS first_chunk FROM v WHERE ok GROUP BY source_file",
    "merge_list_union": f"WITH {_LIST} SELECT conv_id, value, row_number() OVER (PARTITION BY conv_id ORDER BY min((turn, pos))) AS place FROM w GROUP BY conv_id, value",
    "merge_list_provenance": f"WITH {_LIST} SELECT conv_id, value, string_agg(cid, ',' ORDER BY turn, pos) AS chunks FROM w GROUP BY conv_id, value",
    "merge_first_non_null": f"WITH {_SCALAR} SELECT conv_id, arg_min(value, first) AS value FROM g GROUP BY conv_id",
    "merge_scalar_provenance": f"WITH {_SCALAR} SELECT conv_id, arg_min(chunks, first) AS chunks FROM g GROUP BY conv_id",
    "merge_collect": f"WITH {_SCALAR} SELECT conv_id, value, chunks FROM g",
    "merge_entities": f"""WITH {_ITEMS} SELECT conv_id, arg_min(name, (turn, pos)) AS name, arg_min(width, (turn, pos)) AS width, arg_min(height, (turn, pos)) FILTER (height IS NOT NULL) AS height,
        string_agg(cid, ',' ORDER BY turn, pos) AS chunks FROM k WHERE NOT anon GROUP BY conv_id, akey""",
    "entity_conflicts": f"""WITH {_ITEMS}, n AS (SELECT conv_id, akey, turn, pos, cid, 'width' AS field, width AS value FROM k UNION ALL SELECT conv_id, akey, turn, pos, cid, 'height', height FROM k WHERE height IS NOT NULL),
        h AS (SELECT *, first_value(value) OVER (PARTITION BY conv_id, akey, field ORDER BY turn, pos) AS head FROM n) SELECT conv_id, akey, field, value, cid AS chunk_id, pos::BIGINT AS pos FROM h WHERE value <> head""",
    "entity_anonymous": f"WITH {_ITEMS} SELECT conv_id, turn::BIGINT AS turn, pos::BIGINT AS pos, cid AS chunks FROM k WHERE anon",
    "entity_nested_list": f"""WITH {_ITEMS}, r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, akey ORDER BY turn, pos) AS rk FROM k WHERE NOT anon),
        a AS (SELECT conv_id, akey, turn, pos, rk, unnest(words) AS w, unnest(range(len(words))) AS p FROM r),
        b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, akey, w ORDER BY turn, pos, p) AS seen FROM a)
        SELECT r.conv_id, r.akey, coalesce(any_value(x.items), '') AS items FROM (SELECT DISTINCT conv_id, akey FROM r) r LEFT JOIN
        (SELECT conv_id, akey, string_agg(w, ',' ORDER BY turn, pos, p) AS items FROM b WHERE rk = 1 OR seen = 1 GROUP BY conv_id, akey) x USING (conv_id, akey) GROUP BY r.conv_id, r.akey""",
    "merge_stats": f"""WITH {_T} SELECT conv_id, count(*) FILTER (length(text) % 4 <> 0) AS chunks_merged, count(*) FILTER (length(text) % 4 = 0) AS chunks_failed,
        min(length(text) % 8 / 8.0::DOUBLE) FILTER (length(text) % 4 <> 0 AND length(text) % 3 <> 0) AS confidence_min, avg(length(text) % 8 / 8.0::DOUBLE) FILTER (length(text) % 4 <> 0 AND length(text) % 3 <> 0) AS confidence_avg FROM t GROUP BY conv_id""",
    "run_summary": f"""WITH {_T} SELECT count(*) FILTER (length(text) % 4 <> 0) AS succeeded, count(*) AS chunks, avg(CASE WHEN length(text) % 3 <> 0 THEN length(text) % 8 / 8.0::DOUBLE ELSE 0 END) FILTER (length(text) % 4 <> 0) AS mean_confidence,
        avg(length(text) * 3) AS mean_latency_ms FROM t""",
    "all_info": f"""WITH {_LIST}, lw AS (SELECT conv_id, value, min((turn, pos)) AS first, '"' || value || '":["' || string_agg(cid, '","' ORDER BY turn, pos) || '"]' AS src FROM w GROUP BY conv_id, value),
        l AS (SELECT conv_id, '["' || string_agg(value, '","' ORDER BY first) || '"]' AS vals, '{{' || string_agg(src, ',' ORDER BY first) || '}}' AS prov FROM lw GROUP BY conv_id),
        c AS (SELECT conv_id, turn, cid, value, lower(value) AS fold FROM (SELECT *, regexp_extract(text, '[A-Za-z]+') AS value FROM t WHERE length(text) % 2 = 0) WHERE value <> ''),
        g AS (SELECT conv_id, fold, arg_min(value, turn) AS value, min(turn) AS first, '["' || string_agg(cid, '","' ORDER BY turn) || '"]' AS src FROM c GROUP BY conv_id, fold),
        f AS (SELECT conv_id, arg_min(value, first) AS value, arg_min(src, first) AS src FROM g GROUP BY conv_id),
        n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)
        SELECT conv_id, '{{"title":' || coalesce('"' || f.value || '"', 'null') || ',"words":' || coalesce(l.vals, '[]') || ',"missing":null,"_provenance":{{' || array_to_string(list_filter(['"title":' || f.src, '"words":' || l.prov], lambda x: x IS NOT NULL), ',')
        || '}},"_stats":{{"chunks_merged":' || n.n || ',"chunks_failed":0,"confidence_min":null,"confidence_avg":null}}}}' AS all_info FROM n LEFT JOIN l USING (conv_id) LEFT JOIN f USING (conv_id)""",
    "all_info_entities": f"WITH {_ALL_ENTITIES}",
}
