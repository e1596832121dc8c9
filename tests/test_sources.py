import io
import json
import re
import threading
import urllib.error
import urllib.request
import zipfile

import pytest
import yaml
from pyspark.sql import functions as F

from tessera.functions import schema as C
from tessera.operators import extract as E
from tessera.plans import pipeline as P
from tessera.plans import service
from tessera.runtime import Scratch
from tessera.sources import docx, sinks, tables

NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
STYLES = f'<w:styles {NS}><w:style w:type="paragraph" w:default="1" w:styleId="N"><w:name w:val="Normal"/></w:style><w:style w:type="paragraph" w:styleId="H1"><w:name w:val="heading 1"/></w:style><w:style w:type="paragraph" w:styleId="H5"><w:name w:val="heading 5"/></w:style></w:styles>'


def para(text, style="", extra=""):
    props = f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else ""
    return f"<w:p>{props}<w:r><w:t>{text}</w:t>{extra}</w:r></w:p>"


def table(rows):
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{para(c)}</w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"


def document(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/styles.xml", STYLES)
        z.writestr("word/document.xml", f"<w:document {NS}><w:body>{body}<w:sectPr/></w:body></w:document>")
    return out.getvalue()


BREAK = '<w:br w:type="page"/>'
IMAGE = '<w:drawing><a:blip r:embed="rId7"/></w:drawing>'
SAMPLE = document(
    para("Plan of the house") + para("Opening words") + para("Methods", "H1", IMAGE) + para("measured", extra=BREAK) + table([["室名", "寬度 (m)"], ["R-7", "340"]]) + para("Minor", "H5") + para("Results", "H1") + para("a b", extra="<w:tab/><w:t>c</w:t>") + para("Empty", "H1")
)


def test_docx(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep/r.docx").write_bytes(SAMPLE)
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    got = docx.read_chunks(spark, str(tmp_path)).orderBy("chunk_index").collect()
    assert [(r.source_section, r.content, r.source_page, r.source_page_end) for r in got] == [
        ("Plan of the house", "Plan of the house\nOpening words", 1, 1),
        ("Methods", "measured\nMinor\n\n[表格]\n室名 | 寬度 (m)\n--- | ---\nR-7 | 340", 1, 2),
        ("Results", "a b\tc", 2, 2),
    ]
    assert json.loads(got[0].image_refs) == [{"image_ref": "rId7", "page_estimate": 1, "mode": "metadata_only"}]
    assert got[0].source_file == "r.docx" and got[2].source_position == "heading: Results, p.2, para 5-6"
    assert docx.chunk_bytes(spark, [("n.docx", SAMPLE)], 5, 0).count() > 3
    files = spark.createDataFrame([("e", b""), ("big", SAMPLE), ("x", b"1")], "path string, content binary")
    errors = {r.doc: r.error for r in docx.parse_files(files, max_bytes=100).collect()}
    assert errors["e"] == "empty body" and "larger" in errors["big"] and "BadZip" in errors["x"]
    spark.dataSource.register(docx.DocxDataSource)
    assert spark.read.format("docx").load(str(tmp_path / "deep")).count() == 9
    with pytest.raises(ValueError):
        docx.parse_files(files, "other")


def test_docx_of_any_size(spark, tmp_path, capsys):
    big = io.BytesIO(SAMPLE)
    with zipfile.ZipFile(big, "a") as z:
        z.writestr("word/media/image1.png", bytes(65 << 20))
    (tmp_path / "big.docx").write_bytes(big.getvalue())
    assert len(big.getvalue()) > 64 << 20
    assert docx.read_elements(spark, str(tmp_path)).count() == 9 and docx.read_chunks(spark, str(tmp_path)).count() == 3
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    assert P.docx_source(spark, {"file_path": str(tmp_path)}).count() == 3
    told = capsys.readouterr().err
    assert "bad.docx" in told and "BadZip" in told and "big.docx" not in told


def test_html_and_text(spark):
    page = "<html><script>var t='<p>no</p>'</script><h1>Top &amp; more</h1><p class=x>one <b>two</b></p><ul><li>item</li></ul><h2>Next</h2><p>&lt;x&gt;</p>"
    e = tables.html_elements(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), F.col("id"), "html").orderBy("ord").collect()
    assert [(r.text, r.style_heading) for r in e] == [("Top & more", True), ("one two", False), ("item", False), ("Next", True), ("<x>", False)]
    loose = "lead<p>open <i>one</i><P CLASS='a'>two</p> between <li>three<h3>Four</h3></li><pre>no</pre>" + "<p>x " * 20_000
    e = tables.html_elements(spark.createDataFrame([(1, loose)], "id int, html string"), F.col("id"), "html").orderBy("ord").collect()
    assert [(r.text, r.style_heading) for r in e[:5]] == [("open one", False), ("two", False), ("three", False), ("Four", True), ("x", False)] and len(e) == 20_004
    with pytest.raises(ValueError):
        tables.read(spark, "xls", "x")


CONFIG = {
    "engine": {
        "llm": {"endpoint": "${NO_SUCH_ENDPOINT:http://127.0.0.1:9}", "model": "m", "timeout": 1, "max_retries": 0, "parameters": {"temperature": 0.1, "top_k": 4, "top_p": None, "odd": 1}},
        "extraction": {"core": True, "genre": "house", "schema_version": "2"},
        "prompts": {"version": "3", "system": "base \n", "user_template": "{source_file}|{source_section}|{content}|{extraction_instructions}|{json_schema}|{{x}}"},
        "schemas": {"core": {"fields": [{"name": "title", "description": "名稱"}, {"name": "confidence_score", "type": "float", "constraints": {"ge": 0, "le": 1, "default": 0.0}}]}},
    }
}
GENRE = {"system_prompt_suffix": "more\n", "fields": [{"name": "rooms", "type": "list[object]", "identity": "name", "description": "d", "fields": [{"name": "name", "type": "str", "description": "n"}, {"name": "width"}]}, {"name": "colours", "type": "list[str]"}]}


@pytest.fixture
def config_file(tmp_path):
    (tmp_path / "genres").mkdir()
    (tmp_path / "genres/house.yaml").write_text(yaml.safe_dump(GENRE, allow_unicode=True))
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(CONFIG, allow_unicode=True))
    return str(tmp_path / "c.yaml")


def test_config_and_schema(spark, config_file):
    c = P.load_config(config_file, "engine")
    assert c["llm"]["endpoint"] == "http://127.0.0.1:9"
    s = C.Schemas(c)
    js = s.json_schema(True, "house")
    assert js["properties"]["title"]["type"] == ["string", "null"] and js["required"] == ["confidence_score"]
    assert js["properties"]["confidence_score"]["maximum"] == 1 and js["properties"]["rooms"]["items"]["required"] == ["name"]
    text = s.instructions(True, "house")
    assert text.startswith("### Core（必填）\n- title: 名稱") and "### House Genre（house領域）" in text and "（每筆包含：name、width）" in text
    assert C.struct_type(s.combined(True, "house")).simpleString() == "struct<title:string,confidence_score:double,rooms:array<struct<name:string,width:string>>,colours:array<string>>"
    assert P.load_config(config_file, "engine", "none")["extraction"]["genre"] == "none"
    filled = P.substitute({"a": ["${X:1}", "${Y}", 3], "b": "${Z:}|$|${X:}${W:a:b c}|${", "c": {"d": "${-:1}"}}, {"X": "2"})
    assert filled == {"a": ["2", "${Y}", 3], "b": "|$|2a:b c|${", "c": {"d": "${-:1}"}}
    for bad in ("../x", "a b"):
        with pytest.raises(ValueError):
            P.load_config(config_file, "engine", bad)
    with pytest.raises(FileNotFoundError):
        P.load_config(config_file + "x", "engine")
    with pytest.raises(ValueError):
        C.parse_field({"name": "x", "type": "date"})
    with pytest.raises(ValueError):
        C.Schemas({"schemas": {"core": {"fields": [{"name": "a"}]}, "genres": {"g": {"fields": [{"name": "a"}]}}}}).combined(True, "g")
    df = spark.createDataFrame([((None, 2.0),), (("t", 0.5),)], "v struct<title:string,confidence_score:double>")
    assert [r[0] for r in df.select(C.violations(F.col("v"), s.fields("core"))).collect()] == [["confidence_score"], []]
    assert C.chunk_table({"chunk_id": "str", "n": "int"}).simpleString() == "struct<chunk_id:string,n:bigint>"


def test_prompts(spark, config_file):
    p = E.Prompts(P.load_config(config_file, "engine"))
    assert p.system == "base\nmore"
    chunk = {"source_file": "f", "source_section": "s", "content": "{content} {x}"}
    user = p.user(chunk)
    assert user.startswith("f|s|{content} {x}|### Core") and user.endswith("|{x}")
    df = spark.createDataFrame([("f", "s", "{content} {x}")], "source_file string, source_section string, content string")
    assert df.select(p.user_column()).first()[0] == user
    with pytest.raises(KeyError):
        E.split_template("{nope}", {})
    body = P.provider_of(P.load_config(config_file, "engine")).body("s", "u", {"type": "json_object"})
    assert body["temperature"] == 0.1 and body["top_k"] == 4 and "top_p" not in body and "odd" not in body and body["response_format"]


def rule(user):
    content = user.split("|")[2]
    if "measured" in content:
        raise RuntimeError("down")
    return "broken" if "a b" in content else json.dumps({"title": "T", "confidence_score": 0.5, "rooms": [{"name": "R-7"}], "colours": ["r"]})


def test_pipeline_and_sinks(spark, config_file, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/r.docx").write_bytes(SAMPLE)
    config = P.load_config(config_file, "engine")
    results, merged = P.extract_documents(spark, docx.read_elements(spark, str(tmp_path / "in")), config, E.RuleProvider(rule))
    rows = {r.chunk_index: r for r in results.collect()}
    assert [rows[n].is_structured for n in range(3)] == [True, False, False]
    assert rows[1].fallback_text.startswith("EXTRACTION ERROR: down\n\nORIGINAL CONTENT:\nmeasured") and rows[2].fallback_text.startswith("LLM response not valid JSON: Expecting value")
    info = json.loads(merged.first().all_info)
    assert info["title"] == "T" and info["rooms"][0]["source_chunk_ids"] == [rows[0].chunk_id] and info["_stats"] == {"chunks_merged": 1, "chunks_failed": 2, "confidence_min": 0.5, "confidence_avg": 0.5}
    out = P.run_pipeline(
        spark,
        {
            "sources": [{"name": "s", "module": "tessera.plans.pipeline.docx_source", "file_path": str(tmp_path / "in")}],
            "transform": {"module": "tessera.plans.pipeline.model_transform", "config": config, "provider": E.RuleProvider(rule)},
            "sinks": [{"name": "json_output", "module": "tessera.plans.pipeline.json_sink", "output_dir": str(tmp_path / "js")}, {"name": "txt_fallback", "module": "tessera.plans.pipeline.fallback_sink", "output_dir": str(tmp_path / "tx")}],
        },
    )
    assert set(out) == {"json_output", "txt_fallback"}
    files = list((tmp_path / "js").iterdir())
    assert len(files) == 1 and re.fullmatch(r"r_[0-9a-f]{8}_\d{8}_\d{6}\.json", files[0].name)
    text = files[0].read_text()
    assert json.loads(text)[0]["validation_status"] == "pending" and text.startswith('[\n  {\n    "chunk_id": ')
    assert "stated_confidence" not in text
    sinks.write_documents(merged, str(tmp_path / "docs"))
    written = [json.loads(p.read_text()) for p in (tmp_path / "docs").iterdir()]
    assert written == [info]
    sinks.write_json(results.where("not is_structured"), str(tmp_path / "nothing"))
    assert not (tmp_path / "nothing").exists()
    blocks = "\n".join(p.read_text() for p in sorted((tmp_path / "tx").rglob("part-*.txt")))
    assert blocks.count("=" * 60) == 4 and "SOURCE: r.docx, Page 1" in blocks
    assert sinks.write_fallback(results.where("is_structured"), str(tmp_path / "none")) is None
    with pytest.raises(ValueError):
        P.docx_source(spark, {"name": "s"})
    with pytest.raises(ValueError, match="strategy"):
        P.docx_source(spark, {"file_path": str(tmp_path / "in"), "chunking": {"strategy": "pages"}})
    assert P.docx_source(spark, {"file_path": str(tmp_path / "in"), "chunking": {"strategy": "heading"}}).count() == 3


def test_plug_in_options():
    for part, module, lacking in (("sources", "docx_source", "file_path"), ("sinks", "json_sink", "output_dir"), ("transform", "model_transform", "config")):
        with pytest.raises(ValueError, match=lacking):
            P.load(f"tessera.plans.pipeline.{module}", {"name": "x"})
    assert P.with_defaults(P.docx_source, {"file_path": "f"}) == {"image_mode": "metadata_only", "file_path": "f"}
    assert P.with_defaults(P.docx_source, {"image_mode": "other"})["image_mode"] == "other"
    assert P.load("json.dumps", {}) is json.dumps


def test_confidence_through_the_merge(spark, config_file):
    """Only the top-level number counts: nested, quoted, boolean and missing ones as the reply states them."""
    replies = ['{"rooms": [{"name": "a", "confidence_score": "high"}], "confidence_score": 0.9}', '{"confidence_score": "0.1"}', '{"confidence_score": true}', '{"confidence_score": NaN, "title": "t"}', '{"title": "confidence_score\\": \\"0.2"}', '{"confidence_score": 0}']
    rows = [(f"d{n}", f"d{n}_0", f"d{n}", 1, "s", "p", 0, r) for n, r in enumerate(replies)]
    chunks = spark.createDataFrame(rows, "doc string, chunk_id string, source_file string, source_page int, source_section string, source_position string, chunk_index int, content string")
    config = P.load_config(config_file, "engine") | {"prompts": {"user_template": "{content}"}}
    results = E.extract(chunks, E.RuleProvider(lambda user: user), E.Prompts(config))
    got = {r.doc: json.loads(r.all_info)["_stats"]["confidence_min"] for r in P.merge_results(results, config, Scratch(spark, "t")).collect()}
    assert got == {"d0": 0.9, "d1": None, "d2": 1.0, "d3": None, "d4": None, "d5": 0.0}


def test_only_what_may_pass_is_asked_again(monkeypatch):
    asked = []

    def refuse(code):
        def urlopen(request, timeout):
            asked.append(code)
            raise urllib.error.HTTPError("u", code, "no", None, None) if code else urllib.error.URLError("down")

        return urlopen

    monkeypatch.setattr(E.time, "sleep", lambda s: None)
    for code, times in ((400, 1), (401, 1), (404, 1), (429, 3), (503, 3), (408, 3), (0, 3)):
        asked.clear()
        monkeypatch.setattr(E.urllib.request, "urlopen", refuse(code))
        with pytest.raises(OSError):
            E.HttpProvider("http://x", "m", 1, 2).extract("s", "u")
        assert len(asked) == times, code


def test_drift(config_file, tmp_path, capsys):
    run = lambda *a: P.main(["sync", "--config", config_file, "--folder", str(tmp_path / "ddl"), *a])
    assert run("--check") == 1 and run() == 0 and run("--check") == 0
    f = tmp_path / "ddl/core.sql"
    f.write_text(f.read_text().replace("title", "titel"))
    assert run("--check") == 1
    assert "OUT OF SYNC" in capsys.readouterr().out


def test_service(spark, config_file):
    server = service.serve(spark, config_file, port=0, provider=E.RuleProvider(rule))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"
    ask = lambda path, data=None: json.load(urllib.request.urlopen(urllib.request.Request(base + path, data)))
    assert ask("/healthz") == {"status": "ok"}
    got = ask("/extract?parse_only=true", SAMPLE)
    assert got["structured_json"] == {"genre": "house", "chunks": [], "parse_only": True} and "measured" in got["full_text"]
    full = ask("/extract", SAMPLE)["structured_json"]
    assert [c["parse_error"] is None for c in full["chunks"]] == [True, False, False] and full["all_info"]["colours"] == ["r"]
    for data, status in ((b"", 400), (b"zip?", 422)):
        with pytest.raises(urllib.error.HTTPError) as e:
            ask("/extract", data)
        assert e.value.code == status
    server.shutdown()


def test_json_file_holds_objects(spark):
    """Every key of an envelope in its order, the extraction as the model wrote it, nulls too."""
    first = {"z": 1, "a": [0.10, None], "q": 'say "x" {y}'}
    names = [c for c in E._NAMES if c not in sinks.INTERNAL]
    rows = [{"doc": "d", "chunk_id": "d_1", "source_file": "r.docx", "chunk_index": 1, "is_structured": True, "extraction_result": json.dumps(first)}, {"doc": "d", "chunk_id": "d_0", "source_file": "r.docx", "chunk_index": 0, "is_structured": True}]
    got = sinks.by_source(spark.createDataFrame(rows, "doc string, " + E.ENVELOPE)).collect()
    results = json.loads(got[0].results)
    assert [r["chunk_id"] for r in results] == ["d_0", "d_1"] and [list(r) for r in results] == [names, names]
    assert results[1]["extraction_result"] == first and list(results[1]["extraction_result"]) == ["z", "a", "q"]
    assert results[0]["extraction_result"] is None


def test_word_file_of_hard_text(spark):
    from tessera.plan_queries import word_file

    text = "A & B <c>\r\n\n" + "long line " * 9 + "\n]]> \t tail"
    got = [(e["text"], e["style_heading"]) for e in docx.parse_elements(word_file(text))]
    assert got == [("A & B <c>", True), ("", False), (("long line " * 9).strip(), False), ("]]> \t tail", True)]
