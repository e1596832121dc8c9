"""Word documents as a distributed source: one row a file, parsed by the standard library.

``read_elements`` lists files through Spark's binaryFile reader, so any store Spark reads will do.
Rows whose bytes are no document come back with an error and no elements.
"""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.operators.sections import IMAGE, build_sections, chunk_sections, table_markdown
from tessera.runtime import Scratch, ship_package

#: Namespaces of the file format, and the styles that open a section.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
HEADINGS = ("heading 1", "heading 2", "heading 3", "heading 4")
MODES = ("metadata_only", "vision_llm")


def _styles(z: zipfile.ZipFile) -> tuple[dict[str, str], str]:
    """Style names by id, and the default paragraph style's id."""
    if "word/styles.xml" not in z.namelist():
        return {}, ""
    names, default = {}, ""
    for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{W}style"):
        name = s.find(f"{W}name")
        if s.get(f"{W}type") == "paragraph" and name is not None:
            names[s.get(f"{W}styleId")] = name.get(f"{W}val", "")
            if s.get(f"{W}default") in ("1", "true"):
                default = s.get(f"{W}styleId")
    return names, default


def paragraph_text(p: ElementTree.Element) -> str:
    """Text of a paragraph's runs, those in links included; tabs and breaks as characters."""
    out = []
    for child in p:
        runs = [child] if child.tag == f"{W}r" else child.findall(f"{W}r") if child.tag == f"{W}hyperlink" else []
        for r in runs:
            for x in r:
                if x.tag == f"{W}t":
                    out.append(x.text or "")
                elif x.tag == f"{W}tab":
                    out.append("\t")
                elif x.tag == f"{W}cr" or x.tag == f"{W}br" and x.get(f"{W}type", "textWrapping") == "textWrapping":
                    out.append("\n")
                elif x.tag == f"{W}noBreakHyphen":
                    out.append("-")
    return "".join(out).strip()


def table_cells(t: ElementTree.Element) -> list[list[str]]:
    """Rows of cells; a cell is its non-blank paragraphs with a space between. Nested rows are listed too."""
    return [[" ".join(x for x in map(paragraph_text, c.iter(f"{W}p")) if x) for c in r.iter(f"{W}tc")] for r in t.iter(f"{W}tr")]


def parse_elements(data: bytes, mode: str = "metadata_only") -> list[dict]:
    """Direct children of the body in order: paragraphs and tables."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names, default = _styles(z)
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body")
    out, page = [], 1
    for n, e in enumerate(() if body is None else body):
        if e.tag == f"{W}p":
            style = e.find(f"{W}pPr/{W}pStyle")
            name = names.get(style.get(f"{W}val") if style is not None else default, "")
            broken = any(b.get(f"{W}type") == "page" for b in e.iter(f"{W}br"))
            page += broken
            blips = [d.find(f".//{A}blip") for d in e.iter(f"{W}drawing")]
            images = [{"image_ref": b.get(f"{R}embed") or "unknown", "page_estimate": page, "mode": mode} for b in blips if b is not None]
            out.append({"ord": n, "kind": "p", "style_heading": name.lower() in HEADINGS, "text": paragraph_text(e), "cells": [], "page_break": broken, "images": images})
        elif e.tag == f"{W}tbl":
            out.append({"ord": n, "kind": "tbl", "style_heading": False, "text": "", "cells": table_cells(e), "page_break": False, "images": []})
    return out


ELEMENT = f"ord int, kind string, style_heading boolean, text string, cells array<array<string>>, page_break boolean, images {IMAGE}"
_ARROW = pa.struct([("ord", pa.int32()), ("kind", pa.string()), ("style_heading", pa.bool_()), ("text", pa.string()), ("cells", pa.list_(pa.list_(pa.string()))), ("page_break", pa.bool_()),
                    ("images", pa.list_(pa.struct([("image_ref", pa.string()), ("page_estimate", pa.int32()), ("mode", pa.string())])))])


def parse_files(files: DataFrame, mode: str = "metadata_only", max_bytes: int | None = None) -> DataFrame:
    """files(path, content) -> doc, error, elements (array); one Python pass, a file at a time, of any size unless max_bytes is set."""
    if mode not in MODES:
        raise ValueError(f"image_mode is one of {MODES}")
    ship_package(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1)):
                error, found = None, []
                data = data.as_py()
                if not data:
                    error = "empty body"
                elif max_bytes is not None and len(data) > max_bytes:
                    error = f"larger than {max_bytes} bytes"
                else:
                    try:
                        found = parse_elements(data, mode)
                    except Exception as e:  # noqa: BLE001  a broken file is a row with an error
                        error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([error], pa.string()), pa.array([found], pa.list_(_ARROW))], names=["doc", "error", "elements"])

    schema = "doc string, error string, elements array<struct<" + ELEMENT.replace(" ", ":").replace(",:", ",") + ">>"
    return files.select("path", "content").mapInArrow(run, schema)


def elements_of(parsed: DataFrame) -> DataFrame:
    e = parsed.where("error is null").select("doc", F.inline("elements"))
    return e.withColumn("text", F.when(F.col("kind") == "tbl", table_markdown(F.col("cells"))).otherwise(F.col("text"))).drop("cells")


def read_parsed(spark: SparkSession, path: str, mode: str = "metadata_only", max_bytes: int | None = None) -> DataFrame:
    """doc, error, elements of every .docx file under a path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "true").load(path)
    return parse_files(files, mode, max_bytes)


def read_reported(spark: SparkSession, path: str, mode: str = "metadata_only") -> DataFrame:
    """Elements as ``read_elements`` gives them; each file that could not be read is named on standard error."""
    parsed = Scratch(spark, "documents").keep(read_parsed(spark, path, mode), "parsed")
    for r in parsed.where("error is not null").select("doc", "error").toLocalIterator():
        print(f"NOT READ {r['doc']}: {r['error']}", file=sys.stderr)
    return elements_of(parsed)


def read_elements(spark: SparkSession, path: str, mode: str = "metadata_only", max_bytes: int | None = None) -> DataFrame:
    """Elements of every .docx file under a path; files with errors have none, ``read_parsed`` names them."""
    return elements_of(read_parsed(spark, path, mode, max_bytes))


def read_chunks(spark: SparkSession, path: str, max_tokens: int = 4000, overlap_tokens: int = 200, mode: str = "metadata_only") -> DataFrame:
    return chunk_sections(build_sections(read_elements(spark, path, mode)), max_tokens, overlap_tokens)


def chunk_bytes(spark: SparkSession, documents: list[tuple[str, bytes]], max_tokens: int = 4000, overlap_tokens: int = 200) -> DataFrame:
    """Chunks of documents given as (name, bytes)."""
    files = spark.createDataFrame(documents, "path string, content binary")
    return chunk_sections(build_sections(elements_of(parse_files(files))), max_tokens, overlap_tokens)


class DocxDataSource(DataSource):
    """``spark.read.format("docx").load(path)``: elements of the files of a folder that executors can open."""

    @classmethod
    def name(cls) -> str:
        return "docx"

    def schema(self) -> str:
        return "doc string, " + ELEMENT

    def reader(self, schema) -> DataSourceReader:
        return _DocxReader(self.options)


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _DocxReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.mode = options.get("path"), options.get("image_mode", "metadata_only")
        if not self.path:
            raise ValueError("option path is required")

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        info = store.get_file_info(base)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(base, recursive=True))
        return [_File(f.path) for f in found if f.is_file and f.path.endswith(".docx")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        with store.open_input_file(partition.path) as f:
            data = f.read()
        for e in parse_elements(data, self.mode):
            images = [(i["image_ref"], i["page_estimate"], i["mode"]) for i in e["images"]]
            yield (partition.path, e["ord"], e["kind"], e["style_heading"], e["text"], e["cells"], e["page_break"], images)
