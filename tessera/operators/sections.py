"""Elements to sections to chunks, as windows, one grouped aggregate and a fold.

Elements: doc, ord, kind ('p' or 'tbl'), style_heading (boolean), text (stripped; a table's
markdown), page_break (boolean), images (array of structs, may be absent). All windows partition by
document, so a document is a task's unit and nothing is ordered globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X

#: The heading of text before the first heading, and what precedes a table in a chunk.
START = "(document start)"
TABLE_MARK = "\n[表格]\n"
IMAGE = "array<struct<image_ref:string,page_estimate:int,mode:string>>"


def annotate(elements: DataFrame) -> DataFrame:
    """Heading flag, section number, running page and paragraph numbers of each element."""
    run = Window.partitionBy("doc").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.coalesce((F.col("kind") == "p") & F.col("style_heading") & (F.col("text") != ""), F.lit(False))
    e = elements.withColumn("heading", heading)
    count = lambda c: F.coalesce(F.sum(c.cast("int")).over(run), F.lit(0)).cast("int")
    e = e.withColumn("section", count(F.col("heading"))).withColumn("page", count(F.coalesce("page_break", F.lit(False))) + 1)
    return e.withColumn("para", count(F.col("kind") == "p") - 1)


def build_sections(elements: DataFrame) -> DataFrame:
    """doc, section, heading, paragraphs, tables, images, page_start, page_end, para_start, para_end, parts.

    Sections without text are dropped after their neighbours' ends are set. Images in a heading
    belong to the section before it. A first section without a heading takes its first paragraph of
    2 to 80 characters as one.
    """
    e = annotate(elements)
    none = F.array().cast(IMAGE)
    body = (F.col("kind") == "p") & ~F.col("heading") & (F.col("text") != "")
    table = (F.col("kind") == "tbl") & (F.col("text") != "")
    ordered = lambda keep, value: F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("ord", value.alias("v"))))), lambda x: x["v"])
    own = e.groupBy("doc", "section").agg(
        F.max(F.when(F.col("heading"), F.col("text"))).alias("title"),
        F.max(F.when(F.col("heading"), F.col("page"))).alias("page_at"),
        F.max(F.when(F.col("heading"), F.col("para"))).alias("para_at"),
        F.max("page").alias("last_page"),
        F.max("para").alias("last_para"),
        ordered(body, F.col("text")).alias("paragraphs"),
        ordered(table, F.col("text")).alias("tables"),
    )
    images = none
    if "images" in e.columns:
        pictures = e.where(F.size("images") > 0).groupBy("doc", (F.col("section") - F.col("heading").cast("int")).alias("section")).agg(F.flatten(ordered(F.lit(True), F.col("images"))).alias("images"))
    nxt = Window.partitionBy("doc").orderBy("section")
    s = own.withColumn("page_end", F.coalesce(F.lead("page_at").over(nxt), F.col("last_page"))).withColumn("para_end", F.coalesce(F.lead("para_at").over(nxt) - 1, F.col("last_para")))
    s = s.where((F.size("paragraphs") > 0) | (F.size("tables") > 0)).withColumn("rank", F.row_number().over(nxt))
    first_line = F.get(F.filter("paragraphs", lambda p: F.char_length(p).between(2, 80)), F.lit(0))
    untitled = F.when(F.col("rank") == 1, F.coalesce(first_line, F.lit(START))).otherwise(F.lit(START))
    if "images" in e.columns:
        s, images = s.join(pictures, ["doc", "section"], "left"), F.coalesce("images", none)
    return s.select(
        "doc", (F.col("rank") - 1).cast("int").alias("section"), F.coalesce("title", untitled).alias("heading"), "paragraphs", "tables", images.alias("images"),
        F.coalesce("page_at", F.lit(1)).cast("int").alias("page_start"), F.col("page_end").cast("int").alias("page_end"), F.coalesce("para_at", F.lit(0)).cast("int").alias("para_start"), F.col("para_end").cast("int").alias("para_end"),
        F.concat("paragraphs", F.transform("tables", lambda t: F.concat(F.lit(TABLE_MARK), t))).alias("parts"),
    )


def pack(parts: Column, max_tokens: int, overlap_tokens: int = 0) -> Column:
    """Greedy packing of an array of texts into arrays within a token budget, the last text carried over.

    A text over the budget stays whole. A chunk is closed when the next text would exceed the budget;
    its last text opens the next chunk too if it is no larger than the overlap. Texts are estimated
    once, before the fold: a step that named the estimate would compute it anew at each mention.
    """
    sized = F.transform(parts, lambda p: F.struct(p.alias("text"), X.token_estimate(p).alias("tokens")))
    strings = "array<string>"
    start = F.struct(F.array().cast("array<array<string>>").alias("done"), F.array().cast(strings).alias("cur"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("last"))

    def step(a: Column, x: Column) -> Column:
        t = x["tokens"]
        flush = (a["n"] + t > max_tokens) & (F.size(a["cur"]) > 0)
        carry = flush & (a["last"] <= overlap_tokens) if overlap_tokens > 0 else F.lit(False)
        one = F.array(x["text"])
        return F.struct(
            F.when(flush, F.concat(a["done"], F.array(a["cur"]))).otherwise(a["done"]).alias("done"),
            F.when(carry, F.concat(F.slice(a["cur"], -1, 1), one)).when(flush, one).otherwise(F.concat(a["cur"], one)).alias("cur"),
            F.when(carry, a["last"] + t).when(flush, t).otherwise(a["n"] + t).alias("n"),
            t.alias("last"),
        )

    return F.aggregate(sized, start, step, lambda a: F.when(F.size(a["cur"]) > 0, F.concat(a["done"], F.array(a["cur"]))).otherwise(a["done"]))


def chunk_sections(sections: DataFrame, max_tokens: int = 4000, overlap_tokens: int = 200) -> DataFrame:
    """The eleven chunk columns. A section that fits is one chunk without a part number; images go with the
    first part of a split section, but never with its last."""
    s = sections.withColumn("whole", F.array_join("parts", "\n")).withColumn("fits", X.token_estimate(F.col("whole")) <= max_tokens)
    packed = F.transform(pack(F.col("parts"), max_tokens, overlap_tokens), lambda c: F.array_join(c, "\n"))
    s = s.withColumn("contents", F.when(F.col("fits"), F.array("whole")).otherwise(packed))
    c = s.select("*", F.size("contents").alias("n_parts"), F.posexplode("contents").alias("part", "content"))
    index = F.row_number().over(Window.partitionBy("doc").orderBy("section", "part")) - 1
    c = c.withColumn("chunk_index", index.cast("int"))
    number = F.when(~F.col("fits"), F.col("part") + 1)
    pictures = F.when(F.col("fits") | ((F.col("part") == 0) & (F.col("n_parts") > 1)), F.to_json("images")).otherwise(F.lit("[]"))
    return c.select(
        "doc", X.chunk_id(F.col("doc"), F.col("chunk_index")).alias("chunk_id"), X.base_name(F.col("doc")).alias("source_file"), F.col("page_start").alias("source_page"), F.col("page_end").alias("source_page_end"),
        F.col("heading").alias("source_section"), X.position(F.col("heading"), F.col("page_start"), F.col("page_end"), F.col("para_start"), F.col("para_end"), number).alias("source_position"), "chunk_index", "content",
        F.lit("text").alias("content_type"), pictures.alias("image_refs"), X.token_estimate(F.col("content")).alias("token_estimate"),
    )


def head_chunks(chunks: DataFrame, n: int) -> DataFrame:
    """The first n chunks of each document; all of them if n is 0."""
    return chunks.where(F.col("chunk_index") < n) if n > 0 else chunks


def full_text(chunks: DataFrame) -> DataFrame:
    """doc, full_text: chunk contents in order, a blank line between them."""
    return chunks.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "content"))), lambda x: x["content"]), "\n\n").alias("full_text"))


def table_markdown(rows: Column) -> Column:
    """An array of rows of cell texts as lines; a rule below the first row if there are more."""
    lines = F.transform(rows, lambda r: F.array_join(r, " | "))
    rule = F.array_join(F.transform(F.split(F.get(lines, F.lit(0)), " \\| "), lambda _: F.lit("---")), " | ")
    ruled = F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))))
    return F.when(F.size(rows) == 0, F.lit("")).otherwise(F.array_join(F.when(F.size(lines) > 1, ruled).otherwise(lines), "\n"))
