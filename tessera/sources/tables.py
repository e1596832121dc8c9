"""Plain sources: text columns and HTML as elements, and the formats Spark reads itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X

FORMATS = ("parquet", "orc", "csv", "json", "text", "jdbc", "binaryFile")
#: Tags that open a block, and a character that stands nowhere in a page's text.
_OPENS = "(?i)<(?=(?:h[1-6]|p|li)(?:\\s[^>]*)?>)"
_MARK = "\x01"


def read(spark: SparkSession, kind: str, path: str | None = None, **options) -> DataFrame:
    if kind not in FORMATS:
        raise ValueError(f"format is one of {FORMATS}")
    reader = spark.read.format(kind).options(**options)
    return reader.load(path) if path else reader.load()


def text_elements(docs: DataFrame, doc: Column, text: str, heading: Column | None = None, page_break: Column | None = None) -> DataFrame:
    """A paragraph a line. heading and page_break are predicates over text and ord, false if not given."""
    e = docs.select(doc.cast("string").alias("doc"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("ord", "text"))
    e = e.select("doc", "ord", F.lit("p").alias("kind"), X.strip(F.col("text")).alias("text"))
    return e.withColumn("style_heading", heading if heading is not None else F.lit(False)).withColumn("page_break", page_break if page_break is not None else F.lit(False))


def plain(html: Column) -> Column:
    """Tags dropped, the five named entities decoded, white space squeezed."""
    t = F.regexp_replace(html, "(?s)<[^>]*>", "")
    for name, c in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        t = F.replace(t, F.lit(f"&{name};"), F.lit(c))
    return X.strip(F.regexp_replace(t, "\\s+", " "))


def html_elements(pages: DataFrame, doc: Column, html: str) -> DataFrame:
    """Headings, paragraphs and list items of a page in order; headings 1 to 4 open sections.

    A block ends at the first closing tag of any block or where the next one opens, so one that is never
    closed keeps its text, and a page is read in one pass.
    """
    bare = F.regexp_replace(F.replace(F.coalesce(F.col(html), F.lit("")), F.lit(_MARK), F.lit(" ")), "(?is)<script\\b.*?</script>|<style\\b.*?</style>", "")
    blocks = F.split(F.regexp_replace(bare, _OPENS, _MARK), _MARK)
    e = pages.select(doc.cast("string").alias("doc"), F.posexplode(F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0)))).alias("ord", "x"))
    tag = F.lower(F.regexp_extract("x", "^(\\w+)", 1))
    body = F.regexp_replace(F.regexp_replace("x", "^[^>]*>", ""), "(?is)</(?:h[1-6]|p|li)>.*$", "")
    return e.select("doc", "ord", F.lit("p").alias("kind"), plain(body).alias("text"), tag.isin("h1", "h2", "h3", "h4").alias("style_heading"), F.lit(False).alias("page_break"))
