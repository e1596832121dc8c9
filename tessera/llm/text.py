"""Word splitting on the JVM side, shared by the operators that count words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words that white space (space, tab to carriage return) separates.
SPACED = "[^ \t-\r]+"
#: What stands between words: ASCII characters that are no letters or digits (upper-case ones are lowered before).
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null: empty. A text of ASCII alone takes the fast way."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.char_length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null: none."""
    return F.array_remove(F.split(lowered(text), BETWEEN), "")


def spaced_count(text: Column) -> Column:
    """Number of words between white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED)), F.lit(0)).cast("long")


def row_key(text: Column) -> Column:
    """128 bits that tell texts apart; null like empty."""
    t = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"))
