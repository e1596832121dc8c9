"""Scalar functions on text: estimates, identifiers, positions, folding, JSON clean-up."""

from __future__ import annotations

import json
import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tessera.runtime import ship_package

CJK = "[\\u4E00-\\u9FFF]"
ASCII_WORD = "[a-zA-Z0-9]+"
#: White space as Python's str.strip sees it: Unicode's and U+001C to U+001F.
BLANK = "[\\s\\p{Z}\\x1C-\\x1F\\x85]"


def token_estimate(text: Column) -> Column:
    """0.7 a CJK character, 1 an ASCII word, 0.3 any other code point, cut to an integer; empty: 0."""
    cjk = F.regexp_count(text, F.lit(CJK)).cast("double")
    words = F.regexp_count(text, F.lit(ASCII_WORD)).cast("double")
    return (cjk * F.lit(0.7) + words + (F.char_length(text).cast("double") - cjk) * F.lit(0.3)).cast("long")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The base name without its last suffix; names that begin with their only dot keep it."""
    return F.regexp_replace(base_name(path), "(?<=.)\\.[^.]*$", "")


def name_hash(path: Column) -> Column:
    return F.substring(F.md5(base_name(path).cast("binary")), 1, 8)


def chunk_id(path: Column, index: Column) -> Column:
    return F.concat_ws("_", name_hash(path), index.cast("string"))


def page_range(start: Column, end: Column) -> Column:
    return F.when(start == end, F.concat(F.lit("p."), start.cast("string"))).otherwise(F.concat(F.lit("p."), start.cast("string"), F.lit("-"), end.cast("string")))


def position(heading: Column, page_start: Column, page_end: Column, para_start: Column, para_end: Column, part: Column) -> Column:
    """``heading: H, p.A-B, para a-b[, part n]``; a null part is left out."""
    paras = F.concat(F.lit("para "), para_start.cast("string"), F.lit("-"), para_end.cast("string"))
    return F.concat_ws(", ", F.concat(F.lit("heading: "), heading), page_range(page_start, page_end), paras, F.concat(F.lit("part "), part.cast("string")))


def is_absent(value: Column) -> Column:
    """Null or the empty string; zero, false and blanks are values."""
    return value.isNull() | (value == "")


def ascii_fold(value: Column) -> Column:
    """The fold of ASCII and simple Latin text, without a Python worker: lower case, sharp s as ss, no white space."""
    return F.regexp_replace(F.replace(F.lower(value), F.lit("ß"), F.lit("ss")), f"{BLANK}+", "")


def fold_text(value: object) -> str:
    """Compatibility composition, case folding, no white space: equal folds are one identity."""
    return "".join(unicodedata.normalize("NFKC", str(value)).casefold().split())


def identity_fold(value: Column) -> Column:
    """The fold of any text, in one Arrow pass of the active session."""
    ship_package(SparkSession.active())

    @F.pandas_udf("string")
    def fold(v: pd.Series) -> pd.Series:
        return v.map(lambda x: None if x is None else fold_text(x))

    return fold(value)


def clean_json(text: Column) -> Column:
    """Control characters but tab, line feed and return become spaces; commas before a closing bracket go."""
    return F.regexp_replace(F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", " "), ",\\s*([}\\]])", "$1")


def strip_fence(text: Column) -> Column:
    """Without the lines of a code fence, if the trimmed text begins with one.

    A closing line that is a bare fence is dropped with the first line; else every line that begins
    with a fence is.
    """
    t = strip(text)
    lines = F.split(t, "\n")
    last = strip(F.element_at(lines, -1))
    inner = F.slice(lines, 2, F.greatest(F.size(lines) - 2, F.lit(0)))
    loose = F.filter(lines, lambda x: ~strip(x).startswith("```"))
    return F.when(t.startswith("```"), F.array_join(F.when(last == "```", inner).otherwise(loose), "\n")).otherwise(t)


_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")
_COMMA = re.compile(r",\s*([}\]])")


def stated_confidence(value: dict) -> float | None:
    """The object's own confidence, if it is a number (true and false count as 1 and 0) other than NaN."""
    c = value.get("confidence_score")
    return float(c) if isinstance(c, (int, float)) and not math.isnan(c) else None


def parse_reply(raw: str) -> tuple[object, str | None]:
    """(value, None) or (None, error): strict JSON after fences are gone, once more after clean-up.

    Only objects are results: any other JSON value is an error.
    """
    text = raw.strip()
    if text.startswith("```"):
        lines = text.split("\n")
        text = "\n".join(lines[1:-1] if lines[-1].strip() == "```" else [x for x in lines if not x.strip().startswith("```")])
    error = "no reply"
    for attempt in (text, _COMMA.sub(r"\1", _CONTROL.sub(" ", text))):
        try:
            value = json.loads(attempt)
        except (json.JSONDecodeError, RecursionError) as e:
            error = str(e)
            continue
        return (value, None) if isinstance(value, dict) else (None, "not a JSON object")
    return None, error
