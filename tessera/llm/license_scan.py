"""Licence scan: ordered signature rules, a keyword prefilter, priorities and interval containment.

Everything is DataFrame operations on the row itself, without a shuffle. A text is normalised and
split once. A rule's keywords are derived from its pattern: literals of which every match holds one.
A rule is tried only where one of its keywords stands, and a text is looked at further only if it
holds one of a few stems, of which every keyword holds one; so neither test can lose a match. In such a text
each word carries its number, ``gnu#17 general#18``, and a match tells the words it spans. Each rule is
a literal expression, compiled once. Matches become intervals of words; sorted by start and descending
end, any interval that contains another comes before it, so one sweep that remembers the farthest
end of each priority suppresses what lies inside a stronger or longer match.
"""

from __future__ import annotations

import re._parser as grammar
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.license_rules import BASE, KINDS, load
from tessera.llm.text import words_of
from tessera.runtime import spread

LEVELS = max(p for p, _ in KINDS.values()) + 1
#: Every keyword of every rule holds one of these, a word's edge being a space; tests hold them against the rules.
STEMS = [
    "licen", "spdx", "gpl", " bsd", "gnu", " cc by ", " cc0 ", "creativecommons", "creative commons", "opensource org", "apache org", "mozilla org", "eclipse org", "boost org", "wtfpl", "sil org", "opendatacommons",
    "noninfringement", "redistribution", "permission", "sublicense", "substantial portions", "endorse or promote", "advertising materials", "misrepresented", "altered source", "machine executable",
    "perpetual", "free software foundation", "any later version", "merchantability", "mozilla public", "eclipse public", "common development", "public domain", "copy modify publish", "you just do",
    "share copy and redistribute", "standard version", "university of illinois", "psf is making", "openssl", "for good not evil", "whatever you want", "under the eupl", "prohibited", "trade secret",
    "same terms as perl", "all rights reserved", " mpl ", " cddl ", " eupl ", " asl ", "verbatim copies",
]
#: Alternatives that a keyword test may have.
ALTERNATIVES = 8

FOUND = "array<struct<s:int,minus_e:int,minus_p:int,rank:int,label:string,confidence:double,base:boolean>>"
KEPT = "array<struct<s:int,e:int,label:string,confidence:double>>"


def _words_of_pattern(items, limit: int) -> set[str] | None:
    """All texts that the parsed pattern matches, if they are ``limit`` at most."""
    out = {""}
    for op, arg in items:
        if op is grammar.LITERAL:
            more = {chr(arg)}
        elif op is grammar.IN and all(o is grammar.LITERAL for o, _ in arg):
            more = {chr(x) for _, x in arg}
        elif op is grammar.SUBPATTERN:
            more = _words_of_pattern(arg[3], limit)
        elif op is grammar.BRANCH:
            each = [_words_of_pattern(x, limit) for x in arg[1]]
            more = None if None in each else set().union(*each)
        elif op is grammar.MAX_REPEAT and tuple(arg[:2]) == (0, 1):
            more = _words_of_pattern(arg[2], limit)
            more = None if more is None else more | {""}
        else:
            more = None
        if more is None or len(out) * len(more) > limit:
            return None
        out = {a + b for a, b in product(out, more)}
    return out


def keywords(pattern: str) -> list[str]:
    """Literals of which every match, between spaces, holds one: of the pattern's runs with stems that whose shortest is longest."""
    items = [(grammar.LITERAL, 32), *grammar.parse(pattern).data, (grammar.LITERAL, 32)]
    runs: list[set[str]] = []
    for a in range(len(items)):
        if a and items[a][0] is grammar.LITERAL and items[a - 1][0] is grammar.LITERAL:
            continue  # a longer run begins before
        best = None
        for z in range(a + 1, len(items) + 1):
            texts = _words_of_pattern(items[a:z], ALTERNATIVES)
            if texts is None:
                break
            best = texts
        if best:
            runs.append(best)
    stemmed = lambda r: all(any(s in x for s in STEMS) for x in r)
    return sorted(max(runs, key=lambda r: (stemmed(r), min(map(len, r)), -len(r), sorted(r))))


def _regex(pattern: str) -> str:
    """A pattern over words as one over numbered words."""
    pattern = pattern.replace(" ?", "( )?").replace("( \\w+)", "( [^# ]+)").replace(" ", "#[0-9]+ ").replace("[^##[0-9]+ ]", "[^# ]")
    return f"(?<= )(?:{pattern})#[0-9]+(?= )"


def compiled_rules() -> list[tuple]:
    """(keywords, regex, label, priority, confidence, order, base)"""
    out = [(keywords(pattern), _regex(pattern), label, *KINDS[kind], i, False) for i, (kind, label, pattern) in enumerate(load())]
    return out + [([f" {phrase} "], _regex(phrase), label, *KINDS["name"], len(out) + i, True) for i, (phrase, label) in enumerate(BASE)]


def detections(line: str, marked: str, rules: list[tuple]) -> Column:
    """All matches before suppression, sorted: word interval [s, e), priority, rule order, label, confidence, base.

    Written as SQL text, which the parser takes at once: a rule is a literal pattern behind its keywords.
    """

    def tried(rank: int, rule: tuple) -> str:
        gate = " OR ".join(f"contains({line}, '{k}')" for k in rule[0])
        return f"CASE WHEN {gate} THEN named_struct('rank', {rank}, 'ms', regexp_extract_all({marked}, r'{rule[1]}', 0)) END"

    values = {name: F.array(*[F.lit(r[n]) for r in rules]) for name, n in (("label", 2), ("priority", 3), ("confidence", 4), ("base", 6))}

    def interval(rank: Column, m: Column) -> Column:
        of = {name: F.get(v, rank) for name, v in values.items()}
        return F.struct(
            F.regexp_extract(m, "#([0-9]+)", 1).cast("int").alias("s"),
            (-(F.substring_index(m, "#", -1).cast("int") + 1)).alias("minus_e"),
            (-of["priority"]).alias("minus_p"),
            rank.alias("rank"),
            of["label"].alias("label"),
            of["confidence"].alias("confidence"),
            of["base"].alias("base"),
        )

    hits = F.expr(f"array_compact(array({', '.join(tried(i, r) for i, r in enumerate(rules))}))")
    return F.array_sort(F.flatten(F.transform(hits, lambda h: F.transform(h["ms"], lambda m: interval(h["rank"], m)))))


def survivors(found: Column) -> Column:
    """One sweep over sorted detections: (s, e, label, confidence) of those that nothing stronger or longer contains."""
    start = F.struct(F.array_repeat(F.lit(0), LEVELS).alias("far"), F.array().cast(KEPT).alias("kept"))

    def step(a: Column, d: Column) -> Column:
        e, p = -d["minus_e"], -d["minus_p"]
        inside = F.exists(F.slice(a["far"], p + 1, F.lit(LEVELS)), lambda x: x >= e)
        far = F.transform(a["far"], lambda x, i: F.when(i == p, F.greatest(x, e)).otherwise(x))
        new = F.array(F.struct(d["s"].alias("s"), e.alias("e"), d["label"].alias("label"), d["confidence"].alias("confidence")))
        return F.struct(far.alias("far"), F.when(inside, a["kept"]).otherwise(F.concat(a["kept"], new)).alias("kept"))

    return F.aggregate(F.filter(found, lambda d: ~d["base"]), start, step, lambda a: a["kept"])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: id, n_words, base (all base matches), detections (surviving spans).

    Texts that are null or empty have no words and nothing found. Ids may be null or repeat. Columns
    other than id and text are not read. Texts of any length are scanned whole.
    """
    d = spread(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")))
    d = d.select("id", words_of(F.col("text")).alias("w"))
    d = d.select("id", "w", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("line"))
    gate = reduce(lambda a, b: a | b, [F.contains("line", F.lit(s)) for s in STEMS])
    numbered = F.array_join(F.transform("w", lambda w, i: F.concat(w, F.lit("#"), i.cast("string"))), " ")
    d = d.select("id", F.size("w").cast("long").alias("n_words"), "line", F.when(gate, F.concat(F.lit(" "), numbered, F.lit(" "))).alias("marked"))
    found = F.when(F.col("marked").isNotNull(), detections("line", "marked", compiled_rules())).otherwise(F.array().cast(FOUND))
    d = d.select("id", "n_words", found.alias("found"))
    kept = F.when(F.size("found") > 0, survivors(F.col("found"))).otherwise(F.array().cast(KEPT))
    base = F.transform(F.filter("found", lambda x: x["base"]), lambda x: F.struct(x["s"].alias("s"), (-x["minus_e"]).alias("e"), x["label"].alias("label")))
    return d.select(F.col("id").alias(id_col), "n_words", base.alias("base"), kept.alias("detections"))


def license_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of the scan: base matches counted and placed, labels sorted and joined, score = the best confidence kept."""
    s = license_scan(docs, id_col, text)
    starts = F.transform("base", lambda x: x["s"])
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base_labels = F.transform("base", lambda x: x["label"])
    best = F.coalesce(F.array_max(F.transform("detections", lambda x: x["confidence"])), F.lit(0.0))
    return s.select(
        id_col,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels(base_labels).alias("base_labels"),
        labels(F.concat(base_labels, F.transform("detections", lambda x: x["label"]))).alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, F.lit(KINDS["name"][1])).otherwise(0.0)).alias("score"),
    )
