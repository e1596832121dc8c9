import json
import random

import pytest

from tessera.functions.schema import CHUNK_ONLY, parse_field
from tessera.functions.text import fold_text, stated_confidence
from tessera.operators.all_info import absent, all_info

FIELDS = [
    parse_field({"name": "title"}), parse_field({"name": "tags", "type": "list[str]"}), parse_field({"name": "year", "type": "int?"}), parse_field({"name": "age", "merge": "collect"}), parse_field({"name": "thinking"}),
    parse_field({"name": "rooms", "type": "list[object]", "identity": "name", "fields": [{"name": "name", "type": "str"}, {"name": "width"}, {"name": "notes", "type": "list[str]"}, {"name": "n", "type": "float?"}]}),
    parse_field({"name": "loose", "type": "list[object]", "fields": [{"name": "a"}]}),
]


def fold_document(chunks):
    """The merge rules, one chunk after the other."""
    out = {f.name: [] if f.is_list or f.is_entity or f.merge else None for f in FIELDS if f.name not in CHUNK_ONLY}
    prov, sure, good, bad = {}, [], 0, 0
    known = {}
    for cid, x in chunks:
        if x is None:
            bad += 1
            continue
        good += 1
        c = x.get("confidence_score")
        if isinstance(c, (int, float)):
            sure.append(float(c))
        for f in FIELDS:
            v = x.get(f.name)
            if f.name not in out or absent(v):
                continue
            if f.is_entity:
                for item in v if isinstance(v, list) else []:
                    if not isinstance(item, dict):
                        continue
                    ident = item.get(f.identity) if f.identity else None
                    e = None if absent(ident) else known.get((f.name, fold_text(ident)))
                    if e is None:
                        e = {}
                        for g in f.fields:
                            y = item.get(g.name)
                            if g.is_list:
                                e[g.name] = [str(z) for z in y] if isinstance(y, list) else [] if absent(y) else [str(y)]
                            else:
                                e[g.name] = None if absent(y) else y
                        e |= {"source_chunk_ids": [cid], "conflicts": []}
                        out[f.name].append(e)
                        if not absent(ident):
                            known[f.name, fold_text(ident)] = e
                        continue
                    e["source_chunk_ids"].append(cid)
                    for g in f.fields:
                        y = item.get(g.name)
                        if absent(y):
                            continue
                        if g.is_list:
                            e[g.name] += [z for z in dict.fromkeys(str(z) for z in (y if isinstance(y, list) else [y]) if not absent(z)) if z not in e[g.name]]
                        elif absent(e[g.name]):
                            e[g.name] = y
                        elif fold_text(e[g.name]) != fold_text(y):
                            e["conflicts"].append({"field": g.name, "value": y, "chunk_id": cid})
            elif f.is_list:
                for y in v if isinstance(v, list) else [v]:
                    if not absent(y):
                        if str(y) not in out[f.name]:
                            out[f.name].append(str(y))
                        prov.setdefault(f.name, {}).setdefault(str(y), []).append(cid)
            elif f.merge:
                same = next((e for e in out[f.name] if fold_text(e["value"]) == fold_text(v)), None)
                if same:
                    same["source_chunk_ids"].append(cid)
                else:
                    out[f.name].append({"value": v, "source_chunk_ids": [cid]})
            elif out[f.name] is None:
                out[f.name], prov[f.name] = v, [cid]
            elif fold_text(out[f.name]) == fold_text(v):
                prov[f.name].append(cid)
    stats = {"chunks_merged": good, "chunks_failed": bad, "confidence_min": min(sure, default=None), "confidence_avg": sum(sure) / len(sure) if sure else None}
    return out | {"_provenance": prov, "_stats": stats}


def run(spark, docs):
    rows = [(d, n, cid, x is not None, None if x is None else json.dumps(x, ensure_ascii=False)) for d, chunks in docs.items() for n, (cid, x) in enumerate(chunks)]
    rows = [(*r, None if r[4] is None else stated_confidence(json.loads(r[4]))) for r in rows]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc string, ci int, cid string, ok boolean, extraction string, confidence double").repartition(3)
    return {r.doc: json.loads(r.all_info) for r in all_info(df, FIELDS).collect()}


CASES = {
    "union": [("a", {"tags": ["x", "y", "x"]}), ("b", {"tags": ["y", "", None, "z"]})],
    "coerced": [("a", {"tags": "solo"}), ("b", {"tags": [1, 2.5, True]})],
    "first": [("a", {"title": ""}), ("b", {"title": "Ｔitle  A"}), ("c", {"title": "title a"}), ("d", {"title": "other"})],
    "zero": [("a", {"year": 0}), ("b", {"year": 5}), ("c", {"year": "0"})],
    "collect": [("a", {"age": "Late"}), ("b", {"age": "late "}), ("c", {"age": "Early"})],
    "fill": [("a", {"rooms": [{"name": "R-7"}]}), ("b", {"rooms": [{"name": "ｒ－7", "width": "5 m", "n": 2.0}]}), ("c", {"rooms": [{"name": "R -7", "width": "6 m"}, {"name": "R-7", "width": "5M"}]})],
    "anonymous": [("a", {"rooms": [{"width": "1"}, {"name": "", "width": "1"}]}), ("b", {"rooms": [{"width": "1"}], "loose": [{"a": 1}, {"a": 1}, 7]})],
    "lists": [("a", {"rooms": [{"name": "w", "notes": ["p", "p", None, ""]}]}), ("b", {"rooms": [{"name": "w", "notes": ["q", "q", "", None, "p"], "extra": 1}]})],
    "failed": [("a", None), ("b", None)],
    "empty": [("a", {})],
    "kept out": [("a", {"thinking": "t", "confidence_score": 0.25, "unknown": 1}), ("b", {"confidence_score": 0.75}), ("c", {"confidence_score": "x"}), ("d", {"confidence_score": True})],
    "marks": [("a", {"title": 'q"u\\o\nt\u0001e 室', "tags": ['"', "\\"]})],
}


def test_cases(spark):
    got = run(spark, CASES)
    for name, chunks in CASES.items():
        assert got[name] == fold_document(chunks), name
        assert list(got[name]) == [f.name for f in FIELDS if f.name not in CHUNK_ONLY] + ["_provenance", "_stats"]


def test_random_documents(spark):
    rnd = random.Random(7)
    names = ["R-7", "r-7", "Ｒ-7", "b", "", None, " "]
    value = lambda: rnd.choice([None, "", "a", "A", " a", "ß", "ss", 0, 1, 1.5, [], "长"])
    docs = {}
    for d in range(40):
        chunks = []
        for n in range(rnd.randrange(1, 6)):
            x = {"title": value(), "tags": rnd.choice([None, "x", [value() for _ in range(3)]]), "age": value(), "confidence_score": rnd.choice([0.5, 0.25, None])}
            x["rooms"] = [{"name": rnd.choice(names), "width": value(), "n": value(), "notes": rnd.choice([None, "k", ["k", "l", None], []])} for _ in range(rnd.randrange(4))]
            chunks.append((f"d{d}_{n}", rnd.choice([x, x, x, None])))
        docs[f"d{d}"] = chunks
    got = run(spark, docs)
    for d, chunks in docs.items():
        want = fold_document([(c, None if x is None else {k: v for k, v in x.items()}) for c, x in chunks])
        assert got[d] == json.loads(json.dumps(want)), d


def test_width_and_duplicates():
    with pytest.raises(ValueError):
        parse_field({"name": "x", "type": "list[object]", "fields": [{"name": "y", "type": "list[object]"}]})
