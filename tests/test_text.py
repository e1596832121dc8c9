import json
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import text as X

TEXTS = ["", "abc def", "港口 室名 abc 12", " x ", "a" * 50, "😀 é", "　地　", "line\nline", "\x1cq\x1f"]


def test_estimate_strip_and_fold(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select("t", X.token_estimate(F.col("t")), X.strip(F.col("t")), X.identity_fold(F.col("t"))).collect()
    for t, n, s, f in got:
        cjk = len(re.findall("[一-鿿]", t))
        assert n == int(cjk * 0.7 + len(re.findall("[a-zA-Z0-9]+", t)) + (len(t) - cjk) * 0.3)
        assert s == t.strip()
        assert f == "".join(unicodedata.normalize("NFKC", t).casefold().split())


def test_names_and_positions(spark):
    df = spark.createDataFrame([("/a/b/x.y.docx", 3), (".hidden", 0), ("plain", 1)], "p string, i int")
    got = [tuple(r) for r in df.select(X.base_name(F.col("p")), X.stem(F.col("p")), X.chunk_id(F.col("p"), F.col("i"))).collect()]
    assert got[0][:2] == ("x.y.docx", "x.y") and got[1][:2] == (".hidden", ".hidden") and got[2][1] == "plain"
    assert got[0][2].endswith("_3") and len(got[0][2]) == 10
    pos = lambda *v: spark.range(1).select(X.position(*[F.lit(x) for x in v])).first()[0]
    assert pos("H", 2, 2, 0, 4, None) == "heading: H, p.2, para 0-4"
    assert pos("H", 2, 5, 0, 4, 3) == "heading: H, p.2-5, para 0-4, part 3"


REPLIES = [
    ('{"a": 1}', {"a": 1}), ('```json\n{"a": 1,}\n```', {"a": 1}), ('```\n{"a": [1, 2, ]}\n```\nbye', None), ("[1]", None), ("null", None), ('{"a": "x\x01y"}', {"a": "x y"}), ('{"a": "x\ny"}', None), ("", None), ('hi ```{"a":1}```', None),
    ('{"a": 1} tail', None), ('{"a": 1, "a": 2}', {"a": 2}), ("```json\n{}\n  ```  ", {}),
]


@pytest.mark.parametrize("raw,want", REPLIES)
def test_replies(raw, want):
    value, error = X.parse_reply(raw)
    assert value == want and (error is None) == (want is not None)


def test_fence_and_cleaning_columns(spark):
    rows = [r for r, _ in REPLIES]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    for r, s, c in df.select("t", X.strip_fence(F.col("t")), X.clean_json(F.col("t"))).collect():
        t = r.strip()
        if t.startswith("```"):
            lines = t.split("\n")
            t = "\n".join(lines[1:-1] if lines[-1].strip() == "```" else [x for x in lines if not x.strip().startswith("```")])
        assert s == t
        assert c == re.sub(r",\s*([}\]])", r"\1", re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", " ", r))


@settings(deadline=None, max_examples=50)
@given(st.dictionaries(st.text(max_size=5), st.one_of(st.none(), st.integers(), st.text(max_size=10), st.lists(st.integers(), max_size=3)), max_size=4))
def test_any_object_round_trips(d):
    assert X.parse_reply("```json\n" + json.dumps(d) + "\n```") == (d, None)
