import random

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import sections as S

SCHEMA = f"doc string, ord int, kind string, style_heading boolean, text string, page_break boolean, images {S.IMAGE}"


def estimate(t):
    import re

    cjk = len(re.findall("[一-鿿]", t))
    return int(cjk * 0.7 + len(re.findall("[a-zA-Z0-9]+", t)) + (len(t) - cjk) * 0.3)


def walk(elements):
    """The rules one element at a time."""
    done, page, para = [], 1, -1
    new = lambda title, p, i: {"title": title, "paras": [], "tables": [], "images": [], "p": p, "i": i}
    cur = new(None, 1, 0)
    for _, _, kind, heading, text, broken, images in elements:
        if kind == "p":
            para += 1
            page += bool(broken)
            cur["images"] += images
            if heading and text:
                cur |= {"pe": page, "ie": para - 1}
                done.append(cur)
                cur = new(text, page, para)
            elif text:
                cur["paras"].append(text)
        elif text:
            cur["tables"].append(text)
    cur |= {"pe": page, "ie": para}
    done = [s for s in [*done, cur] if s["paras"] or s["tables"]]
    if done and done[0]["title"] is None:
        done[0]["title"] = next((p for p in done[0]["paras"] if 2 <= len(p) <= 80), S.START)
    return done


def pack(parts, most, overlap):
    out, cur = [], []
    total = 0
    for p in parts:
        t = estimate(p)
        if cur and total + t > most:
            out.append(cur)
            keep = cur[-1:] if overlap and estimate(cur[-1]) <= overlap else []
            cur, total = list(keep), sum(map(estimate, keep))
        cur.append(p)
        total += t
    return out + [cur] if cur else out


def streams(n):
    rnd = random.Random(n)
    for d in range(n):
        rows = []
        for o in range(rnd.randrange(0, 25)):
            kind = rnd.choice(["p", "p", "p", "tbl"])
            text = rnd.choice(["", "word " * rnd.randrange(1, 30) + "end", "短い文 text", "x"])
            images = [(f"r{o}", 1, "metadata_only")] if kind == "p" and rnd.random() < 0.2 else []
            rows.append((f"d{d}.docx", o, kind, kind == "p" and rnd.random() < 0.25, text.strip(), kind == "p" and rnd.random() < 0.2, images))
        yield rows


def test_sections_and_chunks_against_a_walk(spark):
    docs = list(streams(60))
    df = spark.createDataFrame([r for d in docs for r in d], SCHEMA).repartition(5)
    got = {}
    for r in S.build_sections(df).collect():
        got.setdefault(r.doc, {})[r.section] = (r.heading, r.paragraphs, r.tables, [i.image_ref for i in r.images], r.page_start, r.page_end, r.para_start, r.para_end)
    chunks = {}
    for r in S.chunk_sections(S.build_sections(df), 40, 10).collect():
        chunks.setdefault(r.doc, {})[r.chunk_index] = (r.source_section, r.content, r.token_estimate, ", part " in r.source_position, r.image_refs != "[]")
    for d in docs:
        want = walk(d)
        name = d[0][0] if d else None
        listed = [(s["title"], s["paras"], s["tables"], [i[0] for i in s["images"]], s["p"], s["pe"], s["i"], s["ie"]) for s in want]
        assert [got.get(name, {})[k] for k in sorted(got.get(name, {}))] == listed
        cs = []
        for s in want:
            parts = s["paras"] + [S.TABLE_MARK + t for t in s["tables"]]
            whole = "\n".join(parts)
            if estimate(whole) <= 40:
                cs.append((s["title"], whole, estimate(whole), False, bool(s["images"])))
            else:
                ps = ["\n".join(p) for p in pack(parts, 40, 10)]
                cs += [(s["title"], p, estimate(p), True, bool(s["images"]) and n == 0 and len(ps) > 1) for n, p in enumerate(ps)]
        assert [chunks.get(name, {})[k] for k in sorted(chunks.get(name, {}))] == cs


def test_head_and_full_text(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 0, "x"), ("b", 0, "z")], "doc string, chunk_index int, content string")
    assert {r.doc: r.full_text for r in S.full_text(df).collect()} == {"a": "x\n\ny", "b": "z"}
    assert S.head_chunks(df, 1).count() == 2 and S.head_chunks(df, 0).count() == 3


def test_markdown(spark):
    cases = [([], ""), ([["a", "b"]], "a | b"), ([["a | c", "b"], ["1", "2"]], "a | c | b\n--- | --- | ---\n1 | 2"), ([[""], ["x"]], "\n---\nx")]
    df = spark.createDataFrame([(c,) for c, _ in cases], "c array<array<string>>")
    assert [r[0] for r in df.select(S.table_markdown(F.col("c"))).collect()] == [w for _, w in cases]


def test_estimates_agree(spark):
    for t in ("", "a b", "地熱abc", "…"):
        assert spark.range(1).select(X.token_estimate(F.lit(t))).first()[0] == estimate(t)
