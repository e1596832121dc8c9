import random

import numpy as np

from tessera.llm import substring_dedup as S


def naive_cuts(data):
    """Byte by byte."""
    h = []
    for i in range(len(data)):
        x = sum(int(S._GEAR[data[i - k]]) << k for k in range(min(16, i + 1)))
        h.append(x * int(S._SPREAD) & 0xFFFFFFFF)
    out, start = [], 0
    for i in range(len(data)):
        before, after = h[max(0, i - S.REACH) : i], h[i + 1 : i + 1 + S.REACH]
        least = all(h[i] < x for x in before) and all(h[i] <= x for x in after)
        if least or i + 1 - start == S.MAX_CHUNK or i + 1 == len(data):
            out.append(i + 1)
            start = i + 1
    return out


def test_cuts_against_the_plain_rule():
    rnd = random.Random(1)
    for n in (0, 1, 2, 27, 28, 29, 30, 400, 2500):
        for alphabet in (b"a", b"ab", b"abcdefghij klmno", bytes(range(256))):
            data = bytes(rnd.choice(alphabet) for _ in range(n))
            assert S.cuts(data) == naive_cuts(data)


def test_cuts_come_back_after_an_insertion():
    rnd = random.Random(2)
    data = bytes(rnd.choice(b"abcdefghij klmno") for _ in range(3000))
    moved = b"inserted" + data
    edge = 16 + S.REACH
    assert {c + 8 for c in S.cuts(data) if c > edge} == {c for c in S.cuts(moved) if c > 8 + edge}


def starts(data):
    return [p for p in range(len(data)) if not data[p : p + 1].isspace() and (p == 0 or data[p - 1 : p].isspace())]


def brute(rows, min_words):
    """Every chunk against every earlier equal one's first place, byte by byte."""
    rows = {(i, (t or "").encode()) for i, t in rows}
    places = []
    for i, data in rows:
        ends = S.cuts(data)
        whole = [(0, len(data), True)] if len(ends) > 1 and len(starts(data)) < min_words else []
        for s, e, w in [*((s, e, False) for s, e in zip([0, *ends], ends)), *whole]:
            places.append(((i is None, -1 if i is None else i, s), data[s:e], w, e, data))
    places.sort(key=lambda p: (p[0], p[4]))
    first, spans = {}, {}
    for own, chunk, w, e, data in places:
        at = first.setdefault((chunk, w), (own, data))
        if at[0] == own and at[1] == data:
            continue
        other, s, x = at[1], own[2], at[0][2]
        while s and x and data[s - 1] == other[x - 1]:
            s, x = s - 1, x - 1
        y = at[0][2] + e - own[2]
        while e < len(data) and y < len(other) and data[e] == other[y]:
            e, y = e + 1, y + 1
        n = sum(s <= p < e for p in starts(data))
        if n >= min_words or s == 0 and e == len(data):
            spans.setdefault((own[:2], data), []).append((s, e, at[0][1] if not at[0][0] else None))
    out = set()
    for (own, data), found in spans.items():
        joined = []
        for s, e, of in sorted(found, key=lambda f: (f[0], f[2] is None, f[2] or 0, f[1])):
            if joined and s < joined[-1][1]:
                joined[-1][1] = max(e, joined[-1][1])
            else:
                joined.append([s, e, of])
        out |= {(None if own[0] else own[1], s, e, sum(s <= p < e for p in starts(data)), of) for s, e, of in joined}
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, key int, at int")


def found(got):
    return [(r.doc_id, r.first_byte, r.last_byte, r.n_words, r.first_id) for r in got.collect()]


def test_passages_against_brute_force(spark, monkeypatch):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = [text(60), text(51), text(90)]
    rows = [(1, passage[0]), (2, None), (3, ""), (4, "z " * 3000), (5, "z " * 3000)]
    for i in range(10, 90):
        rows.append((i, text(rnd.randrange(5, 200)) + " " + passage[i % 3] + (" " + text(30) + " " + passage[0] if i % 5 == 0 else "")))
    rows += [(150, text(100)), (151, text(100)), rows[5], (160, rows[6][1]), (None, rows[7][1]), (None, rows[7][1]), (200, text(80) + passage[1]), (200, passage[2])]
    rows += [(170, "few words"), (171, "few words"), (172, "few words too")]
    want = brute(rows, S.MIN_WORDS)
    got = found(S.repeated_passages(table(spark, rows)))
    assert len(got) == len(set(got)) and set(got) == want
    hit = {g[0] for g in got}
    assert hit >= {*range(13, 90), None, 160, 171} and not hit & {150, 151, 2, 3, 172}
    # heavy digests take another way to the same result
    monkeypatch.setattr(S, "HEAVY_ROWS", 3)
    assert set(found(S.repeated_passages(table(spark, rows)))) == want


def test_passages_have_their_real_ends(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 10)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], set()
    for i in range(400):
        p = text(rnd.choice([30, 49, 51, 55, 200]))
        head, tail = "Q " + text(rnd.randrange(1, 60)) + " X", "Y " + text(rnd.randrange(1, 60))
        rows += [(2 * i, f"{text(40)} V{p}W {text(30)}"), (2 * i + 1, f"{head}{p}{tail}")]
        # the first word hangs on a letter that differs
        if len(p.split()) > S.MIN_WORDS:
            want.add((2 * i + 1, len(head), len(head) + len(p), len(p.split()) - 1, 2 * i))
    assert set(found(S.repeated_passages(table(spark, rows)))) == want


def test_passages_within_a_text_and_empty(spark):
    rnd = random.Random(4)
    p = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    assert found(S.repeated_passages(table(spark, [(1, f"A {p} B {p} C")]))) == [(1, len(p) + 4, 2 * len(p) + 6, 60, 1)]
    assert S.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_matches_over_chunks_that_stand_elsewhere_too(spark):
    rnd = random.Random(5)
    p = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    middle = p[800:1500]
    rows = [(1, f"x {middle} y"), (2, f"A {p} B"), (3, f"C {p} D")]
    got = found(S.repeated_passages(table(spark, rows)))
    assert (3, 1, len(p) + 3, 400, 2) in got and np.all([g[0] != 1 for g in got])
