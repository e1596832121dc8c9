import hashlib
import random
import re

import pytest

from tessera.llm import decontaminate as D


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            x = words(text)
            n = min(window, len(x))
            for s in range(len(x) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == x[s : s + n]:
                        hit |= set(range(p, p + n))
                        found |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def tables(seed):
    rnd = random.Random(seed)
    w = lambda n: " ".join(rnd.choice(["the", "of", "and", "Ein", "été", "x1", "two", "a"]) for _ in range(n))
    items = [(1, w(14)), (2, w(10)), (10, w(3)), (11, "the"), (5, None), (6, "..."), (7, w(25)), (None, w(12)), (9, "rare words never seen in any document at all here")]
    items.append((12, items[0][1]))
    docs = [(k, w(rnd.randrange(0, 80))) for k in range(30)]
    docs += [(100 + k, w(20) + ", " + (t or "") + "! " + w(20) + " " + (t or "").upper()) for k, (_, t) in enumerate(items)]
    docs += [(200, None), (201, ""), (None, docs[-1][1]), (3, docs[3][1]), (3, docs[4][1]), (202, "the " * 3000)]
    return docs, items


@pytest.mark.parametrize("limit", [D.BROADCAST_WINDOWS, 0])
def test_against_brute_force(spark, limit):
    docs, items = tables(1)
    d = spark.createDataFrame([(*r, "w", 1, 2, "r") for r in docs], "doc_id long, text string, w string, id int, __id int, row string")
    b = spark.createDataFrame(items, "item_id long, text string")
    key = lambda r: repr(tuple(r))
    got = D.decontaminate(d, b, broadcast_windows=limit).drop("spans").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs, items), key=key)
    clean = [r for r, x in zip(docs, brute(docs, items)) if not x[5]]
    if limit:
        left = D.remove_contaminated(d, b)
        assert left.columns == d.columns and sorted((tuple(r)[:2] for r in left.collect()), key=key) == sorted(clean, key=key)


def test_empty(spark):
    d, b = "doc_id long, text string", "item_id long, text string"
    assert D.decontaminate(spark.createDataFrame([], d), spark.createDataFrame([(1, "a b")], b)).collect() == []
    r = D.decontaminate(spark.createDataFrame([(1, "a b")], d), spark.createDataFrame([], b)).collect()
    assert [(x.n_words, x.n_hit, x.contaminated) for x in r] == [(2, 0, False)]
    assert D.remove_contaminated(spark.createDataFrame([], d), spark.createDataFrame([(1, "a b")], b)).collect() == []
    assert D.remove_contaminated(spark.createDataFrame([(None, "a b"), (1, None)], d), spark.createDataFrame([], b)).count() == 2
