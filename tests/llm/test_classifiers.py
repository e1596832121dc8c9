import itertools
import random
import zlib

import numpy as np
import pyarrow as pa

from tessera.llm import quality as Q
from tessera.llm import toxicity as T


def corpus(n=500):
    rnd = random.Random(6)
    syll = ["ta", "ri", "no", "sel", "ban", "mor", "ek", "ul"]
    word = lambda: "".join(rnd.choice(syll) for _ in range(rnd.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rnd.randrange(30, 120))]
        bad, toxic = i % 5 == 0, i % 4 == 0
        if bad:
            w = [x + rnd.choice(["###", "$$$"]) for x in w] if i % 2 else [w[0]] * len(w)
        if toxic:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(["grumbus", "vextor"]))
        docs.append((i, " ".join(w), "en", "s"))
        labels.append((i, 0 if bad else 1, 1 if toxic else 0))
    return docs, labels


DOC = "doc_id long, text string, lang string, source string"
LABEL = "doc_id long, quality int, toxic int"
EDGES = [(None, "x", "en", "s"), (9001, None, "en", "s"), (9002, "", "en", "s"), (1, "again", "en", "s"), (9003, "z " * 30_000, "en", "s")]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2


def test_quality(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs + EDGES, DOC)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (99999, 1, 0)], LABEL)
    got = Q.quality_scores(df, lab).collect()
    assert len(got) == len(docs) + len(EDGES) and all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.7) for r in got)
    truth = {i: q for i, q, _ in labels}
    right = [(r.predicted == truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth and r.doc_id != 1]
    assert len(right) > 50 and np.mean(right) > 0.9
    none = Q.quality_scores(df, spark.createDataFrame([], LABEL)).collect()
    assert {r.score for r in none} == {0.5}
    # the stage: columns of any name stay, its decisions are those of the scores
    clash = df.selectExpr("*", "7 AS score", "8 AS __score", "9 AS __text", "10 AS held_out", "text AS __id", "11 AS __u")
    kept = Q.keep_good(clash, lab)
    assert kept.columns == clash.columns
    good = sorted(((r.doc_id, r.score) for r in got if r.predicted), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [i for i, _ in good] and kept.first().score == 7 and kept.first()["__score"] == 8
    assert Q.keep_good(df, spark.createDataFrame([], LABEL)).count() == 0 and Q.keep_good(df, spark.createDataFrame([], LABEL), 0.5).count() == df.count()
    same = Q.quality_scores(clash, lab).collect()
    assert sorted(map(repr, same)) == sorted(map(repr, got))
    assert Q.quality_scores(spark.createDataFrame([], DOC), lab).collect() == []


def test_prior_is_estimated_without_negatives():
    rng = np.random.default_rng(5)
    for prior in (0.2, 0.5, 0.8):
        good = lambda n: rng.normal(1.5, 1, (n, 6))
        bad = rng.normal(-1.5, 1, (round(6000 * (1 - prior)), 6))
        got = Q.estimate_prior(good(3000), np.concatenate([good(round(6000 * prior)), bad]))
        assert abs(got - prior) < 0.06, (prior, got)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = corpus(200)
    df = spark.createDataFrame(docs, DOC)
    turned = [(i, 1 - q, 1 - t) if held(i) else (i, q, t) for i, q, t in labels]
    a, b = (sorted((r.doc_id, r.score) for r in Q.quality_scores(df, spark.createDataFrame(x, LABEL)).collect()) for x in (labels, turned))
    assert a == b


def test_toxicity(spark):
    docs, labels = corpus()
    hidden = [(9100, docs[1][1] + " grumbu5 v3xtor grumbuuus", "en", "s"), (9101, docs[2][1] + " v e x t o r g.r.u.m.b.u.s", "en", "s")]
    df = spark.createDataFrame(docs + EDGES + hidden, DOC)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], LABEL)
    got = T.toxicity_scores(df, lab).collect()
    assert len(got) == len(docs) + len(EDGES) + 2 and all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.3) for r in got)
    truth = {i: t for i, _, t in labels}
    right = [(r.predicted == truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth and r.doc_id != 1]
    assert len(right) > 50 and np.mean(right) > 0.95
    assert all(r.predicted == 1 for r in got if r.doc_id in (9100, 9101))
    assert {r.score for r in T.toxicity_scores(df, spark.createDataFrame([], LABEL)).collect()} == {0.0}
    assert T.toxicity_scores(spark.createDataFrame([], DOC), lab).collect() == []
    clash = df.selectExpr("*", "7 AS score", "9 AS __text", "10 AS held_out", "text AS __id", "text AS w")
    assert sorted(map(repr, T.toxicity_scores(clash, lab).collect())) == sorted(map(repr, got))


def test_symbols_of_other_letters_and_marks():
    assert T.symbols("a?é語ß").tolist() == [1, 0, 28, 28, 28] and T.symbols("a?").tolist() == [1, 0]


def test_scores_against_a_plain_computation(spark):
    """Counts, weights and totals by loops over the texts, from the same restored words."""
    docs, labels = corpus(240)
    lm, weights = T.train(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABEL))
    r = T.Restorer(model_of("\n".join(d[1] for d in docs)))
    n = np.zeros(T.SPACE)
    for _, t, *_ in docs:
        s = [0, 0, 0, *T.symbols(t).tolist(), 0, 0, 0]
        for q in zip(s, s[1:], s[2:], s[3:]):
            n[((q[0] * 30 + q[1]) * 30 + q[2]) * 30 + q[3]] += 1
    codes = np.flatnonzero(n)
    plain = T.language_model(type("Counts", (), {"toArrow": lambda self: pa.table({"code": codes, "n": n[codes]})})())
    assert np.array_equal(lm, plain)
    r, truth = T.Restorer(plain), {i: t for i, _, t in labels if not held(i)}
    words = {i: r.words(t) for i, t, *_ in docs if i in truth}
    n1, n0 = sum(truth.values()), len(truth) - sum(truth.values())
    want = {}
    for k in set().union(*[T.keys_of(w) for w in words.values()]):
        a, b = (sum(k in T.keys_of(words[i]) for i in words if truth[i] == v) for v in (1, 0))
        expect = (a + b) * n1 / len(truth)
        lift = np.log((a + 0.1) / n1) - np.log((b + 0.5) / n0)
        if a >= 4 and lift > 1.1 and (a - expect) / np.sqrt(expect + 1e-9) > 5:
            want[k] = min(lift, 8.0)
    assert weights.weight.keys() == want.keys() and all(abs(weights.weight[k] - x) < 1e-9 for k, x in want.items())


def model_of(text):
    s = np.concatenate([np.zeros(3, np.int64), T.symbols(text), np.zeros(3, np.int64)])
    n = np.zeros(T.SPACE)
    np.add.at(n, ((s[:-3] * T.SYMBOLS + s[1:-2]) * T.SYMBOLS + s[2:-1]) * T.SYMBOLS + s[3:], 1)
    codes = np.flatnonzero(n)
    counts = pa.table({"code": codes, "n": n[codes]})
    return T.language_model(type("Counts", (), {"toArrow": lambda self: counts})())


def test_spelled_runs_of_any_length():
    words = "you are all such grumbus people and nobody wants vextor here today my friend".split()
    r = T.Restorer(model_of(" ".join(words) * 200))
    run = " ".join("".join(words))
    assert len(run) > 80
    assert {"grumbus", "vextor"} <= r.words(run)
    # glued letters before it, and a run with another separator after
    assert {"vextor", "grumbus"} <= r.words("my v e x t o r g.r.u.m.b.u.s") and "vextor" in r.words("a n v e x t o r")
    assert r.words("z " * 30_000) >= {"z"}


def test_heavy_leet_and_drawn_out_words():
    r = T.Restorer(model_of(" ".join(["what an asshole he is", "that idiot should read it", "grumbus and vextor are rude"] * 200)))
    assert "asshole" in r.words("4 455h0l3 here") and "idiot" in r.words("an 1d107 he") and "vextor" in r.words("v3x70r")
    assert "grumbus" in r.words("gr" + "u" * 50 + "mbu5") and "vextor" in r.words("v" * 30 + "e" * 30 + "xtor")
    # every state is kept: as good as trying each reading
    lm = r.lm
    for piece in ("1*8*!|*", "*!*1*|"):
        best = max(itertools.product(*[T._OPTIONS[c] for c in piece]), key=lambda p: score_of(p, lm))
        assert T.decode(piece, lm) == "".join(x for x, _, _ in best)


def score_of(path, lm):
    t, key = 0.0, 0
    for _, cost, s in path:
        key = key * T.SYMBOLS + s
        t, key = t + cost + lm[key], key % T.SYMBOLS**3
    return t + lm[key * T.SYMBOLS]
