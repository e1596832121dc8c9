import math
import random
import tracemalloc

import numpy as np

from tessera.llm import embedding_dedup as E


def brute(rows, cosine):
    """Links and components over all pairs."""
    unit = []
    for i, v, lab in rows:
        ok = lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k in range(n):
        if rows[k][0] is not None:
            least[find(k)] = min(rows[k][0], least.get(find(k), rows[k][0]))
    return sorted(((rows[k][0], links[k], least.get(find(k)), rows[k][0] is not None and rows[k][0] == least.get(find(k))) for k in range(n)), key=repr)


def test_against_brute_force(spark):
    rnd = np.random.default_rng(5)
    rows = [(int(i), rnd.normal(size=16).tolist(), int(i) % 2) for i in range(120)]
    for c in range(6):
        centre = rnd.normal(size=16)
        rows += [(1000 + c * 100 + k, (centre + 0.08 * rnd.normal(size=16)).tolist(), 1) for k in range(25)]
    rows += [(2000 + k, rows[130][1], 1) for k in range(40)] + [(130, rows[130][1], 1), (None, rows[131][1], 1)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 16, 1), (3003, [None] + [1.0] * 15, 1), (3004, [float("nan")] * 16, 1), (3005, [float("inf")] * 16, 1), (3006, rows[0][1], None), (3007, [1.0, 2.0], 1), (3008, [2.0, 4.0], 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, name string")
    for params in ({}, {"list_rows": 16, "vectors_per_pivot": 8}):
        got = sorted((tuple(r) for r in E.embedding_dedup(df, **params).collect()), key=repr)
        want = brute(rows, 0.93)
        exact, found = sum(r[1] for r in want), sum(r[1] for r in got)
        assert found >= 0.95 * exact and all(g[1] <= w[1] for g, w in zip(got, want))
        assert [g[0] for g in got] == [w[0] for w in want]
        if found == exact:
            assert got == want


def test_empty(spark):
    assert E.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_pivot_search_holds_few_cosines():
    rnd = np.random.default_rng(2)
    x, pivots = rnd.normal(size=(4000, 8)), rnd.normal(size=(8192, 8))
    tracemalloc.start()
    near = E.nearest_pivots(x, pivots, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 128 << 20, peak  # all cosines at once are 262 MB, and as much again for each copy
    some = rnd.permutation(4000)[:50]
    assert np.array_equal(near[some], np.argsort(-(x[some] @ pivots.T), axis=1)[:, :5])


def test_rounds_lengths_and_large_clusters(spark, monkeypatch):
    monkeypatch.setattr(E, "ROUND_BYTES", 20_000, raising=False)
    monkeypatch.setattr(E, "PAIRS", 500, raising=False)
    rnd = np.random.default_rng(8)
    rows = [(int(i), rnd.normal(size=6 + i % 2).tolist(), int(i) % 3) for i in range(200)]
    centre = rnd.normal(size=24)
    rows += [(1000 + k, (centre + 0.02 * rnd.normal(size=24)).tolist(), 7) for k in range(300)]
    rows += [(5000 + k, [1.0 + k, 2.0], 100 + k) for k in range(40)] + [(6000, [1e-300, 0.0], 1), (6001, [1e300, 0.0], 1)]
    got = sorted((tuple(r) for r in E.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()), key=repr)
    assert got == brute([r for r in rows if r[0] < 6000] + [(6000, [1.0, 0.0], 1), (6001, [1.0, 0.0], 1)], 0.93)
