import random

import pytest

from tessera.llm import mixing as M


def water(sizes, weights, cap=3):
    """Resharing round by round."""
    target, open_, left = {}, dict(sizes), float(sum(sizes.values()))
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if weights[s] * unit >= cap * sizes[s]]
        if not over:
            return target | {s: weights[s] * unit for s in open_}
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            del open_[s]
    return target


def test_mix(spark):
    rnd = random.Random(4)
    rows = [(k, " ".join("w" * rnd.randrange(1, 60)), s, 1) for s, n in (("a", 5), ("b", 400), ("c", 900), ("d", 300), ("é", 60), (None, 200)) for k in range(n)]
    rows += [(7, None, "c", 1), (8, "", "empty", 1), (None, "x y", "d", 1), (None, "x y", "d", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(7)
    got = M.mix_report(df).collect()
    assert len(got) == len(rows)
    full = M.mix(df).collect()
    sizes, taken = {}, {}
    for r in full:
        sizes[r.row.source] = sizes.get(r.row.source, 0) + r["size"]
        taken[r.row.source] = taken.get(r.row.source, 0) + r["size"] * r["reps"]
        assert r["reps"] <= 3
    order = sorted([s for s in sizes if s is not None]) + [None]
    target = water(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    for r in full:
        assert r["target"] == pytest.approx(target[r.row.source]) and r["source_size"] == sizes[r.row.source]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 60
    again = M.mix_report(df.repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    clash = df.selectExpr("*", "7 AS __size", "8 AS __n", "9 AS reps", "'r' AS row", "10 AS draw", "11 AS target")
    copies = M.mixed_documents(clash)
    rows = copies.collect()
    assert copies.columns == clash.columns and len(rows) == sum(r["reps"] for r in full)
    assert {(r["__size"], r["__n"], r["reps"], r["row"], r["draw"], r["target"], r["size"]) for r in rows} == {(7, 8, 9, "r", 10, 11, 1)}
    assert sorted(map(tuple, M.mix_report(clash).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_empty(spark):
    schema = "doc_id long, text string, source string"
    assert M.mix_report(spark.createDataFrame([], schema)).collect() == [] and M.mixed_documents(spark.createDataFrame([], schema)).collect() == []
    r = M.mix_report(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema)).collect()
    assert [(x.target, x.taken) for x in r] == [(0.0, 0), (0.0, 0)]
