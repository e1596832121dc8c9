import random

import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import connected_components
from tessera.runtime import Scratch

ROWS = [(1, "a b c d e f g"), (2, "A b\tc  d e f g"), (3, None), (4, ""), (5, " \n"), (None, "a b c d e f g"), (1, "a b c d e f g"), (9, "x y"), (7, "é Éa b c d")]


def brute_fp(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    k = min(k, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, diff=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= diff:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def check(spark, rows):
    out = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(i, brute_fp(t)) for i, t in rows]
    comp = brute_components({f for _, f in want})
    least = {}
    for i, f in want:
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, out), key=key) == sorted([(i, f"{f:016x}", least.get(comp[f])) for i, f in want], key=key)


def test_edges(spark):
    check(spark, ROWS)


def test_empty(spark):
    assert simhash.simhash_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_near_copies(spark):
    rnd = random.Random(5)
    rows = []
    for g in range(6):
        base = [rnd.choice("abcdefgh") + str(rnd.randrange(400)) for _ in range(150)]
        for _ in range(40):
            w = list(base)
            for _ in range(rnd.randrange(0, 3)):
                w[rnd.randrange(len(w))] = str(rnd.randrange(1000))
            rows.append((len(rows), " ".join(w)))
    check(spark, rows)


@pytest.mark.parametrize("depth", [2, 3])
def test_links_fingerprints(spark, depth):
    from tessera.runtime import Scratch

    rnd = random.Random(3)
    fps = set()
    for k in range(240):
        a = b = rnd.getrandbits(64)
        for bit in rnd.sample(range(64), k % 6):
            b ^= 1 << bit
        fps |= {a, b}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {}
    for n, r in simhash.link_fingerprints(df, Scratch(spark, "t"), depth=depth).collect():
        got.setdefault(r, set()).add(n & (1 << 64) - 1)
    groups = {}
    for f, r in brute_components(fps).items():
        groups.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_one_of_each(spark):
    rnd = random.Random(8)
    base = [" ".join(rnd.choice("abcdefgh") + str(rnd.randrange(400)) for _ in range(120)) for _ in range(3)]
    rows = [*ROWS, (20, base[0]), (20, base[1]), (21, base[0] + " more"), (22, base[1]), (None, base[2]), (None, base[2]), (None, base[0])]
    df = spark.createDataFrame([(i, t, "f", 1, "k", 2) for i, t in rows], "doc_id long, text string, fp string, id int, __kept string, row int")
    out = simhash.keep_one_of_each(df)
    assert out.columns == df.columns
    comp = brute_components({brute_fp(t) for _, t in rows})
    want = {}
    for i, t in rows:
        g = comp[brute_fp(t)]
        best = min(want.get(g, (True, 0, None)), (i is None, i or 0, t), key=lambda x: (x[2] is None and x[0], x[0], x[1]))
        want[g] = best if g in want else (i is None, i or 0, t)
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
    assert got == sorted((n, i) for n, i, _ in want.values())
    assert simhash.keep_one_of_each(df.limit(0)).collect() == []


def test_components_of_few_edges_write_few_files(spark):
    """Also where Spark leaves empty and small partitions as they are."""
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in held}
    written = []

    class Counted(Scratch):
        def keep(self, df, name):
            out = super().keep(df, name)
            written.append((name, len(out.inputFiles())))
            return out

    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(n, n + 1) for n in range(200) if n % 50], "u long, v long")
        got = {(r.node, r.root) for r in connected_components(edges, Counted(spark, "few")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(n, (n - 1) // 50 * 50 + 1) for n in range(1, 201)}
    assert max(n for name, n in written if name in ("least", "larger")) <= spark.sparkContext.defaultParallelism
