import io
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import token_output as T
from tessera.runtime import Scratch

TEXTS = ["", None, "a", " a  b", "x <|endoftext|> y", "one two.\nThree, four. \n five", "é ü " * 50, "a  b \t c ", "word, word. Word", "9" * 3000, "trailing ", "\n", "it's  we'll they're 12 34"]


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1400), st.integers(1, 99))
def test_blocks_round_trip(ids, percentile):
    a = np.array(ids, np.uint32)
    blocks = T.pack(a, percentile)
    at = np.cumsum([0, *map(len, blocks)])[:-1].tolist()
    assert np.array_equal(T.unpack(b"".join(blocks), at, [min(T.BLOCK, len(a) - n * T.BLOCK) for n in range(len(blocks))]), a)


def test_file_round_trip(monkeypatch):
    monkeypatch.setattr(T, "FLUSH_TOKENS", 700)
    rnd = np.random.default_rng(1)
    docs = [(i if i % 3 else None, rnd.integers(0, 50257, int(n)).astype("<u4")) for i, n in enumerate([0, 1, 511, 512, 513, 5000, 0, 3, 140_000])]
    buf = io.BytesIO()
    w = T.Writer(buf)
    for i, x in docs:
        w.add(i, x.tobytes())
    w.close()
    got = list(T.read_documents(pa.BufferReader(buf.getvalue())))
    assert [g[0] for g in got] == [d[0] for d in docs] and all(np.array_equal(g[2], d[1]) for g, d in zip(got, docs))
    assert [g[1] for g in got] == np.cumsum([0] + [len(d[1]) for d in docs])[:-1].tolist()


def test_memo_is_the_library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(T.vocabulary())
    rnd = random.Random(2)
    texts = [t or "" for t in TEXTS] + ["".join(rnd.choice("ab .,\n\té1'") for _ in range(80)) for _ in range(300)]
    texts += [" ".join(rnd.choice(["Straße", "été,", "x.\nYa", "WORD!!", "don't", "l'été.", "a###", "ñ\n\nb", "œuvre,", "Ελλ", "9th", "…", "e\u0301a", "ǅ", "ª"]) for _ in range(40)) for _ in range(100)]
    memo = T.WordMemo(T.vocabulary())
    for _ in range(2):
        for t, e in zip(texts, memo.encode(texts)):
            assert np.frombuffer(e, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_query(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(T.vocabulary())
    rows = [(n * 7 % 13, t, 5) for n, t in enumerate(TEXTS)] + [(None, "x", 1), (3, "dup", 1), (3, "dup", 1)]
    got = T.token_output(spark.createDataFrame(rows, "doc_id long, text string, start int")).collect()
    got.sort(key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is None, x)) and len(ids) == len(rows)
    at = 0
    want = {}
    for i, t, _ in rows:
        e = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(i, []).append((len(e), zlib.crc32(e.tobytes())))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    assert T.token_output(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_bad_file():
    with pytest.raises(ValueError):
        list(T.read_documents(pa.BufferReader(bytes(40))))


def test_words_that_come_again_stay_known(monkeypatch):
    monkeypatch.setattr(T, "MEMO_WORDS", 40)
    memo, made = T.WordMemo(T.vocabulary()), []
    tokenize = memo.tokenizer.model.tokenize
    memo.tokenize = lambda w: made.append(w) or tokenize(w)
    for n in range(20):
        memo.encode(["x often again " + " ".join("w" + "abcdefghij"[n % 10] * k + "z" * n for k in range(1, 25))])
    assert [made.count("Ġ" + w) for w in ("often", "again")] == [1, 1]
    assert len(memo.memo) + len(memo.memo.before) < 100


def test_many_small_files_are_listed_in_one_and_read_together(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        scratch = Scratch(spark, "tokens")
        folder = scratch.mkdirs(scratch.folder("files"))
        docs = spark.createDataFrame([(n, f"text {n} " * (n % 5)) for n in range(300)], "doc_id long, text string")
        manifest = T.write_tokens(docs, folder, scratch)
        files = manifest.count()
        assert files > 20 and len(manifest.inputFiles()) == 1
        few = T.read_tokens(manifest, folder)
        assert few.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        monkeypatch.setattr(T, "READ_TOKENS", 1)
        many = T.read_tokens(manifest, folder)
        assert few.rdd.getNumPartitions() < many.rdd.getNumPartitions() <= files
        rows = sorted(few.collect())
        assert rows == sorted(many.collect()) and [r.doc_id for r in rows] == list(range(300))
        assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_packing_takes_little_memory():
    ids = np.random.default_rng(3).integers(0, 50257, 1 << 20).astype("<u4")
    tracemalloc.start()
    blocks = T.pack(ids)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(blocks) == len(ids) // T.BLOCK and most < 32 << 20
