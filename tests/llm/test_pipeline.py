import zlib

import duckdb
import pyarrow as pa

import corpus_pipeline as C
from tessera import runtime
from tessera.llm import quality
from tessera.llm.queries import OP6_SQL, OP7_SQL
from tessera.llm.token_output import vocabulary
from tests.llm.test_simhash import brute_components, brute_fp

SCHEMA = "doc_id long, text string, lang string, source string"


def sql(query, **tables):
    c = duckdb.connect()
    for name, t in tables.items():
        c.register(name, t)
    return c.sql(query).fetchall()


def test_stages_and_result(spark):
    """Every stage after the classifier from a plain computation: fingerprints pair by pair, SQL, the tokenizers library."""
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "mix_sources", "token_files"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r.doc_id for r in quality.quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect() if r.score >= 0.7}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in good}
    fps = {i: brute_fp(r.text) for i, r in rows.items()}
    comp = brute_components(set(fps.values()))
    least = {}
    for i in sorted(rows):
        least.setdefault(comp[fps[i]], i)
    rows = {i: rows[i] for i in least.values()}
    table = lambda: pa.table({c: [rows[i][c] for i in sorted(rows)] for c in ("doc_id", "text", "source")})
    bad = {r[0] for r in sql(OP6_SQL, documents=table(), benchmark=spark.read.parquet(f"{sf}/benchmark.parquet").toArrow()) if r[5]}
    assert bad
    rows = {i: r for i, r in rows.items() if i not in bad}
    reps = {i: taken // size if size else 0 for i, size, _, _, taken in sql(OP7_SQL, documents=table())}
    encode = Tokenizer.from_file(vocabulary()).encode
    want, at = [], 0
    for i in sorted(rows):
        ids = [*encode(rows[i].text, add_special_tokens=False).ids, 2]
        for _ in range(reps[i]):
            want.append((i, at, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
            at += len(ids)
    assert [tuple(r)[:4] for r in C.run(spark, sf).orderBy("start").collect()] == want and len(want) > 50


def saved(spark, folder, docs, labels, items):
    for name, rows, schema in (("documents", docs, SCHEMA + ", __size int, __n int, __id int, __kept int, score int, row int"), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_edges(spark, tmp_path):
    extra = (1, 2, 3, 4, 5, 6)
    prose = lambda k: " ".join(f"word{(k * 37 + j * j) % 211} and" for j in range(90)) + "."
    docs = [(k, prose(k), "en", "s", *extra) for k in range(60)] + [(100 + k, "# # # #" * 40, "en", "s", *extra) for k in range(40)]
    docs += [(None, prose(7), "en", None, *extra), (200, None, None, "s", *extra), (201, "", "en", "s", *extra), (3, prose(3), "en", "s", *extra), (3, prose(99), "en", "t", *extra), (202, prose(5) * 300, "en", "s", *extra)]
    labels = [(k, 1, 0) for k in range(60)] + [(100 + k, 0, 0) for k in range(40)]
    items = [(1, prose(11)), (None, "no such words anywhere"), (2, None)]
    got = C.run(spark, saved(spark, f"file://{tmp_path}/a", docs, labels, items)).collect()
    ids = [r.doc_id for r in got]
    assert 11 not in ids and {1, 2, 4} <= set(ids) and all(r.n_tokens > 0 for r in got)
    # no labels: no row reaches the threshold; empty tables: nothing
    assert C.run(spark, saved(spark, f"file://{tmp_path}/b", docs, [], items)).collect() == []
    assert C.run(spark, saved(spark, f"file://{tmp_path}/c", [], labels, [])).collect() == []
    # each stage keeps the columns whatever their names
    frame = spark.read.parquet(f"file://{tmp_path}/a/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, frame, f"file://{tmp_path}/a")
        assert out.columns == frame.columns, name
        assert {tuple(r)[4:] for r in out.collect()} == {extra}, name


def test_batches_of_texts_are_small(spark):
    """What goes to Python at once is bounded by bytes, also where rows are long; a bound that the session sets stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    def largest():
        runtime.ship_package(spark)
        return max(r.n for r in spark.range(0, 3000, 1, 1).selectExpr("repeat('word ', 2000) AS text").mapInArrow(sizes, "n long").collect())

    spark.conf.unset(key)
    assert largest() < runtime.BATCH_BYTES + (1 << 20)
    try:
        spark.conf.set(key, 16 << 20)
        assert largest() > 15 << 20
    finally:
        spark.conf.unset(key)
