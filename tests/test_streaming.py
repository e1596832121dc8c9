import datetime as dt
import json
import random

from tessera.operators.all_info import all_info
from tessera.streaming import merge_stream as M
from tests.test_merge import FIELDS, fold_document


def test_stream_equals_batch(spark, tmp_path):
    rnd = random.Random(3)
    docs = {f"d{d}": [(f"d{d}_{n}", {"title": rnd.choice(["", "A", "a", "b"]), "tags": [rnd.choice("xyz")], "rooms": [{"name": rnd.choice(["w", "W", "v"]), "width": rnd.choice(["1", "2"])}]}) for n in range(5)] for d in range(6)}
    rows = [(d, n, cid, True, json.dumps(x), 0.5) for d, cs in docs.items() for n, (cid, x) in enumerate(cs)]
    rnd.shuffle(rows)
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    for k in range(3):
        part = rows[k::3] + (rows[:2] if k == 2 else [])  # two arrive twice
        spark.createDataFrame(part, M.CHUNKS).coalesce(1).write.mode("append").parquet(source)
        M.store_chunks(M.read_chunks(spark, source), store, str(tmp_path / "cp")).awaitTermination()
    got = {r.doc: json.loads(r.all_info) for r in M.merge_arrived(spark, store, lambda df: all_info(df, FIELDS)).collect()}
    for d, cs in docs.items():
        want = fold_document(cs)
        want["_stats"] |= {"confidence_min": 0.5, "confidence_avg": 0.5}
        assert got[d] == want
    q = M.running_stats(M.read_chunks(spark, source)).writeStream.outputMode("complete").format("memory").queryName("running").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(r.chunks_merged for r in spark.table("running").collect()) == len(rows)


def test_a_chunk_that_comes_again_replaces_what_it_said(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    for title in ("z first", "a second"):
        rows = [("d", 0, "d_0", True, json.dumps({"title": title}), 0.5), ("d", 1, "d_1", title == "z first", json.dumps({"tags": ["x"]}) if title == "z first" else None, None)]
        spark.createDataFrame(rows, M.CHUNKS).coalesce(1).write.mode("append").parquet(source)
        M.store_chunks(M.read_chunks(spark, source), store, str(tmp_path / "cp")).awaitTermination()
    (r,) = M.merge_arrived(spark, store, lambda df: all_info(df, FIELDS)).collect()
    assert json.loads(r.all_info) == fold_document([("d_0", {"title": "a second", "confidence_score": 0.5}), ("d_1", None)])


def test_running_counts_with_a_watermark(spark, tmp_path):
    schema = M.CHUNKS + ", at timestamp"
    rows = [("d", 0, "d_0", True, "{}", 0.5, dt.datetime(2024, 1, 1)), ("d", 0, "d_0", True, "{}", 0.25, dt.datetime(2024, 1, 1, 1)), ("d", 1, "d_1", False, None, None, dt.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    chunks = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    M.running_stats(chunks, "at").writeStream.outputMode("complete").format("memory").queryName("marked").trigger(availableNow=True).start().awaitTermination()
    assert [(r.chunks_merged, r.chunks_failed) for r in spark.table("marked").collect()] == [(1, 1)]
