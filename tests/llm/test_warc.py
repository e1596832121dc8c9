import base64
import hashlib
import io
import random
import struct

import pytest

from tessera.llm import warc


def test_archive_of_many_records():
    rnd = random.Random(1)
    recs = [warc.record(i, f"http://x/{i}", (" ".join(rnd.choice(["alpha", "beta", "<p>"]) for _ in range(rnd.randrange(900)))).encode(), None) for i in range(900)]
    for part in (recs, recs[:3], []):
        out = io.BytesIO()
        w = warc.ArchiveWriter(out)
        for r in part:
            w.add(r)
        w.close()
        assert out.getvalue()[:4] == b"\x5d\x2a\x4d\x18"
        assert list(warc.read_records(io.BytesIO(out.getvalue()))) == part


def dictionary(recs):
    out = io.BytesIO()
    w = warc.ArchiveWriter(out)
    for r in recs:
        w.add(r)
    w.close()
    data = out.getvalue()
    assert list(warc.read_records(io.BytesIO(data))) == recs
    n = struct.unpack("<I", data[4:8])[0]
    return data[8 : 8 + n]


def test_dictionaries_are_built_from_records_however_few():
    rnd = random.Random(2)
    text = lambda n: " ".join(rnd.choice("alpha beta gamma delta <p> </p>".split()) + str(rnd.randrange(50)) for _ in range(n)).encode()
    one = warc.record(1, "http://x/1", b"abc", None)
    assert dictionary([one]) == one  # too little to train on: its own bytes
    few = [warc.record(i, f"http://x/{i}", text(400), None) for i in range(3)]
    assert dictionary(few)[:4] == b"\x37\xa4\x30\xec"
    assert dictionary([warc.record(1, "http://x/1", text(600_000), None)])[:4] == b"\x37\xa4\x30\xec"
    assert dictionary([warc.record(1, "u", b"z" * 3_000_000, None)])


def test_query_against_brute_force(spark):
    rnd = random.Random(3)
    payloads = ["", None, *("".join(rnd.choice("<p>é日 abc") for _ in range(rnd.randrange(1, 300))) for _ in range(40))]
    rows = [(i, f"http://x/{i}", rnd.choice(payloads), 1) for i in range(500)]
    got = warc.archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, digest int")).collect()
    want, latest = [], {}
    for i, _, h, _ in rows:
        latest[h or ""] = max(i, latest.get(h or "", i))
    for i, _, h, _ in rows:
        p = (h or "").encode()
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), *(("response", None) if latest[h or ""] == i else ("revisit", latest[h or ""]))))
    assert sorted(map(tuple, got)) == want and sum(w[3] == "revisit" for w in want) > 400


def test_a_changed_payload_is_found():
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", b"abc", None).replace(b"abc", b"abd"))


def test_query(spark):
    rows = [(1, "u1", "same", 0), (5, "u5", "same", 0), (5, "u5", "same", 0), (3, "u\r\n3", None, 0), (2, None, "", 0), (9, "u9", "é" * 40_000, 0), (None, "n", "same", 0), (None, "n", "same", 0), (7, "a", "x", 0), (7, "a", "y", 0), (4, "b", "y", 0)]
    got = warc.archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, id int")).collect()
    seen = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=repr)
    want = [(1, 4, "revisit", 5), (5, 4, "response", None), (5, 4, "revisit", 5), (3, 0, "response", None), (2, 0, "revisit", 3), (9, 80_000, "response", None), (None, 4, "response", None), (None, 4, "response", None)]
    want += [(7, 1, "response", None), (7, 1, "response", None), (4, 1, "revisit", 7)]
    assert seen == sorted(want, key=repr)
    assert {r.payload_digest for r in got if r.payload_bytes == 0} == {"3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"}
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
