from datetime import datetime

from tessera.functions import records as R
from tessera.operators import extract as E
from tessera.sources import sinks


def test_records_and_reviews(spark):
    rows = [("d", f"c{n}", "f.docx", 1, "s", "p", n, n == 0, '{"a": 1}' if n == 0 else None, "", "direct_prompt", "metadata_only", "2024-01-02T03:04:05+00:00", 5, "m", "e", 1, 2, 0.5, "", "1.2", "1.1", "pending", None, None, 0.5) for n in range(3)]
    records = R.extraction_records(spark.createDataFrame(rows, "doc string, " + E.ENVELOPE))
    r = records.first()
    assert r.metadata.model.model_name == "m" and r.metadata.human_validation.validation_status == "pending" and r.metadata.extraction.extracted_at is not None
    reviews = [("c0", "approved", "v", None, datetime(2024, 1, 1)), ("c0", "rejected", "w", "no", datetime(2024, 1, 3)), ("c1", "maybe", "v", None, datetime(2024, 1, 1))]
    out = R.apply_reviews(records, spark.createDataFrame(reviews, "chunk_id string, validation_status string, validator_id string, validator_note string, validated_at timestamp"))
    assert {x.chunk_id: x.metadata.human_validation.validation_status for x in out.collect()} == {"c0": "rejected", "c1": "pending", "c2": "pending"}


def test_malformed_lines_are_skipped(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"chunk_id": "a", "is_structured": true}\n{broken\n{"chunk_id": "b"}\n')
    got = sinks.read_results(spark, str(tmp_path / "r.json"))
    assert sorted(r.chunk_id for r in got.collect()) == ["a", "b"]
    assert E.structured(got).count() == 1 and E.unstructured(got).count() == 1
