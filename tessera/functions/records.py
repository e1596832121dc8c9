"""Extraction records with nested metadata, built from envelopes, and the review of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the enumerated columns may hold.
METHODS = ("direct_prompt", "internal_skill_api", "langchain_skill")
IMAGE_MODES = ("metadata_only", "vision_llm")
STATUSES = ("pending", "approved", "rejected", "needs_revision")


def _or(name: str, default: object, columns: list[str]) -> Column:
    return (F.coalesce(F.col(name), F.lit(default)) if name in columns else F.lit(default)).alias(name)


def extraction_records(results: DataFrame) -> DataFrame:
    """Envelopes as records: chunk, outcome, and metadata in five parts; what an envelope lacks has its default."""
    have = results.columns
    text = lambda n: (F.col(n) if n in have else F.lit(None)).cast("string").alias(n)
    provenance = F.struct("source_file", _or("source_page", 0, have), F.lit(0).alias("source_line"), _or("source_position", "", have), F.lit("").alias("source_context"), "chunk_id")
    process = F.struct(
        _or("extraction_method", METHODS[0], have), _or("extraction_mode", IMAGE_MODES[0], have), F.to_timestamp(text("extracted_at")).alias("extracted_at"), _or("latency_ms", 0, have), _or("schema_version", "1.0", have),
        _or("prompt_version", "1.0", have).alias("prompt_template_version"),
    )
    model = F.struct(_or("model_name", "", have), _or("model_endpoint", "", have), _or("token_usage_input", 0, have), _or("token_usage_output", 0, have), _or("confidence_score", 0.0, have), text("thinking_content"))
    skill = F.struct(text("skill_name"), text("skill_version"), text("skill_endpoint"), text("raw_response"))
    review = F.struct(_or("validation_status", STATUSES[0], have), text("validator_id"), text("validator_note"), F.lit(None).cast("timestamp").alias("validated_at"))
    metadata = F.struct(provenance.alias("provenance"), process.alias("extraction"), model.alias("model"), skill.alias("skill"), review.alias("human_validation"))
    return results.select("chunk_id", "source_file", _or("source_page", 0, have), _or("source_section", "", have), _or("is_structured", False, have), text("extraction_result"), _or("fallback_text", "", have), metadata.alias("metadata"))


def apply_reviews(records: DataFrame, reviews: DataFrame) -> DataFrame:
    """Records with the latest review of their chunk; reviews: chunk_id, validation_status, validator_id, validator_note, validated_at.

    A status that is none of the four, or a chunk without review, leaves the record as it is.
    """
    known = reviews.where(F.col("validation_status").isin(*STATUSES))
    latest = known.groupBy(F.col("chunk_id").alias("__chunk")).agg(F.max_by(F.struct("validation_status", "validator_id", "validator_note", "validated_at"), "validated_at").alias("__review"))
    joined = records.join(latest, F.col("chunk_id") == F.col("__chunk"), "left")
    return joined.withColumn("metadata", F.col("metadata").withField("human_validation", F.coalesce("__review", "metadata.human_validation"))).drop("__chunk", "__review")
