"""The document-level merge as grouped aggregates over claims.

A claim is one value that one chunk states for one field:
doc, ci (chunk index), pos (place in the chunk's value), cid (chunk id), field, value (as shown),
fold (its identity), and for entities: anon, key (fold of the identity value), nested, npos.
Order is never that of the rows: every rule takes its first by (ci, pos), which partial aggregates
carry, so any partitioning, retry or arrival order gives the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _ord() -> Column:
    return F.struct("ci", "pos")


def _chunks() -> Column:
    """Chunk ids in order of (ci, pos), one for each claim."""
    return F.transform(F.array_sort(F.collect_list(F.struct("ci", "pos", "cid"))), lambda x: x["cid"]).alias("src")


def list_union(claims: DataFrame) -> DataFrame:
    """doc, field, value, first, src: distinct by exact text; first orders them."""
    return claims.groupBy("doc", "field", "value").agg(F.min(_ord()).alias("first"), _chunks())


def collect_values(claims: DataFrame) -> DataFrame:
    """doc, field, fold, value, first, src: distinct by fold, the first raw form shown."""
    return claims.groupBy("doc", "field", "fold").agg(F.min_by("value", _ord()).alias("value"), F.min(_ord()).alias("first"), _chunks())


def first_non_null(claims: DataFrame) -> DataFrame:
    """doc, field, value, src: the first value, and the chunks that state it in any form."""
    best = F.min_by(F.struct("value", "src"), "first")
    return collect_values(claims).groupBy("doc", "field").agg(best.alias("b")).select("doc", "field", "b.value", "b.src")


def entity_keys(items: DataFrame) -> DataFrame:
    """Anonymous items get a key of their own: their place. Adds akey."""
    return items.withColumn("akey", F.when(F.col("anon"), F.concat_ws("/", "ci", "pos")).otherwise(F.col("key")))


def entities(items: DataFrame) -> DataFrame:
    """doc, field, anon, akey, first, src: one row per entity; items: one row per listed object."""
    return entity_keys(items).groupBy("doc", "field", "anon", "akey").agg(F.min(_ord()).alias("first"), _chunks())


def entity_fields(claims: DataFrame) -> DataFrame:
    """doc, field, anon, akey, nested, value, conflicts: the first value of each nested field, and each later
    one whose fold differs, as (ci, pos, nested_rank, nested, value, cid)."""
    seen = F.array_sort(F.collect_list(F.struct("ci", "pos", "value", "fold", "cid")))
    grouped = entity_keys(claims).groupBy("doc", "field", "anon", "akey", "nested_rank", "nested").agg(seen.alias("seen"))
    head = F.col("seen")[0]
    differ = F.transform(
        F.filter("seen", lambda x: x["fold"] != head["fold"]), lambda x: F.struct(x["ci"].alias("ci"), x["pos"].alias("pos"), F.col("nested_rank"), F.col("nested"), x["value"].alias("value"), x["cid"].alias("cid"))
    )
    return grouped.select("doc", "field", "anon", "akey", "nested_rank", "nested", head["value"].alias("value"), differ.alias("conflicts"))


def entity_conflicts(claims: DataFrame) -> DataFrame:
    """A row per conflict: doc, field, anon, akey, ci, pos, nested_rank, nested, value, cid."""
    return entity_fields(claims).select("doc", "field", "anon", "akey", F.inline("conflicts"))


def entity_lists(claims: DataFrame) -> DataFrame:
    """doc, field, anon, akey, nested, items: the first list as it is; of later ones what is not there yet.

    claims: one row per item's list, values an array of texts as shown, absent ones null.
    """
    seen = F.array_sort(F.collect_list(F.struct("ci", "pos", "values")))
    g = entity_keys(claims).groupBy("doc", "field", "anon", "akey", "nested_rank", "nested").agg(seen.alias("seen"))
    head = F.transform(F.col("seen")[0]["values"], lambda v: F.coalesce(v, F.lit("None")))
    tail = F.flatten(F.transform(F.slice("seen", 2, F.greatest(F.size("seen") - 1, F.lit(0))), lambda x: x["values"]))
    new = F.array_distinct(F.filter(tail, lambda v: v.isNotNull() & (v != "")))
    return g.select("doc", "field", "anon", "akey", "nested_rank", "nested", F.concat(head, F.filter(new, lambda v: ~F.array_contains(head, v))).alias("items"))


def stats(chunks: DataFrame) -> DataFrame:
    """doc, chunks_merged, chunks_failed, confidence_min, confidence_avg; chunks: doc, ok, confidence."""
    c = F.when(F.col("ok"), F.col("confidence"))
    return chunks.groupBy("doc").agg(F.count_if("ok").alias("chunks_merged"), F.count_if(~F.col("ok")).alias("chunks_failed"), F.min(c).alias("confidence_min"), F.avg(c).alias("confidence_avg"))


def run_summary(chunks: DataFrame) -> DataFrame:
    """Successes, mean confidence with missing ones as 0, mean latency over all chunks."""
    return chunks.agg(F.count_if("ok").alias("succeeded"), F.count(F.lit(1)).alias("chunks"), F.avg(F.when(F.col("ok"), F.coalesce("confidence", F.lit(0.0)))).alias("mean_confidence"), F.avg("latency_ms").alias("mean_latency_ms"))
