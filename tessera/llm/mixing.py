"""Mixing sources to target weights by capped water-filling, all in DataFrame operations.

Sources share the corpus by weight, none above ``max_epochs`` times its own size; the excess is
reshared among the rest. With sources ordered by cap / weight this has a closed form: the water
level is the largest (total - caps before) / (weights from here) that stays below its own ratio.

A source with target t and size s repeats every document floor(t / s) times and takes a seeded
share of them once more. The share is drawn by a 24-bit hash of the row: documents below a cut are
taken, and the cut is where the running size, in order of the hash, comes nearest to the target.
It is found from two histograms of at most 4,096 bins a source, which are aggregated before the
shuffle, so a source with any number of documents needs no sort and no task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.text import spaced_count
from tessera.runtime import Scratch, spread

BROADCAST_SOURCES = 20_000
BINS = 4096


def row_draw(id_col: Column, text: Column, seed: int) -> Column:
    """24 bits that are the same in each run: from the seed, the id and the text."""
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(mark, 1, 6), 16, 10).cast("int")


def water_fill(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """(source, source_size) -> with target. One row a source is all that these windows sort."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.lit(0)
    for i, w in enumerate(weights):
        weight = F.when(F.col("rank") % len(weights) == i, F.lit(w)).otherwise(weight)
    caps = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    up = Window.orderBy("ratio", "rank")
    total = F.sum("source_size").over(Window.partitionBy())
    before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))
    levels = caps.withColumn("level", (total - before).cast("double") / rest)
    level = F.max(F.when(F.col("level") < F.col("ratio"), F.col("level"))).over(Window.partitionBy())
    capped = F.col("level") >= F.col("ratio")
    levels = levels.withColumn("water", level)
    return levels.select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("water")).alias("target"))


def _cut(hist: DataFrame, need: str, key: str) -> DataFrame:
    """Bins with the size before them; need: what is still to be taken from the source."""
    w = Window.partitionBy("source").orderBy(key)
    return hist.withColumn("before", F.sum("words").over(w) - F.col("words"))


def plan_mix(sized: DataFrame, scratch: Scratch, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """sized(source, size, draw) -> (source, source_size, target, whole, cut): rows with draw < cut are taken once more."""
    fine = scratch.keep(sized.groupBy("source", F.shiftright("draw", 12).alias("bin")).agg(F.sum("size").alias("words")), "histogram")
    shares = water_fill(fine.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    shares = shares.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    shares = scratch.keep(shares.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "shares")
    s = shares.select(F.col("source").alias("name"), "need")
    coarse = _cut(fine, "need", "bin").join(s, F.col("source").eqNullSafe(F.col("name")))
    edge = coarse.where((F.col("before") <= F.col("need")) & (F.col("need") < F.col("before") + F.col("words")))
    edge = scratch.keep(edge.select("name", F.col("bin").alias("edge"), F.col("before").alias("base"), "need"), "edge")
    held = F.broadcast(edge) if edge.count() <= BROADCAST_SOURCES else edge
    inside = sized.join(held, F.col("source").eqNullSafe(F.col("name")) & (F.shiftright("draw", 12) == F.col("edge")))
    inside = inside.groupBy("source", "edge", "base", "need", F.col("draw").alias("bin")).agg(F.sum("size").alias("words"))
    taken = _cut(inside, "need", "bin").where(F.col("base") + F.col("before") + F.col("words") / 2 <= F.col("need"))
    cut = taken.groupBy(F.col("source").alias("s2")).agg((F.max("bin") + 1).alias("inner"))
    ends = edge.join(cut, F.col("name").eqNullSafe(F.col("s2")), "left").select("name", F.coalesce("inner", F.col("edge") * BINS).alias("cut"))
    # no bin holds the cut: nothing is needed, or every word is
    out = shares.join(ends, F.col("source").eqNullSafe(F.col("name")), "left")
    return scratch.keep(out.select("source", "source_size", "target", "whole", F.coalesce("cut", F.when(F.col("need") > 0, F.lit(BINS * BINS)).otherwise(0)).cast("int").alias("cut")), "plan")


def mix(
    documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 42, id_col: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(row, size, source_size, target, reps): the document row as a struct, and how often the mix takes it.

    Texts that are null have size 0. A null source is a source of its own and the last one. Rows that
    are equal in id and text are drawn together. A source whose texts hold no words has target 0. With
    no words at all, every target is 0; an empty table gives an empty one. Other columns may have any names.
    """
    scratch = Scratch(documents.sparkSession, "mix")
    documents = spread(documents)
    size, draw = spaced_count(F.col(f"`{text}`")), row_draw(F.col(f"`{id_col}`"), F.col(f"`{text}`"), seed)
    sized = documents.select(F.col(f"`{source}`").alias("source"), size.alias("size"), draw.alias("draw"))
    plan = plan_mix(sized, scratch, weights, max_epochs)
    held = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(f"`{source}`").alias("of"), size.alias("size"), draw.alias("draw"))
    joined = rows.join(held, F.col("of").eqNullSafe(F.col("source")))
    return joined.select("row", "size", "source_size", "target", (F.col("whole") + F.when(F.col("draw") < F.col("cut"), 1).otherwise(0)).alias("reps"))


def mix_report(documents: DataFrame, **params) -> DataFrame:
    """One row per document row: id, size, source_size, target, taken."""
    names = {k: params.get(k, v) for k, v in (("id_col", "doc_id"), ("text", "text"), ("source", "source"))}
    lean = documents.select(*dict.fromkeys(names.values()))
    out = mix(lean, **params)
    return out.select(F.col(f"row.`{names['id_col']}`").alias(names["id_col"]), "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken"))


def mixed_documents(documents: DataFrame, **params) -> DataFrame:
    """The mix itself: every document row as often as it is taken, all columns as they are, whatever their names.

    A source of which nothing is wanted or that holds no words gives no rows; null texts count as in ``mix``.
    """
    out = mix(documents, **params).where("reps > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "reps"))).select("row.*")
