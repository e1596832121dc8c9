"""Benchmark decontamination by a prefix-filtered set join on word shingles.

An item's windows are its runs of ``window`` words (an item of fewer words is one window). A
window is a set of short shingles, ordered by how rare they are in the documents. To occur, all of
them must be there, so one prefix token, the rarest, is enough to find every place; a window with
a shingle that no document holds can't occur and is dropped. A place found must leave room for the
window before and after the token (positional and length bounds), and is then compared word by
word. All of it is DataFrame operations; document words are split, shingled, joined and verified
in one pass without a shuffle, and only real occurrences are grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import row_key, words_of
from tessera.runtime import Scratch, spread

SHINGLE = 3
#: Windows of this many rows at most are broadcast; beyond it, tokens are joined by a shuffle.
BROADCAST_WINDOWS = 200_000


def _token(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)])


def item_windows(benchmark: DataFrame, window: int, item_id: str, text: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, toks, len), and (wid, item) of the items (as strings, no nulls) that hold them."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), words_of(F.col(f"`{text}`")).alias("w")).where(F.size("w") > 0)
    at = items.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))).alias("s"))
    toks = at.select("item", F.slice("w", F.col("s"), window).alias("toks"))
    name = F.struct(F.xxhash64("toks").alias("a"), F.xxhash64(F.lit(1), "toks").alias("b"))
    held = scratch.keep(toks.select(name.alias("wid"), "toks", "item"), "windows")
    windows = held.groupBy("toks").agg(F.first("wid").alias("wid")).withColumn("len", F.size("toks"))
    return windows, held.where("item is not null").select("wid", "item").distinct()


def _document_tokens(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """docs(id, key, w): a row per position and shingle size; position -1 stands once for the document itself."""
    at = docs.select("*", F.explode(F.sequence(F.lit(-1), F.size("w") - F.lit(1))).alias("i"))
    if len(sizes) == 1:
        return at.withColumn("token", F.when(F.col("i") >= 0, _token(F.col("w"), F.col("i"), sizes[0])))
    at = at.select("*", F.explode(F.when(F.col("i") < 0, F.array(F.lit(0))).otherwise(F.array(*[F.lit(k) for k in sizes]))).alias("k"))
    token = F.lit(None).cast("long")
    for k in sizes:
        token = F.when(F.col("k") == k, _token(F.col("w"), F.col("i"), k)).otherwise(token)
    return at.withColumn("token", token).drop("k")


def find_windows(docs: DataFrame, windows: DataFrame, scratch: Scratch, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """docs(id, key, w) -> (id, key, n_words, s, e, wid): one row with null s for each document row and one per occurrence."""
    size = F.least("len", F.lit(SHINGLE))
    token = F.lit(None).cast("long")
    for k in range(1, SHINGLE + 1):
        token = F.when(F.col("k") == k, _token(F.col("toks"), F.col("o"), k)).otherwise(token)
    shingles = windows.select("*", size.alias("k")).select("*", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("k"))).alias("o")).withColumn("token", token)
    shingles = scratch.keep(shingles, "shingles")
    stats = shingles.agg(F.collect_set("k").alias("sizes"), F.count(F.lit(1)).alias("n")).first()
    sizes, small = sorted(stats["sizes"]) or [SHINGLE], stats["n"] <= broadcast_windows
    held = F.broadcast if small else lambda x: x

    asked = shingles.select("token").distinct()
    lean = _document_tokens(docs, sizes).where("token is not null")
    common = lean.select("token").join(held(asked), "token").groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    ranked = shingles.join(common, "token", "left").groupBy("toks").agg(
        F.first("wid").alias("wid"), F.first("len").alias("len"), F.count("freq").alias("there"), F.count(F.lit(1)).alias("of"), F.min(F.struct("freq", "token", "o")).alias("rarest")
    )
    prefix = ranked.where("there = of").select("toks", "wid", "len", F.col("rarest.o").alias("o"), F.col("rarest.token").alias("token"))
    prefix = scratch.keep(prefix, "prefixes")
    first = F.col("i") - F.col("o")
    fits = (first >= 0) & (first + F.col("len") <= F.size("w"))
    same = F.slice("w", F.when(fits, first + 1).otherwise(1), F.when(fits, F.col("len")).otherwise(0)) == F.col("toks")
    shown = ["id", "key", F.size("w").cast("long").alias("n_words")]
    if small:
        met = _document_tokens(docs, sizes).join(F.broadcast(prefix), "token", "left")
        return met.where((F.col("i") < 0) | (F.col("toks").isNotNull() & fits & same)).select(
            *shown, F.when(F.col("i") >= 0, first).alias("s"), F.when(F.col("i") >= 0, first + F.col("len")).alias("e"), F.when(F.col("i") >= 0, F.col("wid")).alias("wid")
        )
    # a large benchmark: tokens travel without their documents, which are joined to the places found
    places = lean.select("id", "key", "i", "token").join(prefix, "token").drop("token")
    texts = docs.dropDuplicates(["id", "key"]).select(F.col("id").alias("id2"), F.col("key").alias("key2"), "w")
    placed = places.join(texts, F.col("id").eqNullSafe(F.col("id2")) & (F.col("key") == F.col("key2"))).where(fits & same)
    found = placed.select(*shown, first.alias("s"), (first + F.col("len")).alias("e"), "wid")
    none = F.lit(None)
    return docs.select(*shown, none.cast("int").alias("s"), none.cast("int").alias("e"), none.cast("struct<a:bigint,b:bigint>").alias("wid")).union(found)


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """One row per document row: id, n_words, n_hit, n_items, items_sha256, contaminated and the hit spans.

    Texts that are null hold no words; items without words have no windows. Ids may be null or
    repeat: rows are told apart by id and text, and equal rows each return a row. Items without an
    id mark words but are not counted. With no documents or items the result is empty or clean.
    """
    scratch = Scratch(documents.sparkSession, "decontaminate")
    windows, holders = item_windows(benchmark, window, item_id, item_text, scratch)
    found = scratch.keep(find_windows(_worded(documents, id_col, text), windows, scratch, broadcast_windows), "found")
    rows = found.groupBy("id", "key").agg(F.max("n_words").alias("n_words"), F.count_if(F.col("s").isNull()).alias("copies"), F.array_sort(F.collect_set(F.when(F.col("s").isNotNull(), F.struct("s", "e")))).alias("spans"))
    # items are named only where windows were found, once a document and window
    hits = found.where("s is not null").select("id", "key", "wid").distinct()
    named = hits.join(holders, "wid").groupBy(F.col("id").alias("i"), F.col("key").alias("k")).agg(F.array_sort(F.collect_set("item")).alias("items"))
    rows = rows.join(named, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    start = F.struct(F.lit(0).cast("int").alias("to"), F.lit(0).cast("long").alias("n"))
    step = lambda a, x: F.struct(F.greatest(a["to"], x["e"]).alias("to"), (a["n"] + F.greatest(x["e"] - F.greatest(a["to"], x["s"]), F.lit(0))).alias("n"))
    n_hit = F.when(F.size("spans") == 0, F.lit(0).cast("long")).otherwise(F.aggregate("spans", start, step, lambda a: a["n"]))
    out = rows.select("id", "n_words", "copies", "spans", n_hit.alias("n_hit"), "items", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans"
    )


def _worded(documents: DataFrame, id_col: str, text: str) -> DataFrame:
    rows = spread(documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t")))
    return rows.select("id", row_key(F.col("t")).alias("key"), words_of(F.col("t")).alias("w"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The document rows that hold no window of any item; all columns as they are, whatever their names.

    Null and empty texts hold no window and stay, as do all rows if there are no items. Ids may be null or repeat:
    a row goes for what its own text holds. An empty table gives an empty result.
    """
    scratch = Scratch(documents.sparkSession, "decontaminate")
    windows, _ = item_windows(benchmark, window, "item_id", "text", scratch)
    found = find_windows(_worded(documents, id_col, text), windows, scratch)
    bad = scratch.keep(found.where("s is not null").select("id", "key.a", "key.b").distinct(), "contaminated").alias("x")
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")).alias("d")
    key = row_key(F.col(f"d.row.`{text}`"))
    same = F.col(f"d.row.`{id_col}`").eqNullSafe(F.col("x.id")) & (key["a"] == F.col("x.a")) & (key["b"] == F.col("x.b"))
    return packed.join(bad, same, "left_anti").select("row.*")
