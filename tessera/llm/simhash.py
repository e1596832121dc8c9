"""SimHash near-duplicates, found by pigeonring chains of fingerprint segments.

A 64-bit fingerprint is a ring of five segments. If two fingerprints differ in at most four bits,
some segment starts a chain in which the first k segments differ in at most floor(4k/5) bits for
every k: 0, 1, 2, 3, 4. The index holds, per fingerprint and start, the exact first segment with any
two of the four halves of the next two segments (two differences leave two halves untouched), so
every pair that can pass shares a key of about 26 bits. From ``DEEP_FROM`` fingerprints on, it takes
any three of the six halves of the next three segments, about 32 bits, so that buckets stay small.
Pairs are pruned by the chain budgets before the full Hamming check.

Copies share a fingerprint and are one node. Within a bucket, members are first tested against a
few pivots, which is linear in the bucket; only members of buckets that still hold several
components are then compared across components, so tight groups never expand into all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import connected_components
from tessera.llm.text import row_key
from tessera.runtime import Scratch, ship_package, spread

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SHINGLE_BLOCK = 1 << 15
PIVOTS = 4
#: Fingerprints from which the index takes longer keys.
DEEP_FROM = 1 << 30


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a text: bit b is set if over half of its shingles' XXH64 have it set; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    n = len(words) - k + 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, n, SHINGLE_BLOCK):
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[a : a + SHINGLE_BLOCK], stops[a : a + SHINGLE_BLOCK])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little", signed=True)


def add_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, seed: int = 42, out: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all but the text if not given) and the fingerprint as a signed 64-bit integer."""
    ship_package(docs.sparkSession)
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add(out, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t, shingle, seed) for t in b.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], fps], names=[*keep, out])

    return src.mapInArrow(run, schema)


def segments(max_diff: int = 4) -> list[tuple[int, int]]:
    """(shift, width) of the ring's segments: one more than the differences allowed, three at least."""
    m = max(max_diff + 1, 3)
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _bits(fp: Column, shift: int, width: int) -> Column:
    x = F.shiftrightunsigned(fp, shift) if shift else fp
    return x.bitwiseAND(F.lit((1 << width) - 1))


def _choices(max_diff: int, depth: int) -> list[tuple[int, ...]]:
    """Which halves of the ``depth`` segments after the first are exact: as many as the chain's budget leaves untouched."""
    m = len(segments(max_diff))
    budget = (depth + 1) * max_diff // m
    return list(combinations(range(2 * depth), max(2 * depth - budget, 0)))


def index_keys(fp: Column, max_diff: int = 4, depth: int = 2) -> Column:
    """Keys under which a fingerprint is indexed: chain start and choice, first segment, exact halves of the next ones."""
    segs = segments(max_diff)
    choices = _choices(max_diff, depth)
    keys = []
    for i, (shift, width) in enumerate(segs):
        halves = []
        for k in range(1, depth + 1):
            s, w = segs[(i + k) % len(segs)]
            halves += [(s, w // 2), (s + w // 2, w - w // 2)]
        for c, chosen in enumerate(choices):
            key = _bits(fp, shift, width)
            for h in chosen:
                key = F.shiftleft(key, halves[h][1]).bitwiseOR(_bits(fp, *halves[h]))
            keys.append(F.lit((len(choices) * i + c) << 48).bitwiseOR(key))
    return F.array(*keys)


def chain_start(key: Column, max_diff: int = 4, depth: int = 2) -> Column:
    return F.floor(F.shiftright(key, 48) / len(_choices(max_diff, depth))).cast("int")


def within(a: Column, b: Column, start: Column, max_diff: int = 4) -> Column:
    """Chain budgets from the segment in which the pair met, then the full Hamming distance."""
    x = a.bitwiseXOR(b)
    segs = segments(max_diff)
    m = len(segs)
    chains = F.lit(False)
    for i in range(m):
        ok, total = F.lit(True), None
        for k in range(1, m):
            d = F.bit_count(_bits(x, *segs[(i + k - 1) % m]))
            total = d if total is None else total + d
            ok = ok & (total <= k * max_diff // m)
        chains = F.when(start == i, ok).otherwise(chains)
    return chains & (F.bit_count(x) <= max_diff)


def link_fingerprints(fps: DataFrame, scratch: Scratch, max_diff: int = 4, depth: int | None = None) -> DataFrame:
    """Distinct fingerprints (column fp) -> (node, root): those with links, under their smallest member."""
    depth = depth or (3 if fps.count() >= DEEP_FROM else 2)
    start = chain_start(F.col("key"), max_diff, depth)
    keys = fps.select("fp", F.explode(index_keys(F.col("fp"), max_diff, depth)).alias("key"))
    keys = scratch.keep(keys, "index")
    picks = [F.min(F.struct(F.xxhash64("fp", F.lit(r)).alias("h"), F.col("fp"))).getField("fp").alias(f"p{r}") for r in range(PIVOTS)]
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *picks).where("n > 1")
    posted = scratch.keep(keys.join(buckets, "key"), "posted")
    scratch.drop(keys)
    fits = [within(F.col("fp"), F.col(f"p{r}"), start, max_diff) & (F.col("fp") != F.col(f"p{r}")) for r in range(PIVOTS)]
    hits = F.array_compact(F.array(*[F.when(ok, F.col(f"p{r}")) for r, ok in enumerate(fits)]))
    near = scratch.keep(posted.select(F.col("fp").alias("u"), F.explode(F.array_distinct(hits)).alias("v")).distinct(), "near")
    comp = connected_components(near, scratch)
    tagged = posted.where("n > 2").select("key", "fp").join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("comp"))
    tagged = scratch.keep(tagged, "tagged")
    mixed = tagged.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key")
    rest = scratch.keep(tagged.join(mixed, "key"), "rest")
    scratch.drop(posted, tagged)
    a, b = rest.alias("a"), rest.alias("b")
    apart = (
        a.hint("merge")
        .join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.comp") < F.col("b.comp")) & within(F.col("a.fp"), F.col("b.fp"), chain_start(F.col("a.key"), max_diff, depth), max_diff))
        .select(F.col("a.comp").alias("u"), F.col("b.comp").alias("v"))
        .distinct()
    )
    apart = scratch.keep(apart, "apart")
    scratch.drop(rest)
    if apart.isEmpty():
        scratch.drop(apart, near)
        return comp
    out = connected_components(near.union(apart), scratch)
    scratch.drop(apart, near, comp)
    return out


def _groups(docs: DataFrame, id_col: str, text: str, shingle: int, seed: int, max_diff: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows (id, a, b, fp), a and b telling texts apart, and labels (fp, root, component_id)."""
    key = row_key(F.col(f"`{text}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), key["a"].alias("a"), key["b"].alias("b"), F.col(f"`{text}`").alias("text"))
    fp = scratch.keep(add_fingerprints(spread(rows), "text", shingle, seed), "fingerprints")
    nodes = scratch.keep(fp.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    comp = link_fingerprints(nodes.select("fp"), scratch, max_diff)
    linked = scratch.keep(nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "linked")
    # written before it is joined, so that the rows of a large component may be dealt to several tasks
    smallest = scratch.keep(linked.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    return fp, scratch.keep(linked.join(smallest, "root").select("fp", "root", "component_id"), "labels")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42, max_diff: int = 4) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id reachable).

    Texts that are null or hold no words have fingerprint zero and link like any other. Ids that are
    null keep their row; they get the smallest id of their component, null if it has none. Repeated
    rows each return a row. Other columns, whatever their names, are not read.
    """
    fp, labels = _groups(docs, id_col, text, shingle, seed, max_diff, Scratch(docs.sparkSession, "simhash"))
    return fp.join(labels, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42, max_diff: int = 4) -> DataFrame:
    """One document row of each group of near-duplicates: that of the smallest id; all columns as they are, whatever their names.

    Rows without an id come last in their group, and rows of one id are ordered by their text's hash, so rows that
    share an id but not a group are both kept. Of rows that repeat an id and text, one is kept. Null texts group like
    empty ones; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    fp, labels = _groups(docs, id_col, text, shingle, seed, max_diff, scratch)
    own = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("a"), F.col("b"))
    first = fp.groupBy("fp").agg(F.min(own).alias("first"))
    kept = first.join(labels, "fp").groupBy("root").agg(F.min("first").alias("k")).select("k.id", "k.a", "k.b")
    kept = scratch.keep(kept, "kept").alias("k")
    key = row_key(F.col(f"d.row.`{text}`"))
    mine = F.col(f"d.row.`{id_col}`")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).alias("d")
    out = packed.join(kept, mine.eqNullSafe(F.col("k.id")) & (key["a"] == F.col("k.a")) & (key["b"] == F.col("k.b")), "left_semi")
    if not fp.groupBy("id", "a", "b").count().where("count > 1").isEmpty():
        again = row_key(F.col(f"row.`{text}`"))
        out = out.select("row", F.col(f"row.`{id_col}`").alias("i"), again["a"].alias("a"), again["b"].alias("b")).dropDuplicates(["i", "a", "b"])
    return out.select("row.*")
