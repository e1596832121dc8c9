"""Embedding near-duplicates through a pivot-permutation index.

Pivots are a bounded sample of the vectors. Each vector is described by the ordered list of its
nearest pivots; the index holds, per label and pivot, the vectors that list it. Vectors that meet
in a list are candidates if their lists share enough pivots; those are verified by cosine in double
precision. A pair that meets in several lists counts in the first of them only, so that link counts
stay exact without a table of pairs.

Equal vectors are one class. A list longer than ``LIST_ROWS`` is cut into parts, and every two parts
meet in one group of bounded size; a group returns each member's links and a spanning forest, never
its pairs, so tight clusters cost compute but no rows. The lists of a large table are dealt in
``ROUNDS`` rounds at most, so that a vector's copies for its lists are not on disk all at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.components import connected_components
from tessera.runtime import Scratch, ship_package

#: Pivots are as many as vectors / this and as PIVOTS_PER_ROOT * sqrt(vectors that share a label), the fewer, 16 at least, and
#: hold so many bytes at most; they and nothing else reach the driver. The root balances the search for pivots with the lists' work.
VECTORS_PER_PIVOT, PIVOTS_PER_ROOT = 40, 12
MIN_PIVOTS, PIVOT_BYTES = 16, 32 << 20
#: Pivots in a description, and the lists a vector is filed under (the nearest of them).
LISTED, FILED = 12, 8
SHARED = 2
#: Rows of a list that are not cut, and bytes of them in double precision; about so many filed vectors, of several lists, are handed to Python at once.
LIST_ROWS, LIST_BYTES = 4096, 32 << 20
#: Bytes of filed vectors that one round deals, as long as there are not more rounds than ROUNDS.
ROUND_BYTES, ROUNDS = 256 << 20, 8
#: Cosines, and pairs, that a task holds at once.
COSINES, PAIRS = 1 << 21, 20_000


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of unit length in double precision; rows that have no direction hold non-finite values."""
    x = x.astype(np.float64)
    # scaled by its largest component first, so that squares neither overflow nor vanish
    with np.errstate(all="ignore"):
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True)) + 0.0


def named(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """Of (id, v, label), for each length of vectors: the rows that can link, the digests that name their classes, their components."""
    v, labels = b.column(1), b.column(2).to_pylist()
    lengths = v.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = v.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    labelled = np.array([x is not None for x in labels], bool)
    for d in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero((lengths == d) & labelled)
        raw = flat[starts[at][:, None] + np.arange(d)]
        x = unit(raw)
        ok = np.isfinite(x).all(axis=1)
        at, raw, x = at[ok], raw[ok], x[ok]
        yield at, [xxhash.xxh3_128_digest(u.tobytes() + labels[k].encode()) for k, u in zip(at.tolist(), x)], raw


def name_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, v, label) -> (id, name); the name is null if the vector is unusable."""
    for b in batches:
        names: list[bytes | None] = [None] * b.num_rows
        for at, digests, _ in named(b):
            for k, n in zip(at.tolist(), digests):
                names[k] = n
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.binary())], names=["id", "name"])


def usable_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, v, label) -> (id, name, label, vec) of the usable vectors; vec: the components as they came, one after the other."""
    for b in batches:
        for at, digests, raw in named(b):
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(digests, pa.binary()), b.column(2).take(at), packed(raw)], names=["id", "name", "label", "vec"])


def packed(x: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    x = np.ascontiguousarray(x)
    ends = np.arange(len(x) + 1, dtype=np.int64) * (x.itemsize * x.shape[1])
    return pa.Array.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x)]).cast(pa.binary())


def unpacked(column: pa.Array, kind: str) -> np.ndarray:
    """Binary values of one length, none null, as a table of their numbers."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(column), -1)


def choose_pivots(vectors: DataFrame, n: int, rows: int, seed: int, kind: str) -> np.ndarray:
    """``n`` unit vectors of the ``rows`` distinct ones, those whose hash is lowest; only about as many are sorted."""
    draw = F.xxhash64(F.lit(seed), "name")
    share = (n + 8 * n**0.5 + 64) / rows
    if share < 1:
        vectors = vectors.where(draw < F.lit(int(-(2**63) + share * 2**64)))
    got = vectors.orderBy(draw, "name").limit(n).select("vec").toArrow()["vec"].combine_chunks()
    return unit(unpacked(got, kind)).astype(np.float32)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """Pivot numbers by falling cosine, k of them at most (unit vectors); COSINES cosines are held at once, or one row's."""
    k = min(k, len(pivots))
    out = np.empty((len(x), k), np.int32)
    step = max(1, COSINES // len(pivots))
    for a in range(0, len(x), step):
        sims = x[a : a + step] @ pivots.T
        top = np.argpartition(sims, len(pivots) - k, axis=1)[:, len(pivots) - k :]
        out[a : a + step] = np.take_along_axis(top, np.argsort(-np.take_along_axis(sims, top, axis=1), axis=1, kind="stable"), axis=1)
    return out


class Forest:
    """Trees over n nodes; links between two of them are kept."""

    def __init__(self, n: int):
        self.root = list(range(n))
        self.flat = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def _find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        far = self.flat[a] != self.flat[b]
        if not far.any():
            return
        for p, q in zip(a[far].tolist(), b[far].tolist()):
            i, j = self._find(p), self._find(q)
            if i != j:
                self.root[max(i, j)] = min(i, j)
                self.links.append((p, q))
        self.flat = np.array([self._find(i) for i in range(len(self.root))])


def verify_group(side: np.ndarray, x: np.ndarray, lists: np.ndarray, copies: np.ndarray, pivot: int, cosine: float, shared: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links between the group's two sides (or within one): summed copies of each member's partners, and a forest."""
    one = bool((side == side[0]).all())
    left = np.arange(len(x)) if one else np.flatnonzero(side == side.min())
    right = left if one else np.flatnonzero(side == side.max())
    degree = np.zeros(len(x), np.int64)
    forest = Forest(len(x))
    # single precision sieves, with more room than its rounding can take; double precision decides
    small, least = x.astype(np.float32), cosine - 1e-5 - 3e-7 * x.shape[1]
    step = max(1, min(512, COSINES // len(right)))
    for a in range(0, len(left), step):
        rows = left[a : a + step]
        first = a if one else 0
        others = right[first:]
        at_i, at_j = np.nonzero(small[rows] @ small[others].T >= least)
        if one:
            after = at_i < at_j
            at_i, at_j = at_i[after], at_j[after]
        for s in range(0, len(at_i), PAIRS):
            p, q = rows[at_i[s : s + PAIRS]], others[at_j[s : s + PAIRS]]
            ok = np.einsum("ij,ij->i", x[p], x[q]) >= cosine
            p, q = p[ok], q[ok]
            both = (lists[p][:, :, None] == lists[q][:, None, :]) & (lists[p] >= 0)[:, :, None]
            filed = both[:, :FILED, :FILED]
            # the first list in which the two meet is the one with the smallest pivot
            meet = np.where(filed.any(axis=2), lists[p][:, :FILED], np.iinfo(np.int32).max).min(axis=1)
            ok = (both.sum(axis=(1, 2)) >= shared) & (meet == pivot)
            p, q = p[ok], q[ok]
            np.add.at(degree, p, copies[q])
            np.add.at(degree, q, copies[p])
            forest.add(p, q)
    return degree, forest.links


def embedding_dedup(
    vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", seed: int = 42, shared: int = SHARED, list_rows: int = LIST_ROWS, vectors_per_pivot: int = VECTORS_PER_PIVOT
) -> DataFrame:
    """One row per vector row: id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components, and those without a
    label, link with nothing. Vectors of different length never link. Rows may repeat an id or a
    vector; equal vectors of a label link. A null id gets its component's smallest id and is not kept
    unless alone, when its component_id is null. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "embeddings", free_shuffles=True)
    # components stay as they came, in single precision if they are, until they are compared
    single = isinstance(getattr(vectors.select(F.col(f"`{vector}`")).schema[0].dataType, "elementType", None), T.FloatType)
    kind, width = ("<f4", 4) if single else ("<f8", 8)
    src = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<float>" if single else "array<double>").alias("v"), F.col(f"`{label}`").cast("string").alias("label"))
    ids = vectors.select(F.col(f"`{id_col}`").alias("id")).schema
    rows = scratch.keep(src.mapInArrow(name_rows, T.StructType([*ids]).add("name", "binary")), "rows")
    usable = src.mapInArrow(usable_rows, T.StructType([*ids]).add("name", "binary").add("label", "string").add("vec", "binary"))
    classes = usable.groupBy("name").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    classes = scratch.keep(classes, "classes")
    # vectors of each length have an index of their own; a row a length, usually one
    sizes = classes.groupBy((F.length("vec") / width).cast("int").alias("d"), "label").agg(F.count(F.lit(1)).alias("n"))
    dims = {r["d"]: (r["n"], r["pairs"]) for r in sizes.groupBy("d").agg(F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs")).collect()}
    found, links, kept = [], [], {}
    for d, (n, pairs) in sorted(dims.items()):
        part = classes.where(F.length("vec") == d * width)
        wanted = min(n // vectors_per_pivot, int(PIVOTS_PER_ROOT * (pairs / n) ** 0.5))
        pivots = choose_pivots(part, min(max(MIN_PIVOTS, PIVOT_BYTES // (4 * d)), max(MIN_PIVOTS, wanted), n), n, seed, kind)
        shared_pivots = spark.sparkContext.broadcast(pivots)

        def describe(batches: Iterator[pa.RecordBatch], held=shared_pivots) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    near = nearest_pivots(unit(unpacked(b["vec"], kind)).astype(np.float32), held.value, LISTED)
                    near = np.pad(near, ((0, 0), (0, LISTED - near.shape[1])), constant_values=-1)
                    near = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1, dtype=np.int32) * LISTED), pa.array(near.ravel()))
                    yield pa.RecordBatch.from_arrays([*b.columns, near], names=[*b.schema.names, "pivots"])

        described = scratch.keep(part.mapInArrow(describe, T.StructType([*part.schema]).add("pivots", T.ArrayType(T.IntegerType()))), "described")
        kept[d] = described
    scratch.drop(classes)
    for d, described in kept.items():
        n = dims[d][0]
        lists = described.select("label", F.explode(F.slice("pivots", 1, FILED)).alias("pivot")).where("pivot >= 0").groupBy("label", "pivot").agg(F.count(F.lit(1)).alias("n"))
        lists = scratch.keep(lists, "lists")
        most = max(16, min(list_rows, LIST_BYTES // (8 * d)))
        # lists that are cut: so many at most as there are filed vectors by most
        cut = lists.where(F.col("n") > most).select("label", "pivot", F.ceil(F.col("n") / most).cast("int").alias("parts"))
        cut = F.broadcast(scratch.keep(cut, "cut"))
        rounds = max(1, min(ROUNDS, n * FILED * (width * d + 100) // ROUND_BYTES))

        groups = max(64, n * FILED // rounds // most)

        def verify(group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            label_, pivot, p1, p2, part, copies = (group["label"].chunk(0).dictionary_encode().indices.to_numpy(), *(group[c].to_numpy() for c in ("pivot", "p1", "p2", "part", "copies")))
            name = unpacked(group["name"].chunk(0), "u1")
            # members come in any order; sorted, the forest is the same in each run
            order = np.lexsort((*name.view(">u8").T[::-1], part, p2, p1, pivot, label_))
            x, lists_ = unit(unpacked(group["vec"].chunk(0), kind)[order]), group["pivots"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, LISTED)[order]
            label_, pivot, p1, p2, part, copies, name = (c[order] for c in (label_, pivot, p1, p2, part, copies, name))
            new = (np.diff(label_) != 0) | (np.diff(pivot) != 0) | (np.diff(p1) != 0) | (np.diff(p2) != 0)
            hits, counts, tree = [], [], []
            starts = [0, *(np.flatnonzero(new) + 1).tolist(), len(order)]
            for a, z in zip(starts, starts[1:]):
                if z - a > 1 and (p1[a] == p2[a] or part[a] != part[z - 1]):
                    degree, forest = verify_group(part[a:z], x[a:z], lists_[a:z], copies[a:z], int(pivot[a]), cosine, shared)
                    hit = np.flatnonzero(degree)
                    hits.append(hit + a)
                    counts.append(degree[hit])
                    tree += [(i + a, j + a) for i, j in forest]
            hit, tree = np.concatenate([np.zeros(0, np.int64), *hits]), np.array(tree, np.int64).reshape(-1, 2)
            return pa.table(
                {
                    "u": packed(name[np.concatenate([hit, tree[:, 0]])]),
                    "v": pa.concat_arrays([pa.nulls(len(hit), pa.binary()), packed(name[tree[:, 1]])]),
                    "n": pa.array(np.concatenate([np.zeros(0, np.int64), *counts, np.zeros(len(tree), np.int64)])),
                }
            )

        for r in range(rounds):
            filed = described.select("name", "label", "copies", "vec", "pivots", F.explode(F.slice("pivots", 1, FILED)).alias("pivot")).where((F.col("pivot") >= 0) & (F.col("pivot") % rounds == r))
            posted = filed.join(cut, ["label", "pivot"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            posted = posted.withColumn("part", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int"))
            posted = posted.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
            posted = posted.withColumns({"p1": F.least("part", "other"), "p2": F.greatest("part", "other")})
            # one list, or one pair of its parts, is in one group, which may hold several
            posted = posted.withColumn("group", F.pmod(F.xxhash64("label", "pivot", "p1", "p2"), F.lit(groups)).cast("int"))
            posted = posted.select("group", "label", "pivot", "p1", "p2", "part", "name", "copies", "vec", "pivots")
            met = scratch.keep(posted.groupBy("group").applyInArrow(verify, "u binary, v binary, n long"), "met")
            found.append(met.where("v is null").select("u", "n"))
            links.append(met.where("v is not null").select("u", "v"))
    if not dims:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    degrees, edges = found[0], links[0]
    for a, b in zip(found[1:], links[1:]):
        degrees, edges = degrees.union(a), edges.union(b)
    members, *more = [x.select("name", "copies", "least") for x in kept.values()]
    for x in more:
        members = members.union(x)
    comp = connected_components(edges, scratch)
    degrees = degrees.groupBy(F.col("u").alias("name")).agg(F.sum("n").alias("n"))
    linked = members.join(comp.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    linked = scratch.keep(linked, "linked")
    scratch.drop(*kept.values())
    # written before it is joined, so that the rows of a large component may be dealt to several tasks
    smallest = scratch.keep(linked.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    labels_ = linked.join(smallest, "root").join(degrees, "name", "left").select(F.col("name").alias("c"), "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    labels_ = scratch.keep(labels_, "labels")
    out = rows.select("id", "name").join(labels_, F.col("name") == F.col("c"), "left")
    component = F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
