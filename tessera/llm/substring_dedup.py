"""Substring dedup by content-defined chunks under a gear rolling hash.

A text's bytes are cut where the gear hash of the last sixteen bytes is the least within ``REACH``
bytes to either side, so a cut depends on its surroundings alone: two texts that share a passage have
the same cuts in it but for its edges, whatever was inserted before. A stretch without such a place
is cut every ``MAX_CHUNK`` bytes. Chunks are deduplicated by digest: the first, by document id and
place, is kept, later ones are repeats.

A repeated chunk is then compared byte by byte with its first place, to both sides, so digests only
propose: bytes decide, and a span has its real ends, wherever the cuts fell.

Digests are counted with a partial aggregate before the shuffle; only rows of repeated digests go on
to the ordering of places. Digests that very many chunks share are few (at most ``HEAVY_DIGESTS``),
so they are joined by broadcast and never meet in one task; lighter ones are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.runtime import Scratch, ship_package

REACH, MAX_CHUNK = 28, 1024
MIN_WORDS = 50
#: A digest is heavy from this many chunks, or from its share of all of them, so heavy ones are at most so many.
HEAVY_ROWS, HEAVY_DIGESTS = 2000, 50_000
#: Bytes beyond its outermost repeated chunks to which a passage is followed.
ROOM = 2 * MAX_CHUNK


def _gear() -> np.ndarray:
    return np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


_GEAR = _gear()
#: An odd factor that lets all bits of the hash decide which is least.
_SPREAD = np.uint32(0x9E3779B1)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[data[i - k]] << k over the last sixteen bytes, by doubling."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8):
        if len(h) > k:
            h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def _least_of_next(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of x[i + 1 .. i + n], by doubling; past the end nothing counts."""
    top = np.iinfo(x.dtype).max
    m = np.append(x[1:], top)
    size = 1
    while size < n:
        step = min(size, n - size)
        m = np.minimum(m, np.concatenate((m[step:], np.full(min(step, len(m)), top, x.dtype))))
        size += step
    return m


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks; the last is the length."""
    a = np.frombuffer(data, np.uint8)
    n = len(a)
    if not n:
        return []
    h = gear_hash(a) * _SPREAD
    # strictly less than what precedes, so of equal ones within reach none but the first can be a cut
    least = (h <= _least_of_next(h, REACH)) & (h < _least_of_next(h[::-1], REACH)[::-1])
    marks = np.flatnonzero(least) + 1
    ends = marks.tolist()
    if not ends or ends[-1] != n:
        ends.append(n)
    if n > MAX_CHUNK and np.diff(ends, prepend=0).max() > MAX_CHUNK:
        out, start = [], 0
        for e in ends:
            out += range(start + MAX_CHUNK, e, MAX_CHUNK)
            out.append(e)
            start = e
        ends = out
    return ends


def _word_starts(data: bytes) -> np.ndarray:
    """First bytes of the words, which white space separates."""
    a = np.frombuffer(data, np.uint8)
    dark = (a != 32) & ((a < 9) | (a > 13))
    return np.flatnonzero(dark & ~np.concatenate(([False], dark[:-1]))) if len(a) else np.zeros(0, np.int64)


def chunk_documents(docs: DataFrame, id_col: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, key, at, digests): a row per document row, arrays by chunk; at holds start << 32 | length.

    A text of fewer than min_words words and several chunks has one more entry, the whole of it.
    """
    ship_package(docs.sparkSession)
    rows = keyed(docs, id_col, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, low = xxhash.xxh3_64_intdigest, (1 << 63) - 1
        for b in batches:
            places, digests = [], []
            for data in b.column(2).to_pylist():
                ends = cuts(data)
                begin = [0, *ends[:-1]] if ends else []
                at = [s << 32 | (e - s) for s, e in zip(begin, ends)]
                found = [digest(data[s:e]) & low for s, e in zip(begin, ends)]
                if len(ends) > 1 and len(_word_starts(data)) < min_words:
                    at.append(len(data))
                    found.append(digest(data, 1) & low)
                places.append(np.array(at, np.int64))
                digests.append(np.array(found, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(places, pa.list_(pa.int64())), pa.array(digests, pa.list_(pa.int64()))], names=["id", "key", "at", "digests"])

    return rows.mapInArrow(run, "id long, key long, at array<long>, digests array<long>")


def keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, key, t): the text's bytes and a key from them alone, which tells rows of one id apart."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("t"))
    return rows.select("id", F.xxhash64("t").bitwiseAND(F.lit((1 << 63) - 1)).alias("key"), "t")


def _own() -> Column:
    """A chunk's place in the order of places: ids, those that are null last, then key and start."""
    return F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", "key").alias("doc"), F.col("key"), F.shiftright("at", 32).alias("start"))


def later_places(docs: DataFrame, scratch: Scratch, id_col: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, key, at, first): every repeated chunk but the first of its digest, and that first place."""
    chunked = scratch.keep(chunk_documents(docs, id_col, text, min_words), "chunks")
    counted = chunked.select(F.explode("digests").alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = scratch.keep(counted, "repeated-digests")
    total = counted.agg(F.sum("n")).first()[0] or 0
    heavy = counted.where(F.col("n") >= max(HEAVY_ROWS, total // HEAVY_DIGESTS)).select("digest")
    light = counted.join(F.broadcast(heavy), "digest", "left_anti").select("digest")
    flat = chunked.select("id", "key", F.explode(F.arrays_zip("at", "digests")).alias("x")).select(F.col("x.digests").alias("digest"), "id", "key", F.col("x.at").alias("at"))
    seen = scratch.keep(flat.join(F.broadcast(heavy), "digest", "left_anti").join(light, "digest"), "repeated")
    many = flat.join(F.broadcast(heavy), "digest")
    first = lambda rows: rows.groupBy("digest").agg(F.min(_own()).alias("first"))
    leads = scratch.keep(first(many), "heavy-firsts")
    found = seen.join(first(seen), "digest").unionByName(many.join(F.broadcast(leads), "digest"))
    return found.where(_own() != F.col("first")).select("id", "key", "at", "first")


def passages(data: bytes, runs: list[tuple], min_words: int) -> list[tuple[int, int, int, int, int | None]]:
    """Spans (first byte, last byte, words, chunks, first id) of a text, given slices of earlier text shifted onto it.

    A run is (its slice's place in the text, the slice, its source's id, the chunks on it as start << 32 | length).
    A match counts if it holds min_words words or is the whole text; matches that overlap join.
    """
    a = np.frombuffer(data, np.uint8)
    words = _word_starts(data)
    found, held = set(), set()
    for lo, piece, of, at in runs:
        y = a[lo : lo + len(piece)]
        n = len(y)
        # equal bytes run between places that differ
        apart = np.concatenate(([-1], np.flatnonzero(np.frombuffer(piece, np.uint8)[:n] != y), [n]))
        s = (at >> 32) - lo
        i = np.searchsorted(apart, s, "right")
        begin, end = apart[i - 1] + 1, apart[np.minimum(i, len(apart) - 1)]
        ok = (end >= s + (at & 0xFFFFFFFF)) & (begin <= s)
        begin, end = begin[ok] + lo, end[ok] + lo
        much = np.searchsorted(words, end) - np.searchsorted(words, begin) >= min_words
        much |= (begin == 0) & (end == len(a))
        found.update((x, z, of) for x, z in zip(begin[much].tolist(), end[much].tolist()))
        held.update((s[ok][much] + lo).tolist())
    if not found:
        return []
    found = sorted(found, key=lambda f: (f[0], f[2] is None, f[2] or 0, f[1]))
    joined = [list(found[0])]
    for s, e, of in found[1:]:
        if s < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e, of])
    at = np.array(sorted(held))
    count = lambda x, s, e: int(np.searchsorted(x, e) - np.searchsorted(x, s))
    return [(s, e, count(words, s, e), count(at, s, e), of) for s, e, of in joined]


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per span that repeats earlier text: id, first_byte, last_byte (exclusive), n_words, n_chunks, first_id.

    A span is a run of bytes equal to those around its chunks' first places, from the first equal byte to the last,
    with min_words words (counted by their first bytes), or a whole text, whatever its length; overlapping ones are
    one span. n_chunks counts the repeated chunks that begin in it; first_id is the smallest id its beginning was
    found in. Null and empty texts have no spans. Rows without an id come after all others in the order of first
    places; rows that repeat an id and text are one document, whose spans are returned once. Texts of any length are
    read whole. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    later = later_places(docs, Scratch(spark, "substrings"), id_col, text, min_words)
    s, size = F.shiftright("at", 32), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
    own = [F.col("id").isNull().alias("none"), F.coalesce("id", "key").alias("doc"), F.col("key")]
    pairs = later.select(*own, F.col("first.none").alias("xnone"), F.col("first.doc").alias("xdoc"), F.col("first.key").alias("xkey"), (F.col("first.start") - s).alias("d"), "at", s.alias("lo"), (s + size).alias("hi"))
    # chunks at one distance share a slice, which lies where both texts have bytes
    lines = pairs.groupBy("none", "doc", "key", "xnone", "xdoc", "xkey", "d").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_set("at").alias("chunks"))
    lines = lines.withColumn("lo", F.greatest(F.col("lo") - ROOM, -F.col("d"), F.lit(0))).withColumn("hi", F.col("hi") + ROOM)
    texts = keyed(docs, id_col, text).select(*own, "t")
    if not texts.groupBy("none", "doc", "key").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["none", "doc", "key"])
    x, y = texts.alias("x"), texts.alias("y")
    cut = F.substring(F.col("x.t"), (F.col("lo") + F.col("d") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int"))
    one = F.struct(F.col("lo"), cut.alias("slice"), F.when(~F.col("xnone"), F.col("xdoc")).alias("of"), F.col("chunks"))
    met = lines.alias("l").join(x, (F.col("l.xnone") == F.col("x.none")) & (F.col("l.xdoc") == F.col("x.doc")) & (F.col("l.xkey") == F.col("x.key")))
    runs = met.select(F.col("l.none").alias("rnone"), F.col("l.doc").alias("rdoc"), F.col("l.key").alias("rkey"), one.alias("run")).groupBy("rnone", "rdoc", "rkey").agg(F.collect_list("run").alias("runs"))
    both = runs.join(y, (F.col("rnone") == F.col("y.none")) & (F.col("rdoc") == F.col("y.doc")) & (F.col("rkey") == F.col("y.key"))).select("rnone", "rdoc", "rkey", "t", "runs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, lists = [], b.column(4)
            offsets, flat = lists.offsets.to_pylist(), lists.values
            lo, slices, of, held = flat.field("lo").to_numpy(), flat.field("slice"), flat.field("of").to_pylist(), flat.field("chunks")
            begin, at = held.offsets.to_numpy(), held.values.to_numpy()
            for i, (none, doc, data) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist())):
                rs = [(int(lo[j]), slices[j].as_py(), of[j], at[begin[j] : begin[j + 1]]) for j in range(offsets[i], offsets[i + 1])]
                out += [(None if none else doc, *x) for x in passages(data, rs, min_words)]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(6)], names=["id", "first_byte", "last_byte", "n_words", "n_chunks", "first_id"])

    spans = both.mapInArrow(compare, "id long, first_byte long, last_byte long, n_words long, n_chunks long, first_id long")
    return spans.withColumnRenamed("id", id_col)
