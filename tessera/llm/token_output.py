"""Token ids in patched frame-of-reference blocks, with an index of block starts.

Documents are range-partitioned by id and written in ascending order, one file a partition, into
the shared folder. Ids are cut into blocks of ``BLOCK``. A block keeps its smallest id, the width
that holds a chosen percentile of the differences to it, the packed low bits of all of them, and a
list of exceptions (position, difference) for those that need more. The footer holds where each
block starts, and each document's id and length, so any document can be read by its blocks alone.

Attempts write under names of their own; the driver takes the row of one attempt of each partition,
and the manifest, a table of one file, names these, so a lost executor leaves at most a file that
nobody reads. A file's first token has a global number: the sum of the tokens in the files before it,
of which there is one a partition. Small files are read several in a task.

Layout, little-endian: "PFR1", u32 block size; blocks: u32 minimum, u8 width, u16 exceptions,
packed bits, u16 positions, u32 differences; footer: u64 block starts, u8 id present, i64 ids, u64
lengths; u64 footer offset, u64 blocks, u64 documents, u64 tokens, "1RFP".
"""

from __future__ import annotations

import os
import string
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.runtime import Scratch, ship_package, shuffle_partitions

BLOCK = 512
PERCENTILE = 90.0
FLUSH_TOKENS = 1 << 20
#: Blocks packed at once: their bits are held as 32-bit numbers meanwhile.
PACK_BLOCKS = 128
#: Tokens that a task reads back at least, as far as the session's cores all have work.
READ_TOKENS = 1 << 20
MEMO_WORDS = 700_000
TEXT_SLICE = 4 << 20

_encoders: dict[str, "WordMemo"] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Whole(Exception):
    """A unit whose text must be encoded whole."""


class _Known(dict):
    """Units and their ids; a unit met for the first time is made. What the generation before knew moves over when it is met."""

    def __init__(self, make, before: dict | None = None):
        self.make, self.before = make, before or {}

    def __missing__(self, u: str) -> bytes:
        before = self.before
        got = self[u] = before.pop(u) if u in before else self.make(u)
        return got

    def next(self) -> "_Known":
        """This table, or one that follows it if it holds half of MEMO_WORDS: words that come again stay, others go."""
        if len(self) <= MEMO_WORDS // 2:
            return self
        self.before = {}
        return _Known(self.make, self)


class WordMemo:
    """Byte-level BPE by the tokenizers library, with the ids of words met before kept in a bounded table.

    The pre-tokenizer splits before a single space between two characters that are no white space,
    so the text's space-separated units are encoded independently. A text with other spacing, or
    with text that may be a special token, is encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.packed = [struct.pack("<I", i) for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.memo = _Known(self._unit)
        self.bare = _Known(lambda u: self._piece(u, ""))
        self.marks = _Known(lambda u: self._ids([u])[0])
        self.special = [str(t.content)[:2] for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.break_ = self._ids(["\n"])[0]
        letters = self._byte_letters()
        self.space = letters and letters[32]
        # a byte whose form isn't known becomes a null character
        self.letters = letters and {b: letters.get(b, "\0") for b in range(256)}
        # the letters a-z and A-Z may stand for themselves
        self.plain = letters is not None and all(letters.get(ord(c)) == c for c in string.ascii_letters)

    def _byte_letters(self) -> dict[int, str] | None:
        """How the pre-tokenizer shows each byte, if it is the byte-level one: a word is then the model's own input."""
        try:
            shown = {b: self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(b))[-1][0] for b in range(33, 127)}
            seen = {b: c for b, c in shown.items() if len(c) == 1}
            for c in range(0xC0, 0x180):  # letters of two bytes show the rest
                pair = self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[-1][0]
                if len(pair) == 2:
                    seen |= dict(zip(chr(c).encode(), pair))
            seen[32] = self.tokenizer.pre_tokenizer.pre_tokenize_str(" a")[0][0][0]
        except (AttributeError, IndexError):
            return None
        probe = [" déjà", " the", " Straße", "été"]
        whole = [self.tokenizer.encode(p, add_special_tokens=False).ids for p in probe]
        return seen if [[t.id for t in self.tokenizer.model.tokenize("".join(seen[b] for b in p.encode()))] for p in probe] == whole else None

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(i)}I", *i) for i in (e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))]

    def _word(self, w: str, lead: str) -> bytes:
        """Ids of letters that the pre-tokenizer leaves whole; by all of the tokenizer if a byte's form isn't known."""
        if self.plain and w.isascii():
            shown = self.space + w if lead else w
        else:
            shown = (lead + w).encode().decode("latin-1").translate(self.letters)
            if "\0" in shown:
                return self._ids([lead + w])[0]
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(shown)])

    def _piece(self, u: str, lead: str) -> bytes:
        """Ids of a unit without line breaks: letters, then marks, or anything else whole."""
        if self.letters is not None:
            if u.isalpha():
                return self._word(u, lead)
            head = u.rstrip(string.punctuation)
            if head.isalpha():
                return (self.memo if lead else self.bare)[head] + self.marks[u[len(head) :]]
        return self._ids([lead + u])[0]

    def _unit(self, u: str) -> bytes:
        """Ids of a unit after a space."""
        if u.isalpha() and self.letters is not None:
            if self.plain and u.isascii():
                packed = self.packed
                return b"".join([packed[t.id] for t in self.tokenize(self.space + u)])
            return self._word(u, " ")
        if not u or u[-1].isspace() or any([s in u for s in self.special]):
            raise Whole
        if "\n" not in u:
            return self._piece(u, " ")
        first, *lines = u.split("\n")
        if not first or first[0].isspace() or first[-1].isspace() or not all([x and not x[0].isspace() and not x[-1].isspace() for x in lines]):
            return self._ids([" " + u])[0]
        return self.memo[first] + b"".join([self.break_ + self.bare[x] for x in lines])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        self.memo, self.bare, self.marks = self.memo.next(), self.bare.next(), self.marks.next()
        known, out = self.memo.__getitem__, []
        firsts = [t.partition(" ")[0] for t in texts]
        # split one text at a time: its words are looked up while they are in the processor's cache
        for text, first, head in zip(texts, firsts, self._ids(firsts)):
            try:
                if first and (first[-1].isspace() or any([s in first for s in self.special])):
                    raise Whole
                units = text.split(" ")
                out.append(head + b"".join(map(known, units[1:])))
            except Whole:
                out.append(self._ids([text])[0])
        return out


def encoder(path: str) -> WordMemo:
    if path not in _encoders:
        _encoders[path] = WordMemo(path)
    return _encoders[path]


def _width_of(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of BLOCK ids each (the last may be shorter), encoded."""
    full = len(ids) // BLOCK
    out: list[bytes] = []
    for a in range(0, full, PACK_BLOCKS):
        rows = ids[a * BLOCK : min(full, a + PACK_BLOCKS) * BLOCK].reshape(-1, BLOCK)
        out += _pack_rows(rows, percentile)
    if len(ids) % BLOCK:
        out += _pack_rows(ids[full * BLOCK :].reshape(1, -1), percentile)
    return out


def _pack_rows(rows: np.ndarray, percentile: float) -> list[bytes]:
    low = rows.min(axis=1)
    rel = rows - low[:, None]
    k = min(rows.shape[1] - 1, int(rows.shape[1] * percentile / 100))
    widths = _width_of(np.partition(rel, k, axis=1)[:, k])
    out: list[bytes] = [b""] * len(rows)
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        sub = rel[at]
        if w:
            bits = ((sub[:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
            packed = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
        over = sub >> np.uint32(w) != 0 if w < 32 else np.zeros(sub.shape, bool)
        for j, n in enumerate(at.tolist()):
            pos = np.flatnonzero(over[j])
            out[n] = struct.pack("<IBH", int(low[n]), int(w), len(pos)) + (packed[j].tobytes() if w else b"") + pos.astype("<u2").tobytes() + sub[j][pos].astype("<u4").tobytes()
    return out


def unpack(data: bytes, offsets: list[int], counts: list[int]) -> np.ndarray:
    """The ids of blocks at the offsets, one after the other."""
    heads = [struct.unpack_from("<IBH", data, o) for o in offsets]
    raw = np.frombuffer(data, np.uint8)
    starts = np.cumsum([0, *counts]).tolist()
    out = np.zeros(starts[-1], np.uint32)
    kinds: dict[tuple[int, int], list[int]] = {}
    for k, (h, n) in enumerate(zip(heads, counts)):
        kinds.setdefault((h[1], n), []).append(k)
    for (w, n), blocks in kinds.items():
        size = (n * w + 7) // 8
        for a in range(0, len(blocks), 256):
            part = blocks[a : a + 256]
            if w:
                packed = raw[np.array([offsets[k] + 7 for k in part])[:, None] + np.arange(size)]
                bits = np.unpackbits(packed, axis=1, count=n * w, bitorder="little").reshape(-1, w)
                wide = np.zeros((len(bits), 32), np.uint8)
                wide[:, :w] = bits
                rel = np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(len(part), n)
            else:
                rel = np.zeros((len(part), n), np.uint32)
            for r, k in zip(rel, part):
                low, _, m = heads[k]
                if m:
                    e = offsets[k] + 7 + size
                    r[np.frombuffer(data, "<u2", m, e)] = np.frombuffer(data, "<u4", m, e + 2 * m)
                out[starts[k] : starts[k + 1]] = r + np.uint32(low)
    return out


class Writer:
    def __init__(self, stream):
        self.out, self.at = stream, 0
        self.starts: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        self.held: list[bytes] = []
        self.held_tokens = self.tokens = 0
        self._put(b"PFR1" + struct.pack("<I", BLOCK))

    def _put(self, b: bytes) -> None:
        self.out.write(b)
        self.at += len(b)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.held.append(ids)
        self.held_tokens += len(ids) // 4
        if self.held_tokens >= FLUSH_TOKENS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        n = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in pack(ids[:n]):
            self.starts.append(self.at)
            self._put(block)
        self.tokens += n
        self.held, self.held_tokens = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> None:
        self._flush(True)
        foot = self.at
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array([d is not None for d, _ in self.docs], np.uint8).tobytes())
        self._put(np.array([d or 0 for d, _ in self.docs], "<i8").tobytes() + np.array([n for _, n in self.docs], "<u8").tobytes())
        self._put(struct.pack("<QQQQ", foot, len(self.starts), len(self.docs), self.tokens) + b"1RFP")


def read_documents(source) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, first token within the file, ids) of each document, block by block; source: a random-access file."""
    source.seek(source.size() - 36)
    foot, n_blocks, n_docs, tokens = struct.unpack("<QQQQ", source.read(32))
    if source.read(4) != b"1RFP":
        raise ValueError("no footer")
    source.seek(foot)
    starts = np.frombuffer(source.read(8 * n_blocks), "<u8").tolist() + [foot]
    there = np.frombuffer(source.read(n_docs), np.uint8)
    ids = np.frombuffer(source.read(8 * n_docs), "<i8")
    lengths = np.frombuffer(source.read(8 * n_docs), "<u8")
    held, first, b = np.zeros(0, np.uint32), 0, 0
    for has, i, n in zip(there.tolist(), ids.tolist(), lengths.tolist()):
        parts = [held]
        have = len(held)
        while have < n:
            take = min(n_blocks, b + max(256, -(-(n - have) // BLOCK)))
            source.seek(starts[b])
            data = source.read(starts[take] - starts[b])
            parts.append(unpack(data, [x - starts[b] for x in starts[b:take]], [min(BLOCK, tokens - k * BLOCK) for k in range(b, take)]))
            have += len(parts[-1])
            b = take
        run = np.concatenate(parts) if len(parts) > 1 else held
        yield (i if has else None), first, run[:n]
        held, first = run[n:], first + n


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_tokens(docs: DataFrame, folder: str, scratch: Scratch, id_col: str = "doc_id", text: str = "text", vocab: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the files and return their manifest: part, path, n_docs, n_tokens."""
    spark = docs.sparkSession
    ship_package(spark)
    vocab = vocab or vocabulary()
    n = shuffle_partitions(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text").asc()]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, writer, sink, path = encoder(vocab), None, None, None
        part = TaskContext.get().partitionId()
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            a = 0
            while a < len(texts):
                size, z = 0, a
                while z < len(texts) and (z == a or size < TEXT_SLICE):
                    size += len(texts[z])
                    z += 1
                if writer is None:
                    fs_, base = _file_system(folder)
                    path = f"{base}/tokens-{part:06d}-{uuid.uuid4().hex}.pfr"
                    sink = fs_.open_output_stream(path)
                    writer = Writer(sink)
                for i, e in zip(ids[a:z], enc.encode(texts[a:z])):
                    writer.add(i, e + end)
                a = z
        if writer is not None:
            writer.close()
            sink.close()
            name = path.rsplit("/", 1)[1]
            yield pa.RecordBatch.from_pydict({"part": [part], "name": [name], "n_docs": [len(writer.docs)], "n_tokens": [writer.tokens]})

    schema = "part long, name string, n_docs long, n_tokens long"
    listed = sorted(rows.mapInArrow(run, schema).collect())  # a row a partition
    return scratch.keep(spark.createDataFrame(listed, schema).coalesce(1), "manifest")


def read_tokens(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Read the manifest's files back: id, start, n_tokens, ids_crc32 of each document."""
    spark = manifest.sparkSession
    files = sorted(manifest.collect(), key=lambda r: r["part"])  # a row a partition
    total = max(1, sum(r["n_tokens"] for r in files))
    tasks = min(len(files), max(spark.sparkContext.defaultParallelism, total // READ_TOKENS))
    base, dealt = 0, {}
    for r in files:  # to the task in whose share of the tokens a file begins
        dealt.setdefault(base * tasks // total, []).append((r["name"], base))
        base += r["n_tokens"]
    shares = list(dealt.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for b in batches:
            for name, first in [x for n in b.column(0).to_pylist() for x in shares[n]]:
                fs_, root = _file_system(folder)
                rows = []
                with fs_.open_input_file(f"{root}/{name}") as f:
                    for i, s, ids in read_documents(f):
                        rows.append((i, first + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    src = spark.range(0, len(shares), 1, max(1, len(shares)))  # a row a partition
    return src.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def token_output(docs: DataFrame, id_col: str = "doc_id", text: str = "text", vocab: str | None = None, end_id: int = 2) -> DataFrame:
    """Encode, write and read back: one row per document row with id, start, n_tokens, ids_crc32.

    Files are in ascending id order, ids that are null last, equal ids in the order of their text's
    hash. Null texts are empty and hold the end id alone. Empty tables write no file.
    """
    scratch = Scratch(docs.sparkSession, "tokens")
    folder = scratch.mkdirs(scratch.folder("files"))
    return read_tokens(write_tokens(docs, folder, scratch, id_col, text, vocab, end_id), folder, id_col)
