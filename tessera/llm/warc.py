"""WARC archives with a per-file Zstandard dictionary, written, read back and resolved.

Pages are dealt by id; each partition writes its archives in id order. A file starts with a
skippable frame (magic 0x184D2A5D) that holds the dictionary, trained on a bounded sample of the
file's own first records; every record is then a frame of its own. Equal payloads are kept once:
the record of the largest page_id is a response, the others are revisits that name it.

Which id is largest is found on digests alone. Those decisions travel in the same shuffle as the
pages, ahead of the page they are about, so the payloads move once and are never joined. Attempts
write under names of their own and the manifest, a table that Spark commits, lists the files that
count.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.runtime import Scratch, ship_package, shuffle_partitions

SKIPPABLE = 0x184D2A5D
DICT_BYTES = 64 << 10
#: Payload bytes at a file's start from which its dictionary is trained, and bytes after which a file ends.
SAMPLE_BYTES = 2 << 20
FILE_BYTES = 1 << 30
#: Pieces of records at most so long train it.
PIECE = 16 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, extra: str = "") -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    name = "null" if page_id is None else str(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}{extra}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(url or 'about:blank').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a record; a response's payload is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
    body = rest[: int(fields[b"Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    kind, want = fields[b"WARC-Type"].decode(), fields[b"WARC-Payload-Digest"][5:].decode()
    if kind == "response" and (len(payload) != length or digest(payload) != want):
        raise ValueError("a payload differs from its digest")
    number = lambda x: None if x == b"null" else int(x)
    page = number(fields[b"WARC-Record-ID"][10:-1].split(b"#")[0])
    refers = fields.get(b"WARC-Refers-To")
    return page, length, want, kind, None if refers is None else int(refers[10:-1])


class ArchiveWriter:
    """One file: records are held until the dictionary can be trained, then written one frame each."""

    def __init__(self, stream):
        self.out, self.held, self.held_bytes, self.size, self.count, self.pack = stream, [], 0, 0, 0, None

    def add(self, rec: bytes) -> None:
        self.count += 1
        if self.pack is not None:
            return self._put(self.pack.compress(rec))
        self.held.append(rec)
        self.held_bytes += len(rec)
        if self.held_bytes >= SAMPLE_BYTES:
            self._start()

    def _put(self, b: bytes) -> None:
        self.out.write(b)
        self.size += len(b)

    def _dictionary(self) -> zstandard.ZstdCompressionDict:
        """Trained on the held records, cut into pieces where they are few or long; if that fails, their own first bytes."""
        size = max(64, min(PIECE, self.held_bytes // 32))
        pieces = [r[a : a + size] for r in self.held for a in range(0, len(r), size)]
        try:
            return zstandard.train_dictionary(min(DICT_BYTES, max(1024, self.held_bytes // 8)), pieces)
        except zstandard.ZstdError:  # too little or too uniform data to train on
            # a raw dictionary may not begin with the magic of a trained one, and records begin with WARC
            return zstandard.ZstdCompressionDict(b"".join(r[:DICT_BYTES] for r in self.held)[:DICT_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)

    def _start(self) -> None:
        trained = self._dictionary()
        raw = trained.as_bytes()
        self._put(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True)
        for r in self.held:
            self._put(self.pack.compress(r))
        self.held, self.held_bytes = [], 0

    def close(self) -> None:
        if self.pack is None:
            self._start()


def read_records(stream) -> Iterator[bytes]:
    """Records of an archive, a frame at a time, with the dictionary it brings."""
    magic, n = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    raw = stream.read(n)
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    data = b""
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                return
        one, parts = unpack.decompressobj(), []
        while True:
            parts.append(one.decompress(data))
            if one.eof:
                data = one.unused_data
                break
            data = stream.read(1 << 20)
            if not data:
                raise ValueError("a record is cut off")
        yield b"".join(parts)


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def revisits(pages: DataFrame, id_col: str, html: str, scratch: Scratch) -> DataFrame:
    """(id, digest, refers_to) of the pages whose payload a larger id holds."""
    keys = scratch.keep(pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.sha1(_payload(F.col(f"`{html}`"))).alias("digest")), "digests")
    groups = keys.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("id").alias("n")).where("n > 1").drop("n")
    return keys.where("id is not null").join(groups, "digest").where("id <> refers_to").select("id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives and return their manifest: name, records."""
    spark = pages.sparkSession
    ship_package(spark)
    plain = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.lit(1).alias("kind"), F.col(f"`{url}`").cast("string").alias("url"), _payload(F.col(f"`{html}`")).alias("payload"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("refers_to"))
    told = revisits(pages, id_col, html, scratch).select("id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "refers_to")
    n = shuffle_partitions(spark)
    # rows without an id are told apart by their address, so that they do not meet in one task
    dealt = told.union(plain).repartition(n, F.coalesce("id", F.xxhash64("url", "payload"))).sortWithinPartitions("id", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = sink = name = None
        at, known, seen, copies = None, {}, set(), 0
        for b in batches:
            for i, kind, u, payload, dig, refers in zip(*(c.to_pylist() for c in b.columns)):
                if i != at or i is None:
                    at, known, seen, copies = i, {}, set(), 0
                if kind == 0:
                    known[dig] = refers
                    continue
                if writer is None or writer.size >= FILE_BYTES:
                    if writer is not None:
                        writer.close()
                        sink.close()
                        yield pa.RecordBatch.from_pydict({"name": [name], "records": [writer.count]})
                    fs_, base = _file_system(folder)
                    name = f"pages-{uuid.uuid4().hex}.warc.zst"
                    sink = fs_.open_output_stream(f"{base}/{name}", compression=None)
                    writer = ArchiveWriter(sink)
                mark = hashlib.sha1(payload).hexdigest()
                # of rows that repeat the id and payload of a response, the first is it
                refers = known.get(mark, i if mark in seen else None)
                seen.add(mark)
                writer.add(record(i, u, payload, refers, f"#{copies}" if copies else ""))
                copies += 1
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "records": [writer.count]})

    return scratch.keep(dealt.mapInArrow(run, "name string, records long"), "manifest")


def read_archives(manifest: DataFrame, folder: str, id_col: str = "page_id") -> DataFrame:
    """Read every record of the manifest's archives back."""
    files = manifest.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for b in batches:
            for name in b.column(0).to_pylist():
                fs_, base = _file_system(folder)
                rows = []
                with fs_.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for r in read_records(f):
                        rows.append(parse(r))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    out = manifest.select("name").repartition(max(1, files), "name").mapInArrow(run, "id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return out.withColumnRenamed("id", id_col)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write one record per page row, read the archives back: a row per record.

    Null html is an empty payload. Rows without an id are responses and no revisit names them. Rows
    that repeat the id and payload of a response are revisits of it. An empty table writes nothing.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    folder = scratch.mkdirs(scratch.folder("archives"))
    return read_archives(write_archives(pages, folder, scratch, id_col, url, html), folder, id_col)
