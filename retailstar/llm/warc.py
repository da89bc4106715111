"""WARC (11): archives written and read through a chunked record table.

**Writing.** A page becomes a record; a payload over ``chunk_bytes`` becomes a
``response`` of segment 1 and ``continuation`` records, so nothing longer than a
chunk is ever put together. Each record (segment) is a gzip member of its own.
Members are made where the page is read, shuffled compressed by record, joined
with the decisions which pages are responses, and written through Spark's text
sink in rows of some megabytes: the last byte of a member (the top byte of its
length, below 16 MB) is zero, so a zero byte is the line separator and the files
are plain gzip WARC. A file has at most ``PACKS_PER_FILE`` such rows.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
largest page id is the response, the others are ``revisit`` records that refer
to it; smaller payloads are all responses. Which is decided on digests: largest
id per digest (combined before the shuffle), then the answer goes back by (part,
digest), with the square root of the rows as parts, so that a digest which a
third of all rows share is neither in its own lookup nor in the way back one group.

**Reading.** Files are read as bytes (their size is bounded by the writer) and
decompressed in pieces; a record is never put together. ``read_chunks`` gives the
record table: one row per record (segment) and chunk number, with the bytes and
the SHA-1 of the record (segment) up to there. A record in one segment is done with its last
chunk. The chunks of segmented records, and only these, are dealt by record,
sorted, and run through one digest per record, chunk by chunk.

Defined results: a null payload is an empty one; a null page id is smaller than
any and has no ``Page-Id`` field; a null URL becomes ``urn:page:<id>``; repeated
rows are records of their own (the first copy is the response); an empty table
gives no records. An archive cut short, a wrong segment or an unknown line where
a record must begin fails the read; a payload unlike its declared digest has
``intact`` false. Other columns of the table are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from ..session import scratch_path
from .common import prepare, stored

#: longest payload part of one record
CHUNK_BYTES = 1 << 20
#: compressed bytes of one written row, rows of one file
PACK_BYTES, PACKS_PER_FILE = 4 << 20, 8
#: bytes that a reader feeds and gets at once
PIECE = 1 << 18
#: a gzip member's bytes stay below 2**24, so that its last byte is zero
MEMBER_BYTES = (1 << 24) - 1
DATE = "1970-01-01T00:00:00Z"

# Words of the WARC format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
_URL_SAFE = "!#$%&'()*+,-./:;=?@[]_~"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(key: str, copy: int) -> str:
    """A name for a record that depends on its page alone."""
    h = hashlib.sha1(f"{key}:{copy}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}>"


def member(data: bytes) -> bytes:
    """``data`` as gzip members whose last byte is zero, the same in every run."""
    out = []
    for lo in range(0, max(len(data), 1), MEMBER_BYTES):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(z.compress(data[lo:lo + MEMBER_BYTES]) + z.flush())
    return b"".join(out)


def record(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("Content-Length", len(block))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return member(VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n")


def _target(page_id, url: str | None) -> str:
    return quote(url, safe=_URL_SAFE) if url else f"urn:page:{page_id}"


def _http_head(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def response_members(page_id, url, key: str, copy: int, digest: bytes, payload, chunk_bytes: int,
                     date: str) -> Iterator[bytes]:
    """The gzip members of one response, a segment at a time."""
    size = len(payload)
    n, first = max(1, -(-size // chunk_bytes)), record_id(key, copy)
    base = [("WARC-Date", date), ("WARC-Target-URI", _target(page_id, url)),
            ("Page-Id", page_id), ("WARC-Payload-Digest", f"sha1:{base32(digest)}")]
    head = _http_head(size)
    if n == 1:
        yield record("response", [("WARC-Record-ID", first), *base, ("Content-Type", HTTP)], head + bytes(payload))
        return
    for i in range(n):
        part = bytes(payload[i * chunk_bytes:(i + 1) * chunk_bytes])
        if i == 0:
            yield record("response", [("WARC-Record-ID", first), *base, ("WARC-Segment-Number", 1),
                                      ("Content-Type", HTTP)], head + part)
        else:
            total = len(head) + size if i == n - 1 else None
            yield record("continuation", [("WARC-Record-ID", record_id(f"{key}:{i}", copy)), *base[:2],
                                          ("WARC-Segment-Origin-ID", first), ("WARC-Segment-Number", i + 1),
                                          ("WARC-Segment-Total-Length", total)], part)


def looked_up(rows: DataFrame, key: str, row: str, n_rows: int, table: DataFrame) -> DataFrame:
    """``rows`` left-joined with ``table`` (one row per ``key``), for keys that very
    many rows share: every part of the rows asks once per key, and the answer
    joins that part's rows. A group is about the square root of the rows at most."""
    parts = max(1, math.isqrt(n_rows))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(row), F.lit(parts)).cast("int"))
    asked = dealt.select("part", key).where(F.col(key).isNotNull()).distinct()
    told = asked.join(table, key).withColumnsRenamed({"part": "told_part", key: "told_key"})
    return dealt.join(told, (F.col("part") == F.col("told_part")) & (F.col(key) == F.col("told_key")),
                      "left").drop("part", "told_part", "told_key")


def _named(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, url, payload, size, digest, key) of every page."""
    p = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                     F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("payload"))
    p = p.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    return p.withColumn("key", F.sha1(F.to_json(F.struct("id", "url", "digest"))))


def decisions(named: DataFrame, min_bytes: int) -> DataFrame:
    """(id, url, key, digest, size, inline, copies, top_id, top_key): every different
    page, how often it is there, and the response that its payload has."""
    inline = F.when(F.col("size") < min_bytes, F.col("payload"))
    marks = stored(named.select("id", "url", "key", "digest", "size", inline.alias("inline"))
                   .groupBy("id", "url", "key", "digest", "size", "inline").agg(F.count(F.lit(1)).alias("copies")),
                   "warc-marks")
    best = (marks.where(F.col("size") >= min_bytes).groupBy("digest")
            .agg(F.max(F.struct("id", "url", "key")).alias("top"))
            .select("digest", F.col("top.id").alias("top_id"), F.col("top.key").alias("top_key")))
    return stored(looked_up(marks, "digest", "key", marks.count(), best), "warc-decided")


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES,
                   date: str = DATE) -> None:
    """Write a record per page below ``path`` (gzip WARC files)."""
    prepare(pages.sparkSession)
    named = _named(pages, id_col, url_col, payload_col)
    decided = decisions(named, min_bytes)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        out, held = [], 0
        flush = lambda: pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.binary()))],
            names=["key", "segment", "member"])
        for batch in batches:
            ids, urls, keys, digests = [batch.column(c).to_pylist() for c in ("id", "url", "key", "digest")]
            for i in range(batch.num_rows):
                # copies of a page in this task: one is enough, the join keeps one page per key
                if (mark := bytes.fromhex(keys[i])) in done:
                    continue
                done.add(mark)
                payload = memoryview(batch.column("payload")[i].as_buffer())
                for k, m in enumerate(response_members(ids[i], urls[i], keys[i], 0, bytes.fromhex(digests[i]), payload,
                                                       chunk_bytes, date)):
                    out.append((keys[i], k, m))
                    held += len(m)
                    if held > PACK_BYTES:
                        yield flush()
                        out, held = [], 0
        if out:
            yield flush()

    made = named.where(F.col("size") >= min_bytes).select("id", "url", "key", "digest", "payload").mapInArrow(
        whole, "key string, segment int, member binary")
    responses = decided.where(F.col("key") == F.col("top_key")).select(F.col("key").alias("k"))
    # by key, however the planner joins: a page's segments and copies are together
    members = made.repartition("key").join(responses, F.col("key") == F.col("k"), "left_semi")

    # the others: revisits, and payloads too small to share
    rest = decided.withColumn("first", F.when(F.col("key") == F.col("top_key"), 1).otherwise(0)).where(
        F.col("copies") > F.col("first"))
    rest = rest.withColumn("copy", F.explode(F.sequence(F.col("first").cast("long"), F.col("copies") - 1)))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                digest = bytes.fromhex(r["digest"])
                if r["inline"] is not None:
                    out.append(b"".join(response_members(r["id"], r["url"], r["key"], r["copy"], digest, r["inline"],
                                                         chunk_bytes, date)))
                    continue
                out.append(record("revisit", [
                    ("WARC-Record-ID", record_id(r["key"], r["copy"])), ("WARC-Date", date),
                    ("WARC-Target-URI", _target(r["id"], r["url"])), ("Page-Id", r["id"]), ("WARC-Profile", PROFILE),
                    ("WARC-Refers-To", record_id(r["top_key"], 0)),
                    ("WARC-Payload-Digest", f"sha1:{base32(digest)}"), ("Content-Type", HTTP)], b""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["key"] for r in rows]), pa.array([r["copy"] for r in rows]), pa.array(out, pa.binary())],
                names=["key", "segment", "member"])

    others = rest.select("id", "url", "key", "digest", "inline", "top_key", "copy").mapInArrow(
        small, "key string, segment long, member binary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, size, last = [], 0, None
        flush = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(have)[:-1]], pa.binary())], names=["pack"])
        for batch in batches:
            for key, segment, m in zip(*[batch.column(c).to_pylist() for c in ("key", "segment", "member")]):
                if last == (key, segment):
                    continue   # a copy of the page from another task
                last = (key, segment)
                if have and size + len(m) > PACK_BYTES:
                    yield flush()
                    have, size = [], 0
                have.append(m)
                size += len(m)
        if have:
            yield flush()

    for part in (members.withColumn("segment", F.col("segment").cast("long")), others):
        packs = part.sortWithinPartitions("key", "segment").mapInArrow(pack, "pack binary")
        (packs.select(F.col("pack").cast("string").alias("value")).write.mode("append")
         .option("lineSep", "\0").option("maxRecordsPerFile", PACKS_PER_FILE).text(path))


def unpacked(content) -> Iterator[bytes]:
    """The bytes of an archive in pieces: of all its gzip members, or as they are."""
    if bytes(content[:2]) != b"\x1f\x8b":
        yield from (bytes(content[i:i + PIECE]) for i in range(0, len(content), PIECE))
        return
    at, fed, z = 0, b"", None
    while fed or at < len(content):
        if not fed:
            fed, at = bytes(content[at:at + PIECE]), at + PIECE
        z = z or zlib.decompressobj(31)
        got = z.decompress(fed, PIECE)
        fed = z.unused_data if z.eof else z.unconsumed_tail
        if got:
            yield got
        if z.eof:
            z = None
    while z:
        got = z.decompress(b"", PIECE)
        if got:
            yield got
        if z.eof:
            break
        if not got:
            raise ValueError("the archive ends within a gzip member")


class Pieces:
    """A stream of bytes read by marks and by lengths."""

    def __init__(self, source: Iterator[bytes]) -> None:
        self.source, self.have = source, b""

    def more(self) -> bool:
        got = next(self.source, None)
        self.have += got or b""
        return got is not None

    def skip_line_ends(self) -> bool:
        """False at the end of the stream."""
        while True:
            self.have = self.have.lstrip(b"\r\n")
            if self.have:
                return True
            if not self.more():
                return False

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.have.find(mark, start)) < 0:
            start = max(0, len(self.have) - len(mark) + 1)
            if not self.more():
                raise ValueError("the archive ends within a record's head")
        out, self.have = self.have[:at + len(mark)], self.have[at + len(mark):]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.have and not self.more():
                raise ValueError("the archive ends within a record's block")
            out, self.have = self.have[:n], self.have[n:]
            n -= len(out)
            if out:
                yield out


def records(content) -> Iterator[tuple[dict[str, str], int, Iterator[bytes]]]:
    """(fields, bytes of the HTTP head, pieces of the payload) of every record; fields'
    names in lower case. The pieces must be read before the next record."""
    stream = Pieces(unpacked(content))
    while stream.skip_line_ends():
        lines = stream.until(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}
        length = int(fields["content-length"])
        block, head = stream.take(length), 0
        if fields.get("content-type", "").startswith("application/http") and length:
            body = Pieces(block)
            head = len(body.until(b"\r\n\r\n"))
            block = _rest(body)
        yield fields, head, block
        for _ in block:   # what the caller left
            pass


def _rest(body: Pieces) -> Iterator[bytes]:
    if body.have:
        yield body.have
    yield from body.source


def chunks(pieces: Iterator[bytes], size: int) -> Iterator[bytes]:
    """The same bytes in chunks of ``size``; at least one, maybe empty."""
    have, n, any_ = [], 0, False
    for p in pieces:
        while n + len(p) > size:
            have.append(p[:size - n])
            yield b"".join(have)
            p, have, n, any_ = p[size - n:], [], 0, True
        have.append(p)
        n += len(p)
    if n or not any_:
        yield b"".join(have)


CHUNK_FIELDS = {"record_id": pa.string(), "chunk": pa.int64(), "segment": pa.int64(), "kind": pa.string(),
                "page_id": pa.int64(), "uri": pa.string(), "refers_to": pa.string(), "declared": pa.string(),
                "total": pa.int64(), "head": pa.int64(), "size": pa.int64(), "digest": pa.string(), "last": pa.bool_(),
                "data": pa.binary()}
RECORD_FIELDS = {c: CHUNK_FIELDS[c] for c in ("record_id", "kind", "page_id", "uri", "refers_to", "declared", "size", "digest")}


def _schema(fields: dict[str, pa.DataType]) -> T.StructType:
    return from_arrow_schema(pa.schema(list(fields.items())))


def _batch(rows: list[dict], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(fields.items())))


def chunk_rows(content, chunk_bytes: int, every: bool) -> Iterator[dict]:
    """The rows of one archive (see ``read_chunks``)."""
    number = lambda v: None if v is None else int(v)
    for f, head, pieces in records(content):
        segment = number(f.get("warc-segment-number"))
        about = {"record_id": f.get("warc-segment-origin-id") or f.get("warc-record-id"), "segment": segment,
                 "kind": f.get("warc-type"), "page_id": number(f.get("page-id")), "uri": f.get("warc-target-uri"),
                 "refers_to": f.get("warc-refers-to"), "declared": f.get("warc-payload-digest"),
                 "total": number(f.get("warc-segment-total-length")), "head": head}
        h, size, row = hashlib.sha1(), 0, None
        for k, c in enumerate(chunks(pieces, chunk_bytes)):
            if row and row["data"] is not None:
                yield row
            h.update(c)
            size += len(c)
            row = about | {"chunk": k, "size": size, "digest": f"sha1:{base32(h.digest())}", "last": False,
                           "data": c if every or segment is not None else None}
        yield row | {"last": True}


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, data: str = "all") -> DataFrame:
    """The record table of the archives below ``path``: a row per record (segment)
    and chunk number, with the payload's bytes and digest up to the chunk's end.
    A continuation has the id of its first segment.

    ``data``: ``all`` chunks carry their bytes; ``segmented``: only those of
    segmented records do, and of the others there is the last row only."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out, held = [], 0
                for row in chunk_rows(memoryview(batch.column("content")[i].as_buffer()), chunk_bytes, data == "all"):
                    out.append(row)
                    held += 256 + len(row["data"] or b"")
                    if held > PACK_BYTES:
                        yield _batch(out, CHUNK_FIELDS)
                        out, held = [], 0
                if out:
                    yield _batch(out, CHUNK_FIELDS)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _schema(CHUNK_FIELDS))


def joined_segments(table: DataFrame) -> DataFrame:
    """Segmented records, one row each (RECORD_FIELDS): their chunks, sorted, go
    through one digest per record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, h, size, at, total = None, None, 0, (0, 0), None

        def done() -> pa.RecordBatch:
            if total != size + first["head"]:
                raise ValueError(f"segments are missing of {first['record_id']}")
            return _batch([{c: first[c] for c in RECORD_FIELDS} | {"size": size, "digest": f"sha1:{base32(h.digest())}"}],
                          RECORD_FIELDS)

        for batch in batches:
            for r in batch.to_pylist():
                if first is None or r["record_id"] != first["record_id"]:
                    if first:
                        yield done()
                    first, h, size, at, total = r, hashlib.sha1(), 0, (0, 0), None
                if (r["segment"], r["chunk"]) not in ((at[0] + 1, 0), (at[0], at[1] + 1)):
                    raise ValueError(f"segment {r['segment']} of {r['record_id']} does not follow {at[0]}")
                at, total = (r["segment"], r["chunk"]), r["total"] or total
                h.update(r["data"])
                size += len(r["data"])
        if first:
            yield done()

    ordered = (table.where(F.col("segment").isNotNull()).repartition("record_id")
               .sortWithinPartitions("record_id", "segment", "chunk"))
    return ordered.mapInArrow(run, _schema(RECORD_FIELDS))


def _bare(digest: Column) -> Column:
    return F.regexp_replace(digest, "^sha1:", "")


def read_archives(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(record_id, page_id, uri, record_type, payload_bytes, payload_digest, refers_to,
    intact) of every response and revisit below ``path``.

    Bytes and digest of a revisit are those read from the response it refers to
    (null if that is not there); ``refers_to`` is that response's page."""
    table = stored(read_chunks(spark, path, chunk_bytes, "segmented"), "warc-chunks")
    whole = table.where(F.col("segment").isNull() & F.col("last")).select(*RECORD_FIELDS)
    got = stored(whole.unionByName(joined_segments(table)).where(F.col("kind").isin("response", "revisit")), "warc-records")
    answers = got.where(F.col("kind") == "response").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("r_page"), F.col("size").alias("r_size"),
        F.col("digest").alias("r_digest"))
    all_ = looked_up(got, "refers_to", "record_id", got.count(), answers)
    revisit = F.col("kind") == "revisit"
    size, digest = [F.when(revisit, F.col(f"r_{c}")).otherwise(F.col(c)) for c in ("size", "digest")]
    return all_.select("record_id", "page_id", "uri", F.col("kind").alias("record_type"), size.alias("payload_bytes"),
                       _bare(digest).alias("payload_digest"), F.when(revisit, F.col("r_page")).alias("refers_to"),
                       F.coalesce(digest == F.col("declared"), F.col("declared").isNull()).alias("intact"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    got = read_archives(spark, path)
    sound = F.when(F.col("intact"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload unlike its digest: "), F.col("record_id"))).cast("string"))
    return got.select("page_id", "payload_bytes", sound.alias("payload_digest"), "record_type", "refers_to")


__all__ = ["query", "read_archives", "read_chunks", "write_archives"]
