"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

Writing: rows with equal payloads share a SHA-1 digest; the one with the least
id is a ``response`` record and the others are ``revisit`` records that name
it.  Every record is its own gzip member, one file per partition.

Reading: each record is checked (gzip checksum, version line, header syntax,
Content-Length, closing blank lines, payload digest).  After a failed check the
reader searches for the next version line, in the decompressed bytes of the
member (also of a member that is cut or damaged, as far as it decompresses) or
in the plain file, then for the next member, goes on from there, and logs the
bytes between as a gap with the reason.  Offset and length of a record of a
compressed file are those of its member; a gap inside a member has its offset
and the length of the decompressed bytes that are lost.  A damaged member is
logged as a gap as a whole, too; of its records those that state a digest are
taken, but not one that ends where a cut member does.  A file is read in chunks
and a member decompressed in pieces, so memory follows the largest record.
Headers of more than ``MAX_HEAD`` bytes are a failed check.

Defined results: a null payload is empty; payloads of ``min_bytes`` at least
are stored once, smaller ones always whole; rows that repeat the id of their
response are responses too; a null id is written as such and read as null; a
very long payload is one record, held whole while it is written or read; only
the named columns are read, so further columns never clash; an empty table
gives no file.  A truncated file ends in a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import as_id, small_batches, tidy, written

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/[0-9]{1,3}\.[0-9]{1,3}\r\n")
LONGEST_VERSION = len(b"WARC/000.000\r\n")
CHUNK = 1 << 18
CUT = "member truncated"
#: Decompressed bytes of a member that are kept from its first reading; a larger one is decompressed again, piece by piece.
KEPT = 1 << 22
#: Bytes that the headers of a record may take.
MAX_HEAD = 1 << 22


#: Upper-case base32 of a SHA-1 digest in the hexadecimal column ``sha``.
BASE32 = (
    "array_join(transform(sequence(0, 31), i -> substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',"
    " int(shiftright(int(conv(substr(sha, int(i div 4) * 5 + 1, 5), 16, 10)), int(15 - 5 * (i % 4))) & 31) + 1, 1)), '')"
)


def mark_duplicates(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``rows`` (id, url, payload) with payload_digest and response_id: the least
    id of the rows with an equal payload where it is not the row's own, else null.

    Digests that occur twice, with their least id, are counted and written
    first.  While they are few, the planner broadcasts them by their size and no
    payload moves; else rows are joined by digest, and adaptive execution splits
    a digest that very many rows have.
    """
    h = rows.withColumn("sha", F.sha1("payload"))
    twice = h.filter(F.length("payload") >= min_bytes).groupBy("sha").agg(F.count("*").alias("n"), F.min("id").alias("least")).filter("n > 1")
    out = h.join(written(twice.select("sha", "least"), "repeated-payloads"), "sha", "left")
    response = F.when((F.length("payload") >= min_bytes) & F.col("least").isNotNull() & ~F.col("id").eqNullSafe(F.col("least")), F.col("least"))
    return out.select("id", "url", "payload", F.expr(BASE32).alias("payload_digest"), response.alias("response_id"))


def record(rid: int | None, url: str | None, payload: bytes, digest: str, response: int | None) -> bytes:
    """The bytes of one record."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + (payload if response is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if rid is None else rid}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if response is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{response}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str, key: str, url: str, payload: Column, min_bytes: int = 0, level: int = 1) -> DataFrame:
    """Write ``rows`` below ``folder`` (a URI of storage that all executors
    share); returns, materialised, the files written: path, records, bytes.
    A lost task that runs again writes another file; only files named in the
    result count."""
    small_batches(rows.sparkSession)
    marked = mark_duplicates(rows.select(as_id(key).alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload")), min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, n, size = None, 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    fs, local = pyarrow.fs.FileSystem.from_uri(target)
                    fs.create_dir(local.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(local, compression=None)
                z = zlib.compressobj(level, wbits=31)
                member = z.compress(record(*row)) + z.flush()
                out.write(member)
                n, size = n + 1, size + len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

    return written(marked.mapInArrow(tidy(run), "path string, records long, bytes long"), "warc-manifest")


class Bad(Exception):
    """A failed check; the text is the reason."""


def parse_head(data: bytes | bytearray) -> tuple[dict[str, str], int, int] | None:
    """Headers (lower-case names), and where the block of the record at the start
    of ``data`` begins and ends; None if more bytes are needed; raises ``Bad``."""
    line = VERSION.match(data)
    if not line and len(data) >= LONGEST_VERSION:
        raise Bad("no version line")
    stop = data.find(b"\r\n\r\n")
    if stop < 0:
        if len(data) >= MAX_HEAD:
            raise Bad("headers not closed")
        return None
    if not line:
        raise Bad("no version line")
    headers: dict[str, str] = {}
    for row in bytes(data[line.end() : stop]).split(b"\r\n") if stop > line.end() else []:
        name, found, value = row.partition(b":")
        if not found or not name.strip():
            raise Bad("malformed header")
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not size.isdecimal() or len(size) > 15:
        raise Bad("no content length")
    return headers, stop + 4, stop + 4 + int(size)


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block


def check_digest(headers: dict[str, str], block: bytes) -> None:
    name, _, value = headers.get("warc-payload-digest", "").partition(":")
    if name == "sha1" and headers.get("warc-type") != "revisit":
        if base64.b32encode(hashlib.sha1(payload_of(headers, block)).digest()).decode() != value.upper():
            raise Bad("payload digest differs")


class Source:
    """Reads of a random-access file, in chunks."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def chunk(self, at: int) -> bytes:
        """Some bytes from ``at`` on, none at the end."""
        if not self.at <= at < self.at + len(self.data):
            self.at, self.data = at, self.file.read_at(min(CHUNK, max(0, self.size - at)), at)
        return self.data[at - self.at :]

    def find(self, what: bytes, at: int) -> int:
        """Where ``what`` next stands, or the size of the file."""
        keep, start = b"", at
        while start < self.size:
            data = self.file.read_at(min(CHUNK, self.size - start), start)
            hit = (keep + data).find(what)
            if hit >= 0:
                return start - len(keep) + hit
            keep, start = (keep + data)[-(len(what) - 1) :], start + len(data)
        return self.size

    def member(self, at: int) -> Iterator[bytes]:
        """The bytes of the gzip member at ``at``, piece by piece, as far as it
        decompresses; its checksum is verified.  The generator's value is the
        member's end and why it is damaged, if it is."""
        z, p = zlib.decompressobj(wbits=31), at
        while not z.eof:
            data = z.unconsumed_tail or self.chunk(p)
            if not data:
                return p, CUT
            p += 0 if z.unconsumed_tail else len(data)
            before = z.copy()
            try:
                out = z.decompress(data, CHUNK)
            except zlib.error:
                yield from self._whole_part(before, data)
                return p, "bad gzip member"
            if out:
                yield out
        return p - len(z.unused_data), ""

    @staticmethod
    def _whole_part(z, data: bytes) -> Iterator[bytes]:
        """What ``data`` gives before the error, byte by byte."""
        out = []
        try:
            for i in range(len(data)):
                out.append(z.decompress(data[i : i + 1]))
        except zlib.error:
            pass
        yield b"".join(out)

    def look(self, at: int) -> tuple[int, int, str, list[bytes] | None]:
        """Of the member at ``at``: its end, its decompressed length, why it is
        damaged, if it is, and its bytes unless they are more than ``KEPT``."""
        size, kept, pieces = 0, [], self.member(at)
        while True:
            try:
                piece = next(pieces)
            except StopIteration as stop:
                return stop.value[0], size, stop.value[1], kept
            size += len(piece)
            if kept is not None:
                kept.append(piece)
                kept = kept if size <= KEPT else None

    def plain(self, at: int) -> Iterator[bytes]:
        """The bytes of the plain file from ``at`` on."""
        while data := self.chunk(at):
            yield data
            at += len(data)


def inside(pieces: Iterator[bytes], total: int, why: str = "") -> Iterator[tuple]:
    """('record', offset, length, headers, block) and ('gap', offset, length, reason, b'')
    of ``total`` bytes that come in pieces.  ``why`` they are damaged, if they
    are: then a record needs a digest.  One record is held at a time; a record
    that says it is longer than what is left is bad at once."""
    data, at, bad, reason, more = bytearray(), 0, -1, "", True
    while True:
        try:
            head = parse_head(data) if data else None
            if head is None:
                if more:
                    piece = next(pieces, None)
                    more = piece is not None
                    data += piece or b""
                    continue
                if not data:
                    break
                raise Bad("headers not closed" if VERSION.match(data) else "no version line")
            headers, begin, end = head
            if at + end + 4 > total:
                raise Bad("record truncated")
            while len(data) < end + 4:
                data += next(pieces)
            if data[end : end + 4] != b"\r\n\r\n":
                raise Bad("record not closed")
            block = bytes(data[begin:end])
            check_digest(headers, block)
            if why and (not has_digest(headers) or why == CUT and at + end + 4 == total):
                raise Bad(why)
        except Bad as error:
            if bad < 0:
                bad, reason = at, str(error)
            begin = 1
            while not (m := VERSION.search(data, begin)):
                # what may be the beginning of a version line stays
                gone = max(begin, len(data) - LONGEST_VERSION)
                piece = next(pieces, None)
                if piece is None:
                    gone, more = len(data), False
                del data[:gone]
                at, begin = at + gone, 0
                if piece is None:
                    break
                data += piece
            if m:
                del data[: m.start()]
                at += m.start()
            continue
        if bad >= 0:
            yield "gap", bad, at - bad, reason, b""
            bad = -1
        yield "record", at, end + 4, headers, block
        del data[: end + 4]
        at += end + 4
    if bad >= 0:
        yield "gap", bad, at - bad, reason, b""


def has_digest(headers: dict[str, str]) -> bool:
    """Whether ``check_digest`` compares the block."""
    return headers.get("warc-type") != "revisit" and headers.get("warc-payload-digest", "").startswith("sha1:")


def salvage(source: Source) -> Iterator[tuple]:
    """('record', offset, length, headers, block) and ('gap', offset, length, reason, b'')."""
    if source.chunk(0)[:2] != MAGIC[:2] and source.find(MAGIC, 0) >= source.find(b"WARC/", 0):
        yield from inside(source.plain(0), source.size)
        return
    at, bad, reason = 0, -1, ""
    while at < source.size:
        end, size, why, kept = source.look(at)
        found, some = inside(source.member(at) if kept is None else iter(kept), size, why), False
        held: list[tuple] = []  # gaps before the first record
        if why:  # the bytes behind the damage may hold further members
            end = source.find(MAGIC, at + 1)
        for kind, where, n, what, block in found:
            if kind == "record" and not some:
                some = True
                if bad >= 0:
                    yield "gap", bad, at - bad, reason, b""
                    bad = -1
                yield from held
            if kind == "record":
                yield "record", at, end - at, what, block
            elif some:
                yield "gap", at, n, what, b""
            else:
                held.append(("gap", at, n, what, b""))
        if some:
            if why:
                yield "gap", at, end - at, why, b""
            at = end
            continue
        if bad < 0:
            bad, reason = at, why or (held[0][3] if held else "no version line")
        at = source.find(MAGIC, at + 1)
    if bad >= 0:
        yield "gap", bad, source.size - bad, reason, b""


RECORDS = "path string, kind string, offset long, length long, reason string, headers map<string,string>, payload_bytes long, payload_digest string, payload binary"


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record and per quarantined gap of the files named in the column
    ``path``.  ``payload_bytes`` and ``payload_digest`` are those of the payload
    as read; of revisits, as their headers state them."""
    schema = pa.schema([("path", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    names = files.select("path")
    spread = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def row(path: str, kind: str, at: int, n: int, what, block: bytes) -> tuple:
        if kind == "gap":
            return path, kind, at, n, what, [], None, None, None
        if what.get("warc-type") == "revisit":
            size = what.get("warc-payload-length", "")
            stated = what.get("warc-payload-digest", "").partition(":")[2]
            return path, kind, at, n, None, list(what.items()), int(size) if size.isdecimal() else None, stated or None, None
        body = payload_of(what, block)
        return path, kind, at, n, None, list(what.items()), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), body if payloads else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, local = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_file(local) as f:
                    rows, held = [], 0
                    for kind, at, n, what, block in salvage(Source(f, f.size())):
                        rows.append(row(path, kind, at, n, what, block))
                        held += len(block) if payloads else 0
                        if len(rows) == 1000 or held > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return names.repartition(spread, "path").mapInArrow(tidy(run), RECORDS)


def id_of(header: str) -> Column:
    """The row id in a record-id header."""
    return F.expr(f"try_cast(regexp_extract(headers['{header}'], '^<urn:page:(-?[0-9]+)>$', 1) AS BIGINT)")
