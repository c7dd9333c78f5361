"""Web archives: ARC files of both versions become WARC, which is written with revisit records and read back.

An ARC file begins with a version block: ``filedesc://...``, then a line with the version number, then the names of the
fields of the records' header lines. Version 1 has five fields, version 2 ten; the last is the declared length of
what follows. The converter parses those lines (from the right, as an address may hold spaces) and makes the WARC
counterpart: an identifier that depends on the record only, the 14-digit time as ISO, the type by content, and digests.

Pages are first written as ARC files of many records. Converter tasks read those record by record and write WARC files,
each with a warcinfo record of its own and those that tell of the ARC files. All files consist of gzip members of one
record each and are written by the tasks themselves into the shared folder; a table of the files that finished tasks
wrote is what is read next, so what a lost or repeated task leaves behind is never read.

Defined cases: a null payload is empty; a null address becomes ``urn:page:<id>``; blanks and control characters in an
address are percent-encoded, as a header line needs; payloads under REVISIT_BYTES are never revisits; of equal larger
payloads the row with the largest id is the response (rows that tie on it all are), rows with a null id revisit it;
without any id all are responses. Truncated input raises ArchiveError. An empty table writes no file. Columns besides id,
address and payload aren't archived, so their names can't clash; ``roles`` passes them through.
"""

from __future__ import annotations

import base64
import datetime
import functools
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.llm import common

REVISIT_BYTES = 1000
#: The line of a record's HTTP head that names its page.
PAGE = "X-Page-ID"
#: A file is closed at this size.
FILE_BYTES = 64 << 20
#: Compressed records of a task that wait for the file, at most.
BUFFER_BYTES = 1 << 20
EPOCH = "20240101000000"
NAMESPACE = uuid.UUID("6f0c3a52-7d0a-5d0e-9f0b-1c5b8e3a9d10")
# The header fields of both ARC versions.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
# Fixed value: the profile of a revisit of an equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    """An archive that doesn't keep to its format."""


@dataclass
class ArcRecord:
    """A record of an ARC file: its header's fields by name, its bytes, and where it starts."""

    version: int
    fields: dict[str, str]
    block: bytes
    offset: int


@dataclass
class WarcRecord:
    """A WARC record: its type, named fields and block."""

    kind: str
    fields: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    def to_bytes(self) -> bytes:
        lines = ["WARC/1.1", f"WARC-Type: {self.kind}", *(f"{k}: {v}" for k, v in self.fields.items()), f"Content-Length: {len(self.block)}", "", ""]
        return "\r\n".join(lines).encode() + self.block + b"\r\n\r\n"


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_head(version: int, name: str, date: str = EPOCH) -> bytes:
    """The version block that opens an ARC file."""
    body = f"{version} 0 brightwater\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = [f"filedesc://{name}", "0.0.0.0", date, "text/plain", *(["200", "-", "-", "0", name] if version == 2 else []), str(len(body))]
    return " ".join(values).encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, block: bytes, date: str = EPOCH, kind: str = "text/html", name: str = "-", offset: int = 0) -> bytes:
    """One record of an ARC file."""
    values = [url, "0.0.0.0", date, kind, *(["200", "-", "-", str(offset), name] if version == 2 else []), str(len(block))]
    return " ".join(values).encode() + b"\n" + block + b"\n"


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a file in pieces: of gzip members one after the other, or as they are."""
    member, begun, inside = None, False, False
    for chunk in chunks:
        if not begun and chunk:
            begun, member = True, zlib.decompressobj(31) if chunk[:2] == b"\x1f\x8b" else None
        if member is None:
            yield chunk
            continue
        while chunk:
            inside = True
            yield member.decompress(chunk)
            chunk = member.unused_data
            if member.eof:
                member, inside = zlib.decompressobj(31), False
    if inside:
        raise ArchiveError("the file is cut off")


class _Source:
    """Lines and blocks of a stream of bytes; holds one chunk besides."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held, self.at = iter(chunks), b"", 0

    def _more(self) -> bool:
        chunk = next(self.chunks, None)
        if chunk is None:
            return False
        self.held += chunk
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the stream."""
        while (end := self.held.find(b"\n")) < 0:
            if not self._more():
                if self.held.strip():
                    raise ArchiveError(f"no header line at {self.at}")
                return None
        line, self.held = self.held[:end], self.held[end + 1 :]
        self.at += end + 1
        return line.rstrip(b"\r")

    def block(self, size: int) -> bytes:
        parts, due = [self.held], size - len(self.held)
        while due > 0:
            chunk = next(self.chunks, None)
            if chunk is None:
                raise ArchiveError(f"record before {self.at} is cut off")
            parts.append(chunk)
            due -= len(chunk)
        data = b"".join(parts)
        self.held, self.at = data[size:], self.at + size
        return data[:size]


def read_arc(chunks: Iterator[bytes]) -> Iterator[ArcRecord]:
    """The records of an ARC file, from its (inflated) bytes in pieces: the version block first, whose version decides how header lines are read."""
    source, version = _Source(chunks), None
    while (at := source.at) is not None and (line := source.line()) is not None:
        if not line:
            continue
        text = line.decode("utf-8", "replace")
        if version is None:
            if not text.startswith("filedesc://") or not text.rpartition(" ")[2].isdigit():
                raise ArchiveError("no version block")
            # The block's own first line says which fields there are; the last is its length in both versions.
            block = source.block(int(text.rpartition(" ")[2]))
            if (number := block.split(b" ")[0]) not in (b"1", b"2"):
                raise ArchiveError(f"unknown version {number!r}")
            version = int(number)
        else:
            block = None
        names = ARC_FIELDS[version]
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ArchiveError(f"header line at {at}: {text[:80]!r}")
        yield ArcRecord(version, dict(zip(names, values, strict=True)), source.block(int(values[-1])) if block is None else block, at)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """The head (with its blank line) and payload of an HTTP response; no head if it isn't one."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    found = re.search(rb"\r?\n\r?\n", block)
    return (block[: found.end()], block[found.end() :]) if found else (block, b"")


@functools.lru_cache(4096)
def iso_date(digits: str) -> str:
    """ISO form of an ARC date of 14 digits (shorter ones are filled up); the epoch if it is none."""
    try:
        return datetime.datetime.strptime((digits + EPOCH[len(digits) :])[:14], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, ' '.join(map(str, parts)))}>"


def to_warc(record: ArcRecord, source: str) -> WarcRecord:
    """The WARC counterpart of an ARC record of the file ``source``."""
    f = record.fields
    out = {"WARC-Record-ID": record_id(source, record.offset, f["URL"]), "WARC-Date": iso_date(f["Archive-date"])}
    if f["URL"].startswith("filedesc://"):
        return WarcRecord("warcinfo", out | {"WARC-Filename": f["URL"][11:], "Content-Type": "text/plain"}, record.block)
    head, payload = split_http(record.block)
    out |= {"WARC-Target-URI": f["URL"], "WARC-IP-Address": f["IP-address"], "WARC-Block-Digest": sha1_label(record.block), "WARC-Payload-Digest": sha1_label(payload)}
    out["Content-Type"] = "application/http; msgtype=response" if head else f["Content-type"]
    return WarcRecord("response" if head else "resource", out, record.block)


def to_revisit(record: WarcRecord, target: str) -> WarcRecord:
    """A revisit of the response with the id ``target``: the head stays, the payload goes."""
    head, _ = split_http(record.block)
    fields = record.fields | {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": target, "WARC-Block-Digest": sha1_label(head)}
    return WarcRecord("revisit", fields, head)


def read_warc(chunks: Iterator[bytes]) -> Iterator[WarcRecord]:
    """The records of a WARC file from its (inflated) bytes in pieces."""
    source = _Source(chunks)
    while (line := source.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while line := source.line():
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        size = int(fields.pop("Content-Length"))
        block = source.block(size)
        if source.block(4) != b"\r\n\r\n":
            raise ArchiveError("the declared length doesn't fit")
        yield WarcRecord(fields.pop("WARC-Type"), fields, block)


def _file_system(at: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(at)


class _Files:
    """Gzipped records of a task, in files of about ``most`` bytes that begin with ``head(number, name)``; ``done`` lists what is complete."""

    def __init__(self, folder: str, suffix: str, head, most: int):
        self.fs, self.folder = _file_system(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.suffix, self.head, self.at, self.most = suffix, head, folder, most
        self.sink, self.size, self.number, self.done, self.buffer, self.notes = None, 0, 0, [], io.BytesIO(), []

    def open(self) -> str:
        """The name of the file that the next record goes to."""
        if self.sink is None:
            self.name = f"{uuid.uuid4().hex}{self.suffix}"
            self.sink = self.fs.open_output_stream(f"{self.folder}/{self.name}")
            self._put(self.head(len(self.done), self.name))
        return self.name

    def _put(self, data: bytes) -> None:
        squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
        self.size += self.buffer.write(squeeze.compress(data)) + self.buffer.write(squeeze.flush())
        if self.buffer.tell() >= BUFFER_BYTES:
            self._flush()

    def add(self, data: bytes, note=None) -> None:
        self.open()
        self._put(data)
        self.number += 1
        if note is not None:
            self.notes.append(note)
        if self.size >= self.most:
            self.close()

    def _flush(self) -> None:
        self.sink.write(self.buffer.getvalue())
        self.buffer = io.BytesIO()

    def close(self) -> None:
        if self.sink is not None:
            self._flush()
            self.sink.close()
            self.done.append((f"{self.at}/{self.name}", self.number, self.size, self.notes))
            self.sink, self.size, self.number, self.notes = None, 0, 0, []


def roles(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """pages with __target: the id that a row's record revisits, null for responses."""
    common.refuse(pages, "__target")
    text = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    keyed = pages.select(common.packed(pages), F.col(f"`{key}`").alias("__key"), F.sha1(text.cast("binary")).alias("__sha1"), F.octet_length(text).alias("__size"))
    large = keyed.where(F.col("__size") >= REVISIT_BYTES)
    groups = common.cut(large.groupBy("__sha1").agg(F.max("__key").alias("__keeper"), F.count("*").alias("__n")).where("__n > 1"), "digests")
    joined = common.join_keyed(keyed, groups, ["__sha1"], "__n", "left")
    return joined.select("__row.*", F.when(~F.col("__keeper").eqNullSafe(F.col("__key")), F.col("__keeper")).alias("__target"))


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes pages (with __target) as ARC files below ``folder``, of version 1 and 2 by turns; returns (file, records, bytes,
    revisits) of each file, where revisits are the places of records in it and the pages that they revisit."""
    common.prepare(pages.sparkSession)
    column = lambda c: F.col(f"`{c}`")
    rows = pages.select(column(key).cast("long").alias("key"), column(url).cast("string").alias("url"), column(payload).alias("payload"), F.col("__target").cast("long").alias("target"))

    def save(batches):
        common.owner("web_archive")
        files = _Files(folder, ".arc.gz", lambda number, name: arc_head(1 + number % 2, name), file_bytes)
        for part in common.sliced(batches, "payload"):
            body, at = common.utf8(part.column("payload"))
            data = body.tobytes()
            for i, (page, address, target) in enumerate(zip(*(part.column(c).to_pylist() for c in ("key", "url", "target")), strict=True)):
                text = data[at[i] : at[i + 1]]
                address = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", address or f"urn:page:{page}")
                own = f"{PAGE}: {page}\r\n" if page is not None else ""
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(text)}\r\n\r\n".encode() + text
                name = files.open()
                files.add(arc_record(1 + len(files.done) % 2, address, block, name=name, offset=files.size), None if target is None else (files.number, target))
        files.close()
        if files.done:
            name, number, size, notes = zip(*files.done, strict=True)
            revisits = pa.array([[{"place": p, "target": t} for p, t in x] for x in notes], pa.list_(pa.struct([("place", pa.int64()), ("target", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(number, pa.int64()), pa.array(size, pa.int64()), revisits], ["file", "records", "bytes", "revisits"])

    return common.cut(rows.mapInArrow(save, "file string, records long, bytes long, revisits array<struct<place: long, target: long>>"), "arc-files")


def _each_file(files: DataFrame, columns: list[str]) -> DataFrame:
    """The table of files dealt out, a few to a task."""
    return files.select(*columns).repartition(min(max(1, files.count()), 100_000))


def _pieces(file: str) -> Iterator[bytes]:
    fs, path = _file_system(file)
    with fs.open_input_stream(path, buffer_size=1 << 20) as source:
        yield from inflated(iter(lambda: source.read(1 << 16), b""))


def convert(arcs: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """ARC files (file, revisits) as WARC files below ``folder``, each with a warcinfo record before the others; returns
    (file, records, bytes) of each. Records are read and written one at a time."""
    common.prepare(arcs.sparkSession)

    def info(number: int, name: str) -> bytes:
        fields = {"WARC-Record-ID": record_id(name), "WARC-Date": iso_date(EPOCH), "WARC-Filename": name, "Content-Type": "application/warc-fields"}
        return WarcRecord("warcinfo", fields, b"software: brightwater\r\nformat: WARC File Format 1.1\r\n").to_bytes()

    def turn(batches):
        common.owner("web_archive")
        files = _Files(folder, ".warc.gz", info, file_bytes)
        for batch in batches:
            for file, revisits in zip(batch.column("file").to_pylist(), batch.column("revisits").to_pylist(), strict=True):
                targets = {x["place"]: x["target"] for x in revisits or ()}
                for place, legacy in enumerate(read_arc(_pieces(file)), -1):  # the version block comes before the first
                    record = to_warc(legacy, file.rpartition("/")[2])
                    if record.kind == "warcinfo":
                        files.add(record.to_bytes())  # what the ARC file said of itself
                        continue
                    page = page_of(record)
                    if page is not None:
                        record.fields |= {"WARC-Record-ID": record_id("page", page), "Page-ID": str(page)}
                    if place in targets:
                        record = to_revisit(record, record_id("page", targets[place]))
                        record.fields["Refers-To-Page-ID"] = str(targets[place])
                    files.add(record.to_bytes())
        files.close()
        if files.done:
            name, number, size, _ = zip(*files.done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(number, pa.int64()), pa.array(size, pa.int64())], ["file", "records", "bytes"])

    return common.cut(_each_file(arcs, ["file", "revisits"]).mapInArrow(turn, "file string, records long, bytes long"), "archive-files")


def page_of(record: WarcRecord) -> int | None:
    """The page that a record's HTTP head names."""
    found = re.search(rf"(?i)\r\n{PAGE}: (-?\d+)\r\n".encode(), split_http(record.block)[0])
    return int(found[1]) if found else None


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes pages (with __target) as ARC files, and converts those to WARC below ``folder``; returns (file, records, bytes) of each WARC file."""
    return convert(write_arc(pages, f"{folder}-arc", key, url, payload), folder)


SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of WARC files as rows of SCHEMA; sizes and digests are those of the full payload."""
    common.prepare(files.sparkSession)

    def load(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                held, size = [], 0
                for r in read_warc(_pieces(name)):
                    if r.kind not in ("response", "revisit", "resource"):
                        continue
                    head, payload = split_http(r.block)
                    digest = base64.b32decode(r.fields["WARC-Payload-Digest"][5:]).hex()
                    if r.kind == "revisit":
                        length = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)[1])
                    else:
                        length = len(payload)
                        if hashlib.sha1(payload).hexdigest() != digest:
                            raise ArchiveError(f"{r.fields['WARC-Record-ID']}: the payload doesn't have its digest")
                    numbers = (int(x) if x else None for x in (r.fields.get("Page-ID"), r.fields.get("Refers-To-Page-ID")))
                    page, target = numbers
                    held.append((page, r.fields["WARC-Target-URI"], r.kind, length, digest, target, payload if payloads else None))
                    size += len(payload)
                    if len(held) >= 1000 or payloads and size >= common.SLICE_BYTES:
                        yield _rows(held)
                        held, size = [], 0
                if held:
                    yield _rows(held)

    return _each_file(files, ["file"]).mapInArrow(load, SCHEMA)


def _rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)], [x.split(" ")[0] for x in SCHEMA.split(", ")])


def query(spark, sf_dir: str) -> DataFrame:
    """One row for each page, as read back from the archives."""
    common.prepare(spark)
    pages = roles(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    files = write(pages, common.scratch(spark, "warc"))
    return read(files, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM k
"""
