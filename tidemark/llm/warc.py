"""WARC archives as a Spark data source, and the archiving of pages with revisit records.

``spark.read.format("warc")`` plans one partition per file, or several small files to one. Filters
on record type, page and address are taken over by the reader: it unpacks a record's headers
first, and where they don't match, or no wanted column needs the payload, it jumps to the next
record. For that each record is a gzip member of its own with its length in the header (the
"sl" field of the WARC standard's annex); archives without it are read through.

``df.write.format("warc")`` writes one file per task under a name of its own, and the files appear in
the folder when the whole write is done, so repeated and lost tasks leave no records behind.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In,
                                    InputPartition, StringStartsWith, WriterCommitMessage)

SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
          "payload_bytes long, payload binary")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
BATCH_BYTES, PARTITION_BYTES = 8 << 20, 64 << 20
#: Compression level of the records.
LEVEL = 4


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records -----------------------------------------------------------------------------

def _line(value: str) -> str:
    """A header value: control characters are percent-encoded, all else stays."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool, date: str) -> bytes:
    """One record. A revisit holds the response's head, with the payload's length, and no payload."""
    sha = digest(payload)
    name = f"{ID}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {sha}')}"
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}"
            "\r\n\r\n").encode()
    body = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{name}>",
             f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            lines.append(f"WARC-Refers-To: <{ID}{refers_to}>")
    lines += [f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(body)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member with its own length in its header, where both lengths fit 32 bits."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = deflate.compress(data) + deflate.flush()
    total = 12 + 12 + len(packed) + 8
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    if max(total, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff" + packed + tail
    extra = b"sl" + struct.pack("<HII", 8, total, len(data))
    return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + packed + tail


class _Stream:
    """The record that begins at ``start`` of a file, unpacked as far as asked for."""

    def __init__(self, file, start: int):
        self.file, self.buffer, self.total = file, b"", None
        file.seek(start)
        head = file.read(12)
        self.packed = head[:2] == b"\x1f\x8b"
        self.start = start
        if self.packed and head[3] & 4:
            extra = file.read(struct.unpack("<H", head[10:12])[0])
            if extra[:2] == b"sl":
                self.total = struct.unpack("<I", extra[4:8])[0]
        file.seek(start)
        self.inflate = zlib.decompressobj(31) if self.packed else None
        self.read = 0

    def _more(self, size: int = 1 << 14) -> bool:
        if self.packed and self.inflate.eof:
            return False
        data = self.file.read(size)
        self.read += len(data)
        if not data:
            return False
        self.buffer += self.inflate.decompress(data) if self.packed else data
        return True

    def until_blank(self) -> bytes | None:
        """Up to the next blank line, which is dropped."""
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                return None
        found, self.buffer = self.buffer[:at], self.buffer[at + 4:]
        return found

    def take(self, n: int) -> bytes:
        pieces, have = [self.buffer], len(self.buffer)
        self.buffer = b""
        while have < n and self._more(1 << 16):
            pieces.append(self.buffer)
            have += len(self.buffer)
            self.buffer = b""
        whole = b"".join(pieces)
        found, self.buffer = whole[:n], whole[n:]
        return found

    def end(self, unread: int) -> int:
        """Where the next record begins; ``unread`` bytes of this one are left, its blank lines included."""
        if self.total:
            return self.start + self.total
        if not self.packed:
            return self.start + self.read - len(self.buffer) + unread
        while not self.inflate.eof:
            self.buffer = b""
            if not self._more(1 << 16):
                break
        return self.start + self.read - len(self.inflate.unused_data)


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _page(name: str | None) -> int | None:
    name = (name or "").strip("<>")
    return int(name.removeprefix(ID)) if name.startswith(ID) else None


def records(file, size: int, wanted, need_payload: bool, verify: bool) -> Iterator[dict]:
    """The records of a file whose headers ``wanted`` accepts; payloads only where needed."""
    at = 0
    while at < size:
        stream = _Stream(file, at)
        block = stream.until_blank()
        if block is None:
            return
        fields = _fields(block)
        length = int(fields.get("content-length", 0))
        sha = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        row = {"page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"),
               "record_type": fields.get("warc-type"), "refers_to": _page(fields.get("warc-refers-to")),
               "payload_digest": sha}
        if not wanted(row):
            at = stream.end(length + 4)
            continue
        http = fields.get("content-type", "").startswith("application/http")
        head = (stream.until_blank() or b"") if http and length else b""
        body = length - (len(head) + 4 if http and length else 0)
        told = _fields(head).get("content-length") if http else None
        payload = None
        if (need_payload or verify) and row["record_type"] != "revisit":
            payload = stream.take(body)
            if verify and sha and digest(payload) != sha:
                raise ValueError(f"record {row['page_id']}: its payload isn't that of its digest")
            body = 0
        row["payload_bytes"] = len(payload) if payload is not None else int(told) if told else body
        row["payload"] = payload if need_payload else None
        yield row
        at = stream.end(body + 4)


# ---- the data source ---------------------------------------------------------------------

class Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.names = [f.name for f in schema]
        self.path, self.verify = options["path"], options.get("verify", "false") == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Takes over equality on the header columns and prefixes of the address."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("record_type", "page_id", "url", "payload_digest") and isinstance(f, (EqualTo, In)):
                self.tests.append((column, "in", set(f.value) if isinstance(f, In) else {f.value}))
            elif column == "url" and isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", f.value))
            else:
                yield f

    def partitions(self):
        where, path = fs.FileSystem.from_uri(self.path)
        found = sorted((x.path, x.size) for x in where.get_file_info(fs.FileSelector(path, recursive=True))
                       if x.is_file and x.path.endswith((".warc", ".warc.gz")) and "/_" not in x.path[len(path):])
        planned, size = [[]], 0
        for file in found:
            if planned[-1] and size + file[1] > self.partition_bytes:
                planned.append([])
                size = 0
            planned[-1].append(file)
            size += file[1]
        return [Files(files) for files in planned]

    def wanted(self, row: dict) -> bool:
        return all(row[c] is not None and (row[c] in v if how == "in" else row[c].startswith(v))
                   for c, how, v in self.tests)

    def read(self, partition):
        where, _ = fs.FileSystem.from_uri(self.path)
        whole = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                           ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                           ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        schema = pa.schema([whole.field(n) for n in self.names])
        rows, size = [], 0
        for path, length in partition.files:
            with where.open_input_file(path) as file:
                for row in records(file, length, self.wanted, "payload" in self.names, self.verify):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 256
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class Written(WriterCommitMessage):
    def __init__(self, name: str | None):
        self.name = name


class WarcWriter(DataSourceArrowWriter):
    """Rows of page_id, url, payload, refers_to and revisit (boolean)."""

    def __init__(self, options):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator):
        where, path = fs.FileSystem.from_uri(self.path)
        name, file = f"part-{uuid.uuid4().hex}.warc.gz", None
        try:
            for batch in iterator:
                if file is None and len(batch):
                    where.create_dir(f"{path}/_pending", recursive=True)
                    file = where.open_output_stream(f"{path}/_pending/{name}", compression=None)
                for row in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload", "refers_to", "revisit"))):
                    file.write(member(record(row[0], row[1], row[2] or b"", row[3], row[4], self.date)))
        finally:
            if file is not None:
                file.close()
        return Written(name if file is not None else None)

    def commit(self, messages):
        where, path = fs.FileSystem.from_uri(self.path)
        where.create_dir(path, recursive=True)
        for m in messages:
            if m is not None and m.name:
                where.move(f"{path}/_pending/{m.name}", f"{path}/{m.name}")

    def abort(self, messages):
        where, path = fs.FileSystem.from_uri(self.path)
        for m in messages:
            if m is not None and m.name:
                where.delete_file(f"{path}/_pending/{m.name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only added to")
        return WarcWriter(self.options)


# ---- archiving pages ---------------------------------------------------------------------

def planned_records(pages: DataFrame, min_bytes: int = 0, payload: str = "html", page_id: str = "page_id",
                    url: str = "url") -> DataFrame:
    """What to write for each page: page_id, url, payload, refers_to, revisit.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest id is a response and
    the others revisit it; a null payload is an empty one. Pages without id come before all
    others; where no page of a payload has an id, all are responses, as are pages that
    share the largest id. Pages that repeat an id have records of their own.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    keyed = rows.withColumn("sha", F.sha2("payload", 256))
    last = keyed.groupBy("sha").agg(F.max("page_id").alias("last"))
    revisit = ((F.octet_length("payload") >= min_bytes) & F.col("last").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("last")))
    return keyed.join(last, "sha").select(
        "page_id", "url", "payload", F.when(revisit, F.col("last")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records_: DataFrame, path: str) -> None:
    records_.sparkSession.dataSource.register(WarcSource)
    records_.write.format("warc").mode("append").save(path)


def read_archives(spark, path: str, columns: str = SCHEMA, verify: bool = False) -> DataFrame:
    """Records of all archives below a folder; without ``payload`` among the columns none is kept.

    ``verify`` unpacks every response anyway and compares its digest. Turns on the session's
    setting by which Python sources are offered filters; the reader can't be planned without.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").schema(columns).option("verify", str(verify).lower()).load(path)
