"""WARC archives as a Python data source, and the writing of pages into them.

Reading plans partitions over whole archive files, small ones together. Filters on the
record type and other headers are pushed down: a task parses a record's headers first and
leaves the payload of a record it does not want unread, stepping over its compressed bytes
where the archive gives their length (the `sl` extra field of its gzip member).
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from ticketloom.llm.storage import stored

PARTITION_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
# A writing task begins its next archive beyond so many bytes; a reading task takes a whole one.
ARCHIVE_BYTES = 256 << 20
BLANK_LINE = re.compile(rb"\r?\n\r?\n")
DIGESTS = ("md5", "sha1", "sha256", "sha512")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Column, WARC header.
HEADERS = (
    ("record_type", "warc-type"),
    ("record_id", "warc-record-id"),
    ("target_uri", "warc-target-uri"),
    ("record_date", "warc-date"),
    ("refers_to", "warc-refers-to"),
    ("payload_digest", "warc-payload-digest"),
)
SCHEMA = ", ".join(f"{column} string" for column, _ in HEADERS) + ", payload_bytes long, error string, payload binary"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- one record -------------------------------------------------------------------


def gzip_member(data: bytes) -> bytes:
    """A gzip member that names its own compressed and plain length in an `sl` field."""
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\x04\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def page_record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """A response record, or a revisit of the page that `refers_to` names."""
    revisit = refers_to is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=~"))
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    """Header names, lower-cased, and values; the first line is left out."""
    fields: dict[str, str] = {}
    last = None
    for line in re.split("\r?\n", head.decode("utf-8", "replace"))[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            fields[last] = value.strip()
    return fields


class _Stream:
    """Bytes of an archive, one gzip member or plain record after the other."""

    def __init__(self, file):
        self._file = file
        self._raw = b""
        self._gzip = None
        self._plain = b""
        self._skip_to = None
        self._members = 0

    def _more(self) -> bool:
        if self._gzip is None:
            if len(self._raw) < 24:
                self._raw += self._file.read(1 << 20)
            if not self._raw:
                return False
            if self._raw[:2] == b"\x1f\x8b":
                self._begin_member()
            else:
                self._plain, self._raw = self._plain + self._raw, b""
                return True
        if not self._raw:
            self._raw = self._file.read(1 << 20)
            if not self._raw:
                raise ValueError("an archive ends within a gzip member")
        self._plain += self._gzip.decompress(self._raw, 1 << 20)
        self._raw = self._gzip.unconsumed_tail
        if self._gzip.eof:
            self._raw = self._gzip.unused_data
            self._gzip = self._skip_to = None
        return True

    def _begin_member(self) -> None:
        self._gzip = zlib.decompressobj(31)
        self._members += 1
        self._skip_to = None
        if len(self._raw) >= 20 and self._raw[3] & 4 and self._raw[12:14] == b"sl":
            at = self._file.tell() - len(self._raw)
            self._skip_to = at + struct.unpack("<I", self._raw[16:20])[0]

    def head(self) -> bytes | None:
        """The next record's header lines, None at the end of the archive."""
        while True:
            self._plain = self._plain.lstrip(b"\r\n")
            if end := BLANK_LINE.search(self._plain):
                head, self._plain = self._plain[: end.start()], self._plain[end.end() :]
                return head
            if not self._more():
                if self._plain:
                    raise ValueError("an archive ends within a record's headers")
                return None

    def take(self, size: int) -> bytes:
        parts, have = [self._plain], len(self._plain)
        self._plain = b""
        while have < size:
            if not self._more():
                raise ValueError("an archive ends within a record")
            parts.append(self._plain)
            have += len(self._plain)
            self._plain = b""
        data = b"".join(parts)
        data, self._plain = data[:size], data[size:]
        return data

    def skip_member(self) -> bool:
        """Step over the rest of a gzip member; False where there is none to end it."""
        self._plain = b""
        if self._skip_to is not None:
            self.skip(0)
        while (member := self._gzip) is not None and self._more() and self._gzip is member:
            self._plain = b""
        ended, self._plain = self._members > 0, b""
        return ended

    def skip(self, size: int) -> None:
        """Step over the rest of a record; its member is not inflated if its end is known."""
        if self._skip_to is not None:
            self._file.seek(self._skip_to)
            self._raw, self._plain, self._gzip, self._skip_to = b"", b"", None, None
            return
        while size:
            if not self._plain and not self._more():
                raise ValueError("an archive ends within a record")
            step = min(size, len(self._plain))
            self._plain, size = self._plain[step:], size - step


def content_length(text: str | None) -> int | None:
    """A header's length; None where it is missing or no length. Repeats that agree (`5, 5`) are one."""
    said = {part.strip() for part in (text or "").split(",")}
    return int(said.pop()) if len(said) == 1 and re.fullmatch("[0-9]{1,18}", min(said)) else None


def fits(digest: str | None, payload: bytes) -> bool:
    """Whether a payload has its labelled digest, in base32 or hex; an algorithm or spelling that is not known is not checked."""
    name, _, said = (digest or "").partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in DIGESTS:
        return True
    own = hashlib.new(name, payload).digest()
    spelled = {base64.b32encode(own).rstrip(b"=").decode(): 32, own.hex().upper(): 16}
    said = said.strip().rstrip("=").upper()
    return said in spelled or len(said) not in map(len, spelled)


def read_records(file, wanted, with_payload: bool, fail_fast: bool = False):
    """Rows of an archive whose header columns `wanted` accepts.

    `payload_bytes` is the payload's length as it stands in the block, with or without
    `with_payload`, whatever the HTTP header says of it; only a revisit, which leaves its payload out,
    has it from there (null if that is no number). Header lines may end in bare line feeds.

    A record that is damaged is a row whose `error` says how, or raises with `fail_fast`:
    a payload that does not fit its digest comes along as it is; a record whose length is
    missing or no number hides the rest of its gzip member, or of an archive that is not compressed; one
    that is cut off, or bytes that cannot be inflated, end the archive. Errors of records that
    `wanted` does not accept are not shown; headers that are cut off count as null.
    """
    stream = _Stream(file)
    none = dict.fromkeys(column for column, _ in HEADERS)
    while True:
        row, error = none, None
        try:
            if (head := stream.head()) is None:
                return
            fields = header_fields(head)
            row = {column: fields.get(name) for column, name in HEADERS}
            size = content_length(fields.get("content-length"))
            length, payload = size, None
            if size is None:
                error = "the record's length is missing or no number"
                more = stream.skip_member()
            elif not wanted(row):
                stream.skip(size)
            else:
                length, payload = _block(stream, fields, row, size, with_payload)
                if payload is not None and not fits(row["payload_digest"], payload):
                    error = "the payload does not fit its digest"
        except (ValueError, zlib.error, struct.error) as broken:
            length, payload, error, more = None, None, str(broken), False
        if wanted(row):
            if error and fail_fast:
                raise ValueError(f"{row['record_id']}: {error}")
            yield *row.values(), length, error, payload
        if error and error != "the payload does not fit its digest" and not more:
            return


def _block(stream: _Stream, fields: dict, row: dict, size: int, with_payload: bool) -> tuple[int | None, bytes | None]:
    """(payload length, payload or None) of a record, which the stream has then passed."""
    revisit = row["record_type"] == "revisit"
    if "application/http" not in fields.get("content-type", "").lower():
        if with_payload and not revisit:
            return size, stream.take(size)
        stream.skip(size)
        return size, None
    if with_payload and not revisit:
        block = stream.take(size)
        end = BLANK_LINE.search(block)
        payload = block[end.end() :] if end else b""
        return len(payload), payload
    http, begin = _http_head(stream, size)
    return content_length(header_fields(http).get("content-length")) if revisit else size - begin, None


def _http_head(stream: _Stream, size: int) -> tuple[bytes, int]:
    """The HTTP headers of a block and where its payload begins; the payload is stepped over."""
    block, end = b"", None
    while end is None and len(block) < size:
        seen = max(0, len(block) - 3)
        block += stream.take(min(512, size - len(block)))
        end = BLANK_LINE.search(block, seen)
    stream.skip(size - len(block))
    return (block[: end.start()], end.end()) if end else (block, size)


# -- the data source ----------------------------------------------------------------


@dataclass
class ArchiveFiles(InputPartition):
    paths: list[str]


def _filesystem(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.fail_fast = options.get("mode", "PERMISSIVE").upper() == "FAILFAST"
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        columns = {column for column, _ in HEADERS}
        for each in filters:
            if getattr(each, "attribute", (None,))[0] not in columns:
                yield each
            elif isinstance(each, EqualTo):
                self.filters.append((each.attribute[0], "in", {each.value}))
            elif isinstance(each, In):
                self.filters.append((each.attribute[0], "in", set(each.value)))
            elif isinstance(each, StringStartsWith):
                self.filters.append((each.attribute[0], "starts", each.value))
            elif isinstance(each, IsNotNull):
                self.filters.append((each.attribute[0], "there", None))
            else:
                yield each

    def partitions(self):
        system, path = _filesystem(self.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=False))
        files = [f for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))]
        groups, size = [], 0
        for file in sorted(files, key=lambda f: f.path):
            if not groups or size + file.size > PARTITION_BYTES:
                groups.append(ArchiveFiles([]))
                size = 0
            groups[-1].paths.append(file.path)
            size += file.size
        return groups or [ArchiveFiles([])]

    def _wanted(self, row: dict) -> bool:
        for column, kind, value in self.filters:
            own = row[column]
            if own is None or (kind == "in" and own not in value) or (kind == "starts" and not own.startswith(value)):
                return False
        return True

    def read(self, partition):
        system, _ = _filesystem(self.path)
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        kinds = [pa.string()] * len(HEADERS) + [pa.int64(), pa.string(), pa.binary()]
        rows, size = [], 0

        def batch():
            arrays = [pa.array(column, type=kind) for column, kind in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for path in partition.paths:
            with system.open_input_file(path) as file:
                for row in read_records(file, self._wanted, self.with_payload, self.fail_fast):
                    rows.append(row)
                    size += 500 + len(row[-1] or b"")
                    if size > BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


@dataclass
class WrittenFiles(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Archives of `ARCHIVE_BYTES` and at most a record more, of which a task writes one after
    the other, moved from `_pending` into the folder when all tasks are done."""

    def __init__(self, options):
        self.path = options["path"]
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator):
        system, path = _filesystem(self.path)
        system.create_dir(f"{path}/_pending", recursive=True)
        members = (
            gzip_member(page_record(row["page_id"], row["url"], (row["html"] or "").encode("utf-8", "replace"), row["refers_to"], self.date))
            for batch in iterator
            for row in batch.to_pylist()
        )
        names, following = [], next(members, None)
        while following is not None or not names:
            names.append(f"pages-{uuid.uuid4().hex}.warc.gz")
            with system.open_output_stream(f"{path}/_pending/{names[-1]}", compression=None) as out:
                size = 0
                while following is not None and size < ARCHIVE_BYTES:
                    out.write(following)
                    size += len(following)
                    following = next(members, None)
        return WrittenFiles(names)

    def commit(self, messages):
        system, path = _filesystem(self.path)
        for message in messages:
            for name in message.names if message is not None else ():
                system.move(f"{path}/_pending/{name}", f"{path}/{name}")

    def abort(self, messages):
        """Nothing to undo: readers do not look into `_pending`."""


class WarcSource(DataSource):
    """`spark.read.format("warc").option("payload", "true").load(folder)`."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# -- pages to archives and back -------------------------------------------------------


def with_revisits(pages: DataFrame, min_bytes: int = 0, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """(page_id, url, html, refers_to): pages and the page each one's payload repeats.

    Of equal payloads of `min_bytes` or more the smallest page_id is the response and the
    others refer to it. Null html is an empty payload. Rows that repeat the smallest id
    are responses like it; a row without an id refers to the smallest, or, if its payload
    has no id at all, is a response.
    """
    own = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = own.withColumns({"digest": F.sha1(payload), "size": F.octet_length(payload)})
    repeated = keyed.where(F.col("size") >= min_bytes).groupBy("digest", "size")
    repeated = repeated.agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    repeated = stored(repeated.select("digest", "size", "first"), "payloads")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return keyed.join(repeated, ["digest", "size"], "left").select("page_id", "url", "html", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, date: str | None = None) -> None:
    """Write (page_id, url, html, refers_to) rows as archives in a folder.

    Every row is a record, repeated rows and rows without an id or url too; null html is an
    empty payload, and other columns are left out. No rows leave archives without records.
    """
    pages = pages.select("page_id", "url", "html", "refers_to")
    register(pages.sparkSession)
    writer = pages.write.format("warc").mode("append")
    (writer.option("date", date) if date else writer).save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True, fail_fast: bool = False) -> DataFrame:
    """Records of all archives in a folder; without `payload` none is inflated needlessly.

    Damaged records are rows with an `error` (see `read_records`), or fail the read with
    `fail_fast`. A header that a record lacks is null; a folder without records has no rows.
    """
    register(spark)
    reader = spark.read.format("warc").option("payload", str(payload).lower())
    return reader.option("mode", "FAILFAST" if fail_fast else "PERMISSIVE").load(path)


def page_id_of(record_id: str):
    """The page id in a record id that `page_record` wrote."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
