"""WARC archives as a Spark data source.

Writing: each task writes one archive of gzip members, one per record, under a name of its own, and the
job's commit lists the archives in a manifest. What lost or repeated tasks leave is never listed, so
never read. A later job that appends writes the next manifest, which lists the earlier archives too; one that
overwrites lists its own alone. The manifest with the highest number counts, and it is there as a whole or not at
all. One job at a time may write to a folder. The gzip header of a record carries its compressed length (the field `sl` of the format's
annex), which lets a reader jump to the next record.

Reading: the manifest's archives are the partitions; in a folder without one, all its `.warc` and `.warc.gz` files,
from wherever they come. Of those, whole files and members of several records can be read too. Record ids that
are not of pages written here give a null page_id, and of records that are no HTTP response the block is the
payload. Filters on record type and other header columns are
pushed to the reader. A record's headers are parsed first, from the first bytes that unpack; if a
filter rejects the record, or the schema asks for no payload, the rest is skipped without unpacking.

Paths are what pyarrow's file systems open (file, s3, gs, hdfs).

The records: a page is a `response` whose block is an HTTP response; of pages with equal payloads of at least
`min_bytes`, those with the largest page_id stay responses, and the others are `revisit` records that name it
and hold the HTTP headers only. Nulls: a null html is an empty payload; a null url leaves the target
out; pages without an id are never named by others, and where no page of a payload has an id, all are
responses. Rows that repeat the largest id are all responses. Line ends and other control
characters in a url are percent-encoded. An empty table gives archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tillwatch.llm.common import importable
from tillwatch.sources.store import Store

MIN_BYTES = 0
MANIFEST = re.compile(r"manifest-(\d{8})\.json")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: page_id to payload_length come from headers; payload is the body of a response.
SCHEMA = (
    "page_id long, record_type string, target_uri string, payload_digest string, payload_length long, "
    "refers_to long, payload binary"
)
#: Compressed bytes read at a time for headers, and rows per Arrow batch.
HEAD, ROWS = 1 << 12, 256


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records --------------------------------------------------------------------------------


def _record_id(page_id: int | None, number: str) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{number}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, size: int, sha1: str, refers_to: int | None, number: str
) -> bytes:
    """One WARC/1.1 record; `size` and `sha1` are those of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, number)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.insert(2, ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7F%]", lambda m: quote(m[0], safe=""), url)))
    if revisit:
        headers += [("WARC-Refers-To", _record_id(refers_to, "")), ("WARC-Profile", PROFILE)]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in headers), "\r\n"]).encode() + block + END


def member(raw: bytes) -> bytes:
    """A gzip member whose header says how long the member and its content are (the field sl)."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(raw) + packer.flush()
    length = 10 + 2 + 12 + len(body) + 8
    field = b"sl" + struct.pack("<HII", 8, length & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(field)) + field
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.split(b"\r\n")
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip(" \t") for k, _, v in pairs}


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


class _Packed:
    """The records of gzip members, unpacked as far as is asked for. A record stands in one member."""

    def __init__(self, file, size: int):
        self.file, self.size, self.ended = file, size, False
        self._open(0)

    def _open(self, at: int) -> None:
        self.at = at
        self.file.seek(at)
        self.raw = self.file.read(HEAD)
        self.length = self._skip_length()
        self.unpacker = zlib.decompressobj(zlib.MAX_WBITS | 16)
        self.content = b""

    def _skip_length(self) -> int | None:
        if len(self.raw) < 24 or self.raw[:2] != b"\x1f\x8b" or not self.raw[3] & 4 or self.raw[12:14] != b"sl":
            return None
        return struct.unpack("<I", self.raw[16:20])[0]

    def _more(self) -> None:
        raw = self.raw or self.file.read(1 << 16)
        if not raw or self.unpacker.eof:
            raise ValueError("the archive ends within a record")
        self.raw = b""
        self.content += self.unpacker.decompress(raw)

    def next_record(self) -> bool:
        """Go to the next record; False at the end of the archive."""
        if self.ended:
            return False
        while not (content := self.content.lstrip(b"\r\n")):
            self.content = b""
            if not self.unpacker.eof:
                self._more()
                continue
            following = self.file.tell() - len(self.unpacker.unused_data)
            if following >= self.size:
                return False
            self._open(following)
        self.content = content
        return True

    def until(self, mark: bytes) -> bytes:
        """The content before the mark; what follows the mark stays."""
        while mark not in self.content:
            self._more()
        before, _, self.content = self.content.partition(mark)
        return before

    def take(self, n: int) -> bytes:
        """The next n bytes of the content."""
        parts, left = [], n
        while left > len(self.content):
            parts.append(self.content)
            left -= len(self.content)
            self.content = b""
            self._more()
        parts.append(self.content[:left])
        self.content = self.content[left:]
        return b"".join(parts)

    def leave(self, n: int) -> None:
        """Pass over the last n bytes of a record, without unpacking them if the member says how long it is."""
        if self.length is not None:
            self.at, self.content = self.at + self.length, b""
            self.ended = self.at >= self.size
            if not self.ended:
                self._open(self.at)
            return
        while n:
            n -= len(self.take(min(n, 1 << 16)))


class _Plain:
    """The records of an archive that is not compressed."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at = file, size, 0

    def next_record(self) -> bool:
        while self.at < self.size:
            self.file.seek(self.at)
            found = self.file.read(64)
            self.at += len(found) - len(found.lstrip(b"\r\n"))
            if found.strip(b"\r\n"):
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        self.file.seek(self.at)
        content = b""
        while mark not in content:
            more = self.file.read(HEAD)
            if not more:
                raise ValueError("the archive ends within a record")
            content += more
        before = content.partition(mark)[0]
        self.at += len(before) + len(mark)
        return before

    def take(self, n: int) -> bytes:
        self.file.seek(self.at)
        content = self.file.read(n)
        if len(content) < n:
            raise ValueError("the archive ends within a record")
        self.at += n
        return content

    def leave(self, n: int) -> None:
        self.at += n


class _Block:
    """The block of a record, read as far as is asked for."""

    def __init__(self, source, length: int):
        self.source, self.left = source, length

    def take(self, n: int) -> bytes:
        n = min(n, self.left)
        self.left -= n
        return self.source.take(n)

    def http(self) -> tuple[dict[str, str], bytes] | None:
        """The headers of an HTTP message and what has been read after them; None if it has no end of headers."""
        content = b""
        while END not in content and self.left:
            content += self.take(HEAD)
        head, mark, rest = content.partition(END)
        return (_headers(head), rest) if mark else None


# --- data source ----------------------------------------------------------------------------


@dataclass
class _Written(WriterCommitMessage):
    file: str
    records: int


@dataclass
class _Archive(InputPartition):
    file: str


def _listed(system: fs.FileSystem, folder: str) -> tuple[int, list[str] | None]:
    """The number of the last manifest and the archives it lists; (0, None) without one."""
    names = [f.base_name for f in system.get_file_info(fs.FileSelector(folder))]
    number = max((int(m[1]) for m in map(MANIFEST.fullmatch, names) if m), default=0)
    if not number:
        return 0, None
    with system.open_input_stream(f"{folder}/manifest-{number:08d}.json") as manifest:
        return number, json.loads(manifest.read())


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


class WarcWriter(DataSourceArrowWriter):
    """Rows of (page_id, url, payload, payload_length, payload_digest, refers_to)."""

    def __init__(self, options, overwrite: bool = False):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, folder = fs.FileSystem.from_uri(self.path)
        system.create_dir(folder, recursive=True)
        name, records = f"{uuid.uuid4().hex}.warc.gz", 0
        columns = ("page_id", "url", "payload", "payload_length", "payload_digest", "refers_to")
        with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in iterator:
                for i in range(batch.num_rows):
                    row = [batch.column(c)[i].as_py() for c in columns]
                    out.write(member(record(*row, number=str(uuid.uuid4()))))
                    records += 1
        return _Written(name, records)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = fs.FileSystem.from_uri(self.path)
        system.create_dir(folder, recursive=True)
        number, listed = _listed(system, folder)
        files = sorted(m.file for m in messages if m is not None and m.records)
        draft = f"{folder}/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft, compression=None) as out:
            out.write(json.dumps(files if self.overwrite else [*(listed or []), *files]).encode())
        system.move(draft, f"{folder}/manifest-{number + 1:08d}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = fs.FileSystem.from_uri(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{folder}/{m.file}")


_TESTS = {
    EqualTo: lambda f, v: v is not None and v == f.value,
    EqualNullSafe: lambda f, v: v == f.value,
    In: lambda f, v: v is not None and v in f.value,
    GreaterThan: lambda f, v: v is not None and v > f.value,
    GreaterThanOrEqual: lambda f, v: v is not None and v >= f.value,
    LessThan: lambda f, v: v is not None and v < f.value,
    LessThanOrEqual: lambda f, v: v is not None and v <= f.value,
    StringStartsWith: lambda f, v: v is not None and v.startswith(f.value),
    IsNull: lambda f, v: v is None,
    IsNotNull: lambda f, v: v is not None,
}


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.path, self.columns = options["path"], [f.name for f in schema.fields]
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in self.columns and f.attribute[0] != "payload":
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        system, folder = fs.FileSystem.from_uri(self.path)
        _, listed = _listed(system, folder)
        if listed is None:
            names = [f.base_name for f in system.get_file_info(fs.FileSelector(folder)) if f.is_file]
            listed = sorted(n for n in names if n.endswith((".warc", ".warc.gz")))
        return [_Archive(f) for f in listed] or [_Archive("")]

    def read(self, partition: _Archive) -> Iterator[tuple]:
        if not partition.file:
            return
        system, folder = fs.FileSystem.from_uri(self.path)
        path = f"{folder}/{partition.file}"
        size = system.get_file_info(path).size
        with system.open_input_file(path) as file:
            source = (_Packed if path.endswith(".gz") else _Plain)(file, size) if size else None
            while source and source.next_record():
                head = _headers(source.until(END))
                if "warc-type" not in head:
                    raise ValueError(f"no record before byte {file.tell()} of {path}")
                block = _Block(source, int(head.get("content-length", 0)))
                row = self._row(head, block)
                source.leave(block.left)
                if row is not None:
                    yield row

    def _row(self, head: dict[str, str], block: _Block) -> tuple | None:
        sha1 = head.get("warc-payload-digest")
        target = head.get("warc-target-uri")
        values = {
            "page_id": _page(head.get("warc-record-id")),
            "record_type": head["warc-type"],
            "target_uri": None if target is None else unquote(target),
            "payload_digest": None if sha1 is None else sha1.removeprefix("sha1:"),
            "payload_length": None,
            "refers_to": _page(head.get("warc-refers-to")),
            "payload": None,
        }
        # The length stands in the HTTP headers; a filter on it has to read that far.
        late = [f for f in self.filters if f.attribute[0] == "payload_length"]
        if not all(_TESTS[type(f)](f, values[f.attribute[0]]) for f in self.filters if f not in late):
            return None
        if late or self.verify or {"payload", "payload_length"} & set(self.columns):
            http = "application/http" in head.get("content-type", "").lower()
            message = block.http() if http else ({}, b"")
            if message is not None:
                headers, begun = message
                whole = len(begun) + block.left
                stated = headers.get("content-length", "")
                revisit = values["record_type"] == "revisit"
                values["payload_length"] = int(stated) if revisit and stated.isdigit() else None if revisit else whole
                if not all(_TESTS[type(f)](f, values["payload_length"]) for f in late):
                    return None
                if not revisit and (self.verify or "payload" in self.columns):
                    values["payload"] = begun + block.take(block.left)
                    if self.verify and _is_sha1(sha1) and digest(values["payload"]) != values["payload_digest"]:
                        raise ValueError(f"payload of page {values['page_id']} has another digest")
            elif not all(_TESTS[type(f)](f, None) for f in late):
                return None
        return tuple(values[c] for c in self.columns)


def _is_sha1(text: str | None) -> bool:
    """Whether a payload digest is a SHA-1 in base 32, the only one that is checked."""
    return bool(re.fullmatch(r"sha1:[A-Z2-7]{32}", text or ""))


# --- operators ------------------------------------------------------------------------------


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """What to write: page_id, url, payload (null in revisits), payload_length, payload_digest, refers_to.

    Equal payloads are found by their digest; the payloads themselves are moved once, to meet the largest id.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    bits = [F.conv(F.substring("sha1", 5 * i + 1, 5), 16, 10).cast("int") for i in range(8)]
    letters = [
        F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(b, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
        for b in bits
        for shift in (15, 10, 5, 0)
    ]
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
    ).withColumn("payload_length", F.octet_length("payload").cast("long"))
    largest = (
        rows.where(F.col("payload_length") >= min_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha1", "largest")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return (
        rows.join(largest, "sha1", "left")
        .withColumn("refers_to", refers)
        .select(
            "page_id",
            "url",
            F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
            "payload_length",
            F.concat(*letters).alias("payload_digest"),
            "refers_to",
        )
    )


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, mode: str = "append") -> None:
    """Write archives to a folder, beside those that are there or (`overwrite`) instead of them.

    Pages refer to pages of the same call.
    """
    register(pages.sparkSession)
    records(pages, min_bytes).write.format("warc").mode(mode).save(path)


def read(spark: SparkSession, path: str, schema: str = SCHEMA, verify: bool = False) -> DataFrame:
    """The records; leave `payload` out of the schema, and payloads are not unpacked."""
    register(spark)
    return spark.read.format("warc").schema(schema).option("verify", verify).load(path)


def archived(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The pages written to archives in the shared folder, and read back with their payloads checked."""
    spark = pages.sparkSession
    folder = Store(spark).folder("warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    write(pages, folder, min_bytes)
    return read(spark, folder, SCHEMA.removesuffix(", payload binary"), verify=True)
