"""WARC archives as a Spark data source.

``read_warc`` plans one partition per archive file.  Of every record only the
headers are parsed at first; predicates on the record type and on headers are
pushed down to that point, so the payload of an unwanted record is passed
over without being decoded, and a wanted one is kept, only hashed, or passed
over too (option ``payload``).

``write_warc`` writes ``.warc.gz`` files (one gzip member per record) in the
executors.  A manifest written at commit names the files of successful tasks;
readers go by it, so files of failed or repeated attempts are never read.

Paths are URIs that pyarrow opens (file, hdfs, s3, gs) and must be shared by
driver and executors.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, IsNull,
    StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

from aislekit.llm._common import Scratch

MANIFEST = "_manifest.json"
# Header names and the profile are fixed by the WARC 1.1 format.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
           "date": "warc-date", "refers_to": "warc-refers-to", "content_type": "content-type"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + \
    ", content_length long, payload_bytes long, payload_digest string, payload binary"
WRITE_COLUMNS = ["record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload"]
BLOCK = 1 << 20


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


class Stream:
    """Bytes of one archive, plain or gzip members one after another; ``read`` and ``skip`` in bounded blocks."""

    def __init__(self, raw):
        self.raw, self.left, self.at = raw, b"", 0
        head = raw.read(2)
        self.unzip = zlib.decompressobj(31) if head == b"\x1f\x8b" else None
        self.packed = head
        self.done = False

    def _more(self) -> bytes:
        if self.unzip is None:
            out, self.packed = self.packed, b""
            return out or self.raw.read(BLOCK)
        while True:
            if not self.packed:
                self.packed = self.raw.read(BLOCK)
                if not self.packed:
                    return b""
            if self.unzip.eof:
                self.unzip = zlib.decompressobj(31)
            out = self.unzip.decompress(self.packed, BLOCK)
            self.packed = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
            if out:
                return out

    def blocks(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, block by block."""
        while n > 0:
            if self.at >= len(self.left):
                self.left, self.at = self._more(), 0
                if not self.left:
                    raise EOFError("the archive ends inside a record")
            part = self.left[self.at:self.at + n]
            self.at += len(part)
            n -= len(part)
            yield part

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the archive."""
        while (i := self.left.find(mark, self.at)) < 0:
            more = self._more()
            if not more:
                if self.left[self.at:].strip():
                    raise EOFError("the archive ends inside a header")
                return None
            self.left, self.at = self.left[self.at:] + more, 0
        out = self.left[self.at:i + len(mark)]
        self.at = i + len(mark)
        return out


def parse_headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


class Files(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.mode = options.get("payload", "bytes")
        if self.mode not in ("bytes", "digest", "skip"):
            raise ValueError(f"payload: bytes, digest or skip, not {self.mode}")
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):  # noqa: N802 - Spark's name
        """Keep predicates on header columns; hand the others back to Spark."""
        simple = {EqualTo: "eq", In: "in", StringStartsWith: "starts", StringEndsWith: "ends",
                  StringContains: "has", IsNull: "null", IsNotNull: "set"}
        for f in filters:
            kind = simple.get(type(f))
            if kind and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.tests.append((kind, HEADERS[f.attribute[0]], getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        for kind, name, value in self.tests:
            x = headers.get(name)
            if kind == "null":
                ok = x is None
            elif x is None:
                ok = False
            else:
                ok = {"set": lambda: True, "eq": lambda: x == value, "in": lambda: x in value,
                      "starts": lambda: x.startswith(value), "ends": lambda: x.endswith(value),
                      "has": lambda: value in x}[kind]()
            if not ok:
                return False
        return True

    def partitions(self):
        where, folder = open_folder(self.folder)
        info = where.get_file_info(f"{folder}/{MANIFEST}")
        if info.type == fs.FileType.File:
            with where.open_input_stream(f"{folder}/{MANIFEST}") as f:
                names = json.loads(f.read())
            return [Files(f"{folder}/{n}") for n in names]
        if where.get_file_info(folder).type == fs.FileType.File:
            return [Files(folder)]
        found = where.get_file_info(fs.FileSelector(folder, recursive=True))
        return [Files(x.path) for x in sorted(found, key=lambda x: x.path)
                if x.type == fs.FileType.File and x.path.endswith((".warc", ".warc.gz"))]

    def read(self, partition):
        if partition is None:  # Spark asks so when no file was planned
            return
        where, _ = open_folder(self.folder)
        with where.open_input_stream(partition.path, compression=None) as raw:
            stream = Stream(raw)
            while (head := stream.until(b"\r\n\r\n")) is not None:
                if not head.strip():  # the two line ends behind a record
                    continue
                headers = parse_headers(head.lstrip(b"\r\n"))
                length = int(headers["content-length"])
                if self.wanted(headers):
                    yield self.record(headers, length, stream)
                else:
                    for _ in stream.blocks(length):
                        pass

    def record(self, headers: dict[str, str], length: int, stream: Stream) -> tuple:
        """A wanted record; an HTTP block's headers are parsed before its payload is touched."""
        left, size, digest, payload = length, None, headers.get("warc-payload-digest"), None
        if headers.get("content-type", "").startswith("application/http"):
            head = stream.until(b"\r\n\r\n")
            left -= len(head)
            size = parse_headers(head).get("content-length")
            size = int(size) if size is not None else None
        if headers.get("warc-type") == "revisit" or self.mode == "skip":
            for _ in stream.blocks(left):
                pass
        else:
            sha, size, kept = hashlib.sha1(usedforsecurity=False), left, []
            for part in stream.blocks(left):
                sha.update(part)
                if self.mode == "bytes":
                    kept.append(part)
            found = base64.b32encode(sha.digest()).decode()
            if digest and digest.startswith("sha1:") and digest != f"sha1:{found}":
                raise ValueError(f"{headers.get('warc-record-id')}: the payload does not have the digest {digest}")
            digest = f"sha1:{found}"
            payload = b"".join(kept) if self.mode == "bytes" else None
        bare = digest.removeprefix("sha1:") if digest else None
        return (*(headers.get(h) for h in HEADERS.values()), length, size, bare, payload)


class Written(WriterCommitMessage):
    def __init__(self, name: str | None):
        self.name = name


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.level = int(options.get("level", "1"))

    def block(self, kind: str, headers: list[tuple[str, str | None]], body: bytes) -> bytes:
        lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers if v is not None),
                 f"WARC-Date: {self.date}", f"Content-Length: {len(body)}"]
        head = "WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n"
        return gzip.compress(head.encode() + body + b"\r\n\r\n", self.level, mtime=0)

    def response(self, kind, record_id, uri, refers_to, digest, payload) -> bytes:
        payload = payload or b""
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {len(payload)}\r\n\r\n").encode()
        uri = quote(uri, safe="%/:=&?~#+!$,;'@()*[]") if uri is not None else None
        headers = [("WARC-Record-ID", record_id), ("WARC-Target-URI", uri),
                   ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", refers_to),
                   ("WARC-Profile", PROFILE if kind == "revisit" else None),
                   ("Content-Type", "application/http;msgtype=response")]
        return self.block(kind, headers, http if kind == "revisit" else http + payload)

    def write(self, iterator):
        where, folder = open_folder(self.folder)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        out = None
        for batch in iterator:
            for i in range(0, batch.num_rows, 64):
                for r in batch.slice(i, 64).to_pylist():
                    if out is None:
                        out = where.open_output_stream(f"{folder}/{name}", compression=None)
                        info = b"software: aislekit\r\nformat: WARC File Format 1.1\r\n"
                        out.write(self.block("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                                          ("Content-Type", "application/warc-fields")], info))
                    out.write(self.response(*(r[c] for c in WRITE_COLUMNS)))
        if out is not None:
            out.close()
        return Written(name if out is not None else None)

    def commit(self, messages):
        where, folder = open_folder(self.folder)
        names = sorted(m.name for m in messages if m is not None and m.name)
        with where.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages):
        where, folder = open_folder(self.folder)
        for m in messages:
            if m is not None and m.name:
                where.delete_file(f"{folder}/{m.name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def write_warc(records: DataFrame, path: str) -> None:
    """Write records (WRITE_COLUMNS) as archives under ``path``, a folder that is new or empty."""
    records.sparkSession.dataSource.register(WarcSource)
    where, folder = open_folder(path)
    where.create_dir(folder, recursive=True)
    records.select(*WRITE_COLUMNS).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: str = "bytes") -> DataFrame:
    """Records under ``path``; filters on header columns are pushed down to the header scan."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", payload).load(path)


def records_of(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A record per page: of equal payloads the smallest page_id responds, the others revisit it.

    Payloads under ``min_bytes`` all respond.  Null html is an empty payload.
    Rows that repeat the smallest page_id all respond; a null page_id revisits
    if a page with an id has the same payload.
    """
    made = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("__sha1", F.unhex(F.sha1("payload")))
    first = (made.where(F.octet_length("payload") >= min_bytes).select("page_id", "__sha1")
             .groupBy("__sha1").agg(F.min("page_id").alias("__first"), F.count(F.lit(1)).alias("__n"))
             .where("__n > 1 and __first is not null").drop("__n"))
    # equal payloads meet on their digest without the payload; pages are joined by id, which is never hot
    revisits = (made.where(F.octet_length("payload") >= min_bytes).select("page_id", "__sha1").distinct()
                .join(first, "__sha1").where(~F.col("page_id").eqNullSafe(F.col("__first"))))
    joined = made.alias("m").join(
        revisits.alias("r"), F.col("m.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("m.__sha1") == F.col("r.__sha1")),
        "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return joined.select(
        F.when(F.col("r.__first").isNull(), "response").otherwise("revisit").alias("record_type"),
        urn(F.col("m.page_id")).alias("record_id"), F.col("m.url").alias("target_uri"),
        F.when(F.col("r.__first").isNotNull(), urn(F.col("r.__first"))).alias("refers_to"),
        F.hex("m.__sha1").alias("payload_digest"), F.col("m.payload"))


def base32_of_hex(c: Column) -> Column:
    """Base 32 of a 20-byte digest given in hex: five hex digits are four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for i in range(0, 40, 5):
        n = F.conv(F.substring(c, i + 1, 5), 16, 10).cast("int")
        out += [F.substr(letters, F.shiftright(n, 15 - 5 * j).bitwiseAND(31) + 1, F.lit(1)) for j in range(4)]
    return F.concat(*out)


def op4_warc(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    path = Scratch(pages.sparkSession, "warc").path("archives")
    records = records_of(pages, min_bytes).withColumn("payload_digest", base32_of_hex(F.col("payload_digest")))
    write_warc(records, path)
    page = lambda c: F.nullif(F.regexp_extract(c, "<urn:page:(-?[0-9]*)>", 1), F.lit("")).cast("long")
    return (read_warc(pages.sparkSession, path, payload="digest")
            .where(F.col("record_type").isin("response", "revisit"))
            .select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    page("refers_to").alias("refers_to")))
