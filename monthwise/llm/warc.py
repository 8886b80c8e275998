"""WARC archives as a Spark data source, and a page archive that stores equal payloads once.

Writing: each task streams its records into ``.warc.gz`` files of about ``FILE_BYTES``, a gzip member per record
whose extra field ``sl`` holds the member's compressed and plain length.  Files get their final name at commit, so
attempts of lost executors are never read.

Reading: partitions are groups of files planned on the driver.  Of each record the headers are parsed first; filters
on header columns are pushed into the scan, and of records they reject, or when payloads aren't wanted, the payload
is not inflated where ``sl`` allows a seek, and never decoded otherwise.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter,
                                    In, InputPartition, IsNotNull, IsNull, StringContains, StringEndsWith,
                                    StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from monthwise.llm.common import col

FILE_BYTES = 64 << 20
HEAD_BYTES = 4096
BATCH_BYTES = 8 << 20
SCHEMA = ("record_id string, record_type string, target_uri string, payload_digest string, payload_bytes long, "
          "refers_to string, payload binary")
# WARC header names of the columns, and the profile of records that repeat a payload.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, payload_digest string, " \
    "payload_bytes long, refers_to string, payload binary"


def _plain(value: str) -> str:
    """A header value on one line: control characters percent-encoded, edge blanks too."""
    out = "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)
    return out if out == out.strip() else out.replace(" ", "%20")


def record(row: dict, date: str) -> bytes:
    """One WARC record; a revisit carries the HTTP headers of the payload but not the payload."""
    body = row["payload"] or b"" if row["record_type"] == "response" else b""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
            % row["payload_bytes"])
    head = [f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", f"WARC-Date: {date}"]
    if row["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {_plain(row['target_uri'])}")
    head.append(f"WARC-Payload-Digest: sha256:{row['payload_digest']}")
    if row["refers_to"] is not None:
        head += [f"WARC-Refers-To: <{row['refers_to']}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + http + body + b"\r\n\r\n"


def member(plain: bytes, level: int = 1) -> bytes:
    """A gzip member with the lengths of itself in the extra field ``sl``."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    data = squeeze.compress(plain) + squeeze.flush()
    size = 10 + 2 + 12 + len(data) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, size, len(plain) & 0xFFFFFFFF)
            + data + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, date: str):
        self.path, self.date = path, date

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = pafs.FileSystem.from_uri(self.path)
        stem = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        names, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    names.append(f"{stem}-{len(names):04d}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/_{names[-1]}", compression=None), 0
                data = member(record(row, self.date))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for message in messages:
            for name in message.names if message else []:
                fs.move(f"{root}/_{name}", f"{root}/{name}")

    def abort(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for message in messages:
            for name in message.names if message else []:
                fs.delete_file(f"{root}/_{name}")


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, path: str, options: dict):
        self.path = path
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            kinds = {EqualTo: "eq", EqualNullSafe: "same", In: "in", IsNotNull: "set", IsNull: "unset",
                     StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "has"}
            if name in HEADERS and type(f) in kinds:
                self.filters.append((name, kinds[type(f)], getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, values: dict) -> bool:
        for name, kind, want in self.filters:
            have = values[name]
            if kind == "set":
                ok = have is not None
            elif kind == "unset":
                ok = have is None
            elif kind == "same":
                ok = have == want
            elif have is None or want is None:
                ok = False
            else:
                ok = {"eq": lambda: have == want, "in": lambda: have in want, "starts": lambda: have.startswith(want),
                      "ends": lambda: have.endswith(want), "has": lambda: want in have}[kind]()
            if not ok:
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        """Files grouped to about FILE_BYTES, in the order of their names."""
        fs, root = pafs.FileSystem.from_uri(self.path)
        files = sorted((f.path, f.size) for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
                       if f.is_file and f.base_name.endswith((".warc", ".warc.gz")) and f.base_name[0] not in "_.")
        groups, held = [], FILE_BYTES
        for path, size in files:
            if held + size > FILE_BYTES:
                groups.append([])
                held = 0
            groups[-1].append(path)
            held += size
        return [_Files(g) for g in groups] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string())
                            for n in (c.split()[0] for c in SCHEMA.split(", "))])
        rows, held = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                for row in self._zipped(file) if path.endswith(".gz") else self._unzipped(file):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 512
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _row(self, values: dict, found: dict, block: bytes) -> dict:
        """The record's columns from its headers and its whole block (or as much of it as holds its HTTP headers).

        An HTTP message's payload is what follows its headers, as it is stored (a chunked body stays chunked); of any
        other record it is the block.  A revisit has none: its size is the one that its HTTP headers name.
        """
        length, size, body = int(found["content-length"]), None, block
        if self._is_http(found):
            http, blank, body = block.partition(b"\r\n\r\n")
            named = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
            size = max(length - len(http) - len(blank), 0)
            if values["record_type"] == "revisit" and named.get(b"content-length", b"").isdigit():
                size = int(named[b"content-length"])
        else:
            size = length
        if self.verify and values["record_type"] == "response":
            self._check(values, found, body, size)
        revisit = values["record_type"] == "revisit"
        return values | {"payload_bytes": size, "payload": body if self.payload and not revisit else None}

    @staticmethod
    def _is_http(found: dict) -> bool:
        return found.get("content-type", "").replace(" ", "").lower().startswith("application/http")

    @staticmethod
    def _check(values: dict, found: dict, body: bytes, size: int) -> None:
        """Digests that are known by their label: sha256 as hex, sha1 as base 32 (the usual one of crawls)."""
        label = found.get("warc-payload-digest", "").partition(":")[0].strip().lower()
        have = {"sha256": lambda: hashlib.sha256(body).hexdigest(),
                "sha1": lambda: base64.b32encode(hashlib.sha1(body).digest()).decode().lower()}.get(label)
        if len(body) != size or have is not None and have() != values["payload_digest"]:
            raise ValueError(f"{values['record_id']}: the payload doesn't match its digest")

    @staticmethod
    def _headers(raw: bytes) -> tuple[dict, dict]:
        """The columns' values and all headers (names in lower case)."""
        lines = raw.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        found = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        values = {c: found.get(h.lower()) for c, h in HEADERS.items()}
        for name in ("record_id", "refers_to"):
            values[name] = values[name] and values[name].strip("<>")
        values["payload_digest"] = values["payload_digest"] and values["payload_digest"].partition(":")[2].lower()
        return values, found

    @property
    def _needs_body(self) -> bool:
        return self.payload or self.verify

    def _unzipped(self, file) -> Iterator[dict]:
        while True:
            begin, head = file.tell(), b""
            while b"\r\n\r\n" not in head:
                more = file.read(HEAD_BYTES)
                if not more:
                    break
                head += more
            if not head.strip():
                return
            if b"\r\n\r\n" not in head:
                raise ValueError("the archive ends inside a record")
            end = head.index(b"\r\n\r\n")
            values, found = self._headers(head[:end])
            length = int(found["content-length"])
            if self.wanted(values):
                file.seek(begin + end + 4)
                block = file.read(length if self._needs_body else min(length, HEAD_BYTES))
                while not self._needs_body and self._is_http(found) and b"\r\n\r\n" not in block and len(block) < length:
                    block += file.read(min(length - len(block), HEAD_BYTES))
                yield self._row(values, found, block)
            file.seek(begin + end + 4 + length + 4)

    def _zipped(self, file) -> Iterator[dict]:
        while True:
            begin = file.tell()
            data = file.read(HEAD_BYTES)
            if not data:
                return
            size = None
            if len(data) >= 24 and data[3] & 4 and data[12:14] == b"sl":
                size = struct.unpack("<I", data[16:20])[0]
            inflate = zlib.decompressobj(31)
            plain = inflate.decompress(data)
            while b"\r\n\r\n" not in plain and not inflate.eof and (data := file.read(HEAD_BYTES)):
                plain += inflate.decompress(data)
            head, _, block = plain.partition(b"\r\n\r\n")
            values, found = self._headers(head)
            length, wanted = int(found["content-length"]), self.wanted(values)
            if wanted and self._needs_body or size is None:
                parts = [block]
                while not inflate.eof and (data := file.read(1 << 16)):
                    piece = inflate.decompress(data)
                    if wanted:
                        parts.append(piece)
                if not inflate.eof:
                    raise ValueError("the archive ends inside a record")
                block = b"".join(parts)
                size = file.tell() - len(inflate.unused_data) - begin
            elif wanted:
                while (self._is_http(found) and b"\r\n\r\n" not in block and not inflate.eof
                       and (data := file.read(HEAD_BYTES))):
                    block += inflate.decompress(data)
            if wanted:
                yield self._row(values, found, block[:length])
            file.seek(begin + size)


class WarcSource(DataSource):
    """``format("warc")``.  Options when reading: ``payload`` (true) and ``verify`` (false: check digests)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        fs, root = pafs.FileSystem.from_uri(self.options["path"])
        fs.create_dir(root, recursive=True)
        return WarcWriter(self.options["path"], self.options.get("date", "2024-01-01T00:00:00Z"))


def use_warc(spark: SparkSession) -> None:
    """Register the source in a session and let its filters reach the scan."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", smallest: int = 100, urn: str = "urn:page:") -> None:
    """Write a record per row; of equal payloads of at least ``smallest`` bytes all but one become revisits.

    The row with the smallest id is the response, the others refer to it (rows that repeat that id are responses
    too).  Null and empty payloads are empty responses.  A null id is written as ``urn:page:null`` and is never
    referred to; a null url has no header; control characters in urls are percent-encoded.  An empty table writes
    no record.  Other columns are not written, so extra names can't clash.  Only ids and digests are shuffled for
    the grouping: groups are combined before the shuffle, however many copies they hold.
    """
    use_warc(pages.sparkSession)
    payload = F.coalesce(col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(col(id_col).cast("long").alias("id"), col(url_col).cast("string").alias("target_uri"),
                        payload.alias("payload"))
    figures = rows.select("id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("bytes"))
    firsts = (figures.where(F.col("bytes") >= smallest).groupBy("digest")
              .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL"))
    revisits = (figures.join(firsts.select("digest", "first"), "digest").where("NOT id <=> first")
                .select("id", "digest", "first").distinct())
    urn_of = lambda c: F.concat(F.lit(urn), F.coalesce(c.cast("string"), F.lit("null")))
    named = rows.withColumn("payload_digest", F.sha2("payload", 256))
    found = named.join(revisits.withColumnRenamed("id", "rid").withColumnRenamed("digest", "rdigest"),
                       F.expr("id <=> rid AND payload_digest = rdigest"), "left")
    is_revisit = F.col("first").isNotNull()
    (found.select(urn_of(F.col("id")).alias("record_id"),
                  F.when(is_revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
                  "payload_digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
                  F.when(is_revisit, urn_of(F.col("first"))).alias("refers_to"),
                  F.when(~is_revisit, F.col("payload")).alias("payload"))
     .write.format("warc").mode("append").save(path))


def read_archive(spark: SparkSession, path: str, payload: bool = True, verify: bool = False) -> DataFrame:
    """The records of the archives in ``path`` (columns of ``SCHEMA``)."""
    use_warc(spark)
    return (spark.read.format("warc").option("payload", str(payload).lower()).option("verify", str(verify).lower())
            .load(path))
