"""Converter from legacy ARC archives to WARC, and readers of both.

An ARC record is one header line and as many bytes as that line declares.
Version 1 lines have five fields, version 2 lines ten; a ``filedesc`` record
opens an archive and names its version.  The converter reads each archive as a
stream, cuts records by the declared lengths and writes, for each, a WARC
record with a synthesised identifier, timestamp, type and digests.  Records of
equal payload are stored once: the others become ``revisit`` records that name
the stored one.

Archives are written by Spark's text writer (a record is one value; the bytes
that the format asks for between records are the line separator) and read by
its ``binaryFile`` reader, so they may be in any store that Spark reads.
Archives are cut by bytes, so no task holds more than about one archive.

Defined cases: null payload is empty; null url is written as ``about:blank``,
blanks and control bytes in urls are percent-encoded; a null page id has no id
header and reads back as null; among equal payloads the smallest page id is
stored (nulls last, then the place in the archives), so repeated rows give one
response; an empty table gives no archive and no rows; other columns are not
read.  A header line that fits no version, or a declared length that the file
does not hold, raises ``ArchiveError`` with the place.
"""

from __future__ import annotations

import base64
import hashlib
import time
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kollektiv.llm.common import arrow_map, scratch_path, stage_table

#: Uncompressed bytes after which a writer begins another archive.
ARCHIVE_BYTES = 8 << 20
#: Seconds since 1970 of the first capture; page n is captured n seconds later.
FIRST_CAPTURE = 1_704_067_200
_V1 = b"URL IP-address Archive-date Content-type Archive-length"
_V2 = (b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length")
_HTTP_END = b"\r\n\r\n"
_RECORD_NAMES = uuid.UUID("6f1c8b0e-52a4-4f0c-9d59-0f1b8b9b7a11")


class ArchiveError(ValueError):
    """An archive that does not hold what its headers declare."""


# ---- bytes of one archive -------------------------------------------------

class _Stream:
    """Reads lines and exact lengths from (gzipped or plain) bytes, holding
    little more than the record at hand."""

    def __init__(self, raw: bytes, step: int = 1 << 18):
        self.raw, self.step, self.at = memoryview(raw), step, 0
        self.zip = zlib.decompressobj(31) if raw[:2] == b"\x1f\x8b" else None
        self.buf, self.pos, self.offset = b"", 0, 0

    def _more(self) -> bool:
        while self.at < len(self.raw):
            piece = self.raw[self.at:self.at + self.step]
            self.at += len(piece)
            out = self._unzip(bytes(piece)) if self.zip else bytes(piece)
            if out:
                self.buf = self.buf[self.pos:] + out
                self.pos = 0
                return True
        return False

    def _unzip(self, piece: bytes) -> bytes:
        out = []
        while piece:
            out.append(self.zip.decompress(piece))
            piece = self.zip.unused_data
            if self.zip.eof:
                self.zip = zlib.decompressobj(31)
        return b"".join(out)

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the archive."""
        seen = 0
        while (i := self.buf.find(b"\n", self.pos + seen)) < 0:
            seen = len(self.buf) - self.pos
            if not self._more():
                if seen:
                    raise ArchiveError(f"unfinished header line at {self.offset}")
                return None
        out = self.buf[self.pos:i]
        self.offset += i + 1 - self.pos
        self.pos = i + 1
        return out.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        parts, need = [], n
        while len(self.buf) - self.pos < need:
            parts.append(self.buf[self.pos:])
            need -= len(parts[-1])
            self.buf, self.pos = b"", 0
            if not self._more():
                raise ArchiveError(f"{n} bytes declared at {self.offset}, {n - need} found")
        parts.append(self.buf[self.pos:self.pos + need])
        self.pos += need
        self.offset += n
        return b"".join(parts)


def arc_records(raw: bytes) -> Iterator[dict]:
    """Records of an ARC archive: offset, version, url, ip, date, mime,
    status (version 2; else None), block."""
    s = _Stream(raw)
    while True:
        at = s.offset
        line = s.line()
        if line is None:
            return
        if not line:                       # the newline between records
            continue
        f = line.split(b" ")
        if len(f) not in (5, 10) or not f[-1].isdigit():
            raise ArchiveError(f"no ARC header line at {at}: {line[:120]!r}")
        block = s.take(int(f[-1]))
        if f[0].startswith(b"filedesc:"):
            version = block.split(b" ", 1)[0]
            if version not in (b"1", b"2"):
                raise ArchiveError(f"ARC version {version[:20]!r} at {at}")
            continue
        yield {"offset": at, "version": 1 if len(f) == 5 else 2, "url": f[0], "ip": f[1], "date": f[2], "mime": f[3],
               "status": f[4] if len(f) == 10 else None, "block": block}


def warc_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each WARC record."""
    s = _Stream(raw)
    while (line := s.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"no WARC record at {s.offset}: {line[:120]!r}")
        head = {}
        while line := s.line():
            k, _, v = line.partition(b":")
            head[k.decode().lower()] = v.strip().decode()
        yield head, s.take(int(head["content-length"]))


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(head with its empty line, payload)."""
    i = block.find(_HTTP_END)
    return (b"", block) if i < 0 else (block[:i + 4], block[i + 4:])


def page_id_of(head: bytes) -> int | None:
    for line in head.split(b"\r\n"):
        if line.lower().startswith(b"x-page-id:"):
            return int(line.split(b":", 1)[1])
    return None


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- writing ARC ------------------------------------------------------------

def _filedesc(name: str, version: int, date: bytes) -> bytes:
    body = b"%d 0 kollektiv\n" % version + (_V1 if version == 1 else _V2) + b"\n"
    extra = b"" if version == 1 else b" 200 - - 0 " + name.encode()
    return b"filedesc://%s 0.0.0.0 %s text/plain%s %d\n" % (name.encode(), date, extra, len(body)) + body


def _quoted(url: str | None) -> bytes:
    raw = (url or "about:blank").encode()
    return b"".join(bytes([c]) if 32 < c < 127 or c > 127 else b"%%%02X" % c for c in raw)


def arc_rows(pages: DataFrame) -> DataFrame:
    """archive, value: the records of ARC archives, each after its archive's
    ``filedesc``.  Every other partition writes version 1, the rest version 2."""
    def write(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        version, no, size, offset = 1 + part % 2, -1, ARCHIVE_BYTES, 0
        for b in batches:
            names, values = [], []
            for pid, url, html in zip(b["page_id"].to_pylist(), b["url"].to_pylist(), b["html"].to_pylist(), strict=True):
                payload = (html or "").encode()
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(payload)
                if pid is not None:
                    head += b"X-Page-Id: %d\r\n" % pid
                block = head + b"\r\n" + payload
                date = time.strftime("%Y%m%d%H%M%S", time.gmtime(FIRST_CAPTURE + (pid or 0) % 1_000_000_000)).encode()
                opening = b""
                if size >= ARCHIVE_BYTES:
                    no, size, offset = no + 1, 0, 0
                    opening = _filedesc(f"{part:06d}-{no:06d}.arc", version, date) + b"\n"
                name = f"{part:06d}-{no:06d}"
                extra = b"" if version == 1 else b" 200 - - %d %s.arc" % (offset, name.encode())
                value = opening + b"%s 0.0.0.0 %s text/html%s %d\n" % (_quoted(url), date, extra, len(block)) + block
                size += len(value)
                offset += len(value) + 1
                names.append(name)
                values.append(value)
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(values, pa.binary())], ["archive", "value"])
    return pages.select("page_id", "url", "html").mapInArrow(write, "archive string, value binary")


def write_archives(rows: DataFrame, path: str, separator: str, order: tuple[str, ...] = ()) -> None:
    """One gzipped file per ``archive``; ``value`` bytes are written as they are."""
    if order:
        rows = rows.sortWithinPartitions("archive", *order)
    (rows.select("archive", F.col("value").cast("string").alias("value")).write.partitionBy("archive")
     .option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def archives(spark: SparkSession, path: str) -> DataFrame:
    """path, content of every archive below ``path``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt*")
            .load(path).select("path", "content"))


# ---- conversion -------------------------------------------------------------

_SCAN = "path string, record_offset long, page_id long, digest binary, n_bytes long, record_id string, url string, captured string"


def _record_id(path: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_RECORD_NAMES, f'{path}#{offset}')}>"


def _captured(date: bytes) -> str:
    d = date.decode().ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _place(path: str) -> str:
    """The archive's folder and file name: the same wherever the store is mounted."""
    return "/".join(path.rsplit("/", 2)[1:])


def scan_arcs(spark: SparkSession, arc_path: str) -> DataFrame:
    """What the conversion decides by, without payloads."""
    def scan(b: pa.RecordBatch):
        for path, raw in zip(b["path"], b["content"], strict=True):
            out = {k: [] for k in ("path", "record_offset", "page_id", "digest", "n_bytes", "record_id", "url", "captured")}
            path = path.as_py()
            for r in arc_records(raw.as_py()):
                head, payload = split_http(r["block"])
                row = (path, r["offset"], page_id_of(head), hashlib.sha1(payload).digest(), len(payload),
                       _record_id(_place(path), r["offset"]), r["url"].decode(), _captured(r["date"]))
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
            types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))
    return arrow_map(archives(spark, arc_path), scan, _SCAN)


def revisits(scanned: DataFrame, least_bytes: int = 0) -> DataFrame:
    """path, revisits: array of (offset, and the stored record's id, url, date)."""
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "record_offset", "record_id", "url", "captured")
    big = scanned.filter(F.col("n_bytes") >= least_bytes)
    stored = big.groupBy("digest").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return (big.join(stored, "digest").filter(F.col("record_id") != F.col("first.record_id"))
            .groupBy("path").agg(F.collect_list(F.struct("record_offset", "first.record_id", "first.url", "first.captured")).alias("revisits")))


def warc_rows(spark: SparkSession, arc_path: str, decided: DataFrame) -> DataFrame:
    """archive, value: WARC records, each archive led by a ``warcinfo``."""
    def convert(b: pa.RecordBatch):
        for path, raw, again in zip(b["path"], b["content"], b["revisits"], strict=True):
            path = path.as_py()
            again = {r["record_offset"]: r for r in again.as_py() or ()}
            name = _place(path).split("/")[0].removeprefix("archive=")
            info = b"software: kollektiv\r\nformat: WARC File Format 1.0\r\n"
            lead = _warc([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(path, -1)), ("WARC-Filename", f"{name}.warc.gz"),
                          ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], info)
            values, size = [lead], 0
            for r in arc_records(raw.as_py()):
                head, payload = split_http(r["block"])
                to = again.get(r["offset"])
                block = head if to else r["block"]
                fields = [("WARC-Type", "revisit" if to else "response"), ("WARC-Record-ID", _record_id(_place(path), r["offset"])),
                          ("WARC-Date", _captured(r["date"])), ("WARC-Target-URI", r["url"].decode()), ("WARC-IP-Address", r["ip"].decode()),
                          ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
                          ("Content-Type", "application/http; msgtype=response")]
                if to:
                    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                               ("WARC-Refers-To", to["record_id"]), ("WARC-Refers-To-Target-URI", to["url"]),
                               ("WARC-Refers-To-Date", to["captured"])]
                values.append(_warc(fields, block))
                size += len(values[-1])
                if size >= 4 << 20:
                    yield _named(name, values)
                    values, size = [], 0
            yield _named(name, values)
    both = archives(spark, arc_path).join(decided, "path", "left").select("path", "content", "revisits")
    return arrow_map(both, convert, "archive string, value binary")


def _warc(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _named(name: str, values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name] * len(values)), pa.array(values, pa.binary())], ["archive", "value"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> None:
    """Convert every ARC archive below ``arc_path`` to a WARC archive."""
    decided = revisits(stage_table(scan_arcs(spark, arc_path), "arc-scan"), least_bytes)
    # rows of an archive are together and in order: no sort
    write_archives(warc_rows(spark, arc_path, decided), warc_path, _HTTP_END.decode())


def read_warcs(spark: SparkSession, warc_path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, record_id,
    refers_to_id of every response and revisit.  A stored payload is checked
    against its digest; a revisit has the bytes of the record it names."""
    def read(b: pa.RecordBatch):
        names = ["page_id", "own_bytes", "payload_digest", "record_type", "record_id", "refers_to_id"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        for path, raw in zip(b["path"], b["content"], strict=True):
            out = []
            for head, block in warc_records(raw.as_py()):
                kind = head["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                http, payload = split_http(block)
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and sha1_base32(payload) != digest:
                    raise ArchiveError(f"{path.as_py()}: payload of {head['warc-record-id']} differs from its digest")
                out.append((page_id_of(http), len(payload), digest, kind, head["warc-record-id"], head.get("warc-refers-to")))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
    rows = arrow_map(archives(spark, warc_path), read, "page_id long, own_bytes long, payload_digest string, record_type string, "
                     "record_id string, refers_to_id string")
    return rows


def pages_through_warc(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    page, read back from the WARC archives made from its ARC archives."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_archives(arc_rows(pages), arc, "\n")
    if not _has_files(spark, arc):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    convert(spark, arc, warc, least_bytes)
    rows = stage_table(read_warcs(spark, warc), "warc-rows")
    stored = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("s_id"), F.col("page_id").alias("s_page"), F.col("own_bytes").alias("s_bytes"))
    return (rows.join(stored, F.col("refers_to_id") == F.col("s_id"), "left")
            .select("page_id", F.coalesce("s_bytes", "own_bytes").alias("payload_bytes"), "payload_digest", "record_type",
                    F.col("s_page").alias("refers_to")))


def _has_files(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return any(s.isDirectory() and s.getPath().getName().startswith("archive=") for s in fs.listStatus(jvm_path))
