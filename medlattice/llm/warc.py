"""A Python data source for WARC archives, and deduplicated writing.

Reading plans one partition per group of files, takes over equality and IN predicates on the record
type and on header fields, reads each record's headers first, and decodes the payload only of records that are
wanted and only if the payload is asked for. Every record is a gzip member whose header tells its
compressed length (an extra field), so unwanted payloads of archives written here are not even inflated; in other archives
they are inflated and dropped. Writing puts each task's records into files of its own attempt; a manifest, written
last, names the files of successful tasks, and the reader takes only those.
"""

from __future__ import annotations

import glob
import io
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from medlattice.llm.common import settle, shared_path

SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
          "content_length long, headers map<string,string>, payload binary")
# column -> WARC header
FIELDS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
          "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
MANIFEST = "_manifest"
ROLL_BYTES = 256 << 20
BLOCK = 1 << 16


def _store(path: str):
    """(file system or None for local files, path on it)."""
    if path.startswith("file:"):
        return None, "/" + path[5:].lstrip("/")
    if "://" not in path:
        return None, path
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _open(path: str, mode: str):
    store, name = _store(path)
    if store is None:
        if mode == "wb":
            os.makedirs(os.path.dirname(name), exist_ok=True)
        return open(name, mode)
    if mode == "wb":
        store.create_dir(os.path.dirname(name), recursive=True)
        return store.open_output_stream(name)
    return store.open_input_file(name)


def list_archives(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of an archive folder (by its manifest, if it has one) or of one file."""
    store, name = _store(path)
    if store is None:
        if os.path.isfile(name):
            return [(name, os.path.getsize(name))]
        named = os.path.join(name, MANIFEST)
        if os.path.exists(named):
            with open(named) as f:
                files = [os.path.join(name, x) for x in f.read().split()]
        else:
            files = sorted(glob.glob(os.path.join(glob.escape(name), "*.warc*")))
        return [(f, os.path.getsize(f)) for f in files]
    from pyarrow import fs

    if store.get_file_info(name).type == fs.FileType.File:
        return [(path, store.get_file_info(name).size)]
    root = path.rstrip("/")
    found = {os.path.basename(i.path): i.size for i in store.get_file_info(fs.FileSelector(name))}
    if MANIFEST in found:
        with store.open_input_file(f"{name}/{MANIFEST}") as f:
            return [(f"{root}/{x}", found[x]) for x in f.read().decode().split()]
    return [(f"{root}/{x}", n) for x, n in sorted(found.items()) if ".warc" in x]


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member with its own length in an extra field ``SL``."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\x00\xff" + struct.pack("<H", 12) + b"SL" + struct.pack("<H", 8)
    total = len(head) + 8 + len(body) + 8
    return head + struct.pack("<Q", total) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def format_record(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """A WARC/1.1 record. Line breaks in header values become spaces."""
    lines = ["WARC/1.1"] + [f"{k}: {' '.join(v.split())}" for k, v in headers] + [f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    name = None
    for line in lines[1:]:
        if line[:1] in " \t" and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


class _Inflated:
    """Bytes of a stream of gzip members, read in order; knows each member's place."""

    def __init__(self, f):
        self.f, self.raw, self.data, self.engine = f, b"", b"", None

    def _more(self) -> bool:
        block = self.raw or self.f.read(BLOCK)
        self.raw = b""
        if not block:
            return False
        if self.engine is None:
            self.engine = zlib.decompressobj(31)
        self.data += self.engine.decompress(block)
        if self.engine.eof:
            self.raw, self.engine = self.engine.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        at = 0
        while (k := self.data.find(mark, at)) < 0:
            at = max(0, len(self.data) - len(mark))
            if not self._more():
                return None
        out, self.data = self.data[:k], self.data[k + len(mark):]
        return out

    def take(self, n: int, keep: bool) -> bytes:
        parts = []
        while n:
            if not self.data and not self._more():
                raise EOFError("the archive ends within a record")
            got, self.data = self.data[:n], self.data[n:]
            n -= len(got)
            if keep:
                parts.append(got)
        return b"".join(parts)


class _Plain(_Inflated):
    """The same for an archive that is not compressed: unwanted payloads are skipped by seeking."""

    def _more(self) -> bool:
        block = self.f.read(BLOCK)
        self.data += block
        return bool(block)

    def take(self, n: int, keep: bool) -> bytes:
        if not keep and n > len(self.data):
            self.f.seek(n - len(self.data), io.SEEK_CUR)
            self.data = b""
            return b""
        return super().take(n, keep)


def read_records(f, wanted, payloads: bool = True) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records of an open archive whose headers are ``wanted``."""
    start = f.read(2)
    f.seek(0)
    if start == b"\x1f\x8b":
        place = 0
        while True:
            head = f.read(24)
            if len(head) < 24 or head[:4] != b"\x1f\x8b\x08\x04" or head[12:16] != b"SL\x08\x00":
                f.seek(place)
                break
            total = struct.unpack("<Q", head[16:24])[0]
            f.seek(place)
            own = _Inflated(io.BytesIO(f.read(min(total, BLOCK))))
            top = own.until(b"\r\n\r\n")
            if top is None:  # headers beyond the first block
                f.seek(place)
                own = _Inflated(io.BytesIO(f.read(total)))
                top = own.until(b"\r\n\r\n")
            headers = _parse_head(top.lstrip(b"\r\n"))
            if wanted(headers):
                body = None
                if payloads:
                    if total > BLOCK:
                        own.f = io.BytesIO(own.f.read() + f.read(total - BLOCK))
                    body = own.take(int(headers.get("content-length", 0)), True)
                yield headers, body
            place += total
            f.seek(place)
        stream = _Inflated(f)
    else:
        stream = _Plain(f)
    while (top := stream.until(b"\r\n\r\n")) is not None:
        if not top.strip():
            continue
        headers = _parse_head(top.lstrip(b"\r\n"))
        keep = wanted(headers)
        body = stream.take(int(headers.get("content-length", 0)), keep and payloads)
        if keep:
            yield headers, body if payloads else None


@dataclass
class Archives(InputPartition):
    files: tuple


class WarcReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path = options["path"]
        self.payloads = "payload" in schema.names
        self.columns = schema.names
        self.target = int(options.get("partitionbytes", 128 << 20))
        self.equal: dict[str, tuple] = {}

    def partitions(self):
        out, files, used = [], [], 0
        for name, size in list_archives(self.path):
            if files and used + size > self.target:
                out.append(Archives(tuple(files)))
                files, used = [], 0
            files.append(name)
            used += size
        return out + [Archives(tuple(files))] if files else out or [Archives(())]

    def read(self, partition):
        equal = self.equal

        def wanted(headers):
            return all(n in headers if v is None else headers.get(n) in v for n, v in equal.items())

        for name in partition.files:
            with _open(name, "rb") as f:
                for headers, body in read_records(f, wanted, self.payloads):
                    row = {c: headers.get(h) for c, h in FIELDS.items()}
                    row |= {"content_length": int(headers.get("content-length", 0)), "headers": headers, "payload": body}
                    yield tuple(row[c] for c in self.columns)


class PushDownWarcReader(WarcReader):
    """The same, taking over predicates (Spark allows this where spark.sql.python.filterPushdown.enabled is set)."""

    def pushFilters(self, filters):
        for f in filters:
            name = self._header(getattr(f, "attribute", ()))
            if isinstance(f, EqualTo) and name and isinstance(f.value, str):
                self._only(name, (f.value,))
            elif isinstance(f, In) and name and all(isinstance(v, str) for v in f.value):
                self._only(name, tuple(f.value))
            else:
                if isinstance(f, IsNotNull) and name:
                    self.equal.setdefault(name, None)  # any value
                else:
                    yield f

    def _only(self, name, values):
        known = self.equal.get(name)
        self.equal[name] = values if known is None else tuple(v for v in known if v in values)

    @staticmethod
    def _header(attribute) -> str | None:
        if len(attribute) == 1:
            return FIELDS.get(attribute[0])
        return None


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceWriter):
    """Rows (headers map<string,string>, payload binary) as records."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")

    def write(self, rows):
        stem, files, out, size = uuid.uuid4().hex, [], None, 0
        try:
            for row in rows:
                if out is None:
                    files.append(f"part-{stem}-{len(files):04d}.warc.gz")
                    out, size = _open(f"{self.path}/{files[-1]}", "wb"), 0
                member = gzip_member(format_record(list(row["headers"].items()), bytes(row["payload"] or b"")))
                out.write(member)
                size += len(member)
                if size >= ROLL_BYTES:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages):
        names = [f for m in messages if m is not None for f in m.files]
        with _open(f"{self.path}/{MANIFEST}", "wb") as f:
            f.write("\n".join(sorted(names)).encode())

    def abort(self, messages):
        """Files of a failed write stay unnamed: no manifest lists them."""


class WarcDataSource(DataSource):
    """Format ``warc``. Options: path; partitionBytes (bytes of files per partition), pushDown (take over
    predicates; needs spark.sql.python.filterPushdown.enabled)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        options = {k.lower(): v for k, v in self.options.items()}
        return (PushDownWarcReader if options.get("pushdown") == "true" else WarcReader)(options, schema)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, columns: str | None = None) -> DataFrame:
    """Records of an archive or a folder of archives; ``columns``: a schema of the columns to read (default: all).

    Sets spark.sql.python.filterPushdown.enabled for the session: Spark asks the source for predicates only with it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("warc").option("pushDown", "true")
    if columns:
        reader = reader.schema(columns)
    return reader.load(path)


def archive_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """(headers, payload) of one record per page. Of equal payloads of at least ``least_bytes`` bytes, that with the
    largest id is a response, the others revisit it, without the payload; smaller payloads are all responses.

    Null html: an empty payload. Null url: no target. Null id: no page number; it is never the response unless its group has
    no id at all. Rows that repeat the response's id are responses too. Equal payloads are compared by SHA-256 and length.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = (pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
            .withColumn("bytes", F.octet_length("payload").cast("long")))
    key = F.when(F.col("bytes") >= least_bytes, F.sha2("payload", 256))
    groups = settle(rows.select(key.alias("sha"), "id").where("sha is not null").groupBy("sha")
                    .agg(F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n"), "payloads")
    joined = rows.withColumn("sha", key).join(groups, "sha", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    headers = F.map_filter(F.create_map(
        F.lit("WARC-Type"), F.when(revisit, "revisit").otherwise("response"),
        F.lit("WARC-Record-ID"), F.coalesce(name(F.col("id")), F.lit("<urn:page:>")),
        F.lit("WARC-Date"), F.lit("1970-01-01T00:00:00Z"),
        F.lit("WARC-Target-URI"), F.col("url"),
        F.lit("WARC-Payload-Digest"), F.concat(F.lit("sha1:"), F.sha1("payload")),
        F.lit("WARC-Refers-To"), F.when(revisit, name(F.col("keeper"))),
        F.lit("WARC-Profile"), F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.lit("X-Payload-Length"), F.col("bytes").cast("string")), lambda k, v: v.isNotNull())
    return joined.select(headers.alias("headers"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write (headers, payload) as archives below ``path``."""
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").mode("append").option("path", path).save()


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", path: str | None = None) -> DataFrame:
    """Write the pages as WARC archives (below ``path``, or the shared folder) and read them back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri), one row per page.

    A response's length and digest are those of the payload read back; a revisit's are in its headers. An empty table gives no rows."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_warc(archive_records(pages, id_col, url_col, html_col), path)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    to_id = lambda c: F.when(number(c) != "", number(c)).cast("long")
    response = read_warc(spark, path, "record_type string, record_id string, target_uri string, payload binary").where("record_type = 'response'")
    revisit = read_warc(spark, path, "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
                                     "headers map<string,string>").where("record_type = 'revisit'")
    own = response.select(to_id(F.col("record_id")).alias(id_col), F.octet_length("payload").cast("long").alias("payload_bytes"),
                          F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"), "target_uri")
    other = revisit.select(to_id(F.col("record_id")).alias(id_col), F.col("headers")["x-payload-length"].cast("long").alias("payload_bytes"),
                           F.regexp_extract("payload_digest", "^sha1:(.*)$", 1).alias("payload_digest"), "record_type",
                           to_id(F.col("refers_to")).alias("refers_to"), "target_uri")
    return own.unionByName(other)
