"""WARC archives: a Python data source that reads and writes them, and revisit records for repeated payloads.

Reading plans one partition for each archive, or for several small ones; predicates on the record type, on the id, target and
digest are pushed down; headers are parsed first, and the payload of a record that no predicate keeps, or of any record
when ``payload=false``, is skipped by its length without being read or decoded. Compressed archives have one gzip member for each record, with the
member's length in an extra field of its header, so a reader decompresses the head only and seeks past the rest; members of other
writers, without that field, are decompressed through. Writing gives every task its own archives, rolled at ``roll_bytes``, under temporary names
that the commit renames, many at a time; what failed or repeated tasks of the job have left is removed.

Files are opened by pyarrow's file systems (local and shared folders, HDFS, object stores).

Defined cases: a null payload is empty; a null page id is an empty id; line breaks in header values are
percent-escaped; an empty table writes no archive and reads as no rows; of pages with equal ids and equal payloads each that has the smallest id is a
response.
"""

from __future__ import annotations

import gzip
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from ..session import ship
from .common import cut

SCHEMA = "record_type string, record_id string, refers_to string, target_uri string, payload_digest string, payload_length bigint, headers map<string,string>, payload binary, archive string, offset bigint"
#: Header that each column with a pushed predicate stands in.
PUSHED = {"record_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000
#: More repeated digests (some 100 bytes each) than this are joined by a shuffle.
MOST_REPEATED = 500_000


def open_store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# ---- gzip members

#: Extra field of a member's header: its name, and the size of its value, which is the member's length.
LENGTH_FIELD = b"VL\x04\x00"


def packed(record: bytes) -> bytes:
    """A gzip member that tells its own length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush() + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 20 + len(body)
    if size >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + body
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 8) + LENGTH_FIELD + struct.pack("<I", size) + body


def member_size(raw, at: int) -> int | None:
    """Length of the member at a place, 0 at the end of the file, None if it doesn't tell."""
    raw.seek(at)
    head = raw.read(12)
    if not head:
        return 0
    if len(head) == 12 and head[:3] == b"\x1f\x8b\x08" and head[3] & 4:
        extra = raw.read(struct.unpack("<H", head[10:])[0])
        while len(extra) >= 4:
            n = struct.unpack("<H", extra[2:4])[0]
            if extra[:4] == LENGTH_FIELD and len(extra) >= 8:
                return struct.unpack("<I", extra[4:8])[0]
            extra = extra[4 + n :]
    return None


class Member(io.RawIOBase):
    """Reads one member of known length, decompressing no more than is asked for."""

    def __init__(self, raw, at: int, size: int):
        self.raw, self.at, self.end, self.data, self.inflate = raw, at, at + size, b"", zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.inflate.eof:
            if not self.data:
                self.raw.seek(self.at)
                self.data = self.raw.read(min(1 << 16, self.end - self.at))
                self.at += len(self.data)
                if not self.data:
                    raise EOFError("a member is cut off")
            got = self.inflate.decompress(self.data, len(out))
            self.data = self.inflate.unconsumed_tail
            if got:
                out[: len(got)] = got
                return len(got)
        return 0


# ---- records


def _bare(value: str) -> str:
    return value[1:-1] if value.startswith("<") and value.endswith(">") else value


def write_record(out, kind: str, record_id: str, uri: str, payload: bytes, digest: str, length: int, refers_to: str | None, date: str) -> None:
    """A response holds an HTTP head and the payload; a revisit holds the head alone and names what it repeats."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    if kind != "revisit":
        block += payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        head += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in ((k, v.replace("\r", "%0D").replace("\n", "%0A")) for k, v in head))
    out.write(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n")


def _lines(f) -> Iterator[bytes]:
    while (line := f.readline()) not in (b"\r\n", b"\n", b""):
        yield line


def read_headers(f) -> dict[str, str] | None:
    """Headers of the next record by lower-case name; none at the end. Folded lines are joined."""
    line = f.readline()
    while line in (b"\r\n", b"\n"):
        line = f.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not the start of a record: {line[:60]!r}")
    out: dict[str, str] = {}
    last = ""
    for x in _lines(f):
        s = x.decode("utf-8", "replace").rstrip("\r\n")
        if s[:1] in " \t" and last:
            out[last] += " " + s.strip()
        else:
            last, _, value = s.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return out


@dataclass
class Archives(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() != "false"
        self.pack = int(options.get("partition_bytes", 128 << 20))
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters):
        for f in filters:
            at = getattr(f, "attribute", ())
            column = at[0] if len(at) == 1 else None
            if isinstance(f, EqualTo) and column in PUSHED and isinstance(f.value, str):
                self._want(column, {f.value})
            elif isinstance(f, In) and column in PUSHED:
                self._want(column, {v for v in f.value if isinstance(v, str)})
            else:
                yield f

    def _want(self, column: str, values: set[str]) -> None:
        self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self):
        from pyarrow import fs

        store, root = open_store(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)) if store.get_file_info(root).type != fs.FileType.File else [store.get_file_info(root)]
        out: list[list[str]] = []
        room = 0
        for f in sorted((f for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz")) and not f.base_name.startswith((".", "_"))), key=lambda f: f.path):
            if not out or f.size > room:
                out.append([])
                room = self.pack
            out[-1].append(f.path)
            room -= f.size
        return [Archives(p) for p in out] or [Archives([])]

    def _value(self, headers: dict[str, str], column: str) -> str | None:
        value = headers.get(PUSHED[column])
        if value is None:
            return None
        return value.partition(":")[2] if column == "payload_digest" else _bare(value)

    def _members(self, raw, path: str) -> Iterator[tuple]:
        """Records of a compressed archive; behind a member of another writer all is read as one stream."""
        at = 0
        while size := member_size(raw, at):
            yield from self._records(io.BufferedReader(Member(raw, at, size), 4096), path, at, skips=False)
            at += size
        if size is None:
            raw.seek(at)
            yield from self._records(gzip.GzipFile(fileobj=raw), path)

    def _records(self, f, path: str, at: int | None = None, skips: bool = True) -> Iterator[tuple]:
        """Records of a stream; with a place ``at``, the one record that stands there, of which no more than is wanted is read."""
        while True:
            offset = f.tell() if skips else at
            headers = read_headers(f)
            if headers is None:
                return
            left = int(headers.get("content-length", 0))
            values = {c: self._value(headers, c) for c in PUSHED}
            if any(values[c] not in want for c, want in self.wanted.items()):
                if not skips:
                    return
                f.seek(left, io.SEEK_CUR)
                continue
            length, used = None, 0
            if headers.get("content-type", "").startswith("application/http"):
                lines = list(_lines(f))
                used = sum(map(len, lines)) + 2
                head = {k.strip().lower(): v.strip() for k, _, v in (x.decode("latin-1").partition(":") for x in lines)}
                length = int(head["content-length"]) if head.get("content-length", "").isdigit() else None
            left -= used
            payload = None
            if values["record_type"] != "revisit":
                length = left
                if self.with_payload:
                    payload = f.read(left)
                    left = 0
            if skips:
                f.seek(left, io.SEEK_CUR)
            yield (values["record_type"], values["record_id"], values["refers_to"], values["target_uri"], values["payload_digest"], length, headers, payload, path, offset)
            if not skips:
                return

    def read(self, partition):
        store, _ = open_store(self.path)
        kinds = [pa.string()] * 5 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.string(), pa.int64()]
        schema = pa.schema([pa.field(c.split()[0], t) for c, t in zip(SCHEMA.split(", "), kinds)])
        rows, held = [], 0

        def batch():
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array([list(x.items()) for x in c] if i == 6 else c, t) for i, (c, t) in enumerate(zip(cols, kinds))], schema=schema)

        for path in partition.paths:
            with store.open_input_file(path) as raw:
                for r in self._members(io.BufferedReader(raw, 1 << 20), path) if path.endswith(".gz") else self._records(io.BufferedReader(raw, 1 << 20), path):
                    rows.append(r)
                    held += len(r[7] or b"") + 500
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Input columns: kind, record_id, uri, payload, digest, length, refers_to."""

    def __init__(self, options: dict):
        self.path, self.roll = options["path"], int(options.get("roll_bytes", 128 << 20))
        self.date, self.gz = options.get("date", "1970-01-01T00:00:00Z"), options.get("compression") == "gzip"
        self.job = uuid.uuid4().hex[:12]
        store, root = open_store(self.path)
        store.create_dir(root, recursive=True)

    def write(self, iterator):
        store, root = open_store(self.path)
        names, out = [], None
        for b in iterator:
            for r in b.to_pylist():
                if out is not None and out.tell() >= self.roll:
                    out.close()
                    out = None
                if out is None:
                    names.append(f"{self.job}-{uuid.uuid4().hex}.warc{'.gz' * self.gz}")
                    out = store.open_output_stream(f"{root}/.{names[-1]}", compression=None)
                args = (r["kind"], r["record_id"], r["uri"] or "", r["payload"] or b"", r["digest"], r["length"], r["refers_to"], self.date)
                if self.gz:  # one member for each record
                    plain = io.BytesIO()
                    write_record(plain, *args)
                    out.write(packed(plain.getvalue()))
                else:
                    write_record(out, *args)
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages):
        store, root = open_store(self.path)
        with ThreadPoolExecutor(32) as pool:
            list(pool.map(lambda name: store.move(f"{root}/.{name}", f"{root}/{name}"), [n for m in messages if m for n in m.names]))
        self._tidy(store, root)

    def abort(self, messages):
        self._tidy(*open_store(self.path))

    def _tidy(self, store, root: str) -> None:
        """Removes what is left of this job under temporary names."""
        from pyarrow import fs

        left = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.startswith(f".{self.job}-")]
        with ThreadPoolExecutor(32) as pool:
            list(pool.map(store.delete_file, left))


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


# ---- operators


def record_uri(id_column: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(id_column.cast("string"), F.lit("")))


def mark_revisits(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 100) -> DataFrame:
    """Rows for the writer. Of equal payloads of at least ``least_bytes`` the smallest page id is a response.

    The smallest id of each payload is found on digests alone, combined before the shuffle. Payloads that occur twice are named to the others by a
    broadcast while there are at most ``MOST_REPEATED``; above that, payloads of at least ``least_bytes`` are shuffled by digest, and AQE splits
    the partition of a payload that many pages share. Shorter ones never are.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    p = pages.select(F.col(page).alias("page"), F.col(url).cast("string").alias("uri"), payload.alias("payload"))
    p = p.withColumns({"digest": F.sha2("payload", 256), "length": F.octet_length("payload").cast("long")})
    counted = p.where(F.col("length") >= least_bytes).groupBy(F.col("digest").alias("__d")).agg(F.min("page").alias("original"), F.count("*").alias("n"))
    many = cut(counted.where("n > 1 and original is not null").select("__d", "original"))
    if many.count() <= MOST_REPEATED:
        joined = p.join(F.broadcast(many), F.col("digest") == F.col("__d"), "left")
    else:
        long = F.col("length") >= least_bytes
        short = p.where(~long).withColumns({"__d": F.lit(None).cast("string"), "original": F.lit(None).cast(p.schema["page"].dataType)})
        joined = p.where(long).join(many, F.col("digest") == F.col("__d"), "left").unionByName(short)
    again = F.col("original").isNotNull() & ~F.col("page").eqNullSafe(F.col("original"))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("kind"), record_uri(F.col("page")).alias("record_id"), "uri",
        F.when(~again, F.col("payload")).alias("payload"), "digest", "length", F.when(again, record_uri(F.col("original"))).alias("refers_to"),
    )


def write_warc(records: DataFrame, path: str, **options: str) -> None:
    ship(records.sparkSession)
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").options(path=path, **options).save()


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options: str) -> DataFrame:
    """Records of all archives below ``path``. Turns the session's Python filter pushdown on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    ship(spark)
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(path=path, payload=str(payload).lower(), **options).load()

