"""WARC archives as chunked record tables.

A payload never has to be in one piece: a record is a run of rows (record number, chunk number,
bytes), each carrying the digest of all chunks so far. Writers feed such rows into gzip members as
they come, readers give them back while a file streams by. Payloads that repeat are written once,
as the response of the largest id; the others are revisit records that point at it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierlake.session import materialize, shared_folder

CHUNK_BYTES = 256 * 1024      # bytes of a payload in one row
BATCH_CHUNKS = 64             # rows of a record table handed on at once
ARCHIVE_BYTES = 1 << 30       # a writer begins the next file beyond this size
BROADCAST_ROWS = 500_000      # repeated digests, some 100 bytes each, that may be broadcast
_READ = 1 << 20
_ID = "urn:x-page:"           # record ids; the number after it is the row's id
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_digest(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def decide_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds digest (hexadecimal SHA-1), bytes and original to ``pages(id, url, payload)``.

    ``original`` is the id of the response that a revisit refers to, null for responses. Payloads
    of equal digest and at least ``least_bytes`` bytes repeat each other; rows that share the
    largest id are all responses. Only digests are shuffled where the repeated ones are few enough
    to broadcast; beyond that a join moves the rows, and its skewed digests are split by Spark.
    """
    described = pages.withColumns({
        "digest": F.sha1(F.encode("payload", "UTF-8")), "bytes": F.octet_length("payload").cast("long")})
    repeated = materialize(
        described.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
        .agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    found = described.join(repeated, ["digest", "bytes"], "left")
    return found.withColumn("original", F.when(~F.col("id").eqNullSafe(F.col("largest")), F.col("largest"))).drop("largest")


def to_chunks(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each chunk of a payload, in order within its partition; revisits have one empty chunk."""
    payload = F.encode(F.when(F.col("original").isNull(), F.col("payload")).otherwise(F.lit("")), "UTF-8")
    whole = pages.select(
        F.col("id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), "digest", "bytes", "original",
        payload.alias("data"))
    chunks = F.greatest(F.ceil(F.octet_length("data") / chunk_bytes), F.lit(1)).cast("int")
    spread = whole.withColumn("chunks", chunks).withColumn("chunk", F.explode(F.sequence(F.lit(1), "chunks")))
    return spread.withColumn("data", F.substring("data", (F.col("chunk") - 1) * chunk_bytes + 1, F.lit(chunk_bytes)))


def _head(row: dict, moment: str) -> bytes:
    """The record's headers, and the HTTP headers that begin its block."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n").encode()
    revisit = row["original"] is not None
    url = "".join(c for c in row["url"] or "" if c > " ")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_ID}{'' if row['id'] is None else row['id']}>", f"WARC-Date: {moment}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{base32_digest(row['digest'])}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else row['bytes'])}"]
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_ID}{row['original']}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class _Archive:
    """One file of gzip members, written under a name of its own and renamed when whole."""

    def __init__(self, folder: str, name: str):
        self.fs, root = _filesystem(folder)
        self.final, self.draft = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out, self.size = self.fs.open_output_stream(self.draft, compression=None), 0
        self.member = None

    def begin(self, data: bytes) -> None:
        self.member = zlib.compressobj(4, zlib.DEFLATED, 31)
        self.add(data)

    def add(self, data: bytes) -> None:
        self.size += self.out.write(self.member.compress(data)) or 0

    def end(self) -> None:
        self.size += self.out.write(self.member.compress(b"\r\n\r\n") + self.member.flush()) or 0
        self.member = None

    def close(self) -> str:
        self.out.close()
        self.fs.move(self.draft, self.final)
        return self.final


def write_archives(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
    least_bytes: int = 0, moment: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record for each row to ``part-*.warc.gz`` files in the existing ``folder``; give their names.

    A null payload is an empty one, a null url an empty one. Null ids and repeated rows are written
    like others. Each task writes its own rows under a draft name and renames whole files, so a
    repeated task replaces what it had written. An empty table gives no file.
    """
    source = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, archive, written, digest = TaskContext.get().partitionId(), None, [], None
        for batch in batches:
            heads = batch.drop_columns(["data"]).to_pylist()
            for row, data in zip(heads, batch.column("data")):
                data = data.as_py()
                if row["chunk"] == 1:
                    if archive and archive.size > archive_bytes:
                        written.append(archive.close())
                        archive = None
                    archive = archive or _Archive(folder, f"part-{task:06d}-{len(written):05d}.warc.gz")
                    archive.begin(_head(row, moment))
                    digest = hashlib.sha1()
                archive.add(data)
                digest.update(data)
                if row["chunk"] == row["chunks"]:
                    archive.end()
                    if row["original"] is None and digest.hexdigest() != row["digest"]:
                        raise ValueError(f"the chunks of record {row['id']} are not its payload")
        if archive:
            written.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array(written, pa.string())], ["path"])

    return materialize(to_chunks(decide_types(source, least_bytes)).mapInArrow(write, "path string"))


class _Members:
    """The bytes of a gzip file's members, read piece by piece."""

    def __init__(self, raw: BinaryIO):
        self.raw, self.member, self.rest, self.held = raw, zlib.decompressobj(31), b"", b""

    def fill(self) -> bool:
        """Read on; False at the end of the file."""
        while True:
            data = self.rest or self.raw.read(_READ)
            if not data:
                return False
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            found = self.member.decompress(data, _READ)
            self.rest = self.member.unconsumed_tail or self.member.unused_data
            if found:
                self.held += found
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the next ``mark``, which is passed; None at the end of the file."""
        while (at := self.held.find(mark)) < 0:
            if not self.fill():
                if self.held.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        found, self.held = self.held[:at], self.held[at + len(mark):]
        return found

    def take(self, most: int) -> bytes:
        if not self.held and not self.fill():
            raise ValueError("the archive ends inside a record")
        found, self.held = self.held[:most], self.held[most:]
        return found


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def _number(identifier: str | None) -> int | None:
    digits = (identifier or "").strip("<>").removeprefix(_ID)
    return int(digits) if digits else None


def record_chunks(raw: BinaryIO, chunk_bytes: int) -> Iterator[dict]:
    """Chunk rows of every record of an open archive, in order."""
    source, record = _Members(raw), 0
    while True:
        head = source.until(b"\r\n\r\n")
        if head is None:
            return
        fields = _fields(head)
        block = int(fields["content-length"])
        http = source.until(b"\r\n\r\n")
        left = block - len(http) - 4
        row = {"record": record, "id": _number(fields["warc-record-id"]), "url": fields["warc-target-uri"],
               "type": fields["warc-type"], "refers_to": _number(fields.get("warc-refers-to")),
               "stated_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
               "stated_bytes": int(_fields(http)["content-length"])}
        digest, chunk, total = hashlib.sha1(), 0, 0
        while True:
            parts, size = [], 0
            while left and size < chunk_bytes:
                parts.append(source.take(min(left, chunk_bytes - size)))
                size += len(parts[-1])
                left -= len(parts[-1])
            data = b"".join(parts)
            digest.update(data)
            total += size
            so_far = base32_digest(digest.hexdigest())
            if not left and row["type"] == "response" and so_far != row["stated_digest"]:
                raise ValueError(f"record {row['id']} does not have its digest")
            yield row | {"chunk": chunk, "data": data, "bytes": total, "digest": so_far, "last": not left}
            chunk += 1
            if not left:
                break
        if source.until(b"\r\n\r\n"):
            raise ValueError("bytes after a record's block")
        record += 1


_RECORD_SCHEMA = (
    "file string, record long, id long, url string, type string, refers_to long, stated_digest string,"
    " stated_bytes long, chunk long, bytes long, digest string, last boolean")


def read_archives(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, payloads: bool = True) -> DataFrame:
    """The record table of all archives in ``files(path)``: a row for each chunk of each record.

    ``bytes`` and ``digest`` (base32 SHA-1) are those of the payload up to and with this chunk, so
    the row that is ``last`` has the record's own; one that isn't as stated is an error. Revisits have one chunk without bytes. With
    ``payloads`` off, the column ``data`` is left out.
    """
    names = [f.split()[0] for f in _RECORD_SCHEMA.split(", ")] + ["data"] * payloads

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inner = _filesystem(path)
                with fs.open_input_stream(inner, compression=None) as raw:
                    held = []
                    for row in record_chunks(raw, chunk_bytes):
                        held.append(row | {"file": path})
                        if not payloads:
                            held[-1].pop("data")
                        if len(held) >= (BATCH_CHUNKS if payloads else 4096):
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in _RECORD_SCHEMA.split(", "))]
                       + [("data", pa.binary())] * payloads)
    assert schema.names == names
    return files.select("path").mapInArrow(read, _RECORD_SCHEMA + ", data binary" * payloads)


def new_archive_folder(spark: SparkSession) -> str:
    """An empty folder for archives in the shared folder that the session names."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    fs, inner = _filesystem(folder)
    fs.create_dir(inner)
    return folder


def archived_records(files: DataFrame) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every record, read back.

    Responses give what their chunks add up to, revisits what they state of the payload left out.
    """
    own = F.col("type") == "response"
    return read_archives(files, payloads=False).filter("last").select(
        "id", F.when(own, F.col("bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(own, F.col("digest")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
