"""WARC archives: one gzip member per record, written and read as streams.

A page whose payload equals that of a page with a larger id is a revisit record that refers to it.
The reader inflates one member after the other from blocks of the file, frames records by their
content length and verifies digests, holding one block and one record's bytes at most.
Archives are written to and read from any folder that pyarrow's file systems reach.
"""

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from auditloom.llm.common import let_workers_import, map_arrow, small_batches, utf8
from auditloom.storage import new_path, staged

REVISIT_BYTES = 0            # payloads of fewer bytes are always full responses
ARCHIVE_BYTES = 1 << 30      # a task begins a new archive beyond this size
READ_BYTES = 1 << 16
LEVEL = 6

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n"

MANIFEST = "archive string, records bigint, bytes bigint"
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, payload binary")


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(value):
    """A header value on one line."""
    return "".join(c if c >= " " else "%%%02X" % ord(c) for c in value or "")


def record(page_id, url, payload, refers_to, revisit):
    """One record, before compression; ids of records are made from its content."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest(payload)}")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", _field(url)),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        fields.insert(2, ("WARC-Profile", PROFILE))
    fields += [(k, str(v)) for k, v in (("X-Page-Id", page_id), ("X-Refers-To", refers_to)) if v is not None]
    head = VERSION + END + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + END
    return head + block + END + END


def _member(data, level=LEVEL):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _filesystem(path):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def qualified(spark, path):
    """The path with its scheme, as Spark resolves it: a path without one belongs to the default file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(folder).toString()


class _Archive:
    """An archive being written; every attempt of a task has names of its own."""

    def __init__(self, folder):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        system, name = _filesystem(self.path)
        self.stream, self.records, self.bytes = system.open_output_stream(name, compression=None), 0, 0

    def add(self, data):
        self.stream.write(data)
        self.records, self.bytes = self.records + 1, self.bytes + len(data)

    def close(self):
        self.stream.close()
        return pa.RecordBatch.from_pydict(
            {"archive": [self.path], "records": [self.records], "bytes": [self.bytes]})


def plan_revisits(pages, revisit_bytes=REVISIT_BYTES):
    """Add ``refers_to`` and ``revisit`` to pages (page_id, url, html).

    Payloads of a size are equal if their SHA-256 is. They are counted per task before the shuffle,
    and only payloads of several pages enter the join. Pages without an id rank below all others;
    every row with the largest id of its payload is a response.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("_same", F.concat_ws(
        ":", F.octet_length("html").cast("string"), F.sha2(F.col("html").cast("binary"), 256)))
    heads = staged(
        rows.where(F.octet_length("html") >= revisit_bytes).groupBy("_same")
        .agg(F.max("page_id").alias("_head"), F.count("*").alias("_n")).where("_n > 1").drop("_n"), "heads")
    revisit = F.col("_head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_head"))
    return rows.join(heads, "_same", "left").select(
        "page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("_head")).alias("refers_to"))


def write_archives(pages, folder=None, revisit_bytes=REVISIT_BYTES, archive_bytes=ARCHIVE_BYTES, level=LEVEL):
    """Write a record per row of ``pages`` (page_id, url, html) and return the staged manifest.

    A missing html is an empty payload, a missing url an empty target, a missing id is left out.
    Tasks write one archive after the other; the manifest names those of tasks that succeeded, so
    archives of lost or repeated attempts are never read. An empty table gives no archives.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder or new_path(spark, "warc"))
    rows = plan_revisits(pages, revisit_bytes)

    def write(stream):
        archive = None
        for batch in stream:
            for part in small_batches(batch, "html"):
                columns = [part.column(c).to_pylist() for c in ("page_id", "url", "refers_to", "revisit")]
                for page_id, url, refers_to, revisit, html in zip(*columns, utf8(part.column("html"))):
                    if archive is None:
                        _make_folder(folder)
                        archive = _Archive(folder)
                    archive.add(_member(record(page_id, url, html, refers_to, revisit), level))
                    if archive.bytes >= archive_bytes:
                        yield archive.close()
                        archive = None
        if archive is not None:
            yield archive.close()

    let_workers_import(spark)
    return staged(rows.mapInArrow(write, MANIFEST), "manifest")


def _make_folder(folder):
    system, name = _filesystem(folder)
    system.create_dir(name, recursive=True)


class CorruptArchive(ValueError):
    pass


class _Member:
    """Bytes of one gzip member, inflated block by block; reading past its end gives nothing."""

    def __init__(self, stream, rest):
        self.stream, self.packed, self.plain = stream, rest, bytearray()
        self.inflater = zlib.decompressobj(31)

    def _more(self):
        """Inflate the next block; false at the end of the member."""
        if self.inflater.eof:
            return False
        data = self.inflater.unconsumed_tail or self.packed or self.stream.read(READ_BYTES)
        if not data:
            raise CorruptArchive("the file ends inside a record")
        self.packed = b""
        self.plain += self.inflater.decompress(data, 16 * READ_BYTES)
        return True

    def line(self):
        while (end := self.plain.find(END)) < 0:
            if not self._more():
                raise CorruptArchive("a header line has no end")
        out = bytes(self.plain[:end])
        del self.plain[:end + 2]
        return out

    def take(self, size):
        """Yield ``size`` bytes in pieces."""
        while size:
            if not self.plain and not self._more():
                raise CorruptArchive("the content is shorter than its length")
            piece = bytes(self.plain[:size])
            del self.plain[:size]
            size -= len(piece)
            if piece:
                yield piece

    def finish(self):
        """Check the record's closing lines; the packed bytes after the member."""
        while self._more():
            pass
        if bytes(self.plain) != END + END:
            raise CorruptArchive("a record does not end after its content")
        return self.inflater.unused_data


def _headers(member):
    fields = {}
    while line := member.line():
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return fields


def _http_length(head):
    for line in head.split(END):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    raise CorruptArchive("the content has no length")


def read_records(stream, keep_payload=True):
    """Yield the records of an archive; raises CorruptArchive where framing or a digest fails."""
    rest = b""
    while rest or (rest := stream.read(READ_BYTES)):
        member = _Member(stream, rest)
        if member.line() != VERSION:
            raise CorruptArchive("not a record")
        fields = _headers(member)
        block, payload = hashlib.sha1(), hashlib.sha1()
        head, body, kept, size = bytearray(), False, [], 0
        for piece in member.take(int(fields["content-length"])):
            block.update(piece)
            if not body:
                head += piece
                if (at := head.find(END + END)) < 0:
                    continue
                piece, body = bytes(head[at + 4:]), True
                del head[at:]
            payload.update(piece)
            size += len(piece)
            if keep_payload:
                kept.append(piece)
        rest = member.finish()
        stated = fields["warc-payload-digest"].removeprefix("sha1:")
        revisit = fields["warc-type"] == "revisit"
        if fields["warc-block-digest"] != f"sha1:{base64.b32encode(block.digest()).decode()}":
            raise CorruptArchive("the block digest differs")
        length = _http_length(bytes(head))
        if not revisit and (length != size or stated != base64.b32encode(payload.digest()).decode()):
            raise CorruptArchive("the payload digest differs")
        number = lambda k: int(fields[k]) if k in fields else None
        yield (number("x-page-id"), fields["warc-target-uri"], length, stated, fields["warc-type"],
               number("x-refers-to"), b"".join(kept) if keep_payload and not revisit else None)


def read_archives(manifest, keep_payload=True, batch_bytes=8 << 20):
    """The records of the manifest's archives, a task per archive; revisits have no payload."""
    spark = manifest.sparkSession
    tasks = max(1, min(manifest.count(), 100_000))

    def read(batch):
        rows, held = [], 0
        for path in batch.column("archive").to_pylist():
            system, name = _filesystem(path)
            with system.open_input_stream(name, compression=None) as stream:
                for r in read_records(stream, keep_payload):
                    rows.append(r)
                    held += 200 + len(r[-1] or b"")
                    if held > batch_bytes:
                        yield _record_batch(rows)
                        rows, held = [], 0
        if rows:
            yield _record_batch(rows)

    return map_arrow(manifest.select("archive").repartition(tasks), read, RECORD)


def _record_batch(rows):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
