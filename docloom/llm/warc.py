"""WARC archives: writing, normalising monolithic gzip files, reading back.

Tools that compress a whole archive as one gzip stream make it unseekable: a
record can only be reached by inflating all before it.  The normaliser inflates
such a stream once, in bounded pieces, writes every record as a gzip member of
its own and beside it a sidecar index of offsets, by which one record can be
read with one seek.

Archives lie in a folder that all executors share.  Each attempt of a task
writes files of its own, and the stored manifest and index name those of the
attempt that was committed, so lost executors and repeated tasks do no harm.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import join_hot, materialise, qualified, remove, shared_folder

#: Payloads of fewer bytes are never replaced by a revisit.
LEAST_REVISIT = 1_000
#: Payload bytes after which a task begins a new archive; bytes inflated at once; largest header block.
ARCHIVE_BYTES, PIECE, HEADER_BYTES = 64 << 20, 1 << 20, 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def record(page_id: int | None, url: str | None, payload: bytes, length: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, uncompressed.  A revisit has the response's header, which states the full payload's length, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http if refers_to is not None else http + payload
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers (names in lower case) and its block."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    start = end + 4
    return headers, data[start : start + int(headers["content-length"])]


def records_of(stream: Iterator[bytes]) -> Iterator[bytes]:
    """The records of inflated bytes, one at a time: memory for one record and one piece."""
    held = bytearray()
    for piece in stream:
        held += piece
        while True:
            while held[:2] == b"\r\n":
                del held[:2]
            end = held.find(b"\r\n\r\n")
            if end < 0:
                if len(held) > HEADER_BYTES and not held.startswith(b"WARC/"):
                    raise ValueError("not a WARC record")
                break
            length = next(int(x.partition(b":")[2]) for x in bytes(held[:end]).split(b"\r\n") if x.lower().startswith(b"content-length:"))
            whole = end + 4 + length
            if len(held) < whole + 4:
                break
            yield bytes(held[: whole + 4])
            del held[: whole + 4]
    if held.strip():
        raise ValueError("the archive ends within a record")


def inflate(stream, piece: int = PIECE) -> Iterator[bytes]:
    """The bytes of a gzip file of one or many members, in pieces of a bounded size."""
    z = zlib.decompressobj(wbits=31)
    while data := stream.read(piece):
        while data:
            out = z.decompress(data, piece)
            if out:
                yield out
            if z.eof:
                data, z = z.unused_data, zlib.decompressobj(wbits=31)
            else:
                data = z.unconsumed_tail


class _Archive:
    """One gzip file under a temporary name; ``members``: each record is a member of its own."""

    def __init__(self, folder: str, name: str, members: bool):
        self.fs, self.root = _filesystem(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.path, self.members = f"{self.root}/{name}", members
        self.temporary = f"{self.root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.z = None if members else zlib.compressobj(6, wbits=31)
        self.at = self.n = self.payload = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Offset and length of the record's member."""
        z = zlib.compressobj(6, wbits=31) if self.members else self.z
        packed = z.compress(data) + (z.flush() if self.members else b"")
        self.out.write(packed)
        offset = self.at
        self.at += len(packed)
        self.n += 1
        self.payload += len(data)
        return offset, len(packed)

    def close(self) -> None:
        if self.z is not None:
            self.out.write(self.z.flush())
        self.out.close()
        self.fs.move(self.temporary, self.path)


def _decided(pages: DataFrame, least: int) -> DataFrame:
    """Pages with digest and, for revisits, the page that they refer to.

    Digest, count and largest id of a group are aggregated, with partial sums
    before the shuffle.  Pages that never revisit, and those of digests with a
    large part of all rows, spread evenly over the tasks.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("payload_digest", F.sha1(F.encode("html", "UTF-8")))
    rows = rows.withColumn("twin", F.when((F.octet_length("html") >= least) & F.col("page_id").isNotNull(), F.col("payload_digest")))
    copies = materialise(
        rows.filter("twin is not null").groupBy("twin").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1")
    )
    # a response never needs the join's result: only the others of a group do
    revisit = F.col("page_id") != F.col("response")
    return join_hot(rows, copies, "twin", "response").select(
        "page_id", "url", F.when(revisit, "").otherwise(F.col("html")).alias("html"), F.octet_length("html").cast("long").alias("payload_bytes"), "payload_digest", F.when(revisit, F.col("response")).alias("refers_to")
    )


def write_monolithic(pages: DataFrame, folder: str, least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives, each one gzip stream, and return their manifest (archive, records), stored."""
    rows = _decided(pages, least)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt, k, open_one = TaskContext.get().taskAttemptId(), 0, None
        done: list[tuple[str, int]] = []

        def close() -> None:
            nonlocal open_one
            open_one.close()
            done.append((open_one.path.rpartition("/")[2], open_one.n))
            open_one = None

        for batch in it:
            for row in batch.to_pylist():
                if open_one is None:
                    open_one = _Archive(folder, f"{attempt:08d}-{k:04d}.warc.gz", members=False)
                    k += 1
                open_one.add(record(row["page_id"], row["url"], row["html"].encode(), row["payload_bytes"], row["payload_digest"], row["refers_to"]))
                if open_one.payload >= archive_bytes:
                    close()
        if open_one is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["archive", "records"])

    return materialise(rows.mapInArrow(run, "archive string, records long"))


_INDEX = "archive string, offset long, length long, record_id string, record_type string"


def normalise(manifest: DataFrame, folder: str, to: str) -> DataFrame:
    """Rewrite each archive with a member a record and a sidecar index; the index as stored rows.

    The index has (archive, offset, length, record_id, record_type); beside
    each archive the same lies as ``<archive>.idx``, a line of JSON a record.
    Each archive is inflated once, as a stream.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in it:
            for source in batch.column("archive").to_pylist():
                system, root = _filesystem(folder)
                rows, name = [], f"{attempt:08d}-{source}"
                out = _Archive(to, name, members=True)
                with system.open_input_stream(f"{root}/{source}", compression=None) as stream:
                    for data in records_of(inflate(stream)):
                        offset, length = out.add(data)
                        headers, _ = parse(data)
                        rows.append((name, offset, length, headers["warc-record-id"], headers["warc-type"]))
                out.close()
                side = f"{out.root}/.{name}.idx.{uuid.uuid4().hex}"
                with out.fs.open_output_stream(side, compression=None) as f:
                    f.write("".join(json.dumps(dict(zip(("offset", "length", "record_id", "record_type"), r[1:], strict=True))) + "\n" for r in rows).encode())
                out.fs.move(side, f"{out.root}/{name}.idx")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                    ["archive", "offset", "length", "record_id", "record_type"],
                )

    return materialise(manifest.mapInArrow(run, _INDEX))


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the indexed records, each read by its offset."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        name, f = None, None
        for batch in it:
            rows = []
            for x in batch.to_pylist():
                if x["archive"] != name:
                    if f is not None:
                        f.close()
                    name, f = x["archive"], system.open_input_file(f"{root}/{x['archive']}")
                data = zlib.decompress(f.read_at(x["length"], x["offset"]), wbits=31)
                rows.append(_row_of(*parse(data)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )
        if f is not None:
            f.close()

    return index.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _page(name: str | None) -> int | None:
    return int(name[len("<urn:page:") : -1]) if name and name.startswith("<urn:page:") else None


def _row_of(headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "revisit":
        length = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return _page(headers["warc-record-id"]), length, stated, "revisit", _page(headers["warc-refers-to"])
    digest = hashlib.sha1(payload).hexdigest()
    if digest != stated:
        raise ValueError(f"{headers['warc-record-id']}: the payload doesn't have the stated digest")
    return _page(headers["warc-record-id"]), len(payload), digest, "response", None


def round_trip(pages: DataFrame, least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, normalise them and read them back.

    Of pages of equal html of at least ``least`` bytes, that with the largest
    page_id is the response and the others revisit it.  A null html is the
    empty payload; a null url is left out; a page with a null id is always a
    response and read back with a null id; rows that repeat the largest id are
    all responses; an empty table gives no archive and an empty table; other
    columns are ignored.  Archives and sidecars stay in ``folder`` (default: a
    new one below the shared folder).
    """
    spark = pages.sparkSession
    base = qualified(spark, folder or shared_folder(spark))
    mono = f"{base}/monolithic"
    manifest = write_monolithic(pages, mono, least, archive_bytes)
    # an archive a task: each is one unit of work
    count = max(1, manifest.count())
    index = normalise(manifest.repartition(min(count, 4096), "archive"), mono, f"{base}/archives")
    remove(spark, mono)
    return read_records(index, f"{base}/archives")


