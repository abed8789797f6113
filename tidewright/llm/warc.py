"""WARC archives: one gzip member per record, read back front to back.

Equal payloads are stored once: the record of the smallest id is a response, the
others are revisits that name it and carry headers only. The reader inflates one
member at a time as bytes arrive, frames the record by its Content-Length and checks
its digests; it never holds more than one record.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut_lineage, scratch, ship

LINE = b"\r\n"
FILES = "archive string, records bigint, bytes bigint"
RECORDS = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
           "payload binary, archive string, place bigint")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    said = record.removeprefix("<urn:page:").removesuffix(">")
    return None if said == "null" else int(said)


def header_safe(text: str) -> str:
    """A header value cannot hold line ends or controls; they are percent-encoded, as UTF-8."""
    return "".join(c if " " <= c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, payload: bytes, digest: str, date: str) -> bytes:
    """One record: WARC headers, then an HTTP response; a revisit has its HTTP headers only,
    which still tell the payload's length."""
    http = LINE.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""])
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.insert(4, f"WARC-Target-URI: {header_safe(url)}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(lines).encode() + LINE * 2 + block + LINE * 2


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder named by a URI or a path, as executors see it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class CorruptArchive(ValueError):
    pass


class RecordReader:
    """The records of one archive, front to back. `read` gives the next bytes, or none at
    the end."""

    def __init__(self, read, chunk: int = 1 << 16):
        self.read, self.chunk, self.left = read, chunk, b""

    def members(self) -> Iterator[Iterator[bytes]]:
        """The inflated bytes of each gzip member, as they come."""
        while True:
            data = self.left or self.read(self.chunk)
            if not data:
                return
            self.left = b""
            yield self._inflate(data)

    def _inflate(self, data: bytes) -> Iterator[bytes]:
        inflater = zlib.decompressobj(31)
        while True:
            try:
                out = inflater.decompress(data, 1 << 20)
            except zlib.error as e:
                raise CorruptArchive(str(e)) from e
            if out:
                yield out
            if inflater.eof:
                self.left = inflater.unused_data
                return
            data = inflater.unconsumed_tail or self.read(self.chunk)
            if not data:
                raise CorruptArchive("the archive ends inside a record")

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """Headers (names in lower case) and block of each record, digests checked."""
        for parts in self.members():
            got = bytearray()
            for part in parts:
                got += part
                end = got.find(LINE * 2)
                if end >= 0:
                    break
            else:
                raise CorruptArchive("a record without end of headers")
            lines = bytes(got[:end]).decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise CorruptArchive(f"not a WARC record: {lines[0][:40]!r}")
            headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            size = int(headers["content-length"])
            del got[:end + 4]
            for part in parts:
                got += part
                if len(got) > size + 4:
                    raise CorruptArchive("a block longer than its Content-Length")
            if len(got) != size + 4 or got[size:] != LINE * 2:
                raise CorruptArchive("a block shorter than its Content-Length")
            block = bytes(got[:size])
            verify(headers, block)
            yield headers, block


def verify(headers: dict[str, str], block: bytes) -> None:
    if headers.get("warc-block-digest", "") != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise CorruptArchive(f"block digest of {headers.get('warc-record-id')} differs")
    if headers["warc-type"] == "response":
        payload = block[block.index(LINE * 2) + 4:]
        if headers["warc-payload-digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}":
            raise CorruptArchive(f"payload digest of {headers.get('warc-record-id')} differs")


def page_row(headers: dict[str, str], block: bytes) -> tuple:
    """Page id, address, type, referred page, payload length, digest and payload of a record.
    The length of a revisit's payload stands in its HTTP headers."""
    head, _, payload = block.partition(LINE * 2)
    revisit = headers["warc-type"] == "revisit"
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
    return (page_of(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"],
            page_of(headers["warc-refers-to"]) if revisit else None, int(http["content-length"]),
            headers["warc-payload-digest"].removeprefix("sha256:"), None if revisit else payload)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 100, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = 256 << 20) -> DataFrame:
    """Writes one record per row into archives below `folder` (a URI that executors can
    open) and returns (archive, records, bytes), the list of finished archives.

    Payloads of `least_bytes` or more that are equal (by SHA-256 and length) are stored
    once, with the smallest id; rows with that same id are responses too. Digests are
    grouped without the payloads, and only then joined, so many copies of a page are
    one row per task before the shuffle and are split by the join.

    A task that is run again writes new files; only files in the list count. Nulls: a
    null payload is empty; a null id is above all others; a null address has no header.
    Empty table: no archive. Extra columns are not read.
    """
    ship(pages)
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    first = (rows.filter(F.octet_length("html") >= least_bytes).groupBy(F.col("digest").alias("same"))
             .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"))
    told = (rows.join(first, F.col("digest") == F.col("same"), "left")
            .withColumn("revisit", F.coalesce(F.col("first") < F.coalesce("page_id", F.lit(2**63 - 1)), F.lit(False)))
            .select("page_id", "url", "html", "digest", F.expr("if(revisit, first, null)").alias("refers_to"), "revisit"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = open_folder(folder)
        files.create_dir(top, recursive=True)
        task = TaskContext.get()
        stem = f"{top}/part-{task.partitionId():05d}-{task.taskAttemptId()}"
        made, out, number = [], None, 0

        def close() -> None:
            out.close()
            made[-1][2] = size

        size = 0
        for batch in batches:
            for page, url, html, digest, refers, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and size >= archive_bytes:
                    close()
                    out = None
                if out is None:
                    name = f"{stem}-{number:04d}.warc.gz"
                    out, size, number = files.open_output_stream(name, compression=None), 0, number + 1
                    made.append([name, 0, 0])
                data = member(record(page, url, "revisit" if revisit else "response", refers, html.encode(), digest, date))
                out.write(data)
                size += len(data)
                made[-1][1] += 1
        if out is not None:
            close()
        if made:
            yield pa.record_batch([pa.array(c) for c in zip(*made)], names=["archive", "records", "bytes"])

    return cut_lineage(told.mapInArrow(write, FILES))


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True, batch_rows: int = 256,
                  batch_bytes: int = 8 << 20) -> DataFrame:
    """All records of the listed archives (a column `archive`), in order of `place` within
    each. A record that is cut short, too long or does not match its digests raises
    CorruptArchive."""
    ship(archives)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
                            ("archive", pa.string()), ("place", pa.int64())])
        files, _ = open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(name, compression=None) as source:
                    for place, (headers, block) in enumerate(RecordReader(source.read)):
                        row = page_row(headers, block)
                        rows.append((*row[:6], row[6] if with_payload else None, name, place))
                        held += len(block) if with_payload else 0
                        if len(rows) >= batch_rows or held >= batch_bytes:
                            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # a task per archive: their names are a few bytes, so sizes would put all into one
    names = archives.select("archive")
    return names.repartition(max(1, names.count()), "archive").mapInArrow(read, RECORDS)


def archive_and_read(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Writes `pages` to archives in the shared folder and reads them back, without payloads."""
    folder = scratch(spark, "warc")
    return read_archives(write_archives(pages, folder, **options), folder, with_payload=False)
