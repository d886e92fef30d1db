"""WARC archives with a Zstandard dictionary, written and read by Spark tasks.

An archive is a skippable frame that holds the dictionary, followed by one frame per record, so any record can be read
alone once the dictionary is known. Each writing task trains a dictionary on the first records of an archive and starts a
new archive when the current one is full. Records with equal payloads are written once; later ones become revisits.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialise, work_path

# Fixed values of the published formats.
SKIPPABLE = 0x184D2A5D  # magic number of the frame that holds a dictionary
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_SHARED = 100  # payloads below this size are always written
ARCHIVE_BYTES = 64 << 20  # of records before compression
SAMPLE_BYTES = 4 << 20  # of records from whose contents the dictionary is built
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
FIELDS = "page_id string, record_type string, refers_to string, target_uri string, payload_digest string, payload_bytes bigint"


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path inside it."""
    return fs.FileSystem.from_uri(uri) if re.match(r"[a-z][a-z0-9+.-]*:", uri) else (fs.LocalFileSystem(), uri)


def _field(value: str) -> str:
    """A header value: line breaks would end the header."""
    return re.sub(r"[\r\n]+", " ", value)


def record(page_id: str, url: str, payload: bytes, size: int, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, whose length is that of the full payload, and drops the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    header = {
        "WARC-Type": "revisit" if refers_to is not None else "response",
        "WARC-Record-ID": f"<urn:page:{_field(page_id)}>",
        "WARC-Date": date,
        "WARC-Target-URI": _field(url),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
    }
    if refers_to is not None:
        header |= {"WARC-Refers-To": f"<urn:page:{_field(refers_to)}>", "WARC-Profile": REVISIT_PROFILE}
    else:
        block += payload
    header["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in header.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header, HTTP header and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    header = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(header["Content-Length"])].partition(b"\r\n\r\n")
    return header, http, payload


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A trained dictionary, or None where the records are too few or too small to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Archives of one task: a dictionary from the first records, then every record in a frame of its own."""

    def __init__(self, folder: str):
        self.files, self.folder = _file_system(folder)
        self.held: list[bytes] = []
        self.size, self.count, self.out = 0, 0, None

    def add(self, data: bytes) -> Iterator[tuple[str, int]]:
        if self.size >= ARCHIVE_BYTES:
            yield from self.close()
        self.size += len(data)
        self.count += 1
        if self.out is None:
            self.held.append(data)
            if self.size >= SAMPLE_BYTES:
                self._open()
        else:
            self.out.write(self.compressor.compress(data))

    def _open(self) -> None:
        self.name = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
        self.out = self.files.open_output_stream(self.name + ".part", compression=None)
        dictionary = build_dictionary(self.held)
        content = dictionary.as_bytes() if dictionary else b""
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        self.out.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
        for data in self.held:
            self.out.write(self.compressor.compress(data))
        self.held = []

    def close(self) -> Iterator[tuple[str, int]]:
        """The finished archive takes its name only when it is whole; what a lost task leaves is never listed."""
        if self.out is None and self.held:
            self._open()
        if self.out is not None:
            self.out.close()
            self.files.move(self.name + ".part", self.name)
            yield self.name.rpartition("/")[2], self.count
        self.size, self.count, self.out = 0, 0, None


def read_archive(folder: str, name: str, block: int = 1 << 20) -> Iterator[bytes]:
    """The records of one archive in order, holding one record at a time."""
    files, path = _file_system(folder)
    with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
        magic, size = struct.unpack("<II", stream.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{name} does not start with a dictionary frame")
        content = stream.read(size)
        dictionary = zstandard.ZstdCompressionDict(content) if content else None
        decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
        rest = stream.read(block)
        while rest:
            frame, parts = decompressor.decompressobj(), []
            while not frame.eof:
                parts.append(frame.decompress(rest))
                rest = frame.unused_data if frame.eof else stream.read(block)
                if not frame.eof and not rest:
                    raise ValueError(f"{name} ends inside a record")
            rest = rest or stream.read(block)
            yield b"".join(parts)


def with_revisits(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", body_column: str = "html") -> DataFrame:
    """(page_id, url, body, size, digest, refers_to) with ``refers_to`` null for responses.

    Of equal payloads of at least 100 bytes the smallest id is the response. Repeated rows with that id are all
    responses; rows without an id refer to it, or are responses if none of them has one. A null body is empty.
    """
    body = F.coalesce(F.encode(F.col(body_column), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), body.alias("body")).select(
        "*", F.octet_length("body").cast("long").alias("size"), F.sha2("body", 256).alias("digest")
    )
    shared = (
        rows.filter(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    )
    shared = materialise(shared.filter("n > 1").drop("n"), "warc-shared")  # its size tells whether bodies must be shuffled
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "body", "size", "digest", refers.alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", **columns: str) -> DataFrame:
    """Write one record per row into archives below ``folder`` and return their list (name, records) as a table.

    ``folder`` must be reachable by every executor under the same URI. The list is written beside the archives: it names
    the archives of the tasks that succeeded, so files of lost or repeated attempts are never read.
    """
    spark = pages.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _file_system(folder)
        files.create_dir(path, recursive=True)
        writer, done = ArchiveWriter(folder), []
        for batch in batches:
            for page_id, url, body, size, digest, refers_to in zip(*batch.columns):
                done += writer.add(
                    record(
                        page_id.as_py() or "", url.as_py() or "", body.as_py(), size.as_py(), digest.as_py(), refers_to.as_py(), date
                    )
                )
        done += writer.close()
        names, counts = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    rows = with_revisits(pages, **columns)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "url", "refers_to")})
    listed = rows.mapInArrow(write, "archive string, records bigint")
    listed.write.parquet(f"{folder}/_list")
    return spark.read.schema("archive string, records bigint").parquet(f"{folder}/_list")


def read_archives(spark: SparkSession, folder: str, listed: DataFrame | None = None) -> DataFrame:
    """(page_id, record_type, refers_to, target_uri, payload_digest, payload_bytes, payload) of every record.

    One archive is one unit of work. The payload of a revisit is null; its digest and length are those of the full
    payload. The id is text; an empty id is null.
    """
    listed = listed if listed is not None else spark.read.parquet(f"{folder}/_list")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            *((n, pa.string()) for n in ("page_id", "record_type", "refers_to", "target_uri", "payload_digest")),
            ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ])
        rows, size = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for data in read_archive(folder, name):
                    header, http, payload = parse(data)
                    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    revisit = header["WARC-Type"] == "revisit"
                    rows.append(
                        (
                            header["WARC-Record-ID"][10:-1] or None, header["WARC-Type"],
                            header["WARC-Refers-To"][10:-1] if revisit else None, header["WARC-Target-URI"],
                            header["WARC-Payload-Digest"].removeprefix("sha256:"), length, None if revisit else payload,
                        )
                    )
                    size += len(data)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    tasks = max(1, listed.count())
    return listed.select("archive").repartition(tasks).mapInArrow(read, f"{FIELDS}, payload binary")


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives below the shared folder, with the file system it lies on.

    A path without a scheme means the session's default file system to Spark; the executors' writers must not take it for
    a folder on their own disks.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(work_path(spark, "warc"))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^file:/(?!/)", "file:///", system.makeQualified(path).toString())
