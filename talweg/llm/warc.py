"""WARC archives compressed record by record with a dictionary of their own.

Each archive starts with a skippable Zstandard frame that holds a dictionary built from the records of that archive;
every record is then a frame of its own. Records whose payload another record holds are revisits. Archives are written to the
shared folder by the tasks, under names of their own for each attempt; the written manifest names those that count, so a
lost or repeated task leaves at most an unused file.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import byte_rows, ready, stage, staging_folder, table

#: Fixed values of the formats: magic number of the dictionary frame, and its header.
DICTIONARY_MAGIC = 0x184D2A5D
_FRAME = struct.Struct("<II")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Least payload of a revisit; payload bytes of an archive; bytes of a dictionary and of the records it is built from; level.
LEAST, ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 1000, 32 << 20, 64 << 10, 2 << 20, 3
#: Most tasks that read archives back.
MOST_TASKS = 100_000
#: The table has no fetch time.
DATE = "2024-01-01T00:00:00Z"
_URN = "urn:talweg:page:"


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Add digest, size and refers_to (null for responses) to pages.

    Payloads are equal if digest and size are. The counts are partial aggregates, and the join back has one row for each
    payload that repeats, so many copies of one page make no heavy group.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    marked = pages.withColumn("digest", F.sha1(payload)).withColumn("size", F.length(payload).cast("long"))
    repeated = stage(
        marked.filter(F.col("size") >= least).groupBy("digest", "size")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND response IS NOT NULL").drop("n")
    )
    other = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return marked.join(repeated, ["digest", "size"], "left").withColumn("refers_to", other).drop("response")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; that of a revisit has the headers only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{_URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_URN}{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, sample: int = SAMPLE_BYTES) -> bytes:
    """A dictionary from whole records spread evenly over the archive, about ``sample`` bytes; their bytes themselves if they are too few to train on."""
    total = sum(map(len, records))
    step = max(1, -(-total // sample))
    used = records[::step]
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), used, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(used)[-size:]


def archive(records: list[bytes], level: int = LEVEL) -> bytes:
    """An archive of records: the dictionary in a skippable frame, then a frame for each record."""
    words = dictionary(records)
    compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(words), write_checksum=True)
    return b"".join([_FRAME.pack(DICTIONARY_MAGIC, len(words)), words, *map(compressor.compress, records)])


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an open archive, one at a time."""
    magic, size = _FRAME.unpack(source.read(_FRAME.size))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    words = zstandard.ZstdCompressionDict(source.read(size))
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=words).stream_reader(source, read_across_frames=True), 1 << 16)
    while version := stream.readline():
        if version != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name] = value.strip()
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end")
        yield fields, block


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html, digest, refers_to) to ``folder``; the written manifest (path, records, bytes).

    A task holds the records of one archive at a time.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            system.create_dir(base, recursive=True)
            content = archive(held)
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(content)
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(held)], pa.int64()), pa.array([len(content)], pa.int64())], ["name", "records", "bytes"]
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1)] + [byte_rows(batch.column(2))] + [batch.column(i).to_pylist() for i in (3, 4)]
            for row in zip(*columns, strict=True):
                held.append(record(*row))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    columns = pages.select(F.col("page_id").cast("long"), "url", "html", "digest", F.col("refers_to").cast("long"))
    return stage(columns.mapInArrow(written, "name string, records long, bytes long"))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of the archives in a manifest: page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    The payload of a response is read whole and its digest must be that of its header; a revisit has none, but the
    size of the full payload in its HTTP headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)

        def page(urn: str) -> int | None:
            number = urn.strip("<>").removeprefix(_URN)
            return int(number) if number else None

        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                found: list[tuple] = []
                with system.open_input_stream(f"{base}/{name}") as source:
                    for fields, block in read_archive(source):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        kind = fields["WARC-Type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"record {fields['WARC-Record-ID']} of {name} is damaged")
                        to = page(fields["WARC-Refers-To"]) if kind == "revisit" else None
                        found.append((page(fields["WARC-Record-ID"]), size, digest, kind, to, payload if kind == "response" else None))
                        if len(found) >= 500:
                            yield rows(found)
                            found = []
                if found:
                    yield rows(found)

    # One archive a row; the number is given, so that adaptive execution doesn't join these small rows into one task.
    names = manifest.select("name").repartition(min(max(1, manifest.count()), MOST_TASKS), "name")
    return names.mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Archive all pages in the shared folder and read the archives back.

    Null html is an empty payload. Payloads shorter than ``least`` are never revisits. A payload whose page_ids are
    all null has no revisits; rows that repeat the largest page_id of a payload are responses. Null
    ids and urls stay null. Other columns are ignored, and an empty table gives an empty result.
    """
    folder = f"{staging_folder(pages.sparkSession)}-archives"
    manifest = write_archives(revisits(pages.select("page_id", "url", "html"), least), folder)
    return read_archives(manifest, folder)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    return round_trip(table(spark, sf_dir, "pages")).drop("payload")


OP9_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM m
"""

QUERIES = {"op9_warc": ready(op9_warc)}
ORACLES = {"op9_warc": OP9_SQL}
