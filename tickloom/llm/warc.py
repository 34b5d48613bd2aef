"""Write pages as WARC records with an index, and read selected records back by byte range.

Writing comes first with its index: each task writes its records as gzip members to a file of its
own in the shared folder and gives an index row per record (file, offset, length, URL, digest). Files
carry a random name, so a task that is tried again, or runs twice, leaves the finished one's file
alone; only files named by the index count. Reading sorts the selected index rows by file and offset,
joins neighbouring ranges into one read each, and parses the records from these.

Payloads that occur more than once are stored once: the record with the largest id is the response, the
others are revisit records that refer to it.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common
from tickloom.sources import tables

INDEX = ("page_id long, url string, payload_digest string, payload_bytes long, record_type string, "
         "refers_to long, file string, offset long, length long")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_record_type(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, payload_digest, payload_bytes, record_type, refers_to) of each page.

    Null html is an empty payload. Of equal payloads of at least ``min_bytes`` bytes, rows with the
    largest page_id are responses (all of them, if rows are repeated) and the others, also those
    without an id, revisit it; where no row has an id, all are responses.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumns({
        "payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    large = F.col("payload_bytes") >= min_bytes
    copies = common.written(  # known size: Spark broadcasts it only below its own threshold
        rows.where(large).groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
        .where("n > 1 AND first IS NOT NULL").select("payload_digest", "first")
    )
    revisit = F.col("first").isNotNull() & large & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(copies, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a shared folder given as path or URI."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:"):]
    return pafs.FileSystem.from_uri(folder)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(row: dict, date: str) -> bytes:
    """One WARC record as a gzip member."""
    uri = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_id(row['page_id'])}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
    ]
    body = row["payload"]
    if row["record_type"] == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_to'])}"]
        body = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def write_warc(records: DataFrame, date: str = "2024-01-01T00:00:00Z", max_file_bytes: int = 1 << 30) -> DataFrame:
    """Write ``with_record_type`` rows into the shared folder; returns the index, a written table.

    An empty input writes no file and gives an empty index. A file is closed when it exceeds
    ``max_file_bytes``, so that a record is never split.
    """
    folder = f"{tables.shared_dir(records.sparkSession)}/warc"
    fields = [c.split()[0] for c in INDEX.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None or at > max_file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{os.urandom(8).hex()}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                made = record(row, date)
                out.write(made)
                row.pop("payload")
                rows.append(row | {"file": name, "offset": at, "length": len(made)})
                at += len(made)
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_index)
        if out is not None:
            out.close()

    arrow_index = pa.schema([(f, pa.int64() if f in ("page_id", "payload_bytes", "refers_to", "offset", "length")
                              else pa.string()) for f in fields])
    index = common.written(records.mapInArrow(write, INDEX))
    return index.withColumn("file", F.concat(F.lit(folder + "/"), "file"))


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload) of one gzip member."""
    plain = zlib.decompress(member, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    headers = {k.lower(): v for k, v in headers.items()}
    return headers, rest[: int(headers["content-length"])]


def coalesce(ranges: list[tuple[str, int, int]], max_gap: int, max_span: int) -> Iterator[tuple[int, int, int]]:
    """(first, last + 1, end offset) of runs of sorted (file, offset, length) ranges to read at once."""
    first, end = 0, 0
    for i, (file, offset, length) in enumerate(ranges):
        start = ranges[first][1]
        if i > first and (file != ranges[first][0] or offset - end > max_gap or offset + length - start > max_span):
            yield first, i, end
            first, end = i, 0
        end = max(end, offset + length)
    if ranges:
        yield first, len(ranges), end


def read_warc(index: DataFrame, max_gap: int = 1 << 16, max_span: int = 1 << 23) -> DataFrame:
    """The records that index rows name: (page_id, record_type, payload_digest, refers_to, payload).

    ``payload_digest`` is the record's own header, ``payload`` the stored bytes (null for a revisit).
    Selected rows go to one task for each ``max_span`` bytes of a file; gaps up to ``max_gap`` bytes
    are read over rather than sought past.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, pa.NativeFile | None] = ("", None)
        for batch in batches:
            cols = batch.to_pydict()
            ranges = list(zip(cols["file"], cols["offset"], cols["length"], strict=True))
            for first, last, end in coalesce(ranges, max_gap, max_span):
                file, start, _ = ranges[first]
                if opened[0] != file:
                    if opened[1] is not None:
                        opened[1].close()
                    store, path = filesystem(file)
                    opened = (file, store.open_input_file(path))
                data = opened[1].read_at(end - start, start)
                rows = []
                for i in range(first, last):
                    at = ranges[i][1] - start
                    headers, payload = parse(data[at:at + ranges[i][2]])
                    kind = headers["warc-type"]
                    rows.append({
                        "page_id": cols["page_id"][i], "record_type": kind,
                        "payload_digest": headers["warc-payload-digest"].removeprefix("sha1:"),
                        "refers_to": cols["refers_to"][i], "payload": None if kind == "revisit" else payload,
                    })
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        if opened[1] is not None:
            opened[1].close()

    arrow = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                       ("refers_to", pa.int64()), ("payload", pa.binary())])
    at = F.floor(F.col("offset") / max_span)
    chosen = index.select("page_id", "refers_to", "file", "offset", "length")
    sorted_rows = chosen.repartition(common.shuffle_partitions(index.sparkSession), "file", at)
    return sorted_rows.sortWithinPartitions("file", "offset").mapInArrow(
        read, "page_id long, record_type string, payload_digest string, refers_to long, payload binary")


def round_trip(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Write all pages, read all records back, and describe each page from what was read.

    (page_id, payload_bytes, payload_digest, record_type, refers_to); bytes and digest of a response are
    computed from the payload read, those of a revisit are its response's.
    """
    index = write_warc(with_record_type(pages, min_bytes))
    found = read_warc(index).select(
        "page_id", "record_type", "refers_to",
        F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    found = common.written(found)
    targets = found.where("record_type = 'response'").join(
        found.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi"
    ).groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("known_bytes"))
    targets = targets.withColumnRenamed("page_id", "refers_to")
    return found.join(targets, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "known_bytes").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_to",
    )
