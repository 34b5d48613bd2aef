"""Write documents as token ids in entropy-coded files, and read them back in parallel.

Documents are range-partitioned and sorted by id where they are read, turned into ids, and cut into blocks of
equal numbers of ids, which are kept packed in a written table. The ids of all blocks are counted into one
frequency table, which every file shares. Then each block is coded by itself (module ``rans``) and appended
to a file; the index has a row for each block: file, place, and the number of ids.

A folder holds ``table.rans`` and the files ``<part>-<first block>-<random>.rans``, whose names sort in the order of
the documents. A file is ``MAGIC`` and its blocks; a block is

    head        HEAD, with a checksum of head and directories
    segments    for each: first word, number of ids, checksum of its words, checksum of its ids
    documents   for each piece of a document in the block: id, whether the id is null, number of ids
    states      for each segment the 64-bit states of the lanes before it
    words       32 bits each

all little-endian. A segment is decoded from its checkpoint alone. A document's ids may go on in the next blocks;
``before`` in the head is how many of the first document's ids lie in earlier ones. Files carry a random
name, so a task that is tried again leaves a finished one's file alone; only files in the index count.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from tickloom.llm import common, rans, warc, words_to_ids
from tickloom.sources import tables

MAGIC = b"TLRANS01"
HEAD = np.dtype([("ids", "<u8"), ("before", "<u8"), ("words", "<u8"), ("documents", "<u4"), ("segments", "<u4"),
                 ("lanes", "<u4"), ("every", "<u4"), ("table", "<u4"), ("checksum", "<u4")])
SEGMENT = np.dtype([("first", "<u8"), ("ids", "<u8"), ("words_crc", "<u4"), ("ids_crc", "<u4")])
DOCUMENT = np.dtype([("id", "<i8"), ("null", "<u4"), ("ids", "<u4")])
INDEX = "part int, block int, file string, offset long, length long, prefix long, ids long, segments int"
BLOCK_IDS, LANES, EVERY = 1 << 19, 1024, 128
PART_BYTES = 128 << 20  # text of a range partition
SLICE_BYTES, SLICE_ROWS = 8 << 20, 4000  # text turned into ids at a time; one document may be longer
SEGMENTS_PER_TASK = 64


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = min(max(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), at + 1), at + SLICE_ROWS, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def to_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, path: str | None = None,
              block_ids: int = BLOCK_IDS, part_bytes: int = PART_BYTES) -> DataFrame:
    """(part, block, before, documents, packed): the ids of all documents in ascending order of id, in blocks.

    Null ids come first. Rows of one id lie in the order of a hash of their texts, and are spread over parts
    where there are many. ``packed`` holds 32-bit ids.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be an integer")
    rows = docs.select(F.col(id_col).cast(LongType()).alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(common.shuffle_partitions(docs.sparkSession), -(-size // part_bytes))
    order = [F.col("id").asc_nulls_first(), F.col("tie"), F.col("row")]
    placed = (
        rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, part = words_to_ids.WordStore.of_worker(path), TaskContext.get().partitionId()
        held, pieces, size, made, before, following = [], [], 0, 0, 0, 0

        def block() -> pa.RecordBatch:
            ids, listed = np.concatenate(held).astype("<u4"), np.array(pieces, DOCUMENT)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([made], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([listed.tobytes()], pa.binary()), pa.array([ids.tobytes()], pa.binary())],
                names=["part", "block", "before", "documents", "packed"])

        for batch in batches:
            for some in _slices(batch):
                offsets, flat = store.texts_to_ids(some.column("text"))
                n = np.diff(offsets)
                ids = np.insert(flat, offsets[1:], end_id)
                ends = np.cumsum(n + 1)
                names = some.column("id")
                missing = names.is_null().to_numpy(zero_copy_only=False)
                names = pc.fill_null(names, 0).to_numpy()
                at, k = 0, 0
                while at < len(ids):
                    to = min(len(ids), at + block_ids - size)
                    held.append(ids[at:to])
                    size += to - at
                    last = int(np.searchsorted(ends, to, "left"))  # the document that the piece up to ``to`` ends in
                    bounds = np.minimum(ends[k:last + 1], to)
                    pieces.extend(zip(names[k:last + 1].tolist(), missing[k:last + 1].tolist(), np.diff(bounds, prepend=at).tolist(), strict=True))
                    whole = to == ends[last]
                    following = 0 if whole else int(to - (ends[last - 1] if last else 0))
                    if whole:
                        k = last + 1
                    else:
                        k = last
                    at = to
                    if size == block_ids:
                        yield block()
                        held, pieces, size, made, before = [], [], 0, made + 1, following
            pa.default_memory_pool().release_unused()
        if size:
            yield block()

    return placed.mapInArrow(cut, "part int, block int, before long, documents binary, packed binary")


def count_ids(blocks: DataFrame) -> dict[int, int]:
    """How often each id occurs; as many rows as the vocabulary has ids at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for packed in batch.column("packed"):
                found = np.bincount(np.frombuffer(packed.as_buffer(), "<u4"), minlength=len(total))
                found[: len(total)] += total
                total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["token", "n"])

    found = blocks.select("packed").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(found["token"].to_pylist(), found["n"].to_pylist(), strict=True))


def block_bytes(ids: np.ndarray, documents: np.ndarray, before: int, table: rans.Table, lanes: int, every: int) -> tuple[bytes, int, int]:
    """(a block, the length of its part before the words, its number of segments)."""
    coded, step = rans.encode(ids, table, lanes, every), lanes * every
    segments = np.zeros(len(coded.firsts), SEGMENT)
    ends = np.append(coded.firsts[1:], len(coded.words))
    for k in range(len(segments)):
        own = ids[k * step:(k + 1) * step]
        segments[k] = (coded.firsts[k], len(own), zlib.crc32(coded.words[coded.firsts[k]:ends[k]].astype("<u4")), zlib.crc32(own.astype("<u4")))
    head = np.zeros(1, HEAD)
    head[0] = (len(ids), before, len(coded.words), len(documents), len(segments), lanes, every, table.crc, 0)
    rest = segments.tobytes() + documents.tobytes() + coded.states.astype("<u8").tobytes()
    head["checksum"] = zlib.crc32(rest, zlib.crc32(head.tobytes()))
    prefix = head.tobytes() + rest
    return prefix + coded.words.astype("<u4").tobytes(), len(prefix), len(segments)


def write_blocks(blocks: DataFrame, table: rans.Table, lanes: int = LANES, every: int = EVERY) -> DataFrame:
    """Code the blocks into files of the shared folder; returns the index, a written table."""
    folder = f"{tables.shared_dir(blocks.sparkSession)}/ids"
    store, base = warc.filesystem(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/table.rans") as out:
        out.write(table.to_bytes())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = warc.filesystem(folder)
        known, out, opened, name, at = read_table(folder), None, None, "", 0
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                part, block, before = (batch.column(c)[k].as_py() for c in ("part", "block", "before"))
                if opened is None or (part, block) != (opened[0], opened[1] + 1):  # not the next block of this file
                    if out is not None:
                        out.close()
                    name, at = f"{part:08d}-{block:08d}-{os.urandom(8).hex()}.rans", len(MAGIC)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(MAGIC)
                opened = part, block
                ids = np.frombuffer(batch.column("packed")[k].as_buffer(), "<u4")
                made, prefix, segments = block_bytes(ids, np.frombuffer(batch.column("documents")[k].as_buffer(), DOCUMENT), before, known, lanes, every)
                out.write(made)
                rows.append({"part": part, "block": block, "file": name, "offset": at, "length": len(made), "prefix": prefix,
                             "ids": len(ids), "segments": segments})
                at += len(made)
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_index)
        if out is not None:
            out.close()

    arrow_index = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]]) for c in INDEX.split(", ")])
    return common.written(blocks.mapInArrow(write, INDEX)).withColumn("file", F.concat(F.lit(folder + "/"), "file"))


def read_table(folder: str) -> rans.Table:
    """The folder's frequency table, read once per worker."""
    known = common.worker_cache().__dict__.setdefault("rans_tables", {})
    if folder not in known:
        store, base = warc.filesystem(folder)
        with store.open_input_file(f"{base}/table.rans") as f:
            known.clear()
            known[folder] = rans.Table.from_bytes(f.read())
    return known[folder]


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the number of ids in all blocks before.

    Windows go over the blocks of one part and over one row for each part.
    """
    sums = index.groupBy("part").agg(F.sum("ids").alias("own"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return index.join(sums, "part").withColumn("start", F.col("base") + F.coalesce(F.sum("ids").over(inside), F.lit(0))).drop("base")


def read_pieces(index: DataFrame, with_ids: bool = False) -> DataFrame:
    """(start, id, at, n, ids_crc32, whole) of every document's piece in every segment, as read from the files.

    ``start`` is the document's first place among all ids, ``at`` the piece's place in it. ``whole`` pieces are a document.
    A damaged table, head, directory or segment raises an error.
    """
    starts = common.written(with_starts(index))
    n = starts.agg(F.sum("segments")).first()[0] or 0
    tasks = max(common.shuffle_partitions(index.sparkSession), -(-n // SEGMENTS_PER_TASK))
    wanted = starts.withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("segments") - 1))).drop("segments")
    dealt = wanted.repartitionByRange(tasks, "part", "block", "segment")  # neighbours together, read one after the other

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened, place, front = None, None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                folder, _, _ = row["file"].rpartition("/")
                if row["file"] != file:
                    if opened is not None:
                        opened.close()
                    store, base = warc.filesystem(row["file"])
                    file, opened, place = row["file"], store.open_input_file(base), None
                    if opened.read_at(len(MAGIC), 0) != MAGIC:
                        raise ValueError(f"{file} is not a file of token ids")
                if row["offset"] != place:
                    place, front = row["offset"], parse_front(opened.read_at(row["prefix"], row["offset"]))
                head, segments, documents, states = front
                table, k = read_table(folder), row["segment"]
                if table.crc != head["table"]:
                    raise ValueError(f"{file} was written with another frequency table")
                first, last = int(segments["first"][k]), int(segments["first"][k + 1]) if k + 1 < len(segments) else int(head["words"])
                data = opened.read_at(4 * (last - first), row["offset"] + row["prefix"] + 4 * first)
                if zlib.crc32(data) != segments["words_crc"][k]:
                    raise ValueError(f"{file}: a segment is damaged")
                ids = rans.decode(np.frombuffer(data, "<u4"), states[k], int(segments["ids"][k]), table).astype("<u4")
                if zlib.crc32(ids) != segments["ids_crc"][k]:
                    raise ValueError(f"{file}: a segment does not give its ids")
                yield cut(row, head, documents, ids, k)
        if opened is not None:
            opened.close()

    def cut(row: dict, head: np.void, documents: np.ndarray, ids: np.ndarray, k: int) -> pa.RecordBatch:
        """The pieces of documents in segment ``k``."""
        lo = k * int(head["lanes"]) * int(head["every"])
        hi = lo + len(ids)
        ends = np.cumsum(documents["ids"].astype(np.int64))
        begins = ends - documents["ids"]
        first, last = int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(begins, hi, "left"))
        begins, ends = begins[first:last], ends[first:last]
        earlier = np.where(np.arange(first, last) == 0, int(head["before"]), 0)  # the document's ids in blocks before
        a, b = np.maximum(begins, lo) - lo, np.minimum(ends, hi) - lo
        crc = [zlib.crc32(ids[x:y]) for x, y in zip(a, b, strict=True)]
        # The last document of a block may go on; whether it does is not known here.
        whole = (begins >= lo) & (ends <= hi) & (earlier == 0) & (np.arange(first, last) < len(documents) - 1)
        columns = [pa.array(row["start"] + begins - earlier, pa.int64()),
                   pa.array(documents["id"][first:last], pa.int64(), mask=documents["null"][first:last] != 0),
                   pa.array(earlier + np.maximum(lo - begins, 0), pa.int64()), pa.array(b - a, pa.int64()), pa.array(crc, pa.int64()), pa.array(whole)]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.append(a, b[-1:]), pa.int32()), pa.array(ids.astype(np.int32))))
        return pa.RecordBatch.from_arrays(columns, names=["start", "id", "at", "n", "ids_crc32", "whole", "ids"][:len(columns)])

    schema = "start long, id long, at long, n long, ids_crc32 long, whole boolean" + (", ids array<int>" if with_ids else "")
    return dealt.sortWithinPartitions("part", "block", "segment").mapInArrow(read, schema)


def parse_front(data: bytes) -> tuple[np.void, np.ndarray, np.ndarray, np.ndarray]:
    """(head, segments, documents, states) of a block."""
    head = np.frombuffer(data, HEAD, 1).copy()
    checksum, at = int(head["checksum"][0]), HEAD.itemsize
    head["checksum"] = 0
    if zlib.crc32(memoryview(data)[at:], zlib.crc32(head.tobytes())) != checksum:
        raise ValueError("the head of a block is damaged")
    parts = []
    for kind, n in ((SEGMENT, head["segments"][0]), (DOCUMENT, head["documents"][0]), (np.dtype("<u8"), head["segments"][0] * head["lanes"][0])):
        parts.append(np.frombuffer(data, kind, int(n), at))
        at += parts[-1].nbytes
    return head[0], parts[0], parts[1], parts[2].reshape(int(head["segments"][0]), -1)


def read_documents(index: DataFrame, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, and its ``ids`` if asked for, from the files.

    Only pieces of documents that lie in several segments, or end a block, are brought together.
    """
    pieces = common.written(read_pieces(index, with_ids))
    extra = ["ids"] if with_ids else []
    alone = pieces.where("whole").select("id", "start", F.col("n").alias("n_tokens"), "ids_crc32", *extra)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for parts in batch.column("parts").to_pylist():
                crc = 0
                for part in sorted(parts, key=lambda p: p["at"]):
                    crc = rans.joined_crc(crc, part["ids_crc32"], 4 * part["n"])
                crcs.append(crc)
            keep = [c for c in batch.schema.names if c != "parts"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(crcs, pa.int64())], names=[*keep, "ids_crc32"])

    found = [F.sum("n").alias("n_tokens"), F.collect_list(F.struct("at", "n", "ids_crc32")).alias("parts")]
    if with_ids:
        found.append(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda p: p["ids"])).alias("ids"))
    cut = pieces.where("NOT whole").groupBy("start", "id").agg(*found)
    schema = "start long, id long, n_tokens long" + (", ids array<int>" if with_ids else "") + ", ids_crc32 long"
    cut = cut.select("start", "id", "n_tokens", *extra, "parts").mapInArrow(fold, schema)
    return alone.unionByName(cut)


def write_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, path: str | None = None,
              block_ids: int = BLOCK_IDS, lanes: int = LANES, every: int = EVERY, part_bytes: int = PART_BYTES) -> DataFrame:
    """Write every document's ids, each followed by ``end_id``, in ascending order of the integer id; returns the index.

    A null or empty text is ``end_id`` alone. Null ids come first; rows of one id follow each other in the order
    of a hash of their texts; repeated rows stay. No documents make an empty index. Other columns are not
    looked at, whatever their names.
    """
    blocks = to_blocks(docs, id_col, text_col, end_id, path, block_ids, part_bytes)
    blocks = common.written(blocks, compression="zstd")
    return write_blocks(blocks, rans.Table.fit(count_ids(blocks)), lanes, every)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, written by ``write_ids`` and read back."""
    return read_documents(write_ids(docs, id_col, text_col, **how)).withColumnRenamed("id", id_col)
