"""Encode texts through a table of distinct words, and decode ids through a table of pieces.

Documents are split into words where they are read, and put into blocks, which are written once: a block holds its
distinct words and, for each document, the places of its words among them; texts themselves are not kept. Each block lists its
distinct words by hash bucket; each bucket, which holds all blocks' lists, encodes every distinct word
once and returns the ids to the blocks; each block puts the ids in the places of its words. Between the
steps go distinct words, places and ids only, packed. A block is cut by
bytes, whatever the ids of its documents are, null or repeated, so the number of blocks follows the input;
so does that of the buckets, which is at least ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tickloom.llm import common, words_to_ids

SLICE = 256  # documents turned into ids at a time
BLOCK_BYTES = 32 << 20  # text of a block; one document may be longer
LEVEL = 9  # of compression: blocks and lists are written or shuffled
ROW_BYTES = 64  # what a document counts beside its text
BUCKET_BYTES = 64 << 20  # text for each bucket of words


def _squeeze(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


def _planes(x: np.ndarray) -> bytes:
    """Small numbers, their lowest bytes first, then the next, then the highest."""
    return _squeeze(b"".join(((x >> shift) & 0xFF).astype(np.uint8).tobytes() for shift in (0, 8, 16, 24)))


def _from_planes(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 4 * n, codec="zstd"), np.uint8).reshape(4, n).astype(np.int32) if n else np.empty((4, 0), np.int32)
    return planes[0] | planes[1] << 8 | planes[2] << 16 | planes[3] << 24


def _numbers(blob: bytes, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, n * np.dtype(kind).itemsize, codec="zstd"), kind)


def _listed(words: pa.Array, buckets: int) -> list[tuple[int, pa.Array]]:
    """(bucket, its words) of distinct words, in an order that depends on the words alone."""
    words = words.take(pc.array_sort_indices(words))
    bucket = np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in pc.cast(words, pa.large_binary()).to_pylist()),
                         np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
    return [(int(bucket[part[0]]), words.take(pa.array(part))) for part in parts if len(part)]


def _words(row: dict) -> pa.Array:
    """The block's distinct words, sorted; a word holds no line feed."""
    raw = pa.decompress(row["words"], row["words_raw"], codec="zstd", asbytes=True) if row["words_raw"] else b""
    return pa.array(raw.decode().split("\n") if row["n_words"] else [], pa.large_string())


def _coded(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, sorted; rank of every word of the texts by how often it occurs; number of words of each text; how
    often each distinct word occurs).

    Ranks are small numbers, which take less space than places. Of equally frequent words the first has the lower rank.
    """
    words, sizes = [], []
    for chunk in texts.chunks:
        for at in range(0, len(chunk), SLICE):
            found, offsets = common.split_words(chunk.slice(at, SLICE))
            words.append(found.dictionary_encode())
            sizes.append(np.diff(offsets))
    distinct = pa.chunked_array([w.dictionary for w in words], pa.large_string()).unique()
    distinct = distinct.take(pc.array_sort_indices(distinct))
    codes = [pc.index_in(w.dictionary, value_set=distinct).to_numpy(zero_copy_only=False).astype(np.int32)[w.indices.to_numpy()] for w in words]
    codes = np.concatenate([np.empty(0, np.int32), *codes])
    times = np.bincount(codes, minlength=len(distinct))
    rank = np.empty(len(distinct), np.int32)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(distinct), dtype=np.int32)
    return distinct, rank[codes], np.concatenate([np.empty(0, np.int64), *sizes]), times


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           decoded: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, ids) of each row, and ``decoded``, the pieces joined by spaces, if asked for.

    ``ids`` equals what the tokenizer gives for the whole text without special tokens added. Texts that
    are null or hold only white space have no ids. Rows are kept as they are, repeated ones too; an id may be null.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            words, codes, sizes, times = _coded(table["text"])
            raw = b"\n".join(pc.cast(words, pa.large_binary()).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table["id"].combine_chunks())
            columns = {
                "block": pa.array([task << 32 | made], pa.int64()), "ids": lists, "n": pa.array([len(table)], pa.int64()), "raw": pa.array([size], pa.int64()),
                "words": pa.array([_squeeze(raw)], pa.binary()), "words_raw": pa.array([len(raw)], pa.int64()), "n_words": pa.array([len(words)], pa.int64()),
                "sizes": pa.array([_squeeze(sizes.astype(np.int32).tobytes())], pa.binary()),
                "times": pa.array([_planes(times)], pa.binary()), "codes": pa.array([_planes(codes)], pa.binary()), "n_codes": pa.array([len(codes)], pa.int64())}
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES
            at, ends = 0, np.cumsum(lengths)
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                to = max(int(np.searchsorted(ends, before + block_bytes - size, "right")), at + (not held))
                if to > at:
                    held.append(batch.slice(at, to - at))
                    size += int(ends[to - 1]) - before
                    at = to
                if at < batch.num_rows:
                    yield block()
                    made, held, size = made + 1, [], 0
        if held:
            yield block()

    packed = common.written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        pack_texts, f"block long, ids array<{kind}>, n long, raw long, words binary, words_raw long, n_words long, sizes binary, times binary, codes binary, n_codes long"))
    n = max(common.shuffle_partitions(docs.sparkSession), -(-(packed.agg(F.sum("raw")).first()[0] or 0) // BUCKET_BYTES))

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row, rows = batch.slice(at, 1).to_pylist(), []
                for bucket, words in _listed(_words(row[0]), n):
                    raw = b"\n".join(pc.cast(words, pa.large_binary()).to_pylist())
                    rows.append({"bucket": bucket, "block": row[0]["block"], "words": _squeeze(raw), "raw": len(raw)})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("bucket", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("raw", pa.int64())]))

    def encode_bucket(table: pa.Table) -> pa.Table:
        lists = [pa.array(pa.decompress(r["words"], r["raw"], codec="zstd", asbytes=True).decode().split("\n"), pa.large_string())
                 for r in table.select(["words", "raw"]).to_pylist()]
        coded = pa.chunked_array(lists, pa.large_string()).combine_chunks().dictionary_encode()
        counts, flat = words_to_ids.encode_words(coded.dictionary, path)
        starts = np.cumsum(counts) - counts
        code, at, rows = coded.indices.to_numpy(), 0, []
        for bucket, block, words in zip(table["bucket"].to_pylist(), table["block"].to_pylist(), lists, strict=True):
            mine = code[at:at + len(words)]
            at += len(words)
            ids = flat[words_to_ids.spread(starts[mine], counts[mine])]
            rows.append({"block": block, "bucket": bucket, "words": len(words), "total": len(ids),
                         "counts": _squeeze(counts[mine].astype(np.int32).tobytes()),
                         "low": _squeeze((ids & 0xFFFF).astype(np.uint16).tobytes()),
                         "high": _squeeze((ids >> 16).astype(np.uint16).tobytes())})
        return pa.Table.from_pylist(rows, schema=pa.schema([
            ("block", pa.int64()), ("bucket", pa.int32()), ("words", pa.int64()), ("total", pa.int64()),
            ("counts", pa.binary()), ("low", pa.binary()), ("high", pa.binary())]))

    def join_back(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        row = {c: left[c][0].as_py() for c in ("words", "words_raw", "n_words", "sizes", "times", "codes", "n_codes", "n")}  # a block is one row
        own = _words(row)
        listed = _listed(own, n)
        known = {r["bucket"]: r for r in right.to_pylist()}
        rows = [known[bucket] for bucket, _ in listed]
        counts = np.concatenate([np.empty(0, np.int32), *(_numbers(r["counts"], r["words"], np.int32) for r in rows)]).astype(np.int64)
        flat = np.concatenate([np.empty(0, np.int32), *(
            _numbers(r["low"], r["total"], np.uint16) + _numbers(r["high"], r["total"], np.uint16).astype(np.int32) * 65536 for r in rows)])
        starts = np.cumsum(counts) - counts
        words = pa.chunked_array([w for _, w in listed], pa.large_string()).combine_chunks()
        place = pc.index_in(own, value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)
        place = place[np.argsort(-_from_planes(row["times"], row["n_words"]), kind="stable")]  # by rank
        pieces = pa.array(words_to_ids.load(path)[2]) if decoded else None
        names = left["ids"].combine_chunks().flatten()
        codes, ends = _from_planes(row["codes"], row["n_codes"]), np.concatenate([[0], np.cumsum(_numbers(row["sizes"], row["n"], np.int32), dtype=np.int64)])
        for at in range(0, row["n"], SLICE):
            bounds = ends[at:at + SLICE + 1]
            offsets, ids = words_to_ids.gather(place[codes[bounds[0]:bounds[-1]]], bounds - bounds[0], counts, starts, flat)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            columns = [names.slice(at, len(lists)), lists] + ([join_pieces(lists, pieces).cast(pa.string())] if decoded else [])
            yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"][:len(columns)])

    def join_table(left: pa.Table, right: pa.Table) -> pa.Table:
        fields = [("id", left.schema.field("ids").type.value_type), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
        return pa.Table.from_batches(list(join_back(left, right)), schema=pa.schema(fields[:2 + decoded]))

    listed = packed.select("block", "words", "words_raw", "n_words").mapInArrow(list_words, "bucket int, block long, words binary, raw long")
    known = listed.groupBy("bucket").applyInArrow(
        encode_bucket, "block long, bucket int, words long, total long, counts binary, low binary, high binary")
    result = f"id {kind}, ids array<int>" + (", decoded string" if decoded else "")
    joined = packed.drop("raw").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(join_table, result)
    return joined.withColumnRenamed("id", id_col)


def join_pieces(lists: pa.Array, pieces: pa.Array) -> pa.Array:
    """For each list of ids the pieces of the ids, joined by spaces; null ids and unknown ones have none."""
    ids = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(pieces)))
    kept = pc.fill_null(known, False).to_numpy(zero_copy_only=False)
    if not kept.all():
        ids = ids.filter(pa.array(kept))
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
    named = pieces.cast(pa.large_string()).take(ids)
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), named), pa.scalar(" ", pa.large_string()))


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of an array of ids, special tokens kept: each id is looked up in the table of pieces.

    The table has one row for each id of the vocabulary and is read by each worker, so no row of
    ``ids`` leaves its partition. Null is decoded as null.
    """
    def look_up(lists: pa.Array) -> pa.Array:
        text = join_pieces(pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists,
                           pa.array(words_to_ids.load(path)[2]))
        return pc.if_else(lists.is_valid(), text, pa.scalar(None, text.type)).cast(pa.string())

    return F.arrow_udf(look_up, StringType())(ids)
