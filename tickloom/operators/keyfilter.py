"""Bloom filters of key hashes, one or more for each slice of a table.

A filter answers "certainly not here" from some bits for each key. Slices of many keys have several filters, each for a
share of the hashes, so none is larger than ``KEYS`` keys make it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

KEYS = 250_000  # keys of a filter
CHUNK = 50_000  # keys that are tested at a time
BITS, PROBES = 20, 10  # for each key: one wrong answer in about ten thousand
LEAST_BITS = 8192  # in small filters probes would fall together

FIELDS = StructType([StructField("shares", IntegerType()), StructField("share", IntegerType()), StructField("bits", BinaryType())])


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each hash, by double hashing of its two halves."""
    h = hashes.astype(np.uint64)
    mixed = h * np.uint64(0x9E3779B97F4A7C15)
    first, second = mixed >> np.uint64(32), (mixed & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((first[:, None] + np.arange(PROBES, dtype=np.uint64) * second[:, None]) % np.uint64(size)).astype(np.int64)


def made(hashes: np.ndarray) -> bytes:
    """The filter of some hashes."""
    size = max(LEAST_BITS, -(-len(hashes) * BITS // 64) * 64)
    bits = np.zeros(size, bool)
    bits[_places(hashes, size).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter cannot rule out."""
    packed = np.frombuffer(bits, np.uint8)
    at = _places(hashes, len(packed) * 8)
    return ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)


def filters(rows: DataFrame, by: Sequence[str], hashed: str) -> DataFrame:
    """(by..., shares, share, bits): the filters of each slice ``by`` of ``rows``."""
    sizes = rows.groupBy(*by).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / KEYS)).cast("int").alias("shares"))
    dealt = rows.select(*by, hashed).join(sizes, list(by)).withColumn("share", F.pmod(F.col(hashed), F.col("shares")).cast("int"))
    schema = StructType([*(rows.schema[c] for c in by), *FIELDS.fields])
    names = [*by, "shares", "share"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, done = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            change = np.zeros(batch.num_rows, bool)
            for c in names:
                codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()
                change[1:] |= codes[1:] != codes[:-1]
            hashes = batch.column(hashed).to_numpy()
            bounds = [0, *np.flatnonzero(change), batch.num_rows]
            for lo, hi in zip(bounds, bounds[1:]):
                mine = tuple(batch.column(c)[int(lo)].as_py() for c in names)
                if held and mine != key:
                    done.append((*key, made(np.concatenate(held))))
                    held = []
                key = mine
                held.append(hashes[lo:hi])
            yield rows_of(done)
            done = []
        if held:
            yield rows_of([(*key, made(np.concatenate(held)))])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in done], schema=arrow)

    arrow = to_arrow_schema(schema)
    return dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(make, schema)


def hits(rows: DataFrame, kept: DataFrame, by: Sequence[str], hashed: str, ident: Sequence[str]) -> DataFrame:
    """(by..., ident...) of each of the filters ``kept`` that cannot rule out some row of its slice ``by``.

    Keys go to the filters in chunks, so no task holds more than one chunk and one filter at a time.
    """
    by = list(by)
    counted = rows.groupBy(*by).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / CHUNK)).cast("int").alias("chunks"))
    dealt = rows.select(*by, hashed).join(counted, by).withColumn("chunk", F.pmod(F.xxhash64(hashed), F.col("chunks")))
    chunks = dealt.groupBy(*by, "chunk").agg(F.collect_list(hashed).alias("hashes"))  # about CHUNK of them
    schema = StructType([*(rows.schema[c] for c in by), *(kept.schema[c] for c in ident)])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for k in range(batch.num_rows):
                hashes = batch.column("hashes")[k].values.to_numpy()
                shares, share = batch.column("shares")[k].as_py(), batch.column("share")[k].as_py()
                mine = hashes[hashes % shares == share]
                good.append(bool(len(mine)) and bool(may_hold(batch.column("bits")[k].as_py(), mine).any()))
            found = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([found.column(c) for c in schema.names], names=schema.names)

    return chunks.join(kept, by).mapInArrow(test, schema)
