"""Near-duplicate documents by SimHash fingerprints that differ in few bits.

A fingerprint is embedded as the bit counts of its 32 two-bit segments. The Manhattan distance of two
such embeddings never exceeds the Hamming distance of the fingerprints, so it is a lower bound to
filter by. The range join under that distance uses a grid: the segments are dealt to ``max_bits + 3``
groups, a pair within the radius agrees entirely in all but ``max_bits`` of them, so it meets in the
grid cell of at least one choice of three groups. What meets is filtered by the Manhattan distance and
then verified by the exact Hamming distance.

Exact copies are merged before the join: one row per distinct fingerprint. Cells are compared in
sorted streams of 8-byte values, and a cell gives a spanning forest of its links, never its pairs.
A cell beyond ``max_cell`` fingerprints is dealt to blocks, and every pair of blocks is compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tickloom.llm import common
from tickloom.llm.components import connected_components

WINDOW = 1 << 17  # hashes unpacked to bits at a time
LOW = 0x5555555555555555


def shingle_hashes(words: pa.Array, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle with seed 42, offsets of each text's first shingle)."""
    counts = np.diff(offsets)
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(shingles)])
    text = np.repeat(np.arange(len(counts)), shingles)
    first = offsets[:-1][text] + np.arange(starts[-1]) - starts[:-1][text]
    last = first + np.minimum(counts[text], width) - 1
    spaced = pc.binary_join_element_wise(words, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    data, at = common.string_buffers(spaced)  # each word and one space
    hash64 = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (hash64(data[a:b], 42) for a, b in zip(at[first].tolist(), (at[last + 1] - 1).tolist(), strict=True)),
        np.uint64, len(first))
    return hashes, starts


def majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text the 64 bits that are set in over half of its hashes; zero without hashes."""
    n = np.diff(starts)
    ones = np.zeros((len(n), 64), np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    for at in range(0, len(hashes), WINDOW):
        part, mine = hashes[at:at + WINDOW], owner[at:at + WINDOW]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = np.flatnonzero(np.diff(mine, prepend=-1))
        ones[mine[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint(text: Column, width: int = 3) -> Column:
    """The fingerprint of a text as a long; texts that are null or have no words have zero."""
    def some(texts: pa.Array) -> np.ndarray:
        words, offsets = common.split_words(pc.ascii_lower(pc.fill_null(texts, "")))
        return majority(*shingle_hashes(words, offsets, width)).view(np.int64)

    def make(texts: pa.Array) -> pa.Array:
        return pa.array(common.in_slices(some, texts))

    return F.arrow_udf(make, LongType())(text)


def popcounts(fp: Column) -> Column:
    """The bit counts of the two-bit segments in unary code, so that Manhattan distance is that of bits."""
    high = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(high).bitwiseAND(F.lit(LOW))
    both = fp.bitwiseAND(high).bitwiseAND(F.lit(LOW))
    return some.bitwiseOR(F.shiftleft(both, 1))


def grid_masks(max_bits: int, agreeing: int = 3) -> list[int]:
    """Bit masks of the segments of every choice of ``agreeing`` of ``max_bits + agreeing`` groups, signed."""
    groups = [0] * (max_bits + agreeing)
    for segment in range(32):
        groups[segment % len(groups)] |= 3 << (2 * segment)
    masks = [sum(chosen) for chosen in combinations(groups, agreeing)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _near(fps: np.ndarray, codes: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs (i, j) are links: first by the lower bound, then exactly."""
    bound = np.flatnonzero(np.bitwise_count(codes[i] ^ codes[j]) <= max_bits)
    return bound[np.bitwise_count(fps[i[bound]] ^ fps[j[bound]]) <= max_bits]


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i[k] and j[k]; ``label`` holds each member's representative, the least of its set."""
    while True:
        a, b = label[i], label[j]
        apart = np.flatnonzero(a != b)
        if not len(apart):
            return
        i, j, low = i[apart], j[apart], np.minimum(a[apart], b[apart])
        np.minimum.at(label, a[apart], low)
        np.minimum.at(label, b[apart], low)
        while (label[label] != label).any():
            label[:] = label[label]


def links_of_runs(cells: np.ndarray, fps: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside runs of equal cells (sorted), as (fingerprint, representative)."""
    label = np.arange(len(fps))
    begin = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.empty(0, int)
    size = np.diff(np.append(begin, len(cells)))
    short = np.repeat(size <= 64, size)
    left = np.flatnonzero(short)
    step = 1
    while len(left):  # rows with their step-th successor, while it is in the same run
        left = left[left + step < len(cells)]
        left = left[cells[left] == cells[left + step]]
        hit = _near(fps, codes, left, left + step, max_bits)
        merge(label, left[hit], left[hit] + step)
        step += 1
    for at, n in zip(begin[size > 64].tolist(), size[size > 64].tolist(), strict=True):
        mine, code = fps[at:at + n], codes[at:at + n]
        for i in range(0, n, 256):
            bound = np.bitwise_count(code[i:i + 256, None] ^ code[None, :]) <= max_bits
            bound &= np.bitwise_count(mine[i:i + 256, None] ^ mine[None, :]) <= max_bits
            a, b = np.nonzero(bound)
            merge(label, at + i + a, at + b)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return fps[moved], fps[label[moved]]


def fingerprint_links(fps: DataFrame, max_bits: int = 3, max_cell: int = 4096) -> DataFrame:
    """(a, b): fingerprints connected by links of at most ``max_bits`` bits, as forests of grid cells.

    ``fps`` has one column ``fp`` of distinct fingerprints.
    """
    n = common.shuffle_partitions(fps.sparkSession)
    masks = grid_masks(max_bits)
    code = popcounts(F.col("fp"))
    spots = F.array(*[F.struct(F.lit(i).alias("choice"), code.bitwiseAND(F.lit(m)).alias("spot")) for i, m in enumerate(masks)])
    cells = fps.select("fp", F.inline(spots))
    large = common.written(cells.groupBy("choice", "spot").agg(F.count("*").alias("members")).where(F.col("members") > max_cell))
    blocks = F.ceil(F.col("members") / (max_cell // 2)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    placed = cells.join(large, ["choice", "spot"], "left").withColumn("own", F.coalesce(own, F.lit(0)))
    others = F.when(F.col("members").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1))
    placed = placed.select(
        "fp", F.explode(others).alias("other"), "choice", "spot", "own"
    ).select("fp", F.xxhash64("choice", "spot", F.least("own", "other"), F.greatest("own", "other")).alias("cell"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in _with_end(batches):
            if batch is None:
                cell, fp, done = *rest, len(rest[0])
            else:
                cell = np.concatenate([rest[0], batch.column("cell").to_numpy()])
                fp = np.concatenate([rest[1], batch.column("fp").to_numpy()])
                done = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0  # the last run may go on
            rest = (cell[done:], fp[done:])
            u = fp[:done].view(np.uint64)
            high = u >> np.uint64(1)
            low = np.uint64(LOW)
            codes = ((u | high) & low) | (((u & high) & low) << np.uint64(1))
            a, b = links_of_runs(cell[:done], u, codes, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    sorted_cells = placed.repartition(n, "cell").sortWithinPartitions("cell", "fp")
    return sorted_cells.mapInArrow(link, "a long, b long").distinct()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """(id, fingerprint, component_id) of each row of ``docs``.

    ``fingerprint`` is a long; ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits, the row's own included. Texts that are null or have no words have
    fingerprint zero and link like any other. Rows are kept as they are, repeated ones too. Null ids are
    never a component_id, except where all ids of a component are null.
    """
    rows = common.written(docs.select(F.col(id_col), fingerprint(F.col(text_col), width).alias("fingerprint")))
    fps = common.written(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("first")))
    parts = connected_components(fingerprint_links(fps.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    named = fps.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = common.written(named)
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    known = named.join(least, "component").select(F.col("fp").alias("fingerprint"), "component_id")
    return rows.join(known, "fingerprint").select(id_col, "fingerprint", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             grouped: Callable[[DataFrame, str, str], DataFrame] = near_duplicates) -> DataFrame:
    """One row of ``docs``, all columns, of each group of near-duplicates: that with the smallest id.

    ``grouped`` finds the groups, as (id, component_id) of each row. Rows with one id are one document. Rows without an id go by their text's hash, behind all ids.
    """
    name, rank = common.fresh(docs, "name", "rank")
    unnamed = F.shiftrightunsigned(F.xxhash64(text_col), 2).bitwiseOR(F.lit(1 << 62))
    named = docs.withColumn(name, F.coalesce(F.col(id_col).cast("long"), unnamed))
    groups = grouped(named, name, text_col)
    chosen = groups.select(F.col("component_id").alias(name)).distinct()
    same = Window.partitionBy(name).orderBy(F.xxhash64(text_col))
    kept = named.join(chosen, name, "left_semi").withColumn(rank, F.row_number().over(same))
    return kept.where(F.col(rank) == 1).select(*docs.columns)
