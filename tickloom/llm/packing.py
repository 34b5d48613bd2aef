"""Pack documents into as few fixed-length sequences as possible by vector best fit.

A sequence has three capacities: tokens, pieces, and attention cost (the sum of squared lengths). Pieces
are placed longest first, each into the open sequence that fits best under every constraint: by the
least weighted norm of what would remain, or by the greatest weighted dot product of piece and residual.

Pieces of equal length are alike, and there are at most ``capacity`` lengths. So the plan is made
from the counts of the lengths, for runs of sequences that are filled alike; its work does not
depend on the number of documents. Spark then ranks the pieces of each length, in salted groups whose
sizes are summed up, and looks each rank up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import common, words_to_ids

PIECE = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1,
           path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of each document's ids, cut at every ``capacity`` ids.

    A document is its text's ids and then ``end_id``; a null or empty text is ``end_id`` alone. The
    checksum is of little-endian unsigned 32-bit ids. ``with_ids`` adds the ids themselves.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = words_to_ids.WordStore.of_worker(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1500):
                part = batch.slice(at, 1500)
                offsets, flat = store.texts_to_ids(part.column("text"))
                rows, number, start, length, crc, lists = [], [], [], [], [], []
                for i in range(part.num_rows):
                    ids = np.append(flat[offsets[i]:offsets[i + 1]], end_id).astype("<u4")
                    for k, first in enumerate(range(0, len(ids), capacity)):
                        mine = ids[first:first + capacity]
                        rows.append(i)
                        number.append(k)
                        start.append(first)
                        length.append(len(mine))
                        crc.append(zlib.crc32(mine))
                        if with_ids:
                            lists.append(mine.astype(np.int32))
                columns = [part.column("id").take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()),
                           *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
            pa.default_memory_pool().release_unused()

    schema = f"id {kind}, {PIECE}" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def plan(lengths: dict[int, int], capacity: int = 4096, max_pieces: int | None = None, max_cost: int | None = None,
         weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm") -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, offset of the first), by length and rank.

    ``lengths`` counts the pieces of each length. ``rule`` is ``norm`` or ``dot``. ``max_pieces`` and
    ``max_cost`` do not bind if left out. Every piece must fit an empty sequence.
    """
    caps = np.array([capacity, max_pieces or capacity, max_cost or capacity ** 2], float)
    scale = np.array(weights) / caps
    open_at = np.empty((0, 3))  # what remains in each run of equal sequences
    first, size = np.empty(0, np.int64), np.empty(0, np.int64)
    made, rows = 0, []
    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        need = np.array([length, 1, length ** 2], float)
        if (need > caps).any():
            raise ValueError(f"a piece of {length} tokens does not fit an empty sequence")
        while left:
            fits = (open_at >= need).all(axis=1)
            if fits.any():
                where = np.flatnonzero(fits)
                rest = open_at[where]
                if rule == "norm":
                    best = where[np.argmin((((rest - need) * scale) ** 2).sum(axis=1))]
                else:
                    best = where[np.argmax((rest * scale) @ (need * scale))]
            else:
                per = int(min(caps // need))
                open_at = np.vstack([open_at, caps])
                first, size = np.append(first, made), np.append(size, -(-left // per))
                made += int(size[-1])
                best = len(size) - 1
            room = open_at[best]
            per = int(min(room // need))
            full = min(int(size[best]), left // per)
            for count, each in ((full, per), (1, left)) if full < size[best] and not full else ((full, per),):
                if not count or not each:
                    continue
                rows.append((length, rank, int(first[best]), each, capacity - int(room[0])))
                placed = count * each
                after = room - need * each
                if count < size[best]:  # the rest of the run stays as it was
                    open_at = np.vstack([open_at, room])
                    first, size = np.append(first, first[best] + count), np.append(size, size[best] - count)
                    size[best] = count
                open_at[best] = after
                rank += placed
                left -= placed
        keep = (open_at >= 1).all(axis=1)
        open_at, first, size = open_at[keep], first[keep], size[keep]
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(parts: DataFrame, capacity: int = 4096, max_pieces: int | None = None, max_cost: int | None = None,
          weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm", salts: int = 64) -> DataFrame:
    """``parts`` (written rows of ``pieces``) with ``sequence_id`` and ``offset``.

    Pieces of one length are ranked in ``salts`` groups for each shuffle partition's worth of hash, so a length
    that most pieces have is ranked in parallel. Which of equal pieces goes where is of no matter.
    """
    n = salts * max(common.shuffle_partitions(parts.sparkSession) // 8, 1)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(n)))
    sizes = common.written(salted.groupBy("length", "salt").agg(F.count("*").alias("n")))
    counts = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    table = plan(counts, capacity, max_pieces, max_cost, weights, rule)
    key = table[:, 0] * (1 << 44) + table[:, 1]
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("inside", inside).join(shift, ["length", "salt"])
    ranked = ranked.select(*parts.columns, (F.col("inside") + F.col("shift")).alias("rank"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1]
            sequence, slot = np.divmod(rank - row[:, 1], row[:, 3])
            columns = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(row[:, 2] + sequence), pa.array(row[:, 4] + slot * length)],
                names=[*(x for x in batch.schema.names if x != "rank"), "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.mapInArrow(look_up, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1,
         path: str | None = None, **rules) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): every piece's place in a sequence.

    Pieces of a sequence lie without gaps from 0. Rows are kept as they are, repeated ones and null ids too;
    no documents give no rows.
    """
    parts = common.written(pieces(docs, id_col, text_col, capacity, end_id, path))
    return place(parts, capacity, **rules).withColumnRenamed("id", id_col)
