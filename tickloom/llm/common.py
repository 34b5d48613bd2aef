"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tickloom.sources import tables


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` changed, where needed, so that none is a column of ``df`` already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, **options) -> DataFrame:
    """``df`` written as a table in the cluster's shared folder and read again.

    Unlike a checkpoint, its size is known to the optimiser, and its columns can be pruned.
    """
    path = f"{tables.shared_dir(df.sparkSession)}/table"
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_cache() -> SimpleNamespace:
    """A namespace that lives as long as the Python worker.

    The package's functions reach the workers by value, so their globals are not shared between tasks.
    """
    name = "_tickloom_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = SimpleNamespace()
    return sys.modules[name]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words, offsets of each text's first word); words are runs without ASCII white space.

    A null text has no words. The words of text i are ``words[offsets[i]:offsets[i + 1]]``.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    words, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    kept = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not kept.all():  # an empty text splits into one empty word
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
        words = words.filter(pa.array(kept))
    return words, offsets


def string_buffers(words: pa.Array) -> tuple[memoryview, np.ndarray]:
    """(UTF-8 bytes, offsets) of a large string array without nulls."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    return memoryview(data if data is not None else b""), offsets


def in_slices(make, texts: pa.Array, rows: int = 1000) -> np.ndarray:
    """``make`` applied to some rows at a time, which bounds what it holds in memory."""
    parts = [make(texts.slice(at, rows)) for at in range(0, len(texts), rows)]
    pa.default_memory_pool().release_unused()
    return np.concatenate(parts) if parts else make(texts)
