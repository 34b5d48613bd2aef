import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_helpers import rows_of
from tokenizers import Tokenizer

from tickloom.llm import queries, rans, token_files, warc, words_to_ids

DOCS = "doc_id long, text string, start string, ids string, part string"
SMALL = {"block_ids": 1024, "lanes": 16, "every": 8, "part_bytes": 20_000}


def made_docs(seed=3):
    rng = random.Random(seed)
    words = "the of and river mill summer garden größer été 12 x.y".split()
    rows = [(i * 7 % 401, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 20, 150]))), "a", "b", "c") for i in range(300)]
    rows += [(1000, None, "", "", ""), (1001, "", "", "", ""), (1002, " \n ", "", "", ""), (-5, "first of all", "", "", "")]
    rows.append((500, " ".join(rng.choices(words, k=9000)), "", "", ""))  # over many blocks and segments
    return rows


def expected(rows):
    """(id, start, number of ids, crc) one document after the other."""
    tokenizer, out, at = Tokenizer.from_file(words_to_ids.default_path()), [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    return out


def found(df):
    return sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect())


def test_round_trip(spark):
    rows = made_docs()
    got = token_files.round_trip(spark.createDataFrame(rows, DOCS).repartition(5), **SMALL)
    assert found(got) == sorted(expected(rows))


def test_ids_and_order_of_files(spark):
    rows = made_docs(4)
    index = token_files.write_ids(spark.createDataFrame(rows, DOCS).repartition(3), **SMALL)
    docs = {r.id: r.ids for r in token_files.read_documents(index, with_ids=True).collect()}
    tokenizer = Tokenizer.from_file(words_to_ids.default_path())
    assert docs == {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    placed = token_files.with_starts(index).orderBy("file", "offset").collect()
    ends = np.cumsum([r.ids for r in placed])
    assert [r.start for r in placed] == [0, *ends[:-1]] and len({r.file for r in placed}) > 1 and max(r.ids for r in placed) == 1024


def test_nulls_repeats_and_nothing(spark):
    assert token_files.round_trip(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(3, "a b", "", "", ""), (3, "a b", "", "", ""), (3, "c", "", "", ""), (None, "x", "", "", ""), (None, None, "", "", ""), (1, "a", "", "", "")]
    got = token_files.round_trip(spark.createDataFrame(rows, DOCS)).collect()
    by_start = sorted((r.start, r.doc_id, r.n_tokens) for r in got)
    assert [r[1] for r in by_start] == [None, None, 1, 3, 3, 3]
    assert [r[0] for r in by_start] == [0, *np.cumsum([r[2] for r in by_start])[:-1]]
    with pytest.raises(TypeError):
        token_files.write_ids(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_one_id_with_most_rows_is_spread(spark):
    rows = [(7, f"word {i % 3}", "", "", "") for i in range(4000)] + [(i, "x", "", "", "") for i in range(50, 60)]
    index = token_files.write_ids(spark.createDataFrame(rows, DOCS), part_bytes=4000)
    sizes = [r.n for r in index.groupBy("part").agg({"ids": "sum"}).withColumnRenamed("sum(ids)", "n").collect()]
    assert len(sizes) >= 6 and max(sizes) < sum(sizes) / 2
    assert token_files.read_documents(index).count() == len(rows)


@pytest.mark.parametrize("at", [10, 60, -3])
def test_damage_is_seen(spark, at):
    index = token_files.write_ids(spark.createDataFrame(made_docs(), DOCS), **SMALL)
    row = index.orderBy("file", "offset").first()
    store, path = warc.filesystem(row.file)
    with store.open_input_file(path) as f:
        data = bytearray(f.read())
    place = row.offset + (at if at >= 0 else row.length + at)
    data[place] ^= 1
    with store.open_output_stream(path, compression=None) as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="damaged|left over|does not give"):
        token_files.read_documents(index).collect()


@pytest.mark.parametrize("n, lanes, every", [(0, 4, 2), (1, 4, 2), (5, 4, 1), (1000, 7, 3), (30003, 64, 100)])
def test_codec(n, lanes, every):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 49000).astype(np.uint32)
    seen, counts = np.unique(ids, return_counts=True)
    table = rans.Table.from_bytes(rans.Table.fit(dict(zip(seen.tolist(), counts.tolist(), strict=True))).to_bytes())
    assert not n or (table.freqs.sum() == 1 << table.bits and table.freqs.min() >= 1)
    coded = rans.encode(ids, table, lanes, every)
    ends = [*coded.firsts[1:], len(coded.words)]
    parts = [rans.decode(coded.words[a:b], coded.states[k], max(0, min(n - k * every * lanes, every * lanes)), table)
             for k, (a, b) in enumerate(zip(coded.firsts, ends, strict=True))]
    for k in reversed(range(len(parts))):  # in any order
        assert np.array_equal(parts[k], ids[k * every * lanes:(k + 1) * every * lanes])
    if n > 20000:  # within a hundredth of the entropy and the states
        p = counts / n
        assert 4 * len(coded.words) < 1.01 * n * -(p * np.log2(p)).sum() / 8 + 8 * lanes


def test_codec_needs_known_ids_and_joins_checksums():
    with pytest.raises(ValueError):
        rans.encode(np.array([5]), rans.Table.fit({4: 1}), 2, 2)
    a, b = b"first" * 1000, b"second" * 77
    assert rans.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    one = rans.encode(np.full(10, 7), rans.Table.fit({7: 5}), 3, 2)
    assert len(one.words) == 0 and rans.decode(one.words, one.states[0], 6, rans.Table.fit({7: 5})).tolist() == [7] * 6


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))
    got = queries.op13_token_files(spark, folder)
    assert rows_of(got.select("doc_id", "start", "n_tokens", "ids_crc32")) == sorted(expected(rows), key=repr)
    assert len(got.columns) == 4
