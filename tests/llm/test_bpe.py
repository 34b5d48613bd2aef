import random

import llm_helpers  # noqa: F401
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import bpe, words_to_ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(words_to_ids.default_path())


CASES = [
    "Hello, world!", "", None, "   ", "\t\n\r\x0b\x0c", "It's 12 don't I'LL we'Ve", "<|endoftext|>", "a<|endoftext|>b <|STARTOFTEXT|>", "é É ß ẞ İ ı ﬁ",
    "é Å ñ", "漢字 かな 한국어", "x y z　w", "a\x1cb\x85c", "👩‍👩‍👧 🇩🇪", "1234 5,678.90", "....,,,;;", "word." * 50,
    "x" * 5000, "Ünïcödé, ÀÖØÞ.", "tab\tsep  double", "a.b.c, d,e", "end.", "end..", "'s 's", "Σίσυφος ΣΑΣ", "the the the\n the",
]


def test_encode_and_decode_equal_the_library(spark, tokenizer):
    rows = [(i, t, "x", 1) for i, t in enumerate(CASES)] + [(0, CASES[0], "x", 1), (None, "no id", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, n int").repartition(3)
    got = bpe.encode(docs, decoded=True).withColumn("again", bpe.decode(bpe.F.col("ids"))).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "no id" if r.doc_id is None else CASES[r.doc_id]
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert list(r.ids) == want, text
        assert r.decoded == r.again == tokenizer.decode(want, skip_special_tokens=False), text


def test_null_and_repeated_ids_are_spread_over_blocks(spark, tokenizer):
    F = bpe.F
    text = "one and the same text of a document without an id"
    docs = spark.range(0, 4000, 1, 2).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, text).otherwise(F.concat(F.lit("number "), "id")).alias("text"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        coded = bpe.encode(docs, block_bytes=10_000)
        held = [r["count"] for r in coded.groupBy(F.spark_partition_id()).count().collect()]
        got = sorted((str(r.doc_id), tuple(r.ids)) for r in coded.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(held) < 4000 // 4
    known = {t: tuple(tokenizer.encode(t, add_special_tokens=False).ids) for t in {r.text for r in docs.collect()}}
    assert got == sorted((str(r.doc_id), known[r.text]) for r in docs.collect())


def test_empty_table_and_only_empty_texts(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert bpe.encode(docs).count() == 0
    rows = bpe.encode(spark.createDataFrame([("a", ""), ("b", None)], "doc_id string, text string"), decoded=True).collect()
    assert sorted((r.doc_id, list(r.ids), r.decoded) for r in rows) == [("a", [], ""), ("b", [], "")]


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([([320, None, -1, 10**6, 320],), ([],), (None,)], "ids array<int>")
    a = words_to_ids.load()[2][320]
    assert sorted(map(str, (r[0] for r in df.select(bpe.decode(df.ids)).collect()))) == sorted([f"{a} {a}", "", "None"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=12), min_size=1, max_size=30))
def test_words_equal_the_library(words):
    tokenizer = words_to_ids.load()[0]
    texts = pa.array([" ".join(words)], pa.large_string())
    store = words_to_ids.WordStore()
    for _ in range(2):  # the second time from the store
        offsets, ids = store.texts_to_ids(texts)
        assert list(ids) == tokenizer.encode(texts[0].as_py(), add_special_tokens=False).ids and list(offsets) == [0, len(ids)]


def test_the_store_forgets(tokenizer):
    rng = random.Random(4)
    store = words_to_ids.WordStore(limit=200)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcdef.", k=rng.randint(1, 4))) for _ in range(80)) for _ in range(5)]
        offsets, ids = store.texts_to_ids(pa.array(texts, pa.large_string()))
        for i, t in enumerate(texts):
            assert list(ids[offsets[i]:offsets[i + 1]]) == tokenizer.encode(t, add_special_tokens=False).ids
        assert len(store.place) == len(store.counts) == len(store.met) <= 200 + 400


def test_spread():
    assert list(words_to_ids.spread(np.array([5, 0, 9]), np.array([2, 0, 3]))) == [5, 6, 9, 10, 11]
    assert len(words_to_ids.spread(np.empty(0, int), np.empty(0, int))) == 0
