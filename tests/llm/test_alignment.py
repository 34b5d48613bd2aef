import bisect
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import public_tokenizers
import sentencepiece
from llm_helpers import rows_of
from tokenizers import Tokenizer

from tickloom.llm import alignment, queries

DOCS = "doc_id long, text string, n string, pair string, block string"
NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def byte_of():
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD) and not 0x7F <= b < 0xA1]
    out, n = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            out[chr(256 + n)] = b
            n += 1
    return out


def brute(rows):
    """Whole texts, a token at a time."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte, made, counts = byte_of(), [], Counter()
    for doc_id, text, *_ in rows:
        ta = tb = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            ta = [(i, bytes(byte[c] for c in a.id_to_token(i)) if all(c in byte for c in a.id_to_token(i)) else a.id_to_token(i).encode()) for i in ids_a]
            tb = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids_b]
            whole = (" " + text).encode()
            if b"".join(x for _, x in ta) != whole or b"".join(x for _, x in tb) != whole:
                ta = tb = []
        ends_a, ends_b = np.cumsum([len(x) for _, x in ta]).tolist(), np.cumsum([len(x) for _, x in tb]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        links, sides, at = [], {}, 0
        for (i, x), ea in zip(ta, ends_a):
            while ends_b[at] <= ea - len(x):
                at += 1
            links += [(i, tb[k][0]) for k in range(at, bisect.bisect_left(ends_b, ea) + 1)]
        for name, tokens, ends in (("a", ta, ends_a), ("b", tb, ends_b)):
            parts = [[] for _ in cuts]
            for (i, _), e in zip(tokens, ends):
                parts[bisect.bisect_left(cuts, e)].append(str(i))
            sides[name] = parts
        groups = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in zip(sides["a"], sides["b"]))
        made.append((doc_id, len(ta), len(tb), len(cuts), links, hashlib.sha256(groups.encode()).hexdigest() if ta else ""))
        counts.update(links)
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return sorted(((d, na, nb, ng, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha)
                   for d, na, nb, ng, links, sha in made), key=repr)


PARTS = ["the", "Mill", "größer", "été", "日本語", "😀", "👩‍👧", "x.y", "e.g.", "don't", "it's,", "12,345.67", "a b", "▁", "　", "ﬁ①", "é",
         "<|endoftext|>", "<s>", "<0x41>", "\x00", "﻿", "×,", "ß.", "ª,", "​", "नमस्ते", "A.B,C", "end.\nNext", "a\n\nb", "tab\tx", "\r\n", "....", ",,", "(a)", "é,é.", "\u0085x",
         "\n- item", "\n  code", "x\n", "- ", "ſ,", "x" * 70]
GAPS = [" ", " ", " ", "  ", "\n", "\n\n", "", ", ", ". ", " \n", "\n ", "\t"]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) + rng.choice(GAPS) for _ in range(rng.randint(1, 12))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = [(i, t, "", "", "") for i, t in enumerate(texts(seed, 300))]
    rows += [(1000, None, "", "", ""), (1001, "", "", "", ""), (1002, " ", "", "", ""), (1003, "  x ", "", "", ""), (1004, "\n", "", "", ""),
             (1005, ",", "", "", ""), (1006, "word", "", "", ""), (1007, "é", "", "", "")]
    got = alignment.align(spark.createDataFrame(rows, DOCS).repartition(3), block_bytes=3000)
    assert got.columns == NAMES and rows_of(got) == brute(rows)


def test_long_text_repeats_null_ids_and_nothing(spark):
    assert alignment.align(spark.createDataFrame([], DOCS)).count() == 0
    long = " ".join(texts(9, 150))
    rows = [(5, long, "", "", ""), (5, long, "", "", ""), (None, "same text", "", "", ""), (None, "same text", "", "", ""), (7, "ab" * 3000, "", "", "")]
    assert rows_of(alignment.align(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_groups_text_and_text_ids(spark):
    docs = spark.createDataFrame([("k", "Hello größer 😀.", "x"), ("m", None, "y")], "name string, body string, groups string")
    got = {r.name: r for r in alignment.align(docs, "name", "body", with_groups=True).collect()}
    assert got["m"].groups == "" and got["m"].n_a == 0
    assert hashlib.sha256(got["k"].groups.encode()).hexdigest() == got["k"].groups_sha256
    assert len(got["k"].groups.split(";")) == got["k"].n_groups


def test_units_are_cut_and_forgotten(monkeypatch):
    pair = alignment.Pair.of_worker(None, None)
    assert pair.cuts and pair.marks == [",", "."]
    raw = " The mill, the sea.\nNext one  two".encode()
    cuts = [*alignment.unit_starts(np.frombuffer(raw, np.uint8), np.array([0]), pair), len(raw)]
    assert [raw[a:b].decode() for a, b in zip(cuts, cuts[1:], strict=False)] == [" The", " mill", ",", " the", " sea", ".", "\n", "Next", " one", "  two"]
    monkeypatch.setattr(alignment, "UNITS", 4)
    store = alignment.Units(pair)
    words = pa.array([" a", " b", " a", " c", " d", " e", " b", " a"], pa.large_string())
    before = store.codes(words)
    sums, groups = store.sums[before].copy(), [store.groups[i] for i in before]
    store.forget()
    assert set(store.place) == {" a", " b"}
    after = store.codes(words)
    assert (store.sums[after] == sums).all() and [store.groups[i] for i in after] == groups


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    rows = [(r["doc_id"], r["text"]) for r in table]
    assert rows_of(queries.op11_token_alignment(spark, folder)) == brute(rows)
