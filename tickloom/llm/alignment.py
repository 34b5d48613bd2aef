"""Align the tokens of two tokenizers over the same texts, and count which ids overlap.

A is a byte-level tokenizer file, B a sentencepiece model. Each text is read as a space and the text; B adds the space by
itself. A text is cut into units where neither tokenizer can merge across (``unit_starts``), and every distinct unit is
aligned once per worker:

* coarse cuts: A's character offsets and B's spans, turned into byte offsets;
* refined: a token that ends inside a multibyte character, and a byte-fallback token, end where the bytes that
  they and the tokens before them decode to end;
* a text whose tokens do not decode to its bytes on either side has no alignment.

Both sides end a token at the end of each unit, so a text's groups, links and checksums are put together from those of its
units. Documents are kept in blocks of bounded size with a packed list of their units. Blocks exchange their distinct
pairs of ids with tables of counts by pair, which are joins and sums of Spark's, and then sum up the counts for
each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common
from tickloom.llm.words_to_ids import spread

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20  # text of a block; one document may be longer
SLICE_ROWS, SLICE_BYTES = 1000, 2 << 20
UNITS, UNIT_BYTES, LONG_UNIT = 200_000, 16 << 20, 64  # what a worker keeps between blocks
SUMS = ("n_a", "n_b", "n_groups", "n_links")


def _of_byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level piece stands for: itself where it prints, else from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bytes:
    """The bytes of every id of a vocabulary, in a row."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.starts[ids], self.sizes[ids])]


class Pair:
    """Both tokenizers, read once per worker."""

    def __init__(self, a_path: str | None, b_path: str | None):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(a_path or public_tokenizers.path(A_FILE))
        a.encode_special_tokens = True
        a.no_truncation()
        a.no_padding()
        byte = _of_byte_level()
        names = [a.id_to_token(i) or "" for i in range(a.get_vocab_size(with_added_tokens=True))]
        a_bytes = [bytes(byte[c] for c in n) if all(c in byte for c in n) else n.encode() for n in names]
        b = sentencepiece.SentencePieceProcessor(model_file=b_path or public_tokenizers.path(B_FILE))
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.is_byte = np.array([b.is_byte(i) for i in range(len(pieces))])
        b_bytes = [bytes([int(p[3:5], 16)]) if self.is_byte[i] else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a, self.b, self.a_bytes, self.b_bytes = a, b, Bytes(a_bytes), Bytes(b_bytes)
        inside = [p for i, p in enumerate(pieces) if not self.is_byte[i]]
        #: Whether no merge crosses the place before a space after anything else, and before or after a line feed.
        self.lead = b.encode("\n", out_type=str)
        self.cuts = (
            a.normalizer is None and type(a.pre_tokenizer).__name__ == "ByteLevel" and self.lead == ["▁", "<0x0A>"]
            and not any("▁" in p.lstrip("▁") or "\n" in p for p in inside)
        )
        #: The same before each of these marks after a letter.
        self.marks = [m for m in ",." if not any(x.isalpha() and y == m for p in inside for x, y in zip(p, p[1:], strict=False))]

    @staticmethod
    def of_worker(a_path: str | None, b_path: str | None) -> Pair:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        known = common.worker_cache().__dict__.setdefault("pairs", {})
        if (a_path, b_path) not in known:
            known[a_path, b_path] = Pair(a_path, b_path)
        return known[a_path, b_path]


def unit_starts(data: np.ndarray, starts: np.ndarray, pair: Pair) -> np.ndarray:
    """Where units begin in UTF-8 ``data`` whose texts begin at ``starts``.

    A cut lies before a space or line feed that follows a visible character, between such a line feed and
    an ASCII letter, and before a full stop or comma that follows a letter. A's pattern ends a piece there and
    starts the next one as if nothing came before, and no piece of B reaches over it (``Pair.cuts``, ``Pair.marks``).
    Characters before a cut are ASCII or of two bytes from U+00C0 on, of which none is white space.
    """
    at = np.zeros(len(data) + 1, bool)
    at[starts] = True
    if pair.cuts and len(data) > 2:
        last = data[1:-1]  # the byte before places 2, 3, ...
        two = (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF) & (last >= 0x80)  # ends a character of two bytes
        letter = ((last | 0x20) >= ord("a")) & ((last | 0x20) <= ord("z"))
        wide = two & (data[:-2] == 0xC3) & (last != 0x97) & (last != 0xB7)
        seen = ((last > 0x20) & (last < 0x7F)) | two
        now = data[2:]
        cut = seen & ((now == 0x20) | (now == 0x0A))
        for mark in pair.marks:
            cut |= (letter | wide) & (now == ord(mark))
        after = np.zeros(len(cut), bool)
        after[1:] = cut[:-1] & (last[1:] == 0x0A)
        after &= ((now | 0x20) >= ord("a")) & ((now | 0x20) <= ord("z"))
        at[2:-1] |= cut | after
    return np.flatnonzero(at[:-1])


def _ends(data: np.ndarray, units: np.ndarray, first: np.ndarray, ids: np.ndarray, owner: np.ndarray, ends: np.ndarray,
          partial: np.ndarray, table: Bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte offset of each token's end, whether each unit's tokens decode to its bytes).

    ``first`` is the number of characters before each unit, ``owner`` the unit of each token, ``ends`` the token's end in
    characters of the unit; the ends of ``partial`` tokens are found by decoding.
    """
    chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each character begins
    sizes = table.sizes[ids]
    total = np.cumsum(sizes)
    made = np.bincount(owner, weights=sizes, minlength=len(units) - 1).astype(np.int64)
    before = np.cumsum(made) - made  # decoded bytes before each unit
    decoded = units[owner] + total - before[owner]
    coarse = chars[np.minimum(first[owner] + ends, len(chars) - 1)]
    out = np.where(partial, decoded, coarse)
    good = made == np.diff(units)
    good[owner[out != decoded]] = False
    if good.all():
        wrong = table.of(ids) != data
        if wrong.any():
            good[np.searchsorted(units, np.flatnonzero(wrong), "right") - 1] = False
    else:  # compare unit by unit those of equal length
        kept = good[owner]
        same = spread(units[:-1][good], np.diff(units)[good])
        wrong = same[table.of(ids[kept]) != data[same]]
        good[np.searchsorted(units, wrong, "right") - 1] = False
    return out, good


def _flat(lists: list[list], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(owner of each item, items in a row)."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.repeat(np.arange(len(lists)), n), np.fromiter(chain.from_iterable(lists), kind, int(n.sum()))


class Units:
    """Alignments of distinct units, kept by a worker."""

    def __init__(self, pair: Pair):
        self.pair, self.place, self.chars = pair, {}, 0
        self.sums = np.empty((0, len(SUMS)), np.int64)
        self.good, self.met = np.empty(0, bool), np.empty(0, np.int64)
        self.starts, self.links = np.empty(0, np.int64), np.empty(0, np.int64)
        self.groups: list[str] = []

    @staticmethod
    def of_worker(a_path: str | None, b_path: str | None) -> Units:
        known = common.worker_cache().__dict__.setdefault("units", {})
        if (a_path, b_path) not in known:
            known[a_path, b_path] = Units(Pair.of_worker(a_path, b_path))
        return known[a_path, b_path]

    def forget(self) -> None:
        """Drop long units and those met once, or more if too many are left; only between blocks."""
        if len(self.place) <= UNITS and self.chars <= UNIT_BYTES:
            return
        names = list(self.place)
        short = np.fromiter(map(len, names), np.int64, len(names)) <= LONG_UNIT
        kept = np.flatnonzero(short & (self.met > 1))
        if len(kept) > UNITS // 2:
            kept = np.sort(kept[np.argsort(-self.met[kept], kind="stable")[: UNITS // 2]])
        n = self.sums[kept, 3]
        self.links = self.links[spread(self.starts[kept], n)]
        self.sums, self.good, self.met, self.starts = self.sums[kept], self.good[kept], self.met[kept], np.cumsum(n) - n
        self.groups = [self.groups[i] for i in kept]
        self.place = {names[i]: k for k, i in enumerate(kept)}
        self.chars = sum(map(len, self.place))

    def codes(self, units: pa.Array) -> np.ndarray:
        """The place of each unit in the store; new ones are aligned."""
        coded = units.dictionary_encode()
        names = strings(coded.dictionary)
        new = [n for n in names if n not in self.place]
        if new:
            self.add(new)
        at = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
        code = coded.indices.to_numpy()
        self.met[at] += np.bincount(code, minlength=len(names))
        return at[code]

    def add(self, names: list[str]) -> None:
        found = align_units(names, self.pair)
        first = len(self.place)
        self.place.update(zip(names, range(first, first + len(names)), strict=True))
        self.chars += sum(map(len, names))
        sums, good, links, groups = found
        self.starts = np.concatenate([self.starts, len(self.links) + np.cumsum(sums[:, 3]) - sums[:, 3]])
        self.sums, self.good = np.concatenate([self.sums, sums]), np.concatenate([self.good, good])
        self.links = np.concatenate([self.links, links])
        self.met = np.concatenate([self.met, np.zeros(len(names), np.int64)])
        self.groups += groups


def strings(units: pa.Array) -> list[str]:
    """A large string array as Python strings, cut from one string."""
    data, offsets = common.string_buffers(units)
    offsets = offsets - 0
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if len(units) else np.empty(0, np.uint8)
    whole = raw.tobytes().decode()
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters before each byte
    at = before[offsets - offsets[0]].tolist() if len(units) else [0]
    return [whole[a:b] for a, b in zip(at, at[1:], strict=False)]


def align_units(names: list[str], pair: Pair) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(sums by ``SUMS``, whether aligned, links in a row, groups as text) of each unit.

    A link is A's id times 2 ** 32 plus B's id. Units that cannot be aligned have no tokens.
    """
    n = len(names)
    raw = [u.encode() for u in names]
    data = np.frombuffer(b"".join(raw), np.uint8)
    units = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, n))])
    first = np.cumsum([0, *map(len, names)])[:-1]
    found = pair.a.encode_batch(names, add_special_tokens=False)
    owner_a, ids_a = _flat([e.ids for e in found], np.int64)
    ends_a = np.fromiter((end for e in found for _, end in e.offsets), np.int64, len(ids_a))
    begins_a = np.fromiter((begin for e in found for begin, _ in e.offsets), np.int64, len(ids_a))
    partial_a = np.zeros(len(ids_a), bool)
    partial_a[:-1] = (owner_a[1:] == owner_a[:-1]) & (begins_a[1:] < ends_a[:-1])  # the next token shares the last character
    # B puts a space before what it is given. A line feed in front takes it, and no merge reaches over that.
    spans = pair.b.encode(["\n" + u for u in names], return_type="offset_mapping", num_threads=1)
    skip = len(pair.lead)
    owner_b, ids_b = _flat([s["ids"][skip:] for s in spans], np.int64)
    ends_b = np.fromiter((end for s in spans for _, end in s["offsets"][skip:]), np.int64, len(ids_b)) - 1
    end_a, good_a = _ends(data, units, first, ids_a, owner_a, ends_a, partial_a, pair.a_bytes)
    end_b, good_b = _ends(data, units, first, ids_b, owner_b, ends_b, pair.is_byte[ids_b], pair.b_bytes)
    good = good_a & good_b
    return (*_linked(n, good, owner_a, ids_a, end_a, owner_b, ids_b, end_b, pair),)


def _linked(n, good, owner_a, ids_a, end_a, owner_b, ids_b, end_b, pair):
    kept_a, kept_b = good[owner_a], good[owner_b]
    owner_a, ids_a, end_a = owner_a[kept_a], ids_a[kept_a], end_a[kept_a]
    owner_b, ids_b, end_b = owner_b[kept_b], ids_b[kept_b], end_b[kept_b]
    begin_a = end_a - pair.a_bytes.sizes[ids_a]
    begin_b = end_b - pair.b_bytes.sizes[ids_b]
    cuts = np.intersect1d(end_a, end_b)
    lo, hi = np.searchsorted(end_b, begin_a, "right"), np.searchsorted(begin_b, end_a, "left")
    each = hi - lo
    partner = spread(lo, each)
    links = (np.repeat(ids_a, each) << 32) + ids_b[partner]
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    owner = owner_a[np.searchsorted(end_a, cuts)]  # the unit of each group
    sums = np.stack([np.bincount(owner_a, minlength=n), np.bincount(owner_b, minlength=n), np.bincount(owner, minlength=n),
                     np.bincount(owner_a, weights=each, minlength=n).astype(np.int64)], axis=1).astype(np.int64)
    sides = [_joined(pa.array(ids).cast(pa.string()), group, len(cuts), ",") for ids, group in ((ids_a, group_a), (ids_b, group_b))]
    groups = pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string()))
    return sums, good, links, _joined(groups, owner, n, ";").to_pylist()


def _joined(texts: pa.Array, owner: np.ndarray, n: int, by: str) -> pa.Array:
    """For each of ``n`` owners its texts, which lie in a row."""
    offsets = np.searchsorted(owner, np.arange(n + 1))
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), texts.cast(pa.large_string()))
    return pc.binary_join(lists, pa.scalar(by, pa.large_string()))


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x, np.int32).tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, 4 * n, codec="zstd"), np.int32)


def _before(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(x)])


class Block:
    """The alignments of some documents, until they are written."""

    def __init__(self, store: Units, with_groups: bool):
        store.forget()
        self.store, self.size, self.with_groups = store, 0, with_groups
        self.names, self.sums, self.digests, self.groups, self.codes, self.sizes = [], [], [], [], [], []

    def add(self, names: pa.Array, texts: pa.Array) -> None:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        data, offsets = common.string_buffers(texts)
        offsets = offsets - 0
        self.size += int(offsets[-1] - offsets[0])
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes > 0)
        # A space before each text that is not empty.
        places = offsets[filled] - offsets[0]
        raw = np.insert(np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], places, 0x20) if len(filled) else np.empty(0, np.uint8)
        starts = places + np.arange(len(filled))
        cuts = unit_starts(raw, starts, self.store.pair)
        codes, per = self._coded(raw, cuts), np.diff(np.append(np.searchsorted(cuts, starts), len(cuts)))
        bad = np.flatnonzero(np.bincount(np.repeat(np.arange(len(filled)), per), weights=~self.store.good[codes], minlength=len(filled)) > 0)
        if len(bad):  # what units say of these does not add up: align each as a whole
            bounds = np.append(starts, len(raw))
            whole = [raw[bounds[i]:bounds[i + 1]].tobytes().decode() for i in bad]
            alone = self.store.codes(pa.array(whole, pa.large_string()))
            lists = np.split(codes, np.cumsum(per)[:-1])
            for i, code in zip(bad, alone, strict=True):
                lists[i] = np.array([code] if self.store.good[code] else [], np.int64)
            codes, per = np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))
        ends = _before(per)
        added = np.concatenate([np.zeros((1, len(SUMS)), np.int64), np.cumsum(self.store.sums[codes], axis=0)])
        sums = np.zeros((len(texts), len(SUMS)), np.int64)
        sums[filled] = added[ends[1:]] - added[ends[:-1]]
        digests, written = np.full(len(texts), "", object), np.full(len(texts), "", object)
        seen, code = np.unique(codes, return_inverse=True)
        groups = pa.array([self.store.groups[i] for i in seen], pa.large_string()).take(pa.array(code))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), groups), pa.scalar(";", pa.large_string()))
        for i, text in zip(filled, pc.cast(joined, pa.large_binary()), strict=True):
            if sums[i, 0]:
                digests[i] = hashlib.sha256(text.as_buffer()).hexdigest()
                if self.with_groups:
                    written[i] = text.as_py().decode()
        all_sizes = np.zeros(len(texts), np.int64)
        all_sizes[filled] = per
        self.names.append(names)
        self.sums.append(sums)
        self.digests.append(digests)
        self.groups.append(written)
        self.codes.append(codes)
        self.sizes.append(all_sizes)

    def _coded(self, raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        if not len(cuts):
            return np.empty(0, np.int64)
        ends = np.append(cuts, len(raw)).astype(np.int64)
        return self.store.codes(pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))))

    def made(self, number: int) -> pa.RecordBatch:
        """One row; units are numbered within the block, and links within its distinct pairs of ids."""
        store = self.store
        codes = np.concatenate(self.codes)
        seen, code, times = np.unique(codes, return_inverse=True, return_counts=True)
        n = store.sums[seen, 3]
        links = store.links[spread(store.starts[seen], n)]
        pairs, link = np.unique(links, return_inverse=True)
        counts = np.bincount(link, weights=np.repeat(times, n), minlength=len(pairs)).astype(np.int64)
        sums = np.concatenate(self.sums)
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        sizes = np.concatenate(self.sizes)
        columns = {
            "block": pa.array([number], pa.int64()), "ids": one(pa.concat_arrays(self.names)),
            **{name: one(pa.array(sums[:, i])) for i, name in enumerate(SUMS)},
            "groups_sha256": one(pa.array(np.concatenate(self.digests), pa.string())),
            "sizes": pa.array([_pack(sizes)], pa.binary()), "codes": pa.array([_pack(code)], pa.binary()), "n_codes": pa.array([len(code)], pa.int64()),
            "unit_sizes": pa.array([_pack(n)], pa.binary()), "n_units": pa.array([len(n)], pa.int64()),
            "links": pa.array([_pack(link)], pa.binary()), "n_all_links": pa.array([len(link)], pa.int64()),
            "pairs": one(pa.array(pairs, pa.int64())), "times": one(pa.array(counts, pa.int64())),
        }
        if self.with_groups:
            columns["groups"] = one(pa.array(np.concatenate(self.groups), pa.string()))
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None,
                    block_bytes: int = BLOCK_BYTES, with_groups: bool = False) -> DataFrame:
    """Blocks of aligned documents (see the module), a written table."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, task, made = Units.of_worker(a_path, b_path), TaskContext.get().partitionId(), 0
        block = Block(store, with_groups)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
            ends, at = np.cumsum(sizes), 0
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                to = min(max(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), at + 1), at + SLICE_ROWS, batch.num_rows)
                block.add(batch.column("id").slice(at, to - at), batch.column("text").slice(at, to - at))
                at = to
                if block.size >= block_bytes:
                    yield block.made(task << 32 | made)
                    made, block = made + 1, Block(store, with_groups)
            pa.default_memory_pool().release_unused()
        if block.names:
            yield block.made(task << 32 | made)

    lists = ", ".join(f"{name} array<long>" for name in SUMS)
    return common.written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        make, f"block long, ids array<{kind}>, {lists}, groups_sha256 array<string>, sizes binary, codes binary, n_codes long, "
        "unit_sizes binary, n_units long, links binary, n_all_links long, pairs array<long>, times array<long>"
        + (", groups array<string>" if with_groups else "")))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): in how many links of all documents each pair of ids is linked, and whether no other A id is
    linked more often to its B id. A pair is A's id times 2 ** 32 plus B's id."""
    counts = common.written(blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(
        F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return common.written(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None,
          block_bytes: int = BLOCK_BYTES, with_groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document.

    Groups lie between byte offsets where both tokenizers end a token; links are pairs of tokens whose bytes overlap.
    ``count_sum`` adds up, over a document's links, how many links of all documents join the same two ids; ``n_best`` counts
    those links that join a B id to one of the A ids it is joined to most. ``groups_sha256`` is of the groups' text, which
    ``with_groups`` adds as ``groups``: ids of A and B joined by commas, sides by ``|``, groups by ``;``. Null and empty texts, and
    those that cannot be aligned, have zeros and empty strings. Rows stay as they are, repeated ones and null ids
    too; no documents give no rows. Other columns are not looked at, whatever their names.
    """
    blocks = align_documents(docs, id_col, text_col, a_path, b_path, block_bytes, with_groups)
    listed = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    known = listed.join(pair_counts(blocks), "pair").select(F.col("block").alias("of_block"), "at", "n", "best")
    kind = docs.schema[id_col].dataType.simpleString()
    texts = ["groups_sha256", *(["groups"] if with_groups else [])]
    names = ["id", *SUMS, "n_best", "count_sum", *texts]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        counts = np.zeros(len(right), np.int64)
        best = np.zeros(len(right), np.int64)
        at = right["at"].to_numpy()
        counts[at], best[at] = right["n"].to_numpy(), right["best"].to_numpy()
        for k in range(len(left)):  # one row
            row = {c: left[c][k] for c in ("sizes", "codes", "n_codes", "unit_sizes", "n_units", "links", "n_all_links")}
            row = {c: v.as_py() for c, v in row.items()}
            links = _unpack(row["links"], row["n_all_links"])
            unit = _before(_unpack(row["unit_sizes"], row["n_units"]).astype(np.int64))
            codes = _unpack(row["codes"], row["n_codes"])
            n = len(left["ids"][k])
            doc = _before(_unpack(row["sizes"], n).astype(np.int64))
            sums = []
            for value in (best, counts):
                of_unit = _before(value[links])
                of_unit = of_unit[unit[1:]] - of_unit[unit[:-1]]
                of_doc = _before(of_unit[codes])
                sums.append(pa.array(of_doc[doc[1:]] - of_doc[doc[:-1]], pa.int64()))
            out.append(pa.Table.from_arrays([left["ids"][k].values, *(left[c][k].values for c in SUMS), *sums, *(left[c][k].values for c in texts)], names=names))
        return pa.concat_tables(out)

    schema = f"id {kind}, " + ", ".join(f"{c} {'string' if c in texts else 'long'}" for c in names[1:])
    kept = [c for c in blocks.columns if c not in ("pairs", "times")]
    return blocks.select(*kept).groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(finish, schema).withColumnRenamed("id", id_col)
