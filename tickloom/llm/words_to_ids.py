"""Token ids of single words, as a tokenizer file gives them.

The tokenizer drops white space and merges only inside what its pattern cuts out, and no cut crosses
white space. So the ids of a text are those of its words, put in a row.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from tickloom.llm import common

FILE = "word_bpe_49k.json"
#: Letters that the tokenizer keeps together and changes in nothing but their case.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
TOGETHER = 256


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(FILE)


def load(path: str | None = None) -> tuple[Tokenizer, np.ndarray, list[str]]:
    """(tokenizer, whether each id ends a cut, piece of each id); read once per worker.

    ``path`` must be readable where it is called; without it the installed public file is used.
    """
    cache = common.worker_cache()
    key = path or default_path()
    known = getattr(cache, "tokenizers", None)
    if known is None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        known = cache.tokenizers = {}
    if key not in known:
        tokenizer = Tokenizer.from_file(key)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        pieces = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        known[key] = tokenizer, np.array([p.endswith("</w>") for p in pieces]), pieces
    return known[key]


def for_letters(path: str | None = None) -> Tokenizer:
    """The tokenizer without its normalizer and pattern, which do nothing to lower-case letters parted by spaces."""
    cache = common.worker_cache()
    known = cache.__dict__.setdefault("for_letters", {})
    if path not in known:
        short = Tokenizer(load(path)[0].model)
        short.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        known[path] = short
    return known[path]


def joined(words: pa.Array, together: int) -> list[str]:
    """Some words at a time, parted by spaces."""
    ends = np.append(np.arange(0, len(words), together), len(words))
    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), words.cast(pa.large_string()))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).to_pylist() if len(words) else []


def as_list(words: pa.Array) -> list[str]:
    """The words as Python strings, cut from one string, which is faster than one by one."""
    return joined(words, len(words))[0].split(" ") if len(words) else []


def encode_letters(stems: pa.Array, path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids, ids in a row) of words of lower-case ``LETTERS``."""
    tokenizer, ends = for_letters(path), load(path)[1]
    counts, found = [], []
    for group, encoded in zip(range(0, len(stems), TOGETHER), tokenizer.encode_batch_fast(joined(stems, TOGETHER), add_special_tokens=False), strict=True):
        ids = np.array(encoded.ids, np.int32)
        end = np.flatnonzero(ends[ids]) + 1
        if len(end) != min(TOGETHER, len(stems) - group) or end[-1] != len(ids):
            raise ValueError("a tokenizer whose words do not end in </w> cannot be used here")
        counts.append(np.diff(end, prepend=0))
        found.append(ids)
    return (np.concatenate([np.empty(0, np.int64), *counts]).astype(np.int64),
            np.concatenate([np.empty(0, np.int32), *found]).astype(np.int32))


def encode_words(words: pa.Array, path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each word, all ids in a row) of words without white space.

    A word of letters is encoded in lower case, many at a time and equal ones once; so is one that a full
    stop or comma follows, whose id is put behind. All others are encoded one by one.
    """
    tokenizer, _, _ = load(path)
    words = words.cast(pa.large_string())
    stems = pc.replace_substring_regex(words, "[.,]$", "")
    plain = pc.match_substring_regex(stems, LETTERS).to_numpy(zero_copy_only=False)
    counts = np.zeros(len(words), np.int64)
    coded = pc.utf8_lower(stems.filter(pa.array(plain))).dictionary_encode()
    code, at = coded.indices.to_numpy(), np.flatnonzero(plain)
    stem_counts, stem_ids = encode_letters(coded.dictionary, path)
    sizes = pc.binary_length(words).to_numpy() - pc.binary_length(stems).to_numpy()
    marked = at[sizes[at] > 0]
    counts[at] = stem_counts[code] + sizes[at]
    alone = np.flatnonzero(~plain)
    lists = [e.ids for e in tokenizer.encode_batch_fast(words.take(pa.array(alone)).to_pylist(), add_special_tokens=False)]
    counts[alone] = [len(x) for x in lists]
    ends = np.cumsum(counts)
    starts = ends - counts
    flat = np.empty(ends[-1] if len(ends) else 0, np.int32)
    flat[spread(starts[at], stem_counts[code])] = stem_ids[spread((np.cumsum(stem_counts) - stem_counts)[code], stem_counts[code])]
    if len(marked):
        stop = pc.ends_with(words.take(pa.array(marked)), ".").to_numpy(zero_copy_only=False)
        flat[ends[marked] - 1] = np.where(stop, tokenizer.token_to_id(".</w>"), tokenizer.token_to_id(",</w>"))
    flat[spread(starts[alone], counts[alone])] = np.array([i for x in lists for i in x], np.int32)
    return counts, flat


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, in a row."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 2**31 and (not total or int(starts.max()) + total < 2**31) else np.int64
    out = np.repeat((starts - ends + counts).astype(kind), counts)
    out += np.arange(total, dtype=kind)
    return out


class WordStore:
    """Ids of the words met so far; one per worker and tokenizer, so that tasks share it.

    Beyond ``limit`` words those met once are forgotten, or all but the more frequent half if that is too little.
    """

    def __init__(self, path: str | None = None, limit: int = 300_000):
        self.path, self.limit = path, limit
        self.place: dict[str, int] = {}
        self.counts, self.starts, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
        self.met = np.empty(0, np.int64)

    @staticmethod
    def of_worker(path: str | None = None) -> WordStore:
        cache = common.worker_cache()
        stores = cache.__dict__.setdefault("stores", {})
        if path not in stores:
            stores[path] = WordStore(path)
        return stores[path]

    def forget(self) -> None:
        kept = np.flatnonzero(self.met > 1)
        if len(kept) > self.limit // 2:
            kept = np.sort(np.argsort(-self.met, kind="stable")[: self.limit // 2])
        chosen = np.zeros(len(self.met), bool)
        chosen[kept] = True
        self.flat = self.flat[spread(self.starts[kept], self.counts[kept])]
        self.counts, self.met = self.counts[kept], self.met[kept]
        self.starts = np.cumsum(self.counts) - self.counts
        names = [w for w, i in self.place.items() if chosen[i]]  # in the order of their places
        self.place = dict(zip(names, range(len(names)), strict=True))

    def texts_to_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets of the texts' ids, all ids in a row)."""
        words, offsets = common.split_words(texts)
        coded = words.dictionary_encode()
        if len(self.place) > self.limit:
            self.forget()
        names, code = as_list(coded.dictionary), coded.indices.to_numpy()
        new = [w for w in names if w not in self.place]
        if new:
            counts, flat = encode_words(pa.array(new, pa.large_string()), self.path)
            first = len(self.place)
            self.place.update(zip(new, range(first, first + len(new)), strict=True))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.flat = np.concatenate([self.flat, flat])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        at = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
        self.met[at] += np.bincount(code, minlength=len(names))
        return gather(at[code], offsets, self.counts, self.starts, self.flat)


def gather(where: np.ndarray, offsets: np.ndarray, counts: np.ndarray, starts: np.ndarray,
           flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the texts' ids, ids) of texts whose words are at ``where`` in a word table."""
    n = counts[where]
    total = np.concatenate([[0], np.cumsum(n)])
    return total[offsets], flat[spread(starts[where], n)]
