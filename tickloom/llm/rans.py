"""Static range asymmetric numeral system for arrays of token ids.

One frequency table is shared by all blocks. A block is coded by itself: id i belongs to lane i modulo the
number of lanes, each lane is a 64-bit state, and all lanes move one step at a time, so a step is a few
array operations. States are kept at fixed steps, and a segment between two such checkpoints is decoded
without what lies before it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np

LOW = 31  # a state at rest is at least 2 ** LOW; 32 bits move at a time
WORD = np.uint64(32)


@dataclass(frozen=True)
class Table:
    """Frequencies of symbols, summing up to 2 ** bits, in ascending order of the symbols."""

    symbols: np.ndarray  # uint32
    freqs: np.ndarray  # uint32
    bits: int

    @staticmethod
    def fit(counts: dict[int, int]) -> Table:
        """From the number of times that each symbol occurs; every one of them gets a frequency of at least 1."""
        symbols = np.array(sorted(counts), np.uint32)
        n = np.array([counts[int(s)] for s in symbols], np.float64)
        bits = min(max(14, int(len(symbols)).bit_length() + 2), 24)
        whole = 1 << bits
        freqs = np.maximum(1, np.floor(n / max(n.sum(), 1) * whole)).astype(np.int64)
        over = int(freqs.sum()) - whole
        while over > 0 and len(freqs):  # take what the rare symbols were given from those that can spare it most
            spare = np.minimum(freqs - 1, np.ceil((freqs - 1) / (freqs - 1).sum() * over).astype(np.int64))
            taken = np.minimum(spare, np.maximum(0, over - (np.cumsum(spare) - spare)))
            freqs, over = freqs - taken, over - int(taken.sum())
        if len(freqs):
            freqs[np.argmax(freqs)] -= over
        return Table(symbols, freqs.astype(np.uint32), bits)

    def to_bytes(self) -> bytes:
        body = np.array([self.bits, len(self.symbols)], "<u4").tobytes() + self.symbols.astype("<u4").tobytes() + self.freqs.astype("<u4").tobytes()
        return body + np.array([zlib.crc32(body)], "<u4").tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> Table:
        if zlib.crc32(data[:-4]) != int.from_bytes(data[-4:], "little"):
            raise ValueError("the frequency table is damaged")
        bits, n = np.frombuffer(data, "<u4", 2)
        return Table(np.frombuffer(data, "<u4", n, 8), np.frombuffer(data, "<u4", n, 8 + 4 * int(n)), int(bits))

    @cached_property
    def crc(self) -> int:
        return zlib.crc32(self.to_bytes())

    @cached_property
    def cums(self) -> np.ndarray:
        return np.cumsum(self.freqs, dtype=np.uint64) - self.freqs

    @cached_property
    def places(self) -> np.ndarray:
        """The place of each symbol in the table, by symbol; -1 for those not in it."""
        out = np.full(int(self.symbols[-1]) + 1 if len(self.symbols) else 0, -1, np.int32)
        out[self.symbols] = np.arange(len(self.symbols), dtype=np.int32)
        return out

    @cached_property
    def slots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, frequency, place in the symbol's own range) of each slot."""
        f = self.freqs.astype(np.int64)
        own = np.arange(f.sum()) - np.repeat(self.cums.astype(np.int64), f)
        return np.repeat(self.symbols, f), np.repeat(self.freqs.astype(np.uint64), f), own.astype(np.uint64)


@dataclass(frozen=True)
class Coded:
    """A coded block: 32-bit words, and for each segment its first word and the lanes' states before it."""

    words: np.ndarray  # uint32
    firsts: np.ndarray  # int64
    states: np.ndarray  # uint64, segments x lanes


def encode(ids: np.ndarray, table: Table, lanes: int, every: int) -> Coded:
    """``every`` is the number of steps of a segment; the last step may be short of ids."""
    n = len(ids)
    place = table.places[ids] if n and int(ids.max()) < len(table.places) else np.full(n, -1)
    if (place < 0).any():
        raise ValueError("an id is missing in the frequency table")
    f, c = table.freqs.astype(np.uint64)[place], table.cums[place]
    limit = f << np.uint64(LOW + 32 - table.bits)
    bits = np.uint64(table.bits)
    steps = -(-n // lanes)
    state = np.full(lanes, 1 << LOW, np.uint64)
    states, chunks, sizes = np.empty((max(1, -(-steps // every)), lanes), np.uint64), [], np.zeros(steps, np.int64)
    states[0] = state
    for step in range(steps - 1, -1, -1):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        x = state[: at.stop - at.start]
        full = np.flatnonzero(x >= limit[at])
        if len(full):
            moved = x[full]
            chunks.append(moved.astype(np.uint32))
            sizes[step] = len(full)
            x[full] = moved >> WORD
        q = x // f[at]
        x[:] = (q << bits) + (x - q * f[at]) + c[at]
        if step % every == 0:
            states[step // every] = state
    words = np.concatenate([np.empty(0, np.uint32), *reversed(chunks)])
    before = np.concatenate([[0], np.cumsum(sizes)])
    return Coded(words, before[0:steps:every] if steps else np.zeros(1, np.int64), states)


def decode(words: np.ndarray, state: np.ndarray, n: int, table: Table) -> np.ndarray:
    """The ``n`` ids of a segment, from its words and the lanes' states before it."""
    lanes, state = len(state), state.astype(np.uint64)
    symbols, freqs, own = table.slots
    mask, bits, low = np.uint64((1 << table.bits) - 1), np.uint64(table.bits), np.uint64(1 << LOW)
    words = words.astype(np.uint64)
    slots, done = np.empty(n, np.int64), 0
    for at in range(0, n, lanes):
        x = state[: min(lanes, n - at)]
        slot = (x & mask).astype(np.int64)
        slots[at:at + len(x)] = slot
        x[:] = freqs[slot] * (x >> bits) + own[slot]
        short = np.flatnonzero(x < low)
        if len(short):
            x[short] = (x[short] << WORD) | words[done:done + len(short)]
            done += len(short)
    if done != len(words):
        raise ValueError("a segment has words left over")
    return symbols[slots]


def joined_crc(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings put together, from their own; ``length`` is that of the second."""
    step, shift, zero, left = bytes(1 << 20), first, 0, length
    while left:
        part = step[: min(left, len(step))]
        shift, zero, left = zlib.crc32(part, shift), zlib.crc32(part, zero), left - len(part)
    return shift ^ zero ^ second
