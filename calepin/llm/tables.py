"""A read-only hash table of unsigned 64-bit keys, looked up by whole arrays."""

from __future__ import annotations

from itertools import repeat

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
FREE = np.uint64(0xFFFFFFFFFFFFFFFF)  # never a key


class LongTable:
    """Maps distinct keys to their positions, -1 for any other."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, dtype=np.uint64)
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.slots = np.full(1 << self.bits, FREE)
        self.places = np.full(1 << self.bits, -1, dtype=np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(left):
            free = self.slots[at] == FREE
            # Of the keys that want one free slot, the last written wins.
            self.slots[at[free]] = keys[left[free]]
            self.places[at[free]] = left[free]
            lost = self.places[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (keys ^ (keys >> np.uint64(29))) * MIX
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        found = self.slots[at]
        places = self.places[at]
        wrong = np.flatnonzero((found != keys) & (found != FREE))
        places[found != keys] = -1
        at = at[wrong]
        while len(wrong):
            at = (at + 1) & (len(self.slots) - 1)
            found = self.slots[at]
            hit = found == keys[wrong]
            places[wrong[hit]] = self.places[at[hit]]
            on = ~hit & (found != FREE)
            wrong, at = wrong[on], at[on]
        return places


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i], ..., starts[i] + lengths[i] - 1 of all i in turn."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i + 1]] for each i, empty ones included."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


class Memo:
    """Remembers what ``encode`` returned for words seen before, up to about
    ``bound`` of them; beyond, it keeps those that were asked for again since it
    last made room, half as many at most. ``encode`` takes a list of words and
    returns their values one after another and their offsets."""

    def __init__(self, encode, bound: int = 400_000):
        self.encode, self.bound = encode, bound
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.values: np.ndarray | None = None
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.again = np.zeros(0, dtype=bool)

    def _make_room(self) -> None:
        kept = np.flatnonzero(self.again)
        if self.values is None or len(kept) > self.bound // 2:
            self._forget()
            return
        words = [w for w, again in zip(self.place, self.again.tolist()) if again]
        self.place = dict(zip(words, range(len(words))))
        self.sizes = self.sizes[kept]
        self.values = self.values[spans(self.starts[kept], self.sizes)]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.again = np.zeros(len(kept), dtype=bool)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All values kept, and of each of the distinct words start and size."""
        if len(self.place) > self.bound:
            self._make_room()
        held = len(self.place)
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        self.again[at[at >= 0]] = True
        missing = np.flatnonzero(at < 0)
        if len(missing) or self.values is None:
            new = [words[k] for k in missing.tolist()]
            values, offsets = self.encode(new)
            before = 0 if self.values is None else len(self.values)
            self.values = values if self.values is None else np.concatenate([self.values, values])
            self.starts = np.concatenate([self.starts, offsets[:-1] + before])
            self.sizes = np.concatenate([self.sizes, np.diff(offsets)])
            self.again = np.concatenate([self.again, np.zeros(len(new), dtype=bool)])
            at[missing] = held + np.arange(len(new))
            self.place.update(zip(new, at[missing].tolist()))
        return self.values, self.starts[at], self.sizes[at]
