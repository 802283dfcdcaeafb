"""Prediction by partial matching over bytes, counted by Spark and scored by arrays.

A text is modelled as its lower-cased words with one space between them and an
end byte; contexts before its first byte are end bytes. The trie of all
contexts up to ``order`` bytes follows from the counts of (order + 1)-grams
alone: dropping leading bytes gives every shorter context.

The code length of a byte starts at its longest context in the trie. A byte
seen there has probability (c - 1/2) / T (count, total); otherwise an escape of
S / 2T (distinct successors, method D) is paid and the next shorter context
decides among the bytes not excluded. Successors of a context are always among
those of its suffix, so what is excluded at a level depends on the context one
byte longer only, and each context keeps what its suffix has left: the cost of
a gram is a function of the gram and is looked up, not replayed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from calepin.llm.common import filled
from calepin.llm.tables import LongTable, sums

END = 10  # no word holds it
SYMBOLS = 256
# Rows of counts that a task keeps before it hands them on.
HELD_ROWS = 3_000_000


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts and the offsets of each text's words."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(filled(texts)))
    lists = pc.ascii_split_whitespace(trimmed)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.flatten()
    offsets = offsets - offsets[0]
    bare = pc.equal(trimmed, "").to_numpy(zero_copy_only=False)  # one word "" each
    if bare.any():
        words = words.filter(pc.not_equal(words, ""))
        offsets = offsets - np.r_[0, np.cumsum(bare)]
    return words, offsets


def gram_mask(length: int) -> np.uint64:
    return np.uint64((1 << 8 * length) - 1)


def text_grams(words: pa.Array, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (order + 1)-gram that ends at each byte, and the texts' offsets."""
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words)
    texts = pc.binary_join(lists, " ")
    lengths = pc.binary_length(texts).to_numpy().astype(np.int64) + 1
    # Seven end bytes before each text: room for any context and for reading
    # eight bytes at a time.
    padded = pc.binary_join_element_wise("\n" * 7, texts, "\n", "")
    data = _data(padded)
    ends = np.cumsum(lengths)
    read = np.ndarray((max(len(data) - 7, 0),), dtype=">u8", buffer=data, strides=(1,))
    inside = np.ones(len(read), dtype=bool)
    starts = ends - lengths + 7 * np.arange(len(lengths))
    for k in range(7):  # reads that end in the padding of the next text
        inside[(starts[1:] - 7 + k)] = False
    grams = read[inside].astype(np.uint64) & gram_mask(order + 1)
    return grams, np.r_[0, ends]


def _data(texts: pa.Array) -> memoryview:
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1]
    if not len(texts):
        return memoryview(b"")
    return memoryview(texts.buffers()[2])[int(offsets[0]) : int(offsets[-1])]


class Tally:
    """Counts of keys, merged whenever many rows have gathered."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.rows = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.rows += len(keys)
        if self.rows > HELD_ROWS:
            self._merge()

    def _merge(self) -> None:
        keys, which = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate(self.counts)).astype(np.int64)
        self.keys, self.counts, self.rows = [keys], [counts], len(keys)

    def full(self) -> bool:
        return self.rows > HELD_ROWS

    def drain(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.rows:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._merge()
        keys, counts = self.keys[0], self.counts[0]
        self.keys, self.counts, self.rows = [], [], 0
        return keys, counts


class Trie:
    """All contexts up to ``order`` bytes, from the counts of distinct grams.

    Where the grams are a part of all, namely all that share the bytes of their
    contexts next after ``low.order``, ``low`` has the levels up to that order of
    all grams; levels above are then those of the part."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int, low: Trie | None = None):
        self.order = order
        # of each order: grams, counts, contexts, total, distinct, left, new
        self.levels = low.levels[: order + 1] if low else []
        below = self.levels[-1] if low else None
        for k in range(len(self.levels), order + 1):
            keys, which = np.unique(grams & gram_mask(k + 1), return_inverse=True)
            count = np.bincount(which, weights=counts, minlength=len(keys))
            contexts, first = np.unique(keys >> np.uint64(8), return_index=True)
            edges = np.r_[first, len(keys)]
            total, distinct = sums(count, edges), np.diff(edges).astype(float)
            left = new = None
            if below is not None:
                shorter = np.searchsorted(below[0], keys & gram_mask(k))
                suffix = np.searchsorted(below[2], contexts & gram_mask(k - 1))
                left = below[3][suffix] - sums(below[1][shorter], edges)
                new = below[4][suffix] - distinct
            below = (keys, count, contexts, total, distinct, left, new)
            self.levels.append(below)

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        """Natural logarithm of the last byte's probability after the others."""
        if not len(self.levels[0][0]):  # nothing learned
            return np.full(len(grams), -np.log(SYMBOLS))
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        longer = np.full(len(grams), -1)  # context one byte longer, -1 if not in the trie
        for k in range(self.order, -1, -1):
            keys, count, contexts, total, distinct, _, _ = self.levels[k]
            if not len(keys):  # no gram of the part, nor of any longer level
                continue
            own = grams[todo]
            at = _exact(contexts, (own >> np.uint64(8)) & gram_mask(k))
            t, s = total[at], distinct[at]
            if k < self.order:
                left, new = self.levels[k + 1][5:]
                known = longer[todo] >= 0
                t = np.where(known, left[longer[todo]], t)
                s = np.where(known, new[longer[todo]], s)
            place = _exact(keys, own & gram_mask(k + 1))
            seen = place >= 0
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = np.log((count[place] - 0.5) / t)
                escape = np.where(s > 0, np.log(0.5 * s / t), 0.0)
            out[todo] += np.where(seen, hit, np.where(at >= 0, escape, 0.0))
            longer[todo] = at
            todo = todo[~seen]
            if not len(todo):
                return out
        out[todo] -= np.log(SYMBOLS - len(self.levels[0][0]))
        return out


def _exact(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted key in sorted keys, -1 where it is missing."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)
