"""Sum-of-squares packing of documents into sequences.

Tokens come from the public tokenizer, one encoding a distinct word and slice;
a special token spelled out in a text is that token, as for the tokenizer as
loaded from its file.
A document's ids end with one separator id and are cut only if they exceed the
capacity. Whole pieces of full length are sequences of their own. All others
are dealt by a hash into groups of about ``group_size`` pieces; each group
places its pieces, longest first, where the sum over gaps g of N(g) squared
becomes smallest, N(g) being the number of open sequences with g places left.
A group leaves a few sequences open, so with groups of this size the loss does
not grow with the input's size. A group holds lengths and ids only.

Null text counts as empty (its separator alone); rows that repeat are packed
each on their own; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calepin.llm.common import KEPT, filled, shared_folder, stored, text_slices
from calepin.llm.tables import Memo, spans, sums

CAPACITY = 4096
SEPARATOR = 1
# Pieces that one task packs.
GROUP_SIZE = 200_000
# Between words of one text, and how many words such a text has.
BETWEEN, WORDS_A_TEXT = "\x1e", 500
# Plain words: letters and one mark at most. What tokens that end a word end with.
PLAIN, WORD_END = "^[a-z]+[.,;:!?]?$", "</w>"
# Words that a worker process remembers: some 80 MB.
WORDS_HELD = 400_000


@lru_cache(maxsize=1)  # one a worker process, kept between its tasks
def remembering(path: str) -> Memo:
    """Ids of words by the tokenizer of a file. Words are encoded many to a
    text. Plain ones are told apart by the tokens that end a word, all others by
    a control character between them that is a token of its own."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    (between,) = tokenizer.encode(BETWEEN, add_special_tokens=False).ids
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    ends_word[[k for token, k in vocabulary.items() if token.endswith(WORD_END)]] = True

    def many(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def flat_ids(texts: list[str]) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *(np.array(i, dtype=np.uint32) for i in many(texts))])

    def plain_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words one after another and how many each has. The letters
        end with a token of a word's end, and a mark behind them is another."""
        flat = flat_ids([" ".join(words[i : i + WORDS_A_TEXT]) for i in range(0, len(words), WORDS_A_TEXT)])
        ends = np.flatnonzero(ends_word[flat]) + 1
        last = np.cumsum([1 if w[-1].isalpha() else 2 for w in words], dtype=np.int64) - 1
        return flat, np.diff(np.r_[0, ends[last]])

    def marked_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any words, by the control character between them."""
        plain = [w if BETWEEN not in w else "" for w in words]
        flat = flat_ids(
            [
                f" {BETWEEN} ".join(plain[i : i + WORDS_A_TEXT]) + f" {BETWEEN}"
                for i in range(0, len(plain), WORDS_A_TEXT)
            ]
        )
        marks = flat == between
        ends = np.flatnonzero(marks) - np.arange(len(words))
        flat = flat[~marks]
        if "" in plain:  # these hold the control character themselves
            own = np.split(flat, ends)
            for k, w in enumerate(words):
                if BETWEEN in w:
                    own[k] = np.array(many([w])[0], dtype=np.uint32)
            flat = np.concatenate(own)
            ends = np.cumsum([len(ids) for ids in own[: len(words)]])
        return flat, np.diff(np.r_[0, ends].astype(np.int64))

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        is_plain = pc.match_substring_regex(pa.array(words, pa.string()), PLAIN).to_numpy(zero_copy_only=False)
        is_plain = is_plain.astype(bool) & ends_word.any()
        order = np.r_[np.flatnonzero(is_plain), np.flatnonzero(~is_plain)]
        turned = [words[k] for k in order.tolist()]
        first = int(is_plain.sum())
        parts = [plain_ids(turned[:first]), marked_ids(turned[first:])]
        flat, lengths = (np.concatenate(x) for x in zip(*parts))
        sizes, starts = np.empty_like(lengths), np.empty_like(lengths)
        sizes[order], starts[order] = lengths, np.cumsum(lengths) - lengths
        return flat[spans(starts, sizes)], np.r_[0, np.cumsum(sizes)]

    KEPT["packing"] = remembering.cache_clear
    return Memo(encode, WORDS_HELD)


def word_ids(memo: Memo, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another and their offsets. The tokenizer
    lowers letters, drops white space and never joins words across it, so every
    distinct word is encoded once."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    words = lists.flatten().dictionary_encode()
    ids, starts, sizes = memo.of(words.dictionary.to_pylist())
    which = words.indices.to_numpy()
    lengths = sizes[which]
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(sums(lengths, edges), out=offsets[1:])
    return ids[spans(starts[which], lengths)], offsets


@lru_cache(maxsize=1)
def special_tokens(path: str) -> tuple[str, dict[str, int]]:
    """A pattern of the tokens that the tokenizer takes out of a text first, as
    they are spelled, and their ids."""
    ids = {t["content"]: t["id"] for t in json.loads(Path(path).read_bytes())["added_tokens"]}
    return "|".join(re.escape(t) for t in sorted(ids, key=len, reverse=True)), ids


def text_ids(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another and their offsets. Between special
    tokens a text is encoded by its words; these are lowered, so that special
    tokens in capitals are ordinary words."""
    memo, (pattern, special) = remembering(path), special_tokens(path)
    if not pattern or not pc.any(pc.match_substring_regex(texts, pattern)).as_py():
        return word_ids(memo, texts)
    parts, marks, edges = [], [], [0]
    for text in texts.to_pylist():
        found = re.split(f"({pattern})", text)
        parts += found[::2]
        marks += [*(special[t] for t in found[1::2]), -1]
        edges.append(len(parts))
    ids, offsets = word_ids(memo, pa.array(parts, pa.string()))
    marks = np.array(marks)
    marked = marks >= 0
    whole = np.insert(ids, offsets[1:][marked], marks[marked].astype(np.uint32))
    return whole, (offsets + np.r_[0, np.cumsum(marked)])[edges]


def cut(docs: DataFrame, path: str, capacity: int, separator: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, keeps="packing"):
            ids, offsets = text_ids(path, filled(batch.column("text")))
            rows, pieces, starts, lengths, crcs = [], [], [], [], []
            for row in range(batch.num_rows):
                own = np.append(ids[offsets[row] : offsets[row + 1]], np.uint32(separator))
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(len(part))
                    crcs.append(zlib.crc32(part.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int32())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, taken in the given order."""
    gaps = np.zeros(capacity + 1, dtype=np.int64)  # N(g)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    made = 0
    for k, length in enumerate(lengths.tolist()):
        # Moving a sequence from gap g to g - length changes the sum by
        # 2 (N(g - length) - N(g) + 1), without the term that a closed one has not.
        before = gaps[length:]
        after = gaps[: capacity + 1 - length].copy()
        change = 2 * (after - before) + 2
        change[0] = 1 - 2 * before[0]  # exactly full: it leaves the open ones
        change[before == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        fresh = 2 * gaps[capacity - length] + 1 if length < capacity else 0
        if change[best] <= fresh:
            gap = best + length
            sequence[k] = open_[gap].pop()
            gaps[gap] -= 1
        else:
            gap = capacity
            sequence[k] = made
            made += 1
        offset[k] = capacity - gap
        left = gap - length
        if left:
            open_[left].append(int(sequence[k]))
            gaps[left] += 1
    return sequence, offset


def packed(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
    group_size: int = GROUP_SIZE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    pieces = stored(cut(rows, path, capacity, separator), shared_folder(spark), "pieces")
    groups = max(1, -(-pieces.where(F.col("length") < capacity).count() // group_size))
    mixed = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    pieces = pieces.withColumn(
        "pack", F.when(F.col("length") < capacity, F.pmod(mixed, F.lit(groups))).otherwise(-1)
    )

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        sequence, offset = place(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=sequence * 2 * groups + 2 * key[0], offset=offset)

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    shared = pieces.where(F.col("pack") >= 0).groupBy("pack").applyInPandas(pack, schema)
    # Full pieces take odd numbers, the packed ones even numbers.
    alone = pieces.where(F.col("pack") < 0).select(
        "*",
        (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return shared.unionByName(alone).drop("pack")
