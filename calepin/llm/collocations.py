"""Phrase collocations: phrases whose words occur together more than their parts do.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and
into words at spaces and tabs. Words are counted first. Phrases of two words,
then of three, are counted by weighted acyclic automata: a task gathers its
phrases, and from the sorted ones builds count transducers, one for each prefix
range, state by state from the last word back, with a register that keeps one
of equal states. The transducers of a range meet in one task, which unions them
and sums their weights. Splitters of the ranges are quantiles of a sample of
phrases, weighted by the tasks that hold them, so a word that begins a third of
all phrases spans many ranges; the sample decides balance and no count. A task
that holds too much hands on sums so far, which Spark adds up.

A phrase counts only if the two phrases one word shorter in it are frequent.
Filters of a fixed number of bits tell which are: a false hit costs work, and
what stays below the least count leaves at the end. Candidates are composed
with their parts' counts by a join. Sums and comparisons are exact.

Null text is empty, null lang is ``und``. Repeated rows count each time. Empty
tables and tables without a frequent phrase give no rows.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calepin.llm.common import byte_table, shared_folder, stored, text_slices, translated
from calepin.llm.lm_scoring import hashes_of
from calepin.llm.ngram_join import P1, P2, P3, mix
from calepin.llm.ppm import words_of
from calepin.llm.tables import spans

MIN_COUNT, LONGEST, TOP, COVERED_PERCENT = 10, 3, 2000, 50
UNKNOWN = "und"
TO_PIECES = byte_table({".,;:!?\x0a\x0b\x0c\x0d": "\n", "\t": " "})
# Phrases, words and places for pairs of lang and word that a task holds before
# it hands them on. Packed numbers of three words fit 63 bits.
HELD_PHRASES, HELD_WORDS, HELD_PAIRS = 3_000_000, 1 << 20, 1 << 23
# Arcs that a prefix range should hold, ranges and sampled phrases at most, and
# one of how many phrases a task offers for the sample.
RANGE_ARCS, RANGES, SAMPLE, SAMPLE_EVERY = 1 << 18, 4096, 1 << 16, 256
FILTER_BITS = 26
TOP_PARTS = 16
# Bytes of text that a task takes apart at a time.
TEXT_BYTES = 8 << 20


# Count transducers


@dataclass
class CountTransducer:
    """An acyclic automaton over words whose paths all have one length. Of each
    level: where the arcs of its states begin, their labels (places in ``words``,
    which are sorted) and targets, which on the last level are the weights."""

    words: list[str]
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def built(words: list[str], phrases: np.ndarray, weights: np.ndarray) -> CountTransducer:
        """From sorted distinct phrases, a row of labels each."""
        targets, levels = weights, []
        for depth in range(phrases.shape[1] - 1, -1, -1):
            new = (phrases[1:, :depth] != phrases[:-1, :depth]).any(axis=1)
            first = np.flatnonzero(np.r_[True, new])
            offsets, labels, targets, states = registered(
                np.r_[first, len(phrases)], phrases[:, depth], targets
            )
            levels.insert(0, (narrow(offsets), narrow(labels), narrow(targets)))
            phrases, targets = phrases[first], states
        return CountTransducer(words, levels)

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Labels of all paths, in order, and their weights."""
        columns, at = [], np.zeros(1, dtype=np.int64)
        for offsets, labels, targets in self.levels:
            offsets = offsets.astype(np.int64)
            sizes = np.diff(offsets)[at]
            arcs = spans(offsets[at], sizes)
            columns = [np.repeat(c, sizes) for c in columns] + [labels[arcs].astype(np.int64)]
            at = targets[arcs].astype(np.int64)
        return np.stack(columns, axis=1), at


def narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def registered(
    offsets: np.ndarray, labels: np.ndarray, targets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Arcs of the distinct states, and the number of each state among them."""
    starts, sizes = offsets[:-1], np.diff(offsets)
    place = spans(np.zeros_like(sizes), sizes).astype(np.uint64)
    with np.errstate(over="ignore"):
        arcs = mix(labels.astype(np.uint64) * P1 + targets.astype(np.uint64) * P3 + place * P2)
        marks = np.add.reduceat(arcs, starts)
    _, first, which = np.unique(marks, return_index=True, return_inverse=True)
    like = first[which]
    # A mark is no proof: compare arc by arc.
    same = sizes == sizes[like]
    own, other = spans(starts[same], sizes[same]), spans(starts[like[same]], sizes[same])
    equal = (labels[own] == labels[other]) & (targets[own] == targets[other])
    edges = np.r_[0, np.cumsum(sizes[same])[:-1]].astype(np.int64)
    same[np.flatnonzero(same)] = np.logical_and.reduceat(equal, edges)
    like = np.where(same, like, np.arange(len(sizes)))
    kept = np.flatnonzero(like == np.arange(len(sizes)))
    number = np.zeros(len(sizes), dtype=np.int64)
    number[kept] = np.arange(len(kept))
    arcs = spans(starts[kept], sizes[kept])
    return np.r_[0, np.cumsum(sizes[kept])], labels[arcs], targets[arcs], number[like]


def union(parts: list[CountTransducer]) -> CountTransducer:
    """One transducer of all their phrases, weights of equal ones summed."""
    words = sorted(set().union(*(p.words for p in parts)))
    place = {w: k for k, w in enumerate(words)}
    found, weights = [], []
    for part in parts:
        own, weight = part.phrases()
        found.append(np.fromiter(map(place.__getitem__, part.words), np.int64, len(part.words))[own])
        weights.append(weight)
    rows, weight = np.concatenate(found), np.concatenate(weights)
    code = rows[:, 0]
    for depth in range(1, rows.shape[1]):
        _, code = np.unique(code, return_inverse=True)
        code = code * len(words) + rows[:, depth]
    _, first, which = np.unique(code, return_index=True, return_inverse=True)
    total = np.zeros(len(first), dtype=np.int64)
    np.add.at(total, which, weight)
    return CountTransducer.built(words, rows[first], total)


# Filters of frequent phrases


def probe(hashes: np.ndarray, k: int) -> np.ndarray:
    return (hashes >> np.uint64(19 * k)) & np.uint64((1 << FILTER_BITS) - 1)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each hash."""
    left = np.arange(len(hashes))
    for k in range(3):  # most fail at once
        at = probe(hashes[left], k)
        left = left[(bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
    out = np.zeros(len(hashes), dtype=bool)
    out[left] = True
    return out


def longer(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases and one more word."""
    with np.errstate(over="ignore"):
        return mix(hashes * P1 + word)


def frequent_filter(frequent: DataFrame) -> np.ndarray:
    """The bits set by the (lang, phrase) rows, all phrases of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS - 6, dtype=np.uint64)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            split = [p.split(" ") for p in batch.column("phrase").to_pylist()]
            if not split:
                continue
            own = hashes_of(langs)
            columns = [longer(own, hashes_of(list(words))) for words in zip(*split)]
            hashes = columns[0]
            for word in columns[1:]:
                hashes = longer(hashes, word)
            for at in (probe(hashes, k) for k in range(3)):
                np.bitwise_or.at(bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(bits[used].view(np.int64))], names=["slot", "bits"]
        )

    rows = (
        frequent.select("lang", "phrase")
        .mapInArrow(run, "slot bigint, bits bigint")
        .groupBy("slot")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << FILTER_BITS - 6, dtype=np.uint64)
    out[rows["slot"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


# Words of a task


class Symbols:
    """Numbers of the (lang, word) pairs met, -1 for those that the filter rejects."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.word_at: dict[str, int] = {}
        self.lang_at: dict[str, int] = {}
        self.words, self.langs = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # hashes
        # Number of each lang's words, -2 for pairs not met.
        self.table = np.full((4, 1 << 14), -2, dtype=np.int32)
        self.pairs = np.zeros((0, 2), dtype=np.int64)
        self.hashes = np.zeros(0, dtype=np.uint64)

    def numbers(self, words: pa.Array, lang_of: np.ndarray, langs: list[str]) -> np.ndarray:
        coded = words.dictionary_encode()
        place, self.words = _places(coded.dictionary.to_pylist(), self.word_at, self.words)
        word = place[coded.indices.to_numpy()]
        place, self.langs = _places(langs, self.lang_at, self.langs)
        lang = place[lang_of] if len(place) else lang_of
        while self.table.shape[0] < len(self.langs) or self.table.shape[1] < len(self.words):
            axis = int(self.table.shape[0] >= len(self.langs))
            self.table = np.concatenate([self.table, np.full_like(self.table, -2)], axis=axis)
        numbers = self.table[lang, word]
        new = np.flatnonzero(numbers == -2)
        if len(new):
            pairs = np.unique(lang[new] << 32 | word[new])
            pairs = np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1)
            hashes = longer(self.langs[pairs[:, 0]], self.words[pairs[:, 1]])
            good = np.ones(len(pairs), bool) if self.bits is None else passes(self.bits, hashes)
            self.table[pairs[:, 0], pairs[:, 1]] = np.where(good, np.cumsum(good) - 1 + len(self.pairs), -1)
            self.pairs = np.concatenate([self.pairs, pairs[good]])
            self.hashes = np.r_[self.hashes, hashes[good]]
            numbers = self.table[lang, word]
        return numbers.astype(np.int64)

    def known(self) -> list[tuple[str, str]]:
        """(lang, word) by number."""
        langs, words = list(self.lang_at), list(self.word_at)
        return [(langs[a], words[b]) for a, b in self.pairs.tolist()]

    def full(self) -> bool:
        return self.table.size > HELD_PAIRS or len(self.pairs) > HELD_WORDS // 2


def _places(texts: list[str], at: dict[str, int], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each text, new ones added, and the hashes of all by number."""
    new = [t for t in texts if t not in at]
    at.update(zip(new, range(len(at), len(at) + len(new))))
    return np.fromiter(map(at.__getitem__, texts), np.int64, len(texts)), np.r_[hashes, hashes_of(new)]


def numbered(batch: pa.RecordBatch, symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words in turn, and whether each begins a piece."""
    lists = pc.split_pattern(translated(batch.column("text"), TO_PIECES), "\n")
    words, offsets = words_of(lists.flatten())
    coded = pc.fill_null(batch.column("lang"), UNKNOWN).dictionary_encode()
    piece_lang = np.repeat(coded.indices.to_numpy(), pc.list_value_length(lists).to_numpy())
    lang_of = np.repeat(piece_lang, np.diff(offsets)).astype(np.int64)
    begins = np.zeros(len(words) + 1, dtype=bool)
    begins[offsets] = True
    return symbols.numbers(words, lang_of, coded.dictionary.to_pylist()), begins[:-1]


# Counting


def word_counts(docs: DataFrame, sample_every: int = SAMPLE_EVERY) -> DataFrame:
    """lang, phrase and f of every word (sampled false), and of one in
    ``sample_every`` two-word phrases the number of tasks that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, counts, sample = Symbols(), np.zeros(0, np.int64), set()

        def handed_on() -> Iterator[pa.RecordBatch]:
            known = symbols.known()
            yield rows([s[0] for s in known], [s[1] for s in known], counts, False)
            pairs = [(known[p >> 32], known[p & 0xFFFFFFFF][1]) for p in sample]
            yield rows(
                [a[0] for a, _ in pairs], [f"{a[1]} {b}" for a, b in pairs], np.ones(len(pairs), np.int64), True
            )

        for batch in text_slices(batches, most=TEXT_BYTES):
            ids, begins = numbered(batch, symbols)
            counts = np.r_[counts, np.zeros(len(symbols.pairs) - len(counts), np.int64)]
            counts += np.bincount(ids, minlength=len(counts))
            first, second = ids[:-1][~begins[1:]], ids[1:][~begins[1:]]
            drawn = longer(symbols.hashes[first], symbols.hashes[second]) % np.uint64(sample_every) == 0
            sample.update((first[drawn] << 32 | second[drawn]).tolist())
            if symbols.full():
                yield from handed_on()
                symbols.clear()
                counts, sample = counts[:0], set()
        yield from handed_on()

    def rows(langs: list[str], phrases: list[str], counts: np.ndarray, sampled: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array(phrases, pa.string()),
                pa.array(counts),
                pa.array(np.full(len(langs), sampled)),
            ],
            names=["lang", "phrase", "f", "sampled"],
        )

    return (
        docs.mapInArrow(run, "lang string, phrase string, f bigint, sampled boolean")
        .groupBy("lang", "phrase", "sampled")
        .agg(F.sum("f").alias("f"))
    )


def splitters(sample: DataFrame, sample_every: int = SAMPLE_EVERY, range_arcs: int = RANGE_ARCS) -> list[tuple[str, str, str]]:
    """(lang, first word, second word) at which ranges of about equally many arcs begin."""
    thin = max(1, -(-sample.count() // SAMPLE))
    drawn = sample.where(F.pmod(F.xxhash64("lang", "phrase"), F.lit(thin)) == 0)
    rows = sorted((r.lang, *r.phrase.split(" "), r.f) for r in drawn.collect())
    arcs = np.cumsum([r[3] for r in rows]) if rows else np.zeros(1, np.int64)
    ranges = int(min(RANGES, max(1, arcs[-1] * sample_every * thin // range_arcs)))
    at = np.searchsorted(arcs, np.arange(1, ranges) * arcs[-1] / ranges)
    return sorted({rows[k][:3] for k in at.tolist()})


def cuts(
    symbols: list[tuple[str, str]], length: int, bounds: list[tuple[str, str, str]]
) -> np.ndarray:
    """The least packed phrase of sorted symbols at or behind each bound."""
    out = []
    for lang, *words in bounds:
        key = 0
        for depth in range(length):
            wanted = (lang, words[depth]) if depth < len(words) else None
            at = bisect_left(symbols, wanted) if wanted else 0
            key |= at << 21 * (length - 1 - depth)
            if wanted is None or at == len(symbols) or symbols[at] != wanted:
                break
        out.append(key)
    return np.array(out, dtype=np.int64)


def phrase_counts(
    docs: DataFrame,
    length: int,
    words_filter,
    shorter_filter,
    bounds: list[tuple[str, str, str]],
    min_count: int,
    folder: str,
    most: int = HELD_PHRASES,
) -> DataFrame:
    """lang, phrase and f of the phrases of so many words that occur often enough.
    Their words pass one filter, the phrases one word shorter the other. A task
    holds about ``most`` phrases at a time."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, held, many = Symbols(words_filter.value), [], 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            known = symbols.known()
            order = sorted(range(len(known)), key=known.__getitem__)
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            known = [known[k] for k in order]
            shifts, low = [21 * (length - 1 - k) for k in range(length)], (1 << 21) - 1
            for own in held:  # words by rank, so that phrases sort as their words do
                ranked = sum((rank[own >> s & low] << s for s in shifts), np.zeros_like(own))
                own[:] = ranked
            packed, times = np.unique(np.concatenate(held), return_counts=True)
            phrases = np.stack([packed >> s & low for s in shifts], axis=1)
            # Languages follow one another: the first phrase of each is a bound, too.
            first = [k for k in range(len(known)) if not k or known[k][0] != known[k - 1][0]]
            turns = np.searchsorted(phrases[:, 0], first)
            at = np.searchsorted(packed, cuts(known, length, bounds))
            edges = sorted({0, len(packed), *at.tolist(), *turns.tolist()})
            spelled = np.array([w for _, w in known], dtype=object)
            lookup, bodies = np.zeros(len(known), dtype=np.int64), []
            for begin, end in zip(edges, edges[1:]):
                used = np.zeros(len(known), dtype=bool)
                used[phrases[begin:end]] = True
                used = np.flatnonzero(used)
                lookup[used] = np.arange(len(used))
                part = CountTransducer.built(
                    spelled[used].tolist(), lookup[phrases[begin:end]], times[begin:end]
                )
                bodies.append(pickle.dumps(part, protocol=5))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.searchsorted(at, edges[:-1], side="right").astype(np.int32)),
                    pa.array([known[k][0] for k in phrases[edges[:-1], 0].tolist()], pa.string()),
                    pa.array(bodies, pa.binary()),
                ],
                names=["range", "lang", "body"],
            )

        for batch in text_slices(batches, most=TEXT_BYTES):
            ids, begins = numbered(batch, symbols)
            good = ids >= 0
            good[1:] &= ~begins[1:]  # of a phrase's words after the first
            at = np.flatnonzero(ids >= 0)
            for k in range(1, length):
                at = at[at + k < len(ids)]
                at = at[good[at + k]]
            for begin in (0, 1) if shorter_filter is not None and len(at) else ():
                own = symbols.hashes[ids[at + begin]]
                for k in range(1, length - 1):
                    own = longer(own, symbols.hashes[ids[at + begin + k]])
                at = at[passes(shorter_filter.value, own)]
            packed = np.zeros(len(at), dtype=np.int64)
            for k in range(length):
                packed = packed << 21 | ids[at + k]
            held.append(packed)
            many += len(packed)
            if many > most or symbols.full():
                if many:
                    yield from handed_on()
                symbols.clear()
                held, many = [], 0
        if many:
            yield from handed_on()

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, arcs, whole = None, [], 0, True

        def handed_on(last: bool) -> pa.RecordBatch:
            result = union(held)
            phrases, weights = result.phrases()
            if last and whole:
                phrases, weights = phrases[weights >= min_count], weights[weights >= min_count]
            words = pa.array(result.words, pa.string())
            spelled = pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in phrases.T), " ")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([now[1]] * len(weights), pa.string()),
                    spelled,
                    pa.array(weights),
                    pa.array(np.full(len(weights), last and whole)),
                ],
                names=["lang", "phrase", "f", "whole"],
            )

        for batch in batches:
            for k, key in enumerate(zip(batch.column("range").to_pylist(), batch.column("lang").to_pylist())):
                if key != now:
                    if held:
                        yield handed_on(True)
                    now, held, arcs, whole = key, [], 0, True
                part = pickle.loads(batch.column("body")[k].as_py())
                held.append(part)
                arcs += len(part.levels[-1][1])
                if arcs > most:
                    held = [union(held)]
                    arcs = len(held[0].levels[-1][1])
                    if arcs > most // 2:
                        whole = False
                        yield handed_on(False)
                        held, arcs = [], 0
        if held:
            yield handed_on(True)

    counted = stored(
        docs.mapInArrow(shards, "range int, lang string, body binary")
        .repartition("range")
        .sortWithinPartitions("range", "lang")
        .mapInArrow(united, "lang string, phrase string, f bigint, whole boolean"),
        folder,
        f"phrases-{length}",
    )
    rest = counted.where("not whole").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return counted.where("whole").drop("whole").unionByName(rest.where(F.col("f") >= min_count))


def part(words: Column, begin: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def mined(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    lang: str = "lang",
    text: str = "text",
    most: int = HELD_PHRASES,
    sample_every: int = SAMPLE_EVERY,
    range_arcs: int = RANGE_ARCS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score. The last three parameters bound
    what a task holds and change no result."""
    if longest not in (2, 3):
        raise ValueError("phrases have two or three words at most")
    spark = docs.sparkSession
    folder = shared_folder(spark)
    given = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = stored(word_counts(given, sample_every), folder, "words")
    words = counted.where("not sampled").drop("sampled")
    bounds = splitters(counted.where("sampled"), sample_every, range_arcs)
    frequent = words.where(F.col("f") >= min_count)
    send = spark.sparkContext.broadcast
    word_bits = send(frequent_filter(frequent))
    levels, shorter = [frequent], None
    for length in range(2, longest + 1):
        levels.append(phrase_counts(given, length, word_bits, shorter, bounds, min_count, folder, most))
        if length < longest:
            shorter = send(frequent_filter(levels[-1]))
    candidates = levels[1].unionByName(levels[2]) if longest > 2 else levels[1]

    # Compose each candidate with the counts of its parts, cut by cut.
    split = F.split("phrase", " ")
    size = F.size("words")
    cut = (
        candidates.withColumnRenamed("f", "a")
        .withColumn("words", split)
        .withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
        .withColumn("left", part(F.col("words"), F.lit(1), F.col("k")))
        .withColumn("right", part(F.col("words"), F.col("k") + 1, size - F.col("k")))
    )
    parts = frequent if longest == 2 else frequent.unionByName(levels[1])
    lefts = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = "cast({} as decimal(38,0))".format
    ratio = f"{wide(1000000)} * {wide('a')} * {wide('a')} div ({wide('l')} * {wide('r')})"
    scored = (
        cut.join(lefts, ["lang", "left"])
        .join(rights, ["lang", "right"])
        .withColumn("score", F.expr(ratio))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    if longest > 2:
        # The most frequent longer candidate that holds each shorter one.
        longs = levels[2].withColumn("words", split)
        inside = (
            longs.select(
                "lang", "f", F.explode(F.array(*(part(F.col("words"), F.lit(k), F.lit(2)) for k in (1, 2)))).alias("phrase")
            )
            .groupBy("lang", "phrase")
            .agg(F.max("f").alias("longer"))
        )
        scored = scored.join(inside, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < COVERED_PERCENT * F.col("a"))
        )
    # The first of some parts of a language, and of these the first: a task sees
    # TOP_PARTS x top rows at most, however many candidates a language has.
    order = (F.desc("score"), F.desc("a"), "phrase")
    deal = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    ranked = scored.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r", deal.alias("deal"))
    for part_of in (("lang", "deal"), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*part_of).orderBy(*order))
        ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
