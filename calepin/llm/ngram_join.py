"""Self-join of documents by Jaccard similarity of word shingles, with PartEnum.

Documents with equal shingle sets form a class; the rest of the work is about
one set a class and task. Sets are dealt into size bands; two sets similar
enough share a band's instance as its lower or upper side, where their Hamming
distance has one bound. An instance deals the shingle hashes into groups of
partitions, so many that two similar sets differ in few partitions of all but
a few groups, and each subset of a group's partitions (one of one, or two of
three where the bound is small) gives a signature of the shingles in it. More
groups than the bound asks for are kept in reserve: a set may do without as
many groups as the reserve, so an empty subset, which says nothing, gives no
signature. A set with more such groups than that is dealt anew by other seeds,
and if it fails under all of them gives its prefix (the first of its shingles
in one fixed order, as many as any similar set must meet one of). Of two
similar sets either one has enough groups under some seed, or both give
prefixes: no pair is missed.

Shingles that occur most in all documents (a licence line, a much quoted
passage) stand last in the fixed order and outside the partitions: leaving the
same shingles out of all sets only shortens distances. Which they are changes
how many candidates arise, never the result.

Each task sorts its own signatures and hands on one row a key, so a signature
that a third of all sets share costs a row a task; its other members go
straight to the member table. Sets that share a signature are compared first
by sketches, whose differing bits are no more than differing shingles, then on
their shingles: each against one centre of its group to begin with. Groups
that one component holds need nothing more; pairs of members of different
components meet new centres while they are many, and at last each other.

Null or wordless text: no shingles, linked with nothing. Rows of one id are one
document; a null id has no component. Shingles are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, erf, exp, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calepin.llm.common import filled, make_room, shared_folder, stored, text_slices
from calepin.llm.components import components
from calepin.llm.lm_scoring import hashes_of
from calepin.llm.ppm import words_of
from calepin.llm.tables import LongTable, spans

SHINGLE = 5
# Similar: PERCENT of the union at least. The bounds below follow from 80.
PERCENT = 80
BAND = 1.25
# Seeds that a set is dealt by until it has enough nonempty subsets.
SEEDS = 2
# How often a much used shingle occurs, how many such are sent at most, and
# shingles that a task counts at a time.
USED, SENT_SHINGLES, HELD_SHINGLES = 9, 500_000, 1 << 22
# Bytes of a word that is hashed along with all others.
LONG_WORD = 64
# Texts that a task remembers to know copies by.
KNOWN_TEXTS = 2_000_000
SKETCH_BITS = 1024
# Signatures that a task holds before it hands them on.
HELD_SIGNATURES = 600_000
# Bytes of text whose signatures meet in one task, about, and a prime by which
# tasks begin at different parts.
PART_BYTES, TURN = 32 << 20, 2_654_435_761
# Members of a group are compared with centres first, a few a round, until so
# few pairs of different components are left for each member, or until rounds
# help no more; then such pairs are compared one by one.
PAIRS_A_MEMBER = 100
CENTRE_ROUNDS = 6
CENTRES_A_ROUND = 3
# Keys of a member by which a pair finds the one group to meet in.
FIRST_KEYS = 32
# Candidate ids that may be sent to all tasks; more are met by a shuffle join.
SENT_IDS = 1_000_000

P1, P2, P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * P2
        x = (x ^ (x >> np.uint64(27))) * P3
    return x ^ (x >> np.uint64(31))


# Sets


@dataclass
class Sets:
    """Sorted distinct shingle hashes of each row, one row after another."""

    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def part(self, chosen: np.ndarray) -> Sets:
        """The sets of those hashes that are chosen."""
        return Sets(self.hashes[chosen], np.r_[0, np.cumsum(chosen)][self.offsets])


def word_hashes(words: pa.Array) -> np.ndarray:
    """Hashes of all words at once, eight bytes a step; long ones one by one."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    starts, sizes = offsets[:-1].astype(np.int64) - offsets[0], np.diff(offsets)
    data = np.zeros(int(offsets[-1] - offsets[0]) + 8, dtype=np.uint8)
    if len(data) > 8:
        data[:-8] = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    read = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = mix((read[starts] & masks[np.minimum(sizes, 8)]) ^ mix(sizes.astype(np.uint64) * P1))
        for at in range(8, LONG_WORD, 8):
            on = np.flatnonzero((sizes > at) & (sizes <= LONG_WORD))
            if not len(on):
                break
            h[on] = mix(h[on] * P1 + (read[starts[on] + at] & masks[np.minimum(sizes[on] - at, 8)]))
    long = np.flatnonzero(sizes > LONG_WORD)
    if len(long):
        h[long] = hashes_of(words.take(pa.array(long)).to_pylist())
    return h


def shingle_hashes(texts: pa.Array, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, repeated ones each time, text after text, and the
    offsets of each text's."""
    words, offsets = words_of(texts)
    known = word_hashes(words)
    counts = np.diff(offsets)
    # The whole of a short text is one shingle.
    held = np.r_[0, np.cumsum(np.where(counts > 0, np.maximum(counts - length + 1, 1), 0))]
    inside = np.ones(max(len(known) - length + 1, 0), dtype=bool)  # windows within one text
    for k in range(1, length):
        over = offsets[1:][counts >= k] - k
        inside[over[over < len(inside)]] = False
    with np.errstate(over="ignore"):
        h = np.full(len(inside), length, dtype=np.uint64)
        for k in range(length):  # of neighbouring words, without a copy of them
            h *= P1
            h += known[k : k + len(inside)]
        h = h[inside]
        short = np.flatnonzero((counts > 0) & (counts < length))
        if len(short):
            every = np.empty(held[-1], dtype=np.uint64)
            whole = np.ones(len(every), dtype=bool)
            whole[held[short]] = False
            every[whole] = h
            for n in range(1, length):
                own = short[counts[short] == n]
                h = np.full(len(own), n, dtype=np.uint64)
                for k in range(n):
                    h = h * P1 + known[offsets[own] + k]
                every[held[own]] = h
            h = every
        return mix(h * P1), held


def shingle_sets(texts: pa.Array, length: int = SHINGLE) -> Sets:
    h, held = shingle_hashes(texts, length)
    for begin, end in zip(held[:-1].tolist(), held[1:].tolist()):
        h[begin:end].sort()
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    new[held[:-1][held[1:] > held[:-1]]] = True
    return Sets(h[new], np.r_[0, np.cumsum(new)][held])


def set_hashes(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Two independent sums over each set: equal for equal sets only."""

    def total(values: np.ndarray) -> np.ndarray:
        running = np.zeros(len(values) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values, out=running[1:])
            return running[sets.offsets[1:]] - running[sets.offsets[:-1]]

    return mix(total(mix(sets.hashes ^ P1))), mix(total(mix(sets.hashes ^ P3)))


# Signatures


@dataclass(frozen=True)
class Instance:
    """Sizes low..high of the smaller set of a pair, and how sets are cut."""

    number: int
    low: int
    high: int
    distance: int  # bound of the Hamming distance of similar sets
    groups: int
    parts: int
    spare: int  # groups beyond those that similar sets may all differ in


def need(size):
    """Shingles that a set of this size shares with any similar set."""
    return -(-size * PERCENT // 100)


def hamming_bound(low: int, high: int) -> int:
    sizes = np.arange(2 * low, high + high * 100 // PERCENT + 1)
    return int((sizes - 2 * -(-sizes * PERCENT // (100 + PERCENT))).max())


def cut_of(low: int, distance: int) -> tuple[int, int, int]:
    """Groups, partitions a group and spare groups with the fewest expected
    signatures for sets of the instance's sizes."""
    parts = 3 if distance <= 12 else 1
    # Groups in which similar sets may differ so much that no subset agrees.
    broken = distance if parts == 1 else distance // 2

    def cost(spare: int) -> float:
        groups, total = broken + 1 + spare, 0.0
        for size in (1.05 * low, 1.2 * low, 1.4 * low, 1.6 * low):
            mean = size / groups * (1 if parts == 1 else 2 / 3)
            thin = exp(-mean)
            weak = min(1.0, thin * (1 if parts == 1 else 2.5))
            spread = sqrt(max(groups * weak * (1 - weak), 1e-9))
            sparse = 0.5 * (1 - erf((spare + 0.5 - groups * weak) / spread / sqrt(2)))
            given = groups * parts * (1 - thin) * sum(sparse**k for k in range(SEEDS))
            # Prefixes hold single shingles, which meet more sets for nothing.
            total += given + 3 * sparse**SEEDS * (size - need(size) + 1)
        return total

    spare = min(range(broken + 4), key=cost)
    return broken + 1 + spare, parts, spare


@lru_cache(maxsize=None)
def instance(number: int) -> Instance:
    low = 1 if not number else instance(number - 1).high + 1
    high = max(low + 1, ceil(low * BAND)) - 1
    distance = hamming_bound(low, high)
    return Instance(number, low, high, distance, *cut_of(low, distance))


def bands(sizes: np.ndarray) -> np.ndarray:
    """The instance whose range holds each size."""
    highs, number = [], 0
    while not highs or highs[-1] < sizes.max(initial=0):
        highs.append(instance(number).high)
        number += 1
    return np.searchsorted(highs, sizes)


def instance_signatures(
    rare: Sets, used: Sets, rows: np.ndarray, of: Instance, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Row and signature, for rows whose size belongs to the instance. A set is
    the union of its rare and its much used shingles."""
    sizes, starts = rare.sizes[rows], rare.offsets[rows]
    owner = np.repeat(np.arange(len(rows)), sizes)
    h = rare.hashes[spans(starts, sizes)]
    cells = of.groups * of.parts
    if seed:
        h = mix(h ^ np.uint64(seed))
    cell = owner * cells + ((h >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
    if seed:  # else hashes, and so partitions, are in order within a row
        order = np.argsort(cell, kind="stable")
        cell, h = cell[order], h[order]
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]][: len(cell)])
    with np.errstate(over="ignore"):
        sums = np.zeros(len(rows) * cells, dtype=np.uint64)
        held = np.zeros(len(rows) * cells, dtype=np.int32)
        if len(first):
            sums[cell[first]] = np.add.reduceat(mix(h ^ P3), first)
            held[cell[first]] = 1
        sums = sums.reshape(len(rows), of.groups, of.parts)
        held = held.reshape(sums.shape)
        if of.parts > 1:  # all partitions of a group but one
            sums = sums.sum(axis=2, keepdims=True, dtype=np.uint64) - sums
            held = held.sum(axis=2, keepdims=True) - held
        place = np.arange(cells, dtype=np.uint64).reshape(1, of.groups, of.parts)
        salt = mix(place + np.uint64(of.number << 40 | (seed + 1) << 32))
        signatures = mix(sums ^ salt)
    full = held > 0
    owners = np.broadcast_to(np.arange(len(rows)).reshape(-1, 1, 1), full.shape)[full]
    found = [(rows[owners], signatures[full])]
    sparse = rows[(~full).any(axis=2).sum(axis=1) > of.spare]
    if len(sparse) and seed + 1 < SEEDS:
        found.append(instance_signatures(rare, used, sparse, of, seed + 1))
    elif len(sparse):
        size = rare.sizes[sparse] + used.sizes[sparse]
        count = size - need(size) + 1
        own = np.minimum(count, rare.sizes[sparse])
        rest = count - own
        prefix = np.r_[
            rare.hashes[spans(rare.offsets[sparse], own)], used.hashes[spans(used.offsets[sparse], rest)]
        ]
        owners = np.r_[np.repeat(sparse, own), np.repeat(sparse, rest)]
        found.append((owners, mix(prefix ^ mix(np.array([of.number << 40], dtype=np.uint64)))))
    return np.concatenate([r for r, _ in found]), np.concatenate([x for _, x in found])


def signatures(
    sets: Sets, rows: np.ndarray, much_used: LongTable | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Row and signature of the given rows, in all their instances."""
    sizes = sets.sizes[rows]
    known = np.zeros(len(sets.hashes), bool) if much_used is None else much_used.find(sets.hashes) >= 0
    rare, used = sets.part(~known), sets.part(known)
    own, lower = bands(sizes), bands(need(sizes))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for number in np.unique(np.r_[own, lower]):
        of = instance(int(number))
        members = rows[(lower <= number) & (own >= number)]
        if of.distance and len(members):
            found.append(instance_signatures(rare, used, members, of))
    return np.concatenate([r for r, _ in found]), np.concatenate([x for _, x in found])


def sketches(sets: Sets) -> np.ndarray:
    """Rows x WORDS bits of parity: each shingle flips one bit, so two sets
    differ in as many shingles as their sketches in bits, at least."""
    bit = mix(sets.hashes ^ P2) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    row = np.repeat(np.arange(len(sets.offsets) - 1), sets.sizes)
    places, times = np.unique(row * SKETCH_BITS + bit.astype(np.int64), return_counts=True)
    bits = np.zeros((len(sets.offsets) - 1) * SKETCH_BITS, dtype=np.uint8)
    bits[places[times % 2 == 1]] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64).reshape(-1, SKETCH_BITS // 64)


# Spark


SIGNATURE, DOCUMENT, LOCAL = 0, 1, 2
ROWS = "kind int, key bigint, node bigint, n bigint, check bigint, sketch array<bigint>"
LIST_NAMES = ("keys", "nodes", "ns", "checks", "sketches")
LISTS = "kind int, part int, " + ", ".join(f"{c} array<bigint>" for c in LIST_NAMES)
SKETCH_WORDS = SKETCH_BITS // 64


def lists_of(kind: int, parts: list[int], bounds: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """A row per part: the values between two bounds of each column, and of the
    fifth, which has SKETCH_WORDS values for each of theirs."""
    edges = [pa.array((bounds * (SKETCH_WORDS if k == 4 else 1)).astype(np.int32)) for k in range(5)]
    values = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns]
    empty = pa.array(np.zeros(len(bounds), np.int32))
    lists = [pa.ListArray.from_arrays(e, v) for e, v in zip(edges, values)]
    lists += [pa.ListArray.from_arrays(empty, pa.array([], pa.int64()))] * (5 - len(lists))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(parts), pa.int32()), pa.array(parts, pa.int32()), *lists],
        names=["kind", "part", *LIST_NAMES],
    )


def emitted(docs: DataFrame, length: int, parts: int, much_used=None) -> DataFrame:
    """Signatures of each distinct set of a task and facts of each document, as
    lists dealt to so many parts: by key, each key once with its first node.
    Keys of several nodes come once more, with all of them."""

    def handed_on(keys: np.ndarray, nodes: np.ndarray, turn: int) -> Iterator[pa.RecordBatch]:
        order = np.argsort(keys, kind="stable")
        keys, nodes = keys[order], nodes[order]
        first = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
        lead = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
        shared = np.zeros(len(keys), dtype=bool)
        shared[lead[~first]] = True
        shared |= ~first
        part = (keys[first] >> np.uint64(40)) % np.uint64(parts)
        deal = np.argsort(part, kind="stable")
        own, begins = np.unique(part[deal], return_index=True)
        bounds = np.r_[begins, len(deal)]
        yield lists_of(SIGNATURE, own.tolist(), bounds, keys[first][deal], nodes[first][deal])
        cut = np.linspace(0, shared.sum(), 5).astype(int)
        yield lists_of(
            LOCAL, [(turn + k) % parts for k in range(4)], cut, keys[shared], nodes[shared], nodes[lead[shared]]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LongTable(much_used.value) if much_used is not None else None
        seen: set[int] = set()
        # What may go to any part is dealt in turn, by each task from another one on.
        keys, nodes, held, turn = [], [], 0, TaskContext.get().partitionId() * TURN % parts
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text"), length)
            ids = batch.column("doc_id").to_numpy()
            a, b = set_hashes(sets)
            sizes = sets.sizes
            # Copies within a task give their signatures once.
            new = []
            for row, key in enumerate((a ^ b).tolist()):
                if sizes[row] and key not in seen:
                    seen.add(key)
                    new.append(row)
            if len(seen) > KNOWN_TEXTS:
                seen.clear()
            row, signature = signatures(sets, np.array(new, dtype=np.int64), known)
            keys.append(signature)
            nodes.append(ids[row])
            held += len(row)
            turn += 1
            yield lists_of(DOCUMENT, [turn % parts], np.array([0, len(ids)]), a, ids, sizes, b, sketches(sets).ravel())
            if held > HELD_SIGNATURES:
                yield from handed_on(np.concatenate(keys), np.concatenate(nodes), turn)
                keys, nodes, held = [], [], 0
        if held:
            yield from handed_on(np.concatenate(keys), np.concatenate(nodes), turn)

    return docs.mapInArrow(run, LISTS)


def usage(docs: DataFrame, length: int) -> tuple[np.ndarray, int]:
    """Hashes of the shingles that occur most in all texts, copies that a task
    meets again left out, and the bytes of all texts, copies included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, many, size = [np.zeros(0, np.uint64)], 0, 0

        def handed_on() -> pa.RecordBatch:
            hashes = np.concatenate(held)
            del held[1:]
            hashes.sort()
            # One among these is left out: what occurs often, some task meets twice.
            own, times = np.unique(hashes[1:][hashes[1:] == hashes[:-1]], return_counts=True)
            times += 1
            return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(times)], names=["key", "times"])

        for batch in text_slices(batches):
            texts = filled(batch.column("text"))
            size += pc.sum(pc.binary_length(texts)).as_py() or 0
            marks = hashes_of(texts.to_pylist()).tolist()
            new = [row for row, mark in enumerate(marks) if mark not in seen and not seen.add(mark)]
            hashes, _ = shingle_hashes(texts.take(pa.array(new, pa.int32())), length)
            held.append(hashes)
            many += len(hashes)
            if many > HELD_SHINGLES:
                yield handed_on()
                many = 0
            if len(seen) > KNOWN_TEXTS:
                seen.clear()
        yield handed_on()
        # The row without a key has the bytes.
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([size], pa.int64())], names=["key", "times"])

    used = (
        docs.select("text")
        .mapInArrow(run, "key bigint, times bigint")
        .groupBy("key")
        .agg(F.sum("times").alias("times"))
        .where((F.col("times") >= USED) | F.col("key").isNull())
        .orderBy(F.col("key").isNotNull(), F.desc("times"), "key")
        .limit(SENT_SHINGLES + 1)
        .toArrow()
    )
    keyed = used.filter(pc.is_valid(used["key"]))
    size = pc.sum(used.filter(pc.is_null(used["key"]))["times"]).as_py() or 0
    return keyed["key"].to_numpy()[:SENT_SHINGLES].view(np.uint64), size


def much_used_shingles(docs: DataFrame, length: int) -> np.ndarray:
    return usage(docs, length)[0]


def grouped(lists: DataFrame) -> DataFrame:
    """Documents as rows, and (key, node) rows of keys with two nodes or more,
    ``n`` being a node that the key's tasks or a task agree on."""

    def flat(table: pa.Table, kind: int) -> list[np.ndarray]:
        own = table.filter(pc.equal(table["kind"], kind))
        return [
            pc.list_flatten(own[c]).combine_chunks().to_numpy(zero_copy_only=False)
            for c in LIST_NAMES
        ]

    def run(table: pa.Table) -> pa.Table:
        make_room()
        keys, nodes, *_ = flat(table, SIGNATURE)
        order = np.argsort(keys, kind="stable")
        keys, nodes = keys[order], nodes[order]
        first = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
        lead = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
        shared = ~first
        shared[lead[~first]] = True
        local = flat(table, LOCAL)
        documents = flat(table, DOCUMENT)
        none = [np.zeros(shared.sum() + len(local[0]), np.int64)] * 2
        return pa.table(
            {
                "kind": np.r_[none[0], np.full(len(documents[0]), DOCUMENT)].astype(np.int32),
                "key": np.r_[keys[shared], local[0], documents[0]],
                "node": np.r_[nodes[shared], local[1], documents[1]],
                "n": np.r_[nodes[lead[shared]], local[2], documents[2]],
                "check": np.r_[none[1], documents[3]],
                "sketch": pa.concat_arrays(
                    [
                        pa.nulls(len(none[0]), pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(documents[0]) + 1, dtype=np.int32) * SKETCH_WORDS),
                            pa.array(documents[4]),
                        ),
                    ]
                ),
            }
        )

    return lists.groupBy("part").applyInArrow(run, ROWS)


def sets_of(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """node, n, hashes of the wanted documents, from their texts."""
    if wanted.count() <= SENT_IDS:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text"), length)
            lists = pa.ListArray.from_arrays(
                pa.array(sets.offsets.astype(np.int32)), pa.array(sets.hashes.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets.sizes), lists], names=["node", "n", "hashes"]
            )

    chosen = docs.join(wanted, docs["doc_id"] == wanted["node"], "left_semi")
    return chosen.mapInArrow(run, "node bigint, n bigint, hashes array<bigint>")


def side(sets: DataFrame, name: str, *columns: str) -> DataFrame:
    return sets.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))


def possible(x: str, y: str) -> Column:
    """Whether sizes and sketches of two sides do not rule out similarity."""
    sizes = F.col(f"n_{x}"), F.col(f"n_{y}")
    both = sizes[0] + sizes[1]
    bound = both - 2 * F.ceil(both * PERCENT / (100 + PERCENT))
    differ = sum(
        (
            F.bit_count(F.get(f"sketch_{x}", F.lit(k)).bitwiseXOR(F.get(f"sketch_{y}", F.lit(k))))
            for k in range(SKETCH_WORDS)
        ),
        F.lit(0),
    )
    return (100 * F.least(*sizes) >= PERCENT * F.greatest(*sizes)) & (differ <= bound)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar."""
    both = pairs.join(side(sets, "a", "n", "hashes"), "a").join(side(sets, "b", "n", "hashes"), "b")
    shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
    union = F.col("n_a") + F.col("n_b") - shared
    return both.where(100 * shared >= PERCENT * union).select("a", "b")


def joined(
    docs: DataFrame, length: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = given.where("doc_id is not null")
    used, size = usage(rows, length)
    # A part is held in memory, so there are more of them the more text there is.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    much_used = spark.sparkContext.broadcast(used)
    found = stored(grouped(emitted(rows, length, parts, much_used)), folder, "found")
    documents = found.where(F.col("kind") == DOCUMENT).select(
        F.col("node").alias("doc_id"), "n", F.col("key").alias("a"), F.col("check").alias("b")
    )
    # Classes of equal sets; copies are combined before they are shuffled.
    copies = (
        documents.where("n > 0")
        .groupBy("n", "a", "b")
        .agg(F.min("doc_id").alias("class"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    classed = stored(
        documents.join(copies, ["n", "a", "b"], "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class", "doc_id").alias("class")
        ),
        folder,
        "classes",
    )
    shifted = classed.where("class <> doc_id").select(F.col("doc_id").alias("node"), "class").distinct()
    members = found.where(F.col("kind") == SIGNATURE).select("key", "node")
    # Members by class: equal sets have the same signatures. Of keys with the
    # same members one is enough.
    members = stored(
        members.join(shifted, "node", "left")
        .select("key", F.coalesce("class", "node").alias("node"))
        .repartition("key")
        .distinct(),
        folder,
        "members",
    )
    same = members.groupBy("key").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    leading = same.where("c > 1").groupBy("c", "x", "y").agg(F.min("key").alias("key"))
    members = stored(members.join(leading, "key", "left_semi"), folder, "groups")
    facts = found.where(F.col("kind") == DOCUMENT).select("node", "n", "sketch").dropDuplicates(["node"])
    links = linked(members, facts, lambda nodes: sets_of(rows, nodes, length), folder)
    given_component = components(links, folder, "components")
    result = classed.join(
        given_component, classed["class"] == given_component["node"], "left"
    ).select("doc_id", "n_shingles", F.coalesce("component", "class").alias("component_id"))
    nameless = given.where("doc_id is null").select(F.lit(0).cast("long").alias("doc_id"), "text")
    return result.unionByName(
        emitted(nameless, length, 1)
        .where(F.col("kind") == DOCUMENT)
        .select(
            F.lit(None).cast("long").alias("doc_id"),
            F.explode("ns").alias("n_shingles"),
            F.lit(None).cast("long").alias("component_id"),
        )
    )


def ranked(node: str, round_: int) -> Column:
    return F.struct(F.xxhash64(node, F.lit(round_)).alias("rank"), F.col(node).alias("id"))


def linked(
    members: DataFrame, facts: DataFrame, shingles: Callable[[DataFrame], DataFrame], folder: str
) -> DataFrame:
    """Similar pairs (a, b) that join all members similar to one another.
    ``facts`` has sizes and sketches, ``shingles`` gives the sets of nodes."""
    spark = members.sparkSession
    links = tried = spark.createDataFrame([], "a long, b long")
    before = None
    # Sketches go along with the members: pairs are compared where they meet.
    state = stored(
        members.join(facts, "node").withColumn("component", F.col("node")), folder, "state"
    )
    for round_ in range(CENTRE_ROUNDS + 1):
        # Groups that more than one component shares, with a member to compare with.
        head = F.struct(F.xxhash64("node", F.lit(round_)).alias("rank"), "node", "component", "n", "sketch")
        groups = (
            state.groupBy("key")
            .agg(
                F.min(head).alias("head"),
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.count("*").alias("size"),
            )
            .where("low < high")
        )
        apart = stored(state.join(groups.drop("low", "high"), "key"), folder, f"apart-{round_}")
        within = apart.groupBy("key", "component").agg(F.count("*").alias("c"), F.first("size").alias("s"))
        left = within.agg(
            F.coalesce(F.sum("c"), F.lit(0)).alias("members"),
            F.coalesce(F.sum(F.col("c") * (F.col("s") - F.col("c"))) / 2, F.lit(0)).alias("pairs"),
        ).first()
        if not left.members:
            break
        stuck = before is not None and left.members > 0.9 * before
        # Centres come first in any case: similar sets meet under many keys.
        few = round_ > 0 and left.pairs <= PAIRS_A_MEMBER * left.members
        last = stuck or few or round_ == CENTRE_ROUNDS
        before = left.members
        if last:
            # Everyone outside a group's largest component against all others. Two
            # members that share keys among their first ones meet under the
            # least of these only; without such a key they meet wherever they do.
            largest = within.groupBy("key").agg(F.max_by("component", "c").alias("largest"))
            first_keys = apart.groupBy("node").agg(
                F.slice(F.sort_array(F.collect_set("key")), 1, FIRST_KEYS).alias("keys")
            )
            rows = stored(
                apart.drop("head", "size")
                .join(largest, "key")
                .withColumn("outer", F.col("component") != F.col("largest"))
                .join(first_keys, "node"),
                folder,
                "last",
            )
            columns = ("node", "component", "n", "sketch", "keys", "outer")
            x = rows.where("outer").select(F.col("key").alias("key_x"), *(F.col(c).alias(f"{c}_x") for c in columns))
            y = rows.select("key", *(F.col(c).alias(f"{c}_y") for c in columns))
            once = ~F.col("outer_y") | (F.col("node_x") < F.col("node_y"))
            here = F.coalesce(F.array_min(F.array_intersect("keys_x", "keys_y")) == F.col("key"), F.lit(True))
            met = x.join(
                y,
                (F.col("key_x") == F.col("key"))
                & (F.col("component_x") != F.col("component_y"))
                & once
                & possible("x", "y")
                & here,
            )
            pairs = met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
        else:
            # Each member against one centre: that of most of its groups.
            met = apart.select(
                F.col("node").alias("node_x"), F.col("n").alias("n_x"), F.col("sketch").alias("sketch_x"), "component",
                *(F.col(f"head.{c}").alias(f"{c}_y") for c in ("node", "component", "n", "sketch")),
            ).where((F.col("component") != F.col("component_y")) & possible("x", "y"))
            best = Window.partitionBy("node_x").orderBy(F.desc("groups"), "node_y")
            pairs = (
                met.groupBy("node_x", "node_y")
                .agg(F.count("*").alias("groups"))
                .withColumn("rank", F.row_number().over(best))
                .where(F.col("rank") <= CENTRES_A_ROUND)
                .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
            )
        pairs = pairs.distinct()
        if round_:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, folder, f"pairs-{round_}")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = stored(shingles(nodes), folder, f"sets-{round_}").dropDuplicates(["node"])
        found = stored(verified(pairs, sets), folder, f"links-{round_}")
        links = links.union(found)
        if last:
            break
        tried = tried.union(pairs)
        # A component's name for now: of a node and those linked with it the one
        # of the lowest rank, so mostly a centre. Names that differ within a
        # component cost comparisons and lose no link.
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        named = both.groupBy("node").agg(F.min(ranked("other", round_)).alias("lowest"))
        own = ranked("node", round_)
        renamed = (
            apart.select("key", "node", "n", "sketch")
            .join(named, "node", "left")
            .withColumn("component", F.least(own, F.coalesce("lowest", own))["id"])
            .drop("lowest")
        )
        state = stored(renamed, folder, f"state-{round_}")
    return links


def keep_one(docs: DataFrame, length: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose id is the smallest of their group, one row an id,
    with their own columns. Rows without an id belong to no group and stay."""
    groups = stored(joined(docs, length, doc_id, text), shared_folder(docs.sparkSession), "groups")
    groups = groups.where("doc_id is not null")
    gone = groups.where("doc_id <> component_id").select("doc_id")
    again = groups.groupBy("doc_id").count().where("count > 1").select("doc_id")
    apart, doubled = gone.union(again).distinct(), again.join(gone, "doc_id", "left_anti")

    def met(ids: DataFrame, how: str) -> DataFrame:
        name = "id of a group"  # no column of the documents
        ids = ids.select(F.col("doc_id").alias(name))
        if ids.count() <= SENT_IDS:
            ids = F.broadcast(ids)
        return docs.join(ids, docs[doc_id].cast("long") == ids[name], how)

    return met(apart, "left_anti").unionByName(met(doubled, "left_semi").dropDuplicates([doc_id]))
