"""Code lengths of grams from counts that stay in a partitioned table.

The cost of a gram follows from the counts of the grams that share its last
context bytes and from the levels of the shorter contexts. Grams of up to
``LOW`` context bytes have a bound that no corpus moves and are sent; all others
are dealt by the last ``LOW`` + 1 bytes of their contexts, and a task builds the
part of the trie that its grams make. The costs of the most frequent grams are
sent to the tasks that read texts; the others are met by a join. Which are sent
changes no result.

Costs are multiples of 2 ** -30, so that sums up to 2 ** 23 are the same in any
order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calepin.llm.ppm import Trie, gram_mask
from calepin.llm.tables import LongTable

LOW = 2
UNIT = 2.0**30
# Costs that a task computes at a time.
HELD_COSTS = 1 << 20
# Classes of counts a doubling, to find how many grams can be sent.
STEPS = 8


def masked_key(length: int):
    return F.col("key").bitwiseAND(F.lit(int(gram_mask(length))))


def low_counts(counts: DataFrame, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each model 0, 1, ... the grams of up to LOW context bytes."""
    low = counts.groupBy("model", masked_key(min(order, LOW) + 1).alias("key")).agg(F.sum("n").alias("n"))
    table = low.select("model", "key", "n").toArrow()
    model, key, n = (table[c].to_numpy() for c in ("model", "key", "n"))
    return [(key[model == m].view(np.uint64), n[model == m]) for m in range(int(model.max(initial=0)) + 1)]


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """key: the grams of the largest counts, ``most`` at most."""
    size = F.floor(F.log2("n") * STEPS)
    held, least = 0, None
    for row in sorted(counts.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):
        held += row["count"]
        if held > most:
            break
        least = row["size"]
    return counts.where(F.lit(False) if least is None else size >= least).select("key")


_LOW: dict[str, list[Trie]] = {}


def low_tries(name: str, shared) -> list[Trie]:
    """The sent levels, built once a worker process."""
    if name not in _LOW:
        _LOW.clear()
        order, low = shared.value
        _LOW[name] = [Trie(keys, counts, min(order, LOW)) for keys, counts in low]
    return _LOW[name]


class CodeLengths:
    """Costs under several models of counts (model, key, n), n above 0."""

    def __init__(self, counts: DataFrame, order: int):
        self.counts, self.order = counts, order
        self.low = counts.sparkSession.sparkContext.broadcast((order, low_counts(counts, order)))
        self.name = uuid.uuid4().hex

    def of(self, wanted: DataFrame) -> DataFrame:
        """key, costs: of distinct keys the natural logarithm of the last byte's
        probability after the others, under each model."""
        order, low, name = self.order, self.low, self.name

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [[b.column(k).to_numpy() for k in range(3)] for b in batches if b.num_rows]
            if not held:
                return
            model, key, n = (np.concatenate(x) for x in zip(*held))
            del held
            key = key.view(np.uint64)
            asked = key[model < 0]
            if not len(asked):
                return
            below = low_tries(name, low)
            at = np.argsort(model, kind="stable")
            edges = np.searchsorted(model[at], np.arange(len(below) + 1))
            parts = [at[a:b] for a, b in zip(edges, edges[1:])]
            tries = [Trie(key[p], n[p], order, short) for p, short in zip(parts, below)]
            step = max(HELD_COSTS // len(tries), 1)
            for start in range(0, len(asked), step):
                piece = asked[start : start + step]
                costs = np.stack([t.log_probability(piece) for t in tries], axis=1)
                costs = np.round(costs * UNIT) / UNIT
                offsets = np.arange(len(piece) + 1, dtype=np.int32) * len(tries)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece.view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(costs.ravel()))],
                    names=["key", "costs"],
                )

        return (
            self.counts.select(F.col("model").cast("int"), "key", "n")
            .unionByName(wanted.select(F.lit(-1).alias("model"), "key", F.lit(0).cast("long").alias("n")))
            .repartition(F.shiftrightunsigned("key", 8).bitwiseAND(F.lit(int(gram_mask(LOW + 1)))))
            .mapInArrow(run, "key bigint, costs array<double>")
        )


class SentCosts:
    """Sent grams and their costs; other grams cost 0 here and are listed."""

    def __init__(self, keys: np.ndarray, costs: np.ndarray):
        self.table = LongTable(keys)
        self.costs = np.concatenate([costs, np.zeros((1, costs.shape[1]))])

    def met(self, grams: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
        """Costs of all grams, and of each text the grams that were not sent."""
        at = self.table.find(grams)
        other = np.flatnonzero(at < 0)
        row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[other]
        rare, which = np.unique(grams[other], return_inverse=True)
        return self.costs[at], listed(row, which, rare, len(edges) - 1)


def sent_costs(lengths: CodeLengths, wanted: DataFrame, models: int) -> tuple[np.ndarray, np.ndarray]:
    table = lengths.of(wanted).toArrow()
    costs = table["costs"].combine_chunks().flatten().to_numpy()
    return table["key"].to_numpy().view(np.uint64), costs.reshape(-1, models)


KEY_TIMES = "array<struct<key: bigint, times: int>>"


def listed(row: np.ndarray, which: np.ndarray, keys: np.ndarray, rows: int) -> pa.ListArray:
    """Of each row its keys[which], each once with its number of occurrences."""
    pairs, times = np.unique(row.astype(np.int64) << 32 | which, return_counts=True)
    edges = np.searchsorted(pairs, np.arange(rows + 1) << 32).astype(np.int32)
    pairs &= (1 << 32) - 1
    found = pa.StructArray.from_arrays(
        [pa.array(keys[pairs].view(np.int64)), pa.array(times.astype(np.int32))], ["key", "times"]
    )
    return pa.ListArray.from_arrays(pa.array(edges), found)
