"""Approximate nearest neighbours: a robust-pruned directed graph per shard.

Equal vectors form a class and are indexed once; of a class only as many ids
are kept as an answer can hold. Classes are dealt into shards of bounded size
by a hash. In a shard, points join the graph in batches: a greedy beam search
from the most central point proposes neighbours, and relaxed distance pruning
keeps a candidate unless one kept before is closer to it by the factor
``alpha``. Edges are made both ways and lists that grow too long are pruned
again. Each query runs a beam search in every shard, in blocks of queries, and
the shards' answers are merged by Spark.

A shard has a graph for each band of similar lengths, so that long vectors, the
likely answers, are not drowned by short ones. Largest inner product becomes
least distance by one more coordinate that gives all points of a band the same
length. Bands are searched from the longest vectors down, as far as they can
still hold an answer. Scores are inner products of the given
vectors in double precision.

Vectors that are null, zero or hold a null or non-finite component, and rows
without an id, take no part. Of rows that repeat an id the smallest vector
counts. Shorter vectors are filled with zeros. An empty table gives an empty
result; with fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calepin.llm.common import shared_folder, stored

NEAREST = 20
SHARD_SIZE = 5_000
BLOCK_SIZE = 4_096
# Tasks for each shard, or shard and block, so that few of them get two.
TASKS_A_SHARD = 2
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 200
ALPHA = 1.2
BATCH = 256
# Open points that a search expands at a time.
WIDTH = 4
# The longest vector of a band is so many times the shortest, unless the band
# would have fewer points than a small one.
BAND_RATIO, SMALL_BAND = 1.3, 128


class Graph:
    """Points of one shard and the out-edges of each (-1 for none)."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE):
        lengths = (vectors.astype(np.float64) ** 2).sum(axis=1)
        rest = np.sqrt(np.maximum(lengths.max(initial=0) - lengths, 0))
        self.points = np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)
        self.norms = (self.points**2).sum(axis=1)
        self.degree = degree
        count = len(vectors)
        self.edges = np.full((count, degree), -1, dtype=np.int32)
        self.entry = int(((self.points - self.points.mean(axis=0)) ** 2).sum(axis=1).argmin()) if count else 0
        if count <= degree + 1:
            for k in range(count):  # everyone knows everyone
                self.edges[k, : count - 1] = np.delete(np.arange(count), k)
        else:
            self._build()

    def _build(self) -> None:
        rng = np.random.default_rng(0)
        order = rng.permutation(len(self.points))
        order = np.r_[self.entry, order[order != self.entry]]
        for alpha in (1.0, ALPHA):
            begin = 1 if alpha == 1.0 else 0
            while begin < len(order):
                # Small batches first, while the graph is still thin.
                size = BATCH if alpha > 1 else int(min(BATCH, max(8, begin // 4)))
                self._join(order[begin : begin + size], alpha)
                begin += size

    def _join(self, new: np.ndarray, alpha: float) -> None:
        found, _ = self.search(self.points[new], BUILD_BEAM)
        own = self.edges[new]
        self._prune(new, np.concatenate([found, own], axis=1), alpha)
        # Edges back, to each target from all that chose it.
        targets = self.edges[new].ravel()
        sources = np.repeat(new, self.degree)
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
        widest = int(counts.max(initial=0))
        back = np.full((len(nodes), widest), -1, dtype=np.int32)
        column = np.arange(len(targets)) - np.repeat(first, counts)
        back[np.repeat(np.arange(len(nodes)), counts), column] = sources
        both = np.concatenate([self.edges[nodes], back], axis=1)
        both = -np.sort(-both, axis=1)  # present ones first
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        sizes = (both >= 0).sum(axis=1)
        fits = sizes <= self.degree
        packed = -np.sort(-both[fits], axis=1)[:, : self.degree]
        self.edges[nodes[fits]] = -1
        self.edges[nodes[fits], : packed.shape[1]] = packed
        over = np.flatnonzero(~fits)
        for k in range(0, len(over), BATCH):
            part = over[k : k + BATCH]
            self._prune(nodes[part], both[part], alpha)

    def _prune(self, nodes: np.ndarray, candidates: np.ndarray, alpha: float) -> None:
        """Give each node the diverse nearest of its candidates as out-edges."""
        candidates = -np.sort(-candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        candidates[candidates == nodes[:, None]] = -1
        width = int((candidates >= 0).sum(axis=1).max(initial=0))
        candidates = -np.sort(-candidates, axis=1)[:, :width]
        there = candidates >= 0
        points = self.points.take(np.where(there, candidates, 0), axis=0)
        own = self.points[nodes]
        norms = (points**2).sum(axis=2)
        near = norms + self.norms[nodes][:, None] - 2 * np.einsum("bcd,bd->bc", points, own)
        between = norms[:, :, None] + norms[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        near = np.where(there, np.maximum(near, 0), np.inf)
        rows = np.arange(len(nodes))
        out = np.full((len(nodes), self.degree), -1, dtype=np.int32)
        left = near.copy()
        for k in range(self.degree):
            best = left.argmin(axis=1)
            alive = np.isfinite(left[rows, best])
            if not alive.any():
                break
            out[alive, k] = candidates[rows, best][alive]
            # Distances are squared, so the factor is too.
            covered = alpha**2 * between[rows, best] <= near
            left[covered & alive[:, None]] = np.inf
            left[rows, best] = np.inf
        self.edges[nodes] = out

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam's points and squared distances for each query, nearest
        first (-1 and infinity where the graph ended)."""
        count = len(self.points)
        beam = min(beam, count)
        norms = (queries**2).sum(axis=1)
        ids = np.full((len(queries), beam), -1, dtype=np.int32)
        far = np.full((len(queries), beam), np.inf, dtype=np.float32)
        open_ = np.zeros((len(queries), beam), dtype=bool)
        seen = np.zeros((len(queries), count), dtype=bool)
        ids[:, 0] = self.entry
        far[:, 0] = norms + self.norms[self.entry] - 2 * queries @ self.points[self.entry]
        open_[:, 0] = True
        seen[:, self.entry] = True
        while True:
            active = np.flatnonzero(open_.any(axis=1))
            if not len(active):
                return ids, far
            # The nearest open points of each query, and their unseen neighbours.
            near = np.full((len(active), WIDTH, self.degree), -1, dtype=np.int32)
            for k in range(WIDTH):
                pick = open_[active].argmax(axis=1)
                real = open_[active, pick]
                if not real.any():
                    break
                open_[active, pick] = False
                near[real, k] = self.edges[ids[active[real], pick[real]]]
            near = -np.sort(-near.reshape(len(active), -1), axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            fresh = (near >= 0) & ~seen.take(active[:, None] * count + np.where(near >= 0, near, 0))
            near = np.where(fresh, near, -1)
            width = int(fresh.sum(axis=1).max(initial=0))
            if not width:
                continue
            near = -np.sort(-near, axis=1)[:, :width]
            fresh = near >= 0
            owner, column = np.nonzero(fresh)
            seen[active[owner], near[owner, column]] = True
            at = np.where(fresh, near, 0)
            distance = (
                norms[active][:, None]
                + self.norms.take(at)
                - 2 * np.einsum("bcd,bd->bc", self.points.take(at, axis=0), queries[active])
            )
            # Those that come into the beam; of most queries, soon few or none do.
            enters = fresh & (np.maximum(distance, 0) < far[active, -1:])
            width = int(enters.sum(axis=1).max(initial=0))
            if not width:
                continue
            rows = np.flatnonzero(enters.any(axis=1))
            order = np.argsort(~enters[rows], axis=1, kind="stable")[:, :width]
            rows = rows[:, None]
            enters, own = enters[rows, order], active[rows[:, 0]]
            distance = np.where(enters, np.maximum(distance[rows, order], 0), np.inf)
            all_ids = np.concatenate([ids[own], np.where(enters, near[rows, order], -1)], axis=1)
            all_far = np.concatenate([far[own], distance], axis=1)
            all_open = np.concatenate([open_[own], enters], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[own] = np.take_along_axis(all_ids, order, axis=1)
            far[own] = np.take_along_axis(all_far, order, axis=1)
            open_[own] = np.take_along_axis(all_open, order, axis=1)

    def nearest(self, queries: np.ndarray, beam: int) -> np.ndarray:
        return self.search(np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32), beam)[0]


class Shard:
    """Points in bands of similar length, longest first, with a graph each. A
    band is searched for those queries only that it can give a better answer:
    no inner product exceeds the product of both lengths."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, ratio: float = BAND_RATIO):
        self.vectors = vectors
        lengths = np.sqrt((vectors**2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.bands: list[tuple[float, np.ndarray, Graph]] = []
        begin = 0
        while begin < len(order):
            top = lengths[order[begin]]
            end = max(np.searchsorted(-lengths[order], -top / ratio, side="right"), begin + SMALL_BAND)
            own = order[begin:end]
            self.bands.append((float(top), own, Graph(vectors[own].astype(np.float32), degree)))
            begin = end

    def nearest(self, queries: np.ndarray, beam: int, kept: int) -> tuple[np.ndarray, np.ndarray]:
        """Points of the largest inner products with each query and these, best
        first; -1 and minus infinity where there are no more."""
        wide = max(beam, kept)
        found = np.full((len(queries), wide), -1, dtype=np.int64)
        scores = np.full((len(queries), wide), -np.inf)
        lengths = np.sqrt((queries**2).sum(axis=1))
        for top, own, graph in self.bands:
            # A little more than the bound, for its rounding.
            worth = np.flatnonzero(lengths * top * (1 + 1e-9) >= scores[:, kept - 1])
            if not len(worth):
                continue
            near = graph.nearest(queries[worth].astype(np.float32), wide)
            points = np.where(near >= 0, own[near], -1)
            value = np.einsum("bkd,bd->bk", self.vectors[points], queries[worth])
            value = np.where(points >= 0, value, -np.inf)
            all_found = np.concatenate([found[worth], points], axis=1)
            all_scores = np.concatenate([scores[worth], value], axis=1)
            order = np.argsort(-all_scores, axis=1, kind="stable")[:, :wide]
            found[worth] = np.take_along_axis(all_found, order, axis=1)
            scores[worth] = np.take_along_axis(all_scores, order, axis=1)
        return found, scores


def matrix(lists: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for k, values in enumerate(lists):
        out[k, : len(values)] = values
    return out


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(odd, F.lit(True)) & some
    )


def neighbours(
    rows: DataFrame,
    every: int = 20,
    nearest: int = NEAREST,
    shard_size: int = SHARD_SIZE,
    block_size: int = BLOCK_SIZE,
    beam: int = SEARCH_BEAM,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = rows.sparkSession
    folder = shared_folder(spark)
    given = stored(
        usable(rows, vec_id, vector).groupBy("vec_id").agg(F.min("vector").alias("vector")), folder, "given"
    )
    kept = nearest + 1  # one of them may be the query itself
    first = Window.partitionBy("vector").orderBy("vec_id")
    classes = stored(
        given.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= kept)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("class", F.get("ids", F.lit(0))),
        folder,
        "classes",
    )
    count, width = classes.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    shards = max(1, -(-count // shard_size))
    asked = given.where(F.col("vec_id") % every == 0).join(classes.select("vector", "class"), "vector")
    asked = stored(asked.select("vec_id", "class", "vector"), folder, "asked")
    distinct = asked.groupBy("class").agg(F.first("vector").alias("vector"))
    blocks = max(1, -(-distinct.count() // block_size))

    def index(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("class")
        vectors = matrix(shard["vector"], width)
        body = pickle.dumps((Shard(vectors), shard["ids"].map(list).tolist()), protocol=5)
        return pd.DataFrame({"shard": [key[0]], "body": [body]})

    spread = F.pmod(F.xxhash64("class"), F.lit(shards)).cast("int").alias("shard")
    # A shard is little to read and much to compute: tasks by number, not by size.
    dealt_shards = classes.select("class", "ids", "vector", spread).repartition(TASKS_A_SHARD * shards, "shard")
    graphs = stored(
        dealt_shards.groupBy("shard").applyInPandas(index, "shard int, body binary"),
        folder,
        "graphs",
    )

    def answer(key: tuple, shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["class", "vec_id", "score"]
        if not len(shard) or not len(queries):
            return pd.DataFrame(columns=names)
        graphs, ids = pickle.loads(shard["body"].iloc[0])
        found = []
        for begin in range(0, len(queries), BATCH):
            part = queries.iloc[begin : begin + BATCH]
            asked_for = matrix(part["vector"], width)
            for name, query, points in zip(part["class"], asked_for, graphs.nearest(asked_for, beam, kept)[0]):
                points = points[points >= 0]
                scores = (graphs.vectors[points] * query).sum(axis=1)
                if len(points) > kept:  # each has an id, so that the others are beyond what is kept
                    best = scores >= np.partition(scores, -kept)[-kept]
                    points, scores = points[best], scores[best]
                rows = sorted((-s, i) for s, p in zip(scores.tolist(), points.tolist()) for i in ids[p])
                found += [(name, i, -s) for s, i in rows[:kept]]
        return pd.DataFrame(found, columns=names)

    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    each_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    dealt = distinct.withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), F.lit(blocks)).cast("int"))
    tasks = TASKS_A_SHARD * shards * blocks
    searched = (
        graphs.withColumn("block", each_block)
        .repartition(tasks, "shard", "block")
        .groupBy("shard", "block")
        .cogroup(
            dealt.withColumn("shard", each_shard).repartition(tasks, "shard", "block").groupBy("shard", "block")
        )
        .applyInPandas(answer, "class long, vec_id long, score double")
    )
    best = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id")
    merged = (
        searched.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= kept)
        .groupBy("class")
        .agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    )
    others = F.slice(
        F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), F.lit(1), F.lit(nearest)
    )
    return (
        asked.select(F.col("vec_id").alias("query_id"), "class")
        .join(merged, "class")
        .select("query_id", F.posexplode(others).alias("at", "hit"))
        .select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("hit.vec_id").alias("vec_id"),
            F.col("hit.score").alias("score"),
        )
    )
