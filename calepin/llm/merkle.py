"""Merkle manifest of a dataset: a tree per group under one root, and proofs.

Rows are leaves, in order of a key within their tree; eight consecutive nodes,
fewer at the end, become the next one up until one is left. The trees' roots are
the leaves of a last tree. Leaves are range partitioned, so a tree of a third of
all rows is many tasks' work, and numbered from the counts of each partition.
Blocks of consecutive leaves, whole runs all of them, become leaf partitions.

Proofs are octopus multiproofs: a leaf partition finds the least union of node
coordinates that the proofs of all its leaves need and its own leaves do not
give, fetches them once by a join, derives the interiors its leaves share and
expands the proof of every leaf from them. Nothing but the largest tree's size
comes to the driver.

A null field counts as missing. Rows of one key follow one another in the order
of their digests; a null key comes first, a null tree is one of its own and
first. Equal rows are leaves each. A tree of one leaf is that leaf, and an
empty table has no tree and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calepin.llm.common import shared_folder, stored

FANOUT = 8
# Leaves of a block: a power of the fanout, with so many levels above them.
BLOCK_LEVELS = 3
BLOCK = FANOUT**BLOCK_LEVELS

Step = tuple[str, str]  # the siblings before and after a node


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Trees in a task


def missing(held: np.ndarray, count: int) -> list[tuple[int, int]]:
    """Level and place of the nodes that proofs of the held leaves need beyond
    them, in a tree of ``count`` leaves: the least such set."""
    out, level = [], 0
    while count > 1:
        runs = np.unique(held // FANOUT)
        wanted = (runs[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        out += [(level, i) for i in np.setdiff1d(wanted[wanted < count], held).tolist()]
        held, count, level = runs, -(-count // FANOUT), level + 1
    return out


class Block:
    """Consecutive leaves of a tree, with the nodes that their proofs lack."""

    def __init__(self, leaves: list[str], first: int, count: int, others: dict[tuple[int, int], str]):
        self.first = first
        # of each level: place of its first own node, steps of its own nodes
        self.levels: list[tuple[int, list[Step]]] = []
        own, at, level = leaves, first, 0
        while count > 1:
            steps, above = [], []
            for parent in range(at // FANOUT, (at + len(own) - 1) // FANOUT + 1):
                places = range(parent * FANOUT, min((parent + 1) * FANOUT, count))
                run = [
                    own[i - at] if at <= i < at + len(own) else others[level, i] for i in places
                ]
                above.append(digest("".join(run)))
                steps += [
                    ("".join(run[:k]), "".join(run[k + 1 :]))
                    for k, i in enumerate(places)
                    if at <= i < at + len(own)
                ]
            self.levels.append((at, steps))
            own, at, count, level = above, at // FANOUT, -(-count // FANOUT), level + 1
        self.root = own[0]

    def path(self, k: int) -> list[Step]:
        """The steps of the k-th leaf, upwards."""
        place, out = self.first + k, []
        for at, steps in self.levels:
            out.append(steps[place - at])
            place //= FANOUT
        return out

    def siblings(self, above: str) -> list[str]:
        """All siblings of each leaf's path, and those further up."""
        tails, last = [above], 0
        for at, steps in reversed(self.levels):
            tails = [
                before + after + tails[(at + k) // FANOUT - last]
                for k, (before, after) in enumerate(steps)
            ]
            last = at
        return tails


def block_tops(leaves: list[str], levels: int) -> str:
    for _ in range(levels):
        leaves = [digest("".join(leaves[k : k + FANOUT])) for k in range(0, len(leaves), FANOUT)]
    return leaves[0]


def folded(start: str, path: list[Step]) -> str:
    for before, after in path:
        start = digest(before + start + after)
    return start


def height(count: int) -> int:
    out = 0
    while count > 1:
        count, out = -(-count // FANOUT), out + 1
    return out


# Spark


def field(value: Column) -> Column:
    """A field's part of a leaf: its length in bytes and itself, or a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def spelled(value: Column) -> Column:
    return F.lower(F.hex(value))


def placed(leaves: DataFrame, folder: str, name: str) -> DataFrame:
    """The leaves with their ``place`` in the tree and its ``size``."""
    order = ("tree", "key", "leaf", "given")
    dealt = stored(
        leaves.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("given")
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id()),
        folder,
        f"{name}-dealt",
    )
    tree = Window.partitionBy("tree")
    counts = dealt.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("many"))
    starts = counts.select(
        F.col("tree").alias("tree_"),
        F.col("part").alias("part_"),
        (F.sum("many").over(tree.orderBy("part")) - F.col("many") - F.col("first")).alias("shift"),
        F.sum("many").over(tree).alias("size"),
    )
    return (
        dealt.join(starts, dealt["tree"].eqNullSafe(starts["tree_"]) & (dealt["part"] == starts["part_"]))
        .withColumn("place", F.col("at") + F.col("shift"))
        .drop("tree_", "part_", "part", "at", "shift")
    )


class Forest:
    """Trees over leaves (tree, key, leaf and what else goes along with a leaf)."""

    def __init__(self, leaves: DataFrame, folder: str, name: str):
        rows = placed(leaves.withColumn("given", F.monotonically_increasing_id()), folder, name)
        others = [c for c in rows.columns if c not in ("tree", "size", "place")]
        self.blocks = stored(
            rows.groupBy("tree", F.expr(f"place div {BLOCK}").alias("block"))
            .agg(
                F.first("size").alias("size"),
                F.sort_array(F.collect_list(F.struct("place", *others))).alias("leaves"),
            ),
            folder,
            f"{name}-blocks",
        )
        self.tree = leaves.schema["tree"].dataType.simpleString()
        now = stored(self._tops(), folder, f"{name}-{BLOCK_LEVELS}")
        largest = now.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
        self.nodes, level = now, BLOCK_LEVELS
        while FANOUT**level < largest:
            run = F.sort_array(F.collect_list(F.struct("place", spelled(F.col("node")).alias("node"))))
            now = stored(
                now.where(F.col("size") > FANOUT**level)
                .groupBy("tree", F.expr(f"place div {FANOUT}").alias("place"))
                .agg(F.first("size").alias("size"), run.alias("run"))
                .select(
                    "tree",
                    F.lit(level + 1).alias("level"),
                    "place",
                    "size",
                    F.unhex(F.sha2(F.array_join("run.node", ""), 256)).alias("node"),
                ),
                folder,
                f"{name}-{level + 1}",
            )
            self.nodes, level = self.nodes.unionByName(now), level + 1
        self.roots = self.nodes.where(F.expr(f"size <= power({FANOUT}, level)")).select("tree", "node")

    def _tops(self) -> DataFrame:
        """The node above each block, or the root of a smaller tree."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists, sizes = batch.column("leaves"), batch.column("size").to_pylist()
                tops = [
                    bytes.fromhex(block_tops([x["leaf"].as_py().hex() for x in lists[k]], min(BLOCK_LEVELS, height(n))))
                    for k, n in enumerate(sizes)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("tree"),
                        pa.array([BLOCK_LEVELS] * len(tops), pa.int32()),
                        batch.column("block"),
                        batch.column("size"),
                        pa.array(tops, pa.binary()),
                    ],
                    names=["tree", "level", "place", "size", "node"],
                )

        return self.blocks.mapInArrow(
            run, f"tree {self.tree}, level int, place bigint, size bigint, node binary"
        )

    def with_others(self) -> DataFrame:
        """The blocks, each with the nodes its proofs need: asked for once."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                blocks, sizes = batch.column("block").to_pylist(), batch.column("size").to_pylist()
                rows = [
                    (row, block, level, place)
                    for row, (block, n) in enumerate(zip(blocks, sizes))
                    for level, place in missing(np.arange(block * BLOCK, min((block + 1) * BLOCK, n)), n)
                ]
                trees = batch.column("tree").take(pa.array([r[0] for r in rows], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [trees, *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3))],
                    names=["tree", "block", "at_level", "at_place"],
                )

        wanted = self.blocks.select("tree", "block", "size").mapInArrow(
            run, f"tree {self.tree}, block bigint, at_level bigint, at_place bigint"
        )
        nodes = self.nodes.withColumnRenamed("tree", "of")
        fetched = (
            wanted.join(
                nodes,
                wanted["tree"].eqNullSafe(nodes["of"])
                & (wanted["at_level"] == nodes["level"])
                & (wanted["at_place"] == nodes["place"]),
            )
            .groupBy(F.col("tree").alias("of"), F.col("block").alias("of_block"))
            .agg(F.collect_list(F.struct("level", "place", "node")).alias("others"))
        )
        return self.blocks.join(
            fetched,
            self.blocks["tree"].eqNullSafe(fetched["of"]) & (self.blocks["block"] == fetched["of_block"]),
            "left",
        ).drop("of", "of_block")


def block_of(row: dict) -> Block:
    others = {(x["level"], x["place"]): x["node"].hex() for x in row["others"] or ()}
    leaves = [x["leaf"].hex() for x in row["leaves"]]
    return Block(leaves, row["block"] * BLOCK, row["size"], others)


def crown(subroots: DataFrame, folder: str) -> DataFrame:
    """Per tree its path to the one root, and that root."""
    leaves = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("key"), F.col("node").alias("leaf"))
    forest = Forest(leaves, folder, "crown")
    kind = leaves.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = block_of(row)
                paths = [block.path(k) for k in range(len(row["leaves"]))]
                yield pa.RecordBatch.from_pylist(
                    [
                        {"of": x["key"], "root": block.root, "above": [{"before": b, "after": a} for b, a in p]}
                        for x, p in zip(row["leaves"], paths)
                    ],
                    schema=pa.schema(
                        [
                            ("of", batch.schema.field("leaves").type.value_type.field("key").type),
                            ("root", pa.string()),
                            ("above", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
                        ]
                    ),
                )

    return forest.with_others().mapInArrow(
        run, f"of {kind}, root string, above array<struct<before: string, after: string>>"
    )


def proven(leaves: DataFrame, folder: str) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified of leaves
    (tree, key, leaf, claimed): whether the claimed digest, the leaf itself
    where it is null, leads to the root by the leaf's proof."""
    forest = Forest(leaves, folder, "trees")
    above = stored(crown(forest.roots, folder), folder, "above")
    blocks = forest.with_others()
    rows = blocks.join(above, blocks["tree"].eqNullSafe(above["of"])).drop("tree", "of")
    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kind = leaves.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                block, root = block_of(row), row["root"]
                top = [(x["before"], x["after"]) for x in row["above"]]
                proofs = block.siblings("".join(b + a for b, a in top))
                ends = [
                    folded((x["claimed"] or x["leaf"]).hex(), block.path(k) + top) for k, x in enumerate(row["leaves"])
                ]
                many = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("leaves")[at].values.field("key"),
                        pa.array([x["leaf"].hex() for x in row["leaves"]]),
                        pa.array([block.root] * many),
                        pa.array([root] * many),
                        pa.array(list(map(digest, proofs))),
                        pa.array(ends),
                        pa.array([e == root for e in ends]),
                    ],
                    names=names,
                )

    return rows.mapInArrow(
        run,
        f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


def manifest(docs: DataFrame, tree: str = "lang", key: str = "doc_id", fields: tuple[str, ...] | None = None) -> DataFrame:
    """tree, subroot and root of a table whose rows are leaves of the given
    fields, of all columns if none are given."""
    fields = fields or tuple(docs.columns)
    folder = shared_folder(docs.sparkSession)
    forest = Forest(
        stored(
            docs.select(
                F.col(tree).alias("tree"), F.col(key).alias("key"), leaf_digest(*map(F.col, fields)).alias("leaf")
            ),
            folder,
            "leaves",
        ),
        folder,
        "trees",
    )
    roots = crown(forest.roots, folder)
    return (
        forest.roots.join(roots, forest.roots["tree"].eqNullSafe(roots["of"]))
        .select(F.col("tree").alias(tree), spelled(F.col("node")).alias("subroot"), "root")
    )


def audited(docs: DataFrame, every: int = 3) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: proofs of
    all documents, those whose id's crc32 ``every`` divides tampered with (A-Z
    of the text in lower case). A null id is not tampered with."""
    folder = shared_folder(docs.sparkSession)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    leaves = docs.select(
        F.col("lang").alias("tree"),
        F.col("doc_id").alias("key"),
        leaf_digest(*rest, F.col("text")).alias("leaf"),
        F.when(drawn, leaf_digest(*rest, F.translate("text", upper, lower))).alias("claimed"),
    )
    return proven(stored(leaves, folder, "leaves"), folder).withColumnRenamed("key", "doc_id")
