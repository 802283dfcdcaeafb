"""Sharding by sampled splitters, sizes near equal (law ``bytes``).

Records are ordered by (hash of the text, doc_id), so equal texts stay side by
side and a large group of copies can still be cut at any id. A bounded,
size-weighted sample of these keys gives quantile boundaries of many more
ranges than shards; the exact bytes of every range are then summed, ranges
over ``overfull`` times the mean are subdivided by boundaries sampled within
them, and runs of ranges become shards where the running sum crosses a
shard's share. Only keys and sizes move between tasks, never texts. What
reaches the driver is the boundary table and one sum per range.

Null text counts as no bytes, a null id sorts first; rows that repeat get a
slot each; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calepin.llm.common import shared_folder, stored

SHARDS = 16
# Ranges of the first cut and keys sampled for it. Both are bounds on what the
# driver and the one sorting task hold, at any size of the input.
RANGES = 1024
SAMPLE = 12_000
OVERFULL = 2.0
# A key that orders no row: beyond all others.
LONGEST = 2**63 - 1


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    body = F.col(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(body, F.lit(""))).alias("major"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-LONGEST)).alias("minor"),
    )


def sampled(rows: DataFrame, total: int, sample: int) -> DataFrame:
    """Keys drawn with a chance in proportion to size; a record larger than
    total / sample is always drawn and weighs its size, others weigh that step."""
    step = max(total / sample, 1e-9)
    draw = F.pmod(F.xxhash64("minor", "major", F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    return rows.where(draw < F.col("size") / step).select(
        *rows.columns, F.greatest(F.col("size").cast("double"), F.lit(step)).alias("weight")
    )


def quantile_keys(sample: DataFrame, ranges: Column, within: list[str]) -> DataFrame:
    """The first key of each quantile range of the sample, per group ``within``."""
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    order = group.orderBy("major", "minor")
    running = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    part = F.floor((running - F.col("weight") / 2) * ranges / F.sum("weight").over(group)).cast("int")
    return (
        sample.withColumn("part", part)
        .groupBy(*within, "part")
        .agg(F.min(F.struct("major", "minor")).alias("key"))
        .select(*within, "part", "key.major", "key.minor")
    )


def at_or_after(major: Column, minor: Column) -> Column:
    return (F.col("major") > major) | ((F.col("major") == major) & (F.col("minor") >= minor))


def ranged(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """Add ``range``: the index of the last boundary at or before a row's key
    (0 before all), by three levels of comparisons of about the cube root of
    the number of boundaries each."""
    if len(bounds) < 2:
        return rows.withColumn("range", F.lit(0))
    fan = max(2, math.ceil(len(bounds) ** (1 / 3)))
    majors = F.lit([major for major, _ in bounds])
    minors = F.lit([minor for _, minor in bounds])

    def step(base: Column, stride: int, count: int) -> Column:
        passed = F.lit(0)
        for k in range(1, count):
            at = base + k * stride
            beyond = at_or_after(F.get(majors, at), F.get(minors, at))
            passed = passed + F.when(beyond, 1).otherwise(0)
        return base + passed * stride

    inner = fan * fan
    return (
        rows.withColumn("coarse", step(F.lit(0), inner, math.ceil(len(bounds) / inner)))
        .withColumn("middle", step(F.col("coarse"), fan, fan))
        .withColumn("range", step(F.col("middle"), 1, fan))
        .drop("coarse", "middle")
    )


def range_sums(rows: DataFrame) -> list:
    """Bytes and rows of each range, in order; at most one row a range."""
    return (
        rows.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .orderBy("range")
        .collect()
    )


def splitters(
    rows: DataFrame, total: int, ranges: int, sample: int, overfull: float
) -> list[tuple[int, int]]:
    """Boundary keys: quantiles of a sample, then more within overfull ranges."""

    def collected(df: DataFrame) -> list[tuple[int, int]]:
        return [(row.major, row.minor) for row in df.collect()]

    bounds = sorted(set(collected(quantile_keys(sampled(rows, total, sample), F.lit(ranges), []))))
    cut = ranged(rows, bounds)
    full = [row for row in range_sums(cut) if row.bytes > overfull * total / ranges]
    if not full:
        return bounds
    # At most ranges / overfull rows: their shares add up to 1 at most.
    pieces = rows.sparkSession.createDataFrame(
        [(row.range, int(row.bytes * ranges * 2 // total) + 1) for row in full],
        "range int, pieces int",
    )
    within = sampled(cut.join(F.broadcast(pieces), "range"), total, sample)
    more = quantile_keys(within, F.col("pieces"), ["range"])
    return sorted({*bounds, *collected(more)})


def shards_of(
    docs: DataFrame,
    shards: int = SHARDS,
    ranges: int = RANGES,
    sample: int = SAMPLE,
    overfull: float = OVERFULL,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = stored(keyed(docs, doc_id, text), shared_folder(docs.sparkSession), "keys")
    total = rows.agg(F.sum("size")).first()[0] or 1
    bounds = splitters(rows, total, ranges, sample, overfull)
    cut = ranged(rows, bounds)
    plan, before, slots = [], 0, [0] * shards
    for row in range_sums(cut):
        shard = min(shards - 1, (before + row.bytes // 2) * shards // total)
        plan.append((row.range, shard, slots[shard]))
        before += row.bytes
        slots[shard] += row.rows
    # One row a range: bounded by the number of boundaries, so it may be sent.
    placed = cut.sparkSession.createDataFrame(plan, "range int, shard int, base long")
    order = Window.partitionBy("range").orderBy("major", "minor", "size")
    return (
        cut.join(F.broadcast(placed), "range")
        .withColumn("slot", F.col("base") + F.row_number().over(order) - 1)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
