"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a few ratios of its words, lines and characters, computed
by array operations over Arrow batches. Each feature is cut into quantile bins.
Training goes round the features in turn: a shallow tree over one feature's
bins fits the gradient of the logistic loss, and its leaf values, damped, are
added to that feature's lookup table. Feature pairs that explain most of what is
left get tables of their own in the same way. A score adds one table cell per
feature and pair.

The model is fitted on at most ``max_rows`` labelled rows, chosen by a hash of
the id (the bound is a parameter; fewer labels are all taken); every document
is scored. Null and empty texts get a score like any other, from features that
are 0. Of repeated labels of one id the largest counts. Without labels, or
with one class alone, every score is the share of label 1 (0.5 if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from calepin.llm.common import SLICE_BYTES, filled, fold, make_room, text_slices
from calepin.llm.quality_rules import stop_forms
from calepin.llm.tables import sums

MAX_ROWS = 40_000
THRESHOLD = 0.3
HELD_OUT_REMAINDER = 0

FEATURES = (
    "log_words",
    "mean_word_length",
    "symbols_per_word",
    "pipes_per_word",
    "shouts_per_word",
    "upper_share",
    "digit_share",
    "stop_share",
    "distinct_share",
    "top_word_share",
    "distinct_pair_share",
    "dup_line_share",
    "words_per_line",
    "wide_share",
)

UPPER, DIGIT, SYMBOL, PIPE, SHOUT, GAP, NEWLINE, WIDE = (1 << k for k in range(8))


def byte_classes() -> np.ndarray:
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[65:91] |= UPPER
    kinds[48:58] |= DIGIT
    for characters, kind in ((b"#*$%&<>", SYMBOL), (b"|", PIPE), (b"!?", SHOUT)):
        kinds[list(characters)] |= kind
    kinds[[32, 9, 10, 11, 12, 13]] |= GAP
    kinds[10] |= NEWLINE
    kinds[128:] |= WIDE
    return kinds


KINDS = byte_classes()
STOPS = pa.array(stop_forms())


def distinct_counts(row: np.ndarray, code: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of each row, and how often its most frequent one occurs."""
    pairs, times = np.unique(row.astype(np.int64) << 32 | code, return_counts=True)
    owner = pairs >> 32
    most = np.zeros(rows)
    np.maximum.at(most, owner, times)
    return np.bincount(owner, minlength=rows).astype(float), most


def features(texts: pa.Array) -> np.ndarray:
    """Texts x FEATURES."""
    texts = pc.binary_join_element_wise(filled(texts), "", "")  # a buffer of its own
    rows = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[: rows + 1].astype(np.int64) if rows else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: bounds[-1]]
    kinds = KINDS[data]

    def count(kind: int) -> np.ndarray:
        return sums((kinds & kind > 0).astype(np.int64), bounds).astype(float)

    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    edges = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    real = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[code]
    stop = pc.is_in(coded.dictionary, value_set=STOPS).to_numpy(zero_copy_only=False)[code]
    row = np.repeat(np.arange(rows), np.diff(edges))[real]
    stops = np.bincount(row, weights=stop[real], minlength=rows)
    code = code[real]
    words = np.bincount(row, minlength=rows).astype(float)
    n = np.maximum(words, 1)
    distinct, most = distinct_counts(row, code, rows)
    together = row[1:] == row[:-1]
    pair = (code[1:] * np.int64(1_000_003) + code[:-1])[together] & np.int64((1 << 32) - 1)
    pairs, _ = distinct_counts(row[1:][together], pair, rows)

    lines = pc.split_pattern(texts, "\n")
    line_edges = lines.offsets.to_numpy().astype(np.int64)
    line_code = lines.flatten().dictionary_encode()
    full = pc.not_equal(pc.ascii_trim_whitespace(line_code.dictionary), "").to_numpy(zero_copy_only=False)
    line = line_code.indices.to_numpy().astype(np.int64)
    kept = full[line] if len(line) else np.zeros(0, bool)
    line_row = np.repeat(np.arange(rows), np.diff(line_edges))[kept]
    line_count = np.bincount(line_row, minlength=rows).astype(float)
    line_distinct, _ = distinct_counts(line_row, line[kept], rows)

    size = np.maximum(np.diff(bounds) - count(GAP), 1)
    return np.stack(
        [
            np.log1p(words),
            (size - (words == 0)) / n,
            count(SYMBOL) / n,
            count(PIPE) / n,
            count(SHOUT) / n,
            count(UPPER) / size,
            count(DIGIT) / size,
            stops / n,
            distinct / n,
            most / n,
            pairs / np.maximum(words - 1, 1),
            (line_count - line_distinct) / np.maximum(line_count, 1),
            words / np.maximum(line_count, 1),
            count(WIDE) / size,
        ],
        axis=1,
    )


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; scoring is a sum of cells."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        cut = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]
        return np.stack(cut, axis=1) if cut else np.zeros((len(x), 0), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        total = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[bins[:, a], bins[:, b]]
        return 1 / (1 + np.exp(-total))


RIDGE = 1.0


def gain(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient**2 / (weight + RIDGE)


def best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; place 0 means none."""
    g, w = np.cumsum(gradient), np.cumsum(weight)
    if len(g) < 2:
        return 0.0, 0
    gains = gain(g[:-1], w[:-1]) + gain(g[-1] - g[:-1], w[-1] - w[:-1]) - gain(g[-1], w[-1])
    k = int(gains.argmax())
    return (float(gains[k]), k + 1) if gains[k] > 1e-9 else (0.0, 0)


def tree(gradient: np.ndarray, weight: np.ndarray, cuts: int) -> np.ndarray:
    """Leaf values per bin of a tree with so many cuts, best first."""
    leaves = [(0, len(gradient))]
    for _ in range(cuts):
        options = []
        for begin, end in leaves:
            value, at = best_cut(gradient[begin:end], weight[begin:end])
            options.append((value, begin, begin + at, end))
        value, begin, at, end = max(options)
        if value <= 0:
            break
        leaves.remove((begin, end))
        leaves += [(begin, at), (at, end)]
    values = np.zeros(len(gradient))
    for begin, end in leaves:
        values[begin:end] = gradient[begin:end].sum() / (weight[begin:end].sum() + RIDGE)
    return values


def pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """One cut of either feature, then one of the other on each side."""
    best = (0.0, np.zeros_like(gradient))
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        _, at = best_cut(g.sum(axis=1), w.sum(axis=1))
        values, total = np.zeros_like(g), -gain(g.sum(), w.sum())
        for side in (slice(0, at), slice(at, None)):
            gs, ws = g[side].sum(axis=0), w[side].sum(axis=0)
            _, cut = best_cut(gs, ws)
            for part in (slice(0, cut), slice(cut, None)):
                total += gain(gs[part].sum(), ws[part].sum())
                values[side, part] = gs[part].sum() / (ws[part].sum() + RIDGE)
        if total > best[0]:
            best = (float(total), values.T if turned else values)
    return best


def fit(
    x: np.ndarray,
    y: np.ndarray,
    bins: int = 32,
    rounds: int = 150,
    rate: float = 0.1,
    pairs: int = 6,
    pair_rounds: int = 60,
) -> AdditiveModel:
    """Cyclic boosting of feature tables, then of the strongest pairs."""
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        bounded = min(max(share, 1e-3), 1 - 1e-3)
        return AdditiveModel(float(np.log(bounded / (1 - bounded))))
    model = AdditiveModel(float(np.log(share / (1 - share))))
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, k], cuts)) for k in range(x.shape[1])]
    code = model.bins(x)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            gradient, weight = slopes()
            step = rate * tree(
                np.bincount(code[:, k], gradient, len(table)), np.bincount(code[:, k], weight, len(table)), 3
            )
            table += step
            total += step[code[:, k]]

    def sheet(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.tables[a]), len(model.tables[b])
        at = code[:, a] * shape[1] + code[:, b]
        gradient, weight = slopes()
        cells = shape[0] * shape[1]
        return np.bincount(at, gradient, cells).reshape(shape), np.bincount(at, weight, cells).reshape(shape)

    ranked = sorted(
        combinations(range(x.shape[1]), 2), key=lambda ab: -pair_tree(*sheet(*ab))[0]
    )
    model.pairs = ranked[:pairs]
    model.pair_tables = [np.zeros((len(model.tables[a]), len(model.tables[b]))) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            _, values = pair_tree(*sheet(a, b))
            table += rate * values
            total += rate * values[code[:, a], code[:, b]]
    return model


def trained(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> AdditiveModel:
    """The model of a bounded choice of labelled rows outside the held-out fold."""
    key = F.col(doc_id)
    chosen = (
        labels.where(F.col(label).isNotNull() & key.isNotNull() & (fold(key) != HELD_OUT_REMAINDER))
        .groupBy(key.alias("doc_id"))
        .agg(F.max(label).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), *(pa.array(x[:, k]) for k in range(x.shape[1]))], names=["y", *FEATURES]
            )

    # At most max_rows short rows: small enough to be sent to every task.
    rows = docs.select(key.alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = (
        rows.select("text", "y")
        .mapInArrow(run, ", ".join(f"{c} double" for c in ("y", *FEATURES)))
        .toPandas()
        .sort_values(["y", *FEATURES])  # the same model whatever the order of tasks
    )
    return fit(sample[list(FEATURES)].to_numpy(), sample["y"].to_numpy())


def score_column(spark, model: AdditiveModel, text: Column) -> Column:
    """The model's score of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        make_room()
        parts, start, held = [], 0, 0
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for row, length in enumerate(lengths):
            if held and held + length > SLICE_BYTES:
                parts.append(shared.value.score(features(texts.slice(start, row - start))))
                start, held = row, 0
            held += int(length)
        parts.append(shared.value.score(features(texts.slice(start))))
        return pa.array(np.concatenate(parts))

    return score(text)


def classified(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = trained(docs, labels, doc_id=doc_id, text=text)
    return (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .select(
            "doc_id",
            (fold(F.col("doc_id")) == HELD_OUT_REMAINDER).alias("held_out"),
            score_column(docs.sparkSession, model, F.col("text")).alias("score"),
        )
        .withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents scored at the threshold or above, with their own columns."""
    model = trained(docs, labels, doc_id=doc_id, text=text)
    scored = docs.select(
        F.struct("*").alias("row"), score_column(docs.sparkSession, model, F.col(text)).alias("score")
    )
    return scored.where(F.col("score") >= threshold).select("row.*")
