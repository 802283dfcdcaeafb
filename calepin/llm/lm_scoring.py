"""Language-model scoring: prediction by partial matching under frozen counts.

Training counts cover every training document: grams of the byte trie and
tokens of the unigram base. They stay in a stored table at any size, and the
order is what the caller says. The costs of the ``frequent_grams`` most frequent
grams and the counts of the ``frequent`` most frequent tokens are sent to the
tasks; every other gram is met by a join with its cost, every other token by a
join on its hash with the stored counts.

Null text counts as empty: its end token alone. Rows that repeat are scored
each on their own, a null id belongs to fold 0, and where no document trains
every byte and token is as likely as any other. Tokens are known by 64-bit
hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calepin.llm.code_lengths import (
    KEY_TIMES,
    CodeLengths,
    SentCosts,
    listed,
    most_frequent,
    sent_costs,
)
from calepin.llm.common import fold, shared_folder, stored, text_slices
from calepin.llm.ppm import Tally, gram_mask, text_grams, words_of
from calepin.llm.tables import LongTable, sums

ORDER = 5
FREQUENT_GRAMS = 1 << 20
FREQUENT = 1 << 19
HELD_OUT_REMAINDER = 1


def hashes_of(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def training_counts(docs: DataFrame, order: int) -> DataFrame:
    """kind 'gram' or 'token' with key and count of all texts, and under kind
    'end' the number of texts."""

    def rows(kind: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([kind]).take(pa.array(np.zeros(len(keys), np.int32))),
                pa.array(keys.view(np.int64)),
                pa.array(counts.astype(np.int64)),
            ],
            names=["kind", "key", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, tokens, texts = Tally(), Tally(), 0
        for batch in text_slices(batches):
            words, offsets = words_of(batch.column("text"))
            grams.add(*np.unique(text_grams(words, offsets, order)[0], return_counts=True))
            coded = words.dictionary_encode()
            tokens.add(
                hashes_of(coded.dictionary.to_pylist()),
                np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)),
            )
            texts += batch.num_rows
            for kind, tally in (("gram", grams), ("token", tokens)):
                if tally.full():
                    yield rows(kind, *tally.drain())
        yield rows("gram", *grams.drain())
        yield rows("token", *tokens.drain())
        yield rows("end", np.zeros(1, np.uint64), np.array([texts]))

    return (
        docs.select("text")
        .mapInArrow(run, "kind string, key bigint, n bigint")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"))
    )


def fitting_grams(grams: DataFrame, order: int, max_grams: int) -> tuple[int, DataFrame]:
    """The longest order up to ``order`` of at most ``max_grams`` grams."""
    for k in range(order, 0, -1):
        cut = F.col("key").bitwiseAND(F.lit(int(gram_mask(k + 1))))
        counts = grams if k == order else grams.groupBy(cut.alias("key")).agg(F.sum("n").alias("n"))
        if k == 1 or counts.count() <= max_grams:
            return k, counts.select("key", "n")
    return 0, grams


class Model:
    """What a task needs: the costs of sent grams and the frequent tokens."""

    def __init__(self, grams, costs, tokens, token_counts):
        self.grams = SentCosts(grams, costs)
        self.tokens = LongTable(tokens)
        self.token_counts = np.append(token_counts, 0)


_MODEL: dict[str, Model] = {}


def model_of(name: str, shared) -> Model:
    """The broadcast model, built once a worker process."""
    if name not in _MODEL:
        _MODEL.clear()
        _MODEL[name] = Model(*shared.value)
    return _MODEL[name]


def columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.select(*names).toArrow()
    return [table[n].to_numpy() for n in names]


def scored(
    docs: DataFrame,
    order: int = ORDER,
    max_grams: int | None = None,
    frequent: int = FREQUENT,
    doc_id: str = "doc_id",
    text: str = "text",
    held_out: Column | None = None,
    frequent_grams: int = FREQUENT_GRAMS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``max_grams``, None unless the caller asks for a smaller model, lowers the
    order until so few distinct grams are left."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    split = fold(F.col(doc_id)) == HELD_OUT_REMAINDER if held_out is None else held_out
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), split.alias("held_out"))

    learned = stored(training_counts(rows.where("not held_out"), order), folder, "counts")
    tokens = learned.where("kind = 'token'").select("key", "n")
    size = learned.where("kind <> 'gram' and n > 0").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count("*").alias("distinct"),
        F.coalesce(F.sum(F.when(F.col("kind") == "end", F.col("n"))), F.lit(0)).alias("ends"),
    ).first()
    grams = learned.where("kind = 'gram'").select("key", "n")
    if max_grams is not None:
        order, grams = fitting_grams(grams, order, max_grams)
    lengths = CodeLengths(grams.select(F.lit(0).alias("model"), "key", "n"), order)
    keys, costs = sent_costs(lengths, most_frequent(grams, frequent_grams), 1)
    top, top_counts = columns(tokens.orderBy(F.desc("n"), "key").limit(frequent), "key", "n")
    base = size.total + 0.5 * (size.distinct + 1)
    shared = spark.sparkContext.broadcast(
        (keys, costs, top.view(np.uint64), top_counts)
    )
    name = uuid.uuid4().hex
    end_count = size.ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(name, shared)
        for batch in text_slices(batches):
            words, offsets = words_of(batch.column("text"))
            grams, ends = text_grams(words, offsets, order)
            costs, rare_grams = model.grams.met(grams, ends)
            coded = words.dictionary_encode()
            hashes = hashes_of(coded.dictionary.to_pylist())
            which = coded.indices.to_numpy()
            found = model.tokens.find(hashes)
            count = model.token_counts[found][which]
            sent = found[which] >= 0
            lengths = np.diff(offsets)
            parts = sums(np.where(sent, np.log10(count + 0.5), 0.0), offsets)
            # The others, each once a text with its number of occurrences.
            other = np.flatnonzero(~sent)
            row = np.repeat(np.arange(len(lengths)), lengths)[other]
            rare = listed(row, which[other], hashes, len(lengths))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(lengths + 1),
                    pa.array(sums(sent.astype(np.int64), offsets) + (end_count > 0)),
                    pa.array(parts + np.log10(end_count + 0.5)),
                    pa.array(sums(costs[:, 0], ends)),
                    rare,
                    rare_grams,
                ],
                names=["doc_id", "held_out", "n_tokens", "n_sent", "base_sent", "cost_sent", "rare", "rare_grams"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_sent bigint, base_sent double, "
        f"cost_sent double, rare {KEY_TIMES}, rare_grams {KEY_TIMES}"
    )
    scores = stored(
        rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), folder, "scores"
    )
    # Tokens that were not sent, met with their counts; unseen ones count 0.
    rare = scores.select("row", F.explode("rare").alias("rare")).select("row", "rare.*")
    looked_up = (
        rare.join(tokens, "key", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_rare"),
            F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("base_rare"),
        )
    )
    # Grams that were not sent, seen in training or not, met with their costs.
    rare_grams = scores.select("row", F.explode("rare_grams").alias("rare")).select("row", "rare.*")
    costs_met = (
        rare_grams.join(lengths.of(rare_grams.select("key").distinct()), "key")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("costs")[0]).alias("cost_rare"))
    )
    whole = scores.drop("rare", "rare_grams").join(looked_up, "row", "left").join(costs_met, "row", "left")
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_sent") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(size.total).cast("long").alias("train_tokens"),
        (
            F.col("base_sent")
            + F.coalesce("base_rare", F.lit(0.0))
            - F.col("n_tokens") * F.log10(F.lit(float(base)))
        ).alias("base_score"),
        ((F.col("cost_sent") + F.coalesce("cost_rare", F.lit(0.0))) / F.lit(float(np.log(10)))).alias("score"),
    )
