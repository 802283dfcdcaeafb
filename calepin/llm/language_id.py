"""Language identification: one frozen byte trie per language, least code length.

Counts of all labelled training texts make a trie per language; a text is
scored under each by prediction by partial matching and goes to the language
that codes it shortest (ties to the smaller name). The score is that language's
share of the likelihood. The order is what the caller says; the counts stay in a
stored table at any size. The costs of the most frequent grams under all
languages are sent to the tasks, ``sent_cells`` numbers at most; every other gram
is met by a join with its costs.

A text that is null or has no letter is ``und`` with score 0, as is every text
where nothing was learned; a null id belongs to fold 0; rows that repeat are
judged each on their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calepin.llm.code_lengths import KEY_TIMES, CodeLengths, SentCosts, most_frequent, sent_costs
from calepin.llm.common import SLICE_BYTES, filled, fold, shared_folder, stored, text_slices
from calepin.llm.ppm import Tally, text_grams, words_of
from calepin.llm.tables import sums

ORDER = 4
SENT_CELLS = 12_000_000
UNKNOWN = "und"
HELD_OUT_REMAINDER = 0


def language_counts(docs: DataFrame, order: int) -> DataFrame:
    """lang, key, n: grams of all texts of each language."""

    def rows(lang: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang]).take(pa.array(np.zeros(len(keys), np.int32))),
                pa.array(keys.view(np.int64)),
                pa.array(counts.astype(np.int64)),
            ],
            names=["lang", "key", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}
        for batch in text_slices(batches):
            coded = batch.column("lang").dictionary_encode()
            which = coded.indices.to_numpy()
            for k, lang in enumerate(coded.dictionary.to_pylist()):
                own = batch.column("text").take(pa.array(np.flatnonzero(which == k)))
                grams, _ = text_grams(*words_of(own), order)
                tally = tallies.setdefault(lang, Tally())
                tally.add(*np.unique(grams, return_counts=True))
                if tally.full():
                    yield rows(lang, *tally.drain())
        for lang, tally in tallies.items():
            yield rows(lang, *tally.drain())

    return (
        docs.where("text is not null and lang is not null")
        .select("text", "lang")
        .mapInArrow(run, "lang string, key bigint, n bigint")
        .groupBy("lang", "key")
        .agg(F.sum("n").alias("n"))
    )


_SENT: dict[str, SentCosts] = {}


def sent_of(name: str, shared) -> SentCosts:
    """The broadcast costs, built once a worker process."""
    if name not in _SENT:
        _SENT.clear()
        _SENT[name] = SentCosts(*shared.value)
    return _SENT[name]


def identified(
    docs: DataFrame,
    order: int = ORDER,
    sent_cells: int = SENT_CELLS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
        (fold(F.col(doc_id)) == HELD_OUT_REMAINDER).alias("held_out"),
    )
    learned = stored(language_counts(rows.where("not held_out"), order), folder, "counts")
    languages = sorted(r.lang for r in learned.select("lang").distinct().collect())
    models = max(len(languages), 1)
    named = spark.createDataFrame(list(enumerate(languages)), "model int, lang string")
    counts = learned.join(F.broadcast(named), "lang").select("model", "key", "n")
    lengths = CodeLengths(counts, order)
    grams = counts.groupBy("key").agg(F.sum("n").alias("n"))
    shared = spark.sparkContext.broadcast(
        sent_costs(lengths, most_frequent(grams, sent_cells // models), models)
    )
    name = uuid.uuid4().hex

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = sent_of(name, shared)
        # Each byte takes a number per language.
        for batch in text_slices(batches, most=SLICE_BYTES // models):
            texts = filled(batch.column("text"))
            letters = pc.match_substring_regex(texts, r"\p{L}")
            grams, ends = text_grams(*words_of(texts), order)
            costs, rare = sent.met(grams, ends)
            costs = sums(costs, ends)
            offsets = pa.array(np.arange(len(costs) + 1, dtype=np.int32) * models)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    letters,
                    pa.ListArray.from_arrays(offsets, pa.array(costs.ravel())),
                    rare,
                ],
                names=["doc_id", "held_out", "letters", "costs", "rare"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    known = rows.select("doc_id", "text", "held_out")
    if not languages:
        return known.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    texts = stored(
        known.mapInArrow(
            measured,
            f"doc_id {kind}, held_out boolean, letters boolean, costs array<double>, rare {KEY_TIMES}",
        ).withColumn("row", F.monotonically_increasing_id()),
        folder,
        "texts",
    )
    # Grams that were not sent, met with their costs, a sum per text and language.
    rare = texts.where("letters").select("row", F.explode("rare").alias("rare")).select("row", "rare.*")
    met = (
        rare.join(lengths.of(rare.select("key").distinct()), "key")
        .select("row", "times", F.posexplode("costs").alias("model", "cost"))
        .groupBy("row", "model")
        .agg(F.sum(F.col("times") * F.col("cost")).alias("cost"))
        .groupBy("row")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("model", "cost"))), lambda x: x["cost"]).alias("more"))
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*languages, UNKNOWN])
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            log_p = batch.column("costs").flatten().to_numpy().reshape(-1, models).copy()
            more = batch.column("more")
            has = np.flatnonzero(more.is_valid().to_numpy(zero_copy_only=False))
            log_p[has] += more.flatten().to_numpy().reshape(-1, models)
            best = log_p.argmax(axis=1)
            share = 1 / np.exp(log_p - log_p.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    names.take(pa.array(np.where(letters, best, models))),
                    pa.array(np.where(letters, share, 0.0)),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return (
        texts.drop("rare")
        .join(met, "row", "left")
        .select("doc_id", "held_out", "letters", "costs", "more")
        .mapInArrow(judged, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
    )
