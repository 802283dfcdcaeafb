import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from calepin.llm import quality_rules, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = list(zip(words, words[1:], words[2:]))
    times = collections.Counter(grams)
    covered = {k + d for k, g in enumerate(grams) if times[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def measures(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)


def test_measures_equal_brute_force(documents, odd):
    rng = random.Random(5)
    texts = odd + [
        (100 + k, "".join(rng.choice(["a", "b ", "cd ", "\n", "#", "e\t"]) for _ in range(rng.randint(0, 300))))
        for k in range(60)
    ]
    rows = quality_rules.judged(documents(texts)).select("row.doc_id", "row.text", "*").collect()
    assert len(rows) == len(texts)
    for row in rows:
        n, _, _, _, repeats = expected_measures(row.text)
        assert measures(row) == expected_measures(row.text)
        assert row.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (row.base_failed and row.kept)


CLEAN = "The river runs to the sea and the people of the town walk along it in the evening while "


def clean_text(k):
    rng = random.Random(k)
    return CLEAN + " ".join("".join(rng.choice("aeiourstln") for _ in range(5)) for _ in range(60)) + " the of and in"


@pytest.mark.parametrize(
    "text, rule",
    [
        (clean_text(1), None),
        (" ".join(w + "***" for w in clean_text(2).split()), "symbol_ratio"),
        (" ".join(w + "!!" for w in clean_text(3).split()), "shout_ratio"),
        (" ".join("qwert" + str(k) for k in range(80)), "stop_word_ratio"),
        ("the same\n" * 60, "repeat_share"),
        (" ".join(f"{k}abcdefghijklmnop" for k in range(60)) + " the of and in to is", "mean_word_length"),
    ],
)
def test_rules(documents, text, rule):
    row = quality_rules.judged(documents([(1, text)])).first()
    assert row.broken_rule == rule and row.kept == (rule is None)


def test_kept_rows_keep_their_columns(documents):
    docs = documents([(1, clean_text(1)), (2, "short"), (3, None)])
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
    assert quality_rules.keep_good(documents([])).count() == 0


def test_rules_stay_in_the_jvm(documents):
    plan = quality_rules.keep_good(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def check_shards(rows, given):
    assert sorted((r.text_crc32, r.size) for r in rows) == sorted(
        (zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for _, t in given
    )
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert 0 <= r.shard < 16 and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_shards_are_gapless_and_near_equal(documents, odd):
    rng = random.Random(7)
    given = odd + [(100 + k, "t" * rng.randint(0, 900) + str(k)) for k in range(3000)]
    rows = sharding.shards_of(documents(given)).collect()
    check_shards(rows, given)
    sizes = collections.Counter()
    for r in rows:
        sizes[r.shard] += r.size
    largest = max(r.size for r in rows)
    mean = sum(sizes.values()) / 16
    assert max(sizes.values()) - mean <= largest / 2 + 1000 and len(sizes) == 16


def test_a_large_group_of_copies_is_split(documents):
    given = [(k, "copy of one text") for k in range(2000)] + [(5000 + k, f"own {k}") for k in range(2000)]
    rows = sharding.shards_of(documents(given), ranges=64, sample=500).collect()
    check_shards(rows, given)
    sizes = collections.Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert max(sizes.values()) < 1.2 * sum(sizes.values()) / 16
    assert len({r.shard for r in rows if r.size == 17}) > 5


def test_shards_of_nothing(documents):
    assert sharding.shards_of(documents([])).count() == 0


def test_ranges_hold_what_is_between_their_bounds(spark):
    rows = spark.range(-50, 200).select(F.col("id").alias("major"), F.lit(0).cast("long").alias("minor"))
    for bounds in ([(0, 0), (5, 0)], [(k * 7, 0) for k in range(20)], [(k, 0) for k in range(100)]):
        found = {r.major: r.range for r in sharding.ranged(rows, bounds).collect()}
        for major, number in found.items():
            assert number == max(sum(major >= b for b, _ in bounds) - 1, 0)
