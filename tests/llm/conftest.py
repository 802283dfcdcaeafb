"""Helpers of the document operators' tests."""

import pytest
from pyspark.sql import functions as F

from calepin.llm.common import ship

# Names that operators use inside: extra columns may have them too.
CLASHES = ("row", "n", "key", "kind", "words", "size", "score", "kept", "node", "shard", "component_id", "length")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) pairs, with extra columns."""

    def make(rows, clashes=True):
        df = spark.createDataFrame(
            [(i, t, "en", "s", len(t) if t else None) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars int",
        )
        return df.withColumns({c: F.lit("extra") for c in CLASHES}) if clashes else df

    return make


@pytest.fixture(scope="session")
def by_id():
    def collect(df):
        return {row["doc_id"]: row for row in df.collect()}

    return collect


ODD = [
    (0, None),
    (1, ""),
    (2, "  \n\t "),
    (3, "one"),
    (4, "x" * 30_000),
    (5, "word " * 20_000),
    (6, "Ünïcode ▁ text 🦙 é́ with\x0bgaps"),
    (7, "same words here for both of them"),
    (7, "same words here for both of them"),
    (None, "no id has this text of some words"),
    (8, "!!!! #### ||| ***"),
]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
