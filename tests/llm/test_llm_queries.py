"""Registered queries against SQL or brute force, and the pipeline's stages."""

import itertools
import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from calepin.llm import quality_classifier, quality_rules
from calepin.llm.queries import ORACLES, QUERIES
from checks.compare import mismatch, oracle_connection
from test_rules_and_shards import WORD, expected_measures
from test_tokens import check_packing

SF_DIR = "/root/testdata/sf0.001"



@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert mismatch(spark, oracle_connection(SF_DIR), SF_DIR, name) is None


def test_all_operators_are_registered():
    names = contract.queries()
    assert [n for n in range(1, 14) if not any(re.match(rf"op{n}_", q) for q in names)] == []
    assert "pipeline" in names and set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", [n for n in QUERIES if not re.match("op4_|op13_", n)])
def test_every_document_has_its_result(spark, name):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    result = QUERIES[name](spark, SF_DIR)
    assert result.select("doc_id").distinct().count() == documents.select("doc_id").distinct().count()


def plain_kept(text):
    """The quality rules' verdict, in plain words."""
    n, word_chars, n_symbols, n_dup_lines, n_repeat = expected_measures(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    stops = set(quality_rules.stop_forms())
    return (
        n >= 50
        and n_repeat <= 0.5 * n
        and 3 * n <= word_chars <= 10 * n
        and n_symbols <= 0.1 * n
        and text.count("!") <= 0.3 * n
        and sum(w in stops for w in WORD.findall(text)) >= 0.05 * n
        and n_dup_lines <= 0.5 * max(len(lines), 1)
    )


def plain_leaders(docs):
    """The smallest id of each group of near duplicates, from all pairs."""
    sets, group = {}, {}
    for i, text in docs.items():
        words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
        group[i] = i
    for i, j in itertools.combinations(sorted(sets), 2):
        shared = len(sets[i] & sets[j])
        if sets[i] and 100 * shared >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
            low, high = sorted((group[i], group[j]))
            group = {k: low if g == high else g for k, g in group.items()}
    return sorted(set(group.values()))


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}"""
BASE_SECRETS = re.compile(rf"{ASSIGN}|AKIA[A-Z0-9]{{16,}}|[0-9a-f]{{24,}}")


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Every stage of run()'s functions against plain Python on its own input."""
    folder = str(tmp_path / "in")
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [r.asDict() for r in given.collect()]
    # Near and exact copies, planted secrets, and what the rules reject.
    longest = sorted((r for r in rows if plain_kept(r["text"] or "")), key=lambda r: (len(r["text"]), r["doc_id"]))[-12:]
    words = "river house garden window table mountain letter morning people water".split()
    for k, r in enumerate(longest):
        body = r["text"]
        rows.append({**r, "doc_id": 10_000 + k, "text": body})
        rows.append({**r, "doc_id": 11_000 + k, "text": body + " " + words[k % 10]})
        rows.append({**r, "doc_id": 12_000 + k, "text": body + f"\npassword = \"hunter{k}2secret\" and AKIA{'ABCDEFGH' * 2}{k}"})
    rows.append({**longest[0], "doc_id": 13_000, "text": "too short"})
    docs = spark.createDataFrame(rows, given.schema).coalesce(2)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")

    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        kept.append((docs, after))
        docs = after
    assert all(after.columns == given.columns for _, after in kept[:-1])
    tables = [({r.doc_id: r for r in before.collect()}, after.collect()) for before, after in kept]

    before, after = tables[0]
    assert sorted(r.doc_id for r in after) == sorted(i for i, r in before.items() if plain_kept(r.text or ""))
    assert all(before[r.doc_id] == r for r in after)

    before, after = tables[1]
    scores = quality_classifier.classified(kept[1][0], labels).collect()
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in scores if r.score >= 0.3)
    assert all(before[r.doc_id] == r for r in after)

    before, after = tables[2]
    assert sorted(r.doc_id for r in after) == plain_leaders({i: r.text or "" for i, r in before.items()})
    assert len(after) < len(before) and all(before[r.doc_id] == r for r in after)

    before, after = tables[3]
    assert sorted(r.doc_id for r in after) == sorted(before)
    for r in after:
        own = before[r.doc_id]
        assert not BASE_SECRETS.search(r.text) and r.n_chars == len(r.text)
        assert (r.doc_id, r.source, r.lang) == (own.doc_id, own.source, own.lang)
        # Only what stood for a secret is gone.
        parts = [re.escape(p) for p in r.text.split("[secret]")]
        assert re.fullmatch("(?s:.+?)".join(parts), own.text)
        assert BASE_SECRETS.search(own.text) is None or "[secret]" in r.text

    before, after = tables[4]
    check_packing(after, [(i, r.text) for i, r in before.items()], 4096)
    used = len({r.sequence_id for r in after})
    assert used <= 1.1 * sum(r.length for r in after) / 4096 + 2


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("k", range(5))
def test_stages_of_empty_tables(spark, documents, k):
    empty = documents([], clashes=False)
    result = corpus_pipeline.STAGES[k][1](spark, empty, SF_DIR)
    assert result.count() == 0
    assert k == 4 or result.columns == empty.columns


@pytest.mark.parametrize("k", range(5))
def test_stages_of_odd_rows(spark, documents, odd, k):
    docs = documents(odd)
    result = corpus_pipeline.STAGES[k][1](spark, docs, SF_DIR)
    assert k == 4 or result.columns == docs.columns
    result.collect()
