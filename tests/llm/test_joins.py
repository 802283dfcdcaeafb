import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from calepin.llm import graph_search, ngram_join
from calepin.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else frozenset()


def groups(given):
    """Component of each id and size of each set, by all pairs."""
    sets = {i: shingles(t) for i, t in given if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, base, count, first, edits):
    out = []
    for k in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append((first + k, " ".join(words)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(40))
    given, first = [], 100
    for size in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 45, 80, 200, 500):
        for _ in range(3):
            base = [word() for _ in range(size)]
            given += near_copies(rng, base, 6, first, max(1, size // 20))
            first += 6
    passage = " ".join(word() for _ in range(40))
    given += [(first + k, f"{passage} " + " ".join(word() for _ in range(10 + k))) for k in range(25)]
    return given


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_all_pairs(documents, seed):
    given = corpus(seed)
    rows = ngram_join.joined(documents(given)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == groups(given)


def test_parts_follow_the_size_of_the_texts(documents, monkeypatch):
    """More parts than tasks change no result, and facts of documents are
    spread over parts however few slices a task has."""
    given = corpus(3)
    docs = documents(given).repartition(16)
    monkeypatch.setattr(ngram_join, "PART_BYTES", 1000)
    rows = ngram_join.joined(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == groups(given)
    dealt = ngram_join.emitted(docs, ngram_join.SHINGLE, 64).where(f"kind = {ngram_join.DOCUMENT}")
    assert dealt.select("part").distinct().count() > 12
    signatures = ngram_join.emitted(docs, ngram_join.SHINGLE, 64).where(f"kind = {ngram_join.SIGNATURE}")
    assert signatures.where("size(keys) = 0").count() == 0


def test_much_used_shingles_of_all_texts(documents, monkeypatch):
    """Counted over all texts, copies once, whatever a task holds at a time."""
    line = "this line stands in many of the texts"
    texts = [f"{line} number {k} of its own words {k}" for k in range(30)]
    copies = ["copies of one text count once for all of them"] * 40
    docs = documents(list(enumerate(texts + copies + ["", None]))).coalesce(1).select("doc_id", "text")
    used = set(ngram_join.much_used_shingles(docs, 5).tolist())
    given = [ngram_join.shingle_sets(pa.array([t])).hashes.tolist() for t in (line, copies[0])]
    assert set(given[0]) <= used and not set(given[1]) & used
    monkeypatch.setattr(ngram_join, "HELD_SHINGLES", 100)
    assert set(given[0]) <= set(ngram_join.much_used_shingles(docs, 5).tolist())
    assert not len(ngram_join.much_used_shingles(docs.limit(0), 5))


def test_words_and_shingles_of_whole_columns():
    """Words are hashed all at once, and texts measured as shingles are counted."""
    rng = random.Random(8)
    words = {"".join(rng.choice("ab\0é") for _ in range(n)) for n in (1, 7, 8, 9, 16, 17, 63, 64, 65, 200) for _ in range(30)}
    words = pa.array(sorted(words))
    hashes = ngram_join.word_hashes(words)
    assert len(set(hashes.tolist())) == len(words)
    assert (ngram_join.word_hashes(words.slice(5, 40)) == hashes[5:45]).all()
    assert not len(ngram_join.word_hashes(pa.array([], pa.string())))
    texts = [None, "", " \n"] + [" ".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(60)]
    sets = ngram_join.shingle_sets(pa.array(texts).slice(1))
    given = [set(sets.hashes[a:b].tolist()) for a, b in itertools.pairwise(sets.offsets)]
    plain = [shingles(t) for t in texts[1:]]
    assert sets.sizes.tolist() == [len(x) for x in plain]
    assert all(len(a & b) == len(x & y) for a, x in zip(given, plain) for b, y in zip(given, plain))


def test_bytes_of_all_texts(documents):
    docs = documents([(1, "é one two"), (2, None), (3, ""), (4, "é one two"), (None, "x")])
    assert ngram_join.usage(docs, 5)[1] == 10 + 10 + 1
    assert ngram_join.usage(docs.limit(0), 5)[1] == 0


def test_large_group_of_near_copies(documents, monkeypatch):
    """Centres first: no group is expanded into pairs while rounds are left."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    given = near_copies(rng, base, 150, 10, 3) + corpus(5)[:120]
    given = [(k, t) for k, (_, t) in enumerate(given)]
    monkeypatch.setattr(ngram_join, "PAIRS_A_MEMBER", 0)
    rows = ngram_join.joined(documents(given)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == groups(given)


def test_odd_rows_of_the_join(documents, odd):
    rows = ngram_join.joined(documents(odd)).collect()
    assert len(rows) == len(odd)
    found = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)
    expected = collections.Counter(
        (i, *groups(odd)[i]) if i is not None else (None, len(shingles(t)), None) for i, t in odd
    )
    assert found == expected
    assert ngram_join.joined(documents([])).count() == 0


def test_one_of_each_group_stays(documents, odd):
    docs = documents(odd + [(20, "same words here for both of them"), (21, "another text of its own words")])
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 21] and ids.count(None) == 1


def test_signatures_of_all_similar_sets_meet():
    """Sets at the very bound of similarity share a signature, for any sizes."""
    rng = np.random.default_rng(6)
    for size in [*range(3, 60), 90, 150, 333, 700]:
        for _ in range(6):
            small = int(rng.integers(ngram_join.need(size), size + 1))
            both = -(-(small + size) * 80 // 180)
            if both > small:
                continue
            pool = np.unique(rng.integers(0, 2**63, small + size).astype(np.uint64))
            rng.shuffle(pool)
            a, b = pool[:small], np.r_[pool[:both], pool[small : small + size - both]]
            a, b = np.sort(a), np.sort(b)
            sets = ngram_join.Sets(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]))
            if 100 * both < 80 * (len(a) + len(b) - both) or (both == len(a) == len(b)):
                continue
            for used in (pool[:0], pool[: size // 8], pool[: small // 2 + 1], pool):
                row, signature = ngram_join.signatures(sets, np.arange(2), ngram_join.LongTable(used))
                assert set(signature[row == 0]) & set(signature[row == 1]), (small, size, len(used))


def test_components_of_chains_and_stars(spark, tmp_path):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(200, 260)] + [(500, 500 + k) for k in range(1, 40)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(edges)
    found = dict(
        (r.node, r.component)
        for r in components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "c"), "x").collect()
    )
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: find(x) for x in linked}


# Graph search


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")


def brute_nearest(rows, nearest=20):
    good = {
        i: np.array(v, dtype=np.float32).astype(float)
        for i, v, *_ in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    }
    out = {}
    for q, x in good.items():
        if q % 20 == 0:
            ranked = sorted((-float((x * y).sum()), i) for i, y in good.items() if i != q)
            out[q] = [(i, -s) for s, i in ranked[:nearest]]
    return out


def answers(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_small_and_odd_tables_of_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=6).tolist(), 0, "x") for k in range(41)]
    rows += [(60, rows[0][1], 0, "x"), (61, rows[0][1], 0, "x"), (80, None, 0, "x"), (100, [0.0] * 6, 0, "x")]
    rows += [(120, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, "x"), (140, [float("nan")] * 6, 0, "x"), (None, [1.0] * 6, 0, "x")]
    rows += [(160, [float("inf")] * 6, 0, "x")]
    found, expected = answers(graph_search.neighbours(vectors(spark, rows))), brute_nearest(rows)
    assert set(found) == set(expected) == {0, 20, 40, 60}
    for q in expected:
        assert [i for i, _ in found[q]] == [i for i, _ in expected[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in expected[q]])
    assert graph_search.neighbours(vectors(spark, [])).count() == 0
    few = answers(graph_search.neighbours(vectors(spark, rows[:5])))
    assert len(few[0]) == 4


def test_ties_go_to_smaller_ids(spark):
    rng = np.random.default_rng(2)
    copy = rng.normal(size=4).tolist()
    rows = [(k, copy, 0, "x") for k in range(100)] + [(200 + k, rng.normal(size=4).tolist(), 0, "x") for k in range(5)]
    found = answers(graph_search.neighbours(vectors(spark, rows)))
    assert [i for i, _ in found[0]] == list(range(1, 21))
    assert [i for i, _ in found[40]] == list(range(20))


def test_ties_of_different_vectors(spark):
    """More of one score than are kept: the smallest ids of all of them count."""
    rows = [(k, [1.0, (k * 37 % 120) / 16], 0, "x") for k in range(1, 121)] + [(200, [2.0, 0.0], 0, "x")]
    found = answers(graph_search.neighbours(vectors(spark, rows)))
    assert found[200] == [(k, 2.0) for k in range(1, 21)]


def test_shards_are_tasks_of_their_own(spark, tmp_path, monkeypatch):
    """A shard is small to read, and still not joined with others in a task."""
    monkeypatch.setattr(graph_search, "shared_folder", lambda spark: str(tmp_path))
    points = np.random.default_rng(6).normal(size=(400, 8))
    rows = [(k, v.tolist(), 0, "x") for k, v in enumerate(points)]
    assert graph_search.neighbours(vectors(spark, rows), shard_size=50).count() == 400
    per_file = spark.read.parquet(f"{tmp_path}/graphs").groupBy("_metadata.file_path").count().collect()
    assert sum(r["count"] for r in per_file) == 8 and len(per_file) >= 5


def test_recall_over_shards(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(1500, 24))
    rows = [(k, v.tolist(), 0, "x") for k, v in enumerate(points)]
    found = answers(graph_search.neighbours(vectors(spark, rows), shard_size=500))
    expected = brute_nearest(rows)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.95 * 20 * len(expected)


@pytest.mark.parametrize("lengths", ["equal", "uniform", "logarithmic"])
def test_recall_of_a_full_shard(lengths):
    """The registered parameters, on as many vectors as a shard holds."""
    rng = np.random.default_rng(11)
    points = rng.normal(size=(graph_search.SHARD_SIZE, 64))
    if lengths != "equal":
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        low_high = (0.1, 10) if lengths == "uniform" else (-1, 1)
        factor = rng.uniform(*low_high, (len(points), 1))
        points *= factor if lengths == "uniform" else 10**factor
    asked = np.arange(0, len(points), 20)
    products = points[asked] @ points.T
    products[np.arange(len(asked)), asked] = -np.inf
    expected = np.argsort(-products, axis=1)[:, : graph_search.NEAREST]
    kept = graph_search.NEAREST + 1
    found, _ = graph_search.Shard(points).nearest(points[asked], graph_search.SEARCH_BEAM, kept)
    hits = 0
    for q, own, wanted in zip(asked, found, expected):
        own = own[own != q][: graph_search.NEAREST]
        hits += len(set(own.tolist()) & set(wanted.tolist()))
    assert hits >= 0.9 * expected.size


def test_bands_left_out_hold_no_answer():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(600, 8)) * np.repeat([9.0, 3.0, 1.0], 200)[:, None]
    queries = points[::7]
    found, scores = graph_search.Shard(points, ratio=1.1).nearest(queries, 600, 21)
    expected = -np.sort(-(queries @ points.T), axis=1)[:, :21]
    assert np.allclose(scores[:, :21], expected) and (found[:, :21] >= 0).all()
