"""Licence scan, Merkle manifest and collocations against brute force and odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from calepin.llm import collocations, licenses, merkle
from calepin.llm.common import shared_folder

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# Licences


def plain_scan(text):
    words = WORD.findall(lowered(text))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        labels |= {label} if at else set()
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(labels)),
    )


def scan_rows(df):
    return {r.doc_id: r for r in licenses.scanned(df).collect()}


def test_licence_base_equals_plain_words(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = scan_rows(docs)
    for row in docs.collect():
        got = found[row.doc_id]
        assert got[1:6] == plain_scan(row.text)
        assert set(filter(None, got.base_labels.split(","))) <= set(got.labels.split(","))


BODY = licenses.TEMPLATES[0].text
FILLER = "ordinary words of some text that says nothing of the kind "


@pytest.mark.parametrize(
    "text, labels",
    [
        (BODY, "mit"),
        ("Copyright (c) 2020 Someone\n\n" + BODY.replace(" deal in ", " deal, freely, in "), "mit"),
        (FILLER * 30_000 + BODY + FILLER, "mit"),
        (BODY + FILLER * 3 + licenses.TEMPLATES[9].text, "bsd,mit"),
        (" ".join(reversed(BODY.split())), ""),
        (BODY.replace("without restriction", "with some restrictions"), ""),
        (" ".join(BODY.split()[:20]), ""),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("license licensed software permission " * 5_000, ""),
        ("mit " * 10 + "license", "mit"),
        (FILLER, ""),
    ],
)
def test_licence_passages(spark, documents, text, labels):
    # The rest of the corpus makes common words common.
    rows = [(k, FILLER + "under the of and to in") for k in range(1, 40)]
    assert scan_rows(documents([(0, text), *rows]))[0].labels == labels


def test_licence_index_equals_search_of_all_places(documents):
    """Shares by the index are those of a search that tries every beginning."""
    vocabulary = licenses.Vocabulary(licenses.TEMPLATES, licenses.BASE)
    frequencies = np.arange(len(vocabulary.words))[::-1].copy()
    index = licenses.Index(vocabulary, 1000, frequencies, licenses.TEMPLATES, licenses.BASE, slack=1)
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(60):
        words = licenses.TEMPLATES[int(rng.integers(len(licenses.TEMPLATES)))].text.split()
        words = [w if rng.random() > 0.15 else "other" for w in words]
        texts.append(" ".join(["before"] * int(rng.integers(5)) + words))
    codes, offsets = vocabulary.coded(pa.array(texts))
    found = index.passages(codes, offsets)
    for row in range(len(texts)):
        own = codes[offsets[row] : offsets[row + 1]]
        for k in range(len(licenses.TEMPLATES)):
            postings = [(p, w) for p, w, o in zip(index.place, index.word, index.owner) if o == k]
            best = 0.0
            for begin in range(-60, len(own)):
                hit = [(p, w) for p, w in postings if 0 <= begin + p < len(own) and own[begin + p] == w]
                share = sum(index.idf[w] for _, w in hit) / index.full[k]
                if hit and share >= index.share:
                    place = np.array([begin + p for p, _ in hit])
                    if index._verified(own, np.array([0, len(own)]), k, np.array([0]), place.min(keepdims=True), place.max(keepdims=True))[0]:
                        best = max(best, share)
            assert found.get((row, k), 0.0) == pytest.approx(min(best, 1.0))


def test_licence_odd_rows(spark, documents, odd):
    rows = licenses.scanned(documents(odd)).collect()
    assert len(rows) == len(odd) and all(r.labels == "" and 0 <= r.score <= 1 for r in rows)
    assert sorted(r.n_words for r in rows) == sorted(plain_scan(t)[0] for _, t in odd)
    assert licenses.scanned(documents([])).count() == 0


# Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    fields = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def plain_way(levels, place):
    out = []
    for level in levels[:-1]:
        begin = place // 8 * 8
        out.append(("".join(level[begin:place]), "".join(level[place + 1 : begin + 8])))
        place //= 8
    return out


def plain_audit(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row.lang, []).append((row.doc_id is not None, row.doc_id or 0, plain_leaf(row, row.text), row))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        trees[name].sort(key=lambda x: x[:3])
    levels = {name: plain_tree([x[2] for x in trees[name]]) for name in names}
    top = plain_tree([levels[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for place, (*_, leaf, row) in enumerate(trees[name]):
            way = plain_way(levels[name], place) + plain_way(top, k)
            end = leaf
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                end = plain_leaf(row, None if row.text is None else lowered(row.text))
            for before, after in way:
                end = h(before + end + after)
            root = top[-1][0]
            out.append((row.doc_id, leaf, levels[name][-1][0], root, h("".join(b + a for b, a in way)), end, end == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("many, langs", [(1, 1), (9, 1), (700, 1), (5_000, 3), (60, 30)])
def test_manifest_equals_plain_trees(spark, many, langs):
    names = [None, *(f"l{k}" for k in range(langs - 1))]
    # One language holds most rows; one id in ten is there twice, one is null.
    rows = [
        (i - (i % 10 == 1) if i != 5 else None, None if i % 7 == 3 else f"Text {i % 50} of Some", names[0] if i % 3 else names[i % langs], "s", i)
        for i in range(many)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((tuple(r) for r in merkle.audited(docs).collect()), key=repr) == plain_audit(docs.collect())


def test_missing_is_the_least_union():
    """Every proof can be derived, and no coordinate can be left out."""
    rng = np.random.default_rng(5)
    for count in (1, 2, 8, 9, 64, 65, 600):
        levels = plain_tree([h(str(k)) for k in range(count)])
        held = np.unique(rng.integers(0, count, size=int(rng.integers(1, 6))))
        fetched = merkle.missing(held, count)
        needed = set()
        for place in held.tolist():
            for level in range(len(levels) - 1):
                run = range(place // 8 * 8, min(place // 8 * 8 + 8, len(levels[level])))
                needed |= {(level, i) for i in run}
                place //= 8
        derived = {(level, i) for level in range(len(levels)) for i in np.unique(held // 8**level).tolist()}
        assert sorted(fetched) == sorted(needed - derived)


def test_block_proofs_of_a_part_of_a_tree():
    leaves = [h(str(k)) for k in range(700)]
    levels = plain_tree(leaves)
    others = {(level, i): levels[level][i] for level, i in merkle.missing(np.arange(512, 700), 700)}
    block = merkle.Block(leaves[512:], 512, 700, others)
    assert block.root == levels[-1][0]
    proofs = block.siblings("above")
    for k in range(188):
        way = plain_way(levels, 512 + k)
        assert block.path(k) == way and proofs[k] == "".join(b + a for b, a in way) + "above"


def test_manifest_odd_rows(spark, documents, odd):
    docs = documents(odd)
    assert sorted((tuple(r) for r in merkle.audited(docs).collect()), key=repr) == plain_audit(docs.collect())
    assert merkle.audited(documents([])).count() == 0
    roots = merkle.manifest(docs, fields=("doc_id", "source", "lang", "n_chars", "text")).collect()
    assert [(r.lang, r.subroot, r.root) for r in roots] == [("en", *plain_audit(docs.collect())[0][2:4])]


# Collocations


def plain_collocations(rows, least=10, top=2000):
    counts, sizes = {}, {}
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] = sizes.get(lang, 0) + len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    key = lang, tuple(words[i : i + k])
                    counts[key] = counts.get(key, 0) + 1
    found = {}
    for (lang, words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        cut = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cut.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cut)
        inside = any(
            len(w) == 3 and g == lang and words in (w[:2], w[1:]) and f >= least and 100 * f >= 50 * a
            for (g, w), f in counts.items()
        ) if len(words) == 2 else False
        if not inside:
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank + 1, phrase.decode(), -a, left, right, sizes[lang], -score)
        for lang, own in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top])
    )


def phrase_table(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def made_texts(seed=1, many=120):
    rng = np.random.default_rng(seed)
    words = [*"abcdefgh", "New", "york", "é", "I.B.M", "\x00odd"]
    return [
        (["en", "fr", None, "und"][int(rng.integers(4))], " ".join(rng.choice(words, 40)) + ", new york City! new york city")
        for _ in range(many)
    ]


def test_collocations_equal_plain_counts(spark):
    rows = made_texts() + [(None, None), ("en", ""), ("xx", " \t\n"), ("en", "a " * 30_000)]
    got = collocations.mined(phrase_table(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows)


@pytest.mark.parametrize("most, range_arcs", [(60, 20), (20, 1 << 18)])
def test_collocations_handed_on_in_parts(spark, most, range_arcs):
    """Small bounds: many transducers, ranges, and sums handed on before the end."""
    rows = made_texts(2)
    docs = phrase_table(spark, rows).repartition(5)
    got = collocations.mined(docs, most=most, sample_every=1, range_arcs=range_arcs)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows)


def test_collocations_of_two_words_and_few(spark):
    rows = made_texts(3)
    got = collocations.mined(phrase_table(spark, rows), longest=2, top=3)
    assert got.count() == 9 and all(len(r.phrase.split(" ")) == 2 for r in got.collect())


def test_collocations_without_any(spark, documents, odd):
    assert collocations.mined(documents([])).count() == 0
    assert [tuple(r) for r in collocations.mined(documents(odd)).collect()] == plain_collocations(
        [("en", t) for _, t in odd]
    )


def test_splitters_and_cuts_keep_order(spark):
    symbols = sorted([("de", "a"), ("de", "b"), ("en", "a"), ("en", "c")])
    bounds = [("de", "b", "a"), ("en", "a", "b"), ("en", "b", "x"), ("fr", "a", "a")]
    at = collocations.cuts(symbols, 2, bounds).tolist()
    assert at == sorted(at)
    key = lambda *own: sum(symbols.index(w) << 21 * (1 - k) for k, w in enumerate(own))
    assert at[0] == (1 << 21 | 0) and key(("en", "a"), ("en", "a")) < at[1] <= key(("en", "a"), ("en", "c"))


def test_transducers_union_and_registers():
    words = ["a", "b", "c"]
    phrases = np.array([(x, y, z) for x in range(3) for y in range(3) for z in range(3)])
    one = collocations.CountTransducer.built(words, phrases, np.ones(27, np.int64))
    # All states of a level are equal: one is kept.
    assert [len(labels) for _, labels, _ in one.levels] == [3, 3, 3]
    two = collocations.CountTransducer.built(["b", "d"], np.array([(0, 0, 0), (0, 0, 1)]), np.array([5, 7]))
    both = collocations.union([one, two])
    got, weights = both.phrases()
    counts = {tuple(both.words[k] for k in row): w for row, w in zip(got.tolist(), weights.tolist())}
    assert counts["b", "b", "b"] == 6 and counts["b", "b", "d"] == 7 and len(counts) == 28
    assert sorted(counts) == [tuple(both.words[k] for k in row) for row in got.tolist()]


def test_shared_folder_is_used(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
