"""License scan: a positional index of rare licence words.

Licence templates are short passages known for each licence, with the phrases
that must stand in a text that carries it. Document frequencies of all their
words are counted over all documents; of each template the words of highest IDF
are indexed with their positions. In a text every place of an indexed word is
looked up, each posting says where the template would begin, and postings that
agree on that beginning, up to a few words put in or left out, are intersected:
their share of the template's indexed IDF must reach a threshold. A passage
found counts if all phrases that the template demands stand inside.

Words of a text are runs of letters, digits and characters beyond ASCII, A-Z in
lower case. Null text is empty. Long texts are worked through in overlapping
stretches, whole. Places of equal share agree on the label; the score is the
largest share of a passage that counts, 1 where a base phrase stands, else 0.
Templates are a parameter; so are thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calepin.llm.common import byte_table, text_slices, translated
from calepin.llm.ppm import words_of
from calepin.llm.tables import spans

NOT_WORD = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
TO_WORDS = byte_table({NOT_WORD: " "})


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    demanded: tuple[str, ...]  # phrases


# The base phrases of the contract, and passages and notices by
# which licences are known.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template("mit", "Released under the MIT License", ("under the mit license",)),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template(
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
        ("required by applicable law or agreed to in writing", "governing permissions and limitations"),
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "gpl",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license",),
    ),
    Template(
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation",
        ("gnu affero general public license",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
        ("redistribution and use in source and binary forms", "retain the above copyright notice"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at",
        ("mozilla public license",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
        ("unencumbered software released into the public domain",),
    ),
    Template(
        "boost",
        "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at",
        ("boost software license",),
    ),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        ("creative commons attribution noncommercial",),
    ),
    Template(
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work. CC0 1.0 Universal public domain dedication",
        ("waived all copyright and related or neighboring rights",),
    ),
)

# Words of highest IDF indexed of a template, words that may be put in or left
# out within a passage, and the share of the indexed IDF that must agree.
RARE_WORDS, SLACK, SHARE = 16, 8, 0.6
# Words of a stretch of text that is looked up at a time.
STRETCH = 200_000


def split_words(text: str) -> list[str]:
    return words_of(translated(pa.array([text]), TO_WORDS))[0].to_pylist()


class Vocabulary:
    """Numbers of all words of templates and base phrases."""

    def __init__(self, templates: tuple[Template, ...], base: dict[str, str]):
        texts = [t.text for t in templates] + [p for t in templates for p in t.demanded] + list(base)
        self.words = sorted({w for text in texts for w in split_words(text)})
        self.place = {w: k for k, w in enumerate(self.words)}

    def numbers(self, text: str) -> np.ndarray:
        return np.array([self.place[w] for w in split_words(text)], dtype=np.int64)

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, -1 for all others, and the texts' offsets."""
        words, offsets = words_of(translated(texts, TO_WORDS))
        known = words.dictionary_encode()
        numbers = pc.fill_null(pc.index_in(known.dictionary, value_set=pa.array(self.words)), -1).to_numpy()
        return numbers[known.indices.to_numpy()], offsets


def document_frequencies(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> tuple[int, np.ndarray]:
    """All documents, and those that hold each word of the vocabulary."""
    size = len(vocabulary.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, many = np.zeros(size, dtype=np.int64), 0
        for batch in text_slices(batches, "text"):
            codes, offsets = vocabulary.coded(batch.column("text"))
            at = np.flatnonzero(codes >= 0)
            row = np.searchsorted(offsets, at, side="right") - 1
            found += np.bincount(np.unique(row * size + codes[at]) % size, minlength=size)
            many += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, size)), pa.array(np.r_[many, found])], names=["word", "n"]
        )

    rows = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(run, "word bigint, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    out = np.zeros(size + 1, dtype=np.int64)
    out[rows["word"].to_numpy() + 1] = rows["n"].to_numpy()
    return int(out[0]), out[1:]


class Index:
    """Postings of each template's rarest words, and what templates demand."""

    def __init__(
        self,
        vocabulary: Vocabulary,
        total: int,
        frequencies: np.ndarray,
        templates: tuple[Template, ...],
        base: dict[str, str],
        rare_words: int = RARE_WORDS,
        slack: int = SLACK,
        share: float = SHARE,
    ):
        self.vocabulary, self.slack, self.share = vocabulary, slack, share
        self.labels = [t.label for t in templates]
        self.idf = np.log((total + 1) / (frequencies + 1)) + 0.01
        texts = [vocabulary.numbers(t.text) for t in templates]
        self.sizes = np.array([len(t) for t in texts])
        words, places, owners = [], [], []
        for k, own in enumerate(texts):
            distinct = np.unique(own)
            rare = distinct[np.argsort(-self.idf[distinct], kind="stable")][:rare_words]
            at = np.flatnonzero(np.isin(own, rare))
            words.append(own[at])
            places.append(at)
            owners.append(np.full(len(at), k))
        word, place, owner = map(np.concatenate, (words, places, owners))
        order = np.argsort(word, kind="stable")
        self.place, self.owner, self.word = place[order], owner[order], word[order]
        self.starts = np.searchsorted(self.word, np.arange(len(vocabulary.words) + 1))
        self.full = np.bincount(self.owner, weights=self.idf[self.word], minlength=len(texts))
        self.demanded = [[vocabulary.numbers(p) for p in t.demanded] for t in templates]
        self.base = [(vocabulary.numbers(p), label) for p, label in base.items()]
        self.longest = int(self.sizes.max()) + 2 * slack

    def passages(self, codes: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], float]:
        """(text, template) and the largest share of a passage that counts."""
        out: dict[tuple[int, int], float] = {}
        indexed = np.diff(self.starts) > 0
        hits = np.flatnonzero((codes >= 0) & indexed[codes])
        begin = 0
        while begin < len(hits):
            # A stretch, and as far as a passage begun in it may reach.
            end = np.searchsorted(hits, hits[begin] + STRETCH)
            reach = np.searchsorted(hits, hits[begin] + STRETCH + 2 * self.longest)
            self._look_up(codes, offsets, hits[begin:reach], out)
            begin = end
        return out

    def _look_up(self, codes: np.ndarray, offsets: np.ndarray, hits: np.ndarray, out: dict) -> None:
        word = codes[hits]
        sizes = np.diff(self.starts)[word]
        posting = spans(self.starts[word], sizes)
        at = np.repeat(hits, sizes)
        text = np.searchsorted(offsets, at, side="right") - 1
        begins = at - self.place[posting] + self.longest  # never negative
        weight = self.idf[self.word[posting]]
        owner = self.owner[posting]
        for turn in (0, self.slack // 2):
            # Postings of one text and template that agree on where it begins.
            group = (begins + turn) // self.slack
            order = np.lexsort((posting, group, owner, text))
            keys = np.stack([text[order], owner[order], group[order], posting[order]])
            new = np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]
            first = np.flatnonzero(np.r_[True, (keys[:3, 1:] != keys[:3, :-1]).any(axis=0)])
            if not len(first):
                return
            share = np.add.reduceat(np.where(new, weight[order], 0.0), first) / self.full[keys[1, first]]
            low, high = np.minimum.reduceat(at[order], first), np.maximum.reduceat(at[order], first)
            good = np.flatnonzero(share >= self.share)
            for k in np.unique(keys[1, first[good]]).tolist():
                own = good[keys[1, first[good]] == k]
                texts = keys[0, first[own]]
                counts = self._verified(codes, offsets, k, texts, low[own], high[own])
                for row, value in zip(texts[counts].tolist(), share[own[counts]].tolist()):
                    out[row, k] = max(out.get((row, k), 0.0), min(value, 1.0))

    def _verified(self, codes, offsets, template: int, texts, low, high) -> np.ndarray:
        """Whether all demanded phrases stand within the passage's text, about its place."""
        room = int(self.sizes[template]) + self.slack
        begin = np.maximum(high - room, offsets[texts])
        end = np.minimum(low + room, offsets[texts + 1])
        good = np.ones(len(texts), dtype=bool)
        for phrase in self.demanded[template]:
            places = standing(codes, phrase)
            k = np.searchsorted(places, begin)
            good &= (k < len(places)) & (places[np.minimum(k, len(places) - 1)] + len(phrase) <= end) if len(places) else False
        return good


def standing(codes: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of a phrase stand one after another."""
    at = np.flatnonzero(codes == phrase[0])
    for k in range(1, len(phrase)):
        at = at[at + k < len(codes)]
        at = at[codes[at + k] == phrase[k]]
    return at


def scanned(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    base: dict[str, str] = BASE,
    rare_words: int = RARE_WORDS,
    slack: int = SLACK,
    share: float = SHARE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    vocabulary = Vocabulary(templates, base)
    total, frequencies = document_frequencies(docs, vocabulary, text)
    sent = docs.sparkSession.sparkContext.broadcast(
        Index(vocabulary, total, frequencies, templates, base, rare_words, slack, share)
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in text_slices(batches):
            codes, offsets = index.vocabulary.coded(batch.column("text"))
            many = batch.num_rows
            n_base = np.zeros(many, dtype=np.int64)
            first, last = np.full(many, np.iinfo(np.int64).max), np.full(many, -1)
            base_labels: dict[int, set[str]] = {}
            for phrase, label in index.base:
                at = standing(codes, phrase)
                row = np.searchsorted(offsets, at, side="right") - 1
                inside = at + len(phrase) <= offsets[row + 1]  # not on into the next text
                at, row = at[inside], row[inside]
                n_base += np.bincount(row, minlength=many)
                np.minimum.at(first, row, at - offsets[row])
                np.maximum.at(last, row, at - offsets[row])
                for k in np.unique(row).tolist():
                    base_labels.setdefault(k, set()).add(label)
            labels = {k: set(v) for k, v in base_labels.items()}
            scores = np.where(n_base > 0, 1.0, 0.0)
            for (row, template), value in index.passages(codes, offsets).items():
                labels.setdefault(row, set()).add(index.labels[template])
                scores[row] = max(scores[row], value)
            none = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array(n_base),
                    pa.array(first, mask=none),
                    pa.array(last, mask=none),
                    *(pa.array([",".join(sorted(x.get(k, ()))) for k in range(many)]) for x in (base_labels, labels)),
                    pa.array(scores),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )
