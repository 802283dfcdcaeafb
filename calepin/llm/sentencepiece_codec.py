"""SentencePiece BPE, encoded and decoded by vectorised merge rounds.

A text gets a leading space mark, spaces become marks, and it is cut where a
mark follows another character: no piece of a vocabulary trained with
split_by_whitespace crosses that place, so the parts merge independently and
equal parts of a slice are merged once. In a round every part finds its lowest
pair rank, merges the leftmost non-overlapping pairs of that rank and closes
the gaps, until no part has a pair left. A merged piece that could open a pair
of lower rank than its own is merged one at a time, as the agenda of the
library would. A part of over LONG_PART characters takes its pairs from a heap
instead of rounds. Characters without a piece become byte pieces.

Null counts as empty; an empty text has no ids. Texts of any length are whole:
a part without spaces is merged in full.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calepin.llm.common import KEPT, filled, text_slices
from calepin.llm.tables import LongTable, Memo, spans, sums

MARK = "▁"
NONE = np.int32(2**31 - 1)
# Symbols that are no piece: code points from here on.
BARE = 1 << 24
# Parts of more characters are merged from a heap, with the same result.
LONG_PART = 1000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces, scores, byte pieces and the unknown id of a model file."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]
    unknown: int
    unknown_text: str


def read_vocabulary(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids]
    special = [
        model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids
    ]
    return Vocabulary(
        pieces,
        [model.get_score(i) for i in ids],
        [not s for s in special],
        [pieces.index(f"<0x{b:02X}>") for b in range(256)],
        model.unk_id(),
        model.decode([model.unk_id()]),
    )


class Codec:
    """Encoder and decoder of one vocabulary over Arrow arrays."""

    def __init__(self, vocabulary: Vocabulary):
        pieces = vocabulary.pieces
        self.ids = {p: i for i, p in enumerate(pieces) if vocabulary.normal[i]}
        by_score = sorted(self.ids.values(), key=lambda i: (-vocabulary.scores[i], i))
        self.piece_of_rank = np.array(by_score, dtype=np.int64)
        rank = {i: r for r, i in enumerate(by_score)}
        self.char_symbol = np.arange(0x110000, dtype=np.int64) + BARE
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_symbol[ord(piece)] = i

        def symbol(text: str) -> int | None:
            if len(text) == 1:
                return int(self.char_symbol[ord(text)])
            return self.ids.get(text)

        pairs: dict[int, int] = {}
        careful = np.zeros(len(by_score), dtype=bool)
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank[i]
                    for part, text in ((left, piece[:cut]), (right, piece[cut:])):
                        if len(text) > 1 and rank[part] > rank[i]:
                            careful[rank[part]] = True
        self.pairs = LongTable(np.fromiter(pairs, np.uint64, len(pairs)))
        self.pair_rank = np.append(np.fromiter(pairs.values(), np.int32, len(pairs)), NONE)
        self.careful = np.append(careful, False)
        self.byte_ids = np.array(vocabulary.byte_ids, dtype=np.int64)
        self.newline_alone = not any("\n" in p for p in self.ids)

        texts = [p.replace(MARK, " ").encode() if vocabulary.normal[i] else b"" for i, p in enumerate(pieces)]
        for byte, i in enumerate(vocabulary.byte_ids):
            texts[i] = bytes([byte])
        texts[vocabulary.unknown] = vocabulary.unknown_text.encode()
        self.piece_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.piece_lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.piece_starts = np.cumsum(self.piece_lengths) - self.piece_lengths
        self.memo = Memo(self.merge)
        self.id_texts = pa.array([str(i) for i in range(len(pieces))])

    # Encoding

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All parts of the texts, and where each text's parts begin."""
        marked = pc.replace_substring(texts, " ", MARK)
        marked = pc.binary_join_element_wise(MARK, marked, "")
        marked = pc.if_else(pc.equal(texts, ""), "", marked)
        marked = marked.combine_chunks() if isinstance(marked, pa.ChunkedArray) else marked
        bounds = np.frombuffer(marked.buffers()[1], np.int32)[marked.offset : marked.offset + len(marked) + 1]
        data = np.frombuffer(marked.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        begins = np.zeros(len(data) + 1, dtype=bool)
        if len(data) >= 3:
            mark = np.zeros(len(data), dtype=bool)
            mark[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
            begins[:-1] = mark
            begins[3:-1] &= ~mark[:-3]
        if self.newline_alone:
            newline = data == 10
            begins[:-1] |= newline
            begins[1:] |= newline
        begins[bounds] = True
        begins[len(data)] = True
        edges = np.flatnonzero(begins).astype(np.int32)
        parts = pa.StringArray.from_buffers(
            max(len(edges) - 1, 0), pa.py_buffer(edges), pa.py_buffer(data)
        )
        return parts, np.searchsorted(edges, bounds)

    def merge(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each distinct part, one after another, and their offsets."""
        count = len(parts)
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, parts), np.int64, count)
        symbols = self.char_symbol[points]
        part = np.repeat(np.arange(count, dtype=np.int32), lengths)
        ranks = self._ranks(symbols, part, np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if len(lengths) and lengths.max() > LONG_PART:
            edges = np.r_[0, np.cumsum(lengths)]
            for k in np.flatnonzero(lengths > LONG_PART):
                own = np.array(self.agenda(symbols[edges[k] : edges[k + 1]].tolist()), dtype=np.int64)
                done.append((own, np.full(len(own), k, dtype=np.int32)))
            short = np.repeat(lengths <= LONG_PART, lengths)
            symbols, part, ranks = symbols[short], part[short], ranks[short]
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            lowest = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            least = np.repeat(lowest, sizes)
            open_ = least != NONE
            if not open_.all():
                done.append((symbols[~open_], part[~open_]))
                symbols, part, ranks, least = symbols[open_], part[open_], ranks[open_], least[open_]
                if not len(symbols):
                    break
            wanted = ranks == least
            # Every second one of a run of neighbours overlaps the one before.
            first = wanted & ~np.r_[False, wanted[:-1]]
            at = np.arange(len(wanted))
            run = np.maximum.accumulate(np.where(first, at, 0))
            wanted &= (at - run) % 2 == 0
            slow = wanted & self.careful[np.where(wanted, ranks, -1)]
            if slow.any():
                places = np.flatnonzero(slow)
                again = np.r_[False, part[places][1:] == part[places][:-1]]
                wanted[places[again]] = False
            merged = np.flatnonzero(wanted)
            symbols[merged] = self.piece_of_rank[ranks[merged]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[merged + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, part, ranks = symbols[keep], part[keep], ranks[keep]
            touched = moved[merged]
            before = touched[touched > 0] - 1
            for places in (touched, before):
                ranks[places] = self._ranks(symbols, part, places)
        return self._with_bytes(done, count)

    def agenda(self, symbols: list[int]) -> list[int]:
        """The merges of one long part from a heap of its pairs: rounds over a
        part without spaces would cost the square of its length."""
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(places: list[int]) -> None:
            places = [i for i in places if i >= 0 and after[i] < len(symbols)]
            keys = [symbols[i] << 32 | symbols[after[i]] for i in places]
            ranks = self.pair_rank[self.pairs.find(np.array(keys, dtype=np.uint64))].tolist() if keys else []
            for i, rank in zip(places, ranks):
                if rank != NONE:
                    heapq.heappush(heap, (rank, i, symbols[i], symbols[after[i]]))

        offer(list(range(len(symbols))))
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j == len(symbols) or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], symbols[j] = int(self.piece_of_rank[rank]), -1
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            offer([before[i], i])
        return [s for s in symbols if s >= 0]

    def _ranks(self, symbols: np.ndarray, part: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each place, NONE if it has none."""
        after = np.minimum(at + 1, len(symbols) - 1)
        keys = (symbols[at] << 32 | symbols[after]).astype(np.uint64)
        ranks = self.pair_rank[self.pairs.find(keys)]
        ranks[(part[at] != part[after]) | (at == after)] = NONE
        return ranks

    def _with_bytes(self, done, count: int) -> tuple[np.ndarray, np.ndarray]:
        symbols = np.concatenate([s for s, _ in done]) if done else np.zeros(0, np.int64)
        part = np.concatenate([p for _, p in done]) if done else np.zeros(0, np.int32)
        order = np.argsort(part, kind="stable")
        symbols, part = symbols[order], part[order]
        bare = np.flatnonzero(symbols >= BARE)
        if len(bare):
            codes = [self.byte_ids[list(chr(c).encode())] for c in symbols[bare] - BARE]
            widths = np.ones(len(symbols), dtype=np.int64)
            widths[bare] = [len(c) for c in codes]
            part = np.repeat(part, widths)
            starts = np.cumsum(widths) - widths
            symbols = np.repeat(symbols, widths)
            symbols[spans(starts[bare], widths[bare])] = np.concatenate(codes)
        offsets = np.zeros(count + 1, dtype=np.int64)
        np.cumsum(np.bincount(part, minlength=count), out=offsets[1:])
        return symbols, offsets

    # Decoding

    def decode_bytes(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The bytes of each id sequence, before the first space mark is taken off."""
        lengths = self.piece_lengths[ids]
        data = self.piece_bytes[spans(self.piece_starts[ids], lengths)]
        edges = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(lengths, out=edges[1:])
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(offsets) - 1,
            [None, pa.py_buffer(edges[offsets].astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))],
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        parts, bounds = self.parts(pa.array(texts, pa.string()))
        distinct = parts.dictionary_encode()
        ids, starts, sizes = self.memo.of(distinct.dictionary.to_pylist())
        which = distinct.indices.to_numpy()
        result = []
        for begin, end in zip(bounds[:-1], bounds[1:]):
            own = which[begin:end]
            result.append(ids[spans(starts[own], sizes[own])].tolist())
        return result

    def decode(self, ids: list[int]) -> str:
        ids = np.array(ids, dtype=np.int64)
        raw = self.decode_bytes(ids, np.array([0, len(ids)]))[0].as_py()
        return valid_text(raw[1:] if raw[:1] == b" " else raw)


def valid_text(raw: bytes) -> str:
    """UTF-8 text; each byte that belongs to no character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "".join(
            "�" if 0xDC80 <= ord(c) <= 0xDCFF else c for c in raw.decode("utf-8", "surrogateescape")
        )


@lru_cache(maxsize=1)  # one a worker process, kept between its tasks
def codec_of(vocabulary: bytes) -> Codec:
    KEPT["codec"] = codec_of.cache_clear
    return Codec(pickle.loads(vocabulary))


def digests(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = filled(batch.column("text"))
    parts, bounds = codec.parts(texts)
    distinct = parts.dictionary_encode()
    ids, starts, sizes = codec.memo.of(distinct.dictionary.to_pylist())
    ids = ids[spans(starts, sizes)]
    offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    which = distinct.indices
    edges = pa.array(bounds.astype(np.int32))

    def joined(values: pa.Array, glue) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(edges, values.take(which)), glue)

    spelled = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), codec.id_texts.take(pa.array(ids))), ","
    )
    id_lists = joined(spelled, ",")
    decoded = joined(codec.decode_bytes(ids, offsets), b"")
    counts = sums(np.diff(offsets)[which.to_numpy()], bounds)
    id_hashes, text_hashes = [], []
    for numbers, raw in zip(id_lists, decoded):
        id_hashes.append(hashlib.sha256(numbers.as_buffer()).hexdigest())
        raw = raw.as_buffer().to_pybytes()
        text = valid_text(raw[1:] if raw[:1] == b" " else raw)
        text_hashes.append(hashlib.sha256(text.encode()).hexdigest())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_hashes), pa.array(text_hashes)],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def codec_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, number of ids, SHA-256 of the ids and of the text they decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(read_vocabulary(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for batch in text_slices(batches, keeps="codec"):
            yield digests(codec, batch)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
