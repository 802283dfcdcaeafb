import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from calepin.llm import packing, sentencepiece_codec
from calepin.llm.queries import tokenizer_path
from calepin.llm.tables import Memo

PIECES, WORDS = tokenizer_path("piece_bpe_32k.model"), tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(sentencepiece_codec.read_vocabulary(PIECES))


def random_texts(count, alphabet, longest):
    rng = random.Random(3)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def test_codec_equals_the_library(codec, library):
    texts = random_texts(600, list("  \n\t▁abcdeéßàñ中文🦙<>0123aaaá\x00") + ["the ", "tion"], 80)
    texts += ["", " ", "   a", "<s>", "<0x41>", "a" * 999, "▁", "\n\n"]
    assert codec.encode(texts) == library.encode(texts, num_threads=1)
    for ids in library.encode(texts, num_threads=1):
        assert codec.decode(ids) == library.decode(ids)


def test_any_ids_decode(codec, library):
    rng = random.Random(4)
    for _ in range(50):
        ids = [rng.randrange(32000) for _ in range(rng.randint(0, 30))]
        assert codec.decode(ids) == library.decode(ids)


def test_long_parts_merge_from_a_heap(codec, library):
    text = "".join(random.Random(5).choice("abcdefgh") for _ in range(5000))
    assert codec.encode([text, "a b"]) == [library.encode(text), library.encode("a b")]


def test_memo_forgets_and_stays_right(codec, library):
    codec.memo.bound = 3
    texts = random_texts(40, "abc ", 30)
    assert [codec.encode([t])[0] for t in texts] == library.encode(texts, num_threads=1)
    codec.memo.bound = 400_000


def test_codec_digests(documents, odd, library):
    rows = sentencepiece_codec.codec_digests(documents(odd), PIECES).collect()
    assert len(rows) == len(odd)
    texts = {i: t or "" for i, t in odd}
    for row in rows:
        ids = library.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert sentencepiece_codec.codec_digests(documents([]), PIECES).count() == 0


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def test_word_ids_equal_the_tokenizer():
    texts = random_texts(300, list("abÉé Σς\n\t.,'!<|0") + [" the ", "<|endoftext|>", "\x1e", "don't"], 60)
    ids, offsets = packing.word_ids(packing.remembering(WORDS), pa.array(texts))
    t = tokenizer()
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == t.encode(text, add_special_tokens=False).ids


SPECIAL = ["a<|endoftext|>b", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endo<|endoftext|>É", "no token", "", "hel<|endoftext|>lo's"]


def test_special_tokens_equal_the_tokenizer_as_loaded(documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    texts = SPECIAL + random_texts(200, list("abÉ é\n|<") + [" the ", "<|endoftext|>", "<|startoftext|>", "\x1e"], 40)
    ids, offsets = packing.text_ids(WORDS, pa.array(texts))
    expected = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected
    rows = packing.packed(documents(list(enumerate(SPECIAL))), WORDS).collect()
    wanted = {i: np.array([*ids, 1], dtype="<u4") for i, ids in enumerate(expected[: len(SPECIAL)])}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {
        i: (len(x), zlib.crc32(x.tobytes())) for i, x in wanted.items()
    }


def check_packing(rows, given, capacity):
    t, texts = tokenizer(), {i: x or "" for i, x in given}
    expected = []
    for i, text in given:
        ids = np.array([*t.encode(texts[i], add_special_tokens=False).ids, 1], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            expected.append((i is None, i or 0, piece, start, len(part), zlib.crc32(part.tobytes())))
    found = [(r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(found) == sorted(expected)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_of_odd_texts(documents, odd):
    rows = packing.packed(documents(odd), WORDS).collect()
    check_packing(rows, odd, 4096)
    assert packing.packed(documents([]), WORDS).count() == 0


def test_packing_in_groups_is_tight(documents):
    rng = random.Random(9)
    given = [(k, "the " * rng.randint(0, 90)) for k in range(2000)]
    rows = packing.packed(documents(given), WORDS, capacity=64, group_size=500).collect()
    used = check_packing(rows, given, 64)
    assert used <= 1.03 * sum(r.length for r in rows) / 64 + 4


def test_placing_minimises_the_sum_of_squares():
    rng = random.Random(2)
    lengths = np.array([rng.randint(1, 12) for _ in range(300)])
    sequence, _ = packing.place(lengths, 12)
    gaps = {}
    for k, length in enumerate(lengths.tolist()):
        held = dict(gaps)

        def squares(bin_, gap):
            after = {**held, bin_: gap - length}
            counts = {}
            for left in after.values():
                if left:
                    counts[left] = counts.get(left, 0) + 1
            return sum(c * c for c in counts.values())

        options = {b: squares(b, g) for b, g in held.items() if g >= length}
        new = squares("new", 12)
        chosen = int(sequence[k])
        value = options[chosen] if chosen in held else new
        assert value == min([*options.values(), new])
        gaps[chosen] = held.get(chosen, 12) - length


def test_memo_makes_room_and_stays_right():
    asked = []

    def encode(words):
        asked.extend(words)
        sizes = [len(w) for w in words]
        return np.array([ord(c) for w in words for c in w], dtype=np.int64), np.r_[0, np.cumsum(sizes)].astype(np.int64)

    memo, rng = Memo(encode, bound=50), random.Random(3)
    common = [f"w{k}" for k in range(15)]
    for turn in range(200):
        words = sorted({*rng.sample(common, 10), *(f"rare{turn}-{k}" for k in range(5))}, key=lambda w: rng.random())
        values, starts, sizes = memo.of(words)
        assert ["".join(map(chr, values[s : s + n])) for s, n in zip(starts, sizes)] == words
        assert len(memo.place) <= 50 + len(words)
    # Common words are not encoded anew each time room is made.
    assert sum(w in common for w in asked) < 100
