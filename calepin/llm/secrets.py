"""Secret scan: fixed patterns, and strings that a primed compressor finds new.

Three patterns give the base spans. Further candidates are strings of a key's
characters in a sensitive region: the line of a word that names something
sensitive and a few lines after it, and the body of a PEM private key. Each of
them that is not put together from words is measured by its novelty: the bytes
that zstandard, primed with a dictionary of common identifiers and the text
around the candidate, needs for it beyond what the text around needs alone,
against its length. Words and repeated code compress; a random key takes nearly
what the entropy of its alphabet says, whatever its length.

Null text counts as empty and has no spans. Spans are code points, end
exclusive. Where a candidate overlaps a base span it is not reported again.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from calepin.llm.common import filled, make_room, text_slices

KINDS = ("assign", "access", "hex", "novel")

# The patterns of the contract. The length tests follow them.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of hex digits match whole, so asking for 24 drops just the short ones.
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

SENSITIVE = re.compile(
    r"secret|token|passw|pwd|api|key|auth|credential|bearer|private|access|sign", re.IGNORECASE | re.ASCII
)
LINES_AFTER = 3
PEM_BEGIN, PEM_END = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY"), "-----END"
STRING = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Names are words of some length; case and digits cut a random string in short pieces.
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
WORD_LENGTH = 4
UNSPEAKABLE = re.compile(r"[bcdfghjklmnpqrstvwxz]{5}", re.IGNORECASE | re.ASCII)
# One pass over a batch tells which texts can hold anything at all.
POSSIBLE = (
    r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}|(?i:secret|token|passw|pwd|api|key|auth|credential|bearer|private|access|sign)"
)
AROUND = 200
# Random strings reach this share of their alphabet's entropy, less a byte in all:
# how much the text around tells of single characters depends on its length.
NOVELTY = 0.9

# Names and phrases common in code and configuration.
IDENTIFIERS = """
password passwd secret token api_key apikey access_key secret_key private_key public_key client_id client_secret
authorization bearer credentials username database connection host port user admin root localhost example
config settings environment variable default value string integer boolean return function class import
public static void const let var self this null None true false print export require module package
https http www com org net io dev test staging production sample placeholder changeme your_key_here
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 00000000 xxxxxxxx
request response session cookie header content type application json text html utf encoding base64
""".strip()


@lru_cache(maxsize=1)
def compressor() -> zstandard.ZstdCompressor:
    primer = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=19, dict_data=primer, write_content_size=False)


def novelty(before: str, candidate: str, after: str) -> float:
    """Compressed bytes that the candidate adds, per byte of it."""
    around = (before + "\n" + after + "\n").encode()
    size = compressor().compress
    own = candidate.encode()
    return (len(size(around + own)) - len(size(around))) / len(own)


def alphabet(candidate: str) -> int:
    """How many characters the candidate seems to be drawn from."""
    used = set(candidate)
    for digits in ("0123456789", "0123456789abcdef", "0123456789ABCDEF"):
        if used <= set(digits):
            return len(digits)
    sizes = ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10))
    return sum(n for test, n in sizes if any(map(test, used))) + len(used & set("+/_-="))


def bound(candidate: str) -> float:
    """The novelty from which on a candidate counts as random."""
    entropy = math.log2(max(alphabet(candidate), 10)) / 8
    return NOVELTY * entropy - 1 / len(candidate)


def wordlike(candidate: str) -> bool:
    """Put together from pieces that can be words."""
    pieces = PIECE.findall(candidate)
    if not any(p.isalpha() for p in pieces) or any(map(UNSPEAKABLE.search, pieces)):
        return False
    return sum(map(len, pieces)) >= WORD_LENGTH * len(pieces)


def sensitive_regions(text: str) -> list[tuple[int, int]]:
    """Disjoint (start, end), in order, of the lines where secrets are looked for."""
    found, line_end = [], -1
    for m in SENSITIVE.finditer(text):
        if m.start() < line_end:
            continue
        start = text.rfind("\n", max(line_end, 0), m.start()) + 1 or max(line_end, 0)
        end = line_end = _line_end(text, m.end())
        for _ in range(LINES_AFTER):
            end = _line_end(text, min(end + 1, len(text)))
        found.append((start, end))
    at = 0
    while m := PEM_BEGIN.search(text, at):
        at = text.find(PEM_END, m.end())
        at = len(text) if at < 0 else at
        found.append((m.start(), at))
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], end))
        else:
            merged.append((start, end))
    return merged


def _line_end(text: str, at: int) -> int:
    end = text.find("\n", at)
    return len(text) if end < 0 else end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = []
    for first, last in sensitive_regions(text):
        for m in STRING.finditer(text, first, last):
            start, end = m.span()
            if any(s < end and start < e for s, _, e in base) or wordlike(m[0]):
                continue
            before = text[max(0, start - AROUND) : start]
            if novelty(before, m[0], text[end : end + AROUND]) >= bound(m[0]):
                found.append((start, 3, end))
    return found


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def possible(texts: pa.Array) -> list[bool]:
    return pc.match_substring_regex(texts, POSSIBLE).to_pylist()


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in text_slices(batches):
            texts = filled(batch.column("text"))
            counts, digests, spans = [], [], []
            for row, worth in enumerate(possible(texts)):
                if not worth:
                    counts.append((0, 0, 0))
                    digests.append(nothing)
                    spans.append("")
                    continue
                body = texts[row].as_py()
                base = base_spans(body)
                kinds = [kind for _, kind, _ in base]
                counts.append(tuple(kinds.count(k) for k in range(3)))
                digests.append(hashlib.sha256(spelled(base).encode()).hexdigest())
                spans.append(spelled(sorted(base + novel_spans(body, base))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)),
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    )


def masked(text: str, mask: str = "[secret]") -> str:
    """The text with every span replaced by a mask; overlapping spans by one."""
    base = base_spans(text)
    parts, at = [], 0
    for start, _, end in sorted(base + novel_spans(text, base)):
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def without_secrets(text: Column) -> Column:
    """The text column with secrets masked; null stays null."""

    @F.arrow_udf(StringType())
    def run(texts: pa.Array) -> pa.Array:
        make_room()
        out = []
        for row, worth in zip(texts, pc.match_substring_regex(texts, POSSIBLE).to_pylist()):
            body = row.as_py()
            out.append(masked(body) if worth else body)
        return pa.array(out, pa.string())

    return run(text)
