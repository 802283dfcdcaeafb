"""Reading, folds, shared folders and Arrow slices used by the operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text bytes that one step inside a Python worker holds at a time.
SLICE_BYTES = 4 << 20


# Folders of the archives handed out, by application; gone when the driver ends.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, as --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.TemporaryDirectory()
    archive = Path(folder.name) / f"{package.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED[context.applicationId] = folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's text modulo folds; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared one named by ``spark.checkpoint.dir``.
    Only where it is unset and one process runs everything, as in tests, a
    folder of its own is made."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="llm-")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back: later steps
    start from files, whatever executors are lost."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# What forgets the memory that an operator keeps in a worker process, by operator.
KEPT: dict[str, Callable[[], None]] = {}


def make_room(keeps: str = "") -> None:
    """Forget what other operators keep in this worker process, and return freed
    memory to the system: a process that waits for its next task otherwise holds
    what the last one needed at most."""
    for name in [n for n in KEPT if n != keeps]:
        KEPT.pop(name)()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES, keeps: str = ""
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about so many bytes of text, one row at
    least. Memory freed meanwhile goes back when a piece is done with."""
    make_room(keeps)
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, length in enumerate(lengths):
            if held and held + length > most:
                yield batch.slice(start, row - start)
                make_room(keeps)
                start, held = row, 0
            held += int(length)
        if start < batch.num_rows:
            yield batch.slice(start)
    make_room(keeps)


def filled(texts: pa.Array) -> pa.Array:
    return pc.fill_null(texts, "")


def byte_table(changes: dict[str, str]) -> np.ndarray:
    """For ``translated``: what each byte becomes, ASCII characters only."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32  # A-Z to lower case
    for characters, becomes in changes.items():
        out[[ord(c) for c in characters]] = ord(becomes)
    return out


def translated(texts: pa.Array, bytes_to: np.ndarray) -> pa.Array:
    """The texts (null: empty) with each byte replaced."""
    texts = filled(texts)
    if not len(texts):
        return texts
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    start, end = int(offsets[0]), int(offsets[-1])
    if start == end:
        return texts
    data = bytes_to[np.frombuffer(texts.buffers()[2], np.uint8)[start:end]]
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - np.int32(start)), pa.py_buffer(data))
