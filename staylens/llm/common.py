"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import ensure_checkpoint_dir

#: Bytes of text that a Python task works on at a time.
BLOCK_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder of ``spark.checkpoint.dir``, read again.

    Cuts the lineage: what follows reads files, not a recomputation."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_path(tokenizer: str) -> str:
    """A file as given, or the named file of the installed public tokenizers."""
    if os.path.exists(tokenizer):
        return tokenizer
    import public_tokenizers
    return public_tokenizers.path(tokenizer)


def load_tokenizer(tokenizer: str):
    """A tokenizer of the tokenizers library, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(tokenizer))
    t.no_truncation()
    t.no_padding()
    return t


def crc_bucket(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def placed_blocks(batch: pa.RecordBatch, place: int, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Slices of about ``limit`` bytes of one text column, and their first rows.

    A single longer text makes a slice of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a), a


def blocks(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of about ``limit`` bytes of one text column."""
    for batch in released(batches):
        for part, _ in placed_blocks(batch, batch.schema.get_field_index(column), limit):
            yield part


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last one the worker, which Spark keeps for later tasks, hands
    freed memory back to the system."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library trims by itself or not at all
        pass


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def binary_runs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary Arrow column; row i holds the bytes of the next counts[i] values."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def run_values(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of ``binary_runs`` for a column without nulls: values and counts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    size = np.dtype(dtype).itemsize
    offs = np.frombuffer(offsets, dtype=wide)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column) or offs[-1] == offs[0]:
        return np.empty(0, dtype=dtype), np.zeros(len(column), dtype=np.int64)
    values = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]].view(dtype)
    return values, np.diff(offs).astype(np.int64) // size


class Runs:
    """Numbered runs of integers in one growing pool (no object per run, which spares the
    garbage collector millions of lists). Run 0 is empty."""

    def __init__(self):
        self.pool, self.ends = array("q"), array("q", [0, 0])

    def add(self, values) -> int:
        self.pool.extend(values)
        self.ends.append(len(self.pool))
        return len(self.ends) - 2

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the runs one after another, and the length of each."""
        ends = np.frombuffer(self.ends, np.int64)
        starts, lengths = ends[numbers], ends[numbers + 1] - ends[numbers]
        pool = np.frombuffer(self.pool, np.int64) if self.pool else np.empty(0, np.int64)
        return pool[ragged(starts, lengths)], lengths


def coded(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of a column of lists of text: the distinct texts, their numbers one list after another,
    and the offsets of the lists."""
    items = column.flatten().dictionary_encode()
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))])
    return items.dictionary.to_pylist(), items.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets


_KEPT: dict = {}


def per_worker(kind, *key):
    """One ``kind(*key)`` per Python worker, so that caches outlive a task."""
    if (kind, key) not in _KEPT:
        _KEPT[kind, key] = kind(*key)
    return _KEPT[kind, key]


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
