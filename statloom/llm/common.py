"""Helpers of the training-data operators: Arrow batches, words, hashes, hand-over tables."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of one step of a task together have at most this many bytes, or are a single text.
CHUNK_BYTES = 16 << 20


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def remainder(column: str, mod: int) -> Column:
    """crc32 of the column's text, modulo ``mod``; NULL for NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


def chunks(
    batches: Iterable[pa.RecordBatch], column: str, most: int = CHUNK_BYTES, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts stay below ``most`` bytes (a longer text is alone), of ``rows`` rows at most."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows + 1, np.int64)
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0)
        np.cumsum(lengths.to_numpy(zero_copy_only=False), out=sizes[1:])
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(sizes, sizes[start] + most, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows, start + (rows or batch.num_rows))
            yield batch.slice(start, end - start)
            start = end


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 texts; NULL becomes empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def flat_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    r"""Words ``[^\x20\x09-\x0D]+`` of all texts in a row, and their number per text."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.split()  # of bytes: splits at exactly those six characters
        counts[i] = len(own)
        words += own
    return words, counts


_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False


def distinct_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``flat_words`` and ``numbered`` in one, for many words: distinct words in order of appearance,
    the number of each word among them, and the number of words per text."""
    flat = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    solid = _SOLID[flat]
    edges = np.flatnonzero(np.diff(solid.view(np.int8), prepend=np.int8(0)))
    begins, ends = edges[::2], edges[1::2]  # a break follows the last word, too
    offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(flat[solid])]
    coded = pa.Array.from_buffers(pa.binary(), len(begins), buffers).dictionary_encode()
    past = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    counts = np.diff(np.searchsorted(begins, past), prepend=0).astype(np.int64)
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), counts


def numbered(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words in order of appearance, and the number of each word among them."""
    number = dict.fromkeys(words)
    distinct = list(number)
    number.update(zip(distinct, range(len(distinct)), strict=True))
    return distinct, np.fromiter(map(number.__getitem__, words), np.int32, len(words))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start..start+length-1 of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Rows with much in them go to Python in batches of ``most`` rows, in what is run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release() -> None:
    """Gives freed memory back to the system; Python workers live on after a task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
        if trim:
            trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
