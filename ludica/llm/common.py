"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludica.session import scratch_path

#: Words of the contracts: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Text bytes that a task works on at a time (a longer text stays whole).
SLICE_BYTES = 8 << 20
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ascii_lower(text: str) -> str:
    """A-Z lower-cased, everything else as it is."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about SLICE_BYTES of text."""
    size = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, done + SLICE_BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop
    _give_back()


def _give_back() -> None:
    """Hand freed memory back to the system: Python workers are kept from task
    to task, and those of an executor share its memory."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # no glibc: nothing to trim
    _LIBC = None


class Coded(NamedTuple):
    """Lists of strings as codes into their distinct strings."""

    distinct: pa.Array
    codes: np.ndarray
    offsets: np.ndarray


def coded_words(texts: pa.Array) -> Coded:
    """The words (runs of anything but ASCII white space) of each text; none for null."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    return coded(lists.flatten(), np.asarray(lists.offsets, dtype=np.int64))


def coded(flat: pa.Array, offsets: np.ndarray) -> Coded:
    """``flat`` dealt to lists by ``offsets``, without empty strings."""
    offsets = offsets - offsets[0]
    encoded = flat.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(encoded.dictionary, pa.scalar("", encoded.dictionary.type)).as_py()
    if empty >= 0:
        kept = codes != empty
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
        codes = codes[kept]
    return Coded(encoded.dictionary, codes, offsets)


def ragged(lists: list[list[int]], dtype) -> tuple[np.ndarray, np.ndarray]:
    """Lists of numbers as one flat array and offsets."""
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)), out=offsets[1:])
    return np.fromiter(chain.from_iterable(lists), dtype, int(offsets[-1])), offsets


def ragged_take(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists that ``codes`` name, one after the other, and each one's end
    (with a leading 0) in the result."""
    sizes = np.diff(offsets)[codes]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(offsets[:-1][codes] - ends[:-1], sizes)
    at += np.arange(len(at))
    return values[at], ends


def range_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum (along the first axis) of each range offsets[i]:offsets[i + 1]; 0 for empty ones."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), dtype=values.dtype)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full], axis=0)
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``: the fold of a row (null id: null)."""
    return F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % modulus


def code_points(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the strings in one array, and each string's end in it."""
    joined = "".join(strings)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(np.fromiter(map(len, strings), dtype=np.int64, count=len(strings)))
    return points, ends


def hashed_ngrams(strings: list[str], sizes: tuple[int, ...], buckets: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(string index, bucket) of every character n-gram of every string.

    Vectorised over all strings: a polynomial hash of the code points of each
    window that lies within one string, mixed and reduced to ``buckets``
    (a power of two).
    """
    if not strings:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points, ends = code_points(strings)
    owner = np.repeat(np.arange(len(strings)), np.diff(ends, prepend=0))
    rows, cols = [], []
    with np.errstate(over="ignore"):
        values = (points.astype(np.uint64) + np.uint64(salt + 1)) * np.uint64(0x9E3779B97F4A7C15)
        values ^= values >> np.uint64(29)
        for n in sizes:
            m = len(points) - n + 1
            if m <= 0:
                continue
            inside = owner[:m] == owner[n - 1:]
            h = np.full(m, n, dtype=np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + values[k:k + m]
            h = h[inside]
            h ^= h >> np.uint64(33)
            h *= np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(31)
            rows.append(owner[:m][inside])
            cols.append((h & np.uint64(buckets - 1)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(cols)
