"""Operator 2: compression bands, a quality rule on zstandard ratios.

Repetitive text compresses too well, noise too badly. The ratio (bytes over
compressed bytes, level 3) of the whole text must lie in a band that depends
on its length, since short texts compress less; so must the ratios of its
fixed-size chunks, up to a tolerated share, so that a repetitive or noisy
part inside a long document counts too.

Defined cases: null text has no words, no lines and fails the base rule, as
does any text under ``MIN_WORDS``; texts shorter than the first band have no
ratio (null) and pass the method's rule; a last chunk under half a chunk
belongs to the chunk before. Each row is judged alone, so repeated rows get
equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import coded_words, range_sums, slices

MIN_WORDS = 50
#: At most this share of the words may lie in repeated three-word windows.
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Bands:
    """Limits of the compression ratio by length.

    ``whole``: (least bytes, lowest ratio, highest ratio), ascending; a text
    takes the last entry it is long enough for. ``chunk``: the band of every
    chunk of ``chunk_bytes``; at most ``chunk_share`` of the chunks may lie
    outside it.
    """

    level: int = 3
    whole: tuple[tuple[int, float, float], ...] = (
        (128, 0.80, 2.6), (512, 1.10, 3.2), (1024, 1.35, 3.6),
        (4096, 1.45, 4.2), (16384, 1.50, 5.0), (131072, 1.55, 6.0))
    chunk_bytes: int = 2048
    chunk: tuple[float, float] = (1.35, 3.8)
    chunk_share: float = 0.25


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, ratio double, n_chunks int, n_bad_chunks int, kept boolean")
_TYPES = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
          "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "ratio": pa.float64(),
          "n_chunks": pa.int32(), "n_bad_chunks": pa.int32(), "kept": pa.bool_()}


def repeated_window_words(codes: np.ndarray, offsets: np.ndarray, size: int = 3) -> np.ndarray:
    """Per list, the positions covered by windows that occur twice or more in it."""
    n = len(codes)
    if n < size:
        return np.zeros(len(offsets) - 1, np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = np.flatnonzero(owner[:n - size + 1] == owner[size - 1:])
    if not len(whole):
        return np.zeros(len(offsets) - 1, np.int64)
    width, key = int(codes.max()) + 1, owner[whole]
    for k in range(size):
        _, key, counts = np.unique(key * width + codes[whole + k], return_inverse=True, return_counts=True)
    begins = whole[counts[key] > 1]
    covered = np.zeros(n, np.int64)
    for k in range(size):
        covered[begins + k] = 1
    return range_sums(covered, offsets)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def compression(data: bytes, bands: Bands, compress) -> tuple[float | None, int, int, bool]:
    """(ratio, chunks, chunks out of band, within all limits) of one text."""
    band = next((b for b in reversed(bands.whole) if len(data) >= b[0]), None)
    if band is None:
        return None, 0, 0, True
    ratio = len(data) / len(compress(data))
    cuts = list(range(0, max(1, len(data) - bands.chunk_bytes // 2), bands.chunk_bytes)) + [len(data)]
    bad = 0
    if len(cuts) > 2:
        for a, b in zip(cuts, cuts[1:]):
            low, high = bands.chunk
            bad += not low <= (b - a) / len(compress(data[a:b])) <= high
    chunks = len(cuts) - 1
    return ratio, chunks, bad, band[1] <= ratio <= band[2] and bad <= bands.chunk_share * chunks


def judge(texts: pa.Array, bands: Bands = Bands()) -> pa.StructArray:
    """The verdict of each text, as a struct array of VERDICT."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    words = coded_words(texts)
    n_words = np.diff(words.offsets)
    lengths = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    repeats = repeated_window_words(words.codes, words.offsets)
    compress = zstandard.ZstdCompressor(level=bands.level).compress
    plain = texts.to_pylist()
    squeezed = [compression(t.encode(), bands, compress) for t in plain]
    failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    columns = {
        "n_words": n_words,
        "word_chars": range_sums(lengths[words.codes], words.offsets),
        "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").cast(pa.int64()),
        "n_dup_lines": [duplicate_lines(t) for t in plain],
        "n_repeat_words": repeats,
        "base_failed": failed,
        "ratio": [s[0] for s in squeezed],
        "n_chunks": [s[1] for s in squeezed],
        "n_bad_chunks": [s[2] for s in squeezed],
        "kept": ~failed & np.array([s[3] for s in squeezed], dtype=bool),
    }
    return pa.StructArray.from_arrays([pa.array(v, _TYPES[k]) for k, v in columns.items()],
                                      fields=[pa.field(k, t) for k, t in _TYPES.items()])


def quality(text: Column, bands: Bands = Bands()) -> Column:
    """The verdict of a text column as a struct (VERDICT)."""
    @F.arrow_udf(VERDICT)
    def verdict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [judge(s.column("text"), bands)
                     for s in slices(pa.RecordBatch.from_arrays([texts], names=["text"]))]
            yield pa.concat_arrays(parts) if parts else judge(texts, bands)
    return verdict(text)


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """doc_id and the verdict of every document (doc_id, text)."""
    return (docs.select("doc_id", quality(F.col("text").cast("string"), bands).alias("_v"))
            .select("doc_id", "_v.*"))


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (docs.select(F.struct(*columns).alias("_row"), quality(F.col("text").cast("string"), bands).alias("_v"))
            .where("_v.kept").select("_row.*"))
