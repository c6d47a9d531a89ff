import re
from collections import Counter

import pytest
import zstandard

from ludica.llm import quality_rules as Q
from ludica.llm.queries import op2_compression_bands

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in earlier
            earlier.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    data, bands = text.encode(), Q.Bands()
    squeeze = lambda d: len(d) / len(zstandard.ZstdCompressor(level=3).compress(d))
    good = True
    band = [b for b in bands.whole if len(data) >= b[0]]
    if band:
        good = band[-1][1] <= squeeze(data) <= band[-1][2]
        chunks = [data[i:i + 2048] for i in range(0, len(data), 2048)]
        if len(chunks) > 1 and len(chunks[-1]) <= 1024:
            chunks[-2:] = [chunks[-2] + chunks[-1]]
        if len(chunks) > 1:
            bad = sum(not bands.chunk[0] <= squeeze(c) <= bands.chunk[1] for c in chunks)
            good &= bad <= bands.chunk_share * len(chunks)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed, not failed and good)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_odd_documents(odd_docs, rows_of):
    got = Q.quality_rules(odd_docs).collect()
    assert sorted(str((r["doc_id"], *(r[n] for n in NAMES))) for r in got) == sorted(str((i, *brute(t))) for i, t in rows_of)


def test_query(spark, small_docs):
    want = {r["doc_id"]: brute(r["text"]) for r in small_docs.collect()}
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in op2_compression_bands(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_empty(no_docs):
    assert Q.quality_rules(no_docs).collect() == [] and Q.keep_good(no_docs).collect() == []


def test_keep_good_keeps_columns_and_rows(odd_docs, rows_of):
    kept = Q.keep_good(odd_docs)
    assert kept.dtypes == odd_docs.dtypes
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(str((i, t)) for i, t in rows_of if brute(t)[-1])


@pytest.mark.parametrize("text,good", [
    ("The quick brown fox jumps over the lazy dog while seven grey herons watch from a distant bank. " * 60, False),
    ("".join(chr(33 + (i * i * 7919 + i * 31) % 90) + (" " if i % 7 == 0 else "") for i in range(6000)), None)])
def test_bands(text, good):
    ratio, chunks, bad, ok = Q.compression(text.encode(), Q.Bands(), zstandard.ZstdCompressor(level=3).compress)
    assert ratio > 0 and chunks >= 2 and (good is None or ok is good)


def test_noise_is_rejected():
    import base64
    import random
    rng = random.Random(0)
    for size in (1500, 6000, 40000):
        noise = base64.b64encode(bytes(rng.randrange(256) for _ in range(size))).decode()
        spaced = " ".join(noise[i:i + 40] for i in range(0, len(noise), 40))
        assert not Q.compression(spaced.encode(), Q.Bands(), zstandard.ZstdCompressor(level=3).compress)[3]
