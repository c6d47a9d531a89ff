import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ludica.llm import simhash as S
from ludica.llm.queries import op4_simhash_pigeonring


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    """rows: (doc_id, fingerprint) -> component_id of each row."""
    prints = sorted({fp for _, fp in rows})
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    arr = np.array(prints, np.uint64)
    for i, p in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ np.uint64(p)) <= 4):
            a, b = find(p), find(prints[i + 1 + j])
            parent[max(a, b)] = min(a, b)
    least = {}
    for doc_id, fp in rows:
        if doc_id is not None:
            least[find(fp)] = min(least.get(find(fp), doc_id), doc_id)
    return [least.get(find(fp)) for _, fp in rows]


def test_fingerprints(odd_texts):
    assert S.fingerprints(pa.array(odd_texts)).tolist() == [brute_print(t) for t in odd_texts]


def test_query_equals_brute_force(spark, small_docs):
    rows = sorted((r["doc_id"], brute_print(r["text"])) for r in small_docs.collect())
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in op4_simhash_pigeonring(spark, "/root/testdata/sf0.001").collect())
    assert got == [(i, f"{fp:016x}", c) for (i, fp), c in zip(rows, brute_classes(rows))]


def planted(rng, groups, size, spread):
    """Fingerprints in chains of near copies, and lone ones."""
    out = []
    for _ in range(groups):
        fp = rng.getrandbits(64)
        for _ in range(size):
            out.append(fp)
            for bit in rng.sample(range(64), rng.randrange(0, spread)):
                fp ^= 1 << bit
    return out + [rng.getrandbits(64) for _ in range(300)]


@pytest.mark.parametrize("tile", [4, 2048])
def test_links_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(S, "TILE", tile)
    rng = random.Random(3)
    base = rng.getrandbits(64)
    dense = [base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))) for _ in range(150)]
    prints = planted(rng, 40, 6, 6) + dense + [0, 0, 2 ** 64 - 1, 1 << 63]
    rows = [(i if i % 17 else None, fp) for i, fp in enumerate(prints)]
    df = spark.createDataFrame([(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in rows], "doc_id long, fp long")
    found = {r["fp"] % (1 << 64): r["component_id"] for r in S.classes(df).collect()}
    assert [found[fp] for _, fp in rows] == brute_classes(rows)


def test_odd_documents(odd_docs, rows_of):
    rows = [(i, brute_print(t)) for i, t in rows_of]
    want = sorted(str((i, f"{fp:016x}", c)) for (i, fp), c in zip(rows, brute_classes(rows)))
    assert sorted(str(tuple(r)[:3]) for r in S.simhash_groups(odd_docs).collect()) == want


def test_one_row_of_each_class_stays(odd_docs, rows_of):
    kept = S.keep_one_per_group(odd_docs)
    assert kept.dtypes == odd_docs.dtypes
    rows = [(i, brute_print(t)) for i, t in rows_of]
    ids = brute_classes(rows)
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted({c for c in ids if c is not None})


def test_empty(no_docs):
    assert S.simhash_groups(no_docs).collect() == [] and S.keep_one_per_group(no_docs).collect() == []


def test_pigeonring_chain_holds_for_linked_pairs():
    rng = random.Random(0)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 5)))
        x = np.array([a ^ b], np.uint64)
        keys, fps, looked = S._keys(np.array([b], np.uint64))
        met = set(S._filed(np.array([a], np.uint64)).reshape(-1).tolist()) & set(keys.tolist())
        assert any(S._chained(np.array([k]), x)[0] for k in met)


def test_large_groups_keep_to_the_chains():
    """Pairs of one key that are near but outside its chains: 3 bits in the third segment of the start."""
    rng = random.Random(4)
    base = rng.getrandbits(64)
    fps = sorted({base} | {base ^ sum(1 << b for b in rng.sample(range(26, 64), rng.randrange(1, 4))) for _ in range(40)})
    fps = np.array(fps, np.uint64)
    key = int(S._filed(fps)[0][0])
    assert (S._filed(fps)[0] == key).all() and len(fps) >= S.SMALL_GROUP
    n = len(fps)
    found = S._links_of_groups(np.full(2 * n, key), np.tile(fps, 2), np.repeat([0, 1], n), np.array([0]))
    x = np.concatenate([a ^ b for a, b in found])
    assert len(x) and S._chained(np.full(len(x), key), x).all()
    near = fps[:, None] ^ fps[None, :]
    near = near[np.bitwise_count(near) <= S.MAX_BITS]
    assert not S._chained(np.full(len(near), key), near).all()


def test_the_keys_a_large_group_is_looked_up_under(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE", 10)
    key, alone, beside = (1 << 26) | 5, (1 << 26) | 1000, (1 << 26) | 4
    filed = spark.createDataFrame([(key, 35), (alone, 3), (beside, 2)], "key long, count long")
    got = {r["key"]: (r["rights"], r["lefts"]) for r in S._tiles(filed).collect()}
    assert got == {key: (4, 4), beside: (1, 4)} | {key ^ (1 << b): (0, 4) for b in range(1, 13)}
    assert S._tiles(filed.where("count < 10")).collect() == []
