import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ludica.llm import common
from ludica.llm.components import least_members


def test_coded_words_equal_the_pattern(odd_texts):
    c = common.coded_words(pa.array(odd_texts))
    shown = c.distinct.to_pylist()
    for k, text in enumerate(odd_texts):
        assert [shown[i] for i in c.codes[c.offsets[k]:c.offsets[k + 1]]] == re.findall(common.WORD_PATTERN, text or "")


def test_slices_keep_all_rows(monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (3, 4, 40, 0, 9)] + [None])], names=["text"])
    parts = list(common.slices(batch))
    assert pa.concat_arrays([p.column("text") for p in parts]) == batch.column("text")
    assert max(p.num_rows for p in parts) < 6


def test_hashed_ngrams_depend_on_the_string_alone():
    a = common.hashed_ngrams(["abcde", "", "xabcdex"], (3, 4), 1 << 20)
    b = common.hashed_ngrams(["xabcdex"], (3, 4), 1 << 20)
    own = lambda pair, k: sorted(pair[1][pair[0] == k].tolist())
    assert own(a, 2) == own(b, 0) and set(own(a, 0)) < set(own(a, 2)) and own(a, 1) == []


def test_range_sums_and_ragged_take():
    assert common.range_sums(np.arange(5), np.array([0, 0, 2, 2, 5])).tolist() == [0, 1, 0, 9]
    flat, ends = common.ragged_take(np.arange(6), np.array([0, 1, 1, 4, 6]), np.array([2, 1, 3, 0, 2]))
    assert flat.tolist() == [1, 2, 3, 4, 5, 0, 1, 2, 3] and ends.tolist() == [0, 3, 3, 5, 6, 9]


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {"chain": [(i, i + 1) for i in range(300)], "star": [(500, i) for i in range(200)], "none": [],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(7, 7), (9, 8), (9, 8)]}[kind]
    df = spark.createDataFrame(edges, "a long, b long") if edges else spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))
    got = {r["node"]: r["root"] for r in least_members(df, "a", "b").collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(parent) if find(x) != x}
