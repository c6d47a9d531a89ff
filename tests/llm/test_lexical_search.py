import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ludica.llm import lexical_search as S
from ludica.llm.queries import op12_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    counted = [(doc_id, terms(text)) for doc_id, text in docs]
    counted = [(doc_id, found) for doc_id, found in counted if found]
    n_docs, n_terms = len(counted), sum(len(found) for _, found in counted)
    df = {}
    for _, found in counted:
        for t in set(found):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, own in wanted.items():
        scored = []
        for doc_id, found in counted:
            m = 100 - 50 + (50 * len(found) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
                        for t in own if (tf := found.count(t)))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


def got(df):
    return sorted(str((r["item_id"], r["rank"], r["doc_id"], r["score"])) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def test_terms():
    texts = ["Ab9-c_d é x 日本", None, "", "--", "ÀB\x7f1"]
    found = S.terms_of(pa.array(texts)[0:])
    words = found.distinct.take(pa.array(found.codes)).to_pylist()
    assert [words[a:b] for a, b in zip(found.offsets, found.offsets[1:])] == [terms(t) for t in texts]
    part = S.terms_of(pa.array(texts)[3:])
    assert part.distinct.take(pa.array(part.codes)).to_pylist() == ["Àb", "1"] and part.offsets.tolist() == [0, 0, 2]


@pytest.fixture(scope="module")
def tables(spark):
    """Documents of few lengths (hot strata), ties, copies, hot terms."""
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([5, 5, 5, 6, 40, 41, 300])))) for i in range(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(90)] + [(5, docs[3][1]), (5, docs[3][1]), (None, docs[3][1]), (None, None), (6, "")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(30)]
    items += [(3, "w1 w2"), (None, docs[3][1]), (None, "w3"), (40, None), (41, "absent"), (42, docs[3][1])]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string").repartition(5), \
        spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(tables):
    docs, items, docs_df, items_df = tables
    assert got(S.top_documents(docs_df, items_df)) == brute(docs, items)
    assert got(S.top_documents(docs_df, items_df, k=3)) == brute(docs, items, 3)


@pytest.mark.parametrize("name, value", [("BLOCK_DOCS", 7), ("BLOCK_POSTINGS", 50), ("ITEM_PAIRS", 200), ("MAX_TERMS", 3), ("STEP", 64)])
def test_sizes_do_not_change_the_result(tables, monkeypatch, name, value):
    docs, items, docs_df, items_df = tables
    want = brute(docs, items, 10)
    monkeypatch.setattr(S, name, value)
    assert got(S.top_documents(docs_df, items_df, 10)) == want


def test_bounds_hold(tables):
    """No block's bound is below a score of it, and no bound is above what its best tfs together give."""
    docs, items, docs_df, items_df = tables
    pairs = S.item_terms(items_df)
    index = S.build_index(docs_df)
    held = S._collected(S._weighted(index, pairs))
    blocks = 0
    for batch in index.blocks.toArrow().to_batches():
        for block in S._opened(batch, held):
            alive = np.arange(len(held.ids))
            scores = S._scores(block, held, alive)
            assert (scores.max(axis=1) <= block.bounds).all()
            assert ((scores.max(axis=1) > 0) == (block.bounds > 0)).all()
            blocks += 1
    assert blocks > 3


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    assert got(op12_lexical_search(spark, "/root/testdata/sf0.001")) == brute(docs, items)


def test_odd_documents(spark, odd_docs, rows_of, no_docs):
    items = [(1, "Hello the WORLD ÀÉ"), (2, "日本語"), (3, "")]
    items_df = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    assert got(S.top_documents(odd_docs, items_df)) == brute(rows_of, items)
    assert got(S.top_documents(no_docs, items_df)) == []
    assert got(S.top_documents(odd_docs, items_df.limit(0))) == []


def test_long_text(spark):
    docs = [(1, "the cat " * 200_000), (2, "the"), (3, "cat"), (4, "dog")]
    items = [(1, "the cat"), (2, "dog the")]
    assert got(S.top_documents(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)
