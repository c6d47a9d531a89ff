import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ludica.llm import toxicity as T
from ludica.llm.queries import op8_toxicity_mil


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{d}/documents.parquet").where("n_chars < 6000").repartition(8).cache(), spark.read.parquet(f"{d}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return T.train(*tables)


def brute_score(text, model):
    """Sentence by sentence, word by word."""
    import re
    keep = 1.0
    for line in (text or "").split("\n"):
        sentence = []
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        for k, w in enumerate(words):
            sentence.append(w)
            if T._ends(w) or k == len(words) - 1:
                z = model.bias
                for w in dict.fromkeys(sentence):
                    _, bucket = T.hashed_ngrams([f"<{T._edges.sub('', w).lower()}>"], T.NGRAMS, T.BUCKETS)
                    z += sum(model.weights[model.slot[b]] for b in bucket if model.slot[b] >= 0)
                keep *= 1 - 1 / (1 + np.exp(-np.clip(z, -60, 60)))
                sentence = []
    return 1 - keep


def test_score_equals_brute_force(tables, model, odd_texts):
    texts = odd_texts[:-1] + [r["text"] for r in tables[0].limit(40).collect()]
    s = T.Sentences(pa.array(texts))
    assert s.noisy_or(s.probabilities(model)) == pytest.approx([brute_score(t, model) for t in texts], abs=1e-9)


def test_held_out(tables, model):
    docs, labels = tables
    rows = T.score_documents(docs, model).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    toxic, clean = [r["score"] for r in held if r["toxic"]], [r["score"] for r in held if not r["toxic"]]
    wins = np.mean([[a > b for b in clean] for a in toxic])
    # a twentieth of the given labels is flipped at random
    assert wins > 0.93 and np.mean(np.array(clean) >= 0.5) < 0.02 and np.mean(np.array(toxic) >= 0.5) > 0.75


def test_offending_sentences_are_located(tables, model):
    docs, _ = tables
    for r in T.score_documents(docs.where("doc_id % 10 = 1"), model).join(docs.select("doc_id", "text"), "doc_id").collect():
        for o in r["offending"]:
            assert o["p"] >= 0.5 and 0 <= o["start"] < o["end"] <= len(r["text"]) and r["predicted"] == 1
            assert r["text"][o["start"]:o["end"]].strip() == r["text"][o["start"]:o["end"]]


def test_fit_finds_the_guilty_feature():
    """Feature 0 makes a sentence toxic, feature 1 is everywhere."""
    rng = np.random.default_rng(0)
    doc, sentence, slot, sizes, labels, at = [], [], [], [], [], 0
    for d in range(400):
        n, bad = int(rng.integers(1, 6)), rng.random() < 0.4
        sizes.append(n)
        labels.append(bad)
        guilty = int(rng.integers(n))
        for k in range(n):
            for f in [1] * bool(rng.random() < 0.5) + [0] * bool(bad and k == guilty):
                doc.append(d), sentence.append(at + k), slot.append(f)
        at += n
    w, b = T.fit_noisy_or(*map(np.array, (doc, sentence, slot, sizes, labels)), 2)
    assert w[0] + b > 1 and w[1] + b < -2


def test_odd_documents(spark, odd_docs, no_docs, rows_of, model):
    got = T.score_documents(odd_docs, model).collect()
    assert len(got) == len(rows_of)
    assert all(r["score"] == 0 and r["n_sentences"] == 0 for r in got if r["doc_id"] in (0, 1, 2, 3) and r["n_sentences"] == 0)
    assert T.score_documents(no_docs, model).collect() == [] and T.drop_toxic(no_docs, model).collect() == []
    kept = T.drop_toxic(odd_docs, model)
    assert kept.dtypes == odd_docs.dtypes and kept.count() == sum(r["score"] < 0.5 for r in got)


def test_without_usable_labels(spark, odd_docs):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    model = T.train(odd_docs, labels)
    assert {r["score"] for r in T.score_documents(odd_docs, model).collect()} <= {0.0} or max(
        r["score"] for r in T.score_documents(odd_docs, model).collect()) < 1e-12


def test_a_repeated_id_is_one_training_row(spark):
    """Also an id on most rows, with several texts, and labels of ids without a document."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % T.HOLD_OUT]
    docs = spark.createDataFrame([(ids[0], f"text {k % 7}") for k in range(3000)] + [(i, "b") for i in ids[1:]] + [(ids[1], None)],
                                 "doc_id long, text string").withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[0], 1), (10 ** 9, 1)], "doc_id long, toxic int")
    rows = T._sampled(docs, labels).collect()
    assert len(rows) == len(ids) and sorted(r["text"] for r in rows) == ["b"] * (len(ids) - 1) + ["text 0"]
    assert [r["label"] for r in rows if r["text"] == "text 0"] == [1]


def test_query(spark):
    rows = op8_toxicity_mil(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
