import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ludica.llm import language_id as L
from ludica.llm.queries import op6_language_spans


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return L.train(docs)


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(40):
        sizes = rng.integers(0, 6, size=5)
        at = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(size=(at[-1], 3)) * 3
        best = L.viterbi(scores, at, 2.0)
        for k in range(5):
            own = scores[at[k]:at[k + 1]]

            def value(path, own=own):
                return sum(own[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
            top = max(value(p) for p in itertools.product(range(3), repeat=len(own)))
            assert value(best[at[k]:at[k + 1]]) == pytest.approx(top)


def test_held_out_accuracy(spark, docs):
    got = op6_language_spans(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and 150 < len(held) < 350
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_predictions_do_not_depend_on_metadata(docs, model):
    moved = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    a = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs, model).collect()}
    b = {r["doc_id"] - 7: r["lang_pred"] for r in L.identify(moved, model).collect()}
    assert a == b


def test_mixed_text_has_spans(docs, model):
    longest = {r["lang"]: r["text"] for r in docs.orderBy(F.length("text")).where("n_chars between 400 and 900").collect()}
    (la, a), (lb, b) = sorted(longest.items())[:2]
    row = L.label(pa.array([f"{a} {b}"]), model)[0].as_py()
    assert {la, lb} <= {s["lang"] for s in row["spans"]}
    assert sum(s["words"] for s in row["spans"]) == len(f"{a} {b}".split())


def test_scripts_narrow_the_candidates(spark):
    texts = {"ru": "привет мир это простой текст", "el": "αυτό είναι ένα απλό κείμενο", "en": "this is a plain text of words"}
    rows = [(i, texts[k], k) for i, k in enumerate(list(texts) * 30)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.uses.sum() == 3
    pred = [r["lang_pred"] for r in L.label(pa.array(["zz привет", "είναι", "words", "日本", "123 !!", None, ""]), model).to_pylist()]
    assert pred[:3] == ["ru", "el", "en"] and pred[3] in texts and pred[4:] == ["und"] * 3


def test_odd_documents(spark, odd_docs, no_docs, rows_of, model):
    got = L.identify(odd_docs, model).collect()
    assert len(got) == len(rows_of) and all(r["lang_pred"] for r in got)
    assert L.identify(no_docs, model).collect() == []
    untrained = L.train(odd_docs)
    assert {r["lang_pred"] for r in L.identify(odd_docs, untrained).collect()} == {"und"}


@pytest.mark.parametrize("texts", [["123 456"], ["..."], ["½ ²"], ["Ⅷ ① ½"], ["", None, "7"]])
def test_batches_without_a_letter(model, texts):
    assert [r["lang_pred"] for r in L.label(pa.array(texts, pa.string()), model).to_pylist()] == ["und"] * len(texts)


def test_no_letter_in_the_table(spark, model):
    df = spark.createDataFrame([(1, "123 456"), (2, "..."), (3, None)], "doc_id long, text string").repartition(3)
    assert {r["lang_pred"] for r in L.identify(df, model).collect()} == {"und"}


def test_numerals_are_no_letters(model):
    """Numerals neither count as letters nor keep the letters beside them from counting."""
    both = L.label(pa.array(["the house ½ ² Ⅷ", "the house"]), model).to_pylist()
    assert both[0]["lang_pred"] == both[1]["lang_pred"] != "und"
    assert sum(s["letters"] for s in both[0]["spans"]) == sum(s["letters"] for s in both[1]["spans"]) == 8


def test_scores_against_a_plain_count(model):
    """The score of a word is the mean log-likelihood of its n-grams, counted one by one."""
    scores, letters = L.word_scores(["house", "42", "año"], model)
    for i, word in enumerate(["house", "", "año"]):
        grams = [b for n in L.NGRAMS for b in L.hashed_ngrams([f"<{word}>"] if word else [], (n,), L.BUCKETS)[1].tolist()]
        want = sum((model.weights[b] for b in grams), np.zeros(len(model.languages)))
        own = model.uses[L.SCRIPT_NAMES.index("Latin")] if word else np.ones(len(model.languages), bool)
        assert np.allclose(scores[i][own], want[own])
    assert letters.tolist() == [5, 0, 3]
