"""Operator 8: toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability (logistic in
its features), the document's is their noisy-or, 1 - prod(1 - p). Only document
labels are known in training; the fitted model then points at the sentences.

Features are hashed character n-grams (4 to 6, words with < and > around,
lower-cased), taken from the distinct words of a sentence. Training is four small steps over a
bounded sample of the labelled documents (``SAMPLE_DOCS``, chosen by a hash of
the doc_id): document frequencies of every feature by label, summed as a
grouped aggregate; the ``FEATURES`` that speak most clearly for label 1; the
sampled documents reduced to counts of those; and a full-batch fit of the
noisy-or likelihood in one task, whose input the two bounds keep small.
Scoring reads every whole text, once, with the model broadcast.

Sentences end at line feeds and at words that end in . ! or ? (closing quotes
and brackets may follow).

Defined cases: null and wordless texts have no sentences and score 0; label
rows with a null id or label are passed over, and of several labels of an id
the larger one holds; repeated documents score alike, and an id that occurs
more than once trains by its smallest text; without any labelled
rows of both kinds every document scores 0; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import (coded_words, hashed_ngrams, id_remainder, materialize, ragged_take, range_sums,
                               slices)

HOLD_OUT = 5
SAMPLE_DOCS = 12_000
BUCKETS = 1 << 18
FEATURES = 2_048
#: A feature has to occur in this many sampled documents.
LEAST_DOCS = 6
NGRAMS = (4, 5, 6)
STEPS = 400
_ends = re.compile(r"[.!?][\"'\)\]\}»”’]*$").search
_edges = re.compile(r"^\W+|\W+$")


@dataclass
class Model:
    """Weights of the selected buckets; ``slot`` maps a bucket to its weight, -1 to none."""

    slot: np.ndarray
    weights: np.ndarray
    bias: float


class Sentences:
    """The sentences of some texts, with the counts of features in each."""

    def __init__(self, texts: pa.Array):
        lines = pc.split_pattern(pc.fill_null(texts.cast(pa.string()), ""), "\n")
        line_offsets = np.asarray(lines.offsets, dtype=np.int64)
        words = coded_words(lines.flatten())
        self.distinct, self.codes = words.distinct, words.codes
        shown = words.distinct.to_pylist()
        stops = np.fromiter((_ends(w) is not None for w in shown), bool, len(shown))
        # a sentence begins at a line's first word and after a stop
        begins = np.zeros(len(words.codes) + 1, bool)
        begins[1:] = stops[words.codes]
        begins[words.offsets] = True
        self.starts = np.flatnonzero(begins[:-1])
        self.bounds = np.append(self.starts, len(words.codes))
        text_words = words.offsets[line_offsets - line_offsets[0]]
        self.text_words = text_words
        self.text_sentences = np.searchsorted(self.starts, text_words)
        self._shown = shown

    def word_features(self, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
        """(distinct word, bucket) of every n-gram of every distinct word."""
        return hashed_ngrams([f"<{_edges.sub('', w).lower()}>" for w in self._shown], NGRAMS, buckets)

    def word_logits(self, model: Model) -> np.ndarray:
        word, bucket = self.word_features()
        slot = model.slot[bucket]
        known = slot >= 0
        return np.bincount(word[known], model.weights[slot[known]], len(self._shown))

    def once(self) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, distinct word) pairs: a word counts once in a sentence."""
        sentence = np.repeat(np.arange(len(self.starts)), np.diff(self.bounds))
        pairs = np.unique(sentence * len(self._shown) + self.codes) if len(self.codes) else self.codes
        return np.divmod(pairs, max(1, len(self._shown)))

    def probabilities(self, model: Model) -> np.ndarray:
        sentence, word = self.once()
        z = model.bias + np.bincount(sentence, self.word_logits(model)[word], len(self.starts))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def noisy_or(self, p: np.ndarray) -> np.ndarray:
        return -np.expm1(range_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), self.text_sentences))


def _sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label) of the training rows: not held out, at most about
    SAMPLE_DOCS, one row a doc_id (its smallest text) however often it occurs."""
    known = (labels.where("doc_id is not null and toxic is not null")
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(id_remainder("doc_id", HOLD_OUT) != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("label")))
    known = materialize(known, "toxicity-labels")
    rows = known.count()
    rate = min(1.0, SAMPLE_DOCS / max(rows, 1))
    order = F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1 << 30))
    chosen = materialize(known.where(order < int(rate * (1 << 30))), "toxicity-chosen")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return materialize(one.select("text", "label"), "toxicity-sample")


def _frequencies(rows: DataFrame) -> DataFrame:
    """bucket, label, documents with a feature in the bucket; bucket -1: all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for piece in slices(batch):
                label = (piece.column("label").to_numpy(zero_copy_only=False) > 0).astype(np.int64)
                s = Sentences(piece.column("text"))
                word, bucket = s.word_features()
                order = np.argsort(word, kind="stable")
                of_words = bucket[order]
                per_word = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(s.distinct)))])
                for k, y in enumerate(label):
                    own = np.unique(s.codes[s.text_words[k]:s.text_words[k + 1]])
                    found, _ = ragged_take(of_words, per_word, own)
                    seen[y, np.unique(found)] += 1
                    seen[y, BUCKETS] += 1
        y, at = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(at == BUCKETS, -1, at)), pa.array(y), pa.array(seen[y, at])],
            names=["bucket", "label", "docs"])
    return (rows.mapInArrow(count, "bucket long, label long, docs long")
            .groupBy("bucket").agg(F.sum(F.when(F.col("label") == 1, F.col("docs")).otherwise(0)).alias("toxic"),
                                   F.sum(F.when(F.col("label") == 0, F.col("docs")).otherwise(0)).alias("clean")))


def fit_noisy_or(doc: np.ndarray, sentence: np.ndarray, slot: np.ndarray, sizes: np.ndarray, labels: np.ndarray,
                 features: int, steps: int = STEPS, rate: float = 0.2, penalty: float = 2e-4) -> tuple[np.ndarray, float]:
    """Maximum likelihood weights and bias of the noisy-or model.

    ``doc``/``sentence``/``slot``: one entry per occurrence of a selected
    feature, the sentences numbered over all documents; ``sizes``: sentences
    of each document. Sentences without a feature enter by their number.
    Full-batch Adam with an L2 penalty.
    """
    n = len(labels)
    keys, row = np.unique(sentence, return_inverse=True)
    owner = np.zeros(len(keys), np.int64)
    owner[row] = doc
    bare = sizes - np.bincount(owner, minlength=n)
    theta = np.zeros(features + 1)
    theta[-1] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, b = theta[:-1], theta[-1]
        z = np.clip(b + np.bincount(row, w[slot], len(keys)), -30, 30)
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-np.clip(b, -30, 30)))
        none = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), n) + bare * np.log1p(-p0)
        # d loss / d z of a sentence is p for label 0, and -p (1 - P) / P for label 1
        pull = np.where(labels > 0, -np.exp(none) / np.maximum(-np.expm1(none), 1e-9), 1.0) / n
        gz = p * pull[owner]
        g = np.empty_like(theta)
        g[:-1] = np.bincount(slot, gz[row], features) + penalty * w
        g[-1] = gz.sum() + p0 * (bare * pull).sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit the model on (a bounded sample of) the labelled, not held out documents."""
    rows = _sampled(docs, labels)
    counts = materialize(_frequencies(rows), "toxicity-frequencies")
    empty = Model(np.full(BUCKETS, -1, np.int32), np.zeros(0), -60.0)
    total = counts.where("bucket = -1").first()
    if total is None or not total["toxic"] or not total["clean"]:
        return empty
    n1, n0 = total["toxic"], total["clean"]
    p1, p0 = (F.col("toxic") + 0.5) / (n1 + 1), (F.col("clean") + 0.5) / (n0 + 1)
    score = (p1 - p0) / F.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)
    chosen = (counts.where((F.col("bucket") >= 0) & (F.col("toxic") + F.col("clean") >= LEAST_DOCS) & (p1 > 2 * p0))
              .select("bucket", score.alias("score")).orderBy(F.desc("score"), "bucket").limit(FEATURES).collect())
    if not chosen:
        return empty
    slot = np.full(BUCKETS, -1, np.int32)
    slot[[r["bucket"] for r in chosen]] = np.arange(len(chosen))
    shared = docs.sparkSession.sparkContext.broadcast(slot)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                s = Sentences(piece.column("text"))
                word, bucket = s.word_features()
                to = shared.value[bucket]
                word, to = word[to >= 0], to[to >= 0]
                order = np.argsort(word, kind="stable")
                per_word = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(s.distinct)))])
                sentence, own = s.once()
                found, ends = ragged_take(to[order], per_word, own)
                of = np.repeat(sentence, np.diff(ends))
                cut = np.searchsorted(of, s.text_sentences)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("label").cast(pa.int32()), pa.array(np.diff(s.text_sentences)),
                     pa.array([(of[a:b] - f).astype(np.int32).tobytes() for a, b, f in
                               zip(cut, cut[1:], s.text_sentences)], pa.binary()),
                     pa.array([found[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                    names=["label", "sentences", "at", "slot"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, sizes, docs_, at, slots, n, base = [], [], [], [], [], 0, 0
        for batch in batches:
            for y, size, a, f in zip(*(batch.column(c).to_pylist() for c in ("label", "sentences", "at", "slot"))):
                a = np.frombuffer(a, np.int32)
                labels.append(y > 0)
                sizes.append(size)
                docs_.append(np.full(len(a), n))
                at.append(base + a.astype(np.int64))
                slots.append(np.frombuffer(f, np.int32))
                n, base = n + 1, base + size
        if n:
            weights, bias = fit_noisy_or(np.concatenate(docs_), np.concatenate(at), np.concatenate(slots),
                                         np.array(sizes), np.array(labels), len(chosen))
            yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()]), pa.array([bias])], names=["weights", "bias"])

    reduced = materialize(rows.mapInArrow(reduce, "label int, sentences long, at binary, slot binary"), "toxicity-rows")
    # one order of the rows, so that a repeated fit gives the same weights
    one = reduced.repartition(1).sortWithinPartitions("label", "sentences", F.xxhash64("at", "slot"))
    found = one.mapInArrow(fit, "weights array<double>, bias double").first()
    return Model(slot, np.array(found["weights"]), found["bias"])


def offending(text: str, s: Sentences, p: np.ndarray, k: int) -> list[dict]:
    """The sentences of text ``k`` with probability 0.5 or more, as code point ranges."""
    hits = [i for i in range(s.text_sentences[k], s.text_sentences[k + 1]) if p[i] >= 0.5]
    if not hits:
        return []
    words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    first = s.text_words[k]
    return [{"start": words[s.bounds[i] - first][0], "end": words[s.bounds[i + 1] - first - 1][1], "p": float(p[i])}
            for i in hits]


SCORE = "score double, n_sentences int, offending array<struct<start: int, end: int, p: double>>"
_SCORE = pa.struct([("score", pa.float64()), ("n_sentences", pa.int32()),
                    ("offending", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))])


def toxicity(text: Column, model) -> Column:
    """Score and offending sentences of a text column, by a (broadcast) model."""
    @F.arrow_udf(SCORE)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for piece in slices(pa.RecordBatch.from_arrays([texts], names=["text"])):
                own = piece.column("text")
                s = Sentences(own)
                p = s.probabilities(model.value)
                total, n = s.noisy_or(p), np.diff(s.text_sentences)
                bad = range_sums((p >= 0.5).astype(np.int64), s.text_sentences)
                rows += [{"score": float(total[k]), "n_sentences": int(n[k]),
                          "offending": offending(own[k].as_py(), s, p, k) if bad[k] else []}
                         for k in range(len(own))]
            yield pa.array(rows, _SCORE)
    return score(text)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, offending of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select("doc_id", toxicity(F.col("text").cast("string"), shared).alias("_t"))
            .select("doc_id", (id_remainder("doc_id", HOLD_OUT) == 0).alias("held_out"), F.col("_t.score"),
                    (F.col("_t.score") >= 0.5).cast("int").alias("predicted"), "_t.n_sentences", "_t.offending"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.select(row.alias("_row"), toxicity(F.col("text").cast("string"), shared).alias("_t"))
            .where("_t.score < 0.5").select("_row.*"))
