"""Operator 6: language identification of mixed-language text.

Every word is scored for every language (log-likelihood of its hashed
character n-grams, sizes 1 to 4). The script of its letters first narrows the
candidates to the languages that use the script. A Viterbi pass over a text's
words, with a penalty for each switch of language, labels spans; the document
takes the language that labels most letters, and its score is that share.

Training counts n-grams and scripts by language as grouped aggregates over
texts with a language that are not held out, at most about ``SAMPLE_DOCS`` of
each language (chosen by a hash of the doc_id). What reaches the driver is the
table of ``BUCKETS`` counts per language.

Defined cases: null texts and texts without letters are `und` with score 0;
words without letters belong to the span around them; a script that no
learned language uses leaves all candidates; of equal languages the first in
alphabetical order holds; without training rows every text is `und`; repeated
rows are labelled alike; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import (code_points, coded_words, hashed_ngrams, id_remainder, materialize, range_sums,
                               slices)

FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS = 6_000
BUCKETS = 1 << 16
NGRAMS = (1, 2, 3, 4)
#: A language uses a script that holds this share of its letters.
SCRIPT_SHARE = 0.02
#: Log-likelihood that a switch of language costs (the size of about three clear words).
SWITCH = 12.0
#: Words times languages that a Viterbi pass holds at a time (a longer text stays whole).
TABLE = 1 << 22
# The scripts and the first and last code points of their main ranges.
SCRIPTS = (
    ("Latin", 0x0041, 0x024F), ("Latin", 0x1E00, 0x1EFF), ("Greek", 0x0370, 0x03FF), ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF), ("Arabic", 0x0600, 0x077F),
    ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF), ("Tamil", 0x0B80, 0x0BFF), ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF), ("Hangul", 0x1100, 0x11FF), ("Ethiopic", 0x1200, 0x137F), ("Kana", 0x3040, 0x30FF),
    ("Han", 0x3400, 0x9FFF), ("Hangul", 0xAC00, 0xD7AF), ("Han", 0x20000, 0x2FA1F),
)
SCRIPT_NAMES = tuple(dict.fromkeys(s[0] for s in SCRIPTS)) + ("Other",)
_letters = regex.compile(r"\p{L}+").findall
_FIRST = np.array([s[1] for s in SCRIPTS])
_LAST = np.array([s[2] for s in SCRIPTS])
_NAME = np.array([SCRIPT_NAMES.index(s[0]) for s in SCRIPTS])


@dataclass
class Model:
    languages: list[str]
    #: log-likelihood of a bucket in each language, buckets x languages
    weights: np.ndarray
    #: scripts x languages: whether the language uses the script
    uses: np.ndarray


def scripts_of(words: list[str]) -> np.ndarray:
    """Letters of each script in each word (words x scripts)."""
    out = np.zeros((len(words), len(SCRIPT_NAMES)), np.int64)
    points, ends = code_points(words)
    if not len(points):
        return out
    points = points.astype(np.int64)
    at = np.searchsorted(_FIRST, points, "right") - 1
    script = np.where((at >= 0) & (points <= _LAST[at]), _NAME[at], len(SCRIPT_NAMES) - 1)
    np.add.at(out, (np.repeat(np.arange(len(words)), np.diff(ends, prepend=0)), script), 1)
    return out


def _stripped(chunks: list[str]) -> list[str]:
    """The letters of each chunk, lower-cased, runs joined by a space."""
    return [" ".join(_letters(c)).lower() for c in chunks]


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, kind, at, n): n-gram counts by bucket (kind 0) and letters by script (kind 1)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for piece in slices(batch):
                words = coded_words(piece.column("text"))
                stripped = _stripped(words.distinct.to_pylist())
                row, bucket = hashed_ngrams([f"<{w}>" if w else "" for w in stripped], NGRAMS, BUCKETS)
                letters = scripts_of([w.replace(" ", "") for w in stripped])
                langs = np.array(piece.column("lang").to_pylist(), dtype=object)
                owner = np.repeat(langs, np.diff(words.offsets))
                for lang in set(langs.tolist()):
                    times = np.bincount(words.codes[owner == lang], minlength=len(stripped))
                    total = seen.setdefault(lang, [np.zeros(BUCKETS), np.zeros(len(SCRIPT_NAMES))])
                    total[0] += np.bincount(bucket, times[row], BUCKETS)
                    total[1] += times @ letters
        for lang, kinds in seen.items():
            for kind, total in enumerate(kinds):
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), kind, np.int32)),
                     pa.array(at), pa.array(total[at].astype(np.int64))], names=["lang", "kind", "at", "n"])
    return (docs.mapInArrow(count, "lang string, kind int, at long, n long")
            .groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")))


def train(docs: DataFrame) -> Model:
    """Learn from the rows with a language that are not held out."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
            .where("lang is not null and text is not null")
            .where(F.coalesce(id_remainder("doc_id", FOLDS) != HELD_OUT, F.lit(False))))
    order = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30))
    by_lang = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not by_lang:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPT_NAMES), 0), bool))
    limit = F.lit(1 << 30)
    for lang, n in by_lang.items():
        limit = F.when(F.col("lang") == lang, F.lit(int(min(1.0, SAMPLE_DOCS / n) * (1 << 30)))).otherwise(limit)
    counts = materialize(_counts(rows.where(order < limit).select("text", "lang")), "language-counts")
    languages = sorted(by_lang)
    grams = np.zeros((BUCKETS, len(languages)))
    letters = np.zeros((len(SCRIPT_NAMES), len(languages)))
    for r in counts.collect():
        (letters if r["kind"] else grams)[r["at"], languages.index(r["lang"])] = r["n"]
    smooth = grams + 0.5
    weights = np.log(smooth / smooth.sum(axis=0)) / len(NGRAMS)
    return Model(languages, weights, letters >= SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0)))


def word_scores(chunks: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(log-likelihoods, letters) of each chunk; all zero without letters."""
    stripped = _stripped(chunks)
    row, bucket = hashed_ngrams([f"<{w}>" if w else "" for w in stripped], NGRAMS, BUCKETS)
    scores = np.stack([np.bincount(row, model.weights[bucket, k], len(chunks))
                       for k in range(len(model.languages))], axis=1).astype(float)  # counts of nothing are whole numbers
    letters = scripts_of([w.replace(" ", "") for w in stripped])
    n = letters.sum(axis=1)
    allowed = model.uses[letters.argmax(axis=1)]
    allowed[~allowed.any(axis=1) | (n == 0)] = True
    scores[~allowed] -= 1e6
    return scores, n


def viterbi(scores: np.ndarray, offsets: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word of every list (lists of word scores).

    All lists advance together, the longest first, so that each step is one
    numpy operation over the lists that still have words.
    """
    sizes = np.diff(offsets)
    best = np.zeros(len(scores), np.int16)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        longest = int(sizes[order[at]])
        group = order[at:at + max(1, TABLE // (longest * scores.shape[1]))]
        at += len(group)
        begins, n = offsets[group], sizes[group]
        active = np.searchsorted(-n, -np.arange(1, longest + 1), "right")
        back = np.zeros((longest, len(group), scores.shape[1]), np.int16)
        total = scores[begins].copy()
        own = np.arange(scores.shape[1])
        for t in range(1, longest):
            a = active[t]
            live = total[:a]
            top = live.argmax(axis=1)
            over = live[np.arange(a), top] - switch
            stay = live >= over[:, None]
            back[t, :a] = np.where(stay, own, top[:, None])
            total[:a] = np.where(stay, live, over[:, None]) + scores[begins[:a] + t]
        state = total.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            a = active[t]
            best[begins[:a] + t] = state[:a]
            if t:
                state[:a] = back[t, np.arange(a), state[:a]]
    return best


LABEL = "lang_pred string, score double, spans array<struct<lang: string, first_word: int, words: int, letters: int>>"
_LABEL = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()),
                    ("spans", pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()),
                                                  ("words", pa.int32()), ("letters", pa.int32())])))])


def label(texts: pa.Array, model: Model) -> pa.Array:
    """Language, score and spans of each text, as a struct array of LABEL."""
    und = {"lang_pred": "und", "score": 0.0, "spans": []}
    words = coded_words(texts)
    if not model.languages or not len(words.codes):
        return pa.array([und] * len(texts), _LABEL)
    scores, n = word_scores(words.distinct.to_pylist(), model)
    letters = n[words.codes]
    best = viterbi(scores[words.codes], words.offsets)
    per = np.stack([range_sums(np.where(best == k, letters, 0), words.offsets)
                    for k in range(len(model.languages))], axis=1)
    total = per.sum(axis=1)
    begins = np.ones(len(best), bool)
    begins[1:] = best[1:] != best[:-1]
    begins[words.offsets[:-1][np.diff(words.offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    held = range_sums(letters, np.append(starts, len(best)))
    cuts = np.searchsorted(starts, words.offsets)
    ends = np.append(starts[1:], len(best))
    rows = []
    for k in range(len(texts)):
        if not total[k]:
            rows.append(und)
            continue
        top = int(per[k].argmax())
        rows.append({"lang_pred": model.languages[top], "score": float(per[k, top] / total[k]),
                     "spans": [{"lang": model.languages[best[starts[j]]], "first_word": int(starts[j] - words.offsets[k]),
                                "words": int(ends[j] - starts[j]), "letters": int(held[j])}
                               for j in range(cuts[k], cuts[k + 1])]})
    return pa.array(rows, _LABEL)


def language(text: Column, model) -> Column:
    """The label of a text column by a (broadcast) model."""
    @F.arrow_udf(LABEL)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [label(s.column("text"), model.value)
                     for s in slices(pa.RecordBatch.from_arrays([texts], names=["text"]))]
            yield pa.concat_arrays(parts) if parts else pa.array([], _LABEL)
    return find(text)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans of every document (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select("doc_id", language(F.col("text").cast("string"), shared).alias("_l"))
            .select("doc_id", (id_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "_l.*"))
