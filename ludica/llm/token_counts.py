"""Operator 5: token counts by a count-only Viterbi pass.

The pieces of a tokenizer model with their scores form a unigram vocabulary;
a text's count is the number of pieces of its best-scoring segmentation. An
Aho-Corasick automaton enumerates the pieces that end at each character, the
dynamic program carries only (best score, pieces), and nothing is ever
backtracked.

Tie rules of the tokenizers library's unigram model: pieces that end at the
same place are tried from the earliest start, and a later one only replaces
the best if its score is strictly greater. A character that no piece of its
own covers may stand alone as unknown, for the lowest score of the vocabulary
less 10, tried last; unknown characters count as their UTF-8 bytes where the
vocabulary has byte pieces, else a run of them counts as one piece. Scores add
up in double precision; those of the given model are whole numbers, so sums
are exact and a text may be cut wherever no piece reaches across.

Every distinct segment (a run of spaces and what follows up to the next
space) of a slice is counted once and the counts are added up per text.

Defined cases: null and empty texts have no pieces; control and byte pieces
of the vocabulary never match text; repeated rows are counted each; an empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludica.llm.common import range_sums, slices

UNKNOWN_PENALTY = 10.0
SPACE = "▁"
_segments = re.compile(" +[^ ]*|[^ ]+").findall


def load_pieces(path: str) -> tuple[list[tuple[str, float]], float, bool]:
    """(matching pieces with scores, lowest score, byte pieces present) of a
    sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in ids
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return pieces, min(model.get_score(i) for i in ids), any(model.is_byte(i) for i in ids)


class Counter:
    """Counts the pieces of segments for one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], lowest: float, byte_pieces: bool):
        self._automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self._automaton.add_word(piece, (len(piece), score))
        self._automaton.make_automaton()
        self._unknown = lowest - UNKNOWN_PENALTY
        self._bytes = byte_pieces
        #: whether a segmentation may be cut where a run of spaces begins, and unknown runs too
        self.separable = byte_pieces and not any(SPACE in p.lstrip(SPACE) for p, _ in pieces)

    def best(self, text: str) -> tuple[float, int]:
        """(score, pieces) of the best segmentation of a normalised text."""
        n = len(text)
        score, pieces = [0.0] * (n + 1), [0] * (n + 1)
        loose = [False] * (n + 1)  # whether the best way here ends in an unknown character
        reached, covered = 0, False
        unknown, of_bytes = self._unknown, self._bytes

        def close(end: int) -> None:
            # all pieces that end here are tried; the lone character comes last
            nonlocal reached, covered
            begun = reached < end
            if not covered:
                value = score[end - 1] + unknown
                if begun or value > score[end]:
                    score[end] = value
                    pieces[end] = pieces[end - 1] + (len(text[end - 1].encode("utf-8", "surrogatepass")) if of_bytes
                                                     else not loose[end - 1])
                    loose[end] = True
            reached, covered = end, False

        done = 0
        fresh = True
        for last, (length, value) in self._automaton.iter(text):
            end = last + 1
            while done < end - 1:
                done += 1
                close(done)
                fresh = True
            value += score[end - length]
            if fresh or value > score[end]:
                score[end], pieces[end], loose[end] = value, pieces[end - length] + 1, False
                reached, fresh = end, False
            covered |= length == 1
        while done < n:
            done += 1
            close(done)
        return score[n], pieces[n]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, score) of each raw text; a space marker is put in front."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.separable:
            found = [self.best(SPACE + t.replace(" ", SPACE)) if t else (0.0, 0) for t in texts.to_pylist()]
            return np.array([f[1] for f in found], np.int64), np.array([f[0] for f in found])
        odd = pc.match_substring_regex(texts, "^ |  | $").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        distinct = lists.flatten().dictionary_encode()
        codes = distinct.indices.to_numpy(zero_copy_only=False)
        known: dict[str, tuple[float, int]] = {}

        def segment(s: str) -> tuple[float, int]:
            if (found := known.get(s)) is None:
                found = known[s] = self.best(s)
            return found

        per = np.array([self.best(SPACE + s) for s in distinct.dictionary.to_pylist()] or np.zeros((0, 2)))
        sums = range_sums(per[codes], offsets - offsets[0])
        pieces, score = sums[:, 1].astype(np.int64), sums[:, 0]
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        pieces[empty], score[empty] = 0, 0.0
        marked = pc.match_substring(texts, SPACE).to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(marked):  # a marker of the text's own may join what a cut would part
            score[k], pieces[k] = self.best(SPACE + texts[k].as_py().replace(" ", SPACE))
        for k in np.flatnonzero(odd & ~marked):
            found = [segment(s.replace(" ", SPACE)) for s in _segments(" " + texts[k].as_py())]
            pieces[k], score[k] = sum(f[1] for f in found), sum(f[0] for f in found)
        return pieces, score


def counted(text: Column, vocabulary) -> Column:
    """n_pieces and score of a text column, by a (broadcast) vocabulary."""
    @F.arrow_udf("n_pieces long, score double")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(*vocabulary.value)
        for texts in batches:
            found = [counter.texts(s.column("text"))
                     for s in slices(pa.RecordBatch.from_arrays([texts], names=["text"]))]
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate([f[0] for f in found]) if found else [], pa.int64()),
                 pa.array(np.concatenate([f[1] for f in found]) if found else [], pa.float64())], ["n_pieces", "score"])
    return count(text)


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_pieces and score of every document (doc_id, text)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    return (docs.select("doc_id", counted(F.col("text").cast("string"), vocabulary).alias("_c"))
            .select("doc_id", "_c.*"))
