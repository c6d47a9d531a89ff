import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer, models

from ludica.llm import token_counts as C
from ludica.llm.queries import op5_viterbi_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    """The tokenizers library's unigram model over the same pieces and scores."""
    m = sentencepiece.SentencePieceProcessor(model_file=PATH)
    t = Tokenizer(models.Unigram([(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())], 0, True))
    return lambda text: len(t.encode("▁" + text.replace(" ", "▁")).ids) if text else 0


def plain(text):
    # strings of control pieces in a text match in the library's model only
    return text is None or not any(s in text for s in ("<s>", "</s>", "<unk>"))


def test_counts_equal_the_library(library, odd_texts):
    texts = [t for t in odd_texts if plain(t)] + ["a  b   c ", "    ", "aaaa    bbbb", "日本 語\n\n x"]
    pieces, _ = C.Counter(*C.load_pieces(PATH)).texts(pa.array(texts))
    assert pieces.tolist() == [library(t) for t in texts]


def test_query(spark, library, small_docs):
    want = {r["doc_id"]: library(r["text"]) for r in small_docs.collect()}
    assert {r["doc_id"]: r["n_pieces"] for r in op5_viterbi_counts(spark, "/root/testdata/sf0.001").collect()} == want


def test_odd_documents(odd_docs, rows_of, no_docs, library):
    got = C.token_counts(odd_docs, PATH).collect()
    want = sorted(str((i, library(t or ""))) for i, t in rows_of if plain(t))
    assert len(got) == len(rows_of) and set(want) <= {str((r["doc_id"], r["n_pieces"])) for r in got}
    assert C.token_counts(no_docs, PATH).collect() == []


def test_ties_and_unknowns_equal_the_library():
    """Random small vocabularies with many equal scores, without byte pieces."""
    rng = random.Random(0)
    for _ in range(60):
        words = {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 4))) for _ in range(6)} - {"<unk>"}
        vocab = [("<unk>", 0.0)] + [(w, -float(rng.randrange(1, 4))) for w in sorted(words)]
        library = Tokenizer(models.Unigram(vocab, 0, False))
        counter = C.Counter(vocab[1:], min(s for _, s in vocab), False)
        for _ in range(10):
            text = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 12)))
            normal = "▁" + text.replace(" ", "▁")
            assert counter.best(normal)[1] == len(library.encode(normal).ids), (vocab, normal)


def test_markers_in_the_text(library):
    """A literal U+2581 beside spaces: the smallest case, and random ones."""
    rng = random.Random(4)
    texts = ["▁ ", "▁", " ▁", "a▁ b", "▁▁ a", "a ▁b"] + ["".join(rng.choice("▁ ab▁  é") for _ in range(rng.randrange(1, 14))) for _ in range(2000)]
    pieces, _ = C.Counter(*C.load_pieces(PATH)).texts(pa.array(texts))
    assert pieces.tolist() == [library(t) for t in texts]
