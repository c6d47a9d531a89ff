import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from ludica.llm import byte_bpe as B, common
from ludica.llm.queries import op9_byte_bpe

PATTERN = public_tokenizers.PATTERN
TOKENS = B.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})
SPACING = ["a  b", "a   b", " a \n b ", "\n\nx", " ", "  \n  a", "x\x1cy \x1cz", "a  b", "a \t b\n", "it's  we'll\t\tx"]


def digest(doc_id, text):
    ids = LIBRARY.encode_ordinary(text or "")
    return str((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest()))


def run(docs):
    return sorted(str(tuple(r)) for r in B.digests(B.encode(docs, TOKENS, PATTERN), TOKENS).collect())


def test_pre_tokens_equal_the_pattern(odd_texts):
    texts = odd_texts + SPACING
    found, counts = B.pre_tokens(pa.array(texts), regex.compile(PATTERN))
    shown = found.distinct.to_pylist()
    assert counts.sum() == len(found.codes)
    for k, text in enumerate(texts):
        assert [shown[i] for i in found.codes[found.offsets[k]:found.offsets[k + 1]]] == regex.findall(PATTERN, text or ""), repr(text)


@pytest.mark.parametrize("size", [50, 8 << 20])
def test_round_trip(spark, odd_docs, rows_of, monkeypatch, size):
    monkeypatch.setattr(common, "SLICE_BYTES", size)
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(SPACING * 2)], "doc_id long, text string")
    docs = odd_docs.unionByName(extra, allowMissingColumns=True)
    assert run(docs) == sorted(digest(i, t) for i, t in rows_of + [(100 + i, t) for i, t in enumerate(SPACING * 2)])


def test_decode_gives_the_texts_back(odd_docs, rows_of):
    got = B.decode(B.encode(odd_docs, TOKENS, PATTERN), TOKENS).collect()
    assert sorted(str((r["doc_id"], bytes(r["bytes"]))) for r in got) == sorted(str((i, (t or "").encode())) for i, t in rows_of)


def test_pre_tokens_of_random_texts():
    import random
    rng = random.Random(4)
    texts = ["".join(rng.choice("aB1 \n'stveld,.!éÀßªº²×÷µ\t\xa0\x85\x00\u3000ж ") for _ in range(rng.randrange(0, 30))) for _ in range(3000)]
    texts += ["".join(rng.choice("aB1 \n'stveld,.!éÀßªº²×÷µ") for _ in range(rng.randrange(0, 12))) for _ in range(3000)]
    found, _ = B.pre_tokens(pa.array(texts), regex.compile(PATTERN))
    shown = found.distinct.to_pylist()
    for k, text in enumerate(texts):
        assert [shown[i] for i in found.codes[found.offsets[k]:found.offsets[k + 1]]] == regex.findall(PATTERN, text), repr(text)


def test_query(spark, small_docs):
    got = sorted(str(tuple(r)) for r in op9_byte_bpe(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(digest(r["doc_id"], r["text"]) for r in small_docs.collect())


def test_empty(no_docs):
    assert run(no_docs) == []


def test_changed_input_is_refused(spark, small_docs):
    """Rows that differ between the passes never give wrong ids."""
    import random
    changing = F.udf(lambda t: f"{t} {random.random()}", "string").asNondeterministic()
    with pytest.raises(Exception, match="changed between two passes"):
        B.encode(small_docs.withColumn("text", changing("text")), TOKENS, PATTERN).collect()
