import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ludica.llm import token_output as T
from ludica.llm.queries import END_ID, op1_token_files
from ludica.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [END_ID]


def expected(rows):
    """Rows in doc_id order (null first, ties in any order) with their digests."""
    out = []
    for doc_id, text in rows:
        ids = np.array(reference(text), "<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return out


@given(st.integers(1, 32), st.lists(st.integers(0, 2 ** 32 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_pack_round_trip(bits, values):
    ids = np.array(values, np.uint32) & np.uint32((1 << bits) - 1)
    data = T.pack(ids, bits)
    assert len(data) == -(-len(ids) // 64) * bits * 8 and (T.unpack(data, bits, len(ids)) == ids).all()


def test_fewest_bits():
    assert [T.bits_for(n) for n in (1, 2, 3, 256, 257, 49408, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def test_word_bpe_equals_the_library(odd_texts):
    ids, at = T.WordBpe(open(PATH, encoding="utf-8").read())(pa.array(odd_texts))
    for k, text in enumerate(odd_texts):
        assert ids[at[k]:at[k + 1]].tolist() == reference(text)[:-1], text


def test_random_access(tmp_path):
    rng = np.random.default_rng(0)
    docs = [(i if i % 3 else None, rng.integers(0, 50000, n).astype(np.uint32)) for i, n in enumerate((0, 1, 5000, 64, 0, 9000))]
    path = str(tmp_path / "x.ltok")
    T.write_file(path, 16, docs, block_ids=128)
    whole = np.concatenate([d[1] for d in docs])
    with T.TokenFile(path) as f:
        assert f.doc_ids == [d[0] for d in docs]
        for a, b in ((0, 10), (127, 129), (5000, 5001), (0, len(whole)), (14000, 99999), (3, 3)):
            assert (f.ids(a, b) == whole[a:b]).all()
        for k, (_, ids) in enumerate(docs):
            assert (f.document(k) == ids).all()
        assert [d[2] for d in f.digests(window=100)] == [len(d[1]) for d in docs]
        assert [d[3] for d in f.digests(window=100)] == [zlib.crc32(d[1].astype("<u4").tobytes()) for d in docs]


@pytest.mark.parametrize("file_ids", [200, 1 << 22])
def test_files_in_order(spark, odd_docs, rows_of, monkeypatch, file_ids):
    monkeypatch.setattr(T, "FILE_IDS", file_ids)
    folder = scratch_path(spark, "test-tokens")
    manifest = T.tokenize_to_files(odd_docs, PATH, END_ID, folder)
    got = T.read_digests(manifest).collect()
    assert sorted(map(str, ((r[0], r[2], r[3]) for r in got))) == sorted(map(str, expected(rows_of)))
    got.sort(key=lambda r: (r["start"], r["n_tokens"]))
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_empty_table(spark, no_docs):
    assert T.read_digests(T.tokenize_to_files(no_docs, PATH, END_ID)).collect() == []


def test_query(spark, small_docs):
    got = {r["doc_id"]: r for r in op1_token_files(spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for doc_id, n, crc in expected(sorted((r["doc_id"], r["text"]) for r in small_docs.collect())):
        assert (got[doc_id]["start"], got[doc_id]["n_tokens"], got[doc_id]["ids_crc32"]) == (start, n, crc)
        start += n


ADDED = ["one two<|endoftext|>three <|startoftext|> four", "<|endoftext|>", " a.<|endoftext|> B's  x, ", "<|ENDOFTEXT|> <|EndOfText|>",
         "日<|ENDOFTEXT|>本 É", "日本<|startoftext|>語 é", "<|endoftext|><|endoftext|>", "< |endoftext|>", "plain words"]


def by_default(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_added_tokens_as_the_library_by_default(odd_texts):
    texts = [*ADDED, *odd_texts]
    ids, at = T.WordBpe(open(PATH, encoding="utf-8").read(), added_tokens=True)(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == by_default(text), text


def test_query_takes_added_tokens(spark):
    folder = scratch_path(spark, "test-added")
    spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in op1_token_files(spark, folder).collect())
    want, start = [], 0
    for k, text in enumerate(ADDED):
        ids = np.array([*by_default(text), END_ID], "<u4")
        want.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
