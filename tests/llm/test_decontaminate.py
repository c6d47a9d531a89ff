import random
import re

import pytest

from ludica.llm import decontaminate as D
from ludica.llm.queries import op10_decontaminate
from ludica.session import scratch_path


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(docs, items, threshold=0.8):
    out = []
    for doc_id, text in docs:
        own, best = shingles(text), {}
        for item_id, item in set(items):
            q = shingles(item)
            if q and len(q & own) >= threshold * len(q):
                best[item_id] = max(best.get(item_id, (0, 0, 0)), (len(q & own) / len(q), len(q), len(q & own)))
        out += [(doc_id, i, v[1], v[2]) for i, v in best.items()]
    return sorted(map(str, out))


def pairs(df):
    return sorted(str((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"])) for r in df.collect())


@pytest.fixture(scope="module")
def planted(spark):
    """Items of many lengths in documents: whole, cut, with words changed, split in two, in capitals."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((1, 4, 5, 6, 9, 10, 14, 15, 24, 25, 60, 200))]
    items += [(3, items[8][1]), (3, items[8][1]), (None, items[7][1]), (20, None), (21, "")]
    docs = [(None, None), (0, "")]
    for k in range(150):
        words = [word() for _ in range(rng.randrange(0, 400))]
        for _ in range(2):
            _, text = rng.choice(items[:12])
            own = text.split()
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = word()
            cut = rng.randrange(0, max(1, len(own) // 4))
            own = own[cut:] if rng.random() < 0.5 else own
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + rng.choice([",", "", "."]) for w in own]
        docs.append((k, " ".join(words)))
    return docs + docs[5:8], items


@pytest.mark.parametrize("chars", [200, 4_000_000])
def test_pairs_equal_brute_force(spark, planted, monkeypatch, chars):
    monkeypatch.setattr(D, "BLOCK_CHARS", chars)
    docs, items = planted
    got = D.contaminated_pairs(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                               spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert pairs(got) == want and len(want) > 100


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert pairs(op10_decontaminate(spark, d)) == want and want


def test_sketch_is_long_enough():
    for q in range(1, 400):
        assert D.sketch_size(q) > D.allowed_missing(q)


def test_odd_documents(spark, odd_docs, no_docs, rows_of):
    items = spark.createDataFrame([(0, "hello world"), (1, None), (None, "it s we ll they re 12")], "item_id long, text string")
    assert pairs(D.contaminated_pairs(odd_docs, items)) == brute(rows_of, [(0, "hello world"), (None, "it s we ll they re 12")])
    assert D.contaminated_pairs(no_docs, items).collect() == []
    assert D.contaminated_pairs(odd_docs, items.limit(0)).collect() == []
    kept = D.drop_contaminated(odd_docs, items)
    assert kept.dtypes == odd_docs.dtypes and kept.count() == len(rows_of) - 1
    assert D.drop_contaminated(odd_docs, items.limit(0)).count() == len(rows_of)


def brute_short(docs, items):
    """As ``brute``, and items of one to four words where they stand in one piece."""
    out = []
    for doc_id, text in docs:
        shown = f" {' '.join(re.findall(r'\w+', (text or '').lower()))} "
        for item_id, item in set(items):
            words = re.findall(r"\w+", (item or "").lower())
            if 0 < len(words) < 5 and f" {' '.join(words)} " in shown:
                out.append(str((doc_id, item_id, 1, 1)))
    return sorted(out + brute(docs, items))


@pytest.mark.parametrize("chars", [200, 4_000_000])
def test_short_items_equal_brute_force(spark, planted, monkeypatch, chars):
    monkeypatch.setattr(D, "BLOCK_CHARS", chars)
    docs, items = planted
    docs = [*docs, (900, "他说今天天气很好，我们去公园。"), (901, "今天天气很好我们去公园")]
    items = [*items, (30, "我们去公园"), (31, "...")]
    got = D.contaminated_pairs(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                               spark.createDataFrame(items, "item_id long, text string"), short_items=True)
    want = brute_short(docs, items)
    assert pairs(got) == want and len(want) > len(brute(docs, items)) + 10 and str((900, 30, 1, 1)) in want


def test_query_finds_a_short_item(spark):
    folder = scratch_path(spark, "test-short-items")
    spark.createDataFrame([(0, "so: One two, three FOUR."), (1, "one two four three")], "doc_id long, text string").write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame([(7, "one two three four")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert [(r["doc_id"], r["item_id"]) for r in op10_decontaminate(spark, folder).collect()] == [(0, 7)]


def test_ids_of_one_text_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_IDS", 20)
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    monkeypatch.setattr(D, "BATCH_PAIRS", 5)
    text = "one two three four five six"
    items = spark.createDataFrame([(i, text) for i in [*range(400), None]], "item_id long, text string")
    blocks = [b for b in D.benchmark_blocks(items) if b.ids]
    assert len(blocks) > 3 and max(sum(map(len, b.ids)) for b in blocks) < 200
    assert all(len(ids) <= 40 for b in blocks for ids in b.ids)
    docs = spark.createDataFrame([(5, "zero " + text), (6, text), (7, "no")], "doc_id long, text string")
    got = D.contaminated_pairs(docs, items).collect()
    assert sorted(str((r["doc_id"], r["item_id"])) for r in got) == sorted(str((d, i)) for d in (5, 6) for i in [*range(400), None])
