import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ludica.llm import byte_bpe, decontaminate, toxicity
from tests.llm.test_decontaminate import brute as leaked
from tests.llm.test_quality_rules import brute as quality
from tests.llm.test_simhash import brute_classes, brute_print

DIR = "/root/testdata/sf0.01"


def test_stages_follow_each_other(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "simhash_dedup", "decontamination", "byte_bpe"]


def test_run_equals_brute_force(spark):
    table = lambda name: spark.read.parquet(f"{DIR}/{name}.parquet")
    docs = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    kept = {i: t for i, t in docs.items() if quality(t)[-1]}
    model = toxicity.train(table("documents").where(F.col("doc_id").isin(list(kept))), table("labels"))
    from tests.llm.test_toxicity import brute_score
    kept = {i: t for i, t in kept.items() if brute_score(t, model) < 0.5}
    rows = sorted((i, brute_print(t)) for i, t in kept.items())
    kept = {i: kept[i] for (i, _), c in zip(rows, brute_classes(rows)) if i == c}
    items = [tuple(r) for r in table("benchmark").select("item_id", "text").collect()]
    kept = {i: t for i, t in kept.items() if not leaked([(i, t)], items)}
    tokens = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DIR).collect()}
    assert got.keys() == kept.keys() and 500 < len(kept) < len(docs)
    for i, text in kept.items():
        ids = library.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids) and bytes(got[i]["ids"]) == b"".join(x.to_bytes(4, "little") for x in ids)


def test_stages_on_odd_documents(spark, odd_docs, no_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, odd_docs, DIR)
        assert docs.dtypes == odd_docs.dtypes and docs.count() <= odd_docs.count(), name
        assert stage(spark, no_docs, DIR).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs, DIR).count() == odd_docs.count()
    assert decontaminate.THRESHOLD == 0.8
