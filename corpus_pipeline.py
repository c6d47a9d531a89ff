"""A training corpus from raw documents: the stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet under spark.checkpoint.dir and hands what it reads back to the
next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ludica.llm import byte_bpe, decontaminate, quality_rules, simhash, toxicity
from ludica.llm.common import materialize, read_table
from ludica.session import ship_code


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands."""
    ship_code(spark)
    return quality_rules.keep_good(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a model of the labelled ones among them."""
    ship_code(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each SimHash component."""
    ship_code(spark)
    return simhash.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ship_code(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), short_items=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the ids (little-endian unsigned 32-bit) of every document."""
    ship_code(spark)
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality), ("toxicity", toxic), ("simhash_dedup", near_duplicates),
          ("decontamination", decontamination), ("byte_bpe", tokens)]

#: The compression ratios, the trained model and BPE have no SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
