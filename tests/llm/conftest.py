import random

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
WORDS = "the of and to in hand word river stone light table green house water paper north seven".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", ","]) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_texts():
    """Texts with every oddity the operators define: null, empty, blank, one
    very long, other scripts, special strings, odd spacing."""
    rng = random.Random(5)
    long = "\n".join(prose(rng, 60) for _ in range(400))
    return [None, "", " ", "\n\n", "a", "Hello  world\n", "  lead and trail  ", "tab\there\x0bvt\x0cff\r\n", "日本語 テキスト です。",
            "Привет мир, это текст.", "naïve café élan ÀÉ ß", "é combining", "\U0001f600 smile", "<|endoftext|> and <s> </s>",
            "It's we'LL they're 12 ab12 3.5%", "a\x1cb\x85c d　e", "x" * 5000, "## ** $$ %% && || << >>",
            prose(rng, 80), prose(rng, 80), "same words " * 60, long]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts with repeated rows, null ids, and columns whose names
    operators use themselves."""
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(3, odd_texts[18]), (3, odd_texts[18]), (None, "no id here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("score", "fp", "block", "_row", "ids", "word", "label", "kept", "lang", "source"):
        df = df.withColumn(name, F.lit(None).cast("string") if name == "lang" else F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def rows_of(odd_docs):
    return [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
