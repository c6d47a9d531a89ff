import hashlib
import random
import re

import pytest

from ludica.llm import pii
from ludica.llm.queries import op13_pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for at, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]():
                out.append((m.start(), at, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in pii.digests(pii.find_spans(df)).orderBy("doc_id").collect()]


def check(row, text):
    want = base(text)
    assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert set(want) <= set(row["spans"].split(","))
    assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k + ":") for s in want) for k in PATTERNS]


def test_random_texts(spark):
    rng = random.Random(1)
    alphabets = ["0123456789 -.", "ab@.-_c1%+", "0123456789 -.+()@ab_%Aé\U0001f600\n", "+1 ()-.9"]
    texts = ["".join(rng.choice(a) for _ in range(rng.randrange(0, 100))) for a in alphabets for _ in range(800)]
    known = ["4111 1111 1111 1111", "4111-1111-1111-1111", "5500000000000004", "é", "+1 (555) 123-4567", "a.b@c.de", "x", "1.2.3.4", "256.1.1.1"]
    texts += [rng.choice(" ,").join(rng.choice(known) for _ in range(rng.randrange(0, 20))) for _ in range(600)]
    for row, text in zip(found(spark, texts), texts, strict=True):
        check(row, text)


@pytest.mark.parametrize("text, spans", [
    ("Konto: DE89 3704 0044 0532 0130 00 AND MORE", "iban:7:34"), ("GB82WEST12345698765432", "iban:0:22"),
    ("bank DE89 3704 0044 0532 0130 01", ""), ("XX82WEST12345698765432", ""), ("my ssn is 123-45-6789.", "ssn:10:21"),
    ("123-45-6789", ""), ("ssn 000-45-6789", ""), ("ssn 123-00-6789", ""), ("call 0171 555 1234 now", "phone:5:18"),
    ("0171 555 1234", ""), ("card 4111.1111.1111.1111", "card:5:24"), ("4111.1111.1111.1112 card", ""),
    ("mail a@b.c DE89370400440532013000", "email:5:10,iban:11:33"), ("+49 0171 555 1234 phone", "phone:0:17"),
    ("a@b.c_d@e.f", "email:0:5,email:5:11"), ("\U0001f600 a@b.c", "email:2:7"),
    ("call " + "x" * 60 + " 0171 555 1234", "")])
def test_added_spans(spark, text, spans):
    assert found(spark, [text])[0]["spans"] == spans


def test_scores(spark):
    df = spark.createDataFrame([("call +49 171 5551234; 4111111111111111, a@b.c",)], "text string").selectExpr("1L AS doc_id", "text")
    scores = {s["value"]: s["score"] for s in pii.find_spans(df).collect()[0]["base"]}
    assert scores == {"+49 171 5551234": 0.7, "4111111111111111": 0.7, "a@b.c": 0.4}


def test_many_matches(spark):
    for text in ("a.b@c.de " * 3000, "1.2.3.4 " * 1500 + "4111111111111111", "a@b.c DE89370400440532013000 " * 700):
        row = found(spark, [text])[0]
        check(row, text)
    assert row["spans"].count("iban") == 700 and row["spans"].endswith(f"iban:{len(text) - 23}:{len(text) - 1}")


@pytest.mark.parametrize("text, spans", [
    ("x" * 1_000_000, 0), ("1" * 1_000_000, 0), ("1 " * 500_000, 0), ("a@" + "a." * 500_000, 1), ("+1" + "(" * 500_000, 0),
    ("1." * 200_000, 50_000), ("+" * 500_000, 0), ("A1" * 300_000, 0), ("0123-456-" * 50_000, 0)])
def test_long_runs_neither_overflow_nor_take_long(spark, text, spans):
    row = found(spark, [text])[0]
    assert (row["spans"].count(":") // 2) == row["n_email"] + row["n_ip"] == spans


def test_odd_documents(odd_docs, rows_of, no_docs):
    rows = pii.digests(pii.find_spans(odd_docs)).collect()
    assert len(rows) == len(rows_of)
    empty = hashlib.sha256(b"").hexdigest()
    for r in rows:
        assert (r["base_sha256"] == empty) == (r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == 0)
    assert pii.digests(pii.find_spans(no_docs)).collect() == []


def test_query_is_native(spark):
    out = op13_pii(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for row in out.collect():
        check(row, texts[row["doc_id"]])
