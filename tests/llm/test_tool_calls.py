import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ludica.llm import tool_calls as C
from ludica.llm.queries import ORACLE, op3_tool_call_linking

CALLS = "group_id long, call_id string, position long, name string, arguments string, after array<string>"
RESULTS = "call_id string, position long, content string"
SCHEMAS = {"add": {"properties": {"a": {"type": "integer"}, "b": {"type": ["number", "null"], "maximum": 9}}, "required": ["a"],
                   "additionalProperties": False}}


def test_schemas():
    s = {"type": "object", "properties": {"x": {"type": "array", "items": {"enum": ["p", "q"]}}, "y": {"type": "string", "minLength": 2, "maxLength": 3}}}
    assert C.violation({"x": ["p", "q"], "y": "ab"}, s) is None
    assert "x[1]" in C.violation({"x": ["p", "z"]}, s)
    assert C.violation({"y": "a"}, s) and C.violation({"y": "abcd"}, s) and C.violation([], s)
    assert C.violation(True, {"type": "integer"}) and C.violation(1, {"type": "number"}) is None
    assert C.canonical({"b": 1, "a": ["é", None, True]}) == '{"a":["é",null,true],"b":1}'


def test_links_and_order(spark):
    calls = [(1, "a", 0, "add", '{"b": 2.5, "a": 1}', []), (1, "b", 1, "add", '{"a": "x"}', ["a"]), (1, "c", 2, "none", "{}", ["b", "zz"]),
             (2, "d", 0, "add", '{"a": 1}', ["e"]), (2, "e", 1, "add", "[1]", ["f"]), (2, "f", 2, "add", "no json", []),
             (3, "g", 0, "add", None, ["h"]), (3, "h", 1, "add", '{"a": 2, "c": 1}', ["g"]), (1, "a", 0, "add", '{"b": 2.5, "a": 1}', []),
             (None, "k", None, None, None, None), (1, None, 0, "add", "{}", [])]
    results = [("a", 1, "one"), ("a", 2, "two"), ("b", 2, None), ("lost", 3, "x"), (None, 1, "y")]
    got = {r["call_id"]: r for r in C.link_calls(spark.createDataFrame(calls, CALLS).withColumn("status", F.lit("clash")),
                                                 spark.createDataFrame(results, RESULTS), SCHEMAS).collect()}
    assert set(got) == set("abcdefghk") | {"lost"}
    assert {k: r["level"] for k, r in got.items()} == dict(a=0, b=0, c=0, d=2, e=1, f=0, g=None, h=None, k=0, lost=None)
    assert {k: r["status"] for k, r in got.items()} == dict(a="linked", b="linked", c="open", d="open", e="open", f="open", g="open", h="open", k="open", lost="orphan")
    assert (got["a"]["n_calls"], got["a"]["n_results"], got["c"]["n_missing"]) == (2, 2, 1)
    assert [k for k, r in sorted(got.items()) if r["valid"]] == ["a", "d"]
    assert got["b"]["error"] == "$.a: not of type integer" and got["c"]["error"] == "no schema" and got["f"]["error"] == "$: no JSON"
    assert got["a"]["json"] == '{"arguments":{"a":1,"b":2.5},"id":"a","name":"add","result":"one"}'
    assert json.loads(got["lost"]["json"]) == {"arguments": None, "id": "lost", "name": None, "result": "x"}


def test_levels_are_topological(spark):
    rng = random.Random(1)
    calls = []
    for g in range(6):
        names = [f"{g}-{i}" for i in range(12)]
        place = rng.sample(range(12), 12) if g % 2 else list(range(12))
        for i, name in enumerate(names):
            calls.append((g, name, place[i], "add", '{"a":1}', rng.sample(names[:i], min(i, 2))))
    got = C.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect()
    rank = {r["call_id"]: (r["level"], r["position"]) for r in got}
    assert len(rank) == 72 and all(rank[d] < rank[c[1]] for c in calls for d in c[5])


def test_empty(spark):
    assert C.link_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect() == []


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    got = op3_tool_call_linking(spark, d)
    want = con.execute(ORACLE["op3_tool_call_linking"])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(str(tuple(r[n] for n in sorted(names))) for r in got.collect()) == sorted(
        str(tuple(v for _, v in sorted(zip(names, row)))) for row in want.fetchall())


TURNS = "conv_id long, turn long, role string, text string"


def test_odd_conversations(spark):
    rows = [(None, None, "user", "a"), (None, 0, None, "b"), (1, 0, "user", None), (1, 1, "assistant", None), (1, 0, "user", ""), (2, 5, "assistant", "x"),
            (2, 0, "system", "s"), (2, 3, "system", "late"), (3, 4, "user", "long " * 20000), (3, 2, "tool", "t"), (4, 2 ** 63 - 1, "user", "far"),
            (5, -2 ** 63, "assistant", "no id"), (6, -1, "user", "early")]
    got = {r["call_id"]: r for r in C.link_calls(*C.calls_of_conversations(
        spark.createDataFrame(rows, TURNS).withColumn("name", F.lit("x"))), C.TURN_SCHEMAS).collect()}
    assert set(got) == {":0", "1:0", "2:4", "2:0", "2:3", "3:4", "3:2", f"4:{2 ** 63 - 1}", "6:-1"}
    assert got["1:0"]["n_calls"] == 2 and got["2:4"]["status"] == "orphan" and got[":0"]["name"] == "unknown"
    assert got["3:4"]["n_missing"] == 0 and got["3:4"]["valid"] and got["3:2"]["error"] == "no schema" and got["3:2"]["n_missing"] == 1
    assert got["2:0"]["valid"] and got["2:3"]["error"] == "$.turn: not one of the values" and got["2:0"]["n_missing"] == 2
    assert got["6:-1"]["error"] == "$.turn: out of range" and got[f"4:{2 ** 63 - 1}"]["n_missing"] == 0


def test_nested_conversations_are_ordered(spark):
    """Sub-calls first, whatever the length; backward conversations stay in listed order."""
    rows = [(c, t, "user", "x") for c, n in ((2, 62), (4, 1), (6, 40), (3, 30)) for t in range(n)]
    calls, results = C.calls_of_conversations(spark.createDataFrame(rows, TURNS))
    got = {r["call_id"]: r for r in C.link_calls(calls, results, C.TURN_SCHEMAS).collect()}
    assert len(got) == len(rows) and {r["level"] for r in got.values() if r["group_id"] == 3} == {0}
    assert {r["level"] for r in got.values() if r["group_id"] == 2} == set(range(5)) and got["4:0"]["level"] == 0
    for call in calls.collect():
        for dep in call["after"]:
            if dep in got:
                a, b = got[dep], got[call["call_id"]]
                assert (a["level"], a["position"]) < (b["level"], b["position"])
    assert got["2:0"]["n_missing"] == 0 and got["2:60"]["n_missing"] == 2


def test_the_query_takes_the_ordering_path(spark):
    rows = op3_tool_call_linking(spark, "/root/testdata/sf0.001").collect()
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert sum(r["n_calls"] + r["n_results"] for r in rows) == turns.count()
    assert max(r["level"] or 0 for r in rows) > 0 and {"reply", "instruct"} <= {r["name"] for r in rows}


@pytest.mark.parametrize("n", [400])
def test_a_chain_needs_no_rounds(spark, n):
    calls = [(1, str(i), i, "add", '{"a":1}', [str(i - 1)] if i else []) for i in range(n)]
    got = C.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect()
    assert {r["level"] for r in got} == {0}


def test_arguments_that_no_json_can_hold(spark):
    deep = '{"a":' + "[" * 100_000 + "]" * 100_000 + "}"
    given = {"deep": deep, "half": '{"a":"\\ud800"}', "nan": '{"a":NaN}', "inf": '{"a":-Infinity}', "pair": '{"a":"\\ud83d\\ude00"}'}
    calls = [(1, k, i, "any", v, []) for i, (k, v) in enumerate(given.items())]
    got = {r["call_id"]: r for r in C.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), {"any": {}}).collect()}
    assert {k: r["error"] for k, r in got.items()} == {"deep": "$: nested too deeply", "half": "$: no JSON", "nan": "$: no JSON",
                                                       "inf": "$: no JSON", "pair": None}
    assert all(json.loads(r["json"])["arguments"] == given[k] for k, r in got.items() if k != "pair")
    assert "\U0001f600" in got["pair"]["json"]


def test_schema_kinds():
    assert C.violation(True, {"enum": [1]}) and C.violation(1, {"enum": [True]}) and C.violation(1.0, {"enum": [1]}) is None
    assert C.violation(2.0, {"type": "integer"}) is None and C.violation(2.5, {"type": "integer"})
    assert C.violation("ab1", {"pattern": "^[a-z]+$"}) and C.violation("ab", {"pattern": "^[a-z]+$"}) is None
