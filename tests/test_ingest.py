"""Ingest rules: event-stream lines (X3) and message decoding/mapping."""

import json

import pytest

from ludica.operators.ingest import decode_messages, is_close, messages_to_rows
from ludica.sources.messages import sse_to_messages


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_sse_rules(spark):
    lines = ["", "   ", "id: 7", "  event: x", 'data: {"AppID":"1"}', '{"AppID":"1"}',
             "  data: x", ": comment", "retry: 5", "\tdata: y\t"]
    got = [r.value for r in sse_to_messages(_lines(spark, lines)).collect()]
    assert got == [
        json.dumps({"data": '{"AppID":"1"}'}, separators=(",", ":")),
        json.dumps({"data": '{"AppID":"1"}'}, separators=(",", ":")),
        '{"data":"data: x"}',
        '{"data":": comment"}',
        '{"data":"retry: 5"}',
        '{"data":"data: y"}',
    ]


def _msg(inner):
    return json.dumps({"data": inner})


def _rows(spark, values, **kw):
    return messages_to_rows(_lines(spark, values), **kw).collect()


def test_basic_record_and_missing_keys(spark):
    r = _rows(spark, [_msg('{"AppID":"1","Peak CCU":"5","Mac":true}')])
    assert len(r) == 1
    row = r[0].asDict()
    assert row["appID"] == "1" and row["peakCCU"] == 5 and row["supportMac"] is True
    assert row["name"] is None and row["price"] is None and row["requiredAge"] is None


@pytest.mark.parametrize("text", ["x", "5.0", " 5 ", ""])
def test_bad_int_is_zero(spark, text):
    (row,) = _rows(spark, [_msg(json.dumps({"Peak CCU": text}))])
    assert row.peakCCU == 0


@pytest.mark.parametrize("text,expected", [("yes", False), ("1", False), ("TRUE", True),
                                           ("false", False), ("True", True)])
def test_bool_rule(spark, text, expected):
    (row,) = _rows(spark, [_msg(json.dumps({"Mac": text}))])
    assert row.supportMac is expected


def test_float_rule(spark):
    rows = _rows(spark, [_msg('{"AppID":"a","Price":"abc"}'), _msg('{"AppID":"b","Price":"1.5f"}'),
                         _msg('{"AppID":"c","Price":" 2.25 "}')])
    got = {r.appID: r.price for r in rows}
    assert got == {"a": 0.0, "b": 1.5, "c": 2.25}


def test_null_poison_and_text_null(spark):
    rows = _rows(spark, [_msg('{"AppID":"1","Price":null}'), _msg('{"AppID":"2","Name":null}')])
    assert [r.appID for r in rows] == ["2"]
    assert rows[0].name is None


def test_unmapped_and_target_spelled_keys(spark):
    (a,) = _rows(spark, [_msg('{"AppID":"1","Packages":"p"}')])
    assert a.packages is None
    (b,) = _rows(spark, [_msg('{"AppID":"2","packages":"p","price":"abc","peakCCU":"7"}')])
    assert b.packages == "p" and b.price is None and b.peakCCU == 7


@pytest.mark.parametrize("inner", ["not json", "[1]", ""])
def test_malformed_inner_gives_null_row(spark, inner):
    rows = _rows(spark, [_msg(inner)])
    assert len(rows) == 1 and all(v is None for v in rows[0].asDict().values())


def test_malformed_policies(spark):
    df = _lines(spark, [_msg("not json"), _msg('{"AppID":"1"}')])
    assert messages_to_rows(df, malformed="drop").count() == 1
    q = decode_messages(df, malformed="quarantine").collect()
    assert sorted(r._malformed for r in q) == [False, True]


@pytest.mark.parametrize("value", ['{"data":"null"}', '{"data":null}', '{"x":1}', "close",
                                   "[1]", "", '{"data":"close"}', "{'data':'{}'}"])
def test_dropped_messages(spark, value):
    assert _rows(spark, [value]) == []


def test_close_sentinel_flag(spark):
    df = _lines(spark, ['{"data":"close"}', _msg('{"AppID":"1"}'), "close"])
    assert [r.c for r in df.select(is_close().alias("c")).collect()] == [True, False, False]


def test_duplicate_keys_last_wins(spark):
    (row,) = _rows(spark, [_msg('{"AppID":"1","Peak CCU":"3","Peak CCU":"9"}')])
    assert row.peakCCU == 9


def test_nested_object_becomes_json_text(spark):
    (row,) = _rows(spark, [_msg('{"AppID":"1","Tags":{"a":1}}')])
    assert json.loads(row.tags) == {"a": 1}


@pytest.mark.parametrize("number, expected", [("5", 5), ("5.0", 0), ("-7", -7), ("1e3", 0), ("99999999999", 0), ("true", 0), ("0.5", 0)])
def test_unquoted_numbers_in_int_columns(spark, number, expected):
    (row,) = _rows(spark, [_msg(f'{{"AppID":"v1.5","Peak CCU":{number}}}')])
    assert row.peakCCU == expected and row.appID == "v1.5"


def test_missing_null_and_repeated_keys(spark):
    """A JSON null of a text key is not a missing key: the key spelled like the
    column only stands in for a missing one. The last of repeated keys counts, in the envelope, too."""
    rows = _rows(spark, [_msg('{"AppID":"1","Name":null,"name":"n"}'), _msg('{"AppID":"2","name":"n"}'),
                         _msg('{"AppID":"3","Name":"a","Name":null}'), _msg('{"AppID":"4","Price":null,"Price":"2"}'),
                         _msg('{"AppID":"5","Price":"2","Price":null}'), '{"data":"null","data":"{\\"AppID\\":\\"6\\"}"}'])
    got = {r.appID: r for r in rows}
    assert sorted(got) == ["1", "2", "3", "4", "6"]
    assert (got["1"].name, got["2"].name, got["3"].name, got["4"].price) == (None, "n", None, 2.0)


def test_strict_json(spark):
    """What is no JSON makes an all-NULL row: NaN, leading zeros, single quotes, half an object. Text after the object is left out."""
    for inner in ('{"AppID":"1","Price":NaN}', '{"AppID":01}', "{'AppID':'1'}", '{"AppID":"1"'):
        (row,) = _rows(spark, [_msg(inner)])
        assert all(v is None for v in row.asDict().values())
    assert _rows(spark, [_msg('{"AppID":"1"} and more')])[0].appID == "1"
