import json

import pytest

from siftline.operators import decode
from siftline.schema import MESSAGE_FIELDS
from siftline.sources.local import messages

GOOD = (
    '{"account_id":"u-8","message_id":"5521","message_body":"the ferry leaves at noon",'
    '"correlation_id":"trip/3","message_status":"queued","timestamp":"2024-07-19T06:45:12Z"}'
)


def _values(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _reason(spark, value):
    return decode.inspect_json(_values(spark, value)).first().reason


def test_message_is_decoded(spark):
    row = decode.decode_json(_values(spark, GOOD)).first().asDict()
    assert row == {**json.loads(GOOD), "profanity_type": None}
    assert tuple(row) == MESSAGE_FIELDS


@pytest.mark.parametrize(
    "value, reason",
    [
        (GOOD, None),
        ("{}", None),
        ('{"extra":{"deep":[1,2]},"account_id":"1"}', None),
        ('{"account_id":17,"message_body":true}', None),
        ('{"account_id":1.50}', None),
        ('{"other":{"account_id":1.50},"account_id":1.50}', None),
        ('{"account\\u005fid":1.50}', None),
        ('{"account_id":null}', None),
        ('{"account_id":"{x"}', None),
        ('{"profanity_type":"SAFE"}', None),
        ('{"profanity_type":null}', None),
        ('{"account_id":"a","account_id":"b"}', None),
        ("not json", "malformed_json"),
        ('{"account_id":"1"', "malformed_json"),
        ("", "malformed_json"),
        (None, "malformed_json"),
        ("null", "null_record"),
        ("[1]", "not_an_object"),
        ("3", "not_an_object"),
        ('"text"', "not_an_object"),
        ('{"account_id":{"b":1}}', "nested_field"),
        ('{"timestamp":[]}', "nested_field"),
        ('{"profanity_type":{"a":1}}', "nested_field"),
        ('{"profanity_type":"RUDE"}', "unknown_profanity_type"),
        ('{"profanity_type":"safe"}', "unknown_profanity_type"),
    ],
)
def test_reasons(spark, value, reason):
    assert _reason(spark, value) == reason


def test_scalars_become_text_and_last_duplicate_wins(spark):
    rows = decode.decode_json(
        _values(spark, '{"account_id":17,"message_body":true}', '{"account_id":"a","account_id":"b"}')
    ).collect()
    assert [(r.account_id, r.message_body) for r in rows] == [("17", "true"), ("b", None)]


@pytest.mark.parametrize(
    "number", ["1.50", "1e5", "-0.10E-3", "-0", "12345678901234567890123.10", "9" * 60, "1.0e400", "0.1"]
)
def test_numbers_keep_their_text(spark, number):
    value = f'{{"message_body":"\\"account_id\\": 7.7","account_id" : {number},"message_id":"3.0"}}'
    row = decode.decode_json(_values(spark, value)).first()
    assert (row.account_id, row.message_id, row.message_body) == (number, "3.0", '"account_id": 7.7')


@pytest.mark.parametrize(
    "value, expected",
    [
        ('{"other":{"account_id":1.5},"account_id":1.50}', "1.50"),
        ('{"account_id":1.50,"other":{"account_id":9.90}}', "1.50"),
        ('{"a":[{"account_id":2.0},3.0],"account_id" : -1.50E+3 }', "-1.50E+3"),
        ('{"account\\u005fid":1.50}', "1.50"),
        ('{"account_id":1.0,"account_id":2.00}', "2.00"),
        ('{"account_id":1.0,"account\\u005fid":3.00}', "3.00"),
        ('{"message_body":"{\\"account_id\\": 7.70, [","x":{"account_id":7.70},"account_id":7.70}', "7.70"),
        ('{"message_body":"a \\\\","x":{"account_id":1},"account_id":-0}', "-0"),
        ('{"x":{"account_id":1.50},"account_id":"1.5"}', "1.5"),
        ('{"x":{"account_id":1.50}}', None),
    ],
)
def test_numbers_keep_their_text_whatever_is_deeper(spark, value, expected):
    assert json.loads(value).get("account_id") is not None or expected is None
    row = decode.inspect_json(_values(spark, value)).first()
    assert (row.reason, row.account_id) == (None, expected)


def test_a_long_value_with_many_escapes_is_taken_apart(spark):
    body = "\\n\\\"" * 50_000
    value = f'{{"x":{{"account_id":1.50}},"message_body":"{body}","account_id":1.500}}'
    row = decode.decode_json(_values(spark, value)).first()
    assert row.account_id == "1.500" and len(row.message_body) == 100_000


def test_every_value_is_either_message_or_reject(spark):
    inspected = decode.inspect_json(_values(spark, GOOD, "x", "null", '{"a":1}', "[]", None))
    assert decode.messages_of(inspected).count() == 2
    rejects = decode.rejects_of(inspected)
    assert rejects.columns == ["reason", "value"]
    assert sorted(str(r.value) for r in rejects.collect()) == ["None", "[]", "null", "x"]


def test_failfast_stops_on_the_first_bad_value(spark):
    with pytest.raises(Exception, match="cannot decode message: malformed_json"):
        decode.decode_json(_values(spark, GOOD, "oops")).collect()


def test_failfast_stops_even_if_no_column_is_read(spark):
    with pytest.raises(Exception, match="nested_field"):
        decode.decode_json(_values(spark, '{"account_id":[1]}')).count()


def test_failfast_skips_json_null(spark):
    assert decode.decode_json(_values(spark, "null", GOOD)).count() == 1


def test_text_is_parsed_once_for_all_checks(spark):
    checked = decode.messages_of(decode.inspect_json(_values(spark, GOOD)))
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson(") == 1


def test_encoding_keeps_order_and_nulls(spark):
    row = {"account_id": "1", "message_body": 'say "é"', "profanity_type": "PROFANITY"}
    value = decode.encode_json(messages(spark, [row])).first().value
    assert list(json.loads(value)) == list(MESSAGE_FIELDS)
    assert json.loads(value) == {**dict.fromkeys(MESSAGE_FIELDS), **row}


def test_round_trip(spark):
    row = {name: f"{name} \\ \n ü" for name in MESSAGE_FIELDS[:-1]}
    value = decode.encode_json(messages(spark, [row]))
    assert decode.decode_json(value).first().asDict() == {**row, "profanity_type": None}
