"""Mediation operators (C1-C5) and their edge cases."""

import json

from tollgate import decode, encode, mediate, split, unify, validate
from tollgate.schemas import MEDIATED_CDR, RAW_CDR


def _messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def _voice(caller="212660000001", callee="212660000002", duration=60, **extra):
    rec = {"record_type": "voice", "timestamp": "2025-06-12T09:30:05Z", "caller_id": caller,
           "callee_id": callee, "duration_sec": duration, "cell_id": "C1", "technology": "4G"}
    rec.update(extra)
    return {k: v for k, v in rec.items() if v is not None}


def test_decode_typed_fields_and_garbage(spark):
    texts = [
        json.dumps(_voice()),
        "not json",
        "",
        None,
        json.dumps(_voice(duration=5.5)),      # D2: wrong type nulls the field only
        json.dumps(_voice(duration="7")),
        json.dumps(_voice(duration=99999999999)),
        json.dumps(_voice(extra_field=1)),     # D3: extra field ignored
        json.dumps([_voice()]),               # D3: array: nothing survives
    ]
    rows = decode(_messages(spark, texts), RAW_CDR).collect()
    assert rows[0].duration_sec == 60 and rows[0].caller_id == "212660000001"
    for r in rows[1:4]:
        assert all(v is None for v in r)
    for r in rows[4:7]:
        assert r.duration_sec is None and r.caller_id == "212660000001"
    assert rows[7].duration_sec == 60
    assert all(v is None for v in rows[8])


def test_decode_number_in_string_field_keeps_text(spark):
    rows = decode(_messages(spark, ['{"caller_id": 212660000001}']), RAW_CDR).collect()
    assert rows[0].caller_id == "212660000001"


def test_decode_binary_and_keep_raw(spark):
    df = spark.createDataFrame([(bytearray(b'{"record_type":"sms"}'), 7)], "value binary, offset long")
    out = decode(df, RAW_CDR, keep=("offset",), keep_raw=True).collect()[0]
    assert out.offset == 7 and out.raw_value == '{"record_type":"sms"}' and out.record_type == "sms"


def test_unify_shapes(spark):
    texts = [
        json.dumps(_voice()),
        json.dumps({"record_type": "sms", "sender_id": "212660000003", "receiver_id": "212660000004"}),
        json.dumps({"record_type": "data", "user_id": "212660000005", "data_volume_mb": 10.5,
                    "session_duration_sec": 300}),
    ]
    rows = unify(decode(_messages(spark, texts), RAW_CDR)).collect()
    cols = unify(decode(_messages(spark, texts), RAW_CDR)).columns
    assert cols == ["record_type", "timestamp", "cell_id", "technology", "msisdn", "peer_id",
                    "volume_mb", "duration", "status"]
    assert (rows[0].msisdn, rows[0].peer_id, rows[0].duration) == ("212660000001", "212660000002", 60)
    assert (rows[1].msisdn, rows[1].peer_id, rows[1].duration) == ("212660000003", "212660000004", None)
    assert (rows[2].msisdn, rows[2].peer_id, rows[2].volume_mb, rows[2].duration) == ("212660000005", None, 10.5, 300)
    assert {r.status for r in rows} == {"valid"}


def test_msisdn_is_first_non_null_whatever_the_type(spark):
    # A voice record carrying only user_id still gets it as msisdn
    rows = unify(decode(_messages(spark, ['{"record_type":"voice","user_id":"212660000009"}']), RAW_CDR)).collect()
    assert rows[0].msisdn == "212660000009"


def test_validity_rules(spark):
    texts = [
        json.dumps(_voice()),                                   # valid
        json.dumps({"record_type": "data", "data_volume_mb": 1.0}),  # no subscriber
        json.dumps(_voice(caller="999123")),                    # test number
        json.dumps(_voice(record_type=None)),                   # no type
        json.dumps(_voice(duration=-60)),                       # D7: negative is still valid
        json.dumps(_voice(callee=None)),                        # missing peer is valid
        json.dumps(_voice(caller="front-desk")),                 # non-numeric is valid here
        json.dumps(_voice(record_type="other")),                # unknown type is valid
        "garbage",                                              # D1
    ]
    flags = [r.is_valid for r in validate(unify(decode(_messages(spark, texts), RAW_CDR))).collect()]
    assert flags == [True, False, False, False, True, True, True, True, False]


def test_split_partitions_input(spark):
    texts = [json.dumps(_voice()), "x", json.dumps(_voice(caller="999")), json.dumps(_voice(duration=1))]
    med = mediate(decode(_messages(spark, texts), RAW_CDR))
    valid, invalid = split(med)
    assert valid.count() + invalid.count() == med.count() == 4
    assert {r.status for r in invalid.collect()} == {"error"}
    assert {r.status for r in valid.collect()} == {"valid"}
    assert "is_valid" not in valid.columns and "is_valid" not in invalid.columns


def test_encode_leaves_out_nulls_and_round_trips(spark):
    texts = [json.dumps(_voice(callee=None))]
    valid, _ = split(mediate(decode(_messages(spark, texts), RAW_CDR)))
    enc = encode(valid).collect()[0]
    assert enc.key is None
    body = json.loads(enc.value)
    assert "peer_id" not in body and "volume_mb" not in body  # D4
    back = decode(encode(valid), MEDIATED_CDR)
    assert dict(back.schema.fields[6].jsonValue())["type"] == "long"
    r = back.collect()[0]
    assert (r.msisdn, r.peer_id, r.duration, r.status) == ("212660000001", None, 60, "valid")


def test_strict_rules_are_opt_in(spark):
    texts = [
        json.dumps(_voice()),                                   # valid under every rule
        json.dumps(_voice(duration=-60)),                       # negative_usage
        json.dumps(_voice(callee=None)),                        # missing_peer
        json.dumps(_voice(record_type="other")),                # unknown_type
        json.dumps(_voice(timestamp="bad")),                    # bad_timestamp
        json.dumps(_voice(caller="front-desk")),                 # not_a_customer
        json.dumps(_voice(caller="999123")),                    # default rule still applies
    ]
    raw = decode(_messages(spark, texts), RAW_CDR)
    assert [r.is_valid for r in mediate(raw).collect()] == [True] * 6 + [False]
    strict = [r.is_valid for r in mediate(raw, reject=("negative_usage", "missing_peer", "unknown_type",
                                                        "bad_timestamp", "not_a_customer")).collect()]
    assert strict == [True] + [False] * 6
    only_peer = [r.is_valid for r in mediate(raw, reject=("missing_peer",)).collect()]
    assert only_peer == [True, True, False, True, True, True, False]
    import pytest
    with pytest.raises(ValueError):
        mediate(raw, reject=("no_such_rule",))
