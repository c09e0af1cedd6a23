"""Raw JSON messages through both hops to bills, with hand-derived totals.

The records are our own; the per-customer totals are the pricing cases of
FIXTURES §3 (RP2: data 227.91 MB, voice 2632 s; RP1: data 222.93 MB, voice
1544 s).
"""

import json

from pyspark.sql import functions as F

from tollgate import bill_monthly, decode, encode, mediate, normalise, rate_monthly, split
from tollgate.schemas import CUSTOMERS, MEDIATED_CDR, RAW_CDR
from tollgate.sources.reference import product_rates

A, B = "212660000005", "212660000188"      # RP2 and RP1 subscribers


def _voice(caller, secs, ts="2025-06-12T09:30:05Z", **kw):
    return {"record_type": "voice", "timestamp": ts, "caller_id": caller, "callee_id": "212660000077",
            "duration_sec": secs, "cell_id": "CELL_1", "technology": "4G", **kw}


def _data(user, mb, secs=300, ts="2025-06-12T08:00:00Z"):
    return {"record_type": "data", "timestamp": ts, "user_id": user, "data_volume_mb": mb,
            "session_duration_sec": secs, "cell_id": "CELL_2", "technology": "5G"}


def _sms(sender, ts="2025-06-13T09:00:00Z"):
    return {"record_type": "sms", "timestamp": ts, "sender_id": sender, "receiver_id": "212660000078",
            "cell_id": "CELL_3", "technology": "3G"}


MESSAGES = [
    _voice(A, 1000), _voice(A, 1632), _data(A, 200.0), _data(A, 27.91),
    _voice(B, 1500), _voice(B, 44), _data(B, 122.93), _data(B, 100.0),
    _sms(B),
    {"record_type": "data", "timestamp": "2025-06-12T08:00:00Z", "data_volume_mb": 5.0},   # no subscriber
    _voice("front-desk", 60),                                                               # text subscriber
    _voice("212660000201", 60),                                                            # unknown subscriber
]


def test_raw_messages_to_bills(spark):
    msgs = spark.createDataFrame([(json.dumps(m),) for m in MESSAGES] + [("not json",)], "value string")
    valid, invalid = split(mediate(decode(msgs, RAW_CDR)))
    assert valid.count() == 11 and invalid.count() == 2

    wire = decode(encode(valid), MEDIATED_CDR)                 # the topic between the hops
    cdr = normalise(wire)
    assert cdr.count() == 10                                   # the text subscriber is dropped
    data_a = cdr.filter((F.col("customer_id") == "+" + A) & (F.col("record_type") == "data")).collect()
    assert {r.duration_sec for r in data_a} == {300} and {r.session_duration_sec for r in data_a} == {0}

    customers = spark.createDataFrame(
        [("+" + A, "A", "postpaid", "RP2", None, "active", None),
         ("+" + B, "B", "postpaid", "RP1", None, "active", None)], CUSTOMERS)
    rated = rate_monthly(cdr, customers, product_rates(spark))
    got = {(r.customer_id, r.record_type): r for r in rated.collect()}
    assert set(got) == {("+" + A, "voice"), ("+" + A, "data"), ("+" + B, "voice"), ("+" + B, "data"),
                        ("+" + B, "sms")}                      # the unknown subscriber is not rated

    def close(a, b):
        return abs(a - b) < 1e-9

    assert close(got[("+" + A, "data")].billable_units, 27.91) and close(got[("+" + A, "data")].cost, 0.8373)
    assert close(got[("+" + A, "voice")].cost, 21.056)
    assert close(got[("+" + B, "data")].billable_units, 122.93) and close(got[("+" + B, "data")].cost, 6.1465)
    assert close(got[("+" + B, "voice")].cost, 15.44)
    assert got[("+" + B, "sms")].billable_units == 0 and got[("+" + B, "sms")].cost == 0

    bills = {r.customer_id: r for r in bill_monthly(rated).collect()}
    assert close(bills["+" + A].total_amount, 21.8933) and bills["+" + A].num_services == 2
    assert close(bills["+" + B].total_amount, 21.5865) and bills["+" + B].num_services == 3
    assert {b.year_month for b in bills.values()} == {"2025-06"}
    assert {b.rate_plan_id for b in bills.values()} == {"RP1", "RP2"}
