"""Normalisation (C6) and its rules."""

import datetime as dt

from pyspark.sql import functions as F

from tollgate import normalise
from tollgate.schemas import NORMALISED_CDR

MED = ("record_type string, timestamp string, cell_id string, technology string, msisdn string, "
       "peer_id string, duration long, volume_mb double, status string")


def _med(spark, rows):
    return spark.createDataFrame(rows, MED)


def test_schema_and_column_order(spark):
    out = normalise(_med(spark, [("voice", "2025-06-12T09:30:05Z", "C", "4G", "212660000001", "212660000002", 60, None, "valid")]))
    assert [f.name for f in out.schema.fields] == [f.name for f in NORMALISED_CDR.fields]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in NORMALISED_CDR.fields]


def test_peer_routing_and_defaults(spark):
    rows = [
        ("voice", "2025-06-12T09:30:05Z", "C", "4G", "212660000001", "212660000002", 60, None, "valid"),
        ("sms", "2025-06-12T09:30:05Z", "C", "4G", "212660000003", "212660000004", None, None, "valid"),
        ("data", "2025-06-12T09:30:05Z", "C", "4G", "212660000005", None, 300, 10.5, "valid"),
    ]
    out = {r.record_type: r for r in normalise(_med(spark, rows)).collect()}
    v, s, d = out["voice"], out["sms"], out["data"]
    assert (v.customer_id, v.receiver_id, v.callee_id) == ("+212660000001", "212660000002", "212660000002")  # D9
    assert (s.receiver_id, s.callee_id, s.duration_sec, s.data_volume_mb) == ("212660000004", None, 0, 0.0)  # D10
    assert (d.duration_sec, d.session_duration_sec, d.data_volume_mb) == (300, 0, 10.5)  # D6
    assert v.timestamp == dt.datetime(2025, 6, 12, 9, 30, 5)


def test_customer_number_rule(spark):
    nums = ["212660000001", "front-desk", "INVALID", "21266000000", "2126600000011", "312660000001", "212660000001\n"]
    rows = [("sms", "2025-06-12T09:30:05Z", None, None, n, None, None, None, "valid") for n in nums]
    got = sorted(r.customer_id for r in normalise(_med(spark, rows)).collect())
    # Java's "$" also accepts one trailing newline.
    assert got == ["+212660000001", "+212660000001\n"]


def test_only_valid_status_and_bad_timestamp(spark):
    rows = [
        ("voice", "bad", None, None, "212660000001", None, 1, None, "valid"),
        ("voice", "2025-06-12T09:30:05Z", None, None, "212660000001", None, 1, None, "error"),
        ("voice", None, None, None, "212660000001", None, 1, None, "valid"),
    ]
    out = normalise(_med(spark, rows)).collect()
    assert len(out) == 2 and all(r.timestamp is None for r in out)  # D11: null, never an error


def test_with_month_partition_column(spark):
    rows = [("voice", "2025-06-30T23:59:59Z", None, None, "212660000001", None, 1, None, "valid")]
    out = normalise(_med(spark, rows), with_month=True).collect()[0]
    assert out.year_month == "2025-06"


def test_observation_counts_dropped_rows(spark):
    from pyspark.sql import Observation

    rows = [
        ("voice", "2025-06-12T09:30:05Z", "C", "4G", "212660000001", "212660000002", 60, None, "valid"),
        ("voice", "2025-06-12T09:30:05Z", "C", "4G", "front-desk", "212660000002", 60, None, "valid"),
        ("sms", "2025-06-12T09:30:05Z", "C", "4G", "2126600000011", None, 0, None, "valid"),
        ("sms", "2025-06-12T09:30:05Z", "C", "4G", "212660000001", None, 0, None, "error"),
    ]
    obs = Observation("normalise")
    out = normalise(_med(spark, rows), observe=obs)
    assert out.count() == 1
    assert obs.get == {"valid_rows": 3, "dropped_rows": 2}


def test_wall_clock_in_an_hour_that_repeats(spark):
    """05:30 and 06:30 UTC are both 01:30 in New York on the night clocks go back;
    the UTC wall clock tells them apart in any session zone."""
    from tollgate.functions.cdr import utc_wall_clock

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Europe/Paris", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([("2025-11-02T05:30:00Z",), ("2025-11-02T06:30:00Z",), ("1969-12-31T23:59:59Z",), (None,)], "t string")
            rows = df.select(utc_wall_clock(F.try_to_timestamp("t")).cast("string").alias("u"),
                             utc_wall_clock(F.try_to_timestamp("t"), "America/New_York").cast("string").alias("n")).collect()
            assert [r.u for r in rows] == ["2025-11-02 05:30:00", "2025-11-02 06:30:00", "1969-12-31 23:59:59", None]
            assert [r.n for r in rows] == ["2025-11-02 01:30:00", "2025-11-02 01:30:00", "1969-12-31 18:59:59", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
