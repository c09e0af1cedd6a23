"""Rating (C8-C10) and billing (C11): D12-D23 and the pricing cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollgate import bill_monthly, monthly_consumption, price, rate_monthly, cdr_with_plan
from tollgate.schemas import CUSTOMERS, NORMALISED_CDR
from tollgate.sources.reference import product_rates

T = dt.datetime(2025, 6, 11, 12, 0, 0)


def _cdr(spark, rows):
    """rows: (record_type, customer_id, duration_sec, data_volume_mb, timestamp)."""
    full = [(t, c, None, None, None, None, d, v, 0, ts) for t, c, d, v, ts in rows]
    return spark.createDataFrame(full, NORMALISED_CDR)


def _customers(spark, rows):
    """rows: (customer_id, rate_plan_id, status)."""
    return spark.createDataFrame([(c, None, "postpaid", p, None, s, None) for c, p, s in rows], CUSTOMERS)


def _rated(spark, cdr_rows, cust_rows, **kw):
    out = rate_monthly(_cdr(spark, cdr_rows), _customers(spark, cust_rows), product_rates(spark), **kw)
    return {(r.customer_id, r.record_type, r.year_month): r for r in out.collect()}


def test_pricing_cases(spark):
    cdr = [
        ("voice", "+1", 1000, 0.0, T), ("voice", "+1", 544, 0.0, T),            # RP1 voice 1544
        ("voice", "+2", 2632, 0.0, T),                                          # RP2 voice 2632
        ("data", "+1", 0, 122.93, T), ("data", "+1", 0, 100.0, T),              # RP1 data 222.93
        ("data", "+2", 0, 27.91, T), ("data", "+2", 0, 200.0, T),               # RP2 data 227.91
        ("data", "+3", 0, 100.0, T),                                            # RP1 data = allowance
        ("voice", "+3", -60, 0.0, T),                                           # negative lowers the sum
        ("other", "+3", 5, 0.0, T),                                             # no price row
    ] + [("sms", "+3", 0, 0.0, T)] * 50 + [("sms", "+5", 0, 0.0, T)] * 51       # RP1 sms 50 / 51
    cust = [("+1", "RP1", "active"), ("+2", "RP2", "active"), ("+3", "RP1", "active"), ("+5", "RP1", "active")]
    r = _rated(spark, cdr, cust)
    m = "2025-06"
    assert r[("+1", "voice", m)].cost == pytest.approx(15.44)
    assert r[("+2", "voice", m)].cost == pytest.approx(21.056)
    assert r[("+1", "data", m)].billable_units == pytest.approx(122.93)
    assert r[("+1", "data", m)].cost == pytest.approx(6.1465)
    assert r[("+2", "data", m)].billable_units == pytest.approx(27.91)
    assert r[("+2", "data", m)].cost == pytest.approx(0.8373)
    assert r[("+3", "data", m)].billable_units == 0 and r[("+3", "data", m)].cost == 0
    assert r[("+3", "sms", m)].cost == 0 and r[("+5", "sms", m)].cost == pytest.approx(0.05)
    assert r[("+3", "voice", m)].total_consumption_units == -60 and r[("+3", "voice", m)].cost == 0
    other = r[("+3", "other", m)]
    assert other.total_consumption_units == 0 and other.billable_units == 0 and other.cost is None
    assert other.free_units is None and other.unit_price is None


def test_bills(spark):
    cdr = [("voice", "+5", 2632, 0.0, T), ("data", "+5", 0, 227.91, T), ("other", "+6", 1, 0.0, T),
           ("voice", "+7", 100, 0.0, T), ("other", "+7", 1, 0.0, T)]
    cust = [("+5", "RP2", "active"), ("+6", "RP2", "active"), ("+7", "RP1", "active")]
    rated = rate_monthly(_cdr(spark, cdr), _customers(spark, cust), product_rates(spark))
    bills = {b.customer_id: b for b in bill_monthly(rated).collect()}
    assert bills["+5"].total_amount == pytest.approx(21.8933) and bills["+5"].num_services == 2
    assert bills["+5"].rate_plan_id == "RP2"
    assert bills["+6"].total_amount is None and bills["+6"].num_services == 1  # D23: all null -> null
    assert bills["+7"].total_amount == pytest.approx(1.0) and bills["+7"].num_services == 2


def test_only_active_customers_are_rated(spark):
    cdr = [("voice", c, 10, 0.0, T) for c in ("+1", "+2", "+3", "+4", "+9")]
    cust = [("+1", "RP1", "active"), ("+2", "RP1", "suspended"), ("+3", "RP1", None), ("+4", None, "active")]
    r = _rated(spark, cdr, cust)
    assert set(k[0] for k in r) == {"+1", "+4"}  # D14: unknown, suspended, null status vanish
    assert r[("+4", "voice", "2025-06")].cost is None  # active without plan stays, unpriced


def test_allowance_applies_to_monthly_sum(spark):
    # 30 + 30 sms in June against 50 free -> 10 billable, not 0 + 0
    jun, jul = dt.datetime(2025, 6, 1), dt.datetime(2025, 7, 1)
    cdr = [("sms", "+1", 0, 0.0, jun)] * 60 + [("sms", "+1", 0, 0.0, jul)] * 10
    r = _rated(spark, cdr, [("+1", "RP1", "active")])
    assert r[("+1", "sms", "2025-06")].billable_units == 10
    assert r[("+1", "sms", "2025-07")].billable_units == 0


def test_null_time_forms_its_own_month(spark):
    cdr = [("voice", "+1", 10, 0.0, None), ("voice", "+1", 5, 0.0, T)]
    r = _rated(spark, cdr, [("+1", "RP1", "active")])
    assert r[("+1", "voice", None)].total_consumption_units == 10  # D12
    assert r[("+1", "voice", "2025-06")].total_consumption_units == 5


def test_month_does_not_depend_on_session_zone(spark):
    late = dt.datetime(2025, 6, 30, 23, 30, 0)  # UTC instant
    cdr = _cdr(spark, [("voice", "+1", 10, 0.0, late)])
    cust = _customers(spark, [("+1", "RP1", "active")])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        months = {r.year_month for r in monthly_consumption(cdr, cust).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert months == {"2025-06"}


def test_duplicate_customer_rows_keep_reference_semantics(spark):
    # A customer id listed twice with the same plan doubles the usage (as a
    # row-level join would); the result stays one row per key.
    cdr = [("voice", "+1", 10, 0.0, T), ("voice", "+1", 20, 0.0, T)]
    cust = [("+1", "RP1", "active"), ("+1", "RP1", "active")]
    r = _rated(spark, cdr, cust)
    assert len(r) == 1 and r[("+1", "voice", "2025-06")].total_consumption_units == 60


def test_units_by_type_are_double(spark):
    cdr = [("voice", "+1", 7, 9.0, T), ("sms", "+1", 7, 9.0, T), ("data", "+1", 7, 2.5, T)]
    out = cdr_with_plan(_cdr(spark, cdr), _customers(spark, [("+1", "RP1", "active")]))
    assert dict(out.dtypes)["consumption_units"] == "double"
    assert sorted(r.consumption_units for r in out.collect()) == [1.0, 2.5, 7.0]


def test_price_broadcast_and_salted_agree(spark, tmp_dir):
    cons = spark.createDataFrame([("+1", "RP1", "data", "2025-06", 150.0)],
                                 "customer_id string, rate_plan_id string, record_type string, year_month string, total_consumption_units double")
    a = price(cons, product_rates(spark)).collect()  # rows in the plan: broadcast
    product_rates(spark).write.parquet(f"{tmp_dir}/rates")
    stored = spark.read.parquet(f"{tmp_dir}/rates")  # salted
    b = price(cons, stored).collect()
    c = price(cons, stored, salts=1).collect()
    assert a == b == c and a[0].cost == pytest.approx(2.5)


def test_bill_plan_pick(spark):
    rated = spark.createDataFrame(
        [("+1", "RP2", "voice", "2025-06", 1.0), ("+1", "RP1", "sms", "2025-06", 2.0)],
        "customer_id string, rate_plan_id string, record_type string, year_month string, cost double")
    b = bill_monthly(rated).collect()[0]
    assert b.rate_plan_id == "RP1" and b.total_amount == 3.0 and b.num_services == 2
    with pytest.raises(ValueError):
        bill_monthly(rated, plan_pick="max")


def test_decimal_pricing_is_exact(spark):
    from decimal import Decimal

    cdr = [("data", "+1", 0, 122.93, T), ("data", "+1", 0, 100.0, T), ("voice", "+2", 2632, 0.0, T),
           ("other", "+2", 5, 0.0, T)]
    cust = [("+1", "RP1", "active"), ("+2", "RP2", "active")]
    r = _rated(spark, cdr, cust, decimal=True)
    data = r[("+1", "data", "2025-06")]
    assert data.billable_units == Decimal("122.930000") and data.cost == Decimal("6.146500")
    assert r[("+2", "voice", "2025-06")].cost == Decimal("21.056000")
    assert r[("+2", "other", "2025-06")].cost is None
    floats = _rated(spark, cdr, cust)
    assert abs(floats[("+1", "data", "2025-06")].cost - 6.1465) < 1e-9


def test_hot_subscriber_is_pre_aggregated(spark):
    # One subscriber holds a third of all records.
    n = 30_000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("+1")).otherwise(F.concat(F.lit("+"), (F.col("id") % 500 + 2).cast("string"))).alias("customer_id"),
        F.col("id"),
    )
    cdr = base.select(
        F.lit("voice").alias("record_type"), "customer_id", F.lit(None).cast("string").alias("cell_id"),
        F.lit(None).cast("string").alias("technology"), F.lit(None).cast("string").alias("receiver_id"),
        F.lit(None).cast("string").alias("callee_id"), (F.col("id") % 7).alias("duration_sec"),
        F.lit(0.0).alias("data_volume_mb"), F.lit(0).cast("long").alias("session_duration_sec"),
        F.lit(T).cast("timestamp").alias("timestamp"),
    )
    cust = _customers(spark, [("+1", "RP1", "active")] + [(f"+{i}", "RP2", "active") for i in range(2, 502)])
    cons = monthly_consumption(cdr.repartition(8), cust)
    plan = cons._jdf.queryExecution().executedPlan().toString()
    hot = [r for r in cons.collect() if r.customer_id == "+1"]
    assert len(hot) == 1 and hot[0].total_consumption_units == sum(i % 7 for i in range(0, n, 3))
    # the exchange on the usage keys carries partial sums (one row per key and
    # task), never the hot subscriber's raw records
    import re
    assert re.search(r"Exchange hashpartitioning\(customer_id#\d+, [^#]+#\d+, [^#]+#\d+, \d+\), ENSURE_REQUIREMENTS"
                     r"[^\n]*\n[\s:|]*\+- HashAggregate\(keys=\[[^\]]*\], functions=\[partial_sum", plan), plan


def test_bill_plan_as_key_is_hash_only_and_equal_when_plans_are_unique(spark):
    from tollgate.plans.chain import Testbed, normalised_direct

    tb = Testbed(spark, "/root/testdata/sf0.001")
    rated = rate_monthly(normalised_direct(tb.raw_records()), tb.customers(), tb.rates())
    by_min, by_key = bill_monthly(rated), bill_monthly(rated, plan_pick="key")
    assert by_key.columns == by_min.columns
    # A month with services without a price alone has no amount.
    amount = lambda r: None if r.total_amount is None else round(r.total_amount, 6)
    rows = lambda df: sorted(((r.customer_id, r.year_month, amount(r), r.num_services, r.rate_plan_id) for r in df.collect()), key=str)
    assert rows(by_key) == rows(by_min)
    plan = by_key._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    two_plans = spark.createDataFrame(
        [("+1", "RP2", "voice", "2025-06", 1.0), ("+1", "RP1", "sms", "2025-06", 2.0)],
        "customer_id string, rate_plan_id string, record_type string, year_month string, cost double")
    assert bill_monthly(two_plans, plan_pick="key").count() == 2


def test_record_level_join_splits_a_hot_subscriber(spark):
    # Customers not broadcast (as above the broadcast bound): a sort-merge
    # join on customer_id in which AQE splits the hot subscriber's partition.
    # Thresholds are lowered so that test-sized data counts as skewed.
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}  # customers too large to broadcast
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 40_000
        cdr = spark.range(n).select(
            F.lit("voice").alias("record_type"),
            F.when(F.col("id") % 3 == 0, F.lit("+1"))
             .otherwise(F.concat(F.lit("+"), (F.col("id") % 400 + 2).cast("string"))).alias("customer_id"),
            *[F.lit(None).cast("string").alias(c) for c in ("cell_id", "technology", "receiver_id", "callee_id")],
            F.col("id").alias("duration_sec"), F.lit(0.0).alias("data_volume_mb"),
            F.lit(0).cast("long").alias("session_duration_sec"), F.lit(T).cast("timestamp").alias("timestamp"))
        cust = _customers(spark, [(f"+{i}", "RP1", "active") for i in range(1, 402)])
        out = cdr_with_plan(cdr, cust)
        rows = out.collect()
        assert len(rows) == n and sum(1 for r in rows if r.customer_id == "+1") == (n + 2) // 3
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
