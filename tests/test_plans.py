"""Physical-plan properties that matter at scale."""

import re

from tollgate.plans.chain import Testbed, normalised_direct, rate_and_bill
from tollgate.operators import quality as Q
from tollgate.operators.rating import monthly_consumption

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _jobs_run(spark, build):
    """Jobs started while ``build`` makes a frame."""
    tracker = spark.sparkContext.statusTracker()
    group = f"build-{id(build)}"
    spark.sparkContext.setJobGroup(group, "building")
    try:
        build()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_operators_run_no_job(spark, tmp_dir):
    from tollgate import bill_monthly, cdr_with_plan, rate_monthly
    from tollgate.operators.rating import latest_runs, with_run

    tb = Testbed(spark, SF_SMALL)
    tb.rates().write.parquet(f"{tmp_dir}/rates")
    cdr, customers, stored = normalised_direct(tb.raw_records()), tb.customers(), spark.read.parquet(f"{tmp_dir}/rates")
    for rates in (tb.rates(), stored):
        assert _jobs_run(spark, lambda: bill_monthly(latest_runs(with_run(rate_monthly(cdr, customers, rates), 1)))) == 0
    assert _jobs_run(spark, lambda: cdr_with_plan(cdr, customers)) == 0
    assert _jobs_run(spark, lambda: Q.check(customers, Q.CUSTOMER_RULES)) == 0


def test_no_single_partition_before_a_join(spark, tmp_dir):
    tb = Testbed(spark, SF_SMALL)
    tb.rates().write.parquet(f"{tmp_dir}/rates")
    _, bills = rate_and_bill(normalised_direct(tb.raw_records()), tb.customers(), spark.read.parquet(f"{tmp_dir}/rates"))
    assert "SinglePartition" not in _formatted(bills)


def test_rated_usage_is_shuffled_once(spark):
    """With customers that AQE broadcasts from their measured size, the usage is
    shuffled for its aggregation only."""
    tb = Testbed(spark, SF_SMALL)
    rated, _ = rate_and_bill(normalised_direct(tb.raw_records()), tb.customers(), tb.rates())
    rated.collect()
    final = rated._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    usage = [line for line in final.splitlines() if re.search(r"Exchange hashpartitioning\(customer_id#\d+, record_type#\d+", line)]
    assert len(usage) == 1, final
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final.split("Nation")[0].split("n_name")[0]
    # a price book in the plan is broadcast; the usage never is
    assert final.count("BroadcastExchange") >= 2


def test_scan_prunes_columns(spark):
    tb = Testbed(spark, SF_SMALL)
    _, bills = rate_and_bill(normalised_direct(tb.raw_records()), tb.customers(), tb.rates())
    text = _formatted(bills)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    cust = [s for s in schemas if "c_custkey" in s][0]
    assert "c_mktsegment" not in cust and "c_name" not in cust
    counts = _formatted(monthly_consumption(normalised_direct(tb.raw_records()), tb.customers()))
    read = [s for s in re.findall(r"ReadSchema: (struct<[^\n]*>)", counts) if "c_custkey" in s][0]
    assert set(re.findall(r"(\w+):", read)) <= {"c_custkey", "c_acctbal", "c_nationkey"}


def test_filters_reach_the_scan(spark):
    tb = Testbed(spark, SF_SMALL)
    in_credit = tb.table("customer").filter("c_acctbal >= 0")
    text = _formatted(Q.check_fk(tb.table("orders"), in_credit, ["o_custkey"], ["c_custkey"]))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThanOrEqual(c_acctbal,0.0)" in text
    assert "IsNotNull(o_custkey)" in text


def test_key_checks_aggregate_map_side(spark):
    tb = Testbed(spark, SF_SMALL)
    text = _formatted(Q.check_unique(tb.table("lineitem"), ["l_orderkey"]))
    assert len(re.findall(r"^\(\d+\) HashAggregate", text, re.M)) == 2  # partial before the exchange, final after


def test_split_parses_each_message_once(spark):
    from tollgate.operators.mediation import split
    from tollgate.plans.chain import mediated_from_messages

    tb = Testbed(spark, SF_SMALL)
    valid, invalid = split(mediated_from_messages(tb.raw_messages()))
    for side in (valid, invalid):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        # one for the testbed's props, one for the raw message: the split's
        # filter is not pushed below the decode
        assert plan.count("from_json(") == 2, plan


def test_fk_check_shuffles_the_child_once(spark):
    tb = Testbed(spark, SF_SMALL)
    text = _formatted(Q.check_fk(tb.table("orders"), tb.table("customer"), ["o_custkey"], ["c_custkey"]))
    assert "LeftAnti" in text
    # one for the child rows, one for the distinct parent keys; the child is scanned once
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 2


def test_fk_check_against_rows_in_the_plan_shuffles_nothing(spark):
    from tollgate.sources.reference import rate_plans

    tb = Testbed(spark, SF_SMALL)
    text = _formatted(Q.check_fk(tb.customers(), rate_plans(spark), ["rate_plan_id"]))
    assert "LeftAnti" in text and "BroadcastHashJoin" in text


def test_mediation_and_normalisation_are_narrow(spark):
    from tollgate.operators.mediation import split
    from tollgate.plans.chain import mediated_from_messages

    tb = Testbed(spark, SF_SMALL)
    valid, invalid = split(mediated_from_messages(tb.raw_messages()))
    for df in (valid, invalid, normalised_direct(tb.raw_records())):
        text = _formatted(df)
        assert not re.findall(r"^\(\d+\) (?:Exchange|BroadcastExchange|Sort)\b", text, re.M), text
