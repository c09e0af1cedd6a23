"""Constraint checks (C12, Q1-Q6) and row counts."""

from decimal import Decimal

from tollgate.operators import quality as Q
from tollgate.sources.reference import PRODUCT_RATES_DEFAULTS, product_rates, products, rate_plans


def test_allowed_values_null_passes(spark):
    df = spark.createDataFrame([("active",), ("gone",), (None,)], "status string")
    assert [r.status for r in Q.check_allowed(df, "status", ["active", "suspended"]).collect()] == ["gone"]


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), (None, 2)], "k string, j int")
    dup = Q.check_unique(df, ["k"]).collect()
    assert [(r.k, r.n_rows) for r in dup] == [("a", 2)]
    assert sorted(r.j for r in Q.check_not_null(df, ["k"]).collect()) == [2, 2]
    assert Q.check_unique(df, ["k", "j"]).count() == 1


def test_unique_with_a_hot_key(spark):
    rows = [("hot",)] * 3000 + [(str(i),) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string").repartition(8)
    out = Q.check_unique(df, ["k"]).collect()
    assert [(r.k, r.n_rows) for r in out] == [("hot", 3000)]


def test_foreign_key(spark):
    parent = spark.createDataFrame([("RP1",), ("RP2",)], "rate_plan_id string")
    child = spark.createDataFrame([("RP1", 1), ("RP3", 2), ("RP3", 3), (None, 4)], "rate_plan_id string, n int")
    assert sorted(r.n for r in Q.check_fk(child, parent, ["rate_plan_id"]).collect()) == [2, 3]


def test_defaults_only_for_absent_columns(spark):
    df = spark.createDataFrame([("RP1", "voice", None)], "rate_plan_id string, service_type string, free_units decimal(38,18)")
    out = Q.with_defaults(df, PRODUCT_RATES_DEFAULTS).collect()[0]
    assert out.free_units is None and out.tiered is False  # explicit null stays null
    bare = product_rates(spark).drop("free_units", "tiered")
    filled = Q.with_defaults(bare, PRODUCT_RATES_DEFAULTS).collect()
    assert {r.free_units for r in filled} == {Decimal(0)} and {r.tiered for r in filled} == {False}


def test_declared_rules_hold_on_seed_tables(spark):
    tables = {"rate_plans": rate_plans(spark), "products": products(spark), "product_rates": product_rates(spark)}
    rules = {"rate_plans": Q.RATE_PLAN_RULES, "products": Q.PRODUCT_RULES, "product_rates": Q.PRODUCT_RATE_RULES}
    for name, df in tables.items():
        assert Q.check(df, rules[name], parents=tables).collect() == [], name


def test_declared_rules_catch_violations(spark):
    df = spark.createDataFrame(
        [("+1", "c", "prepaid", "RP1", None, "active", None), ("+1", "d", "postpaid", "RP1", None, "closed", None)],
        "customer_id string, customer_name string, subscription_type string, rate_plan_id string, "
        "activation_date date, status string, region string")
    found = {(r.rule.split(" in ")[0], r.value): r.n_rows for r in Q.check(df, Q.CUSTOMER_RULES).collect()}
    assert found == {("unique(customer_id)", '{"customer_id":"+1"}'): 2,
                     ("allowed(subscription_type)", '{"subscription_type":"prepaid"}'): 1,
                     ("allowed(status)", '{"status":"closed"}'): 1}


def test_no_rule_is_lost(spark):
    """Two foreign keys, and two lists of allowed values, on one column."""
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parents = {"p1": spark.createDataFrame([("a",)], "k string"), "p2": spark.createDataFrame([("b",)], "k string")}
    rules = [Q.Rule("fk", ("k",), parent="p1"), Q.Rule("fk", ("k",), parent="p2"),
             Q.Rule("allowed", ("k",), allowed=("a",)), Q.Rule("allowed", ("k",), allowed=("b",)), Q.Rule("not_null", ("k",))]
    found = sorted((r.rule, r.value, r.n_rows) for r in Q.check(child, rules, parents).collect())
    assert found == [("allowed(k) in (a)", '{"k":"b"}', 2), ("allowed(k) in (b)", '{"k":"a"}', 1),
                     ("fk(k) -> p1(k)", '{"k":"b"}', 2), ("fk(k) -> p2(k)", '{"k":"a"}', 1), ("not_null(k)", "{}", 1)]
    assert Q.check(child, []).count() == 0


def test_row_counts(spark):
    out = {r.table_name: r.row_count for r in Q.row_counts(
        {"plans": rate_plans(spark), "products": products(spark), "rates": product_rates(spark)}).collect()}
    assert out == {"plans": 2, "products": 3, "rates": 6}
