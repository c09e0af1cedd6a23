"""How many customers and services a region had in a month, and over any months, from
mergeable sketches.

Distinct counts don't add up: the customers of a quarter are not the sum of its months'.
A HyperLogLog sketch per region and month is a few kilobytes whatever the rows, is stored
with the month's exact counts, and merges: the sketch of several months is the union of
theirs, so a count over any months reads no record again.  The relative standard error is about
``1.04 / sqrt(2 ** lg_k)`` (1.6 % at the default); small sets are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions import cdr as X
from tollgate.plans.joins import join_dimension

LG_K = 12


def monthly_reach(cdr: DataFrame, customers: DataFrame, lg_k: int = LG_K, time_zone: str = "UTC") -> DataFrame:
    """``region, year_month, n_customers, n_services`` (exact) and ``customers, services``
    (sketches) of stored records.  Records are first reduced to distinct (customer, service,
    month), map-side too, before they meet the customers."""
    used = (
        cdr.filter(F.col("customer_id").isNotNull())
        .select("customer_id", "record_type", X.billing_month("timestamp", time_zone).alias("year_month"))
        .distinct()
    )
    regions = customers.select("customer_id", "region").dropDuplicates(["customer_id"])
    return (
        join_dimension(used, regions, ["customer_id"])
        .groupBy("region", "year_month")
        .agg(
            F.count_distinct("customer_id").alias("n_customers"),
            F.count_distinct("record_type").alias("n_services"),
            F.hll_sketch_agg("customer_id", lg_k).alias("customers"),
            F.hll_sketch_agg("record_type", lg_k).alias("services"),
        )
    )


def merged_reach(stored: DataFrame, by: tuple[str, ...] = ("region",)) -> DataFrame:
    """Sketches of stored months, merged per ``by``, with their estimates."""
    merged = stored.groupBy(*by).agg(
        F.hll_union_agg("customers").alias("customers"), F.hll_union_agg("services").alias("services")
    )
    return merged.withColumns(
        {
            "est_customers": F.hll_sketch_estimate("customers"),
            "est_services": F.hll_sketch_estimate("services"),
        }
    )
