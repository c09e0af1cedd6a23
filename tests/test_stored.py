"""The chain over stored, month-partitioned tables."""

from tollgate import normalise
from tollgate.plans.stored import bill_stored, rate_stored, store_normalised, stored_months
from tollgate.schemas import CUSTOMERS
from tollgate.sources.files import read_table
from tollgate.sources.reference import product_rates

MED = ("record_type string, timestamp string, cell_id string, technology string, msisdn string, "
       "peer_id string, duration long, volume_mb double, status string")


def _setup(spark, tmp_dir):
    rows = [
        ("voice", "2025-05-03T10:00:00Z", "C", "4G", "212660000001", "212660000002", 100, None, "valid"),
        ("voice", "2025-06-03T10:00:00Z", "C", "4G", "212660000001", "212660000002", 200, None, "valid"),
        ("data", "2025-06-04T10:00:00Z", "C", "4G", "212660000001", None, 10, 150.0, "valid"),
    ]
    cdr = normalise(spark.createDataFrame(rows, MED), with_month=True)
    store_normalised(cdr, f"{tmp_dir}/cdr")
    cust = spark.createDataFrame([("+212660000001", None, "postpaid", "RP1", None, "active", None)], CUSTOMERS)
    return cust


def test_month_filter_prunes_partitions(spark, tmp_dir):
    _setup(spark, tmp_dir)
    june = stored_months(spark, f"{tmp_dir}/cdr", ["2025-06"])
    plan = june._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and "2025-06" in plan
    assert june.count() == 2


def test_rerating_one_month_keeps_the_others(spark, tmp_dir):
    cust = _setup(spark, tmp_dir)
    rated_path, bills_path = f"{tmp_dir}/rated", f"{tmp_dir}/bills"
    all_rated = rate_stored(spark, f"{tmp_dir}/cdr", cust, product_rates(spark), rated_path)
    bill_stored(all_rated, bills_path)
    june = rate_stored(spark, f"{tmp_dir}/cdr", cust, product_rates(spark), rated_path, months=["2025-06"])
    bill_stored(june, bills_path, months=["2025-06"])
    rated = read_table(spark, rated_path)
    assert rated.count() == 3  # May voice, June voice, June data: no duplicates
    bills = {r.year_month: r.total_amount for r in read_table(spark, bills_path).collect()}
    assert set(bills) == {"2025-05", "2025-06"}
    assert abs(bills["2025-05"] - 1.0) < 1e-9 and abs(bills["2025-06"] - (2.0 + 2.5)) < 1e-9


def test_rerating_after_a_customer_ended_leaves_nothing_stale(spark, tmp_dir):
    from pyspark.sql import functions as F

    cust = _setup(spark, tmp_dir)
    rate_stored(spark, f"{tmp_dir}/cdr", cust, product_rates(spark), f"{tmp_dir}/rated")
    ended = cust.withColumn("status", F.lit("terminated"))
    june = rate_stored(spark, f"{tmp_dir}/cdr", ended, product_rates(spark), f"{tmp_dir}/rated", months=["2025-06"])
    assert june.count() == 0
    assert [r.year_month for r in read_table(spark, f"{tmp_dir}/rated").collect()] == ["2025-05"]


def test_backfill_clustering_writes_few_files(spark, tmp_dir):
    import glob

    from pyspark.sql import functions as F

    from tollgate.sinks.tables import write_normalised

    months = ["2025-01", "2025-02", "2025-03"]
    rows = spark.range(3000).select(
        F.concat(F.lit("+2126600"), F.lpad((F.col("id") % 97).cast("string"), 5, "0")).alias("customer_id"),
        F.element_at(F.array(*[F.lit(m) for m in months]), (F.col("id") % 3 + 1).cast("int")).alias("year_month"),
        F.col("id").alias("duration_sec"),
    ).repartition(12)
    write_normalised(rows, f"{tmp_dir}/plain")
    write_normalised(rows, f"{tmp_dir}/clustered", cluster_into=3)
    plain = glob.glob(f"{tmp_dir}/plain/year_month=*/*.parquet")
    clustered = glob.glob(f"{tmp_dir}/clustered/year_month=*/*.parquet")
    # a task may straddle a month boundary: at most tasks + months - 1 files
    assert len(plain) == 36 and len(clustered) <= 3 + len(months) - 1
    assert read_table(spark, f"{tmp_dir}/clustered").count() == 3000


def test_rating_stored_months_reads_four_columns(spark, tmp_dir):
    from tollgate import rate_monthly

    cust = _setup(spark, tmp_dir)
    cdr = stored_months(spark, f"{tmp_dir}/cdr", ["2025-06"])
    rated = rate_monthly(cdr, cust, product_rates(spark), month_col="year_month")
    plan = rated._jdf.queryExecution().executedPlan().toString()
    schemas = [s for s in plan.split("ReadSchema: ")[1:] if "record_type" in s]
    assert schemas and "timestamp" not in schemas[0].split("]")[0]
    assert schemas[0].startswith("struct<record_type:string,customer_id:string,duration_sec:bigint,data_volume_mb:double>")
    assert {r.year_month for r in rated.collect()} == {"2025-06"}


def test_backfill_clustering_splits_a_hot_subscriber(spark, tmp_dir):
    from pyspark.sql import functions as F

    from tollgate.sinks.tables import write_normalised

    n = 6000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("+212660000001"))
         .otherwise(F.concat(F.lit("+2126600"), F.lpad((F.col("id") % 500).cast("string"), 5, "0"))).alias("customer_id"),
        F.lit("2025-06").alias("year_month"),
        F.timestamp_seconds(F.lit(1748736000) + F.col("id")).alias("timestamp"),
    )
    write_normalised(rows, f"{tmp_dir}/c", cluster_into=6)
    sizes = read_table(spark, f"{tmp_dir}/c").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == n
    assert max(r["count"] for r in sizes) < n / 3   # the hot subscriber's third is split
