"""Sinks (K3-K7) and sources."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import needs_database

from tollgate.schemas import RAW_CDR, RATED_USAGE
from tollgate.sinks.jdbc import jdbc_write_options
from tollgate.sinks.kafka import kafka_sink_options
from tollgate.sinks.tables import batch_table_writer, write_bills, write_rated
from tollgate.sources.files import read_snapshot, read_table
from tollgate.sources.jdbc import jdbc_read_options
from tollgate.sources.kafka import kafka_options


def _rated(spark, months):
    rows = [("+1", "RP1", "voice", m, 10.0, None, 10.0, None, 0.1) for m in months]
    return spark.createDataFrame(rows, RATED_USAGE)


def test_rated_replace_months_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/rated"
    write_rated(_rated(spark, ["2025-05", "2025-06"]), path)
    write_rated(_rated(spark, ["2025-06"]), path, months=["2025-06"])  # re-rate June only
    out = read_table(spark, path, RATED_USAGE)
    assert sorted(r.year_month for r in out.collect()) == ["2025-05", "2025-06"]
    assert [f.name for f in out.schema.fields] == [f.name for f in RATED_USAGE.fields]


def test_replaced_month_without_rows_is_empty(spark, tmp_dir):
    path = f"{tmp_dir}/rated"
    write_rated(_rated(spark, ["2025-04", "2025-05", "2025-06"]), path)
    write_rated(_rated(spark, ["2025-05"]), path, months=["2025-05", "2025-06"])  # nothing left in June
    assert sorted(r.year_month for r in read_table(spark, path, RATED_USAGE).collect()) == ["2025-04", "2025-05"]
    write_rated(_rated(spark, []), path, months=["2025-04"])
    assert [r.year_month for r in read_table(spark, path, RATED_USAGE).collect()] == ["2025-05"]
    write_rated(_rated(spark, ["2025-01"]), path)  # no months named: the whole table
    assert [r.year_month for r in read_table(spark, path, RATED_USAGE).collect()] == ["2025-01"]


def test_rated_files_are_few(spark, tmp_dir):
    import glob

    rated = _rated(spark, [f"2025-{m:02d}" for m in range(1, 13)] * 50).repartition(8)
    write_rated(rated, f"{tmp_dir}/rated")
    assert len(glob.glob(f"{tmp_dir}/rated/*/*.parquet")) == 12  # a file per month, not per task and month


def test_rated_append_duplicates(spark, tmp_dir):
    path = f"{tmp_dir}/rated"
    write_rated(_rated(spark, ["2025-06"]), path, mode="append")
    write_rated(_rated(spark, ["2025-06"]), path, mode="append")  # D22
    assert read_table(spark, path).count() == 2
    with pytest.raises(ValueError):
        write_rated(_rated(spark, ["2025-06"]), path, mode="merge")


def test_bills_overwrite(spark, tmp_dir):
    bills = spark.createDataFrame([("+1", "2025-06", 1.0, 1, "RP1")],
                                  "customer_id string, year_month string, total_amount double, num_services long, rate_plan_id string")
    write_bills(bills, f"{tmp_dir}/b")
    write_bills(bills, f"{tmp_dir}/b")  # D24
    assert read_table(spark, f"{tmp_dir}/b").count() == 1


def test_batch_writer_replay_replaces(spark, tmp_dir):
    w = batch_table_writer(f"{tmp_dir}/t")
    df = spark.range(5)
    w(df, 0)
    w(df, 0)  # replayed batch
    w(spark.range(3), 1)
    w(spark.range(0), 2)  # empty batch: skipped
    assert read_table(spark, f"{tmp_dir}/t").count() == 8
    assert not os.path.exists(f"{tmp_dir}/t/batch_id=2")


def test_batch_writer_error_policy(spark, tmp_dir):
    bad = spark.createDataFrame([(1,)], "a int")
    blocker = f"{tmp_dir}/file"
    open(blocker, "w").write("x")  # a file where a folder must go
    with pytest.raises(Exception):
        batch_table_writer(blocker)(bad, 0)
    batch_table_writer(blocker, on_error="skip")(bad, 0)  # swallowed (D25)


def test_snapshot_json_array_file(spark, tmp_dir):
    recs = [{"record_type": "voice", "caller_id": "212660000001", "duration_sec": 5},
            {"record_type": "sms", "sender_id": "212660000002", "extra": 1},
            {"record_type": "data", "user_id": "212660000003", "data_volume_mb": 1.5}]
    with open(f"{tmp_dir}/dump.json", "w") as f:
        json.dump(recs, f, indent=2)
    df = read_snapshot(spark, f"{tmp_dir}/dump.json")
    assert df.schema == RAW_CDR
    rows = df.collect()
    assert [r.record_type for r in rows] == ["voice", "sms", "data"]
    assert rows[0].duration_sec == 5 and rows[2].data_volume_mb == 1.5


@needs_database
def test_connector_options():
    o = kafka_options("broker:9092", "raw-cdr")
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "raw-cdr",
                 "startingOffsets": "latest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5000000"}
    assert kafka_options("b", "valid-cdr", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    bounded = kafka_options("b", "raw-cdr", max_offsets_per_trigger=100000, min_partitions=64)
    assert bounded["maxOffsetsPerTrigger"] == "100000" and bounded["minPartitions"] == "64"
    assert kafka_sink_options("b", "valid-cdr", "/ck")["topic"] == "valid-cdr"
    r = jdbc_read_options("jdbc:x", "customers", {"user": "u"}, partition_column="id",
                          lower_bound=0, upper_bound=100, num_partitions=4)
    assert r["numPartitions"] == "4" and r["partitionColumn"] == "id" and r["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", "t", partition_column="id")
    w = jdbc_write_options("jdbc:x", "monthly_bills", truncate=True)
    assert w["truncate"] == "true"


def _derby_url():
    import uuid

    # Embedded in-memory database inside the Spark JVM: opens no port.
    return f"jdbc:derby:memory:tg{uuid.uuid4().hex[:12]};create=true"


def _bills(spark, n=4):
    rows = [(f"+{i}", "2025-06", float(i), 1, "RP1") for i in range(n)]
    return spark.createDataFrame(
        rows, "customer_id string, year_month string, total_amount double, num_services long, rate_plan_id string")


@needs_database
def test_jdbc_append_creates_then_overwrite_replaces(spark):
    from tollgate.sinks.jdbc import write_jdbc
    from tollgate.sources.jdbc import read_jdbc

    url = _derby_url()
    bills = _bills(spark)
    write_jdbc(bills, url, "MONTHLY_BILLS")                    # K7: append creates the table
    write_jdbc(bills, url, "MONTHLY_BILLS")                    # D22-style append duplicates
    assert read_jdbc(spark, url, "MONTHLY_BILLS").count() == 8
    write_jdbc(bills, url, "MONTHLY_BILLS", mode="overwrite", truncate=True)   # K5
    back = read_jdbc(spark, url, "MONTHLY_BILLS")
    assert back.count() == 4
    assert sorted(r.customer_id for r in back.collect()) == sorted(r.customer_id for r in bills.collect())
    pushed = back.filter(F.col("total_amount") > 1.0)
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(total_amount), *GreaterThan(total_amount,1.0)]" in plan
    assert pushed.count() == 2


@needs_database
def test_jdbc_partitioned_read(spark):
    from tollgate.sinks.jdbc import write_jdbc
    from tollgate.sources.jdbc import read_jdbc

    url = _derby_url()
    write_jdbc(_bills(spark, 10), url, "BILLS")
    df = read_jdbc(spark, url, "BILLS", partition_column="total_amount", lower_bound=0, upper_bound=10,
                   num_partitions=3)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 10


@needs_database
def test_jdbc_batch_writer_exactly_once_with_keys(spark):
    from tollgate.sinks.jdbc import jdbc_batch_writer
    from tollgate.sources.jdbc import read_jdbc

    url = _derby_url()
    batch = spark.createDataFrame([(i, f"+{i}", "voice") for i in range(6)],
                                  "offset long, customer_id string, record_type string")
    keyed = jdbc_batch_writer(url, "CDR", key_columns=("offset",))
    keyed(batch.filter("offset < 2"), 7)       # a batch that failed half-way
    keyed(batch, 7)                            # replay: only the missing rows
    keyed(batch, 7)                            # second replay: nothing
    keyed(batch.limit(0), 8)                   # empty batch skipped
    out = read_jdbc(spark, url, "CDR")
    assert out.count() == 6 and out.select("offset").distinct().count() == 6
    assert {r.batch_id for r in out.collect()} == {7}

    plain = jdbc_batch_writer(url, "CDR_PLAIN")
    plain(batch, 1)
    plain(batch, 1)                            # at-least-once without keys
    assert read_jdbc(spark, url, "CDR_PLAIN").count() == 12


@needs_database
def test_jdbc_batch_writer_error_policy(spark):
    from tollgate.sinks.jdbc import jdbc_batch_writer

    batch = _bills(spark)
    bad = "jdbc:derby:memory:does_not_exist_" + "x"     # no create=true: connection fails
    with pytest.raises(Exception):
        jdbc_batch_writer(bad, "T")(batch, 0)
    jdbc_batch_writer(bad, "T", on_error="skip")(batch, 0)  # D25: logged and dropped


@needs_database
def test_rerating_through_an_append_only_table(spark):
    from tollgate.operators.rating import latest_runs, with_run
    from tollgate.sinks.jdbc import write_jdbc
    from tollgate.sources.jdbc import read_jdbc

    url = _derby_url()
    first = spark.createDataFrame(
        [("+1", "RP1", "voice", "2025-05", 10.0, 0.1), ("+1", "RP1", "voice", "2025-06", 20.0, 0.2),
         ("+2", "RP2", "sms", None, 1.0, 0.03)],
        "customer_id string, rate_plan_id string, record_type string, year_month string, "
        "billable_units double, cost double")
    write_jdbc(with_run(first, 1), url, "RATED")
    june_again = first.filter("year_month = '2025-06'").withColumn("cost", F.lit(0.5))
    write_jdbc(with_run(june_again, 2), url, "RATED")          # re-rate June only
    latest = {(r.year_month, r.run_id): r.cost for r in latest_runs(read_jdbc(spark, url, "RATED")).collect()}
    assert latest == {("2025-05", 1): 0.1, ("2025-06", 2): 0.5, (None, 1): 0.03}


class _SqlError(Exception):
    """Stands in for an exception of Spark's with a database error behind it."""

    def __init__(self, state):
        class Java:
            def getSQLState(self):
                return state

        class Wrapper:
            def getCause(self):
                return Java()

        super().__init__(state)
        self.java_exception = Wrapper()


def test_keyed_writer_appends_only_when_written_rows_are_known(spark, monkeypatch):
    from tollgate.sinks import jdbc
    from tollgate.sources import jdbc as source

    batch = spark.createDataFrame([("raw", 0, i, f"+{i}") for i in (4, 5, 6, 6)],
                                  "raw_topic string, raw_partition int, raw_offset long, customer_id string")
    written = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, *a, **k: written.append(sorted(r.raw_offset for r in df.collect())))
    writer = jdbc.jdbc_batch_writer("jdbc:x", "CDR", key_columns=("raw_topic", "raw_partition", "raw_offset"))

    def answer(value):
        def read(*a, **k):
            if isinstance(value, Exception):
                raise value
            return value

        monkeypatch.setattr(source, "read_jdbc", read)

    answer(_SqlError("42P01"))  # no such table: all rows, each message once
    writer(batch, 3)
    # A message that an earlier batch wrote, under whatever batch id, is not written again.
    answer(spark.createDataFrame([("raw", 0, 5), ("raw", 1, 6), ("raw", 0, 99)], "raw_topic string, raw_partition int, raw_offset long"))
    writer(batch, 4)
    assert written == [[4, 5, 6], [4, 6]]
    for error in (_SqlError("42501"), _SqlError("08006"), RuntimeError("timeout")):
        answer(error)
        with pytest.raises(type(error)):
            writer(batch, 5)
    assert len(written) == 2


def test_keyed_writer_keeps_every_row_without_keys(spark, monkeypatch):
    from tollgate.sinks import jdbc
    from tollgate.sources import jdbc as source

    schema = "raw_topic string, raw_partition int, raw_offset long, customer_id string"
    rows = [("raw", 0, 4, "+4"), ("raw", 0, 4, "+4"), ("raw", 0, 5, "+5"), (None, None, None, "a"), (None, None, None, "a"),
            (None, None, None, "b"), ("raw", 0, None, "c"), ("raw", 0, None, "d"), (None, 0, 5, "e")]
    written = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, *a, **k: written.append(sorted(r.customer_id for r in df.collect())))
    existing = spark.createDataFrame([("raw", 0, 5), (None, None, None), (None, 0, 5)], schema.rsplit(",", 1)[0])
    monkeypatch.setattr(source, "read_jdbc", lambda *a, **k: existing)
    writer = jdbc.jdbc_batch_writer("jdbc:x", "CDR", key_columns=("raw_topic", "raw_partition", "raw_offset"))
    writer(spark.createDataFrame(rows, schema), 1)
    writer(spark.createDataFrame(rows[3:6], schema), 2)  # no key at all in the batch
    assert written == [["+4", "a", "a", "b", "c", "d", "e"], ["a", "a", "b"]]


def test_batch_writer_does_not_cache_a_cached_side_twice(spark, tmp_dir, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    from tollgate.sinks.tables import side_of_cached

    persisted = []
    persist = Frame.persist
    monkeypatch.setattr(Frame, "persist", lambda self, *a: persisted.append(self) or persist(self, *a))
    batch = spark.range(10).withColumn("even", F.col("id") % 2 == 0)
    batch_table_writer(f"{tmp_dir}/a")(batch.filter("even"), 0)
    assert len(persisted) == 1
    batch_table_writer(f"{tmp_dir}/b")(side_of_cached(batch.filter("even")), 0)
    assert len(persisted) == 1
    assert read_table(spark, f"{tmp_dir}/a").count() == read_table(spark, f"{tmp_dir}/b").count() == 5


@needs_database
def test_kafka_shaped_batch_to_jdbc_exactly_once(spark):
    # A frame with the Kafka source's columns (no broker here): the message
    # coordinates ride along through decode, mediation and normalisation and
    # key the JDBC writer, so a replayed batch adds nothing.
    from tollgate import decode, mediate, normalise, split
    from tollgate.schemas import NORMALISED_CDR, RAW_CDR
    from tollgate.sinks.jdbc import jdbc_batch_writer
    from tollgate.sources.jdbc import read_jdbc

    msgs = [json.dumps({"record_type": "voice", "timestamp": "2025-06-12T09:30:05Z",
                        "caller_id": f"2126600000{i:02d}", "callee_id": "212660000099", "duration_sec": i})
            for i in range(5)] + ["junk"]
    kafka = spark.createDataFrame(
        [(None, m.encode(), "raw-cdr", 0, off) for off, m in enumerate(msgs)],
        "key binary, value binary, topic string, partition int, offset long")
    coords = ("topic", "partition", "offset")
    valid, invalid = split(mediate(decode(kafka, RAW_CDR, keep=coords)))
    assert [r.offset for r in invalid.collect()] == [5]              # the dead letter keeps its coordinates
    rows = normalise(valid, keep=coords)
    assert rows.columns == [f.name for f in NORMALISED_CDR.fields] + list(coords)
    url = _derby_url()
    writer = jdbc_batch_writer(url, "CDR", key_columns=coords)
    writer(rows.filter("offset < 3"), 0)                             # a write that failed half-way
    writer(rows, 0)                                                  # the replay
    back = read_jdbc(spark, url, "CDR")
    assert back.count() == 5 and sorted(r.offset for r in back.collect()) == [0, 1, 2, 3, 4]


def test_partitioned_batch_writer_keeps_months_together(spark, tmp_dir):
    w = batch_table_writer(f"{tmp_dir}/t", partition_by=("year_month",))
    may = spark.createDataFrame([("2025-05", 1), ("2025-06", 2)], "year_month string, v int")
    w(may, 0)
    w(may, 0)                                             # replay replaces its own folders
    w(spark.createDataFrame([("2025-06", 3)], "year_month string, v int"), 1)
    assert sorted(os.listdir(f"{tmp_dir}/t/year_month=2025-06")) == ["batch_id=0", "batch_id=1"]
    got = sorted((r.year_month, r.v, r.batch_id) for r in read_table(spark, f"{tmp_dir}/t").collect())
    assert got == [("2025-05", 1, 0), ("2025-06", 2, 0), ("2025-06", 3, 1)]


@needs_database
def test_jdbc_split_and_predicate_reads(spark):
    from tollgate.sinks.jdbc import write_jdbc
    from tollgate.sources.jdbc import read_jdbc_predicates, read_jdbc_split

    url = _derby_url()
    write_jdbc(_bills(spark, 20), url, "BILLS")
    split = read_jdbc_split(spark, url, "BILLS", "total_amount", 4)
    assert split.rdd.getNumPartitions() == 4 and split.count() == 20
    # predicates are the database's SQL: the column was created quoted, in lower case
    by_digit = read_jdbc_predicates(spark, url, "BILLS", [f"\"customer_id\" LIKE '%{d}'" for d in range(10)])
    assert by_digit.rdd.getNumPartitions() == 10 and by_digit.count() == 20
    assert sorted(r.customer_id for r in by_digit.collect()) == sorted(f"+{i}" for i in range(20))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from tollgate.session import shared_dir

    def session(master, folder=None):
        context = SimpleNamespace(
            master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: d), getCheckpointDir=lambda: None,
            setCheckpointDir=lambda d: None,
        )
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder), sparkContext=context)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
        assert shared_dir(session(master, "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(session("local[4]"))
