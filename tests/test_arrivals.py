"""Streams with keyed state: resent records (T1, D27), primary keys (Q2-Q4), and
consumption kept up to date (C8, A1)."""

import json
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tollgate.operators.rating import rate_monthly
from tollgate.schemas import CUSTOMERS, NORMALISED_CDR
from tollgate.sinks.tables import batch_table_writer
from tollgate.sources.files import message_files, read_table
from tollgate.sources.reference import product_rates
from tollgate.streaming.keys import first_of_key, run_key_check
from tollgate.streaming.resent import late_rows, rocksdb_state, without_resent
from tollgate.streaming.runners import run_mediation_streams, run_store, wait_any
from tollgate.streaming.usage import UsageStore, run_usage

NOW = {"availableNow": True}


def message(minute, number=1, duration=5, kind="voice", day=12, month=6):
    at = None if minute is None else f"2025-{month:02d}-{day:02d}T{minute // 60:02d}:{minute % 60:02d}:00Z"
    return json.dumps({"record_type": kind, "timestamp": at, "msisdn": f"21266{number:07d}", "duration": duration,
                       "volume_mb": float(duration), "status": "valid"})


def drop(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def store(spark, root, sink=None, **options):
    return run_store(message_files(spark, f"{root}/in", 1), sink or batch_table_writer(f"{root}/out"), f"{root}/ck", NOW, **options)


def durations(spark, root):
    return sorted(r.duration_sec for r in read_table(spark, f"{root}/out").collect())


def test_resent_records_are_stored_once_also_after_a_restart(spark, tmp_dir):
    drop(f"{tmp_dir}/in", "a.txt", [message(600, duration=1), message(600, duration=1), message(601, duration=2)])
    store(spark, tmp_dir, resent_within="2 hours").awaitTermination()
    drop(f"{tmp_dir}/in", "b.txt", [message(600, duration=1), message(590, duration=3), message(601, number=2, duration=4)])
    store(spark, tmp_dir, resent_within="2 hours").awaitTermination()  # a new query on the same checkpoint
    assert durations(spark, tmp_dir) == [1, 2, 3, 4]


def test_by_default_a_resent_record_is_stored_again(spark, tmp_dir):
    drop(f"{tmp_dir}/in", "a.txt", [message(600), message(600)])
    store(spark, tmp_dir).awaitTermination()
    assert durations(spark, tmp_dir) == [5, 5]


def test_a_failed_batch_keeps_the_state(spark, tmp_dir):
    drop(f"{tmp_dir}/in", "a.txt", [message(600, duration=1)])
    store(spark, tmp_dir, resent_within="2 hours").awaitTermination()
    drop(f"{tmp_dir}/in", "b.txt", [message(600, duration=1), message(602, duration=2)])

    def broken(batch, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(StreamingQueryException):
        store(spark, tmp_dir, broken, resent_within="2 hours").awaitTermination()
    store(spark, tmp_dir, resent_within="2 hours").awaitTermination()
    assert durations(spark, tmp_dir) == [1, 2]


def test_records_beyond_the_bound_are_counted_and_those_without_time_kept(spark, tmp_dir):
    drop(f"{tmp_dir}/in", "a.txt", [message(900, duration=1), message(None, duration=7), message(None, duration=7)])
    first = store(spark, tmp_dir, resent_within="1 hour")
    first.awaitTermination()
    assert late_rows(first) == 0
    drop(f"{tmp_dir}/in", "b.txt", [message(100, duration=2), message(850, duration=3), message(None, duration=7)])
    second = store(spark, tmp_dir, resent_within="1 hour")
    second.awaitTermination()
    assert durations(spark, tmp_dir) == [1, 3, 7, 7, 7] and late_rows(second) == 1


def test_by_arrival_nothing_is_late(spark, tmp_dir):
    def run():
        messages = message_files(spark, f"{tmp_dir}/in", 1).withColumn("arrived", F.col("_metadata.file_modification_time"))
        return run_store(messages, batch_table_writer(f"{tmp_dir}/out"), f"{tmp_dir}/ck", NOW, keep=("arrived",),
                         resent_within="1 hour", arrival="arrived")

    drop(f"{tmp_dir}/in", "a.txt", [message(900, duration=1)])
    run().awaitTermination()
    drop(f"{tmp_dir}/in", "b.txt", [message(1, duration=2), message(900, duration=1), message(None, duration=3), message(None, duration=3)])
    run().awaitTermination()
    assert durations(spark, tmp_dir) == [1, 2, 3]
    with pytest.raises(ValueError):
        run_store(message_files(spark, f"{tmp_dir}/in"), print, f"{tmp_dir}/ck2", arrival="arrived")


def test_batch_frames_drop_every_copy(spark):
    rows = spark.createDataFrame(
        [("voice", "+1", None, None, None, None, 5, 0.0, 0, t) for t in (None, None)]
        + [("voice", "+1", None, None, None, None, d, 0.0, 0, None) for d in (5, 6)], NORMALISED_CDR)
    timed = rows.withColumn("timestamp", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    assert without_resent(timed, "1 hour").count() == 2 and without_resent(rows, "1 hour").count() == 4


def test_the_state_store_setting_is_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key) == before


# -- waiting for queries (T8) ------------------------------------------------------------
def test_another_querys_failure_is_not_ours(spark, tmp_dir):
    """A query of somebody else fails before and while ours are waited for."""
    drop(f"{tmp_dir}/raw", "a.txt", ["junk"])

    def broken(batch, batch_id):
        raise RuntimeError("somebody else's")

    def foreign(name):
        stream = message_files(spark, f"{tmp_dir}/raw")
        return stream.writeStream.foreachBatch(broken).option("checkpointLocation", f"{tmp_dir}/{name}").start()

    first = foreign("f1")
    while first.isActive:
        pass
    queries = run_mediation_streams(message_files(spark, f"{tmp_dir}/raw"), f"{tmp_dir}/v", f"{tmp_dir}/i", f"{tmp_dir}/ck", NOW)
    foreign("f2")
    wait_any(spark, queries, until_all=True)
    assert all(q.exception() is None for q in queries)
    assert read_table(spark, f"{tmp_dir}/i").count() == 1
    # The failures are still there for those whom they concern.
    with pytest.raises(StreamingQueryException):
        first.awaitTermination()


def test_wait_any_of_none_returns(spark):
    wait_any(spark, [])
    wait_any(spark, [], until_all=True)


# -- primary keys ----------------------------------------------------------------------------
KEYED = "k string, j int, at long, v string"


def check_keys(spark, root, accepted=None, keys=("k", "j")):
    stream = spark.readStream.schema(KEYED).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    return run_key_check(stream, keys, accepted or batch_table_writer(f"{root}/good"), batch_table_writer(f"{root}/bad"),
                         f"{root}/ck", order=["at"], trigger=NOW)


def arrive(spark, root, rows):
    spark.createDataFrame(rows, KEYED).coalesce(1).write.mode("append").parquet(f"{root}/in")


def plain_keys(batches, n_keys=2):
    seen, good, bad = set(), [], []
    for batch in batches:
        order = sorted(batch, key=lambda r: tuple((x is not None, x) for x in (r[2], r[0], r[1], r[3])))
        for row in order:
            key = row[:n_keys]
            if None in key:
                bad.append((*row, "null_key"))
            elif key in seen:
                bad.append((*row, "duplicate_key"))
            else:
                seen.add(key)
                good.append(row)
    return sorted(good, key=str), sorted(bad, key=str)


def found_keys(spark, root):
    good = read_table(spark, f"{root}/good").drop("batch_id")
    bad = read_table(spark, f"{root}/bad").drop("batch_id")
    return sorted((tuple(r) for r in good.collect()), key=str), sorted((tuple(r) for r in bad.collect()), key=str)


def test_keys_of_arriving_batches(spark, tmp_dir):
    rng = random.Random(3)
    batches = [[(rng.choice("abcd") if rng.random() > 0.1 else None, rng.choice([1, 2, 3, None]), rng.randrange(50), str(i))
                for i in range(n)] for n in (60, 1, 40)]
    batches[1] = [("new", 7, 1, "x")]
    failed = []
    keep = batch_table_writer(f"{tmp_dir}/good")

    def fails_once(batch, batch_id):
        if batch_id == 2 and not failed:
            failed.append(1)
            raise RuntimeError("sink down")
        keep(batch, batch_id)

    for i, batch in enumerate(batches):
        arrive(spark, tmp_dir, batch)
        query = check_keys(spark, tmp_dir, fails_once)
        if i == 2:
            with pytest.raises(StreamingQueryException):
                query.awaitTermination()
            query = check_keys(spark, tmp_dir, fails_once)  # replayed
        query.awaitTermination()
    assert failed and found_keys(spark, tmp_dir) == plain_keys(batches)


def test_a_hot_key_and_nulls(spark, tmp_dir):
    rows = [("hot", 1, i, None) for i in range(3000, 0, -1)] + [(None, 1, i, "n") for i in range(2000)]
    arrive(spark, tmp_dir, rows)
    check_keys(spark, tmp_dir).awaitTermination()
    assert found_keys(spark, tmp_dir) == plain_keys([rows])


def test_key_check_keeps_columns_and_types(spark, tmp_dir):
    stream = spark.readStream.schema(KEYED).parquet(tmp_dir)
    out = first_of_key(stream, ["k"])
    assert out.schema.simpleString() == "struct<k:string,j:int,at:bigint,v:string,reject_reason:string>"


# -- consumption by batches ----------------------------------------------------------------------
def subscribers(spark, rows):
    data = [(f"+21266{n:07d}", None, "postpaid", plan, None, status, None) for n, plan, status in rows]
    return spark.createDataFrame(data, CUSTOMERS)


def rated_rows(df):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else str(v) for v in (
            r.customer_id, r.rate_plan_id, r.record_type, r.year_month, r.total_consumption_units, r.billable_units, r.cost or 0.0))
        for r in df.collect())


def test_batches_with_late_months_equal_one_rating(spark, tmp_dir):
    rng = random.Random(5)
    people = [(n, f"RP{n % 3}", "active" if n % 4 else "suspended") for n in range(12)] + [(3, "RP1", "active")]
    customers = subscribers(spark, people)
    store_ = UsageStore(spark, f"{tmp_dir}/store")

    def run():
        return run_usage(message_files(spark, f"{tmp_dir}/in", 1), store_, lambda: customers, lambda: product_rates(spark), f"{tmp_dir}/ck", NOW)

    for turn in range(4):
        lines = [message(rng.choice([None, *range(5)]), rng.randrange(14), rng.randrange(300), rng.choice(["voice", "sms", "data", "fax"]),
                         month=rng.choice([4, 5, 6])) for _ in range(40)]
        drop(f"{tmp_dir}/in", f"{turn}.txt", lines)
        query = run()
        query.awaitTermination()
        if turn == 1:
            store_.fold(1)
            assert store_.usage.folded() == store_.priced.folded() == 1
            store_.fold(0)  # nothing to do
            assert store_.usage.vacuum() > 0
    from tollgate.operators.mediation import decode
    from tollgate.operators.normalise import normalise
    from tollgate.schemas import MEDIATED_CDR

    cdr = normalise(decode(spark.read.text(f"{tmp_dir}/in"), MEDIATED_CDR))
    want = rate_monthly(cdr, customers, product_rates(spark))
    assert rated_rows(store_.rated()) == rated_rows(want)
    assert rated_rows(store_.rated(["2025-05"])) == rated_rows(want.filter("year_month = '2025-05'"))
    assert rated_rows(store_.rated([None])) == rated_rows(want.filter("year_month is null"))
    assert store_.consumption().agg(F.sum("n_records")).first()[0] == cdr.count()


def test_a_replayed_batch_counts_once_and_only_touched_keys_are_priced(spark, tmp_dir):
    store_ = UsageStore(spark, tmp_dir)
    cdr = lambda *rows: spark.createDataFrame(
        [(k, f"+21266{n:07d}", u, 0.0, m) for k, n, u, m in rows],
        "record_type string, customer_id string, duration_sec long, data_volume_mb double, year_month string")
    people = subscribers(spark, [(1, "RP1", "active"), (2, "RP1", "active")])
    for batch, rows in enumerate([[("voice", 1, 10, "2025-01"), ("voice", 2, 5, "2025-01")], [("voice", 1, 7, "2025-01")]]):
        for _ in range(2):  # each batch comes twice
            store_.add(cdr(*rows), batch)
            store_.rerate(batch, people, product_rates(spark))
    layer = store_.priced.layer(1).collect()
    assert [(r.customer_id[-1], r.total_consumption_units) for r in layer] == [("1", 17.0)]
    assert sorted((r.customer_id[-1], r.total_consumption_units) for r in store_.rated().collect()) == [("1", 17.0), ("2", 5.0)]
    # A customer who has ended leaves the rated usage when touched.
    ended = subscribers(spark, [(1, "RP1", "terminated"), (2, "RP1", "active")])
    store_.add(cdr(("voice", 1, 1, "2025-01")), 2)
    store_.rerate(2, ended, product_rates(spark))
    assert [(r.customer_id[-1], r.total_consumption_units) for r in store_.rated().collect()] == [("2", 5.0)]
    store_.fold(2)
    assert [(r.customer_id[-1], r.total_consumption_units) for r in store_.rated().collect()] == [("2", 5.0)]
    store_.rerate(9, people, product_rates(spark))  # a batch without rows
    assert store_.rated().count() == 1
