"""Command-line jobs: the chain's four steps, and the table checks.

    spark-submit --py-files tollgate.zip tollgate/jobs.py mediate --kafka-servers H:9092 \\
        --raw-topic raw-cdr --valid-topic valid-cdr --invalid-topic invalid-cdr --checkpoint <shared dir>
    ... store  --kafka-servers H:9092 --valid-topic valid-cdr --out <table> --checkpoint <dir>
    ... rate   --cdr <table> --customers <table> --rates <table> --out <table> [--months 2025-06]
    ... bill   --rated <table> --out <table> [--months 2025-06]
    ... check  --table <table> --rules customers --out <table>
    ... usage  --valid-dir <dir> --store <path> --customers <table> --rates <table> --checkpoint <dir>
    ... gaps   --table <table> --out <table>

(``python -m tollgate.jobs ...`` runs the same in a local session.)

A table is a parquet path, or ``jdbc:<name>`` with ``--jdbc-url``.  JDBC
credentials come from the environment variables ``TOLLGATE_JDBC_USER`` and
``TOLLGATE_JDBC_PASSWORD``, never from arguments or code.  Streams read Kafka
(``--kafka-servers``) or, for tests and backfills, a folder of message files
(``--raw-dir`` / ``--valid-dir``).  Streaming jobs block until the query
ends; ``--available-now`` processes what is there and stops.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.billing import bill_monthly
from tollgate.operators.mediation import encode
from tollgate.operators.offsets import gaps, islands
from tollgate.operators.quality import DECLARED_RULES, check
from tollgate.operators.rating import RUN_ID, latest_runs, rate_monthly, with_run
from tollgate.plans.joins import hold
from tollgate.schemas import KEYED_CDR, MEDIATED_CDR, RAW_KEYS
from tollgate.session import build_session
from tollgate.sinks.jdbc import jdbc_batch_writer, write_jdbc
from tollgate.sinks.kafka import write_kafka_batch
from tollgate.sinks.tables import BatchSink, batch_table_writer, write_bills, write_rated
from tollgate.sources.files import MAX_FILES_PER_TRIGGER, message_files, read_table
from tollgate.sources.jdbc import read_jdbc, read_jdbc_balanced, read_jdbc_split
from tollgate.sources.kafka import MAX_OFFSETS_PER_TRIGGER, kafka_stream
from tollgate.streaming.runners import run_mediation, run_mediation_streams, run_store, wait_any
from tollgate.streaming.usage import UsageStore, run_usage

JDBC_PREFIX = "jdbc:"
KAFKA_COORDS = ("topic", "partition", "offset")


def _jdbc_properties() -> dict[str, str]:
    props = {}
    if os.environ.get("TOLLGATE_JDBC_USER"):
        props["user"] = os.environ["TOLLGATE_JDBC_USER"]
    if os.environ.get("TOLLGATE_JDBC_PASSWORD"):
        props["password"] = os.environ["TOLLGATE_JDBC_PASSWORD"]
    return props


def read_any(spark: SparkSession, spec: str, args, split_column: str | None = None) -> DataFrame:
    """A parquet path, or ``jdbc:<table>`` read through ``--jdbc-url``; with
    ``--jdbc-partitions`` a JDBC table that has ``split_column`` is read in
    that many parallel ranges instead of one task."""
    if spec.startswith(JDBC_PREFIX):
        table = spec[len(JDBC_PREFIX):]
        if split_column and args.jdbc_partitions and args.jdbc_balanced:
            return read_jdbc_balanced(spark, args.jdbc_url, table, split_column, args.jdbc_partitions,
                                      properties=_jdbc_properties())
        if split_column and args.jdbc_partitions:
            return read_jdbc_split(spark, args.jdbc_url, table, split_column, args.jdbc_partitions,
                                   properties=_jdbc_properties())
        return read_jdbc(spark, args.jdbc_url, table, properties=_jdbc_properties())
    return read_table(spark, spec)


def _months(df: DataFrame, months: list[str] | None) -> DataFrame:
    return df if not months else df.filter(F.col("year_month").isin(months))


def month_range(months: list[str], column: str = "timestamp") -> Column:
    """True for instants in any of the months (UTC), as ranges of the column that
    a scan can push down."""
    spans = []
    for month in months:
        year, number = map(int, month.split("-"))
        start = datetime(year, number, 1, tzinfo=timezone.utc)
        end = datetime(year + number // 12, number % 12 + 1, 1, tzinfo=timezone.utc)
        low, high = (F.timestamp_seconds(F.lit(int(t.timestamp()))) for t in (start, end))
        spans.append((F.col(column) >= low) & (F.col(column) < high))
    return reduce(lambda x, y: x | y, spans)


def _trigger(args) -> dict | None:
    return {"availableNow": True} if args.available_now else None


def _kafka_side(args, topic: str) -> BatchSink:
    """Batch writer to a topic.  Messages carry the raw message's coordinates
    under the names of ``RAW_KEYS`` (the fan-out drops ``raw_value`` from the
    valid side, so only dead letters carry the message text)."""
    names = dict(zip(KAFKA_COORDS, RAW_KEYS))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_kafka_batch(encode(batch.withColumnsRenamed(names)), args.kafka_servers, topic)

    return write


def job_mediate(spark: SparkSession, args) -> None:
    options = {"keep_raw": args.keep_raw, "reject": tuple(args.reject or ()), "reasons": args.reasons}
    if args.kafka_servers:
        messages = kafka_stream(
            spark, args.kafka_servers, args.raw_topic, starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets_per_trigger, min_partitions=args.min_partitions,
        )
        sides = _kafka_side(args, args.valid_topic), _kafka_side(args, args.invalid_topic)
        run_mediation(messages, *sides, args.checkpoint, _trigger(args), keep=KAFKA_COORDS, **options).awaitTermination()
    else:
        messages = message_files(spark, args.raw_dir, args.max_files_per_trigger)
        queries = run_mediation_streams(messages, args.valid_dir, args.invalid_dir, args.checkpoint, _trigger(args), **options)
        wait_any(spark, queries, until_all=args.available_now)


def job_store(spark: SparkSession, args) -> None:
    to_jdbc = args.out.startswith(JDBC_PREFIX)
    keys: tuple[str, ...] = ()
    if args.kafka_servers:
        messages = kafka_stream(
            spark, args.kafka_servers, args.valid_topic, starting_offsets=args.starting_offsets,
            fail_on_data_loss=False, max_offsets_per_trigger=args.max_offsets_per_trigger,
            min_partitions=args.min_partitions,
        )
        keys = RAW_KEYS if to_jdbc and not args.plain_columns else ()
    else:
        messages = message_files(spark, args.valid_dir, args.max_files_per_trigger)
    if to_jdbc:
        sink = jdbc_batch_writer(args.jdbc_url, args.out[len(JDBC_PREFIX):], _jdbc_properties(),
                                 key_columns=keys, on_error=args.on_error, num_partitions=args.jdbc_write_partitions)
    else:
        sink = batch_table_writer(args.out, partition_by=("year_month",), on_error=args.on_error)
    query = run_store(messages, sink, args.checkpoint, _trigger(args), with_month=not to_jdbc,
                      schema=KEYED_CDR if keys else MEDIATED_CDR, message_keys=keys, own_keys=KAFKA_COORDS if keys else (),
                      observe="store_losses", resent_within=args.resent_within)
    query.awaitTermination()


def job_usage(spark: SparkSession, args) -> None:
    """Consumption and rated usage kept up to date from the valid messages."""
    if args.kafka_servers:
        messages = kafka_stream(
            spark, args.kafka_servers, args.valid_topic, starting_offsets=args.starting_offsets, fail_on_data_loss=False,
            max_offsets_per_trigger=args.max_offsets_per_trigger, min_partitions=args.min_partitions,
        )
    else:
        messages = message_files(spark, args.valid_dir, args.max_files_per_trigger)
    store = UsageStore(spark, args.store)
    query = run_usage(
        messages, store, lambda: read_any(spark, args.customers, args), lambda: hold(read_any(spark, args.rates, args)),
        args.checkpoint, _trigger(args),
    )
    query.awaitTermination()
    last = query.lastProgress
    if args.fold and last:
        store.fold(int(last["batchId"]))
    if args.out:
        write_rated(store.rated(), args.out, atomic=True)


def job_gaps(spark: SparkSession, args) -> None:
    """Offsets missing from a stored table's message coordinates, written as a table."""
    stored = read_any(spark, args.table, args)
    names = KAFKA_COORDS if set(KAFKA_COORDS) <= set(stored.columns) else RAW_KEYS
    messages = stored.select(*[F.col(n).alias(c) for n, c in zip(names, KAFKA_COORDS)])
    gaps(islands(messages)).write.mode("overwrite").parquet(args.out)


def job_rate(spark: SparkSession, args) -> None:
    to_jdbc = args.out.startswith(JDBC_PREFIX)
    if to_jdbc and args.run_id is None and args.mode != "append":
        raise SystemExit("rating into a JDBC table appends: give --run-id (billing then takes each month's latest run), "
                         "or --mode append to double the month on a rerun")
    customers = read_any(spark, args.customers, args, split_column=args.customers_partition_column)
    rates = hold(read_any(spark, args.rates, args))  # a small book is broadcast
    cdr = read_any(spark, args.cdr, args, split_column=args.jdbc_partition_column)
    month_col = "year_month" if "year_month" in cdr.columns else None
    if args.months:  # partition pruning, or a time range for the scan
        cdr = _months(cdr, args.months) if month_col else cdr.filter(month_range(args.months))
    rated = rate_monthly(cdr, customers, rates, month_col=month_col, decimal=args.decimal)
    if args.run_id is not None:
        rated = with_run(rated, args.run_id)
    if to_jdbc:
        write_jdbc(rated, args.jdbc_url, args.out[len(JDBC_PREFIX):], mode="append", properties=_jdbc_properties(),
                   num_partitions=args.jdbc_write_partitions)
    else:
        write_rated(rated, args.out, mode=args.mode, months=args.months, atomic=args.atomic)


def job_bill(spark: SparkSession, args) -> None:
    to_jdbc = args.out.startswith(JDBC_PREFIX)
    if to_jdbc and args.months:
        raise SystemExit("bills in a JDBC table are overwritten as a whole: --months would drop the other months' bills")
    rated = _months(read_any(spark, args.rated, args), args.months)
    if RUN_ID in rated.columns and not args.all_runs:
        rated = latest_runs(rated)
    bills = bill_monthly(rated, plan_pick=args.plan_pick)
    if to_jdbc:
        write_jdbc(bills, args.jdbc_url, args.out[len(JDBC_PREFIX):], mode="overwrite", truncate=True,
                   properties=_jdbc_properties(), num_partitions=args.jdbc_write_partitions)
    else:
        write_bills(bills, args.out, args.months, args.atomic)


def job_check(spark: SparkSession, args) -> None:
    """Violations of a table's declared rules, written as a table."""
    parents = dict(p.split("=", 1) for p in args.parent or ())
    frames = {name: read_any(spark, spec, args) for name, spec in parents.items()}
    rules = DECLARED_RULES[args.rules]
    missing = {r.parent for r in rules if r.kind == "fk"} - set(frames)
    if missing:
        raise SystemExit(f"give --parent {' '.join(f'{m}=<table>' for m in sorted(missing))}")
    check(read_any(spark, args.table, args), rules, frames).write.mode("overwrite").parquet(args.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tollgate.jobs")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-write-partitions", type=int, default=8, help="database connections of a write, at most")
    sub = p.add_subparsers(dest="job", required=True)

    def stream_opts(s):
        s.add_argument("--kafka-servers")
        s.add_argument("--starting-offsets", default="latest")
        s.add_argument("--max-offsets-per-trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER)
        s.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES_PER_TRIGGER)
        s.add_argument("--min-partitions", type=int, help="split few topic partitions over more tasks")
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--available-now", action="store_true")

    m = sub.add_parser("mediate")
    stream_opts(m)
    m.add_argument("--raw-topic", default="raw-cdr")
    m.add_argument("--valid-topic", default="valid-cdr")
    m.add_argument("--invalid-topic", default="invalid-cdr")
    m.add_argument("--raw-dir")
    m.add_argument("--valid-dir")
    m.add_argument("--invalid-dir")
    m.add_argument("--keep-raw", action="store_true")
    m.add_argument("--reasons", action="store_true", help="dead letters say which fields are wrong, and how")
    m.add_argument("--reject", nargs="*")

    s = sub.add_parser("store")
    stream_opts(s)
    s.add_argument("--valid-topic", default="valid-cdr")
    s.add_argument("--valid-dir")
    s.add_argument("--out", required=True)
    s.add_argument("--on-error", choices=("raise", "skip"), default="raise")
    s.add_argument("--resent-within", help="store a record that is sent again within this time once, e.g. '7 days'")
    s.add_argument("--plain-columns", action="store_true",
                   help="JDBC: append the ten storage columns only (an existing table); a replayed batch is then appended again")

    u = sub.add_parser("usage")
    stream_opts(u)
    u.add_argument("--valid-topic", default="valid-cdr")
    u.add_argument("--valid-dir")
    u.add_argument("--store", required=True, help="path of the partial sums and priced keys")
    u.add_argument("--customers", required=True)
    u.add_argument("--rates", required=True)
    u.add_argument("--fold", action="store_true", help="merge the layers when the query has ended")
    u.add_argument("--out", help="write the rated usage as a table when the query has ended")

    g = sub.add_parser("gaps")
    g.add_argument("--table", required=True)
    g.add_argument("--out", required=True)

    r = sub.add_parser("rate")
    r.add_argument("--cdr", required=True)
    r.add_argument("--customers", required=True)
    r.add_argument("--rates", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--months", nargs="*")
    r.add_argument("--mode", choices=("replace_months", "append", "overwrite"), default="replace_months")
    r.add_argument("--atomic", action="store_true", help="keep --out as versions: all months change in one step")
    r.add_argument("--decimal", action="store_true")
    r.add_argument("--run-id", type=int, help="tag rows with this run (append-only stores, e.g. JDBC)")
    r.add_argument("--jdbc-partitions", type=int, help="parallel ranges for JDBC reads of large tables")
    r.add_argument("--jdbc-balanced", action="store_true", help="ranges with equally many rows (skewed columns)")
    r.add_argument("--jdbc-partition-column", help="numeric/date column of a JDBC --cdr table to split on")
    r.add_argument("--customers-partition-column", help="numeric/date column of a JDBC --customers table")

    b = sub.add_parser("bill")
    b.add_argument("--rated", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--months", nargs="*")
    b.add_argument("--atomic", action="store_true", help="keep --out as versions: all months change in one step")
    b.add_argument("--plan-pick", choices=("min", "first", "key"), default="min")
    b.add_argument("--all-runs", action="store_true", help="bill every rating run, not the latest of each month")

    c = sub.add_parser("check")
    c.add_argument("--table", required=True)
    c.add_argument("--rules", choices=sorted(DECLARED_RULES), required=True)
    c.add_argument("--parent", nargs="*", metavar="NAME=TABLE")
    c.add_argument("--out", required=True)
    return p


JOBS = {
    "mediate": job_mediate, "store": job_store, "usage": job_usage, "gaps": job_gaps, "rate": job_rate, "bill": job_bill,
    "check": job_check,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    JOBS[args.job](spark or build_session(app_name=f"tollgate-{args.job}"), args)


if __name__ == "__main__":
    main(sys.argv[1:])
