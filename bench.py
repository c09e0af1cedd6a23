"""Bench: time the registered queries over the driver's tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is run to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver).  One warm-up run of the
flagship query precedes the timed runs; each query is timed ``BENCH_REPEAT``
times (default 2) and its best time is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tollgate.plans.catalog import QUERIES  # noqa: E402
from tollgate.session import build_session  # noqa: E402

# Headline queries first: the full chain from raw messages to bills.
HEADLINE = (
    "monthly_bills",
    "rated_monthly",
    "normalised_cdr",
    "mediated_all",
    "cdr_with_plan",
    "stream_store",
    "check_pk_pair",
    "check_fk",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def exchanges(spark, name: str, sf_dir: str) -> dict[str, int]:
    """Shuffle and broadcast exchanges of the query's physical plan (as
    planned, before adaptive re-planning)."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    shuffles = len(re.findall(r"\bExchange (?:hash|range|RoundRobin|Single)", plan))
    return {"shuffle": shuffles, "broadcast": plan.count("BroadcastExchange")}


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    names = argv or list(HEADLINE) + [q for q in QUERIES if q not in HEADLINE]

    spark = build_session(
        f"local[{cpus}]",
        app_name="tollgate-bench",
        shuffle_partitions=2 * cpus,
        conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    run_once(spark, "monthly_bills", sf_dir)  # JVM and code-cache warm-up

    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            timings[name] = round(min(run_once(spark, name, sf_dir) for _ in range(repeat)), 3)
        except Exception as exc:  # noqa: BLE001 - report the query and go on
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    headline = [q for q in HEADLINE if q in timings]
    plans = {}
    for q in headline:
        try:
            plans[q] = exchanges(spark, q, sf_dir)
        except Exception:  # noqa: BLE001 - plan counts are informative only
            pass
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(timings[q] for q in headline), 3),
                "unit": "sec",
                "queries": timings,
                "exchanges": plans,
                "errors": errors,
                "all_queries_total_sec": round(sum(timings.values()), 3),
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
