"""Reference data of the rating system: plans, products and the price book.

These are seed rows (``INSERT ... VALUES`` in the source system), loaded as
small DataFrames with the declared schemas.  Real deployments read the same
tables from their store with :func:`tollgate.sources.files.read_table` or
:func:`tollgate.sources.jdbc.read_jdbc`.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tollgate.schemas import PRODUCT_RATES, PRODUCTS, RATE_PLANS

# ---------------------------------------------------------------------------
# Fixed values (seed rows of the source system; must match for equal bills)
# rate plans: (rate_plan_id, plan_name)
RATE_PLAN_ROWS = [
    ("RP1", "Plan Classique"),
    ("RP2", "Plan Premium"),
]
# products: (product_code, service_type, unit, rate_type)
PRODUCT_ROWS = [
    ("P1", "voice", "second", "flat"),
    ("P2", "sms", "SMS", "flat"),
    ("P3", "data", "MB", "tiered"),
]
# price book: (rate_plan_id, service_type, unit_price, free_units, tiered)
PRICE_ROWS = [
    ("RP1", "voice", "0.010", "0", False),
    ("RP1", "sms", "0.050", "50", False),
    ("RP1", "data", "0.050", "100", True),
    ("RP2", "voice", "0.008", "0", False),
    ("RP2", "sms", "0.030", "100", False),
    ("RP2", "data", "0.030", "200", True),
]
# Column defaults of the price book (applied when a column is absent).
PRODUCT_RATES_DEFAULTS = {"free_units": Decimal("0"), "tiered": False}
# ---------------------------------------------------------------------------


def seed_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small literal table with a declared schema (a seed load): a SQL
    ``VALUES`` list with bound parameters, cast to the declared types.

    The rows live in the plan itself (a local relation), so their number is
    known without running a job, and the frame is broadcast for free.
    """
    if not rows:
        return spark.createDataFrame([], schema)
    args: dict[str, object] = {}
    tuples = []
    for i, row in enumerate(rows):
        names = []
        for j, value in enumerate(row):
            args[f"v{i}_{j}"] = value
            names.append(f":v{i}_{j}")
        tuples.append(f"({', '.join(names)})")
    cols = ", ".join(f.name for f in schema.fields)
    df = spark.sql(f"SELECT * FROM VALUES {', '.join(tuples)} AS t({cols})", args=args)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def rate_plans(spark: SparkSession) -> DataFrame:
    return seed_frame(spark, RATE_PLAN_ROWS, RATE_PLANS)


def products(spark: SparkSession) -> DataFrame:
    return seed_frame(spark, PRODUCT_ROWS, PRODUCTS)


def product_rates(spark: SparkSession) -> DataFrame:
    rows = [(p, s, Decimal(u), Decimal(f), t) for p, s, u, f, t in PRICE_ROWS]
    return seed_frame(spark, rows, PRODUCT_RATES)
