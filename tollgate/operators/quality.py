"""Table constraints as data-quality jobs.

A database rejects violating rows on insert; Spark tables do not, so each
constraint becomes a job that returns the violations.  All checks are
distributed: key checks aggregate with map-side combine (a hot key is
collapsed per task before the shuffle), and foreign keys are one anti join.
``check`` runs a whole rule set in one scan; :mod:`tollgate.streaming.keys` checks
primary keys of batches as they arrive.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.plans.joins import bounded


def check_allowed(df: DataFrame, column: str, allowed: Iterable) -> DataFrame:
    """Rows whose ``column`` is set and outside ``allowed`` (NULL passes, as
    in a SQL CHECK)."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(list(allowed)))


def check_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with a null in any of ``columns`` (primary-key columns)."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.filter(cond)


def check_unique(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Key values that occur more than once, with their row count ``n_rows``.

    Null keys are left to :func:`check_not_null`.  Partial aggregation keeps
    the shuffle to one row per key and task, whatever the key skew.
    """
    cols = list(columns)
    keyed = df.select(*cols).filter(~check_null_any(cols))
    return keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_null_any(columns: Iterable[str]):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def check_fk(
    child: DataFrame,
    parent: DataFrame,
    columns: Iterable[str],
    parent_columns: Iterable[str] | None = None,
) -> DataFrame:
    """Child rows whose (non-null) key has no parent row.

    One anti join of the child rows with the distinct parent keys: the child is
    scanned and shuffled once (not at all when the parent is broadcast), and AQE
    splits a hot child key.
    """
    cols = list(columns)
    pcols = list(parent_columns) if parent_columns is not None else cols
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(pcols, cols)])
    if bounded(keys):
        keys = F.broadcast(keys)
    else:
        keys = keys.distinct()
    return child.filter(~check_null_any(cols)).join(keys, cols, "left_anti")


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add each absent column with its default value.  Columns that exist
    keep their values, explicit nulls included (SQL DEFAULT semantics)."""
    out = df
    for name, value in defaults.items():
        if name not in df.columns:
            out = out.withColumn(name, F.lit(value))
    return out


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each frame, computed in one job."""
    parts = [
        df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Rule:
    """One declared constraint of a table."""

    kind: str  # "allowed" | "not_null" | "unique" | "fk"
    columns: tuple[str, ...]
    allowed: tuple = ()
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        """Tells rules apart: two rules on one column differ in what they
        allow, or in their parent."""
        out = f"{self.kind}({', '.join(self.columns)})"
        if self.kind == "allowed":
            out += f" in ({', '.join(map(str, self.allowed))})"
        if self.kind == "fk":
            out += f" -> {self.parent}({', '.join(self.parent_columns or self.columns)})"
        return out


def violations(df: DataFrame, rule: Rule, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The violating rows of one rule (for ``unique``: key values and counts)."""
    if rule.kind == "allowed":
        return check_allowed(df, rule.columns[0], rule.allowed)
    if rule.kind == "not_null":
        return check_not_null(df, rule.columns)
    if rule.kind == "unique":
        return check_unique(df, rule.columns)
    if rule.kind == "fk":
        return check_fk(df, (parents or {})[rule.parent], rule.columns, rule.parent_columns or rule.columns)
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def _key(columns: Iterable[str]) -> Column:
    return F.to_json(F.struct(*columns))


def _item(rule: Rule) -> Column:
    """The value that a row gives to a rule: what violates it, or for rules about
    keys the key itself; null when there is none."""
    value = _key(rule.columns)
    column = F.col(rule.columns[0])
    if rule.kind == "allowed":
        return F.when(column.isNotNull() & ~column.isin(list(rule.allowed)), value)
    missing = check_null_any(rule.columns)
    if rule.kind == "not_null":
        return F.when(missing, value)
    if rule.kind in ("unique", "fk"):
        return F.when(~missing, value)
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def _parent_keys(df: DataFrame, number: int, rule: Rule, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of a rule's parent, written as the child's are."""
    parent = parents[rule.parent]
    columns = zip(rule.columns, rule.parent_columns or rule.columns)
    keys = parent.select(*[F.col(p).cast(df.schema[c].dataType).alias(c) for c, p in columns])
    keys = keys.filter(~check_null_any(rule.columns))
    return keys.select(F.lit(number).alias("rule_no"), _key(rule.columns).alias("value")).distinct()


def check(df: DataFrame, rules: Iterable[Rule], parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All violations as one frame ``(rule, value, n_rows)``: a row per rule and
    distinct violating value of the rule's columns (JSON, nulls left out).

    One scan of the table for all rules: each row is exploded to (rule, value) items,
    which are counted in one aggregation.  It combines map-side, so a value that a third
    of the rows have is one row per task.  Keys are violations when counted more than
    once; foreign keys when no parent has them, which one outer join of the counted
    values with all parents' keys says.  Lazy; no rule gives no rows."""
    rules = list(rules)
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, value string, n_rows long")
    items = F.array(*[F.struct(F.lit(i).alias("rule_no"), _item(r).alias("value")) for i, r in enumerate(rules)])
    counted = (
        df.select(F.explode(items).alias("item"))
        .select("item.rule_no", "item.value")
        .filter(F.col("value").isNotNull())
        .groupBy("rule_no", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    numbers = {kind: [i for i, r in enumerate(rules) if r.kind == kind] for kind in ("unique", "fk")}
    broken = ~F.col("rule_no").isin(numbers["unique"]) | (F.col("n_rows") > 1)
    if numbers["fk"]:
        keys = reduce(
            DataFrame.unionByName, [_parent_keys(df, i, rules[i], parents or {}) for i in numbers["fk"]]
        ).withColumn("has_parent", F.lit(True))
        counted = counted.join(keys, ["rule_no", "value"], "left")
        broken = broken & (~F.col("rule_no").isin(numbers["fk"]) | F.col("has_parent").isNull())
    names = F.array(*[F.lit(r.name) for r in rules])
    return counted.filter(broken).select(names[F.col("rule_no")].alias("rule"), "value", "n_rows")


# ---------------------------------------------------------------------------
# The declared constraints of the rating tables
CUSTOMER_RULES = (
    Rule("not_null", ("customer_id",)),
    Rule("unique", ("customer_id",)),
    Rule("allowed", ("subscription_type",), allowed=("postpaid",)),
    Rule("allowed", ("status",), allowed=("active", "suspended", "terminated")),
)
RATE_PLAN_RULES = (
    Rule("not_null", ("rate_plan_id",)),
    Rule("unique", ("rate_plan_id",)),
)
PRODUCT_RULES = (
    Rule("not_null", ("product_code",)),
    Rule("unique", ("product_code",)),
    Rule("allowed", ("service_type",), allowed=("voice", "sms", "data")),
    Rule("allowed", ("rate_type",), allowed=("flat", "tiered", "time-based")),
)
PRODUCT_RATE_RULES = (
    Rule("not_null", ("rate_plan_id", "service_type")),
    Rule("unique", ("rate_plan_id", "service_type")),
    Rule("fk", ("rate_plan_id",), parent="rate_plans"),
)
DECLARED_RULES = {
    "customers": CUSTOMER_RULES,
    "rate_plans": RATE_PLAN_RULES,
    "products": PRODUCT_RULES,
    "product_rates": PRODUCT_RATE_RULES,
}
# ---------------------------------------------------------------------------
