"""Mediation: decode raw messages, unify the three record shapes, validate,
split into valid and invalid, and encode back into key/value messages.

All steps are narrow projections and filters: no shuffle, so they scale with
the number of input partitions (topic partitions or files) and run the same
inside a streaming query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tollgate.functions import cdr as X
from tollgate.schemas import UNIFIED_AWAY

VALID, ERROR = "valid", "error"


def decode(
    df: DataFrame,
    schema: StructType,
    value_col: str = "value",
    keep: tuple[str, ...] = (),
    keep_raw: bool = False,
) -> DataFrame:
    """Parse a binary or string JSON column with a declared schema.

    Malformed, empty or null messages give a row of nulls; a wrongly typed
    field is null on its own; unknown fields are ignored.  ``keep`` carries
    other input columns (e.g. topic/partition/offset for idempotent sinks);
    ``keep_raw`` keeps the message text as ``raw_value`` for dead letters.
    """
    text = F.col(value_col).cast("string")
    cols = [F.col(c) for c in keep]
    if keep_raw:
        cols.append(text.alias("raw_value"))
    # The struct is flattened by a generator over a one-element array rather
    # than by ``select("d.*")``.  With a projection, a later filter on a
    # decoded field (validation, the valid/invalid split) is pushed below it
    # with ``from_json`` substituted into the condition, so each message
    # would be parsed once per referenced field.  A filter on generator
    # output stays above the generator: one parse per message.  A null struct
    # (empty or null message) becomes a row of nulls, as ``d.*`` gives.
    return df.select(*cols, F.inline(F.array(F.from_json(text, schema))))


def unify(raw: DataFrame) -> DataFrame:
    """Fold the voice / sms / data shapes into one: msisdn, peer_id,
    volume_mb, duration and a ``valid`` status.  Other columns pass through."""
    passthrough = [c for c in raw.columns if c not in UNIFIED_AWAY]
    return raw.select(
        *passthrough,
        X.subscriber().alias("msisdn"),
        X.peer().alias("peer_id"),
        F.col("data_volume_mb").alias("volume_mb"),
        X.usage_duration().alias("duration"),
        F.lit(VALID).alias("status"),
    )


def validate(unified: DataFrame, reject: tuple[str, ...] = ()) -> DataFrame:
    """Add the non-null ``is_valid`` flag.

    The default flags a record invalid for a missing subscriber, a test
    number or a missing type, as the source system does.  ``reject`` names
    further rules of ``functions.cdr.STRICT_RULES`` (negative usage, missing
    peer, unknown type, bad timestamp, non-customer number) to send such
    records to the invalid side as well.
    """
    flag = X.is_valid_strict(reject) if reject else X.is_valid()
    return unified.withColumn("is_valid", flag)


def mediate(raw: DataFrame, reject: tuple[str, ...] = ()) -> DataFrame:
    """unify then validate."""
    return validate(unify(raw), reject)


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid); invalid rows get status ``error``.  The flag is
    dropped from both.  Every input row lands in exactly one side."""
    valid = validated.filter(F.col("is_valid")).drop("is_valid")
    invalid = (
        validated.filter(~F.col("is_valid"))
        .withColumn("status", F.lit(ERROR))
        .drop("is_valid")
    )
    return valid, invalid


def encode(df: DataFrame) -> DataFrame:
    """Key/value message frame: null string key, JSON of all columns
    (null fields are left out of the JSON)."""
    return df.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"),
    )
