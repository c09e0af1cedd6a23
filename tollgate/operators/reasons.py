"""Why a field of a raw message is null.

``decode`` gives null for a field that is absent, null in the JSON or of another type,
and a row of nulls for text that is no JSON; a dead letter doesn't say which.  Here a
message is parsed once, into a ``VARIANT``, and every field is read from that: by its
declared type as ``decode`` reads it, and as it was sent.  A field that was sent and has no
value of its type is *bad*.

Bad fields are ``(field, raw, reason)``: ``wrong_type``, ``out_of_range`` (a whole number
beyond the declared one), and for whole messages, with a null field, ``not_json`` and
``not_an_object``.  Unlike ``decode``, an array is not read as its first element, and
objects and arrays are no strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructField, StructType

from tollgate.operators.mediation import mediate
from tollgate.schemas import RAW_CDR

WRONG_TYPE, OUT_OF_RANGE, NOT_JSON, NOT_AN_OBJECT = "wrong_type", "out_of_range", "not_json", "not_an_object"
BAD = "bad_fields"
_SENT = "_sent"


def _numbers(what: Column) -> Column:
    return what.isin("BIGINT", "DOUBLE", "FLOAT") | what.startswith("DECIMAL")


def decode_with_reasons(
    df: DataFrame, schema: StructType = RAW_CDR, value_col: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Parse JSON messages with a declared schema: ``keep``, ``raw_value`` (the text), the
    fields, and ``bad_fields``.  One parse per message: the variant is made below a
    generator, so no filter on a field is pushed into copies of it."""
    text = F.col(value_col).cast("string")
    made = df.select(
        *keep, F.inline(F.array(F.struct(text.alias("raw_value"), F.try_parse_json(text).alias("_message"))))
    )
    message = F.col("_message")
    sent = []
    for f in schema.fields:
        value = F.try_variant_get(message, f"$['{f.name}']", "variant")
        sent.append(F.struct(value.alias("value"), F.schema_of_variant(value).alias("what")).alias(f.name))
    fielded = made.select(
        *keep, "raw_value", F.inline(F.array(F.struct(F.schema_of_variant(message).alias("_kind"), F.struct(*sent).alias(_SENT))))
    )

    values, bad = [], []
    for f in schema.fields:
        one = F.col(_SENT)[f.name]
        value = _value(one["value"], one["what"], f.dataType)
        values.append(value.alias(f.name))
        bad.append(_bad(one["value"], one["what"], f, value))
    whole = F.when(F.trim("raw_value") == "", F.lit(None)).when(
        F.col("_kind").isNull() & F.col("raw_value").isNotNull(), F.lit(NOT_JSON)
    ).when(~F.col("_kind").startswith("OBJECT") & (F.col("_kind") != "VOID"), F.lit(NOT_AN_OBJECT))
    bad.insert(0, F.when(whole.isNotNull(), _entry(F.lit(None).cast("string"), F.col("raw_value"), whole)))
    return fielded.select(*keep, "raw_value", *values, F.filter(F.array(*bad), lambda x: x.isNotNull()).alias(BAD))


def _entry(field: Column, raw: Column, reason: Column) -> Column:
    return F.struct(field.alias("field"), raw.alias("raw"), reason.alias("reason"))


def _value(value: Column, what: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        fits = ~(what.startswith("OBJECT") | what.startswith("ARRAY"))
    elif isinstance(kind, IntegralType):
        fits = what == "BIGINT"
    else:
        fits = _numbers(what)
    return F.when(fits, F.try_variant_get(value, "$", kind.simpleString()))


def _bad(value: Column, what: Column, field: StructField, typed: Column) -> Column:
    reason = F.lit(WRONG_TYPE)
    if isinstance(field.dataType, IntegralType):
        large = F.abs(F.try_variant_get(value, "$", "double")) >= F.lit(2.0**63)
        reason = F.when((what == "BIGINT") | (_numbers(what) & large), OUT_OF_RANGE).otherwise(WRONG_TYPE)
    sent = what.isNotNull() & (what != "VOID")
    return F.when(sent & typed.isNull(), _entry(F.lit(field.name), F.to_json(value), reason))


def dead_letters(messages: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The invalid side of mediation with the reasons: rows that are invalid, with the
    message text and the bad fields."""
    validated = mediate(decode_with_reasons(messages, RAW_CDR, value_col, keep))
    return validated.filter(~F.col("is_valid")).drop("is_valid").withColumn("status", F.lit("error"))
