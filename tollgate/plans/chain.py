"""End-to-end chains built from the operators.

Batch chains skip the JSON hop between mediation and normalisation: encoding
to JSON and decoding with the mediated schema is the identity apart from
widening ``duration`` to long, which ``normalise`` does itself.  The wire
path (``normalised_over_wire``) keeps the hop for parity checks and streams.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tollgate.operators.billing import bill_monthly
from tollgate.operators.mediation import decode, encode, mediate, split
from tollgate.operators.normalise import normalise
from tollgate.operators.rating import rate_monthly
from tollgate.plans import testbed
from tollgate.plans.joins import hold
from tollgate.schemas import MEDIATED_CDR, RAW_CDR
from tollgate.sources.reference import product_rates


@dataclass
class Testbed:
    """The driver's tables at one scale factor, seen as the rating inputs."""

    __test__ = False  # its name is no test class's

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._cache[name]

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    def raw_messages(self) -> DataFrame:
        return testbed.raw_messages(self.events)

    def raw_records(self) -> DataFrame:
        return testbed.raw_records(self.events)

    def customers(self) -> DataFrame:
        if "names" not in self._cache:
            self._cache["names"] = hold(self.table("nation").select("n_nationkey", "n_name"))
        return testbed.customers_from(self.table("customer"), self._cache["names"])

    def rates(self) -> DataFrame:
        return product_rates(self.spark)


def mediated_from_messages(messages: DataFrame) -> DataFrame:
    """decode -> unify -> validate (``is_valid`` kept)."""
    return mediate(decode(messages, RAW_CDR))


def normalised_over_wire(messages: DataFrame, topic_path: str) -> DataFrame:
    """Both hops with the JSON wire format between them, as two jobs linked
    by a topic: hop 1 writes the valid records as JSON messages (one per
    line) to ``topic_path``; hop 2 reads and decodes them.

    The written topic is also what keeps the plans apart: decoding an
    in-plan ``encode`` would let the optimizer inline the first hop's
    expressions into every field of the second (hundreds of JSON parses per
    row), so the hops are never fused into one plan.
    """
    valid, _ = split(mediated_from_messages(messages))
    encode(valid).select("value").write.mode("overwrite").text(topic_path)
    topic = messages.sparkSession.read.text(topic_path)
    return normalise(decode(topic, MEDIATED_CDR))


def normalised_direct(raw: DataFrame) -> DataFrame:
    """Both hops in one plan from typed raw records (no JSON in between)."""
    valid, _ = split(mediate(raw))
    return normalise(valid)


def rate_and_bill(cdr: DataFrame, customers: DataFrame, rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rated usage, bills) in one plan."""
    rated = rate_monthly(cdr, customers, rates)
    return rated, bill_monthly(rated)
