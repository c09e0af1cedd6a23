"""Tables of months whose versions change as a whole.

A plain folder of ``year_month=<m>`` partitions is replaced month by month: a failure
between two months leaves old and new ones side by side, and a reader sees the
change half done.  Here every write puts its rows into a folder of its own, and a
*commit file*, which names the folders of every month, is put in place last, in one
rename.  A reader follows the newest commit file, so it sees all of a write or none
of it; a failed write leaves files that no commit names.

Layout::

    <path>/data/write=<id>/year_month=<m>/part-*.parquet
    <path>/_commits/<version>.json     {"months": {"2024-01": ["<id>"], ...}, "schema": ..., "note": ...}

A commit file grows with the number of months, not with their rows.  Two writers that
commit at once: the later one finds its version taken, and applies its change to the
newest version again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tollgate import storage

MONTH = "year_month"
#: The folder of rows without a month (fixed by Spark's partition layout).
NULL_MONTH = "__HIVE_DEFAULT_PARTITION__"
_WRITE = "write"
_TRIES = 20


class MonthTable:
    """A month-partitioned table with atomic versions."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._commits, self._data = f"{self.path}/_commits", f"{self.path}/data"

    # -- versions ----------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in storage.names(self.spark, self._commits) if n.endswith(".json") and n[:-5].isdigit()]

    def exists(self) -> bool:
        return bool(self.versions())

    def commit_of(self, version: int | None = None) -> dict:
        """The commit file of a version (the newest by default); an empty table has
        version 0 and no months."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return {"version": 0, "schema": None, "months": {}, "note": {}}
        return json.loads(storage.read_text(self.spark, f"{self._commits}/{version:020d}.json"))

    def _commit(self, change, schema: StructType, note: dict | None) -> int:
        for _ in range(_TRIES):
            now = self.commit_of()
            version = now["version"] + 1
            entry = {
                "version": version,
                "schema": schema.json(),
                "months": change(dict(now["months"])),
                "note": now["note"] if note is None else note,
            }
            if storage.write_new(self.spark, f"{self._commits}/{version:020d}.json", json.dumps(entry, sort_keys=True)):
                return version
        raise RuntimeError(f"{self.path}: other writers took {_TRIES} versions in turn")

    # -- reading -------------------------------------------------------------------
    def read(self, months: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version.  Only the folders of ``months`` are listed and read."""
        entry = self.commit_of(version)
        if entry["schema"] is None:
            raise FileNotFoundError(f"{self.path} has no version")
        schema = StructType.fromJson(json.loads(entry["schema"]))
        wanted = None if months is None else set(months)
        folders = [
            f"{self._data}/{_WRITE}={write}/{MONTH}={month}"
            for month, writes in entry["months"].items() if wanted is None or month in wanted
            for write in writes
        ]
        if not folders:
            return self.spark.createDataFrame([], schema)
        marked = StructType([*schema.fields, StructField(_WRITE, StringType())])
        return self.spark.read.schema(marked).option("basePath", self._data).parquet(*folders).select(*schema.names)

    # -- writing -------------------------------------------------------------------
    def _written(self, df: DataFrame) -> tuple[str, list[str], StructType]:
        """Write the rows to a folder that no commit names yet: one job, whatever the
        number of months; which months came out is seen in the folder's names."""
        write = uuid.uuid4().hex
        folder = f"{self._data}/{_WRITE}={write}"
        schema = StructType([*[f for f in df.schema.fields if f.name != MONTH], StructField(MONTH, StringType())])
        dealt = df.withColumn(MONTH, F.col(MONTH).cast("string")).hint("rebalance", MONTH)
        dealt.write.partitionBy(MONTH).parquet(folder)
        found = [n.partition("=")[2] for n in storage.names(self.spark, folder) if n.startswith(f"{MONTH}=")]
        return write, found, schema

    def replace(self, df: DataFrame, months: Iterable[str] | None = None, note: dict | None = None) -> int:
        """Make ``df`` the contents of ``months`` (rows of other months are not
        written; a month without rows becomes empty), or of the whole table.  All
        months change together.  Returns the version."""
        wanted = None if months is None else sorted(set(months))
        rows = df if wanted is None else df.filter(F.col(MONTH).isin(wanted))
        write, found, schema = self._written(rows)

        def change(now: dict) -> dict:
            kept = {} if wanted is None else {m: w for m, w in now.items() if m not in set(wanted)}
            return kept | {m: [write] for m in found}

        return self._commit(change, schema, note)

    def append(self, df: DataFrame, note: dict | None = None) -> int:
        write, found, schema = self._written(df)
        return self._commit(lambda now: now | {m: [*now.get(m, []), write] for m in found}, schema, note)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the folders that only older versions than the newest ``keep`` name,
        and those versions' commit files.  Folders that no version names (of a
        write that goes on, or that failed) are left.  Returns the removed writes."""
        versions = sorted(self.versions())
        old, new = versions[:-keep], versions[-keep:]
        held = {w for v in new for writes in self.commit_of(v)["months"].values() for w in writes}
        gone = sorted({w for v in old for writes in self.commit_of(v)["months"].values() for w in writes} - held)
        for v in old:
            storage.remove(self.spark, f"{self._commits}/{v:020d}.json")
        for write in gone:
            storage.remove(self.spark, f"{self._data}/{_WRITE}={write}")
        return gone
