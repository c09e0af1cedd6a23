"""Tables whose versions change as a whole (K4, Q8), and month replacement."""

import pytest
from pyspark.sql import functions as F

from tollgate import storage
from tollgate.plans.stored import stored_months
from tollgate.sinks import tables
from tollgate.sinks.tables import replace_months, write_bills, write_rated
from tollgate.sources.files import read_table
from tollgate.versions import MonthTable

MONTHS = ["2024-01", "2024-02", "2024-03"]


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "v long, year_month string")


def contents(df):
    return sorted(((r.v, r.year_month) for r in df.collect()), key=str)


def test_versions_replace_months_together(spark, tmp_dir):
    table = MonthTable(spark, f"{tmp_dir}/t")
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(rows(spark, (1, "2024-01"), (2, "2024-02"), (3, "2024-03"), (9, None))) == 1
    assert table.replace(rows(spark, (10, "2024-01"), (7, "2024-03")), ["2024-01", "2024-02"]) == 2
    assert contents(table.read()) == [(10, "2024-01"), (3, "2024-03"), (9, None)]
    assert contents(table.read(version=1)) == [(1, "2024-01"), (2, "2024-02"), (3, "2024-03"), (9, None)]
    assert contents(table.read(["2024-03", "2024-02"])) == [(3, "2024-03")]
    assert table.append(rows(spark, (11, "2024-01"), (12, "2024-04"))) == 3
    assert contents(table.read(["2024-01", "2024-04"])) == [(10, "2024-01"), (11, "2024-01"), (12, "2024-04")]
    assert contents(read_table(spark, f"{tmp_dir}/t")) == contents(table.read())
    assert contents(stored_months(spark, f"{tmp_dir}/t", ["2024-04"])) == [(12, "2024-04")]
    assert table.replace(rows(spark), MONTHS) == 4  # months without rows are empty
    assert contents(table.read()) == [(12, "2024-04"), (9, None)]


def test_a_failure_between_months_leaves_the_old_table_whole(spark, tmp_dir):
    table = MonthTable(spark, f"{tmp_dir}/t")
    old = [(1, "2024-01"), (2, "2024-02"), (3, "2024-03")]
    table.replace(rows(spark, *old))
    broken = rows(spark, (10, "2024-01"), (20, "2024-02")).repartition(2, "year_month").withColumn(
        "v", F.when(F.col("v") == 20, F.raise_error(F.lit("planned"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="planned"):
        table.replace(broken, ["2024-01", "2024-02"])
    assert table.versions() == [1] and contents(table.read()) == old


def test_a_failed_commit_leaves_the_old_table_whole(spark, tmp_dir, monkeypatch):
    table = MonthTable(spark, f"{tmp_dir}/t")
    table.replace(rows(spark, (1, "2024-01"), (2, "2024-02")))

    def fails(*_):
        raise OSError("planned")

    monkeypatch.setattr(storage, "write_new", fails)
    with pytest.raises(OSError):
        table.replace(rows(spark, (10, "2024-01")), ["2024-01", "2024-02"])
    assert contents(MonthTable(spark, f"{tmp_dir}/t").read()) == [(1, "2024-01"), (2, "2024-02")]


def test_two_writers_lose_nothing(spark, tmp_dir, monkeypatch):
    table, other = MonthTable(spark, f"{tmp_dir}/t"), MonthTable(spark, f"{tmp_dir}/t")
    table.replace(rows(spark, (1, "2024-01"), (2, "2024-02")))
    commit_of, meddled = MonthTable.commit_of, []

    def slow(self, version=None):
        now = commit_of(self, version)
        if self is table and not meddled:  # the other writer commits after this one has looked
            meddled.append(1)
            other.replace(rows(spark, (20, "2024-02")), ["2024-02"])
        return now

    monkeypatch.setattr(MonthTable, "commit_of", slow)
    assert table.replace(rows(spark, (10, "2024-01")), ["2024-01"]) == 3
    assert contents(table.read()) == [(10, "2024-01"), (20, "2024-02")]


def test_write_new_never_replaces(spark, tmp_dir):
    assert storage.write_new(spark, f"{tmp_dir}/x.json", "one")
    assert not storage.write_new(spark, f"{tmp_dir}/x.json", "two")
    assert storage.read_text(spark, f"{tmp_dir}/x.json") == "one"
    assert [n for n in storage.names(spark, tmp_dir) if not n.startswith(".")] == ["x.json"]
    assert storage.names(spark, f"{tmp_dir}/none") == [] and not storage.exists(spark, f"{tmp_dir}/none")


def test_vacuum_keeps_what_the_newest_versions_name(spark, tmp_dir):
    table = MonthTable(spark, f"{tmp_dir}/t")
    for v in range(4):
        table.replace(rows(spark, (v, "2024-01")), ["2024-01"])
    table.append(rows(spark, (9, "2024-02")))
    assert len(table.vacuum(keep=2)) == 3
    assert table.versions() == [4, 5] and contents(table.read()) == [(3, "2024-01"), (9, "2024-02")]
    assert contents(table.read(version=4)) == [(3, "2024-01")]


def test_writers_follow_a_table_with_versions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    write_rated(rows(spark, (1, "2024-01"), (2, "2024-02")), path, atomic=True)
    write_rated(rows(spark, (10, "2024-01"), (5, "2024-03")), path, months=["2024-01"])  # known by its commits
    write_bills(rows(spark, (3, "2024-03")), path, ["2024-03"])
    write_rated(rows(spark, (4, "2024-03")), path, mode="append")
    assert contents(read_table(spark, path)) == [(10, "2024-01"), (2, "2024-02"), (3, "2024-03"), (4, "2024-03")]
    with pytest.raises(ValueError):
        write_rated(rows(spark), path, mode="other")


def test_replacing_months_runs_the_plan_once(spark, tmp_dir):
    """A month that has no rows any more is emptied without a look at the rows."""
    path = f"{tmp_dir}/t"
    replace_months(rows(spark, (1, "2024-01"), (2, "2024-02"), (3, "2024-03")), path)
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    new = rows(spark, (10, "2024-01"), (99, "2024-04")).mapInArrow(seen, "v long, year_month string")
    replace_months(new, path, MONTHS[:2])
    assert counted.value == 2
    assert contents(read_table(spark, path)) == [(10, "2024-01"), (3, "2024-03")]
    replace_months(rows(spark), path, ["2024-03", "2024-07"])  # no rows at all
    assert contents(read_table(spark, path)) == [(10, "2024-01")]
    assert not hasattr(tables, "Observation")
