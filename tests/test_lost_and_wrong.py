"""Whole rule sets in one scan (C12), split JSON arrays (S6), balanced JDBC ranges (S3,
S4), lost offsets (T6), reasons of nulls (C1) and mergeable distinct counts (A3)."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tollgate.operators import quality as Q
from tollgate.operators.mediation import decode
from tollgate.operators.offsets import gaps, islands, merge_islands
from tollgate.operators.reach import merged_reach, monthly_reach
from tollgate.operators.reasons import BAD, dead_letters, decode_with_reasons
from tollgate.plans.joins import bounded, hold
from tollgate.schemas import RAW_CDR
from tollgate.sources import jdbc
from tollgate.sources.files import read_snapshot
from tollgate.sources.json_array import follow, range_states, read_json_array


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- one scan for all rules ---------------------------------------------------------
def table(spark, path, rows=400, seed=1):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None]), rng.choice([1.5, None]), i % 390) for i in range(rows)]
    spark.createDataFrame(data, "k string, j int, d double, n long").write.parquet(path)
    return spark.read.parquet(path)


RULES = [
    Q.Rule("allowed", ("k",), allowed=("a", "b")), Q.Rule("not_null", ("k", "j")), Q.Rule("unique", ("n",)),
    Q.Rule("unique", ("k", "j")), Q.Rule("fk", ("j",), parent="p", parent_columns=("id",)), Q.Rule("fk", ("k", "n"), parent="q"),
]


def test_a_rule_set_takes_one_scan(spark, tmp_dir):
    df = table(spark, f"{tmp_dir}/t")
    parents = {"p": spark.createDataFrame([(1,), (1,), (None,)], "id long"),  # another type than the child's
               "q": df.filter("n < 200").select("k", "n")}
    found = Q.check(df, RULES, {**parents, "q": spark.createDataFrame(parents["q"].collect(), "k string, n long")})
    assert plan(found).count("FileScan parquet") == 1
    want = {}
    for rule in RULES:  # the rules one by one
        part = Q.violations(df, rule, parents)
        for r in part.collect():
            value = json.dumps({c: r[c] for c in rule.columns if r[c] is not None}, separators=(",", ":"))
            key = (rule.name, value)
            want[key] = want.get(key, 0) + (r.n_rows if rule.kind == "unique" else 1)
    assert {(r.rule, r.value): r.n_rows for r in found.collect()} == want
    assert {r.kind for r in RULES if any(k[0] == r.name for k in want)} == {"allowed", "not_null", "unique", "fk"}


def test_rules_of_an_empty_table_and_unknown_kinds(spark):
    empty = spark.createDataFrame([], "k string, j int, d double, n long")
    parents = {"p": spark.createDataFrame([], "id int"), "q": empty}
    assert Q.check(empty, RULES, parents).count() == 0
    with pytest.raises(ValueError):
        Q.check(empty, [Q.Rule("other", ("k",))])


# -- held dimensions ----------------------------------------------------------------
def test_a_small_stored_book_is_broadcast(spark, tmp_dir):
    from tollgate.operators.rating import price
    from tollgate.sources.reference import product_rates

    product_rates(spark).write.parquet(f"{tmp_dir}/book")
    stored = spark.read.parquet(f"{tmp_dir}/book")
    usage = spark.createDataFrame([("+1", "RP1", "sms", "2025-01", 60.0)],
                                  "customer_id string, rate_plan_id string, record_type string, year_month string, total_consumption_units double")
    usage.write.parquet(f"{tmp_dir}/usage")
    usage = spark.read.parquet(f"{tmp_dir}/usage")
    assert not bounded(stored) and bounded(hold(stored))
    assert hold(stored).schema == stored.schema and sorted(hold(stored).collect()) == sorted(stored.collect())
    assert not bounded(hold(stored, max_rows=5)) and hold(stored, max_rows=5) is stored
    assert hold(product_rates(spark)).count() == 6
    text = plan(price(usage, hold(stored)))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert price(usage, hold(stored)).first().cost == price(usage, stored).first().cost == pytest.approx(0.5)


# -- JSON arrays by byte ranges ------------------------------------------------------
def records(n, seed=1):
    rng = random.Random(seed)
    odd = lambda: "".join(rng.choice('{}[]"\\ab\n\té😀,:') for _ in range(rng.randrange(12)))
    return [{"record_type": rng.choice(["voice", "s}m{s", 'q"[]\\']), "caller_id": odd(), "duration_sec": i,
             "extra": {"a": [{"b": 1}, odd()], odd() + "x": "}"}} for i in range(n)]


@pytest.mark.parametrize("split", ["128m", "20k", "1k"])
def test_arrays_are_read_by_byte_ranges(spark, tmp_dir, split):
    recs = records(600)
    files = {"one_line": json.dumps(recs), "indented": json.dumps(recs[:50], indent=2) + "\n",
             "raw_utf8": json.dumps(recs[:50], ensure_ascii=False), "crlf": json.dumps(recs[:9], indent=1).replace("\n", "\r\n")}
    for name, text in files.items():
        with open(f"{tmp_dir}/{name}.json", "w", newline="") as f:
            f.write(text)
    keys = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = sorted(map(str, read_json_array(spark, tmp_dir).collect()))
        ranges = range_states(spark, tmp_dir).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(map(str, read_snapshot(spark, tmp_dir).collect())) and len(got) == 709
    size = os.path.getsize(f"{tmp_dir}/one_line.json")
    assert ranges >= {"128m": 4, "20k": size // 20_000, "1k": size // 1_000}[split]


def test_odd_arrays(spark, tmp_dir):
    texts = {"empty": "[]", "nothing": "", "scalars": '["x{", 7, null, {"duration_sec": 5}, "}"]', "single": '{"duration_sec": 6}',
             "nested": '[[{"duration_sec": 7}], {"duration_sec": 8, "a": {"duration_sec": 9}}]', "cut": '[{"duration_sec": 10}, {"duration_sec": 11',
             "two": '[{"duration_sec": 12}]\n[{"duration_sec": 13}]'}
    for name, text in texts.items():
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text)
    got = sorted(r.duration_sec if r.duration_sec is not None else -1 for r in read_json_array(spark, tmp_dir).collect())
    assert got == [5, 6, 7, 8, 10, 11, 12, 13]  # the record that is cut has its whole fields


def test_following_from_any_state():
    pieces = ['b":"x', '"', ',{"c":1', ',{"d":"\\"']
    assert list(follow(pieces[:2], True, 1)) == [("head", 'b":"x}"}')]
    assert list(follow(pieces[:1], True, 1)) == [("middle", 'b":"x}')]
    assert list(follow(["1", ',{"c":1', ',{"d":2'], False, 1)) == [("head", "1}"), ("record", '{"c":1}'), ("record", '{"d":2}')]
    assert list(follow(['x","y{","z":{', "", ""], True, 1)) == [("head", 'x","y{","z":{}}')]
    assert list(follow(['[{"a":"'], False, 0)) == [("tail", '{"a":"}')]
    assert list(follow(["]"], False, 0)) == []


# -- JDBC ranges -----------------------------------------------------------------------
@pytest.mark.parametrize("kind", ["skewed", "string", "date", "ties"])
def test_ranges_cover_every_row_once(spark, monkeypatch, kind):
    rng = random.Random(2)
    ids = {"skewed": [int(10 ** (rng.random() * 9)) for _ in range(4000)], "string": [f"it's {rng.randrange(900)}" for _ in range(3000)],
           "date": [f"2025-{1 + i % 3:02d}-{1 + rng.randrange(28):02d}" for i in range(2000)], "ties": [7] * 3000 + list(range(1000))}[kind]
    df = spark.createDataFrame([(i,) for i in ids], "id long" if kind in ("skewed", "ties") else "id string")
    df = df.withColumn("id", F.col("id").cast("date")) if kind == "date" else df
    df.unionByName(df.limit(5).withColumn("id", F.lit(None).cast(df.schema["id"].dataType))).createOrReplaceTempView("usage_rows")
    asked = {}

    def read(spark_, url, table, properties=None, **_):
        asked["query"] = table
        return spark.sql(f"SELECT * FROM {table}")  # the database's part

    monkeypatch.setattr(jdbc, "read_jdbc", read)
    monkeypatch.setattr(jdbc, "read_jdbc_predicates", lambda s, u, t, predicates, p=None: predicates)
    predicates = jdbc.read_jdbc_balanced(spark, "jdbc:x", "usage_rows", "id", 8)
    counts = [spark.sql(f"SELECT count(*) FROM usage_rows WHERE {p}").first()[0] for p in predicates]
    assert sum(counts) == len(ids) + 5 and asked["query"].count("NTILE(8)") == 1
    if kind != "ties":  # one value with most rows can't be parted
        assert len(predicates) == 8 and max(counts) <= 2 * sum(counts) / len(counts)


def test_ranges_of_nothing():
    assert jdbc.range_predicates("id", []) == ["1 = 1"] == jdbc.range_predicates("id", [None, 5, 5])
    assert jdbc.range_predicates("id", [1, 9]) == ["id < 9 OR id IS NULL", "id >= 9"]
    assert jdbc.range_predicates("id", ["a", "b'c"])[1] == "id >= 'b''c'"


# -- lost offsets -------------------------------------------------------------------------
def test_gaps_between_merged_islands(spark, monkeypatch):
    from tollgate.operators import offsets

    monkeypatch.setattr(offsets, "SLICE", 10)
    rng = random.Random(4)
    data = [("t", rng.choice([0, 0, 0, 1]), o) for o in range(500) for _ in range(2) if rng.random() < 0.5] + [("u", 0, 5), (None, 0, 9), ("t", None, 9), ("t", 0, None)]
    df = spark.createDataFrame(data, "topic string, partition int, offset long")
    batches = [islands(df.filter(F.pmod(F.xxhash64("offset"), F.lit(3)) == b)) for b in range(3)]
    runs = merge_islands(batches[0].unionByName(batches[1]).unionByName(batches[2]))
    stored = {}
    for t, p, o in data:
        if None not in (t, p, o):
            stored.setdefault((t, p), set()).add(o)
    want_runs, want_gaps = [], []
    for (t, p), offsets_ in stored.items():
        runs_ = []
        for o in sorted(offsets_):
            if runs_ and runs_[-1][1] == o - 1 and o % 10:  # runs are cut at the edges of slices
                runs_[-1][1] = o
            else:
                runs_.append([o, o])
        want_runs += [(t, p, a, b) for a, b in runs_]
        want_gaps += [(t, p, a[1] + 1, b[0] - 1, b[0] - a[1] - 1) for a, b in zip(runs_, runs_[1:]) if b[0] > a[1] + 1]
    assert sorted(tuple(r) for r in runs.collect()) == sorted(want_runs)
    assert sorted(tuple(r) for r in gaps(runs).collect()) == sorted(want_gaps) == sorted(tuple(r) for r in gaps(islands(df)).collect())
    whole = spark.createDataFrame([("t", 0, 3, 44), ("t", 0, 47, 61), ("t", 0, 60, 60)], "topic string, partition int, first long, last long")
    assert [tuple(r) for r in gaps(whole).collect()] == [("t", 0, 45, 46, 2)]  # runs that nobody has cut
    assert gaps(islands(df.limit(0))).count() == 0


# -- why a field is null ---------------------------------------------------------------------
MESSAGES = {
    '{"record_type":"voice","caller_id":212,"duration_sec":"5","data_volume_mb":1}': [("duration_sec", '"5"', "wrong_type")],
    '{"duration_sec":99999999999,"session_duration_sec":5.5,"data_volume_mb":"x"}': [
        ("duration_sec", "99999999999", "out_of_range"), ("data_volume_mb", '"x"', "wrong_type"), ("session_duration_sec", "5.5", "wrong_type")],
    '{"session_duration_sec":123456789012345678901234567890,"duration_sec":-3,"cell_id":true}': [
        ("session_duration_sec", "123456789012345678901234567890", "out_of_range")],
    '{"duration_sec":null,"caller_id":"","data_volume_mb":1e3,"unknown":{}}': [], "{}": [], "": [], "  ": [], "null": [],
    '{"a":': [(None, '{"a":', "not_json")], "junk": [(None, "junk", "not_json")], "[1]": [(None, "[1]", "not_an_object")],
    '"text"': [(None, '"text"', "not_an_object")],
}


def test_bad_fields_carry_reasons_and_values_are_those_of_decode(spark):
    df = spark.createDataFrame([(i, m) for i, m in enumerate([*MESSAGES, None])], "id int, value string")
    found = {r.id: r for r in decode_with_reasons(df, keep=("id",)).collect()}
    plain = {r.id: r for r in decode(df, RAW_CDR, keep=("id",)).collect()}
    for i, want in enumerate([*MESSAGES.values(), []]):
        assert sorted((tuple(x) for x in found[i][BAD]), key=str) == sorted(want, key=str), found[i].raw_value
        assert [found[i][c] for c in RAW_CDR.names] == [plain[i][c] for c in RAW_CDR.names], found[i].raw_value


def test_dead_letters_have_reasons_with_one_parse(spark, tmp_dir):
    with open(f"{tmp_dir}/m.txt", "w") as f:
        f.write("\n".join(m for m in MESSAGES if m.strip()) + "\n")
    out = dead_letters(spark.read.text(tmp_dir))
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    text = out._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    assert text.lower().count("parsejson") + text.count("parse_json(") == 1
    kept = {r.raw_value: r for r in out.collect()}
    assert '{"record_type":"voice","caller_id":212,"duration_sec":"5","data_volume_mb":1}' not in kept  # valid though bad
    assert kept["junk"].bad_fields[0].reason == "not_json" and kept["junk"].status == "error"


# -- distinct counts that merge -----------------------------------------------------------------
def test_sketches_of_months_merge(spark, tmp_dir):
    n = 6000
    cdr = spark.range(n * 3).select(
        F.concat(F.lit("+"), (F.col("id") % n).cast("string")).alias("customer_id"),
        F.when(F.col("id") % 7 == 0, "sms").otherwise("voice").alias("record_type"),
        F.timestamp_seconds(F.lit(1_735_700_000) + (F.col("id") % 4) * 86_400 * 31).alias("timestamp"))
    customers = spark.range(n).select(F.concat(F.lit("+"), F.col("id").cast("string")).alias("customer_id"),
                                      F.when(F.col("id") % 5 == 0, "north").otherwise("south").alias("region"))
    months = monthly_reach(cdr, customers.unionByName(customers))
    months.write.parquet(f"{tmp_dir}/m")
    stored = spark.read.parquet(f"{tmp_dir}/m")
    assert stored.count() == 8
    for r in stored.select("n_customers", F.hll_sketch_estimate("customers").alias("e")).collect():
        assert abs(r.e - r.n_customers) <= 0.05 * r.n_customers
    got = {r.region: r for r in merged_reach(stored).collect()}
    assert abs(got["north"].est_customers - 1200) <= 60 and abs(got["south"].est_customers - 4800) <= 240
    assert {r.est_services for r in got.values()} == {2}
    (all_,) = merged_reach(stored, by=()).collect()
    assert abs(all_.est_customers - n) <= 0.05 * n
