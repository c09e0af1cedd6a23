"""Streaming hops (C7, T1-T10): stream equals batch, restart, replay."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tollgate import decode, mediate, split
from tollgate.schemas import MEDIATED_CDR, RAW_CDR
from tollgate.sinks.tables import batch_message_writer, batch_table_writer
from tollgate.sources.files import message_files, read_table
from tollgate.streaming.runners import mediation_streams, run_mediation, run_mediation_streams, run_store, wait_any

NOW = {"availableNow": True}


def _voice(i, caller="212660000001"):
    return json.dumps({"record_type": "voice", "timestamp": "2025-06-12T09:30:05Z",
                       "caller_id": caller, "callee_id": "212660000002", "duration_sec": i})


def _drop(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def _batch_result(spark, path):
    msgs = spark.read.text(path)
    valid, invalid = split(mediate(decode(msgs, RAW_CDR)))
    return valid, invalid


def test_two_hops_equal_batch_and_restart(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    _drop(raw, "a.txt", [_voice(1), _voice(2, caller="999"), "junk", _voice(3, caller="front-desk")])
    q = run_mediation(message_files(spark, raw), batch_message_writer(f"{tmp_dir}/valid"),
                      batch_table_writer(f"{tmp_dir}/invalid"), f"{tmp_dir}/ck1", NOW)
    q.awaitTermination()
    bvalid, binvalid = _batch_result(spark, raw)
    got_valid = decode(spark.read.text(f"{tmp_dir}/valid"), MEDIATED_CDR)
    assert sorted(r.duration for r in got_valid.collect()) == sorted(r.duration for r in bvalid.collect())
    assert read_table(spark, f"{tmp_dir}/invalid").count() == binvalid.count() == 2

    # restart with the same checkpoint and one new file: only the new file is processed
    _drop(raw, "b.txt", [_voice(4)])
    q = run_mediation(message_files(spark, raw), batch_message_writer(f"{tmp_dir}/valid"),
                      batch_table_writer(f"{tmp_dir}/invalid"), f"{tmp_dir}/ck1", NOW)
    q.awaitTermination()
    assert decode(spark.read.text(f"{tmp_dir}/valid"), MEDIATED_CDR).count() == 3

    q2 = run_store(message_files(spark, f"{tmp_dir}/valid"), batch_table_writer(f"{tmp_dir}/norm"), f"{tmp_dir}/ck2", NOW)
    q2.awaitTermination()
    stored = read_table(spark, f"{tmp_dir}/norm")
    assert sorted(r.duration_sec for r in stored.collect()) == [1, 4]  # front-desk dropped at normalisation


def test_failed_batch_is_replayed(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    _drop(raw, "a.txt", [_voice(1), _voice(2)])
    calls = {"n": 0}
    good = batch_table_writer(f"{tmp_dir}/out")

    def flaky(df, batch_id):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("sink down")
        good(df, batch_id)

    q = run_store_messages(spark, raw, flaky, f"{tmp_dir}/ck")
    try:
        q.awaitTermination()
    except Exception:
        pass
    q = run_store_messages(spark, raw, flaky, f"{tmp_dir}/ck")
    q.awaitTermination()
    assert read_table(spark, f"{tmp_dir}/out").count() == 2  # replayed, same batch id, no loss


def test_messages_without_raw_coordinates_are_keyed_by_their_own(spark, tmp_dir):
    from tollgate.schemas import KEYED_CDR, RAW_KEYS

    sent = {"record_type": "voice", "timestamp": "2025-06-12T09:30:05Z", "caller_id": "212660000001",
            "callee_id": "212660000099", "duration_sec": 5, "msisdn": "212660000001", "user_id": "212660000001",
            "subscriber_id": "212660000001", "status": "valid"}
    extra = [{}, {}, {"raw_topic": "raw", "raw_partition": 3}, {"raw_topic": "raw", "raw_partition": 3, "raw_offset": 70}]
    os.makedirs(f"{tmp_dir}/valid")
    with open(f"{tmp_dir}/valid/m.txt", "w") as f:
        f.writelines(json.dumps({**sent, **e, "own": k}) + "\n" for k, e in enumerate(extra))
    messages = spark.readStream.text(f"{tmp_dir}/valid").selectExpr(
        "value", "'valid' AS topic", "1 AS partition", "cast(get_json_object(value, '$.own') AS long) AS offset")
    seen = []
    run_store(messages, lambda batch, _: seen.extend(tuple(r) for r in batch.select(*RAW_KEYS).collect()), f"{tmp_dir}/ck", NOW,
              schema=KEYED_CDR, message_keys=RAW_KEYS, own_keys=("topic", "partition", "offset")).awaitTermination()
    assert sorted(seen) == [("raw", 3, 70), ("valid", 1, 0), ("valid", 1, 1), ("valid", 1, 2)]


def run_store_messages(spark, raw, sink, ck):
    # hop 2 fed with raw-shaped voice messages that carry the mediated fields
    msgs = message_files(spark, raw).select(
        F.to_json(F.struct(F.lit("voice").alias("record_type"), F.lit("valid").alias("status"),
                           F.get_json_object("value", "$.caller_id").alias("msisdn"),
                           F.get_json_object("value", "$.duration_sec").cast("long").alias("duration"))).alias("value"))
    return run_store(msgs, sink, ck, NOW)


def test_a_replayed_batch_reaches_the_next_hop_once(spark, tmp_dir):
    """The invalid side fails once; hop 2 runs before and after the restart."""
    raw = f"{tmp_dir}/raw"
    _drop(raw, "a.txt", [_voice(1), "junk"])
    calls = {"n": 0}

    def flaky(df, batch_id):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("sink down")
        batch_table_writer(f"{tmp_dir}/invalid")(df, batch_id)

    for turn in range(2):
        queries = run_mediation_streams(message_files(spark, raw), f"{tmp_dir}/valid", flaky, f"{tmp_dir}/ck1", NOW)
        queries[0].awaitTermination()
        if turn == 0:
            with pytest.raises(StreamingQueryException):
                queries[1].awaitTermination()
        else:
            queries[1].awaitTermination()
        run_store(message_files(spark, f"{tmp_dir}/valid"), batch_table_writer(f"{tmp_dir}/norm"), f"{tmp_dir}/ck2", NOW).awaitTermination()
    assert read_table(spark, f"{tmp_dir}/norm").count() == 1
    assert read_table(spark, f"{tmp_dir}/invalid").count() == 1


def test_wait_any_stops_the_other_query(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    _drop(raw, "a.txt", [_voice(1), "junk"])

    def broken(df, batch_id):
        raise RuntimeError("sink down")

    # No trigger: both would run on for ever.
    queries = run_mediation_streams(message_files(spark, raw), f"{tmp_dir}/valid", broken, f"{tmp_dir}/ck")
    with pytest.raises(StreamingQueryException):
        wait_any(spark, queries)
    assert not any(q.isActive for q in queries)


def test_batches_are_bounded_and_lose_nothing(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    for k in range(7):
        _drop(raw, f"{k}.txt", [_voice(k)])
    queries = run_mediation_streams(message_files(spark, raw, 2), f"{tmp_dir}/valid", f"{tmp_dir}/invalid", f"{tmp_dir}/ck", NOW)
    wait_any(spark, queries, until_all=True)
    assert len(queries[0].recentProgress) >= 4
    assert decode(spark.read.text(f"{tmp_dir}/valid"), MEDIATED_CDR).count() == 7


def test_two_query_variant(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    _drop(raw, "a.txt", [_voice(1), "junk"])
    valid, invalid = mediation_streams(message_files(spark, raw))
    qv = valid.writeStream.foreachBatch(batch_table_writer(f"{tmp_dir}/v")).option("checkpointLocation", f"{tmp_dir}/cv").trigger(availableNow=True).start()
    qi = invalid.writeStream.foreachBatch(batch_table_writer(f"{tmp_dir}/i")).option("checkpointLocation", f"{tmp_dir}/ci").trigger(availableNow=True).start()
    qv.awaitTermination()
    qi.awaitTermination()
    assert read_table(spark, f"{tmp_dir}/v").count() == 1 and read_table(spark, f"{tmp_dir}/i").count() == 1


def test_store_hop_reports_dropped_rows(spark, tmp_dir):
    valid = f"{tmp_dir}/valid"
    med = [json.dumps({"record_type": "voice", "timestamp": "2025-06-12T09:30:05Z", "msisdn": m,
                       "peer_id": "212660000002", "duration": 5, "status": "valid"})
           for m in ("212660000001", "front-desk", "212660000003")]
    _drop(valid, "a.txt", med)
    q = run_store(message_files(spark, valid), batch_table_writer(f"{tmp_dir}/norm"), f"{tmp_dir}/ck", NOW,
                  observe="store_losses")
    q.awaitTermination()
    metrics = [p["observedMetrics"]["store_losses"] for p in q.recentProgress
               if p.get("observedMetrics", {}).get("store_losses")]
    assert sum(m["valid_rows"] for m in metrics) == 3
    assert sum(m["dropped_rows"] for m in metrics) == 1
    assert read_table(spark, f"{tmp_dir}/norm").count() == 2


def test_dead_letters_keep_text_under_strict_rules(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    no_peer = json.dumps({"record_type": "voice", "timestamp": "2025-06-12T09:30:05Z",
                          "caller_id": "212660000001", "duration_sec": 9})
    _drop(raw, "a.txt", [_voice(1), "junk", no_peer])
    q = run_mediation(message_files(spark, raw), batch_table_writer(f"{tmp_dir}/valid"),
                      batch_table_writer(f"{tmp_dir}/invalid"), f"{tmp_dir}/ck", NOW,
                      keep_raw=True, reject=("missing_peer",))
    q.awaitTermination()
    valid = read_table(spark, f"{tmp_dir}/valid")
    assert "raw_value" not in valid.columns and valid.count() == 1
    dead = sorted(r.raw_value for r in read_table(spark, f"{tmp_dir}/invalid").collect())
    assert dead == sorted(["junk", no_peer])
