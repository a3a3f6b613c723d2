"""Streaming: F8 micro-batch fixture (watermark, late rows), restart, rate limit,
the multi-sink foreachBatch job, and fan-out of one stream to several queries."""
import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quotelake.sources.streams import envelope_file_stream, file_metadata, parquet_stream
from quotelake.streaming import jobs

F8 = [
    [("a", 1.0, 10, "00:01"), ("a", 3.0, 30, "00:02"), ("b", 5.0, 7, "00:03")],
    [("a", 9.0, 5, "00:12")],
    [("b", 1.0, 1, "00:30")],
    [("a", 2.0, 99, "00:01:30"), ("b", 1.0, 1, "00:31")],
    [("z", 1.0, 1, "02:00")],
    [("z", 1.0, 1, "03:00")],
]
SCHEMA = "symbol string, price_usd double, volume_24h bigint, recorded_at timestamp_ntz, row_id bigint"


def _ts(hms):
    parts = [int(x) for x in hms.split(":")] + [0]
    return dt.datetime(2024, 1, 1, parts[0], parts[1], parts[2])


def _write_batches(folder, batches, start=0):
    """One parquet file per batch, modification times strictly increasing."""
    os.makedirs(folder, exist_ok=True)
    rid = start * 100
    for i, rows in enumerate(batches, start=start):
        tbl = pa.table({
            "symbol": [r[0] for r in rows], "price_usd": [r[1] for r in rows],
            "volume_24h": pa.array([r[2] for r in rows], pa.int64()),
            "recorded_at": pa.array([_ts(r[3]) for r in rows], pa.timestamp("us")),
            "row_id": pa.array(list(range(rid, rid + len(rows))), pa.int64()),
        })
        rid += len(rows)
        path = os.path.join(folder, f"batch-{i:03d}.parquet")
        pq.write_table(tbl, path)
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def _tumble(spark, folder, ckpt, out, **opts):
    src = jobs.with_event_time(parquet_stream(spark, folder, SCHEMA, max_files_per_trigger=1))
    agg = jobs.tumbling(src, "5 minutes", "5 minutes")
    return jobs.run_available_now(agg, ckpt, sink="parquet", path=out)


def _result(spark, out):
    return sorted((r.symbol, r.window_start.strftime("%H:%M"), r.avg_volume, r.volatility_score,
                   r.record_count) for r in spark.read.parquet(out).collect())


def test_f8_append_mode_and_late_row(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", F8)
    q = _tumble(spark, f"{tmp_dir}/in", f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    assert _result(spark, f"{tmp_dir}/out") == [
        ("a", "00:00", 20.0, 1.414214, 2), ("a", "00:10", 5.0, None, 1),
        ("b", "00:00", 7.0, None, 1), ("b", "00:30", 1.0, 0.0, 2), ("z", "02:00", 1.0, None, 1)]
    assert jobs.late_rows_dropped(q) == 1


def test_f8_late_row_accepted_without_batch_2(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", [F8[0], F8[1], F8[3], F8[4], F8[5]])
    _tumble(spark, f"{tmp_dir}/in", f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    res = _result(spark, f"{tmp_dir}/out")
    assert ("a", "00:00", round((10 + 30 + 99) / 3, 6), 1.0, 3) in res


def test_restart_reads_only_new_files(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", F8[:3])
    _tumble(spark, f"{tmp_dir}/in", f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    first = _result(spark, f"{tmp_dir}/out")
    q = _tumble(spark, f"{tmp_dir}/in", f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    assert sum(p.numInputRows for p in q.recentProgress) == 0      # nothing new
    _write_batches(f"{tmp_dir}/in", F8[3:], start=3)
    _tumble(spark, f"{tmp_dir}/in", f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    final = _result(spark, f"{tmp_dir}/out")
    assert set(first) <= set(final) and len(final) == len(set(final)) == 5


def test_rate_limit_gives_several_batches(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", F8[:4])
    src = parquet_stream(spark, f"{tmp_dir}/in", SCHEMA, max_files_per_trigger=2)
    seen = []
    jobs.run_available_now(src, f"{tmp_dir}/ckpt", foreach_batch=lambda df, i: seen.append((i, df.count())))
    assert [n for _, n in seen if n] == [4, 3]


def test_complete_mode_reemits_all_windows(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", F8)
    src = jobs.with_event_time(parquet_stream(spark, f"{tmp_dir}/in", SCHEMA, max_files_per_trigger=1))
    agg = jobs.tumbling(src, "5 minutes", "5 minutes")
    last = {}

    def keep(df, i):
        last["rows"] = {(r.symbol, r.window_start.strftime("%H:%M")): r.record_count
                        for r in df.collect()}
    jobs.run_available_now(agg, f"{tmp_dir}/ckpt", output_mode="complete", foreach_batch=keep)
    # every window ever seen, the still-open 03:00 one included; no state is evicted
    assert sorted(last["rows"]) == [("a", "00:00"), ("a", "00:10"), ("b", "00:00"),
                                    ("b", "00:30"), ("z", "02:00"), ("z", "03:00")]
    assert last["rows"][("a", "00:00")] == 3      # complete mode does not drop the late row


def test_window_join_stream_flags_rows(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", F8)
    src = jobs.with_event_time(parquet_stream(spark, f"{tmp_dir}/in", SCHEMA, max_files_per_trigger=1))
    joined = jobs.window_join_stream(src, "5 minutes", "5 minutes")
    jobs.run_available_now(joined, f"{tmp_dir}/ckpt", sink="parquet", path=f"{tmp_dir}/out")
    rows = spark.read.parquet(f"{tmp_dir}/out").collect()
    spikes = [(r.symbol, r.recorded_at.strftime("%H:%M")) for r in rows if r.volume_spike]
    assert spikes == [("a", "00:02")]
    assert "03:00" not in {r.recorded_at.strftime("%H:%M") for r in rows}


def _envelopes(folder, n_files, quotes_per_file):
    os.makedirs(folder, exist_ok=True)
    for i in range(n_files):
        coins = [{"id": f"c{j}", "symbol": "s" + str(j % 2), "name": "N", "current_price": float(j + i),
                  "total_volume": (j + 1) * 10, "last_updated": f"2024-01-01T00:0{i}:0{j}.000Z"}
                 for j in range(quotes_per_file)]
        path = os.path.join(folder, f"m{i}.json")
        with open(path, "w") as fh:
            fh.write(json.dumps({"ingested_at": f"2024-01-01T00:0{i}:00+00:00", "coins": coins}) + "\n")
            fh.write("not json\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_batch_pipeline_writes_three_sinks_idempotently(spark, tmp_dir):
    _envelopes(f"{tmp_dir}/in", 4, 3)
    rows = jobs.quotes_from_messages(envelope_file_stream(spark, f"{tmp_dir}/in", max_files_per_trigger=2))
    p = jobs.BatchPipeline(f"{tmp_dir}/raw", f"{tmp_dir}/enr", f"{tmp_dir}/stats")
    jobs.run_available_now(rows, f"{tmp_dir}/ckpt", foreach_batch=p)
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    assert raw.count() == 12 and raw.select("batch_id").distinct().count() == 2
    st = spark.read.parquet(f"{tmp_dir}/stats")
    assert st.count() == 4                      # 2 symbols x 2 micro-batches
    # replaying batch 1 (e.g. after a lost executor) replaces, never duplicates
    # (materialised first: the replay overwrites the folder it was read from)
    held = raw.drop("batch_id", "stream", "day")
    batch1 = spark.createDataFrame(raw.where("batch_id = 1").drop("batch_id", "stream", "day").collect(), held.schema)
    p.stream_id = raw.first().stream
    p(batch1, 1)
    assert spark.read.parquet(f"{tmp_dir}/raw").count() == 12
    enr = spark.read.parquet(f"{tmp_dir}/enr")
    assert enr.count() == 12 and enr.where("volume_spike IS NULL").count() == 0


def test_second_stream_or_new_checkpoint_deletes_nothing(spark, tmp_dir):
    p = jobs.BatchPipeline(f"{tmp_dir}/raw", f"{tmp_dir}/enr", f"{tmp_dir}/stats")
    for k, n in enumerate((3, 1)):
        _envelopes(f"{tmp_dir}/in{k}", 1, n)
        rows = jobs.quotes_from_messages(envelope_file_stream(spark, f"{tmp_dir}/in{k}"))
        jobs.run_available_now(rows, f"{tmp_dir}/ckpt{k}", foreach_batch=p)
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    assert raw.count() == 4 and raw.select("stream").distinct().count() == 2
    # a reset checkpoint on the first input: batch 0 again, under another identity
    rows = jobs.quotes_from_messages(envelope_file_stream(spark, f"{tmp_dir}/in0"))
    jobs.run_available_now(rows, f"{tmp_dir}/ckpt-new", foreach_batch=p)
    assert spark.read.parquet(f"{tmp_dir}/raw").count() == 7


def test_rejects_are_kept_with_a_reason(spark, tmp_dir):
    import json as js
    os.makedirs(f"{tmp_dir}/in")
    coin = {"id": "a", "symbol": "s", "name": "N", "current_price": 1.0, "total_volume": 3, "last_updated": "2024-01-01T00:00:00.000Z"}
    bodies = [js.dumps({"ingested_at": "t", "coins": [coin, {**coin, "symbol": None}, {**coin, "last_updated": "soon"}]}),
              "{cut", js.dumps({"ingested_at": "t"}), js.dumps({"ingested_at": "t", "coins": []})]
    with open(f"{tmp_dir}/in/m.json", "w") as fh:
        fh.write("\n".join(bodies) + "\n")
    seen = []
    jobs.start_pipeline(envelope_file_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/lake", f"{tmp_dir}/ckpt",
                        event_time=True, log=lambda *e: seen.append(e[:2]))
    count = {s: spark.read.parquet(f"{tmp_dir}/lake/{s}").count() for s in ("raw", "enriched", "stats", "rejects")}
    assert count == {"raw": 3, "enriched": 1, "stats": 1, "rejects": 5}
    reasons = sorted(r.reason for r in spark.read.parquet(f"{tmp_dir}/lake/rejects").collect())
    assert reasons == ["empty_coins", "no_coins", "null_symbol", "unparsable", "unreadable_time"]
    assert seen == [("stream_batch", "started"), ("stream_batch", "success")]


def test_streamed_lake_prunes_by_day_and_compacts(spark, tmp_dir):
    from quotelake.sinks import lake
    rows = spark.range(40).selectExpr("concat('s', id % 3) symbol", "id row_id",
                                      "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 4 as int)) recorded_at") \
        .withColumn("day", F.to_date("recorded_at"))
    for b in range(3):
        lake.write_batch(rows.where(F.col("row_id") % 3 == b), f"{tmp_dir}/raw", "s1", b)
    one = spark.read.parquet(f"{tmp_dir}/raw").where("day = '2024-01-02'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ = 2024-01-02", plan) and one.count() == 10
    lake.compact(spark, f"{tmp_dir}/raw", f"{tmp_dir}/days", ["2024-01-02", "2024-01-03"])
    out = spark.read.parquet(f"{tmp_dir}/days")
    assert out.count() == 20 and sorted(os.listdir(f"{tmp_dir}/days"))[-2:] == ["day=2024-01-02", "day=2024-01-03"]


def test_late_rows_listener_sees_every_report(spark, tmp_dir):
    from types import SimpleNamespace as NS
    listener = jobs.LateRows()
    for i in range(250):
        listener.onQueryProgress(NS(progress=NS(id="q", stateOperators=[NS(numRowsDroppedByWatermark=2)])))
    assert listener.dropped == {"q": 500}


def test_window_join_salts_follow_the_state_partitions(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", F8[:2])
    ss = jobs.stream_session(spark, state_partitions=5)
    src = jobs.with_event_time(parquet_stream(ss, f"{tmp_dir}/in", SCHEMA)).withColumn("row_id", F.lit(1))
    joined = jobs.window_join_stream(src, "5 minutes", "5 minutes", keep=("row_id", "price_usd", "volume_24h"))
    assert "sequence(0, 4" in joined._jdf.queryExecution().analyzed().toString()
    assert "RocksDB" in ss.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_kafka_columns_and_publish_frames(spark):
    """The transport projection and the published frame, on static rows of a record's shape."""
    from quotelake.schemas import TRANSPORT_COLUMNS
    from quotelake.sinks.bus import kafka_frame
    from quotelake.sources.streams import kafka_metadata
    import datetime as dt
    record = spark.createDataFrame([(bytearray(b"k"), bytearray(b"{}"), "t", 3, 17, dt.datetime(2024, 1, 1))],
                                   "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    assert record.columns == TRANSPORT_COLUMNS
    r = kafka_metadata(record).first()
    assert (r.key, r.value, r.topic, r.partition, r.offset) == ("k", "{}", "t", 3, 17)
    env = spark.createDataFrame([("2024", 0, 1, "{}")], "ingested_at string, envelope_no long, n_coins int, value string")
    assert [tuple(x) for x in kafka_frame(env).collect()] == [("2024", "{}")]


def test_file_metadata_columns(spark, tmp_dir):
    _envelopes(f"{tmp_dir}/in", 1, 1)
    seen = []
    meta = file_metadata(envelope_file_stream(spark, f"{tmp_dir}/in"))
    jobs.run_available_now(meta, f"{tmp_dir}/ckpt", foreach_batch=lambda df, i: seen.extend(df.collect()))
    assert len(seen) == 2 and seen[0].topic.endswith("m0.json") and seen[0].kafka_timestamp is not None


def test_fan_out_three_queries(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", F8)
    src = jobs.with_event_time(parquet_stream(spark, f"{tmp_dir}/in", SCHEMA))
    q1 = src.writeStream.format("memory").queryName("fan_mem").option(
        "checkpointLocation", f"{tmp_dir}/c1").trigger(availableNow=True).start()
    q2 = src.writeStream.format("parquet").option("path", f"{tmp_dir}/o2").option(
        "checkpointLocation", f"{tmp_dir}/c2").trigger(availableNow=True).start()
    got = []
    q3 = src.writeStream.foreachBatch(lambda df, i: got.append(df.count())).option(
        "checkpointLocation", f"{tmp_dir}/c3").trigger(availableNow=True).start()
    for q in (q1, q2, q3):
        q.awaitTermination()
    assert spark.table("fan_mem").count() == 9
    assert spark.read.parquet(f"{tmp_dir}/o2").count() == 9 and sum(got) == 9


def test_console_sink_and_timed_stop(spark, tmp_dir, capfd):
    import time
    _write_batches(f"{tmp_dir}/in", F8[:2])
    src = parquet_stream(spark, f"{tmp_dir}/in", SCHEMA)
    q = (src.writeStream.format("console").option("truncate", "false").option("numRows", "3")
            .option("checkpointLocation", f"{tmp_dir}/ckpt")
            .trigger(processingTime="1 second").start())
    deadline = time.time() + 60
    while time.time() < deadline and not any(p.numInputRows for p in q.recentProgress):
        time.sleep(0.5)
    q.stop()
    assert not q.isActive
    assert sum(p.numInputRows for p in q.recentProgress) == 4


def test_batch_pipeline_window_scope(spark, tmp_dir):
    _envelopes(f"{tmp_dir}/in", 2, 4)
    rows = jobs.quotes_from_messages(envelope_file_stream(spark, f"{tmp_dir}/in"))
    p = jobs.BatchPipeline(f"{tmp_dir}/raw", f"{tmp_dir}/enr", f"{tmp_dir}/stats", window="1 minute")
    jobs.run_available_now(rows, f"{tmp_dir}/ckpt", foreach_batch=p)
    st = spark.read.parquet(f"{tmp_dir}/stats")
    # 2 symbols x 2 one-minute windows (files stamp minutes 0 and 1), one micro-batch
    assert st.count() == 4 and "bucket_start" in st.columns


def test_start_pipeline_end_to_end(spark, tmp_dir):
    _envelopes(f"{tmp_dir}/in", 3, 2)
    q = jobs.start_pipeline(envelope_file_stream(spark, f"{tmp_dir}/in", 2), f"{tmp_dir}/lake",
                            f"{tmp_dir}/ckpt", event_time=True)
    assert not q.isActive
    assert spark.read.parquet(f"{tmp_dir}/lake/raw").count() == 6
    assert spark.read.parquet(f"{tmp_dir}/lake/stats").select("batch_id").distinct().count() == 2


def test_stream_session_sizes_state_without_touching_caller(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    child = jobs.stream_session(spark, state_partitions=3)
    assert child.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    dflt = jobs.stream_session(spark)
    assert int(dflt.conf.get("spark.sql.shuffle.partitions")) == spark.sparkContext.defaultParallelism


def test_observed_quality_metrics_per_batch(spark, tmp_dir):
    from pyspark.sql import Observation
    from quotelake.operators.quality import gate_metrics, observed
    _write_batches(f"{tmp_dir}/in", F8[:3])
    src = parquet_stream(spark, f"{tmp_dir}/in", SCHEMA, max_files_per_trigger=1) \
        .withColumn("name", F.when(F.col("symbol") == "b", None).otherwise(F.col("symbol")))
    q = jobs.run_available_now(observed(src), f"{tmp_dir}/ckpt", sink="parquet", path=f"{tmp_dir}/out")
    per_batch = [p.observedMetrics["quality"] for p in q.recentProgress if "quality" in p.observedMetrics]
    assert [(m["row_count"], m["null_critical_rows"]) for m in per_batch][:3] == [(3, 1), (1, 0), (1, 1)]
    assert gate_metrics({"row_count": 1, "null_critical_rows": 1})["nulls_status"] == "failed"
    obs = Observation("batch_quality")
    observed(spark.read.parquet(f"{tmp_dir}/out"), obs).write.format("noop").mode("overwrite").save()
    assert obs.get["row_count"] == 5


def test_state_partitions_frozen_in_checkpoint(spark, tmp_dir):
    _write_batches(f"{tmp_dir}/in", F8[:2])
    ss = jobs.stream_session(spark, state_partitions=3)
    src = jobs.with_event_time(parquet_stream(ss, f"{tmp_dir}/in", SCHEMA))
    jobs.run_available_now(jobs.tumbling(src, "5 minutes", "5 minutes"), f"{tmp_dir}/ckpt",
                           sink="parquet", path=f"{tmp_dir}/out")
    with open(f"{tmp_dir}/ckpt/offsets/0") as fh:
        meta = json.loads(fh.read().splitlines()[1])
    assert meta["conf"]["spark.sql.shuffle.partitions"] == "3"
    assert sorted(os.listdir(f"{tmp_dir}/ckpt/state/0")) == ["0", "1", "2", "_metadata"]


def test_recorded_at_type_same_in_both_time_modes(spark, tmp_dir):
    _envelopes(f"{tmp_dir}/in", 1, 2)
    for mode in (True, False):
        rows = jobs.quotes_from_messages(envelope_file_stream(spark, f"{tmp_dir}/in"), event_time=mode)
        assert dict(rows.dtypes)["recorded_at"] == "timestamp_ntz"
