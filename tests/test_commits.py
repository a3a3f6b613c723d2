"""Atomic multi-sink commits, audit before publication, incremental history, late-row output."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelake.operators import stats
from quotelake.plans import history
from quotelake.plans.registry import raw_lake_rows
from quotelake.sinks import lake, manifest
from quotelake.sources.adapters import event_quotes
from quotelake.streaming import jobs
from quotelake.streaming.late import TumblingWithLate
from tests.conftest import SF001

SINKS = ("raw", "enriched", "stats", "rejects")


class Broken(jobs.BatchPipeline):
    """Fails before writing the sink named in ``at``."""
    at = None

    def _sink(self, name, *rest):
        if name == self.at:
            raise RuntimeError(name)
        super()._sink(name, *rest)


@pytest.fixture(scope="module")
def quotes(spark):
    return raw_lake_rows(event_quotes(spark, SF001)).cache()


def parts(quotes, n):
    return [quotes.where(F.pmod("row_id", F.lit(n)) == k) for k in range(n)]


def counts(spark, base):
    return {s: manifest.read_committed(spark, base, s).count() for s in SINKS[:3]}


@pytest.mark.parametrize("sink", SINKS)
def test_a_batch_shows_in_all_sinks_or_none(spark, quotes, tmp_dir, sink):
    first, second = parts(quotes, 2)
    jobs.BatchPipeline(commit_base=tmp_dir, stream_id="s")(first, 0)
    want = counts(spark, tmp_dir)
    failing = Broken(commit_base=tmp_dir, stream_id="s")
    failing.at = sink
    with pytest.raises(RuntimeError):
        failing(second, 1)
    assert counts(spark, tmp_dir) == want
    jobs.BatchPipeline(commit_base=tmp_dir, stream_id="s")(second, 1)
    assert counts(spark, tmp_dir)["raw"] == quotes.count() and counts(spark, tmp_dir)["enriched"] == quotes.count()
    jobs.BatchPipeline(commit_base=tmp_dir, stream_id="s")(second, 1)          # a replay after the commit writes nothing
    jobs.BatchPipeline(commit_base=tmp_dir, stream_id="t")(second, 1)          # another stream is another batch
    assert counts(spark, tmp_dir)["raw"] == quotes.count() + second.count()


def test_nothing_committed_yet(spark, tmp_dir):
    assert manifest.manifest(spark, tmp_dir).count() == 0 and not manifest.is_settled(spark, tmp_dir, "s", 0)


def test_readers_prune_folders_by_the_manifest(spark, quotes, tmp_dir):
    for k, part in enumerate(parts(quotes, 3)):
        jobs.BatchPipeline(commit_base=tmp_dir, stream_id="s")(part, k)
    only = manifest.manifest(spark, tmp_dir).filter("batch_id = 1")
    got = manifest.read_committed(spark, tmp_dir, "raw", only=only)
    assert {r[0] for r in got.select("batch_id").distinct().collect()} == {1}
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString().lower()


def test_gate_quarantines_a_bad_batch_until_release(spark, quotes, tmp_dir):
    log = []
    good, bad = parts(quotes, 2)
    bad = bad.withColumn("name", F.when(F.col("row_id") > 20, F.col("name")))
    job = jobs.BatchPipeline(commit_base=tmp_dir, stream_id="s", gate=True, log=lambda *e: log.append(e))
    job(bad, 0)
    job(good, 1)
    job(good.limit(0), 2)                                                     # an empty batch fails the row-count gate
    assert counts(spark, tmp_dir)["raw"] == good.count()
    assert [e[1] for e in log if e[0] == "data_quality_nulls"] == ["started", "failed", "started", "success"]
    assert [e[1] for e in log if e[0] == "data_quality_row_counts"] == ["started", "success", "started", "success", "started", "failed"]
    job(bad, 0)                                                               # a replay does not publish it either
    assert counts(spark, tmp_dir)["raw"] == good.count()
    assert manifest.release(spark, tmp_dir, "s", 0) and not manifest.release(spark, tmp_dir, "s", 0)
    assert not manifest.release(spark, tmp_dir, "s", 1)
    assert counts(spark, tmp_dir)["raw"] == quotes.count()


def test_compaction_swaps_folders_in_one_commit(spark, quotes, tmp_dir):
    for k, part in enumerate(parts(quotes, 3)):
        jobs.BatchPipeline(commit_base=tmp_dir, stream_id="s")(part, k)
    before = sorted(map(repr, manifest.read_committed(spark, tmp_dir, "raw").drop(*manifest.KEYS).collect()))
    assert manifest.compact_committed(spark, tmp_dir) == 3 and manifest.compact_committed(spark, tmp_dir) == 0
    after = manifest.read_committed(spark, tmp_dir, "raw")
    assert {r[0] for r in after.select("stream").distinct().collect()} == {"compact"}
    assert sorted(map(repr, after.drop(*manifest.KEYS).select(*spark.read.parquet(f"{tmp_dir}/raw").drop(*manifest.KEYS).columns)
                      .collect())) == before
    assert manifest.vacuum(spark, tmp_dir, "raw") == 3 and manifest.read_committed(spark, tmp_dir, "raw").count() == len(before)


def stats_rows(df):
    return sorted(map(tuple, df.collect()))


def test_incremental_history_reads_only_new_batches(spark, quotes, tmp_dir):
    base, state = tmp_dir + "/lake", tmp_dir + "/state"
    a, b, c, d = parts(quotes, 4)
    job = jobs.BatchPipeline(commit_base=base, stream_id="s")
    job(a, 0)
    job(b, 1)
    assert history.update_history(spark, base, state) == 2 and history.update_history(spark, base, state) == 0
    job(c, 2)
    assert history.update_history(spark, base, state) == 1
    assert stats_rows(history.incremental_history(spark, state)) == stats_rows(stats.history_stats(a.union(b).union(c)))
    manifest.compact_committed(spark, base)                                   # moves covered rows only
    assert history.update_history(spark, base, state) == 0
    job(d, 3)
    assert history.update_history(spark, base, state) == 1
    assert stats_rows(history.incremental_history(spark, state)) == stats_rows(stats.history_stats(quotes))
    job(a, 4)
    manifest.compact_committed(spark, base)                                   # joins a covered with an uncovered batch
    assert history.update_history(spark, base, state) == 1
    assert stats_rows(history.incremental_history(spark, state)) == stats_rows(stats.history_stats(quotes.union(a)))


def quote(symbol, time, price=1.0, volume=1):
    return symbol, None if time is None else dt.datetime.fromisoformat("2024-01-15T" + time), price, volume


def batch(spark, *rows):
    return spark.createDataFrame(rows, "symbol string, recorded_at timestamp_ntz, price_usd double, volume_24h bigint")


def test_late_rows_go_to_the_side_output(spark, tmp_dir):
    job = TumblingWithLate(tmp_dir, "5 minutes", "5 minutes")
    job(batch(spark, quote("a", "10:01:00", 1.0), quote("a", "10:04:59", 3.0), quote("b", "10:12:00"), quote(None, "10:01:00"), quote("a", None)), 0)
    # watermark 10:07: the first window of a is closed; a row in it is late, one at 10:06 still counts
    again = batch(spark, quote("a", "10:02:00"), quote("a", "10:06:00"), quote("b", "10:30:00"))
    job(again, 1)
    job(again, 1)                                                             # replayed: settled
    closed = {(r.symbol, str(r.window_start)[11:16]): (r.record_count, r.avg_price, r.volatility_score) for r in job.results(spark).collect()}
    assert closed == {("a", "10:00"): (2, 2.0, 1.414214), ("a", "10:05"): (1, 1.0, None), ("b", "10:10"): (1, 1.0, None)}
    assert sorted(r.reason for r in job.results(spark, "late").collect()) == ["late", "null_symbol", "unreadable_time"]
    assert [(r.symbol, r.record_count) for r in job.results(spark, "open").collect()] == [("b", 1)]
    restarted = TumblingWithLate(tmp_dir, "5 minutes", "5 minutes")           # no state in the object
    restarted(batch(spark, quote("b", "10:20:00"), quote("b", "10:31:00")), 2)
    assert job.results(spark, "late").filter("reason = 'late'").count() == 2
    assert [(r.symbol, r.record_count) for r in job.results(spark, "open").collect()] == [("b", 2)]


def test_first_batch_without_times(spark, tmp_dir):
    job = TumblingWithLate(tmp_dir, "5 minutes", "5 minutes")
    job(batch(spark, quote("a", None)), 0)
    job(batch(spark, quote("a", "10:00:00")), 1)
    assert job.results(spark, "late").count() == 1 and job.results(spark, "open").count() == 1


def test_write_folder_replaces(spark, tmp_dir):
    for n in (3, 2):
        lake.write_folder(spark.range(n), tmp_dir + "/x")
    assert spark.read.parquet(tmp_dir + "/x").count() == 2


def test_committed_batches_stage_their_table_rows(spark, quotes, tmp_dir, monkeypatch):
    """With a manifest, table rows go to a staging table per batch, replaced by a replay; without, they are appended."""
    calls = []
    monkeypatch.setattr(jobs.jdbc_sink, "write_table", lambda df, options, mode="append": calls.append((options["dbtable"], mode, df.count())))
    tables = {"coin_prices": {"dbtable": "coin_prices"}, "market_stats": {"dbtable": "market_stats"}}
    jobs.BatchPipeline(commit_base=tmp_dir, stream_id="s-1", jdbc=tables)(quotes, 4)
    jobs.BatchPipeline(f"{tmp_dir}/r", f"{tmp_dir}/e", f"{tmp_dir}/s", stream_id="s-1", jdbc=tables)(quotes, 4)
    assert [c[:2] for c in calls] == [("coin_prices_stage_s_1_4", "overwrite"), ("market_stats_stage_s_1_4", "overwrite"),
                                      ("coin_prices", "append"), ("market_stats", "append")]
    assert calls[0][2] == calls[2][2] > 0


def test_stream_history_and_compact_commands(spark, tmp_dir, capsys):
    from quotelake import cli
    from quotelake.functions import envelope
    from quotelake.sinks.bus import publish_files
    q = event_quotes(spark, SF001)
    publish_files(envelope.to_envelopes(q, envelope.iso_utc(F.date_trunc("hour", "recorded_at"))), tmp_dir + "/in")
    lake_dir, state = tmp_dir + "/lake", tmp_dir + "/state"
    stream = ["stream", "--files", tmp_dir + "/in", "--lake", lake_dir, "--checkpoint", tmp_dir + "/ckpt", "--event-time", "--gate"]
    assert cli.main(stream) == 0 and cli.main(["compact", "--lake", lake_dir]) == 0
    assert cli.main(["history", "--lake", lake_dir, "--state", state, "--out", tmp_dir + "/stats"]) == 0
    assert manifest.read_committed(spark, lake_dir, "raw").count() == q.count()
    assert spark.read.parquet(tmp_dir + "/stats").agg(F.sum("record_count")).first()[0] == q.count()
    assert cli.main(["history", "--lake", lake_dir, "--state", state]) == 0 and "0 new batches" in capsys.readouterr().out


def test_run_log_errors_are_warnings(spark, tmp_dir, caplog):
    from quotelake.sinks.runlog import lake_logger
    with open(tmp_dir + "/file", "w") as f:
        f.write("x")
    lake_logger(spark, tmp_dir + "/file")("stage", "started", "m")
    assert "not written" in caplog.text
