"""Contracts, quality gates and the run log."""
import pytest
from pyspark.sql import functions as F

from quotelake.operators import contracts, quality
from quotelake.sinks import jdbc as jdbc_sink
from quotelake.sinks.runlog import log_frame


def _facts(spark, rows):
    return spark.createDataFrame(
        rows, "symbol string, name string, price_usd double, recorded_at timestamp_ntz")


def test_not_null_split(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    f = _facts(spark, [("a", "A", 1.0, t), (None, "B", 2.0, t), ("c", None, None, t)])
    ok, bad = contracts.split_not_null(f, contracts.NOT_NULL["coin_prices"])
    assert ok.count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == ["null_name", "null_symbol"]
    s = contracts.not_null_summary(f, contracts.NOT_NULL["coin_prices"]).first()
    assert (s.total, s.accepted, s.rejected, s.null_price_usd) == (3, 1, 2, 1)


def test_domain_check(spark):
    from quotelake.schemas import LOG_STATUSES
    df = spark.createDataFrame([("success",), ("done",), (None,)], "status string")
    ok, bad = contracts.split_domain(df, "status", LOG_STATUSES)
    assert ok.count() == 1 and bad.count() == 2


def test_decimal_overflow_rejected_not_failed(spark):
    df = spark.createDataFrame([(12.34, 1.0), (2.0e6, None)], "volatility_score double, other double")
    out = contracts.cast_decimals(df, contracts.MARKET_STATS_DECIMALS).collect()
    assert str(out[0].volatility_score) == "12.3400" and out[0].decimal_reject is False
    assert out[1].volatility_score is None and out[1].decimal_reject is True


def test_fixture_row_fits_table_precision(spark):
    import datetime as dt
    df = spark.createDataFrame([("ada", "Cardano", 0.61803, 21700000000, 480250, -2.7182, dt.datetime(2024, 3, 9, 8))],
                               "symbol string, name string, price_usd double, market_cap bigint, "
                               "volume_24h bigint, price_change_pct_24h double, recorded_at timestamp_ntz")
    r = jdbc_sink.fact_rows(df).first()
    assert str(r.price_usd) == "0.61803000" and str(r.price_change_pct_24h) == "-2.7182"
    s = spark.createDataFrame([("ada", 0.5772, False, dt.datetime(2024, 3, 9, 8), dt.datetime(2024, 3, 9, 9))],
                              "symbol string, volatility_score double, volume_spike boolean, "
                              "window_start timestamp_ntz, window_end timestamp_ntz")
    assert str(jdbc_sink.stats_rows(s).first().volatility_score) == "0.5772"


def test_defaults_and_ids(spark):
    df = spark.createDataFrame([("a", None), ("b", True)], "symbol string, volume_spike boolean")
    out = contracts.stamp_ids(contracts.apply_defaults(df, {"volume_spike": F.lit(False)}))
    rows = out.collect()
    assert [r.volume_spike for r in rows] == [False, True]
    assert len({r.id for r in rows}) == 2 and all(r.created_at is not None for r in rows)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in contracts.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]


def test_gates_order_and_log(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    log = []
    good = _facts(spark, [("a", "A", 1.0, t)])
    assert quality.run_gates(good, lambda *e: log.append(e))["row_count"] == 1
    assert [e[1] for e in log] == ["started", "success", "started", "success"]

    log.clear()
    with pytest.raises(quality.QualityGateError, match="Found 1 null-critical rows"):
        quality.run_gates(_facts(spark, [("a", None, 1.0, t)]), lambda *e: log.append(e))
    assert log[-1][1] == "failed"

    log.clear()
    with pytest.raises(quality.QualityGateError, match="empty"):
        quality.run_gates(good.limit(0), lambda *e: log.append(e))
    assert [e[0] for e in log] == [quality.ROW_COUNT_STAGE] * 2   # null gate never ran


def test_failing_logger_never_fails_gate(spark):
    import datetime as dt
    good = _facts(spark, [("a", "A", 1.0, dt.datetime(2024, 1, 1))])

    def boom(*_):
        raise RuntimeError("log store down")
    assert quality.run_gates(good, boom)["null_critical_rows"] == 0


def test_report_and_log_rows_when_empty(spark):
    empty = _facts(spark, [])
    rep = quality.dq_report(empty).first()
    assert (rep.row_count_status, rep.nulls_status) == ("failed", "skipped")
    assert [r.seq for r in quality.run_log_rows(quality.dq_report(empty)).collect()] == [1, 2]


def test_log_frame_refuses_an_unknown_status(spark, tmp_dir):
    import os

    from quotelake.sinks.runlog import lake_logger, with_log_columns
    rows = log_frame(spark, [("lake_compaction", "running", "day 3 of 9")]).collect()
    assert len(rows) == 1 and rows[0].stage == "lake_compaction" and rows[0].run_id
    with pytest.raises(ValueError, match="bogus"):
        log_frame(spark, [("lake_compaction", "success", ""), ("x", "bogus", None)])
    with pytest.raises(ValueError, match="done"):
        lake_logger(spark, f"{tmp_dir}/log")("x", "done", "")
    assert not os.path.exists(f"{tmp_dir}/log")
    frame = spark.createDataFrame([("x", None, "m")], "stage string, status string, message string")
    with pytest.raises(Exception, match="unknown run-log status"):
        with_log_columns(frame).collect()


def test_contract_split_keeps_every_row(spark):
    import datetime as dt
    t = dt.datetime(2024, 5, 6)
    rows = [("eos", "Eos", 0.75, 10, 20, -0.5, t), ("eos", None, 0.75, 10, 20, 0.0, t), (None, "X", 1.0, 1, 1, 1.0, t),
            ("big", "Big", 5e11, 10, 20, 0.0, t), ("pct", "Pct", 1.0, 10, 20, 123456.0, t), ("nt", "Nt", 1.0, 1, 1, 1.0, None)]
    df = spark.createDataFrame(rows, "symbol string, name string, price_usd double, market_cap bigint, volume_24h bigint, "
                                     "price_change_pct_24h double, recorded_at timestamp_ntz")
    good, bad = jdbc_sink.split_facts(df)
    assert [r.symbol for r in good.collect()] == ["eos"] and str(good.schema["price_usd"].dataType) == "DecimalType(18,8)"
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "null_name", "null_recorded_at", "null_symbol", "overflow_price_change_pct_24h", "overflow_price_usd"]


def test_enforce_record_contract(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    contract = StructType([StructField("id", StringType(), False), StructField("n", LongType(), True)])
    df = spark.createDataFrame([("a", "7"), ("b", "x"), (None, "1"), ("c", None)], "id string, n string")
    good, bad = contracts.enforce(df, contract)
    assert [tuple(r) for r in good.collect()] == [("a", 7), ("c", None)] and good.schema["n"].dataType == LongType()
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_n", "null_id"]
    with pytest.raises(ValueError, match="missing columns: n"):
        contracts.enforce(df.select("id"), contract)


def test_jdbc_write_options():
    o = jdbc_sink.jdbc_options("jdbc:x", "coin_prices", "u", "p")
    assert jdbc_sink.write_options(o, "overwrite")["truncate"] == "true"
    assert "truncate" not in jdbc_sink.write_options(o, "append")
    assert jdbc_sink.write_options({**o, "truncate": "false"}, "overwrite")["truncate"] == "false"
    assert jdbc_sink.staged(o, "a-b", 7)["dbtable"] == "coin_prices_stage_a_b_7"
