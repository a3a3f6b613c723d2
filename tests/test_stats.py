"""Stats scopes, spike equivalences, window join and latest-per-key forms."""
from pyspark.sql import functions as F

from quotelake.operators import latest, stats
from quotelake.plans import reports
from quotelake.sources.adapters import brand_quotes, event_quotes
from tests.conftest import SF001, SF01


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _fixture(spark):
    rows = [("a", 1.0, 10, "2024-01-01 00:01:00", 1), ("a", 3.0, 30, "2024-01-01 00:02:00", 2),
            ("b", 5.0, 7, "2024-01-01 00:03:00", 3), ("b", 6.0, 7, "2024-01-01 00:04:00", 4),
            ("c", 2.0, None, "2024-01-01 00:05:00", 5)]
    return spark.createDataFrame(rows, "symbol string, price_usd double, volume_24h bigint, t string, row_id bigint") \
        .withColumn("recorded_at", F.col("t").cast("timestamp_ntz")).drop("t")


def test_one_pass_spike_equals_join_form(spark):
    q = event_quotes(spark, SF01).withColumn("day", F.to_date("recorded_at"))
    one = stats.batch_stats(q, ["day"]).select("symbol", "day", "volume_spike")
    two = stats.spike_by_join(q, ["symbol", "day"])
    assert _rows(one) == _rows(two)
    # both values occur at this grain
    assert {r.volume_spike for r in one.collect()} <= {True, False}


def test_spike_on_fixture(spark):
    s = {r.symbol: r for r in stats.history_stats(_fixture(spark)).collect()}
    assert s["a"].volume_spike is True and s["a"].avg_volume == 20.0
    assert s["b"].volume_spike is False          # all volumes equal
    assert s["c"].volume_spike is False          # NULL volume -> false
    assert round(s["a"].volatility_score, 6) == 1.414214
    assert s["b"].record_count == 2


def test_window_join_equals_range_join(spark):
    q = event_quotes(spark, SF001)
    eq = stats.window_join(q, "1 hour").select("row_id", "avg_volume_window", "volume_spike")
    w = q.groupBy("symbol", F.window("recorded_at", "1 hour").alias("w")) \
         .agg(F.round(F.avg("volume_24h"), 6).alias("avg_volume_window"),
              F.avg("volume_24h").alias("raw_avg"))
    rng = q.alias("p").join(w.alias("w"), (F.col("p.symbol") == F.col("w.symbol"))
                            & (F.col("p.recorded_at") >= F.col("w.w.start"))
                            & (F.col("p.recorded_at") < F.col("w.w.end")), "left") \
           .select("p.row_id", "w.avg_volume_window",
                   F.coalesce(F.col("p.volume_24h") > F.col("w.raw_avg"), F.lit(False)).alias("volume_spike"))
    assert _rows(eq) == _rows(rng)


def test_window_stats_reference_rounding(spark):
    ws = stats.window_stats(_fixture(spark), "5 minutes", digits=(2, 4, 2, 2))
    a = ws.where("symbol = 'a'").first()
    assert a.avg_price == 2.0 and a.volatility_score == 1.4142 and a.record_count == 2


def test_enrich_left_join_keeps_all_rows(spark):
    f = _fixture(spark)
    s = stats.history_stats(f).where("symbol <> 'c'")
    out = stats.enrich(f, s, ["symbol"])
    assert out.count() == f.count()
    assert out.where("symbol = 'c'").first().volume_spike is None


def test_latest_forms_agree_with_ties(spark):
    q = brand_quotes(spark, SF001)
    cols = ["price_usd", "recorded_at", "row_id"]
    a = latest.latest_per_key(q, "symbol", ("recorded_at", "row_id"), cols)
    b = latest.latest_per_key_window(q, "symbol", ("recorded_at", "row_id"), cols)
    assert _rows(a) == _rows(b)
    assert a.count() == q.select("symbol").distinct().count()


def test_top_k_nulls_first(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 9)], "symbol string, volume_24h bigint")
    got = [r.symbol for r in latest.top_k(df, [F.col("volume_24h").desc_nulls_first()], 2).collect()]
    assert got == ["b", "c"]


def test_ranked_page(spark):
    df = spark.range(0, 120).withColumnRenamed("id", "market_cap")
    page = latest.ranked_page(df, [F.col("market_cap").desc()], 50, 2)
    assert [r.market_cap for r in page.collect()] == list(range(69, 19, -1))


def test_trend_sql_equals_dataframe(spark):
    q = event_quotes(spark, SF001)
    assert _rows(reports.q2_trend(q, "view")) == _rows(reports.q2_trend_sql(spark, q, "view"))


def test_spike_rate_and_pivot(spark):
    s = stats.window_stats(event_quotes(spark, SF001), "1 day")
    rate = reports.q4_spike_rate(s).collect()
    assert all(0.0 <= r.volume_spike_pct <= 100.0 for r in rate)
    piv = reports.heatmap_pivot(s, ["click", "view"])
    assert piv.columns == ["window_start", "click", "view"]


def test_window_join_keeps_null_time_rows(spark):
    f = _fixture(spark).unionByName(spark.createDataFrame(
        [("a", 4.0, 50, 9)], "symbol string, price_usd double, volume_24h bigint, row_id bigint")
        .withColumn("recorded_at", F.lit(None).cast("timestamp_ntz")))
    out = stats.window_join(f, "5 minutes")
    assert out.count() == f.count()
    r = out.where("row_id = 9").first()
    assert r.window_start is None and r.volume_spike is False


def test_tumbling_start_matches_window(spark):
    from quotelake.functions.scalars import tumbling_start
    q = event_quotes(spark, SF001)
    a = q.select("row_id", tumbling_start("recorded_at", "5 minutes").alias("s"))
    b = q.select("row_id", F.window("recorded_at", "5 minutes").start.alias("s"))
    assert _rows(a) == _rows(b)


def test_dashboard_sql_trend_param(spark):
    from quotelake.plans import dashboard_sql
    q = event_quotes(spark, SF001)
    a = dashboard_sql.run(spark, "trend", facts=q, symbol="signup")
    assert _rows(a) == _rows(reports.q2_trend(q, "signup"))
    dashboard_sql.register_views(q)
    b = spark.sql(dashboard_sql.VIEW_SQL["trend"], args={"symbol": "signup"})
    assert _rows(b) == _rows(a)


def test_stats_scopes(spark):
    import pytest
    q = event_quotes(spark, SF001)
    assert _rows(stats.stats(q, "history")) == _rows(stats.history_stats(q))
    assert stats.stats(q, "window", "1 day").count() == stats.window_stats(q, "1 day").count()
    assert stats.stats(q.withColumn("d", F.to_date("recorded_at")), "batch", keys=["d"]).count() > 5
    with pytest.raises(ValueError):
        stats.stats(q, "window")


def test_checked_broadcast_falls_back_above_limit(spark):
    from quotelake.operators.joins import checked_broadcast, lookup_join
    q = event_quotes(spark, SF001)
    small = stats.history_stats(q).select("symbol", "volatility_score")
    assert lookup_join(q, small, ["symbol"]).count() == q.count()
    # with a limit below the row count the side is not broadcast: plan has no broadcast of it
    big = checked_broadcast(q.select("row_id", "symbol"), max_rows=10)
    joined = q.select("row_id").join(big, ["row_id"])
    assert joined.count() == q.count()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


def test_latest_forms_keep_a_null_key_and_break_ties(spark):
    rows = [(None, 1, 5), (None, 1, 9), ("a", 2, 10), ("a", 2, 9), ("a", 1, 99), ("b", None, 1)]
    df = spark.createDataFrame(rows, "symbol string, recorded_at int, row_id int")
    expected = [(None, 1, 9), ("a", 2, 10), ("b", None, 1)]
    for out in (latest.latest_per_key(df), latest.latest_per_key(df, method="max_by"), latest.latest_per_key_window(df)):
        assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(expected, key=str)


def test_brand_ties_go_by_integers(spark):
    from quotelake.sources.adapters import BRAND_ORDER
    rows = [("x", 1, 9, 1, 1, 1), ("x", 1, 10, 1, 1, 1)]
    df = spark.createDataFrame(rows, "symbol string, recorded_at int, l_orderkey int, l_linenumber int, l_partkey int, l_suppkey int")
    assert latest.latest_per_key(df, order=BRAND_ORDER).first().l_orderkey == 10


def test_spike_forms_agree_just_above_the_mean(spark):
    """3,000,001 rows of one key, one of them lower: the mean rounds to the highest value."""
    df = spark.range(3_000_001).selectExpr("'k' as symbol", "if(id = 0, 4L, 5L) as volume_24h", "1.0d as price_usd",
                                           "timestamp_ntz'2024-01-01 00:00:00' as recorded_at")
    assert stats.history_stats(df).first().volume_spike is True
    assert stats.spike_by_join(df, ["symbol"]).first().volume_spike is True


def test_exact_mean_rounds_ties_and_signs(spark):
    from quotelake.functions.exact import exact_mean
    rows = [("t", 43.472812), ("t", 43.472813), ("n", -0.000001), ("n", -0.000002), ("z", None), ("w", 1e30), ("w", 3e30),
            ("m", 1.5), ("m", None), ("m", 2.5)]
    got = {r.k: r.m for r in spark.createDataFrame(rows, "k string, v double").groupBy("k")
           .agg(exact_mean("v", 6).alias("m")).collect()}
    assert got == {"t": 43.472813, "n": -0.000002, "z": None, "w": 2e30, "m": 2.0}


def test_heatmap_keeps_every_symbol(spark):
    rows = [("s%d" % i, 1, float(i)) for i in range(6)] + [(None, 2, 9.0)]
    df = spark.createDataFrame(rows, "symbol string, window_start int, volatility_score double")
    out = {r.window_start: r.asDict() for r in reports.heatmap_pivot(df).collect()}
    assert out[1]["s5"] == 5.0 and out[2]["None"] == 9.0 and len(out[1]) == 8
    import pytest
    with pytest.raises(ValueError):
        reports.heatmap_pivot(df, max_symbols=3)


def test_rows_without_time_are_counted(spark):
    df = spark.createDataFrame([(None,), (1,)], "recorded_at int")
    assert stats.rows_without_time(df).first().rows_without_time == 1


def test_latest_plan_has_no_shuffle_of_input(spark):
    from plan_report import plan_text
    out = reports.q5_latest(brand_quotes(spark, SF001))
    out.collect()
    text = plan_text(out)
    assert "BroadcastHashJoin LeftSemi" in text
    assert _rows(out) == _rows(reports.q5_latest(brand_quotes(spark, SF001), method="max_by"))


def test_ranked_page_rejects_bad_arguments(spark):
    import pytest
    df = spark.range(3)
    for per_page, page in ((0, 1), (5, 0)):
        with pytest.raises(ValueError):
            latest.ranked_page(df, [F.col("id")], per_page, page)
