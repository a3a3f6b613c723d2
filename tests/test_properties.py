"""Property tests: core operators against a brute-force pandas model.

Inputs are generated with one dominant ("hot") symbol, NULL volumes, NULL
times and tied timestamps, i.e. the cases where a shortcut would go wrong.
"""
import datetime as dt
import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotelake.operators import latest, stats

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "row_id bigint, symbol string, price_usd double, volume_24h bigint, recorded_at timestamp_ntz"

row = st.tuples(
    st.sampled_from(["hot", "hot", "hot", "hot", "b", "c"]),
    st.floats(min_value=0.01, max_value=1000, allow_nan=False).map(lambda x: round(x, 2)),
    st.one_of(st.none(), st.integers(min_value=0, max_value=100)),
    st.one_of(st.none(), st.integers(min_value=0, max_value=180)),   # minutes; ties likely
)
rows_strategy = st.lists(row, min_size=1, max_size=30)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frames(spark, rows):
    data = [(i, s, p, v, None if m is None else BASE + dt.timedelta(minutes=m))
            for i, (s, p, v, m) in enumerate(rows)]
    pdf = pd.DataFrame(data, columns=["row_id", "symbol", "price_usd", "volume_24h", "recorded_at"])
    pdf["recorded_at"] = pd.to_datetime(pdf["recorded_at"])
    return spark.createDataFrame(data, SCHEMA), pdf


def _close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= 1e-6 * max(1.0, abs(b))


@SETTINGS
@given(rows_strategy)
def test_history_stats_match_brute_force(spark, rows):
    sdf, pdf = _frames(spark, rows)
    got = {r.symbol: r for r in stats.history_stats(sdf, digits=None).collect()}
    for sym, g in pdf.groupby("symbol"):
        r = got[sym]
        vols = g["volume_24h"].dropna()
        mean = vols.mean() if len(vols) else None
        assert _close(r.avg_volume, mean)
        sd = g["price_usd"].std(ddof=1) if len(g) > 1 else None
        assert _close(r.volatility_score, sd)
        assert r.volume_spike == bool(len(vols) and (vols > mean).any())
        assert r.record_count == len(g)


@SETTINGS
@given(rows_strategy)
def test_latest_per_key_matches_brute_force(spark, rows):
    sdf, pdf = _frames(spark, rows)
    got = {r.symbol: r.row_id for r in latest.latest_per_key(
        sdf, "symbol", ("recorded_at", "row_id"), ["row_id"]).collect()}
    got_w = {r.symbol: r.row_id for r in latest.latest_per_key_window(
        sdf, "symbol", ("recorded_at", "row_id"), ["row_id"]).collect()}
    got_2 = {r.symbol: r.row_id for r in latest.latest_per_key(
        sdf, "symbol", ("recorded_at", "row_id"), ["row_id"], method="max_by").collect()}
    assert got_2 == got
    for sym, g in pdf.groupby("symbol"):
        # NULL times sort lowest (max ignores them unless all are NULL); then highest id
        timed = g.dropna(subset=["recorded_at"])
        pool = timed[timed["recorded_at"] == timed["recorded_at"].max()] if len(timed) else g
        assert got[sym] == pool["row_id"].max() == got_w[sym]


@SETTINGS
@given(rows_strategy)
def test_window_join_matches_brute_force(spark, rows):
    sdf, pdf = _frames(spark, rows)
    got = {r.row_id: r for r in stats.window_join(sdf, "30 minutes", digits=None).collect()}
    assert len(got) == len(pdf)                       # left join keeps every row
    pdf["w"] = pdf["recorded_at"].dt.floor("30min")
    for _, r in pdf.iterrows():
        g = got[r.row_id]
        if pd.isna(r.w):
            assert g.window_start is None and g.volume_spike is False
            continue
        grp = pdf[(pdf.symbol == r.symbol) & (pdf.w == r.w)]
        vols = grp["volume_24h"].dropna()
        mean = vols.mean() if len(vols) else None
        assert _close(g.avg_volume_window, mean)
        expect = bool(mean is not None and not pd.isna(r.volume_24h) and r.volume_24h > mean)
        assert g.volume_spike == expect


@SETTINGS
@given(rows_strategy)
def test_one_pass_spike_equals_join_form(spark, rows):
    sdf, _ = _frames(spark, rows)
    one = {r.symbol: r.volume_spike for r in stats.history_stats(sdf, digits=None).collect()}
    two = {r.symbol: r.volume_spike for r in stats.spike_by_join(sdf, ["symbol"]).collect()}
    assert one == two


quote_row = st.tuples(
    st.text(max_size=12),                                   # id: quotes, backslashes, unicode
    st.one_of(st.none(), st.text(max_size=6)),              # symbol
    st.one_of(st.none(), st.text(max_size=20)),             # name
    st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
    st.one_of(st.none(), st.integers(min_value=-2**63, max_value=2**63 - 1)),
)


@SETTINGS
@given(st.lists(quote_row, min_size=1, max_size=25))
def test_envelope_round_trip_is_lossless(spark, rows):
    from quotelake.functions import envelope
    data = [(i, r[0], r[1], r[2], r[3], r[4], BASE) for i, r in enumerate(rows)]
    df = spark.createDataFrame(
        data, "row_id bigint, id string, symbol string, name string, price_usd double, "
              "volume_24h bigint, recorded_at timestamp_ntz") \
        .withColumns({"market_cap": F.lit(None).cast("bigint"),
                      "price_change_pct_24h": F.lit(None).cast("double"),
                      "high_24h": F.lit(None).cast("double"), "low_24h": F.lit(None).cast("double"),
                      "last_updated": F.lit(None).cast("string")})
    env = envelope.to_envelopes(df, F.lit("2024-01-01T00:00:00+00:00"), max_quotes=7)
    assert env.agg(F.max("n_coins")).first()[0] <= 7
    back = envelope.parse_envelopes(env).select("id", "symbol", "name", "current_price", "total_volume")
    got = sorted(map(tuple, back.collect()), key=repr)
    want = sorted([(r[0], r[1], r[2], r[3], r[4]) for r in rows], key=repr)
    assert got == want
