"""Order-independent sums: against exact fractions, over any partitioning, and the same in every form of the statistics."""
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quotelake.functions import exact
from quotelake.operators import stats
from quotelake.plans import reports

KINDS = {"tiny": lambda r: r.uniform(1, 9) * 1e-12, "huge": lambda r: r.uniform(-1, 1) * 1e22,
         "mixed": lambda r: r.choice([1e22, -1e22, 1e-12, 3.7, 0.1]) * r.uniform(1, 3), "near": lambda r: 1e6 + r.random() * 1e-2,
         "whole": lambda r: float(r.randint(-5, 1000)), "cents": lambda r: round(r.uniform(0, 600), 2), "same": lambda r: 0.1}
V = {"v": True}


def groups(seed=1):
    r = random.Random(seed)
    return {f"{k}{n}": [f(r) for _ in range(n)] for k, f in KINDS.items() for n in (1, 2, 7, 40)}


def frame(spark, data):
    rows = [(k, v) for k, vs in data.items() for v in vs]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "k string, v double")


def summary(df):
    g = exact.finished(exact.moments_by(df, ["k"], V), V)
    return {r.k: r for r in g.select("k", exact.mean("v").alias("mean"), exact.mean("v", 6).alias("mean6"), exact.stddev("v").alias("sd"),
                                     exact.top_above_mean("v").alias("spike"), F.col("v__m.off").alias("off")).collect()}


def test_against_fractions(spark):
    data = groups()
    for k, r in summary(frame(spark, data)).items():
        x = [Fraction(v) for v in data[k]]
        mean = sum(x) / len(x)
        assert r.off == 0 and abs(r.mean - float(mean)) <= 3e-16 * abs(float(mean))
        assert r.spike == (max(x) > mean)
        if len(x) == 1:
            assert r.sd is None
        else:
            want = math.sqrt(sum((v - mean) ** 2 for v in x) / (len(x) - 1))
            assert abs(r.sd - want) <= 1e-12 * want


def test_any_partitioning_gives_the_same_bits(spark):
    df = frame(spark, groups(2))
    want = summary(df.coalesce(1))
    for n in (2, 5, 13):
        assert summary(df.repartition(n)) == want
    assert summary(df.repartition(4, F.rand(n)).orderBy("v")) == want


def test_stored_moments_merge(spark):
    df = frame(spark, groups(4)).withColumn("part", F.pmod(F.hash("v"), F.lit(5)))
    parts = exact.moments_by(df, ["k", "part"], V)
    assert summary_of(exact.finished(parts.groupBy("k").agg(*exact.merged(V)), V)) == summary_of(
        exact.finished(exact.moments_by(df, ["k"], V), V))


def summary_of(g):
    return sorted(tuple(r) for r in g.select("k", exact.mean("v"), exact.stddev("v"), exact.top_above_mean("v")).collect())


def test_values_off_the_grid_are_never_left_out(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("big", 1e30), ("big", 3e30), ("inf", inf), ("inf", 1.0), ("nan", nan), ("nan", 1.0), ("null", None), ("dust", 1e-40), ("dust", 3e-40)]
    got = summary(spark.createDataFrame(rows, "k string, v double"))
    assert got["big"].mean == 2e30 and got["big"].off == 2 and got["big"].spike and abs(got["big"].sd - 2 ** 0.5 * 1e30) < 1e16
    assert got["inf"].mean == inf and not got["inf"].spike and math.isnan(got["nan"].mean)
    assert got["null"].mean is None and got["null"].sd is None and not got["null"].spike
    assert got["dust"].mean == 2e-40 and got["dust"].mean6 == 0 and got["dust"].spike


def test_ties_round_as_decimals(spark):
    rows = [("up", 43.472812), ("up", 43.472813), ("neg", -0.000001), ("neg", -0.000002), ("third", 0.1), ("third", 0.2), ("third", 0.4)]
    got = summary(spark.createDataFrame(rows, "k string, v double"))
    assert (got["up"].mean6, got["neg"].mean6, got["third"].mean6) == (43.472813, -0.000002, 0.233333)


EXTREMES = [("a", 1e22, 1e22), ("a", 2e22, 2e22), ("b", 1e-9, 1e-9), ("b", 2e-9, 2e-9), ("c", 1e-12, 1e-12), ("c", 1e-12, 1e-12),
            ("d", 5.0, 1e22), ("d", 6.0, 1e-12), ("e", 7.0, None), ("f", 0.3, 0.1), ("f", 0.3, 0.1), ("f", 0.3, 0.1)]
SPIKES = {"a": True, "b": True, "c": False, "d": True, "e": False, "f": False}


@pytest.fixture
def extreme_quotes(spark):
    df = spark.createDataFrame(EXTREMES, "symbol string, price_usd double, volume_24h double")
    return df.withColumn("recorded_at", F.to_timestamp_ntz(F.lit("2024-01-15 10:00:00")))


def test_every_form_agrees_on_extreme_volumes(spark, extreme_quotes):
    q = extreme_quotes
    assert {r.symbol: r.volume_spike for r in stats.batch_stats(q).collect()} == SPIKES
    assert {r.symbol: r.volume_spike for r in stats.spike_by_join(q, ["symbol"]).collect()} == SPIKES
    assert {r.symbol: r.volume_spike for r in stats.window_stats(q, "5 minutes").collect()} == SPIKES
    rows = stats.window_join(q, "5 minutes").groupBy("symbol").agg(F.bool_or("volume_spike").alias("s")).collect()
    assert {r.symbol: r.s for r in rows} == SPIKES


def test_rollup_counts_extreme_prices(spark, extreme_quotes):
    got = {r.level: r for r in reports.date_rollup(extreme_quotes.where("symbol = 'a'")).collect()}
    assert all(got[level].avg_price == 1.5e22 and got[level].records == 2 for level in ("total", "year", "month", "day"))


def test_deviation_of_a_hot_group_is_stable(spark):
    """A third of all rows in one group, prices around a large mean: the rounded deviation is the same however rows are dealt."""
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, 'hot', concat('s', id % 997)) as symbol", "cast(id as bigint) as volume_24h",
                                        "60000 + (id * 7919 % 10007) * 0.0001 as price_usd", "timestamp_ntz'2024-01-01 00:00:00' as recorded_at")
    want = sorted(map(tuple, stats.history_stats(df, digits=9).collect()))
    assert sorted(map(tuple, stats.history_stats(df.repartition(17, "price_usd"), digits=9).collect())) == want
