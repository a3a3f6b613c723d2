"""Point-in-interval joins against a nested loop in Python."""
import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from quotelake.operators.intervals import interval_join

T0 = dt.datetime(2024, 1, 15)
ROWS = "row_id int, symbol string, recorded_at timestamp_ntz"
WINDOWS = "symbol string, w int, window_start timestamp_ntz, window_end timestamp_ntz"


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def data(seed=1, hot=False):
    r = random.Random(seed)
    pick = lambda: "hot" if hot and r.random() < 0.5 else r.choice(["a", "b", None])
    rows = [(i, pick(), at(r.choice([None, *range(-500, 3000, 7)]))) for i in range(300)]
    windows = []
    for w in range(120):
        start = r.choice([None, *range(-600, 3000, 5)])
        length = r.choice([0, -3, 1, 2, 5, 63, 64, 65, 1000, 100_000])
        windows.append((pick(), w, at(start), None if start is None else at(start + length) + dt.timedelta(microseconds=r.randint(0, 1))))
    return rows, windows


def brute(rows, windows):
    return sorted((i, w) for i, s, t in rows for k, w, a, b in windows
                  if None not in (s, t, k, a, b) and s == k and a <= t < b)


@pytest.mark.parametrize("width", ["1 minute", "1 hour", "7 minutes"])
def test_matches_a_nested_loop(spark, width):
    rows, windows = data()
    got = interval_join(spark.createDataFrame(rows, ROWS), spark.createDataFrame(windows, WINDOWS), ["symbol"], bin_width=width)
    assert got.columns == ["row_id", "symbol", "recorded_at", "w", "window_start", "window_end"]
    assert sorted((r.row_id, r.w) for r in got.collect()) == brute(rows, windows)


def test_left_keeps_every_row(spark):
    rows, windows = data(2)
    got = interval_join(spark.createDataFrame(rows, ROWS), spark.createDataFrame(windows[:15], WINDOWS), ["symbol"], how="left", row_id="row_id")
    pairs = [(r.row_id, r.w) for r in got.collect()]
    want = brute(rows, windows[:15])
    hit = {i for i, _ in want}
    assert sorted(p for p in pairs if p[1] is not None) == want
    assert sorted(i for i, w in pairs if w is None) == sorted(i for i, _, _ in rows if i not in hit)


def test_empty_sides_and_bad_arguments(spark):
    rows, windows = data(3)
    r, w = spark.createDataFrame(rows, ROWS), spark.createDataFrame(windows, WINDOWS)
    assert interval_join(r, w.limit(0), ["symbol"]).count() == 0 and interval_join(r.limit(0), w, ["symbol"]).count() == 0
    assert interval_join(r, w.limit(0), ["symbol"], how="left", row_id="row_id").count() == len(rows)
    for kw in ({"how": "outer"}, {"how": "left"}):
        with pytest.raises(ValueError):
            interval_join(r, w, ["symbol"], **kw)
    with pytest.raises(ValueError):
        interval_join(r.withColumn("w", F.lit(1)), w, ["symbol"])


def test_plan_is_an_equality_join_and_spreads_a_hot_key(spark):
    rows, windows = data(4, hot=True)
    got = interval_join(spark.createDataFrame(rows, ROWS), spark.createDataFrame(windows, WINDOWS), ["symbol"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_bin" in plan and "_level" in plan
    assert sorted((r.row_id, r.w) for r in got.collect()) == brute(rows, windows)


def test_no_side_is_gathered_in_the_driver(spark, tmp_dir):
    rows, windows = data(5)
    sides = []
    for name, side in (("rows", spark.createDataFrame(rows, ROWS)), ("windows", spark.createDataFrame(windows, WINDOWS))):
        side.write.parquet(f"{tmp_dir}/{name}")              # a stored table has a size estimate
        sides.append(spark.read.parquet(f"{tmp_dir}/{name}"))
    got = interval_join(*sides, ["symbol"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("width, origin", [("1 minute", T0), ("1 hour", dt.datetime(1970, 1, 1, 0, 0, 1)), ("7 minutes", T0), ("30 days", T0)])
def test_totals_are_those_of_the_pairs(spark, width, origin):
    """Sums, counts and extremes per window, with repeated windows, rows of one instant and null values."""
    r = random.Random(6)
    rows, windows = data(6, hot=True)
    move = lambda t: None if t is None else t - T0 + origin
    rows = [(i, s, move(t), r.choice([None, i % 17 - 8]), r.choice([None, decimal.Decimal(r.randint(-999, 999)) / 100])) for i, s, t in rows * 2]
    rows += [(i, "a", origin + dt.timedelta(microseconds=r.randint(-3, 3)), 1, None) for i in range(20)]
    windows = [(k, w % 90, move(a), move(b)) for k, w, a, b in windows + windows[:20]]
    windows += [("a", 200 + w, origin + dt.timedelta(microseconds=r.randint(-3, 3)), origin + dt.timedelta(microseconds=r.randint(-3, 3))) for w in range(20)]
    sides = spark.createDataFrame(rows, ROWS + ", v bigint, p decimal(9,2)"), spark.createDataFrame(windows, WINDOWS)
    got = interval_join(*sides, ["symbol"], bin_width=width, by=["w", "symbol"], totals={
        "n": ("count", None), "vs": ("count", "v"), "v": ("sum", "v"), "low": ("min", "p"), "high": ("max", "p"), "p": ("sum", "p")})
    pairs = interval_join(*sides, ["symbol"], bin_width=width)
    want = pairs.groupBy("w", "symbol").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("vs"), F.sum("v").alias("v"),
                                            F.min("p").alias("low"), F.max("p").alias("high"), F.sum("p").alias("p"))
    assert got.dtypes == want.dtypes
    order = lambda df: sorted(map(tuple, df.collect()), key=lambda x: x[:2])
    assert order(got) == order(want) and len(order(got)) > 50


def test_totals_make_no_row_for_each_pair(spark):
    """A window is cut into two bins of a level at most, which cover it once."""
    from quotelake.operators.intervals import _pieces
    r = random.Random(7)
    spans = [(i, a, a + r.randint(1, 1 << r.randint(0, 12))) for i, a in enumerate(r.randint(-5000, 5000) for _ in range(200))]
    got = {x.i: x.p for x in spark.createDataFrame(spans, "i int, _a bigint, _b bigint").select("i", _pieces(13).alias("p")).collect()}
    for i, a, b in spans:
        held = sorted(k for p in got[i] for k in range(p._bin << p._level, (p._bin + 1) << p._level))
        assert held == list(range(a, b)) and len(got[i]) <= 2 * (b - a).bit_length()


def test_totals_refuse_what_they_cannot_give(spark):
    rows, windows = data(8)
    sides = spark.createDataFrame(rows, ROWS).withColumn("x", F.lit(0.5)), spark.createDataFrame(windows, WINDOWS)
    for kw in ({"by": ["w"], "totals": {"x": ("sum", "x")}}, {"by": ["w"], "totals": {"x": ("median", "x")}}, {"totals": {"n": ("count", None)}},
               {"by": ["x"], "totals": {"n": ("count", None)}}, {"by": ["w"], "totals": {"n": ("count", None)}, "how": "left", "row_id": "row_id"}):
        with pytest.raises(ValueError):
            interval_join(*sides, ["symbol"], **kw)
    assert interval_join(sides[0], sides[1].limit(0), ["symbol"], by=["w"], totals={"n": ("count", None)}).count() == 0
