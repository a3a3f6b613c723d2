"""Keyed appends, newest-first reads and the curve layout."""
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quotelake.operators.latest import latest_per_key
from quotelake.operators.newest import NewestFirst, day_folders
from quotelake.sinks import lake
from quotelake.sinks.unique import append_unique, existing_keys
from quotelake.sources.adapters import event_quotes
from tests.conftest import SF001


def keyed(spark, rows):
    return spark.createDataFrame(rows, "symbol string, t int, v int, day string").withColumn("day", F.col("day").cast("date"))


D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"


def refused(df):
    return {(r.reason, r.symbol, r.t, r.n) for r in df.collect()}


def test_append_unique(spark, tmp_dir):
    path = tmp_dir + "/facts"
    first = keyed(spark, [("a", 1, 10, D1), ("a", 1, 9, D1), ("b", 1, 5, D2), (None, 1, 1, D1), ("c", 3, 1, None)])
    new = {("duplicate_in_batch", "a", 1, 1), ("null_key", None, 1, 1), ("null_key", "c", 3, 1)}
    assert refused(append_unique(first, path, ["symbol", "t"])) == new
    # a replay adds nothing
    assert refused(append_unique(first, path, ["symbol", "t"])) == new | {("exists", "a", 1, 1), ("exists", "b", 1, 1)}
    more = keyed(spark, [("a", 1, 99, D1), ("a", 2, 7, D1), ("b", 1, 6, D3), ("d", 1, 1, D3)] + [("hot", 5, k, D3) for k in range(50)])
    out = {(r.reason, r.symbol): r.n for r in append_unique(more, path, ["symbol", "t"]).collect()}
    assert out[("exists", "a")] == 1 and out[("duplicate_in_batch", "hot")] == 49 and ("exists", "b") not in out   # day 2 is not touched
    rows = sorted((r.symbol, r.t, r.v) for r in spark.read.parquet(path).collect())
    assert rows == [("a", 1, 9), ("a", 2, 7), ("b", 1, 5), ("b", 1, 6), ("d", 1, 1), ("hot", 5, 0)]


def test_append_unique_reads_touched_days_only(spark, tmp_dir):
    path = tmp_dir + "/facts"
    append_unique(keyed(spark, [("a", d, 1, f"2024-01-{d:02d}") for d in range(1, 20)]), path, ["symbol", "t"])
    plan = existing_keys(spark, path, keyed(spark, [("a", 3, 1, D3)]), ["symbol", "t"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 1 and "dynamicpruning" in text.lower() and "ReadSchema: struct<symbol:string,t:int>" in text


def days(spark, tmp_dir):
    path = tmp_dir + "/days"
    q = event_quotes(spark, SF001).withColumn("day", F.to_date("recorded_at"))
    q = q.withColumn("symbol", F.when(F.to_date("recorded_at") == F.lit("2024-01-03").cast("date"), "rare").otherwise(F.col("symbol")))
    lake.write_partitions(q, path, ["day"])
    return path, q


def test_latest_n_opens_the_newest_days_only(spark, tmp_dir):
    path, q = days(spark, tmp_dir)
    newest, by = NewestFirst(spark, path), [F.col("recorded_at").desc(), F.col("row_id").desc()]
    all_days = day_folders(spark, path)
    assert all_days == sorted(all_days, reverse=True) and len(all_days) > 20
    for n in (1, 10, 70):
        got = [r.row_id for r in newest.latest_n(n, by).collect()]
        assert got == [r.row_id for r in q.orderBy(*by).limit(n).collect()]
        seen, need = 0, 0
        while seen < n:
            seen += q.where(F.col("day") == all_days[need]).count()
            need += 1
        assert newest.opened == all_days[:len(newest.opened)] and len(newest.opened) <= max(1, 2 * need)
    assert newest.latest_n(10 ** 6, by).count() == q.count()


def test_latest_per_key_stops_when_all_keys_are_found(spark, tmp_dir):
    path, q = days(spark, tmp_dir)
    newest = NewestFirst(spark, path)
    common = q.select("symbol").where("symbol <> 'rare'").distinct()
    got = newest.latest_per_key(common, columns=["row_id"])
    opened = len(newest.opened)
    want = latest_per_key(q.where("symbol <> 'rare'"), columns=["row_id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and opened <= 7
    got = newest.latest_per_key(q.select("symbol").unionByName(spark.createDataFrame([(None,), ("none",)], "symbol string")), columns=["row_id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, latest_per_key(q, columns=["row_id"]).collect()))


def test_curve_layout_skips_row_groups_on_either_column(spark, tmp_dir):
    df = spark.range(60_000).select(F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(40)).cast("string")).alias("symbol"),
                                    F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).cast("timestamp_ntz").alias("recorded_at"),
                                    F.when(F.col("id") % 1000 > 0, F.col("id")).alias("row_id"))
    path = tmp_dir + "/curve"
    lake.write_clustered(df, path, partitions=64)
    groups = []
    for file in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(c).statistics for c in (0, 1)]
            groups.append([(s.min, s.max) for s in stats])
    middle = df.selectExpr("percentile_approx(unix_micros(cast(recorded_at as timestamp)), 0.5) as t").first().t

    def share(column, value):
        return sum(lo <= value <= hi for lo, hi in (g[column] for g in groups)) / len(groups)

    import datetime as dt
    at = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=middle)
    assert len(groups) >= 32 and share(0, "s17") < 0.4 and share(1, at) < 0.4
    back = spark.read.parquet(path)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_curve_layout_with_nulls_and_no_rows(spark, tmp_dir):
    df = spark.createDataFrame([(None, None), ("a", None), (None, 1), ("a", 1)] * 3, "symbol string, t int")
    lake.write_clustered(df, tmp_dir + "/n", ("symbol", "t"), 4)
    assert sorted(map(repr, spark.read.parquet(tmp_dir + "/n").collect())) == sorted(map(repr, df.collect()))
    lake.write_clustered(df.limit(0), tmp_dir + "/e", ("symbol", "t"))
    assert spark.read.schema(df.schema).parquet(tmp_dir + "/e").count() == 0
