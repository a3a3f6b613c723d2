"""Hot keys: one symbol holds a third of all rows.

The lookup join is forced past its broadcast limit, so it runs as a sort-merge
join; with AQE's skew thresholds lowered to test scale, the final plan must show
the hot partition split (``skew=true``) and the results must stay exact.
"""
import contextlib

from pyspark.sql import functions as F

from plan_report import plan_text
from quotelake.operators import stats


@contextlib.contextmanager
def _conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_facts(spark, n=60000):
    ids = spark.range(0, n, numPartitions=8)
    return ids.select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("symbol"),
        (F.col("id") % 97 + 1).cast("double").alias("price_usd"),
        (F.col("id") % 89).alias("volume_24h"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("recorded_at"))


def test_hot_key_join_is_split_and_exact(spark):
    with _conf(spark, **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.shuffle.partitions": "16"}):
        facts = _hot_facts(spark)
        s = stats.history_stats(facts)
        out = stats.enrich(facts, s, ["symbol"], max_rows=10)     # 501 keys > 10: no broadcast
        rows = out.groupBy("symbol").agg(F.count("*").alias("n"),
                                         F.countDistinct("volatility_score").alias("v")).collect()
        by = {r.symbol: r for r in rows}
        assert by["hot"].n == 20000 and by["hot"].v == 1
        assert sum(r.n for r in rows) == 60000
        final = out.select("row_id", "volatility_score")
        final.write.format("noop").mode("overwrite").save()
        final.collect()
        assert "SortMergeJoin" in plan_text(final)
        assert "skew=true" in plan_text(final)


def test_hot_key_aggregate_combines_before_shuffle(spark):
    facts = _hot_facts(spark)
    s = stats.history_stats(facts, digits=None)
    hot = s.where("symbol = 'hot'").first()
    assert hot.record_count == 20000
    text = plan_text(s)
    assert text.count("HashAggregate") >= 2       # partial (map side) and final
