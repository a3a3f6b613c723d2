"""Backfill: rebuild the fact and stats tables from the raw lake.

Reads the raw lake (schema from the parquet footers), projects the seven fact
columns and computes whole-history stats per symbol in one aggregate.  Both
targets are *replaced* (a rerun never duplicates rows) and skipped when the
lake is empty.  The fact write streams rows straight through; the stats
aggregate scans only the four columns it needs (column pruning), so the lake
is never cached.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.stats import history_stats
from quotelake.schemas import FACT_COLUMNS
from quotelake.sinks import jdbc as jdbc_sink
from quotelake.sinks.lake import clustered, rebalanced


def backfill_frames(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    facts = raw.select(*FACT_COLUMNS)
    stats = history_stats(raw)
    return facts, stats


def backfill(spark: SparkSession, raw_path: str, facts_path: str | None = None,
             stats_path: str | None = None,
             jdbc: Mapping[str, Mapping[str, str]] | None = None,
             rejects_path: str | None = None) -> dict[str, bool]:
    """Run the backfill; returns which targets were written.

    JDBC targets are truncated and refilled; rows that break a table's contract go to ``rejects_path``.
    """
    raw = spark.read.parquet(raw_path)
    if raw.isEmpty():
        return {"facts": False, "stats": False}
    facts, stats = backfill_frames(raw)
    if facts_path:
        # static overwrite: the whole target is replaced, days absent from the lake too
        clustered(rebalanced(facts.withColumn("day", F.to_date("recorded_at")), ["day"])) \
            .write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy("day").parquet(facts_path)
    if stats_path:
        clustered(stats, ("symbol", "window_end")).write.mode("overwrite").parquet(stats_path)
    if jdbc:
        if "coin_prices" in jdbc:
            accepted, refused = jdbc_sink.split_facts(facts)
            jdbc_sink.write_table(accepted, jdbc["coin_prices"], mode="overwrite")
            if rejects_path:
                refused.write.mode("overwrite").parquet(f"{rejects_path}/coin_prices")
        if "market_stats" in jdbc:
            accepted, refused = jdbc_sink.split_stats(stats)
            jdbc_sink.write_table(accepted, jdbc["market_stats"], mode="overwrite")
            if rejects_path:
                refused.write.mode("overwrite").parquet(f"{rejects_path}/market_stats")
    return {"facts": bool(facts_path) or bool(jdbc), "stats": bool(stats_path) or bool(jdbc)}
