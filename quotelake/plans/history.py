"""Whole-history statistics that read only what is new.

The exact moments per symbol (``functions.exact``) are additive, so the statistics of the whole lake are those of a small
state table, one row per symbol, plus the batches committed since.  An update reads only those batches, folds
their moments into the state and commits the new state together with the list of batches it covers, in one
manifest file; a crash in between changes nothing.  A compaction of the lake moves rows without adding any: its
folder is covered when the folders it replaced are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.exact import finished, merged, moments_by
from quotelake.operators.stats import DEFAULT_DIGITS, stats_columns
from quotelake.sinks import manifest as commits
from quotelake.sinks.lake import write_folder

MEASURES = {"price_usd": True, "volume_24h": False}
STREAM = "history"


def _spans(first: str, last: str, n) -> list:
    return [F.min(first).alias("window_start"), F.max(last).alias("window_end"), n.alias("record_count")]


def _state(spark: SparkSession, base: str, sink: str) -> DataFrame | None:
    if commits.manifest(spark, base).filter(F.col("sink") == sink).isEmpty():
        return None
    rows = commits.read_committed(spark, base, sink).drop(*commits.KEYS)
    return rows.toDF(*[c.removeprefix("lake_") for c in rows.columns])


def _open_batches(spark: SparkSession, lake: str, covered: DataFrame | None, sink: str) -> tuple[DataFrame, DataFrame, bool]:
    """(batches to read, batches that hold nothing new, must the state be rebuilt?)."""
    now = commits.manifest(spark, lake).filter(F.col("sink") == sink).select(*commits.KEYS).distinct()
    if covered is None:
        return now, now.limit(0), False
    fresh = now.join(covered.select(*commits.KEYS), commits.KEYS, "left_anti")
    known = covered.select(*[F.col(k).alias("_" + k) for k in commits.KEYS], F.lit(True).alias("known"))
    same = [F.col(k) == F.col("_" + k) for k in commits.KEYS]
    # of each folder that replaced others: were these counted?
    moved = (commits.removals(spark, lake, sink).join(known, same, "left").groupBy("replaced_by")
             .agg(F.bool_and(F.col("known").isNotNull()).alias("every"), F.bool_or(F.col("known").isNotNull()).alias("some")))
    judged = fresh.join(moved, fresh["attempt"] == moved["replaced_by"], "left").persist()
    rebuild = not judged.filter(F.col("some") & ~F.col("every")).isEmpty()
    nothing = judged.filter(F.coalesce("every", F.lit(False))).select(*commits.KEYS)
    return judged.filter(~F.coalesce("every", F.lit(False))).select(*commits.KEYS), nothing, rebuild


def update_history(spark: SparkSession, lake: str, state: str, sink: str = "raw") -> int:
    """Fold the batches committed to ``lake`` since the last update into ``state``; returns how many were read.

    If a compaction joined covered folders with uncovered ones, their rows cannot be told apart and the state is rebuilt.
    """
    covered, old = _state(spark, state, "covered"), _state(spark, state, "moments")
    fresh, nothing, rebuild = _open_batches(spark, lake, covered, sink)
    if rebuild:
        covered = old = None
        fresh, nothing, _ = _open_batches(spark, lake, None, sink)
    fresh = fresh.persist()
    try:
        n = fresh.count()
        if n == 0 and nothing.isEmpty():
            return 0
        rows = commits.read_committed(spark, lake, sink, only=fresh)
        part = moments_by(rows, ["symbol"], MEASURES, *_spans("recorded_at", "recorded_at", F.count(F.lit(1))))
        whole = part if old is None else old.select(*part.columns).unionByName(part).groupBy("symbol").agg(
            *merged(MEASURES), *_spans("window_start", "window_end", F.sum("record_count")))
        listed = fresh.unionByName(nothing)
        listed = listed if covered is None else covered.select(*commits.KEYS).unionByName(listed)
        # the covered keys are data here, not partition columns of the state
        listed = listed.select(*[F.col(k).alias("lake_" + k) for k in commits.KEYS])
        before = commits.manifest(spark, state).select("sink", *commits.KEYS).distinct().persist()
        batch_id = before.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0] + 1
        attempt, sinks = commits.new_attempt(), {}
        for name, df in (("moments", whole.sortWithinPartitions("symbol")), ("covered", listed)):
            path = commits.attempt_path(state, name, STREAM, batch_id, attempt)
            write_folder(df, path)
            sinks[name] = spark.read.schema(df.schema).parquet(path)
        commits.commit(spark, state, STREAM, batch_id, attempt, sinks, removed=before)
        before.unpersist()
        return n
    finally:
        fresh.unpersist()


def incremental_history(spark: SparkSession, state: str, digits: int | None = DEFAULT_DIGITS, factor: float = 1.0) -> DataFrame:
    """The statistics of everything the state covers: the rows of ``history_stats``."""
    moments = _state(spark, state, "moments")
    if moments is None:
        raise ValueError(f"no history under {state}; run update_history first")
    return stats_columns(finished(moments, MEASURES), ["symbol"], "price_usd", "volume_24h", digits, factor)
