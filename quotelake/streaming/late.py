"""Tumbling windows with a side output for late rows.

A stateful query drops rows behind its watermark and only counts them.  Here the watermark is replayed per
micro-batch: it is the largest event time of the batches before, less the delay, as Spark's own.  A row whose window has
closed by then goes to the rejects with its reason; all others are folded into the open windows, whose exact
moments (``functions.exact``) are the state.  Windows that the batch closes are emitted once.

Every batch commits its closed windows, its late rows, the open state and the new watermark in one manifest file
(``sinks.manifest``).  A crash before that leaves nothing behind, a replay finds the batch settled, and a restart
goes on from the last committed state.  aggregated + open + late + rows without a window = input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.exact import finished, mean, merged, moments_by, stddev, top_above_mean
from quotelake.functions.scalars import duration_micros, tumbling_start
from quotelake.sinks import manifest
from quotelake.sinks.lake import write_folder

SINKS = ("closed", "late", "open", "progress")


@dataclass
class TumblingWithLate:
    """``foreachBatch`` callback: window statistics per symbol under ``<base>/closed``, late rows under ``<base>/late``.

    Rows without symbol or event time lie in no window and go to ``late`` with their own reason.
    """

    base: str
    duration: str
    delay: str
    stream: str = "tumbling"
    time: str = "recorded_at"
    price: str = "price_usd"
    volume: str = "volume_24h"
    digits: int | None = 6
    keys: Sequence[str] = ("symbol", "window_start")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if manifest.is_settled(spark, self.base, self.stream, batch_id):
            return
        measures = {self.price: True, self.volume: True}
        before = self._progress(spark)
        mark = F.lit(None if before is None else str(before)).cast("timestamp_ntz")
        length = F.expr(f"INTERVAL {duration_micros(self.duration)} MICROSECOND")
        start = F.col("window_start")
        reason = (F.when(F.col("symbol").isNull(), "null_symbol").when(start.isNull(), "unreadable_time")
                  .when(start + length <= mark, "late"))
        rows = (batch.withColumn("window_start", tumbling_start(self.time, self.duration)).withColumn("reason", reason)).persist()
        try:
            delay = F.expr(f"INTERVAL {duration_micros(self.delay)} MICROSECOND")
            after = rows.agg(F.max(self.time).alias("newest")).select(F.greatest(mark, F.col("newest") - delay).alias("watermark"))
            part = moments_by(rows.filter(F.col("reason").isNull()), list(self.keys), measures, F.count(F.lit(1)).alias("record_count"))
            state = self._open(spark)
            if state is not None:
                part = (state.select(*part.columns).unionByName(part).groupBy(*self.keys)
                        .agg(*merged(measures), F.sum("record_count").alias("record_count")))
            part = part.persist()
            try:
                limit = after.first()["watermark"]
                closing = F.lit(None if limit is None else str(limit)).cast("timestamp_ntz")
                done = F.coalesce(start + length <= closing, F.lit(False))
                late = rows.filter(F.col("reason").isNotNull()).select(
                    "reason", F.to_json(F.struct(*batch.columns)).alias("body"), "symbol", self.time)
                out = {"closed": self._columns(finished(part.filter(done), measures), length), "late": late,
                       "open": part.filter(~done), "progress": after}
                attempt = manifest.new_attempt()
                for name, df in out.items():
                    write_folder(df, manifest.attempt_path(self.base, name, self.stream, batch_id, attempt))
                old = manifest.manifest(spark, self.base).filter(F.col("sink").isin("open", "progress") & (F.col("stream") == self.stream))
                manifest.commit(spark, self.base, self.stream, batch_id, attempt, out,
                                removed=old.select("sink", *manifest.KEYS).distinct())
            finally:
                part.unpersist()
        finally:
            rows.unpersist()

    def _columns(self, groups: DataFrame, length) -> DataFrame:
        return groups.select(
            "symbol", "window_start", (F.col("window_start") + length).alias("window_end"), mean(self.price, self.digits).alias("avg_price"),
            stddev(self.price, self.digits).alias("volatility_score"), mean(self.volume, self.digits).alias("avg_volume"),
            stddev(self.volume, self.digits).alias("volume_stddev"), top_above_mean(self.volume).alias("volume_spike"), "record_count")

    def _committed(self, spark: SparkSession, sink: str) -> DataFrame | None:
        here = manifest.manifest(spark, self.base).filter((F.col("sink") == sink) & (F.col("stream") == self.stream))
        if here.isEmpty():
            return None
        return manifest.read_committed(spark, self.base, sink, only=here).drop(*manifest.KEYS)

    def _progress(self, spark: SparkSession):
        """The watermark that the committed batches leave; None before the first."""
        rows = self._committed(spark, "progress")
        return None if rows is None else rows.agg(F.max("watermark")).first()[0]

    def _open(self, spark: SparkSession) -> DataFrame | None:
        return self._committed(spark, "open")

    def results(self, spark: SparkSession, sink: str = "closed") -> DataFrame:
        """The committed rows of ``closed``, ``late`` or ``open``."""
        rows = self._committed(spark, sink)
        if rows is None:
            raise ValueError(f"nothing committed under {self.base}")
        return rows
