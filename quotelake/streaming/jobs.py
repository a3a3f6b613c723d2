"""Structured Streaming jobs built from the batch operators.

* ``BatchPipeline`` – the micro-batch job: one ``foreachBatch`` callback writes
  raw rows, enriched rows, per-batch stats and rejects (and optionally JDBC
  tables).  Every sink replaces the folder of this stream and batch, so a replayed
  batch (after an executor or driver loss) leaves one copy, and another
  stream or a new checkpoint never touches earlier rows.  JDBC appends are at least once.
* ``tumbling`` – watermark + event-time tumbling window aggregate.
* ``window_join_stream`` – rows joined to their own closed window (salted join).
* ``stream_session`` – child session whose shuffle partitions size the state of new streams.

Event time: the stream's time column is converted to ``TIMESTAMP`` (the type
watermarks need) with the session pinned to UTC, and converted back to
``TIMESTAMP_NTZ`` on output.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from quotelake.functions.envelope import envelope_rejects, parse_envelopes, to_raw_lake
from quotelake.functions.exact import above_mean, baseline, finished, mean, moments_by, stddev
from quotelake.functions.scalars import day_start, parse_iso_ts, tumbling_start
from quotelake.operators.quality import QualityGateError, run_gates
from quotelake.operators.stats import batch_stats, enrich, window_stats
from quotelake.schemas import ENRICHED_LAKE_COLUMNS
from quotelake.session import default_parallelism
from quotelake.sinks import jdbc as jdbc_sink
from quotelake.sinks import manifest
from quotelake.sinks.lake import write_batch, write_folder


# Session setting that overrides the number of state partitions of new stateful queries.
STATE_PARTITIONS_CONF = "quotelake.streaming.statePartitions"


# Session setting that names another state store provider than the default below.
STATE_STORE_CONF = "quotelake.streaming.stateStore"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A child session (same SparkContext, own SQL conf) for starting stateful streams.

    A stateful query fixes its number of state partitions from
    ``spark.sql.shuffle.partitions`` at its first start, and AQE cannot
    change it later.  The batch default (often 200, or sized for
    terabyte shuffles) is the wrong number for state.  So streams start from a
    session where it is ``state_partitions``, else ``quotelake.streaming.statePartitions``,
    else the cluster's default parallelism (one state partition per core).
    The caller's session conf is left untouched.
    """
    n = state_partitions or spark.conf.get(STATE_PARTITIONS_CONF, None) \
        or default_parallelism(spark)
    try:
        child = spark.newSession()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect client: size the session itself
        spark.conf.set("spark.sql.shuffle.partitions", str(int(n)))
        return spark
    child.conf.set("spark.sql.shuffle.partitions", str(int(n)))
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    # window and join state off the executors' heap
    child.conf.set("spark.sql.streaming.stateStore.providerClass", spark.conf.get(STATE_STORE_CONF, ROCKSDB))
    return child


def quotes_from_messages(messages: DataFrame, event_time: bool = True,
                         lenient_numbers: bool = False) -> DataFrame:
    """Envelope stream -> raw-lake rows.

    ``recorded_at`` is the quote's own ``last_updated`` stamp (event time) when
    ``event_time`` is set, else the micro-batch processing time.
    """
    flat = parse_envelopes(messages, lenient_numbers=lenient_numbers)
    # both modes store TIMESTAMP_NTZ (UTC wall clock), so one lake never mixes the two types
    stamp = parse_iso_ts(F.col("last_updated")) if event_time \
        else F.current_timestamp().cast("timestamp_ntz")
    return to_raw_lake(flat, stamp)


REJECT_COLUMNS = ["reason", "body"]


def row_reason() -> Column:
    """Why a parsed row cannot enter the statistics (NULL when it can)."""
    return (F.when(F.col("symbol").isNull(), "null_symbol")
            .when(F.col("recorded_at").isNull(), "unreadable_time"))


def stream_identity(df: DataFrame) -> str:
    """The query's own id, kept in its checkpoint: a restart keeps it, a new checkpoint gets another."""
    sc = df.sparkSession.sparkContext
    return sc.getLocalProperty("sql.streaming.queryId") or "batch"


@dataclass
class BatchPipeline:
    """The ``foreachBatch`` callback of the micro-batch job.

    ``stats_keys`` are grouped on inside each micro-batch (``["symbol"]`` is the
    micro-batch scope; add an event-time bucket to keep batches comparable).
    ``window`` (e.g. ``"5 minutes"``) adds the tumbling window start of
    ``recorded_at`` as the key ``bucket_start``: window scope inside each
    micro-batch (``window_start``/``window_end`` stay the group's time span).

    With ``parse`` the batch holds messages and ``parse`` turns them into rows.  The raw
    sink keeps every parsed row.  A message without quotes, a row without symbol or
    readable time, and (for the JDBC tables) a row that breaks the table
    contract go to ``rejects_path`` with a reason; without a path they are still left out
    of enriched and stats.

    With ``commit_base`` the sinks are ``<base>/raw``, ``enriched``, ``stats`` and ``rejects``, written attempt by
    attempt and made visible together by one manifest file (``sinks.manifest``); the paths may then be empty.  A batch that
    fails between two sinks stays invisible until its replay, and a settled batch is not written again.  With
    ``gate`` the written raw rows are audited before publication: a batch that fails a gate is quarantined as a
    whole and the stream goes on.
    """
    raw_path: str | None = None
    enriched_path: str | None = None
    stats_path: str | None = None
    stats_keys: Sequence[str] = ("symbol",)
    jdbc: Mapping[str, Mapping[str, str]] | None = None  # {"coin_prices": opts, "market_stats": opts}
    on_batch: Callable[[int, DataFrame], None] | None = None
    window: str | None = None
    rejects_path: str | None = None
    parse: Callable[[DataFrame], DataFrame] | None = None
    stream_id: str | None = None
    log: Callable[[str, str, str], None] | None = None
    commit_base: str | None = None
    gate: bool = False

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        stream = self.stream_id or stream_identity(batch_df)
        if self.commit_base and manifest.is_settled(batch_df.sparkSession, self.commit_base, stream, batch_id):
            self._say("success", f"stream {stream} batch {batch_id} was settled before")
            return
        attempt, written = manifest.new_attempt(), {}
        self._say("started", f"stream {stream} batch {batch_id}")

        def sink(name: str, df: DataFrame, path: str, partition_by=("day",), sort_by=("symbol", "recorded_at")) -> None:
            self._sink(name, df, path, stream, batch_id, attempt, partition_by, sort_by)
            written[name] = df
        messages = batch_df.persist() if self.parse else None
        rows = self.parse(messages) if self.parse else batch_df
        rows = rows.withColumn("reject", row_reason()).withColumn("day", F.to_date("recorded_at"))
        keys = list(self.stats_keys)
        if "day" in keys:
            rows = rows.withColumn("day_start", day_start("recorded_at"))
            keys[keys.index("day")] = "day_start"
        if self.window:
            rows = rows.withColumn("bucket_start", tumbling_start("recorded_at", self.window))
            keys.append("bucket_start")
        rows = rows.persist()
        good = rows.where(F.col("reject").isNull()).drop("reject")
        stats = batch_stats(good, [k for k in keys if k != "symbol"]).persist()
        helpers = [c for c in ("day_start", "bucket_start") if c in rows.columns]
        try:
            sink("raw", rows.drop("reject", *helpers), self.raw_path)
            # One stats row per key of this micro-batch: the size is bounded by the
            # batch's own key count; AQE broadcasts it when small, else shuffles.
            enriched = enrich(good, stats, keys, max_rows=None).select(
                *ENRICHED_LAKE_COLUMNS, *[k for k in helpers if k == "bucket_start"], "day")
            sink("enriched", enriched, self.enriched_path)
            out = stats.withColumnRenamed("day_start", "day") if "day_start" in keys else stats
            sink("stats", out, self.stats_path, (), ("symbol", "window_end"))
            rejects = rows.where(F.col("reject").isNotNull()).select(
                F.col("reject").alias("reason"), F.to_json(F.struct(*rows.drop("reject", "day", *helpers).columns)).alias("body"))
            if messages is not None:
                rejects = envelope_rejects(messages).select(*REJECT_COLUMNS).unionByName(rejects)
            if self.jdbc:
                rejects = rejects.unionByName(self._write_tables(good, stats, stream, batch_id))
            if self.rejects_path or self.commit_base:
                sink("rejects", rejects, self.rejects_path, (), None)
            if self.on_batch:
                self.on_batch(batch_id, rows)
            if self.commit_base:
                self._publish(batch_df.sparkSession, stream, batch_id, attempt, written)
            else:
                self._say("success", f"stream {stream} batch {batch_id}")
        except Exception:
            self._say("failed", f"stream {stream} batch {batch_id}")
            raise
        finally:
            stats.unpersist()
            rows.unpersist()
            if messages is not None:
                messages.unpersist()

    def _say(self, status: str, message: str) -> None:
        if self.log:
            self.log("stream_batch", status, message)

    def _sink(self, name: str, df: DataFrame, path: str | None, stream: str, batch_id: int, attempt: str,
              partition_by: Sequence[str], sort_by: Sequence[str] | None) -> None:
        if self.commit_base:
            write_folder(df, manifest.attempt_path(self.commit_base, name, stream, batch_id, attempt), partition_by, sort_by)
        else:
            write_batch(df, path, stream, batch_id, partition_by, sort_by)

    def _publish(self, spark: SparkSession, stream: str, batch_id: int, attempt: str, written: Mapping[str, DataFrame]) -> None:
        """Audit what was written, then make it visible or hold it back, by one manifest file."""
        action, what = manifest.ADD, f"stream {stream} batch {batch_id}"
        if self.gate:
            raw = spark.read.schema(written["raw"].schema).parquet(manifest.attempt_path(self.commit_base, "raw", stream, batch_id, attempt))
            try:
                run_gates(raw, lambda stage, status, message: self.log and self.log(stage, status, f"{message} ({what})"))
            except QualityGateError:
                action = manifest.QUARANTINE
        manifest.commit(spark, self.commit_base, stream, batch_id, attempt, written, action)
        if action == manifest.ADD:
            self._say("success", what)
        else:
            self._say("failed", f"{what} is quarantined")

    def _write_tables(self, rows: DataFrame, stats: DataFrame, stream: str, batch_id: int) -> DataFrame:
        """Append to the JDBC tables; returns the rows that break a table's contract.

        With ``commit_base`` each batch fills staging tables of its own, which a replay replaces; the database merges
        those of committed batches.
        """
        rejects = rows.sparkSession.createDataFrame([], "reason string, body string")
        for table, frame, split in (("coin_prices", rows, jdbc_sink.split_facts), ("market_stats", stats, jdbc_sink.split_stats)):
            if table not in self.jdbc:
                continue
            accepted, refused = split(frame)
            if self.commit_base:
                jdbc_sink.write_table(accepted, jdbc_sink.staged(self.jdbc[table], stream, batch_id), mode="overwrite")
            else:
                jdbc_sink.write_table(accepted, self.jdbc[table])
            rejects = rejects.unionByName(refused.select(
                F.col("reject_reason").alias("reason"), F.to_json(F.struct(*frame.columns)).alias("body")))
        return rejects


def run_available_now(df: DataFrame, checkpoint: str, *, sink: str | None = None,
                      path: str | None = None, output_mode: str = "append",
                      foreach_batch: Callable[[DataFrame, int], None] | None = None,
                      query_name: str | None = None, partition_by: Sequence[str] = (),
                      options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Drain everything available, in as many micro-batches as the rate limit gives, then stop."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink or "parquet")
        if path:
            w = w.option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def with_event_time(df: DataFrame, column: str = "recorded_at", name: str = "event_ts"
                    ) -> DataFrame:
    """Add a ``TIMESTAMP`` copy of an NTZ event-time column (watermarks need it)."""
    return df.withColumn(name, F.col(column).cast("timestamp"))


def tumbling(df: DataFrame, duration: str, watermark: str, time: str = "event_ts",
             price: str = "price_usd", volume: str = "volume_24h",
             digits: int | None = 6) -> DataFrame:
    """Watermarked tumbling-window stats per symbol (append or complete mode)."""
    return window_stats(df.withWatermark(time, watermark), duration, time, price, volume, (digits,) * 4)


def window_join_stream(df: DataFrame, duration: str, watermark: str, time: str = "event_ts",
                       keep: Sequence[str] = ("row_id", "price_usd", "volume_24h"),
                       price: str = "price_usd", volume: str = "volume_24h",
                       digits: int | None = 6, salt_buckets: int | None = None,
                       salt_key: str = "row_id") -> DataFrame:
    """Each row joined to the stats of its own (symbol, window), emitted when the window closes.

    Both sides carry event time only in the window column ``w`` (the raw time
    travels as epoch micros), which makes the join an equi-join on
    ``(symbol, w)`` whose state Spark can evict by watermark.

    Rows wait in join state until their window closes, and AQE does not run
    on streams, so a hot (symbol, window) would sit in one partition.  The
    join is therefore salted: a row's salt is ``pmod(hash(salt_key), n)``
    (deterministic, so a retried task routes rows the same way) and each
    window-stats row is replicated to the ``n`` salts, spreading one key's
    rows over ``n`` partitions for the price of ``n`` copies of one small row.
    ``n`` is the session's number of state partitions unless given; a running
    query keeps the number it started with, as it keeps its state partitions.
    """
    n = max(1, int(salt_buckets or df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    marked = df.withWatermark(time, watermark)
    rows = marked.select("symbol", *keep, F.unix_micros(time).alias("t_us"),
                         F.window(time, duration).alias("w"),
                         F.pmod(F.hash(salt_key), F.lit(n)).alias("_salt"))
    measures = {price: True, volume: False}
    groups = finished(moments_by(marked, ["symbol", F.window(time, duration).alias("w")], measures), measures)
    agg = (baseline(groups.withColumns({"avg_volume_window": mean(volume, digits), "volatility_score": stddev(price, digits)}),
                    ["symbol", "w"], volume, "avg_volume_window", "volatility_score")
           .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))))
    joined = rows.join(agg, ["symbol", "w", "_salt"], "left")
    return joined.select(
        "symbol", *keep,
        F.timestamp_micros("t_us").cast("timestamp_ntz").alias("recorded_at"),
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "avg_volume_window",
        "volatility_score",
        above_mean(f"`{volume}`", volume).alias("volume_spike"),
    )


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks drop, over every progress report of a query.

    A query itself keeps only its last reports; add this listener
    (``spark.streams.addListener``) before the query starts to miss none.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        key = str(event.progress.id)
        late = sum(int(op.numRowsDroppedByWatermark or 0) for op in event.progress.stateOperators)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows dropped by the watermark over the reports the query still holds (see ``LateRows`` for all)."""
    return sum(int(getattr(op, "numRowsDroppedByWatermark", 0) or 0)
               for p in query.recentProgress for op in p.stateOperators or [])


def start_pipeline(messages: DataFrame, lake_base: str, checkpoint: str,
                   jdbc: Mapping[str, Mapping[str, str]] | None = None,
                   stats_keys: Sequence[str] = ("symbol",), event_time: bool = False,
                   available_now: bool = True, processing_time: str | None = None,
                   window: str | None = None, lenient_numbers: bool = False,
                   log: Callable[[str, str, str], None] | None = None,
                   commit: bool = False, gate: bool = False) -> StreamingQuery:
    """The micro-batch job end to end: envelope stream -> raw, enriched, stats, rejects (+ JDBC).

    With ``commit`` the sinks of a batch become visible together, through the manifest under ``lake_base``; ``gate``
    audits each batch before that and holds back the ones that fail.

    ``messages`` is a Kafka or file stream with a ``value`` column.  With
    ``available_now`` the backlog is drained (rate-limited by the source's
    max-per-trigger option) and the query stops; otherwise it runs on a
    processing-time trigger.
    """
    def parse(batch: DataFrame) -> DataFrame:
        return quotes_from_messages(batch, event_time=event_time, lenient_numbers=lenient_numbers)

    pipeline = BatchPipeline(f"{lake_base}/raw", f"{lake_base}/enriched", f"{lake_base}/stats",
                             tuple(stats_keys), jdbc, window=window, rejects_path=f"{lake_base}/rejects",
                             parse=parse, log=log, commit_base=lake_base if commit or gate else None, gate=gate)
    w = messages.select("value").writeStream.foreachBatch(pipeline).option("checkpointLocation", checkpoint)
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return w.trigger(processingTime=processing_time or "1 minute").start()
