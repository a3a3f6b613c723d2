"""Commits over several sinks: a batch is visible in all of them or in none.

Every attempt at a micro-batch writes its sinks into folders of its own,
``<base>/<sink>/stream=<id>/batch_id=<n>/attempt=<a>/...``.  When all are complete, one manifest file
``<base>/commits/stream=<id>/batch_id=<n>/attempt=<a>`` is written that names them, a line per sink and day.
Readers go through the manifest, so half-written attempts, replays and quarantined batches never show; a batch that is
already in the manifest is not written again.  Compaction is a commit too: it adds the new folders and
removes the old ones in one file.

The manifest is a small table that Spark reads and joins; folders are pruned by that join (they
are partition columns), so no list of paths passes through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.joins import checked_broadcast
from quotelake.sinks.lake import clustered, rebalanced

KEYS = ["stream", "batch_id", "attempt"]
SCHEMA = "action string, sink string, stream string, batch_id bigint, attempt string, day date, rows bigint, replaced_by string"
ADD, REMOVE, QUARANTINE = "add", "remove", "quarantine"


def new_attempt() -> str:
    return "a" + uuid.uuid4().hex


def attempt_path(base: str, sink: str, stream: str, batch_id: int, attempt: str) -> str:
    return f"{base}/{sink}/stream={stream}/batch_id={batch_id}/attempt={attempt}"


def _entries(spark: SparkSession, base: str, below: str = "") -> DataFrame:
    """All manifest lines (``below`` a sub-folder); none when nothing was committed yet."""
    path = f"{base}/commits{below}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], SCHEMA)
    # stream, batch_id and attempt stand in the lines; a removal names others than the folder it lies in
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(path)


def manifest(spark: SparkSession, base: str, action: str = ADD) -> DataFrame:
    """The lines that hold now: added (or quarantined) and not removed since."""
    lines = _entries(spark, base)
    gone = lines.filter(F.col("action") == REMOVE).select("sink", *KEYS).distinct()
    return lines.filter(F.col("action") == action).join(gone, ["sink", *KEYS], "left_anti")


def removals(spark: SparkSession, base: str, sink: str) -> DataFrame:
    """(stream, batch_id, attempt, replaced_by) of the attempts of a sink that a later commit replaced."""
    return _entries(spark, base).filter((F.col("action") == REMOVE) & (F.col("sink") == sink)).select(*KEYS, "replaced_by").distinct()


def is_settled(spark: SparkSession, base: str, stream: str, batch_id: int) -> bool:
    """Has some attempt at this batch been committed or quarantined?"""
    return not _entries(spark, base, f"/stream={stream}/batch_id={batch_id}").isEmpty()


def commit(spark: SparkSession, base: str, stream: str, batch_id: int, attempt: str, sinks: Mapping[str, DataFrame],
           action: str = ADD, removed: DataFrame | None = None) -> None:
    """Write the manifest file of one attempt; this is the moment its sinks become visible.

    ``sinks`` maps each sink to the rows written (cached by the caller); a sink without a ``day`` column, or
    without rows, has one line with a null day.  The lines are one JSON part file, which appears as a whole.
    """
    lines = None
    for sink, rows in sinks.items():
        day = F.col("day") if "day" in rows.columns else F.lit(None).cast("date")
        per_day = rows.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))
        none = spark.range(1).select(F.lit(None).cast("date").alias("day"), F.lit(0).cast("bigint").alias("rows"))
        part = per_day.unionByName(none).select(
            F.lit(action).alias("action"), F.lit(sink).alias("sink"), F.lit(stream).alias("stream"),
            F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(attempt).alias("attempt"), "day", "rows",
            F.lit(None).cast("string").alias("replaced_by"))
        lines = part if lines is None else lines.unionByName(part)
    if removed is not None:
        lines = lines.unionByName(removed.select(F.lit(REMOVE).alias("action"), "sink", *KEYS, F.lit(None).cast("date").alias("day"),
                                                 F.lit(0).cast("bigint").alias("rows"), F.lit(attempt).alias("replaced_by")))
    lines.coalesce(1).write.mode("error").json(attempt_path(base, "commits", stream, batch_id, attempt))


def read_committed(spark: SparkSession, base: str, sink: str, schema=None, only: DataFrame | None = None) -> DataFrame:
    """The rows of ``sink`` from committed attempts, with the partition columns stream, batch_id and attempt.

    ``only`` (stream, batch_id, attempt) narrows it to some of them.  The join with the manifest prunes the folders
    to read; the manifest side is broadcast behind a size check.
    """
    keys = manifest(spark, base).filter(F.col("sink") == sink).select(*KEYS).distinct()
    if only is not None:
        keys = keys.join(only.select(*KEYS).distinct(), KEYS, "left_semi")
    path, kinds = f"{base}/{sink}", {"stream": "string", "batch_id": "bigint", "attempt": "string"}
    found = schema or spark.read.parquet(path).schema
    plain = [f"`{f.name}` {kinds.get(f.name, f.dataType.simpleString())}" for f in found]
    plain += [f"{k} {kinds[k]}" for k in KEYS if k not in found.names]
    rows = spark.read.schema(", ".join(plain)).parquet(path)
    # the condition on the attempt lets the planner prune folders by this side at run time
    return rows.join(checked_broadcast(keys).filter(F.col("attempt") > ""), KEYS, "left_semi")


def release(spark: SparkSession, base: str, stream: str, batch_id: int) -> bool:
    """Publish a quarantined batch after review; False if there is none.  Its lines become an ordinary commit."""
    held = manifest(spark, base, QUARANTINE).filter((F.col("stream") == stream) & (F.col("batch_id") == batch_id))
    published = manifest(spark, base).filter((F.col("stream") == stream) & (F.col("batch_id") == batch_id))
    if held.isEmpty() or not published.isEmpty():
        return False
    out = held.withColumn("action", F.lit(ADD)).select("action", "sink", *KEYS, "day", "rows")
    out.coalesce(1).write.mode("error").json(attempt_path(base, "commits", stream, batch_id, f"release-{new_attempt()}"))
    return True


def compact_committed(spark: SparkSession, base: str, sink: str = "raw",
                      sort_by: Sequence[str] = ("symbol", "recorded_at")) -> int:
    """Rewrite all committed attempts of a sink as one folder per day; returns how many attempts it replaced.

    Readers see either the old folders or the new ones: the manifest file that adds the new ones removes the old.
    Removed folders stay on disk for readers that are still at work; ``vacuum`` them later.
    """
    old = manifest(spark, base).filter(F.col("sink") == sink).select("sink", *KEYS).distinct().persist()
    try:
        n = old.count()
        if n < 2:
            return 0
        stream, attempt = "compact", new_attempt()
        batch_id = _entries(spark, base).filter(F.col("stream") == stream).agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0] + 1
        rows = read_committed(spark, base, sink).drop(*KEYS)
        path = attempt_path(base, sink, stream, batch_id, attempt)
        clustered(rebalanced(rows, ["day"]), sort_by).write.partitionBy("day").parquet(path)
        commit(spark, base, stream, batch_id, attempt, {sink: spark.read.parquet(path)}, removed=old)
        return n
    finally:
        old.unpersist()


def vacuum(spark: SparkSession, base: str, sink: str) -> int:
    """Delete folders of a sink that the manifest has removed; returns how many.  Call it when no reader is on them."""
    gone = removals(spark, base, sink).select(*KEYS).distinct()
    sc, done = spark.sparkContext, 0
    for r in gone.toLocalIterator():                 # one folder at a time
        path = sc._jvm.org.apache.hadoop.fs.Path(attempt_path(base, sink, r["stream"], r["batch_id"], r["attempt"]))
        done += bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))
    return done
