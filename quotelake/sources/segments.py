"""Offsets and a cap in messages for files of messages.

A file stream caps files per trigger, however many messages they hold, and has no offsets.  ``land`` turns newly
arrived JSON-lines files into segments of at most ``per_segment`` messages with the transport columns of a bus:
(partition, offset, value, topic, arrived).  Messages are spread over partitions by file; offsets count on without gaps from
landing to landing.  ``segment_stream`` then reads one segment per trigger: the cap is in messages whatever the size
of the files, and the stream's checkpoint resumes after the last segment read.  A trigger has a cost of its own, so the
segments can be dealt over ``lanes``: one stream a lane, side by side, each with its own checkpoint and the same cap.

A landing is planned, written aside and renamed into place, in this order, so a failed one is done again with the
same files and offsets, and the stream never sees half of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.sources.streams import parquet_stream

COLUMNS = "value string, topic string, arrived timestamp, partition int, offset bigint"
PLAN = "landing bigint, file string, partition int, first bigint, messages bigint"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _plans(spark: SparkSession, base: str) -> DataFrame:
    path = f"{base}/plans"
    if not _exists(spark, path):
        return spark.createDataFrame([], PLAN)
    return spark.read.schema(PLAN).option("recursiveFileLookup", "true").parquet(path)


def _messages(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, its modification time and their order in it."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def _plan(spark: SparkSession, incoming: str, base: str, landing: int, partitions: int) -> bool:
    """Write which new files this landing takes and where their offsets begin; False without new files."""
    known = _plans(spark, base)
    counts = _messages(spark, incoming).groupBy("file").agg(F.count(F.lit(1)).alias("messages"), F.max("arrived").alias("arrived"))
    fresh = counts.join(known.select("file"), "file", "left_anti").withColumn("partition", F.pmod(F.xxhash64("file"), F.lit(partitions)).cast("int"))
    used = known.groupBy("partition").agg(F.max(F.col("first") + F.col("messages")).alias("used"))
    before = Window.partitionBy("partition").orderBy("arrived", "file").rowsBetween(Window.unboundedPreceding, -1)   # one row a file
    plan = (fresh.join(used, "partition", "left")
            .withColumn("first", F.coalesce("used", F.lit(0)) + F.coalesce(F.sum("messages").over(before), F.lit(0)))
            .select(F.lit(landing).cast("bigint").alias("landing"), "file", "partition", F.col("first").cast("bigint").alias("first"), "messages"))
    plan = plan.checkpoint()
    if plan.isEmpty():
        return False
    plan.coalesce(1).write.mode("error").parquet(f"{base}/plans/landing={landing}")
    return True


def land(spark: SparkSession, incoming: str, base: str, per_segment: int = 100, partitions: int = 1, lanes: int = 1) -> int:
    """Segment the files that arrived in ``incoming`` since the last call; returns the number of messages.

    One caller at a time.  Empty lines are messages too.  A segment holds messages of one partition.
    The segments of a partition go to the lanes in turn.
    """
    plans = _plans(spark, base)
    landing = plans.agg(F.coalesce(F.max("landing"), F.lit(-1))).first()[0]
    if landing < 0 or _exists(spark, f"{base}/segments/landing={landing}"):
        landing += 1
        if not _plan(spark, incoming, base, landing, partitions):
            return 0
    plan = _plans(spark, base).filter(F.col("landing") == landing).drop("landing")
    lines = _messages(spark, incoming).join(F.broadcast(plan) if plan.count() <= 10_000 else plan, "file")
    # a file is numbered block by block: rows inside a block of bounded size, blocks by their counts
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("row"))
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("k"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("k").over(ahead), F.lit(0)).alias("ahead"))
    rows = (lines.withColumn("inside", inside).join(blocks, ["file", "block"])
            .withColumn("offset", F.col("first") + F.col("ahead") + F.col("inside") - 1))
    start = plan.groupBy("partition").agg(F.min("first").alias("start"))
    rows = (rows.join(start, "partition")
            .withColumn("segment", F.floor((F.col("offset") - F.col("start")) / per_segment))
            .select("value", F.col("file").alias("topic"), "arrived", F.col("partition").cast("int").alias("partition"), "offset",
                    (F.col("segment") % lanes).cast("int").alias("lane"),
                    F.format_string("p%04d-s%08d", "partition", "segment").alias("segment")))
    aside = f"{base}/aside/landing={landing}"
    (rows.repartition("segment").sortWithinPartitions("lane", "segment", "offset").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("lane", "segment").parquet(aside))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (aside, f"{base}/segments/landing={landing}"))
    files = source.getFileSystem(conf)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"could not move {aside} into place")
    return plan.agg(F.sum("messages")).first()[0]


def segment_stream(spark: SparkSession, base: str, segments_per_trigger: int = 1, lane: int | None = None) -> DataFrame:
    """The landed messages, of one lane or of all, as a stream with value, topic, arrived, partition and offset."""
    root = f"{base}/segments"
    path = root if lane is None else f"{root}/landing=*/lane={lane}"
    return (parquet_stream(spark, path, COLUMNS, segments_per_trigger, base_path=None if lane is None else root)
            .select("value", "topic", "arrived", "partition", "offset"))
