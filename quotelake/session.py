"""Session settings and the shared working folder.

Everything the library writes as an intermediate (staged stream input, sink
output read back by a query, stream checkpoints) goes under the folder the
cluster names in ``spark.checkpoint.dir``.  We only invent one when the
setting is missing *and* the session runs in local mode (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every quotelake job expects.  AQE re-plans joins and aggregates from
# measured shuffle sizes: it coalesces small partitions, turns a sort-merge join
# into a broadcast join only when the measured side is below the threshold, and
# splits skewed join partitions (a hot symbol may hold a third of all rows).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpointed lookup tables (joins.checked_broadcast) are deleted once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "quotelake",
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone; day buckets and ISO stamps are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", None)
    if master is None and _context(spark) is not None:
        master = _context(spark).master
    return bool(master) and master.startswith("local")


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    conf = spark.conf.get("spark.default.parallelism", None)
    return int(conf) if conf else (os.cpu_count() or 1)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written intermediates.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  When
    neither is set we create one under the system temp folder, but only for a
    local-mode session: on a cluster a machine-local folder would be lost with
    its executor, so we refuse instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS)")
    base = tempfile.mkdtemp(prefix="quotelake-")
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", base)
        return base
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir().rstrip("/")


_RUN_DIRS: list[str] = []


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run of one job (see ``release_run_dirs``)."""
    path = f"{shared_dir(spark)}/quotelake/{name}-{uuid.uuid4().hex[:12]}"
    _RUN_DIRS.append(path)
    return path


def release_run_dirs(spark: SparkSession) -> int:
    """Delete the run folders this process has made; call it when their results are no longer read.

    A query returns a lazy frame over its folder, so only the caller knows when that is.
    Uses the file system of each path, so object stores work too.  Returns how many were deleted.
    """
    sc, done = _context(spark), 0
    if sc is None:
        return 0
    while _RUN_DIRS:
        path = sc._jvm.org.apache.hadoop.fs.Path(_RUN_DIRS.pop())
        done += bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))
    return done
