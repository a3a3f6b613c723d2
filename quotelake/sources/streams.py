"""Stream and lake readers.

The envelope stream comes from a message bus (Kafka) in production; the same
downstream code runs on a file stream of JSON lines, which is what the tests
and the registered queries use (no broker in this environment).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Object-store settings the lake jobs set (values are parameters).
S3A_KEYS = {
    "endpoint": "spark.hadoop.fs.s3a.endpoint",
    "access_key": "spark.hadoop.fs.s3a.access.key",
    "secret_key": "spark.hadoop.fs.s3a.secret.key",
    "path_style": "spark.hadoop.fs.s3a.path.style.access",
    "timeout_ms": "spark.hadoop.fs.s3a.connection.timeout",
}


def object_store_conf(endpoint: str, access_key: str, secret_key: str,
                      path_style: bool = True, timeout_ms: int = 60000) -> dict[str, str]:
    """Session settings for an S3-compatible lake (pass to ``build_session``)."""
    return {
        S3A_KEYS["endpoint"]: endpoint,
        S3A_KEYS["access_key"]: access_key,
        S3A_KEYS["secret_key"]: secret_key,
        S3A_KEYS["path_style"]: str(path_style).lower(),
        S3A_KEYS["timeout_ms"]: str(timeout_ms),
    }


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                 fail_on_data_loss: bool = False, options: Mapping[str, str] | None = None) -> DataFrame:
    """Envelope messages from a Kafka topic (needs the spark-sql-kafka package).

    No cap per trigger unless one is given.  Lost offsets are tolerated by default, an
    explicit choice; ``options`` are passed on (security, group id, ...).
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.options(**(options or {})).load()


def kafka_metadata(messages: DataFrame) -> DataFrame:
    """Transport columns of a Kafka record, value/key as text."""
    return messages.selectExpr(
        "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
        "topic", "partition", "offset", "timestamp AS kafka_timestamp")


def envelope_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                         schema: StructType | str | None = None,
                         ignore_missing_files: bool = False) -> DataFrame:
    """JSON-lines envelope files as a stream with a ``value`` text column.

    ``ignore_missing_files`` is the file analogue of ``failOnDataLoss=false``, off by default;
    ``maxFilesPerTrigger`` the analogue of ``maxOffsetsPerTrigger``.
    """
    r = spark.readStream.format("text").option("ignoreMissingFiles", str(ignore_missing_files).lower())
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def file_metadata(messages: DataFrame) -> DataFrame:
    """File analogue of the transport columns: source file and its modification time."""
    return messages.select(
        "value",
        F.col("_metadata.file_path").alias("topic"),
        F.col("_metadata.file_modification_time").alias("kafka_timestamp"))


def parquet_stream(spark: SparkSession, path: str, schema: StructType | str,
                   max_files_per_trigger: int | None = None,
                   ignore_missing_files: bool = False, base_path: str | None = None) -> DataFrame:
    """``base_path`` is the root of the partition folders when ``path`` is a pattern below it."""
    r = (spark.readStream.format("parquet").schema(schema)
         .option("ignoreMissingFiles", str(ignore_missing_files).lower()))
    if base_path:
        r = r.option("basePath", base_path)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
