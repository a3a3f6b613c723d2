"""Envelope publishing: quotes -> JSON envelopes -> a topic or a folder of JSON lines.

The envelope builder caps each message at 50 quotes (see ``functions.envelope``),
so a message never carries an unbounded group.  The Kafka writer needs the
spark-sql-kafka package on the classpath; the file writer is its analogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish_files(envelopes: DataFrame, path: str) -> None:
    """Append envelopes as JSON-lines text files (one message per line)."""
    envelopes.select("value").write.mode("append").text(path)


def kafka_frame(envelopes: DataFrame) -> DataFrame:
    """Key (the snapshot stamp) and value of each record."""
    return envelopes.select(F.col("ingested_at").cast("string").alias("key"),
                            F.col("value").cast("string").alias("value"))


def publish_kafka(envelopes: DataFrame, servers: str, topic: str) -> None:
    """Write envelopes to a Kafka topic."""
    (kafka_frame(envelopes).write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save())
