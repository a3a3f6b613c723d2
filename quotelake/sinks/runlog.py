"""Append-only run log: ``(run_id, stage, status, message, created_at)``.

Writing a log row never fails the job that logs: a storage error becomes a warning of the Python logger.  A
status outside the allowed domain is the caller's mistake and raises.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.schemas import LOG_STATUSES

LOGGER = logging.getLogger(__name__)


def log_frame(spark: SparkSession, entries: list[tuple[str, str, str | None]]) -> DataFrame:
    """Small driver-built frame of log entries with generated id and time."""
    check_statuses([e[1] for e in entries])
    df = spark.createDataFrame(entries, "stage string, status string, message string")
    return with_log_columns(df)


def check_statuses(statuses: list[str]) -> None:
    bad = sorted({str(s) for s in statuses if s not in LOG_STATUSES})
    if bad:
        raise ValueError(f"unknown run-log status {', '.join(bad)}; use {', '.join(LOG_STATUSES)}")


def with_log_columns(df: DataFrame) -> DataFrame:
    """Adds generated id and time; a row with an unknown status makes the write fail."""
    known = F.col("status").isin(LOG_STATUSES)
    status = F.when(known, F.col("status")).otherwise(
        F.raise_error(F.concat(F.lit("unknown run-log status "), F.coalesce("status", F.lit("NULL")))))
    return df.select("stage", status.alias("status"), "message").select(
        F.expr("uuid()").alias("run_id"), "stage", "status", "message",
        F.current_timestamp().alias("created_at"))


def lake_logger(spark: SparkSession, path: str) -> Callable[[str, str, str], None]:
    """A ``log(stage, status, message)`` callable that appends to a parquet folder."""
    def log(stage: str, status: str, message: str) -> None:
        check_statuses([status])
        try:
            log_frame(spark, [(stage, status, message)]).write.mode("append").parquet(path)
        except Exception as e:  # noqa: BLE001 - never fail the caller
            LOGGER.warning("run log %s not written: %s", path, e)
    return log


def table_logger(spark: SparkSession, options: dict[str, str]) -> Callable[[str, str, str], None]:
    """The same callable for a JDBC log table (``options`` as from ``jdbc.jdbc_options``)."""
    def log(stage: str, status: str, message: str) -> None:
        check_statuses([status])
        try:
            log_frame(spark, [(stage, status, message)]).write.format("jdbc").options(**options).mode("append").save()
        except Exception as e:  # noqa: BLE001 - never fail the caller
            LOGGER.warning("run log table %s not written: %s", options.get("dbtable"), e)
    return log
