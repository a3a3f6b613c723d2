"""Data-quality gates over the fact table, and the run log they produce.

Both gates (row count, null-critical rows) are computed by ONE aggregate over
one scan.  The ordered semantics are kept: the null gate reports ``skipped``
when the row-count gate fails.  ``run_gates`` is the imperative form that
raises, logging started/failed/success rows as it goes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.contracts import any_null
from quotelake.schemas import CRITICAL_FACT_COLUMNS

# Gate stage names and run-log message texts.
ROW_COUNT_STAGE = "data_quality_row_counts"
NULLS_STAGE = "data_quality_nulls"
MSG_ROWS_STARTED = "Checking coin_prices row count"
MSG_ROWS_FAILED = "coin_prices is empty"
MSG_ROWS_PASSED = "coin_prices row count passed"
MSG_NULLS_STARTED = "Checking coin_prices null-critical columns"
MSG_NULLS_FAILED = "Found %d null-critical rows in coin_prices"
MSG_NULLS_PASSED = "Null checks passed"


class QualityGateError(ValueError):
    pass


def quality_counts(facts: DataFrame, critical: Sequence[str] = CRITICAL_FACT_COLUMNS
                   ) -> DataFrame:
    """One row: total rows and rows with a NULL in a critical column."""
    return facts.agg(F.count(F.lit(1)).alias("row_count"),
                     F.count_if(any_null(critical)).alias("null_critical_rows"))


def dq_report(facts: DataFrame, min_rows: int = 1,
              critical: Sequence[str] = CRITICAL_FACT_COLUMNS) -> DataFrame:
    """Both gates in order, as one row of counts and statuses."""
    c = quality_counts(facts, critical)
    rows_ok = F.col("row_count") >= min_rows
    return c.select(
        "row_count", "null_critical_rows",
        F.when(rows_ok, "success").otherwise("failed").alias("row_count_status"),
        F.when(~rows_ok, "skipped")
         .when(F.col("null_critical_rows") > 0, "failed")
         .otherwise("success").alias("nulls_status"),
    )


def run_log_rows(report: DataFrame) -> DataFrame:
    """Gate report -> run-log rows ``(seq, stage, status, message)``, in log order."""
    started_rows = F.lit(MSG_ROWS_STARTED)
    started_nulls = F.lit(MSG_NULLS_STARTED)
    rows_msg = F.when(F.col("row_count_status") == "success", F.lit(MSG_ROWS_PASSED)) \
                .otherwise(F.lit(MSG_ROWS_FAILED))
    nulls_msg = F.when(F.col("nulls_status") == "success", F.lit(MSG_NULLS_PASSED)) \
                 .otherwise(F.format_string(MSG_NULLS_FAILED, F.col("null_critical_rows")))

    def entry(seq: int, stage: str, status, message) -> F.Column:
        status = F.lit(status) if isinstance(status, str) else status
        return F.struct(F.lit(seq).alias("seq"), F.lit(stage).alias("stage"),
                        status.alias("status"), message.alias("message"))

    entries = F.array(
        entry(1, ROW_COUNT_STAGE, "started", started_rows),
        entry(2, ROW_COUNT_STAGE, F.col("row_count_status"), rows_msg),
        entry(3, NULLS_STAGE, "started", started_nulls),
        entry(4, NULLS_STAGE, F.col("nulls_status"), nulls_msg),
    )
    # The null gate does not run after a failed row-count gate.
    kept = F.filter(entries, lambda e: (e["stage"] != NULLS_STAGE)
                    | (F.col("row_count_status") == "success"))
    return report.select(F.inline(kept))


def observed(df: DataFrame, name: str = "quality",
             critical: Sequence[str] = CRITICAL_FACT_COLUMNS) -> DataFrame:
    """Attach the gate counts to ``df`` as named observed metrics.

    Nothing extra is scanned: the counts are accumulated while ``df`` is
    computed for its real purpose.  In a stream they appear per micro-batch in
    ``query.lastProgress.observedMetrics[name]``; in batch, pass an
    ``Observation`` as ``name`` and read ``observation.get`` after an action.
    """
    return df.observe(name, F.count(F.lit(1)).alias("row_count"),
                      F.count_if(any_null(critical)).alias("null_critical_rows"))


def gate_metrics(metrics: dict, min_rows: int = 1) -> dict:
    """Statuses for observed counts, with the same ordering rule as ``dq_report``."""
    rows_ok = metrics["row_count"] >= min_rows
    nulls = "skipped" if not rows_ok else ("failed" if metrics["null_critical_rows"] else "success")
    return {**metrics, "row_count_status": "success" if rows_ok else "failed",
            "nulls_status": nulls}


def run_gates(facts: DataFrame, log: Callable[[str, str, str], None] | None = None,
              min_rows: int = 1) -> dict:
    """Imperative gates: raise ``QualityGateError`` on the first failing gate.

    One aggregate job computes both counts; ``log`` (if given) receives
    ``(stage, status, message)`` and must never fail the gate itself.
    """
    def say(stage, status, message):
        if log is None:
            return
        try:
            log(stage, status, message)
        except Exception:  # noqa: BLE001 - logging must not fail the job
            pass

    row = quality_counts(facts).first()
    say(ROW_COUNT_STAGE, "started", MSG_ROWS_STARTED)
    if row["row_count"] < min_rows:
        say(ROW_COUNT_STAGE, "failed", MSG_ROWS_FAILED)
        raise QualityGateError(MSG_ROWS_FAILED)
    say(ROW_COUNT_STAGE, "success", MSG_ROWS_PASSED)
    say(NULLS_STAGE, "started", MSG_NULLS_STARTED)
    bad = row["null_critical_rows"]
    if bad > 0:
        msg = MSG_NULLS_FAILED % bad
        say(NULLS_STAGE, "failed", msg)
        raise QualityGateError(msg)
    say(NULLS_STAGE, "success", MSG_NULLS_PASSED)
    return row.asDict()
