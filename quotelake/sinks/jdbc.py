"""JDBC table sinks and readers (public ``format("jdbc")`` options only).

Writes are dealt to ``max_connections`` tasks by a ``repartition``, so only the
write itself is narrow, and ``batchsize`` rows travel per round trip.  A replaced
table is truncated, not dropped, so its keys, defaults and precision stay.
``split_facts`` and ``split_stats`` apply the table contracts (NOT NULL, decimal
precision) before a write and return what does not fit, with a reason.
Appends are at least once: a replayed micro-batch can append its rows again.
Use ``staged`` tables where that matters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from quotelake.operators.contracts import (COIN_PRICES_DECIMALS, MARKET_STATS_DECIMALS, NOT_NULL,
                                            split_contract)
from quotelake.schemas import FACT_COLUMNS


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, extra: Mapping[str, str] | None = None
                 ) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update(extra or {})
    return opts


def write_table(df: DataFrame, options: Mapping[str, str], mode: str = "append",
                batchsize: int = 5000, max_connections: int | None = 16) -> None:
    out = df.repartition(max_connections) if max_connections else df
    (out.write.format("jdbc").options(**write_options(options, mode, batchsize))
        .mode(mode).save())


def write_options(options: Mapping[str, str], mode: str = "append", batchsize: int = 5000) -> dict[str, str]:
    """Options of a write: batch size, and ``truncate`` when the table is replaced."""
    out = {"batchsize": str(batchsize), **options}
    if mode == "overwrite":
        out.setdefault("truncate", "true")
    return out


def staged(options: Mapping[str, str], stream: str, batch_id: int) -> dict[str, str]:
    """Options for a staging table of one micro-batch.

    Replacing ``<table>_stage_<stream>_<batch>`` is idempotent under replay; the database then merges
    it into the table once (``INSERT ... SELECT``) and drops it.
    """
    tag = "".join(c if c.isalnum() else "_" for c in stream)
    return {**options, "dbtable": f"{options['dbtable']}_stage_{tag}_{batch_id}"}


def read_table(spark: SparkSession, options: Mapping[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read a table; with a numeric partition column the read is split into ranges."""
    r = spark.read.format("jdbc").options(**options)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower)).option("upperBound", str(upper))
              .option("numPartitions", str(num_partitions)))
    return r.load()


def fact_rows(raw: DataFrame, decimals: bool = True) -> DataFrame:
    """Raw lake rows -> the seven fact-table columns; at table precision only rows that meet the contract."""
    return split_facts(raw)[0] if decimals else raw.select(*FACT_COLUMNS)


def split_facts(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows at table precision, rows of ``raw`` that break the fact table's contract, with ``reject_reason``)."""
    return split_contract(raw, FACT_COLUMNS, NOT_NULL["coin_prices"], COIN_PRICES_DECIMALS)


STATS_COLUMNS = ("symbol", "volatility_score", "volume_spike", "window_start", "window_end")


def split_stats(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows at table precision, rows of ``stats`` that break the stats table's contract)."""
    return split_contract(stats, STATS_COLUMNS, NOT_NULL["market_stats"], MARKET_STATS_DECIMALS)


def stats_rows(stats: DataFrame, decimals: bool = True, columns: Sequence[str] = STATS_COLUMNS) -> DataFrame:
    """Stats -> market_stats columns; at table precision only rows that meet the contract."""
    return split_stats(stats)[0] if decimals else stats.select(*columns)
