"""Row-level derived fields and the processed-record contract.

The processed contract declares fields without formulas; the formulas here
are ours, with every threshold a parameter:

* price/volume/market-cap categories: ordered ``(edge, label)`` buckets;
* near all-time high/low: ``price >= near_high * ath`` / ``price <= near_low * atl``;
* 24h volatility: ``(high - low) / low``;
* ``data_date``: ``yyyy-MM-dd`` of the processing time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.scalars import (
    bucket,
    is_price_positive,
    price_category,
    price_range_24h,
)
from quotelake.operators.joins import lookup_join

# Default buckets (parameters, not reference values).
VOLUME_EDGES = [(1e9, "high"), (1e7, "medium")]
MARKET_CAP_EDGES = [(1e10, "large"), (1e9, "mid")]


def with_derived_fields(df: DataFrame, high: float = 1000.0, medium: float = 100.0) -> DataFrame:
    """price_range_24h, is_price_positive and price_category on quote rows."""
    return df.withColumns({
        "price_range_24h": price_range_24h(),
        "is_price_positive": is_price_positive(),
        "price_category": price_category("price_usd", high, medium),
    })


def with_history_extremes(quotes: DataFrame, key: str = "symbol", price: str = "price_usd"
                          ) -> DataFrame:
    """Add ``ath``/``atl``: the symbol's highest and lowest price over the history.

    An aggregate (one row per symbol, combined map-side) joined back on the key,
    not a window over the symbol, so a hot symbol is never held by one task.
    """
    ext = quotes.groupBy(key).agg(F.max(price).alias("ath"), F.min(price).alias("atl"))
    return lookup_join(quotes, ext, [key], "left")


def processed_record(quotes: DataFrame,
                     processing_ts: Column | None = None,
                     data_source: str = "market_feed",
                     pipeline_version: str = "1.0.0",
                     price_edges: Sequence[tuple[float, str]] = ((1000.0, "high"), (100.0, "medium")),
                     volume_edges: Sequence[tuple[float, str]] = VOLUME_EDGES,
                     market_cap_edges: Sequence[tuple[float, str]] = MARKET_CAP_EDGES,
                     near_high: float = 0.95, near_low: float = 1.05) -> DataFrame:
    """Quote rows with ``ath``/``atl`` -> the 17-field processed record."""
    ts = processing_ts if processing_ts is not None else F.current_timestamp()
    price = F.col("price_usd")
    return quotes.select(
        F.col("id"), F.col("symbol"), F.col("name"),
        price.alias("current_price"),
        F.col("market_cap"),
        F.col("volume_24h").alias("total_volume"),
        F.col("price_change_pct_24h").alias("price_change_percentage_24h"),
        bucket(price, list(price_edges), "low").alias("price_category"),
        bucket("volume_24h", list(volume_edges), "low").alias("volume_category"),
        bucket("market_cap", list(market_cap_edges), "small").alias("market_cap_category"),
        (price >= F.col("ath") * near_high).alias("is_near_ath"),
        (price <= F.col("atl") * near_low).alias("is_near_atl"),
        F.try_divide(F.col("high_24h") - F.col("low_24h"), F.col("low_24h")).alias("volatility_24h"),
        ts.alias("processing_timestamp"),
        F.date_format(ts, "yyyy-MM-dd").alias("data_date"),
        F.lit(data_source).alias("data_source"),
        F.lit(pipeline_version).alias("pipeline_version"),
    )
