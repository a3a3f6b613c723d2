"""Record and table contracts as StructType constants.

Fixed values: the field names, types and nullability below must equal the
envelope and table layouts the pipeline exchanges with producers and BI tools.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# --- fixed values: one quote inside an envelope (13 fields, all nullable) ---
COIN_SCHEMA = StructType([
    StructField("id", StringType(), True),
    StructField("symbol", StringType(), True),
    StructField("name", StringType(), True),
    StructField("current_price", DoubleType(), True),
    StructField("market_cap", LongType(), True),
    StructField("total_volume", LongType(), True),
    StructField("price_change_percentage_24h", DoubleType(), True),
    StructField("high_24h", DoubleType(), True),
    StructField("low_24h", DoubleType(), True),
    StructField("circulating_supply", DoubleType(), True),
    StructField("total_supply", DoubleType(), True),
    StructField("max_supply", DoubleType(), True),
    StructField("last_updated", StringType(), True),
])

# --- fixed values: the message envelope ---
ENVELOPE_SCHEMA = StructType([
    StructField("ingested_at", StringType(), True),
    StructField("coins", ArrayType(COIN_SCHEMA), True),
])

# --- fixed values: transport columns of a message-bus record ---
TRANSPORT_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]

# --- fixed values: the raw lake dataset, names as the stream job writes them ---
# (recorded_at is stored as TIMESTAMP_NTZ, the UTC wall clock, in every write mode)
RAW_LAKE_SCHEMA = StructType([
    StructField("symbol", StringType(), True),
    StructField("name", StringType(), True),
    StructField("price_usd", DoubleType(), True),
    StructField("market_cap", LongType(), True),
    StructField("volume_24h", LongType(), True),
    StructField("price_change_pct_24h", DoubleType(), True),
    StructField("recorded_at", TimestampNTZType(), True),
    StructField("id", StringType(), True),
    StructField("high_24h", DoubleType(), True),
    StructField("low_24h", DoubleType(), True),
    StructField("circulating_supply", DoubleType(), True),
    StructField("total_supply", DoubleType(), True),
    StructField("max_supply", DoubleType(), True),
    StructField("last_updated", StringType(), True),
])

# --- fixed values: the enriched lake dataset ---
ENRICHED_LAKE_COLUMNS = [
    "symbol", "name", "price_usd", "market_cap", "volume_24h",
    "price_change_pct_24h", "recorded_at", "volatility_score", "volume_spike",
]

# --- fixed values: the seven columns of the fact table ---
FACT_COLUMNS = [
    "symbol", "name", "price_usd", "market_cap", "volume_24h",
    "price_change_pct_24h", "recorded_at",
]

# --- fixed values: table contracts (precision, nullability) ---
COIN_PRICES_TABLE = StructType([
    StructField("id", StringType(), False),
    StructField("symbol", StringType(), False),
    StructField("name", StringType(), False),
    StructField("price_usd", DecimalType(18, 8), False),
    StructField("market_cap", DecimalType(24, 2), True),
    StructField("volume_24h", DecimalType(24, 2), True),
    StructField("price_change_pct_24h", DecimalType(8, 4), True),
    StructField("recorded_at", TimestampType(), False),
])

MARKET_STATS_TABLE = StructType([
    StructField("id", StringType(), False),
    StructField("symbol", StringType(), False),
    StructField("volatility_score", DecimalType(10, 4), True),
    StructField("volume_spike", BooleanType(), True),
    StructField("window_start", TimestampType(), False),
    StructField("window_end", TimestampType(), False),
    StructField("created_at", TimestampType(), False),
])

PIPELINE_LOGS_TABLE = StructType([
    StructField("run_id", StringType(), False),
    StructField("stage", StringType(), False),
    StructField("status", StringType(), False),
    StructField("message", StringType(), True),
    StructField("created_at", TimestampType(), False),
])

# --- fixed values: allowed run-log states ---
LOG_STATUSES = ["started", "running", "success", "failed"]

# --- fixed values: the raw record contract (15 fields) ---
RAW_RECORD_CONTRACT = StructType([
    StructField("id", StringType(), False),
    StructField("symbol", StringType(), False),
    StructField("name", StringType(), False),
    StructField("current_price", DoubleType(), True),
    StructField("market_cap", LongType(), True),
    StructField("total_volume", LongType(), True),
    StructField("price_change_percentage_24h", DoubleType(), True),
    StructField("high_24h", DoubleType(), True),
    StructField("low_24h", DoubleType(), True),
    StructField("circulating_supply", DoubleType(), True),
    StructField("total_supply", DoubleType(), True),
    StructField("max_supply", DoubleType(), True),
    StructField("ath", DoubleType(), True),
    StructField("atl", DoubleType(), True),
    StructField("last_updated", TimestampType(), True),
])

# --- fixed values: the processed record contract (17 fields) ---
PROCESSED_RECORD_CONTRACT = StructType([
    StructField("id", StringType(), False),
    StructField("symbol", StringType(), False),
    StructField("name", StringType(), False),
    StructField("current_price", DoubleType(), True),
    StructField("market_cap", LongType(), True),
    StructField("total_volume", LongType(), True),
    StructField("price_change_percentage_24h", DoubleType(), True),
    StructField("price_category", StringType(), True),
    StructField("volume_category", StringType(), True),
    StructField("market_cap_category", StringType(), True),
    StructField("is_near_ath", BooleanType(), True),
    StructField("is_near_atl", BooleanType(), True),
    StructField("volatility_24h", DoubleType(), True),
    StructField("processing_timestamp", TimestampType(), False),
    StructField("data_date", StringType(), False),
    StructField("data_source", StringType(), False),
    StructField("pipeline_version", StringType(), False),
])

# Columns whose NULL makes a fact row unusable (the null-critical gate).
CRITICAL_FACT_COLUMNS = ["symbol", "name", "price_usd", "recorded_at"]

