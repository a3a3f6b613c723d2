"""Turn the driver's tables into quote rows.

A quote row has the raw-lake column names plus ``row_id``, a unique id that
makes "latest" deterministic when timestamps tie.  Timestamps stay
``TIMESTAMP_NTZ`` (wall clock in UTC) in every compared output; the streaming
jobs convert to ``TIMESTAMP`` only where a watermark needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE_COLUMNS = [
    "row_id", "id", "symbol", "name", "price_usd", "market_cap", "volume_24h",
    "price_change_pct_24h", "high_24h", "low_24h", "recorded_at", "last_updated",
]


BRAND_ORDER = ("recorded_at", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso_millis_z(ts: F.Column) -> F.Column:
    """ISO-8601 text with milliseconds and a literal Z, as quote feeds send it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def quotes_from_events(events: DataFrame) -> DataFrame:
    """events -> quotes: one event type is one symbol.

    Mapping: id=user_id as text, symbol=event_type, name=upper(event_type),
    price=value, volume=props.k, market cap=floor(value*1000),
    24h change=value-50, 24h high/low=value*1.02/0.98, recorded_at=ts.
    Pure projection: Catalyst prunes the scan to the six source columns.
    """
    value = F.col("value")
    return events.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("symbol"),
        F.upper("event_type").alias("name"),
        value.alias("price_usd"),
        F.floor(value * 1000).cast("bigint").alias("market_cap"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("volume_24h"),
        (value - 50).alias("price_change_pct_24h"),
        (value * 1.02).alias("high_24h"),
        (value * 0.98).alias("low_24h"),
        F.col("ts").alias("recorded_at"),
        iso_millis_z(F.col("ts")).alias("last_updated"),
    )


def quotes_from_lineitem(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """lineitem x part -> quotes with day-grain, heavily tied timestamps.

    symbol=p_brand, price=l_extendedprice/l_quantity, volume=l_quantity,
    recorded_at=l_shipdate.  The row id is the 4-column line key as text; "latest"
    breaks ties on the four integers (``BRAND_ORDER``).  ``part`` is a dimension
    joined on its key; AQE broadcasts it only when its measured size allows.
    """
    p = part.select("p_partkey", "p_brand")
    l = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                        "l_quantity", "l_extendedprice", "l_shipdate")
    joined = l.join(p, l.l_partkey == p.p_partkey, "inner")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        F.col("l_suppkey").cast("string").alias("id"),
        F.col("p_brand").alias("symbol"),
        F.upper("p_brand").alias("name"),
        price.alias("price_usd"),
        F.floor(F.col("l_extendedprice")).cast("bigint").alias("market_cap"),
        F.col("l_quantity").cast("bigint").alias("volume_24h"),
        (F.col("l_quantity") - 25).alias("price_change_pct_24h"),
        (price * 1.02).alias("high_24h"),
        (price * 0.98).alias("low_24h"),
        F.col("l_shipdate").alias("recorded_at"),
        iso_millis_z(F.col("l_shipdate")).alias("last_updated"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
    )


def event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_from_events(load_table(spark, sf_dir, "events"))


def brand_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_from_lineitem(load_table(spark, sf_dir, "lineitem"),
                                load_table(spark, sf_dir, "part"))
