"""Envelope messages <-> quote rows.

An envelope is ``{"ingested_at": <ISO text>, "coins": [<quote>, ...]}``.
Parsing is ``from_json`` with the declared schema followed by ``inline``;
building is a bounded ``collect_list`` per (snapshot, chunk) so no message
(and no task) ever holds an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegralType, LongType, StringType, StructField, StructType

from quotelake.schemas import COIN_SCHEMA, ENVELOPE_SCHEMA

# Envelope schema with every numeric quote field read as text, for lenient parsing.
_NUMERIC = {f.name: f.dataType for f in COIN_SCHEMA if isinstance(f.dataType, (LongType, DoubleType))}
_TEXT_ENVELOPE = StructType([
    StructField("ingested_at", StringType(), True),
    StructField("coins", ArrayType(StructType([
        StructField(f.name, StringType() if f.name in _NUMERIC else f.dataType, True)
        for f in COIN_SCHEMA])), True),
])

# Fixed value: the largest page a snapshot request returns.
MAX_QUOTES_PER_ENVELOPE = 50

# Flattened quote columns (F2 order, without processing_time).
FLAT_COLUMNS = [
    "ingested_at", "id", "symbol", "name", "current_price", "market_cap", "total_volume",
    "price_change_pct_24h", "high_24h", "low_24h", "circulating_supply", "total_supply",
    "max_supply", "last_updated",
]


def iso_utc(ts: Column, micros: bool = False) -> Column:
    """ISO-8601 stamp with an explicit +00:00 offset (UTC session).

    Second precision by default; ``micros=True`` adds ``.ffffff`` like an
    ``isoformat()`` of a processing-time instant.
    """
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" if micros else "yyyy-MM-dd'T'HH:mm:ss"
    return F.concat(F.date_format(ts, fmt), F.lit("+00:00"))


def coin_struct(columns: list[str]) -> Column:
    """Quote row (raw-lake names) -> coin struct (envelope names); supplies absent from ``columns`` are NULL."""
    def pick(name: str, source: str | None = None) -> Column:
        return F.col(source or name).cast(COIN_SCHEMA[name].dataType).alias(name)

    def optional(name: str) -> Column:
        return pick(name) if name in columns else F.lit(None).cast(COIN_SCHEMA[name].dataType).alias(name)

    return F.struct(
        pick("id"), pick("symbol"), pick("name"),
        pick("current_price", "price_usd"), pick("market_cap"),
        pick("total_volume", "volume_24h"),
        pick("price_change_percentage_24h", "price_change_pct_24h"),
        pick("high_24h"), pick("low_24h"),
        optional("circulating_supply"), optional("total_supply"), optional("max_supply"),
        pick("last_updated"),
    )


def to_envelopes(quotes: DataFrame, snapshot: Column, seq: str = "row_id",
                 max_quotes: int = MAX_QUOTES_PER_ENVELOPE) -> DataFrame:
    """Group quotes into envelopes of at most ``max_quotes`` coins.

    ``snapshot`` is the ISO text stamped as ``ingested_at``; ``seq`` must be a unique
    integer id (another type raises; each id is in one envelope), and ``floor(seq / max_quotes)``
    caps every envelope at ``max_quotes`` coins whatever the key skew.  Returns
    ``(ingested_at, envelope_no, n_coins, value)`` with ``value`` the JSON text.
    """
    if not isinstance(quotes.schema[seq].dataType, IntegralType):
        raise TypeError(f"{seq} must be an integer id")
    keyed = quotes.select(
        snapshot.alias("ingested_at"),
        F.floor(F.col(seq) / max_quotes).alias("envelope_no"),
        coin_struct(quotes.columns).alias("coin"),
    )
    grouped = keyed.groupBy("ingested_at", "envelope_no").agg(
        F.collect_list("coin").alias("coins"))
    return grouped.select(
        "ingested_at", "envelope_no",
        F.size("coins").alias("n_coins"),
        F.to_json(F.struct("ingested_at", "coins")).alias("value"),
    )


def _exact_number(text: Column, target) -> Column:
    """Numeric text -> target type, only when the value is exactly representable.

    ``"20.0"`` and ``"1.0e3"`` become LONG 20 and 1000; ``"30.5"`` stays NULL
    for a LONG field; ``"12.5"`` (a JSON string) becomes DOUBLE 12.5.
    """
    d = text.try_cast("double")
    if isinstance(target, DoubleType):
        return d
    as_long = d.try_cast("bigint")
    return F.when(as_long.try_cast("double") == d, as_long)


def parse_envelopes(messages: DataFrame, value: str = "value",
                    lenient_numbers: bool = False) -> DataFrame:
    """JSON envelopes (text or bytes) -> one row per quote, F2 names.

    Malformed JSON, a missing ``coins`` field and an empty array all yield no
    row (``inline`` drops them); see ``envelope_rejects`` for the side output.
    By default numbers follow the declared types strictly: a LONG written as
    ``20.0`` or ``1.0e3`` and a number sent as text become NULL.  With
    ``lenient_numbers`` such values are kept whenever they denote an exact
    value of the field's type.
    """
    schema = _TEXT_ENVELOPE if lenient_numbers else ENVELOPE_SCHEMA
    parsed = messages.select(F.from_json(F.col(value).cast("string"), schema).alias("m"))
    flat = parsed.select(F.col("m.ingested_at").alias("ingested_at"),
                         F.inline(F.col("m.coins")))
    if lenient_numbers:
        flat = flat.withColumns({c: _exact_number(F.col(c), t) for c, t in _NUMERIC.items()})
    return flat.withColumnRenamed("price_change_percentage_24h", "price_change_pct_24h") \
               .select(*FLAT_COLUMNS)


def envelope_rejects(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that produce no quote: unparsable, no coins, or an empty list."""
    parsed = messages.select(
        F.col(value).cast("string").alias("body"),
        F.from_json(F.col(value).cast("string"), ENVELOPE_SCHEMA).alias("m"))
    coins = F.col("m.coins")
    reason = (F.when(F.col("m").isNull() | (F.col("m.ingested_at").isNull() & coins.isNull()),
                     "unparsable")
              .when(coins.isNull(), "no_coins")
              .when(F.size(coins) == 0, "empty_coins"))
    return parsed.select("body", reason.alias("reason")).where(F.col("reason").isNotNull())


def envelope_sizes(envelopes: DataFrame) -> DataFrame:
    """Number of coins per envelope (the producer's batch-size log line)."""
    parsed = envelopes.select(
        F.from_json(F.col("value").cast("string"), ENVELOPE_SCHEMA).alias("m"))
    return parsed.select(F.col("m.ingested_at").alias("ingested_at"),
                         F.size("m.coins").alias("n_coins"))


def to_raw_lake(flat: DataFrame, recorded_at: Column | None = None) -> DataFrame:
    """Flattened quotes -> raw-lake layout (renamed price/volume/time)."""
    stamp = recorded_at if recorded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return flat.select(
        "symbol", "name",
        F.col("current_price").alias("price_usd"),
        "market_cap",
        F.col("total_volume").alias("volume_24h"),
        "price_change_pct_24h",
        stamp.alias("recorded_at"),
        "id", "high_24h", "low_24h", "circulating_supply", "total_supply", "max_supply",
        "last_updated",
    )
