"""Column expressions: flags, categories, parsing, typed casts.

All are native Catalyst expressions (no Python UDFs), so they compile into
whole-stage codegen next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def spike_flag(volume: ColumnOrName, baseline: ColumnOrName, factor: float = 1.0) -> Column:
    """Strictly greater than the baseline (times ``factor``); NULL on either side -> false."""
    base = _c(baseline) if factor == 1.0 else _c(baseline) * F.lit(factor)
    return F.coalesce(_c(volume) > base, F.lit(False))


def null_as_false(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def price_range_24h(high: ColumnOrName = "high_24h", low: ColumnOrName = "low_24h") -> Column:
    return (_c(high) - _c(low)).cast("double")


def is_price_positive(pct: ColumnOrName = "price_change_pct_24h") -> Column:
    return null_as_false(_c(pct) > 0)


def price_category(price: ColumnOrName = "price_usd", high: float = 1000.0,
                   medium: float = 100.0) -> Column:
    """'high' above ``high``, 'medium' above ``medium``, else (NULL included) 'low'."""
    p = _c(price)
    return F.when(p > high, "high").when(p > medium, "medium").otherwise("low")


def volatility_flag(volatility: ColumnOrName, threshold: float = 1000.0) -> Column:
    return null_as_false(_c(volatility) > threshold)


def bucket(value: ColumnOrName, edges: list[tuple[float, str]], default: str) -> Column:
    """First label whose lower edge the value exceeds; edges are scanned in order."""
    v = _c(value)
    expr = None
    for edge, label in edges:
        expr = F.when(v > edge, label) if expr is None else expr.when(v > edge, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def parse_iso_ts(text: ColumnOrName) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ (UTC wall clock); bad text -> NULL.

    ``try_to_timestamp`` keeps milliseconds and honours a trailing Z; the cast
    to NTZ happens in the (UTC-pinned) session zone.
    """
    return F.try_to_timestamp(_c(text)).cast("timestamp_ntz")


def to_double(text: ColumnOrName) -> Column:
    return _c(text).try_cast("double")


def to_long(text: ColumnOrName) -> Column:
    return _c(text).try_cast("bigint")


def to_decimal(x: ColumnOrName, precision: int, scale: int) -> Column:
    """Cast to DECIMAL(p,s); values that do not fit become NULL instead of failing."""
    return _c(x).try_cast(f"decimal({precision},{scale})")


# Microseconds per fixed-length duration unit accepted by ``tumbling_start``.
_UNIT_MICROS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
                "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
                "week": 604_800_000_000}


def duration_micros(duration: str) -> int:
    """'5 minutes' -> 300000000 (fixed-length units only)."""
    n, unit = duration.strip().split()
    unit = unit.lower().rstrip("s")
    if unit not in _UNIT_MICROS:
        raise ValueError(f"unsupported duration unit: {duration!r}")
    return int(n) * _UNIT_MICROS[unit]


def day_start(ts: ColumnOrName) -> Column:
    """Midnight (TIMESTAMP_NTZ) of the day holding ``ts``, in the session zone (UTC here).

    Used instead of a DATE so day keys keep one type (timestamp) through
    parquet, Arrow and pandas alike.
    """
    return F.date_trunc("day", _c(ts)).cast("timestamp_ntz")


def tumbling_start(ts: ColumnOrName, duration: str) -> Column:
    """Start (TIMESTAMP_NTZ) of the epoch-aligned tumbling window holding ``ts``.

    Unlike ``F.window`` this adds no implicit NOT NULL filter, so a left join
    keyed on it keeps rows whose time is NULL.
    """
    us = duration_micros(duration)
    t = _c(ts)
    micros = F.unix_micros(t.cast("timestamp"))
    start = F.timestamp_micros(micros - F.pmod(micros, F.lit(us)))
    return start.cast("timestamp_ntz")
