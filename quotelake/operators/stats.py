"""Volatility and volume-spike statistics in three scopes, and joins back to rows.

One aggregate serves every scope:

* ``batch``   – per symbol inside the DataFrame handed in (a micro-batch), plus
                optional extra keys;
* ``history`` – per symbol over the whole history;
* ``window``  – per symbol and event-time tumbling window.

Spike: some row's volume is strictly above the group mean, which is the same
as ``max(volume) > avg(volume)``; one partial/final aggregate computes it,
no join and no second aggregate.  Means, deviations and flags come from exact binned sums (``functions.exact``), so
every form and every partitioning gives the same result.  Every aggregate here is algebraic
(count/sum/min/max), so Spark combines map-side and a hot symbol holding a
third of all rows only adds one partial row per task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.exact import above_mean, baseline, finished, mean, moments_by, stddev, top_above_mean
from quotelake.functions.scalars import tumbling_start
from quotelake.operators.joins import DEFAULT_MAX_ROWS, lookup_join

DEFAULT_DIGITS = 6


def group_stats(df: DataFrame, keys: list[str], price: str = "price_usd",
                volume: str = "volume_24h", time: str = "recorded_at",
                digits: int | None = DEFAULT_DIGITS, factor: float = 1.0) -> DataFrame:
    """Per-group stats: mean volume, sample stddev of price, time span, spike flag."""
    measures = {price: True, volume: False}
    spans = (F.min(time).alias("window_start"), F.max(time).alias("window_end"), F.count(F.lit(1)).alias("record_count"))
    return stats_columns(finished(moments_by(df, keys, measures, *spans), measures), keys, price, volume, digits, factor)


def stats_columns(groups: DataFrame, keys: list[str], price: str, volume: str, digits: int | None = DEFAULT_DIGITS,
                  factor: float = 1.0) -> DataFrame:
    """The stats table's columns from finished moments with window_start, window_end and record_count beside them."""
    return groups.select(*keys, stddev(price, digits).alias("volatility_score"), mean(volume, digits).alias("avg_volume"),
                         top_above_mean(volume, factor).alias("volume_spike"), "window_start", "window_end", "record_count")


def batch_stats(batch: DataFrame, extra_keys: list[str] | None = None, **kw) -> DataFrame:
    """Stats per symbol within one micro-batch (``extra_keys`` refine the group)."""
    return group_stats(batch, ["symbol", *(extra_keys or [])], **kw)


def history_stats(history: DataFrame, **kw) -> DataFrame:
    """Stats per symbol over the full history (the backfill's scope)."""
    return group_stats(history, ["symbol"], **kw)


def window_stats(df: DataFrame, duration: str, time: str = "recorded_at",
                 price: str = "price_usd", volume: str = "volume_24h",
                 digits: tuple[int | None, int | None, int | None, int | None] =
                 (DEFAULT_DIGITS,) * 4, factor: float = 1.0) -> DataFrame:
    """Per (symbol, tumbling window): mean/stddev of price and volume, count, spike.

    ``digits`` rounds (avg_price, volatility_score, avg_volume, volume_stddev);
    pass ``(2, 4, 2, 2)`` for the dashboard's display rounding.  A row whose time is
    NULL lies in no window; ``rows_without_time`` counts such rows.
    """
    d_price, d_vol, d_avgv, d_vstd = digits
    measures = {price: True, volume: True}
    groups = finished(moments_by(df, ["symbol", F.window(time, duration).alias("w")], measures,
                                 F.count(F.lit(1)).alias("record_count")), measures)
    # a watermarked stream's window is TIMESTAMP; its wall clock is stored as TIMESTAMP_NTZ
    return groups.select(
        "symbol",
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        mean(price, d_price).alias("avg_price"),
        stddev(price, d_vol).alias("volatility_score"),
        mean(volume, d_avgv).alias("avg_volume"),
        stddev(volume, d_vstd).alias("volume_stddev"),
        top_above_mean(volume, factor).alias("volume_spike"),
        "record_count",
    )


def stats(df: DataFrame, scope: str = "history", duration: str | None = None,
          keys: list[str] | None = None, **kw) -> DataFrame:
    """One entry point for the three scopes.

    ``scope="batch"``   per symbol (and ``keys``) inside the frame handed in;
    ``scope="history"`` per symbol over everything;
    ``scope="window"``  per symbol and tumbling window of ``duration``.
    """
    if scope == "batch":
        return batch_stats(df, keys, **kw)
    if scope == "history":
        return history_stats(df, **kw)
    if scope == "window":
        if not duration:
            raise ValueError("scope='window' needs a duration such as '5 minutes'")
        return window_stats(df, duration, **kw)
    raise ValueError(f"unknown scope {scope!r}; use batch, history or window")


def rows_without_time(df: DataFrame, time: str = "recorded_at") -> DataFrame:
    """One row: how many rows no window can hold because their time is NULL."""
    return df.agg(F.count_if(F.col(time).isNull()).alias("rows_without_time"))


def spike_by_join(batch: DataFrame, keys: list[str], volume: str = "volume_24h",
                  max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """The same flag asked row by row: is any row of the group above the group's mean?

    Kept to show (and test) that it equals the one-pass form.  The group's exact sum and count
    travel instead of a rounded mean, so ``volume * count > sum`` decides as in the one-pass form.
    """
    measures = {volume: False}
    per = baseline(finished(moments_by(batch, keys, measures), measures), keys, volume)
    rows = lookup_join(batch.select(*keys, volume), per, keys, "left", max_rows)
    return rows.groupBy(*keys).agg(F.bool_or(above_mean(f"`{volume}`", volume)).alias("volume_spike"))


def enrich(facts: DataFrame, stats: DataFrame, keys: list[str],
           columns: tuple[str, ...] = ("volatility_score", "volume_spike"),
           max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """Left join of fact rows to their group's stats (one stats row per key).

    The stats side is broadcast only behind a size check (``max_rows``); pass
    ``max_rows=None`` to leave the choice to AQE (e.g. inside a micro-batch
    whose rows are already cached).
    """
    return lookup_join(facts, stats.select(*keys, *columns), keys, "left", max_rows)


def window_join(rows: DataFrame, duration: str, time: str = "recorded_at",
                price: str = "price_usd", volume: str = "volume_24h",
                digits: int | None = DEFAULT_DIGITS, volatility_threshold: float = 1000.0,
                max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """Each row joined to the stats of its own (symbol, tumbling window).

    The interval condition ``start <= t < end`` is replaced by an equi-join on
    ``(symbol, window(t).start)``: a row lies in exactly one tumbling window,
    so the result is the same and Spark can hash/sort-merge/broadcast it
    instead of running a range (nested-loop) join.  The stats side is an
    aggregate (partial before the shuffle), broadcast only when a size check
    proves it small; beyond ``max_rows`` it is a sort-merge join whose skewed
    partitions AQE splits.  Rows whose time is NULL are kept, with NULL stats.
    """
    keyed = rows.withColumn("window_start", tumbling_start(time, duration))
    measures = {price: True, volume: False}
    groups = finished(moments_by(keyed, ["symbol", "window_start"], measures), measures)
    base = baseline(groups.select("symbol", "window_start", f"{volume}__m", f"{volume}__t",
                                  mean(volume, digits).alias("avg_volume_window"), stddev(price, digits).alias("volatility_score"),
                                  stddev(price).alias("__volatility")),
                    ["symbol", "window_start"], volume, "avg_volume_window", "volatility_score", "__volatility")
    joined = lookup_join(keyed, base, ["symbol", "window_start"], "left", max_rows)
    return joined.select(
        *keyed.columns,
        "avg_volume_window",
        "volatility_score",
        above_mean(f"`{volume}`", volume).alias("volume_spike"),
        F.coalesce(F.col("__volatility") > volatility_threshold,
                   F.lit(False)).alias("volatility_flag"),
    )
