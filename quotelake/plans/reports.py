"""Dashboard questions over the fact table (quotes) and the stats table.

Each function takes DataFrames and returns a DataFrame; nothing is collected.
Ordering follows the dashboard text, with explicit tie-breaks so that top-k and
"latest" answers are deterministic when timestamps or values tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.exact import exact_mean, finished, mean, merged, moments_by
from quotelake.functions.scalars import day_start
from quotelake.operators.latest import latest_per_key, latest_per_key_window, top_k
from quotelake.plans import dashboard_sql
from quotelake.schemas import FACT_COLUMNS

LATEST_COLUMNS = ["name", "price_usd", "market_cap", "volume_24h",
                  "price_change_pct_24h", "recorded_at"]
LATEST_ORDER = ("recorded_at", "row_id")


def q1_top_volume(facts: DataFrame, k: int = 20, order: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """Latest quote per symbol, then the k largest volumes (NULL volumes first)."""
    latest = latest_per_key(facts, "symbol", order, LATEST_COLUMNS)
    ranked = top_k(latest, [F.col("volume_24h").desc_nulls_first(), F.col("symbol").asc()], k)
    return ranked.select("symbol", "name", "volume_24h", "price_usd", "market_cap",
                         "price_change_pct_24h", "recorded_at")


def q2_trend(facts: DataFrame, symbol: str, digits: int = 6) -> DataFrame:
    """Daily average/max/min price of one symbol, by day (``day`` = midnight, TIMESTAMP_NTZ).

    The symbol filter sits directly on the scan, so parquet row groups whose
    symbol statistics exclude it are skipped (helped by the sorted lake layout).
    """
    day = day_start("recorded_at").alias("day")
    return (facts.where(F.col("symbol") == symbol)
            .groupBy(day)
            .agg(exact_mean("price_usd", digits).alias("avg_price"),
                 F.max("price_usd").alias("max_price"),
                 F.min("price_usd").alias("min_price"))
            .orderBy("day"))


def q2_trend_sql(spark: SparkSession, facts: DataFrame, symbol: str) -> DataFrame:
    """The same question as parameterised SQL (named parameter ``:symbol``)."""
    return dashboard_sql.run(spark, "trend", facts, symbol=symbol)


def q3_heatmap(stats: DataFrame) -> DataFrame:
    """Volatility per (symbol, window), newest window first."""
    return stats.select("symbol", "window_start", "window_end", "volatility_score") \
                .orderBy(F.col("window_end").desc(), F.col("symbol").asc())


def q4_spike_rate(stats: DataFrame) -> DataFrame:
    """Percentage of stats rows flagged as a volume spike, per symbol."""
    agg = stats.groupBy("symbol").agg(
        F.count_if(F.col("volume_spike")).alias("spikes"),
        F.count(F.lit(1)).alias("records"),
    )
    return (agg.where(F.col("records") > 0)
            .select("symbol",
                    (F.lit(100.0) * F.col("spikes") / F.col("records")).alias("volume_spike_pct"),
                    "records")
            .orderBy(F.col("volume_spike_pct").desc()))


def q5_latest(facts: DataFrame, method: str = "hash", order: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """Latest snapshot per symbol (``method`` as in ``latest_per_key``)."""
    return latest_per_key(facts, "symbol", order, LATEST_COLUMNS,
                          method=method).select("symbol", *LATEST_COLUMNS)


def q5_latest_window(facts: DataFrame) -> DataFrame:
    """Latest snapshot per symbol (ranking-window form, same rows)."""
    return latest_per_key_window(facts, "symbol", ("recorded_at", "row_id"), LATEST_COLUMNS) \
        .select("symbol", *LATEST_COLUMNS)


def latest_n_facts(facts: DataFrame, n: int = 10) -> DataFrame:
    return top_k(facts, [F.col("recorded_at").desc(), F.col("row_id").desc()], n) \
        .select("row_id", *FACT_COLUMNS)


def latest_n_stats(stats: DataFrame, n: int = 10) -> DataFrame:
    return top_k(stats, [F.col("window_end").desc(), F.col("symbol").asc()], n) \
        .select("symbol", "volatility_score", "volume_spike", "window_start", "window_end")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each (a union of global counts, no join)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bi_measures(stats: DataFrame, digits: int = 6) -> DataFrame:
    """Overall spike rate (safe divide) and mean volatility."""
    return stats.agg(
        F.try_divide(F.count_if(F.col("volume_spike")).cast("double"),
                     F.count(F.lit(1))).alias("spike_rate"),
        exact_mean("volatility_score", digits).alias("avg_volatility"),
        F.count(F.lit(1)).alias("stats_rows"),
    )


def date_rollup(facts: DataFrame, digits: int = 6) -> DataFrame:
    """Drill-down on recorded_at: year > month > day subtotals plus the grand total.

    The facts are summed by day first; the rollup then expands the few day rows, not
    every fact.  Each row is labelled by ``level`` (total, year,
    month, day) and ``period`` ('all', '2024', '2024-01', '2024-01-15'), a
    ready-made axis for a drill-down, instead of NULL subtotal markers.
    """
    price = {"price_usd": False}
    days = moments_by(facts, [F.to_date("recorded_at").alias("day")], price,
                      F.count(F.lit(1)).alias("n"), F.sum("volume_24h").alias("volume"))
    parts = days.select(F.year("day").alias("y"), F.month("day").alias("m"), F.dayofmonth("day").alias("d"),
                        "n", "price_usd__m", "volume")
    agg = finished(parts.rollup("y", "m", "d").agg(
        *merged(price),
        F.grouping_id().alias("g"),
        F.sum("n").alias("records"),
        F.sum("volume").alias("total_volume"),
    ), price).withColumn("avg_price", mean("price_usd", digits))
    level = F.when(F.col("g") == 7, "total").when(F.col("g") == 3, "year") \
             .when(F.col("g") == 1, "month").otherwise("day")
    period = F.when(F.col("g") == 7, F.lit("all")) \
              .when(F.col("g") == 3, F.format_string("%04d", "y")) \
              .when(F.col("g") == 1, F.format_string("%04d-%02d", "y", "m")) \
              .otherwise(F.format_string("%04d-%02d-%02d", "y", "m", "d"))
    return agg.select(level.alias("level"), period.alias("period"),
                      "records", "avg_price", "total_volume")


def heatmap_pivot(stats: DataFrame, symbols: Sequence[str] | None = None, value: str = "volatility_score",
                  max_symbols: int = 1000) -> DataFrame:
    """Window x symbol matrix of ``value``: one aggregate, one column per symbol.

    Without ``symbols`` every symbol of ``stats`` gets a column, in order; more than
    ``max_symbols`` of them raise, since a matrix that wide is not a report.
    """
    if symbols is None:
        found = stats.select("symbol").distinct().orderBy("symbol").limit(max_symbols + 1).collect()
        if len(found) > max_symbols:
            raise ValueError(f"more than {max_symbols} symbols; pass the ones to show")
        symbols = [r["symbol"] for r in found]
    cells = [F.max(F.when(F.col("symbol").eqNullSafe(F.lit(s)), F.col(value))).alias(str(s)) for s in symbols]
    if not cells:
        return stats.select("window_start").distinct()
    return stats.groupBy("window_start").agg(*cells)
