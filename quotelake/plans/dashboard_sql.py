"""The dashboard questions as Spark SQL text.

The texts name their inputs ``{coin_prices}`` and ``{market_stats}``; ``run``
binds DataFrames to those names through ``spark.sql(text, coin_prices=df, ...)``,
so nothing is registered in the session (safe when several queries run at
once).  ``register_views`` is there for BI users who want real temp views;
``VIEW_SQL`` then holds the same texts over the view names.  PostgreSQL's
``DISTINCT ON (symbol) ... ORDER BY symbol, recorded_at DESC`` has no Spark
form, so "latest per symbol" is the newest time per symbol (a hash aggregate), a
semi-join to the rows at that time, and ``max_by`` with ``row_id`` among those few.  Catalyst plans these exactly like the DataFrame
versions in ``reports.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession



def exact_mean_sql(column: str, digits: int) -> str:
    """``functions.exact.exact_mean`` as SQL text (values within its units)."""
    total = f"sum(CAST(CAST({column} AS DECIMAL(29,8)) * 100000000BD AS DECIMAL(38,0)))"
    step = f"(CAST(count({column}) AS DECIMAL(38,0)) * CAST({10 ** (8 - digits)} AS DECIMAL(38,0)))"
    twice = f"(abs({total}) * 2BD + {step})"
    whole = f"CAST(({twice} - {twice} % ({step} * 2BD)) / ({step} * 2BD) AS DECIMAL(38,0))"
    return f"signum({total}) * CAST({whole} AS DOUBLE) / {10 ** digits}D"


LATEST_CTE = """newest AS (
  SELECT symbol, max(recorded_at) AS t FROM {coin_prices} GROUP BY symbol),
latest AS (
  SELECT symbol, l.name, l.volume_24h, l.price_usd, l.market_cap, l.price_change_pct_24h,
         l.recorded_at
  FROM (SELECT symbol,
               max_by(named_struct('name', name, 'volume_24h', volume_24h, 'price_usd', price_usd,
                                   'market_cap', market_cap,
                                   'price_change_pct_24h', price_change_pct_24h,
                                   'recorded_at', recorded_at), row_id) AS l
        FROM {coin_prices} f
        LEFT SEMI JOIN newest ON f.symbol <=> newest.symbol AND f.recorded_at <=> newest.t
        GROUP BY symbol))"""

DASHBOARD_SQL = {
    "top_volume": f"""WITH {LATEST_CTE}
SELECT symbol, name, volume_24h, price_usd, market_cap, price_change_pct_24h, recorded_at
FROM latest ORDER BY volume_24h DESC NULLS FIRST, symbol LIMIT 20""",
    "trend": f"""SELECT CAST(date_trunc('DAY', recorded_at) AS TIMESTAMP_NTZ) AS day,
       {exact_mean_sql("price_usd", 6)} AS avg_price, max(price_usd) AS max_price, min(price_usd) AS min_price
FROM {{coin_prices}} WHERE symbol = :symbol
GROUP BY CAST(date_trunc('DAY', recorded_at) AS TIMESTAMP_NTZ) ORDER BY day""",
    "heatmap": """SELECT symbol, window_start, window_end, volatility_score
FROM {market_stats} ORDER BY window_end DESC, symbol""",
    "spike_rate": """SELECT symbol,
       100.0D * count_if(volume_spike) / count(*) AS volume_spike_pct, count(*) AS records
FROM {market_stats} GROUP BY symbol HAVING count(*) > 0 ORDER BY volume_spike_pct DESC""",
    "latest": f"""WITH {LATEST_CTE}
SELECT symbol, name, price_usd, market_cap, volume_24h, price_change_pct_24h, recorded_at
FROM latest""",
}


# The same texts over registered temp views.
VIEW_SQL = {k: v.replace("{coin_prices}", "coin_prices").replace("{market_stats}", "market_stats")
            for k, v in DASHBOARD_SQL.items()}


def register_views(facts: DataFrame, stats: DataFrame | None = None) -> None:
    facts.createOrReplaceTempView("coin_prices")
    if stats is not None:
        stats.createOrReplaceTempView("market_stats")


def run(spark: SparkSession, name: str, facts: DataFrame | None = None,
        stats: DataFrame | None = None, **params) -> DataFrame:
    """Run one dashboard text with DataFrames bound to its inputs; ``params`` fill ``:names``."""
    frames = {}
    if facts is not None:
        frames["coin_prices"] = facts
    if stats is not None:
        frames["market_stats"] = stats
    return spark.sql(DASHBOARD_SQL[name], args=params or None, **frames)
