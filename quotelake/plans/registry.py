"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables, over the whole tables, or data Spark
derives from them and writes under the shared folder (``session.run_dir``).

Fact table ("coin_prices") = ``event_quotes`` (events, 5 symbols, 30 days);
``brand_quotes`` (lineitem x part, 25 brands, day-grain ties) is the second
fact table.  Stats table ("market_stats") = hourly ``window_stats``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions import derive, envelope, scalars
from quotelake.operators import contracts, latest, quality, stats
from quotelake.operators.newest import NewestFirst
from quotelake.operators.intervals import interval_join as join_intervals
from quotelake.plans import dashboard_sql, reports
from quotelake.plans.backfill import backfill
from quotelake.schemas import ENRICHED_LAKE_COLUMNS, FACT_COLUMNS, RAW_RECORD_CONTRACT
from quotelake.session import ensure_utc, run_dir
from quotelake.sinks import jdbc as jdbc_sink
from quotelake.sinks import lake, runlog
from quotelake.sinks.unique import append_unique as add_unique
from quotelake.sources.adapters import BRAND_ORDER, brand_quotes, event_quotes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries (ours, not reference values).
TREND_SYMBOL = "click"
PAGE_SYMBOLS = ["click", "view", "purchase"]
DOMAIN_SYMBOLS = ["click", "view", "purchase", "signup"]
EVENT_PRICE_EDGES = (300.0, 100.0)  # event prices stay under 600
SPIKE_CONSTANT = 50.0
STATS_WINDOW = "1 hour"
SHORT_WINDOW = "5 minutes"
VOLATILITY_THRESHOLD = 60.0    # between the quartiles of hourly volatility


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def market_stats(quotes: DataFrame) -> DataFrame:
    return stats.window_stats(quotes, STATS_WINDOW)


def raw_lake_rows(quotes: DataFrame) -> DataFrame:
    """Quotes in the raw-lake layout (no supply figures in the test feed)."""
    none = F.lit(None).cast("double")
    return quotes.select(
        "symbol", "name", "price_usd", "market_cap", "volume_24h", "price_change_pct_24h",
        "recorded_at", "id", "high_24h", "low_24h",
        none.alias("circulating_supply"), none.alias("total_supply"), none.alias("max_supply"),
        "last_updated", "row_id")


def with_injected_nulls(quotes: DataFrame) -> DataFrame:
    """Data-driven NULLs for contract tests: no name under price 1, no price at volume 0."""
    return quotes.withColumns({
        "name": F.when(F.col("price_usd") < 1.0, F.lit(None)).otherwise(F.col("name")),
        "price_usd": F.when(F.col("volume_24h") == 0, F.lit(None))
                      .otherwise(F.col("price_usd")),
    })


def hour_snapshot(ts: str = "recorded_at"):
    return envelope.iso_utc(F.date_trunc("hour", F.col(ts)))


# --------------------------------------------------------------- scans / projections

@register("scan_raw")
def scan_raw(spark, sf_dir):
    """Raw quotes appended to a lake folder and read back (schema from footers)."""
    path = run_dir(spark, "scan_raw")
    lake.append(raw_lake_rows(event_quotes(spark, sf_dir)), path)
    return lake.read_lake(spark, path).drop("row_id")


@register("project_fact")
def project_fact(spark, sf_dir):
    """Rename + narrow to the seven fact columns."""
    return jdbc_sink.fact_rows(raw_lake_rows(event_quotes(spark, sf_dir)), decimals=False)


@register("envelope_roundtrip")
def envelope_roundtrip(spark, sf_dir):
    """Quotes -> hourly envelopes (<= 50 coins) -> JSON -> parsed + flattened rows."""
    env = envelope.to_envelopes(event_quotes(spark, sf_dir), hour_snapshot())
    return envelope.parse_envelopes(env)


@register("envelope_size")
def envelope_size(spark, sf_dir):
    env = envelope.to_envelopes(event_quotes(spark, sf_dir), hour_snapshot())
    return envelope.envelope_sizes(env)


@register("snapshot_page")
def snapshot_page(spark, sf_dir):
    """Ids in a list, by market cap desc, page 2 of 50."""
    return latest.snapshot_page(event_quotes(spark, sf_dir), PAGE_SYMBOLS, per_page=50, page=2) \
        .select("row_id", "symbol", "market_cap", "price_usd")


# --------------------------------------------------------------- scalars

@register("typed_cast")
def typed_cast(spark, sf_dir):
    """Text fields cast back to numbers; non-numeric text becomes NULL."""
    q = event_quotes(spark, sf_dir)
    return q.select(
        "row_id",
        scalars.to_double(F.col("price_usd").cast("string")).alias("price_usd"),
        scalars.to_long(F.col("volume_24h").cast("string")).alias("volume_24h"),
        scalars.to_double(F.col("symbol")).alias("symbol_as_number"),
    )


@register("parse_ts")
def parse_ts(spark, sf_dir):
    q = event_quotes(spark, sf_dir)
    return q.select("row_id", "last_updated",
                    scalars.parse_iso_ts("last_updated").alias("last_updated_ts"),
                    scalars.parse_iso_ts("symbol").alias("bad_text_ts"))


@register("derived_fields")
def derived_fields(spark, sf_dir):
    q = derive.with_derived_fields(event_quotes(spark, sf_dir), *EVENT_PRICE_EDGES)
    return q.select("row_id", "price_range_24h", "is_price_positive", "price_category")


@register("derived_fields_brand")
def derived_fields_brand(spark, sf_dir):
    """Reference thresholds (1000 / 100) on the brand quotes, whose prices reach 2000."""
    q = derive.with_derived_fields(brand_quotes(spark, sf_dir))
    return q.select("row_id", "price_range_24h", "is_price_positive", "price_category")


@register("spike_flag")
def spike_flag(spark, sf_dir):
    q = event_quotes(spark, sf_dir)
    return q.select("row_id", "volume_24h",
                    scalars.spike_flag("volume_24h", F.lit(SPIKE_CONSTANT)).alias("volume_spike"))


@register("enriched_contract")
def enriched_contract(spark, sf_dir):
    """The 17-field processed record, processing time = the quote's own time."""
    q = derive.with_history_extremes(event_quotes(spark, sf_dir))
    return derive.processed_record(
        q, processing_ts=F.col("recorded_at"), data_source="events",
        price_edges=[(300.0, "high"), (100.0, "medium")],
        volume_edges=[(66.0, "high"), (33.0, "medium")],
        market_cap_edges=[(300000.0, "large"), (100000.0, "mid")])


# --------------------------------------------------------------- stats and joins

@register("batch_stats")
def batch_stats(spark, sf_dir):
    """Per-(symbol, day) stats: each day plays one micro-batch."""
    q = event_quotes(spark, sf_dir).withColumn("day", scalars.day_start("recorded_at"))
    return stats.batch_stats(q, ["day"])


@register("history_stats")
def history_stats(spark, sf_dir):
    return stats.history_stats(event_quotes(spark, sf_dir))


@register("history_stats_brand")
def history_stats_brand(spark, sf_dir):
    return stats.history_stats(brand_quotes(spark, sf_dir))


@register("stats_spike_join")
def stats_spike_join(spark, sf_dir):
    """The join-and-regroup spike form, per (symbol, day)."""
    q = event_quotes(spark, sf_dir).withColumn("day", scalars.day_start("recorded_at"))
    return stats.spike_by_join(q, ["symbol", "day"])


@register("enrich_join")
def enrich_join(spark, sf_dir):
    """Facts left-joined to their symbol's history stats (the enriched lake rows)."""
    q = event_quotes(spark, sf_dir)
    return stats.enrich(q, stats.history_stats(q), ["symbol"]) \
        .select("row_id", "symbol", "name", "price_usd", "market_cap", "volume_24h",
                "price_change_pct_24h", "recorded_at", "volatility_score", "volume_spike")


@register("window_stats")
def window_stats(spark, sf_dir):
    """5-minute tumbling-window stats per symbol."""
    return stats.window_stats(event_quotes(spark, sf_dir), SHORT_WINDOW)


@register("window_stats_daily")
def window_stats_daily(spark, sf_dir):
    """1-day tumbling windows: groups hold many rows, so both spike values occur."""
    return stats.window_stats(event_quotes(spark, sf_dir), "1 day")


@register("window_join")
def window_join(spark, sf_dir):
    """Rows joined to their own hourly window: mean volume, volatility, row spike flag."""
    j = stats.window_join(event_quotes(spark, sf_dir), STATS_WINDOW)
    return j.select("row_id", "symbol", "window_start", "volume_24h", "avg_volume_window",
                    "volatility_score", "volume_spike", "volatility_flag")


# --------------------------------------------------------------- dashboards

@register("q1_top_volume")
def q1_top_volume(spark, sf_dir):
    return reports.q1_top_volume(event_quotes(spark, sf_dir))


@register("q1_top_volume_brand")
def q1_top_volume_brand(spark, sf_dir):
    return reports.q1_top_volume(brand_quotes(spark, sf_dir), order=BRAND_ORDER)


@register("q2_trend")
def q2_trend(spark, sf_dir):
    return reports.q2_trend(event_quotes(spark, sf_dir), TREND_SYMBOL)


@register("q2_trend_sql")
def q2_trend_sql(spark, sf_dir):
    return reports.q2_trend_sql(spark, event_quotes(spark, sf_dir), TREND_SYMBOL)


@register("q3_heatmap")
def q3_heatmap(spark, sf_dir):
    return reports.q3_heatmap(market_stats(event_quotes(spark, sf_dir)))


@register("q4_spike_rate")
def q4_spike_rate(spark, sf_dir):
    return reports.q4_spike_rate(market_stats(event_quotes(spark, sf_dir)))


@register("q5_latest")
def q5_latest(spark, sf_dir):
    return reports.q5_latest(event_quotes(spark, sf_dir))


@register("q5_latest_window")
def q5_latest_window(spark, sf_dir):
    return reports.q5_latest_window(event_quotes(spark, sf_dir))


@register("q5_latest_brand")
def q5_latest_brand(spark, sf_dir):
    """Latest per brand in one pass (``max_by``): day-grain timestamps tie, the line key breaks ties."""
    return reports.q5_latest(brand_quotes(spark, sf_dir), method="max_by", order=BRAND_ORDER)


@register("q5_latest_brand_two_phase")
def q5_latest_brand_two_phase(spark, sf_dir):
    """Latest per brand without sorting the input: newest time, semi-join, tie-break on few rows."""
    return reports.q5_latest(brand_quotes(spark, sf_dir), method="hash", order=BRAND_ORDER)


@register("latest_n_facts")
def latest_n_facts(spark, sf_dir):
    return reports.latest_n_facts(event_quotes(spark, sf_dir))


@register("latest_n_stats")
def latest_n_stats(spark, sf_dir):
    return reports.latest_n_stats(market_stats(event_quotes(spark, sf_dir)))


@register("table_counts")
def table_counts(spark, sf_dir):
    q = event_quotes(spark, sf_dir)
    logs = quality.run_log_rows(quality.dq_report(q))
    return reports.table_counts({"coin_prices": q, "market_stats": market_stats(q),
                                 "pipeline_logs": logs})


@register("bi_measures")
def bi_measures(spark, sf_dir):
    return reports.bi_measures(market_stats(event_quotes(spark, sf_dir)))


@register("date_rollup")
def date_rollup(spark, sf_dir):
    return reports.date_rollup(event_quotes(spark, sf_dir))


@register("heatmap_pivot")
def heatmap_pivot(spark, sf_dir):
    """Day x symbol volatility matrix."""
    daily = stats.window_stats(event_quotes(spark, sf_dir), "1 day")
    return reports.heatmap_pivot(daily)


# --------------------------------------------------------------- contracts and gates

@register("contract_not_null")
def contract_not_null(spark, sf_dir):
    q = with_injected_nulls(event_quotes(spark, sf_dir))
    return contracts.not_null_summary(q, contracts.NOT_NULL["coin_prices"])


@register("contract_not_null_rejects")
def contract_not_null_rejects(spark, sf_dir):
    q = with_injected_nulls(event_quotes(spark, sf_dir))
    _, rejected = contracts.split_not_null(q, contracts.NOT_NULL["coin_prices"])
    return rejected.select("row_id", "reject_reason")


@register("contract_domain")
def contract_domain(spark, sf_dir):
    return contracts.domain_summary(event_quotes(spark, sf_dir), "symbol", DOMAIN_SYMBOLS)


@register("contract_decimal")
def contract_decimal(spark, sf_dir):
    q = event_quotes(spark, sf_dir).select("row_id", "price_usd", "market_cap", "volume_24h",
                                           "price_change_pct_24h")
    casted = contracts.cast_decimals(q, contracts.COIN_PRICES_DECIMALS)
    # values at table precision, reported as doubles (exact for these scales)
    return casted.withColumns({c: F.col(c).cast("double") for c in contracts.COIN_PRICES_DECIMALS})


@register("contract_default")
def contract_default(spark, sf_dir):
    """Stats rows whose spike flag is unknown (single-row windows) get the default false."""
    s = market_stats(event_quotes(spark, sf_dir))
    s = s.withColumn("volume_spike", F.when(F.col("record_count") > 1, F.col("volume_spike")))
    return contracts.apply_defaults(s, {"volume_spike": F.lit(False)}) \
        .select("symbol", "window_start", "window_end", "record_count", "volume_spike")


@register("contract_unique")
def contract_unique(spark, sf_dir):
    """Duplicate (symbol, recorded_at) keys in the brand facts (day-grain ties)."""
    return contracts.duplicate_keys(brand_quotes(spark, sf_dir), ["symbol", "recorded_at"])


@register("contract_unique_line")
def contract_unique_line(spark, sf_dir):
    """The four-column line key is unique: no rows."""
    return contracts.duplicate_keys(brand_quotes(spark, sf_dir),
                                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@register("dq_row_count")
def dq_row_count(spark, sf_dir):
    return quality.dq_report(event_quotes(spark, sf_dir)).select("row_count", "row_count_status")


@register("dq_nulls")
def dq_nulls(spark, sf_dir):
    q = with_injected_nulls(event_quotes(spark, sf_dir))
    return quality.dq_report(q).select("null_critical_rows", "nulls_status")


@register("dq_report")
def dq_report(spark, sf_dir):
    return quality.dq_report(with_injected_nulls(event_quotes(spark, sf_dir)))


@register("run_log")
def run_log(spark, sf_dir):
    """Run-log rows the gates produce (ids and times left out: generated)."""
    q = with_injected_nulls(event_quotes(spark, sf_dir))
    return quality.run_log_rows(quality.dq_report(q))


@register("decimal_rejects")
def decimal_rejects(spark, sf_dir):
    """Facts that break the table contract: prices beyond their precision, missing names."""
    q = with_injected_nulls(event_quotes(spark, sf_dir))
    q = q.withColumn("price_usd", F.when(F.col("volume_24h") == 99, F.col("price_usd") * 1e10)
                     .otherwise(F.col("price_usd")))
    accepted, refused = jdbc_sink.split_facts(q)
    return refused.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows")).unionByName(
        accepted.agg(F.lit("accepted").alias("reject_reason"), F.count(F.lit(1)).alias("rows")))


@register("contract_raw_record")
def contract_raw_record(spark, sf_dir):
    """The raw record contract enforced: required names missing, text that is no number."""
    q = with_injected_nulls(event_quotes(spark, sf_dir))
    none = F.lit(None).cast("double")
    records = q.select(
        "row_id", "id", "symbol", "name", F.col("price_usd").alias("current_price"),
        F.when(F.col("volume_24h") == 1, "n/a").otherwise(F.col("market_cap").cast("string")).alias("market_cap"),
        F.col("volume_24h").alias("total_volume"), F.col("price_change_pct_24h").alias("price_change_percentage_24h"),
        "high_24h", "low_24h", none.alias("circulating_supply"), none.alias("total_supply"), none.alias("max_supply"),
        none.alias("ath"), none.alias("atl"), "last_updated")
    _, refused = contracts.enforce(records, RAW_RECORD_CONTRACT)
    return refused.select("row_id", "reject_reason")


@register("envelope_rejects")
def envelope_rejects(spark, sf_dir):
    """Messages without quotes: cut-off JSON, no list, an empty list; the others are accepted."""
    messages = broken_messages(event_quotes(spark, sf_dir))
    return envelope.envelope_rejects(messages)


def broken_messages(quotes: DataFrame) -> DataFrame:
    """One message per quote; the volume decides which are broken, and how."""
    env = envelope.to_envelopes(quotes, hour_snapshot(), max_quotes=1).select(
        "value", F.get_json_object("value", "$.coins[0].total_volume").cast("bigint").alias("v"),
        F.get_json_object("value", "$.ingested_at").alias("at"))
    body = (F.when(F.col("v") == 0, F.concat(F.lit('{"ingested_at": "'), F.col("at")))
            .when(F.col("v") == 1, F.format_string('{"ingested_at": "%s"}', F.col("at")))
            .when(F.col("v") == 2, F.format_string('{"ingested_at": "%s", "coins": []}', F.col("at")))
            .when(F.col("v") == 3, F.regexp_replace("value", '"symbol":"[^"]*",', ""))
            .when(F.col("v") == 4, F.regexp_replace("value", '"last_updated":"[^"]*"', '"last_updated":"soon"'))
            .otherwise(F.col("value")))
    return env.select(body.alias("value"))


# --------------------------------------------------------------- sinks

@register("append_union")
def append_union(spark, sf_dir):
    """Two appends (first half, second half of the month) read back as one multiset."""
    q = raw_lake_rows(event_quotes(spark, sf_dir))
    path = run_dir(spark, "append_union")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    lake.append(q.where(F.col("recorded_at") < cut), path)
    lake.append(q.where(F.col("recorded_at") >= cut), path)
    return lake.read_lake(spark, path).drop("row_id")


@register("sink_raw")
def sink_raw(spark, sf_dir):
    """Idempotent raw sink: the same batch written twice leaves one copy."""
    q = raw_lake_rows(event_quotes(spark, sf_dir)).withColumn("batch_id", F.lit(7).cast("bigint"))
    path = run_dir(spark, "sink_raw")
    lake.write_partitions(q, path, ["batch_id"], rebalance=False)
    lake.write_partitions(q, path, ["batch_id"], rebalance=False)
    return lake.read_lake(spark, path).drop("row_id", "batch_id")


@register("sink_enriched")
def sink_enriched(spark, sf_dir):
    """Enriched rows (per-day stats joined back) written by day partition, read back."""
    q = event_quotes(spark, sf_dir).withColumn("day", scalars.day_start("recorded_at"))
    s = stats.batch_stats(q, ["day"])
    rows = stats.enrich(q, s, ["symbol", "day"])
    path = run_dir(spark, "sink_enriched")
    lake.write_partitions(rows.select("row_id", *ENRICHED_LAKE_COLUMNS, "day"), path, ["day"])
    return lake.read_lake(spark, path).drop("day")


# --------------------------------------------------------------- backfill

def _backfilled(spark, sf_dir, name):
    base = run_dir(spark, name)
    q = raw_lake_rows(event_quotes(spark, sf_dir)).drop("row_id")
    lake.write_partitions(q.withColumn("day", F.to_date("recorded_at")), f"{base}/raw", ["day"])
    backfill(spark, f"{base}/raw", f"{base}/facts", f"{base}/stats")
    return base


@register("backfill_stats")
def backfill_stats(spark, sf_dir):
    """Whole-history stats rebuilt from the raw lake (reruns replace: see the sink tests)."""
    return spark.read.parquet(f"{_backfilled(spark, sf_dir, 'backfill_stats')}/stats")


@register("backfill_facts")
def backfill_facts(spark, sf_dir):
    return spark.read.parquet(f"{_backfilled(spark, sf_dir, 'backfill_facts')}/facts").drop("day")


# --------------------------------------------------------------- dashboards as SQL text

def _dashboard(spark, sf_dir, name):
    q = event_quotes(spark, sf_dir)
    return dashboard_sql.run(spark, name, facts=q, stats=market_stats(q))


@register("q1_top_volume_sql")
def q1_top_volume_sql(spark, sf_dir):
    return _dashboard(spark, sf_dir, "top_volume")


@register("q3_heatmap_sql")
def q3_heatmap_sql(spark, sf_dir):
    return _dashboard(spark, sf_dir, "heatmap")


@register("q4_spike_rate_sql")
def q4_spike_rate_sql(spark, sf_dir):
    return _dashboard(spark, sf_dir, "spike_rate")


@register("q5_latest_sql")
def q5_latest_sql(spark, sf_dir):
    return _dashboard(spark, sf_dir, "latest")


@register("interval_join")
def interval_join(spark, sf_dir):
    """Quotes joined to windows of any length and place (from minutes to days), summed per window."""
    q = event_quotes(spark, sf_dir)
    windows = q.where("row_id % 25 = 0").select(
        "symbol", F.col("row_id").alias("window_id"), F.col("recorded_at").alias("window_start"),
        (F.col("recorded_at") + F.expr("make_dt_interval(0, 0, 7 * (1 + volume_24h * volume_24h))")).alias("window_end"))
    return join_intervals(q.select("symbol", "price_usd", "volume_24h", "recorded_at"), windows, ["symbol"], by=["window_id", "symbol"],
                          totals={"quotes": ("count", None), "max_price": ("max", "price_usd"), "volume": ("sum", "volume_24h")})


def _by_day(spark: SparkSession, sf_dir: str, name: str) -> NewestFirst:
    path = run_dir(spark, name)
    lake.write_partitions(event_quotes(spark, sf_dir).withColumn("day", F.to_date("recorded_at")), path, ["day"])
    return NewestFirst(spark, path)


@register("latest_n_facts_days")
def latest_n_facts_days(spark, sf_dir):
    """The ten newest facts of a lake partitioned by day, opening the newest folders only."""
    by = [F.col("recorded_at").desc(), F.col("row_id").desc()]
    return _by_day(spark, sf_dir, "latest_n_days").latest_n(10, by).select("row_id", *FACT_COLUMNS)


@register("q5_latest_days")
def q5_latest_days(spark, sf_dir):
    """Latest quote per symbol of a lake partitioned by day; older folders stay closed once every symbol is found."""
    symbols = event_quotes(spark, sf_dir).select("symbol").distinct()
    found = _by_day(spark, sf_dir, "q5_days").latest_per_key(symbols, columns=[c for c in FACT_COLUMNS if c != "symbol"])
    return found.select(*reports.q5_latest(event_quotes(spark, sf_dir)).columns)


@register("append_unique")
def append_unique(spark, sf_dir):
    """Two appends to a keyed table; the second overlaps the first by two days and repeats rows of its own."""
    path = run_dir(spark, "append_unique")
    q = raw_lake_rows(event_quotes(spark, sf_dir)).withColumn("day", F.to_date("recorded_at"))
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    later = q.where(F.col("recorded_at") >= F.lit("2024-01-14").cast("timestamp_ntz"))
    add_unique(q.where(F.col("recorded_at") < cut), path, ["row_id", "recorded_at"])
    refused = add_unique(later.unionByName(later.where("row_id % 10 = 0")), path, ["row_id", "recorded_at"])
    stored = spark.read.parquet(path).groupBy(F.date_format("day", "yyyy-MM-dd").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return stored.select(F.lit("lake").alias("kind"), "name", "n").unionByName(
        refused.groupBy(F.col("reason").alias("name")).agg(F.sum("n").alias("n")).select(F.lit("refused").alias("kind"), "name", "n"))


@register("facts_clustered")
def facts_clustered(spark, sf_dir):
    """Facts laid out along a curve over (symbol, time) with Bloom filters, read back by a symbol and by a time filter."""
    path = run_dir(spark, "facts_clustered")
    lake.write_clustered(event_quotes(spark, sf_dir).select("row_id", *FACT_COLUMNS), path)
    back = lake.read_lake(spark, path)
    noon = [F.lit(f"2024-01-15 {h}:00:00").cast("timestamp_ntz") for h in (12, 13)]
    by_symbol = back.where(F.col("symbol") == TREND_SYMBOL).select(F.lit("symbol").alias("filter"), "row_id", "price_usd")
    in_hour = (F.col("recorded_at") >= noon[0]) & (F.col("recorded_at") < noon[1])
    by_time = back.where(in_hour).select(F.lit("hour").alias("filter"), "row_id", "price_usd")
    return by_symbol.unionByName(by_time)


@register("contract_unique_planted")
def contract_unique_planted(spark, sf_dir):
    """The line key over lines of which every thousandth order comes twice or three times: those keys and their copies."""
    q = brand_quotes(spark, sf_dir)
    again = q.where("l_orderkey % 1000 = 0")
    return contracts.duplicate_keys(q.unionByName(again).unionByName(again.where("l_linenumber = 1")),
                                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@register("window_join_flag")
def window_join_flag(spark, sf_dir):
    """Rows of windows whose volatility exceeds a threshold that the data crosses both ways."""
    j = stats.window_join(event_quotes(spark, sf_dir), STATS_WINDOW, volatility_threshold=VOLATILITY_THRESHOLD)
    return j.groupBy("symbol", "volatility_flag", "volume_spike").agg(F.count(F.lit(1)).alias("rows"))


@register("run_log_lake")
def run_log_lake(spark, sf_dir):
    """A gate run that passes and one that fails, each appended to a run log and read back."""
    path = run_dir(spark, "run_log")
    q = event_quotes(spark, sf_dir)
    for facts in (q, with_injected_nulls(q), q.limit(0)):
        entries: list[tuple[str, str, str]] = []
        try:
            quality.run_gates(facts, lambda *entry: entries.append(entry))  # noqa: B023
        except quality.QualityGateError:
            pass
        runlog.log_frame(spark, entries).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("stage", "status", "message").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("run_id").alias("ids"))
