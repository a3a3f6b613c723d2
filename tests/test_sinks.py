"""Lake sinks: idempotent partition overwrite, append, skip-if-empty, layout, JDBC options."""
from pyspark.sql import functions as F

from quotelake.sinks import jdbc as jdbc_sink
from quotelake.sinks import lake
from quotelake.sources.adapters import event_quotes
from quotelake.sources.streams import object_store_conf
from tests.conftest import SF001


def test_partition_overwrite_is_idempotent(spark, tmp_dir):
    q = event_quotes(spark, SF001).withColumn("batch_id", F.lit(1))
    lake.write_partitions(q, tmp_dir, ["batch_id"])
    lake.write_partitions(q.withColumn("batch_id", F.lit(2)), tmp_dir, ["batch_id"])
    lake.write_partitions(q, tmp_dir, ["batch_id"])          # replay of batch 1
    assert lake.read_lake(spark, tmp_dir).count() == 2 * q.count()


def test_append_and_skip_if_empty(spark, tmp_dir):
    q = event_quotes(spark, SF001)
    lake.append(q, tmp_dir)
    assert lake.append_if_nonempty(q.limit(0), tmp_dir) is False
    assert lake.append_if_nonempty(q.limit(3), tmp_dir) is True
    assert lake.read_lake(spark, tmp_dir).count() == q.count() + 3


def test_sorted_layout_prunes_row_groups(spark, tmp_dir):
    q = event_quotes(spark, SF001)
    lake.write_partitions(q.withColumn("day", F.to_date("recorded_at")), tmp_dir, ["day"])
    back = lake.read_lake(spark, tmp_dir).where("symbol = 'click' AND day = DATE'2024-01-02'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,click)]" in plan
    assert "PartitionFilters" in plan
    assert back.count() == q.where("symbol = 'click' AND to_date(recorded_at) = DATE'2024-01-02'").count()


def test_jdbc_options_and_projections(spark):
    opts = jdbc_sink.jdbc_options("jdbc:postgresql://db:5432/quotes", "coin_prices", "u", "p",
                                  "org.postgresql.Driver", {"stringtype": "unspecified"})
    assert opts["dbtable"] == "coin_prices" and opts["stringtype"] == "unspecified"
    facts = jdbc_sink.fact_rows(event_quotes(spark, SF001))
    assert facts.columns == ["symbol", "name", "price_usd", "market_cap", "volume_24h",
                             "price_change_pct_24h", "recorded_at"]
    assert dict(facts.dtypes)["price_usd"] == "decimal(18,8)"


def test_object_store_conf():
    conf = object_store_conf("http://store:9000", "k", "s")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.timeout"] == "60000"


def test_run_log_lake_logger(spark, tmp_dir):
    from quotelake.operators.quality import run_gates
    from quotelake.sinks.runlog import lake_logger
    q = event_quotes(spark, SF001).select("symbol", "name", "price_usd", "recorded_at")
    run_gates(q, lake_logger(spark, f"{tmp_dir}/log"))
    log = spark.read.parquet(f"{tmp_dir}/log")
    assert log.count() == 4 and log.where("status = 'success'").count() == 2
    assert set(log.columns) == {"run_id", "stage", "status", "message", "created_at"}


def test_run_folders_are_released(spark):
    import os
    from quotelake.session import release_run_dirs, run_dir
    release_run_dirs(spark)
    path = run_dir(spark, "tidy")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local) and release_run_dirs(spark) == 1 and not os.path.exists(local)
    assert release_run_dirs(spark) == 0


def test_contract_schemas_are_stable():
    from quotelake.operators.contracts import COIN_PRICES_DECIMALS, MARKET_STATS_DECIMALS, NOT_NULL
    from quotelake.schemas import COIN_PRICES_TABLE, MARKET_STATS_TABLE, PIPELINE_LOGS_TABLE, RAW_RECORD_CONTRACT
    assert [f.name for f in RAW_RECORD_CONTRACT if not f.nullable] == ["id", "symbol", "name"]
    generated = {"id", "run_id", "created_at"}
    for table, name in ((COIN_PRICES_TABLE, "coin_prices"), (MARKET_STATS_TABLE, "market_stats"),
                        (PIPELINE_LOGS_TABLE, "pipeline_logs")):
        assert [f.name for f in table if not f.nullable and f.name not in generated] == NOT_NULL[name]
    precision = {f.name: (f.dataType.precision, f.dataType.scale) for t in (COIN_PRICES_TABLE, MARKET_STATS_TABLE)
                 for f in t if f.dataType.typeName() == "decimal"}
    assert precision == {**COIN_PRICES_DECIMALS, **MARKET_STATS_DECIMALS}


def test_processed_record_matches_contract_names(spark):
    from pyspark.sql import functions as F
    from quotelake.functions.derive import processed_record, with_history_extremes
    from quotelake.schemas import PROCESSED_RECORD_CONTRACT
    rec = processed_record(with_history_extremes(event_quotes(spark, SF001)))
    assert rec.columns == PROCESSED_RECORD_CONTRACT.fieldNames()
    assert rec.schema["processing_timestamp"].dataType.typeName() == "timestamp"


def test_cli_query_runs(spark, capsys):
    from quotelake.cli import main
    assert main(["query", "q5_latest", "--tables", SF001, "--rows", "5"]) == 0
    assert "symbol" in capsys.readouterr().out


def test_backfill_skips_empty_lake(spark, tmp_dir):
    from quotelake.plans.backfill import backfill
    event_quotes(spark, SF001).limit(0).write.parquet(f"{tmp_dir}/raw")
    assert backfill(spark, f"{tmp_dir}/raw", f"{tmp_dir}/f", f"{tmp_dir}/s") == {"facts": False, "stats": False}


def test_backfill_replaces_whole_target(spark, tmp_dir):
    from pyspark.sql import functions as F
    from quotelake.plans.backfill import backfill
    from quotelake.plans.registry import raw_lake_rows
    q = raw_lake_rows(event_quotes(spark, SF001)).drop("row_id")
    q.write.parquet(f"{tmp_dir}/raw1")
    q.where("recorded_at < '2024-01-10'").write.parquet(f"{tmp_dir}/raw2")
    backfill(spark, f"{tmp_dir}/raw1", f"{tmp_dir}/facts", f"{tmp_dir}/stats")
    backfill(spark, f"{tmp_dir}/raw2", f"{tmp_dir}/facts", f"{tmp_dir}/stats")
    facts = spark.read.parquet(f"{tmp_dir}/facts")
    assert facts.count() == q.where("recorded_at < '2024-01-10'").count()
    assert facts.agg(F.max("day")).first()[0].isoformat() < "2024-01-10"


def test_lake_reads_with_declared_raw_schema(spark, tmp_dir):
    from quotelake.plans.registry import raw_lake_rows
    from quotelake.schemas import RAW_LAKE_SCHEMA
    raw_lake_rows(event_quotes(spark, SF001)).drop("row_id").write.parquet(f"{tmp_dir}/lake")
    back = lake.read_lake(spark, f"{tmp_dir}/lake", RAW_LAKE_SCHEMA)
    assert back.schema == RAW_LAKE_SCHEMA and back.count() == 1000
