"""Command-line entry points."""
from pyspark.sql import functions as F

from quotelake.cli import main
from quotelake.plans.registry import raw_lake_rows, with_injected_nulls
from quotelake.sources.adapters import event_quotes
from tests.conftest import SF001


def test_gates_exit_codes_and_log(spark, tmp_dir):
    q = event_quotes(spark, SF001)
    q.select("symbol", "name", "price_usd", "recorded_at").write.parquet(f"{tmp_dir}/good")
    with_injected_nulls(q).select("symbol", "name", "price_usd", "recorded_at") \
        .write.parquet(f"{tmp_dir}/bad")
    assert main(["gates", "--facts", f"{tmp_dir}/good", "--log", f"{tmp_dir}/log"]) == 0
    assert main(["gates", "--facts", f"{tmp_dir}/bad", "--log", f"{tmp_dir}/log"]) == 2
    statuses = [r.status for r in spark.read.parquet(f"{tmp_dir}/log").collect()]
    # good run: 2 successes; bad run: row-count success, then the null gate fails
    assert statuses.count("failed") == 1 and statuses.count("success") == 3


def test_backfill_command(spark, tmp_dir):
    raw_lake_rows(event_quotes(spark, SF001)).drop("row_id").write.parquet(f"{tmp_dir}/raw")
    assert main(["backfill", "--raw", f"{tmp_dir}/raw", "--facts", f"{tmp_dir}/f",
                 "--stats", f"{tmp_dir}/s"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/s").count() == 5
    assert spark.read.parquet(f"{tmp_dir}/f").agg(F.count("*")).first()[0] == 1000


def test_query_command_writes_parquet(spark, tmp_dir):
    assert main(["query", "history_stats", "--tables", SF001, "--out", f"{tmp_dir}/out"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 5
