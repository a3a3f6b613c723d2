"""Appends that keep a primary key.

Only the day folders that the batch touches are read, and of them only the key columns: the batch's days prune the
scan at run time, and its keys, broadcast behind a size check, meet the stored ones in a semi-join, so the lake is
not shuffled.  Duplicates inside the batch are found by an aggregate.  A replayed batch finds its own rows and adds none.
One writer at a time is assumed, as for every folder without a manifest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.contracts import any_null
from quotelake.operators.joins import checked_broadcast
from quotelake.sinks.lake import append


def existing_keys(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], day: str = "day") -> DataFrame:
    """The keys of ``batch`` that the lake at ``path`` holds; reads the touched days only."""
    columns = list(dict.fromkeys([*keys, day]))
    stored = spark.read.parquet(path).select(*columns)
    days = checked_broadcast(batch.select(F.col(day).alias("_day")).distinct())
    # the condition makes the side selective for run-time partition pruning
    touched = stored.join(days.filter(F.col("_day") > F.lit("0001-01-01").cast("date")), F.col(day) == F.col("_day"), "left_semi")
    wanted = checked_broadcast(batch.select(*[F.col(k).alias("_" + k) for k in keys]).distinct())
    return touched.join(wanted, [F.col(k) == F.col("_" + k) for k in keys], "left_semi").select(*keys).distinct()


def append_unique(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), day: str = "day") -> DataFrame:
    """Append the rows of ``df`` whose key is new, partitioned by ``day``; returns the refused ones.

    The day must follow from the key.  Of rows that share a key in the batch the first by ``order`` (then by all columns)
    is taken.  Refused rows come as (reason, keys, n): ``null_key`` or null day, ``duplicate_in_batch``, ``exists``.
    """
    spark, keys = df.sparkSession, list(keys)
    rest = [c for c in df.columns if c not in keys]
    usable = ~any_null([*keys, day])
    first = F.struct(*order, *[c for c in rest if c not in order])
    one = (df.filter(usable).groupBy(*keys).agg(F.min_by(F.struct(*rest), first).alias("_row"), F.count(F.lit(1)).alias("_n"))
           .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest], "_n")).checkpoint()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    empty = not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    known = one.limit(0).select(*keys) if empty else existing_keys(spark, path, one, keys, day).checkpoint()
    append(one.join(known, keys, "left_anti").select(*df.columns), path, (day,))
    n = F.col("_n") - 1
    return (one.filter("_n > 1").select(F.lit("duplicate_in_batch").alias("reason"), *keys, n.alias("n"))
            .unionByName(one.join(known, keys, "left_semi").select(F.lit("exists").alias("reason"), *keys, F.lit(1).cast("bigint").alias("n")))
            .unionByName(df.filter(~usable).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                         .select(F.lit("null_key").alias("reason"), *keys, "n")))
