"""Parquet lake sinks.

* ``write_partitions`` – idempotent: rows carry their partition keys (e.g.
  ``batch_id`` and event ``day``) and the write replaces exactly those
  partitions (dynamic partition overwrite), so a retried micro-batch or a
  rerun backfill never duplicates rows.
* ``write_batch`` – one micro-batch of one stream, replaced as a whole on replay;
  ``compact`` turns many such folders into one per day.
* ``append`` – plain multiset append, the reference behaviour.
* Layout: rows are clustered by ``symbol`` then newest-first inside each
  file, so parquet min/max statistics let ``symbol = ?`` filters skip row
  groups (the lake's counterpart of an index on ``(symbol, time desc)``).
* File count: before a write partitioned by a many-valued column (event
  ``day``) the rows are rebalanced on that column: one shuffle after which
  AQE sizes every output partition near the advisory size and splits a
  skewed (hot) day, so each task writes a few large files instead of every
  task writing one small file per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clustered(df: DataFrame, sort_by: Sequence[str] = ("symbol", "recorded_at"),
              range_partitions: int | None = None) -> DataFrame:
    """Sort rows inside each task by (symbol, time desc).

    With ``range_partitions`` the data is first range-partitioned on the full
    sort key: boundaries come from a sample, and because the time column is
    part of the key a hot symbol is spread over many ranges instead of
    landing in one task.
    """
    key, *rest = sort_by
    order = [F.col(key).asc()] + [F.col(c).desc() for c in rest]
    if range_partitions:
        df = df.repartitionByRange(range_partitions, *order)
    return df.sortWithinPartitions(*order)


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6, sample_rows: int = 4096) -> Column:
    """Place of a row on a space-filling curve over ``columns``: the interleaved bits of its quantile in each.

    Quantile borders come from a hash sample of at most ``sample_rows`` rows, so the curve follows the data; every row gets its
    place whatever the sample.  NULLs lie first.
    """
    sample = df.select(*columns).orderBy(F.xxhash64(F.lit(11), *df.columns)).limit(sample_rows).collect()
    z = F.lit(0).cast("bigint")
    for j, c in enumerate(columns):
        values = sorted(r[c] for r in sample if r[c] is not None)
        cuts = sorted({values[len(values) * k >> bits] for k in range(1, 1 << bits)}) if values else []
        kind = df.schema[c].dataType
        borders = F.array(*[F.lit(str(v)).cast(kind) for v in cuts]) if cuts else F.array().cast(f"array<{kind.simpleString()}>")
        place = F.coalesce(F.size(F.filter(borders, lambda b: b <= F.col(c))), F.lit(0))  # noqa: B023
        for i in range(bits):
            bit = F.shiftright(place, i).bitwiseAND(1).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return z


def write_clustered(df: DataFrame, path: str, columns: Sequence[str] = ("symbol", "recorded_at"), partitions: int | None = None,
                    bloom: Sequence[str] = ("symbol",), row_group_bytes: int | None = None) -> None:
    """Replace ``path`` by ``df`` laid out along a space-filling curve over ``columns``, with Parquet Bloom filters on ``bloom``.

    A filter on any one of the columns then skips most row groups, unlike a sort, which serves its first column only.  A hot
    value is spread over several ranges by the other columns.
    """
    ranked = df.withColumn("_z", z_value(df, columns))
    ranked = ranked.repartitionByRange(partitions, "_z", *columns) if partitions else ranked.repartitionByRange("_z", *columns)
    w = ranked.sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite")
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    w.parquet(path)


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``REBALANCE`` on ``columns``: AQE coalesces small and splits skewed partitions."""
    return df.hint("rebalance", *columns)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                     sort_by: Sequence[str] | None = ("symbol", "recorded_at"),
                     fmt: str = "parquet", rebalance: bool = True) -> None:
    """Replace the partitions present in ``df``; leave all others untouched.

    Pass ``rebalance=False`` when ``df`` holds a single partition value (one
    micro-batch): each task then writes one file anyway and the shuffle is waste.
    """
    out = rebalanced(df, partition_by) if rebalance else df
    out = clustered(out, sort_by) if sort_by else out
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path))


def write_batch(df: DataFrame, path: str, stream: str, batch_id: int, partition_by: Sequence[str] = ("day",),
                sort_by: Sequence[str] | None = ("symbol", "recorded_at")) -> None:
    """Replace exactly the folder of one micro-batch of one stream: ``stream=<id>/batch_id=<n>/day=...``.

    Batch numbers start again at 0 with every new checkpoint, so the stream's own
    identity is part of the key: several streams, or a stream with a new checkpoint,
    share a lake without touching each other's rows, and a replay leaves one copy.
    """
    write_folder(df, f"{path}/stream={stream}/batch_id={batch_id}", partition_by, sort_by)


def write_folder(df: DataFrame, folder: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] | None = None) -> None:
    """Replace one folder as a whole."""
    out = clustered(df, sort_by) if sort_by else df
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(folder)


def compact(spark, path: str, target: str, days: Sequence[str] | None = None) -> None:
    """Rewrite a streamed lake (one folder per micro-batch) as one clustered folder per day.

    Only ``days`` (``yyyy-MM-dd``) are rewritten if given; the target's other days stay.
    """
    df = spark.read.parquet(path)
    if days is not None:
        df = df.where(F.col("day").isin([str(d) for d in days]))
    write_partitions(df, target, ["day"])


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (),
           sort_by: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    out = rebalanced(df, partition_by) if partition_by else df
    out = clustered(out, sort_by) if sort_by else out
    w = out.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_if_nonempty(df: DataFrame, path: str, **kw) -> bool:
    """Append only when there is at least one row (``isEmpty`` reads one row)."""
    if df.isEmpty():
        return False
    append(df, path, **kw)
    return True


def read_lake(spark, path: str, schema=None) -> DataFrame:
    """Read a lake folder; the schema comes from the parquet footers unless given."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)
