"""Joins against a per-key lookup side, broadcast only behind a size check.

``checked_broadcast`` materialises the lookup side once with ``checkpoint()``
under the shared folder (``spark.checkpoint.dir``), so it is computed once,
survives executor loss and has no lineage back to the big input.  One
distributed aggregate then counts its rows and estimates its bytes.  The side
gets the broadcast hint only when that estimate is below the session's own
broadcast threshold and the row limit.  A larger side is joined normally:
a sort-merge join, with AQE splitting skewed partitions.  This way the big
side is never shuffled just because the planner could not know the lookup
side was small.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from quotelake.session import shared_dir

DEFAULT_MAX_ROWS = 1_000_000
_FIXED_BYTES = 16          # per value: eight bytes and its share of the row's overhead
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative means never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    m = re.fullmatch(r"(-?\d+)([bkmgt]?)b?", text)
    return int(m[1]) * _UNITS[m[2]] if m else -1


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) by one partial/final aggregate."""
    wide = [f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    size = F.lit(_FIXED_BYTES * len(df.columns)).cast("bigint")
    for c in wide:
        size = size + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def checked_broadcast(small: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``small`` checkpointed, with a broadcast hint only when its measured size allows one."""
    spark = small.sparkSession
    shared_dir(spark)                         # make sure a checkpoint folder exists
    fixed = small.checkpoint(eager=True)
    rows, size = measured(fixed)
    fits = rows <= max_rows and size <= broadcast_threshold(spark)
    return F.broadcast(fixed) if fits else fixed


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str] | Sequence[Column],
                how: str = "left", max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """Join rows to a per-key lookup; ``max_rows=None`` leaves the choice to the planner/AQE."""
    side = checked_broadcast(lookup, max_rows) if max_rows else lookup
    return rows.join(side, list(on), how)
