"""Latest row per key, top-k, latest-N and ranked pages.

``latest_per_key`` finds each key's newest time with a hash aggregate (partial
before the shuffle, so a key holding a third of the rows costs no more than any
other), keeps the rows at that time by a null-safe semi-join, and breaks ties
among those few.  The full input is never sorted.  The one-pass ``max_by`` form
and the window form (``row_number() = 1``) give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.operators.joins import checked_broadcast


def latest_per_key(df: DataFrame, key: str | Sequence[str] = "symbol",
                   order: Sequence[str] = ("recorded_at", "row_id"),
                   columns: Sequence[str] | None = None, method: str = "hash") -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple (later wins, then higher id).

    ``method="hash"`` (default) reads two columns for the newest ``order[0]`` per key and
    then streams the input past that small table, which is broadcast only after a size
    check (``joins.checked_broadcast``).  ``method="max_by"`` is one pass, but its struct
    buffers make Spark sort each task's rows.  A NULL key is a key in both, and NULLs in ``order`` come first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    if method == "hash":
        first = order[0]
        newest = checked_broadcast(
            df.groupBy(*keys).agg(F.max(first).alias("_t"))
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_t"))
        cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        cond.append(F.col(first).eqNullSafe(F.col("_t")))
        df = df.join(newest, cond, "left_semi")
    elif method != "max_by":
        raise ValueError(f"unknown method {method!r}")
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*cols), F.struct(*order)).alias("_latest"))
    return picked.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in cols])


def latest_per_key_window(df: DataFrame, key: str | Sequence[str] = "symbol",
                          order: Sequence[str] = ("recorded_at", "row_id"),
                          columns: Sequence[str] | None = None) -> DataFrame:
    """Same rows as ``latest_per_key`` through ``row_number() over (... desc) = 1``."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    ranked = df.withColumn("_rn", F.row_number().over(w))
    return ranked.where(F.col("_rn") == 1).select(*keys, *cols)


def top_k(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    """``ORDER BY by LIMIT k``: planned as TakeOrderedAndProject (per-task top-k, then merge)."""
    return df.orderBy(*by).limit(k)


def ranked_page(df: DataFrame, by: Sequence[Column], per_page: int, page: int) -> DataFrame:
    """Page ``page`` (1-based) of ``per_page`` rows in ``by`` order.

    ``offset`` + ``limit`` plans as a bounded top-(page*per_page) sort, so only
    ``page*per_page`` rows per task reach the final merge.
    """
    if per_page < 1 or page < 1:
        raise ValueError("per_page and page must be >= 1")
    return df.orderBy(*by).offset((page - 1) * per_page).limit(per_page)


def snapshot_page(quotes: DataFrame, ids: Sequence[str] | None, per_page: int = 50,
                  page: int = 1, id_col: str = "symbol") -> DataFrame:
    """Snapshot selection: quotes whose id is in ``ids`` (all when None), by market cap desc."""
    rows = quotes if ids is None else quotes.where(F.col(id_col).isin(list(ids)))
    order = [F.col("market_cap").desc_nulls_last()]
    if "row_id" in quotes.columns:
        order.append(F.col("row_id").asc())
    return ranked_page(rows, order, per_page, page)
