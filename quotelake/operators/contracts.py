"""Table contracts as DataFrame operators: split, cast, default, uniqueness.

Each check is a predicate evaluated in the same scan as the data; accepted and
rejected rows are two filters of one (optionally persisted) plan, and the
summary counts are ``count_if`` aggregates, so a contract never needs a join
or a second pass over the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The table precisions, column -> (precision, scale).
COIN_PRICES_DECIMALS = {
    "price_usd": (18, 8),
    "market_cap": (24, 2),
    "volume_24h": (24, 2),
    "price_change_pct_24h": (8, 4),
}
MARKET_STATS_DECIMALS = {"volatility_score": (10, 4)}

# NOT NULL columns per table (generated ids and defaulted times excluded).
NOT_NULL = {
    "coin_prices": ["symbol", "name", "price_usd", "recorded_at"],
    "market_stats": ["symbol", "window_start", "window_end"],
    "pipeline_logs": ["stage", "status"],
}


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def null_reason(columns: Sequence[str]) -> Column:
    """Name of the first NULL column among ``columns`` (NULL when none is)."""
    expr = None
    for c in columns:
        expr = F.when(F.col(c).isNull(), f"null_{c}") if expr is None else \
            expr.when(F.col(c).isNull(), f"null_{c}")
    return expr


def split_not_null(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected-with-reason) for a NOT NULL contract."""
    bad = any_null(columns)
    return df.where(~bad), df.where(bad).withColumn("reject_reason", null_reason(columns))


def not_null_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: total, accepted, rejected and the NULL count of every column."""
    bad = any_null(columns)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~bad).alias("accepted"),
        F.count_if(bad).alias("rejected"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def in_domain(column: str, allowed: Sequence[str]) -> Column:
    return F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))


def split_domain(df: DataFrame, column: str, allowed: Sequence[str]
                 ) -> tuple[DataFrame, DataFrame]:
    ok = in_domain(column, allowed)
    return df.where(ok), df.where(~ok)


def domain_summary(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows per (value, accepted) for a domain check."""
    return df.groupBy(F.col(column), in_domain(column, allowed).alias("accepted")) \
             .agg(F.count(F.lit(1)).alias("rows"))


def cast_decimals(df: DataFrame, spec: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Cast columns to DECIMAL(p,s) with ``try_cast``; flag rows where a value did not fit.

    ``decimal_reject`` is true when some input was non-NULL but its cast is
    NULL (overflow), so such rows can be quarantined instead of failing the job.
    """
    casted = {c: F.col(c).try_cast(f"decimal({p},{s})") for c, (p, s) in spec.items()}
    overflow = reduce(or_, [F.col(c).isNotNull() & casted[c].isNull() for c in spec])
    return df.select(
        *[casted[c].alias(c) if c in casted else F.col(c) for c in df.columns],
        F.coalesce(overflow, F.lit(False)).alias("decimal_reject"))


def decimal_reason(spec: Mapping[str, tuple[int, int]]) -> Column:
    """``overflow_<column>`` of the first value that does not fit its precision (NULL when all fit)."""
    expr = None
    for c, (p, s) in spec.items():
        bad = F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
        expr = F.when(bad, f"overflow_{c}") if expr is None else expr.when(bad, f"overflow_{c}")
    return expr


def split_contract(df: DataFrame, columns: Sequence[str], required: Sequence[str],
                   decimals: Mapping[str, tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """(``columns`` of the rows that meet NOT NULL and precision, cast; the other rows with a reason)."""
    marked = df.withColumn("reject_reason", F.coalesce(null_reason(required), decimal_reason(decimals)))
    good = marked.where(F.col("reject_reason").isNull()).select(*columns).withColumns(
        {c: F.col(c).try_cast(f"decimal({p},{s})") for c, (p, s) in decimals.items()})
    return good, marked.where(F.col("reject_reason").isNotNull())


def enforce(df: DataFrame, contract: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that meet a record contract, in its columns and types; the other rows with ``reject_reason``).

    A missing column raises.  A value that cannot be cast, or a NULL where the contract allows none, rejects its row.
    """
    missing = [f.name for f in contract if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    reason = None
    for f in contract:
        cast = F.col(f.name).try_cast(f.dataType)
        bad = [(F.col(f.name).isNotNull() & cast.isNull(), f"bad_{f.name}")]
        if not f.nullable:
            bad.append((F.col(f.name).isNull(), f"null_{f.name}"))
        for test, name in bad:
            reason = F.when(test, name) if reason is None else reason.when(test, name)
    marked = df.withColumn("reject_reason", reason)
    good = marked.where(F.col("reject_reason").isNull()).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract])
    return good, marked.where(F.col("reject_reason").isNotNull())


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill NULLs with column defaults (e.g. ``volume_spike`` -> false)."""
    return df.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def stamp_ids(df: DataFrame, id_col: str = "id", time_col: str | None = "created_at"
              ) -> DataFrame:
    """Generated surrogate id (uuid) and creation time, as the table defaults give them."""
    out = df.withColumn(id_col, F.expr("uuid()"))
    return out.withColumn(time_col, F.current_timestamp()) if time_col else out


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity (partial aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")) \
             .where(F.col("copies") > 1)
