"""Point-in-interval joins without a nested loop.

``start <= t < end`` is no equality, so Spark would compare every row with every interval of its key.  Here time is cut
into aligned bins at powers of two of ``bin_width``: an interval is filed at the smallest level whose bins are as
long as it is, where it touches two bins at most; a row is looked up in its one bin of each level
that occurs.  The join is an equality on (keys, level, bin), followed by the exact condition.  Long and short intervals
thus cost the same two copies, and a hot key is spread over its bins.  Both sides are shuffled and sorted: Spark's size
estimate does not see how often a row is looked up, so a side that looks small would be gathered in the driver.

The pairs grow with rows times intervals.  Who wants totals of them only need not make them (``totals``): rows are
totalled per bin and level first, an interval is cut into whole bins, two of a level at most, and the two ends
inside a bin, which take running totals of the bin's rows.  Rows and intervals then cost a logarithm each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.scalars import duration_micros

MAX_LEVEL = 30              # longer intervals touch more bins of this level


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def interval_join(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str = "recorded_at",
                  start: str = "window_start", end: str = "window_end", bin_width: str = "1 minute",
                  how: str = "inner", row_id: str | None = None, by: Sequence[str] | None = None,
                  totals: Mapping[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """``rows`` joined to every interval of the same keys that holds their time (``start <= time < end``).

    Columns: those of ``rows``, then those of ``intervals`` without the keys (names must differ).  Rows with a null
    time or key, and intervals with a null bound or without length, match nothing.  With ``how="left"`` rows without
    any interval are kept with nulls; ``row_id`` must then name a unique column of ``rows``.

    With ``totals`` the result is the inner join grouped by ``by`` (keys and columns of ``intervals``), without a row for
    each pair: a column for each name, from (function, column of ``rows``).  Functions: count (column None: of rows),
    min, max, and sum of integers or decimals (of doubles it would depend on the order).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if how == "left" and row_id is None:
        raise ValueError("a left interval join needs row_id, a unique column of rows")
    width = duration_micros(bin_width)
    top = min(MAX_LEVEL, 61 - width.bit_length())
    values = [c for c in intervals.columns if c not in keys]
    clash = set(values) & set(rows.columns)
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(sorted(clash))}")
    if totals is not None:
        if how == "left":
            raise ValueError("totals are of an inner join")
        unknown = set(by or ()) - set(keys) - set(values)
        if unknown or not by:
            raise ValueError(f"totals need by, keys or columns of intervals, not {', '.join(sorted(unknown)) or 'nothing'}")
        return _totals(rows, intervals, keys, time, start, end, width, by, totals)
    a, b = _micros(F.col(start)), _micros(F.col(end))
    length = F.ceil((b - a) / F.lit(width))
    level = F.least(F.greatest(F.ceil(F.log2(length.cast("double"))), F.lit(0)), F.lit(top)).cast("int")
    filed = (intervals.filter(F.col(start) < F.col(end)).withColumn("_level", level)
             .withColumn("_size", F.lit(width).cast("bigint") * F.expr("shiftleft(1L, _level)"))
             .withColumn("_bin", F.explode(F.sequence(F.floor(a / F.col("_size")), F.floor((b - 1) / F.col("_size")))))
             .drop("_size"))
    levels = sorted(r[0] for r in filed.select("_level").distinct().collect())      # at most MAX_LEVEL + 1
    places = F.array(*[F.struct(F.lit(n).alias("_level"), F.floor(_micros(F.col(time)) / F.lit(width << n)).alias("_bin"))
                       for n in levels]) if levels else F.array().cast("array<struct<_level:int,_bin:bigint>>")
    looked = rows.filter(F.col(time).isNotNull()).select("*", F.inline(places))
    side = filed.select(*[F.col(k).alias("_k" + str(i)) for i, k in enumerate(keys)], *values,
                        F.col("_level").alias("_l"), F.col("_bin").alias("_b"))
    same = [F.col(k) == F.col("_k" + str(i)) for i, k in enumerate(keys)]
    same += [F.col("_level") == F.col("_l"), F.col("_bin") == F.col("_b"), F.col(time) >= F.col(start), F.col(time) < F.col(end)]
    hit = looked.join(side.hint("merge"), same).select(*rows.columns, *values)
    if how == "inner":
        return hit
    missed = rows.join(hit.select(F.col(row_id).alias("_hit")).distinct(), F.col(row_id) == F.col("_hit"), "left_anti")
    nulls = [F.lit(None).cast(intervals.schema[c].dataType).alias(c) for c in values]
    return hit.unionByName(missed.select(*rows.columns, *nulls))


def _bin(t: Column, width: int) -> Column:
    return ((t - F.pmod(t, F.lit(width))) / F.lit(width)).cast("bigint")


def _pieces(top: int) -> Column:
    """The whole bins ``_a`` (inclusive) to ``_b`` (exclusive) as the fewest aligned bins of the levels 0 to ``top``.

    At each level the first bin is a piece if it is the second of its pair, the last one if it is the first of its pair.
    """
    lo, hi = "-shiftright(-_a, n)", "shiftright(_b, n)"
    return F.expr(f"""filter(flatten(transform(sequence(0, {top}), n -> array(
        named_struct('_level', n, '_bin', if({lo} < {hi} AND ({lo}) % 2 <> 0, {lo}, NULL)),
        named_struct('_level', n, '_bin', if({lo} < {hi} AND {hi} % 2 <> 0, {hi} - 1, NULL))))), p -> p._bin IS NOT NULL)""")


def _totals(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str, start: str, end: str, width: int,
            by: Sequence[str], totals: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    first = {"count": lambda c: F.count(F.lit(1) if c is None else F.col(c)), "sum": lambda c: F.sum(c),
             "min": lambda c: F.min(c), "max": lambda c: F.max(c)}
    for name, (function, column) in totals.items():
        if function not in first or column is None and function != "count":
            raise ValueError(f"{name}: {function} of {column}")
        if function == "sum" and rows.schema[column].dataType.typeName() in ("float", "double"):
            raise ValueError(f"{name}: a sum of {column} would depend on the order of rows")
    kinds = rows.agg(*[first[f](c).alias(n) for n, (f, c) in totals.items()]).schema
    held = {f"_v{i}": (f if f in ("min", "max") else "sum", kinds[n].dataType) for i, (n, (f, _)) in enumerate(totals.items())}
    held["_n"] = ("sum", "bigint")

    def merged(over=None) -> list[Column]:
        return [(first[f](c) if over is None else first[f](c).over(over)).cast(kind).alias(c) for c, (f, kind) in held.items()]

    ks, gs = [f"_k{i}" for i in range(len(keys))], [f"_g{i}" for i in range(len(by))]
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys], F.lit(True))
    named = [F.col(k).alias(a) for k, a in zip(keys, ks)]
    points = (rows.filter(known & F.col(time).isNotNull()).select(*named, _micros(F.col(time)).alias("_t"), *rows.columns)
              .groupBy(*ks, "_t").agg(*[first[f](c).alias(f"_v{i}") for i, (f, c) in enumerate(totals.values())], F.count(F.lit(1)).alias("_n"))
              .withColumn("_bin", _bin(F.col("_t"), width)))
    spans = (intervals.filter(known & (F.col(start) < F.col(end)))
             .select(*named, *[F.col(c).alias(g) for c, g in zip(by, gs)], _micros(F.col(start)).alias("_from"), _micros(F.col(end)).alias("_to"))
             .withColumn("_a", _bin(F.col("_from") + (width - 1), width)).withColumn("_b", _bin(F.col("_to"), width)))
    inside = F.col("_a") > F.col("_b")                 # both ends in one bin
    longest = spans.agg(F.max(F.col("_b") - F.col("_a"))).first()[0] or 0
    top = max(longest, 1).bit_length()
    levels = (points.groupBy(*ks, "_bin").agg(*merged())
              .select(*ks, F.expr(f"inline(transform(sequence(0, {top}), n -> named_struct('_level', n, '_bin', shiftright(_bin, n))))"), *held)
              .groupBy(*ks, "_level", "_bin").agg(*merged()))
    whole = spans.filter("_a < _b").select(*ks, *gs, F.inline(_pieces(top)))
    whole = whole.join(levels.hint("merge"), [*ks, "_level", "_bin"]).select(*gs, *held)
    # running totals of a bin's rows, forwards (side 0) up to an end and backwards (side 1) from a start
    nulls = [F.lit(None).cast(kind).alias(c) for c, (_, kind) in held.items()]
    none = [F.lit(None).cast(spans.schema[g].dataType).alias(g) for g in gs]
    asked = F.array(F.struct(F.lit(0).alias("_side"), (F.col("_to") - 1).alias("_place"), F.col("_b").alias("_bin"), (F.pmod("_to", F.lit(width)) > 0).alias("_open")),
                    F.struct(F.lit(1).alias("_side"), (-F.col("_from")).alias("_place"), (F.col("_a") - 1).alias("_bin"), (F.pmod("_from", F.lit(width)) > 0).alias("_open")))
    ends = spans.filter(~inside).select(*ks, *gs, F.inline(asked), *nulls).filter("_open").withColumn("_ask", F.lit(True)).drop("_open")
    both = F.array(F.struct(F.lit(0).alias("_side"), F.col("_t").alias("_place")), F.struct(F.lit(1).alias("_side"), (-F.col("_t")).alias("_place")))
    line = ends.unionByName(points.select(*ks, *none, "_bin", F.inline(both), *held, F.lit(False).alias("_ask")))
    so_far = Window.partitionBy(*ks, "_side", "_bin").orderBy("_place").rangeBetween(Window.unboundedPreceding, 0)
    edges = line.select(*gs, "_ask", *merged(so_far)).filter("_ask AND _n > 0").select(*gs, *held)
    short = spans.filter(inside).withColumn("_bin", F.col("_b")).join(points.hint("merge"), [*ks, "_bin"])
    short = short.filter("_t >= _from AND _t < _to").select(*gs, *held)
    out = whole.unionByName(edges).unionByName(short).groupBy(*gs).agg(*merged())
    return out.select(*[F.col(g).alias(c) for g, c in zip(gs, by)], *[F.col(f"_v{i}").alias(n) for i, n in enumerate(totals)])
