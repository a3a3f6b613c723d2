"""Sums, means and deviations that do not depend on the order of addition.

A double sum depends on the order in which partial sums meet, so a mean on a rounding tie, a flag at the
mean or a rounded deviation can come out either way.  Here every value is cut at fixed exponents into
whole numbers of 28 bits (bins), and each bin is summed as a 64-bit integer: integer sums have no order.  The
bins cover magnitudes below 2^75 (3.7e22) down to bits of 2^-92, so any value from 1e-12 to 1e22 is held
with all its bits; 2^34 rows of one value fit one group.  Squares are split into a double and its exact error and
binned the same way.

``moments_by`` is the aggregate: it returns these sums as one struct per measure (its *moments*).  ``merged``
adds stored moments, ``finished`` turns the sums into double-doubles, once per group, and ``mean``,
``stddev`` and ``above_mean`` read those.  Values off the grid (larger, NaN, infinite, or with bits below the last
bin) are added as plain doubles beside it, so they are never left out.  Expressions are built as SQL text, which costs one
call to the JVM each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT_DIGITS = 8
BITS = 28
VALUE_BINS = [-92 + BITS * i for i in range(6)]       # exponent of each bin
SQUARE_BINS = [-184 + BITS * i for i in range(12)]
_LIMIT = 2.0 ** (VALUE_BINS[-1] + BITS - 1)
_SPLIT = 2.0 ** 27 + 1                                # cuts a double into two halves of 26 bits


def _num(x: float) -> str:
    return f"{x!r}D"


def _on_grid(x: str) -> str:
    low = _num(2.0 ** -VALUE_BINS[0])
    return f"(abs({x}) < {_num(_LIMIT)} AND rint({x} * {low}) / {low} = {x})"


def _cuts(x: str, bins: list[int]) -> list[str]:
    return [f"rint({x} * {_num(2.0 ** -b)})" for b in bins]


def _whole(low: str, high: str | None) -> str:
    """The whole number of one bin, from the cuts at its own and at the next exponent."""
    return f"floor({low} - {high} * {_num(2.0 ** BITS)})" if high else f"floor({low})"


def _array(items: Sequence[str]) -> str:
    return f"array({', '.join(items)})"


# --- the aggregate -----------------------------------------------------------------

def moments_by(df: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, bool], *extra: Column) -> DataFrame:
    """One row per group: the keys, ``<column>__m`` per measure and the ``extra`` aggregates.

    ``measures`` maps a numeric column to whether its squares are needed.  Moments are struct(n, bins, off, off_sum,
    top[, squares, off_squares]) of the values that are not null: ``off`` counts values off the grid, ``top`` is the
    largest value.  Whole numbers beyond 2^53 count as their nearest double.
    """
    layers: list[list[str]] = [[] for _ in range(6)]
    states = []
    for k, (column, squares) in enumerate(measures.items()):
        x, v, h, p, e = (f"__{name}{k}" for name in "xvhpe")
        layers[0].append(f"CAST(`{column}` AS DOUBLE) AS {x}")
        layers[1].append(f"coalesce({_on_grid(x)}, true) AS __on{k}")
        layers[2].append(f"coalesce(CASE WHEN __on{k} THEN {x} END, 0D) AS {v}")
        cuts = [f"__c{k}_{i}" for i in range(len(VALUE_BINS))]
        layers[3] += [f"{c} AS {name}" for c, name in zip(_cuts(v, VALUE_BINS), cuts)]
        fields = [f"'n', count({x})", "'bins', " + _array([f"sum({_whole(a, b)})" for a, b in zip(cuts, [*cuts[1:], None])]),
                  f"'off', count_if(NOT __on{k})", f"'off_sum', sum(CASE WHEN NOT __on{k} THEN {x} ELSE 0D END)", f"'top', max({x})"]
        if squares:
            layers[3].append(f"{v} * {_num(_SPLIT)} - ({v} * {_num(_SPLIT)} - {v}) AS {h}")
            layers[4] += [f"{v} * {v} AS {p}", f"(({h} * {h} - {v} * {v}) + {h} * ({v} - {h}) * 2D) + ({v} - {h}) * ({v} - {h}) AS {e}"]
            pairs = []
            for part in (p, e):
                names = [f"{part}_{i}" for i in range(len(SQUARE_BINS))]
                layers[5] += [f"{c} AS {name}" for c, name in zip(_cuts(part, SQUARE_BINS), names)]
                pairs.append([_whole(a, b) for a, b in zip(names, [*names[1:], None])])
            fields += ["'squares', " + _array([f"sum({a} + {b})" for a, b in zip(*pairs)]),
                       f"'off_squares', sum(CASE WHEN NOT __on{k} THEN {x} * {x} ELSE 0D END)"]
        states.append(F.expr(f"named_struct({', '.join(fields)})").alias(f"{column}__m"))
    for layer in layers:
        if layer:
            df = df.selectExpr("*", *layer)
    return df.groupBy(*keys).agg(*states, *extra)


def merged(measures: Mapping[str, bool]) -> list[Column]:
    """Aggregates over rows that hold ``<column>__m``: the moments of everything behind them, under the same names."""
    def total(m: str, name: str, bins: list[int]) -> str:
        return f"'{name}', " + _array([f"sum({m}.{name}[{i}])" for i in range(len(bins))])

    states = []
    for column, squares in measures.items():
        m = f"`{column}__m`"
        fields = [f"'n', sum({m}.n)", total(m, "bins", VALUE_BINS), f"'off', sum({m}.off)", f"'off_sum', sum({m}.off_sum)",
                  f"'top', max({m}.top)"]
        if squares:
            fields += [total(m, "squares", SQUARE_BINS), f"'off_squares', sum({m}.off_squares)"]
        states.append(F.expr(f"named_struct({', '.join(fields)})").alias(f"{column}__m"))
    return states


# --- per group ---------------------------------------------------------------------

def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _pair(hi: str, lo: str) -> str:
    return f"named_struct('hi', {hi}, 'lo', {lo})"


def _total(sums: str, bins: list[int]) -> str:
    """Bin sums as a double-double: their halves added from the largest bin down, with the error of each addition."""
    parts = []
    for i in reversed(range(len(bins))):
        high = f"shiftright({sums}[{i}], 32)"
        parts += [f"CAST({high} AS DOUBLE) * {_num(2.0 ** (bins[i] + 32))}",
                  f"CAST({sums}[{i}] - shiftleft({high}, 32) AS DOUBLE) * {_num(2.0 ** bins[i])}"]
    s = "(a.hi + y)"
    error = f"((a.hi - ({s} - ({s} - a.hi))) + (y - ({s} - a.hi)) + a.lo)"
    step = _let("t", _pair(s, error), _pair("t.hi + t.lo", "t.lo - ((t.hi + t.lo) - t.hi)"))
    return f"aggregate({_array(parts)}, {_pair('0D', '0D')}, (a, y) -> {step})"


def _product(a: str, b: str) -> str:
    """Exact product of two doubles as a double-double."""
    def halves(x: str) -> tuple[str, str]:
        high = f"(v.{x} * {_num(_SPLIT)} - (v.{x} * {_num(_SPLIT)} - v.{x}))"
        return high, f"(v.{x} - {high})"

    (ah, al), (bh, bl) = halves("a"), halves("b")
    error = f"((({ah} * {bh} - v.a * v.b) + {ah} * {bl} + {al} * {bh}) + {al} * {bl})"
    return _let("v", f"named_struct('a', {a}, 'b', {b})", _pair("v.a * v.b", error))


def finished(df: DataFrame, measures: Mapping[str, bool]) -> DataFrame:
    """Adds ``<column>__t`` (the sum) and, with squares, ``<column>__q`` (their sum) as struct(hi, lo)."""
    out = []
    for column, squares in measures.items():
        out.append(f"{_total(f'`{column}__m`.bins', VALUE_BINS)} AS `{column}__t`")
        if squares:
            out.append(f"{_total(f'`{column}__m`.squares', SQUARE_BINS)} AS `{column}__q`")
    return df.selectExpr("*", *out)


def baseline(df: DataFrame, keys: Sequence[str], column: str, *kept: str) -> DataFrame:
    """Of a finished measure only what ``above_mean`` reads, beside ``keys`` and the ``kept`` columns: the side of a join."""
    return df.select(*keys, *kept, F.expr(f"named_struct('n', `{column}__m`.n, 'off', `{column}__m`.off, 'off_sum', "
                                          f"`{column}__m`.off_sum)").alias(f"{column}__m"), f"{column}__t")


def _mean_of_units(units: str, n: str, digits: int) -> str:
    """``units / n`` (whole units of 10^-8), rounded half away from zero to ``digits`` places, as a double."""
    step = f"(CAST({n} AS DECIMAL(38,0)) * CAST({10 ** (UNIT_DIGITS - digits)} AS DECIMAL(38,0)))"
    twice = f"(abs({units}) * CAST(2 AS DECIMAL(38,0)) + {step})"
    double = f"({step} * CAST(2 AS DECIMAL(38,0)))"
    whole = f"CAST(({twice} - {twice} % {double}) / {double} AS DECIMAL(38,0))"
    return f"signum({units}) * CAST({whole} AS DOUBLE) / {_num(float(10 ** digits))}"


def _mean(m: str, t: str, digits: int | None) -> str:
    plain = f"((CASE WHEN {m}.off > 0 THEN {t}.hi + {m}.off_sum ELSE {t}.hi END) / {m}.n)"
    if digits is None or digits > UNIT_DIGITS:
        return f"CASE WHEN {m}.n > 0 THEN {plain if digits is None else f'round({plain}, {digits})'} END"

    def whole(x: str) -> str:                          # a whole double below 2^96 as a decimal
        high = f"floor({x} * {_num(2.0 ** -48)})"
        return (f"(CAST({high} AS DECIMAL(20,0)) * CAST({2 ** 48} AS DECIMAL(18,0)) + "
                f"CAST(CAST({x} - CAST({high} AS DOUBLE) * {_num(2.0 ** 48)} AS BIGINT) AS DECIMAL(20,0)))")

    rest = f"CAST(rint((({t}.hi - rint({t}.hi)) + ({t}.lo - rint({t}.lo))) * {_num(float(10 ** UNIT_DIGITS))}) AS BIGINT)"
    units = (f"CAST(CAST({whole(f'rint({t}.hi)')} + CAST(CAST(rint({t}.lo) AS BIGINT) AS DECIMAL(20,0)) AS DECIMAL(30,0)) "
             f"* CAST({10 ** UNIT_DIGITS} AS DECIMAL(10,0)) + CAST({rest} AS DECIMAL(20,0)) AS DECIMAL(38,0))")
    exact = _let("u", units, _mean_of_units("u", f"{m}.n", digits))
    return (f"CASE WHEN {m}.n > 0 AND {m}.off = 0 AND abs({t}.hi) < 1e28D THEN {exact} "
            f"WHEN {m}.n > 0 THEN round({plain}, {digits}) END")


def mean(column: str, digits: int | None = None) -> Column:
    """The mean of a finished measure; NULL without values.

    Rounded, it is taken from the sum in whole units of 10^-8, half away from zero, so a mean of decimals that lies on a tie
    rounds as the decimals do.  Sums beyond 10^28 and means with values off the grid are rounded as doubles.
    """
    return F.expr(_mean(f"`{column}__m`", f"`{column}__t`", digits))


def stddev(column: str, digits: int | None = None) -> Column:
    """The sample standard deviation of a finished measure with squares; NULL for fewer than two values."""
    m, t, q = f"`{column}__m`", f"`{column}__t`", f"`{column}__q`"
    n = f"CAST({m}.n AS DOUBLE)"
    # n * sum of squares - square of the sum, in double-doubles
    exact = _let("d", f"named_struct('a', {_product(f'{q}.hi', n)}, 'b', {_product(f'{t}.hi', f'{t}.hi')})",
                 f"(d.a.hi - d.b.hi) + ((d.a.lo + {q}.lo * {n}) - (d.b.lo + {t}.hi * {t}.lo * 2D))")
    all_sum = f"({t}.hi + {m}.off_sum)"
    scaled = _let("w", f"CASE WHEN {m}.off = 0 THEN {exact} ELSE ({q}.hi + {m}.off_squares) * {n} - {all_sum} * {all_sum} END",
                  "CASE WHEN isnan(w) THEN w ELSE greatest(w, 0D) END")
    out = f"CASE WHEN {m}.n > 1 THEN sqrt({scaled} / ({n} * ({n} - 1D))) END"
    return F.expr(out if digits is None else f"round({out}, {digits})")


def above_mean(value: str, column: str, factor: float = 1.0) -> Column:
    """Is ``value`` (SQL text) strictly above the mean (times ``factor``) of a finished measure?  False where either is missing.

    Exact on the grid: ``value * n`` is compared with the sum, both unrounded.
    """
    m, t, x = f"`{column}__m`", f"`{column}__t`", f"CAST({value} AS DOUBLE)"
    plain = f"({x} > ({t}.hi + {m}.off_sum) / {m}.n * {_num(factor)})"
    if factor == 1.0:
        exact = _let("p", _product(x, f"CAST({m}.n AS DOUBLE)"), f"(p.hi > {t}.hi OR (p.hi = {t}.hi AND p.lo > {t}.lo))")
        plain = f"CASE WHEN {m}.off = 0 AND {_on_grid(x)} THEN {exact} ELSE {plain} END"
    return F.expr(f"coalesce(CASE WHEN {m}.n > 0 AND {value} IS NOT NULL THEN {plain} END, false)")


def top_above_mean(column: str, factor: float = 1.0) -> Column:
    """Is some value of a finished measure strictly above its mean (times ``factor``)?  False without values."""
    return above_mean(f"`{column}__m`.top", column, factor)


def exact_mean(column: str, digits: int | None) -> Column:
    """Aggregate: the mean of a column rounded to ``digits`` places, the same for any order of the rows; NULL without values.

    For one mean beside other aggregates; ``moments_by`` computes its intermediate values once per row.
    """
    x = f"CAST(`{column}` AS DOUBLE)"
    on = f"coalesce({_on_grid(x)}, true)"
    cuts = _cuts(f"coalesce(CASE WHEN {on} THEN {x} END, 0D)", VALUE_BINS)
    bins = [f"sum({_whole(low, high)})" for low, high in zip(cuts, [*cuts[1:], None])]
    state = (f"named_struct('n', count({x}), 'bins', {_array(bins)}, 'off', count_if(NOT {on}), "
             f"'off_sum', sum(CASE WHEN NOT {on} THEN {x} ELSE 0D END))")
    return F.expr(_let("m", state, _let("t", _total("m.bins", VALUE_BINS), _mean("m", "t", digits))))
