"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed by (source, language, topic) cell.  Raking scales the
cells until the sums over each dimension meet their targets, never above what
a cell has.  A document is then kept with its cell's probability, the raked
share of the cell's tokens.

Every value of a dimension is a margin of its own, however many there are.  The cells stay a table on Spark: a raking step is
an aggregate over one dimension joined back to it.  A table that is measured to be small takes the same
steps in arrays on the driver instead, which gives the same weights sooner.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.joins import checked_broadcast

from .common import WORD_PATTERN, Scratch, ascii_lower, written

NONE = "(none)"          # how a null source or language is shown; a real value of this name stays a value of its own
DIMENSIONS = ("source", "lang", "topic")

# Topics by surface form, first match wins; what matches none is "prose".  A text is only
# searched for a pattern if, lower-cased, it holds one of the marks that every match holds.
TOPICS = (
    ("legal", r"(?i)\b(licen[sc]ed?|copyright|warranty|all rights reserved)\b",
     ("license", "licence", "copyright", "warranty", "all rights reserved")),
    ("table", r"[^\n]\|[^\n]*\|", ("|",)),
    ("contact", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}\.[A-Za-z]", ("@",)),
    ("markup", r"[#$%&*<>]{3}", tuple("#$%&*<>")),
)


@dataclass(frozen=True)
class MixRules:
    """``targets``: per dimension {value: weight}, None standing for null; without one, natural shares to the power
    ``temper``.  Up to ``driver_cells`` cells are raked in arrays, more of them on Spark, with the same result.
    """

    keep_share: float = 0.7        # tokens to keep, as a share of all
    temper: float = 0.7
    targets: dict = field(default_factory=dict)
    topics: tuple = TOPICS
    driver_cells: int = 200_000
    rounds: int = 200
    tolerance: float = 1e-6
    seed: int = 20


def topic_of(text: Column, topics: tuple = TOPICS) -> Column:
    out = None
    lower = ascii_lower(text)
    for name, pattern, marks in topics:
        hit = reduce(or_, [lower.contains(m) for m in marks]) & text.rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.coalesce(F.lit("prose") if out is None else out.otherwise("prose"), F.lit("prose"))


def n_tokens(text: Column) -> Column:
    """Words of the text; an empty or null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def rake(keys: list[tuple], have: np.ndarray, targets: list[dict], rules: MixRules) -> np.ndarray:
    """Tokens to take from each cell: at most ``have``, with sums over each dimension near the targets.

    Targets are weights; values without tokens are left out and the rest rescaled.
    """
    budget = rules.keep_share * have.sum()
    if budget <= 0:
        return np.zeros(len(have))
    dims = []
    for d, target in enumerate(targets):
        number: dict = {}
        at = np.array([number.setdefault(k[d], len(number)) for k in keys])
        natural = np.bincount(at, have, len(number))
        goal = np.array([float(target.get(v, 0.0)) for v in number]) if target else \
            np.where(natural > 0, natural, 0) ** rules.temper
        goal = np.where(natural > 0, goal, 0)
        if goal.sum() <= 0:
            goal = natural
        dims.append((at, goal / goal.sum() * budget))
    take = have * rules.keep_share
    for _ in range(rules.rounds):
        before = take.copy()
        for at, goal in dims:
            now = np.bincount(at, take, len(goal))
            factor = np.divide(goal, now, out=np.zeros(len(goal)), where=now > 0)
            take = np.minimum(take * factor[at], have)
        if np.abs(take - before).max() <= rules.tolerance * budget / len(take):
            break
    return take


def rake_on_spark(cells: DataFrame, targets: list[dict], rules: MixRules) -> DataFrame:
    """(cell columns, tokens, take): the same steps as ``rake`` on a table of cells.

    Each step sums one dimension and joins the sums back; a round is written, so its lineage is one round long.  The
    joins are left to adaptive execution: broadcast when the sums turn out small, else a value with a third of all cells is split.
    """
    scratch = Scratch(cells.sparkSession)
    budget = (cells.agg(F.sum("tokens")).first()[0] or 0) * rules.keep_share
    state = cells.withColumn("take", F.col("tokens") * F.lit(rules.keep_share))
    if budget <= 0:
        return state.withColumn("take", F.lit(0.0))

    def joined(df: DataFrame, side: DataFrame, d: str) -> DataFrame:
        return df.join(side.withColumnRenamed(d, "_value"), F.col(d).eqNullSafe(F.col("_value"))).drop("_value")

    for d, target in zip(DIMENSIONS, targets):
        natural = cells.groupBy(d).agg(F.sum("tokens").cast("double").alias("natural"))
        goal = F.when(F.col("natural") > 0, F.pow("natural", F.lit(rules.temper))).otherwise(0.0)
        if target:
            wanted = cells.sparkSession.createDataFrame([(v, float(w)) for v, w in target.items()], "wanted string, weight double")
            natural = natural.join(wanted, F.col(d).eqNullSafe(F.col("wanted")), "left").drop("wanted")
            goal = F.when(F.col("natural") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0)
        side = scratch.written(natural.select(d, "natural", goal.alias("goal")), "mix-goals")
        total = side.agg(F.sum("goal").alias("goal"), F.sum("natural").alias("natural")).first()
        share = F.col("goal") / total["goal"] if total["goal"] > 0 else F.col("natural") / total["natural"]
        state = joined(state, side.select(d, (share * budget).alias("goal_" + d)), d)
    state = scratch.written(state, "mix-round")
    n = state.count()
    for _ in range(rules.rounds):
        after = state.withColumn("before", F.col("take"))
        for d in DIMENSIONS:
            now = after.groupBy(d).agg(F.sum("take").alias("now"))
            scaled = F.when(F.col("now") > 0, F.col("take") * F.col("goal_" + d) / F.col("now")).otherwise(0.0)
            after = joined(after, now, d).withColumn("take", F.least(scaled, F.col("tokens").cast("double"))).drop("now")
        after = scratch.written(after, "mix-round")
        moved = after.agg(F.max(F.abs(F.col("take") - F.col("before")))).first()[0]
        scratch.drop(state)
        state = after.drop("before")
        scratch.paths[id(state)] = (state, scratch.paths.pop(id(after))[1])
        if moved <= rules.tolerance * budget / n:
            break
    return state


def _keyed(docs: DataFrame, rules: MixRules, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"),
                       topic_of(F.col(text_col), rules.topics).alias("topic"),
                       n_tokens(F.col(text_col)).alias("n_tokens"))


def calibrate(docs: DataFrame, rules: MixRules = MixRules(), text_col: str = "text",
              source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Table of cells: source, lang (null as it is), topic, tokens, probability, weight."""
    spark = docs.sparkSession
    cells = written(_keyed(docs, rules, text_col, source_col, lang_col).groupBy(*DIMENSIONS)
                    .agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    targets = [rules.targets.get(d, {}) for d in DIMENSIONS]
    if cells.count() <= rules.driver_cells:
        got = cells.collect()                          # measured
        got.sort(key=lambda r: [(r[d] is not None, r[d]) for d in DIMENSIONS])
        keys, have = [tuple(r[d] for d in DIMENSIONS) for r in got], np.array([float(r["tokens"] or 0) for r in got])
        take = rake(keys, have, targets, rules)
        taken = spark.createDataFrame([(*k, int(h), float(t)) for k, h, t in zip(keys, have, take)],
                                      "source string, lang string, topic string, tokens bigint, take double")
    else:
        taken = rake_on_spark(cells, targets, rules)
    probability = F.when(F.col("tokens") > 0, F.col("take") / F.col("tokens")).otherwise(F.lit(rules.keep_share))
    return taken.select(*DIMENSIONS, "tokens", probability.alias("probability"), (probability / rules.keep_share).alias("weight"))


def _chance(*cols: Column) -> Column:
    """A number in [0, 1) that depends on nothing but ``cols``."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def mixed(docs: DataFrame, rules: MixRules = MixRules(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Every row with its cell: _row (the input columns), source, lang, topic, n_tokens, weight, probability, kept.

    Null sources and languages are values of their own; a null or empty text counts no
    token.  The draw depends on id, text and seed only, so repeated rows share it.
    """
    cells = calibrate(docs, rules, text_col, source_col, lang_col)
    rows = _keyed(docs, rules, text_col, source_col, lang_col)
    cells = cells.select(*[F.col(d).alias("_c" + d) for d in DIMENSIONS], "probability", "weight")
    same = [F.col(d).eqNullSafe(F.col("_c" + d)) for d in DIMENSIONS]
    chance = _chance(F.lit(rules.seed), F.col(f"_row.`{id_col}`"), F.col(f"_row.`{text_col}`"))
    shown = [F.coalesce(F.col(d), F.lit(NONE)).alias(d) for d in DIMENSIONS]
    return (rows.join(checked_broadcast(cells), same)
            .select("_row", *shown, "n_tokens", "weight", "probability",
                    (chance < F.col("probability")).alias("kept")))


def mix_table(docs: DataFrame, rules: MixRules = MixRules(), id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability, kept of every row."""
    out = mixed(docs, rules, id_col, text_col, source_col, lang_col)
    return out.select(F.col(f"_row.`{id_col}`").alias("doc_id"), *DIMENSIONS, "n_tokens", "weight", "probability", "kept")


def mix_filter(docs: DataFrame, rules: MixRules = MixRules(), id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The sampled rows with the columns of ``docs``."""
    out = mixed(docs, rules, id_col, text_col, source_col, lang_col).filter("kept")
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
