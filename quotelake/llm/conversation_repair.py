"""Conversation structure repair by weighted interval parsing.

The rows of a conversation become a string of symbols, one per row.  A repair grammar in Chomsky
normal form derives from that string every legal sequence of roles, ``(s?(ua)+)?``, by
keeping, re-roling, deleting and inserting rows.  Its nonterminals ``X[p,q]`` say that the span's
output takes the role sequence from place p to place q; its binary rules are ``X[p,q] -> X[p,r] X[r,q]``.
A chart cell holds the cheapest (cost, audit) of its nonterminal over its span.  Cells of one row
are closed under insertion on both sides, so an inserted row needs no span of its own.

The chart is filled bottom-up by span length: 1, 2, 4, ... rows.  All split points of a span give the
same cell in this grammar (the rules compose paths), so one split per span suffices and
the work grows linearly with a conversation; a test compares it with the chart of all spans and splits.
(cost, audit) minima compose as well: audits of one span with one cost are never prefixes of each other,
because the letters fix the cost, so the smaller one stays smaller whatever follows.

Rows are range-partitioned by their place in the conversation, so a conversation with a third of all
rows is parsed by many tasks and its spans are joined afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

# Places in the role sequence: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
PLACES = 4
MOVES = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
LEGAL_PAIRS = ("su", "ua", "au")
FULL_ROLE = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"

Cells = tuple                       # PLACES * PLACES entries: (cost, audit) or None


@dataclass(frozen=True)
class EditCosts:
    keep: int = 0
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3              # a truncated row that stays


# --- the grammar -----------------------------------------------------------------

# X[p,q] -> X[p,r] X[r,q] as positions in a cell tuple: left, right, result.
BINARY = tuple((p * PLACES + r, r * PLACES + q, p * PLACES + q)
               for p in range(PLACES) for r in range(PLACES) for q in range(PLACES))


def _least(options: list) -> Cells:
    cells = [None] * (PLACES * PLACES)
    for at, cost, audit in options:
        if cells[at] is None or (cost, audit) < cells[at]:
            cells[at] = (cost, audit)
    return tuple(cells)


def join_spans(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans together."""
    out = [None] * (PLACES * PLACES)
    for i, j, k in BINARY:
        a, b = left[i], right[j]
        if a is None or b is None:
            continue
        cost, best = a[0] + b[0], out[k]
        if best is None or cost < best[0]:
            out[k] = (cost, a[1] + b[1])
        elif cost == best[0]:
            audit = a[1] + b[1]
            if audit < best[1]:
                out[k] = (cost, audit)
    return tuple(out)


class RepairGrammar:
    """Cells of symbol strings.  Symbols: ``s u a x`` the role of a sound row (x: any other role),
    ``S U A X`` the same truncated, ``D`` a row that must go."""

    def __init__(self, costs: EditCosts = EditCosts(), memo_span: int = 16, memo_size: int = 50_000):
        self.costs, self.memo_span, self.memo_size = costs, memo_span, memo_size
        self.memo: dict[str, Cells] = {}
        stay = [(p * PLACES + p, 0, "") for p in range(PLACES)]
        insert = [(p * PLACES + q, costs.insert, "I") for role in "ua" for p, q in MOVES[role]]
        self.empty = _least(stay + insert)
        while True:                                   # insertion closure of the empty span
            wider = join_spans(self.empty, self.empty)
            if wider == self.empty:
                break
            self.empty = wider

    def terminal(self, symbol: str) -> Cells:
        """Cells of one row, without insertions around it."""
        c = self.costs
        options = [(p * PLACES + p, c.delete, "D") for p in range(PLACES)]
        if symbol != "D":
            extra = c.truncated if symbol.isupper() else 0
            options += [(p * PLACES + q, c.keep + extra, "K") for p, q in MOVES.get(symbol.lower(), ())]
            options += [(p * PLACES + q, c.rerole + extra, "R") for role in "ua" for p, q in MOVES[role]]
        return _least(options)

    def closed_row(self, symbol: str) -> Cells:
        return join_spans(join_spans(self.empty, self.terminal(symbol)), self.empty)

    def cells(self, symbols: str) -> Cells:
        """Cells of the whole string, bottom-up over spans of 1, 2, 4, ... rows."""
        if not symbols:
            return self.empty
        known = self.memo
        level = []
        for s in symbols:
            if s not in known:
                known[s] = self.closed_row(s)
            level.append(known[s])
        size = 1
        while len(level) > 1:
            above = []
            for k in range(0, len(level) - 1, 2):
                if 2 * size > self.memo_span:
                    above.append(join_spans(level[k], level[k + 1]))
                    continue
                span = symbols[k * size:(k + 2) * size]
                if span not in known:
                    if len(known) >= self.memo_size:
                        known.clear()
                    known[span] = join_spans(level[k], level[k + 1])
                above.append(known[span])
            if len(level) % 2:
                above.append(level[-1])
            level, size = above, 2 * size
        return level[0]


def accepted(cells: Cells) -> tuple[int, str]:
    """The cheapest (cost, audit) that ends in a legal sequence: nothing, or a last assistant."""
    return min(c for c in (cells[0], cells[3]) if c is not None)


# --- rows ------------------------------------------------------------------------

def damaged(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) after the deterministic damage of the query; a null counts as one space."""
    blank = F.lit(" ")
    c = convs.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), blank).alias("role"), F.coalesce(F.col(text_col), blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    d = F.crc32(key) % 20
    text = F.when(d == 1, "").when(d == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(d == 0, 0).when(d == 3, 2).otherwise(1)
    return c.select("conv_id", "turn", F.when(d == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def plain_rows(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) as they are; a null role or text counts as one space."""
    return convs.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))


ORDER = ["conv_id", "turn", "role", "mark"]         # nulls first; rows of one turn by role, then by md5 of the text


def _stripped(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def row_symbols(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, mark): n copies, role initial, symbol, first fault of the first copy.

    ``mark`` is the md5 of the text, so texts do not travel.  Copies are counted before the shuffle; whether an
    equal role and text stood earlier comes from an aggregate per (conversation, role, mark), joined back.
    """
    body = _stripped(F.col("text"))
    slim = rows.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("mark"), (body == "").alias("blank"),
                       (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    items = written(slim.groupBy("conv_id", "turn", "role", "mark").agg(
        F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")), "conversation-items")
    seen = (items.groupBy("conv_id", "role", "mark")
            .agg(F.count(F.lit(1)).alias("places"), F.min("turn").alias("first_turn"),
                 F.bool_or(F.col("turn").isNull()).alias("no_turn"))
            .filter("places > 1")
            .select(*[F.col(c).alias("_" + c) for c in ("conv_id", "role", "mark")], "first_turn", "no_turn"))
    again = items.join(seen, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role"))
                       & (F.col("mark") == F.col("_mark")), "left")
    later = F.coalesce(F.when(F.col("no_turn"), F.col("turn").isNotNull())
                       .otherwise(F.col("turn") > F.col("first_turn")), F.lit(False))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    fault = (F.when(F.col("blank"), "blank").when(later, "duplicate").when(F.col("cut"), "truncated").otherwise("none"))
    return again.select(*ORDER, "n", initial.alias("initial"), fault.alias("fault"),
                        F.when(F.col("blank") | later, "D").when(F.col("cut"), F.upper(letter))
                        .otherwise(letter).alias("symbol"))


# --- segments of conversations ------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal")


class Segment:
    """Neighbouring rows of one conversation: counts, turns, role initials at both ends, symbols."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None                # role initials
        self.low = self.high = None                  # turns
        self.symbols: list[str] = []

    def add(self, turn, n: int, initial: str, fault: str, symbol: str) -> None:
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.illegal += n - 1                        # copies stand side by side
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if fault == "blank":
            self.blank += n
        else:
            self.duplicate += n if fault == "duplicate" else n - 1
            self.truncated += fault == "truncated"
        self.symbols.append(symbol + "D" * (n - 1))


def _gaps(low, high, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def _segment_schema(rows: DataFrame) -> T.StructType:
    whole, text = T.LongType(), T.StringType()
    cell = T.ArrayType(T.StructType([T.StructField("cost", whole), T.StructField("audit", text)]))
    return T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("part", T.IntegerType()),
                         T.StructField("edge", T.BooleanType()), *[T.StructField(c, whole) for c in _COUNTS],
                         T.StructField("low", whole), T.StructField("high", whole), T.StructField("turns", whole),
                         T.StructField("first", text), T.StructField("last", text), T.StructField("cells", cell)])


def _cell_rows(cells: Cells) -> list:
    return [None if c is None else {"cost": c[0], "audit": c[1]} for c in cells]


def segments(symbols: DataFrame, costs: EditCosts = EditCosts()) -> DataFrame:
    """Segments of conversations, parsed where they lie: one per (conversation, range partition).

    Only the first and last conversation of a partition can go on elsewhere (``edge``); all others are whole,
    and keep only the cells from place 0.
    """
    schema = _segment_schema(symbols)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        grammar, part = RepairGrammar(costs), TaskContext.get().partitionId()
        fields = to_arrow_schema(schema)
        out, seg, conv, n_done = [], None, None, 0

        def row(edge: bool) -> dict:
            cells = grammar.cells("".join(seg.symbols))
            return {"conv_id": conv, "part": part, "edge": edge, **{c: getattr(seg, c) for c in _COUNTS},
                    "low": seg.low, "high": seg.high, "turns": seg.turns, "first": seg.first, "last": seg.last,
                    "cells": _cell_rows(cells if edge else cells[:PLACES])}

        for batch in batches:
            names = ("conv_id", "turn", "n", "initial", "fault", "symbol")
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]
            for key, *rest in zip(*columns):
                if seg is None or key != conv:
                    if seg is not None:
                        out.append(row(n_done == 0))
                        n_done += 1
                    seg, conv = Segment(), key
                seg.add(*rest)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=fields)
                out = []
        if seg is not None:
            yield pa.RecordBatch.from_pylist([row(True)], schema=fields)

    return (symbols.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(parse, schema))


def joined_segments(parts: list[dict]) -> dict:
    """One row of the segments of a conversation, in order of their partitions."""
    parts = sorted(parts, key=lambda r: r["part"])
    total = {c: sum(p[c] for p in parts) for c in _COUNTS}
    low = high = cells = last = None
    turns = 0
    for p in parts:
        here = tuple(c and (c["cost"], c["audit"]) for c in p["cells"])
        cells = here if cells is None else join_spans(cells, here)
        if last is not None and last + p["first"] not in LEGAL_PAIRS:
            total["illegal"] += 1
        last = p["last"]
        if p["low"] is not None:
            turns += p["turns"] - (p["low"] == high)
            low = p["low"] if low is None else low
            high = p["high"]
    cost, audit = accepted(cells)
    return {"gaps": _gaps(low, high, turns), **total, "cost": cost, "audit": audit}


def repairs(rows: DataFrame, costs: EditCosts = EditCosts()) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation in ``rows``
    (conv_id, turn, role, text without null roles or texts).

    A conversation that spans several partitions has one segment in each; those few rows are joined per
    conversation.
    """
    parts = written(segments(row_symbols(rows), costs), "conversation-segments")
    start = F.filter(F.array(*[F.col("cells")[q] for q in (0, 3)]), lambda c: c.isNotNull())
    best = F.array_min(start)
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    whole = parts.filter(~F.col("edge")).select(
        "conv_id", gaps.cast("bigint").alias("gaps"), *_COUNTS, best["cost"].alias("cost"), best["audit"].alias("audit"))

    def join(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        got = joined_segments(rows)
        return pa.table({"conv_id": table.column("conv_id")[:1],
                         **{c: pa.array([v], pa.string() if c == "audit" else pa.int64()) for c, v in got.items()}})

    split = parts.filter("edge").groupBy("conv_id").applyInArrow(join, whole.schema)
    return whole.unionByName(split)


# --- the repaired conversations ------------------------------------------------------

class Walk:
    """Applies one audit to the rows of its conversation as they come; yields (role, text)."""

    def __init__(self, audit: str):
        self.audit, self.at, self.out = audit, 0, 0
        length = len(audit) - audit.count("D")
        self.lead = length % 2                        # an odd number of rows starts with system

    def _role(self) -> str:
        return FULL_ROLE["ua"[(self.out - self.lead) % 2]]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield self._role(), ""
            self.at += 1
            self.out += 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield (role if edit == "K" else self._role()), text
            self.out += 1


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of the repaired rows in order; (conv_id, None, None) ends a conversation."""
    walk = conv = None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "audit", "role", "text")]
        for key, audit, role, text in zip(*columns):
            if audit is not None:
                if walk is not None:
                    for r, t in walk.inserted():
                        yield conv, r, t
                    yield conv, None, None
                walk, conv = Walk(audit), key
            else:
                for r, t in walk.row(role, text):
                    yield conv, r, t
    if walk is not None:
        for r, t in walk.inserted():
            yield conv, r, t
        yield conv, None, None


def _audited(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows of every conversation in order behind its audit, one partition per conversation."""
    kind = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("mark"),
                       "text", F.lit(None).cast("string").alias("audit"))
    none = F.lit(None).cast("string")
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                          none.alias("role"), none.alias("mark"), none.alias("text"), "audit")
    order = ["conv_id", "kind", *ORDER[1:]]
    return kind.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text): the repaired conversations, rows numbered from 0."""
    schema = T.StructType([rows.schema["conv_id"], T.StructField("seq", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        fields, out, seq, held = to_arrow_schema(schema), [], 0, 0
        for conv, role, text in _walked(batches):
            if role is None:
                seq = 0
                continue
            out.append({"conv_id": conv, "seq": seq, "role": role, "text": text})
            seq += 1
            held += len(text)
            if held > 4 << 20 or len(out) >= 20_000:
                yield pa.RecordBatch.from_pylist(out, schema=fields)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=fields)

    return _audited(rows, audits).mapInArrow(emit, schema)


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): sha256 of the repaired ``role:text`` rows joined by newlines.

    The hash of one text is one stream, so a conversation is read by one task, row by row and without holding it.
    """
    schema = T.StructType([rows.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        fields, out, sha, n = to_arrow_schema(schema), [], hashlib.sha256(), 0
        for conv, role, text in _walked(batches):
            if role is None:
                out.append({"conv_id": conv, "repaired_sha256": sha.hexdigest()})
                sha, n = hashlib.sha256(), 0
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema=fields)
                    out = []
                continue
            sha.update((("\n" if n else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
            n += 1
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=fields)

    return _audited(rows, audits).mapInArrow(digest, schema)


def repair_table(convs: DataFrame, rows: DataFrame, costs: EditCosts = EditCosts(), id_col: str = "conv_id") -> DataFrame:
    """One row per conversation id in ``convs``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256, over its ``rows`` (conv_id, turn, role, text).

    A conversation without rows has zeros, an empty audit and the hash of the empty text.  Rows with a null id
    are one conversation, with a null turn they come first, and rows of one turn are taken by role, then by the md5
    of the text; equal rows stand side by side.  A role that starts with neither s, u nor a can only be re-roled or
    deleted.  Very long conversations are parsed in segments.
    """
    rows = written(rows, "conversation-rows")
    found = written(repairs(rows, costs), "conversation-repairs")
    digests = repaired_digests(rows, found.select("conv_id", "audit"))
    ids = convs.select(F.col(id_col).alias("conv_id")).distinct()
    values = ["gaps", *_COUNTS, "cost"]
    per = (found.select("conv_id", *values, "audit", F.lit(None).cast("string").alias("repaired_sha256"))
           .unionByName(digests.select("conv_id", *[F.lit(None).cast("bigint").alias(c) for c in values],
                                       F.lit(None).cast("string").alias("audit"), "repaired_sha256"))
           .unionByName(ids.select("conv_id", *[F.lit(None).cast("bigint").alias(c) for c in values],
                                   *[F.lit(None).cast("string").alias(c) for c in ("audit", "repaired_sha256")])))
    nothing = hashlib.sha256(b"").hexdigest()
    return per.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("bigint")).alias(c) for c in values],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"))
