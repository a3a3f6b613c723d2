"""op12: the chart against all spans and splits, against every edit sequence, and whole results against plain Python."""
import functools
import hashlib
import itertools
import os
import random
import re
import sys
import zlib

sys.path.insert(0, os.path.dirname(__file__))

from quotelake.llm.conversation_repair import (PLACES, EditCosts, RepairGrammar, Segment, Walk, _cell_rows, accepted,  # noqa: E402
                                               damaged, join_spans, joined_segments, plain_rows, repair_table, repaired_rows, repairs)

LEGAL = re.compile(r"(s?(ua)+)?\Z")
INK = re.compile(r"[^\x20\x09-\x0D]")


def full_chart(symbols, grammar):
    """The chart over all spans and all their splits."""
    n, chart = len(symbols), {}
    for size in range(1, n + 1):
        for i in range(n - size + 1):
            if size == 1:
                chart[i, i + 1] = grammar.closed_row(symbols[i])
                continue
            best = [None] * (PLACES * PLACES)
            for k in range(i + 1, i + size):
                for at, c in enumerate(join_spans(chart[i, k], chart[k, i + size])):
                    if c is not None and (best[at] is None or c < best[at]):
                        best[at] = c
            chart[i, i + size] = tuple(best)
    return chart[0, n] if n else grammar.empty


def every_edit(symbols):
    """Cheapest (cost, audit) over all edit sequences with up to two insertions at each place."""
    best = None
    inserts = [()] + [(a,) for a in "ua"] + list(itertools.product("ua", repeat=2))
    options = []
    for s in symbols:
        rows = [("D", "", 4)]
        if s != "D":
            extra = 3 if s.isupper() else 0
            rows += [("K", s.lower(), extra)] if s.lower() != "x" else []
            rows += [("R", r, 3 + extra) for r in "ua"]
        options.append(rows)
    for places in itertools.product(inserts, repeat=len(symbols) + 1):
        for rows in itertools.product(*options):
            audit, out, cost = "", "", 3 * sum(map(len, places))
            for k in range(len(symbols) + 1):
                audit += "I" * len(places[k])
                out += "".join(places[k])
                if k < len(symbols):
                    audit += rows[k][0]
                    out += rows[k][1]
                    cost += rows[k][2]
            if LEGAL.match(out) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def test_one_split_per_span_equals_the_full_chart():
    grammar, rng = RepairGrammar(), random.Random(3)
    for _ in range(300):
        s = "".join(rng.choice("suaxSUAXD") for _ in range(rng.randint(0, 14)))
        assert grammar.cells(s) == full_chart(s, grammar)


def test_cells_are_the_cheapest_of_all_edits():
    grammar = RepairGrammar()
    for n in range(3):
        for s in itertools.product("suaxSUAXD", repeat=n):
            assert accepted(grammar.cells("".join(s))) == every_edit("".join(s))
    rng = random.Random(4)
    for _ in range(12):
        s = "".join(rng.choice("suaxUAD") for _ in range(3))
        assert accepted(grammar.cells(s)) == every_edit(s)


def test_memo_and_other_costs():
    tight = RepairGrammar(memo_span=4, memo_size=3)
    s = "".join(random.Random(1).choice("suaxUAD") for _ in range(200))
    assert tight.cells(s) == RepairGrammar().cells(s)
    assert accepted(RepairGrammar(EditCosts(insert=1)).cells("uu")) == (2, "KIKI")


def test_segments_join_to_the_whole():
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(6)]), rng.randint(1, 2), rng.choice(["s", "u", "a", "t", ""])) for _ in range(40)]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    items = [(t, n, z, f := rng.choice(["none", "blank", "duplicate", "truncated"]),
              "D" if f in ("blank", "duplicate") else (z or "x").replace("t", "x").upper() if f == "truncated"
              else (z or "x").replace("t", "x")) for t, n, z in rows]
    grammar = RepairGrammar()

    def joined(cuts):
        parts = []
        for p, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(items)])):
            seg = Segment()
            for item in items[lo:hi]:
                seg.add(*item)
            parts.append({"part": p, "blank": seg.blank, "duplicate": seg.duplicate, "truncated": seg.truncated, "illegal": seg.illegal,
                          "low": seg.low, "high": seg.high, "turns": seg.turns, "first": seg.first, "last": seg.last,
                          "cells": _cell_rows(grammar.cells("".join(seg.symbols)))})
        return joined_segments(parts[::-1])

    whole = joined([])
    for cuts in ([1], [20], [5, 6, 7, 30], list(range(1, 40))):
        assert joined(cuts) == whole


def test_walk_gives_legal_roles():
    walk = Walk("KIDKRI")
    out = [x for role, text in [("system", "a"), ("user", "b"), ("assistant", "c"), ("user", "d")] for x in walk.row(role, text)]
    assert out + list(walk.inserted()) == [("system", "a"), ("user", ""), ("assistant", "c"), ("user", "d"), ("assistant", "")]


def brute(convs, damage=True):
    """{conv_id: row of the result} by plain Python and the full chart."""
    rows = {}
    for conv, turn, role, text in convs:
        got = rows.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20 if damage else 19
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        got += [(turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    out = {}
    for conv, got in rows.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, symbols, n = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in got:
            z = role[:1] if role[:1] in ("s", "u", "a") else "x"
            ink = INK.findall(text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            symbols += "D" if fault in ("blank", "duplicate") else z.upper() if fault else z
        turns = {t for t, _, _ in got if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:]))
        grammar = RepairGrammar()                    # all spans and splits take cubic time: row by row for long ones
        cells = full_chart(symbols, grammar) if len(symbols) < 40 else functools.reduce(join_spans, map(grammar.closed_row, symbols))
        cost, audit = accepted(cells)
        kept, at, final = len(audit.replace("D", "")), 0, []
        for e in audit:
            place = len(final) - kept % 2
            if e == "I":
                final.append(("assistant" if place % 2 else "user") + ":")
                continue
            _, role, text = got[at]
            at += 1
            if e != "D":
                final.append((role if e == "K" else "assistant" if place % 2 else "user") + ":" + text)
        assert LEGAL.match("".join(x[0] for x in final))
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(final).encode()).hexdigest())
    return out


def awkward():
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice(["Yes.", "no", "", " \t", None, "What?!  ", "Same.", "é…", "a.\x85", "long " * 400 + "."]))
            for c in [*range(40), None] for t in [None, *range(rng.randint(0, 12)), 3, 3, 50]]
    rows += [(99, None, "user", "x."), (99, None, "user", "x."), (100, 7, None, None), (101, 5, "system", "Only.")]
    return rows + rows[:30]


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def table(spark, rows):
    full = [(*r, "k", "a", 1, "f", "p", "c", 2) for r in rows]
    return spark.createDataFrame(full, "conv_id bigint, turn bigint, role string, text string, kind string, audit string, "
                                       "part int, first string, edge string, cells string, n int")


def test_whole_results_with_awkward_rows(spark):
    rows = awkward()
    convs = table(spark, rows)
    for damage, frame in ((True, damaged(convs)), (False, plain_rows(convs))):
        got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in repair_table(convs, frame).collect()}
        assert got == brute(rows, damage)


def test_long_conversations_span_partitions(spark):
    """One conversation holds most rows; segments of many range partitions join to one parse."""
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Fine.", "a b", f"Row {t}.", ""])) for t in range(600)]
    rows += [(c, t, "user", "Hm.") for c in (0, 2) for t in range(3)]
    rows += [(1, 700, "user", "Again and again.")] * 500
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in repair_table(table(spark, rows), plain_rows(table(spark, rows))).collect()}
    assert got == brute(rows, False)


def test_repaired_rows_are_legal(spark):
    rows = plain_rows(table(spark, awkward()))
    fixed = repaired_rows(rows, repairs(rows).select("conv_id", "audit")).collect()
    per = {}
    for r in sorted(fixed, key=lambda r: (str(r.conv_id), r.seq)):
        assert r.seq == len(per.setdefault(r.conv_id, ""))
        per[r.conv_id] += r.role[0]
    assert per and all(LEGAL.match(x) for x in per.values())


def test_empty_and_dropped(spark):
    empty = table(spark, awkward()).limit(0)
    assert repair_table(empty, damaged(empty)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    convs = table(spark, [(gone, 0, "user", "x.")])
    assert [tuple(r) for r in repair_table(convs, damaged(convs)).collect()] == \
        [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
