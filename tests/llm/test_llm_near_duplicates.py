import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_cases import case_rows, components, frame, prose, words_of  # noqa: E402

from quotelake.llm.components import connected_components  # noqa: E402
from quotelake.llm.ngram_join import (JoinRules, max_difference, near_duplicate_filter,  # noqa: E402
                                      near_duplicates, segment_signatures, size_bands)
from quotelake.llm.substring_dedup import (PassageRules, compact_windows,  # noqa: E402
                                           near_duplicate_passages, shared_passages)


def sort_key(t):
    return tuple((x is None, x) for x in t)


def joined(df, rules=JoinRules()):
    return sorted((tuple(r) for r in near_duplicates(df, rules).select("doc_id", "n_shingles", "component_id").collect()),
                  key=sort_key)


def test_join_awkward_rows(spark, tmp_path):
    rows = [(d, t) for d, t, _, _ in case_rows()]
    df = frame(spark, case_rows())
    assert joined(df) == sorted(components(rows), key=sort_key)


def mutated(r, words, share):
    return [w if r.random() > share else f"m{r.randrange(10**6)}" for w in words]


def test_join_against_brute_force(spark):
    """Families of copies with edits around the threshold, short sets, shared passages."""
    r = random.Random(5)
    rows = []
    for family in range(25):
        base = prose(family, r.choice([3, 5, 6, 8, 12, 20, 40, 90, 200]))
        for _ in range(r.randint(1, 6)):
            rows.append((len(rows), " ".join(mutated(r, base, r.choice([0, 0.01, 0.03, 0.05])))))
    passage = prose(99, 60)
    for i in range(60):
        rows.append((len(rows), " ".join(prose(1000 + i, r.choice([5, 15, 60])) + passage)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert joined(df) == sorted(components(rows), key=sort_key)


@pytest.mark.parametrize("all_pairs,block_rows", [(1, 7), (50, 1024)])
def test_join_large_groups_go_by_components(spark, all_pairs, block_rows):
    """The same links when nearly every signature counts as large."""
    r = random.Random(8)
    rows = []
    for family in range(4):
        base = prose(family, 60)
        rows += [(len(rows) + i, " ".join(mutated(r, base, 0.04))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert joined(df, JoinRules(all_pairs=all_pairs, block_rows=block_rows)) == sorted(components(rows), key=sort_key)


def test_join_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(df).collect() == []
    assert near_duplicate_filter(df).collect() == []
    assert near_duplicate_passages(df).collect() == []


def test_signatures_meet_for_every_similar_pair():
    """Pigeonhole: a probe and an indexed set within the allowed difference share a signature."""
    r = np.random.default_rng(3)
    rules = JoinRules()
    for _ in range(300):
        n = int(r.integers(1, 120))
        x = r.integers(1, 2**62, n).astype(np.uint64)
        y = x.copy()
        for _ in range(int(r.integers(0, max_difference(n, n, 75) + 2))):
            if r.random() < 0.5 and len(y) > 1:
                y = np.delete(y, r.integers(len(y)))
            else:
                y = np.append(y, np.uint64(r.integers(1, 2**62)))
        x, y = sorted((x, y), key=len, reverse=True)
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        ends = size_bands(len(x), 75)
        band = int(np.searchsorted(ends, len(y), side="right")) - 1
        args = band, int(ends[band]), int(ends[band + 1]) - 1
        own = ends[band] <= len(x) < ends[band + 1]
        freq = r.integers(2, 1000, len(x)).astype(np.uint32)
        sx, px, _ = segment_signatures(x, freq, len(x), *args, own, rules)
        sy, _, iy = segment_signatures(y, np.full(len(y), 2, np.uint32), len(y), *args, True, rules)
        assert np.intersect1d(sx[px], sy[iy]).size


def test_filter_keeps_one_of_each_group(spark):
    rows = case_rows()
    df = frame(spark, rows)
    kept = near_duplicate_filter(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=lambda t: (t[0] is None, t[0] or 0, t[1] or ""))
    per = components([(d, t) for d, t, _, _ in rows])
    expected = {(d, t) for (d, t, _, _), (_, n, c) in zip(rows, per) if n == 0 or d == c}
    expected = {x for x in expected if x != (12, rows[12][1])} | {(None, rows[10][1])}
    assert {g for g in got} == expected and len(got) == len(set(got))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_compact_windows_match_all_subsequences():
    """Every subsequence of the least length or more lies in exactly the window of its least hash."""
    r = np.random.default_rng(1)
    h = r.integers(1, 2**63, 60).astype(np.uint64)
    rows = np.array([0, 25, 25, 60])
    from quotelake.llm.common import mix64
    x = mix64(h ^ np.uint64(0x9E3779B97F4A7C15))
    v, row, lo, hi = compact_windows(h, rows, 0, 8)
    for d in range(3):
        n = rows[d + 1] - rows[d]
        for i in range(n):
            for j in range(i + 7, n):
                least = x[rows[d] + i:rows[d] + j + 1].min()
                assert sum(1 for k in range(len(v)) if row[k] == d and lo[k] <= i and j <= hi[k] and v[k] == least) == 1


def test_passages_of_fifty_words_are_found(spark):
    r = random.Random(2)
    rows, planted = [], {}
    for p in range(6):
        passage = prose(500 + p, 52)
        for _ in range(4):
            i = len(rows)
            rows.append((i, " ".join(prose(2000 + i, r.randint(20, 200)) + passage + prose(4000 + i, r.randint(20, 200)))))
            planted[i] = passage
    clean = [(100 + i, " ".join(prose(9000 + i, 200))) for i in range(20)]
    df = spark.createDataFrame(rows + clean, "doc_id bigint, text string")
    got = near_duplicate_passages(df).collect()
    linked = {x for g in got for x in (g.doc_id, g.other_id)}
    assert linked == set(planted)
    text = {d: words_of(t) for d, t in rows}
    for g in got:
        assert planted[g.doc_id] == planted[g.other_id]
        span = text[g.doc_id][g.start_word:g.end_word]
        assert len(span) >= 50 and set(planted[g.doc_id]) <= set(span) and g.similarity >= 0.75


def test_passages_awkward_rows(spark):
    got = near_duplicate_passages(frame(spark, case_rows())).collect()
    linked = {x for g in got for x in (g.doc_id, g.other_id)}
    assert {1, 2, 3, 4, 12, 16, 17, 18} <= linked and not {5, 6, 7, 8, 9, 10, 13, 14} & linked


def test_shared_passages_split_at_breaks():
    rules = PassageRules()
    r = np.random.default_rng(0)
    core = r.integers(1, 2**62, 60)
    noise = [r.integers(1, 2**62, 30) for _ in range(4)]
    x = np.concatenate([noise[0], core, noise[1]]).astype(np.uint64)
    y = np.concatenate([noise[2], noise[3], core]).astype(np.uint64)
    assert shared_passages(x, y, rules) == [(30, 90, 60, 120, 1.0)]
    assert shared_passages(x[:0], y, rules) == []


def test_repeated_phrases_do_not_cut_a_passage():
    """A phrase of a shared passage that stands earlier in the partner too, and copies with a refrain."""
    rules = PassageRules()
    r = np.random.default_rng(7)
    core = r.integers(1, 2**62, 60).astype(np.uint64)
    noise = [r.integers(1, 2**62, 80).astype(np.uint64) for _ in range(3)]
    y = np.concatenate([noise[0], core[30:31], noise[1], core])
    assert shared_passages(np.concatenate([noise[2], core]), y, rules) == [(80, 140, 161, 221, 1.0)]
    refrain = core[:1]
    song = np.concatenate([np.concatenate([refrain, r.integers(1, 2**62, 44).astype(np.uint64)]) for _ in range(20)])
    assert shared_passages(song, song.copy(), rules) == [(0, 900, 0, 900, 1.0)]
    # the first half of the passage stands in the partner once more, before the whole
    y = np.concatenate([core[:30], noise[0], core])
    assert (0, 60, 110, 170, 1.0) in shared_passages(core, y, rules)


def test_every_verbatim_passage_is_found_over_a_small_vocabulary():
    rules = PassageRules()
    for seed in range(60):
        r = np.random.default_rng(seed)
        x, y = (r.integers(1, int(r.integers(5, 400)), int(r.integers(60, 300))).astype(np.uint64) for _ in range(2))
        core = r.integers(1, int(r.integers(5, 400)), rules.length).astype(np.uint64)
        i, j = int(r.integers(0, len(x))), int(r.integers(0, len(y)))
        x, y = np.concatenate([x[:i], core, x[i:]]), np.concatenate([y[:j], core, y[j:]])
        got = shared_passages(x, y, rules)
        held = np.zeros(len(x), bool)
        for lo, hi, ylo, yhi, similarity in got:
            held[lo:hi] = True
            a, b = set(x[lo:hi].tolist()), set(y[ylo:yhi].tolist())
            assert hi - lo >= rules.length and similarity == len(a & b) / len(a | b) >= 0.75
        assert held[i:i + rules.length].all()


def test_repeated_phrases_and_refrains_in_texts(spark):
    passage, refrain = prose(31, 64), prose(77, 5)
    verses = [w for v in range(12) for w in refrain + prose(600 + v, 40)]
    rows = [(1, " ".join(prose(32, 60) + passage + prose(33, 60))),
            (2, " ".join(prose(34, 60) + passage[30:35] + prose(35, 90) + passage + prose(36, 60))),
            (3, " ".join(verses)), (4, " ".join(verses))]
    got = near_duplicate_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    spans = {frozenset((g.doc_id, g.other_id)): g for g in got}
    text = {d: words_of(t) for d, t in rows}
    assert set(spans) == {frozenset((1, 2)), frozenset((3, 4))}
    for pair, whole in (((1, 2), passage), ((3, 4), verses)):
        g = spans[frozenset(pair)]
        assert set(whole) <= set(text[g.doc_id][g.start_word:g.end_word]) and g.similarity >= 0.75


@pytest.mark.parametrize("all_pairs", [128, None])
def test_no_text_of_a_class_is_left_out(spark, all_pairs):
    """Texts that quote overlapping slices of one passage, some of them twice: every one is linked, as by all pairs."""
    r = random.Random(11)
    passage = prose(700, 160)
    rows = []
    for i in range(240):
        start = r.randint(0, 100)
        rows.append((i, " ".join(prose(3000 + i, 30) + passage[start:start + 60] + prose(5000 + i, 30))))
    rows += [(300 + i, t) for i, t in rows[:5]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_duplicate_passages(df, PassageRules(all_pairs=all_pairs)).collect()
    linked = {x for g in got for x in (g.doc_id, g.other_id)}
    near = {d: set(zip(*[words_of(t)[k:] for k in range(5)])) for d, t in rows}
    alone = {d for d in near if max(len(near[d] & near[e]) for e in near if e != d) < 46}
    assert set(near) - alone <= linked
    assert {(g.doc_id, g.other_id) for g in got if g.doc_id >= 300} == {(300 + i, i) for i in range(5)}


def test_a_frequent_line_makes_no_pairs_to_verify(spark, monkeypatch):
    """Texts that share one line only are not verified pair by pair; two that share a passage with it are."""
    from quotelake.llm import substring_dedup
    line, passage = prose(810, 15), prose(811, 60)
    rows = [(i, " ".join(prose(20000 + i, 80) + line + prose(30000 + i, 80))) for i in range(120)]
    rows += [(200 + i, " ".join(prose(40000 + i, 50) + passage + line + prose(50000 + i, 50))) for i in range(2)]
    tried, verified = [], substring_dedup._verified

    def counted(pairs, texts, rules):
        tried.append(pairs.count())
        return verified(pairs, texts, rules)

    monkeypatch.setattr(substring_dedup, "_verified", counted)
    got = near_duplicate_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {frozenset((g.doc_id, g.other_id)) for g in got} == {frozenset((200, 201))}
    assert sum(tried) <= 4 * len(rows)


@pytest.mark.parametrize("block_rows", [16, 1 << 15])
def test_windows_of_one_min_hash_are_compared_by_what_is_around(spark, block_rows):
    """A min-hash of more texts than a block: the pairs of a passage are found among all that share a line."""
    from quotelake.llm.common import Scratch
    from quotelake.llm.substring_dedup import _between_classes, _links, _windows
    rules = PassageRules(block_rows=block_rows)
    line, passages = prose(820, 15), [prose(821 + p, 60) for p in range(5)]
    rows = [(i, " ".join(prose(60000 + i, 80) + line + prose(70000 + i, 80))) for i in range(150)]
    rows += [(200 + i, " ".join(prose(80000 + i, 50) + passages[i % 5] + line + prose(90000 + i, 50))) for i in range(10)]
    texts = spark.createDataFrame(rows, "key bigint, text string")
    scratch = Scratch(spark)
    found = scratch.written(_links(_windows(texts, rules, 2)), "test-links")
    names = found.filter("y IS NULL AND token IS NULL").select("x", "key")
    none = spark.createDataFrame([], "x_key bigint, y_key bigint")
    pairs = _between_classes(found.filter("token IS NOT NULL").select("x", "f", "token", "xl", "xr"), names, texts, none, rules, scratch)
    key = {r.x: r.key for r in names.collect()}
    assert {frozenset((key[p.x], key[p.y])) for p in pairs.collect()} == {frozenset((200 + i, 205 + i)) for i in range(5)}


def test_sharing_pairs_against_brute_force():
    from quotelake.llm.substring_dedup import _sharing_pairs
    for seed in range(20):
        r = np.random.default_rng(seed)
        n = 60
        sets = [np.unique(r.integers(0, 60, int(r.integers(5, 40)))) for _ in range(n)]
        cell, group, need = r.integers(0, 3, n), r.integers(0, 20, n), r.integers(1, 16, n)
        want = {(max(i, j), min(i, j)) for i in range(n) for j in range(i) if cell[i] == cell[j] and group[i] != group[j]
                and len(np.intersect1d(sets[i], sets[j])) >= max(need[i], need[j])}
        got = _sharing_pairs(cell, np.arange(n), group, need, np.concatenate(sets), np.array([len(s) for s in sets]), block=16)
        assert got == want


def test_surroundings_bound_what_a_passage_shares():
    """No passage that holds the minimum of a window shares less than the bound with any partner."""
    from quotelake.llm.substring_dedup import _different, _surroundings
    for seed in range(40):
        r = np.random.default_rng(seed)
        h = r.integers(0, int(r.integers(4, 80)), int(r.integers(12, 60))).astype(np.uint64)
        value, length = h * np.uint64(2654435761) % np.uint64(97), 10
        kinds = _different(h, np.ones(len(h), bool), length)
        assert kinds.tolist() == [len(set(h[i:i + length].tolist())) for i in range(len(h) - length + 1)]
        least, near = _surroundings(h, value, 1, len(h) - 1, kinds, length)
        at = [i for i in range(1, len(h)) if value[i] == value[1:].min()]
        stretches = [set(h[i:i + length].tolist()) for i in range(1, len(h) - length + 1) if any(i <= k < i + length for k in at)]
        assert least == min(map(len, stretches)) and set(near.tolist()) == set().union(*stretches)


def test_the_bound_on_unshared_shingles_rejects_no_passage(monkeypatch):
    from quotelake.llm import substring_dedup
    rules, cases = PassageRules(), []
    for seed in range(150):
        r = np.random.default_rng(seed)
        few, many = int(r.integers(3, 60)), int(r.integers(60, 400))
        base = np.resize(r.integers(0, 500, few), many)
        x, y = (np.where(r.random(many) < r.choice([0, 0.02, 0.1]), r.integers(0, 600, many), np.roll(base, int(r.integers(0, 50))))
                for _ in range(2))
        cases.append((np.append(x, r.integers(1000, 2000, 40)).astype(np.uint64), y.astype(np.uint64)))
    got = [shared_passages(x, y, rules) for x, y in cases]
    monkeypatch.setattr(substring_dedup, "_may_be_similar", lambda *_: True)
    assert got == [shared_passages(x, y, rules) for x, y in cases] and 20 < sum(map(bool, got)) < 150


def test_every_pair_of_texts_is_linked_whatever_else_joins_them(spark):
    """Texts that hang together by one passage and share others: no pair is left out, and no passage of it."""
    passages = [prose(840 + p, 70) for p in range(4)]
    rows = [(i, " ".join(prose(86000 + i, 40) + passages[0] + prose(87000 + i, 60) + passages[1 + i % 3] + prose(88000 + i, 40))) for i in range(30)]
    rows += [(100, rows[0][1])]
    got = near_duplicate_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {frozenset((g.doc_id, g.other_id)) for g in got} == {frozenset((i, j)) for i in range(30) for j in range(i)} | {frozenset((0, 100))}
    text = {d: words_of(t) for d, t in rows}
    shared = {}
    for g in got:
        shared.setdefault(frozenset((g.doc_id, g.other_id)), set()).update(text[g.doc_id][g.start_word:g.end_word])
    for i in range(30):
        for j in range(i % 3, i, 3):
            assert set(passages[0] + passages[1 + i % 3]) <= shared[frozenset((i, j))]


def test_a_text_travels_once_for_many_partners(spark):
    from quotelake.llm.substring_dedup import _cells
    pairs = [(x, y, 0, 9, 0, 9) for x in range(300) for y in range(x)] + [(1000 + i, 2000 + i, 0, 9, 0, 9) for i in range(50)]
    cells = _cells(spark.createDataFrame(pairs, "x_key bigint, y_key bigint, xl int, xr int, yl int, yr int")).collect()
    assert sorted((c.x_key, c.y_key) for c in cells) == sorted(p[:2] for p in pairs)
    held = {(c.cell, k) for c in cells for k in (c.x_key, c.y_key)}
    assert len(held) < 25 * 100 + 300 and max(sum(c == cell for c, _ in held) for cell in {c for c, _ in held}) < 220
