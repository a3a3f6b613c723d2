"""op11: one automaton, whole texts, offsets in the original; against a word-by-word brute force."""
import hashlib
import os
import random
import re
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
from llm_cases import LOWER, case_rows, frame, prose  # noqa: E402

from quotelake.llm.decontaminate import (LeakRules, _byte_classes, contaminated_spans, decontaminated, leak_digest,  # noqa: E402
                                         merged_runs, normalise)

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def matches(text):
    return list(ITEM_WORD.finditer((text or "").translate(LOWER)))


def brute(text, items, window=10):
    """(words, hit words, sorted ids, spans) of one text."""
    found = matches(text)
    w = [m.group() for m in found]
    hit, ids, runs = set(), set(), []
    for key, item in items:
        v = [m.group() for m in matches(item)]
        n = min(window, len(v))
        for a in range(len(v) - n + 1 if n else 0):
            for b in range(len(w) - n + 1):
                if w[b:b + n] == v[a:a + n]:
                    hit.update(range(b, b + n))
                    runs.append((b, b + n))
                    if key is not None:
                        ids.add(str(key))
    joined = []
    for a, b in sorted(runs):
        if joined and a < joined[-1][1]:
            joined[-1][1] = max(b, joined[-1][1])
        else:
            joined.append([a, b])
    spans = ",".join(f"{found[a].start()}:{found[b - 1].end()}" for a, b in joined)
    return len(w), len(hit), sorted(ids), spans


ITEMS = [(1, " ".join(prose(1, 300)[40:75])), (2, "Ääß  straße-42, été!"), (3, "one"), (4, ""), (5, None), (6, "?!"),
         (7, " ".join(prose(6, 240)[10:20])), (None, " ".join(prose(5, 40_000, 5000)[100:115])), (7, "日本語 🙂"),
         (10, " ".join(prose(1, 300)[60:90])), (8, "x" * 60_000), (9, " ".join(prose(6, 240)[100:140]))]


def extra_rows():
    passage = " ".join(prose(1, 300)[40:75])
    return [(30, "ÄÄSS ääß_STRASSE straße?42 ÉTÉ été", "de", "a"), (31, "x ääß straße 42 été y ääß Straße\t42\x7fété.", "de", "a"),
            (32, passage.upper().replace(" ", " -- "), "en", "a"), (33, passage.replace(" ", "")[:400], "en", "a"),
            (34, "one one\nONE", "en", "a"), (35, "none onee one1", "en", "a"), (36, "(" + passage + ")" + passage, "en", "a"),
            (37, "日本語 🙂 日本語\U0001F642", None, "a"), (38, "straße 42 été", "de", "a")]


def compare(spark, rules):
    rows = case_rows() + extra_rows()
    docs = frame(spark, rows).withColumnRenamed("n", "item_id")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = contaminated_spans(docs, items, rules).collect()
    want = [(d, *brute(t, ITEMS)) for d, t, _, _ in rows]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"], r.spans)) for r in got)
    return docs, items, got


def test_spans_match_brute_force_and_digest(spark):
    docs, items, got = compare(spark, LeakRules())
    digest = {r.doc_id: r for r in leak_digest(contaminated_spans(docs, items)).collect()}
    by = {r.doc_id: r for r in got}
    assert by[1]["items"] == ["1", "10"] and by[34].n_hit == 3 and by[35].n_hit == 0 and by[38].n_hit == 0
    for d, r in digest.items():
        assert r.items_sha256 == hashlib.sha256(",".join(by[d]["items"]).encode()).hexdigest()
        assert r.n_items == len(by[d]["items"]) and r.contaminated == (by[d].n_hit > 0)


def test_a_benchmark_of_several_blocks_gives_the_same(spark):
    compare(spark, LeakRules(block_bytes=30_000))


def test_spans_are_places_of_the_original(spark):
    passage = "Éa b c d e f g h i j"
    text = "🙂 é\n" + passage.replace(" ", "…") + "; " + passage.replace(" ", " -\n")
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    r = contaminated_spans(docs, items).first()
    assert r.n_hit == 10                                # '…' is no separator, so only the second copy has these words
    a, b = map(int, r.spans.split(":"))
    assert text[a:b] == passage.replace(" ", " -\n")


def test_empty_tables(spark):
    docs, items = frame(spark, case_rows()), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert contaminated_spans(docs.limit(0), items).collect() == []
    clean = contaminated_spans(docs, items.limit(0)).collect()
    assert len(clean) == len(case_rows()) and all(r.n_hit == 0 and r["items"] == [] and r.spans == "" for r in clean)
    kept = decontaminated(docs, items)
    assert kept.columns == docs.columns
    want = [d for d, t, _, _ in case_rows() if not brute(t, ITEMS)[1]]
    assert sorted(map(repr, want)) == sorted(repr(r.doc_id) for r in kept.collect())


def test_normalised_words_of_random_batches():
    rng = random.Random(5)
    for _ in range(50):
        texts = ["".join(rng.choice("aB9 .-é\nß🙂\x00\x7f") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
        n = normalise(np.frombuffer(b"".join(raw), np.uint8), offsets, _byte_classes())
        words = [[m.group() for m in matches(t)] for t in texts]
        assert list(np.diff(n.first_word)) == [len(w) for w in words]
        lines = [" " + " ".join(w) + " " for w in words if w]
        assert n.text.encode("latin-1").decode() == " " + "".join("\n" + x for x in lines)
        whole = b"".join(raw)
        assert [whole[a:b].decode().translate(LOWER) for a, b in zip(n.begin, n.end)] == sum(words, [])


def test_merged_runs():
    assert merged_runs(np.array([], int), np.array([], int)).tolist() == []
    assert merged_runs(np.array([5, 0, 3, 20]), np.array([9, 10, 4, 30])).tolist() == [[0, 10], [20, 30]]
