"""Shared rows for the tests: the awkward cases every operator must take."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "n_words int, _row string, key string, pos int, cls string, tokens string, kept int, "
          "sequence_id string, topic string, host string, rank int, score string, seq int, n int, size int")


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    words = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4)))
             for _ in range(vocabulary)]
    return [r.choice(words) for _ in range(n)]


def lines(words, per=12):
    return "\n".join(" ".join(words[i:i + per]) for i in range(0, len(words), per))


def case_rows():
    """(doc_id, text, lang, source): copies, near copies, nulls, empty, tiny and very long texts, ties."""
    base = prose(1, 300)
    edited = base[:]
    edited[7], edited[150] = "changed", "again"
    half = base[:150] + prose(2, 150)
    out = [
        (1, " ".join(base), "en", "a"), (2, " ".join(base), "en", "a"), (3, " ".join(edited), "fr", "b"),
        (4, " ".join(half), "fr", None), (5, None, None, None), (6, "", "en", "a"), (7, " \t\n ", "en", "a"),
        (8, "one", "en", "b"), (9, "ONE", "en", "b"), (10, "one two three", "de", "b"),
        (None, " ".join(prose(3, 80)), "en", "c"), (None, None, "en", None),
        (12, " ".join(base), "en", "a"), (12, " ".join(base), "en", "a"), (12, " ".join(prose(4, 60)), "en", "d"),
        (13, " ".join(prose(5, 40_000, 5000)), "en", "d"), (14, "x" * 60_000, "en", "d"),
        (15, "word " * 3000, "en", "d"), (16, lines(prose(6, 240)), "de", "e"),
        (17, lines(prose(7, 60) + prose(6, 240)[:120] + prose(8, 24)), "de", "e"),
        (18, lines(prose(6, 240)), "de", "e"), (19, "été ça où " * 30, "fr", "e"), (20, "🙂 \u0301 ﬁ\x1c \x85 日本語", None, "e"),
    ]
    return out


def frame(spark, rows):
    """``rows`` with extra columns whose names clash with the operators' own."""
    full = [(d, t, lang, s, None if t is None else len(t), 1, "r", "k", 2, "c", "t", 1, "s", "t", "h", 1, "s", 1, 1, 1)
            for d, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(rows):
    """Per row the smallest id reachable by links between the rows' sets (rows, not ids, are the nodes)."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = root(i)
            least[r] = min(d, least.get(r, d))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]
