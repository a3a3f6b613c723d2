"""Quality rules by compression bands.

A text is compressed as a whole and in fixed chunks with zstandard.  Text that
shrinks too far is repetitive, text that does not shrink is noise; how far prose
shrinks depends on its length, so the limits are given per length band.  The
base counts (words, symbols, repeated lines and windows) come from the same pass.

``calibrated`` measures the limits: ratios of all texts and of all chunks that pass the base counts are counted by
length band in steps of 0.001, and a band's limits are its median plus and minus a multiple of the quartile distances, which a
minority of junk does not move.  A band with few texts leans on the given limits.  What compresses like prose of its length
(hexadecimal noise under a page, random letters under half a page) stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, text_batches, word_hashes

SYMBOLS = "#*$%&|<>"

# (bytes below, lowest ratio, highest ratio) for whole texts: compressed / raw bytes.
# Short texts carry zstandard's frame overhead and share few substrings, so their
# band lies higher; from a page on, prose settles between about 0.3 and 0.55.
WHOLE_BANDS = (
    (128, 0.30, 1.60),
    (256, 0.25, 1.20),
    (512, 0.22, 1.00),
    (1024, 0.20, 0.90),
    (4096, 0.18, 0.80),
    (16384, 0.15, 0.75),
    (1 << 62, 0.12, 0.72),
)
# The same limits for a chunk on its own; chunks are judged by their share of failures.
CHUNK_BANDS = WHOLE_BANDS


@dataclass(frozen=True)
class CompressionRules:
    """Parameters of the rules; ``max_bad_chunks`` is the share of bad chunks allowed."""

    level: int = 3
    chunk_bytes: int = 4096
    whole: tuple = WHOLE_BANDS
    chunk: tuple = CHUNK_BANDS
    least_chunk: int = 1024
    max_bad_chunks: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


def band_of(n_bytes: int, bands: tuple) -> tuple[float, float]:
    for below, low, high in bands:
        if n_bytes < below:
            return low, high
    return bands[-1][1:]


def compression_verdict(raw: bytes, rules: CompressionRules, zc: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """(whole ratio, share of bad chunks, inside the bands) of one text; empty text is inside."""
    n = len(raw)
    if n == 0:
        return 1.0, 0.0, True
    ratio = len(zc.compress(raw)) / n
    low, high = band_of(n, rules.whole)
    bad = chunks = 0
    for i in range(0, n, rules.chunk_bytes):
        part = raw[i:i + rules.chunk_bytes]
        if i and len(part) < rules.least_chunk:
            continue                      # too short for a ratio of its own; judged with the whole text
        r = ratio if len(part) == n else len(zc.compress(part)) / len(part)
        lo, hi = band_of(len(part), rules.chunk)
        bad += not lo <= r <= hi
        chunks += 1
    share = bad / chunks
    return ratio, share, low <= ratio <= high and share <= rules.max_bad_chunks


MEASURES = pa.struct([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("ratio", pa.float64()), ("bad_chunks", pa.float64()), ("in_bands", pa.bool_()),
])


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(words: np.ndarray, rows: np.ndarray, n: int = 3) -> np.ndarray:
    """Words per row that lie in an n-word window found at least twice in the row."""
    if len(words) < n:
        return np.zeros(len(rows) - 1, np.int64)
    row = np.repeat(np.arange(len(rows) - 1, dtype=np.int64), np.diff(rows))
    h = words[:-2].copy()
    for k in range(1, n):
        h = mix64(h) + words[k:len(words) - n + 1 + k]
    inside = row[:len(h)] == row[n - 1:]
    at = np.flatnonzero(inside)
    key = mix64(h[at] + mix64(row[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    twice = at[order[same[:-1] | same[1:]]]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + n, -1)
    return _sums(np.cumsum(cover)[:-1] > 0, rows)


def _dup_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    out = np.zeros(len(offsets) - 1, np.int64)
    raw = data.tobytes()
    for i in range(len(out)):
        text = raw[offsets[i]:offsets[i + 1]]
        if b"\n" not in text:
            continue
        lines = text.split(b"\n")
        if len(set(lines)) == len(lines):
            continue
        seen = set()
        for line in lines:
            if line in seen and line.strip(b" \t\n\r\x0b\x0c"):
                out[i] += 1
            seen.add(line)
    return out


def measure_batches(arrays: Iterator[pa.Array], rules: CompressionRules) -> Iterator[pa.Array]:
    zc = zstandard.ZstdCompressor(level=rules.level)
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    for array in arrays:
        batch = pa.RecordBatch.from_arrays([array.cast(pa.large_string())], ["text"])
        parts = []
        for _, data, offsets in text_batches([batch], "text"):
            words, rows = word_hashes(data, offsets)
            is_word = ~((data == 32) | ((data >= 9) & (data <= 13)))
            code_point = (data & 0xC0) != 0x80
            raw = data.tobytes()
            judged = [compression_verdict(raw[offsets[i]:offsets[i + 1]], rules, zc)
                      for i in range(len(offsets) - 1)]
            parts.append(pa.StructArray.from_arrays([
                pa.array(np.diff(rows)), pa.array(_sums(is_word & code_point, offsets)),
                pa.array(_sums(symbol[data], offsets)), pa.array(_dup_lines(data, offsets)),
                pa.array(_repeated_words(words, rows)),
                pa.array([j[0] for j in judged], pa.float64()),
                pa.array([j[1] for j in judged], pa.float64()),
                pa.array([j[2] for j in judged], pa.bool_()),
            ], fields=list(MEASURES)))
        yield pa.concat_arrays(parts) if parts else pa.array([], MEASURES)


def measures(text: Column, rules: CompressionRules = CompressionRules()) -> Column:
    """Struct of the base counts and the compression verdict of a text column."""
    @F.arrow_udf("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
                 "n_repeat_words:bigint,ratio:double,bad_chunks:double,in_bands:boolean>")
    def judge(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return measure_batches(arrays, rules)
    return judge(text)


def failed_base(m: Column, rules: CompressionRules = CompressionRules()) -> Column:
    n = m["n_words"]
    return (n < rules.min_words) | (100 * m["n_repeat_words"] > rules.max_repeat_percent * n)


STEP = 1000                          # ratios are counted in steps of 1 / STEP


def ratio_counts(docs: DataFrame, rules: CompressionRules, text_col: str = "text") -> DataFrame:
    """(kind, band, step, n): how many texts (kind 0) and chunks (kind 1) of each length band have which ratio.

    Over all texts that pass the base counts; the table has at most a few thousand rows whatever the input.
    """
    whole, chunk = [np.array([b[0] for b in bands]) for bands in (rules.whole, rules.chunk)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zc = zstandard.ZstdCompressor(level=rules.level)
        total: dict[tuple[int, int, int], int] = {}

        def add(kind: int, bands: np.ndarray, part: bytes) -> None:
            key = (kind, int(np.searchsorted(bands, len(part), side="right")), int(len(zc.compress(part)) * STEP / len(part)))
            total[key] = total.get(key, 0) + 1

        for batch in batches:
            for _, data, offsets in text_batches([batch], "text"):
                words, rows = word_hashes(data, offsets)
                n, repeated = np.diff(rows), _repeated_words(words, rows)
                raw = data.tobytes()
                for i in np.flatnonzero((n >= rules.min_words) & (100 * repeated <= rules.max_repeat_percent * n)):
                    text = raw[offsets[i]:offsets[i + 1]]
                    add(0, whole, text)
                    for at in range(0, len(text), rules.chunk_bytes):
                        if at == 0 or len(text) - at >= rules.least_chunk:
                            add(1, chunk, text[at:at + rules.chunk_bytes])
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in keys], pa.int32()) for j in range(3)]
                                         + [pa.array([total[k] for k in keys], pa.int64())], names=["kind", "band", "step", "n"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "kind int, band int, step int, n bigint")
    return parts.groupBy("kind", "band", "step").agg(F.sum("n").alias("n"))


def fences(steps: np.ndarray, counts: np.ndarray, low: float, high: float, spread: float, prior: int) -> tuple[float, float]:
    """Limits of one band: median -/+ ``spread`` times the distance to the quartiles, drawn to (low, high) by ``prior`` texts."""
    total = int(counts.sum())
    if total == 0:
        return low, high
    order = np.argsort(steps)
    share = np.cumsum(counts[order]) / total
    q1, median, q3 = (steps[order][np.searchsorted(share, q)] / STEP for q in (0.25, 0.5, 0.75))
    mine = total / (total + prior)
    return (float(mine * (median - spread * max(median - q1, 1 / STEP)) + (1 - mine) * low),
            float(mine * (median + spread * max(q3 - median, 1 / STEP) + 1 / STEP) + (1 - mine) * high))


def calibrated(docs: DataFrame, rules: CompressionRules = CompressionRules(), text_col: str = "text", spread: float = 5.0,
               prior: int = 50, max_bad_chunks: float = 0.2, least_chunk: int = 512) -> CompressionRules:
    """``rules`` with limits measured over all of ``docs`` (see the module's text), and tails from ``least_chunk`` bytes judged."""
    rules = replace(rules, max_bad_chunks=max_bad_chunks, least_chunk=least_chunk)
    got = ratio_counts(docs, rules, text_col).collect()          # at most bands * steps rows
    out = []
    for kind, bands in enumerate((rules.whole, rules.chunk)):
        made = []
        for b, (below, low, high) in enumerate(bands):
            mine = [(r["step"], r["n"]) for r in got if r["kind"] == kind and r["band"] == b]
            steps, counts = np.array([m[0] for m in mine]), np.array([m[1] for m in mine], np.int64)
            made.append((below, *fences(steps, counts, low, high, spread, prior)))
        out.append(tuple(made))
    return replace(rules, whole=out[0], chunk=out[1])


def quality_table(docs: DataFrame, rules: CompressionRules = CompressionRules(),
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base counts, ratios, ``base_failed``, ``kept``.

    A null text counts as empty (no words, base failed); a null id and repeated
    rows are judged like any other row; other columns are not looked at.
    """
    m = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col), rules).alias("m"))
    failed = failed_base(F.col("m"), rules)
    return m.select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                    "m.ratio", "m.bad_chunks", failed.alias("base_failed"),
                    (~failed & F.col("m.in_bands")).alias("kept"))


def quality_filter(docs: DataFrame, rules: CompressionRules = CompressionRules(),
                   text_col: str = "text") -> DataFrame:
    """The rows whose text passes; every column is passed on as it is."""
    @F.arrow_udf("boolean")
    def passes(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for m in measure_batches(arrays, rules):
            n = np.asarray(m.field("n_words"))
            repeated = np.asarray(m.field("n_repeat_words"))
            failed = (n < rules.min_words) | (100 * repeated > rules.max_repeat_percent * n)
            yield pa.array(~failed & m.field("in_bands").to_numpy(zero_copy_only=False))
    return docs.filter(passes(F.col(text_col)))
