"""Shared helpers: table access, written intermediates, vectorised word hashing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.session import run_dir

SHINGLE_WORDS = 5

# Word separators: space and the control characters 0x09-0x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file; it must be installed on every executor."""
    import public_tokenizers
    return public_tokenizers.path(name)


# Shuffle files of a finished write are of no use to anyone; this setting deletes them when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage is cut
    and a lost executor costs a re-read, not a recomputation.  The shuffle files behind it are deleted when the write ends.
    """
    spark = df.sparkSession
    path, before = path or run_dir(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The written tables of one job; each can be deleted as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = run_dir(self.spark, name)
        table = written(df, name, path)
        self.paths[id(table)] = (table, path)
        return table

    def drop(self, *tables: DataFrame) -> None:
        sc = self.spark.sparkContext
        for table in tables:
            _, folder = self.paths.pop(id(table))
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

    def drop_all(self, but: Sequence[DataFrame] = ()) -> None:
        kept = {id(t) for t in but}
        self.drop(*[t for k, (t, _) in list(self.paths.items()) if k not in kept])


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_batches(batches: Iterator[pa.RecordBatch], column: str,
                 max_bytes: int = 4 << 20, max_rows: int = 30_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches so that one piece holds about ``max_bytes`` of text (one row at least,
    ``max_rows`` at most).

    Yields (batch, utf8 bytes, row offsets); a null text counts as empty.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if col.null_count:
            col = col.fill_null("")
        if not pa.types.is_large_string(col.type):
            col = col.cast(pa.large_string())
        n = len(col)
        if n == 0:
            continue
        off = np.frombuffer(col.buffers()[1], dtype=np.int64, count=col.offset + n + 1)[col.offset:]
        buf = col.buffers()[2]
        data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
        start = 0
        while start < n:
            end = int(np.searchsorted(off, off[start] + max_bytes, side="right")) - 1
            end = min(n, max(end, start + 1), start + max_rows)
            yield (batch.slice(start, end - start), data[off[start]:off[end]],
                   (off[start:end + 1] - off[start]).astype(np.int64))
            start = end


def _byte_values() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(mix64(x))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_MULT = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _MULT, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of every row: byte starts, byte ends (exclusive) and the words' row offsets."""
    ok = ~((data == 32) | ((data >= 9) & (data <= 13)))
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    first = ok.copy()
    first[1:] &= ~ok[:-1]
    last = ok.copy()
    last[:-1] &= ~ok[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]   # a row boundary ends a word
    first[cut] = ok[cut]
    last[cut - 1] = ok[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False,
                words_at_once: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the row offsets into them; temporary arrays stay small."""
    starts, ends, rows = word_spans(data, offsets)
    out = np.zeros(len(starts), np.uint64)
    if len(starts) == 0:
        return out, rows
    table = _byte_values()
    if lower:
        table[65:91] = table[97:123]
    table[[9, 10, 11, 12, 13, 32]] = 0             # separators behind a word add nothing
    powers = _powers(int((ends - starts).max()))
    for i in range(0, len(starts), words_at_once):
        first, last = starts[i:i + words_at_once], ends[i:i + words_at_once]
        begin, end = first[0], last[-1]
        size = np.diff(np.append(first, end))
        pos = np.arange(end - begin) - np.repeat(first - begin, size)
        value = table[data[begin:end]] * powers[np.minimum(pos, len(powers) - 1)]
        out[i:i + words_at_once] = mix64(np.add.reduceat(value, first - begin) ^ (last - first).astype(np.uint64))
    return out, rows


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's n-word windows in order, and their row offsets.

    A row with 1 to n-1 words has one window, its whole sequence; a row without
    words has none.
    """
    count = np.diff(rows)
    size = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    out_rows = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    total = int(out_rows[-1])
    if total == 0:
        return np.zeros(0, np.uint64), out_rows
    at = np.repeat(rows[:-1] - out_rows[:-1], size) + np.arange(total)
    length = np.repeat(np.minimum(count, n), size)
    h = length.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    for k in range(n):
        more = k < length
        w = words[np.where(more, at + k, 0)]
        h = np.where(more, mix64(h) + w, h)
    return mix64(h), out_rows


def distinct_per_row(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, and their row offsets."""
    row = np.repeat(np.arange(len(rows) - 1, dtype=np.int64), np.diff(rows))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[keep], row[keep]
    return h, np.searchsorted(row, np.arange(len(rows)), side="left").astype(np.int64)
