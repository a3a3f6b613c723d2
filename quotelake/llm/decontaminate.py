"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are normalised to words (lower-case A-Z; runs of digits, letters and characters beyond ASCII), and every
window of ten words becomes a pattern.  Texts are normalised the same way, a batch of rows at a time,
and scanned once; a map from normalised to original bytes gives the words and places of each match.

The patterns live on the executors as one automaton of a bounded size.  A benchmark with more patterns is dealt into
blocks: the documents pass through the blocks one after another and carry what was found so far, so
nothing depends on the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, text_batches, written


@dataclass(frozen=True)
class LeakRules:
    window: int = 10                   # words of a pattern; an item with fewer words is one pattern
    block_bytes: int = 4 << 20         # patterns of one automaton (about 80 bytes of memory per byte)


# Words of normalised text; separators are the ASCII characters that are neither digits nor lower-case letters.
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_windows(items: DataFrame, rules: LeakRules = LeakRules(), id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """(item_id string, window) of all items, distinct; windows are words joined by single spaces."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(ITEM_WORDS), 0)
    n = F.size("w")
    starts = F.when(n > rules.window, F.sequence(F.lit(1), n - rules.window + 1)).otherwise(F.array(F.lit(1)))
    return (items.select(F.col(id_col).cast("string").alias("item_id"), words.alias("w")).filter(n > 0)
            .select("item_id", "w", F.explode(starts).alias("at"))
            .select("item_id", F.array_join(F.slice("w", F.col("at"), rules.window), " ").alias("window")).distinct())


# --- normalised batches ------------------------------------------------------------

def _byte_classes() -> np.ndarray:
    """Byte -> its normalised byte; separators become a space."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for first, last in ((48, 57), (97, 122)):
        table[first:last + 1] = np.arange(first, last + 1)
    table[65:91] = table[97:123]
    return table


@dataclass
class NormalText:
    """``text``: all rows of a batch, each behind a space, words joined by single spaces (one character a byte).
    ``word[i]`` counts word starts up to and with character i; word w lies at the original bytes
    ``begin[w]:end[w]``; ``first_word`` are the rows' offsets into the words."""

    text: str
    word: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first_word: np.ndarray


def normalise(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> NormalText:
    rows, n = len(offsets) - 1, len(data)
    value = table[data]
    is_word = value != 32
    starts, stops = is_word.copy(), is_word.copy()
    starts[1:] &= ~is_word[:-1]
    stops[:-1] &= ~is_word[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]      # a row boundary ends a word
    starts[cut], stops[cut - 1] = is_word[cut], is_word[cut - 1]
    at_word = np.flatnonzero(is_word)
    begins = starts[at_word]
    # every word start is preceded by one space; a row's last word is followed by the next row's space
    place = np.arange(len(at_word)) + np.cumsum(begins)
    total = len(at_word) + int(begins.sum())
    row_of = np.searchsorted(offsets, at_word, side="right") - 1
    new_row = np.zeros(len(at_word), bool)
    if len(at_word):
        new_row[0] = True
        new_row[1:] = row_of[1:] != row_of[:-1]
    # between two rows stands one more separator that no pattern holds
    place = place + np.cumsum(new_row) * 2
    out = np.full(total + 2 * int(new_row.sum()) + 1, 32, np.uint8)
    out[place] = value[at_word]
    if len(at_word):
        out[place[new_row] - 2] = 10
    word = np.zeros(len(out), np.int64)
    word[place[begins]] = 1
    np.cumsum(word, out=word)
    begin = at_word[begins]
    return NormalText(out.tobytes().decode("latin-1"), word, begin, np.flatnonzero(stops) + 1,
                      np.searchsorted(begin, offsets, side="left").astype(np.int64))


def automaton(patterns: list[tuple[str, list[str]]]):
    """Aho-Corasick automaton over (window, item ids); its values are (pattern number, words)."""
    import ahocorasick
    a = ahocorasick.Automaton()
    for i, (window, _) in enumerate(patterns):
        a.add_word(" " + window.encode("utf-8", "replace").decode("latin-1") + " ", (i, window.count(" ") + 1))
    a.make_automaton()
    return a


def merged_runs(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Disjoint [first, end) runs of word numbers, sorted, from any runs; touching runs stay apart only if they do not overlap."""
    if not len(first):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.ones(len(first), bool)
    new[1:] = first[1:] >= end[:-1]
    at = np.flatnonzero(new)
    return np.stack([first[at], end[np.append(at[1:], len(first)) - 1]], axis=1)


def code_point_spans(raw: bytes, begin: np.ndarray, end: np.ndarray) -> list[str]:
    """``start:end`` in code points for the byte ranges of one text."""
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [f"{points[a]}:{points[b]}" for a, b in zip(begin, end)]


# --- scan --------------------------------------------------------------------------

def _scan(patterns: list[tuple[str, list[str]]], schema: T.StructType, carried: bool, last: bool):
    """The task function of one block: adds its runs and items to those carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        table, fields = _byte_classes(), to_arrow_schema(schema)
        finder = automaton(patterns) if patterns else None
        names = [ids for _, ids in patterns]
        for batch, data, offsets in text_batches(batches, "text"):
            normal = normalise(data, offsets, table)
            ends, hits, sizes = [], [], []
            if finder is not None:
                for at, (p, size) in finder.iter(normal.text):
                    ends.append(at)
                    hits.append(p)
                    sizes.append(size)
            ends, hits, sizes = (np.array(x, np.int64) for x in (ends, hits, sizes))
            end = normal.word[ends - 1] if len(ends) else ends          # words up to and with the match's last one
            first = end - sizes
            row = np.searchsorted(normal.first_word, first, side="right") - 1
            order = np.argsort(row, kind="stable")
            first, end, hits, row = first[order], end[order], hits[order], row[order]
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            old_runs = batch.column(batch.schema.get_field_index("runs")).to_pylist() if carried else None
            old_items = batch.column(batch.schema.get_field_index("items")).to_pylist() if carried else None
            n_words = np.diff(normal.first_word)
            out_runs, out_items, spans, n_hit = [], [], [], []
            for r in range(batch.num_rows):
                lo, hi, base = cut[r], cut[r + 1], int(normal.first_word[r])
                a, b = first[lo:hi] - base, end[lo:hi] - base
                items = {i for p in np.unique(hits[lo:hi]) for i in names[p]}
                if carried:
                    before = np.frombuffer(old_runs[r], "<i8").reshape(-1, 2)
                    a, b = np.append(a, before[:, 0]), np.append(b, before[:, 1])
                    items |= set(old_items[r])
                runs = merged_runs(a, b)
                out_runs.append(runs)
                out_items.append(sorted(items))
                n_hit.append(int((runs[:, 1] - runs[:, 0]).sum()))
                if last:
                    text = data[offsets[r]:offsets[r + 1]].tobytes() if len(runs) else b""
                    spans.append(",".join(code_point_spans(text, normal.begin[runs[:, 0] + base] - offsets[r],
                                                           normal.end[runs[:, 1] + base - 1] - offsets[r])))
            id_column = batch.column(0)
            items = pa.array(out_items, pa.list_(pa.string()))
            if last:
                yield pa.RecordBatch.from_arrays(
                    [id_column, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), items, pa.array(spans, pa.string())],
                    schema=fields)
            else:
                runs = pa.array([r.astype("<i8").tobytes() for r in out_runs], pa.binary())
                yield pa.RecordBatch.from_arrays([id_column, batch.column(1), runs, items], schema=fields)
    return run


def contaminated_spans(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules(), id_col: str = "doc_id",
                       text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, spans.

    ``items`` are the ids (as sorted strings) of the items with a window in the text, ``spans`` the hit passages as
    ``start:end`` in code points of the original text, comma-joined.  A null text has no words.  An item without words has
    no window; rows of one item id are one item; the windows of a null item id hit words but are listed under no id.
    Null document ids and repeated rows are scanned like any row.  Windows lie within one row's text.
    """
    windows = written(item_windows(items, rules, item_id_col, item_text_col), "leak-windows")
    size = windows.agg(F.sum(F.octet_length("window") + 2).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // rules.block_bytes))
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)))
    id_type, text = docs.schema[id_col].dataType, T.StringType()
    key = T.StructField("doc_id", id_type)
    found = T.StructField("items", T.ArrayType(text))
    middle = T.StructType([key, T.StructField("text", text), T.StructField("runs", T.BinaryType()), found])
    final = T.StructType([key, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), found,
                          T.StructField("spans", text)])
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    for block in range(blocks):
        patterns: dict[str, list[str]] = {}
        # one block is bounded by ``block_bytes``; the automaton is built from it in every task
        for r in dealt.filter(F.col("block") == block).select("window", "item_id").collect():
            ids = patterns.setdefault(r["window"], [])
            if r["item_id"] is not None:
                ids.append(r["item_id"])
        last = block == blocks - 1
        out = out.mapInArrow(_scan(list(patterns.items()), final if last else middle, block > 0, last),
                             final if last else middle)
        if not last:
            out = written(out, "leak-block")
    return out


def leak_digest(found: DataFrame) -> DataFrame:
    """The digest columns of a result of :func:`contaminated_spans`."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit word; equal rows are judged once."""
    key = F.xxhash64(F.lit(1), F.col(id_col), F.md5(F.col(text_col).cast("binary")))
    keyed = docs.withColumn("_key", key)
    leaks = contaminated_spans(keyed.select("_key", F.col(text_col).alias("text")), items, rules, "_key", "text")
    bad = leaks.filter("n_hit > 0").select(F.col("doc_id").alias("_bad")).distinct()
    return keyed.join(bad, F.col("_key") == F.col("_bad"), "left_anti").drop("_key")
