"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only sizes matter for the plan, and there are at most ``capacity`` of them: the
plan is made on the histogram of sizes, so its cost does not depend on the
number of documents.  Pieces then take their places by rank within their size.

Reduction: a set of pieces may be fixed in one sequence if it dominates every
other feasible set with its largest piece, i.e. each such set can be split into
parts that the fixed pieces cover one by one.  Used here: a piece that fits with
nothing stays alone; a pair that fills the sequence exactly; and a pair with the
largest fitting partner when no two other pieces fit beside the large one.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import written

CAPACITY = 2048
END_ID = 0


# --- plan -----------------------------------------------------------------

@dataclass
class Plan:
    """``slots``: (size, first rank, count, first sequence, offset); rank r of a size goes to
    sequence ``first sequence + r - first rank`` at ``offset``."""

    slots: list
    sequences: int
    fixed: int        # sequences fixed by the reduction


def reduce_sizes(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets; takes them off ``counts``.  Returns (sizes in a sequence, how many)."""
    fixed = []

    def fix(sizes: tuple[int, ...], n: int) -> None:
        for s in sizes:
            counts[s] -= n
        fixed.append((sizes, n))

    for w in range(capacity, 0, -1):
        n = int(counts[w])
        if not n:
            continue
        partner = capacity - w
        if partner == 0:
            fix((w,), n)
        elif partner == w:
            if n >= 2:
                fix((w, w), n // 2)
        elif 0 < partner < w and counts[partner]:
            fix((w, partner), min(n, int(counts[partner])))
    for w in range(capacity, 0, -1):           # largest first; each fixed set shrinks the rest
        while counts[w]:
            room = capacity - w
            small = np.flatnonzero(counts)
            others = small[(small <= room) & ((small != w) | (counts[w] > 1))]
            if len(others) == 0:
                fix((w,), int(counts[w]))
                break
            least = int(others[0])
            second = least if counts[least] - (least == w) > 1 else int(others[1]) if len(others) > 1 else capacity + 1
            if least + second <= room:
                break                          # three pieces fit: no pair dominates by this test
            best = int(others[-1])
            n = int(counts[w]) // 2 if best == w else min(int(counts[w]), int(counts[best]))
            # the two smallest pieces do not grow smaller by taking pieces away, so the test holds for all n
            fix((w, best), max(n, 1))
        if counts[w]:
            break                              # smaller pieces leave more room: the test fails for them too
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram; equal open sequences move as one group."""
    open_: dict[int, list[list]] = {}          # room -> [sizes, how many]
    rooms: list[int] = []                      # sorted rooms with groups
    out = []

    def put(room: int, sizes: tuple[int, ...], n: int) -> None:
        if room == 0:
            out.append((sizes, n))
            return
        if room not in open_:
            open_[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_[room].append([sizes, n])

    for w in range(capacity, 0, -1):
        left = int(counts[w])
        while left:
            i = bisect_left(rooms, w)
            if i == len(rooms):
                fill = capacity // w           # new sequences, filled with equal pieces
                n, rest = divmod(left, fill)
                if n:
                    put(capacity - fill * w, (w,) * fill, n)
                if rest:
                    put(capacity - rest * w, (w,) * rest, 1)
                break
            room = rooms[i]
            sizes, n = open_[room][-1]
            take = min(n, left)
            if take == n:
                open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            else:
                open_[room][-1][1] = n - take
            put(room - w, sizes + (w,), take)
            left -= take
    for groups in open_.values():
        out.extend((tuple(s), n) for s, n in groups)
    return out


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Plan for ``histogram`` (size -> pieces); every size must lie in 1..capacity."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in histogram.items():
        if not 1 <= size <= capacity:
            raise ValueError(f"size {size} outside 1..{capacity}")
        counts[size] += n
    fixed = reduce_sizes(counts, capacity)
    packed = fixed + best_fit(counts, capacity)
    used = np.zeros(capacity + 1, dtype=np.int64)
    slots, first = [], 0
    for sizes, n in packed:
        offset = 0
        for s in sizes:
            slots.append((int(s), int(used[s]), int(n), first, offset))
            used[s] += n
            offset += s
        first += n
    return Plan(slots, first, sum(n for _, n in fixed))


# --- places of the pieces -----------------------------------------------------

def pack(pieces: DataFrame, length_col: str, order_cols: list[str], capacity: int = CAPACITY,
         rows_per_bucket: int = 100_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces``.

    ``pieces`` should be a written table: it is read three times.  Ranks within a
    size come from (size, hash bucket) groups of about ``rows_per_bucket`` rows, so a size
    that holds a third of all rows is still ranked by many tasks.  Rows equal in
    all ``order_cols`` are interchangeable.  A null length, or one outside
    1..capacity, raises.
    """
    spark = pieces.sparkSession
    keyed = pieces.withColumn("_size", F.col(length_col).cast("int"))
    sizes = keyed.groupBy("_size").count().collect()      # at most ``capacity`` rows
    total = sum(r["count"] for r in sizes)
    buckets = max(1, -(-total // rows_per_bucket), spark.sparkContext.defaultParallelism)
    plan = make_plan({r["_size"]: r["count"] for r in sizes}, capacity)
    slots = spark.createDataFrame(
        plan.slots or [(0, 0, 0, 0, 0)],
        "_s int, _from bigint, _n bigint, _first bigint, offset bigint")
    keyed = keyed.withColumn("_bucket", F.pmod(F.xxhash64(*order_cols), F.lit(buckets)).cast("int"))
    per = keyed.groupBy("_size", "_bucket").agg(F.count(F.lit(1)).alias("_k"))
    before = per.select(F.col("_size").alias("_size2"), F.col("_bucket").alias("_bucket2"),
                        (F.sum("_k").over(Window.partitionBy("_size").orderBy("_bucket")) - F.col("_k")).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_size", "_bucket").orderBy(*order_cols)).cast("bigint") - 1
    ranked = (keyed.withColumn("_local", local)
              .join(before, (F.col("_size") == F.col("_size2")) & (F.col("_bucket") == F.col("_bucket2")))
              .withColumn("_rank", F.col("_local") + F.col("_before")))
    # the slots of a plan are bounded by the capacity, not by the data
    at = slots.groupBy("_s").agg(F.sort_array(F.collect_list(F.struct("_from", "_n", "_first", "offset"))).alias("_slots"))
    placed = (ranked.join(F.broadcast(at), F.col("_size") == F.col("_s"))
              .withColumn("_slot", F.element_at(F.filter("_slots", lambda x: x["_from"] <= F.col("_rank")), -1))
              .withColumn("sequence_id", F.col("_slot._first") + F.col("_rank") - F.col("_slot._from"))
              .withColumn("offset", F.col("_slot.offset")))
    return placed.select(*pieces.columns, "sequence_id", "offset")


# --- tokens -------------------------------------------------------------------

_PLAIN = re.compile(r"[a-zß-öø-ÿ]+\Z")
_SPACES = bytes.maketrans(b"\n\t\r", b"   ")
_LOWER_SPACES = bytes.maketrans(b"\n\t\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"   abcdefghijklmnopqrstuvwxyz")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte that byte-level vocabularies use."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordTokens:
    """Token ids of whole texts, word by word.

    The vocabulary never joins tokens over white space, so a text's ids are its
    words' ids in a row.  Words repeat, so each distinct one is encoded once and kept.  Two generations of
    ``max_words`` words bound the memory: when the young one is full it becomes the old one, and words that are met
    again move back, so frequent words never leave.

    Only the path travels; a copy on a worker loads the vocabulary and learns its words there.  Sent as a broadcast
    variable, one copy serves all tasks of a worker.
    """

    def __init__(self, path: str, max_words: int = 400_000):
        from tokenizers import Tokenizer
        self.path, self.max_words = path, max_words
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __reduce__(self):
        return WordTokens, (self.path, self.max_words)

    def word(self, w: str) -> bytes:
        if _PLAIN.match(w):                             # lower-case letters: nothing to normalise or to split
            mapped = w if w.isascii() else "".join([self.letters[b] for b in w.encode()])
            ids = [t.id for t in self.tokenizer.model.tokenize(mapped)]
        else:
            ids = self.tokenizer.encode(w, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def known(self, w: str) -> bytes:
        got = self.young.get(w)
        if got is None:
            got = self.old.get(w)
            if got is None:
                got = self.word(w)
            self.young[w] = got
        return got

    def unknown(self, w: str) -> bytes:
        """A word that is not in the young generation; punctuation after a letter is a token of its own."""
        body = w.rstrip(".,")
        if body != w and body and _PLAIN.match(body):
            return self.known(body) + self.known(w[len(body):])
        return self.known(w)

    def ids(self, text: str) -> np.ndarray:
        """uint32 ids of ``text``."""
        if len(self.young) > self.max_words:
            self.old, self.young = self.young, {}
        lookup, unknown = self.young.get, self.unknown
        # special tokens are matched before lower-casing
        words = text.encode().translate(_SPACES if "<|" in text else _LOWER_SPACES).decode().split(" ")
        return np.frombuffer(b"".join([lookup(w) or unknown(w) for w in words]), dtype="<u4")


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids binary): little-endian unsigned 32-bit token ids.

    A document's tokens end with ``end_id``; only longer ones than ``capacity`` are cut, into
    full pieces and a last one.  A null or empty text is one piece with the end id alone.
    Null ids and repeated rows each give their own pieces.  The tokenizer file
    must exist at the same path on every executor.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    words = docs.sparkSession.sparkContext.broadcast(WordTokens(tokenizer_path))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = words.value
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            at, piece, start, length, ids = [], [], [], [], []

            def flush():
                return pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])
            held = 0
            for i in range(len(texts)):
                text = texts[i].as_py()
                all_ids = np.append(tok.ids(text) if text else np.zeros(0, "<u4"), np.uint32(end_id)).astype("<u4")
                for p, s in enumerate(range(0, len(all_ids), capacity)):
                    part = all_ids[s:s + capacity]
                    at.append(i)
                    piece.append(p)
                    start.append(s)
                    length.append(len(part))
                    ids.append(part.tobytes())
                    held += part.nbytes
                if held > 8 << 20:
                    yield flush()
                    at, piece, start, length, ids, held = [], [], [], [], [], 0
            if at:
                yield flush()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Tokens are made once; the written table keeps each piece's length and checksum.
    :func:`packed_tokens` gives the sequences themselves.
    """
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    slim = written(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")),
                   "pack-pieces")
    return pack(slim, "length", ["doc_id", "piece", "ids_crc32"], capacity)


def packed_tokens(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                  end_id: int = END_ID) -> DataFrame:
    """One row per sequence: sequence_id, length, tokens array<int>, doc_ids; at most ``capacity`` tokens each."""
    pieces = written(token_pieces(docs, tokenizer_path, capacity, end_id), "pack-tokens")
    placed = pack(pieces, "length", ["doc_id", "piece", "ids"], capacity)

    @F.arrow_udf("array<int>")
    def numbers(ids: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x.as_py(), "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))

    parts = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    whole = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return parts.select("sequence_id", "length", F.col("parts.doc_id").alias("doc_ids"),
                        numbers(whole).alias("tokens"))
