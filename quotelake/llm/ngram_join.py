"""N-gram Jaccard join by universe partition and pigeonhole.

Two sets of sizes x and y with Jaccard similarity of at least 3/4 differ in at
most (x + y) / 7 elements.  Hash the universe into segments: with more
difference allowances handed out than elements may differ, one segment differs
within its allowance.  A segment gets allowance "skip" (0 units), "equal" (1) or "one
deletion" (2), the cheapest units first by the document frequencies of its
tokens, so segments made of widespread passages are passed over.

Steps: equal sets form classes; tokens that occur in one class only cannot be
shared and just use up the allowance, so most classes drop out; the rest index
segment subsets with their one-deletion neighbourhoods by size band, probe their
allocated units, and every candidate is verified on its whole set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SHINGLE_WORDS, Scratch, distinct_per_row, mix64, shingle_hashes, text_batches, word_hashes, written
from .components import connected_components


@dataclass(frozen=True)
class JoinRules:
    """Similarity is ``percent`` of the union; the sizes below only trade time for memory."""

    words: int = SHINGLE_WORDS
    percent: int = 75
    segment_percent: int = 40      # segments per 100 elements of the band's smallest set,
    min_segments: int = 8          # but one per element up to so many, so that units suffice without empty segments
    all_pairs: int = 4096          # a signature with more probe x index pairs is resolved by components first
    block_rows: int = 1024         # sets of a tangle compared at once, about so many
    block_tokens: int = 1 << 20    # and tokens


BATCH_SCHEMA = "part int, batch bigint, kind tinyint, a binary, b binary, c binary"
META, TOKENS, SHARED = 0, 1, 2
MANY = 0x8000                      # marks a token of several rows of a batch; the low bits count them


def _bits(spark) -> int:
    """log2 of the number of token buckets: about four per shuffle partition."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(2, min(16, (4 * n - 1).bit_length()))


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _ship(number: int, meta: pa.RecordBatch, tokens: np.ndarray, rows: np.ndarray, bits: int) -> pa.RecordBatch:
    """The rows of one batch: its meta data, and its distinct tokens by bucket.

    A token is the top 48 + bits bits of a shingle's hash.  One that several rows of
    the batch hold is sent once, with their count; its holders stay with the meta data.
    """
    t = tokens >> np.uint64(16 - bits)
    mask = np.uint64((1 << bits) - 1)
    at = np.repeat(np.arange(len(rows) - 1, dtype=np.int64), np.diff(rows))
    key = ((t & mask) << np.uint64(48)) | (t >> np.uint64(bits))
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(first)
    count = np.diff(np.append(start, len(key)))
    mark = np.where(count == 1, at[start], MANY | np.minimum(count, MANY - 1)).astype(np.uint16)
    several = np.repeat(count > 1, count)
    uniq = key[start]
    bucket = (uniq >> np.uint64(48)).astype(np.int64)
    cut = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    low = (uniq & np.uint64(0xFFFFFFFF)).astype("<u4")
    high = ((uniq >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2")
    part, kind, a, b, c = [number % (1 << bits)], [META], [_ipc(meta)], [key[several].tobytes()], \
        [at[several].astype("<u2").tobytes()]
    for i in np.flatnonzero(np.diff(cut)):
        lo, hi = cut[i], cut[i + 1]
        part.append(int(i))
        kind.append(TOKENS)
        a.append(low[lo:hi].tobytes())
        b.append(high[lo:hi].tobytes())
        c.append(mark[lo:hi].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array([number] * len(part), pa.int64()), pa.array(kind, pa.int8()),
         pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(c, pa.binary())],
        names=["part", "batch", "kind", "a", "b", "c"])


def _shared_in_bucket(table: pa.Table, bits: int) -> pa.Table:
    """Of one bucket, each batch's tokens that occur twice or more overall, with their row counts."""
    kind = table.column("kind").to_numpy()
    out = {k: [] for k in ("part", "batch", "kind", "a", "b", "c")}

    def put(part, batch, k, a, b, c):
        for name, v in zip(out, (part, batch, k, a, b, c)):
            out[name].append(v)

    batch, part = table.column("batch").to_pylist(), table.column("part").to_pylist()
    a, b, c = (table.column(x) for x in "abc")
    for i in np.flatnonzero(kind == META):
        put(part[i], batch[i], META, a[i].as_py(), b[i].as_py(), c[i].as_py())
    which = np.flatnonzero(kind == TOKENS)
    if len(which):
        lows = [np.frombuffer(a[i].as_buffer(), "<u4") for i in which]
        sizes = np.array([len(x) for x in lows])
        low = np.concatenate(lows).astype(np.uint64)
        high = np.concatenate([np.frombuffer(b[i].as_buffer(), "<u2") for i in which]).astype(np.uint64)
        mark = np.concatenate([np.frombuffer(c[i].as_buffer(), "<u2") for i in which])
        key = (high << np.uint64(32)) | low
        n = np.where(mark >= MANY, mark & (MANY - 1), 1).astype(np.int64)
        order = np.argsort(key, kind="stable")
        k = key[order]
        first = np.ones(len(k), bool)
        first[1:] = k[1:] != k[:-1]
        start = np.flatnonzero(first)
        df = np.add.reduceat(n[order], start)
        each = np.empty(len(k), np.int64)
        each[order] = np.repeat(df, np.diff(np.append(start, len(k))))
        begin = np.concatenate([[0], np.cumsum(sizes)])
        for j, i in enumerate(which):
            s = slice(begin[j], begin[j + 1])
            ok = each[s] >= 2
            if ok.any():
                full = (np.uint64(part[i]) << np.uint64(48)) | key[s][ok]
                put(part[i], batch[i], SHARED, full.tobytes(), mark[s][ok].tobytes(),
                    np.minimum(each[s][ok], 0xFFFFFFFF).astype("<u4").tobytes())
    kinds = {"part": pa.int32(), "batch": pa.int64(), "kind": pa.int8(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary()}
    return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})


def _join_batch(table: pa.Table, percent: int) -> pa.Table:
    """One batch again: its meta data with each row's shared tokens (null where too few for any link)."""
    kind = table.column("kind").to_pylist()
    i = kind.index(META)
    meta = pa.ipc.open_stream(table.column("a")[i].as_buffer()).read_all()
    many = np.frombuffer(table.column("b")[i].as_buffer(), "<u8")
    many_at = np.frombuffer(table.column("c")[i].as_buffer(), "<u2").astype(np.int64)
    keys, marks, dfs = [np.zeros(0, "<u8")], [np.zeros(0, "<u2")], [np.zeros(0, "<u4")]
    for j, k in enumerate(kind):
        if k == SHARED:
            keys.append(np.frombuffer(table.column("a")[j].as_buffer(), "<u8"))
            marks.append(np.frombuffer(table.column("b")[j].as_buffer(), "<u2"))
            dfs.append(np.frombuffer(table.column("c")[j].as_buffer(), "<u4"))
    key, mark, df = np.concatenate(keys), np.concatenate(marks), np.concatenate(dfs)
    single = mark < MANY
    known = np.argsort(key)
    many_df = df[known][np.searchsorted(key[known], many)] if len(many) else np.zeros(0, "<u4")
    at = np.concatenate([mark[single].astype(np.int64), many_at])
    token = np.concatenate([key[single], many])
    df = np.concatenate([df[single], many_df])
    order = np.lexsort((token, at))
    at, token, df = at[order], token[order], df[order].astype("<u4")
    rows = np.searchsorted(at, np.arange(meta.num_rows + 1))
    n = meta.column("n").to_numpy()
    tokens, freqs = [], []
    for r in range(meta.num_rows):
        lo, hi = rows[r], rows[r + 1]
        ok = n[r] > 0 and 100 * (hi - lo) >= percent * n[r]
        tokens.append(token[lo:hi].tobytes() if ok else None)
        freqs.append(df[lo:hi].tobytes() if ok else None)
    return (meta.append_column("tokens", pa.array(tokens, pa.binary()))
            .append_column("freqs", pa.array(freqs, pa.binary())))


def _shared_tokens(shipped: DataFrame, bits: int, percent: int, schema: T.StructType) -> DataFrame:
    """From shipped batches to rows (meta columns, tokens, freqs)."""
    def in_bucket(table: pa.Table) -> pa.Table:
        return _shared_in_bucket(table, bits)

    def of_batch(table: pa.Table) -> pa.Table:
        return _join_batch(table, percent)

    back = shipped.groupBy("part").applyInArrow(in_bucket, BATCH_SCHEMA)
    full = T.StructType([*schema.fields, T.StructField("tokens", T.BinaryType()), T.StructField("freqs", T.BinaryType())])
    return back.groupBy("batch").applyInArrow(of_batch, full)


def _set_id(h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One 64-bit name per set: two independent sums over its elements, mixed with its size."""
    n = np.diff(rows)
    a, b = mix64(h), mix64(h ^ np.uint64(0xA5A5A5A5DEADBEEF))
    ca = np.concatenate([np.zeros(1, np.uint64), np.cumsum(a, dtype=np.uint64)])
    cb = np.concatenate([np.zeros(1, np.uint64), np.cumsum(b, dtype=np.uint64)])
    sa, sb = ca[rows[1:]] - ca[rows[:-1]], cb[rows[1:]] - cb[rows[:-1]]
    return mix64(mix64(sa) + sb * np.uint64(3) + n.astype(np.uint64)).view(np.int64)


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _text_sets(docs: DataFrame, id_col: str, text_col: str, rules: JoinRules, bits: int) -> DataFrame:
    """All texts: doc_id, n (set size), cls (name of the set), shared tokens of possible partners."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType),
                           T.StructField("key", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("cls", T.LongType())])

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for batch, data, offsets in text_batches(batches, "text"):
            words, rows = word_hashes(data, offsets, lower=True)
            h, rows = distinct_per_row(*shingle_hashes(words, rows, rules.words))
            meta = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(rows)), pa.array(_set_id(h, rows))],
                names=["doc_id", "key", "n", "cls"])
            yield _ship(number, meta, h, rows, bits)
            number += 1

    shipped = docs.select(F.col(id_col).alias("doc_id"), _text_key(F.col(text_col)).alias("key"),
                          F.col(text_col).alias("text")).mapInArrow(ship, BATCH_SCHEMA)
    return _shared_tokens(shipped, bits, rules.percent, schema)


def _class_sets(classes: DataFrame, rules: JoinRules, bits: int) -> DataFrame:
    """The same step over one set per class: frequencies now count classes."""
    schema = T.StructType([T.StructField("cls", T.LongType()), T.StructField("n", T.LongType())])

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                end, held = start, 0
                while end < batch.num_rows and held < 8 << 20 and end - start < 30_000:
                    held += len(batch.column(2)[end].as_buffer())
                    end += 1
                part = batch.slice(start, end - start)
                sets = [np.frombuffer(x.as_buffer(), "<u8") for x in part.column(2)]
                rows = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
                key = np.concatenate(sets)
                low, bucket = key & np.uint64((1 << 48) - 1), key >> np.uint64(48)
                h = ((low << np.uint64(bits)) | bucket) << np.uint64(16 - bits)
                meta = pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["cls", "n"])
                yield _ship(number, meta, h, rows, bits)
                number += 1
                start = end

    shipped = classes.select("cls", "n", "tokens").mapInArrow(ship, BATCH_SCHEMA)
    return _shared_tokens(shipped, bits, rules.percent, schema).filter("tokens IS NOT NULL")


# --- segments, neighbourhoods, allocation --------------------------------------

def size_bands(largest: int, percent: int) -> np.ndarray:
    """Lower ends of the size bands; a set probes its own band and those down to percent of its size."""
    ends = [1]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
    return np.array(ends)


def max_difference(x: int, y: int, percent: int) -> int:
    """Most elements by which sets of sizes x and y may differ: U - I with 100 I >= percent U."""
    return (x + y) * (100 - percent) // (100 + percent)


def segment_signatures(tokens: np.ndarray, freqs: np.ndarray, n: int, band: int, low: int, high: int,
                       own: bool, rules: JoinRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, is probe, is index) of one set under one band's scheme.

    ``low``..``high`` are the band's sizes; ``own``: the set lies in this band, so it is indexed.
    """
    m = max(low * rules.segment_percent // 100, min(low, rules.min_segments))
    salt = mix64(np.array([band * 2654435761 + 97], np.uint64))
    mixed = mix64(tokens + salt)
    seg = (mixed % np.uint64(m)).astype(np.int64)
    value = mix64(mixed)
    order = np.argsort(seg, kind="stable")
    seg, value, freq = seg[order], value[order], freqs[order].astype(np.float64)
    size = np.bincount(seg, minlength=m)
    begin = np.concatenate([[0], np.cumsum(size)])
    total = np.zeros(m, np.uint64)
    np.add.at(total, seg, value)
    place = mix64(np.arange(m, dtype=np.uint64) + salt * np.uint64(31))
    equal = mix64(total + place)
    without = total[seg] - value + place[seg]           # one token deleted, per token
    shorter = mix64(without)                            # as an equal subset of a partner
    partner = mix64(without ^ np.uint64(0x5DEECE66D))   # index key of "I am this plus one token"
    longer = mix64((total + place) ^ np.uint64(0x5DEECE66D))

    left = max_difference(n, min(high, n), rules.percent) - (n - len(tokens))
    sig, probe, index = [], [], []

    def put(keys, p, i):
        sig.append(keys)
        probe.append(np.full(len(keys), p))
        index.append(np.full(len(keys), i))

    chosen_equal = np.zeros(m, bool)
    chosen_delete = np.zeros(m, bool)
    if left >= 0:
        huge = 1e18
        cost1, cost2 = np.full(m, huge), np.full(m, 2 * huge)
        full = np.flatnonzero(size)
        by = np.lexsort((freq, seg))
        least = freq[by][begin[full]]
        cost1[full] = least
        two = full[size[full] >= 2]
        second = freq[by][begin[two] + 1]
        cost2[two] = cost1[two] * (size[two] + 1) + second
        units = np.concatenate([cost1, cost2])
        take = np.argsort(units, kind="stable")[:left + 1]
        chosen_equal[take[take < m]] = True
        chosen_delete[take[take >= m] - m] = True
    if own:
        put(equal[chosen_equal], True, True)
        put(equal[~chosen_equal], False, True)
        put(partner, False, True)
    else:
        put(equal[chosen_equal], True, False)
    put(longer[chosen_delete], True, False)
    put(shorter[chosen_delete[seg]], True, False)
    return np.concatenate(sig), np.concatenate(probe), np.concatenate(index)


def _signatures(sets: DataFrame, rules: JoinRules) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [[], [], [], []]
            held = 0
            for cls, n, tokens, freqs in zip(*(batch.column(i) for i in range(4))):
                cls, n = cls.as_py(), n.as_py()
                tokens, freqs = np.frombuffer(tokens.as_buffer(), "<u8"), np.frombuffer(freqs.as_buffer(), "<u4")
                ends = size_bands(n, rules.percent)
                own = int(np.searchsorted(ends, n, side="right")) - 1
                least = int(np.searchsorted(ends, -(-n * rules.percent // 100), side="right")) - 1
                for band in range(max(0, least), own + 1):
                    s, p, i = segment_signatures(tokens, freqs, n, band, int(ends[band]), int(ends[band + 1]) - 1,
                                                 band == own, rules)
                    for col, v in zip(cols, (s.view(np.int64), np.full(len(s), cls), p, i)):
                        col.append(v)
                    held += len(s)
                if held > 400_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                                     names=["sig", "cls", "probe", "is_index"])
                    cols, held = [[], [], [], []], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                                 names=["sig", "cls", "probe", "is_index"])
    return sets.select("cls", "n", "tokens", "freqs").mapInArrow(
        emit, "sig bigint, cls bigint, probe boolean, is_index boolean")


# --- candidates and verification ------------------------------------------------

def _verified(pairs: DataFrame, sets: DataFrame, rules: JoinRules) -> DataFrame:
    """The pairs (a, b) that meet the threshold on their whole sets."""
    percent = rules.percent

    @F.arrow_udf("boolean")
    def similar(ta: pa.Array, tb: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
        out = []
        for a, b, x, y in zip(ta, tb, na, nb):
            a, b = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (x.as_py() + y.as_py() - both))
        return pa.array(out, pa.bool_())

    def side(name: str) -> DataFrame:
        return sets.select(F.col("cls").alias(name), F.col("n").alias("n" + name), F.col("tokens").alias("t" + name))

    size = sets.select("cls", "n", (F.octet_length("tokens") / 8).cast("bigint").alias("k"))
    least = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    possible = (pairs.join(size.toDF("a", "na", "ka"), "a").join(size.toDF("b", "nb", "kb"), "b")
                .filter(F.least("ka", "kb", "na", "nb") >= least).select("a", "b"))
    return (possible.join(side("a"), "a").join(side("b"), "b")
            .filter(similar("ta", "tb", "na", "nb")).select("a", "b"))


def jaccard_links(sets: DataFrame, rules: JoinRules) -> DataFrame:
    """(node, component) over classes: connected by links of at least the threshold.

    ``sets``: written table of (cls, n, tokens, freqs).  Signatures with few probe x
    index pairs give all of them.  For the others, each probe is first checked
    against one index member; where members still lie in different
    components, all pairs across components are compared in blocks.  So no link between
    components is lost, and a large group of copies does not give all its pairs.
    """
    scratch = Scratch(sets.sparkSession)
    sigs = scratch.written(_signatures(sets, rules), "join-signatures")
    per = (sigs.groupBy("sig")
           .agg(F.sum(F.col("probe").cast("bigint")).alias("p"), F.sum(F.col("is_index").cast("bigint")).alias("i"),
                F.min("cls").alias("lo"), F.max("cls").alias("hi"),
                F.min(F.when(F.col("is_index"), F.col("cls"))).alias("pivot"))
           .filter("p > 0 AND i > 0 AND lo < hi"))
    big = F.col("p") * F.col("i") > rules.all_pairs
    live = scratch.written(sigs.join(per.select("sig", "pivot", big.alias("big")), "sig"), "join-live")
    scratch.drop(sigs)
    few = live.filter(~F.col("big"))
    x = few.filter("probe").select("sig", F.col("cls").alias("x"))
    y = few.filter("is_index").select("sig", F.col("cls").alias("y"))

    def ordered(df: DataFrame) -> DataFrame:
        return (df.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                .filter("a < b").distinct())

    star = live.filter("big AND probe").select(F.col("cls").alias("x"), F.col("pivot").alias("y"))
    first = ordered(x.join(y, "sig").select("x", "y").unionByName(star))
    links = written(_verified(first, sets, rules), "join-links")
    found = written(connected_components(links), "join-components")
    many = live.filter("big")
    if many.isEmpty():
        scratch.drop_all()
        return found
    label = F.coalesce("component", "cls")
    named = scratch.written(many.join(found.withColumnRenamed("node", "cls"), "cls", "left")
                            .select("sig", "cls", "probe", "is_index", label.alias("label")), "join-named")
    scratch.drop(live)
    mixed = (named.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("cls").alias("pivot"))
             .filter("lo < hi").select("sig", "pivot"))
    rest = named.join(mixed, "sig")
    shares = rest.select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct()
    tangles = written(connected_components(shares), "join-tangles")
    own = named.select("cls", "label").distinct()
    more = written(_block_links(tangles.toDF("cls", "tangle").join(own, "cls"), sets, rules), "join-links")
    scratch.drop_all()
    return connected_components(links.unionByName(more))


def _block_links(members: DataFrame, sets: DataFrame, rules: JoinRules) -> DataFrame:
    """Links (a, b) between different labels inside each tangle, enough of them to join the labels.

    ``members``: (cls, tangle, label).  A tangle is a set of classes that hang together by large
    signatures; near misses of one text make most of it, so nearly every pair would be a
    candidate.  Its members are dealt into blocks of about ``block_rows`` sets and ``block_tokens`` tokens, and every pair of blocks
    is compared as one matrix product in a task of bounded size: no row is made per pair.
    """
    percent = rules.percent
    size = sets.select("cls", (F.octet_length("tokens") / 8).alias("k"))
    need = F.greatest(F.count(F.lit(1)) / rules.block_rows, F.sum("k") / rules.block_tokens)
    blocks = members.join(size, "cls").groupBy("tangle").agg(F.ceil(need).cast("int").alias("blocks"))
    dealt = (members.join(blocks, "tangle")
             .withColumn("own", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cls", "tangle", "label", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
             .join(sets.select("cls", "n", "tokens"), "cls"))

    def compare(table: pa.Table) -> pa.Table:
        a, b = _links_in_blocks(table, percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("tangle", "lo", "hi").applyInArrow(compare, "a bigint, b bigint")


def _links_in_blocks(table: pa.Table, percent: int, columns: int = 4096) -> tuple[list[int], list[int]]:
    """Links that join different labels among the rows of one block, or between two blocks."""
    own, lo, hi = (table.column(c).to_numpy() for c in ("own", "lo", "hi"))
    cls, label, n = (table.column(c).to_numpy() for c in ("cls", "label", "n"))
    tokens = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("tokens")]
    left = np.flatnonzero(own == lo)
    right = np.flatnonzero(own == hi)
    if not len(left) or not len(right):
        return [], []
    size = np.array([len(t) for t in tokens])
    row = np.repeat(np.arange(len(tokens)), size)
    _, word, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    keep = count[word] > 1
    row, word = row[keep], word[keep]
    used, word = np.unique(word, return_inverse=True)
    order = np.argsort(word, kind="stable")
    row, word = row[order], word[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(used), columns):
        s = slice(*np.searchsorted(word, [start, start + columns]))
        part = np.zeros((len(tokens), min(columns, len(used) - start)), np.float32)
        part[row[s], word[s] - start] = 1
        both += part[left] @ part[right].T
    both = both.astype(np.int64)
    similar = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
    similar &= label[left][:, None] != label[right][None, :]
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            x = up[x]
        return x

    a, b = [], []
    for i, j in zip(*np.nonzero(similar)):
        x, y = root(int(label[left[i]])), root(int(label[right[j]]))
        if x != y:
            up[max(x, y)] = min(x, y)
            a.append(int(cls[left[i]]))
            b.append(int(cls[right[j]]))
    return a, b


def near_duplicates(docs: DataFrame, rules: JoinRules = JoinRules(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable), group, text_key.

    Texts without words have an empty set and no links (``group`` is null).  Rows with the same
    set are one class; repeated rows and repeated ids stay rows of their own.  A null id
    takes part but never names a component unless all its ids are null.  ``docs``
    should be a stored table, so that a task that runs again sees the same rows.
    """
    bits = _bits(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    texts = scratch.written(_text_sets(docs, id_col, text_col, rules, bits), "join-texts")
    rows = written(texts.select("doc_id", "key", "n", "cls"), "join-rows")
    classes = (texts.filter("tokens IS NOT NULL").groupBy("cls")
               .agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")))
    sets = scratch.written(_class_sets(classes, rules, bits), "join-sets")
    scratch.drop(texts)
    component = written(jaccard_links(sets, rules), "join-groups")
    scratch.drop(sets)
    of_class = rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    named = of_class.join(component.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.select("cls", "least", F.coalesce("component", "cls").alias("group"))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "group").select("cls", "group", "component_id")
    out = rows.select("doc_id", F.col("key").alias("text_key"), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("cls")).alias("cls"))
    return (out.join(ids, "cls", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "group", "text_key"))


def near_duplicate_filter(docs: DataFrame, rules: JoinRules = JoinRules(), id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """One row of each group, the one with the smallest id (then text hash); all columns as they are.

    Texts without words are in no group and stay.  Rows equal in id and text are one document.
    """
    rows = near_duplicates(docs, rules, id_col, text_col)
    one = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")
    stay = (rows.filter("group IS NOT NULL").groupBy("group").agg(F.min(one).alias("one"))
            .select("one.doc_id", "one.text_key")
            .unionByName(rows.filter("group IS NULL").select("doc_id", "text_key")).distinct()
            .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text_key")))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(id_col).alias("_doc"), _text_key(F.col(text_col)).alias("_key"))
    kept = held.join(stay, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text_key")))
    kept = kept.dropDuplicates(["_id", "_text_key"])
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
