"""Line dedup by a distributed suffix array over line-ID sequences.

Every line with a word is a symbol; a document is a sequence of symbols.  The longest block that begins at a line and
also begins at an earlier line (of an earlier document, or earlier in the same one) is that line's maximal repeated run.  Runs
with at least ``min_words`` words go, as a whole.

Prefix doubling sorts the suffixes by their first 1, 2, 4, ... symbols: round k ranks
pairs (rank of the first half, rank of the second half).  Suffixes of one rank form an LCP interval: their first 2^k
lines are equal.  Suffixes alone in their interval leave.  Two overlapping ranks of round k name a block of any
length from 2^k to 2^(k+1) - 1, so the ranks tell which blocks of any length are later copies.

The depth of the array follows from the floor.  Every line has a word, so ``min_words`` lines always reach it.  Take a run that
reaches the floor and a line in it: either the least block from the run's first line on that reaches the floor
holds the line, or the least block that ends at the line and reaches it lies inside the run.  Both are blocks of at
most ``min_words`` lines with the same earlier copy, and any such block lies in a run that reaches the floor.  So the
lines that go are those of all *least blocks* (from a line on, or up to a line) that are later copies, and the suffixes
must be sorted by their first ``min_words`` lines only, however long the runs are.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_PATTERN, Scratch, written

MIN_WORDS = 16
ROWS_PER_BUCKET = 20_000   # of the order buckets that split one class; their number follows the input


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _ranked(pairs: DataFrame, bucket: Column) -> DataFrame:
    """Adds ``rank`` to the distinct (r1, r2, n): r1 plus the members of the same r1 with a smaller r2.

    ``bucket`` grows with r2 and takes a bounded number of values; a class is
    counted by bucket first, so a class that holds a third of all suffixes is
    ranked by as many tasks as it has buckets.
    """
    p = pairs.withColumn("bucket", bucket)
    per = p.groupBy("r1", "bucket").agg(F.sum("n").alias("k"))
    before = per.select(
        "r1", "bucket", (F.sum("k").over(Window.partitionBy("r1").orderBy("bucket")) - F.col("k")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("r1", "bucket").orderBy("r2")) - F.col("n")
    return (p.join(before, ["r1", "bucket"])
            .withColumn("rank", F.col("r1") + F.col("before") + inside).drop("bucket", "before"))


def _round(halves: DataFrame, bucket: Column) -> DataFrame:
    """One doubling step: rows (doc, key, seq, r1, r2) to (doc, key, seq, rank) of the suffixes that share their rank."""
    pairs = halves.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n"))
    ranks = _ranked(pairs.filter("n > 1"), bucket)
    return halves.join(ranks, ["r1", "r2"]).select("doc", "key", "seq", "rank")


def _least_block(words: Column, min_words: int) -> Column:
    """How many of the first numbers of an array reach ``min_words``; null if all together do not."""
    sums = F.aggregate(words, F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("n")),
                       lambda a, w: F.when(a["sum"] >= min_words, a).otherwise(F.struct(a["sum"] + w, a["n"] + 1).cast("struct<sum:bigint,n:int>")))
    return F.when(sums["sum"] >= min_words, sums["n"])


def _later_copies(blocks: DataFrame, ranks: DataFrame, length: int) -> DataFrame:
    """(doc, key, seq, end) of the blocks (doc, key, seq, len) that equal an earlier block.

    ``ranks`` are those of the first ``length`` lines, ``length <= len < 2 * length``.  Blocks are equal when the
    ranks at their start and at ``length`` lines before their end are.
    """
    here = (blocks.filter(f"len >= {length} AND len < {2 * length}")
            .join(ranks.withColumnRenamed("rank", "r1"), ["doc", "key", "seq"])
            .withColumn("inner", F.col("seq") + F.col("len") - length))
    inner = ranks.select("doc", "key", F.col("seq").alias("inner"), F.col("rank").alias("r2"))
    named = here.join(inner, ["doc", "key", "inner"])
    place = F.struct("doc", "key", "seq")
    first = named.groupBy("len", "r1", "r2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    return (named.join(first, ["len", "r1", "r2"]).filter(place != F.col("first"))
            .select("doc", "key", "seq", (F.col("seq") + F.col("len")).alias("end")))


def line_symbols(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, seq, pos, line, words): the lines with words of every distinct (id, text).

    ``doc`` is a struct so that a null id has an order (first) and joins as a value.
    """
    return (docs.select(F.struct(F.col(id_col).isNotNull().alias("known"),
                                 F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("id")).alias("doc"),
                        _text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
            .select("doc", "key", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
            .select("doc", "key", "pos", F.xxhash64("text").alias("line"),
                    F.regexp_count("text", F.lit(WORD_PATTERN)).alias("words"))
            .filter("words > 0"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc, key, runs): for every document with deletions, its runs of line positions [from, to].

    A line goes if it lies in a maximal repeated run with at least ``min_words`` words: the longest block of
    consecutive lines (lines without words do not count) from some line on that equals an earlier block, earlier by (id, text
    hash, position).  Lines without words go when they stand between two lines of one run.
    """
    lines = line_symbols(docs, id_col, text_col)
    # one shuffle by document serves all: one of each repeated row, the numbering and the least blocks
    lines = (lines.repartition("doc", "key").groupBy("doc", "key", "pos")
             .agg(F.first("line").alias("line"), F.first("words").alias("words")))
    in_doc = Window.partitionBy("doc", "key").orderBy("pos")
    ahead = F.collect_list("words").over(in_doc.rowsBetween(0, min_words - 1))
    behind = F.reverse(F.collect_list("words").over(in_doc.rowsBetween(1 - min_words, 0)))
    lines = lines.withColumn("seq", F.row_number().over(in_doc).cast("bigint"))
    lines = lines.select("*", ahead.alias("ahead"), behind.alias("behind"))
    lines = written(lines.select("doc", "key", "pos", "line", "seq", _least_block(F.col("ahead"), min_words).alias("on"),
                                 _least_block(F.col("behind"), min_words).alias("up")), "line-symbols")
    blocks = (lines.filter("on IS NOT NULL").select("doc", "key", "seq", F.col("on").alias("len"))
              .unionByName(lines.filter("up IS NOT NULL").select("doc", "key", (F.col("seq") - F.col("up") + 1).alias("seq"),
                                                                  F.col("up").alias("len"))).distinct())
    scratch = Scratch(docs.sparkSession)
    blocks = scratch.written(blocks, "line-blocks")
    spread = max(4, (lines.count() // ROWS_PER_BUCKET).bit_length())
    start = lines.select("doc", "key", "seq", F.lit(0).cast("bigint").alias("r1"), F.col("line").alias("r2"))
    live = scratch.written(_round(start, F.shiftright("r2", 64 - spread)), "line-round")
    size, length, marks = live.agg(F.max("rank")).first()[0], 1, []
    while size is not None:
        marks.append(written(_later_copies(blocks, live, length), "line-marks"))
        if 2 * length > min_words:
            break
        x, y = live.alias("x"), live.alias("y")
        halves = (x.join(y, (F.col("x.doc") == F.col("y.doc")) & (F.col("x.key") == F.col("y.key"))
                         & (F.col("x.seq") + length == F.col("y.seq")))
                  .select("x.doc", "x.key", "x.seq", F.col("x.rank").alias("r1"), F.col("y.rank").alias("r2")))
        bucket = F.floor(F.col("r2") * (1 << spread) / F.lit(size + 1)).cast("bigint")
        before, live = live, scratch.written(_round(halves, bucket), "line-round")
        scratch.drop(before)
        size, length = live.agg(F.max("rank")).first()[0], 2 * length
    if not marks:
        marks = [live.select("doc", "key", "seq", F.col("seq").alias("end")).limit(0)]
    else:
        scratch.drop_all()
    all_marks = marks[0]
    for m in marks[1:]:
        all_marks = all_marks.unionByName(m)
    steps = (all_marks.select("doc", "key", F.col("seq").alias("seq"), F.lit(1).alias("step"))
             .unionByName(all_marks.select("doc", "key", F.col("end").alias("seq"), F.lit(-1).alias("step")))
             .groupBy("doc", "key", "seq").agg(F.sum("step").alias("step")))
    touched = steps.select("doc", "key").distinct()
    in_doc = Window.partitionBy("doc", "key").orderBy("seq")
    covered = (lines.join(touched, ["doc", "key"], "left_semi")
               .join(steps, ["doc", "key", "seq"], "left")
               .withColumn("open", F.sum(F.coalesce("step", F.lit(0))).over(in_doc))
               .filter("open > 0")
               .withColumn("island", F.col("seq") - F.row_number().over(in_doc)))
    runs = (covered.groupBy("doc", "key", "island")
            .agg(F.min("pos").alias("from"), F.max("pos").alias("to")))
    return (runs.groupBy("doc", "key")
            .agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs")))


def _with_runs(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(_row, _lines, _runs, _kept): every input row with its lines and what remains of them."""
    runs = repeated_runs(docs, min_words, id_col, text_col)
    runs = runs.select(F.col("doc").alias("_doc"), F.col("key").alias("_key"), F.col("runs").alias("_runs"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.struct(F.col(id_col).isNotNull().alias("known"),
                 F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("id")).alias("_d"),
        _text_key(F.col(text_col)).alias("_k"))
    both = rows.join(runs, (F.col("_d") == F.col("_doc")) & (F.col("_k") == F.col("_key")), "left")
    text = F.col(f"_row.`{text_col}`")
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.exists("_runs", lambda r: r["from"].cast("int") <= i) |
                    ~F.exists("_runs", lambda r: (r["from"] <= i) & (i <= r["to"])))
    return both.select("_row", F.coalesce("_runs", F.array().cast("array<struct<from:int,to:int>>")).alias("_runs"),
                       F.when(F.col("_runs").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("_kept"))


def deduplicate_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, removed (``from-to`` line ranges), text.

    A null text has no lines and stays null.  Rows equal in id and text are one document
    and get the same result; different texts under one id, or a null id, are
    documents of their own (a null id comes first).  Ids must be integers.
    """
    out = _with_runs(docs, min_words, id_col, text_col)
    text = F.col(f"_row.`{text_col}`")
    removed = F.aggregate("_runs", F.lit(0).cast("bigint"), lambda a, r: a + r["to"] - r["from"] + 1)
    return out.select(
        F.col(f"_row.`{id_col}`").alias("doc_id"),
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("bigint").alias("n_lines"),
        removed.alias("n_removed"),
        F.array_join(F.transform("_runs", lambda r: F.concat_ws("-", r["from"], r["to"])), ",").alias("removed"),
        F.col("_kept").alias("text"))


def line_dedup_filter(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                      text_col: str = "text", size_col: str | None = None) -> DataFrame:
    """``docs`` with the later copies taken out of ``text_col``; other columns as they are.

    A document that loses all its words leaves.  ``size_col``, if given, becomes
    the new text's length.
    """
    out = _with_runs(docs, min_words, id_col, text_col)
    out = out.filter((F.size("_runs") == 0) | F.col("_kept").rlike(WORD_PATTERN))

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("_kept").alias(c)
        if c == size_col:
            return F.length("_kept").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"_row.`{c}`").alias(c)
    return out.select(*[column(c) for c in docs.columns])
