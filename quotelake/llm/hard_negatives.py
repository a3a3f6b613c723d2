"""Hard-negative mining with bounds along a spanning tree of the anchors.

For an anchor c with parent p in the tree and any candidate x, ``|c.x - p.x| <= |c - p| * |x|``.  So a
parent's score, or its bounds, gives bounds of the child's score: the parent's plus or minus the edge's
length times the candidate's norm.  Only candidates whose bounds overlap the window an anchor asks for are scored
again; the others keep their bounds and hand them down the tree.

Two passes over (anchor group, candidate shard) pairs of bounded size: the first finds each anchor's positives
(window: from the k-th best lower bound upwards), the second its negatives (windows: the score ranges the positives
allow, from the best lower bounds downwards).  A block of anchors has one tree; it takes anchors of one cell around a
pivot, so that edges are short, and a cell with many anchors has several blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written


@dataclass(frozen=True)
class MiningRules:
    scale: int = 256
    every: int = 50                 # anchors: ids divisible by this
    positives: int = 5
    negatives: int = 3
    low: int = 50                   # low * positive <= 100 * negative <= high * positive
    high: int = 95
    block_anchors: int = 1024       # anchors of one tree
    blocks_per_group: int = 16      # trees that one task searches, so that a shard is sent once for all of them
    cells: int = 64                 # pivots (a sample of the anchors) at most
    shard_rows: int = 8192
    flip_every: int = 7             # labels of ids divisible by this move on by one
    flip_modulo: int = 10


EXACT = 2.0 ** 53                   # whole numbers below this are exact in a double
LONG_MAX = 2 ** 63 - 1
WIDEST = 10 ** 37                   # scores are cut to this range before they are ranked


def labelled_vectors(vectors: DataFrame, rules: MiningRules, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, dim, v, row): floor(scale * x) as little-endian doubles; ``row`` is a hash of the other columns.

    Rows that take no part are left out, and rows equal in id, label and vector are one row.
    """
    scale = float(rules.scale)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, dims, blobs = [], [], [], []
            lists = batch.column(2)
            for i, (key, label) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key is None or label is None or not lists[i].is_valid or lists[i].values.null_count:
                    continue
                x = np.asarray(lists[i].values, dtype=np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(x * scale) + 0.0            # -0.0 becomes 0.0
                if not np.isfinite(x).all():
                    continue
                ids.append(key)
                labels.append(label)
                dims.append(len(x))
                blobs.append(x.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(blobs, pa.binary())], names=["id", "label", "dim", "v"])

    key, label = F.col(id_col).cast("bigint"), F.col(label_col).cast("bigint")
    if rules.flip_every:
        label = F.when(key % rules.flip_every == 0, (label + 1) % rules.flip_modulo).otherwise(label)
    rows = vectors.select(key, label, F.col(vec_col)).mapInArrow(convert, "id bigint, label bigint, dim int, v binary")
    return rows.distinct().withColumn("row", F.xxhash64("id", "label", "v"))


# --- the tree ------------------------------------------------------------------------

def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``x`` with ``y``: doubles where all sums stay whole, else Python integers."""
    if x.size and y.size and float(np.abs(x).max()) * float(np.abs(y).max()) * len(y) >= EXACT:
        big = [int(v) for v in y]
        sums = [sum(int(a) * b for a, b in zip(row, big) if a and b) for row in x]
        return np.array([max(-WIDEST, min(WIDEST, s)) for s in sums], dtype=object)
    return x @ y


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows of ``x`` (Prim): visiting order, parent and edge length of each row.

    Lengths are rounded up, so that they bound the true distances.
    """
    n = len(x)
    parent, near = np.full(n, -1), np.full(n, np.inf)
    todo = np.ones(n, bool)
    order, at = [], 0
    near[0] = 0.0
    while True:
        order.append(at)
        todo[at] = False
        if not todo.any():
            return np.array(order), parent, near
        with np.errstate(over="ignore"):
            diff = x - x[at]
            d = np.sqrt((diff * diff).sum(axis=1)) * (1 + 1e-9)
        closer = todo & ((d < near) | (parent < 0))
        near[closer], parent[closer] = d[closer], at
        at = int(np.flatnonzero(todo)[near[todo].argmin()])


def depth_first(order: np.ndarray, parent: np.ndarray) -> list[int]:
    """All nodes, each behind its parent and with its subtree in one piece."""
    children: dict[int, list[int]] = {}
    for node in order:
        children.setdefault(int(parent[node]), []).append(int(node))
    out, stack = [], children[-1][::-1]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(children.get(node, [])))
    return out


@dataclass
class AnchorTree:
    """The anchors of one block in depth-first order; ``parent`` are positions in that order (-1: the root)."""

    rows: list
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    positives: list | None = None      # per anchor the scores of its positives


class Candidates:
    """The candidates of one shard, ascending by id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        at = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[at], labels[at], x[at]
        self.norm = np.sqrt((self.x * self.x).sum(axis=1)) * (1 + 1e-9)


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value; minus infinity with fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def walk(tree: AnchorTree, candidates: Candidates, window) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every anchor of the tree the candidates to look at and their exact scores.

    ``window(anchor, low, high)`` says which candidates may matter, given bounds of their scores.  Yields (anchor,
    positions, scores) with parents before children.  Bounds are dropped behind an anchor's last child.
    """
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    open_children = np.bincount(tree.parent[tree.parent >= 0], minlength=len(tree.ids))
    unlimited = np.full(len(candidates.ids), np.inf)
    for node in range(len(tree.ids)):
        up = int(tree.parent[node])
        if up < 0:
            low, high = -unlimited, unlimited.copy()
        else:
            low, high = held[up]
            with np.errstate(invalid="ignore", over="ignore"):
                reach = np.nan_to_num(tree.edge[node] * candidates.norm, nan=np.inf, posinf=np.inf) + 1e-6
                low, high = low - reach, high + reach
            open_children[up] -= 1
            if not open_children[up]:
                del held[up]
        at = np.flatnonzero(window(node, low, high))
        scores = products(candidates.x[at], tree.x[node])
        if open_children[node]:
            near = scores.astype(np.float64)
            away = np.where(np.abs(near) >= EXACT, np.abs(near) * 1e-9, 0.0)
            low[at], high[at] = near - away, near + away
            held[node] = (low, high)
        yield node, at, scores


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; ties go to the earlier place (candidates lie ascending by id)."""
    if len(scores) > 4 * k and scores.dtype != object:
        keep = np.flatnonzero(scores >= _kth(scores, k))
    else:
        keep = np.arange(len(scores))
    return keep[np.argsort(-scores[keep], kind="stable")[:k]]


def positives_in(tree: AnchorTree, candidates: Candidates, k: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, 0, candidate id, score) of the k best candidates with an anchor's label."""
    def window(node, low, high):
        same = (candidates.labels == tree.labels[node]) & (candidates.ids != tree.ids[node])
        return same & (high >= _kth(low[same], k))

    for node, at, scores in walk(tree, candidates, window):
        for i in best(scores, k):
            yield node, 0, int(candidates.ids[at[i]]), int(scores[i])


def score_range(positive: int, rules: MiningRules) -> tuple[int, int]:
    """The whole scores that a negative of this positive may have."""
    return -(-rules.low * positive // 100), rules.high * positive // 100


def negatives_in(tree: AnchorTree, candidates: Candidates, rules: MiningRules) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, positive number, candidate id, score) of the best candidates of other labels in each range."""
    ranges = [[score_range(p, rules) for p in scores] for scores in tree.positives]

    def window(node, low, high):
        other = (candidates.labels != tree.labels[node]) & (candidates.ids != tree.ids[node])
        need = np.zeros(len(low), bool)
        for a, b in set(ranges[node]):
            if a <= b:
                sure = other & (low >= a) & (high <= b)
                need |= other & (high >= max(float(a), _kth(low[sure], rules.negatives))) & (low <= b)
        return need

    for node, at, scores in walk(tree, candidates, window):
        for n, (a, b) in enumerate(ranges[node]):
            inside = np.flatnonzero((scores >= a) & (scores <= b))
            for i in inside[best(scores[inside], rules.negatives)]:
                yield node, n, int(candidates.ids[at[i]]), int(scores[i])


# --- on Spark ------------------------------------------------------------------------

def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), "<f8")
    return x.reshape(len(column), dim) if dim else np.zeros((len(column), 0))


def _blocks(anchors: DataFrame, rules: MiningRules) -> DataFrame:
    """``anchors`` with ``cell``, the nearest of the pivots: a hash sample of at most ``cells`` anchors per length."""
    n = max(1, -(-anchors.count() // rules.block_anchors))
    pivots: dict[int, list[bytes]] = {}
    for r in anchors.orderBy(F.xxhash64(F.lit(3), "row")).limit(min(rules.cells, n)).select("dim", "v").collect():
        pivots.setdefault(r["dim"], []).append(bytes(r["v"]))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {dim: np.frombuffer(b"".join(vs), "<f8").reshape(len(vs), dim) for dim, vs in pivots.items()}
        for batch in batches:
            cells = []
            for dim, v in zip(batch.column("dim").to_pylist(), batch.column("v").to_pylist()):
                if dim not in known or not dim:
                    cells.append(0)
                    continue
                with np.errstate(over="ignore"):
                    diff = known[dim] - np.frombuffer(v, "<f8")
                    cells.append(int((diff * diff).sum(axis=1).argmin()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], names=[*batch.schema.names, "cell"])

    return anchors.mapInArrow(nearest, "id bigint, label bigint, dim int, v binary, row bigint, cell int")


def anchor_trees(anchors: DataFrame, rules: MiningRules) -> DataFrame:
    """The anchors in blocks of about ``block_anchors``, with seq, parent and edge of their block's tree."""
    celled = written(_blocks(anchors, rules), "mining-cells")
    sizes = celled.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("dim").alias("_dim"), F.col("cell").alias("_cell"), F.ceil(F.col("n") / rules.block_anchors).alias("parts"))
    hashed = F.xxhash64(F.lit(2), "row")
    dealt = (celled.join(sizes, (F.col("dim") == F.col("_dim")) & (F.col("cell") == F.col("_cell")))
             .select("id", "label", "dim", "v", "row", F.xxhash64("cell", F.pmod(hashed, F.col("parts"))).alias("block")))

    def grow(table: pa.Table) -> pa.Table:
        order, parent, edge = spanning_tree(_matrix(table.column("v"), table.column("dim")[0].as_py()))
        line = depth_first(order, parent)
        seq = np.empty(len(line), np.int64)
        seq[line] = np.arange(len(line))
        up = np.where(parent >= 0, seq[parent], -1)
        return (table.append_column("seq", pa.array(seq, pa.int32())).append_column("parent", pa.array(up, pa.int32()))
                .append_column("edge", pa.array(edge, pa.float64())))

    return dealt.groupBy("dim", "block").applyInArrow(
        grow, "id bigint, label bigint, dim int, v binary, row bigint, block bigint, seq int, parent int, edge double")


def _trees(table: pa.Table, dim: int) -> Iterator[AnchorTree]:
    """The trees of a group of blocks."""
    table = table.sort_by([("block", "ascending"), ("seq", "ascending")])
    blocks = table.column("block").to_numpy()
    cut = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
    for lo, hi in zip(cut, cut[1:]):
        part = table.slice(lo, hi - lo)
        scores = [[int(s) for s in p] for p in part.column("scores").to_pylist()] if "scores" in table.column_names else None
        yield AnchorTree(part.column("row").to_pylist(), part.column("id").to_numpy(), part.column("label").to_numpy(),
                         _matrix(part.column("v"), dim), part.column("parent").to_numpy(), part.column("edge").to_numpy(), scores)


def _pass(vectors: DataFrame, anchors: DataFrame, rules: MiningRules, second: bool) -> DataFrame:
    """(row, n, id, score) found in each (anchor group, candidate shard) pair; scores as decimal text."""
    schema = pa.schema([("row", pa.int64()), ("n", pa.int32()), ("id", pa.int64()), ("score", pa.string())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"row": [], "n": [], "id": [], "score": []}
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            shard = Candidates(left.column("id").to_numpy(), left.column("label").to_numpy(), _matrix(left.column("v"), dim))
            for tree in _trees(right, dim):
                found = negatives_in(tree, shard, rules) if second else positives_in(tree, shard, rules.positives)
                for node, n, i, s in found:
                    out["row"].append(tree.rows[node])
                    out["n"].append(n)
                    out["id"].append(i)
                    out["score"].append(str(s))
        return pa.table(out, schema=schema)

    keys = ["dim", "shard", "team"]
    return (vectors.groupBy(*keys).cogroup(anchors.groupBy(*keys))
            .applyInArrow(run, "row bigint, n int, id bigint, score string"))


def hard_negatives(vectors: DataFrame, rules: MiningRules = MiningRules(), id_col: str = "vec_id",
                   vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; their positives the ``positives`` best other rows of the
    label, and per positive the ``negatives`` best rows of other labels with a score between ``low`` and ``high`` per
    cent of the positive's; ties go to the smaller id.  Rows with a null id, label or vector, or with a null or
    non-finite component (before or after scaling) take no part.  Vectors of different lengths are not compared.  Rows
    equal in id, label and vector count once; rows that share an id otherwise are rows of their own, but not
    candidates of each other.  Scores are exact up to 10^37, where they are cut; beyond a long its end is reported.
    """
    rows = written(labelled_vectors(vectors, rules, id_col, vec_col, label_col), "mining-vectors")
    shards = max(1, -(-rows.count() // rules.shard_rows))
    trees = written(anchor_trees(rows.filter(F.col("id") % rules.every == 0), rules), "mining-trees")
    teams = max(1, -(-trees.count() // (rules.block_anchors * rules.blocks_per_group)))

    def numbers(parts: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(name)

    shard = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(shards)).cast("int").alias("shard")
    dealt = rows.select("id", "label", "dim", "v", shard, numbers(teams, "team"))
    asked = trees.withColumn("team", F.pmod(F.xxhash64(F.lit(4), "block"), F.lit(teams)).cast("int"))

    score = F.col("score").cast("decimal(38,0)")
    first = Window.partitionBy("row").orderBy(F.desc("s"), "id")
    found = _pass(dealt, asked.select("*", numbers(shards, "shard")), rules, False).withColumn("s", score)
    per = (found.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= rules.positives)
           .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "id", "score"))).alias("p"))   # few a row
           .select(F.col("row").alias("_row"), F.col("p.id").alias("positive_ids"), F.col("p.score").alias("scores")))
    asked = written(asked.join(per, F.col("row") == F.col("_row"), "left")      # an inner node may have no positive
                    .withColumn("scores", F.coalesce("scores", F.array().cast("array<string>"))).drop("_row"), "mining-asked")
    hits = _pass(dealt, asked.drop("positive_ids").select("*", numbers(shards, "shard")), rules, True)
    second = Window.partitionBy("row", "n").orderBy(F.desc("s"), "negative_id")
    top = (hits.select("row", "n", F.col("id").alias("negative_id"), "score", score.alias("s"))
           .withColumn("rank", F.row_number().over(second)).filter(F.col("rank") <= rules.negatives))
    named = asked.select(F.col("row").alias("_row"), F.col("id").alias("anchor_id"), "positive_ids", "scores")

    def as_long(text):
        wide = text.cast("decimal(38,0)")
        return F.greatest(F.least(wide, F.lit(LONG_MAX)), F.lit(-LONG_MAX - 1)).cast("bigint")

    return (top.join(named, F.col("row") == F.col("_row"))
            .select("anchor_id", F.element_at("positive_ids", F.col("n") + 1).alias("positive_id"),
                    F.col("rank").cast("int").alias("rank"), "negative_id",
                    as_long(F.element_at("scores", F.col("n") + 1)).alias("positive_score"),
                    as_long(F.col("score")).alias("negative_score")))
