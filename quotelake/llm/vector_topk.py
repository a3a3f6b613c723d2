"""Exact top-k by inner product with KD-trees per shard.

Vectors are dealt into shards of bounded size; each shard gets a KD-tree of
median splits with tight bounding boxes.  The largest inner product a query can
have inside a box bounds its subtree.  A first pass searches only the best leaf
of every shard and so finds a score that the k-th result reaches at least; the
second pass starts from that score, goes best-first and skips every subtree
whose bound is below the score of the k-th result so far.
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
class SearchRules:
    k: int = 5
    scale: int = 256
    every: int = 50                # queries: ids divisible by this
    shard_rows: int = 8192
    query_block: int = 8192
    leaf_rows: int = 128


def scaled_vectors(vectors: DataFrame, id_col: str, vec_col: str, rules: SearchRules) -> DataFrame:
    """(id, dim, v): floor(scale * x) as little-endian doubles; rows that take no part are left out."""
    scale = float(rules.scale)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, blobs = [], [], []
            lists = batch.column(1)
            for i, key in enumerate(batch.column(0).to_pylist()):
                if key is None or not lists[i].is_valid:
                    continue
                values = lists[i].values
                if values.null_count:
                    continue
                x = np.asarray(values, dtype=np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(x * scale)
                if not np.isfinite(x).all():
                    continue
                ids.append(key)
                dims.append(len(x))
                blobs.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(blobs, pa.binary())], names=["id", "dim", "v"])
    return (vectors.select(F.col(id_col).cast("bigint"), F.col(vec_col))
            .mapInArrow(convert, "id bigint, dim int, v binary"))


# --- one shard -----------------------------------------------------------------

class Tree:
    """KD-tree over the rows of one shard, rows sorted by id inside equal boxes."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf_rows: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.lo, self.hi, self.child, self.span = [], [], [], []
        at = np.arange(len(ids))
        self.order = np.empty(len(ids), np.int64)
        self._build(at, 0, leaf_rows)
        self.ids, self.x = self.ids[self.order], self.x[self.order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _build(self, at: np.ndarray, begin: int, leaf_rows: int) -> int:
        todo = [(at, begin, None, 0)]
        while todo:
            at, begin, parent, side = todo.pop()
            node = len(self.span)
            x = self.x[at]
            lo, hi = x.min(axis=0), x.max(axis=0)
            self.lo.append(lo)
            self.hi.append(hi)
            self.child.append([-1, -1])
            self.span.append((begin, begin + len(at)))
            if parent is not None:
                self.child[parent][side] = node
            width = hi - lo
            axis = int(width.argmax()) if len(width) else 0
            if len(at) <= leaf_rows or not len(width) or width[axis] == 0:
                self.order[begin:begin + len(at)] = np.sort(at)
                continue
            by = np.argsort(x[:, axis], kind="stable")
            half = len(at) // 2
            todo.append((at[by[half:]], begin + half, node, 1))
            todo.append((at[by[:half]], begin, node, 0))
        return 0

    def bounds(self, q: np.ndarray, nodes: list[int]) -> np.ndarray:
        return np.maximum(q, 0) @ self.hi[nodes].T + np.minimum(q, 0) @ self.lo[nodes].T

    def leaves(self, q: np.ndarray, floor: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Leaves under boxes that some query cannot rule out, and all queries' bounds for them."""
        found, level = [], [0]
        while level:
            b = self.bounds(q, level)
            below = []
            for j, node in enumerate(level):
                if not (b[:, j] >= floor).any():
                    continue
                if self.child[node][0] < 0:
                    found.append(node)
                else:
                    below += self.child[node]
            level = below
        return found, self.bounds(q, found) if found else np.zeros((len(q), 0))


def _merge(scores: np.ndarray, ids: np.ndarray, new_scores: np.ndarray, new_ids: np.ndarray,
           k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best by score, then smaller id; an empty place is (-inf, largest id)."""
    s, i = np.concatenate([scores, new_scores], axis=1), np.concatenate([ids, new_ids], axis=1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


NO_ID = np.iinfo(np.int64).max


def search(tree: Tree, qids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int,
           first_leaf_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Best k (score, id) of each query in one shard, apart from its own id; scores below ``floor`` may miss."""
    scores = np.full((len(q), k), -np.inf)
    ids = np.full((len(q), k), NO_ID)
    leaves, bound = tree.leaves(q, floor)
    if not leaves:
        return scores, ids
    order = np.argsort(-bound, axis=1, kind="stable")
    for turn in range(1 if first_leaf_only else len(leaves)):
        at = order[:, turn]
        best = bound[np.arange(len(q)), at]
        active = best >= np.maximum(floor, scores[:, -1])       # an equal score may have a smaller id
        if not active.any():
            break
        for leaf in np.unique(at[active]):
            who = np.flatnonzero(active & (at == leaf))
            lo, hi = tree.span[leaves[leaf]]
            s = q[who] @ tree.x[lo:hi].T
            i = np.broadcast_to(tree.ids[lo:hi], s.shape)
            s = np.where(i == qids[who][:, None], -np.inf, s)
            i = np.where(np.isneginf(s), NO_ID, i)
            scores[who], ids[who] = _merge(scores[who], ids[who], s, i, k)
    return scores, ids


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), "<f8")
    return x.reshape(len(column), dim) if dim else np.zeros((len(column), 0))


LONG_MAX = 2 ** 63 - 1


def _is_exact(q: np.ndarray, x: np.ndarray) -> bool:
    """Do all sums of products stay whole numbers that a double holds?"""
    return not (q.size and x.size) or float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0 ** 53


def search_large(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k (score, id) of each query where doubles do not hold the scores: whole numbers of any size, no pruning.

    Scores beyond the range of a long are its ends, also for the order.
    """
    scores, found = np.zeros((len(q), k), np.int64), np.full((len(q), k), NO_ID)
    rows = [[int(v) for v in row] for row in x]
    for j, one in enumerate(q):
        whole = [int(v) for v in one]
        best = sorted((-max(-LONG_MAX - 1, min(LONG_MAX, sum(a * b for a, b in zip(row, whole) if a and b))), int(i))
                      for row, i in zip(rows, ids) if i != qids[j])[:k]
        for n, (s, i) in enumerate(best):
            scores[j, n], found[j, n] = -s, i
    return scores, found


def _pass(vectors: DataFrame, queries: DataFrame, rules: SearchRules, first: bool) -> DataFrame:
    """(query_id, vec_id, score) of each (shard, query block) pair."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            x, q = _matrix(left.column("v"), dim), _matrix(right.column("v"), dim)
            ids, qids = left.column("id").to_numpy(), right.column("id").to_numpy()
            if _is_exact(q, x):
                floor = np.full(len(q), -np.inf) if first else right.column("floor").to_numpy()
                scores, ids = search(Tree(ids, x, rules.leaf_rows), qids, q, floor, rules.k, first)
            else:
                scores, ids = search_large(ids, x, qids, q, rules.k)
            keep = ids != NO_ID
            out = {"query_id": np.broadcast_to(qids[:, None], ids.shape)[keep], "vec_id": ids[keep],
                   "score": scores[keep].astype(np.int64)}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return (vectors.groupBy("dim", "shard", "block")
            .cogroup(queries.groupBy("dim", "shard", "block"))
            .applyInArrow(run, "query_id bigint, vec_id bigint, score bigint"))


def top_k(vectors: DataFrame, rules: SearchRules = SearchRules(), id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every query its k best other vectors by inner product.

    Ties go to the smaller id.  Rows with a null id, a null vector, or a null or
    non-finite component take no part; vectors of different lengths are not compared.
    Rows that repeat an id are candidates one by one, but not for queries of that id; a repeated query is
    answered once, for the least of its vectors in byte order.  Components too large for exact doubles are multiplied as whole
    numbers, and scores beyond a long count as its end; a component that is infinite after scaling takes its row out.
    Every (shard, query block) pair is a task of bounded size.
    """
    all_v = written(scaled_vectors(vectors, id_col, vec_col, rules), "topk-vectors")
    n = all_v.count()
    shards = max(1, -(-n // rules.shard_rows))
    queries = written(all_v.filter(F.col("id") % rules.every == 0).groupBy("id", "dim").agg(F.min("v").alias("v")), "topk-queries")
    blocks = max(1, -(-queries.count() // rules.query_block))

    def hashed(seed: int, n_parts: int):
        return F.pmod(F.xxhash64(F.lit(seed), "id", "v"), F.lit(n_parts)).cast("int")

    def every(n_parts: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias(name)

    dealt = all_v.select("id", "dim", "v", hashed(1, shards).alias("shard"), every(blocks, "block"))
    asked = queries.select("id", "dim", "v", hashed(2, blocks).alias("block"), every(shards, "shard"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def kth(df: DataFrame) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= rules.k)

    reached = (kth(_pass(dealt, asked, rules, True)).groupBy("query_id")
               .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")))
    floors = written(reached.filter(F.col("n") == rules.k)
                     .select(F.col("query_id").alias("id"), F.col("least").cast("double").alias("floor")), "topk-floors")
    asked = (asked.join(floors, "id", "left")
             .withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))))
    found = kth(_pass(dealt, asked, rules, False))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
