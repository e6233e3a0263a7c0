"""Exact top-k search by inner product: a ball tree per shard, branch and bound.

Candidates are dealt into shards and queries into blocks, and each (shard, block) pair is one
group of bounded size. A group builds the ball tree of its shard and visits nodes in the order of
their upper bound ``q . centre + |q| * radius``, best first over the queries of the block; a
node is left out for every query whose kth score it cannot reach. The kth score a query has
found on one shard is handed to all others: a first round searches one shard per block, a
second the rest, starting from those scores.

Scores are whole numbers. Vectors of small components meet in double precision, which is exact
for them. Pairs with a vector of large components are bounded in double precision with the error
counted in; what can still be among the best is computed in Python integers. A score that no long
holds is returned as the nearest long and ranked by its exact value.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.workspace import materialize

#: Rows of a shard and of a block of queries; the bound of a group's memory.
SHARD_ROWS, BLOCK_ROWS = 16_384, 4_096
LEAF = 256
_EXACT = float(1 << 53)
_LARGEST = float(np.finfo(np.float64).max)
_NONE = -(1 << 62)
_LONG = (1 << 63) - 1


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v, dim) with floor(scale * x) of each component; unusable vectors are left out.

    A double of 2**53 and more is whole. A product beyond the doubles counts as the largest.
    """

    def whole(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(scale))
        y = F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)
        return F.greatest(F.least(y, F.lit(_LARGEST)), F.lit(-_LARGEST))

    x = F.col(f"`{vector_col}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) <= _LARGEST))
    return rows.where(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & finite).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(x, whole).alias("v"), F.size(x).alias("dim")
    )


class BallTree:
    """Balanced splits along the widest axis; a node is a stretch of the reordered points."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, np.ndarray, float, int, int]] = []
        self._build(points, 0, len(points))

    def _build(self, points: np.ndarray, lo: int, hi: int) -> int:
        own = points[self.order[lo:hi]]
        centre = own.mean(axis=0)
        radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
        place = len(self.nodes)
        self.nodes.append((lo, hi, centre, radius, -1, -1))
        if hi - lo > LEAF and radius > 0:
            axis, mid = int(np.argmax(own.var(axis=0))), (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argpartition(own[:, axis], mid)]
            left, right = self._build(points, lo, lo + mid), self._build(points, lo + mid, hi)
            self.nodes[place] = (lo, hi, centre, radius, left, right)
        return place


def _ordered(score: int) -> bytes:
    """Bytes that sort like whole numbers of any size."""
    size = (abs(score).bit_length() + 7) // 8
    head = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\x01" + head if score >= 0 else b"\x00" + bytes(255 - x for x in head)


def search_exact(
    queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, list[int]]]:
    """As ``search``, for components of any size."""
    scale = np.abs(points).max(initial=1.0)
    near = points / scale
    lost = (points.shape[1] + 2) * 2.0**-51
    order = np.argsort(ids, kind="stable")
    for q, query in enumerate(queries):
        own = query / max(np.abs(query).max(initial=0), 1.0)
        about = near @ own
        error = np.abs(near) @ np.abs(own) * lost + 1e-290
        usable = order[ids[order] != query_ids[q]]
        if not len(usable):
            continue
        least = np.sort((about - error)[usable])[-min(k, len(usable))]
        close = usable[(about + error)[usable] >= least]
        whole = [int(x) for x in query]
        scores = [sum(a * int(b) for a, b in zip(whole, points[p], strict=True)) for p in close.tolist()]
        best = sorted(range(len(close)), key=lambda i: (-scores[i], i))[:k]
        best = [i for i in best if scores[i] >= floor[q] or floor[q] in (_NONE, -_LONG)]
        if best:
            yield q, ids[close[best]], [scores[i] for i in best]


def search(
    queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (index): ids and scores of its best ``k`` among ``points``, at least ``floor``.

    A point with the query's own id is no candidate. Ties go to the smaller id. Products of the
    components, and their sums, must be exact in double precision.
    """
    order = np.argsort(ids, kind="stable")
    points, ids = points[order], ids[order]
    norms = np.sqrt((queries**2).sum(axis=1))
    tree = BallTree(points)
    best = np.full((len(queries), k), _NONE, np.int64)
    who = np.full((len(queries), k), len(ids), np.int64)
    kth = np.maximum(floor, _NONE)

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        _, _, centre, radius, _, _ = tree.nodes[node]
        top = queries[rows] @ centre + norms[rows] * radius
        return top + 1e-6 * (1 + np.abs(top) + norms[rows] * radius)

    everyone = np.arange(len(queries))
    first = bound(0, everyone)
    heap = [(-first.max(initial=0), 0, everyone, first)]
    while heap:
        _, node, rows, tops = heapq.heappop(heap)
        rows = rows[tops >= kth[rows]]
        if not len(rows):
            continue
        lo, hi, _, _, left, right = tree.nodes[node]
        if left >= 0:
            for child in (left, right):
                tops = bound(child, rows)
                open_rows = tops >= kth[rows]
                if open_rows.any():
                    heapq.heappush(heap, (-float(tops[open_rows].max()), child, rows[open_rows], tops[open_rows]))
            continue
        members = np.sort(tree.order[lo:hi])
        found = np.rint(queries[rows] @ points[members].T).astype(np.int64)
        found[ids[members][None, :] == query_ids[rows][:, None]] = _NONE
        better = (found >= kth[rows][:, None]).any(axis=1)
        rows, found = rows[better], found[better]
        scores = np.concatenate([best[rows], found], axis=1)
        places = np.concatenate([who[rows], np.broadcast_to(members, found.shape)], axis=1)
        pick = np.lexsort((places, -scores), axis=1)[:, :k]
        best[rows] = np.take_along_axis(scores, pick, axis=1)
        who[rows] = np.take_along_axis(places, pick, axis=1)
        kth[rows] = np.maximum(kth[rows], best[rows][:, -1])
    for q in range(len(queries)):
        got = (best[q] > _NONE) & (best[q] >= floor[q])
        if got.any():
            yield q, ids[who[q][got]], best[q][got]


def _vectors(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


_FOUND = ("query_id", "vec_id", "score", "beyond")


def _rows(query_id: int, who: np.ndarray, scores) -> pd.DataFrame:
    """Scores as longs; those at the edge of the longs or beyond have their order as bytes."""
    beyond = None
    if not isinstance(scores, np.ndarray):
        beyond = [_ordered(s) if abs(s) >= _LONG else None for s in scores]
        scores = [max(-_LONG, min(_LONG, s)) for s in scores]
    return pd.DataFrame(dict(zip(_FOUND, (query_id, who, scores, beyond), strict=True)))


def _group(k: int):
    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(shard) and len(block):
            points, ids = _vectors(shard["v"]), shard["id"].to_numpy()
            queries, asked, floor = _vectors(block["v"]), block["id"].to_numpy(), block["floor"].to_numpy()
            limit = np.sqrt(_EXACT / max(1, points.shape[1]))
            small_p, small_q = ((np.abs(v) < limit).all(axis=1) for v in (points, queries))
            for method, q, p in (
                (search, small_q, small_p),
                (search_exact, small_q, ~small_p),
                (search_exact, ~small_q, np.ones(len(points), bool)),
            ):
                if q.any() and p.any():
                    found = method(queries[q], asked[q], floor[q], points[p], ids[p], k)
                    out += [_rows(asked[q][n], who, scores) for n, who, scores in found]
        empty = pd.DataFrame({c: pd.Series(dtype="int64" if c != "beyond" else "object") for c in _FOUND})
        return pd.concat(out) if out else empty

    return run


def _search_round(queries: DataFrame, candidates: DataFrame, pairs: Column, k: int) -> DataFrame:
    """Best k of the shards in ``pairs`` (an array of shards per query row) per shard."""
    dealt = queries.select("*", F.explode(pairs).alias("shard"))
    blocks = dealt.select(
        F.col("shard").alias("for_shard"), F.col("block").alias("for_block"), F.col("dim").alias("for_dim")
    ).distinct()
    shards = candidates.join(
        blocks, (candidates["shard"] == blocks["for_shard"]) & (candidates["dim"] == blocks["for_dim"])
    ).select("id", "v", "for_shard", "for_block", "for_dim")
    return (
        shards.groupBy("for_shard", "for_block", "for_dim")
        .cogroup(dealt.groupBy("shard", "block", "dim"))
        .applyInPandas(_group(k), "query_id long, vec_id long, score long, beyond binary")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(
        F.col("score").desc(), F.col("beyond").desc(), "vec_id"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): the k highest inner products of each query, all if fewer.

    Components count as ``floor(scale * x)``, exactly; a score beyond the longs is returned as the
    nearer of ``2**63 - 1`` and ``1 - 2**63`` and ranked by its exact value. Ties go to the smaller
    id. Rows with a null id, a null vector, or a null or non-finite component take no part. A query's own id is no candidate,
    in any row. Vectors meet those of the same length only. Equal rows count once; of different
    vectors under one id all are candidates and the least is the query. Either table may be
    empty; other columns are not read.
    """
    # one row per distinct (id, vector); a number tells apart vectors that share an id
    candidates = materialize(whole_vectors(rows, id_col, vector_col, scale).distinct(), "vectors")
    asked = whole_vectors(queries, id_col, vector_col, scale).groupBy("id").agg(F.min(F.struct("v", "dim")).alias("x"))
    asked = materialize(asked.select("id", "x.v", "x.dim"), "queries")
    sizes = candidates.agg(F.count(F.lit(1))).first()[0], asked.agg(F.count(F.lit(1))).first()[0]
    n_shards, n_blocks = -(-sizes[0] // SHARD_ROWS) or 1, -(-sizes[1] // BLOCK_ROWS) or 1
    mixed = F.xxhash64("id", "v")
    candidates = candidates.withColumn("shard", F.pmod(mixed, F.lit(n_shards)).cast("int"))
    asked = asked.withColumn("block", F.pmod(mixed, F.lit(n_blocks)).cast("int"))
    home = F.pmod(F.col("block"), F.lit(n_shards))
    first = materialize(
        _best(_search_round(asked.withColumn("floor", F.lit(_NONE)), candidates, F.array(home), k), k), "first_round"
    )
    if n_shards > 1:
        floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        rest = asked.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(_NONE)))
        others = F.filter(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: s != home)
        second = _search_round(rest, candidates, others, k)
        first = _best(first.drop("rank").unionByName(second), k)
    return first.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")
