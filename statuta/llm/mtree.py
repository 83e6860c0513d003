"""Exact top-k inner products by best-first search in an M-tree.

Vectors become whole numbers floor(256 * x).  With one more component that
gives all candidates of a tree the same norm R, the candidate with the largest
inner product is the nearest one: |q - v|^2 = |q|^2 + R^2 - 2 q.v, a metric.
Each block of candidates gets a tree of paged nodes: routing objects with
covering radii and each entry's distance to its parent.  A search visits nodes
in the order of their lower bounds, skips those that |d(q, parent) - d(entry,
parent)| already rules out before any distance to them is computed, and ends
when no node can hold a better score.  Scores are exact integers.

Candidates are dealt into blocks by a hash of their id and queries into blocks
too; each pair of blocks is a unit of work of bounded size, and a query's best
of each block meet at the end.  Before, every query sees one bounded sample of
candidates, whose k-th score lets the searches prune from the start.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stored

K, CANDIDATES, QUERIES, PAGE, SAMPLE = 5, 4096, 1024, 64, 1024


class MTree:
    """Three levels: root entries, inner pages, leaf pages of about ``page`` vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE):
        self.ids, self.v = ids, vectors
        sq = (vectors * vectors).sum(1)
        self.top = int(sq.max()) if len(sq) else 0
        self.lift = np.sqrt((self.top - sq).astype(np.float64))
        x = np.column_stack([vectors.astype(np.float64), self.lift])
        n = len(ids)
        leaves = max(1, -(-n // page))
        rng = np.random.default_rng(5)
        pivot = np.sort(rng.choice(n, leaves, replace=False))
        near = self._nearest(x, x[pivot])
        order = np.argsort(near, kind="stable")
        self.order = order
        self.bounds = np.searchsorted(near[order], np.arange(leaves + 1))
        self.pivots = x[pivot]
        self.to_parent = np.linalg.norm(x[order] - self.pivots[near[order]], axis=1)
        self.radius = np.array([self.to_parent[a:b].max(initial=0.0) for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)])
        inner = max(1, int(np.sqrt(leaves)))
        head = np.sort(rng.choice(leaves, inner, replace=False))
        of = self._nearest(self.pivots, self.pivots[head])
        self.heads = self.pivots[head]
        self.children = [np.flatnonzero(of == k) for k in range(inner)]
        self.leaf_to_head = np.linalg.norm(self.pivots - self.heads[of], axis=1)
        self.head_radius = np.array([(self.leaf_to_head[c] + self.radius[c]).max(initial=0.0) for c in self.children])

    @staticmethod
    def _nearest(x: np.ndarray, to: np.ndarray) -> np.ndarray:
        return np.argmin((to * to).sum(1)[None, :] - 2 * (x @ to.T), axis=1)

    def search(self, query: np.ndarray, own: int, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The k best (score, id); ties to the smaller id.  Scores below ``floor`` may be missing."""
        q = np.append(query.astype(np.float64), 0.0)
        base = float(q @ q) + self.top
        slack = 1e-6 * (1.0 + np.sqrt(base))
        best: list[tuple[int, int]] = []  # heap of (score, -id)

        def reach() -> float:
            """The distance beyond which nothing can enter the result."""
            least = best[0][0] if len(best) == k else floor
            return np.inf if least is None else np.sqrt(max(base - 2.0 * least, 0.0)) + slack

        d_head = np.linalg.norm(self.heads - q, axis=1)
        heap = [(max(d - r, 0.0), 0, i, d) for i, (d, r) in enumerate(zip(d_head.tolist(), self.head_radius.tolist(), strict=True))]
        heapq.heapify(heap)
        while heap:
            bound, level, i, d = heapq.heappop(heap)
            limit = reach()
            if bound > limit:
                break
            if level == 0:
                c = self.children[i]
                c = c[np.abs(d - self.leaf_to_head[c]) - self.radius[c] <= limit]
                dist = np.linalg.norm(self.pivots[c] - q, axis=1)
                for leaf, x, low in zip(c.tolist(), dist.tolist(), (dist - self.radius[c]).tolist(), strict=True):
                    if low <= limit:
                        heapq.heappush(heap, (max(low, 0.0), 1, leaf, x))
                continue
            rows = slice(self.bounds[i], self.bounds[i + 1])
            rows = self.order[rows][np.abs(d - self.to_parent[rows]) <= limit]
            scores = self.v[rows] @ query
            if len(best) == k:
                keep = scores >= best[0][0]
                rows, scores = rows[keep], scores[keep]
            for s, id_ in zip(scores.tolist(), self.ids[rows].tolist(), strict=True):
                if id_ == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -id_))
                elif (s, -id_) > best[0]:
                    heapq.heapreplace(best, (s, -id_))
        return [(s, -i) for s, i in best]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.int64) for v in column])


def _top_scores(scores: np.ndarray, k: int) -> list[int | None]:
    if scores.shape[1] < k:
        return [None] * len(scores)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k].tolist()


def _searched(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(queries) and len(candidates):
            for _, part in candidates.groupby("dim"):
                own = queries[queries["dim"] == part["dim"].iat[0]]
                if not len(own):
                    continue
                tree = MTree(part["vec_id"].to_numpy(), _matrix(part["vec"]))
                floors = own["floor"].tolist()
                for id_, vec, floor in zip(own["vec_id"].tolist(), _matrix(own["vec"]), floors, strict=True):
                    rows += [(id_, i, s) for s, i in tree.search(vec, id_, k, None if pd.isna(floor) else int(floor))]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})
    return run


def top_inner(vectors: DataFrame, every: int = 50, k: int = K, candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each row whose vec_id is divisible by ``every``.

    Needs vec_id and embedding.  A component x counts as floor(256 * x).  Ties go
    to the smaller vec_id; a query with fewer candidates gets all.  Rows with a null
    id, a null or empty vector, or null or non-finite components take no part; vectors
    of different length don't meet.  Rows that repeat a vec_id: equal ones are
    one candidate and one query, of different ones each vector is a candidate and a query under its id
    (neither is a candidate for its own id).
    """
    fine = "vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(fine)

    def packed(batch_iter):
        import pyarrow as pa

        for batch in batch_iter:
            whole = [np.floor(np.asarray(v) * 256.0).astype(np.int64) for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([len(v) for v in whole], pa.int32()), pa.array([v.tobytes() for v in whole], pa.binary())], ["vec_id", "dim", "vec"])

    base = stored(base.mapInArrow(packed, "vec_id long, dim int, vec binary").distinct(), "vectors")
    n = base.count()
    blocks, query_blocks = max(1, -(-n // candidates)), max(1, -(-n // every // queries))
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()  # bounded: the first floors for pruning
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in sample}:
        rows = [r for r in sample if r["dim"] == dim]
        by_dim[dim] = np.array([r["vec_id"] for r in rows]), np.stack([np.frombuffer(r["vec"], np.int64) for r in rows])

    def floored(frames):
        for pdf in frames:
            floors = []
            for id_, dim, vec in zip(pdf["vec_id"], pdf["dim"], pdf["vec"], strict=True):
                ids, m = by_dim.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
                floors.append(_top_scores((m[ids != id_] @ np.frombuffer(vec, np.int64))[None, :], k)[0])
            yield pdf.assign(floor=pd.array(floors, "Int64"))

    asked = base.where(f"vec_id % {every} = 0").mapInPandas(floored, "vec_id long, dim int, vec binary, floor long")
    q_block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("int")
    asked = asked.withColumn("q", q_block).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    offered = base.withColumn("c", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    found = asked.groupBy("q", "c").cogroup(offered.groupBy("q", "c")).applyInPandas(_searched(k), "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
