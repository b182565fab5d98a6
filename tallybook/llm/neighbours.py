"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``SAMPLE`` vectors, by a hash of their id); every vector is then put into one leaf by
going down to the nearest centre.  A query visits leaves in the order of a priority queue over the distances to the
centres of the tree.  How many leaves it visits is calibrated: for ``CALIBRATION`` of the queries the true neighbours among
all vectors are found, and visits widen until the leaves visited hold ``RECALL`` of them.  Leaves are joined with the queries
that visit them; a large leaf is split into parts of at most about ``PART`` vectors, each of which sees the same queries.
Distances are computed on the original vectors in double precision.

The tree and the calibration queries are all that is broadcast; both have fixed bounds.

Cases: vectors that are NULL, zero, or hold NULL or non-finite numbers take no part, neither do those of another length than
the most frequent one; a query never finds rows with its own id; ties go to the smaller id; with fewer than ``k``
candidates all are found; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import freeze

SAMPLE = 20_000
BRANCH = 8
LEAF = 64  # sample vectors in a leaf at most
CALIBRATION = 64
RECALL = 0.97
PART = 4096
K = 10
SEED = 5


class Tree:
    """Nodes in arrays: centre, children (none: a leaf)."""

    def __init__(self, vectors: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = SEED):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.rng = np.random.default_rng(seed)
        self._grow(vectors, branch, leaf)
        self.leaves = [i for i, c in enumerate(self.children) if not c]
        self.stacks = [self._stack(c) for c in self.children]
        del self.rng

    def _stack(self, nodes):
        return np.stack([self.centres[n] for n in nodes]) if nodes else None

    def _grow(self, vectors: np.ndarray, branch: int, leaf: int) -> int:
        node = len(self.centres)
        self.centres.append(vectors.mean(axis=0))
        self.children.append([])
        if len(vectors) > leaf:
            label = self._means(vectors, branch)
            kinds = np.unique(label)
            if len(kinds) > 1:  # equal vectors can't be split
                self.children[node] = [self._grow(vectors[label == k], branch, leaf) for k in kinds]
        return node

    def _means(self, vectors: np.ndarray, branch: int) -> np.ndarray:
        centres = vectors[self.rng.choice(len(vectors), branch, replace=False)]
        for _ in range(12):
            label = _squares(vectors, centres).argmin(axis=1)
            for k in np.unique(label):
                centres[k] = vectors[label == k].mean(axis=0)
        return label

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of every vector."""
        at = np.zeros(len(vectors), dtype=np.int64)
        while True:
            moved = False
            for node in np.unique(at):
                if self.children[node]:
                    rows = np.flatnonzero(at == node)
                    at[rows] = np.array(self.children[node])[_squares(vectors[rows], self.stacks[node]).argmin(axis=1)]
                    moved = True
            if not moved:
                return at

    def visits(self, query: np.ndarray, most: int | None = None) -> list[int]:
        """Leaves best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and (most is None or len(out) < most):
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for child, d in zip(self.children[node], ((self.stacks[node] - query) ** 2).sum(axis=1)):
                    heapq.heappush(queue, (float(d), child))
            else:
                out.append(node)
        return out


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :]


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def nearest(q_ids, q, ids, vectors, k: int) -> pd.DataFrame:
    """The k nearest of ``vectors`` for each query, its own id left out: query_id, vec_id, score."""
    out = []
    for i, query in zip(q_ids, q):
        score = np.sqrt(((vectors - query) ** 2).sum(axis=1))
        own = np.flatnonzero(ids != i)
        if len(own) > k:
            own = own[score[own] <= np.partition(score[own], k - 1)[k - 1]]  # all ties of the last one
        own = own[np.lexsort((ids[own], score[own]))][:k]
        out.append(pd.DataFrame({"query_id": np.full(len(own), i), "vec_id": ids[own], "score": score[own]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


_FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & _fine(F.col("v")))


def _fine(v: Column) -> Column:
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(ok, F.lit(False)) & F.exists(v, lambda x: x != 0)


def search(
    vectors: DataFrame, is_query: Column | None = None, k: int = K, recall: float = RECALL, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of every query row."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if size is None:
        return empty
    rows = rows.where(F.size("v") == size["n"])
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    tree = Tree(_matrix(sample.toPandas()["v"]))
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if len(part):
                yield part.assign(leaf=shared.value.place(_matrix(part["v"])))

    placed = freeze(rows.mapInPandas(place, "vec_id long, v array<double>, leaf long"), "ann-leaves")
    picked = is_query if is_query is not None else F.col("vec_id") % 100 == 0
    queries = placed.where(picked).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).dropDuplicates(["query_id"])
    visits = calibrated_visits(placed, queries, shared, k, recall)

    def routes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for i, q in zip(part["query_id"], part["q"]):
                leaves = shared.value.visits(np.asarray(q), visits)
                yield pd.DataFrame({"query_id": i, "q": [q] * len(leaves), "leaf": leaves})

    def in_part(key, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(ours) or not len(theirs):
            return nearest([], [], None, None, k)
        return nearest(ours["query_id"].to_numpy(), _matrix(ours["q"]), theirs["vec_id"].to_numpy(), _matrix(theirs["v"]), k)

    # one row per leaf, of which there are at most as many as the sample has vectors
    parts = freeze(placed.groupBy("leaf").count().select("leaf", F.ceil(F.col("count") / PART).alias("parts")), "ann-parts")
    routed = queries.mapInPandas(routes, "query_id long, q array<double>, leaf long").join(F.broadcast(parts), "leaf")
    routed = routed.select("query_id", "q", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    shares = F.broadcast(parts.withColumnRenamed("parts", "n"))
    cut = placed.join(shares, "leaf").select("vec_id", "v", "leaf", F.pmod(F.xxhash64("vec_id"), F.col("n")).alias("part"))
    found = routed.groupBy("leaf", "part").cogroup(cut.groupBy("leaf", "part")).applyInPandas(in_part, _FOUND)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def calibrated_visits(placed: DataFrame, queries: DataFrame, shared, k: int, recall: float) -> int:
    """The fewest leaves that hold ``recall`` of the true neighbours of some queries, found among all vectors."""
    some = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION).toPandas()
    if not len(some):
        return 1
    ids, q = some["query_id"].to_numpy(), _matrix(some["q"])
    held = placed.sparkSession.sparkContext.broadcast((ids, q))

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for part in batches:
            if not len(part):
                continue
            own = nearest(*held.value, part["vec_id"].to_numpy(), _matrix(part["v"]), k)
            own = own.merge(part[["vec_id", "leaf"]].drop_duplicates("vec_id"), on="vec_id")
            best = own if best is None else pd.concat([best, own])
            best = best.sort_values(["query_id", "score", "vec_id"]).groupby("query_id").head(k)
        if best is not None:
            yield best[["query_id", "vec_id", "score", "leaf"]]

    near = placed.mapInPandas(brute, f"{_FOUND}, leaf long")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    true = near.withColumn("n", order).where(F.col("n") <= k).select("query_id", "leaf").toPandas()  # CALIBRATION x k rows
    if not len(true):
        return 1
    ranks = []
    for i, query in zip(ids, q):
        place = {leaf: r for r, leaf in enumerate(shared.value.visits(query), 1)}
        ranks += [place[leaf] for leaf in true.loc[true["query_id"] == i, "leaf"]]
    ranks.sort()
    return max(1, ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)])
