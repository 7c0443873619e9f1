"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

The tree is fitted on at most ``SAMPLE`` distinct vectors, those with the smallest hashes (the documented bound), and
every vector is then put into a leaf. A query walks the tree with a priority queue of branches by their centroids'
distance, so that leaves come out nearest bin first. How many leaves it visits is calibrated: for up to ``CALIBRATED``
queries the true neighbours are found by brute force against all rows, and the visits are widened until the visited
leaves hold ``RECALL`` of them. A query goes on beyond that until it has seen enough rows for a full answer.

Queries and vectors meet by leaf. A leaf with many vectors or queries is cut into blocks on both sides, each pair of
blocks a unit of its own. Equal vectors are searched once: of their ids only the smallest ``k + 1`` can be in an answer.

* null, empty, zero vectors, those with null or non-finite components, null ids, and vectors whose length is not the
  commonest one (the smaller if two are) take no part, neither as queries nor as candidates.
* rows that share the query's id are no candidates. Repeated rows count once. Ties go to the smaller id.
* empty table, or no query: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.ship import ship
from stratamart.llm.storage import small_side, stored

SAMPLE = 20_000
LEAF = 128
BRANCHES = 8
CALIBRATED = 200
RECALL = 0.95
BLOCK = 4096


@dataclass
class Tree:
    """Inner node i has ``centroids[i]`` and ``children[i]``: inner nodes from 0, leaves as -1 - leaf."""

    centroids: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    n_leaves: int = 0

    def new_leaf(self) -> int:
        self.n_leaves += 1
        return -self.n_leaves

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: the nearest centroid at every node."""
        out = np.zeros(len(vectors), dtype=np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                nearest = (vectors[rows] @ self.centroids[node].T).argmax(axis=1)
                todo += [(child, rows[nearest == i]) for i, child in enumerate(self.children[node])]
        return out

    def best_bins(self, query: np.ndarray) -> Iterator[int]:
        """All leaves, nearest bin first."""
        queue: list[tuple[float, int]] = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while node >= 0:
                distances = 1 - self.centroids[node] @ query
                nearest = int(distances.argmin())
                for i, child in enumerate(self.children[node]):
                    if i != nearest:
                        heapq.heappush(queue, (float(distances[i]), child))
                node = self.children[node][nearest]
            yield -1 - node


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _centroids(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means of unit vectors, from far-apart starts."""
    chosen = [0]
    nearest = 1 - points @ points[0]
    for _ in range(k - 1):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, 1 - points @ points[chosen[-1]])
    centers = points[chosen]
    for _ in range(rounds):
        own = (points @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centers)
    return centers


def fit_tree(points: np.ndarray, leaf_points: int, branches: int = BRANCHES) -> Tree:
    """A tree whose leaves hold at most ``leaf_points`` of the (unit) points, as far as these can be told apart."""
    tree = Tree()

    def grow(rows: np.ndarray) -> int:
        if tree.centroids and len(rows) <= leaf_points:
            return tree.new_leaf()
        at = len(tree.centroids)
        centers = _centroids(points[rows], min(branches, len(rows)))
        tree.centroids.append(centers)
        tree.children.append([])
        own = (points[rows] @ centers.T).argmax(axis=1)
        for i in range(len(centers)):
            inside = rows[own == i]
            tree.children[at].append(tree.new_leaf() if len(inside) == len(rows) else grow(inside))
        return at

    grow(np.arange(len(points)))
    return tree


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def usable(vectors: Column) -> Column:
    """Whether a vector is neither null nor zero and has only finite components."""
    finite = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vectors, lambda x: x != 0), F.lit(False))


def distinct_vectors(table: DataFrame, k: int, id_col: str, vector_col: str) -> DataFrame:
    """k1, k2 (hashes), vector, ids: the smallest k + 1 ids of each distinct vector."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "size").limit(1).collect()
    rows = rows.where(F.size("vector") == (common[0].size if common else 0))
    keyed = rows.select(F.xxhash64(F.lit(1), "vector").alias("k1"), F.xxhash64(F.lit(2), "vector").alias("k2"), "vector", "id")
    order = Window.partitionBy("k1", "k2").orderBy("id")
    smallest = keyed.withColumn("nth", F.rank().over(order)).where(F.col("nth") <= k + 1).drop("nth")
    return smallest.groupBy("k1", "k2", "vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def _assign(shared):
    @F.arrow_udf("int")
    def assign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            found = shared.value.leaves_of(_unit(_matrix(lists))) if len(lists) else np.zeros(0, dtype=np.int32)
            yield pa.array(found, pa.int32())

    return assign


def best_matches(queries: np.ndarray, vectors: np.ndarray, ids: list[list[int]], most: int) -> list[list[tuple[float, int]]]:
    """Per query the ``most`` best (score, id), best first, ties to smaller ids; scores in double precision."""
    queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
    own, other = np.linalg.norm(queries, axis=1), np.linalg.norm(vectors, axis=1)
    rough = (queries @ vectors.T) / own[:, None] / other[None, :]
    out = []
    for i, scores in enumerate(rough):
        least = np.partition(scores, len(scores) - most)[len(scores) - most] if len(scores) > most else -np.inf
        near = np.flatnonzero(scores >= least - 1e-12)
        exact = np.array([vectors[j] @ queries[i] / (own[i] * other[j]) for j in near])
        found = [(-float(s), x) for s, j in zip(exact, near) for x in ids[j]]
        out.append([(-s, x) for s, x in heapq.nsmallest(most, found)])
    return out


def _rows(keys: list[tuple[int, int]], found: list[list[tuple[float, int]]]) -> list[pa.Array]:
    flat = [(*key, x, s) for key, best in zip(keys, found) for s, x in best]
    return [pa.array([r[i] for r in flat], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))]


FOUND = "k1 long, k2 long, vec_id long, score double"
_NAMES = ["k1", "k2", "vec_id", "score"]


def brute_force(vectors: DataFrame, keys: list[tuple[int, int]], queries: np.ndarray, most: int) -> DataFrame:
    """The true best ``most`` of a bounded set of queries, against all vectors in blocks."""
    shared = ship(vectors.sparkSession).broadcast((keys, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_keys, own = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                found = best_matches(own, _matrix(part.column("vector")), part.column("ids").to_pylist(), most)
                yield pa.RecordBatch.from_arrays(_rows(own_keys, found), names=_NAMES)

    return best_of(vectors.select("vector", "ids").mapInArrow(run, FOUND), most)


def best_of(found: DataFrame, most: int) -> DataFrame:
    """The best ``most`` rows of each query."""
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def visits_for(recall: float, tree: Tree, queries: np.ndarray, true_leaves: list[list[int]]) -> int:
    """Leaves to visit so that the visited ones hold this share of the true neighbours."""
    needed = []
    for query, leaves in zip(queries, true_leaves):
        place = {leaf: i + 1 for i, leaf in enumerate(tree.best_bins(query))}
        needed += [place[leaf] for leaf in leaves]
    needed.sort()
    return needed[min(int(np.ceil(recall * len(needed))), len(needed)) - 1] if needed else 1


def _walk(shared, most: int):
    @F.arrow_udf("array<int>")
    def walk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tree, visits, leaf_rows = shared.value
        for lists in batches:
            routes = []
            for query in _unit(_matrix(lists)) if len(lists) else []:
                route, seen = [], 0
                for leaf in tree.best_bins(query):
                    if len(route) >= visits and seen >= most:
                        break
                    route.append(leaf)
                    seen += leaf_rows[leaf]
                routes.append(route)
            yield pa.array(routes, pa.list_(pa.int32()))

    return walk


def _meet(most: int):
    def meet(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        keys = list(zip(queries.column("k1").to_pylist(), queries.column("k2").to_pylist()))
        found = []
        if keys and vectors.num_rows:
            candidates, ids, own = _matrix(vectors.column("vector")), vectors.column("ids").to_pylist(), _matrix(queries.column("query"))
            for start in range(0, len(keys), 512):
                found += best_matches(own[start : start + 512], candidates, ids, most)
        return pa.Table.from_arrays(_rows(keys, found), names=_NAMES)

    return meet


def search(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
    sample: int = SAMPLE,
    leaf: int = LEAF,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row that ``is_query`` (on ``id``)."""
    spark, most = table.sparkSession, k + 1
    context = ship(spark)
    vectors = stored(distinct_vectors(table, k, id_col, vector_col), "vectors")
    picked = vectors.orderBy("k1", "k2").limit(sample).select("vector").toArrow()  # at most ``sample`` vectors
    if picked.num_rows == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = _unit(_matrix(picked.column("vector")))
    tree = fit_tree(points, max(2, leaf * len(points) // vectors.count()))
    placed = stored(vectors.withColumn("leaf", _assign(context.broadcast(tree))("vector")), "placed")
    leaf_rows = np.zeros(tree.n_leaves, dtype=np.int64)
    for at, n in placed.groupBy("leaf").agg(F.sum(F.size("ids"))).collect():  # one row per leaf
        leaf_rows[at] = n

    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(is_query & usable(F.col("vector")))
    keyed = stored(rows.select("id", F.xxhash64(F.lit(1), "vector").alias("k1"), F.xxhash64(F.lit(2), "vector").alias("k2")).distinct(), "queries")
    asked = vectors.join(small_side(keyed.select("k1", "k2").distinct()), ["k1", "k2"], "left_semi")
    asked = stored(asked.select("k1", "k2", F.col("vector").alias("query")), "asked")

    trial = asked.orderBy("k2", "k1").limit(CALIBRATED).toArrow()
    visits = 1
    if trial.num_rows:
        keys, own = list(zip(trial.column("k1").to_pylist(), trial.column("k2").to_pylist())), _matrix(trial.column("query"))
        truth = brute_force(placed, keys, own, most).select("k1", "k2", "vec_id")
        homes = placed.select(F.explode("ids").alias("vec_id"), "leaf").join(F.broadcast(truth), "vec_id")  # CALIBRATED * most rows
        leaves: dict[tuple[int, int], list[int]] = {}
        for r in homes.collect():
            leaves.setdefault((r.k1, r.k2), []).append(r.leaf)
        visits = visits_for(recall, tree, _unit(own), [leaves.get(key, []) for key in keys])

    shared = context.broadcast((tree, visits, leaf_rows))
    routed = stored(asked.withColumn("leaf", F.explode(_walk(shared, most)("query"))), "routes")
    parts = [
        df.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name)) for df, name in ((placed, "v_blocks"), (routed, "q_blocks"))
    ]
    sizes = F.broadcast(stored(parts[0].join(parts[1], "leaf"), "blocks"))  # one row per leaf

    def dealt(df: DataFrame, own: str, other: str, own_blocks: str, other_blocks: str) -> DataFrame:
        out = df.join(sizes, "leaf").withColumn(own, F.pmod(F.xxhash64("k1", "leaf"), F.col(own_blocks)).cast("int"))
        return out.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1))).drop("v_blocks", "q_blocks")

    unit = ["leaf", "v_block", "q_block"]
    left = dealt(routed, "q_block", "v_block", "q_blocks", "v_blocks").groupBy(*unit)
    right = dealt(placed, "v_block", "q_block", "v_blocks", "q_blocks").select(*unit, "vector", "ids").groupBy(*unit)
    found = best_of(left.cogroup(right).applyInArrow(_meet(most), FOUND), most).drop("rank")

    # an answer has one row more than asked for, as the query itself may be among them
    answers = found.groupBy("k1", "k2").agg(F.collect_list(F.struct((-F.col("score")).alias("order"), "vec_id")).alias("best"))
    joined = keyed.join(answers, ["k1", "k2"])
    others = F.slice(F.filter(F.array_sort("best"), lambda x: x["vec_id"] != F.col("id")), 1, k)
    listed = joined.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x"))
    return listed.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.order")).alias("score")
    )


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)
