"""Exact top-k inner products by a ball tree in each shard.

Vectors are dealt into shards, queries into blocks; a task holds one shard and one block. Its tree bounds the
inner product of a query with anything in a ball by q . centre + |q| radius. Nodes that cannot reach a query's current
k-th score are left out, the others are opened in order of their bounds. A first pass opens only the best leaf
of each shard; the best k-th score over all shards is then shared by all of them in the second pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talweg.llm.common import ready, stage, table

#: Results of a query, vectors of a shard, queries of a block, vectors of a leaf, scale of the integers.
K, SHARD, BLOCK, LEAF, SCALE = 20, 8192, 4096, 64, 64.0
#: Relative room for rounding in a bound, so that no node is left out wrongly.
_ROOM = 1e-9


class Ball:
    """A node over ``points[start:stop]`` of its tree."""

    __slots__ = ("start", "stop", "centre", "radius", "children")

    def __init__(self, start: int, stop: int, points: np.ndarray):
        self.start, self.stop = start, stop
        own = points[start:stop]
        self.centre = own.mean(axis=0)
        self.radius = float(np.sqrt(((own - self.centre) ** 2).sum(axis=1).max()))
        self.children: list[Ball] = []


class BallTree:
    """Split at the median of the widest direction, down to leaves."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids, self.leaf = points.copy(), ids.copy(), leaf
        self.root = self._grow(0, len(points))

    def _grow(self, start: int, stop: int) -> Ball:
        node = Ball(start, stop, self.points)
        if stop - start > self.leaf and node.radius > 0:
            own = self.points[start:stop]
            axis = int(np.argmax(np.ptp(own, axis=0)))
            order, middle = np.argsort(own[:, axis], kind="stable"), (stop - start) // 2
            self.points[start:stop], self.ids[start:stop] = own[order], self.ids[start:stop][order]
            node.children = [self._grow(start, start + middle), self._grow(start + middle, stop)]
        return node

    def leaves(self, queries: np.ndarray, floor: np.ndarray, best_only: bool) -> Iterator[tuple[Ball, np.ndarray, np.ndarray]]:
        """(leaf, queries, bounds) that the floors leave; with ``best_only`` each query goes down one way."""
        norms = np.sqrt((queries**2).sum(axis=1))

        def bound(node: Ball, which: np.ndarray) -> np.ndarray:
            reach = np.sqrt((node.centre**2).sum()) + node.radius
            return queries[which] @ node.centre + norms[which] * (node.radius + _ROOM * (1 + reach))

        def down(node: Ball, which: np.ndarray, bounds: np.ndarray):
            alive = bounds >= floor[which]
            which, bounds = which[alive], bounds[alive]
            if not len(which):
                return
            if not node.children:
                yield node, which, bounds
                return
            below = [bound(child, which) for child in node.children]
            for i, child in enumerate(node.children):
                use = slice(None)
                if best_only:
                    use = below[i] >= below[1 - i] if i == 0 else below[i] > below[1 - i]
                yield from down(child, which[use], np.minimum(below[i], bounds)[use])

        everyone = np.arange(len(queries))
        yield from down(self.root, everyone, bound(self.root, everyone))

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, best_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Best scores and ids of each query, ties to smaller ids; unused places hold -inf.

        ``own`` are ids that a query leaves out, ``floor`` scores that its results must reach.
        """
        count = len(queries)
        scores, ids = np.full((count, k), -np.inf), np.full((count, k), np.iinfo(np.int64).max)
        kth = floor.astype(np.float64).copy()
        plan = list(self.leaves(queries, kth, best_only))
        visits = pd.DataFrame(
            {
                "leaf": np.repeat(np.arange(len(plan)), [len(p[1]) for p in plan]),
                "query": np.concatenate([p[1] for p in plan]) if plan else np.empty(0, np.int64),
                "bound": np.concatenate([p[2] for p in plan]) if plan else np.empty(0),
            }
        )
        visits = visits.sort_values(["query", "bound"], ascending=[True, False], kind="stable")
        visits["turn"] = visits.groupby("query").cumcount()
        for _, turn in visits.groupby("turn"):  # each query's next best leaf
            turn = turn[turn["bound"].to_numpy() >= kth[turn["query"].to_numpy()]]
            for number, group in turn.groupby("leaf"):
                node, which = plan[number][0], group["query"].to_numpy()
                new = queries[which] @ self.points[node.start : node.stop].T
                names = np.broadcast_to(self.ids[node.start : node.stop], new.shape)
                new = np.where(names == own[which, None], -np.inf, new)
                every, named = np.hstack([scores[which], new]), np.hstack([ids[which], names])
                order = np.lexsort((named, -every), axis=-1)[:, :k]
                scores[which], ids[which] = np.take_along_axis(every, order, 1), np.take_along_axis(named, order, 1)
                kth[which] = np.maximum(kth[which], scores[which][:, -1])
        return scores, ids


def _valid(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = F.floor(F.sqrt(F.lit(2.0**53) / F.greatest(F.size("embedding"), F.lit(1)))).cast("double")
    whole = F.transform("embedding", lambda x: F.greatest(-most, F.least(most, F.floor(F.greatest(-most, F.least(most, x.cast("double") * SCALE))).cast("double"))))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long"), whole.alias("v"), F.size("embedding").alias("dim")
    )


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def top_k(vectors: DataFrame, every: int = 20, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of each row whose vec_id is divisible by ``every``.

    Components become floor(64 x). Beyond the root of 2^53 over the number of components (about 185,000 for x in 64 of them) they count as that
    root, so that every sum is an exact integer. Null vectors, those that hold null or non-finite components, and rows without an id
    take no part; vectors are compared with those of the same length. Rows with a query's own id are its own. Repeated
    rows are candidates each, and queries each. Every query meets every shard, in blocks, by trees; only what
    reaches the shared k-th score leaves a task.
    """
    rows = stage(_valid(vectors).withColumn("row", F.monotonically_increasing_id()))
    asked = rows.filter(F.col("vec_id") % every == 0)
    shards, blocks = max(1, -(-rows.count() // shard)), max(1, -(-asked.count() // block))
    points = rows.select("vec_id", "v", "dim", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    queries = asked.select(
        F.col("row").alias("asker"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("dim").alias("q_dim"),
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("q_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("q_shard"),
    )

    def together(queries: DataFrame, function, schema: str) -> DataFrame:
        right = queries.groupBy("q_dim", "q_shard", "q_block")
        return points.groupBy("dim", "shard", "block").cogroup(right).applyInPandas(function, schema)

    def seed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"asker": pd.Series(dtype="int64"), "floor": pd.Series(dtype="float64")})
        tree = BallTree(_matrix(left["v"]), left["vec_id"].to_numpy(), max(LEAF, 2 * k))
        scores, _ = tree.search(_matrix(right["q"]), right["query_id"].to_numpy(), np.full(len(right), -np.inf), k, best_only=True)
        full = np.isfinite(scores[:, -1])
        return pd.DataFrame({"asker": right["asker"].to_numpy()[full], "floor": scores[full, -1]})

    shared = together(queries, seed, "asker long, floor double").groupBy("asker").agg(F.max("floor").alias("floor"))
    informed = queries.join(shared, "asker", "left").select(*queries.columns, F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = {"asker": "int64", "query_id": "int64", "vec_id": "int64", "score": "int64"}
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in empty.items()})
        tree = BallTree(_matrix(left["v"]), left["vec_id"].to_numpy())
        scores, ids = tree.search(_matrix(right["q"]), right["query_id"].to_numpy(), right["floor"].to_numpy(), k)
        q, place = np.nonzero(np.isfinite(scores) & (scores >= right["floor"].to_numpy()[:, None]))
        return pd.DataFrame(
            {
                "asker": right["asker"].to_numpy()[q], "query_id": right["query_id"].to_numpy()[q], "vec_id": ids[q, place],
                "score": scores[q, place].astype(np.int64),
            }
        )

    found = together(informed, search, "asker long, query_id long, vec_id long, score long")
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for every twentieth one."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY rank <= 20
"""

QUERIES = {"op10_topk": ready(op10_topk)}
ORACLES = {"op10_topk": OP10_SQL}
